"""Column builders: pure ``Column -> Column`` functions, all JVM-side expressions."""

from lakestrata.functions.coerce import (  # noqa: F401
    col_or_null, strip_ws, to_decimal_or_zero, to_decimal_or_null, to_int_or_null,
    parse_timestamp, id_from_text,
)
from lakestrata.functions.business import (  # noqa: F401
    normalize_customer_id, normalize_customer_name, rebate_cutoff, rebate_columns,
)
from lakestrata.functions.timefmt import (  # noqa: F401
    partition_of, watermark_literal, hours_between,
)
