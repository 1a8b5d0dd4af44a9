from decimal import Decimal

from lakestrata.operators.ledger import fact_general_ledger, margin_rebate
from lakestrata.schemas import BRONZE


def _gl(spark, data):
    return spark.createDataFrame(data, BRONZE["general_ledger"])


def test_margin_rebate_groups(spark):
    gl = _gl(spark, [
        (1, "422200", "1998-02-01", "10.5", "", "S", "Mckesson a"),
        (2, "422200", "1998-02-02", "2", "", "S", "Mckesson b"),
        (3, "422200", "1998-02-02", "5", "", "S", "Zed unmapped"),     # null id: dropped (Q2)
        (4, "410000", "1998-02-02", "7", "", "S", "Mckesson c"),       # other account
        (5, "422200", "1998-02-02", "bad", "", "S", "Owens x"),        # bad amount -> 0
    ])
    got = sorted(tuple(r) for r in margin_rebate(fact_general_ledger(gl, as_of="1999-01-01")).collect())
    assert got == [("Mckesson", 1004, Decimal("12.5000")), ("Owens", 1005, Decimal("0.0000"))]


def test_margin_rebate_empty_keeps_schema(spark):
    gl = _gl(spark, [(1, "410000", "1998-02-01", "1", "1", "S", "Mckesson a")])
    out = margin_rebate(fact_general_ledger(gl, as_of="1999-01-01"))
    assert out.count() == 0
    assert out.columns == ["RebateCustomerName", "RebateCustomerID", "Domestic_Amount"]


def test_fact_general_ledger_types(spark):
    gl = _gl(spark, [(1, "422200", "1998-02-01 00:00:00", "1.5", "", "S", "Cardinal rebate")])
    r = fact_general_ledger(gl, as_of="1999-01-01").first()
    assert (r.Domestic_Amount, r.Foreign_Amount, r.RebateCustomerName, r.RebateCustomerID) == (
        Decimal("1.5"), Decimal("0"), "Cardinal", 1008)
