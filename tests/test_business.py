from pyspark.sql import functions as F

from lakestrata.functions.business import (
    normalize_customer_id, normalize_customer_name, rebate_columns, rebate_cutoff,
)


def test_customer_id_map(spark):
    # Ints are mapped, others and null pass through
    df = spark.createDataFrame([(1064,), (1314,), (7,), (None,)], "c int")
    assert [r.v for r in df.select(normalize_customer_id(F.col("c")).alias("v")).collect()] == [1015, 1005, 7, None]


def test_customer_name_map_exact(spark):
    # Exact and case-sensitive; null passes through
    df = spark.createDataFrame([("OMNICARE",), ("omnicare",), ("Owens & Minor",), (None,)], "n string")
    got = [r.v for r in df.select(normalize_customer_name(F.col("n")).alias("v")).collect()]
    assert got == ["CVS/Omnicare", "omnicare", "Owens", None]


def test_rebate_cutoff(spark):
    # D3 / Q18: 1 Jan of the previous year of as_of
    assert spark.range(1).select(rebate_cutoff("1999-06-01").alias("c")).first().c.isoformat() == "1998-01-01T00:00:00"


def test_rebate_rules(spark):
    # Q19 / Q20: every rule of the rebate name extraction
    data = [
        ("422200", "1998-03-01", "Mckesson Q1 rebate", "Mckesson", 1004),
        ("422200", "1997-12-31", "Mckesson Q1 rebate", "", None),        # before cutoff
        ("410000", "1998-03-01", "Mckesson Q1 rebate", "", None),        # other account
        (None, "1998-03-01", "Mckesson Q1 rebate", "", None),            # null account
        ("422200.0", "1998-03-01", "Mckesson Q1 rebate", "", None),      # float-looking account never matches
        ("422200", "1998-03-01", "Owens/Retro Rebate FY 2025", "", None),  # excluded reference
        ("422200", "1998-03-01", "Medline", "", None),                   # no space
        ("422200", "1998-03-01", "Retro adj", "", None),                 # excluded prefix
        ("422200", "1998-03-01", "Income misc", "", None),
        ("422200", "1998-03-01", " lead space", "", None),               # leading space -> ''
        ("422200", "1998-03-01", "Zed unmapped", "Zed", None),           # unmapped -> null id
        ("422200", "1998-03-01", None, "", None),
        ("422200", "not a date", "Cardinal rebate", "", None),           # unparsable date -> ineligible
        ("422200", None, "Cardinal rebate", "", None),
        ("422200", "1998-03-01", "Owens Q2", "Owens", 1005),
    ]
    df = spark.createDataFrame(data, "acct string, d string, ref string, en string, eid int")
    name, rid = rebate_columns(F.col("acct"), F.col("d"), F.col("ref"), as_of="1999-06-01")
    for r in df.select("*", name.alias("n"), rid.alias("i")).collect():
        assert (r.n, r.i) == (r.en, r.eid), r


def test_rebate_rule_on_generated_ledger_rows(spark):
    # Q19 as a property, against a plain statement of the rule: the first word of the reference
    # when the row is on the rebate account, dated on/after the cutoff, not the excluded
    # reference, contains a space and does not start with an excluded prefix; else ''.
    # The id is the mapped id of a non-empty name.
    import datetime as dt
    from hypothesis import given, settings, strategies as st
    from lakestrata.functions.business import (
        REBATE_CUSTOMER_ID_MAPPING, REBATE_EXCLUDED_PREFIXES, REBATE_EXCLUDED_REFS, SALES_REBATE_ACCOUNT,
    )
    cutoff = dt.date(1998, 1, 1)  # as_of 1999-06-01

    def rule(acct, date, ref):
        text = ref or ""
        first = text.split(" ", 1)[0]
        eligible = acct == SALES_REBATE_ACCOUNT and date is not None and dt.date.fromisoformat(date) >= cutoff
        valid = (eligible and text not in REBATE_EXCLUDED_REFS and " " in text
                 and first not in REBATE_EXCLUDED_PREFIXES)
        name = first if valid else ""
        return name, (REBATE_CUSTOMER_ID_MAPPING.get(name) if name else None)

    words = list(REBATE_CUSTOMER_ID_MAPPING) + list(REBATE_EXCLUDED_PREFIXES) + ["Zed", "rebate", "Q1", "", "FY"]
    refs = st.one_of(st.none(), st.sampled_from(REBATE_EXCLUDED_REFS),
                     st.lists(st.sampled_from(words), min_size=1, max_size=4).map(" ".join))
    dates = st.one_of(st.none(), st.dates(dt.date(1996, 1, 1), dt.date(2000, 12, 31)).map(dt.date.isoformat))
    rows_ = st.tuples(st.sampled_from([SALES_REBATE_ACCOUNT, "410000", None]), dates, refs)

    @settings(max_examples=5, deadline=None)
    @given(st.lists(rows_, min_size=1, max_size=200))
    def check(data):
        df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "i int, acct string, d string, ref string")
        name, rid = rebate_columns(F.col("acct"), F.col("d"), F.col("ref"), "1999-06-01")
        got = {r.i: (r.n, r.id) for r in df.select("i", name.alias("n"), rid.alias("id")).collect()}
        assert got == {i: rule(*r) for i, r in enumerate(data)}

    check()
