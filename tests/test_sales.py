import datetime as dt
from decimal import Decimal

import pytest

from lakestrata.operators.quality import QualityError, assert_positive
from lakestrata.operators.sales import (
    enrich_sales, sales_by_product, sales_by_region, sales_rollup, summary_breakdown, summary_document,
    summary_totals,
)
from lakestrata.schemas import BRONZE

# The five ERP rows of the reference's sample feed.
ERP = [(1001, "C001", "Widget A", 2, Decimal("29.99"), dt.date(2025, 1, 1), "East"),
       (1002, "C002", "Widget B", 1, Decimal("49.99"), dt.date(2025, 1, 1), "West"),
       (1003, "C001", "Widget A", 3, Decimal("29.99"), dt.date(2025, 1, 1), "East"),
       (1004, "C003", "Widget C", 1, Decimal("79.99"), dt.date(2025, 1, 1), "North"),
       (1005, "C002", "Widget B", 2, Decimal("49.99"), dt.date(2025, 1, 1), "West")]


@pytest.fixture
def silver(spark):
    return enrich_sales(spark.createDataFrame(ERP, BRONZE["sales"]), now="2025-01-01 12:00:00")


def test_golden_by_region(silver):
    got = {r.region: (r.order_count, r.total_quantity, r.total_revenue)
           for r in sales_by_region(silver, "2025-01-01").collect()}
    assert got == {"East": (2, 5, Decimal("149.95")), "West": (2, 3, Decimal("149.97")),
                   "North": (1, 1, Decimal("79.99"))}


def test_golden_by_product_and_summary(silver):
    got = {r.product: r.total_revenue for r in sales_by_product(silver).collect()}
    assert got == {"Widget A": Decimal("149.95"), "Widget B": Decimal("149.97"), "Widget C": Decimal("79.99")}
    s = summary_totals(silver, "2025-01-01", "2025-01-01-00").first()
    assert (s.total_orders, s.total_revenue, s.avg_order_value) == (5, Decimal("379.91"), Decimal("75.9820"))


def test_rollup_matches_separate_aggregates(silver):
    r = {(x.grouping, x.key): x for x in sales_rollup(silver).collect()}
    assert r[("region", "East")].total_revenue == Decimal("149.95")
    assert r[("product", "Widget C")].order_count == 1
    assert r[("total", None)].total_orders == 5


def test_summary_document_maps(silver):
    d = summary_document(silver, "2025-01-01", "2025-01-01-00", now="2025-01-01 12:00:00").first()
    assert d.by_region == {"East": Decimal("149.95"), "North": Decimal("79.99"), "West": Decimal("149.97")}
    assert d.by_product["Widget B"] == Decimal("149.97")
    assert d.total_revenue == Decimal("379.91")


def test_null_keys_and_counts(spark):
    # Q2 null group dropped, Q3 all-null sum is 0, Q4 order_count counts non-null ids
    data = [(None, "c", "p", 1, None, None, "East"), (7, "c", "p", 2, None, None, "East"),
            (8, "c", "p", 1, Decimal("1"), None, None)]
    silver = enrich_sales(spark.createDataFrame(data, BRONZE["sales"]))
    got = {r.region: (r.order_count, r.total_quantity, r.total_revenue) for r in sales_by_region(silver).collect()}
    assert got == {"East": (1, 3, Decimal("0"))}
    assert summary_totals(silver).first().total_orders == 3
    assert summary_breakdown(silver, "region").count() == 1


@pytest.mark.parametrize("data", [
    [],                                                         # empty batch
    [(1, "c", "p", None, None, None, "E")],                     # null-only
    [(1, "c", "p", 0, Decimal("1"), None, "E")],                # zero quantity
    [(1, "c", "p", 1, Decimal("1"), None, "E"), (2, "c", "p", 1, Decimal("-1"), None, "E")],  # one negative
])
def test_silver_gate_fails(spark, data):
    # X1 / Q33
    with pytest.raises(QualityError):
        assert_positive(spark.createDataFrame(data, BRONZE["sales"]), ("quantity", "unit_price"))


def test_summary_documents_per_partition_and_key_guard(silver):
    # A3+A4 per partition in one pass: the golden five rows split over two partitions
    from pyspark.sql import functions as F
    from lakestrata.operators.sales import summary_documents_from_rollup
    parts = silver.withColumn("partition", F.when(F.col("order_id") <= 1002, "p1").otherwise("p2"))
    docs = {r.partition: r for r in summary_documents_from_rollup(sales_rollup(parts, ["partition"]), "2025-01-01").collect()}
    assert (docs["p1"].total_orders, docs["p1"].total_revenue) == (2, Decimal("109.97"))
    assert docs["p1"].by_region == {"East": Decimal("59.98"), "West": Decimal("49.99")}
    assert (docs["p2"].total_orders, docs["p2"].total_revenue) == (3, Decimal("269.94"))
    assert docs["p2"].by_product == {"Widget A": Decimal("89.97"), "Widget B": Decimal("99.98"),
                                     "Widget C": Decimal("79.99")}
    with pytest.raises(ValueError):  # p2 has 3 products: over a 2-key limit the maps are refused
        summary_documents_from_rollup(sales_rollup(parts, ["partition"]), "2025-01-01", max_keys=2)


def test_summary_document_of_empty_input_is_a_zero_document(spark):
    empty = enrich_sales(spark.createDataFrame([], BRONZE["sales"]), now="2025-01-01 12:00:00")
    doc = summary_document(empty, "2025-01-01", "2025-01-01-00").collect()
    assert len(doc) == 1 and (doc[0].total_orders, doc[0].total_revenue) == (0, Decimal("0.00"))
    assert doc[0].by_region == {} and doc[0].partition == "2025-01-01-00"


def test_sales_by_region_matches_brute_force(spark):
    # A1 with Q2-Q4 as a property: null regions dropped, order_count counts non-null ids,
    # sums of all-null values are 0, money exact to the cent
    from collections import defaultdict
    from hypothesis import given, settings, strategies as st

    row = st.tuples(st.one_of(st.none(), st.integers(1, 50)), st.sampled_from(["East", "West", None]),
                    st.one_of(st.none(), st.integers(1, 5)),
                    st.one_of(st.none(), st.sampled_from([Decimal("1.25"), Decimal("19.99"), Decimal("0.10")])))

    @settings(max_examples=6, deadline=None)
    @given(st.lists(row, min_size=1, max_size=40))
    def check(data):
        bronze = spark.createDataFrame([(oid, "C", "W", q, p, dt.date(2025, 1, 1), region)
                                        for oid, region, q, p in data], BRONZE["sales"])
        got = {r.region: (r.order_count, r.total_quantity, r.total_revenue)
               for r in sales_by_region(enrich_sales(bronze, now="2025-01-01 00:00:00"), "2025-01-01").collect()}
        want = defaultdict(lambda: [0, 0, Decimal("0.00")])
        for oid, region, q, p in data:
            if region is None:
                continue
            w = want[region]
            w[0] += oid is not None
            w[1] += q or 0
            w[2] += (Decimal(q) * p).quantize(Decimal("0.01")) if q is not None and p is not None else 0
        assert got == {k: (v[0], v[1], Decimal(v[2]).quantize(Decimal("0.01"))) for k, v in want.items()}

    check()
