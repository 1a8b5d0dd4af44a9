from decimal import Decimal

from lakestrata.operators.facts import dim_customer, fact_invoice, fact_invoice_detail, fact_order_item
from lakestrata.schemas import BRONZE


def test_fact_invoice_measures(spark):
    item = spark.createDataFrame([("  INV1 ", 1, "CO1", 1, "P1", "2025-01-15", "2", "10.5", "7.25", None),
                                  ("INV2", 1, "CO2", 1, "P2", "bad", "n/a", "3", "1", None)], BRONZE["invoice_item"])
    r = {x.InvoiceID: x for x in fact_invoice(item).collect()}
    assert set(r) == {"INV1", "INV2"}  # trimmed (Q10)
    a = r["INV1"]
    assert (a.QtyInvoiced, a.ExtendedPrice, a.TotalCost, a.Margin) == (
        Decimal("2.0000"), Decimal("21.0000"), Decimal("14.5000"), Decimal("6.5000"))
    b = r["INV2"]
    assert b.InvoiceDate is None and b.QtyInvoiced == 0 and b.Margin == 0


def test_fact_invoice_detail_keeps_raw_id(spark):
    hdr = spark.createDataFrame([("  INV1 ", 1064, None), ("INV2", None, None)], BRONZE["invoice_header"])
    got = sorted(fact_invoice_detail(hdr).collect(), key=lambda r: r.InvoiceID)
    assert [(r.InvoiceID, r.CustomerID) for r in got] == [("  INV1 ", 1015), ("INV2", None)]


def test_fact_order_item(spark):
    oi = spark.createDataFrame([("CO1", 2, "P1", "5", "pending", "1.5", "2.5", "Widget", None)], BRONZE["order_item"])
    r = fact_order_item(oi).first()
    assert (r.OrderLine, r.QtyOrdered, r.QtyShipped, r.Cost, r.Price, r.ProductName) == (
        2, Decimal("5"), Decimal("0"), Decimal("1.5"), Decimal("2.5"), "Widget")


def test_dim_customer(spark):
    ca = spark.createDataFrame([(1, 0, "Kaleida Health"), (1, 1, None)], BRONZE["customer_address"])
    got = sorted((r.CustomerSequence, r.CustomerName) for r in dim_customer(ca).collect())
    assert got == [(0, "Olean General"), (1, None)]
