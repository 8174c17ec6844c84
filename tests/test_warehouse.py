from __future__ import annotations

import datetime as dt
from decimal import Decimal

from tidemark.plans import reports
from tidemark.plans.warehouse import Warehouse
from tidemark.sources import external

D1, D2 = dt.date(2026, 2, 1), dt.date(2026, 2, 2)


def write(spark, path, **tables):
    for name in external.STAGING:
        schema = external.STAGING[name] + ", ingest_date date"
        spark.createDataFrame(tables.get(name, []), schema).coalesce(1).write.parquet(f"{path}/stg_{name}.parquet")
    return str(path)


def order(key, customer, day, ingest=D2):
    return (key, customer, "delivered", dt.datetime.combine(day, dt.time(9)) if day else None, None, None, None, None, ingest)


def item(key, n, price, freight="0.00", ingest=D2, product="p", seller="s"):
    return (key, n, product, seller, None, Decimal(price), Decimal(freight), ingest)


def pay(key, n, kind, parts, value, ingest=D2):
    return (key, n, kind, parts, None if value is None else Decimal(value), ingest)


def customer(key, state, ingest=D2):
    return (key, None, None, None, state, ingest)


def test_core_and_marts(spark, tmp_path):
    folder = write(
        spark, tmp_path, customers=[customer("c1", "BE"), customer("c2", "NL"), customer("c3", "BE")], orders=[order("o1", "c1", D1), order("o2", "c2", D1), order("o3", "c3", D2)],
        order_items=[item("o1", 1, "50.00", "5.00"), item("o2", 1, "60.00", "2.00"), item("o2", 2, "40.00", "3.00"), item("o3", 1, "200.00", "10.00")], order_payments=[pay("o1", 1, "credit_card", 3, "55.00"), pay("o2", 1, "voucher", 1, "5.00"), pay("o2", 2, "boleto", 1, "100.00"), pay("o3", 1, "credit_card", 1, "210.00")],
    )
    w = Warehouse(spark, folder)
    core = sorted((r.order_id, r.customer_state, str(r.payment_value), r.main_payment_type, r.max_installments) for r in w.core_orders.collect())
    assert core == [("o1", "BE", "55.00", "credit_card", 3), ("o2", "NL", "105.00", "boleto", 1), ("o3", "BE", "210.00", "credit_card", 1)]
    assert sorted((r.sales_date, r.orders_cnt, r.items_cnt, str(r.gross_sales), str(r.freight_sum)) for r in w.sales_daily.collect()) == [(D1, 2, 3, "150.00", "10.00"), (D2, 1, 1, "200.00", "10.00")]
    assert reports.QUERIES["reconcile_breaks"](spark, folder).count() == 0 and reports.QUERIES["rollup_invariant"](spark, folder).count() == 0
    assert reports.QUERIES["pipeline_audit"](spark, folder).first().status == "success"
    assert {r.status for r in reports.QUERIES["quality_scorecard"](spark, folder).collect()} == {"ok"}


def test_full_join_branches_and_load_predicate(spark, tmp_path):
    folder = write(
        spark, tmp_path, customers=[customer("c", "BE"), customer("c", "BE", D1)],
        orders=[order("same", "c", dt.date(2026, 1, 1)), order("less", "c", dt.date(2026, 1, 2)), order("nocust", "x", dt.date(2026, 1, 3)), order("other-load", "c", dt.date(2026, 1, 4), D1)],
        order_items=[item("same", 1, "10.00"), item("less", 1, "100.00"), item("less", 1, "-10.00", ingest=D1), item("nocust", 1, "100.00"), item("other-load", 1, "70.00")],
    )
    got = {str(r.sales_date): (str(r.mart_gross_sales), str(r.source_gross_sales), str(r.diff_amount)) for r in Warehouse(spark, folder).reconcile_sales_daily.collect()}
    assert got == {"2026-01-01": ("10.00", "10.00", "0.00"), "2026-01-02": ("90.00", "100.00", "-10.00"), "2026-01-03": ("0.00", "100.00", "-100.00"), "2026-01-04": ("70.00", "0.00", "70.00")}


def test_main_payment_type_takes_an_unknown_amount_first(spark, tmp_path):
    folder = write(spark, tmp_path, customers=[customer("c", "BE")], orders=[order("o", "c", D1)], order_payments=[pay("o", 1, "boleto", 1, "9.00"), pay("o", 2, "card", 4, None), pay("o", 3, "voucher", None, "9.00")])
    r = Warehouse(spark, folder).core_orders.first()
    assert (r.main_payment_type, str(r.payment_value), r.max_installments) == ("card", "18.00", 4)


def test_empty_warehouse(spark, tmp_path):
    folder = write(spark, tmp_path)
    assert Warehouse(spark, folder).sales_daily.count() == 0
    assert reports.QUERIES["layer_snapshot"](spark, folder).collect()[0].date_from == "no data"
    assert reports.QUERIES["payment_reconciliation"](spark, folder).count() == 0
