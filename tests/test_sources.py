from __future__ import annotations

import pytest

from tidemark.sources import external
from tidemark.sources.tables import stream_path


def test_csv_staging(spark, tmp_path):
    path = str(tmp_path / "p.csv")
    (tmp_path / "p.csv").write_text('order_id,payment_sequential,payment_type,payment_installments,payment_value\na,1,"","3",10.50\n"b\nc",,card,,\n')
    rows = [tuple(r)[:5] for r in external.staged_csv(spark, path, "order_payments", "2026-01-01").collect()]
    assert [(r[0], r[1], r[2], r[3], None if r[4] is None else str(r[4])) for r in rows] == [("a", 1, "", 3, "10.50"), ("b\nc", None, "card", None, None)]
    assert external.csv_records(spark, path) == 2
    (tmp_path / "bad.csv").write_text("order_id,payment_sequential,payment_type,payment_installments,payment_value\na,x,card,1,1\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        external.staged_csv(spark, str(tmp_path / "bad.csv"), "order_payments", "2026-01-01").collect()
    whole = dict.fromkeys(external.STAGING, 2)
    external.loaded_whole(whole, whole)
    for wrong in ({**whole, "orders": 1}, {**whole, "orders": 0}):
        with pytest.raises(ValueError):
            external.loaded_whole(whole, wrong)


def test_synthetic_events_repeat(spark):
    a, b = (external.synthetic_events(spark, 500, seed=7) for _ in range(2))
    assert a.exceptAll(b.repartition(3)).isEmpty() and a.select("order_id").distinct().count() == 500
    low, high = a.selectExpr("min(amount)", "max(amount)").first()
    assert 5 <= low and high <= 500
    assert not external.synthetic_events(spark, 500, seed=8).exceptAll(a).isEmpty()


def test_stream_path_matches_itself():
    assert stream_path("/x/t.parquet") == "/x/t.parque[t]"
