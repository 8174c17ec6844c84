from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.functions.canonical import canonical_json, payload_digest
from tidemark.plans import lakehouse, publish
from tidemark.sources import catalog


def test_tables_appear_together(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(LookupError):
        publish.published(spark, root, "a")
    publish.publish_together(spark, root, {"a": spark.range(3), "b": spark.range(2)}, {"a": ["id"]})
    with pytest.raises(ValueError):
        publish.publish_together(spark, root, {"a": spark.range(5).union(spark.range(1)), "b": spark.range(9)}, {"a": ["id"]})
    assert publish.published(spark, root, "a").count() == 3 and publish.published(spark, root, "b").count() == 2


def test_texts(spark):
    html = publish.html_report({"Numbers": spark.range(2).withColumn("x", F.lit(None).cast("string"))})
    assert "<h2>Numbers</h2>" in html and "<td>1</td>" in html
    assert "rows.</p>" not in html and "The first 3 of 7 rows." in publish.html_report({"N": spark.range(7)}, rows=3)
    text = publish.exposition([{"metric_ts": 1, "source": "w", "status": "failed", "rows": 1}, {"metric_ts": 2, "source": "w", "status": "success", "rows": 5}])
    assert 'tidemark_source_up{source="w"} 1' in text and 'tidemark_rows{source="w"} 5' in text


def test_canonical(spark):
    rows = spark.createDataFrame([("ü", None, 2)], "order_id string, customer string, business_version bigint")
    a = rows.select(canonical_json({c: F.col(c) for c in rows.columns}).alias("t")).withColumn("d", payload_digest(F.col("t"))).first()
    assert a.t == '{"business_version":2,"customer":null,"order_id":"ü"}' and len(a.d) == 64


def test_catalog(spark, tmp_path):
    spark.range(1).write.parquet(f"{tmp_path}/nums.parquet")
    assert catalog.register_views(spark, str(tmp_path)) == ["nums"]
    assert [tuple(r) for r in catalog.columns(spark, "nums").collect()] == [("nums", 0, "id", "bigint")]
    assert catalog.tables(spark).filter("table_name = 'nums'").count() == 1
    catalog.check_contract(spark.table("nums"), "id bigint")
    with pytest.raises(TypeError):
        catalog.check_contract(spark.table("nums"), "id int")


def test_overlaps(spark):
    schema = "load_id string, source_paths array<string>, bronze_data_files array<string>"
    manifests = spark.createDataFrame([("a", ["s1"], ["f1"]), ("b", ["s2"], ["f2"]), ("c", ["s3"], ["f9"]), ("d", [], [])], schema)
    flying = spark.createDataFrame([("b", [], []), ("x", ["s1"], ["f9"]), ("y", ["f2"], [])], schema)
    assert sorted(r.load_id for r in lakehouse.overlapping(manifests, flying).collect()) == ["a", "b", "c"]
