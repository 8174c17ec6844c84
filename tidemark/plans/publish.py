"""Results shown to others: several tables made visible at once, HTML reports, metric texts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources import files as control


def publish_together(spark: SparkSession, root: str, relations: dict[str, DataFrame], unique: dict[str, list[str]] | None = None) -> str:
    """Write several relations and show all of them by one change of a pointer; a failure before it leaves the old ones.

    ``unique`` names keys that must be single in what was written.
    """
    version = uuid.uuid4().hex
    for name, rows in relations.items():
        rows.write.parquet(f"{root}/versions/{version}/{name}")
    for name, keys in (unique or {}).items():
        if spark.read.parquet(f"{root}/versions/{version}/{name}").groupBy(*keys).count().filter("count > 1").limit(1).count():
            raise ValueError(f"{name} has several rows for one {', '.join(keys)}")
    control.write_json(spark, f"{root}/current.json", {"version": version, "tables": sorted(relations)})
    return version


def published(spark: SparkSession, root: str, name: str) -> DataFrame:
    if not control.exists(spark, f"{root}/current.json"):
        raise LookupError("nothing has been published")
    return spark.read.parquet(f"{root}/versions/{control.read_json(spark, f'{root}/current.json')['version']}/{name}")


def html_report(results: dict[str, DataFrame], rows: int = 200) -> str:
    """One page with a table per result. A result of more than ``rows`` rows is cut, and the page says so and how many there are."""
    parts = []
    for title, frame in results.items():
        shown = frame.limit(rows + 1).toPandas()
        note = f"<p>The first {rows} of {frame.count()} rows.</p>" if len(shown) > rows else ""
        parts.append(f"<h2>{title}</h2>{note}{shown.head(rows).to_html(index=False, na_rep='')}")
    return "<!doctype html><meta charset=\"utf-8\"><title>Report</title>" + "\n".join(parts)


def exposition(metrics: list[dict], prefix: str = "tidemark") -> str:
    """The newest figures per source in the text format that metric scrapers read."""
    newest: dict[str, dict] = {}
    for row in metrics:
        if row["source"] not in newest or row["metric_ts"] >= newest[row["source"]]["metric_ts"]:
            newest[row["source"]] = row
    lines = []
    for source, row in sorted(newest.items()):
        lines.append(f'{prefix}_source_up{{source="{source}"}} {int(row["status"] in ("success", "ok", "noop"))}')
        lines += [f'{prefix}_{k}{{source="{source}"}} {v}' for k, v in sorted(row.items()) if isinstance(v, (int, float)) and not isinstance(v, bool)]
    return "\n".join(lines) + "\n"
