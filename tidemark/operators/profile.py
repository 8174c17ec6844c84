"""Exact column profiles, load by load.

All columns are unpivoted to (load, column, value) and counted once; the counts are reduced on the map side, so a value that
fills a third of a table crosses the shuffle once per task. Null rates, distinct counts, ranges, patterns, the commonest value
and exact quantiles all come from these frequencies, as do chi-square and population stability between loads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.text import day_text

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def frequencies(rows: DataFrame, load: str, columns: list[str] | None = None) -> DataFrame:
    """``(load_day, column_name, value, number, n)``: how often each value occurs per load; NULL counts as a value.

    ``number`` is the value of a numeric column as double, else NULL. A NULL load is a load of its own.
    """
    columns = columns or [c for c in rows.columns if c != load]
    numeric = {c for c, t in rows.dtypes if t.startswith(NUMERIC)}
    number = lambda c: F.col(c).cast("double") if c in numeric else F.lit(None).cast("double")
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value"), number(c).alias("number")) for c in columns])
    return rows.select(day_text(load).alias("load_day"), F.inline(cells)).groupBy("load_day", "column_name", "value", "number").agg(F.count(F.lit(1)).alias("n"))


def is_blank(value: Column) -> Column:
    return F.btrim(value, F.lit(" \t")) == ""


def lower_median(freq: DataFrame, splits: int = 64) -> DataFrame:
    """``(load_day, column_name, median_value)``: smallest number that at least half of the numbers do not exceed.

    The numbers are cut at ``splits`` approximate quantiles; only the piece that holds the half is sorted, so no task sorts
    all distinct values of a load. The result is exact: a poor cut only makes a piece larger.
    """
    by = ["load_day", "column_name"]
    numbers = freq.filter("number IS NOT NULL").select(*by, "number", "n")
    cuts = numbers.groupBy(*by).agg(F.percentile_approx("number", [i / splits for i in range(1, splits)], F.lit(1000)).alias("cuts"), F.sum("n").alias("total"))
    # one row per load and column
    placed = numbers.join(F.broadcast(cuts).withColumnsRenamed({c: f"c_{c}" for c in by}), F.col("load_day").eqNullSafe(F.col("c_load_day")) & (F.col("column_name") == F.col("c_column_name")))
    placed = placed.select(*by, "number", "n", "total", F.size(F.filter("cuts", lambda x: x < F.col("number"))).alias("piece"))
    sizes = placed.groupBy(*by, "piece").agg(F.sum("n").alias("in_piece"), F.first("total").alias("total"))
    up_to = Window.partitionBy(*by).orderBy("piece").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    half = sizes.withColumn("reached", F.sum("in_piece").over(up_to)).filter("reached * 2 >= total AND (reached - in_piece) * 2 < total").select(*by, "piece", (F.col("reached") - F.col("in_piece")).alias("skipped"))
    inside = placed.join(F.broadcast(half).withColumnsRenamed({"load_day": "h_load_day", "column_name": "h_column_name", "piece": "h_piece"}), F.col("load_day").eqNullSafe(F.col("h_load_day")) & (F.col("column_name") == F.col("h_column_name")) & (F.col("piece") == F.col("h_piece")))
    running = Window.partitionBy(*by).orderBy("number").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = inside.withColumn("reached", F.col("skipped") + F.sum("n").over(running)).filter("reached * 2 >= total")
    return reached.groupBy(*by).agg(F.min("number").alias("median_value"))


def profile(freq: DataFrame, patterns: dict[str, str] | None = None) -> DataFrame:
    """One row per load and column with all metrics; a metric that has no value to look at is NULL."""
    by = ["load_day", "column_name"]
    pattern = F.lit(None).cast("boolean")
    for column, regex in (patterns or {}).items():
        pattern = F.when(F.col("column_name") == column, F.col("value").rlike(f"^(?:{regex})$")).otherwise(pattern)
    known, n = F.col("value").isNotNull(), F.col("n")
    some = F.coalesce(F.sum(F.when(known, n)), F.lit(0))
    base = freq.groupBy(*by).agg(
        F.sum(n).alias("rows"),
        (F.coalesce(F.sum(F.when(~known, n)), F.lit(0)) / F.sum(n)).alias("null_share"),
        (F.coalesce(F.sum(F.when(is_blank(F.col("value")), n)), F.lit(0)) / F.sum(n)).alias("blank_share"),
        (F.coalesce(F.max(F.when(known, n)), F.lit(0)) / F.sum(n)).alias("top_share"),
        (F.sum(F.when(pattern, n).when(~pattern, F.lit(0))) / F.when(some > 0, some)).alias("pattern_share"),
        F.count_if(known).cast("double").alias("distinct_count"),
        F.min("number").alias("min_value"),
        F.max("number").alias("max_value"),
    )
    median = lower_median(freq).withColumnsRenamed({"load_day": "m_load_day", "column_name": "m_column_name"})
    return base.join(median, F.col("load_day").eqNullSafe(F.col("m_load_day")) & (F.col("column_name") == F.col("m_column_name")), "left").drop("m_load_day", "m_column_name")


METRICS = ("null_share", "blank_share", "top_share", "pattern_share", "distinct_count", "min_value", "max_value", "median_value")


def outside_baseline(profiled: DataFrame, table_name: str, baseline: DataFrame) -> DataFrame:
    """``(table_name, column_name, metric, load_day)`` of metrics below the low or above the high bound. A NULL metric or bound is no case."""
    stacked = profiled.select("load_day", "column_name", F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("measured")) for m in METRICS])))
    bounds = baseline.filter(F.col("table_name") == table_name).select("table_name", "column_name", "metric", "low_bound", "high_bound")
    found = stacked.join(bounds, ["column_name", "metric"]).filter("measured < low_bound OR measured > high_bound")
    return found.select("table_name", "column_name", "metric", "load_day").distinct()


def recount_items(items: DataFrame) -> DataFrame:
    """Per ingest day: rows with a NULL key column, and (order_id, order_item_id) pairs as stored that have more than one row."""
    null_key = F.greatest(*[F.col(c).isNull().cast("int") for c in ("order_id", "order_item_id", "product_id", "seller_id")])
    grains = items.groupBy("ingest_date", "order_id", "order_item_id").agg(F.count(F.lit(1)).alias("n"), F.sum(null_key).alias("nulls"))
    twice = (F.col("n") > 1) & F.col("order_id").isNotNull() & F.col("order_item_id").isNotNull()
    return grains.groupBy(day_text("ingest_date").alias("load_day")).agg(F.sum("nulls").alias("null_key_rows"), F.count_if(twice).alias("duplicate_grain_rows"))


def wrong_counts(runs: DataFrame, items: DataFrame) -> DataFrame:
    """Counts of each load's latest run that differ from a recount. Runs without an ingestion run belong to no load; a load without rows counts 0; a NULL count differs."""
    dated = runs.withColumn("load_day", F.regexp_extract("ingestion_run_id", r"(\d{4}-\d{2}-\d{2})", 1)).filter("load_day <> ''")
    columns = ("null_key_rows", "duplicate_grain_rows")
    latest = dated.groupBy("load_day").agg(F.max_by(F.struct(*columns), F.struct("run_ts", "run_id")).alias("said"))
    true = recount_items(items).select("load_day", *[F.col(c).alias(f"true_{c}") for c in columns])
    both = latest.join(true, "load_day", "left")
    wrong = F.filter(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"said.{c}").eqNullSafe(F.coalesce(f"true_{c}", F.lit(0))).alias("right")) for c in columns]), lambda x: ~x["right"])
    return both.select("load_day", F.inline(wrong)).select(F.lit("pipeline_runs").alias("table_name"), "column_name", F.lit("recount").alias("metric"), "load_day")


#: Pieces of equal weight that a load's numbers are cut into for comparison, and most distinct values that are compared one by one.
BINS, MOST_VALUES = 10, 64


def rulers(freq: DataFrame, bins: int = BINS, splits: int = 64) -> DataFrame:
    """``(load_day, column_name, many, edges)``: what the next load of a column is measured with.

    ``edges`` are the exact lower quantiles i/``bins`` of the load's numbers, NULL for a column without numbers. ``many`` says that
    values are too many to be compared one by one: more than ``MOST_VALUES``, or more than ``bins`` and half of the rows with a value.
    As in ``lower_median`` the numbers are cut at ``splits`` approximate quantiles and each piece is sorted for itself.
    """
    by = ["load_day", "column_name"]
    known = F.col("value").isNotNull()
    width = freq.groupBy(*by).agg(F.count_if(known).alias("values"), F.sum(F.when(known, F.col("n"))).alias("filled"))
    many = (F.col("values") > MOST_VALUES) | (F.col("values") > bins) & (F.col("values") * 2 > F.col("filled"))
    numbers = freq.filter("number IS NOT NULL").select(*by, "number", "n")
    cuts = numbers.groupBy(*by).agg(F.percentile_approx("number", [i / splits for i in range(1, splits)], F.lit(1000)).alias("cuts"), F.sum("n").alias("total"))
    at = lambda x: F.col("load_day").eqNullSafe(F.col(f"{x}_load_day")) & (F.col("column_name") == F.col(f"{x}_column_name"))
    # one row per load and column
    placed = numbers.join(F.broadcast(cuts).withColumnsRenamed({c: f"c_{c}" for c in by}), at("c"))
    placed = placed.select(*by, "number", "n", "total", F.size(F.filter("cuts", lambda x: x < F.col("number"))).alias("piece"))
    before = Window.partitionBy(*by).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy(*by, "piece").agg(F.sum("n").alias("in_piece")).select(*by, "piece", F.coalesce(F.sum("in_piece").over(before), F.lit(0)).alias("skipped"))
    # one row per load, column and piece, of which there are at most ``splits``
    inside = placed.join(F.broadcast(sizes).withColumnsRenamed({"load_day": "s_load_day", "column_name": "s_column_name", "piece": "s_piece"}), at("s") & (F.col("piece") == F.col("s_piece")))
    running = Window.partitionBy(*by, "piece").orderBy("number").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = inside.withColumn("reached", F.col("skipped") + F.sum("n").over(running))
    edges = reached.groupBy(*by).agg(F.array(*[F.min(F.when(F.col("reached") * bins >= F.col("total") * i, F.col("number"))) for i in range(1, bins)]).alias("edges"))
    joined = width.join(F.broadcast(edges).withColumnsRenamed({c: f"e_{c}" for c in by}), at("e"), "left")
    return joined.select(*by, F.coalesce(many, F.lit(False)).alias("many"), "edges")


def text_form(value: Column) -> Column:
    """Length of a text and the kinds of characters in it: what can be compared of texts that hardly come twice."""
    kinds = [F.when(value.rlike(regex), name).otherwise("") for regex, name in ((r"\p{Ll}", "a"), (r"\p{Lu}", "A"), (r"\d", "9"), (r"[ \t]", "_"), (r"[^\p{L}\d \t]", "-"))]
    return F.concat(F.length(value).cast("string"), F.lit(":"), *kinds)


def load_drift(freq: DataFrame, floor: float = 1e-6, measures: DataFrame | None = None) -> DataFrame:
    """Chi-square and population stability index of each load's value distribution against the load before it, per column.

    A value missing on one side counts with the share ``floor`` for the index. Columns in which every value is nearly unique
    give large figures by nature, unless ``measures`` (see ``rulers``) are given: where the earlier load has too many values,
    both loads' numbers are counted in the bins of the earlier load, both loads' texts by ``text_form``; NULL stays a value of
    its own. The first load of a column has no row.
    """
    by = ["load_day", "column_name"]
    totals = freq.groupBy(*by).agg(F.sum("n").alias("total"))
    in_order = Window.partitionBy("column_name").orderBy("load_day")
    pairs = totals.select("column_name", "load_day", "total", F.lag("load_day").over(in_order).alias("before_day"), F.lag("total").over(in_order).alias("before_total")).filter("before_day IS NOT NULL")
    value = F.coalesce("value", F.lit("\u0000null"))
    if measures is not None:
        # one row per load and column
        pairs = pairs.join(F.broadcast(measures).withColumnsRenamed({"load_day": "before_day", "column_name": "m_column_name"}), ["before_day"]).filter("column_name = m_column_name").drop("m_column_name")
        bin_of = F.size(F.filter("edges", lambda x: x < F.col("number"))).cast("string")
        value = F.when(~F.col("many") | F.col("value").isNull(), value).when(F.col("edges").isNotNull(), bin_of).otherwise(text_form(F.col("value")))
    now = freq.join(pairs, by).select("column_name", "load_day", value.alias("v"), F.col("n").alias("now"), F.lit(0).cast("bigint").alias("was"), "total", "before_total")
    then = freq.withColumnRenamed("load_day", "before_day").join(pairs, ["column_name", "before_day"]).select("column_name", "load_day", value.alias("v"), F.lit(0).cast("bigint").alias("now"), F.col("n").alias("was"), "total", "before_total")
    each = now.unionByName(then).groupBy("column_name", "load_day", "v").agg(F.sum("now").alias("now"), F.sum("was").alias("was"), F.first("total").alias("total"), F.first("before_total").alias("before_total"))
    p, q = F.greatest(F.col("now") / F.col("total"), F.lit(floor)), F.greatest(F.col("was") / F.col("before_total"), F.lit(floor))
    both = F.col("now") + F.col("was")
    all_rows = F.col("total") + F.col("before_total")
    expected_now, expected_was = both * F.col("total") / all_rows, both * F.col("before_total") / all_rows
    chi = F.pow(F.col("now") - expected_now, F.lit(2)) / expected_now + F.pow(F.col("was") - expected_was, F.lit(2)) / expected_was
    return each.groupBy("column_name", "load_day").agg(F.round(F.sum(chi), 6).alias("chi_square"), (F.count(F.lit(1)) - 1).alias("degrees"), F.round(F.sum((p - q) * F.log(p / q)), 6).alias("psi"))
