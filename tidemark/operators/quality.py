"""Quality rules and generic expectations; an expectation returns the rows that break it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

VALID_STATUSES = ("created", "paid", "shipped", "delivered")


def rules(columns: list[str]) -> dict[str, Column]:
    """Rule name to the condition of a violation, for the columns that exist. A NULL status is as invalid as an unknown one."""
    every = {
        "order_id_null": ("order_id", lambda c: c.isNull()),
        "amount_null_or_nonpositive": ("amount", lambda c: c.isNull() | (c <= 0)),
        "country_null": ("country", lambda c: c.isNull()),
        "status_invalid": ("status", lambda c: ~F.coalesce(c.isin(*VALID_STATUSES), F.lit(False))),
        "event_time_null": ("event_time", lambda c: c.isNull()),
    }
    return {name: broken(F.col(column)) for name, (column, broken) in every.items() if column in columns}


def violations(rows: DataFrame) -> DataFrame:
    """``(rule, violations)`` in one pass; rules without violations don't come out."""
    named = rules(rows.columns)
    counted = rows.agg(*[F.count_if(c).alias(n) for n, c in named.items()])
    stacked = F.inline(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in named]))
    return counted.select(stacked).filter("violations > 0")


def is_valid(columns: list[str]) -> Column:
    broken = F.lit(False)
    for condition in rules(columns).values():
        broken = broken | condition
    return ~broken


def expect_not_null(rows: DataFrame, *columns: str) -> DataFrame:
    broken = F.lit(False)
    for c in columns:
        broken = broken | F.col(c).isNull()
    return rows.filter(broken)


def expect_unique(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def expect_accepted(rows: DataFrame, column: str, values: tuple[str, ...]) -> DataFrame:
    """Values outside the list with their number of rows; NULL is not judged."""
    return rows.filter(F.col(column).isNotNull() & ~F.col(column).isin(*values)).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def expect_same_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of either side that the other lacks, as sets with NULL equal to NULL."""
    return left.subtract(right).withColumn("unmatched_side", F.lit("left")).unionByName(right.subtract(left).withColumn("unmatched_side", F.lit("right")))


def same_multiset(left: DataFrame, right: DataFrame) -> bool:
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def publish_gate(rows: DataFrame, strict: bool) -> dict[str, int]:
    """Violations by rule; in strict mode raises if there are any, so that nothing is published."""
    found = {r["rule"]: r["violations"] for r in violations(rows).collect()}  # at most one row per rule
    if strict and found:
        raise ValueError(f"quality violations: {found}")
    return found
