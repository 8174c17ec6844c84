"""Small column expressions used by several operators."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def trim_blanks(col: Column | str) -> Column:
    """Without surrounding blanks; blanks are spaces and tabs."""
    col = F.col(col) if isinstance(col, str) else col
    return F.btrim(col, F.lit(" \t"))


def plain_key(col: Column | str) -> Column:
    """A key as it is compared: no surrounding blanks, lower case; NULL where nothing is left."""
    return F.nullif(F.lower(trim_blanks(col)), F.lit(""))


def epoch_day(col: Column | str) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return F.unix_date(col.cast("date"))


def day_text(col: Column | str) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return F.date_format(col, "yyyy-MM-dd")
