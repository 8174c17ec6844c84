"""Canonical JSON text of an event and its digest."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Fields of the canonical text, in its order.
DOMAIN = ("amount", "business_version", "country", "customer", "event_time", "order_id", "status")


def canonical_json(fields: dict[str, Column] | None = None) -> Column:
    """Compact JSON with sorted keys and NULLs kept. Numbers are written as Spark writes them, so a digest that a producer has
    sent must be checked against the producer's own bytes, never against this text."""
    given = fields or {c: F.col(c) for c in DOMAIN}
    return F.to_json(F.struct(*[given[c].alias(c) for c in sorted(given)]), {"ignoreNullFields": "false"})


def payload_digest(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)
