"""Schemas that drift between files: one typed table with a rescue column, and a report of every change of shape.

A stored file is one row whose body holds one JSON record per line. Records are parsed once, inside the row, so finding a
file's shape needs no shuffle. Fields are matched to target columns by name, by a known other name, or by what they hold: a field
that says in its records what the canonical payload says of a column which the file lacks stands for that column. The same match
decides where values go on ingestion and which changes are reported. What is unknown or cannot be cast is kept as JSON in
``rescued`` and can be promoted into a typed column later.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

#: Columns of the target table and their types.
TARGET = {
    "order_id": "string", "customer": "string", "amount": "double", "country": "string", "status": "string", "event_time": "timestamp_ntz",
    "kafka_timestamp": "timestamp_ntz", "kafka_partition": "int", "kafka_offset": "bigint", "event_date": "date", "business_version": "bigint",
    "source_epoch_id": "string", "event_id": "string", "canonical_payload": "string", "canonical_payload_hash": "string",
}

#: Other names under which producers send a target column, beyond spellings in other case or without underscores.
OTHER_NAMES = {
    "customer_name": "customer",
    "order_amount": "amount",
    "country_code": "country",
    "occurred_at": "event_time",
    "biz_version": "business_version",
    "version_no": "business_version",
    "epoch": "source_epoch_id",
    "src_epoch": "source_epoch_id",
    "payload_json": "canonical_payload",
    "canonical_body": "canonical_payload",
}

#: Files of one producer that are compared within one task.
BLOCK = 4096

#: Columns that the canonical payload repeats.
PAYLOAD = ("order_id", "customer", "amount", "country", "status", "event_time", "business_version")
#: A name stands for a column if this share of its records, this many at least and with as many different values, say what the payload says.
AGREEING, LEAST_RECORDS, LEAST_VALUES = 0.9, 5, 3


def _folded(name: Column) -> Column:
    return F.lower(F.regexp_replace(name, "[^A-Za-z0-9]", ""))


def target_of(name: Column, other_names: dict[str, str] | None = None) -> Column:
    """The target column that a field stands for, else the field's own name. Names are compared without case, ``_`` and ``-``."""
    known = {c: c for c in TARGET} | (OTHER_NAMES if other_names is None else other_names)
    table = F.create_map(*[F.lit(x) for k, v in known.items() for x in (k.replace("_", "").lower(), v)])
    return F.coalesce(F.element_at(table, _folded(name)), name)


#: Names of variant types to JSON kinds; an integer beyond 64 bits is a decimal without scale, while 2.0 is DECIMAL(1,0).
_KINDS = {"STRING": "text", "BOOLEAN": "truth", "BIGINT": "whole", "OBJECT": "object", "ARRAY": "array", "DECIMAL": "fraction", "DOUBLE": "fraction", "FLOAT": "fraction"} | {f"DECIMAL({p},0)": "whole" for p in range(19, 39)}


def kind_of(value: Column) -> Column:
    """JSON kind of a variant: text, whole, fraction, truth, object, array; NULL for null. The variant is looked at once."""
    table = F.create_map(*[F.lit(x) for pair in _KINDS.items() for x in pair])
    return F.try_element_at(table, F.regexp_extract(F.schema_of_variant(value), r"^(DECIMAL\((?:19|2[0-9]|3[0-8]),0\)|[A-Z]+)", 1))


def record_of(line: Column) -> Column:
    """The line as a map from field name to variant, NULL if it is not one complete JSON object."""
    return F.when(F.rtrim(line).endswith("}"), F.try_variant_get(F.try_parse_json(line), "$", "map<string,variant>"))


def records_of(body: Column) -> Column:
    """Array of the body's readable records, each a map from field name to variant. Lines that are not complete JSON objects drop out."""
    lines = F.filter(F.split(body, "\r?\n"), lambda x: F.length(F.btrim(x)) > 0)
    return F.filter(F.transform(lines, record_of), lambda x: x.isNotNull())


def survey(files: DataFrame, other_names: dict[str, str] | None = None) -> DataFrame:
    """``(producer, file_seq, file_id, p, hints)`` of every readable file of a producer: names with their kinds, and what hints at unknown names.

    A hint is a record in which an unknown name can be compared with the payload: (name, field, value), where field is the column that
    says the same, NULL if none does. Only columns that the file does not have under a known name are compared.
    """
    kept = files.filter("producer IS NOT NULL").select("producer", F.col("file_seq").cast("bigint").alias("file_seq"), F.col("file_id").cast("bigint").alias("file_id"), "body")
    # an explode of one element: a filter on its output is not pushed below it, which would parse every body twice
    readable = kept.select("producer", "file_seq", "file_id", F.explode(F.array(records_of(F.col("body")))).alias("r")).filter("size(r) > 0")
    # kind and name as one text, so that distinct values are found by hash
    pair = lambda e: F.concat(F.coalesce(kind_of(e["value"]), F.lit("")), F.lit("|"), e["key"])
    pairs = F.array_distinct(F.flatten(F.transform("r", lambda m: F.transform(F.map_entries(m), pair))))
    split = lambda x: F.struct(x["pair"].substr(F.length(x["kind"]) + 2, F.length(x["pair"])).alias("name"), F.nullif(x["kind"], F.lit("")).alias("kind"))
    seen = readable.select("*", F.transform(pairs, lambda p: F.struct(F.substring_index(p, "|", 1).alias("kind"), p.alias("pair"))).alias("p"))
    seen = seen.select("producer", "file_seq", "file_id", "r", F.transform("p", split).alias("p"))
    seen = seen.withColumn("t", F.array_distinct(F.transform("p", lambda x: F.struct(x["name"].alias("name"), target_of(x["name"], other_names).alias("target")))))
    unknown = F.transform(F.filter("t", lambda x: (x["target"] == x["name"]) & ~x["name"].isin(*TARGET)), lambda x: x["name"])
    payload_name = F.get(F.filter("t", lambda x: x["target"] == "canonical_payload"), F.lit(0))["name"]
    lacking = F.array_except(F.array(*[F.lit(c) for c in PAYLOAD]), F.transform("t", lambda x: x["target"]))
    seen = seen.withColumn("unknown", unknown).withColumn("payload_name", payload_name).withColumn("lacking", lacking)

    def hints_of(m: Column) -> Column:
        payload = _payload_of(F.element_at(m, F.col("payload_name")))

        def hint(n: Column) -> Column:
            value = F.element_at(m, n)
            same = F.filter("lacking", lambda c: F.coalesce(_said(value) == _said(F.element_at(payload, c)), F.lit(False)) | (c == "event_time") & F.coalesce(_as_time(value) == _as_time(F.element_at(payload, c)), F.lit(False)))
            return F.when(_said(value).isNotNull(), F.struct(n.alias("name"), F.get(same, F.lit(0)).alias("field"), F.xxhash64(_said(value)).alias("value")))

        return F.when(payload.isNotNull(), F.array_compact(F.transform("unknown", hint)))

    compared = (F.size("unknown") > 0) & F.col("payload_name").isNotNull() & (F.size("lacking") > 0)
    return seen.select("producer", "file_seq", "file_id", "p", F.when(compared, F.flatten(F.array_compact(F.transform("r", hints_of)))).alias("hints"))


def _said(value: Column) -> Column:
    return F.nullif(F.btrim(F.try_variant_get(value, "$", "string"), F.lit(" \t")), F.lit(""))


def _payload_of(value: Column) -> Column:
    """The payload's fields, whether it was sent as an object or as text."""
    return F.coalesce(F.try_variant_get(F.try_parse_json(F.try_variant_get(value, "$", "string")), "$", "map<string,variant>"), F.try_variant_get(value, "$", "map<string,variant>"))


def inferred_names(surveyed: DataFrame) -> dict[str, str]:
    """Unknown names that stand for a column, by the hints of all files; one row per such name comes to the driver."""
    hints = surveyed.select(F.inline("hints"))
    per = hints.groupBy("name", "field").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("value").alias("values"))
    best = per.groupBy("name").agg(F.sum("n").alias("all"), F.max(F.when(F.col("field").isNotNull(), F.struct("n", "values", "field"))).alias("best"))
    return {r.name: r.field for r in best.filter((F.col("best.n") >= F.col("all") * AGREEING) & (F.col("best.n") >= LEAST_RECORDS) & (F.col("best.values") >= LEAST_VALUES)).select("name", "best.field").collect()}


def shapes_of(surveyed: DataFrame, inferred: dict[str, str] | None = None) -> DataFrame:
    """``(producer, file_seq, file_id, fields)``; fields are (field, name, kind).

    ``kind`` is NULL where the field is null throughout the file. Where two names of a file stand for one column, the column's
    own name (else the first by name) speaks for it and the other counts as a field of its own.
    """
    named = surveyed.withColumn("names", F.transform(F.array_sort(F.array_distinct(F.transform("p", lambda x: x["name"]))), lambda n: F.struct(n.alias("name"), target_of(n, OTHER_NAMES | (inferred or {})).alias("target"))))

    def field(n: Column) -> Column:
        rivals = F.filter("names", lambda o: o["target"] == n["target"])
        speaker = F.when(F.exists(rivals, lambda o: o["name"] == n["target"]), n["target"]).otherwise(F.get(rivals, F.lit(0))["name"])
        return F.when((F.size(rivals) == 1) | (speaker == n["name"]), n["target"]).otherwise(n["name"])

    # several kinds in one file: the first by name, as a stable choice
    kind = lambda n: F.array_min(F.transform(F.filter("p", lambda x: x["name"] == n["name"]), lambda x: x["kind"]))
    return named.select("producer", "file_seq", "file_id", F.transform("names", lambda n: F.struct(field(n).alias("field"), n["name"].alias("name"), kind(n).alias("kind"))).alias("fields"))


def file_shapes(files: DataFrame, inferred: dict[str, str] | None = None) -> DataFrame:
    return shapes_of(survey(files), inferred)


def shape_changes(shapes: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(file_id, field_name, change_kind)`` between each file and the same producer's file before it.

    ``shapes`` should be stored, it is read several times. One producer may own a third of all files, so its files are cut
    into blocks by ``file_seq``; a block starts with the last file of the block before it and with the kinds known until then.
    """
    files = shapes.withColumn("block", F.floor(F.coalesce("file_seq", F.lit(-1)) / block))
    last = files.groupBy("producer", "block").agg(F.max(F.struct("file_seq", "file_id", "fields")).alias("last"))
    across = Window.partitionBy("producer").orderBy("block")
    before = last.withColumn("last", F.lag("last").over(across)).filter("last IS NOT NULL").select("producer", "block", F.col("last.file_seq").alias("file_seq"), F.col("last.file_id").alias("file_id"), F.col("last.fields").alias("fields"))
    in_block = Window.partitionBy("producer", "block").orderBy("file_seq", "file_id")
    ordered = (
        files.select("producer", "block", "file_seq", "file_id", "fields")
        .unionByName(before)
        .withColumn("ord", F.row_number().over(in_block))
        .withColumn("next_file", F.lead("file_id").over(in_block))
    )
    each = ordered.select("producer", "block", "ord", "file_id", "next_file", F.inline("fields"))

    exploded = files.select("producer", "block", "file_seq", "file_id", F.inline("fields")).filter("kind IS NOT NULL")
    kinds = exploded.groupBy("producer", "field", "block").agg(F.max_by("kind", F.struct("file_seq", "file_id")).alias("kind"))
    earlier = Window.partitionBy("producer", "field").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    occurs = each.select("producer", "field", "block").distinct()
    known = occurs.join(kinds, ["producer", "field", "block"], "left").withColumn("kind", F.last("kind", ignorenulls=True).over(earlier)).filter("kind IS NOT NULL")
    none = F.lit(None)
    rows = each.unionByName(known.select("producer", "block", F.lit(-1).alias("ord"), none.cast("bigint").alias("file_id"), none.cast("bigint").alias("next_file"), "field", none.cast("string").alias("name"), "kind"))
    of_field = Window.partitionBy("producer", "block", "field").orderBy("ord")
    seen = (
        rows.withColumn("ord_before", F.lag("ord").over(of_field))
        .withColumn("name_before", F.lag("name").over(of_field))
        .withColumn("ord_after", F.lead("ord").over(of_field))
        .withColumn("kind_before", F.last("kind", ignorenulls=True).over(of_field.rowsBetween(Window.unboundedPreceding, -1)))
        .filter("ord > 0")
    )
    follows = F.coalesce(F.col("ord_before") == F.col("ord") - 1, F.lit(False))
    case = lambda when, file, kind: F.when(when, F.struct(F.col(file).alias("file_id"), F.lit(kind).alias("change_kind")))
    cases = F.array_compact(
        F.array(
            case((F.col("ord") > 1) & ~follows, "file_id", "added"),
            case(F.col("next_file").isNotNull() & ~F.coalesce(F.col("ord_after") == F.col("ord") + 1, F.lit(False)), "next_file", "removed"),
            case(follows & (F.col("name_before") != F.col("name")), "file_id", "renamed"),
            case(follows & (F.col("kind_before") != F.col("kind")), "file_id", "retyped"),
        )
    )
    return seen.select(F.col("field").alias("field_name"), F.explode(cases).alias("c")).select("c.file_id", "field_name", "c.change_kind").distinct()


def _as_time(value: Column) -> Column:
    """ISO text or milliseconds since 1970 as a timestamp without zone, in UTC."""
    text = F.try_variant_get(value, "$", "string")
    millis = F.try_variant_get(value, "$", "bigint")
    return F.when(kind_of(value) == "whole", F.timestamp_millis(millis)).otherwise(F.try_to_timestamp(text)).cast("timestamp_ntz")


def _typed(column: str, value: Column) -> Column:
    kind = TARGET[column]
    if kind == "timestamp_ntz":
        return _as_time(value)
    if column == "source_epoch_id":
        text = F.try_variant_get(value, "$", "string")
        return F.when(text.rlike("^[0-9]{8}$"), F.regexp_replace(text, "^(....)(..)(..)$", "epoch-$1-$2-$3")).otherwise(text)
    if kind == "string":
        return F.when(kind_of(value).isin("object", "array"), F.to_json(value)).otherwise(F.try_variant_get(value, "$", "string"))
    if kind == "bigint":  # "2" and 2.0 are the whole number 2, 2.5 is none
        number = F.try_variant_get(value, "$", "string").try_cast("decimal(38,6)")
        return F.when(number == F.floor(number), number.try_cast("bigint"))
    return F.try_variant_get(value, "$", "string").try_cast(kind)


def ingest_files(files: DataFrame, inferred: dict[str, str] | None = None, unreadable: bool = False) -> DataFrame:
    """All complete records of all files as rows of the target table, with ``file_id``, ``line_no`` and ``rescued``.

    ``rescued`` is a JSON object of the fields without a target column and of values that the target type cannot hold, NULL
    where there are none. Columns no record has are NULL. Empty files and blank lines give no row; lines that are no complete JSON
    object, such as those cut off, give one only with ``unreadable``, all columns NULL and the line as ``_unreadable`` in ``rescued``.
    """
    names = OTHER_NAMES | (inferred or {})
    lines = F.transform(F.split("body", "\r?\n"), lambda x: F.struct(x.alias("line"), record_of(x).alias("m")))
    records = files.select("file_id", F.col("event_date").alias("file_date"), F.posexplode(lines).alias("line_no", "l")).select("file_id", "file_date", "line_no", "l.m", "l.line")
    records = records.filter("m IS NOT NULL" + (" OR length(btrim(line)) > 0" if unreadable else ""))
    keyed = records.withColumn("by_field", F.transform(F.map_entries("m"), lambda e: F.struct(target_of(e["key"], names).alias("field"), e["key"].alias("name"), e["value"].alias("value"))))
    first = lambda part, c: F.get(F.filter("by_field", lambda x: x[part] == c), F.lit(0))
    picked = keyed.select("*", *[F.coalesce(first("name", c), first("field", c)).alias(f"v_{c}") for c in TARGET])
    typed = picked.select("*", *[_typed(c, F.col(f"v_{c}.value")).alias(c) for c in TARGET])
    placed = F.array_compact(F.array(*[F.when(F.col(c).isNotNull() | kind_of(F.col(f"v_{c}.value")).isNull(), F.col(f"v_{c}.name")) for c in TARGET]))
    rest = F.filter("by_field", lambda x: ~F.array_contains(placed, x["name"]))
    rescued = F.when(F.size(rest) > 0, F.to_json(F.map_from_entries(F.transform(rest, lambda x: F.struct(x["name"], x["value"])))))
    rescued = F.when(F.col("m").isNull(), F.to_json(F.struct(F.col("line").alias("_unreadable")))).otherwise(rescued)
    day = F.when(F.col("m").isNotNull(), F.coalesce("event_date", "file_date", F.to_date("event_time")))
    done = typed.select("file_id", "line_no", *[day.alias(c) if c == "event_date" else F.col(c) for c in TARGET], rescued.alias("__rescued"))
    return done.select("file_id", "line_no", *TARGET, F.explode(F.array("__rescued")).alias("rescued"))  # as above: filters stay behind it


def promote(rows: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Replay approved fields from ``rescued`` into typed columns, where these are NULL; values that cannot be cast, or whose column holds another value, stay rescued."""
    out = rows.withColumn("__r", F.explode(F.array(F.try_variant_get(F.try_parse_json("rescued"), "$", "map<string,variant>"))))
    moved = []
    for name, kind in fields.items():
        replayed = F.try_variant_get(F.element_at("__r", name), "$", kind)
        free = F.col(name).isNull() if name in rows.columns else F.lit(True)
        moved.append(F.when(free & replayed.isNotNull(), F.lit(name)))
        out = out.withColumn(f"__{name}", F.coalesce(F.col(name), replayed) if name in rows.columns else replayed)
    left = F.map_filter("__r", lambda k, v: ~F.array_contains(F.array_compact(F.array(*moved)), k))
    out = out.withColumn("rescued", F.when(F.col("__r").isNull(), F.col("rescued")).when(F.size(left) > 0, F.to_json(left)))
    for name in fields:
        out = out.withColumn(name, F.col(f"__{name}")).drop(f"__{name}")
    return out.drop("__r")


def find_changes(spark: SparkSession, files: DataFrame, path: str, block: int = BLOCK) -> DataFrame:
    """``shape_changes`` of ``files``; the survey is stored below ``path``, so that bodies are parsed once."""
    survey(files).write.mode("overwrite").parquet(f"{path}/survey")
    surveyed = spark.read.parquet(f"{path}/survey")
    shapes_of(surveyed, inferred_names(surveyed)).write.mode("overwrite").parquet(f"{path}/shapes")
    return shape_changes(spark.read.parquet(f"{path}/shapes"), block)


def ingest(spark: SparkSession, files: DataFrame, path: str, unreadable: bool = False) -> DataFrame:
    """``ingest_files`` with the names inferred by the same survey that finds changes."""
    survey(files).select("hints").filter("size(hints) > 0").write.mode("overwrite").parquet(f"{path}/hints")
    return ingest_files(files, inferred_names(spark.read.parquet(f"{path}/hints")), unreadable)
