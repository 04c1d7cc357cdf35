"""JSON Lines readers: lenient, strict, key-checked and typed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.text import strip_text
from quern.session import stage

# A split table larger than this is joined by shuffle instead of broadcast.
MAX_BROADCAST_SPLITS = 200_000
# Spark's readers take single-quoted names and strings unless told not to.
STRICT_QUOTES = {"allowSingleQuotes": "false"}


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, seq, value): lines with their place in the file and overall.

    Spark reads files in splits; a line's place is its split's offset plus its
    place in the split. The files are read once: lines are written with their
    split and place, and both the offsets (one row per split) and every later
    read come from that table, however the source would be split then.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("_at"),
        "value",
    )
    lines = stage(lines, "lines")
    splits = stage(
        lines.groupBy("file", "block").agg(
            F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first")
        ),
        "splits",
    )
    overall = "sum(_n) OVER (ORDER BY file, block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    in_file = (
        "sum(_n) OVER (PARTITION BY file ORDER BY block "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    )
    offsets = splits.select(
        "file",
        "block",
        "_first",
        F.coalesce(F.expr(overall), F.lit(0)).alias("_before"),
        F.coalesce(F.expr(in_file), F.lit(0)).alias("_in_file"),
    )
    if splits.count() <= MAX_BROADCAST_SPLITS:
        offsets = F.broadcast(offsets)
    place = F.col("_at") - F.col("_first") + 1
    return lines.join(offsets, ["file", "block"]).select(
        "file",
        (F.col("_in_file") + place).alias("line"),
        (F.col("_before") + place).alias("seq"),
        "value",
    )


def json_object(value: Column) -> Column:
    """The line as map<string, variant>, or null unless it is one whole JSON object.

    Read inside brackets, so that anything after the object is noticed.
    """
    wrapped = F.concat(F.lit("["), value, F.lit("]"))
    objects = F.from_json(wrapped, "array<map<string,variant>>", STRICT_QUOTES)
    return F.when(F.size(objects) == 1, objects[0])


def typed_object(value: Column, schema: T.StructType) -> Column:
    """The line as a struct; a line that is not one whole JSON object fails the job."""
    wrapped = F.concat(F.lit("["), value, F.lit("]"))
    objects = F.from_json(wrapped, T.ArrayType(schema), {"mode": "FAILFAST", **STRICT_QUOTES})
    whole = (F.size(objects) == 1) & objects[0].isNotNull()
    return F.when(whole, objects[0]).otherwise(F.raise_error(F.lit("line is not a JSON object")))


def string_field(fields: Column, name: str) -> Column:
    """A key's value if it is a JSON string; null for other types and when absent."""
    value = _last(fields, name)
    is_string = F.schema_of_variant(value) == "STRING"
    return F.when(is_string, F.try_variant_get(value, "$", "string"))


def _last(fields: Column, name: str) -> Column:
    # A repeated key counts with its last value.
    entries = F.filter(F.map_entries(fields), lambda e: e["key"] == name)
    return F.try_element_at(entries, F.lit(-1))["value"]


def replace_text(fields: Column, text: Column, name: str = "text") -> Column:
    """The record as one JSON line with ``name`` replaced and every other key kept."""
    changed = F.transform_values(
        fields, lambda key, value: F.when(key == name, text.cast("variant")).otherwise(value)
    )
    return F.to_json(changed)


def lenient_records(spark: SparkSession, path: str) -> DataFrame:
    """(seq, text, fields): every non-blank line; text is null for invalid ones.

    Invalid is a line that is not one JSON object, or whose ``text`` is absent or
    not a string. Blank lines are not records.
    """
    lines = numbered_lines(spark, path).where(strip_text(F.col("value")) != "")
    parsed = lines.select("seq", json_object(F.col("value")).alias("fields"))
    return parsed.select("seq", string_field(F.col("fields"), "text").alias("text"), "fields")


def malformed_records(spark: SparkSession, path: str) -> DataFrame:
    """(seq) of the non-blank lines that carry no usable text."""
    return lenient_records(spark, path).where(F.col("text").isNull()).select("seq")


def strict_records(
    spark: SparkSession, path: str, schema: T.StructType, blank: str = "skip", order: str | None = None
) -> DataFrame:
    """Typed records; the first line that does not parse fails the job.

    ``blank='fail'`` also fails on blank lines, ``'skip'`` ignores them. ``order``
    names a column for the place of the line in the input.
    """
    lines = numbered_lines(spark, path) if order else spark.read.text(path)
    value = F.col("value")
    empty = strip_text(value) == ""
    if blank == "skip":
        lines = lines.where(~empty)
    checked = F.when(empty, F.raise_error(F.lit("blank line"))).otherwise(value)
    parsed = typed_object(checked, schema).alias("r")
    kept = [F.col("seq").alias(order)] if order else []
    return lines.select(*kept, parsed).select(*([order] if order else []), "r.*")


def dataset_records(
    spark: SparkSession, path: str, schema: T.StructType | None = None, needed: T.StructType | None = None
) -> DataFrame:
    """Scan of a file or folder of JSON Lines; a line that is not one object fails the job.

    Without a schema every key of any line becomes a column: the types come from
    one more pass over all lines. Fields of ``needed`` are always there, cast to
    their type, and null where no line has them.
    """
    if schema is not None:
        return strict_records(spark, path, schema)
    found = spark.read.options(mode="FAILFAST", **STRICT_QUOTES).json(path).schema
    fields = {f.name: f.dataType for f in (needed or T.StructType())}
    read = T.StructType(found.fields + [T.StructField(n, k) for n, k in fields.items() if n not in found.names])
    rows = strict_records(spark, path, read)
    columns = {c: F.col(f"`{c}`") for c in rows.columns}
    return rows.select(*[(v.cast(fields[c]) if c in fields else v).alias(c) for c, v in columns.items()])


def missing_fields(fields: Column, required: list[str]) -> Column:
    """Sorted names from ``required`` that are not keys of the record."""
    return F.array_sort(
        F.array_except(F.array(*[F.lit(name) for name in required]), F.map_keys(fields))
    )


def field_violations(spark: SparkSession, path: str, required: list[str]) -> DataFrame:
    """(file, line, value, missing) of every record without all required keys."""
    parsed = numbered_lines(spark, path).select(
        "file",
        "line",
        "value",
        missing_fields(strict_object(F.col("value")), required).alias("missing"),
    )
    return parsed.where(F.size("missing") > 0)


def required_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Typed records whose keys are all present; a null value passes.

    Fails on the first record with a missing key and names line and keys.
    """
    names = schema.fieldNames()
    rows = numbered_lines(spark, path).select(
        "seq", "line", "value", missing_fields(strict_object(F.col("value")), names).alias("missing")
    )
    message = F.concat(
        F.lit("line "), F.col("line").cast("string"), F.lit(" lacks fields: "), F.array_join("missing", ", ")
    )
    checked = F.when(F.size("missing") > 0, F.raise_error(message)).otherwise(F.col("value"))
    return rows.select("seq", F.from_json(checked, schema, {"mode": "FAILFAST", **STRICT_QUOTES}).alias("r")).select(
        "seq", "r.*"
    )


def strict_object(value: Column) -> Column:
    """As ``json_object``, but a line that is not an object fails the job."""
    fields = json_object(value)
    return F.when(fields.isNull(), F.raise_error(F.lit("line is not a JSON object"))).otherwise(fields)


def display_text(fields: Column, name: str, absent: str = "") -> Column:
    """A key's value as text: absent gives ``absent``, an explicit null gives 'None'.

    Numbers and booleans become text; nested values keep their JSON form.
    """
    value = _last(fields, name)
    kind = F.schema_of_variant(value)
    shown = (
        F.when(kind == "VOID", "None")
        .when(kind == "STRING", F.try_variant_get(value, "$", "string"))
        .when(kind == "BOOLEAN", F.initcap(F.to_json(value)))
        .when(kind.rlike("^(DECIMAL|DOUBLE)"), F.try_variant_get(value, "$", "double").cast("string"))
        .otherwise(F.to_json(value))
    )
    return F.when(F.map_contains_key(fields, name), shown).otherwise(F.lit(absent))
