"""Landed pages whose records have drifted from the schema: no value is lost and no record ends the run.

A page is parsed once into a variant. Of each record the columns of the schema are taken where the value can
be read as the column's type; what is left over goes to ``_rescued``, one entry for each field: unknown
fields, and fields whose value another type holds (``"upvotes": "many"``). A record that cannot be used at
all is kept in ``_bad`` with a reason and its text:

* ``page``: the page is no JSON (cut off, or a record names a field twice); its text as it landed
* ``record``: an element of the page is no object
* ``required``: a required column has no readable value, or a time is no ISO time

Blank lines and empty pages give no rows, as for ``read_issue_pages``. Everything runs in the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from echolot.functions.iso_time import parse_lenient
from echolot.schemas import RAW_SCHEMA
from echolot.sources.tables import read_existing

FILE, BAD, RESCUED = "_file", "_bad", "_rescued"
ENTRIES = "array<struct<field:string,value:string>>"
QUARANTINE_SCHEMA = "file string, reason string, iid long, field string, content string"


class TooManyBadRecords(RuntimeError):
    """More unusable records than a run permits."""

    def __init__(self, bad: int, records: int):
        super().__init__(f"{bad} of {records} landed records cannot be used")
        self.bad, self.records = bad, records


def _get(path: str, kind: str) -> Column:
    return F.try_variant_get(F.col("record"), path, kind)


def _child(path: str, name: str) -> str:
    return f"{path}['{name}']"


def _fields_of(path: str) -> Column:
    """The fields of an object as a map; null for anything else."""
    return _get(path, "map<string,variant>")


def _value(path: str, kind: T.DataType) -> Column:
    """The value as a type, null where it says something else. Text columns take any value as its JSON text."""
    if isinstance(kind, T.StructType):
        fields = [_value(_child(path, f.name), f.dataType).alias(f.name) for f in kind.fields]
        return F.when(_fields_of(path).isNotNull(), F.struct(*fields))
    text = _get(path, "string")
    value = text.try_cast(kind)
    if isinstance(kind, T.FractionalType):
        return value
    if not isinstance(kind, (T.StringType, T.IntegralType, T.BooleanType)):
        raise ValueError(f"a page's column of type {kind.simpleString()} is not supported")
    return F.when(value.cast("string") == text, value)


def _leftovers(path: str, prefix: str, kind: T.StructType) -> list[Column]:
    """Arrays of entries: unknown fields of an object, then known ones that cannot be read."""
    unknown = F.map_filter(_fields_of(path), lambda name, _: ~name.isin(kind.fieldNames()))
    parts = [
        F.transform(
            F.map_entries(unknown),
            lambda e: F.struct(F.concat(F.lit(prefix), e["key"]).alias("field"), F.to_json(e["value"]).alias("value")),
        )
    ]
    for field in kind.fields:
        place, name = _child(path, field.name), prefix + field.name
        lost = _get(place, "string").isNotNull() & _value(place, field.dataType).isNull()
        entry = F.struct(F.lit(name).alias("field"), F.to_json(_get(place, "variant")).alias("value"))
        parts.append(F.when(lost, F.array(entry)))
        if isinstance(field.dataType, T.StructType):
            parts += _leftovers(place, name + ".", field.dataType)
    return parts


def _records(spark: SparkSession, path: str | Sequence[str], one_page_per_file: bool) -> DataFrame:
    """(_file, text, record): one variant for each record, or the text of a page that is no JSON."""
    paths = path if isinstance(path, str) else list(path)
    if not paths:
        pages = spark.createDataFrame([], f"value string, {FILE} string")
    else:
        lines = spark.read.text(paths, wholetext=one_page_per_file)
        pages = lines.select("value", F.col("_metadata.file_path").alias(FILE))
    parsed = pages.where(F.col("value").rlike(r"\S")).select(
        FILE, "value", F.try_parse_json("value").alias("page")
    )
    # One object that is a page by itself is its only record, as for Spark's JSON reader.
    elements = F.coalesce(F.try_variant_get("page", "$", "array<variant>"), F.array("page"))
    found = parsed.select(
        FILE,
        F.when(F.col("page").isNull(), F.col("value")).alias("text"),
        F.explode_outer(F.when(F.col("page").isNotNull(), elements)).alias("record"),
    )
    return found.where(F.col("text").isNotNull() | F.col("record").isNotNull())


def read_drifting_pages(
    spark: SparkSession,
    path: str | Sequence[str],
    one_page_per_file: bool = False,
    schema: T.StructType = RAW_SCHEMA,
    required: Sequence[str] = ("iid", "created_at"),
    times: Sequence[str] = ("created_at", "updated_at"),
) -> DataFrame:
    """All records of all pages: the columns of ``schema``, ``_file``, ``_bad`` and ``_rescued``.

    ``_bad`` is null for a usable record: one whose ``required`` columns have a value and whose
    ``times`` are null or ISO times. ``_rescued`` is an empty array where nothing drifted, and for bad records, which
    keep their whole text in ``_bad``. Without drift the columns are those of ``read_issue_pages``.
    """
    values = [_value(_child("$", f.name), f.dataType).alias(f.name) for f in schema.fields]
    parts = [F.coalesce(part, F.array().cast(ENTRIES)) for part in _leftovers("$", "", schema)]
    rows = _records(spark, path, one_page_per_file).select(
        *values,
        FILE,
        "text",
        F.to_json("record").alias("whole"),
        _fields_of("$").isNotNull().alias("is_object"),
        F.concat(*parts).alias("entries"),
    )
    absent = F.lit(False)
    for name in required:
        absent = absent | F.col(name).isNull()
    for name in times:
        absent = absent | (F.col(name).isNotNull() & parse_lenient(F.col(name)).isNull())
    reason = (
        F.when(F.col("text").isNotNull(), "page").when(~F.col("is_object"), "record").when(absent, "required")
    )
    bad = F.struct(reason.alias("reason"), F.coalesce("text", "whole").alias("content"))
    rows = rows.withColumn(BAD, F.when(reason.isNotNull(), bad))
    entries = F.when(F.col(BAD).isNull(), F.col("entries")).otherwise(F.array().cast(ENTRIES))
    return rows.select(*schema.fieldNames(), FILE, BAD, entries.alias(RESCUED))


def field_kinds(
    spark: SparkSession,
    path: str | Sequence[str],
    one_page_per_file: bool = False,
    schema: T.StructType = RAW_SCHEMA,
) -> DataFrame:
    """(field, expected, found, n): which kinds of value the fields of all records hold, against the schema.

    ``expected`` is null for a field that the schema lacks, ``found`` a JSON kind (``VOID`` is null). It counts
    every record, in one pass and a small shuffle: one row for each field and kind leaves a task.
    """

    def kinds(place: str, prefix: str, kind: T.StructType) -> list[Column]:
        entries = F.transform(
            F.map_entries(_fields_of(place)),
            lambda e: F.struct(
                F.concat(F.lit(prefix), e["key"]).alias("field"),
                F.regexp_extract(F.schema_of_variant(e["value"]), "^[A-Z]+", 0).alias("value"),
            ),
        )
        deeper = [f for f in kind.fields if isinstance(f.dataType, T.StructType)]
        below = [c for f in deeper for c in kinds(_child(place, f.name), f"{prefix}{f.name}.", f.dataType)]
        return [F.coalesce(entries, F.array().cast(ENTRIES)), *below]

    def expected(prefix: str, kind: T.StructType) -> dict[str, str]:
        names = {prefix + f.name: f.dataType.typeName() for f in kind.fields}
        for f in kind.fields:
            if isinstance(f.dataType, T.StructType):
                names |= expected(f"{prefix}{f.name}.", f.dataType)
        return names

    records = _records(spark, path, one_page_per_file).where("text IS NULL")
    found = records.select(F.explode(F.concat(*kinds("$", "", schema))).alias("e"))
    counts = found.groupBy(F.col("e.field").alias("field"), F.col("e.value").alias("found"))
    known = F.create_map(*[F.lit(x) for pair in expected("", schema).items() for x in pair])
    return counts.agg(F.count(F.lit(1)).alias("n")).select("field", known[F.col("field")].alias("expected"), "found", "n")


def quarantine_rows(read: DataFrame) -> DataFrame:
    """What did not fit the schema, one row for each bad record or rescued field."""
    null = F.lit(None).cast("string")
    bad = F.array(F.struct(F.col(f"{BAD}.reason").alias("reason"), null.alias("field"), F.col(f"{BAD}.content").alias("content")))
    fields = F.transform(
        RESCUED, lambda e: F.struct(F.lit("field").alias("reason"), e["field"].alias("field"), e["value"].alias("content"))
    )
    entries = F.when(F.col(BAD).isNotNull(), bad).otherwise(fields)
    rows = read.select(F.col(FILE).alias("file"), "iid", F.explode(entries).alias("e"))
    return rows.select("file", "e.reason", "iid", "e.field", "e.content")


def write_quarantine(read: DataFrame, path: str) -> None:
    """Add what did not fit to the side table, as far as the table lacks it; a repeated run adds nothing.

    Equal entries of one file are kept once.
    Rows meet by a hash of all columns and are then compared themselves.
    """
    spark, names = read.sparkSession, [f.split()[0] for f in QUARANTINE_SCHEMA.split(", ")]
    rows = quarantine_rows(read).dropDuplicates(names)
    known = read_existing(spark, path, QUARANTINE_SCHEMA)
    if known is not None:
        known = known.select(*[F.col(name).alias(f"_{name}") for name in names])
        same = F.xxhash64(*names) == F.xxhash64(*known.columns)
        for name in names:
            same = same & F.col(name).eqNullSafe(F.col(f"_{name}"))
        rows = rows.join(known, same, "left_anti")
    rows.write.mode("append").parquet(path)
