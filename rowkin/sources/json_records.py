"""JSON documents and JSON Lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowkin.functions.fields import last_per_key
from rowkin.functions.text import let, strip
from rowkin.sources.files import (
    RECORD_COLUMNS,
    SOURCE_PATH,
    file_name,
    own_path,
    path_key,
    read_documents,
    with_path,
    with_row_numbers,
)

# Keys of a root object that may hold the list of records, in priority order.
LIST_KEYS = ("records", "data", "items", "rows", "students", "employees", "customers", "results")

_MAP = "map<string,string>"


def json_records(text: Column) -> Column:
    """Array of ``(line_number, raw)`` of a JSON document, NULL when the text is not JSON.

    The records are the objects of the root list; or of the first list found under one of
    ``LIST_KEYS``; or the root object itself.  Values keep their JSON text, strings lose the quotes; of a
    repeated key the last value counts.

    Lists are read item by item, so a document may be of any size.  Variants only tell the types of
    values: where they cannot be made (a repeated key, a value beyond their size limit), a value that
    reads as an object or list is taken for one.
    """

    def items_of(listed: Column) -> Column:
        def typed(items: Column) -> Column:
            def raw(types: Column) -> Column:
                return F.transform(
                    items,
                    lambda item, i: F.struct(
                        (i + 1).cast("bigint").alias("line_number"),
                        F.when(_is(F.get(types, i), item, types.isNotNull(), "OBJECT", "{"), json_object(item)).alias("raw"),
                    ),
                )

            return let(F.from_json(listed, "array<variant>"), raw)

        found = let(F.from_json(listed, "array<string>"), typed)
        return F.filter(found, lambda item: item["raw"].isNotNull())

    def of_object(fields: Column) -> Column:
        def under(types: Column) -> Column:
            lists = [
                F.when(
                    _is(F.try_element_at(types, F.lit(key)), F.try_element_at(fields, F.lit(key)), types.isNotNull(), "ARRAY", "["),
                    F.try_element_at(fields, F.lit(key)),
                )
                for key in LIST_KEYS
            ]
            whole = F.array(F.struct(F.lit(1).cast("bigint").alias("line_number"), fields.alias("raw")))
            return let(F.coalesce(*lists), lambda listed: F.coalesce(items_of(listed), whole))

        return let(F.from_json(text, "map<string,variant>"), under)

    nothing = F.array().cast(f"array<struct<line_number:bigint,raw:{_MAP}>>")
    other = F.when(F.try_parse_json(text).isNotNull(), nothing)
    return F.coalesce(items_of(text), let(json_object(text), lambda fields: F.when(fields.isNotNull(), of_object(fields))), other)


def _is(typed: Column, value: Column, known: Column, kind: str, opening: str) -> Column:
    """Whether a value is an object or list: by its type where types are known, else by its text."""
    by_type = F.coalesce(F.schema_of_variant(typed).startswith(kind), F.lit(False))
    return F.when(known, by_type).otherwise(F.coalesce(F.startswith(F.ltrim(value), F.lit(opening)), F.lit(False)))


def json_object(text: Column) -> Column:
    """A JSON object as a map, NULL for anything else; of a repeated key the last value counts."""
    return let(F.from_json(text, _MAP), lambda found: F.when(found.isNotNull(), last_per_key(F.map_entries(found))))


def records_of_documents(documents: DataFrame, file_type: str = "JSON") -> DataFrame:
    """Raw records of ``(source_file, text)`` JSON documents."""
    path = with_path(documents)
    return documents.select(
        "source_file", F.lit(file_type).alias("file_type"), F.inline(json_records(F.col("text"))), *path
    ).select("source_file", "file_type", "line_number", strip_keys(F.col("raw")).alias("raw"), *path)


def scan_json(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return records_of_documents(read_documents(spark, paths))


def broken_documents(documents: DataFrame) -> DataFrame:
    """``(filename, reason, path)`` of the documents that are not JSON."""
    return documents.where(json_records(F.col("text")).isNull()).select(
        F.col("source_file").alias("filename"),
        F.lit("not a JSON document").alias("reason"),
        *[F.col(c).alias("path") for c in with_path(documents)],
    )


def json_line(line: Column) -> Column:
    """Raw map of a line that is exactly one JSON object, else NULL.

    The line is read as the only item of a list, which makes text after the object an error.
    """
    items = F.from_json(F.concat(F.lit("["), strip(line), F.lit("]")), f"array<{_MAP}>")
    return let(items, lambda found: F.when(F.size(found) == 1, found[0]))


def strip_keys(raw: Column) -> Column:
    """Keys without outer blanks; of keys that then are the same the last value counts."""
    entries = F.transform(
        F.map_entries(raw), lambda e: F.struct(strip(e["key"]).alias("key"), e["value"].alias("value"))
    )
    return last_per_key(entries)


def scan_jsonl(spark: SparkSession, paths: str | list[str], line_numbers: bool = True) -> DataFrame:
    """Raw records of JSON Lines files; blank, broken and non-object lines are skipped."""
    lines = spark.read.text(paths).select(
        own_path().alias("_path"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
        "value",
    )
    if line_numbers:
        lines = with_row_numbers(lines, "_path", "_block", "_at", "line_number", 1)
    else:
        lines = lines.withColumn("line_number", F.lit(None).cast("bigint"))
    value = F.coalesce(
        F.try_validate_utf8("value"), F.decode(F.col("value").cast("binary"), "ISO-8859-1")
    )
    return (
        lines.select(
            file_name(F.col("_path")).alias("source_file"),
            F.lit("JSONL").alias("file_type"),
            "line_number",
            json_line(value).alias("raw"),
            path_key(F.col("_path")).alias(SOURCE_PATH),
        )
        .where(F.col("raw").isNotNull())
        .withColumn("raw", strip_keys(F.col("raw")))
        .select(*RECORD_COLUMNS, SOURCE_PATH)
    )
