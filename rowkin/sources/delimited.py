"""CSV and TSV scans."""

from __future__ import annotations

import csv
import json
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowkin.functions.text import strip
from rowkin.sources import quoted
from rowkin.sources.files import (
    NO_RECORDS_YET,
    RECORD_COLUMNS,
    SOURCE_PATH,
    as_pattern,
    file_name,
    own_path,
    path_key,
    union_sources,
    with_row_numbers,
)

# Delimiters to choose from, in order of preference.
DELIMITERS = (",", ";", "\t", "|")

#: Characters of a header line.  A file with a longer one is reported as failed; the others are read.
MOST_HEADER = 1_000_000
TOO_LONG = "header line of %s characters"


def inspect_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``path, header, header_chars, sep, encoding, returns`` of delimited files, found in one pass over all of them.

    ``header`` is the first line that is not blank, NULL if it is longer than ``MOST_HEADER``.  ``returns`` tells
    files whose lines end with a carriage return alone.

    The delimiter is the candidate of the header line that most lines of the file contain; ``,`` if
    the header has none.  A file that is not valid UTF-8 as a whole is read as Latin-1.
    """
    lines = spark.read.option("lineSep", "\n").text(paths).select(
        own_path().alias("path"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("at"),
        "value",
    )
    full = strip(F.col("value")) != ""
    containing = [
        F.count_if(full & F.contains("value", F.lit(sep))).alias(f"with_{i}") for i, sep in enumerate(DELIMITERS)
    ]
    files = lines.groupBy("path").agg(
        F.min_by(F.when(full, F.col("value")), F.when(full, F.col("at"))).alias("header"),
        F.bool_and(F.is_valid_utf8("value")).alias("utf8"),
        *containing,
    )
    files = files.withColumn("returns", F.regexp_like("header", F.lit("[^\r\n]\r+[^\r\n]"))).withColumn(
        "header", F.regexp_extract("header", "^\r*([^\r]*)", 1)
    )
    scores = F.array(
        *[
            F.struct(
                F.col(f"with_{i}").alias("lines"),
                F.regexp_count("header", F.lit(f"\\Q{sep}\\E")).alias("cells"),
                F.lit(-i).alias("rank"),
                F.lit(sep).alias("sep"),
            )
            for i, sep in enumerate(DELIMITERS)
        ]
    )
    best = F.array_max(F.filter(scores, lambda s: s["cells"] > 0))["sep"]
    decoded = F.when(F.col("utf8"), F.col("header")).otherwise(F.decode(F.col("header").cast("binary"), "ISO-8859-1"))
    size = F.length("header")
    return files.where(F.col("header").isNotNull()).select(
        "path",
        F.when(size <= MOST_HEADER, decoded).alias("header"),
        size.alias("header_chars"),
        F.coalesce(best, F.lit(",")).alias("sep"),
        F.when(F.col("utf8"), F.lit("UTF-8")).otherwise(F.lit("ISO-8859-1")).alias("encoding"),
        "returns",
    )


def scan_csv(
    spark: SparkSession,
    paths: str | list[str],
    sep: str | None = None,
    multi_line: bool = True,
    line_numbers: bool = True,
    file_type: str = "CSV",
    inspected: DataFrame | None = None,
) -> DataFrame:
    """Raw records of CSV files, each with its own header; ``sep`` None finds the delimiter per file.

    Cells are stripped, missing ones are "", extra ones dropped, rows without any value skipped.
    Quoted cells may hold line breaks with ``multi_line``; files are split over tasks all the same (see
    :mod:`rowkin.sources.quoted`), unless their lines end with a carriage return alone.  Lines are stored once
    for that, and for their numbers: without ``line_numbers`` each file is read as a whole instead, and nothing
    is stored.  Without ``multi_line`` every line is a record.  ``inspected`` is the outcome of
    :func:`inspect_files`, where the caller has it already, and reports what :func:`failed_files` says;
    without it a header longer than ``MOST_HEADER`` is an error.
    """
    reported = inspected is not None
    if inspected is None:
        inspected = inspect_files(spark, paths)
    # One row per file: the file listing, which the driver holds for any scan.
    kinds, split, separators = defaultdict(list), [], set()
    for row in inspected.select("path", "header", "header_chars", "sep", "encoding", "returns").toLocalIterator():
        if row["header"] is None:
            if not reported:
                raise ValueError(f"{row['path']}: {TOO_LONG % row['header_chars']}")
            continue
        found, pattern = sep or row["sep"], as_pattern(row["path"])
        if multi_line and line_numbers and not row["returns"]:
            split.append(pattern)
            separators.add(found)
            continue
        if multi_line and row["header"].count('"') % 2:  # a quoted cell of the header goes on behind the line
            names = _first_record(spark, pattern, found, row["encoding"])
        else:
            names = header_names(row["header"], found)
        kinds[(tuple(names), found, row["encoding"])].append(pattern)
    scans = [
        _scan_alike(spark, files, names, found, encoding, multi_line, line_numbers, file_type)
        for (names, found, encoding), files in sorted(kinds.items())
    ]
    if split:
        known = inspected.where("header is not null").withColumn("sep", F.lit(sep)) if sep else inspected
        scans.append(_scan_split(spark, split, known, sorted(separators), file_type))
    if not scans:
        return spark.createDataFrame([], NO_RECORDS_YET)
    return union_sources(*scans)


def failed_files(inspected: DataFrame) -> DataFrame:
    """``(filename, reason, path)`` of the files whose header is too long to be read."""
    return inspected.where("header is null").select(
        file_name(F.col("path")).alias("filename"),
        F.format_string(TOO_LONG, F.col("header_chars").cast("string")).alias("reason"),
        path_key(F.col("path")).alias("path"),
    )


def scan_tsv(spark: SparkSession, paths: str | list[str], **options) -> DataFrame:
    """:func:`scan_csv` with tabs."""
    return scan_csv(spark, paths, sep="\t", file_type="TSV", **options)


def header_names(header: str, sep: str) -> list[str]:
    """Cell names of a header line; a missing name becomes ``col_i``."""
    before = csv.field_size_limit(MOST_HEADER)
    try:
        return _names(next(csv.reader([header.lstrip("\ufeff")], delimiter=sep)))
    finally:
        csv.field_size_limit(before)


def _names(cells: list[str | None]) -> list[str]:
    return [cell.strip() if cell else f"col_{i}" for i, cell in enumerate(cells)]


def _first_record(spark: SparkSession, path: str, sep: str, encoding: str) -> list[str]:
    """The names in a header that spans lines, read by the reader of the records themselves."""
    options = {"sep": sep, "encoding": encoding, "multiLine": True, "quote": '"', "escape": '"', "maxCharsPerColumn": MOST_HEADER}
    first = list(spark.read.options(header=False, **options).csv(path).limit(1).first())
    return _names([first[0].lstrip("\ufeff") if first[0] else first[0], *first[1:]])


def _scan_split(spark, patterns, inspected, separators, file_type) -> DataFrame:
    cells = quoted.cells_of(quoted.records(spark, patterns, inspected), separators)
    rows = quoted.raw_maps(cells).select(
        file_name(F.col("path")).alias("source_file"),
        F.lit(file_type).alias("file_type"),
        F.col("number").alias("line_number"),
        "raw",
        path_key(F.col("path")).alias(SOURCE_PATH),
    )
    return rows.where(F.exists(F.map_values("raw"), lambda v: v != ""))


def _scan_alike(spark, files, names, sep, encoding, multi_line, line_numbers, file_type) -> DataFrame:
    columns = [f"c{i}" for i in range(len(names))]
    rows = (
        spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
        .options(header=True, sep=sep, encoding=encoding, multiLine=multi_line, quote='"', escape='"')
        .csv(files)
    )
    # Of several cells with one name the last counts.  One literal and one lambda, however many columns there are.
    cell_of = dict(zip(names, columns))
    cells = F.transform(F.expr(f"array({', '.join(cell_of.values())})"), lambda cell: strip(F.coalesce(cell, F.lit(""))))
    raw = F.map_from_arrays(F.from_json(F.lit(json.dumps(list(cell_of))), "array<string>"), cells)
    picked = rows.select(
        file_name(own_path()).alias("source_file"),
        F.lit(file_type).alias("file_type"),
        raw.alias("raw"),
        path_key(own_path()).alias(SOURCE_PATH),
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
    )
    if line_numbers:
        picked = with_row_numbers(picked, "_path", "_block", "_at", "line_number", 2)
    else:
        picked = picked.withColumn("line_number", F.lit(None).cast("bigint"))
    found = picked.where(F.exists(F.map_values("raw"), lambda v: v != ""))
    return found.select(*RECORD_COLUMNS, SOURCE_PATH)
