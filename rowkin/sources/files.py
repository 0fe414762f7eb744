"""File listing, format detection, decoding, and reports per file."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from rowkin.operators.numbering import number_rows
from rowkin.scratch import write_out

# Extension -> (display name, reader).
FORMATS = {
    ".csv": ("CSV", "csv"),
    ".tsv": ("TSV", "tsv"),
    ".json": ("JSON", "json"),
    ".jsonl": ("JSONL", "jsonl"),
    ".ndjson": ("JSONL", "jsonl"),
    ".xlsx": ("Excel", "excel"),
    ".xls": ("Excel", "excel"),
    ".pdf": ("PDF", "pdf"),
    ".docx": ("Word (.docx)", "docx"),
    ".txt": ("Plain Text", "text"),
}

# The texts of a file report.
UNSUPPORTED = "Unsupported file extension '%s'. Supported: CSV, TSV, XLSX, XLS, JSON, JSONL, PDF, DOCX, TXT."
NO_RECORDS = "No records could be extracted from '%s'. The file may be empty or unformatted."
FAILED = "Error parsing '%s': %s"

RECORD_COLUMNS = ("source_file", "file_type", "line_number", "raw")
#: Scans of files also give the path, which tells files of one name apart.
SOURCE_PATH = "source_path"
NO_RECORDS_YET = "source_file string, file_type string, line_number bigint, raw map<string,string>, source_path string"


def extension(name: str) -> str:
    return os.path.splitext(name)[1].lower()


def extension_column(path: Column) -> Column:
    """Lower-case extension with its dot; a name that only starts with a dot has none."""
    base = F.regexp_extract(path, r"([^/]*)$", 1)
    return F.lower(F.regexp_extract(base, r"[^.].*(\.[^.]*)$", 1))


def plain_path(uri: Column) -> Column:
    """The path in a URI as readers give it in ``_metadata.file_path``; a plain path must not pass through here."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def own_path() -> Column:
    """The plain path of the file that a row was read from."""
    return plain_path(F.col("_metadata.file_path"))


def file_name(path: Column) -> Column:
    """The last part of a plain path, as it is: any mark may stand in a name."""
    return F.regexp_extract(path, r"([^/]*)$", 1)


def path_key(path: Column) -> Column:
    """One spelling of a plain path, however the reader that gave it writes its scheme."""
    return F.regexp_replace(path, "^([A-Za-z0-9+.-]+):/+", "$1:/")


def as_pattern(path: str) -> str:
    """A plain path that a reader takes for this file alone, not for a pattern of names."""
    return "".join(f"\\{mark}" if mark in "\\{}[]*?" else mark for mark in path)


def with_path(df: DataFrame) -> list[str]:
    """The path column, where ``df`` has it."""
    return [c for c in df.columns if c == SOURCE_PATH]


def detect_format(path: Column) -> Column:
    """Display name of the file format, NULL when unsupported."""
    return _lookup(path, 0)


def reader_of(path: Column) -> Column:
    return _lookup(path, 1)


def _lookup(path: Column, part: int) -> Column:
    pairs = [F.lit(x) for ext, names in FORMATS.items() for x in (ext, names[part])]
    return F.try_element_at(F.create_map(*pairs), extension_column(path))


def list_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``path, filename, format, reader, size_bytes, size_kb`` of the files; contents are not read.

    Files without a byte are listed, too, which readers leave out; they come from the listing that the driver
    holds for any scan.  Names that start with ``_`` or ``.`` are no data files.
    """
    found = spark.read.format("binaryFile").load(paths)
    sizes = found.select(own_path().alias("path"), F.col("length").alias("size_bytes"))
    listing = spark.createDataFrame([(uri,) for uri in found.inputFiles()], "uri string")
    names = listing.select(plain_path(F.col("uri")).alias("path")).distinct()
    return names.select(path_key(F.col("path")).alias("key"), "path").join(
        sizes.select(path_key(F.col("path")).alias("key"), "size_bytes").distinct(), "key", "left"
    ).select(
        "path",
        file_name(F.col("path")).alias("filename"),
        detect_format(F.col("path")).alias("format"),
        reader_of(F.col("path")).alias("reader"),
        F.coalesce("size_bytes", F.lit(0)).alias("size_bytes"),
        F.bround(F.coalesce("size_bytes", F.lit(0)) / 1024, 1).alias("size_kb"),
    )


def decode_text(content: Column) -> Column:
    """UTF-8 if the bytes are valid UTF-8, else Latin-1, which never fails."""
    return F.coalesce(
        F.try_validate_utf8(content.cast("string")), F.decode(content, "ISO-8859-1")
    )


def read_documents(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``source_file, text, source_path``: whole decoded files, one row each."""
    return spark.read.format("binaryFile").load(paths).select(
        file_name(own_path()).alias("source_file"),
        decode_text(F.col("content")).alias("text"),
        path_key(own_path()).alias(SOURCE_PATH),
    )


def with_row_numbers(rows: DataFrame, path: str, block: str, at: str, name: str, start: int) -> DataFrame:
    """Number the rows of each file in file order, from ``start``.

    ``at`` is ``monotonically_increasing_id`` taken at the scan and ``block`` the start of the file
    split a row came from.  The scanned rows are written once and numbered from that table, as another
    scan may split the files differently.  Only one row per file split is aggregated and joined back, so a
    file of any size is numbered without gathering its rows.
    """
    rows = write_out(rows, "scanned")
    splits = rows.groupBy(path, block).agg(F.min(at).alias("_first"), F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(path).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    placed = splits.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    placed = write_out(placed.drop("_rows"), "splits")
    return (
        rows.join(placed, [path, block])
        .withColumn(name, F.col(at) - F.col("_first") + F.col("_before") + start)
        .drop("_first", "_before", at, block)
    )


def union_sources(*scans: DataFrame) -> DataFrame:
    """All records of several scans under one schema."""
    whole = scans[0]
    for scan in scans[1:]:
        whole = whole.unionByName(scan, allowMissingColumns=True)
    return whole


def with_record_ids(records: DataFrame, order: tuple[str, ...] | None = None) -> DataFrame:
    """Add ``record_id``: 1, 2, 3, ... over files in name order, those of one name by path, and lines in
    file order."""
    return number_rows(records, list(order or ("source_file", *with_path(records), "line_number")), "record_id")


def file_reports(files: DataFrame, records: DataFrame, failures: DataFrame | None = None) -> DataFrame:
    """``filename, record_count, status, error`` of every file in ``files(filename)``.

    ``failures(filename, reason)`` names files that could not be parsed at all.  Where all of them carry
    paths (``path`` of files and failures, ``source_path`` of records), files are told apart by path, and the
    path is given, too.
    """
    by_path = "path" in files.columns and SOURCE_PATH in records.columns
    own, theirs = ("path", SOURCE_PATH) if by_path else ("filename", "source_file")
    if by_path:
        files = files.withColumn("path", path_key(F.col("path")))
    counts = records.groupBy(F.col(theirs).alias(own)).agg(F.count(F.lit(1)).alias("record_count"))
    joined = files.select(*dict.fromkeys((own, "filename"))).join(counts, own, "left")
    if failures is None:
        joined = joined.withColumn("reason", F.lit(None).cast("string"))
    else:
        joined = joined.join(failures.select(own, "reason"), own, "left")
    name = F.col("filename")
    supported = F.coalesce(F.col("record_count"), F.lit(0)) > 0
    error = (
        F.when(
            detect_format(name).isNull(),
            F.format_string(UNSUPPORTED, F.regexp_extract(name, r"[^./][^/]*(\.[^./]*)$", 1)),
        )
        .when(F.col("reason").isNotNull(), F.format_string(FAILED, name, "reason"))
        .when(~supported, F.format_string(NO_RECORDS, name))
    )
    failed = error.isNotNull()
    return joined.select(
        *([own] if by_path else []),
        name,
        F.when(failed, F.lit(0)).otherwise(F.col("record_count")).cast("bigint").alias("record_count"),
        F.when(failed, F.lit("error")).otherwise(F.lit("success")).alias("status"),
        error.alias("error"),
    )
