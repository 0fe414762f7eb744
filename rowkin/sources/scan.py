"""One scan over files of mixed formats."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowkin.scratch import write_out
from rowkin.sources.cards import scan_text
from rowkin.sources.delimited import failed_files, inspect_files, scan_csv, scan_tsv
from rowkin.sources.files import NO_RECORDS_YET, as_pattern, file_reports, list_files, read_documents, union_sources
from rowkin.sources.json_records import broken_documents, scan_json, scan_jsonl

_SCANS = {"csv": scan_csv, "tsv": scan_tsv, "json": scan_json, "jsonl": scan_jsonl, "text": scan_text}


def scan_files(
    spark: SparkSession, paths: str | list[str], *extracted: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """``(records, file_reports)`` of all files under ``paths``; one bad file never fails the rest.

    Each format is read by one scan over all its files.  ``extracted`` are raw records of files whose
    container format is decoded elsewhere: worksheets, reports, documents.
    """
    files = list_files(spark, paths)
    by_reader = defaultdict(list)
    # One row per file: the listing, which the driver holds for any scan.
    for row in files.select("path", "reader").where("reader is not null").collect():
        by_reader[row["reader"]].append(as_pattern(row["path"]))
    scans, failures = [], []
    for reader, scan in _SCANS.items():
        if not by_reader[reader]:
            continue
        if reader in ("csv", "tsv"):
            inspected = write_out(inspect_files(spark, by_reader[reader]), "inspected")
            scans.append(scan(spark, by_reader[reader], inspected=inspected))
            failures.append(failed_files(inspected))
        else:
            scans.append(scan(spark, by_reader[reader]))
    if by_reader["json"]:
        failures.append(broken_documents(read_documents(spark, by_reader["json"])))
    scans += extracted
    records = union_sources(*scans) if scans else spark.createDataFrame([], NO_RECORDS_YET)
    failures = union_sources(*failures) if failures else None
    return records, file_reports(files, records, failures)


def sink_json(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Write result rows as JSON documents, one per line."""
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.json(path)


def sink_parquet(df: DataFrame, path: str, partition_by: str | None = "duplicate_type") -> None:
    """Write result rows as Parquet, by default one folder per kind of outcome."""
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def record_documents(df: DataFrame) -> DataFrame:
    """Each row as one JSON text, NULL fields included."""
    packed = F.struct(*[F.col(c) for c in df.columns])
    return df.select(F.to_json(packed, {"ignoreNullFields": "false"}).alias("document"))
