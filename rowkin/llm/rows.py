"""Names for the rows of a table, so that narrow results find their rows again."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowkin.scratch import PLAIN_READS, write_out

#: Rows with whole texts that a task works on, and hands back, at a time.
PART = 1_000
#: Narrow rows (some 16 to 40 bytes) that are broadcast to find their documents; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def _numbered(docs: DataFrame) -> Column | None:
    """The hidden column with the place of every row, if ``docs`` is a plain table of files that number their rows."""
    plan = docs._jdf.queryExecution().analyzed()
    if plan.children().nonEmpty() or not docs.inputFiles():
        return None
    # A table may have a column of its own with this name.
    hidden = docs.metadataColumn("_metadata")
    return hidden if "row_index" in docs.select(hidden.alias("m")).schema["m"].dataType.names else None


def keyed(docs: DataFrame, label: str) -> DataFrame:
    """(key, doc): a name for every row, the same whenever it is read, and the row itself as a struct.

    Parquet files name their rows themselves, by path and row number, however they are split.  Anything
    but a plain table of such files (a plan, a table of JSON, CSV or ORC files) is written first.  The columns of
    ``docs`` may have any names.
    """
    place = _numbered(docs)
    if place is None:
        docs = write_out(docs, label)
        place = docs.metadataColumn("_metadata")
    name = F.concat_ws(":", place["file_path"], place["row_index"])
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(F.unhex(F.md5(name)).alias("key"), row.alias("doc"))


def flat(docs: DataFrame, text_col: str) -> tuple[DataFrame, int]:
    """``docs`` with its columns named ``_0``, ``_1``, ..., and the place of the text as a string: its own, or, if that
    holds no strings, that of one more column at the end.  So a whole text goes to Python once."""
    columns = [F.col(f"`{c}`").alias(f"_{k}") for k, c in enumerate(docs.columns)]
    if isinstance(docs.schema[text_col].dataType, T.StringType):
        return docs.select(*columns), docs.columns.index(text_col)
    return docs.select(*columns, F.col(f"`{text_col}`").cast("string").alias("_text")), len(columns)


def parts(batches: Iterator[pa.RecordBatch], rows: int = PART) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most so many rows, as results are gathered piece by piece."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run``, after which the memory that it has freed goes back to the system.

    Python workers live on after a task, and each would keep the most that any of its tasks took.
    """

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc has it
                trim(0)

    return whole


def bounded(df: DataFrame, rows: int) -> DataFrame:
    """``df`` with a broadcast hint if its ``rows`` are few enough."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


@contextmanager
def _set(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def _batch_limits(spark: SparkSession, rows: int, size: int) -> dict[str, str]:
    limits = {"spark.sql.execution.arrow.maxRecordsPerBatch": rows, "spark.sql.execution.arrow.maxBytesPerBatch": size}
    now = {name: int(spark.conf.get(name).rstrip("b")) for name in limits}
    return {name: str(min(most, now[name]) if now[name] > 0 else most) for name, most in limits.items()}


@contextmanager
def small_batches(spark: SparkSession, rows: int = PART, size: int = 4 << 20) -> Iterator[None]:
    """Arrow batches of at most so many rows, and of about so many bytes, for the jobs run inside: with whole texts in
    them, ten times as many take tens of megabytes on either side of every task."""
    with _set(spark, _batch_limits(spark, rows, size)):
        yield


def lean(spark: SparkSession, rows: int = PART, size: int = 4 << 20) -> None:
    """Small batches and plain reads for all later jobs of the session.

    For an application whose results run after the functions that made them: what a task frees, its process keeps.
    """
    for name, value in (_batch_limits(spark, rows, size) | PLAIN_READS).items():
        spark.conf.set(name, value)


def short_shuffles(spark: SparkSession):
    """Shuffle files go when the job that wrote them has ended: for steps that each write a table, from which the next reads."""
    return _set(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def plain_reads(spark: SparkSession):
    """No vectored reads of Parquet files in the jobs run inside, whoever named the files: see ``PLAIN_READS``."""
    return _set(spark, PLAIN_READS)
