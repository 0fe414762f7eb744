"""Intermediate tables in the shared folder of the cluster.

Iterative and multi-tier steps write their narrow state as Parquet and read it back.  This cuts the
lineage, survives the loss of executors (the files live on shared storage, not on a worker), and lets
the next step prune columns and push filters.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Parquet's vectored reads of local files fetch whole column chunks, and every reading thread keeps a direct buffer as large as the
#: largest it has read, outside of all that Spark accounts for.  Plain reads need none.
PLAIN_READS = {"parquet.hadoop.vectored.io.enabled": "false"}

#: Paths made inside the innermost :func:`dropping`.
_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a temporary one only on a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    # A local-cluster master has executors of its own, so it needs a shared folder, too.
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="rowkin-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has been written to."""
    path = f"{shared_folder(spark)}/rowkin/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    if (made := _MADE.get()) is not None:
        made.append(path)
    return path


@contextmanager
def dropping(spark: SparkSession) -> Iterator[list[str]]:
    """Remove, in the end, the tables written inside; those taken off the list stay.

    Nothing that is read later may depend on them: the result has to be written itself.
    """
    made: list[str] = []
    token = _MADE.set(made)
    try:
        yield made
    finally:
        _MADE.reset(token)
        for path in made:
            name = spark._jvm.org.apache.hadoop.fs.Path(path)
            name.getFileSystem(spark._jsc.hadoopConfiguration()).delete(name, True)


@dataclass(frozen=True)
class Stored:
    """A written table with its row count and further figures, observed while it was written."""

    table: DataFrame
    rows: int
    figures: dict


def store(df: DataFrame, label: str, **figures: Column) -> Stored:
    """Write ``df`` to the shared folder and return the written table with its size.

    ``figures`` are further aggregates to observe on the way.
    """
    return _written(df, fresh_path(df.sparkSession, label), figures)


def _written(df: DataFrame, path: str, figures: dict[str, Column]) -> Stored:
    seen = Observation()
    watched = [F.count(F.lit(1)).alias("rows"), *[value.alias(name) for name, value in figures.items()]]
    df.observe(seen, *watched).write.parquet(path)
    values = seen.get
    return Stored(df.sparkSession.read.options(**PLAIN_READS).schema(df.schema).parquet(path), values["rows"], values)


def write_out(df: DataFrame, label: str) -> DataFrame:
    return store(df, label).table


class Growing:
    """One table written in steps: each adds a folder, and reading it is one scan however many there were."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.path, self.steps, self.schema = spark, fresh_path(spark, label), 0, None

    def add(self, df: DataFrame, **figures: Column) -> Stored:
        """Write ``df`` as the next step and return what was written."""
        path = f"{self.path}/step={self.steps}"
        self.steps, self.schema = self.steps + 1, df.schema
        return _written(df, path, figures)

    def table(self) -> DataFrame:
        """All steps so far, with their number as ``step``."""
        whole = T.StructType([*self.schema, T.StructField("step", T.IntegerType())])
        return self.spark.read.options(**PLAIN_READS).schema(whole).parquet(self.path)
