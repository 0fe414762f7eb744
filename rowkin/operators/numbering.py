"""Consecutive numbers over a whole table without putting it into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowkin.scratch import write_out

_POSITION_BITS = 33  # low bits of monotonically_increasing_id: position inside a partition


def number_rows(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Add ``name``: 1, 2, 3, ... in the order of the given columns.

    The rows are range-partitioned and sorted inside their partitions; each partition then starts
    where the rows before it end.  Only the row count of every partition passes the driver.
    """
    spark = df.sparkSession
    placed = write_out(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_at", _POSITION_BITS)),
        "numbered",
    )
    starts, before = [], 0
    for row in sorted(placed.groupBy("_part").count().collect()):
        starts.append((row["_part"], before))
        before += row["count"]
    offsets = spark.createDataFrame(starts, "_part bigint, _before bigint")
    position = F.col("_at") - F.shiftleft(F.col("_part"), _POSITION_BITS)
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + position + 1)
        .drop("_part", "_at", "_before")
    )
