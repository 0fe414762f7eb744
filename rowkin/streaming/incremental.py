"""Match a stream of records against a master that grows with every micro-batch."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowkin.operators.lookup import incremental_match
from rowkin.settings import DEFAULTS, MatchSettings


class MasterSink:
    """``foreachBatch`` target: hits go to ``hits_path``, new keys join the master under ``master_path``.

    Each micro-batch owns the folder ``batch=<id>`` in both places and overwrites it when the batch is
    replayed after a failure, reading the master as it stood before that batch: every record counts
    once.
    """

    def __init__(
        self,
        master_path: str,
        hits_path: str,
        key: str = "primary_key",
        id_col: str = "record_id",
        settings: MatchSettings = DEFAULTS,
    ):
        self.master_path = master_path
        self.hits_path = hits_path
        self.key = key
        self.id_col = id_col
        self.settings = settings

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        master = self._master_before(batch, batch_id)
        hits, fresh = incremental_match(batch, master, self.key, self.id_col, self.settings)
        slim = fresh.select(self.id_col, self.key)
        hits.write.mode("overwrite").parquet(f"{self.hits_path}/batch={batch_id}")
        slim.write.mode("overwrite").parquet(f"{self.master_path}/batch={batch_id}")

    def _master_before(self, batch: DataFrame, batch_id: int) -> DataFrame:
        spark = batch.sparkSession
        schema = batch.select(self.id_col, self.key).schema
        reader = spark.read.schema(schema.add("batch", "long")).option("basePath", self.master_path)
        try:
            master = reader.parquet(self.master_path).where(F.col("batch") < batch_id)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            # Nothing has been written before the first batch.
            return batch.select(self.id_col, self.key).limit(0)
        return master.select(self.id_col, self.key)

    def start(self, stream: DataFrame, checkpoint: str, **trigger):
        """Start the query; ``trigger`` as for ``writeStream.trigger``, by default ``availableNow``."""
        writer = stream.writeStream.foreachBatch(self).option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"availableNow": True})).start()

