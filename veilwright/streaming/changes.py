"""Current state from a stream of change events.

Each micro-batch is reduced to its net effect per key and merged with the versioned
state table, so a key's state depends on the order of events alone, not on how they
were cut into batches; a replayed batch changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import read_pointer, write_pointer


class StateTable:
    """``(key, order, columns, op)`` of the last event of each key; versions swap by one rename."""

    def __init__(self, spark: SparkSession, path: str, key: str, cols: Sequence[str], order: Sequence[str]):
        self.spark, self.path, self.key, self.cols, self.order = spark, path.rstrip("/"), key, list(cols), list(order)

    def read(self) -> DataFrame | None:
        v = read_pointer(self.spark, f"{self.path}/_CURRENT")
        return self.spark.read.parquet(f"{self.path}/v={v}") if v else None

    def merge(self, batch: DataFrame, batch_id: int) -> None:
        """Fold a batch in; of equal events one counts."""
        rows = batch.select(self.key, *self.order, *self.cols)
        old = self.read()
        if old is not None:
            rows = rows.unionByName(old)
        o = F.struct(*self.order)
        rest = [c for c in self.order + self.cols if c != self.key]
        out = rows.groupBy(self.key).agg(F.max_by(F.struct(*rest), o).alias("r")).select(self.key, "r.*")
        out.write.mode("overwrite").parquet(f"{self.path}/v={batch_id}")
        write_pointer(self.spark, f"{self.path}/_CURRENT", str(batch_id))


def run_available(stream: DataFrame, table: StateTable, checkpoint: str) -> None:
    """Process all that is there with checkpointed progress, then stop."""
    q = stream.writeStream.foreachBatch(lambda df, i: table.merge(df, i)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
