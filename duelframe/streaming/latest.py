"""A table of newest rows per key that micro-batches add to.

Each batch adds only its own winners under ``batch_id=<n>``; running a batch again replaces
just that folder, so retries change nothing. Readers merge the folders with the same
newest-per-key rule, and ``compact`` folds them into one.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.ranks import latest_per_key


class LatestTable:
    def __init__(self, path: str, keys: list[str], ts: str, ties: list[str]):
        self.path, self.keys, self.ts, self.ties = path, keys, ts, ties

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        winners = latest_per_key(batch, self.keys, self.ts, self.ties)
        winners.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")

    def read(self, spark: SparkSession) -> DataFrame:
        rows = spark.read.option("basePath", self.path).parquet(f"{self.path}/batch_id=*")
        return latest_per_key(rows, self.keys, self.ts, [*self.ties, "batch_id"]).drop("batch_id")

    def compact(self, spark: SparkSession, target: str) -> "LatestTable":
        """Write the merged state as the first batch of a new table."""
        self.read(spark).write.mode("overwrite").parquet(f"{target}/batch_id=0")
        return LatestTable(target, self.keys, self.ts, self.ties)


# State of any size on disk; of an executor's memory it takes so many MB in all, whatever the number of partitions.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "300",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams that start here keep their state in RocksDB; a checkpoint that began with another store goes on with it."""
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def run_available(stream_writer, checkpoint: str) -> None:
    """Process everything that is there now, then stop."""
    query = stream_writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    finally:
        query.stop()


def newest_version(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Newest batch's row per key of an update-mode log."""
    others = [c for c in rows.columns if c not in (*keys, "batch_id")]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*others), "batch_id").alias("_r"))
    return best.select(*keys, *[f"_r.{c}" for c in others])
