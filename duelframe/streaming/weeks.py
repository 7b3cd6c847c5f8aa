"""Finals by the week of their kickoff: open weeks take rows, closed weeks are final.

``watermark`` of a batch is the newest kickoff of the batches before it, less the lookback. Rows whose kickoff lies before
it go to ``late``, with those without kickoff; they change no week. The others go to ``open``, in a folder for each batch
and week. A week that ends at or before the watermark can get no more rows: its folders are merged into one part of
``closed`` and deleted, so what a batch has to look at is bounded by the lookback. A batch that runs again replaces its own folders;
where its closed part is complete, only the deleting is done again.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..functions.times import tuesday_start
from ..operators.ranks import latest_per_key
from . import folders as fs


def batch_watermark(spark: SparkSession, checkpoint: str, batch_id: int) -> dt.datetime | None:
    """The watermark that Spark logged for a batch before it ran (UTC), None before the first row."""
    lines = fs.read_text(spark, f"{checkpoint}/offsets/{batch_id}").splitlines()
    millis = json.loads(lines[1])["batchWatermarkMs"]
    return dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=millis) if millis else None


class OpenWeeks:
    def __init__(self, path: str, keys: list[str], kickoff: str = "kickoff", reported: str = "reported_at", ties: list[str] | None = None):
        self.path, self.keys, self.kickoff, self.reported, self.ties = path, keys, kickoff, reported, ties or []

    def write_batch(self, batch: DataFrame, number: int, watermark: dt.datetime | None) -> None:
        spark = batch.sparkSession
        if not fs.exists(spark, f"{self.path}/schema"):
            fs.write_text(spark, f"{self.path}/schema", batch.schema.json())
        # Read twice below: kept by Spark, and made again where an executor is lost.
        batch = batch.persist()
        try:
            limit = F.lit(watermark).cast("timestamp")
            late = F.col(self.kickoff).isNull() | (F.lit(watermark is not None) & F.coalesce(F.col(self.kickoff) < limit, F.lit(False)))
            batch.where(late).write.mode("overwrite").parquet(f"{self.path}/late/batch_id={number}")
            newest = latest_per_key(batch.where(~late), self.keys, self.reported, self.ties)
            week = F.date_format(tuesday_start(self.kickoff), "yyyy-MM-dd")
            newest.withColumn("week_start", week).write.mode("overwrite").partitionBy("week_start").parquet(f"{self.path}/open/batch_id={number}")
        finally:
            batch.unpersist()
        if watermark is not None:
            self._close(spark, number, watermark)

    def open_folders(self, spark: SparkSession) -> list[str]:
        """Paths of the folders of open weeks; their number is bounded by the lookback's weeks and batches."""
        return [f"{self.path}/open/{b}/{w}" for b in fs.names(spark, f"{self.path}/open") if b.startswith("batch_id=")
                for w in fs.names(spark, f"{self.path}/open/{b}") if w.startswith("week_start=")]

    def _close(self, spark: SparkSession, number: int, watermark: dt.datetime) -> None:
        def ended(path: str) -> bool:
            return dt.datetime.fromisoformat(path.rpartition("=")[2]) + dt.timedelta(days=7) <= watermark

        over = [p for p in self.open_folders(spark) if ended(p)]
        target = f"{self.path}/closed/batch_id={number}"
        if over and not fs.exists(spark, f"{target}/_SUCCESS"):
            rows = spark.read.schema(self._schema(spark)).parquet(*over)
            latest_per_key(rows, self.keys, self.reported, self.ties).write.mode("overwrite").parquet(target)
        for path in over:
            fs.delete(spark, path)
        for name in fs.names(spark, f"{self.path}/open"):
            if not [w for w in fs.names(spark, f"{self.path}/open/{name}") if w.startswith("week_start=")]:
                fs.delete(spark, f"{self.path}/open/{name}")

    def _schema(self, spark: SparkSession) -> StructType:
        return StructType.fromJson(json.loads(fs.read_text(spark, f"{self.path}/schema")))

    def _table(self, spark: SparkSession, paths: list[str]) -> DataFrame:
        schema = self._schema(spark)
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    def late(self, spark: SparkSession) -> DataFrame:
        return self._table(spark, [f"{self.path}/late/{n}" for n in fs.names(spark, f"{self.path}/late")])

    def read(self, spark: SparkSession) -> DataFrame:
        """Newest final of every key that came in time; ``is_closed`` tells those of closed weeks."""
        closed = self._table(spark, [f"{self.path}/closed/{n}" for n in fs.names(spark, f"{self.path}/closed")])
        rows = closed.withColumn("is_closed", F.lit(True)).unionByName(
            self._table(spark, self.open_folders(spark)).withColumn("is_closed", F.lit(False)))
        return latest_per_key(rows, self.keys, self.reported, self.ties)
