"""A table of newest rows per key whose folders stay few, whatever the number of batches.

Each batch writes its winners to ``delta-<n>``. Once more than ``every`` folders are in use, the batch also merges all of
them into ``base-<n>``. ``versions/<n>`` names the folders that make up the table after batch n; readers follow the
highest one, so a batch counts from the moment its version is there, and as a whole. A batch that runs again starts from
the version before it and writes the same folders, at whatever point it was cut off. Folders that neither the newest
version nor the one before it names are swept.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..operators.ranks import latest_per_key
from . import folders as fs


class VersionedTable:
    """``ties`` make the order of rows with equal ``ts`` total."""

    def __init__(self, path: str, keys: list[str], ts: str, ties: list[str], every: int = 8):
        self.path, self.keys, self.ts, self.ties, self.every = path, keys, ts, ties, every

    def _version(self, spark: SparkSession, below: int | None = None) -> dict | None:
        numbers = [int(n) for n in fs.names(spark, f"{self.path}/versions") if n.isdigit() and (below is None or int(n) < below)]
        return json.loads(fs.read_text(spark, f"{self.path}/versions/{max(numbers)}")) if numbers else None

    def _rows(self, spark: SparkSession, schema: StructType, names: list[str]) -> DataFrame:
        rows = spark.read.schema(schema).parquet(*[f"{self.path}/{n}" for n in names])
        return latest_per_key(rows, self.keys, self.ts, self.ties)

    def write_batch(self, batch: DataFrame, number: int) -> None:
        spark, schema = batch.sparkSession, batch.schema
        before = self._version(spark, below=number)
        names = [*(before["folders"] if before else []), f"delta-{number}"]
        latest_per_key(batch, self.keys, self.ts, self.ties).write.mode("overwrite").parquet(f"{self.path}/delta-{number}")
        if len(names) > self.every:
            self._rows(spark, schema, names).write.mode("overwrite").parquet(f"{self.path}/base-{number}")
            names = [f"base-{number}"]
        fs.write_text(spark, f"{self.path}/versions/{number}", json.dumps({"folders": names, "schema": schema.jsonValue()}))
        self._sweep(spark, {*names, *(before["folders"] if before else [])}, number)

    def _sweep(self, spark: SparkSession, used: set[str], number: int) -> None:
        for name in fs.names(spark, self.path):
            if name.startswith(("delta-", "base-")) and name not in used:
                fs.delete(spark, f"{self.path}/{name}")
        older = sorted(int(n) for n in fs.names(spark, f"{self.path}/versions") if n.isdigit() and int(n) < number)
        for n in older[:-1]:
            fs.delete(spark, f"{self.path}/versions/{n}")

    def read(self, spark: SparkSession) -> DataFrame:
        """The newest row of every key; the table must have a version."""
        version = self._version(spark)
        if version is None:
            raise ValueError(f"no batch was written to {self.path}")
        return self._rows(spark, StructType.fromJson(version["schema"]), version["folders"])
