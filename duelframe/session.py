"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings only: they take effect on a session the caller already has.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even when the split costs one more shuffle: a hot key must
    # never end up in a single task.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Catalyst's estimate misses what explode() adds, so joins are broadcast on measured sizes
    # only: adaptive execution looks at the finished shuffle files.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, empty path below the cluster's shared checkpoint folder.

    The folder named by ``spark.checkpoint.dir`` is visible to every executor. Without it only a local session, whose
    tasks run on the driver's machine, may write below the temp folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = os.path.join(tempfile.gettempdir(), "duelframe")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """The same rows from a table in the scratch folder: what is used more than once is computed once, and a lost executor
    costs a reread."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
