"""Intermediate tables in the cluster's shared folder, and connected components over them."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; without the setting a local session takes the temp folder, a cluster fails."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return (base or f"{tempfile.gettempdir()}/duelframe-llm").rstrip("/")


class Stored:
    """Tables written once and read by later jobs, so that a lost executor costs a reread and no recomputation.

    ``drop`` removes a table that no later job reads.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.base = spark, f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
        self.paths: dict[int, str] = {}
        self.count = 0

    def save(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.base}/{self.count}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for table in tables:
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop(id(table)))
            path.getFileSystem(conf).delete(path, True)
        # Shuffle files of finished jobs go when both sides of the driver have collected the plans that own them. The last
        # job's are only free in a second round.
        for _ in range(2):
            gc.collect()
            jvm.System.gc()


#: Narrow rows of a task; tables with fewer rows than tasks of this size take fewer tasks.
TASK_ROWS = 50_000


def few_tasks(df: DataFrame, rows: int, per: int = TASK_ROWS) -> DataFrame:
    """df, which comes out of a shuffle of about ``rows`` rows, in tasks of ``per`` rows, four at least.

    Larger tables, which would take as many tasks as there are shuffle partitions, stay as they are. All rows stay in any case.
    """
    tasks = max(4, -(-rows // per))
    return df.coalesce(tasks) if tasks < int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


#: A key is heavy if it holds more than one row in HEAVY, so there are fewer heavy keys than this.
HEAVY = 1024


def spread_join(rows: DataFrame, table: DataFrame, on: str | list[str], count: str) -> DataFrame:
    """Left join of rows with the written table, whose keys are unique, leaving the table's column ``count`` out.

    ``count`` is the number of rows with the key. Heavy keys are sent to the rows, the others meet them in a shuffle, in which
    no key has more than one row in HEAVY. Rows with a null key should go round the join.
    """
    total = table.agg(F.sum(count)).first()[0] or 0
    heavy = F.col(count) * HEAVY > total
    few, rest = table.where(heavy).drop(count), table.where(~heavy).drop(count)
    on = [on] if isinstance(on, str) else on
    if few.isEmpty():
        return rows.join(rest, on, "left")
    columns = [*rows.columns, *(c for c in few.columns if c not in on)]
    return (rows.join(F.broadcast(few), on).select(*columns)
            .union(rows.join(F.broadcast(few.select(*on)), on, "left_anti").join(rest, on, "left").select(*columns)))


def components(spark: SparkSession, edges: DataFrame, store: Stored) -> DataFrame:
    """(node, component) of every node of the undirected edges (a, b); component is its smallest reachable node.

    Alternates the large-star and small-star steps until the edges are stars; each step is a grouped minimum and a join,
    and the edges of each round are written. A round takes tasks in proportion to the written edges, which are counted first.
    Empty edges give an empty table.
    """
    n = edges.count()
    current = store.save(few_tasks(edges.select("a", "b").where("a <> b").distinct(), n))
    seen = None
    while True:
        both = current.select(F.col("a").alias("u"), F.col("b").alias("v")).union(current.select("b", "a"))
        low = few_tasks(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), 2 * n)
        large = few_tasks(both.where("v > u").join(low, "u"), 2 * n).select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = few_tasks(large.distinct(), n).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
        least = few_tasks(down.groupBy("u").agg(F.min("v").alias("m")), n)
        small = (few_tasks(down.join(least, "u"), n).where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
                 .union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct())
        after = store.save(few_tasks(small, n))
        now = after.agg(F.count("*"), F.sum(F.hash("a", "b"))).first()
        store.drop(current)
        current = after
        if now == seen:
            break
        seen, n = now, now[0]
    stars = current.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    return stars.union(current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
