"""Weekly tables that are rewritten only where they change, and tables in an order that can be read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..operators.prefix import running_sums
from ..operators.ranges import same_keys
from ..streaming import folders as fs
from ..session import written
from .files import write_week


def week_fingerprints(df: DataFrame, partitions: list[str], ignore: tuple[str, ...] = ()) -> DataFrame:
    """Rows and an order-free hash of each partition; ``ignore`` names columns that may differ, such as load times."""
    cols = sorted(c for c in df.columns if c not in ignore)
    return df.groupBy(*partitions).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64(*cols).cast("decimal(20,0)")).alias("hash"))


def write_changed_weeks(df: DataFrame, path: str, fingerprints: str, partitions: tuple[str, ...] = ("season", "wk"),
                        order: tuple[str, ...] = ("kickoff", "game_id"), ignore: tuple[str, ...] = (),
                        fmt: str = "parquet") -> DataFrame:
    """Overwrite the weeks of ``path`` whose rows differ from what was last written; one row per week with its ``status``.

    ``new``, ``changed``, ``unchanged`` or ``gone`` (stored, but not in ``df``: it is kept as it is). Fingerprints
    are numbered folders. A run that writes first marks its weeks as unknown, so that the next one rewrites them if it is
    cut off, and notes their fingerprints when they are stored. A run without a difference writes nothing.
    """
    spark, keys = df.sparkSession, list(partitions)
    now = written(week_fingerprints(df, keys, ignore), "fingerprints")
    runs = [int(n) for n in fs.names(spark, fingerprints) if n.isdigit()]
    finished = [n for n in runs if "_SUCCESS" in fs.names(spark, f"{fingerprints}/{n}")]
    before = (spark.read.schema(now.schema).parquet(f"{fingerprints}/{max(finished)}") if finished else now.limit(0))
    joined = now.alias("n").join(before.alias("o"), same_keys(keys, "n", "o"), "full_outer")
    same = F.col("n.rows").eqNullSafe(F.col("o.rows")) & F.col("n.hash").eqNullSafe(F.col("o.hash"))
    status = (F.when(F.col("o.rows").isNull(), "new").when(F.col("n.rows").isNull(), "gone")
              .when(same, "unchanged").otherwise("changed"))
    compared = written(joined.select(
        *[F.coalesce(f"n.{k}", f"o.{k}").alias(k) for k in keys], status.alias("status"),
        F.coalesce("n.rows", "o.rows").alias("rows"), F.coalesce("n.hash", "o.hash").alias("hash")), "weeks")
    wanted = compared.where("status in ('new', 'changed')").select(*keys)
    if not wanted.isEmpty():
        rows = df.alias("d").join(wanted.alias("w"), same_keys(keys, "d", "w"), "left_semi").select("d.*")
        number = max(runs, default=0) + 1
        pending = F.when(F.col("status").isin("unchanged", "gone"), F.col("hash"))
        compared.withColumn("hash", pending).select(*now.columns).write.mode("overwrite").parquet(f"{fingerprints}/{number}")
        write_week(rows, path, fmt, partitions, order)
        compared.select(*now.columns).write.mode("overwrite").parquet(f"{fingerprints}/{number + 1}")
    return compared.select(*keys, "rows", "status")


def write_sorted(df: DataFrame, path: str, order: list[str], files: int | None = None) -> None:
    """Parquet files in one order: sorted inside each file, and every file behind the one before it by name.

    Rows are dealt by ranges that Spark draws from the data; with a total order the same rows give the same files.
    """
    files = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.repartitionByRange(files, *order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def read_sorted(spark: SparkSession, path: str, name: str = "ordinal") -> DataFrame:
    """Rows of a sorted table with their place 1..N over all files, as the files' names and the rows in them say."""
    rows = spark.read.parquet(path)
    columns = rows.columns
    rows = rows.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    sizes = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_n")).withColumn("_all", F.lit(1))
    starts = running_sums(sizes, ["_all"], ["_file"], {"_upto": F.col("_n")})
    starts = starts.select("_file", (F.col("_upto") - F.col("_n")).alias("_start"))
    return rows.join(starts, "_file").select(*columns, (F.col("_row") + F.col("_start") + 1).alias(name))


def order_breaks(spark: SparkSession, path: str, order: list[str]) -> int:
    """How many rows of a sorted table are behind a larger one: 0 proves the order from the files."""
    rows = spark.read.parquet(path)
    rows = rows.select(F.struct(*order).alias("_key"), F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    # Neighbours inside a file, and each file's ends against the files before it.
    inside = Window.partitionBy("_file").orderBy("_row")
    wrong = rows.withColumn("_last", F.lag("_key").over(inside)).where("_key < _last").count()
    ends = rows.groupBy("_file").agg(F.min("_key").alias("_low"), F.max("_key").alias("_high")).withColumn("_all", F.lit(1))
    files = Window.partitionBy("_all").orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    return wrong + ends.withColumn("_before", F.max("_high").over(files)).where("_low < _before").count()
