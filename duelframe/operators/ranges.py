"""Groups of any size along an order: small ones take a window, hot ones are dealt by ranges.

One team, pair of sides, week or pool may hold a third of all rows, and its rows may share a day or an instant. Groups that
one task may sort take an ordinary window. The rows of larger groups are dealt by ranges whose split points Spark draws from
the data; what a range passes on to the next ones (a count, a total, the last value seen) is worked out range by range.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import written

#: Rows of a group that one task may sort (some 100 bytes each, and sorts spill). Groups with more are dealt by ranges, which
#: writes and shuffles their rows several times; both ways give the same results.
POOL_ROWS = 1_000_000


def same_keys(keys: list[str], left: str, right: str) -> Column:
    """Equality of all keys of two aliases; nulls are equal."""
    out = F.lit(True)
    for key in keys:
        out = out & F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}"))
    return out


def dealt(df: DataFrame, pool: list[str], order: list[Column]) -> DataFrame:
    """Rows dealt by ranges of (pool, order), with the range's number.

    Spark draws the split points from the data, so a pool with a third of all rows and one with a far outlier lie in as
    many ranges as their rows need.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(ranges, *[F.col(c) for c in pool], *order).withColumn("_range", F.spark_partition_id())


def _placed(df: DataFrame, group: list[str], order: list[Column]) -> DataFrame:
    """The dealt rows, written, with ``_place``: it grows along the order of a range."""
    rows = dealt(df, group, order).sortWithinPartitions(*[F.col(c) for c in group], *order)
    return written(rows.withColumn("_place", F.monotonically_increasing_id()), "ranges")


def by_size(df: DataFrame, by: list[str], small: Callable[[DataFrame], DataFrame],
            large: Callable[[DataFrame], DataFrame], store: bool = False) -> DataFrame:
    """``small`` of the groups that one task may sort and ``large`` of the others.

    With ``store`` the rows are written before they are counted, otherwise only if some group is large.
    """
    if store:
        df = written(df, "ranked")
    big = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > POOL_ROWS).select(*by)
    if big.isEmpty():
        return small(df)
    if not store:
        df = written(df, "grouped")
        big = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > POOL_ROWS).select(*by)
    rows, hot = df.alias("r"), same_keys(by, "r", "b")
    return small(rows.join(big.alias("b"), hot, "left_anti")).unionByName(large(rows.join(big.alias("b"), hot, "left_semi")))


def _with_parts(rows: DataFrame, group: list[str], parts: DataFrame, passed: dict[str, Column]) -> DataFrame:
    """``rows`` with what the earlier ranges of their group pass on; ``parts`` has one row for each group and range."""
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(*group, "_range", *[c.over(earlier).alias(n) for n, c in passed.items()])
    # A range of a group is one task's worth of rows, so this join is even whatever the group.
    return rows.alias("r").join(starts.alias("s"), same_keys([*group, "_range"], "r", "s")).select("r.*", *passed)


def ranged_sums(df: DataFrame, group: list[str], order: list[Column], sums: list[str]) -> DataFrame:
    """The columns ``sums`` as running sums of each group up to and including the row; ``order`` must be total."""
    rows = _placed(df, group, order)
    parts = rows.groupBy(*group, "_range").agg(*[F.sum(n).alias(f"_t_{n}") for n in sums])
    inside = Window.partitionBy(*group, "_range").orderBy("_place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = rows.withColumns({n: F.sum(n).over(inside) for n in sums})
    out = _with_parts(run, group, parts, {f"_s_{n}": F.sum(f"_t_{n}") for n in sums})
    total = {n: F.coalesce(n, F.lit(0)) + F.coalesce(f"_s_{n}", F.lit(0)) for n in sums}
    return out.select(*[total[c].alias(c) if c in total else F.col(c) for c in df.columns])


def ranged_last(df: DataFrame, group: list[str], order: list[Column], values: list[str]) -> DataFrame:
    """The columns ``values`` replaced by the last one that is not null, up to and including the row."""
    rows = _placed(df, group, order)
    parts = rows.groupBy(*group, "_range").agg(
        *[F.max_by(F.col(n), F.when(F.col(n).isNotNull(), F.col("_place"))).alias(f"_t_{n}") for n in values])
    inside = Window.partitionBy(*group, "_range").orderBy("_place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = rows.withColumns({n: F.last(n, ignorenulls=True).over(inside) for n in values})
    out = _with_parts(seen, group, parts, {f"_s_{n}": F.last(f"_t_{n}", ignorenulls=True) for n in values})
    return out.select(*[F.coalesce(n, f"_s_{n}").alias(n) if n in values else F.col(n) for n in df.columns])


def window_last(df: DataFrame, group: list[str], order: list[Column], values: list[str]) -> DataFrame:
    """As :func:`ranged_last`, by one window over each group."""
    inside = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns({n: F.last(n, ignorenulls=True).over(inside) for n in values})


def spread(df: DataFrame) -> Column:
    """A hash of the row that deals rows of one instant; columns that Spark cannot hash are left out."""
    plain = [f.name for f in df.schema.fields if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
    return F.xxhash64(*plain) if plain else F.lit(0).cast("long")
