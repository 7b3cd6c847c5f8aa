"""Ranks, newest-per-key and ordinals. Every window has a partition key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import written
from .prefix import row_numbers
from .ranges import by_size, dealt, same_keys


#: Rows of range starts that travel with every task; more of them are joined by a shuffle.
STARTS = 100_000


def _from_starts(rows: DataFrame, pool: list[str], parts: DataFrame, start: Column) -> DataFrame:
    """``rows`` with ``_start`` of their pool's part in their range; ``parts`` has one row for each, numbered along the pool."""
    starts = written(parts.select(*pool, "_range", start.alias("_start")), "starts")
    if starts.count() <= STARTS:
        starts = F.broadcast(starts)
    return rows.alias("r").join(starts.alias("s"), same_keys([*pool, "_range"], "r", "s")).select("r.*", "_start")


def pool_numbers(df: DataFrame, pool: list[str], order: list[Column], name: str) -> DataFrame:
    """Number the rows of each pool 1..N in ``order``; ``df`` is read once.

    The sorted ranges are written; a row's number is its place in its range plus the rows of its pool in earlier ranges,
    which are counted range by range.
    """
    placed = dealt(df, pool, order).sortWithinPartitions(*[F.col(c) for c in pool], *order)
    rows = written(placed.withColumn("_place", F.monotonically_increasing_id()), "ranges")
    parts = rows.groupBy(*pool, "_range").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*pool).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1
    out = _from_starts(rows, pool, parts, start)
    return out.select(*df.columns, (F.col("_place") + F.col("_start")).cast("int").alias(name))


def pool_dense_numbers(df: DataFrame, pool: list[str], value: str, spread: list[str], name: str) -> DataFrame:
    """Number the distinct values of each pool 1..N, ascending; ``df`` is read once.

    Equal values may lie in several ranges, split by ``spread``: a range that begins with the value that the one before
    ends with counts it once only.
    """
    inside = Window.partitionBy(*pool, "_range").orderBy(value)
    rows = written(dealt(df, pool, [F.col(c) for c in [value, *spread]]).withColumn("_in", F.dense_rank().over(inside)), "ranges")
    parts = rows.groupBy(*pool, "_range").agg(F.max("_in").alias("_n"), F.min(value).alias("_low"), F.max(value).alias("_high"))
    along = Window.partitionBy(*pool).orderBy("_range")
    parts = parts.withColumn("_again", F.coalesce((F.lag("_high").over(along) == F.col("_low")).cast("int"), F.lit(0)))
    start = F.coalesce(F.sum(F.col("_n") - F.col("_again")).over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) - F.col("_again")
    out = _from_starts(rows, pool, parts, start)
    return out.select(*df.columns, (F.col("_in") + F.col("_start")).cast("int").alias(name))


def _sortable(name: str, high: bool) -> tuple[Column, Column]:
    """Class and value of a metric, so that ascending order is rank order; True: high is better.

    NaN counts as the highest value. The class puts it first or last and nulls last. Adding zero turns a negative zero
    into zero.
    """
    v = F.col(name).cast("double")
    kind = F.when(v.isNull(), 2).when(F.isnan(v), 0 if high else 1).otherwise(1 if high else 0)
    return kind, (-v if high else v) + 0.0


def _cells(metrics: dict[str, bool]) -> Column:
    """(metric, class, value) of every metric."""
    return F.array(*[F.struct(F.lit(n).alias("_metric"), *[c.alias(x) for c, x in zip(_sortable(n, h), ("_class", "_v"))])
                     for n, h in metrics.items()])


def _wide(ranked: DataFrame, keys: list[str], metrics: dict[str, bool], carried: list[str] = ()) -> DataFrame:
    return ranked.groupBy(*keys).agg(*[F.any_value(c, True).alias(c) for c in carried],
                                     *[F.max(F.when(F.col("_metric") == n, F.col("_rank"))).alias(f"{n}_rank") for n in metrics])


def dense_rank_league(df: DataFrame, by: list[str], metrics: dict[str, bool], key: tuple[str, ...] = ("team",),
                      derived: dict[str, Column] | None = None, store: bool = True) -> DataFrame:
    """Dense rank per metric (True: high is better) over the whole pool of ``by``. Nulls and NaN get no rank.

    ``df`` has one row per pool and ``key``. Values are compared as doubles. ``derived`` adds columns that are worked out
    where the rows of a pool have met, so that they are not shuffled. Without ``store`` the pools are counted from ``df``
    itself, which pays where it is quickly made from few rows.
    """
    derived = derived or {}

    def small(rows: DataFrame) -> DataFrame:
        if derived:
            rows = rows.repartition(*by).withColumns(derived)
        out = []
        for name, high in metrics.items():
            value = F.nanvl(_sortable(name, high)[1], F.lit(None).cast("double"))
            order = Window.partitionBy(*by).orderBy(F.asc_nulls_last(value))
            out.append(F.when(value.isNotNull(), F.dense_rank().over(order)).alias(f"{name}_rank"))
        return rows.select("*", *out)

    def large(rows: DataFrame) -> DataFrame:
        rows = rows.withColumns(derived) if derived else rows
        cells = rows.select(*by, *key, F.explode(_cells(metrics)).alias("_c")).select(*by, *key, "_c._metric", "_c._v").where(
            "_v IS NOT NULL AND NOT isnan(_v)")
        wide = _wide(pool_dense_numbers(cells, ["_metric", *by], "_v", list(key), "_rank"), [*by, *key], metrics)
        joined = rows.alias("d").join(wide.alias("w"), same_keys([*by, *key], "d", "w"), "left")
        return joined.select("d.*", *[f"{n}_rank" for n in metrics])

    return by_size(df, by, small, large, store=store)


def ordinal_ranks(df: DataFrame, by: list[str], metrics: dict[str, bool], tie: str) -> DataFrame:
    """``<metric>_rank`` by value (True: high is better) over the whole pool of ``by``, ties broken by ``tie``; nulls get none.

    ``df`` has one row per pool and ``tie``. Values are compared as doubles.
    """
    def small(rows: DataFrame) -> DataFrame:
        out = []
        for name, high in metrics.items():
            order = Window.partitionBy(*by).orderBy(*_sortable(name, high), tie)
            out.append(F.when(F.col(name).isNotNull(), F.row_number().over(order)).alias(f"{name}_rank"))
        return rows.select("*", *out)

    def large(rows: DataFrame) -> DataFrame:
        # All metrics are ranked together; a row's other columns travel with the first.
        first, rest = next(iter(metrics)), [c for c in df.columns if c not in (*by, tie)]
        cells = rows.select("*", F.explode(_cells(metrics)).alias("_c")).select(
            *by, tie, "_c.*", *[F.when(F.col("_c._metric") == first, F.col(c)).alias(c) for c in rest])
        numbered = pool_numbers(cells, ["_metric", *by], [F.col("_class"), F.col("_v"), F.col(tie)], "_rank")
        ranked = numbered.withColumn("_rank", F.when(F.col("_v").isNotNull(), F.col("_rank")))
        return _wide(ranked, [*by, tie], metrics, rest).select(*df.columns, *[f"{n}_rank" for n in metrics])

    return by_size(df, by, small, large, store=True)


def ordinal_rank(df: DataFrame, by: list[str], value: str, tie: str, name: str, descending: bool = True) -> DataFrame:
    """Rank by value over the whole pool of ``by``, ties broken by ``tie``; nulls get no rank."""
    order = [F.desc_nulls_last(value) if descending else F.asc_nulls_last(value), F.col(tie)]

    def kept(rows: DataFrame, number: Column) -> DataFrame:
        return rows.select(*df.columns, F.when(F.col(value).isNotNull(), number).alias(name))

    return by_size(df, by, lambda rows: kept(rows, F.row_number().over(Window.partitionBy(*by).orderBy(*order))),
                   lambda rows: kept(pool_numbers(rows, by, order, "_number"), F.col("_number")), store=True)


def contiguous_rank(df: DataFrame, by: list[str], keep: Column, rank: str, tie: str, name: str) -> DataFrame:
    """Keep one class of ranked rows and number it 1..N by (rank, tie)."""
    return ordinal_rank(df.where(keep), by, rank, tie, name, descending=False)


def best_per_key(df: DataFrame, keys: list[str], *order) -> DataFrame:
    """First row per key in a total order.

    ``row_number() = 1`` lets Spark keep one row per key before the shuffle (window group
    limit), so a hot key sends one row per map task.
    """
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_rn = 1").drop("_rn")


def latest_per_key(df: DataFrame, keys: list[str], ts: str, ties: list[str]) -> DataFrame:
    """Newest row per key; equal timestamps fall back to the given tie columns, first wins."""
    return best_per_key(df.where(F.col(ts).isNotNull()), keys, F.desc(ts), *[F.asc(t) for t in ties])


def upsert_keep_best(master: DataFrame, new: DataFrame, keys: list[str], scored: Column, priority: Column,
                     ties: list[str]) -> DataFrame:
    """Union of both; per key prefer a scored row, then source priority, then the new row."""
    both = (master.withColumn("_new", F.lit(0))
            .unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True))
    both = both.select("*", F.coalesce(scored, F.lit(False)).cast("int").alias("_scored"),
                       F.coalesce(priority, F.lit(2147483647)).alias("_prio"))
    best = best_per_key(both, keys, F.desc("_scored"), F.asc("_prio"), F.desc("_new"), *[F.asc(t) for t in ties])
    return best.drop("_new", "_scored", "_prio")


def dedupe_first(df: DataFrame, page: list[str], rank: str, team: str, position: str) -> DataFrame:
    """Rows of each page in source order, without those whose rank or team an earlier kept row has.

    A skipped row claims neither its rank nor its team, so the lines are folded one after another; a page is one source
    row, so its lines fit into one.
    """
    lines = F.array_sort(F.collect_list(F.struct(F.col(position).alias("_at"), F.struct(*df.columns).alias("_row"))))
    rows = F.transform("_lines", lambda x: x["_row"])
    none = F.filter(rows, lambda x: F.lit(False))

    def claimed(values: Column, value: Column) -> Column:
        return F.when(value.isNull(), F.exists(values, lambda v: v.isNull())).otherwise(
            F.coalesce(F.array_contains(values, value), F.lit(False)))

    # What is claimed is kept beside the rows: it is searched for every line.
    start = F.struct(none.alias("rows"), F.transform(none, lambda x: x[rank]).alias("ranks"), F.transform(none, lambda x: x[team]).alias("teams"))
    kept = F.aggregate(rows, start, lambda seen, x: F.when(
        claimed(seen["ranks"], x[rank]) | claimed(seen["teams"], x[team]), seen).otherwise(F.struct(
            F.concat(seen["rows"], F.array(x)).alias("rows"), F.concat(seen["ranks"], F.array(x[rank])).alias("ranks"),
            F.concat(seen["teams"], F.array(x[team])).alias("teams"))), lambda seen: seen["rows"])
    return df.groupBy(*page).agg(lines.alias("_lines")).select(F.explode(kept).alias("_row")).select("_row.*")


def game_numbers(games: DataFrame, by: list[str], week: str = "wk", kickoff: str = "kickoff", key: str = "game_id") -> DataFrame:
    """Ordinal within the week by kickoff and its display number, week then two digits. A week may hold a third of all games."""
    out = row_numbers(games, [*by, week], [kickoff, key], "ordinal")
    digits = F.when(F.col("ordinal") < 100, F.lpad(F.col("ordinal").cast("string"), 2, "0")).otherwise(
        F.col("ordinal").cast("string"))
    return out.withColumn("game_number", F.concat(F.col(week).cast("string"), digits))


def team_numbers(teams: DataFrame, name: str, by: list[str]) -> DataFrame:
    """Alphabetical number of each distinct name within its league or season."""
    distinct = teams.select(*by, name).where(F.col(name).isNotNull()).distinct()
    return row_numbers(distinct, by, [name], "team_number")
