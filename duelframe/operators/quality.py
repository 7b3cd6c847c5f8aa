"""Set-based quality gates: each is one aggregate over the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import is_blank
from .skew import skew_join


def key_setops(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    """Every distinct key of either side and where it was found."""
    left = a.select(*on, F.lit(1).alias("_a"), F.lit(0).alias("_b"))
    right = b.select(*on, F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    # One aggregate with map-side combine in place of three set operations.
    both = left.unionByName(right).groupBy(*on).agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"))
    where = F.when(F.col("_b") == 0, "left_only").when(F.col("_a") == 0, "right_only").otherwise("both")
    return both.select(*on, where.alias("found"))


def coverage(df: DataFrame, rules: dict[str, tuple[Column, float]], by: list[str] | None = None) -> DataFrame:
    """Covered rows, fraction and pass flag per rule in one scan."""
    by = by or []
    counts = [F.count_if(cond).alias(f"_{name}") for name, (cond, _) in rules.items()]
    total = df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *counts)
    out = []
    for name, (_, threshold) in rules.items():
        fraction = F.try_divide(F.col(f"_{name}"), F.col("rows"))
        out.append(F.struct(F.lit(name).alias("rule"), F.col(f"_{name}").alias("covered"), fraction.alias("fraction"),
                            F.coalesce(fraction >= threshold, F.lit(False)).alias("passed")))
    return total.select(*by, "rows", F.explode(F.array(*out)).alias("r")).select(*by, "rows", "r.*")


def validate_ratings(df: DataFrame, by: list[str], low: int, high: int, rank: str = "pr_rank", team: str = "team",
                     rating: str = "pr", strength: str = "sos", strength_rank: str = "sos_rank",
                     min_strength: float = 0.9) -> DataFrame:
    """Checks of each snapshot: size, contiguous unique ranks, unique names, two decimals, strength."""
    def two_decimals(c: str) -> Column:
        scaled = F.col(c).cast("double") * 100
        return F.abs(scaled - F.rint(scaled)) < 1e-6

    # One row per (snapshot, rank) and per (snapshot, team) first: repeats are combined map-side.
    base = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct(rank).alias("ranks"), F.countDistinct(team).alias("teams"),
        F.min(rank).alias("low_rank"), F.max(rank).alias("high_rank"),
        F.count_if(F.col(rating).isNull() | ~two_decimals(rating)).alias("bad_precision"),
        F.count_if(F.col(strength).isNotNull() & ~two_decimals(strength)).alias("bad_strength_precision"),
        F.count_if(is_blank(F.col(team).cast("string"))).alias("blank_names"),
        F.count(strength).alias("with_strength"),
        F.count_if(F.col(strength).isNotNull() & F.coalesce(F.col(strength_rank) < 1, F.lit(True))
                   ).alias("bad_strength_rank"))
    checks = {
        "count_ok": F.col("rows").between(low, high),
        "ranks_ok": (F.col("low_rank") == 1) & (F.col("high_rank") == F.col("rows")) & (F.col("ranks") == F.col("rows")),
        "names_ok": (F.col("teams") == F.col("rows")) & (F.col("blank_names") == 0),
        "precision_ok": (F.col("bad_precision") == 0) & (F.col("bad_strength_precision") == 0),
        "strength_ok": (F.col("with_strength") == 0) | (
            (F.col("with_strength") >= min_strength * F.col("rows")) & (F.col("bad_strength_rank") == 0)),
    }
    return base.select(*by, "rows", *[F.coalesce(c, F.lit(False)).alias(n) for n, c in checks.items()])


def range_checks(df: DataFrame, ranges: dict[str, tuple[float, float]], finite: list[str]) -> DataFrame:
    """Rows outside a range and rows with NaN or infinity, per column."""
    counts = [F.count_if(F.col(c).isNotNull() & ~F.col(c).between(lo, hi)).alias(f"{c}_out")
              for c, (lo, hi) in ranges.items()]
    counts += [F.count_if(F.isnan(c) | (F.abs(F.col(c).cast("double")) == float("inf"))).alias(f"{c}_nonfinite")
               for c in finite]
    return df.agg(F.count(F.lit(1)).alias("rows"), *counts)


def gaps(current: DataFrame, baseline: DataFrame, on: list[str], critical: list[str]) -> DataFrame:
    """Baseline keys missing from the current table, and current rows with blank critical fields."""
    missing = skew_join(baseline.select(*on).distinct(), current.select(*on).distinct(), on, "left_anti")
    blanks = F.lit(0)
    for c in critical:
        blanks = blanks + is_blank(c, current.schema[c].dataType.simpleString()).cast("int")
    holes = current.select(*on, blanks.alias("blank_fields")).where("blank_fields > 0")
    return (missing.select(*on, F.lit("missing").alias("gap"), F.lit(len(critical)).alias("blank_fields"))
            .unionByName(holes.select(*on, F.lit("blank").alias("gap"), "blank_fields")))


def join_audit(df: DataFrame, by: list[str], spread: str = "spread", total: str = "total",
               favored: str = "favored_side", edge: str = "rating_vs_odds") -> DataFrame:
    has_spread, has_total = F.col(spread).isNotNull(), F.col(total).isNotNull()
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(has_spread).alias("with_spread"),
        F.count_if(has_total).alias("with_total"), F.count_if(has_spread & has_total).alias("with_both"),
        F.count_if(F.col(favored).isNotNull()).alias("with_favored"),
        F.count_if(F.col(edge).isNotNull()).alias("with_edge"))


def needs_repair(df: DataFrame, by: list[str], spread: str = "spread_favored_team",
                 edge: str = "rating_vs_odds") -> DataFrame:
    """True for a week with any row whose spread and edge are both blank."""
    bad = F.col(spread).isNull() & F.col(edge).isNull()
    return df.groupBy(*by).agg(F.bool_or(bad).alias("needs_repair"))


def content_hash(df: DataFrame, ignore: tuple[str, ...] = ()) -> DataFrame:
    """Row count and order-free hash of the content (decimal sum: it cannot overflow)."""
    cols = sorted(c for c in df.columns if c not in ignore)
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.coalesce(F.sum(F.xxhash64(*cols).cast("decimal(20,0)")), F.lit(0)).alias("hash"))


def content_equal(a: DataFrame, b: DataFrame, ignore: tuple[str, ...] = ()) -> DataFrame:
    """One row telling whether two tables hold the same rows in any order."""
    left = content_hash(a, ignore).select(F.col("rows").alias("left_rows"), F.col("hash").alias("_lh"))
    right = content_hash(b, ignore).select(F.col("rows").alias("right_rows"), F.col("hash").alias("_rh"))
    # Both sides are one aggregate row.
    return left.join(F.broadcast(right), how="cross").select(
        "left_rows", "right_rows",
        ((F.col("left_rows") == F.col("right_rows")) & (F.col("_lh") == F.col("_rh"))).alias("equal"))
