"""Joins of events with per-side dimensions, and key tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .skew import skew_join


def join_both_sides(games: DataFrame, dim: DataFrame, on: list[str], values: list[str], home: str = "home_id",
                    away: str = "away_id", team: str = "team") -> DataFrame:
    """Left join one dimension twice, columns prefixed ``home_`` and ``away_``."""
    out = games
    for prefix, column in (("home_", home), ("away_", away)):
        side = dim.select(*on, F.col(team).alias(column), *[F.col(v).alias(f"{prefix}{v}") for v in values])
        out = skew_join(out, side, [*on, column], "left")
    return out


def semi_both(games: DataFrame, dim: DataFrame, home: str = "home_id", away: str = "away_id",
              team: str = "team") -> DataFrame:
    """Games whose two sides are both in the dimension."""
    keys = dim.select(team).distinct()
    out = skew_join(games, keys.withColumnRenamed(team, home), [home], "left_semi")
    return skew_join(out, keys.withColumnRenamed(team, away), [away], "left_semi")


def missing_in(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Left rows without a partner."""
    return skew_join(left, right.select(*on).distinct(), on, "left_anti")


def duplicate_keys(df: DataFrame, on: list[str]) -> DataFrame:
    return df.groupBy(*on).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def join_one_to_one(left: DataFrame, right: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join that fails, when it runs, if the right side repeats a key.

    The test rides on the join's own aggregation: no extra job and nothing collected.
    """
    others = [c for c in right.columns if c not in on]
    grouped = right.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*others)).alias("_row"))
    checked = grouped.select(*on, F.when(F.col("_n") == 1, F.col("_row")).otherwise(
        F.raise_error(F.lit("duplicate key on the right side of a one-to-one join"))).alias("_row"))
    return left.join(checked, on, how).select(*left.columns, *[f"_row.{c}" for c in others])
