"""Joins of a large, possibly skewed side with a side that is unique on the key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def skew_join(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner",
              spread_by: list[str] | None = None, salts: int = 1) -> DataFrame:
    """Equi-join that keeps a hot key of ``big`` off a single task.

    Adaptive execution looks at the finished shuffle files: it broadcasts the small side if its measured size allows and
    splits a skewed partition of the big one otherwise (``session.tune`` switches that on, also where the split costs
    another shuffle). With ``salts``, the small side is repeated that often and rows of one key are spread over as many
    sub-keys by a hash of ``spread_by``: for a session without adaptive execution.

    ``how``: inner, left, left_semi or left_anti.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"only the big side may be kept whole, not a {how} join")
    if salts == 1:
        return big.join(small, on, how)
    spread_by = spread_by or [c for c in big.columns if c not in on]
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    repeated = small.select("*", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"))
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")


def calendar(df: DataFrame) -> DataFrame:
    """Broadcast a table with one row per season or per week.

    Its size is bounded by the calendar, not by the data. Without the hint such a join could
    leave the big side partitioned by season alone: a handful of tasks.
    """
    return F.broadcast(df)
