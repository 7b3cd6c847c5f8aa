"""Distinct counts of any span from stored sketches.

One HyperLogLog sketch per part (say season and week) and column is stored; the sketches of a span are merged, so a count
over any weeks reads a few kilobytes per week instead of the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: 2^14 registers: about 0.8 % standard error, at most 16 KB a sketch.
REGISTERS = 14


def distinct_sketches(df: DataFrame, by: list[str], columns: list[str], registers: int = REGISTERS) -> DataFrame:
    """One row per part with ``<column>_sketch`` of each column, as bytes to be stored. Nulls are not counted."""
    return df.groupBy(*by).agg(*[
        F.hll_sketch_agg(F.col(c).cast("string"), F.lit(registers)).alias(f"{c}_sketch") for c in columns])


def merge_sketches(sketches: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """Stored sketches merged by ``by``; sketches of later data merge with those of earlier data."""
    return sketches.groupBy(*by).agg(*[F.hll_union_agg(f"{c}_sketch").alias(f"{c}_sketch") for c in columns])


def span_distinct(sketches: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """Estimated number of distinct values of each column over all parts of a span."""
    merged = merge_sketches(sketches, by, columns)
    return merged.select(*by, *[F.hll_sketch_estimate(f"{c}_sketch").alias(f"{c}_distinct") for c in columns])
