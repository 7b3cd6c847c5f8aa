"""Running totals and ordinals that never put a whole hot group into one task.

A group (say one team of one season) may hold a third of all rows, on one day or even at one instant. Groups that one task
may sort take a window; the others are dealt by ranges of the order (:mod:`ranges`). The result is exact either way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .ranges import by_size, ranged_sums, same_keys


def running_sums(df: DataFrame, group: list[str], order: list[str], sums: dict[str, Column], mode: str = "through") -> DataFrame:
    """Add running sums per group. Null keys form groups of their own; null values count as 0.

    ``mode="through"``: up to and including the row, in ``order`` (which must be total).
    ``mode="before"``: rows whose ``order`` (one long column) is strictly smaller: rows of the same instant do not see each
    other. Rows without a value in it come first and see nothing.
    """
    if mode not in ("through", "before"):
        raise ValueError(f"unknown mode: {mode}")
    base = df.select("*", *[F.coalesce(c.cast("long"), F.lit(0)).alias(f"_v_{n}") for n, c in sums.items()])
    values = [f"_v_{n}" for n in sums]

    def small(rows: DataFrame) -> DataFrame:
        window = Window.partitionBy(*group).orderBy(*order)
        if mode == "through":
            totals = {n: F.sum(v).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow)) for n, v in zip(sums, values)}
        else:
            # Equal values are peers of a range frame: all up to the instant, less the instant's own.
            same = window.rangeBetween(Window.currentRow, Window.currentRow)
            totals = {n: F.sum(v).over(window.rangeBetween(Window.unboundedPreceding, Window.currentRow)) - F.sum(v).over(same)
                      for n, v in zip(sums, values)}
        return rows.select(*df.columns, *[c.alias(n) for n, c in totals.items()])

    def large(rows: DataFrame) -> DataFrame:
        if mode == "through":
            out = ranged_sums(rows, group, [F.asc(c) for c in order], values)
            return out.select(*df.columns, *[F.col(v).alias(n) for n, v in zip(sums, values)])
        # One row for each instant is summed before the shuffle; a hot instant meets its row in a join that splits it.
        own = [f"_o_{n}" for n in sums]
        instants = rows.groupBy(*group, order[0]).agg(*[F.sum(v).alias(v) for v in values])
        instants = instants.select("*", *[F.col(v).alias(o) for v, o in zip(values, own)])
        upto = ranged_sums(instants, group, [F.asc(order[0])], values)
        joined = rows.alias("d").join(upto.alias("u"), same_keys([*group, order[0]], "d", "u"))
        return joined.select(*[F.col(f"d.{c}") for c in df.columns],
                             *[(F.col(f"u.{v}") - F.col(f"u.{o}")).alias(n) for n, v, o in zip(sums, values, own)])

    return by_size(base, group, small, large)


def row_numbers(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """Ordinal 1..N per group in ``order``, which must be total."""
    return running_sums(df, group, order, {name: F.lit(1)}, "through")
