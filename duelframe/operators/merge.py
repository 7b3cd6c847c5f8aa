"""Value-preserving merges, differences and late-score backfill."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.numbers import has_value
from .skew import calendar

# Fields whose old value survives a merge.
ODDS_FIELDS = ["spread_home_relative", "spread_favored_team", "favored_side", "total", "moneyline_home",
               "moneyline_away", "odds_source", "snapshot_at", "is_closing"]
RATING_FIELDS = ["rating_diff", "rating_vs_odds", "rating_diff_favored_team", "rating_vs_odds_favored_team", "hfa"]
RATING_PREFIXES = ("home_pr", "away_pr", "home_sos", "away_sos")
ODDS_SIGNALS = ["spread_home_relative", "spread_favored_team", "total", "moneyline_home", "moneyline_away",
                "favored_side", "odds_source"]


def keeps_old_value(field: str) -> bool:
    return field in ODDS_FIELDS or field in RATING_FIELDS or field.startswith(RATING_PREFIXES)


def _simple(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def _merge_struct(old: Column, new: Column, dtype: T.StructType) -> Column:
    """Field-wise merge of a provenance struct: odds fields keep the old value when the new is blank."""
    fields = []
    for f in dtype.fields:
        if f.name.startswith("odds"):
            fields.append(F.when(has_value(new[f.name], f.dataType.simpleString()), new[f.name])
                          .otherwise(old[f.name]).alias(f.name))
        else:
            fields.append(new[f.name].alias(f.name))
    return F.when(old.isNull(), new).when(new.isNull(), old).otherwise(F.struct(*fields))


def merge_preserving(existing: DataFrame, incoming: DataFrame, key: list[str], keep=keeps_old_value,
                     provenance: str | None = "raw_sources") -> DataFrame:
    """Full outer merge by key, unique on both sides. Odds and rating fields keep a non-blank old
    value, every other field takes the new row's; rows on one side survive unchanged."""
    old, new = existing.alias("o"), incoming.alias("n")
    on = F.lit(True)
    for k in key:
        on = on & (F.col(f"o.{k}") == F.col(f"n.{k}"))
    joined = old.withColumn("_in_old", F.lit(True)).alias("o").join(
        new.withColumn("_in_new", F.lit(True)).alias("n"), on, "full_outer")
    in_old, in_new = F.col("_in_old").isNotNull(), F.col("_in_new").isNotNull()
    columns = [F.coalesce(F.col(f"o.{k}"), F.col(f"n.{k}")).alias(k) for k in key]
    names = [*[c for c in existing.columns if c not in key],
             *[c for c in incoming.columns if c not in key and c not in existing.columns]]
    for name in names:
        if name not in incoming.columns:
            columns.append(F.col(f"o.{name}").alias(name))
        elif name not in existing.columns:
            columns.append(F.col(f"n.{name}").alias(name))
        else:
            o, n = F.col(f"o.{name}"), F.col(f"n.{name}")
            dtype = existing.schema[name].dataType
            if name == provenance and isinstance(dtype, T.StructType):
                value = F.when(in_old & in_new, _merge_struct(o, n, dtype)).when(in_new, n).otherwise(o)
            elif keep(name):
                value = F.when(in_old & (has_value(o, _simple(existing, name)) | ~in_new), o).otherwise(n)
            else:
                value = F.when(in_new, n).otherwise(o)
            columns.append(value.alias(name))
    return joined.select(*columns)


def diff_flags(a: DataFrame, b: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """One row per key of either side with ``status``: left_only, right_only, equal, mismatched."""
    on = F.lit(True)
    for k in key:
        on = on & (F.col(f"a.{k}") == F.col(f"b.{k}"))
    same = F.lit(True)
    for f in fields:
        same = same & F.col(f"a.{f}").eqNullSafe(F.col(f"b.{f}"))
    joined = (a.withColumn("_l", F.lit(True)).alias("a")
              .join(b.withColumn("_r", F.lit(True)).alias("b"), on, "full_outer"))
    status = (F.when(F.col("_r").isNull(), "left_only").when(F.col("_l").isNull(), "right_only")
              .when(same, "equal").otherwise("mismatched"))
    changed = F.filter(F.array(*[F.when(~F.col(f"a.{f}").eqNullSafe(F.col(f"b.{f}")), F.lit(f)) for f in fields]),
                       lambda x: x.isNotNull())
    return joined.select(*[F.coalesce(F.col(f"a.{k}"), F.col(f"b.{k}")).alias(k) for k in key],
                         status.alias("status"), changed.alias("changed"))


def diff_rows(a: DataFrame, b: DataFrame, key: list[str], ignore: tuple[str, ...] = ()) -> DataFrame:
    """Counts per status; fields that change on every run are left out by ``ignore``."""
    fields = [c for c in a.columns if c in b.columns and c not in key and c not in ignore]
    return diff_flags(a, b, key, fields).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def preservation(existing: DataFrame, merged: DataFrame, key: list[str]) -> DataFrame:
    """How many games kept all their old odds signals, and how many their old edge."""
    odds = [f for f in ODDS_SIGNALS if f in existing.columns and f in merged.columns]
    edge = [f for f in ("rating_vs_odds",) if f in existing.columns and f in merged.columns]
    both = existing.alias("o").join(merged.alias("m"), key)

    def kept(fields: list[str]) -> Column:
        seen, same = F.lit(False), F.lit(True)
        for f in fields:
            old = has_value(F.col(f"o.{f}"), _simple(existing, f))
            seen = seen | old
            same = same & (~old | F.col(f"m.{f}").eqNullSafe(F.col(f"o.{f}")))
        return seen & same

    return both.agg(F.count_if(kept(odds)).alias("preserved_odds"), F.count_if(kept(edge)).alias("preserved_rvo"))


def lookback_weeks(games: DataFrame, current: DataFrame, by: list[str], weeks_back: int = 2,
                   week: str = "wk") -> DataFrame:
    """Rows of the ``weeks_back`` weeks before each season's current week."""
    small = current.select(*by, F.col(week).alias("_current"))
    return (games.join(calendar(small), by)
            .where((F.col(week) < F.col("_current")) & (F.col(week) >= F.col("_current") - weeks_back))
            .drop("_current"))


def backfill_scores(games: DataFrame, master: DataFrame, current: DataFrame, by: list[str], key: list[str],
                    weeks_back: int = 2, week: str = "wk", overwrite: bool = False) -> DataFrame:
    """Late finals into the lookback weeks.

    Without ``overwrite`` only games missing a score change, and both scores come from the
    master together. ``score_status`` is kept, updated or skipped (no final known yet).
    """
    finals = (master.where(F.col("home_score").isNotNull() & F.col("away_score").isNotNull())
              .select(*key, F.col("home_score").alias("_h"), F.col("away_score").alias("_a")))
    target = lookback_weeks(games, current, by, weeks_back, week)
    joined = target.join(finals, key, "left")
    missing = F.col("home_score").isNull() | F.col("away_score").isNull()
    known = F.col("_h").isNotNull()
    differs = ~(F.col("home_score").eqNullSafe(F.col("_h")) & F.col("away_score").eqNullSafe(F.col("_a")))
    update = known & ((missing | differs) if overwrite else missing)
    status = F.when(update, "updated").when(missing, "skipped").otherwise("kept")
    rest = [c for c in games.columns if c not in ("home_score", "away_score")]
    return joined.select(*rest, F.when(update, F.col("_h")).otherwise(F.col("home_score")).alias("home_score"),
                         F.when(update, F.col("_a")).otherwise(F.col("away_score")).alias("away_score"),
                         status.alias("score_status"))


def bag_difference(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """Rows that one table has more often than the other: ``only_left`` and ``only_right`` tell how often, as EXCEPT ALL would.

    Both tables go through one count, so a row that is repeated a million times is one row of each task before the shuffle, and no
    join is needed. Nulls are equal to nulls. Equal tables give no rows.
    """
    both = left.select(*columns, F.lit(1).alias("_n")).unionByName(right.select(*columns, F.lit(-1).alias("_n")))
    more = both.groupBy(*columns).agg(F.sum("_n").alias("_n")).where("_n <> 0")
    return more.select(*columns, F.greatest("_n", F.lit(0)).cast("long").alias("only_left"),
                       F.greatest(-F.col("_n"), F.lit(0)).cast("long").alias("only_right"))


def bag_samples(difference: DataFrame, columns: list[str], samples: int = 5) -> DataFrame:
    """Per status (only_left, only_right): rows, repetitions, and the first few rows by value. The limit is the report's."""
    status = F.when(F.col("only_left") > 0, "only_left").otherwise("only_right")
    marked = difference.select(*columns, status.alias("status"), (F.col("only_left") + F.col("only_right")).alias("times"))
    totals = marked.groupBy("status").agg(F.count(F.lit(1)).alias("rows"), F.sum("times").alias("times"))
    # Window group limit keeps a few rows of each status per task before the shuffle.
    first = Window.partitionBy("status").orderBy(*columns)
    shown = marked.withColumn("_rn", F.row_number().over(first)).where(F.col("_rn") <= samples)
    lists = shown.groupBy("status").agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("sample"))
    return totals.join(lists, "status")
