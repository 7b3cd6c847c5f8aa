"""Late scores into stored running records, without computing the records again."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .prefix import running_sums
from .ranges import same_keys
from .teams import outcome_flags, to_team_rows


def record_changes(before: DataFrame, after: DataFrame, by: list[str], key: str = "game_id", kickoff: str = "kickoff") -> DataFrame:
    """What each side of a game gains or loses in its records when its scores change: new flags less old ones.

    Both tables hold the games that change, once each; a game that only ``after`` has counts from nothing. Rows without a
    change are left out.
    """
    flags = outcome_flags()
    keep = [key, *by, kickoff]

    def side_rows(games: DataFrame) -> DataFrame:
        return to_team_rows(games, keep).select(*keep, "team", "site", *[c.alias(n) for n, c in flags.items()])

    new, old = side_rows(after).alias("n"), side_rows(before).alias("o")
    joined = new.join(old, same_keys([key, "site"], "n", "o"), "left")
    diff = [(F.col(f"n.{f}") - F.coalesce(F.col(f"o.{f}"), F.lit(0))).alias(f) for f in flags]
    out = joined.select(*[F.col(f"n.{c}") for c in [*keep, "team"]], *diff)
    return out.where(" OR ".join(f"{f} <> 0" for f in flags))


def updated_records(records: DataFrame, changes: DataFrame, by: list[str], key: str = "game_id", kickoff: str = "kickoff") -> DataFrame:
    """The stored rows (``<flag>_before`` of each game and side) whose records change, with their new values.

    A change counts from the games that begin later than its own. Only the seasons of the changes are read (their number is
    bounded by the calendar; a table stored by season skips the others' files), and only teams that have a change.
    Rows without a season have no record to change. The changes and the stored games of a team lie on one time line.
    """
    season = by[-1]
    seasons = sorted(r[0] for r in changes.select(season).where(F.col(season).isNotNull()).distinct().collect())
    flags = list(outcome_flags())
    touched = changes.select(*by, "team").distinct()
    stored = records.where(F.col(season).isin(seasons)).join(touched, [*by, "team"], "left_semi")
    line = stored.select(*by, "team", kickoff, F.struct(*stored.columns).alias("_row"), *[F.lit(0).alias(f) for f in flags]).unionByName(
        changes.select(*by, "team", kickoff, *flags), allowMissingColumns=True)
    timed = line.withColumn("_at", F.unix_micros(F.col(kickoff)))
    moved = running_sums(timed, [*by, "team"], ["_at"], {f"_d_{f}": F.col(f) for f in flags}, "before")
    rows = moved.where("_row IS NOT NULL").where(" OR ".join(f"_d_{f} <> 0" for f in flags))
    new = {f"{f}_before": (F.col(f"_row.{f}_before") + F.col(f"_d_{f}")).alias(f"{f}_before") for f in flags}
    return rows.select(*[new.get(c, F.col(f"_row.{c}").alias(c)) for c in records.columns])


def patched(records: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """The table with its updated rows in place, marked ``changed``."""
    kept = records.join(updates.select(*keys), keys, "left_anti")
    return kept.withColumn("changed", F.lit(False)).unionByName(updates.withColumn("changed", F.lit(True)))
