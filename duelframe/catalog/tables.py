"""Stored tables: sketches, weeks rewritten only where they change, files in order."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numbers import round_to
from ..operators import sketches
from ..plans import adapters as A
from ..session import scratch_dir, written
from ..sources import weekly
from .registry import query
from .teams import team_rows


@query("distinct_sketches", """
    SELECT season, span, count(DISTINCT team) AS teams, count(DISTINCT game_id) AS games, true AS teams_close, true AS games_close
    FROM (SELECT season, team, game_id, 'first_half' AS span FROM team_rows WHERE wk <= 26
          UNION ALL SELECT season, team, game_id, 'season' FROM team_rows) GROUP BY season, span""", ["team_rows"])
def distinct_sketches(spark, sf):
    """Stored sketches of each week merged for two spans, within 3 % of the exact counts beside them."""
    rows = team_rows(spark, sf).select("season", "wk", "team", "game_id")
    columns = ["team", "game_id"]
    stored = written(sketches.distinct_sketches(rows, ["season", "wk"], columns), "sketches")

    def spans(df):
        parts = F.array(F.lit("season"), F.when(F.col("wk") <= 26, "first_half"))
        return df.select("*", F.explode(parts).alias("span")).where("span IS NOT NULL")

    found = sketches.span_distinct(spans(stored), ["season", "span"], columns)
    exact = spans(rows).groupBy("season", "span").agg(
        F.countDistinct("team").alias("teams"), F.countDistinct("game_id").alias("games"))
    out = exact.join(found, ["season", "span"], "left")

    def close(estimate: str, count: str):
        return F.coalesce(F.abs(F.col(estimate) - F.col(count)) <= 0.03 * F.col(count), F.lit(False))

    return out.select("season", "span", "teams", "games", close("team_distinct", "teams").alias("teams_close"),
                      close("game_id_distinct", "games").alias("games_close"))


@query("changed_weeks", """
    SELECT season, wk, CASE WHEN wk = 5 AND season = 1998 THEN 'gone' WHEN wk = 3 THEN 'changed' ELSE 'unchanged' END AS status,
           count(*) AS games, CAST(sum(home_id) AS BIGINT) + CASE WHEN wk = 3 THEN count(*) ELSE 0 END AS home_sum
    FROM games GROUP BY season, wk""", ["games"])
def changed_weeks(spark, sf):
    """The second run finds one week number changed and one week absent; the rows are read back from the files."""
    path, marks = scratch_dir(spark, "weeks"), scratch_dir(spark, "week_marks")
    g = A.games(spark, sf).select("game_id", "season", "wk", "kickoff", "home_id", "away_id")
    weekly.write_changed_weeks(g, path, marks)
    later = g.where("NOT (wk = 5 AND season = 1998)").withColumn("home_id", F.col("home_id") + F.when(F.col("wk") == 3, 1).otherwise(0))
    status = weekly.write_changed_weeks(later, path, marks).select("season", "wk", "status")
    stored = spark.read.parquet(path).groupBy("season", "wk").agg(F.count(F.lit(1)).alias("games"), F.sum("home_id").alias("home_sum"))
    return stored.join(status, ["season", "wk"], "left")


@query("sorted_output", """
    SELECT game_id, row_number() OVER (ORDER BY season, wk, kickoff, game_id) AS ordinal, round(spread * 0.37, 1) AS spread_rounded
    FROM games""", ["games"])
def sorted_output(spark, sf):
    """Places of the games as their files tell them."""
    path = scratch_dir(spark, "sorted")
    weekly.write_sorted(A.games(spark, sf).select("game_id", "season", "wk", "kickoff", "spread"), path, ["season", "wk", "kickoff", "game_id"])
    return weekly.read_sorted(spark, path).select("game_id", "ordinal", round_to(F.col("spread") * 0.37, 1).alias("spread_rounded"))
