"""The wide event view and the two-row week view."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import lines
from ..operators import quotes, ranks, teams
from ..operators.prefix import running_sums
from ..operators.skew import skew_join

METRIC_RANKS = {"ry_pg": True, "py_pg": True, "ty_pg": True, "ry_allowed_pg": False, "py_allowed_pg": False,
                "ty_allowed_pg": False}
METRICS = ["gp", "pf_pg", "pa_pg", "ry_pg", "py_pg", "ty_pg", "ry_allowed_pg", "py_allowed_pg", "ty_allowed_pg",
           "to_margin_pg"]
RATING_COLUMNS = ("pr", "pr_rank", "sos", "sos_rank")


STATS = ["rush", "pass", "turnovers", "opp_rush", "opp_pass", "opp_turnovers", "pf", "pa"]


def means(prefix: str = "") -> dict[str, F.Column]:
    """Per-game means of season-to-date totals."""
    def total(name: str) -> F.Column:
        return F.col(f"{prefix}{name}")

    sums = {"pf_pg": total("pf"), "pa_pg": total("pa"), "ry_pg": total("rush"), "py_pg": total("pass"),
            "ty_pg": total("rush") + total("pass"), "ry_allowed_pg": total("opp_rush"), "py_allowed_pg": total("opp_pass"),
            "ty_allowed_pg": total("opp_rush") + total("opp_pass"), "to_margin_pg": total("opp_turnovers") - total("turnovers")}
    return {n: F.try_divide(c, total("gp")) for n, c in sums.items()}


def league_totals(team_rows: DataFrame, by: list[str], week: str = "wk", league: F.Column | None = None) -> DataFrame:
    """Totals over earlier weeks with their means and league ranks, for every week of every season; ``_played`` marks the
    weeks in which the team has rows."""
    weekly = teams.weekly_totals(team_rows, {s: F.col(s) for s in STATS}, by, week)
    totals = teams.to_date(weekly, ["gp", *STATS], by, week, played="_played")
    if league is not None:
        totals = totals.withColumn("league", league)
    pool = [*by, week] if league is None else ["league", *by, week]
    return ranks.dense_rank_league(totals, pool, METRIC_RANKS, derived=means(), store=False)


def league_metrics(team_rows: DataFrame, by: list[str], week: str = "wk", league: F.Column | None = None) -> DataFrame:
    """Per-game means over earlier weeks with league ranks, for every week of every season.

    ``team_rows`` carries rush, pass and turnovers of both sides next to the points. ``league``
    tells a team's league, so that a rank window is only as long as one league has teams.
    """
    return league_totals(team_rows, by, week, league).select(
        *by, "team", week, "gp", F.col("pf").alias("pf_total"), F.col("pa").alias("pa_total"), *means(),
        *([] if league is None else ["league"]), *[f"{m}_rank" for m in METRIC_RANKS])


def side_rows(team_rows: DataFrame, ratings: DataFrame, by: list[str], week: str = "wk", key: str = "game_id",
              league: F.Column | None = None) -> DataFrame:
    """One row per game and side: records before kickoff, week totals with ranks, and week ratings.

    Records count regular games only (a missing type is regular). Totals and ratings are
    joined once, on the team-week, for both sides together; totals of weeks without a game stay behind.
    """
    flags = teams.outcome_flags()
    if "game_type" in team_rows.columns:
        regular = F.coalesce(F.col("game_type") == "REG", F.lit(True))
        flags = {n: F.when(regular, c).otherwise(0) for n, c in flags.items()}
    timed = team_rows.select(key, "site", *by, week, "team", "kickoff", F.unix_micros("kickoff").alias("_at"),
                             *[c.alias(f"_{n}") for n, c in flags.items()])
    before = running_sums(timed, [*by, "team"], ["_at"],
                          {n: F.col(f"_{n}") for n in flags}, "before")
    rows = before.select(key, "site", *by, week, "team",
                         lines.format_record("w", "l", "t", "su").alias("su"),
                         lines.format_record("ats_w", "ats_l", "ats_p", "ats").alias("ats"))
    metrics = league_totals(team_rows, by, week, league).where("_played").select(
        *by, week, "team", "gp", *STATS, *[f"{m}_rank" for m in METRIC_RANKS])
    rating_cols = [c for c in RATING_COLUMNS if c in ratings.columns]
    rows = skew_join(rows, metrics, [*by, week, "team"], "left")
    return skew_join(rows, ratings.select(*by, week, "team", *rating_cols), [*by, week, "team"], "left")


def game_view(games: DataFrame, team_rows: DataFrame, pinned: DataFrame, ratings: DataFrame, by: list[str],
              week: str = "wk", key: str = "game_id", hfa: float = 0.0, ties: list[str] | None = None,
              policy: str = "latest", league: F.Column | None = None) -> DataFrame:
    """One wide row per game: schedule, promoted lines, ratings, season-to-date metrics, records.

    Edges are computed after promotion. ``ratings`` has pr, pr_rank, sos, sos_rank per week.
    Sides and lines both arrive grouped by the game key, so the last joins need no more shuffles.
    """
    sides = side_rows(team_rows, ratings, by, week, key, league)
    columns = [c for c in sides.columns if c not in (key, "site", *by, week, "team")]
    packed = F.struct(*columns)
    # The rows meet before they are grouped: structs are grouped by sorting, which would be done on both ends of the shuffle.
    nested = sides.repartition(key).groupBy(key).agg(
        F.any_value(F.when(F.col("site") == "H", packed), True).alias("_h"),
        F.any_value(F.when(F.col("site") == "A", packed), True).alias("_a"))
    plain = [c for c in columns if c not in STATS]
    flat = nested.select(key, *[c for s in ("home", "away") for c in (
        *[F.col(f"_{s[0]}.{c}").alias(f"{s}_{c}") for c in plain], *[c.alias(f"{s}_{n}") for n, c in means(f"_{s[0]}.").items()])])
    promoted = quotes.promote_lines(games, pinned, key, policy=policy, ties=ties)
    out = games.join(promoted.drop("provenance", "used_records", "markets"), key, "left").join(flat, key, "left")
    if "spread" in games.columns:
        # The schedule's own line stands where nothing was promoted.
        out = out.withColumns({
            "odds_source": F.coalesce("odds_source", F.when(F.col("spread").isNotNull(), "schedule")),
            "spread_home_relative": F.coalesce("spread_home_relative", "spread")})
    out = out.withColumn("hfa", F.lit(float(hfa)))
    return out.withColumns(lines.edge_columns("home_pr", "away_pr", "hfa", "spread_home_relative", use_hfa=True))


def provenance(view: DataFrame) -> DataFrame:
    """Game view with its sources nested in one struct."""
    def side(prefix: str) -> F.Column:
        return F.struct(*[F.col(f"{prefix}_{c}").alias(c) for c in ("pr", "pr_rank", "sos", "sos_rank")
                          if f"{prefix}_{c}" in view.columns])

    return view.withColumn("raw_sources", F.struct(
        F.struct("game_id", "season", "wk", "home_id", "away_id").alias("schedule_row"),
        F.struct("odds_source", "snapshot_at", "spread_home_relative", "total").alias("odds_row"),
        side("home").alias("rating_row_home"), side("away").alias("rating_row_away")))


def week_view(view: DataFrame, keep: list[str]) -> DataFrame:
    """Two rows per game, away first: line, total, record, rating, edge and strength surplus."""
    def row(own: str, other: str, place: int) -> F.Column:
        label = own.upper()
        favored = F.col("favored_side") == label
        return F.struct(
            F.lit(place).alias("line_no"), F.lit(label).alias("side"), F.col(f"{own}_id").alias("team"),
            F.col(f"{other}_id").alias("opp"), lines.side_view("spread_home_relative", F.lit(label)).alias("line"),
            F.col("total").alias("total"), F.col(f"{own}_su").alias("su"), F.col(f"{own}_ats").alias("ats"),
            F.col(f"{own}_pr").alias("pr"),
            F.when(favored, F.col("rating_diff_favored_team")).alias("rating_diff"),
            F.when(favored, F.col("rating_vs_odds_favored_team")).alias("rating_vs_odds"),
            lines.sos_diff(F.col(f"{own}_sos"), F.col(f"{other}_sos")).alias("sos_diff"))

    return (view.select(*keep, F.explode(F.array(row("away", "home", 1), row("home", "away", 2))).alias("_r"))
            .select(*keep, "_r.*"))
