"""Team rows, season-to-date metrics, records, ranks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import joins, ranks, teams
from ..plans import adapters as A, game_view as G
from ..session import written
from .registry import query
from .scalar import text_of

BY = ["season"]


def team_rows(spark, sf) -> DataFrame:
    return teams.to_team_rows(A.with_stats(A.games(spark, sf)), ["game_id", "season", "wk", "kickoff", "game_type"],
                              stats=A.STATS)


def rated(spark, sf) -> DataFrame:
    """Ratings with ordinal ranks over all teams of a snapshot; written, since views join it to both sides."""
    return written(ranks.ordinal_ranks(A.ratings(spark, sf), ["season", "wk"], {"pr": True, "sos": True}, "team"), "rated")


def page_rated(spark, sf) -> DataFrame:
    """Ratings with ordinal ranks among the teams of one rating page."""
    r = A.ratings(spark, sf).withColumn("league", A.league_of())
    return ranks.ordinal_ranks(r, ["league", "season", "wk"], {"pr": True, "sos": True}, "team").drop("league")


@query("team_rows", "SELECT game_id, season, wk, team, opp, site, pf, pa, margin, line, rush, opp_rush, turnovers FROM team_rows",
       ["team_rows"])
def q_team_rows(spark, sf):
    return team_rows(spark, sf).select("game_id", "season", "wk", "team", "opp", "site", "pf", "pa", "margin", "line",
                                       "rush", "opp_rush", "turnovers")


@query("su_ats_records", """
    SELECT season, team, count(pf) AS gp, CAST(coalesce(sum(pf), 0) AS BIGINT) AS pf_total,
           CAST(coalesce(sum(pa), 0) AS BIGINT) AS pa_total, CAST(sum(w) AS BIGINT) AS w, CAST(sum(l) AS BIGINT) AS l,
           CAST(sum(t) AS BIGINT) AS t, CAST(sum(ats_w) AS BIGINT) AS ats_w, CAST(sum(ats_l) AS BIGINT) AS ats_l,
           CAST(sum(ats_p) AS BIGINT) AS ats_p FROM flags GROUP BY season, team""", ["flags"])
def su_ats_records(spark, sf):
    return teams.season_records(team_rows(spark, sf), ["season", "team"])


@query("season_to_date", """
    SELECT season, team, wk, gp, rush, pass, turnovers, CAST(rush AS DOUBLE) / nullif(gp, 0) AS rush_pg,
           CAST(pass AS DOUBLE) / nullif(gp, 0) AS pass_pg, CAST(turnovers AS DOUBLE) / nullif(gp, 0) AS turnovers_pg
    FROM to_date""", ["to_date"])
def season_to_date(spark, sf):
    return teams.season_to_date(team_rows(spark, sf), ["rush", "pass", "turnovers"], BY)


@query("season_to_date_first_kickoff", """
    , starts AS (SELECT season, wk, min(kickoff) AS first_kickoff FROM games GROUP BY season, wk)
    SELECT t.season, t.team, s.wk, count(x.game_id) AS gp, CAST(coalesce(sum(x.rush), 0) AS BIGINT) AS rush,
           CAST(coalesce(sum(x.rush), 0) AS DOUBLE) / nullif(count(x.game_id), 0) AS rush_pg
    FROM (SELECT DISTINCT season, team FROM team_rows) t JOIN starts s USING (season)
    LEFT JOIN team_rows x ON x.season = t.season AND x.team = t.team AND x.kickoff < s.first_kickoff
    GROUP BY t.season, t.team, s.wk""", ["games", "team_rows"])
def season_to_date_first_kickoff(spark, sf):
    return teams.season_to_date_first_kickoff(team_rows(spark, sf), A.games(spark, sf), ["rush"], BY)


@query("dense_ranks", """
    SELECT season, team, wk, gp, ry_pg, ty_pg, ry_allowed_pg, to_margin_pg, ry_pg_rank, py_pg_rank, ty_pg_rank,
           ry_allowed_pg_rank, py_allowed_pg_rank, ty_allowed_pg_rank FROM ranked""", ["ranked"])
def dense_ranks(spark, sf):
    return G.league_metrics(team_rows(spark, sf), BY).select(
        "season", "team", "wk", "gp", "ry_pg", "ty_pg", "ry_allowed_pg", "to_margin_pg", "ry_pg_rank", "py_pg_rank",
        "ty_pg_rank", "ry_allowed_pg_rank", "py_allowed_pg_rank", "ty_allowed_pg_rank")


@query("opponent_mirror", """
    , pairs AS (SELECT season, wk, team, opp, sum(rush) AS rush, sum(pass) AS pass FROM team_rows GROUP BY ALL)
    SELECT a.season, a.wk, a.team, a.opp, CAST(a.rush AS BIGINT) AS rush, CAST(b.rush AS BIGINT) AS rush_allowed,
           CAST(b.pass AS BIGINT) AS pass_allowed
    FROM pairs a LEFT JOIN pairs b ON b.season = a.season AND b.wk = a.wk AND b.team = a.opp AND b.opp = a.team""",
       ["team_rows"])
def opponent_mirror(spark, sf):
    # One row per (week, team, opponent): the self-join is one to one.
    pairs = team_rows(spark, sf).groupBy("season", "wk", "team", "opp").agg(F.sum("rush").alias("rush"), F.sum("pass").alias("pass"))
    return teams.opponent_mirror(pairs, ["season", "wk"], ["rush", "pass"]).drop("pass")


@query("running_record", """
    SELECT game_id, team, CAST(sum(w) OVER p AS BIGINT) AS run_w, CAST(sum(l) OVER p AS BIGINT) AS run_l,
           CAST(sum(t) OVER p AS BIGINT) AS run_t
    FROM flags WHERE pf IS NOT NULL AND pa IS NOT NULL
    WINDOW p AS (PARTITION BY season, team ORDER BY kickoff, game_id ROWS UNBOUNDED PRECEDING)""", ["flags"])
def running_record(spark, sf):
    return teams.running_record(team_rows(spark, sf), BY).select("game_id", "team", "run_w", "run_l", "run_t")


@query("record_before", "SELECT * FROM before", ["before"])
def record_before(spark, sf):
    return teams.record_before(team_rows(spark, sf), BY).select(
        "game_id", "team", "w_before", "l_before", "t_before", "ats_w_before", "ats_l_before", "ats_p_before")


FAVORITE_TALLY = """
    tally AS (
        SELECT season, wk, team, sum(CASE WHEN c > 0 THEN 1 ELSE 0 END) AS w, sum(CASE WHEN c < 0 THEN 1 ELSE 0 END) AS l,
               sum(CASE WHEN c = 0 THEN 1 ELSE 0 END) AS p
        FROM (SELECT season, wk, team, margin + line AS c FROM team_rows WHERE margin IS NOT NULL AND line IS NOT NULL)
        GROUP BY season, wk, team),
    tally_before AS MATERIALIZED (
        SELECT t.season, t.team, CAST(k.wk AS INTEGER) AS wk, CAST(coalesce(sum(x.w) OVER p, 0) AS BIGINT) AS w,
               CAST(coalesce(sum(x.l) OVER p, 0) AS BIGINT) AS l, CAST(coalesce(sum(x.p) OVER p, 0) AS BIGINT) AS p
        FROM (SELECT DISTINCT season, team FROM tally) t JOIN season_weeks s USING (season),
             unnest(range(1, s.last_wk + 1)) AS k(wk)
        LEFT JOIN tally x ON x.season = t.season AND x.team = t.team AND x.wk = k.wk
        WINDOW p AS (PARTITION BY t.season, t.team ORDER BY k.wk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


def favored(spark, sf) -> DataFrame:
    from ..functions import lines

    return A.games(spark, sf).withColumns({"favored_side": lines.favored_side("spread"),
                                           "spread_favored_team": lines.favored_spread("spread")})


@query("favorite_ats", f", {FAVORITE_TALLY} SELECT * FROM tally_before", ["team_rows", "season_weeks"])
def favorite_ats(spark, sf):
    return teams.favorite_ats(favored(spark, sf), BY)


@query("apply_records", f"""
    , {FAVORITE_TALLY}
    SELECT g.game_id, CASE WHEN h.w + h.l + h.p > 0 THEN h.w||'-'||h.l||'-'||h.p END AS home_ats,
           CASE WHEN a.w + a.l + a.p > 0 THEN a.w||'-'||a.l||'-'||a.p END AS away_ats,
           CASE WHEN h.w + h.l + h.p > 0 THEN h.w END AS home_ats_w, CASE WHEN a.w + a.l + a.p > 0 THEN a.p END AS away_ats_p,
           ('0-0-0' IS DISTINCT FROM CASE WHEN h.w + h.l + h.p > 0 THEN h.w||'-'||h.l||'-'||h.p END)
           OR (NULL IS DISTINCT FROM CASE WHEN a.w + a.l + a.p > 0 THEN a.w||'-'||a.l||'-'||a.p END) AS ats_changed
    FROM games g LEFT JOIN tally_before h ON h.season = g.season AND h.wk = g.wk AND h.team = g.home_id
    LEFT JOIN tally_before a ON a.season = g.season AND a.wk = g.wk AND a.team = g.away_id""",
       ["games", "team_rows", "season_weeks"])
def apply_records(spark, sf):
    g = favored(spark, sf)
    tallies = teams.favorite_ats(g, BY)
    old = g.withColumns({"home_ats": F.lit("0-0-0"), "away_ats": F.lit(None).cast("string")})
    return teams.apply_records(old, tallies, BY).select("game_id", "home_ats", "away_ats", "home_ats_w", "away_ats_p",
                                                        "ats_changed")


@query("roster_agg", """
    SELECT r.team, coalesce(x.gp, 0) AS gp, CAST(coalesce(x.rush, 0) AS BIGINT) AS rush,
           CAST(coalesce(x.opp_pass, 0) AS BIGINT) AS opp_pass, CAST(coalesce(x.w, 0) AS BIGINT) AS w,
           CAST(x.rush AS DOUBLE) / x.gp AS rush_pg, CAST(x.opp_turnovers AS DOUBLE) / x.gp AS opp_turnovers_pg,
           CAST(x.pf AS DOUBLE) / x.gp AS pf_pg
    FROM roster r LEFT JOIN (SELECT team, count(*) AS gp, sum(rush) AS rush, sum(opp_pass) AS opp_pass,
        sum(opp_turnovers) AS opp_turnovers, coalesce(sum(pf), 0) AS pf, sum(w) AS w FROM flags GROUP BY team) x ON x.team = r.team""",
       ["roster", "flags"])
def roster_agg(spark, sf):
    out = teams.roster_totals(team_rows(spark, sf), A.roster(spark, sf), ["rush", "pass", "turnovers"])
    return out.select("team", "gp", "rush", "opp_pass", "w", "rush_pg", "opp_turnovers_pg", "pf_pg")


@query("final_season", """
    , m AS (SELECT season, team, count(*) AS stat_games, CAST(sum(rush) AS DOUBLE) / count(*) AS ry_pg,
                   CAST(sum(opp_rush) AS DOUBLE) / count(*) AS ry_allowed_pg FROM team_rows GROUP BY season, team),
    r AS (SELECT season, team, CAST(sum(pf) AS BIGINT) AS pf_total, CAST(sum(w) AS BIGINT) AS w, CAST(sum(l) AS BIGINT) AS l, CAST(sum(t) AS BIGINT) AS t
          FROM flags WHERE pf IS NOT NULL AND (game_type = 'REG' OR game_type IS NULL) GROUP BY season, team)
    SELECT season, team, stat_games, ry_pg, ry_allowed_pg, pf_total, w, l, t,
           CASE WHEN ry_pg IS NOT NULL THEN CAST(dense_rank() OVER (PARTITION BY season ORDER BY ry_pg DESC NULLS LAST) AS INTEGER) END AS ry_pg_rank,
           CASE WHEN ry_allowed_pg IS NOT NULL THEN CAST(dense_rank() OVER (PARTITION BY season ORDER BY ry_allowed_pg ASC NULLS LAST) AS INTEGER) END AS ry_allowed_pg_rank
    FROM m FULL JOIN r USING (season, team)""", ["team_rows", "flags"])
def final_season(spark, sf):
    rows = team_rows(spark, sf)
    metrics = rows.groupBy("season", "team").agg(
        F.count(F.lit(1)).alias("stat_games"), F.avg("rush").alias("ry_pg"), F.avg("opp_rush").alias("ry_allowed_pg"))
    records = teams.season_records(rows.where("pf IS NOT NULL AND (game_type = 'REG' OR game_type IS NULL)"),
                                   ["season", "team"]).select("season", "team", "pf_total", "w", "l", "t")
    out = teams.final_season(metrics, records, BY)
    return ranks.dense_rank_league(out, BY, {"ry_pg": True, "ry_allowed_pg": False})


@query("distinct_teams", """
    SELECT season, count(DISTINCT team) AS teams, count(DISTINCT opp) AS opponents FROM team_rows GROUP BY season""", ["team_rows"])
def distinct_teams(spark, sf):
    return team_rows(spark, sf).groupBy("season").agg(F.countDistinct("team").alias("teams"),
                                                      F.countDistinct("opp").alias("opponents"))


@query("bounds", """
    SELECT season, strftime(min(kickoff), '%Y-%m-%d %H:%M:%S') AS first_kickoff, strftime(max(kickoff), '%Y-%m-%d %H:%M:%S') AS last_kickoff,
           arg_min(game_id, (kickoff, game_id)) AS first_game, arg_min(spread, (kickoff, game_id)) FILTER (WHERE spread IS NOT NULL) AS first_line,
           season = (SELECT max(season) FROM games) AS newest
    FROM games GROUP BY season""", ["games"])
def bounds(spark, sf):
    g = A.games(spark, sf)
    order = F.struct("kickoff", "game_id")
    newest = g.agg(F.max("season").alias("_newest"))
    per = g.groupBy("season").agg(
        text_of(F.min("kickoff")).alias("first_kickoff"), text_of(F.max("kickoff")).alias("last_kickoff"),
        F.min_by("game_id", order).alias("first_game"),
        F.min_by("spread", F.when(F.col("spread").isNotNull(), order)).alias("first_line"))
    # One row against one row per season.
    return per.join(F.broadcast(newest), how="cross").select(*per.columns, (F.col("season") == F.col("_newest")).alias("newest"))


@query("ordinal_rank", "SELECT season, wk, team, pr, sos, pr_rank, sos_rank FROM rated", ["rated"])
def ordinal_rank(spark, sf):
    return rated(spark, sf)


@query("contiguous_rank", """
    SELECT season, wk, team, pr_rank, CAST(row_number() OVER (PARTITION BY season, wk ORDER BY pr_rank, team) AS INTEGER) AS class_rank
    FROM rated WHERE team % 3 = 0""", ["rated"])
def contiguous_rank(spark, sf):
    # A third of the teams is the top class.
    klass = F.when(F.col("team") % 3 == 0, "A").otherwise("AA")
    r = rated(spark, sf).withColumn("class", klass)
    return ranks.contiguous_rank(r, ["season", "wk"], F.col("class") == "A", "pr_rank", "team", "class_rank").select(
        "season", "wk", "team", "pr_rank", "class_rank")


@query("game_numbers", """
    SELECT game_id, ordinal, wk || lpad(CAST(ordinal AS VARCHAR), CAST(greatest(2, len(CAST(ordinal AS VARCHAR))) AS INTEGER), '0') AS game_number
    FROM (SELECT *, row_number() OVER (PARTITION BY season, wk ORDER BY kickoff, game_id) AS ordinal FROM games)""", ["games"])
def game_numbers(spark, sf):
    return ranks.game_numbers(A.games(spark, sf), BY).select("game_id", "ordinal", "game_number")


@query("team_numbers", """
    SELECT n_nationkey, s_name, row_number() OVER (PARTITION BY n_nationkey ORDER BY s_name) AS team_number
    FROM (SELECT DISTINCT n_nationkey, s_name FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE s_name IS NOT NULL)""")
def team_numbers(spark, sf):
    s = A.table(spark, sf, "supplier").select(F.col("s_nationkey").alias("n_nationkey"), "s_name")
    return ranks.team_numbers(s, "s_name", ["n_nationkey"])


@query("trailing_form", """
    , form AS (SELECT season, team, wk, pr, avg(pr) OVER (PARTITION BY season, team ORDER BY wk ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS pr_last5,
                      pr - lag(pr) OVER (PARTITION BY season, team ORDER BY wk) AS pr_trend FROM ratings)
    SELECT f.*, p.pr_last_year FROM form f
    LEFT JOIN (SELECT season + 1 AS season, team, arg_max(pr, wk) AS pr_last_year FROM ratings GROUP BY season, team) p
      ON p.season = f.season AND p.team = f.team""", ["ratings"])
def trailing_form(spark, sf):
    return teams.trailing_form(A.ratings(spark, sf).drop("sos"), BY)


@query("game_view_join", """
    SELECT g.game_id, h.pr AS home_pr, h.pr_rank AS home_pr_rank, a.pr AS away_pr, a.sos_rank AS away_sos_rank
    FROM games g LEFT JOIN rated h ON h.season = g.season AND h.wk = g.wk AND h.team = g.home_id
    LEFT JOIN rated a ON a.season = g.season AND a.wk = g.wk AND a.team = g.away_id""", ["games", "rated"])
def game_view_join(spark, sf):
    out = joins.join_both_sides(A.games(spark, sf), rated(spark, sf), ["season", "wk"], ["pr", "pr_rank", "sos_rank"])
    return out.select("game_id", "home_pr", "home_pr_rank", "away_pr", "away_sos_rank")


@query("semi_both", """
    SELECT game_id, home_id, away_id FROM games
    WHERE home_id IN (SELECT team FROM roster) AND away_id IN (SELECT team FROM roster)""", ["games", "roster"])
def semi_both(spark, sf):
    return joins.semi_both(A.games(spark, sf), A.roster(spark, sf)).select("game_id", "home_id", "away_id")


@query("missing_games", "SELECT game_id, season, wk FROM games WHERE game_id NOT IN (SELECT game_id FROM odds)", ["games", "odds"])
def missing_games(spark, sf):
    return joins.missing_in(A.games(spark, sf).select("game_id", "season", "wk"), A.odds(spark, sf), ["game_id"])


@query("one_to_one", """
    SELECT c_custkey, c_nationkey, n_name, n_regionkey FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey""")
def one_to_one(spark, sf):
    n = A.table(spark, sf, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    return joins.join_one_to_one(A.table(spark, sf, "customer").select("c_custkey", "c_nationkey"), n, ["c_nationkey"])
