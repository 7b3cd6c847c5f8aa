"""Event-shaped views over the driver's star-schema tables.

Sides are blocks of eight customers plus neighbours, so the number of teams grows with the
data and a team plays about 23 games a season at any scale. Measures are integers, or
integers divided by two, so sums do not depend on order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..session import tune

HFA = 2.5
# Teams of one rating page at most.
PAGE_TEAMS = 64


# Schemas already read, so that a plan with many scans does not open the footers again.
_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    reader = tune(spark).read
    if path not in _SCHEMAS:
        _SCHEMAS[path] = reader.parquet(path).schema
    df = reader.schema(_SCHEMAS[path]).parquet(path)
    return utc_columns(df)


def utc_columns(df: DataFrame) -> DataFrame:
    """Driver timestamps have no zone; everything here is UTC."""
    return df.select(*[F.col(f"`{f.name}`").cast("timestamp").alias(f.name)
                       if f.dataType.simpleString() == "timestamp_ntz" else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


def week_of_year(ts: Column) -> Column:
    return (F.floor((F.dayofyear(ts) - 1) / 7) + 1).cast("int")


def league_of(team: str = "team") -> Column:
    return F.floor(F.col(team) / PAGE_TEAMS)


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    return games_columns(table(spark, sf_dir, "orders"))


def games_columns(o: DataFrame) -> DataFrame:
    """Games from orders, as a batch or a stream."""
    low = F.floor(F.col("o_custkey") / 8)
    high = low + 1 + F.col("o_orderkey") % 31
    flip = F.col("o_orderkey") % 2 == 1
    unplayed = F.col("o_orderstatus") == "O"
    price = F.floor(F.col("o_totalprice")).cast("long")
    kickoff = F.col("o_orderdate") + F.make_dt_interval(hours=(F.col("o_orderkey") % 3 * 4).cast("int"))
    return o.select(
        F.col("o_orderkey").alias("game_id"), F.year("o_orderdate").alias("season"),
        week_of_year(F.col("o_orderdate")).alias("wk"), kickoff.alias("kickoff"),
        F.when(flip, high).otherwise(low).alias("home_id"), F.when(flip, low).otherwise(high).alias("away_id"),
        F.when(~unplayed, (price % 43).cast("int")).alias("home_score"),
        F.when(~unplayed, (F.floor(F.col("o_totalprice") / 43.0).cast("long") % 43).cast("int")).alias("away_score"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED",
               ((F.col("o_orderkey") * 7) % 29 - 14) / 2.0).alias("spread"),
        (F.col("o_orderkey") % 11 == 0).alias("neutral"),
        F.when(F.col("o_orderkey") % 17 != 0, F.when(F.col("o_orderkey") % 19 != 0, "REG")).otherwise("POST"
                                                                                               ).alias("game_type"))


def with_stats(g: DataFrame) -> DataFrame:
    """Games plus yardage and turnovers of both sides."""
    k = F.col("game_id")
    return g.select(
        "*", ((k * 13) % 200).alias("home_rush"), ((k * 29) % 200).alias("away_rush"),
        ((k * 17) % 350).alias("home_pass"), ((k * 31) % 350).alias("away_pass"),
        (k % 4).alias("home_to"), ((k + 1) % 4).alias("away_to"))


STATS = {"rush": ("home_rush", "away_rush"), "pass": ("home_pass", "away_pass"), "turnovers": ("home_to", "away_to")}


def odds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes; (line_no, part, supp, cents) is unique per game."""
    return odds_columns(table(spark, sf_dir, "lineitem"))


def odds_columns(li: DataFrame) -> DataFrame:
    """Quotes from line items, as a batch or a stream."""
    kind = F.col("l_partkey") % 3
    return li.select(
        F.col("l_orderkey").alias("game_id"), F.col("l_returnflag").alias("book"),
        F.when(kind == 0, "spreads").when(kind == 1, "totals").otherwise("h2h").alias("market"),
        F.col("l_shipdate").alias("fetch_ts"), F.col("l_quantity").alias("qty"),
        F.floor(F.col("l_extendedprice")).cast("long").alias("price"),
        F.col("l_linenumber").alias("line_no"), F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp"),
        F.round(F.col("l_extendedprice") * 100).cast("long").alias("cents"))


QUOTE_TIES = ["line_no", "part", "supp", "cents"]


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes with their market's line fields."""
    q = odds(spark, sf_dir)
    money = (F.col("price") % 400 - 200).cast("int")
    return q.select(
        "*", F.when(F.col("market") == "spreads", (F.col("qty") - 25) / 2).alias("spread_home_relative"),
        F.when(F.col("market") == "totals", F.col("qty") + 20).alias("total_points"),
        F.when(F.col("market") == "h2h", money).alias("moneyline_home"),
        F.when(F.col("market") == "h2h", -money).alias("moneyline_away"))


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rating cells per (season, week, team); some cells and some teams are missing."""
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy(
        F.year("l_shipdate").alias("season"), week_of_year(F.col("l_shipdate")).alias("wk"),
        (F.col("l_suppkey") * 2 + F.col("l_linenumber") % 2).alias("team")).agg(
        F.sum(F.col("l_quantity").cast("long")).cast("double").alias("pr"),
        F.count(F.lit(1)).cast("double").alias("sos"))


def roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Teams on the roster: some teams with games are not on it, and its last ones play no game."""
    return table(spark, sf_dir, "part").select((F.floor(F.col("p_partkey") / 8) + 10).alias("team")).distinct()


def feed(g: DataFrame) -> DataFrame:
    """Provider events: shifted up to two days, roles swapped on every fifth."""
    k = F.col("game_id")
    swap = k % 5 == 0
    shifted = F.col("kickoff") + F.make_dt_interval(hours=(k % 97 - 48).cast("int"))
    return g.select(k.alias("event_id"), shifted.alias("event_ts"),
                    F.when(swap, F.col("away_id")).otherwise(F.col("home_id")).alias("home"),
                    F.when(swap, F.col("home_id")).otherwise(F.col("away_id")).alias("away"))


# The same views for the SQL check, each with the views it needs.
VIEWS_SQL = {
    "games": ((), """
        SELECT o_orderkey AS game_id, CAST(year(o_orderdate) AS INTEGER) AS season,
               CAST((dayofyear(o_orderdate) - 1) // 7 + 1 AS INTEGER) AS wk,
               o_orderdate + to_hours(CAST(o_orderkey % 3 * 4 AS INTEGER)) AS kickoff,
               CASE WHEN o_orderkey % 2 = 1 THEN o_custkey // 8 + 1 + o_orderkey % 31 ELSE o_custkey // 8 END AS home_id,
               CASE WHEN o_orderkey % 2 = 1 THEN o_custkey // 8 ELSE o_custkey // 8 + 1 + o_orderkey % 31 END AS away_id,
               CASE WHEN o_orderstatus <> 'O' THEN CAST(CAST(floor(o_totalprice) AS BIGINT) % 43 AS INTEGER) END AS home_score,
               CASE WHEN o_orderstatus <> 'O' THEN CAST(CAST(floor(o_totalprice / 43.0) AS BIGINT) % 43 AS INTEGER) END AS away_score,
               CASE WHEN o_orderpriority <> '4-NOT SPECIFIED'
                    THEN CAST((o_orderkey * 7) % 29 - 14 AS DOUBLE) / 2 END AS spread,
               o_orderkey % 11 = 0 AS neutral,
               CASE WHEN o_orderkey % 17 = 0 THEN 'POST' WHEN o_orderkey % 19 <> 0 THEN 'REG' END AS game_type
        FROM orders"""),
    "stats": (("games",), """
        SELECT *, (game_id * 13) % 200 AS home_rush, (game_id * 29) % 200 AS away_rush,
               (game_id * 17) % 350 AS home_pass, (game_id * 31) % 350 AS away_pass,
               game_id % 4 AS home_to, (game_id + 1) % 4 AS away_to
        FROM games"""),
    "team_rows": (("stats",), """
        SELECT game_id, season, wk, kickoff, game_type, home_id AS team, away_id AS opp, 'H' AS site,
               home_score AS pf, away_score AS pa, home_score - away_score AS margin, spread AS line,
               home_rush AS rush, away_rush AS opp_rush, home_pass AS pass, away_pass AS opp_pass,
               home_to AS turnovers, away_to AS opp_turnovers
        FROM stats
        UNION ALL
        SELECT game_id, season, wk, kickoff, game_type, away_id, home_id, 'A', away_score, home_score,
               away_score - home_score, -spread, away_rush, home_rush, away_pass, home_pass, away_to, home_to
        FROM stats"""),
    "flags": (("team_rows",), """
        SELECT *, CAST(coalesce(margin > 0, false) AS INTEGER) AS w, CAST(coalesce(margin < 0, false) AS INTEGER) AS l,
               CAST(coalesce(margin = 0, false) AS INTEGER) AS t,
               CAST(coalesce(margin + line > 0, false) AS INTEGER) AS ats_w,
               CAST(coalesce(margin + line < 0, false) AS INTEGER) AS ats_l,
               CAST(coalesce(margin + line = 0, false) AS INTEGER) AS ats_p
        FROM team_rows"""),
    "odds": ((), """
        SELECT l_orderkey AS game_id, l_returnflag AS book,
               CASE l_partkey % 3 WHEN 0 THEN 'spreads' WHEN 1 THEN 'totals' ELSE 'h2h' END AS market,
               l_shipdate AS fetch_ts, l_quantity AS qty, CAST(floor(l_extendedprice) AS BIGINT) AS price,
               l_linenumber AS line_no, l_partkey AS part, l_suppkey AS supp,
               CAST(round(l_extendedprice * 100) AS BIGINT) AS cents
        FROM lineitem"""),
    "lines": (("odds",), """
        SELECT *, CASE WHEN market = 'spreads' THEN (qty - 25) / 2 END AS spread_home_relative,
               CASE WHEN market = 'totals' THEN qty + 20 END AS total_points,
               CASE WHEN market = 'h2h' THEN CAST(price % 400 - 200 AS INTEGER) END AS moneyline_home,
               CASE WHEN market = 'h2h' THEN CAST(200 - price % 400 AS INTEGER) END AS moneyline_away
        FROM odds"""),
    "ratings": ((), """
        SELECT CAST(year(l_shipdate) AS INTEGER) AS season, CAST((dayofyear(l_shipdate) - 1) // 7 + 1 AS INTEGER) AS wk,
               l_suppkey * 2 + l_linenumber % 2 AS team, CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) AS pr,
               CAST(count(*) AS DOUBLE) AS sos
        FROM lineitem GROUP BY ALL"""),
    "rated": (("ratings",), """
        SELECT *, CAST(row_number() OVER (PARTITION BY season, wk ORDER BY pr DESC, team) AS INTEGER) AS pr_rank,
               CAST(row_number() OVER (PARTITION BY season, wk ORDER BY sos DESC, team) AS INTEGER) AS sos_rank
        FROM ratings"""),
    "page_rated": (("ratings",), """
        SELECT *, CAST(row_number() OVER (PARTITION BY team // 64, season, wk ORDER BY pr DESC, team) AS INTEGER) AS pr_rank,
               CAST(row_number() OVER (PARTITION BY team // 64, season, wk ORDER BY sos DESC, team) AS INTEGER) AS sos_rank
        FROM ratings"""),
    "season_weeks": (("games",), "SELECT season, max(wk) AS last_wk FROM games GROUP BY season"),
    "grid": (("team_rows", "season_weeks"), """
        SELECT t.season, t.team, CAST(w.wk AS INTEGER) AS wk
        FROM (SELECT DISTINCT season, team FROM team_rows) t JOIN season_weeks s USING (season),
             unnest(range(1, s.last_wk + 1)) AS w(wk)"""),
    "weekly": (("flags",), """
        SELECT season, team, wk, count(*) AS gp, sum(rush) AS rush, sum(pass) AS pass, sum(turnovers) AS turnovers,
               sum(opp_rush) AS opp_rush, sum(opp_pass) AS opp_pass, sum(opp_turnovers) AS opp_turnovers
        FROM flags GROUP BY season, team, wk"""),
    "to_date": (("grid", "weekly"), """
        SELECT g.season, g.team, g.wk, CAST(coalesce(sum(x.gp) OVER p, 0) AS BIGINT) AS gp,
               CAST(coalesce(sum(x.rush) OVER p, 0) AS BIGINT) AS rush,
               CAST(coalesce(sum(x.pass) OVER p, 0) AS BIGINT) AS pass,
               CAST(coalesce(sum(x.turnovers) OVER p, 0) AS BIGINT) AS turnovers,
               CAST(coalesce(sum(x.opp_rush) OVER p, 0) AS BIGINT) AS opp_rush,
               CAST(coalesce(sum(x.opp_pass) OVER p, 0) AS BIGINT) AS opp_pass,
               CAST(coalesce(sum(x.opp_turnovers) OVER p, 0) AS BIGINT) AS opp_turnovers
        FROM grid g LEFT JOIN weekly x ON x.season = g.season AND x.team = g.team AND x.wk = g.wk
        WINDOW p AS (PARTITION BY g.season, g.team ORDER BY g.wk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""),
    "per_game": (("to_date",), """
        SELECT season, team, wk, gp, CAST(rush AS DOUBLE) / nullif(gp, 0) AS ry_pg,
               CAST(pass AS DOUBLE) / nullif(gp, 0) AS py_pg, CAST(rush + pass AS DOUBLE) / nullif(gp, 0) AS ty_pg,
               CAST(opp_rush AS DOUBLE) / nullif(gp, 0) AS ry_allowed_pg,
               CAST(opp_pass AS DOUBLE) / nullif(gp, 0) AS py_allowed_pg,
               CAST(opp_rush + opp_pass AS DOUBLE) / nullif(gp, 0) AS ty_allowed_pg,
               CAST(opp_turnovers - turnovers AS DOUBLE) / nullif(gp, 0) AS to_margin_pg
        FROM to_date"""),
    "ranked": (("per_game",), """
        SELECT *, CASE WHEN ry_pg IS NOT NULL THEN CAST(dense_rank() OVER (PARTITION BY season, wk ORDER BY ry_pg DESC NULLS LAST) AS INTEGER) END AS ry_pg_rank,
               CASE WHEN py_pg IS NOT NULL THEN CAST(dense_rank() OVER (PARTITION BY season, wk ORDER BY py_pg DESC NULLS LAST) AS INTEGER) END AS py_pg_rank,
               CASE WHEN ty_pg IS NOT NULL THEN CAST(dense_rank() OVER (PARTITION BY season, wk ORDER BY ty_pg DESC NULLS LAST) AS INTEGER) END AS ty_pg_rank,
               CASE WHEN ry_allowed_pg IS NOT NULL THEN CAST(dense_rank() OVER (PARTITION BY season, wk ORDER BY ry_allowed_pg ASC NULLS LAST) AS INTEGER) END AS ry_allowed_pg_rank,
               CASE WHEN py_allowed_pg IS NOT NULL THEN CAST(dense_rank() OVER (PARTITION BY season, wk ORDER BY py_allowed_pg ASC NULLS LAST) AS INTEGER) END AS py_allowed_pg_rank,
               CASE WHEN ty_allowed_pg IS NOT NULL THEN CAST(dense_rank() OVER (PARTITION BY season, wk ORDER BY ty_allowed_pg ASC NULLS LAST) AS INTEGER) END AS ty_allowed_pg_rank
        FROM per_game"""),
    "before": (("flags",), """
        SELECT game_id, team, CAST(coalesce(sum(w) OVER p, 0) AS BIGINT) AS w_before,
               CAST(coalesce(sum(l) OVER p, 0) AS BIGINT) AS l_before, CAST(coalesce(sum(t) OVER p, 0) AS BIGINT) AS t_before,
               CAST(coalesce(sum(ats_w) OVER p, 0) AS BIGINT) AS ats_w_before,
               CAST(coalesce(sum(ats_l) OVER p, 0) AS BIGINT) AS ats_l_before,
               CAST(coalesce(sum(ats_p) OVER p, 0) AS BIGINT) AS ats_p_before
        FROM flags
        WINDOW p AS (PARTITION BY season, team ORDER BY epoch_us(kickoff) RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""),
    "per_book": (("lines", "games"), """
        SELECT l.*, g.kickoff, l.fetch_ts <= g.kickoff AS early
        FROM lines l JOIN games g USING (game_id)"""),
    "latest_market": (("per_book",), """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY game_id, market ORDER BY fetch_ts DESC, book DESC,
                              line_no, part, supp, cents) AS rn FROM per_book) WHERE rn = 1"""),
    "closing_market": (("per_book",), """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY game_id, market ORDER BY early DESC, fetch_ts DESC, book DESC,
                              line_no, part, supp, cents) AS rn FROM per_book) WHERE rn = 1"""),
    "feed": (("games",), """
        SELECT game_id AS event_id, kickoff + to_hours(CAST(game_id % 97 - 48 AS INTEGER)) AS event_ts,
               CASE WHEN game_id % 5 = 0 THEN away_id ELSE home_id END AS home,
               CASE WHEN game_id % 5 = 0 THEN home_id ELSE away_id END AS away
        FROM games"""),
    "roster": ((), "SELECT DISTINCT p_partkey // 8 + 10 AS team FROM part"),
}


def with_views(needed: list[str], select: str) -> str:
    """``select`` preceded by the views it needs."""
    order: list[str] = []

    def add(name: str) -> None:
        if name in order:
            return
        for dep in VIEWS_SQL[name][0]:
            add(dep)
        order.append(name)

    for name in needed:
        add(name)
    if not order:
        return select.strip()
    body = ",\n".join(f"{n} AS ({VIEWS_SQL[n][1].strip()})" for n in order)
    # A leading comma means the select brings views of its own.
    return f"WITH {body}\n{select.strip()}"
