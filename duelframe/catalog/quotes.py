"""Entity names, quotes and matching."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.names import compact_key
from ..operators import entities, matching, quotes, ratings, ranks
from ..plans import adapters as A
from .registry import query, stamp
from .scalar import text_of
from .teams import rated


def nation_names(spark, sf) -> DataFrame:
    n = A.table(spark, sf, "nation").withColumnRenamed("n_regionkey", "r_regionkey")
    # Two dimension tables of fixed size.
    both = n.join(A.table(spark, sf, "region"), "r_regionkey")
    return both.select("n_nationkey", "r_name", F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("abbr"),
                       F.concat_ws(" ", "r_name", "n_name").alias("full"))


def nation_aliases(spark, sf) -> DataFrame:
    names = nation_names(spark, sf)
    cities = names.groupBy(F.lower("r_name").alias("alias")).agg(F.min("full").alias("canonical")).select(
        F.lit("free").alias("form"), "alias", F.lit(entities.CITY).alias("tier"), "canonical")
    return entities.alias_rows(names, "abbr", "full").unionByName(cities)


def labels(spark, sf) -> DataFrame:
    """Seven spellings of the customers' nations."""
    c = A.table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    both = c.join(nation_names(spark, sf), "n_nationkey")
    nk, k = F.col("n_nationkey").cast("string"), F.col("c_custkey") % 7
    label = (F.when(k == 0, F.concat(F.lit(" n"), nk)).when(k == 1, F.lower("full"))
             .when(k == 2, F.concat(F.lit("Nation_"), nk)).when(k == 3, F.concat("r_name", F.lit(". ")))
             .when(k == 4, F.concat(F.lit("  Unknown & "), nk)).when(k == 5, F.regexp_replace("full", " ", "-"))
             .otherwise("X"))
    return both.select("c_custkey", label.alias("label"))


LABELS_SQL = """
    names AS (SELECT n_nationkey, r_name, 'N' || n_nationkey AS abbr, r_name || ' ' || n_name AS full_name,
                     lower(r_name || ' ' || n_name) AS clean
              FROM nation JOIN region ON r_regionkey = n_regionkey),
    aliases AS (
        SELECT 'raw' AS form, lower(abbr) AS alias, 1 AS tier, full_name FROM names
        UNION ALL SELECT 'raw', lower(full_name), 2, full_name FROM names
        UNION ALL SELECT 'free', clean, 3, full_name FROM names
        UNION ALL SELECT 'free', regexp_extract(clean, ' (\\S+)$', 1), 3, min(full_name) FROM names GROUP BY 2 HAVING count(*) = 1
        UNION ALL SELECT 'free', regexp_extract(clean, '^(.*) \\S+$', 1), 4, min(full_name) FROM names GROUP BY 2 HAVING count(*) = 1
        UNION ALL SELECT 'free', lower(r_name), 4, min(full_name) FROM names GROUP BY 2),
    best AS (SELECT form, alias, arg_min(full_name, tier) AS full_name FROM aliases GROUP BY form, alias),
    labels AS (
        SELECT c_custkey, CASE c_custkey % 7 WHEN 0 THEN ' n' || n_nationkey WHEN 1 THEN lower(full_name) WHEN 2 THEN 'Nation_' || n_nationkey
               WHEN 3 THEN r_name || '. ' WHEN 4 THEN '  Unknown & ' || n_nationkey WHEN 5 THEN replace(full_name, ' ', '-') ELSE 'X' END AS label
        FROM customer JOIN names ON n_nationkey = c_nationkey),
    resolved AS (
        SELECT c_custkey, label, coalesce(r.full_name, f.full_name, trim(label)) AS canonical
        FROM labels LEFT JOIN best r ON r.form = 'raw' AND r.alias = lower(trim(label))
        LEFT JOIN best f ON f.form = 'free'
             AND f.alias = trim(regexp_replace(replace(translate(lower(label), '.-,', '   '), '&', 'and'), '\\s+', ' ', 'g')))"""


@query("resolve_nation", f"WITH {LABELS_SQL} SELECT c_custkey, canonical FROM resolved")
def resolve_nation(spark, sf):
    return entities.resolve_entity(labels(spark, sf), "label", nation_aliases(spark, sf), "canonical").drop("label")


@query("merge_key", f"""
    WITH {LABELS_SQL} SELECT c_custkey, regexp_replace(replace(lower(canonical), '&', 'and'), '[^a-z0-9]', '', 'g') AS team_key FROM resolved""")
def merge_key(spark, sf):
    return entities.merge_key(labels(spark, sf), "label", nation_aliases(spark, sf), "team_key").drop("label")


@query("normalize_label", """
    SELECT p_partkey, CASE WHEN clean = 'red widget' THEN 'Red Widget (Classic)' ELSE
           array_to_string(list_transform(string_split(clean, ' '), lambda w: upper(w[1:1]) || w[2:]), ' ') END AS display
    FROM (SELECT p_partkey, regexp_replace(replace(lower(trim('  ' || p_name || CASE WHEN p_partkey % 3 = 0 THEN '   & ' || p_type ELSE '' END)), '&', 'and'), '\\s+', ' ', 'g') AS clean
          FROM part)""")
def normalize_label(spark, sf):
    p = A.table(spark, sf, "part")
    extra = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("   & "), F.col("p_type"))).otherwise("")
    label = F.concat(F.lit("  "), F.col("p_name"), extra)
    return p.select("p_partkey", entities.normalize_label(label, {"red widget": "Red Widget (Classic)"}).alias("display"))


@query("strip_suffix", """
    SELECT p_partkey, CASE WHEN base = 'hot rod' THEN 'furnace' WHEN base = 'blue ring' THEN 'blue'
        ELSE regexp_replace(trim(regexp_replace(base || ' ' || lower(p_type), '(small|large) promo$', '')), '( (anvil|bolt|gear|gizmo|economy|standard))+$', '') END AS stem
    FROM (SELECT *, p_name AS base FROM part)""")
def strip_suffix(spark, sf):
    p = A.table(spark, sf, "part")
    label = F.when(F.col("p_name").isin("hot rod", "blue ring"), F.col("p_name")).otherwise(
        F.concat_ws(" ", "p_name", "p_type"))
    return p.select("p_partkey", entities.strip_suffix_words(
        label, aliases={"hot rod": "Furnace", "bluering": "blue  gear"}, phrases=["small promo", "large promo"],
        words=["anvil", "bolt", "gear", "gizmo", "economy", "standard"], display={}).alias("stem"))


@query("override_key", """
    SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'now' WHEN '5-LOW' THEN 'later' ELSE o_orderpriority END AS o_orderpriority
    FROM orders""")
def override_key(spark, sf):
    dim = spark.createDataFrame([("1-URGENT", "now"), ("5-LOW", "later")], "alias string, target string")
    return entities.override_key(A.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority", dim)


@query("multi_key_lookup", """
    , dim AS (SELECT s_suppkey, s_name, s_nationkey FROM supplier),
    keys AS (SELECT lower(s_name) AS k, s_suppkey FROM dim UNION ALL SELECT 's' || s_suppkey % 40, s_suppkey FROM dim),
    idx AS (SELECT k, min(s_suppkey) AS s_suppkey FROM keys GROUP BY k)
    SELECT o.o_orderkey, coalesce(a.s_suppkey, b.s_suppkey) AS s_suppkey
    FROM (SELECT o_orderkey, 'supplier#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS t1, 's' || o_custkey % 60 AS t2 FROM orders) o
    LEFT JOIN idx a ON a.k = o.t1 LEFT JOIN idx b ON b.k = o.t2""", ["season_weeks"])
def multi_key_lookup(spark, sf):
    o = A.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    s = A.table(spark, sf, "supplier")
    tries = [F.concat(F.lit("supplier#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")),
             F.concat(F.lit("s"), (F.col("o_custkey") % 60).cast("string"))]
    keys = [F.lower("s_name"), F.concat(F.lit("s"), (F.col("s_suppkey") % 40).cast("string"))]
    return entities.multi_key_lookup(o, tries, s, keys, ["s_suppkey"], "s_suppkey", "found").select(
        "o_orderkey", F.col("found").alias("s_suppkey"))


PINNED = """
    cand AS (
        SELECT f.event_id, g.game_id, f.home <> g.home_id AS swapped, abs(epoch(g.kickoff) - epoch(f.event_ts)) AS delta,
               CASE WHEN g.neutral THEN 0 ELSE 1 END AS nr, g.kickoff
        FROM feed f JOIN games g ON (f.home = g.home_id AND f.away = g.away_id) OR (f.home = g.away_id AND f.away = g.home_id)
        WHERE abs(epoch(g.kickoff) - epoch(f.event_ts)) <= 36 * 3600
          AND abs(date_diff('day', CAST(g.kickoff AS DATE), CAST(f.event_ts AS DATE))) <= 3),
    pool AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY swapped, delta, nr, game_id) AS rn,
                    count(*) OVER (PARTITION BY event_id, swapped, delta, nr) AS ties FROM cand),
    best AS (SELECT * FROM pool WHERE rn = 1)"""


@query("pin_events", f"""
    , {PINNED}
    SELECT f.event_id, CASE WHEN ties = 1 THEN game_id END AS game_id, CASE WHEN ties = 1 THEN swapped END AS role_swapped,
           CASE WHEN ties = 1 THEN {stamp('kickoff')} END AS kickoff,
           CASE WHEN game_id IS NULL THEN 'no_candidate' WHEN ties > 1 THEN 'ambiguous' END AS why
    FROM feed f LEFT JOIN best b USING (event_id)""", ["feed", "games"])
def pin_events(spark, sf):
    g = A.games(spark, sf)
    out = matching.pin_events(A.feed(g), g, neutral="neutral")
    return out.select("event_id", "game_id", "role_swapped", text_of("kickoff").alias("kickoff"), "why")


@query("pin_lenient", f"""
    , {PINNED}
    SELECT f.event_id, game_id, swapped AS role_swapped FROM feed f JOIN best b USING (event_id)""", ["feed", "games"])
def pin_lenient(spark, sf):
    g = A.games(spark, sf)
    out = matching.pin_events(A.feed(g), g, neutral="neutral", strict_ties=False)
    return matching.pinned(out).select("event_id", "game_id", "role_swapped")


@query("pin_quarantine", f"""
    , {PINNED}
    SELECT f.event_id, f.home, f.away, CASE WHEN game_id IS NULL THEN 'no_candidate' ELSE 'ambiguous' END AS why
    FROM feed f LEFT JOIN best b USING (event_id) WHERE game_id IS NULL OR ties > 1""", ["feed", "games"])
def pin_quarantine(spark, sf):
    g = A.games(spark, sf)
    events = A.feed(g)
    return matching.quarantined(matching.pin_events(events, g, neutral="neutral"), events).select(
        "event_id", "home", "away", "why")


TIERED = """
    near_feed AS (SELECT event_id, home, away, kickoff + to_minutes(CAST(event_id % 400 - 200 AS INTEGER)) AS event_ts
                  FROM (SELECT f.event_id, f.home, f.away, g.kickoff FROM feed f JOIN games g ON g.game_id = f.event_id)),
    tcand AS (
        SELECT f.event_id, g.game_id, abs(epoch(g.kickoff) - epoch(f.event_ts)) AS delta,
               CASE WHEN abs(epoch(g.kickoff) - epoch(f.event_ts)) <= 300 THEN 1 ELSE 3 END + CAST(f.home <> g.home_id AS INTEGER) AS tier
        FROM near_feed f JOIN games g ON (f.home = g.home_id AND f.away = g.away_id) OR (f.home = g.away_id AND f.away = g.home_id)
        WHERE abs(epoch(g.kickoff) - epoch(f.event_ts)) <= 300
           OR (abs(epoch(g.kickoff) - epoch(f.event_ts)) <= 7200 AND CAST(g.kickoff AS DATE) = CAST(f.event_ts AS DATE))),
    open0 AS (SELECT * FROM tcand)"""
# Each round settles a game of every losing event, so as many rounds as an event has games in reach are enough; with a pair's
# games on at most three slots a day they are few.
ROUNDS = 6
for _n in range(1, ROUNDS + 1):
    TIERED += f""",
    best{_n} AS (SELECT * FROM open{_n - 1} QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY tier, delta, game_id) = 1),
    won{_n} AS (SELECT * FROM best{_n} QUALIFY row_number() OVER (PARTITION BY game_id ORDER BY tier, delta, event_id) = 1),
    open{_n} AS (SELECT * FROM open{_n - 1} WHERE event_id NOT IN (SELECT event_id FROM won{_n}) AND game_id NOT IN (SELECT game_id FROM won{_n}))"""
TIERED += ",\n    twin AS (" + " UNION ALL ".join(f"SELECT * FROM won{_n}" for _n in range(1, ROUNDS + 1)) + ")"


def near_feed(spark, sf) -> DataFrame:
    """Feed events within 200 minutes of their game."""
    g = A.games(spark, sf)
    k = F.col("game_id")
    return A.feed(g.select("*")).join(g.select(k.alias("event_id"), "kickoff"), "event_id").select(
        "event_id", (F.col("kickoff") + F.make_dt_interval(mins=(F.col("event_id") % 400 - 200).cast("int"))).alias("event_ts"),
        "home", "away")


@query("tiered_match", f"""
    , {TIERED}
    SELECT f.event_id, w.game_id, CASE w.tier WHEN 1 THEN 'ordered_exact' WHEN 2 THEN 'unordered_exact' WHEN 3 THEN 'ordered_near'
           WHEN 4 THEN 'unordered_near' END AS tier, CAST(w.delta AS DOUBLE) AS delta,
           CASE WHEN w.game_id IS NULL THEN 'no_schedule_candidate' END AS why
    FROM near_feed f LEFT JOIN twin w USING (event_id)""", ["feed", "games"])
def tiered_match(spark, sf):
    return matching.tiered_match(near_feed(spark, sf), A.games(spark, sf)).select("event_id", "game_id", "tier", "delta", "why")


@query("alias_debt", f"""
    , {TIERED}
    SELECT token, count(*) AS n FROM (
        SELECT unnest(['t' || f.home, 't' || f.away]) AS token FROM near_feed f LEFT JOIN twin w USING (event_id) WHERE w.game_id IS NULL)
    GROUP BY token ORDER BY n DESC, token LIMIT 50""", ["feed", "games"])
def alias_debt(spark, sf):
    out = matching.tiered_match(near_feed(spark, sf), A.games(spark, sf))
    def token(c):
        return F.concat(F.lit("t"), F.col(c).cast("string"))
    return entities.alias_debt(out.select("why", token("home").alias("home_norm"), token("away").alias("away_norm")))


@query("enrich_missing", """
    , src AS (SELECT event_id AS rid, CASE WHEN event_id % 2 = 0 THEN event_id END AS game_id, home AS home_id, away AS away_id,
                     kickoff + to_minutes(CAST(event_id % 30 - 15 AS INTEGER)) AS event_ts,
                     CASE WHEN event_id % 9 > 0 THEN CAST(event_id % 21 AS DOUBLE) - 10 END AS sp, CASE WHEN event_id % 7 > 0 THEN CAST(event_id % 40 AS DOUBLE) + 30 END AS tot
              FROM (SELECT f.event_id, f.home, f.away, g.kickoff FROM feed f JOIN games g ON g.game_id = f.event_id)),
    useful AS (SELECT * FROM src WHERE sp IS NOT NULL OR tot IS NOT NULL),
    near AS (SELECT * FROM (
        SELECT g.game_id AS gid, u.sp, u.tot, row_number() OVER (PARTITION BY g.game_id ORDER BY abs(epoch(u.event_ts) - epoch(g.kickoff)), u.event_ts, u.rid) AS rn
        FROM games g JOIN useful u ON u.home_id = g.home_id AND u.away_id = g.away_id AND abs(epoch(u.event_ts) - epoch(g.kickoff)) <= 600) WHERE rn = 1)
    SELECT g.game_id, coalesce(g.spread, CASE WHEN k.rid IS NOT NULL THEN k.sp ELSE n.sp END) AS spread,
           CASE WHEN k.rid IS NOT NULL THEN k.tot ELSE n.tot END AS total,
           (g.spread IS NULL AND CASE WHEN k.rid IS NOT NULL THEN k.sp ELSE n.sp END IS NOT NULL)
             OR CASE WHEN k.rid IS NOT NULL THEN k.tot ELSE n.tot END IS NOT NULL AS enriched
    FROM games g LEFT JOIN useful k ON k.game_id = g.game_id LEFT JOIN near n ON n.gid = g.game_id""", ["feed", "games"])
def enrich_missing(spark, sf):
    g = A.games(spark, sf)
    k = F.col("event_id")
    src = A.feed(g).join(g.select(F.col("game_id").alias("event_id"), "kickoff"), "event_id").select(
        k.alias("rid"), F.when(k % 2 == 0, k).alias("game_id"), F.col("home").alias("home_id"), F.col("away").alias("away_id"),
        (F.col("kickoff") + F.make_dt_interval(mins=(k % 30 - 15).cast("int"))).alias("event_ts"),
        F.when(k % 9 > 0, (k % 21).cast("double") - 10).alias("spread_home_relative"),
        F.when(k % 7 > 0, (k % 40).cast("double") + 30).alias("total_points"))
    out = matching.enrich_missing(g.withColumn("total", F.lit(None).cast("double")), src, ties=["rid"])
    return out.select("game_id", "spread", "total", "enriched")


@query("week_of_ts", """
    , win AS (SELECT season, wk, date_trunc('week', min(kickoff) - INTERVAL 1 DAY) + INTERVAL 1 DAY AS start FROM games GROUP BY season, wk),
    starts AS (SELECT season, start, min(wk) AS wk FROM win GROUP BY season, start),
    ends AS (SELECT season, min(start) AS first_start, arg_min(wk, (start, wk)) AS first_wk, arg_max(wk, (start, wk)) AS last_wk FROM win GROUP BY season)
    SELECT o.game_id, o.line_no, o.part, o.supp, o.cents, CAST(coalesce(s.wk, CASE WHEN o.fetch_ts < e.first_start THEN e.first_wk ELSE e.last_wk END) AS INTEGER) AS week
    FROM odds o JOIN games g USING (game_id) LEFT JOIN starts s ON s.season = g.season
         AND s.start <= o.fetch_ts AND o.fetch_ts < s.start + INTERVAL 7 DAY
    LEFT JOIN ends e ON e.season = g.season""", ["odds", "games"])
def week_of_ts(spark, sf):
    g = A.games(spark, sf)
    q = A.odds(spark, sf).join(g.select("game_id", "season"), "game_id")
    return matching.week_of(q, matching.week_windows(g, ["season"]), ["season"], "fetch_ts").select(
        "game_id", *A.QUOTE_TIES, "week")


@query("event_window", """
    , b AS (SELECT min(kickoff) AS lo, max(kickoff) AS hi FROM games)
    SELECT event_id, event_ts >= lo - INTERVAL 6 DAY AND event_ts <= hi + INTERVAL 6 DAY AS in_window,
           event_ts > hi + INTERVAL 2 DAY AS is_future, event_ts < lo - INTERVAL 2 DAY AS is_past FROM feed, b""", ["feed", "games"])
def event_window(spark, sf):
    g = A.games(spark, sf)
    return matching.event_window_flags(A.feed(g), g).select(
        "event_id", "in_window", "is_future", "is_past")


@query("event_window_all", """
    , far AS (SELECT event_id, event_ts + to_days(CASE event_id % 50 WHEN 7 THEN 4000 WHEN 8 THEN -4000 ELSE 0 END) AS event_ts FROM feed),
    b AS (SELECT min(kickoff) AS lo, max(kickoff) AS hi FROM games)
    SELECT event_id, event_ts >= lo - INTERVAL 6 DAY AND event_ts <= hi + INTERVAL 6 DAY AS in_window,
           event_ts > hi + INTERVAL 2 DAY AS is_future, event_ts < lo - INTERVAL 2 DAY AS is_past FROM far, b""", ["feed", "games"])
def event_window_all(spark, sf):
    """Bounds of all games; some events lie years outside."""
    g, k = A.games(spark, sf), F.col("event_id") % 50
    days = F.when(k == 7, 4000).when(k == 8, -4000).otherwise(0)
    events = A.feed(g).withColumn("event_ts", F.col("event_ts") + F.make_dt_interval(days=days))
    return matching.event_window_flags(events, g).select("event_id", "in_window", "is_future", "is_past")


@query("latest_per_key", """
    SELECT game_id, market, book, strftime(fetch_ts, '%Y-%m-%d %H:%M:%S') AS fetch_ts, line_no, part, cents FROM (
        SELECT *, row_number() OVER (PARTITION BY game_id, market, book ORDER BY fetch_ts DESC, line_no, part, supp, cents) AS rn FROM odds)
    WHERE rn = 1""", ["odds"])
def latest_per_key(spark, sf):
    return ranks.latest_per_key(A.odds(spark, sf), ["game_id", "market", "book"], "fetch_ts", A.QUOTE_TIES).select(
        "game_id", "market", "book", text_of("fetch_ts").alias("fetch_ts"), "line_no", "part", "cents")


ASOF = """
    SELECT g.game_id, x.book AS asof_book, x.price AS asof_price, strftime(x.fetch_ts, '%Y-%m-%d %H:%M:%S') AS asof_fetch_ts
    FROM games g LEFT JOIN (SELECT * FROM (
        SELECT o.*, row_number() OVER (PARTITION BY o.game_id ORDER BY o.fetch_ts DESC, line_no, part, supp, cents) AS rn
        FROM odds o JOIN games USING (game_id) WHERE o.fetch_ts <= kickoff) WHERE rn = 1) x ON x.game_id = g.game_id"""


@query("asof_last_before", ASOF, ["games", "odds"])
def asof_last_before(spark, sf):
    out = quotes.asof_backward(A.games(spark, sf).select("game_id", "kickoff"), A.odds(spark, sf), ["game_id"], "kickoff",
                               "fetch_ts", ["book", "price", "fetch_ts"], A.QUOTE_TIES)
    return out.select("game_id", "asof_book", "asof_price", text_of("asof_fetch_ts").alias("asof_fetch_ts"))


@query("asof_history", """
    SELECT f.event_id, x.part AS asof_part, strftime(x.fetch_ts, '%Y-%m-%d %H:%M:%S') AS asof_fetch_ts
    FROM feed f LEFT JOIN (SELECT * FROM (
        SELECT f.event_id, o.part, o.fetch_ts, row_number() OVER (PARTITION BY f.event_id ORDER BY o.fetch_ts DESC, game_id, line_no, part, supp, cents) AS rn
        FROM feed f JOIN odds o ON o.supp = f.home AND o.fetch_ts <= f.event_ts) WHERE rn = 1) x USING (event_id)""", ["feed", "odds"])
def asof_history(spark, sf):
    # Many cutoffs per key: the last quote with the home side's number before each event.
    f = A.feed(A.games(spark, sf)).select("event_id", F.col("home").alias("supp"), "event_ts")
    out = quotes.asof_history(f, A.odds(spark, sf), ["supp"], "event_ts", "fetch_ts", ["part", "fetch_ts"],
                              ["game_id", *[t for t in A.QUOTE_TIES if t != "supp"]])
    return out.select("event_id", "asof_part", text_of("asof_fetch_ts").alias("asof_fetch_ts"))


def promoted_sql(view: str, closing: str) -> str:
    return f"""
    SELECT game_id, max(spread_home_relative) FILTER (WHERE market = 'spreads') AS spread_home_relative,
           -abs(max(spread_home_relative) FILTER (WHERE market = 'spreads')) AS spread_favored_team,
           max(total_points) FILTER (WHERE market = 'totals') AS total,
           max(moneyline_home) FILTER (WHERE market = 'h2h') AS moneyline_home,
           arg_max(book, (fetch_ts, market)) AS odds_source, strftime(max(fetch_ts), '%Y-%m-%d %H:%M:%S') AS snapshot_at,
           {closing} AS is_closing, count(*) AS markets
    FROM {view} GROUP BY game_id"""


def promote(spark, sf, policy: str) -> DataFrame:
    out = quotes.promote_lines(A.games(spark, sf), A.lines(spark, sf), policy=policy, ties=A.QUOTE_TIES)
    return out.select("game_id", "spread_home_relative", "spread_favored_team", "total", "moneyline_home", "odds_source",
                      text_of("snapshot_at").alias("snapshot_at"), "is_closing", "markets")


@query("promote_lines", promoted_sql("latest_market", "false"), ["latest_market"])
def promote_lines(spark, sf):
    return promote(spark, sf, "latest")


@query("promote_closing", promoted_sql("closing_market", "coalesce(bool_or(early) FILTER (WHERE market = 'spreads'), false)"),
       ["closing_market"])
def promote_closing(spark, sf):
    return promote(spark, sf, "closing")


@query("closing_line", """
    , src AS (
        SELECT 0 AS place, 'pinned' AS source, * FROM per_book WHERE book = 'R' AND market = 'spreads'
        UNION ALL SELECT 1, 'snapshot', * FROM per_book WHERE book = 'A' AND market = 'spreads'
        UNION ALL SELECT 2, 'history', * FROM per_book WHERE market = 'spreads')
    SELECT game_id, source, book, strftime(fetch_ts, '%Y-%m-%d %H:%M:%S') AS fetched_ts, spread_home_relative AS closing_spread,
           CASE WHEN spread_home_relative < 0 THEN 'HOME' WHEN spread_home_relative > 0 THEN 'AWAY' ELSE 'PICK' END AS favored_side
    FROM (SELECT *, row_number() OVER (PARTITION BY game_id ORDER BY place, fetch_ts DESC, book, line_no, part, supp, cents) AS rn
          FROM src WHERE early) WHERE rn = 1""", ["per_book"])
def closing_line(spark, sf):
    q = A.lines(spark, sf).where("market = 'spreads'")
    out = quotes.closing_line(A.games(spark, sf), [("pinned", q.where("book = 'R'")), ("snapshot", q.where("book = 'A'")),
                                                   ("history", q)], ties=A.QUOTE_TIES)
    return out.withColumn("fetched_ts", text_of("fetched_ts"))


@query("snapshot_counts", "SELECT market, book, count(*) AS n FROM odds GROUP BY ROLLUP (market, book)", ["odds"])
def snapshot_counts(spark, sf):
    return quotes.snapshot_counts(A.odds(spark, sf))


@query("reason_counts", """
    SELECT CASE WHEN event_type IN ('click', 'view') THEN event_type ELSE 'other' END AS reason, count(*) AS n FROM events GROUP BY 1""")
def reason_counts(spark, sf):
    return quotes.reason_counts(A.table(spark, sf, "events"), ["click", "view"], "event_type")


def provider_events(spark, sf) -> DataFrame:
    """One provider event per quote, with one or two books, each market with its outcomes."""
    q = A.lines(spark, sf)
    home, away = F.concat(F.lit("T&"), F.col("supp").cast("string")), F.concat(F.lit("P."), F.col("part").cast("string"))
    point = (F.col("qty") - 25) / 2
    def outcome(name, price, point_):
        return F.struct(name.alias("name"), price.cast("string").alias("price"), point_.cast("string").alias("point"))
    none = F.lit(None).cast("double")
    spreads = F.array(outcome(away, F.lit(-110), -point), outcome(home, F.col("price") % 300, point))
    # Some feeds list only the away side.
    spreads = F.when(F.col("line_no") == 3, F.slice(spreads, 1, 1)).otherwise(spreads)
    totals = F.array(outcome(F.lit("Under"), F.lit(-105), F.col("qty") + 20), outcome(F.lit("Over"), F.lit(-115), F.col("qty") + 20))
    totals = F.when(F.col("line_no") == 4, F.slice(totals, 1, 1)).otherwise(totals)
    h2h = F.array(outcome(home, F.col("price") % 400, none), outcome(away, -(F.col("price") % 400), none))
    def market(key, outs):
        return F.struct(F.lit(key).alias("key"), F.date_format("fetch_ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("last_update"), outs.alias("outcomes"))
    markets = F.array(market("spreads", spreads), market("totals", totals), market("h2h", h2h))
    def book(key, title):
        return F.struct(key.alias("key"), title.alias("title"), markets.alias("markets"))
    books = F.when(F.col("line_no") % 2 == 0, F.array(book(F.col("book"), F.col("book")), book(F.lit("x"), F.lit("Pinnacle")))
                   ).otherwise(F.array(book(F.lit(None).cast("string"), F.col("book"))))
    ident = F.concat_ws("-", "game_id", *A.QUOTE_TIES)
    return q.select(ident.alias("id"), F.date_format("fetch_ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("commence_time"),
                    home.alias("home_team"), away.alias("away_team"), books.alias("bookmakers"))


@query("pick_book", """
    SELECT game_id || '-' || line_no || '-' || part || '-' || supp || '-' || cents AS id,
           CASE WHEN line_no % 2 = 0 THEN 'Pinnacle' ELSE book END AS title FROM odds""", ["odds"])
def pick_book(spark, sf):
    return provider_events(spark, sf).select("id", quotes.pick_book("bookmakers")["title"].alias("title"))


@query("flatten_odds", """
    SELECT b.book, m.market, count(*) AS n, CAST(sum(CASE WHEN m.market = 'spreads' AND o.line_no = 3 OR m.market = 'totals' AND o.line_no = 4 THEN 1 ELSE 2 END) AS BIGINT) AS outcomes
    FROM odds o, (VALUES ('spreads'), ('totals'), ('h2h')) AS m(market),
         unnest(CASE WHEN o.line_no % 2 = 0 THEN [o.book, 'x'] ELSE ['unknown'] END) AS b(book)
    GROUP BY 1, 2""", ["odds"])
def flatten_odds(spark, sf):
    rows = quotes.flatten_odds(provider_events(spark, sf))
    return rows.groupBy("book", "market").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("outcomes")).alias("outcomes"))


@query("extract_lines", """
    SELECT game_id || '-' || line_no || '-' || part || '-' || supp || '-' || cents AS event_id, b.book, m.market,
           CASE WHEN m.market = 'spreads' THEN CASE WHEN swap THEN -1 ELSE 1 END * ((qty - 25) / 2) + 0.0 END AS spread_home_relative,
           CASE WHEN m.market = 'spreads' THEN -abs((qty - 25) / 2) END AS spread_favored_team,
           CASE WHEN m.market = 'spreads' THEN CASE WHEN NOT swap THEN CASE WHEN line_no <> 3 THEN CAST(price % 300 AS INTEGER) END ELSE -110 END END AS home_price,
           CASE WHEN m.market = 'totals' THEN qty + 20 END AS total_points,
           CASE WHEN m.market = 'totals' AND line_no <> 4 THEN -115 END AS over_price,
           CASE WHEN m.market = 'totals' THEN -105 END AS under_price,
           CASE WHEN m.market = 'h2h' THEN CAST(price % 400 AS INTEGER) * CASE WHEN swap THEN -1 ELSE 1 END END AS moneyline_home
    FROM (SELECT *, part % 2 = 1 AS swap FROM odds) AS o, (VALUES ('spreads'), ('totals'), ('h2h')) AS m(market),
         unnest(CASE WHEN o.line_no % 2 = 0 THEN [o.book, 'x'] ELSE ['unknown'] END) AS b(book)""", ["odds"])
def extract_lines(spark, sf):
    rows = quotes.flatten_odds(provider_events(spark, sf))
    swap = F.split("event_id", "-")[2].cast("long") % 2 == 1
    out = quotes.extract_lines(rows.withColumn("role_swapped", swap))
    return out.select("event_id", "book", "market", (F.col("spread_home_relative") + 0.0).alias("spread_home_relative"),
                      "spread_favored_team", "home_price", "total_points", "over_price", "under_price", "moneyline_home")


@query("asof_nearest_week", """
    , need AS (SELECT DISTINCT season, wk, team FROM team_rows),
    near AS (SELECT * FROM (
        SELECT n.season, n.wk, n.team, r.wk AS rating_week, r.pr, r.sos, row_number() OVER (PARTITION BY n.season, n.wk, n.team
               ORDER BY CASE WHEN r.wk <= n.wk THEN 0 ELSE 1 END, abs(r.wk - n.wk)) AS rn
        FROM need n JOIN ratings r ON r.season = n.season AND r.team = n.team) WHERE rn = 1)
    SELECT t.game_id, t.team, n.rating_week, n.pr, n.sos FROM team_rows t LEFT JOIN near n USING (season, wk, team)""", ["team_rows", "ratings"])
def asof_nearest_week(spark, sf):
    from .teams import team_rows

    rows = team_rows(spark, sf).select("game_id", "season", "wk", "team")
    weeks = A.games(spark, sf).groupBy("season").agg(F.max("wk").alias("_last"))
    filled = ratings.fill_rating_weeks(A.ratings(spark, sf), weeks, ["season"], ["pr", "sos"])
    out = ratings.attach_ratings(rows, filled, ["season"], ["rating_week", "pr", "sos"], {"team": ""})
    return out.select("game_id", "team", "rating_week", "pr", "sos")


@query("rank_fallback", """
    , t AS (SELECT season, wk, team, opp, game_id, CASE WHEN game_id % 3 = 0 THEN 0 WHEN game_id % 3 = 1 THEN 7 END AS pr_rank FROM team_rows),
    m AS (SELECT season, wk, team, CASE WHEN team % 2 = 0 THEN ty_pg_rank END AS r FROM ranked)
    SELECT t.game_id, t.team, coalesce(nullif(t.pr_rank, 0), m.r, k.pr_rank) AS pr_rank,
           nullif(t.pr_rank, 0) IS NULL AND coalesce(m.r, k.pr_rank) IS NOT NULL AS pr_rank_fixed,
           coalesce(mo.r, ko.pr_rank) AS opp_pr_rank, coalesce(mo.r, ko.pr_rank) IS NOT NULL AS opp_pr_rank_fixed
    FROM t LEFT JOIN m USING (season, wk, team) LEFT JOIN rated k USING (season, wk, team)
    LEFT JOIN m mo ON mo.season = t.season AND mo.wk = t.wk AND mo.team = t.opp
    LEFT JOIN rated ko ON ko.season = t.season AND ko.wk = t.wk AND ko.team = t.opp""", ["team_rows", "rated", "ranked"])
def rank_fallback(spark, sf):
    from ..plans.game_view import league_metrics
    from .teams import BY, team_rows

    rows = team_rows(spark, sf)
    k = F.col("game_id") % 3
    base = rows.select("game_id", "season", "wk", "team", "opp", F.when(k == 0, 0).when(k == 1, 7).alias("pr_rank"),
                       F.lit(None).cast("int").alias("opp_pr_rank"))
    metrics = league_metrics(rows, BY).select("season", "wk", "team", F.when(F.col("team") % 2 == 0, F.col("ty_pg_rank")).alias("pr_rank"))
    out = ratings.rank_fallback(base, [metrics, rated(spark, sf)], BY,
                                {"pr_rank": ("team", "pr_rank"), "opp_pr_rank": ("opp", "pr_rank")})
    return out.select("game_id", "team", "pr_rank", "pr_rank_fixed", "opp_pr_rank", "opp_pr_rank_fixed")
