"""Merges, backfill, quality gates and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import lines
from ..operators import deltas, joins, merge, nested, quality, quotes, ranks, teams
from ..plans import adapters as A, timelines
from ..session import scratch_dir, written
from ..streaming import jobs
from ..streaming.latest import LatestTable
from ..streaming.versions import VersionedTable
from ..streaming.weeks import OpenWeeks
from .registry import query
from .scalar import text_of
from .teams import BY, page_rated, rated


def week_rows(spark, sf) -> DataFrame:
    """Stored rows: scores missing on some games, lines blank on others, some games only in the rebuilt rows.

    Every game is in the stored or the rebuilt rows.
    """
    k = F.col("game_id")
    g = A.games(spark, sf).where((k % 9 != 4) | (k % 11 == 3))
    return g.select(
        "game_id", "season", "wk", "kickoff", F.when(k % 7 != 0, F.col("home_score")).alias("home_score"),
        F.when(k % 7 != 0, F.col("away_score")).alias("away_score"),
        F.when(k % 4 != 0, F.col("spread")).alias("spread_home_relative"),
        F.when(k % 6 == 0, " ").when(k % 6 < 4, "book1").alias("odds_source"),
        F.when(k % 10 == 0, F.lit(float("nan"))).when(k % 10 < 8, (k % 15).cast("double")).alias("rating_vs_odds"),
        F.struct(F.when(k % 3 == 0, F.struct(k.alias("id"))).alias("odds_row"), k.alias("schedule_row")).alias("raw_sources"))


def new_rows(spark, sf) -> DataFrame:
    """Rebuilt rows: all scores, other lines, one game in eleven absent."""
    k = F.col("game_id")
    g = A.games(spark, sf).where(k % 11 != 3)
    return g.select(
        "game_id", "season", "wk", "kickoff", "home_score", "away_score",
        F.when(k % 5 != 0, (k % 8).cast("double")).alias("spread_home_relative"), F.lit("book2").alias("odds_source"),
        F.when(k % 3 != 0, (k % 5).cast("double")).alias("rating_vs_odds"),
        F.struct(F.when(k % 2 == 0, F.struct((-k).alias("id"))).alias("odds_row"), (k + 1).alias("schedule_row")).alias("raw_sources"))


MERGE_SQL = """
    , old AS (SELECT game_id, season, wk, kickoff, CASE WHEN game_id % 7 <> 0 THEN home_score END AS home_score, CASE WHEN game_id % 7 <> 0 THEN away_score END AS away_score,
                     CASE WHEN game_id % 4 <> 0 THEN spread END AS sp, CASE WHEN game_id % 6 = 0 THEN ' ' WHEN game_id % 6 < 4 THEN 'book1' END AS src,
                     CASE WHEN game_id % 10 BETWEEN 1 AND 7 THEN CAST(game_id % 15 AS DOUBLE) END AS rvo, CASE WHEN game_id % 3 = 0 THEN game_id END AS oid, game_id AS sid
              FROM games WHERE game_id % 9 <> 4 OR game_id % 11 = 3),
    new AS (SELECT game_id, season, wk, kickoff, home_score, away_score, CASE WHEN game_id % 5 <> 0 THEN CAST(game_id % 8 AS DOUBLE) END AS sp, 'book2' AS src,
                   CASE WHEN game_id % 3 <> 0 THEN CAST(game_id % 5 AS DOUBLE) END AS rvo, CASE WHEN game_id % 2 = 0 THEN -game_id END AS oid, game_id + 1 AS sid
            FROM games WHERE game_id % 11 <> 3),
    merged AS (SELECT coalesce(o.game_id, n.game_id) AS game_id, o.game_id IS NOT NULL AS in_old,
                      CASE WHEN n.game_id IS NOT NULL THEN n.home_score ELSE o.home_score END AS home_score, coalesce(o.sp, n.sp) AS sp,
                      CASE WHEN n.game_id IS NULL OR trim(o.src) <> '' THEN o.src ELSE n.src END AS src, coalesce(o.rvo, n.rvo) AS rvo, o.sp AS osp, o.src AS osrc, o.rvo AS orvo,
                      coalesce(n.oid, o.oid) AS oid, coalesce(n.sid, o.sid) AS sid
               FROM old o FULL JOIN new n ON n.game_id = o.game_id)"""


PRESERVED_SQL = MERGE_SQL + """
    SELECT game_id, home_score, sp AS spread_home_relative, src AS odds_source, rvo AS rating_vs_odds, oid AS odds_id, sid AS schedule_id FROM merged"""


@query("merge_preserving_all", PRESERVED_SQL, ["games"])
@query("merge_preserving", PRESERVED_SQL, ["games"])
def merge_preserving(spark, sf):
    out = merge.merge_preserving(week_rows(spark, sf), new_rows(spark, sf), ["game_id"])
    return out.select("game_id", "home_score", "spread_home_relative", "odds_source",
                      F.nanvl("rating_vs_odds", F.lit(None).cast("double")).alias("rating_vs_odds"),
                      F.col("raw_sources.odds_row.id").alias("odds_id"), F.col("raw_sources.schedule_row").alias("schedule_id"))


PRESERVATION_SQL = MERGE_SQL + """
    SELECT count(*) FILTER (WHERE in_old AND (osp IS NOT NULL OR trim(osrc) <> '') AND (osp IS NULL OR sp = osp)
               AND (coalesce(trim(osrc), '') = '' OR src = osrc)) AS preserved_odds,
           count(*) FILTER (WHERE in_old AND orvo IS NOT NULL AND rvo = orvo) AS preserved_rvo FROM merged"""


@query("preservation_all", PRESERVATION_SQL, ["games"])
@query("preservation", PRESERVATION_SQL, ["games"])
def preservation(spark, sf):
    old = week_rows(spark, sf)
    return merge.preservation(old, merge.merge_preserving(old, new_rows(spark, sf), ["game_id"]), ["game_id"])


DIFF_ROWS_SQL = MERGE_SQL + """
    SELECT CASE WHEN n.game_id IS NULL THEN 'left_only' WHEN o.game_id IS NULL THEN 'right_only'
                WHEN o.home_score IS NOT DISTINCT FROM n.home_score AND o.away_score IS NOT DISTINCT FROM n.away_score AND o.sp IS NOT DISTINCT FROM n.sp
                THEN 'equal' ELSE 'mismatched' END AS status, count(*) AS n
    FROM old o FULL JOIN new n ON n.game_id = o.game_id GROUP BY 1"""


@query("diff_rows_all", DIFF_ROWS_SQL, ["games"])
@query("diff_rows", DIFF_ROWS_SQL, ["games"])
def diff_rows(spark, sf):
    return merge.diff_rows(week_rows(spark, sf), new_rows(spark, sf), ["game_id"],
                           ignore=("odds_source", "rating_vs_odds", "raw_sources"))


@query("diff_samples", MERGE_SQL + """
    SELECT o.game_id, array_to_string(list_filter([CASE WHEN o.home_score IS DISTINCT FROM n.home_score THEN 'home_score' END,
           CASE WHEN o.sp IS DISTINCT FROM n.sp THEN 'spread_home_relative' END], lambda x: x IS NOT NULL), ',') AS changed
    FROM old o JOIN new n ON n.game_id = o.game_id
    WHERE o.home_score IS DISTINCT FROM n.home_score OR o.sp IS DISTINCT FROM n.sp ORDER BY o.game_id LIMIT 10""", ["games"])
def diff_samples(spark, sf):
    flags = merge.diff_flags(week_rows(spark, sf), new_rows(spark, sf), ["game_id"], ["home_score", "spread_home_relative"])
    # A report of ten samples: the limit is the feature.
    return (flags.where("status = 'mismatched'").select("game_id", F.array_join("changed", ",").alias("changed"))
            .orderBy("game_id").limit(10))


@query("bag_difference", """
    , a AS (SELECT game_id, market, book, CASE WHEN part % 7 <> 0 THEN qty END AS qty FROM odds),
    b AS (SELECT game_id, market, book, CASE WHEN part % 7 <> 0 THEN qty END AS qty FROM odds WHERE line_no <> 3
          UNION ALL SELECT game_id, market, book, CASE WHEN part % 7 <> 0 THEN qty END FROM odds WHERE line_no = 2)
    SELECT game_id, market, book, qty, CAST(sum(l) AS BIGINT) AS only_left, CAST(sum(r) AS BIGINT) AS only_right FROM (
        SELECT *, 1 AS l, 0 AS r FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
        UNION ALL SELECT *, 0, 1 FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)) GROUP BY ALL""", ["odds"])
def bag_difference(spark, sf):
    """All quotes against those without third lines and with second lines twice."""
    qty = F.when(F.col("part") % 7 != 0, F.col("qty")).alias("qty")
    q, columns = A.odds(spark, sf), ["game_id", "market", "book", "qty"]
    rows = lambda df: df.select("game_id", "market", "book", qty)
    return merge.bag_difference(rows(q), rows(q.where("line_no <> 3")).unionAll(rows(q.where("line_no = 2"))), columns)


UPSERT_KEEP_BEST_SQL = """
    , m AS (SELECT game_id, season, wk, CASE WHEN game_id % 4 <> 0 THEN home_score END AS home_score, 'old' AS source FROM games WHERE game_id % 5 <> 1 OR game_id % 6 = 2),
    n AS (SELECT game_id, season, wk, CASE WHEN game_id % 3 <> 0 THEN home_score END AS home_score, CASE game_id % 2 WHEN 0 THEN 'feed' ELSE 'manual' END AS source FROM games WHERE game_id % 6 <> 2),
    u AS (SELECT *, 0 AS is_new FROM m UNION ALL SELECT *, 1 FROM n)
    SELECT game_id, season, wk, home_score, source FROM (SELECT *, row_number() OVER (PARTITION BY season, wk, game_id
        ORDER BY CASE WHEN home_score IS NOT NULL THEN 0 ELSE 1 END, CASE source WHEN 'manual' THEN 1 ELSE 2 END, is_new DESC) AS rn FROM u) WHERE rn = 1"""


@query("upsert_keep_best_all", UPSERT_KEEP_BEST_SQL, ["games"])
@query("upsert_keep_best", UPSERT_KEEP_BEST_SQL, ["games"])
def upsert_keep_best(spark, sf):
    g, k = A.games(spark, sf), F.col("game_id")
    old = g.where((k % 5 != 1) | (k % 6 == 2)).select("game_id", "season", "wk", F.when(k % 4 != 0, F.col("home_score")).alias("home_score"), F.lit("old").alias("source"))
    new = g.where(k % 6 != 2).select("game_id", "season", "wk", F.when(k % 3 != 0, F.col("home_score")).alias("home_score"),
                                     F.when(k % 2 == 0, "feed").otherwise("manual").alias("source"))
    return ranks.upsert_keep_best(old, new, ["season", "wk", "game_id"], F.col("home_score").isNotNull(),
                                  F.when(F.col("source") == "manual", 1).otherwise(2), ["source"])


@query("backfill_scores", MERGE_SQL + """
    , cur AS (SELECT season, max(wk) AS wk FROM games GROUP BY season)
    SELECT o.game_id, CASE WHEN (o.home_score IS NULL OR o.away_score IS NULL) AND f.game_id IS NOT NULL THEN f.home_score ELSE o.home_score END AS home_score,
           CASE WHEN o.home_score IS NULL OR o.away_score IS NULL THEN CASE WHEN f.game_id IS NOT NULL THEN 'updated' ELSE 'skipped' END ELSE 'kept' END AS score_status
    FROM old o JOIN cur c USING (season) LEFT JOIN (SELECT * FROM games WHERE home_score IS NOT NULL AND away_score IS NOT NULL) f ON f.game_id = o.game_id
    WHERE o.wk < c.wk AND o.wk >= c.wk - 20""", ["games"])
def backfill_scores(spark, sf):
    g = A.games(spark, sf)
    current = g.groupBy("season").agg(F.max("wk").alias("wk"))
    out = merge.backfill_scores(week_rows(spark, sf), g, current, BY, ["game_id"], weeks_back=20)
    return out.select("game_id", "home_score", "score_status")


def _summed(flag: str) -> str:
    return ", ".join(f"CAST(coalesce(sum(CASE WHEN {flag} THEN {f} ELSE 0 END) OVER p, 0) AS BIGINT) AS {f}_before" for f in FLAGS)


FLAGS = ["w", "l", "t", "ats_w", "ats_l", "ats_p"]


@query("backfill_records", f"""
    , cur AS (SELECT season, max(wk) AS wk FROM games GROUP BY season),
    f AS (SELECT x.*, game_id % 7 <> 0 AS stored, game_id % 7 <> 0 OR (x.wk < c.wk AND x.wk >= c.wk - 2) AS known FROM flags x JOIN cur c USING (season)),
    old AS (SELECT game_id, team, {_summed("stored")} FROM f
            WINDOW p AS (PARTITION BY season, team ORDER BY epoch_us(kickoff) RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    new AS (SELECT game_id, season, team, {_summed("known")} FROM f
            WINDOW p AS (PARTITION BY season, team ORDER BY epoch_us(kickoff) RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    SELECT n.*, {" OR ".join(f"n.{f}_before <> o.{f}_before" for f in FLAGS)} AS changed FROM new n JOIN old o USING (game_id, team)""", ["flags"])
def backfill_records(spark, sf):
    """Scores of every seventh game are missing; those of the two weeks before a season's last one come in late."""
    g = A.games(spark, sf)
    late = F.col("game_id") % 7 == 0
    stored = g.withColumns({c: F.when(~late, F.col(c)) for c in ("home_score", "away_score")})
    root = scratch_dir(spark, "records")
    rows = teams.to_team_rows(stored, ["game_id", "season", "kickoff"])
    teams.record_before(rows, BY).select("game_id", "season", "team", "kickoff", *[f"{f}_before" for f in FLAGS]).write.partitionBy(
        "season").parquet(root)
    records = spark.read.parquet(root)
    current = g.groupBy("season").agg(F.max("wk").alias("wk"))
    filled = merge.backfill_scores(stored, g, current, BY, ["game_id"], weeks_back=2).where("score_status = 'updated'").drop("score_status")
    changes = deltas.record_changes(stored.join(filled.select("game_id"), "game_id", "left_semi"), filled, BY)
    updates = deltas.updated_records(records, changes, BY)
    return deltas.patched(records, updates, ["game_id", "team"]).drop("kickoff")


@query("backfill_ats", """
    , closing AS (SELECT * FROM (SELECT game_id, book, spread_home_relative AS line, row_number() OVER (PARTITION BY game_id ORDER BY fetch_ts DESC, book, line_no, part, supp, cents) AS rn
                  FROM per_book WHERE early AND market = 'spreads') WHERE rn = 1)
    SELECT f.game_id, f.team, f.book, f.stored IS NULL AND f.cover IS NOT NULL AS filled,
           coalesce(f.stored, CASE WHEN f.cover > 0 THEN 'W' WHEN f.cover < 0 THEN 'L' WHEN f.cover = 0 THEN 'P' END) AS ats,
           CASE WHEN f.stored IS NULL THEN CASE WHEN f.cover > 0 THEN '1-0-0' WHEN f.cover < 0 THEN '0-1-0' WHEN f.cover = 0 THEN '0-0-1' END END AS first_record
    FROM (SELECT t.game_id, t.team, c.book, CASE WHEN t.game_id % 3 = 0 THEN 'W' END AS stored, t.margin + CASE WHEN t.site = 'H' THEN c.line ELSE -c.line END AS cover
          FROM team_rows t LEFT JOIN closing c USING (game_id)) f""", ["per_book", "team_rows"])
def backfill_ats(spark, sf):
    from ..plans.backfill import backfill_ats as run

    g = A.games(spark, sf)
    closing = quotes.closing_line(g, [("pinned", A.lines(spark, sf).where("market = 'spreads'"))], ties=A.QUOTE_TIES)
    stored = F.when(F.col("game_id") % 3 == 0, "W")
    out = run(g.withColumns({"home_ats": stored, "away_ats": stored}), closing)
    return out.select("game_id", "team", "book", "filled", "ats", "first_record")


@query("backfill_timeline", """
    , closing AS (SELECT * FROM (SELECT game_id, spread_home_relative AS line, row_number() OVER (PARTITION BY game_id ORDER BY fetch_ts DESC, book, line_no, part, supp, cents) AS rn
                  FROM per_book WHERE early AND market = 'spreads') WHERE rn = 1),
    f AS (SELECT t.season, t.team, CASE WHEN t.game_id % 3 = 0 THEN 'W' END AS stored, t.margin + CASE WHEN t.site = 'H' THEN c.line ELSE -c.line END AS cover
          FROM team_rows t LEFT JOIN closing c USING (game_id)),
    e AS (SELECT season, team, coalesce(stored, CASE WHEN cover > 0 THEN 'W' WHEN cover < 0 THEN 'L' WHEN cover = 0 THEN 'P' END) AS ats,
                 CASE WHEN stored IS NOT NULL THEN 1.5 ELSE cover END AS m, stored IS NULL AND cover IS NOT NULL AS filled FROM f),
    r AS (SELECT season, team, count(*) FILTER (WHERE ats = 'W') AS w, count(*) FILTER (WHERE ats = 'L') AS l, count(*) FILTER (WHERE ats = 'P') AS p, count(*) AS games,
                 CAST(coalesce(sum(m), 0) AS DOUBLE) AS margin_sum, count(m) AS margin_n, count(*) FILTER (WHERE filled) AS filled FROM e GROUP BY season, team)
    SELECT season, team, w, l, p, games, margin_sum, margin_n, w || '-' || l || '-' || p AS record, filled FROM r""", ["per_book", "team_rows"])
def backfill_timeline(spark, sf):
    """Outcome of the closing line, entry of the timeline, record of the team: stored entries of every third game are not blank."""
    from ..plans.backfill import backfill_ats as run

    g = A.games(spark, sf)
    stored = F.when(F.col("game_id") % 3 == 0, "W")
    rows = teams.to_team_rows(g, ["game_id", "season", "wk", "kickoff"]).withColumns(
        {"ats": stored, "to_margin": F.when(F.col("game_id") % 3 == 0, 1.5)})
    chunks = written(timelines.timeline_chunks(rows, BY, ["opp", "pf", "pa", "ats", "to_margin"]), "chunks")
    index = written(timelines.chunk_index(chunks, BY), "chunk-index")
    closing = quotes.closing_line(g, [("pinned", A.lines(spark, sf).where("market = 'spreads'"))], ties=A.QUOTE_TIES)
    outcomes = run(g.withColumns({"home_ats": stored, "away_ats": stored}), closing).where("filled")
    patched = timelines.patch_chunks(chunks, index, outcomes, BY)
    filled = F.size(F.filter("entries", lambda e: e["ats"].isNotNull() & (e["tie"] % 3 != 0)))
    counts = patched.groupBy("season", "team").agg(F.sum(filled).alias("filled"))
    return timelines.chunk_records(patched, BY).join(counts, ["season", "team"])


@query("key_setops", """
    SELECT coalesce(a.game_id, b.game_id) AS game_id, CASE WHEN b.game_id IS NULL THEN 'left_only' WHEN a.game_id IS NULL THEN 'right_only' ELSE 'both' END AS found
    FROM (SELECT DISTINCT game_id FROM games WHERE spread IS NOT NULL) a FULL JOIN (SELECT DISTINCT game_id FROM odds) b ON a.game_id = b.game_id""", ["games", "odds"])
def key_setops(spark, sf):
    return quality.key_setops(A.games(spark, sf).where("spread IS NOT NULL"), A.odds(spark, sf), ["game_id"])


@query("coverage", """
    , c AS (SELECT season, count(*) AS rows, count(spread) AS s, count(home_score) AS h, count(*) FILTER (WHERE neutral) AS n FROM games GROUP BY season)
    SELECT season, rows, 'spread' AS rule, s AS covered, CAST(s AS DOUBLE) / rows AS fraction, CAST(s AS DOUBLE) / rows >= 0.6 AS passed FROM c
    UNION ALL SELECT season, rows, 'score', h, CAST(h AS DOUBLE) / rows, CAST(h AS DOUBLE) / rows >= 0.67 FROM c
    UNION ALL SELECT season, rows, 'neutral', n, CAST(n AS DOUBLE) / rows, CAST(n AS DOUBLE) / rows >= 0.9 FROM c""", ["games"])
def coverage(spark, sf):
    return quality.coverage(A.games(spark, sf), {
        "spread": (F.col("spread").isNotNull(), 0.6), "score": (F.col("home_score").isNotNull(), 0.67),
        "neutral": (F.col("neutral"), 0.9)}, ["season"])


@query("validate_ratings", """
    SELECT team // 64 AS league, season, wk, count(*) AS rows, count(*) BETWEEN 20 AND 64 AS count_ok,
           min(r) = 1 AND max(r) = count(*) AND count(DISTINCT r) = count(*) AS ranks_ok, count(DISTINCT team) = count(*) AS names_ok,
           count(*) FILTER (WHERE team % 50 = 0 AND wk % 4 = 0) = 0 AS precision_ok,
           count(*) FILTER (WHERE team % 9 <> 0) = 0 OR count(*) FILTER (WHERE team % 9 <> 0) >= 0.9 * count(*) AS strength_ok
    FROM (SELECT *, CASE WHEN wk % 5 = 0 AND pr_rank = 2 THEN 1 ELSE pr_rank END AS r FROM page_rated) GROUP BY ALL""", ["page_rated"])
def validate_ratings(spark, sf):
    r = page_rated(spark, sf)
    spoiled = r.select(
        A.league_of().alias("league"), "season", "wk", "team", "sos_rank", F.when((F.col("wk") % 5 == 0) & (F.col("pr_rank") == 2), 1).otherwise(F.col("pr_rank")).alias("pr_rank"),
        F.when((F.col("team") % 50 == 0) & (F.col("wk") % 4 == 0), F.col("pr") + 0.125).otherwise(F.col("pr")).alias("pr"),
        F.when(F.col("team") % 9 != 0, F.col("sos")).alias("sos"))
    return quality.validate_ratings(spoiled, ["league", "season", "wk"], 20, 64)


@query("range_checks", """
    SELECT count(*) AS rows, count(*) FILTER (WHERE pr_rank NOT BETWEEN 1 AND 32) AS pr_rank_out, count(*) FILTER (WHERE sos NOT BETWEEN 1 AND 2) AS sos_out,
           count(*) FILTER (WHERE team % 7 = 0) AS edge_nonfinite FROM rated""", ["rated"])
def range_checks(spark, sf):
    edge = F.when(F.col("team") % 14 == 0, F.lit(float("inf"))).when(F.col("team") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("pr"))
    return quality.range_checks(rated(spark, sf).withColumn("edge", edge), {"pr_rank": (1, 32), "sos": (1, 2)}, ["edge"])


@query("gaps", MERGE_SQL + """
    SELECT game_id, 'missing' AS gap, 3 AS blank_fields FROM games WHERE game_id NOT IN (SELECT game_id FROM old)
    UNION ALL SELECT game_id, 'blank', b FROM (SELECT game_id, CAST(sp IS NULL AS INTEGER) + CAST(coalesce(trim(src), '') = '' AS INTEGER) + CAST(rvo IS NULL AS INTEGER) AS b FROM old) WHERE b > 0""", ["games"])
def gaps(spark, sf):
    return quality.gaps(week_rows(spark, sf), A.games(spark, sf), ["game_id"], ["spread_home_relative", "odds_source", "rating_vs_odds"])


@query("join_audit", """
    SELECT season, wk, count(*) AS rows, count(spread) AS with_spread, count(home_score) AS with_total,
           count(*) FILTER (WHERE spread IS NOT NULL AND home_score IS NOT NULL) AS with_both, count(spread) AS with_favored,
           count(*) FILTER (WHERE spread IS NOT NULL AND home_score IS NOT NULL) AS with_edge FROM games GROUP BY season, wk""", ["games"])
def join_audit(spark, sf):
    g = A.games(spark, sf).withColumns({
        "total": F.col("home_score") + F.col("away_score"), "favored_side": lines.favored_side("spread"),
        "rating_vs_odds": F.col("home_score") + F.col("spread")})
    return quality.join_audit(g, ["season", "wk"])


@query("needs_repair", """
    SELECT season, wk, bool_or(spread IS NULL AND home_score IS NULL) AS needs_repair FROM games GROUP BY season, wk""", ["games"])
def needs_repair(spark, sf):
    g = A.games(spark, sf).select("season", "wk", F.col("spread").alias("spread_favored_team"), F.col("home_score").alias("rating_vs_odds"))
    return quality.needs_repair(g, ["season", "wk"])


@query("content_hash", """
    SELECT count(*) AS left_rows, count(*) AS right_rows, true AS equal FROM games""", ["games"])
def content_hash(spark, sf):
    g = A.games(spark, sf).drop("kickoff")
    # The same rows in another order, with a field that changes on every run.
    other = g.repartition(13, "home_id").withColumn("fetched_at", F.current_timestamp())
    return quality.content_equal(g.withColumn("fetched_at", F.lit(None).cast("timestamp")), other, ignore=("fetched_at",))


def file_stream(spark, sf, name: str) -> DataFrame:
    """One driver table as a file stream."""
    schema = spark.read.parquet(f"{sf}/{name}.parquet").schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf)
    return A.utc_columns(raw)


def stream_quotes(spark, sf) -> DataFrame:
    li = file_stream(spark, sf, "lineitem")
    return A.odds_columns(li)


@query("stream_odds", """
    SELECT game_id, market, book, strftime(fetch_ts, '%Y-%m-%d %H:%M:%S') AS fetch_ts, line_no, part, cents FROM (
        SELECT *, row_number() OVER (PARTITION BY game_id, market, book ORDER BY fetch_ts DESC, line_no, part, supp, cents) AS rn FROM odds)
    WHERE rn = 1""", ["odds"])
def stream_odds(spark, sf):
    root = scratch_dir(spark, "stream_odds")
    A.tune(spark)
    table = LatestTable(f"{root}/table", ["game_id", "market", "book"], "fetch_ts", A.QUOTE_TIES)
    jobs.stream_odds(stream_quotes(spark, sf), table, f"{root}/checkpoint")
    return table.read(spark).select("game_id", "market", "book", text_of("fetch_ts").alias("fetch_ts"), "line_no", "part", "cents")


@query("stream_quotes", """
    SELECT game_id, market, book, strftime(fetch_ts, '%Y-%m-%d %H:%M:%S') AS fetch_ts, qty, price, line_no, part, supp, cents FROM (
        SELECT *, row_number() OVER (PARTITION BY game_id, market, book ORDER BY fetch_ts DESC, line_no, part, supp, cents) AS rn FROM odds)
    WHERE rn = 1""", ["odds"])
def stream_quotes_compact(spark, sf):
    """Quotes arrive in five files by their line number, the first of them twice; each run continues the one before."""
    root, quotes_in = scratch_dir(spark, "stream_quotes"), A.odds(spark, sf)
    table = VersionedTable(f"{root}/table", ["game_id", "market", "book"], "fetch_ts", A.QUOTE_TIES, every=3)
    for chunk in (0, 1, 0, 2, 3, 4):
        quotes_in.where(F.col("line_no") % 5 == chunk).write.mode("append").parquet(f"{root}/feed")
        feed = spark.readStream.schema(quotes_in.schema).parquet(f"{root}/feed")
        jobs.stream_quotes(feed.select("*", F.col("_metadata.file_modification_time").alias("arrived_at")), table, f"{root}/checkpoint", "arrived_at")
    return table.read(spark).withColumn("fetch_ts", text_of("fetch_ts"))


WEEK_COUNTS = """
    SELECT strftime(time_bucket(INTERVAL 7 DAY, fetch_ts, TIMESTAMP '2000-01-04'), '%Y-%m-%d %H:%M:%S') AS week_start, market, book, count(*) AS n
    FROM odds GROUP BY 1, 2, 3"""


@query("week_window_counts", WEEK_COUNTS, ["odds"])
def week_window_counts(spark, sf):
    out = jobs.week_window_counts(A.odds(spark, sf), "fetch_ts", ["market", "book"])
    return out.withColumn("week_start", text_of("week_start"))


@query("stream_week_windows", WEEK_COUNTS, ["odds"])
def stream_week_windows(spark, sf):
    root = scratch_dir(spark, "stream_weeks")
    A.tune(spark)
    jobs.stream_week_windows(stream_quotes(spark, sf), "fetch_ts", ["market", "book"], f"{root}/table", f"{root}/checkpoint")
    return jobs.read_week_windows(spark, f"{root}/table", ["market", "book"]).withColumn("week_start", text_of("week_start"))


def stream_games(spark, sf) -> DataFrame:
    return A.games_columns(file_stream(spark, sf, "orders"))


@query("stream_pin", """
    , cand AS (
        SELECT f.event_id, g.game_id, f.home <> g.home_id AS swapped, abs(epoch(g.kickoff) - epoch(f.event_ts)) AS delta
        FROM feed f JOIN games g ON (f.home = g.home_id AND f.away = g.away_id) OR (f.home = g.away_id AND f.away = g.home_id)
        WHERE abs(epoch(g.kickoff) - epoch(f.event_ts)) <= 36 * 3600),
    best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY swapped, delta, game_id) AS rn,
                    count(*) OVER (PARTITION BY event_id, swapped, delta) AS ties FROM cand) WHERE rn = 1)
    SELECT f.event_id, CASE WHEN ties = 1 THEN game_id END AS game_id, coalesce(ties, 0) = 1 AS is_pinned,
           CASE WHEN game_id IS NULL THEN 'no_candidate' WHEN ties > 1 THEN 'ambiguous' END AS why
    FROM feed f LEFT JOIN best USING (event_id)""", ["feed", "games"])
def stream_pin(spark, sf):
    root = scratch_dir(spark, "stream_pin")
    games = A.games(spark, sf)
    jobs.stream_pin(A.feed(stream_games(spark, sf)), games, f"{root}/table", f"{root}/checkpoint")
    rows = spark.read.option("basePath", f"{root}/table").parquet(f"{root}/table/batch_id=*")
    return rows.select("event_id", "game_id", F.col("is_pinned").cast("boolean").alias("is_pinned"), "why")


@query("late_scores", """
    , finals AS (SELECT game_id, home_score, away_score, kickoff, kickoff + to_days(CAST(game_id % 40 AS INTEGER)) AS reported_at FROM games WHERE home_score IS NOT NULL)
    SELECT game_id, home_score, away_score, kickoff < date_trunc('week', reported_at - INTERVAL 1 DAY) + INTERVAL 1 DAY - INTERVAL 14 DAY AS is_late FROM finals""", ["games"])
def late_scores(spark, sf):
    root = scratch_dir(spark, "late_scores")
    A.tune(spark)
    finals = stream_games(spark, sf).where("home_score IS NOT NULL").select(
        "game_id", "home_score", "away_score", "kickoff",
        (F.col("kickoff") + F.make_dt_interval(days=(F.col("game_id") % 40).cast("int"))).alias("reported_at"))
    jobs.stream_late_scores(finals, root, f"{root}/checkpoint", ["game_id"])
    on_time = LatestTable(f"{root}/on_time", ["game_id"], "reported_at", []).read(spark).withColumn("is_late", F.lit(False))
    late = spark.read.option("basePath", f"{root}/late").parquet(f"{root}/late/batch_id=*").withColumn("is_late", F.lit(True))
    cols = ["game_id", "home_score", "away_score", "is_late"]
    return on_time.select(*cols).unionByName(late.select(*cols))


@query("late_finals", """
    , finals AS (SELECT game_id, home_score, away_score, kickoff, kickoff + to_days(CAST(game_id % 40 AS INTEGER)) AS reported_at FROM games WHERE home_score IS NOT NULL),
    chunks AS (SELECT year(reported_at) AS chunk, max(kickoff) AS newest FROM finals GROUP BY 1),
    marks AS (SELECT chunk, max(newest) OVER (ORDER BY chunk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 14 DAY AS mark FROM chunks)
    SELECT game_id, home_score, away_score, coalesce(kickoff < mark, false) AS is_late,
           NOT coalesce(kickoff < mark, false) AND coalesce(time_bucket(INTERVAL 7 DAY, kickoff, TIMESTAMP '2000-01-04') + INTERVAL 7 DAY
               <= (SELECT max(mark) FROM marks), false) AS is_closed
    FROM finals JOIN marks ON chunk = year(reported_at)""", ["games"])
def late_finals(spark, sf):
    """The finals reported in a year arrive together; each run continues the one before."""
    root = scratch_dir(spark, "late_finals")
    finals = A.games(spark, sf).where("home_score IS NOT NULL").select(
        "game_id", "home_score", "away_score", "kickoff",
        (F.col("kickoff") + F.make_dt_interval(days=(F.col("game_id") % 40).cast("int"))).alias("reported_at"))
    weeks, year = OpenWeeks(root, ["game_id"]), F.year("reported_at")
    for chunk in [r[0] for r in finals.select(year.alias("y")).distinct().orderBy("y").collect()]:
        finals.where(year == chunk).write.mode("append").parquet(f"{root}/feed")
        jobs.stream_finals(spark.readStream.schema(finals.schema).parquet(f"{root}/feed"), weeks, f"{root}/checkpoint")
    cols = ["game_id", "home_score", "away_score", "is_late", "is_closed"]
    late = weeks.late(spark).withColumns({"is_late": F.lit(True), "is_closed": F.lit(False)})
    return weeks.read(spark).withColumn("is_late", F.lit(False)).select(*cols).unionByName(late.select(*cols))
