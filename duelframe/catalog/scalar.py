"""Sources and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import lines, names, numbers, times
from ..operators import nested
from ..plans import adapters as A
from ..session import scratch_dir
from ..sources import files
from .registry import query, stamp

STAMP = "yyyy-MM-dd HH:mm:ss"


def text_of(ts) -> F.Column:
    return F.date_format(ts, STAMP)


@query("scan_games", f"""
    SELECT game_id, season, wk, game_type, {stamp('kickoff')} AS kickoff, home_id, away_id, home_score, away_score, spread
    FROM games WHERE season = 1998""", ["games"])
def scan_games(spark, sf):
    path = scratch_dir(spark, "schedule")
    cols = ["game_id", "season", "wk", "game_type", "kickoff", "home_id", "away_id", "home_score", "away_score", "spread"]
    (A.games(spark, sf).select(*cols).write.option("header", True)
     .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss'Z'").csv(path))
    return files.read_schedule(spark, path, 1998).withColumn("kickoff", text_of("kickoff"))


@query("week_filter", """
    SELECT game_id, season, wk, home_id, away_id FROM games
    WHERE (game_type = 'REG' OR game_type IS NULL) AND home_score IS NOT NULL AND away_score IS NOT NULL""", ["games"])
def week_filter(spark, sf):
    return files.week_filter(A.games(spark, sf), or_missing=True, scored=True).select(
        "game_id", "season", "wk", "home_id", "away_id")


@query("json_props", """
    SELECT event_id, CAST(props ->> '$.k' AS INTEGER) AS k FROM events
    WHERE trim(CASE WHEN event_id % 9 = 0 THEN ' ' WHEN event_id % 10 = 0 THEN '{"k": ' ELSE props END) <> ''
      AND NOT (event_id % 9 <> 0 AND event_id % 10 = 0)""")
def json_props(spark, sf):
    e = A.table(spark, sf, "events")
    # Every ninth line is blank and some are cut off.
    line = F.when(F.col("event_id") % 9 == 0, " ").when(F.col("event_id") % 10 == 0, '{"k": ').otherwise(F.col("props"))
    return files.parse_jsonl(e.select("event_id", line.alias("value")), "value", "k INT", ["event_id"])


@query("nonfinite_to_null", """
    SELECT event_id, CASE WHEN event_id % 7 = 0 OR event_id % 11 = 0 OR event_id % 13 = 0 THEN NULL ELSE value END AS v
    FROM events""")
def nonfinite_to_null(spark, sf):
    e = A.table(spark, sf, "events")
    shown = (F.when(F.col("event_id") % 7 == 0, "NaN").when(F.col("event_id") % 11 == 0, "Infinity")
             .when(F.col("event_id") % 13 == 0, "-Infinity").otherwise(F.col("value").cast("string")))
    lines_ = e.select("event_id", F.concat(F.lit('{"v": '), shown, F.lit("}")).alias("value"))
    return files.nonfinite_to_null(files.parse_jsonl(lines_, "value", "v DOUBLE", ["event_id"]))


@query("week_partitions", """
    SELECT game_id, season, wk, home_id, away_id FROM games WHERE season = (SELECT max(season) FROM games)""", ["games"])
def week_partitions(spark, sf):
    root = scratch_dir(spark, "weeks")
    g = A.games(spark, sf).select("game_id", "home_id", "away_id",
                                  F.format_string("%d_week%d", "season", "wk").alias("folder"))
    g.hint("rebalance", F.col("folder")).write.partitionBy("folder").parquet(root)
    return files.read_week_partitions(spark, root).select("game_id", "season", "wk", "home_id", "away_id")


@query("odds_xml", """
    SELECT game_id, line_no, part, supp, cents, 'T' || supp AS home_raw, 'P' || part AS away_raw,
           CAST(line_no AS INTEGER) AS rotation_home, CASE WHEN line_no % 2 = 0 THEN (qty - 25) / 2 ELSE -((qty - 20) / 2) END
           AS spread_home_relative, qty + 20 AS total, CAST(price % 400 AS INTEGER) AS moneyline_home, true AS is_closing
    FROM odds""", ["odds"])
def odds_xml(spark, sf):
    q = A.odds(spark, sf)
    def tag(name: str, body) -> F.Column:
        return F.concat(F.lit(f"<{name}>"), body, F.lit(f"</{name}>"))
    def num(c) -> F.Column:
        return c.cast("string")
    spread = F.when(F.col("line_no") % 2 == 0, tag("home", num((F.col("qty") - 25) / 2))).otherwise(
        tag("away", num((F.col("qty") - 20) / 2)))
    xml = tag("event", F.concat(
        tag("home_team", F.concat(F.lit("T"), num(F.col("supp")))), tag("away_team", F.concat(F.lit("P"), num(F.col("part")))),
        tag("rotation", tag("home", num(F.col("line_no")))), tag("spread", spread),
        tag("total", tag("points", num(F.col("qty") + 20))),
        tag("moneyline", tag("home", num(F.col("price") % 400)))))
    parsed = files.parse_odds_xml(q.withColumn("xml", xml), "xml", ["game_id", *A.QUOTE_TIES], "close")
    return parsed.select("game_id", *A.QUOTE_TIES, "home_raw", "away_raw", "rotation_home", "spread_home_relative",
                         "total", "moneyline_home", "is_closing")


@query("page_tables", """
    SELECT p_partkey, CASE r.i WHEN 0 THEN p_brand ELSE p_type END AS label,
           CASE p_partkey % 3 WHEN 0 THEN '1999' WHEN 1 THEN '2001' ELSE 'Rank' END AS "column",
           CAST(CASE r.i WHEN 0 THEN CASE p_partkey % 3 WHEN 0 THEN p_size WHEN 1 THEN p_size + 2 ELSE p_size END
                ELSE CASE p_partkey % 3 WHEN 0 THEN p_size + 1 WHEN 1 THEN p_size + 3 ELSE p_size + 1 END END AS DOUBLE) AS value
    FROM part, (VALUES (0), (1)) AS r(i)""")
def page_tables(spark, sf):
    p = A.table(spark, sf, "part")
    kind = F.col("p_partkey") % 3
    # Third kind of page: no year column, so the first numeric column counts.
    head = F.when(kind == 2, "<tr><th>Team</th><th>Note</th><th>Rank</th></tr>").otherwise(
        "<tr><th>Team</th><th>1999</th><th>2001</th></tr>")
    def row(name, a, b) -> F.Column:
        return F.concat(F.lit("<tr><td><b>"), name, F.lit("</b>*</td><td>"), a, F.lit("</td><td> "), b, F.lit("</td></tr>"))
    size = F.col("p_size")
    def num(c):
        return c.cast("string")
    rows = F.concat(
        row(F.col("p_brand"), F.when(kind == 2, "n").otherwise(num(size)),
            F.when(kind == 2, num(size)).otherwise(num(size + 2))),
        row(F.col("p_type"), F.when(kind == 2, "m").otherwise(num(size + 1)),
            F.when(kind == 2, num(size + 1)).otherwise(num(size + 3))))
    page = F.concat(F.lit("<html><table></table><table class='x'>"), head, rows, F.lit("</table></html>"))
    season = F.when(kind == 0, 1999)
    return nested.extract_html_tables(p.withColumn("html", page), ["p_partkey"], "html", season)


@query("page_links", """
    SELECT page_id, CAST(unnest(regexp_extract_all(html, '(?i)<a\\s[^>]*?href="([^"]*)"', 1)) AS VARCHAR) AS link FROM pages""")
def page_links(spark, sf):
    return A.table(spark, sf, "pages").select("page_id", F.explode(nested.page_links("html")).alias("link"))


@query("week_sink", """
    SELECT season, wk, count(*) AS games, CAST(sum(home_id * 7 + away_id) AS BIGINT) AS side_sum,
           count(spread) AS lined FROM games GROUP BY season, wk""", ["games"])
def week_sink(spark, sf):
    path = scratch_dir(spark, "week_sink")
    g = A.games(spark, sf).select("game_id", "season", "wk", "kickoff", "home_id", "away_id", "spread")
    files.write_week(g, path, "parquet")
    # A second write of one season replaces only that season's weeks.
    files.write_week(g.where("season = 1998"), path, "parquet")
    return spark.read.parquet(path).groupBy("season", "wk").agg(
        F.count(F.lit(1)).alias("games"), F.sum(F.col("home_id") * 7 + F.col("away_id")).alias("side_sum"),
        F.count("spread").alias("lined"))


@query("staging_append", """
    SELECT market, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents FROM odds GROUP BY market""", ["odds"])
def staging_append(spark, sf):
    path = scratch_dir(spark, "staging")
    q = A.odds(spark, sf)
    files.append_staging(q.where("book = 'A'"), path, ("market",))
    files.append_staging(q.where("book <> 'A'"), path, ("market",))
    return spark.read.parquet(path).groupBy("market").agg(F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents"))


@query("align_union", """
    SELECT game_id, season, wk, spread, NULL::DOUBLE AS total FROM games
    UNION ALL SELECT game_id, NULL, NULL, NULL, total_points FROM lines WHERE total_points IS NOT NULL""", ["games", "lines"])
def align_union(spark, sf):
    g = A.games(spark, sf).select("game_id", "season", "wk", "spread")
    t = A.lines(spark, sf).where("total_points IS NOT NULL").select(F.col("total_points").alias("total"), "game_id")
    return files.align_union(g, t)


@query("tolerant_cast", """
    SELECT game_id, line_no, part, supp, cents,
           CASE part % 5 WHEN 0 THEN CAST(price AS DOUBLE) WHEN 1 THEN CAST(supp AS DOUBLE) WHEN 3 THEN qty END AS number,
           CASE part % 5 WHEN 0 THEN CAST(price AS INTEGER) WHEN 1 THEN CAST(supp AS INTEGER) WHEN 3 THEN CAST(qty AS INTEGER) END AS whole
    FROM odds""", ["odds"])
def tolerant_cast(spark, sf):
    q = A.odds(spark, sf)
    kind = F.col("part") % 5
    # "12,345", "79-6", a word, padded decimals, and a spelling only the JVM would take.
    text = (F.when(kind == 0, F.regexp_replace(F.format_number("price", 0), "^$", "0"))
            .when(kind == 1, F.concat_ws("-", "supp", "line_no")).when(kind == 2, "n/a")
            .when(kind == 3, F.concat(F.lit("  "), F.col("qty").cast("string"), F.lit(" "))).otherwise("1e999"))
    return q.select("game_id", *A.QUOTE_TIES, numbers.to_number(text).alias("number"), numbers.to_int(text).alias("whole"))


@query("blank_counts", """
    SELECT count(*) AS rows,
           count(*) FILTER (WHERE coalesce(trim(text), '') = '') AS blank_text,
           count(*) FILTER (WHERE coalesce(trim(CASE WHEN doc_id % 4 = 0 THEN '  ' ELSE lang END), '') = '') AS blank_lang,
           count(*) FILTER (WHERE len(CASE WHEN doc_id % 3 > 0 THEN [source] ELSE [] END) > 0) AS with_tags,
           count(*) FILTER (WHERE doc_id % 6 <> 0) AS with_ratio,
           count(*) FILTER (WHERE TRY_CAST(text AS DOUBLE) IS NOT NULL) AS numeric_text,
           count(*) FILTER (WHERE TRY_CAST(n_chars AS DOUBLE) IS NOT NULL) AS numeric_size
    FROM documents""")
def blank_counts(spark, sf):
    d = A.table(spark, sf, "documents")
    k = F.col("doc_id")
    d = d.select("text", "n_chars", F.when(k % 4 == 0, "  ").otherwise(F.col("lang")).alias("lang"),
                 F.when(k % 3 > 0, F.array("source")).otherwise(F.array().cast("array<string>")).alias("tags"),
                 F.when(k % 6 == 0, F.lit(float("nan"))).otherwise(1.0).alias("ratio"))
    return d.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(numbers.is_blank("text")).alias("blank_text"),
        F.count_if(numbers.is_blank("lang")).alias("blank_lang"),
        F.count_if(numbers.has_value("tags", "array<string>")).alias("with_tags"),
        F.count_if(numbers.has_value("ratio", "double")).alias("with_ratio"),
        F.count_if(numbers.has_numeric("text")).alias("numeric_text"),
        F.count_if(numbers.has_numeric("n_chars")).alias("numeric_size"))


@query("numeric_texts", """
    SELECT count(*) AS rows, count(*) FILTER (WHERE TRY_CAST(text AS DOUBLE) IS NOT NULL) AS numeric_text,
           count(*) FILTER (WHERE TRY_CAST(CASE doc_id % 3 WHEN 0 THEN text WHEN 1 THEN CAST(doc_id AS VARCHAR)
               ELSE CAST(doc_id AS VARCHAR) || ' ' || text END AS DOUBLE) IS NOT NULL) AS numeric_mixed
    FROM documents""")
def numeric_texts(spark, sf):
    """Whole texts, numbers, and texts that only start with a number."""
    d, k = A.table(spark, sf, "documents"), F.col("doc_id")
    number = k.cast("string")
    mixed = F.when(k % 3 == 0, F.col("text")).when(k % 3 == 1, number).otherwise(F.concat(number, F.lit(" "), "text"))
    return d.agg(F.count(F.lit(1)).alias("rows"), F.count_if(numbers.has_numeric("text")).alias("numeric_text"),
                 F.count_if(numbers.has_numeric(mixed)).alias("numeric_mixed"))


@query("first_present", """
    SELECT o_orderkey, coalesce(TRY_CAST(CASE WHEN o_orderkey % 3 = 0 THEN 'x' ELSE CAST(o_orderkey % 100 AS VARCHAR) END AS DOUBLE),
           TRY_CAST(CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_custkey AS VARCHAR) END AS DOUBLE)) AS number,
           coalesce(nullif(trim(CASE WHEN o_orderkey % 4 = 0 THEN ' ' ELSE o_orderpriority END), ''), o_orderstatus) AS label
    FROM orders""")
def first_present(spark, sf):
    o, k = A.table(spark, sf, "orders"), F.col("o_orderkey")
    a = F.when(k % 3 == 0, "x").otherwise((k % 100).cast("string"))
    b = F.when(k % 2 == 0, F.col("o_custkey").cast("string"))
    label = F.when(k % 4 == 0, " ").otherwise(F.col("o_orderpriority"))
    return o.select("o_orderkey", numbers.first_present(a, b).alias("number"),
                    numbers.first_present(label, F.col("o_orderstatus"), cast="string").alias("label"))


@query("kickoff_utc", """
    SELECT game_id, strftime(CASE game_id % 4
        WHEN 0 THEN kickoff
        WHEN 1 THEN timezone('UTC', timezone('America/New_York', date_trunc('day', kickoff) + INTERVAL 13 HOUR))
        WHEN 2 THEN timezone('UTC', timezone('America/New_York', date_trunc('day', kickoff) + INTERVAL 1170 MINUTE))
        ELSE timezone('UTC', timezone('America/New_York', date_trunc('day', kickoff))) END, '%Y-%m-%d %H:%M:%S') AS kickoff
    FROM games""", ["games"])
def kickoff_utc(spark, sf):
    g = A.games(spark, sf)
    k = F.col("game_id") % 4
    g = g.select("game_id", F.when(k == 0, F.date_format("kickoff", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
                 .when(k == 1, "soon").alias("stamp"), F.date_format("kickoff", "yyyy-MM-dd").alias("day"),
                 F.when(k == 1, "13:00").when(k == 2, "7:30 pm").when(k == 3, " ").alias("clock"))
    return g.select("game_id", text_of(times.parse_kickoff("stamp", "day", "clock")).alias("kickoff"))


@query("time_tokens", """
    SELECT event_id, strftime(ts, '%Y%m%d_%H%M') AS token, strftime(ts, '%Y-%m-%dT%H:%M') AS minute,
           strftime(ts, '%Y-%m-%d') AS day,
           strftime(timezone('America/Los_Angeles', timezone('UTC', ts)), '%a %m/%d %-I:%M %p') AS pacific
    FROM events""")
def time_tokens(spark, sf):
    e = A.table(spark, sf, "events")
    return e.select("event_id", times.kickoff_token("ts").alias("token"), times.minute_token("ts").alias("minute"),
                    times.date_token("ts").alias("day"), times.local_display("ts").alias("pacific"))


@query("utc_stamps", """
    SELECT event_id, CASE event_id % 4 WHEN 3 THEN NULL ELSE strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') END AS at
    FROM events""")
def utc_stamps(spark, sf):
    e = A.table(spark, sf, "events")
    k = F.col("event_id") % 4
    text = (F.when(k == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
            .when(k == 1, F.concat(F.date_format(F.col("ts") + F.expr("INTERVAL 2 HOURS"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00")))
            .when(k == 2, F.unix_timestamp("ts").cast("string")).otherwise("kickoff tbd"))
    return e.select("event_id", text_of(times.parse_utc_or_epoch(text)).alias("at"))


@query("slug_names", """
    SELECT p_partkey, trim(regexp_replace(lower(' ' || p_name || ' & ' || p_type || '#' || p_brand || '!'), '[^a-z0-9]+', '_', 'g'), '_') AS slug
    FROM part""")
def slug_names(spark, sf):
    p = A.table(spark, sf, "part")
    label = F.concat(F.lit(" "), F.col("p_name"), F.lit(" & "), F.col("p_type"), F.lit("#"), F.col("p_brand"), F.lit("!"))
    return p.select("p_partkey", names.slug(label).alias("slug"))


@query("game_key", """
    SELECT game_id, strftime(kickoff, '%Y%m%d_%H%M') || '_t_' || away_id || '_t_' || home_id AS game_key FROM games""", ["games"])
def game_key(spark, sf):
    g = A.games(spark, sf)
    def team(c):
        return F.concat(F.lit("T. "), F.col(c).cast("string"))
    return g.select("game_id", names.game_key("kickoff", team("away_id"), team("home_id")).alias("game_key"))


@query("bool_words", """
    SELECT event_type, count(*) FILTER (WHERE event_id % 6 IN (0, 1)) AS yes, count(*) FILTER (WHERE event_id % 6 IN (2, 3)) AS no,
           count(*) FILTER (WHERE event_id % 6 > 3) AS unknown FROM events GROUP BY event_type""")
def bool_words(spark, sf):
    e = A.table(spark, sf, "events")
    word = F.element_at(F.array(*[F.lit(w) for w in (" TRUE", "neutral", "No ", "home", "maybe", "")]),
                        (F.col("event_id") % 6 + 1).cast("int"))
    flag = names.to_bool(word)
    return e.groupBy("event_type").agg(F.count_if(flag).alias("yes"), F.count_if(~flag).alias("no"),
                                       F.count_if(flag.isNull()).alias("unknown"))


@query("team_search", """
    SELECT c_custkey, c_name, c_mktsegment FROM customer
    WHERE contains(lower(c_name), '00001') OR contains(lower(c_mktsegment), '00001') OR contains(lower(c_mktsegment), 'build')
       AND contains(lower(c_name), '7')""")
def team_search(spark, sf):
    c = A.table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return c.where(names.search_text(" 00001 ", "c_name", "c_mktsegment")
                   | (names.search_text("Build", "c_mktsegment") & names.search_text("7", "c_name")))


@query("record_text", """
    SELECT season, team, su, ats, CASE WHEN gp > 0 THEN CASE WHEN t <> 0 THEN w||'-'||l||'-'||t ELSE w||'-'||l END ELSE '—' END AS week_text,
           CASE WHEN aw + al + ap > 0 THEN ats END AS ats_or_null, CAST(w AS INTEGER) AS back_w, CAST(w + l + t AS INTEGER) AS back_gp
    FROM (SELECT season, team, sum(w) w, sum(l) l, sum(t) t, sum(w) + sum(l) + sum(t) AS gp,
                 sum(ats_w) aw, sum(ats_l) al, sum(ats_p) ap,
                 CASE WHEN sum(t) <> 0 THEN sum(w)||'-'||sum(l)||'-'||sum(t) ELSE sum(w)||'-'||sum(l) END AS su,
                 sum(ats_w)||'-'||sum(ats_l)||'-'||sum(ats_p) AS ats FROM flags GROUP BY season, team)""", ["flags"])
def record_text(spark, sf):
    from ..operators import teams
    rows = teams.to_team_rows(A.games(spark, sf), ["season"])
    r = teams.season_records(rows, ["season", "team"])
    su = lines.format_record("w", "l", "t", "su")
    back = lines.parse_record(su)
    return r.select("season", "team", su.alias("su"), lines.format_record("ats_w", "ats_l", "ats_p", "ats").alias("ats"),
                    lines.format_record("w", "l", "t", "ats_or_dash").alias("week_text"),
                    lines.format_record("ats_w", "ats_l", "ats_p", "ats_or_null").alias("ats_or_null"),
                    back["w"].alias("back_w"), back["gp"].alias("back_gp"))


@query("favored_side", """
    SELECT game_id, CASE WHEN spread < 0 THEN 'HOME' WHEN spread > 0 THEN 'AWAY' WHEN spread = 0 THEN 'PICK'
           WHEN home_score - away_score >= 0 THEN 'HOME' WHEN home_score - away_score < 0 THEN 'AWAY' END AS side,
           -abs(spread) AS favored_spread FROM games""", ["games"])
def favored_side(spark, sf):
    return A.games(spark, sf).select(
        "game_id", lines.favored_side("spread", F.col("home_score") - F.col("away_score")).alias("side"),
        lines.favored_spread("spread").alias("favored_spread"))


@query("ats_outcome", """
    SELECT game_id, team, margin, line, CASE WHEN abs(margin + line) < 1e-9 THEN 'P' WHEN margin + line > 0 THEN 'W'
           WHEN margin + line < 0 THEN 'L' END AS ats, CAST(margin + line AS DOUBLE) AS to_margin,
           CASE WHEN margin > 0 THEN 'W' WHEN margin < 0 THEN 'L' WHEN margin = 0 THEN 'T' END AS result
    FROM team_rows""", ["team_rows"])
def ats_outcome(spark, sf):
    from ..operators import teams
    rows = teams.to_team_rows(A.games(spark, sf), ["game_id"])
    return rows.select("game_id", "team", "margin", "line", lines.ats_outcome("margin", "line").alias("ats"),
                       (F.col("margin") + F.col("line")).alias("to_margin"), lines.result("pf", "pa").alias("result"))


@query("rating_edge", """
    SELECT g.game_id, h.pr + 2.5 - a.pr AS rating_diff, h.pr + 2.5 - a.pr + g.spread AS rating_vs_odds,
           CASE WHEN spread < 0 THEN 'HOME' WHEN spread > 0 THEN 'AWAY' WHEN spread = 0 THEN 'PICK' END AS favored_side,
           -abs(spread) AS spread_favored_team,
           CASE WHEN spread <= 0 THEN h.pr + 2.5 - a.pr WHEN spread > 0 THEN -(h.pr + 2.5 - a.pr) END AS rating_diff_favored_team,
           CASE WHEN spread <= 0 THEN h.pr + 2.5 - a.pr WHEN spread > 0 THEN -(h.pr + 2.5 - a.pr) END - abs(spread)
               AS rating_vs_odds_favored_team,
           CASE WHEN h.sos > a.sos THEN h.sos - a.sos END AS home_sos_diff
    FROM games g LEFT JOIN ratings h ON h.season = g.season AND h.wk = g.wk AND h.team = g.home_id
    LEFT JOIN ratings a ON a.season = g.season AND a.wk = g.wk AND a.team = g.away_id""", ["games", "ratings"])
def rating_edge(spark, sf):
    from ..operators import joins
    g = joins.join_both_sides(A.games(spark, sf), A.ratings(spark, sf), ["season", "wk"], ["pr", "sos"])
    g = g.withColumn("hfa", F.lit(A.HFA))
    cols = lines.edge_columns()
    return g.select("game_id", *[c.alias(n) for n, c in cols.items()],
                    lines.sos_diff("home_sos", "away_sos").alias("home_sos_diff"))
