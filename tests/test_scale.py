"""Scale of the round's queries: what travels, and that odd rows still come out right."""

import datetime as dt
import glob

from pyspark.sql import functions as F

import __spark_entry__ as entry
from duelframe.operators import ranks, ratings, teams
from duelframe.plans import timelines
from duelframe.sources import files
from duelframe.streaming import jobs
from duelframe.streaming.versions import VersionedTable

SF = "/root/testdata/sf0.001"
BASE = dt.datetime(2025, 9, 6)


def plan(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def schedule(spark):
    """Two seasons of four teams; game 5 comes twice, one game has no key and one no home side."""
    data = [(i, 2024 + i // 20, i % 20 // 2 + 1, BASE + dt.timedelta(days=7 * i), i % 4, (i + 1 + i // 4 % 3) % 4) for i in range(40)]
    data += [data[5], (None, 2025, 3, BASE + dt.timedelta(days=200), 1, 2), (99, 2025, 9, BASE + dt.timedelta(days=275), None, 2)]
    return spark.createDataFrame(data, "game_id int, season int, wk int, kickoff timestamp, home_id int, away_id int"), data


def test_arrays_are_counted_where_they_are_cut(spark):
    games, data = schedule(spark)
    rows = games.select("game_id", "season", "wk", "kickoff", F.explode(F.array("home_id", "away_id")).alias("team"))
    chunks = timelines.timeline_chunks(rows, ["season"], ["season"], chunk=3)
    whole = timelines.game_arrays(games, chunks, ["season"], before_week=True)
    counted = timelines.game_arrays(games, chunks, ["season"], before_week=True, make={b: lambda arr: F.size(arr) for b in timelines.BUCKETS})
    got = sorted(counted.collect(), key=repr)
    assert got == sorted(whole.select("game_id", *[F.size(b).alias(b) for b in timelines.BUCKETS]).collect(), key=repr)
    assert len(got) == len(data)
    for key, season, wk, kickoff, *sides in data:
        same = [x for x in data if x[0] == key and key is not None]

        def seen(team, ytd):
            if key is None or team is None:
                return 0
            mine = [x for x in data for t in x[4:] if t == team]
            return len(same) * sum((x[1] == season and x[3] < kickoff and x[2] < wk) if ytd else x[1] == season - 1 for x in mine)

        want = [seen(sides[0], True), seen(sides[1], True), seen(sides[0], False), seen(sides[1], False)]
        assert [r[1:] for r in got if r.game_id == key] == [tuple(want)] * max(len(same), 1)
    assert all(r.home_ytd == sorted(r.home_ytd, key=lambda e: e.kickoff) for r in whole.where("game_id <> 5").collect())


def test_timeline_documents_are_compressed(spark, tmp_path):
    df = spark.range(50).select("id", F.array_repeat(F.struct(F.lit("2025-09-06").alias("date"), F.col("id").alias("opp")), 20).alias("home_ytd"))
    files.write_timelines(df, f"{tmp_path}/t")
    assert glob.glob(f"{tmp_path}/t/*.json.gz") and not glob.glob(f"{tmp_path}/t/*.json")
    assert sorted(map(repr, spark.read.schema(df.schema).json(f"{tmp_path}/t").collect())) == sorted(map(repr, df.collect()))


def test_record_moves_counts_and_no_entries(spark):
    text = plan(entry.queries()["timeline_record"](spark, SF))
    assert "Generate" not in text and "collect_list" not in text


def test_totals_of_odd_weeks_without_a_grid_in_the_shuffle(spark):
    rows = [(2025, 1, 3, 10), (2025, 1, 5, 7), (2025, 1, None, 100), (2025, 2, 0, 4), (2025, 2, 6, 1), (2025, 3, None, 9), (2025, None, 2, 5), (None, 4, 2, 5)]
    weekly = spark.createDataFrame(rows, "season int, team int, wk int, pts int")
    out = teams.to_date(weekly, ["pts"], ["season"], played="played")
    assert "Union" not in plan(out)
    got = {(r.season, r.team, r.wk): (r.pts, r.played) for r in out.collect()}
    want = {}
    for team in (1, 2, 3, None):
        mine = [(w, p) for s, t, w, p in rows if s == 2025 and t == team]
        for wk in range(min([1, *[w for w, _ in mine if w is not None]]), 7):
            want[2025, team, wk] = (sum(p for w, p in mine if w is None or w < wk), any(w == wk for w, _ in mine))
    assert got == want and out.count() == len(want)


def test_pool_takes_sums_and_works_out_means_behind_the_shuffle(spark):
    df = spark.range(60).select((F.col("id") % 3).alias("s"), F.col("id").alias("team"), (F.col("id") * 37 % 11).alias("x"), (F.col("id") % 4).alias("n"))
    mean = F.try_divide("x", "n")
    got = ranks.dense_rank_league(df, ["s"], {"m": True}, derived={"m": mean}, store=False)
    want = ranks.dense_rank_league(df.withColumn("m", mean), ["s"], {"m": True})
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_game_view_leaves_weeks_without_a_game_behind(spark):
    text = plan(entry.queries()["game_view"](spark, SF))
    assert "_played" in text and "Union" not in text


def test_quote_state_lies_on_disk(spark, tmp_path):
    q = spark.createDataFrame([(1, "x", None, BASE), (1, "x", None, BASE), (1, None, "x", BASE), (2, "y", "z", BASE)], "k int, a string, b string, at timestamp")
    q.write.parquet(f"{tmp_path}/feed")
    feed = spark.readStream.schema(q.schema).parquet(f"{tmp_path}/feed").withColumn("arrived", F.current_timestamp())
    table = VersionedTable(f"{tmp_path}/table", ["k", "a"], "at", ["b"])
    jobs.stream_quotes(feed, table, f"{tmp_path}/checkpoint", "arrived")
    assert table.read(spark).count() == 3
    assert glob.glob(f"{tmp_path}/checkpoint/state/0/0/*.zip") + glob.glob(f"{tmp_path}/checkpoint/state/0/0/*.changelog")
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", "").find("RocksDB") < 0


def test_digests_tell_null_places_apart(spark):
    q = spark.createDataFrame([(None, 1), (1, None), (None, None), (1, 1)], "a int, b int").withColumns(jobs.row_digest(["a", "b"]))
    assert q.select("_digest_1").distinct().count() == q.select("_digest_2").distinct().count() == 4


def test_pro_lines_are_read_once(spark):
    page = "\n".join(["   1  Alpha  Team*          =  20.50   4  1  0   19.25(   3) (AFC EAST)", "2\tBeta\f = 18.00 |17.5( 4)| (NFC)", "   2  Gamma  =  1.00 (AFC)",
                      "   1  Alpha  Team           =  20.50   4  1  0   19.25(   3) (AFC EAST)", "   3  Gamma = 2.00 (NFC)", "   x  Delta = 2.00 (NFC)", "9 Eps = 3.00"])
    out = ratings.parse_rating_pages(spark.createDataFrame([(1, page)], "page int, text string"), ["page"], style="pro")
    assert "translate(" not in plan(out)
    assert sorted((r.pr_rank, r.team_raw, r.pr, r.sos, r.sos_rank) for r in out.collect()) == [
        (1, "Alpha Team", 20.5, 19.25, 3), (2, "Beta", 18.0, 17.5, 4), (3, "Gamma", 2.0, None, None)]


def test_rank_maps_are_joined_once_for_each_side(spark):
    rows = spark.createDataFrame([(1, 1, 1, "a", "b", 0), (2, 1, 1, "b", "c", 7), (3, 1, 1, "c", None, None), (4, None, 1, "a", "d", None)],
                                 "id int, season int, wk int, team string, opp string, r int").withColumn("o", F.lit(None).cast("int"))
    schema = "season int, wk int, team string, rank double"
    first = spark.createDataFrame([(1, 1, "a", 0.0), (1, 1, "b", 4.0), (1, 1, "b", 5.0), (None, 1, "a", 3.0)], schema)
    second = spark.createDataFrame([(1, 1, "a", 8.0), (1, 1, "c", 9.0), (1, 1, "b", 2.0)], schema)
    out = ratings.rank_fallback(rows, [first, second], ["season"], {"r": ("team", "rank"), "o": ("opp", "rank")})
    assert plan(out).count("LeftOuter") == plan(rows.join(rows.select("id"), "id", "left")).count("LeftOuter") * 2
    assert sorted(((x.id, x.r, x.o) for x in out.collect()), key=repr) == sorted(
        [(1, 8, 4), (1, 8, 5), (2, 7, 9), (2, 7, 9), (3, 9, None), (4, None, None)], key=repr)


def test_update_cuts_the_home_side_only(spark):
    text = plan(entry.queries()["timeline_update"](spark, SF))
    assert "Generate" not in text and "collect_list" not in text


def test_week_view_leaves_weeks_without_a_game_behind(spark):
    text = plan(entry.queries()["week_view"](spark, SF))
    assert "_played" in text and "Union" not in text


def test_game_provenance_leaves_weeks_without_a_game_behind(spark):
    text = plan(entry.queries()["game_provenance"](spark, SF))
    assert "_played" in text and "Union" not in text
