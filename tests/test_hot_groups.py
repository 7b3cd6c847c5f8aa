"""A third of all rows in one group, on one day or at one instant: both ways of following an order give one result."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from duelframe.operators import matching, prefix, quotes, ranges, ranks, teams

BASE = dt.datetime(2025, 9, 6, 0, 0)


def minutes(n):
    return BASE + dt.timedelta(minutes=n)


@pytest.fixture(params=[100_000, 40, 0])
def pool_rows(request, monkeypatch):
    monkeypatch.setattr(ranges, "POOL_ROWS", request.param)
    return request.param


def team_rows(spark):
    rng = random.Random(5)
    # Team 1 plays a third of all games, most of them on one day and half of those at one instant.
    data = []
    for i in range(600):
        team = 1 if i % 3 == 0 else None if i % 50 == 1 else rng.randrange(2, 30)
        when = None if i % 97 == 5 else minutes(720 if i % 6 == 0 else rng.randrange(1440 if i % 5 else 40 * 1440))
        data.append((i, 2025, team, when, rng.choice([None, 7, 14, 21]), 14, float(rng.choice([-3, 0, 3]))))
    schema = "game_id int, season int, team int, kickoff timestamp, pf int, pa int, line double"
    return spark.createDataFrame(data, schema).withColumn("margin", F.col("pf") - F.col("pa")), data


def test_records_of_a_hot_team(spark, pool_rows):
    df, data = team_rows(spark)
    got = {r.game_id: (r.w_before, r.l_before, r.t_before) for r in teams.record_before(df, ["season"]).collect()}

    def key(when):
        return when or dt.datetime.min

    for i, _, team, when, *_ in data:
        seen = [] if when is None else [x for x in data if x[2] == team and key(x[3]) < when and x[4] is not None]
        assert got[i] == (sum(x[4] > 14 for x in seen), sum(x[4] < 14 for x in seen), sum(x[4] == 14 for x in seen))
    run = {r.game_id: r.run_w for r in teams.running_record(df, ["season"]).collect()}
    scored = [x for x in data if x[4] is not None]
    assert run == {x[0]: sum(y[4] > 14 for y in scored if y[2] == x[2] and (key(y[3]), y[0]) <= (key(x[3]), x[0])) for x in scored}


def test_numbers_of_a_hot_week(spark, pool_rows):
    games = [(i, 2025, 1 if i % 3 else 2, minutes(60 * (i % 2))) for i in range(300)]
    df = spark.createDataFrame(games, "game_id int, season int, wk int, kickoff timestamp")
    got = {r.game_id: (r.ordinal, r.game_number) for r in ranks.game_numbers(df, ["season"]).collect()}
    for wk in (1, 2):
        order = sorted((g for g in games if g[2] == wk), key=lambda g: (g[3], g[0]))
        assert all(got[g[0]] == (n, f"{wk}{n:02d}") for n, g in enumerate(order, 1))


def test_empty_tables(spark, pool_rows):
    df, _ = team_rows(spark)
    assert teams.record_before(df.limit(0), ["season"]).count() == 0
    q = spark.createDataFrame([], "k int, at timestamp, seq int")
    left = spark.createDataFrame([(1, 1, BASE)], "id int, k int, cut timestamp")
    assert [tuple(r) for r in quotes.asof_history(left, q, ["k"], "cut", "at", ["seq"], ["seq"]).collect()] == [(1, 1, BASE, None)]


def test_last_quote_of_a_hot_key(spark, pool_rows):
    rng = random.Random(9)

    def when(i):
        return None if i % 41 == 7 else minutes(600 if i % 4 == 0 else rng.randrange(1440))

    q = [(1 if i % 3 == 0 else None if i % 37 == 1 else rng.randrange(2, 9), when(i), i) for i in range(500)]
    left = [(i, 1 if i % 3 == 0 else None if i % 19 == 1 else rng.randrange(2, 12), when(i)) for i in range(300)]
    out = quotes.asof_history(spark.createDataFrame(left, "id int, k int, cut timestamp"), spark.createDataFrame(q, "k int, at timestamp, seq int"),
                              ["k"], "cut", "at", ["seq"], ["seq"])
    got = {r.id: r.asof_seq for r in out.collect()}
    assert len(got) == len(left)
    for i, k, cut in left:
        seen = [x for x in q if k is not None and cut is not None and x[0] == k and x[1] is not None and x[1] <= cut]
        assert got[i] == (min(seen, key=lambda x: (-x[1].timestamp(), x[2]))[2] if seen else None)


def test_events_of_a_hot_pair(spark, pool_rows):
    rng = random.Random(11)
    sides = [("a", "b"), ("b", "a"), ("c", "d"), ("a", "d")]
    games = [(i, *(sides[i % 2] if i % 3 == 0 else rng.choice(sides)), minutes(rng.randrange(0, 1440, 5))) for i in range(150)]
    events = [(i, *(sides[0] if i % 3 == 0 else (None, "b") if i % 29 == 1 else rng.choice(sides)),
               None if i % 31 == 2 else minutes(720 if i % 2 else rng.randrange(1440))) for i in range(300)]
    g = spark.createDataFrame(games, "game_id int, home_id string, away_id string, kickoff timestamp")
    e = spark.createDataFrame(events, "event_id int, home string, away string, event_ts timestamp")
    got = {r.event_id: r for r in matching.pin_events(e, g, max_hours=1, strict_ties=False).collect()}
    assert len(got) == len(events)
    for i, home, away, when in events:
        def reach(h, a):
            return [x for x in games if (x[1], x[2]) == (h, a) and abs((x[3] - when).total_seconds()) <= 3600]
        if home is None or when is None:
            assert got[i].game_id is None and got[i].why in ("no_candidate", "invalid_event_time")
            continue
        pool = reach(home, away) or reach(away, home)
        want = min(pool, key=lambda x: (abs((x[3] - when).total_seconds()), x[0]))[0] if pool else None
        assert got[i].game_id == want


def test_no_task_holds_a_hot_pair(spark):
    """A pair with a third of 60,000 rows on one day, half of those at one instant."""
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 500 + 2).alias("pair"),
        F.when(F.col("id") % 6 == 0, 720).otherwise(F.col("id") * 7919 % 1440).alias("_at"), F.col("id").alias("row"))
    parts = ranges.dealt(df, ["pair"], [F.asc("_at"), ranges.spread(df).asc()]).groupBy("_range").count().collect()
    sizes = [r["count"] for r in parts]
    assert len(sizes) == 8 and max(sizes) <= 2 * statistics.median(sizes)


def test_hot_totals_equal_the_window(spark, monkeypatch):
    df = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 100).alias("g"), (F.col("id") * 7919 % 20011).alias("at"))
    out = []
    for rows in (100_000, 1_000):
        monkeypatch.setattr(ranges, "POOL_ROWS", rows)
        out.append(sorted(prefix.running_sums(df, ["g"], ["at"], {"n": F.lit(1), "s": F.col("at")}, "through").collect()))
    assert out[0] == out[1]
