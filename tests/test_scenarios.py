"""Situations the operators must decide: ties, swaps, late and future quotes, byes, blanks."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from duelframe.operators import deltas, joins, matching, merge, nested, quality, quotes, ranges, ranks, ratings, skew, teams
from duelframe.sources import files


def at(text):
    return dt.datetime.strptime(text, "%Y-%m-%d %H:%M") if text else None


GAMES = "game_id long, season int, wk int, kickoff timestamp, home_id string, away_id string, neutral boolean"
EVENTS = "event_id long, event_ts timestamp, home string, away string"


def games(spark):
    return spark.createDataFrame([
        (1, 2025, 1, at("2025-09-07 17:00"), "A", "B", False), (2, 2025, 1, at("2025-09-07 20:00"), "C", "D", False),
        (3, 2025, 2, at("2025-09-14 17:00"), "E", "F", False), (4, 2025, 2, at("2025-09-14 17:00"), "E", "F", False),
        (5, 2025, 2, at("2025-09-14 17:00"), "G", "H", False), (6, 2025, 2, at("2025-09-14 17:00"), "G", "H", True),
        (7, 2025, 3, at("2025-09-21 12:00"), "I", "J", False), (8, 2025, 3, at("2025-09-21 18:00"), "I", "J", False),
        (9, 2025, 3, at("2025-09-21 12:00"), "K", "L", True), (10, 2025, 3, at("2025-09-21 18:00"), "K", "L", False)], GAMES)


@pytest.fixture(scope="module")
def pins(spark):
    events = spark.createDataFrame([
        (1, at("2025-09-07 18:00"), "A", "B"),      # plain
        (2, at("2025-09-07 18:00"), "D", "C"),      # roles swapped
        (3, at("2025-09-14 17:00"), "E", "F"),      # two equal games
        (4, at("2025-09-14 16:00"), "G", "H"),      # neutral site first
        (5, at("2025-09-09 06:00"), "A", "B"),      # 37 hours away
        (6, None, "A", "B"),                        # no time
        (7, at("2025-09-21 15:00"), "I", "J"),      # halfway between two games
        (8, at("2025-09-21 15:00"), "K", "L"),      # halfway, one is neutral
        (9, at("2025-09-07 18:00"), "A", "Z"),      # unknown pair
        (10, at("2025-09-09 05:00"), "A", "B"),     # exactly 36 hours
        (11, at("2025-09-07 18:00"), None, "B")], EVENTS)
    out = matching.pin_events(events, games(spark), neutral="neutral")
    return {r.event_id: (r.game_id, r.role_swapped, r.why) for r in out.collect()}


def test_pin_scenarios(pins):
    assert pins == {
        1: (1, False, None), 2: (2, True, None), 3: (None, None, "ambiguous"), 4: (6, False, None),
        5: (None, None, "no_candidate"), 6: (None, None, "invalid_event_time"), 7: (None, None, "ambiguous"),
        8: (9, False, None), 9: (None, None, "no_candidate"), 10: (1, False, None), 11: (None, None, "no_candidate")}


def test_pin_options(spark):
    events = spark.createDataFrame([(1, at("2025-09-07 18:00"), "D", "C"), (2, at("2025-09-14 17:00"), "E", "F"),
                                    (3, at("2025-09-10 17:00"), "A", "B"), (4, at("2025-09-11 17:00"), "A", "B")], EVENTS)
    strict = {r.event_id: r.why for r in matching.pin_events(events, games(spark), allow_swap=False, max_hours=-1).collect()}
    assert strict == {1: "no_candidate", 2: "ambiguous", 3: None, 4: "no_candidate"}
    loose = {r.event_id: r.game_id for r in matching.pin_events(events, games(spark), strict_ties=False).collect()}
    assert loose[2] == 3 and loose[1] == 2


def test_direct_role_beats_a_closer_swapped_game(spark):
    g = spark.createDataFrame([(1, at("2025-09-07 12:00"), "A", "B"), (2, at("2025-09-07 18:00"), "B", "A")],
                              "game_id long, kickoff timestamp, home_id string, away_id string")
    e = spark.createDataFrame([(1, at("2025-09-07 18:00"), "A", "B")], EVENTS)
    row = matching.pin_events(e, g).first()
    assert (row.game_id, row.role_swapped) == (1, False)


def brute_pins(evs, gs, hours=36):
    out = {}
    for eid, ts, home, away in evs:
        cands = []
        for gid, kick, gh, ga in gs:
            if abs((kick - ts).total_seconds()) <= hours * 3600:
                if (gh, ga) == (home, away):
                    cands.append((0, abs((kick - ts).total_seconds()), gid))
                elif (gh, ga) == (away, home):
                    cands.append((1, abs((kick - ts).total_seconds()), gid))
        cands.sort()
        if not cands:
            out[eid] = (None, "no_candidate")
        elif len(cands) > 1 and cands[0][:2] == cands[1][:2]:
            out[eid] = (None, "ambiguous")
        else:
            out[eid] = (cands[0][2], None)
    return out


def test_hot_pair_equals_brute_force(spark):
    """One pair of sides holds nearly everything: same answer as comparing all pairs."""
    import random

    rng = random.Random(5)
    base = at("2025-09-01 00:00")

    def sides():
        if rng.random() < 0.8:
            return ("A", "B") if rng.random() < 0.5 else ("B", "A")
        return ("C", "D")
    gs = [(i, base + dt.timedelta(minutes=rng.randrange(0, 60 * 24 * 20, 30)), *sides()) for i in range(250)]
    evs = [(i, base + dt.timedelta(minutes=rng.randrange(0, 60 * 24 * 24, 15)), *sides()) for i in range(400)]
    g = spark.createDataFrame(gs, "game_id long, kickoff timestamp, home_id string, away_id string")
    e = spark.createDataFrame(evs, EVENTS)
    got = {r.event_id: (r.game_id, r.why) for r in matching.pin_events(e, g).collect()}
    assert got == brute_pins(evs, gs)


def test_tiers_are_one_to_one(spark):
    g = spark.createDataFrame([(1, at("2025-09-07 17:00"), "A", "B"), (2, at("2025-09-08 00:30"), "C", "D")],
                              "game_id long, kickoff timestamp, home_id string, away_id string")
    e = spark.createDataFrame([
        (1, at("2025-09-07 17:04"), "B", "A"), (2, at("2025-09-07 17:05"), "A", "B"), (3, at("2025-09-07 18:00"), "A", "B"),
        (4, at("2025-09-07 23:30"), "C", "D"), (5, at("2025-09-08 01:30"), "D", "C"), (6, None, "A", "B"), (7, at("2025-09-07 17:00"), None, "B")], EVENTS)
    got = {r.event_id: (r.game_id, r.tier, r.why) for r in matching.tiered_match(e, g).collect()}
    assert got == {1: (None, None, "no_schedule_candidate"), 2: (1, "ordered_exact", None), 3: (None, None, "no_schedule_candidate"),
                   4: (None, None, "no_schedule_candidate"), 5: (2, "unordered_near", None),
                   6: (None, None, "invalid_commence_time"), 7: (None, None, "name_mismatch")}


SLOTS = "game_id long, kickoff timestamp, home_id string, away_id string"


def test_event_that_loses_its_game_takes_a_free_one(spark):
    g = spark.createDataFrame([(1, at("2025-09-07 12:00"), "A", "B"), (2, at("2025-09-07 13:00"), "A", "B")], SLOTS)
    e = spark.createDataFrame([(1, at("2025-09-07 12:00"), "A", "B"), (2, at("2025-09-07 12:10"), "A", "B")], EVENTS)
    got = {r.event_id: (r.game_id, r.tier, r.delta, r.why) for r in matching.tiered_match(e, g).collect()}
    assert got == {1: (1, "ordered_exact", 0.0, None), 2: (2, "ordered_near", 3000.0, None)}


def brute_tiers(evs, gs):
    """Rounds over all pairs of unmatched events and free games."""
    free, open_, out = list(gs), list(evs), {}
    while True:
        asked = {}
        for eid, ts, home, away in open_:
            cands = []
            for gid, kickoff, gh, ga in free:
                delta = abs((kickoff - ts).total_seconds())
                if {gh, ga} == {home, away} and (delta <= 300 or delta <= 7200 and kickoff.date() == ts.date()):
                    cands.append(((1 if delta <= 300 else 3) + (gh != home), delta, gid))
            if cands:
                tier, delta, gid = min(cands)
                asked.setdefault(gid, []).append((tier, delta, eid))
        if not asked:
            return {eid: out.get(eid) for eid, *_ in evs}
        for gid, asks in asked.items():
            tier, delta, eid = min(asks)
            out[eid] = (gid, matching.TIER_NAMES[tier - 1], delta)
        open_, free = [x for x in open_ if x[0] not in out], [x for x in free if x[0] not in asked]


def test_tiers_of_a_hot_pair_equal_brute_force(spark):
    """Many games and events of one pair within hours, some games at the same time."""
    import random

    rng = random.Random(7)
    base = at("2025-09-07 20:00")

    def rows(n, step):
        return [(i, base + dt.timedelta(minutes=rng.randrange(0, 480, step)), *(rng.sample(["A", "B"], 2) if rng.random() < 0.9 else ["C", "D"])) for i in range(n)]
    gs, evs = rows(16, 30), rows(30, 10)
    want = brute_tiers(evs, gs)
    out = matching.tiered_match(spark.createDataFrame(evs, EVENTS), spark.createDataFrame(gs, SLOTS)).collect()
    assert {r.event_id: (r.game_id, r.tier, r.delta) if r.game_id is not None else None for r in out} == want
    assert len(out) == len(evs)


def test_week_of_clamps_and_gaps(spark):
    g = spark.createDataFrame([(1, 2025, 1, at("2025-09-04 17:00")), (2, 2025, 2, at("2025-09-09 00:00")), (3, 2025, 4, at("2025-09-25 10:00"))],
                              "game_id long, season int, wk int, kickoff timestamp")
    probe = spark.createDataFrame([(2025, at("2025-01-01 00:00")), (2025, at("2025-09-02 00:00")), (2025, at("2025-09-08 23:59")),
                                   (2025, at("2025-09-09 00:00")), (2025, at("2025-09-17 00:00")), (2025, at("2026-01-01 00:00")), (2025, None)],
                                  "season int, ts timestamp")
    out = matching.week_of(probe, matching.week_windows(g, ["season"]), ["season"], "ts")
    rows = [r.week for r in out.orderBy("ts").collect()]
    assert rows == [None, 1, 1, 1, 2, 4, 4]


QUOTES = "game_id long, market string, book string, fetch_ts timestamp, spread_home_relative double, total_points double, moneyline_home int, moneyline_away int, seq int"


def quote_rows(spark):
    return spark.createDataFrame([
        (1, "spreads", "a", at("2025-09-07 10:00"), -3.0, None, None, None, 1),
        (1, "spreads", "a", at("2025-09-07 18:00"), -9.0, None, None, None, 2),   # newest of its book is after kickoff
        (1, "spreads", "b", at("2025-09-07 09:00"), -2.5, None, None, None, 3),
        (1, "totals", "b", at("2025-09-07 17:00"), None, 44.5, None, None, 4),    # at kickoff: still closing
        (2, "spreads", "a", at("2025-09-08 10:00"), 1.0, None, None, None, 5),    # only a later quote
        (3, "h2h", "b", at("2025-09-14 10:00"), None, None, -120, 110, 6),
        (3, "h2h", "a", at("2025-09-14 10:00"), None, None, -125, 105, 7),        # same instant: greater book name wins
        (99, "spreads", "a", at("2025-09-14 10:00"), 5.0, None, None, None, 8)], QUOTES)


def test_promotion_policies(spark):
    g = games(spark).where("game_id < 5")
    latest = {r.game_id: r for r in quotes.promote_lines(g, quote_rows(spark), ties=["seq"]).collect()}
    assert set(latest) == {1, 2, 3}
    assert latest[1].spread_home_relative == -9.0 and latest[1].odds_source == "a" and latest[1].is_closing is False
    assert latest[1].total == 44.5 and latest[1].used_records == 3 and latest[1].provenance["totals"].book == "b"
    assert latest[3].moneyline_home == -120 and latest[3].odds_source == "b"
    closing = {r.game_id: r for r in quotes.promote_lines(g, quote_rows(spark), policy="closing", ties=["seq"]).collect()}
    assert closing[1].spread_home_relative == -3.0 and closing[1].is_closing is True and closing[1].favored_side == "HOME"
    assert closing[2].spread_home_relative == 1.0 and closing[2].is_closing is False
    with pytest.raises(ValueError):
        quotes.promote_lines(g, quote_rows(spark), policy="newest")


def test_closing_line_tiers(spark):
    g = games(spark).where("game_id < 5")
    q = quote_rows(spark).where("market = 'spreads'")
    out = {r.game_id: r for r in quotes.closing_line(g, [("pinned", q.where("book = 'b'")), ("history", q)], ties=["seq"]).collect()}
    # Game 2 has a quote after kickoff only.
    assert set(out) == {1} and (out[1].source, out[1].closing_spread) == ("pinned", -2.5)


def test_asof_forms_agree_on_a_hot_key(spark):
    import random

    rng = random.Random(3)
    base = at("2025-09-01 00:00")
    g = spark.createDataFrame([(i, base + dt.timedelta(hours=rng.randrange(0, 240))) for i in range(30)], "game_id long, kickoff timestamp")
    q = spark.createDataFrame([(7 if rng.random() < 0.4 else rng.randrange(30), base + dt.timedelta(hours=rng.randrange(0, 240)), i, i * 1.5)
                               for i in range(2000)], "game_id long, fetch_ts timestamp, seq int, point double")
    a = quotes.asof_backward(g, q, ["game_id"], "kickoff", "fetch_ts", ["point", "seq"], ["seq"])
    b = quotes.asof_history(g, q, ["game_id"], "kickoff", "fetch_ts", ["point", "seq"], ["seq"])
    assert sorted(a.collect()) == sorted(b.collect())


def test_salted_join_keeps_every_row(spark):
    # A third of the big side shares one key.
    big = spark.range(50000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    small = spark.range(1, 5000, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    want = {how: sorted(map(tuple, big.join(small, ["k"], how).collect()), key=str) for how in ("inner", "left", "left_semi", "left_anti")}
    for how, rows in want.items():
        for salts in (1, 8):
            plan = skew.skew_join(big, small, ["k"], how, salts=salts)
            assert sorted(map(tuple, plan.collect()), key=str) == rows
    with pytest.raises(ValueError):
        skew.skew_join(big, small, ["k"], "full_outer")


def team_rows(spark):
    g = spark.createDataFrame([
        (1, 2025, 1, at("2025-09-07 17:00"), "A", "B", 21, 14, -3.0), (2, 2025, 1, at("2025-09-07 17:00"), "A", "C", 10, 17, None),
        (3, 2025, 3, at("2025-09-21 17:00"), "B", "A", 24, 24, -2.0), (4, 2025, 4, at("2025-09-28 17:00"), "A", "B", None, None, 1.0)],
        "game_id long, season int, wk int, kickoff timestamp, home_id string, away_id string, home_score int, away_score int, spread double")
    return teams.to_team_rows(g.withColumns({"home_rush": F.lit(100), "away_rush": F.lit(50)}), ["game_id", "season", "wk", "kickoff"],
                              stats={"rush": ("home_rush", "away_rush")})


def test_same_kickoff_games_do_not_see_each_other(spark):
    out = {(r.game_id, r.team): (r.w_before, r.l_before, r.t_before) for r in teams.record_before(team_rows(spark), ["season"]).collect()}
    assert out[(1, "A")] == (0, 0, 0) and out[(2, "A")] == (0, 0, 0)
    assert out[(3, "A")] == (1, 1, 0) and out[(4, "A")] == (1, 1, 1) and out[(4, "B")] == (0, 1, 1)


def test_running_record_counts_the_game_itself(spark):
    out = {(r.game_id, r.team): (r.run_w, r.run_l, r.run_t) for r in teams.running_record(team_rows(spark), ["season"]).collect()}
    assert out == {(1, "A"): (1, 0, 0), (2, "A"): (1, 1, 0), (3, "A"): (1, 1, 1), (1, "B"): (0, 1, 0), (3, "B"): (0, 1, 1), (2, "C"): (1, 0, 0)}


def test_bye_weeks_keep_a_row(spark):
    rows = teams.season_to_date(team_rows(spark), ["rush"], ["season"]).where("team = 'A'").orderBy("wk").collect()
    assert [(r.wk, r.gp, r.rush_pg) for r in rows] == [(1, 0, None), (2, 2, 100.0), (3, 2, 100.0), (4, 3, 250 / 3)]


def test_opponent_mirror_meets_the_opponent(spark):
    rows = team_rows(spark).groupBy("season", "wk", "team", "opp").agg(F.sum("rush").alias("rush"))
    out = {(r.wk, r.team, r.opp): r.rush_allowed for r in teams.opponent_mirror(rows, ["season", "wk"], ["rush"]).collect()}
    assert out[(1, "A", "B")] == 50 and out[(1, "B", "A")] == 100 and out[(3, "A", "B")] == 100


def test_cutoff_at_first_kickoff_ignores_the_week_number(spark):
    g = spark.createDataFrame([
        (1, 2025, 1, at("2025-09-07 17:00"), "A", "B", 1, 0, None), (2, 2025, 1, at("2025-09-16 17:00"), "A", "B", 1, 0, None),  # postponed
        (3, 2025, 2, at("2025-09-14 17:00"), "A", "B", 1, 0, None), (4, 2025, 3, at("2025-09-21 17:00"), "A", "B", 1, 0, None)],
        "game_id long, season int, wk int, kickoff timestamp, home_id string, away_id string, home_score int, away_score int, spread double")
    rows = teams.to_team_rows(g, ["game_id", "season", "wk", "kickoff"])
    out = teams.season_to_date_first_kickoff(rows, g, ["pf"], ["season"]).where("team = 'A'").orderBy("wk").collect()
    assert [(r.wk, r.gp) for r in out] == [(1, 0), (2, 1), (3, 3)]


def test_rating_weeks(spark):
    r = spark.createDataFrame([(2025, 3, "A", 80.0), (2025, 5, "A", 85.0)], "season int, wk int, team string, pr double")
    weeks = spark.createDataFrame([(2025, 6)], "season int, _last int")
    out = ratings.fill_rating_weeks(r, weeks, ["season"], ["pr"]).orderBy("wk").collect()
    assert [(x.wk, x.rating_week, x.pr) for x in out] == [(1, 3, 80.0), (2, 3, 80.0), (3, 3, 80.0), (4, 3, 80.0), (5, 5, 85.0), (6, 5, 85.0)]


def test_merge_keeps_old_lines_and_is_idempotent(spark):
    schema = "game_key string, home_score int, spread_home_relative double, odds_source string, home_pr double, raw_sources struct<odds_row:string, schedule_row:string>"
    old = spark.createDataFrame([("k1", None, -3.0, " ", 80.0, ("o", "s")), ("k2", 7, None, "a", None, (None, "s")), ("only_old", 1, 1.0, "a", 1.0, None)], schema)
    new = spark.createDataFrame([("k1", 21, -9.0, "b", 99.0, (None, "t")), ("k2", None, 4.0, None, 70.0, ("p", "t")), ("only_new", 2, None, None, None, None)], schema)
    merged = merge.merge_preserving(old, new, ["game_key"])
    got = {r.game_key: tuple(r)[1:] for r in merged.collect()}
    assert got == {"k1": (21, -3.0, "b", 80.0, ("o", "t")), "k2": (None, 4.0, "a", 70.0, ("p", "t")),
                   "only_old": (1, 1.0, "a", 1.0, None), "only_new": (2, None, None, None, None)}
    again = merge.merge_preserving(merged, new, ["game_key"])
    assert {r.game_key: tuple(r)[1:] for r in again.collect()} == got


def test_backfill_only_touches_the_lookback(spark):
    schema = "game_id long, season int, wk int, home_score int, away_score int"
    stored = spark.createDataFrame([(1, 2025, 5, None, None), (2, 2025, 7, None, 3), (3, 2025, 8, 1, 2), (4, 2025, 8, None, None), (5, 2025, 9, None, None)], schema)
    master = spark.createDataFrame([(1, 2025, 5, 9, 9), (2, 2025, 7, 10, 3), (3, 2025, 8, 7, 7), (5, 2025, 9, 1, 1)], schema)
    current = spark.createDataFrame([(2025, 9)], "season int, wk int")
    out = {r.game_id: (r.home_score, r.away_score, r.score_status) for r in merge.backfill_scores(stored, master, current, ["season"], ["game_id"]).collect()}
    assert out == {2: (10, 3, "updated"), 3: (1, 2, "kept"), 4: (None, None, "skipped")}
    over = {r.game_id: (r.home_score, r.score_status) for r in merge.backfill_scores(stored, master, current, ["season"], ["game_id"], overwrite=True).collect()}
    assert over[3] == (7, "updated")


def test_backfill_scores_query_looks_twenty_weeks_back(spark, tmp_path):
    import __spark_entry__ as entry

    # One game a week from Monday 2024-01-01; the scores of all are missing in the stored rows.
    spark.sql("""SELECT 7L * w AS o_orderkey, 8L AS o_custkey, to_timestamp(date_add(DATE'2024-01-01', 7 * (w - 1))) AS o_orderdate, 'F' AS o_orderstatus,
                        CAST(100 AS DECIMAL(15, 2)) AS o_totalprice, '1-URGENT' AS o_orderpriority FROM (SELECT explode(sequence(1, 50)) AS w)"""
              ).write.parquet(f"{tmp_path}/orders.parquet")
    out = {r.game_id // 7: r.score_status for r in entry.queries()["backfill_scores"](spark, str(tmp_path)).collect()}
    # Games with a key of 4 modulo 9 and other than 3 modulo 11 are only in the rebuilt rows.
    assert out == {w: "updated" for w in range(30, 50) if 7 * w % 9 != 4 or 7 * w % 11 == 3}


def test_one_to_one_join_fails_on_duplicates(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    good = spark.createDataFrame([(1, "a")], "k int, v string")
    assert sorted(map(tuple, joins.join_one_to_one(left, good, ["k"]).collect())) == [(1, "a"), (2, None)]
    with pytest.raises(Exception, match="duplicate key"):
        joins.join_one_to_one(left, good.union(good), ["k"]).collect()


def test_timeline_update_fills_only_blanks(spark):
    df = spark.sql("""SELECT array(named_struct('season', 2025, 'week', 1, 'ats', 'W', 'to_margin', double('NaN')),
                                   named_struct('season', 2025, 'week', 2, 'ats', ' ', 'to_margin', 3.0D)) AS e""")
    out = df.select(nested.update_timeline_entry("e", F.lit(2025), F.lit(1), F.lit("L"), F.lit(1.456)).alias("a"),
                    nested.update_timeline_entry("e", F.lit(2025), F.lit(2), F.lit("L"), F.lit(9.0)).alias("b"),
                    nested.update_timeline_entry("e", F.lit(2024), F.lit(1), F.lit("L"), F.lit(9.0))[1]["ats"].alias("c")).first()
    assert (out.a[0].ats, out.a[0].to_margin) == ("W", 1.46) and (out.b[1].ats, out.b[1].to_margin) == ("L", 3.0) and out.c == " "


def test_content_equal_sees_changes(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y")], "k int, v string")
    assert quality.content_equal(a, a.orderBy(F.desc("k"))).first().equal
    assert not quality.content_equal(a, a.dropDuplicates()).first().equal
    assert not quality.content_equal(a, a.withColumn("v", F.upper("v"))).first().equal


def test_latest_per_key_first_of_equal_times(spark):
    df = spark.createDataFrame([("k", at("2025-01-01 00:00"), 2), ("k", at("2025-01-01 00:00"), 1), ("k", None, 0)], "k string, ts timestamp, seq int")
    assert [r.seq for r in ranks.latest_per_key(df, ["k"], "ts", ["seq"]).collect()] == [1]


def test_week_sink_and_readers(spark, tmp_path):
    root = str(tmp_path / "out")
    df = spark.createDataFrame([(1, 2024, 1, "x"), (2, 2025, 1, "y"), (3, 2025, 2, "z")], "game_id long, season int, wk int, v string")
    for r in df.collect():
        spark.createDataFrame([(r.game_id, r.v)], "game_id long, v string").write.json(f"{root}/{r.season}_week{r.wk}")
    got = files.read_week_partitions(spark, root, "game_id LONG, v STRING", "json")
    assert sorted((r.game_id, r.season, r.wk) for r in got.collect()) == [(2, 2025, 1), (3, 2025, 2)]
    everything = files.read_week_partitions(spark, root, "game_id LONG, v STRING", "json", newest_season_only=False)
    assert everything.count() == 3


def test_xml_and_csv_readers(spark, tmp_path):
    (tmp_path / "odds.xml").write_text("""<odds><event><home_team>A</home_team><away_team>B</away_team><rot_home>101</rot_home>
        <start_time>2025-09-07T17:00:00Z</start_time><spread><away>+3.5</away></spread><total><points>44</points></total>
        <moneyline><home>-150</home><away>+130</away></moneyline></event><event start_time_utc="t"><home_team></home_team><away_team>C</away_team></event></odds>""")
    rows = files.read_odds_xml(spark, str(tmp_path / "odds.xml"), "close").collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.home_raw, r.rotation_home, r.spread_home_relative, r.total, r.moneyline_home, r.moneyline_away, r.is_closing) == ("A", 101, -3.5, 44.0, -150, 130, True)
    (tmp_path / "r.csv").write_text("TEAM,Pr,hfa\n A ,81.5,\nB,x,2\n")
    got = {r.team: (r.pr, r.hfa, r.sos) for r in files.read_ratings_csv(spark, str(tmp_path / "r.csv")).collect()}
    assert got == {"A": (81.5, None, None), "B": (None, 2.0, None)}
    (tmp_path / "bad.csv").write_text("name\nA\n")
    with pytest.raises(ValueError, match="team"):
        files.read_ratings_csv(spark, str(tmp_path / "bad.csv"))
    (tmp_path / "m.csv").write_text("Team,PF\nA b,1\nC,2\nA-B,3\n")
    assert {r.team_key: r.PF for r in files.read_metrics_csv(spark, str(tmp_path / "m.csv"), "Team STRING, PF DOUBLE").collect()} == {"ab": 3.0, "c": 2.0}


def test_skipped_page_line_does_not_claim_its_rank(spark):
    from duelframe.operators.ranks import dedupe_first

    lines = spark.createDataFrame([("p", 1, "X", 0), ("p", 2, "X", 1), ("p", 2, "Y", 2), ("q", 1, "X", 0)], "page string, r int, t string, pos int")
    got = dedupe_first(lines, ["page"], "r", "t", "pos").collect()
    assert sorted((x.page, x.r, x.t) for x in got) == [("p", 1, "X"), ("p", 2, "Y"), ("q", 1, "X")]


def test_rating_weeks_before_the_first(spark):
    from duelframe.operators.ratings import fill_rating_weeks

    ratings = spark.createDataFrame([(1, 0, "A", 5.0), (1, 4, "A", 7.0)], "season int, wk int, team string, pr double")
    weeks = spark.createDataFrame([(1, 5)], "season int, _last int")
    got = fill_rating_weeks(ratings, weeks, ["season"], ["pr"]).collect()
    assert sorted((x.wk, x.rating_week) for x in got) == [(0, 0), (1, 0), (2, 0), (3, 0), (4, 4), (5, 4)]


def test_grid_has_weeks_below_one(spark):
    from duelframe.operators.teams import to_date

    weekly = spark.createDataFrame([(1, 0, "A", 3), (1, 2, "A", 4), (1, 2, "B", 1)], "season int, wk int, team string, pts int")
    got = to_date(weekly, ["pts"], ["season"]).collect()
    assert sorted((x.team, x.wk, x.pts) for x in got) == [("A", 0, 0), ("A", 1, 3), ("A", 2, 3), ("B", 1, 0), ("B", 2, 0)]


def test_later_metrics_file_wins(spark, tmp_path):
    from duelframe.sources.files import read_metrics_csv

    (tmp_path / "a.csv").write_text("Team,PF\nT1,1\n")
    (tmp_path / "b.csv").write_text("Team,PF\n" + "".join(f"U{i},0\n" for i in range(500)) + "T1,2\n")
    got = read_metrics_csv(spark, str(tmp_path), "Team string, PF int").where("Team = 'T1'").collect()
    assert [x.PF for x in got] == [2]


@pytest.mark.parametrize("pool_rows", [100_000, 50])
def test_ranks_span_a_whole_pool(spark, monkeypatch, pool_rows):
    from pyspark.sql import functions as F

    from duelframe.operators import ranks

    monkeypatch.setattr(ranges, "POOL_ROWS", pool_rows)
    # 400 teams of one pool, a third of them with one value, some without any, two infinite.
    inf = float("inf")
    data = [(t, None if t % 10 == 9 else inf if t == 5 else -inf if t == 8 else 7.0 if t % 3 == 0 else (t * 37 % 101) / 4) for t in range(400)]
    df = spark.createDataFrame(data, "team int, v double").withColumn("s", F.lit(1))
    for high in (True, False):
        values = sorted({v for _, v in data if v is not None}, reverse=high)
        dense = {r.team: r.v_rank for r in ranks.dense_rank_league(df, ["s"], {"v": high}).collect()}
        assert dense == {t: None if v is None else values.index(v) + 1 for t, v in data}
        order = sorted((t for t, v in data if v is not None), key=lambda t: (-data[t][1] if high else data[t][1], t))
        got = {r.team: r.n for r in ranks.ordinal_rank(df, ["s"], "v", "team", "n", high).collect()}
        assert got == {t: order.index(t) + 1 if v is not None else None for t, v in data}
        both = ranks.ordinal_ranks(df.withColumn("w", -F.col("v")), ["s"], {"v": high, "w": not high}, "team").collect()
        assert {r.team: r.v_rank for r in both} == {r.team: r.w_rank for r in both} == got
        assert {r.team: r.v for r in both} == dict(data)


def test_a_hot_pool_beside_small_ones(spark, monkeypatch):
    """Two metrics, a null pool, NaN and negative zero; both ways of ranking give one result."""
    from duelframe.operators import ranks

    rows = [(1 if t % 3 else None if t % 2 else t % 7, t, [float(t % 11), -0.0, 0.0, None, float("nan")][t % 5], t % 13) for t in range(300)]
    df = spark.createDataFrame(rows, "s int, team int, v double, u int")
    out = []
    for pool_rows in (1000, 60, 0):
        monkeypatch.setattr(ranges, "POOL_ROWS", pool_rows)
        dense = ranks.dense_rank_league(df, ["s"], {"v": True, "u": False})
        out.append([sorted(map(repr, x.collect())) for x in (dense, ranks.ordinal_ranks(df, ["s"], {"v": True, "u": False}, "team"),
                                                            ranks.contiguous_rank(df, ["s"], F.col("u") > 3, "u", "team", "n"))])
    assert out[0] == out[1] == out[2] and len(out[0][0]) == len(out[0][1]) == 300


def test_an_outlier_does_not_fill_one_range(spark):
    from duelframe.operators import ranks

    df = spark.range(200_000).select(F.lit(1).alias("s"), F.col("id").alias("team"),
                                     F.when(F.col("id") == 0, 1e12).otherwise(F.rand(3)).alias("v"))
    sizes = [r["count"] for r in ranges.dealt(df, ["s"], [F.col("v"), F.col("team")]).groupBy("_range").count().collect()]
    assert sum(sizes) == 200_000 and max(sizes) <= 2 * 200_000 / len(sizes) and len(sizes) >= 7
    # The same with one value for all: the tie splits it.
    same = ranges.dealt(df.withColumn("v", F.lit(1.0)), ["s"], [F.col("v"), F.col("team")]).groupBy("_range").count().collect()
    assert max(r["count"] for r in same) <= 2 * 200_000 / len(same)


LATE_GAMES = "game_id long, season int, kickoff timestamp, home_id int, away_id int, home_score int, away_score int, spread double"


def test_late_scores_move_only_later_records(spark, tmp_path):
    """Random seasons; a third of all games are one team's. Scores come late, change and go: equal to a new calculation."""
    import random

    rng = random.Random(5)
    base = dt.datetime(2024, 9, 1)
    games = [(i, 2020 + i % 3, base + dt.timedelta(hours=6 * rng.randrange(0, 200)), 1 if i % 3 == 0 else rng.randrange(2, 9), rng.randrange(10, 19),
              None if i % 4 == 0 else rng.randrange(0, 5), rng.randrange(0, 5), rng.choice([None, -1.0, 0.0, 2.5])) for i in range(300)]
    # Season 2022 stays as it is.
    after = [(*g[:5], rng.randrange(0, 5) if g[5] is None else None if g[0] % 25 == 1 else g[5], *g[6:]) if g[1] != 2022 and g[0] % 5 < 3 else g for g in games]
    old, new = (spark.createDataFrame(x, LATE_GAMES) for x in (games, after))
    keep = ["game_id", "season", "kickoff"]

    def records(df):
        flags = [f"{f}_before" for f in teams.outcome_flags()]
        return teams.record_before(teams.to_team_rows(df, keep), ["season"]).select("game_id", "season", "team", "kickoff", *flags)

    records(old).write.partitionBy("season").parquet(str(tmp_path / "r"))
    stored = spark.read.parquet(str(tmp_path / "r"))
    moved = new.join(old.select("game_id", F.col("home_score").alias("h")), "game_id").where("NOT home_score <=> h").drop("h")
    changes = deltas.record_changes(old.join(moved.select("game_id"), "game_id", "left_semi"), moved, ["season"])
    updates = deltas.updated_records(stored, changes, ["season"])
    got = deltas.patched(stored, updates, ["game_id", "team"])
    want = sorted(map(tuple, records(new).select(*stored.columns).collect()))
    assert sorted(tuple(r)[:-1] for r in got.collect()) == want
    before = {tuple(r) for r in stored.collect()}
    assert {tuple(r) for r in updates.collect()} == set(want) - before
    # Only the files of the changed seasons are read.
    text = updates._sc._jvm.PythonSQLUtils.explainString(updates._jdf.queryExecution(), "formatted")
    assert re.search(r"PartitionFilters: \[[^\]]*season#\d+ IN \(2020,2021\)", text)


def test_patches_reach_single_entries(spark):
    """Chunks of two entries; blanks are filled, other entries and chunks stay."""
    from duelframe.plans import timelines

    base = dt.datetime(2024, 9, 1)
    rows = [(i, 2024, 1 + i // 2, base + dt.timedelta(days=i), "a" if i % 3 else "b", None if i % 2 else "L", float("nan") if i % 4 == 1 else None if i % 2 else 1.0)
            for i in range(12)]
    df = spark.createDataFrame(rows, "game_id long, season int, wk int, kickoff timestamp, team string, ats string, to_margin double")
    chunks = timelines.timeline_chunks(df, ["season"], ["ats", "to_margin"], chunk=2)
    index = timelines.chunk_index(chunks, ["season"])
    assert {(r.team, r.game_id) for r in index.collect()} == {(x[4], x[0]) for x in rows}
    outcomes = spark.createDataFrame([("a", 1, "W", 2.004), ("a", 2, "W", 9.0), ("b", 3, "P", 0.0), ("a", 99, "W", 1.0), ("b", 3, "P", 0.0)],
                                     "team string, game_id long, ats string, to_margin double")
    out = timelines.patch_chunks(chunks, index, outcomes, ["season"])
    got = {(r.team, e.tie): (e.ats, e.to_margin) for r in out.collect() for e in r.entries}
    want = {(x[4], x[0]): (x[5], x[6]) for x in rows} | {("a", 1): ("W", 2.0), ("b", 3): ("P", 0.0)}
    assert {k: repr(v) for k, v in got.items()} == {k: repr(v) for k, v in want.items()}
    assert sum(r.is_patched for r in out.collect()) == 2
    record = {r.team: (r.w, r.l, r.p, r.games, r.record) for r in timelines.chunk_records(out, ["season"]).collect()}
    assert record == {"a": (1, 4, 0, 8, "1-4-0"), "b": (0, 2, 1, 4, "0-2-1")}
    assert timelines.patch_chunks(chunks, index, outcomes.where("false"), ["season"]).where("is_patched").count() == 0


def test_bag_difference_counts_repeated_rows(spark):
    schema = "k int, v string"
    left = [(1, "a")] * 3 + [(2, None)] * 2 + [(3, "c"), (4, "d")] + [(i, "x") for i in range(10, 20)]
    right = [(1, "a"), (2, None), (2, None), (3, "c"), (3, "c"), (5, None)]
    a, b = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    got = merge.bag_difference(a, b, ["k", "v"])
    expanded = lambda side: sorted(((r.k, r.v) for r in got.collect() for _ in range(r[side])), key=repr)
    assert expanded("only_left") == sorted(map(tuple, a.exceptAll(b).collect()), key=repr)
    assert expanded("only_right") == sorted(map(tuple, b.exceptAll(a).collect()), key=repr)
    report = {r.status: r for r in merge.bag_samples(got, ["k", "v"], 3).collect()}
    assert (report["only_left"].rows, report["only_left"].times) == (12, 13) and [x.k for x in report["only_left"].sample] == [1, 4, 10]
    assert (report["only_right"].rows, report["only_right"].times, len(report["only_right"].sample)) == (2, 2, 2)
    assert merge.bag_difference(a, a.orderBy(F.desc("k")), ["k", "v"]).count() == 0
