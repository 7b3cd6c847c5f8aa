"""Pin feed events to scheduled games by sides and time, without forming candidate pairs.

Events and games of one pair of sides are laid on a common time line. For each event only the
nearest game before and the nearest after, per orientation, can win; both are carried along the
line, once per direction. Cost is linear in events plus games; a pair of sides with a third of
all rows, even on one day, is dealt by ranges that follow its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import scratch_dir
from .ranges import by_size, ranged_last, spread, window_last
from .ranks import best_per_key
from .skew import calendar, skew_join

MICROS = 1_000_000


def nearest_by_pair(probes: DataFrame, points: DataFrame, reach_seconds: int, probe_at: str, point_at: str,
                    home: str = "home", away: str = "away") -> DataFrame:
    """Add ``near``: up to four nearest points (before/after x same/swapped roles) in reach.

    ``points`` must be unique on (home, away, time). Each element of ``near`` has the point's
    columns plus ``swapped``, ``delta`` (seconds) and ``same_date``. Probes without sides or
    time keep an empty array.
    """
    lo, hi = F.least(home, away), F.greatest(home, away)
    point_known = F.col(home).isNotNull() & F.col(away).isNotNull() & F.col(point_at).isNotNull()
    usable = F.col(probe_at).isNotNull() & F.col(home).isNotNull() & F.col(away).isNotNull()
    slots = points.where(point_known).select(
        lo.alias("_lo"), hi.alias("_hi"), F.unix_micros(F.col(point_at)).alias("_at"), F.lit(0).alias("_kind"),
        (F.col(home) == lo).alias("_fwd"), F.struct(*points.columns).alias("_point"), F.lit(None).alias("_probe"),
        F.lit(0).cast("long").alias("_spread"))
    asks = probes.where(usable).select(
        lo.alias("_lo"), hi.alias("_hi"), F.unix_micros(F.col(probe_at)).alias("_at"), F.lit(1).alias("_kind"),
        (F.col(home) == lo).alias("_fwd"), F.lit(None).alias("_point"), F.struct(*probes.columns).alias("_probe"),
        spread(probes).alias("_spread"))
    tagged = F.struct(F.col("_at").alias("at"), F.col("_fwd").alias("fwd"), F.col("_point").alias("point"))
    is_slot = F.col("_kind") == 0
    line = slots.unionByName(asks).select(
        "_lo", "_hi", "_at", "_kind", "_fwd", "_probe", "_spread",
        *[F.when(is_slot & (F.col("_fwd") == F.lit(fwd)), tagged).alias(f"{name}{int(fwd)}")
          for name in ("_b", "_a") for fwd in (True, False)])

    pair = ["_lo", "_hi"]
    # "Nearest after" also runs over preceding rows, of the reversed order: a frame that
    # reaches forward would be rebuilt for every row.
    passes = [([F.asc("_at"), F.asc("_kind"), F.asc("_spread")], ["_b1", "_b0"]),
              ([F.desc("_at"), F.asc("_kind"), F.asc("_spread")], ["_a1", "_a0"])]

    def both(step):
        def run(rows: DataFrame) -> DataFrame:
            for order, names in passes:
                rows = step(rows, pair, order, names)
            return rows
        return run

    seen = by_size(line, pair, both(window_last), both(ranged_last))
    reach = int(reach_seconds) * MICROS
    found = F.array("_b1", "_b0", "_a1", "_a0")
    # A game at the event's own instant is both "before" and "after": keep one of them.
    near = F.array_distinct(F.filter(found, lambda c: c.isNotNull() & (F.abs(c["at"] - F.col("_at")) <= reach)))
    day = F.to_date(F.timestamp_micros("_at"))
    shaped = F.transform(near, lambda c: F.struct(
        *[c["point"][name].alias(name) for name in points.columns],
        (c["fwd"] != F.col("_fwd")).alias("swapped"),
        (F.abs(c["at"] - F.col("_at")) / F.lit(float(MICROS))).alias("delta"),
        (F.to_date(F.timestamp_micros(c["at"])) == day).alias("same_date"),
        F.abs(F.datediff(F.to_date(F.timestamp_micros(c["at"])), day)).alias("days")))
    out = seen.where("_kind = 1").select("_probe.*", shaped.alias("near"))
    # Probes without sides or time share no key with anything: they go round the time line.
    alone = probes.where(~usable).select("*", F.array().cast(out.schema["near"].dataType).alias("near"))
    return out.unionByName(alone)


def game_slots(games: DataFrame, key: str, kickoff: str, home: str, away: str, neutral: str | None,
               carry: list[str] | None = None) -> DataFrame:
    """One row per (home, away, kickoff): neutral-site games first, then the smallest key.

    ``ties`` counts the games that share the best rank, so later ties stay visible.
    """
    flag = F.coalesce(F.col(neutral), F.lit(False)) if neutral else F.lit(False)
    rank = F.when(flag, 0).otherwise(1)
    columns = [key, *(carry or [])]
    grouped = games.groupBy(home, away, kickoff).agg(
        F.min_by(F.struct(*columns), F.struct(rank, F.col(key))).alias("_best"),
        F.min(rank).alias("neutral_rank"), F.count_if(flag).alias("_neutral"), F.count(F.lit(1)).alias("_all"))
    ties = F.when(F.col("neutral_rank") == 0, F.col("_neutral")).otherwise(F.col("_all"))
    return grouped.select(F.col(home).alias("home"), F.col(away).alias("away"), F.col(kickoff).alias("kickoff"),
                          "neutral_rank", ties.alias("ties"), "_best.*")


def pin_events(events: DataFrame, games: DataFrame, key: str = "game_id", kickoff: str = "kickoff",
               event_ts: str = "event_ts", home: str = "home", away: str = "away", game_home: str = "home_id",
               game_away: str = "away_id", neutral: str | None = None, carry: list[str] | None = None,
               day_window: int = 3, max_hours: float = 36, allow_swap: bool = True,
               strict_ties: bool = True) -> DataFrame:
    """Every event with its game, or with the reason it stays unpinned in ``why``.

    Same roles beat swapped roles; then the smallest time difference, neutral site first.
    What still ties is ``ambiguous`` under ``strict_ties``, else the smallest key wins.
    A negative ``max_hours`` leaves only the day window.
    """
    carry = carry or []
    slots = game_slots(games, key, kickoff, game_home, game_away, neutral, carry)
    slots = slots.select(F.col("home").alias(home), F.col("away").alias(away), F.col("kickoff").alias("_kickoff"),
                         "neutral_rank", "ties", key, *carry)
    reach = int(max_hours * 3600) if max_hours >= 0 else (day_window + 1) * 86400
    matched = nearest_by_pair(events, slots, reach, event_ts, "_kickoff", home, away)
    in_days = F.filter("near", lambda c: c["days"] <= day_window)
    direct = F.filter(in_days, lambda c: ~c["swapped"])
    pool = F.when(F.size(direct) > 0, direct)
    if allow_swap:
        pool = pool.otherwise(F.filter(in_days, lambda c: c["swapped"]))
    else:
        pool = pool.otherwise(direct)
    matched = matched.withColumn("_pool", pool)
    best = F.array_min(F.transform("_pool", lambda c: F.struct(
        c["delta"], c["neutral_rank"], c[key], c["swapped"], c["_kickoff"].alias("kickoff"),
        *[c[x] for x in carry])))
    matched = matched.withColumn("_best", best)
    same = F.aggregate(
        F.filter("_pool", lambda c: (c["delta"] == F.col("_best.delta"))
                 & (c["neutral_rank"] == F.col("_best.neutral_rank"))),
        F.lit(0).cast("long"), lambda acc, c: acc + c["ties"])
    why = F.when(F.col(event_ts).isNull(), "invalid_event_time").when(F.col("_best").isNull(), "no_candidate")
    if strict_ties:
        why = why.when(same > 1, "ambiguous")
    matched = matched.withColumn("why", why)
    ok = F.col("why").isNull()
    return matched.select(
        *events.columns, F.when(ok, F.col(f"_best.{key}")).alias(key), F.when(ok, F.col("_best.kickoff")).alias(kickoff),
        *[F.when(ok, F.col(f"_best.{c}")).alias(c) for c in carry],
        F.when(ok, F.col("_best.swapped")).alias("role_swapped"), "why")


def pinned(matched: DataFrame) -> DataFrame:
    return matched.where("why IS NULL").drop("why")


def quarantined(matched: DataFrame, events: DataFrame) -> DataFrame:
    return matched.where("why IS NOT NULL").select(*events.columns, "why")


TIER_NAMES = ["ordered_exact", "unordered_exact", "ordered_near", "unordered_near"]


def tiered_match(events: DataFrame, games: DataFrame, event_id: str = "event_id", key: str = "game_id",
                 kickoff: str = "kickoff", event_ts: str = "event_ts", home: str = "home", away: str = "away",
                 game_home: str = "home_id", game_away: str = "away_id", exact_minutes: int = 5,
                 near_minutes: int = 120) -> DataFrame:
    """Four tiers of match, at most one event per game and one game per event.

    In rounds: each event takes its best game by (tier, time difference, key); each game then keeps its best event by
    (tier, time difference, event). Events that lose their game go on with the games still free, until no unmatched
    event has a free game in reach. In each round every losing event sees one of its games go for good, so there are at most
    as many rounds as one event has games of its sides within ``near_minutes``, whatever the size of the tables. Unmatched
    events carry ``why``.
    """
    exact = exact_minutes * 60

    def tier(c: Column) -> Column:
        close = F.when(c["delta"] <= exact, 1).when(c["same_date"], 3)
        return close + c["swapped"].cast("int")

    def choose(asks: DataFrame, free: DataFrame) -> DataFrame:
        slots = game_slots(free, key, kickoff, game_home, game_away, None)
        slots = slots.select(F.col("home").alias(home), F.col("away").alias(away), F.col("kickoff").alias("_kickoff"), key)
        near = nearest_by_pair(asks, slots, near_minutes * 60, event_ts, "_kickoff", home, away)
        best = F.array_min(F.filter(
            F.transform("near", lambda c: F.struct(tier(c).alias("tier"), c["delta"], c[key])),
            lambda c: c["tier"].isNotNull()))
        picked = near.withColumn("_best", best)
        tagged = picked.select(*events.columns, F.col(f"_best.{key}").alias(key), F.col("_best.tier").alias("tier"),
                               F.col("_best.delta").alias("delta"))
        matched = tagged.where(F.col(key).isNotNull() & F.col(event_id).isNotNull())
        winners = best_per_key(matched, [key], "tier", "delta", event_id).select(
            F.col(event_id), F.lit(True).alias("_won"))
        return _stored(tagged.join(winners, [event_id], "left"))

    won = F.col("_won").isNotNull()
    lost = F.col(key).isNotNull() & F.col(event_id).isNotNull() & ~won
    # Only games of sides with a losing event can still be wanted.
    pair = [F.least(home, away).alias("_lo"), F.greatest(home, away).alias("_hi")]
    free = games.select(key, kickoff, game_home, game_away)
    out = choose(events, free)
    losers = out.where(lost)
    settled = out.where(~lost)
    while not losers.isEmpty():
        wanted = free.withColumns({"_lo": F.least(game_home, game_away), "_hi": F.greatest(game_home, game_away)})
        wanted = skew_join(wanted, losers.select(*pair).distinct(), ["_lo", "_hi"], "left_semi").drop("_lo", "_hi")
        free = _stored(skew_join(wanted, out.where(won).select(key), [key], "left_anti"))
        out = choose(losers.select(*events.columns), free)
        losers = out.where(lost)
        settled = settled.unionByName(out.where(~lost))

    label = F.element_at(F.array(*[F.lit(t) for t in TIER_NAMES]), F.col("tier"))
    why = (F.when(won, F.lit(None).cast("string"))
           .when(F.col(home).isNull() | F.col(away).isNull(), "name_mismatch")
           .when(F.col(event_ts).isNull(), "invalid_commence_time")
           .otherwise("no_schedule_candidate"))
    return settled.select(*events.columns, F.when(won, F.col(key)).alias(key), F.when(won, label).alias("tier"),
                          F.when(won, F.col("delta")).alias("delta"), why.alias("why"))


def _stored(df: DataFrame) -> DataFrame:
    """The rows of ``df``, written once: a later round does not compute the earlier ones again."""
    path = scratch_dir(df.sparkSession, "tiers")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def enrich_missing(games: DataFrame, odds: DataFrame, key: str = "game_id", kickoff: str = "kickoff",
                   home: str = "home_id", away: str = "away_id", odds_ts: str = "event_ts",
                   fields: dict[str, str] | None = None, seconds: int = 600, ties: list[str] | None = None,
                   digits: int = 1) -> DataFrame:
    """Fill missing spread and total from odds: by key, else same sides within ten minutes.

    ``fields`` maps a game column to the odds column that may fill it. An odds row without a
    time is used for its sides when nothing else matches.
    """
    fields = fields or {"spread": "spread_home_relative", "total": "total_points"}
    ties = ties or []
    values = list(fields.values())
    useful = odds.where(F.coalesce(*[F.col(v).cast("double") for v in values]).isNotNull())
    packed = F.struct(*[F.col(v).cast("double").alias(v) for v in values])
    order = F.struct(*ties) if ties else F.struct(*values)

    by_key = (useful.where(F.col(key).isNotNull()).groupBy(key)
              .agg(F.min_by(packed, order).alias("_by_key")))
    timed = (useful.where(F.col(odds_ts).isNotNull()).groupBy(home, away, odds_ts)
             .agg(F.min_by(packed, order).alias("_line")))
    untimed = (useful.where(F.col(odds_ts).isNull()).groupBy(home, away)
               .agg(F.min_by(packed, order).alias("_untimed")))

    near = nearest_by_pair(games, timed.withColumnRenamed(odds_ts, "_odds_at"), seconds, kickoff, "_odds_at", home, away)
    same_roles = F.array_min(F.transform(
        F.filter("near", lambda c: ~c["swapped"]), lambda c: F.struct(c["delta"], c["_odds_at"], c["_line"])))
    out = near.withColumn("_near", same_roles["_line"]).drop("near")
    out = skew_join(out, by_key, [key], "left")
    out = skew_join(out, untimed, [home, away], "left", spread_by=[key])
    line = F.coalesce("_by_key", "_near", "_untimed")
    filled = [F.coalesce(F.col(g).cast("double"), F.round(line[o], digits)).alias(g) for g, o in fields.items()]
    changed = F.lit(False)
    for g, o in fields.items():
        changed = changed | (F.col(g).isNull() & line[o].isNotNull())
    rest = [c for c in games.columns if c not in fields]
    return out.select(*rest, *filled, F.coalesce(changed, F.lit(False)).alias("enriched"))


def week_windows(games: DataFrame, by: list[str], week: str = "wk", kickoff: str = "kickoff") -> DataFrame:
    """Seven-day window of each week, from the Tuesday on or before its first kickoff."""
    from ..functions.times import tuesday_start

    first = games.where(F.col(kickoff).isNotNull()).groupBy(*by, week).agg(F.min(kickoff).alias("_first"))
    start = tuesday_start("_first")
    return first.select(*by, week, start.alias("start"), (start + F.expr("INTERVAL 7 DAYS")).alias("end"))


def week_of(df: DataFrame, windows: DataFrame, by: list[str], ts: str, week: str = "wk",
            name: str = "week") -> DataFrame:
    """Week of each timestamp: before the first window the first week, after it, or in a gap, the last.

    All windows start on a Tuesday, so the range condition is an equality on the Tuesday of
    the timestamp: no range join.
    """
    from ..functions.times import tuesday_start

    starts = windows.groupBy(*by, "start").agg(F.min(week).alias("_week"))
    ends = windows.groupBy(*by).agg(
        F.min("start").alias("_first_start"), F.min_by(week, F.struct("start", week)).alias("_first_week"),
        F.max_by(week, F.struct("start", week)).alias("_last_week"))
    probe = df.withColumn("start", tuesday_start(ts))
    out = probe.join(calendar(starts), [*by, "start"], "left")
    out = out.join(calendar(ends), by, "left")
    resolved = F.coalesce("_week", F.when(F.col(ts) < F.col("_first_start"), F.col("_first_week"))
                          .otherwise(F.col("_last_week")))
    return out.withColumn(name, F.when(F.col(ts).isNotNull(), resolved)).drop(
        "start", "_week", "_first_start", "_first_week", "_last_week")


def event_window_flags(events: DataFrame, games: DataFrame, event_ts: str = "event_ts", kickoff: str = "kickoff",
                       days_before: int = 6, days_after: int = 6, slack_days: int = 2) -> DataFrame:
    """Is an event inside the schedule's span, or clearly after or before it?"""
    # One row, whatever the size of the schedule.
    bounds = games.agg(F.min(kickoff).alias("_min"), F.max(kickoff).alias("_max"))
    ts = F.col(event_ts)

    def days(n: int) -> Column:
        return F.expr(f"INTERVAL {n} DAYS")

    joined = events.join(F.broadcast(bounds), how="cross")
    return joined.select(
        *events.columns,
        ((ts >= F.col("_min") - days(days_before)) & (ts <= F.col("_max") + days(days_after))).alias("in_window"),
        (ts > F.col("_max") + days(slack_days)).alias("is_future"),
        (ts < F.col("_min") - days(slack_days)).alias("is_past"))
