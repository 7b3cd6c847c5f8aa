"""Quote snapshots: newest, last before a cutoff, promotion to event columns, closing line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import lines
from ..functions.numbers import parse_number, to_number
from ..functions.names import compact_key
from ..functions.times import parse_utc
from .ranges import by_size, ranged_last, spread, window_last
from .skew import skew_join


def newest_first(ts: str, ties: list[str]) -> Column:
    """Ordering value for ``min_by``: newest timestamp, then smallest tie columns."""
    return F.struct((-F.unix_micros(F.col(ts))).alias("age"), *[F.col(t) for t in ties])


def asof_backward(left: DataFrame, right: DataFrame, by: list[str], cutoff: str, ts: str, payload: list[str],
                  ties: list[str], prefix: str = "asof_") -> DataFrame:
    """Newest right row per key at or before the left row's cutoff.

    ``left`` is unique on ``by``. Only (key, cutoff) meets the quotes; the winners are found
    with a partial aggregate before the shuffle, so a key with a third of all quotes
    sends one row per map task.
    """
    cutoffs = left.select(*by, F.col(cutoff).alias("_cutoff"))
    quotes = right.select(*by, *dict.fromkeys([ts, *payload, *ties]))
    seen = skew_join(quotes, cutoffs, by, spread_by=[ts, *ties]).where(F.col(ts) <= F.col("_cutoff"))
    best = seen.groupBy(*by).agg(
        F.min_by(F.struct(*[F.col(c).alias(f"{prefix}{c}") for c in payload]), newest_first(ts, ties)).alias("_best"))
    return left.join(best, by, "left").select(*left.columns, *[f"_best.{prefix}{c}" for c in payload])


def asof_history(left: DataFrame, right: DataFrame, by: list[str], cutoff: str, ts: str, payload: list[str],
                 ties: list[str], prefix: str = "asof_") -> DataFrame:
    """As-of join for many cutoffs per key and long histories: no pairs are formed.

    Both sides are laid on one time line per key and the last quote seen is carried forward. A key with more rows than one
    task may sort is dealt by ranges, also where they lie on one day or at one instant. Left rows without key or cutoff
    find nothing and go round the time line; quotes without key or time are no quotes.
    """
    pay = F.struct(*[F.col(c).alias(f"{prefix}{c}") for c in payload])
    usable = F.col(cutoff).isNotNull()
    known = F.col(ts).isNotNull()
    for key in by:
        usable, known = usable & F.col(key).isNotNull(), known & F.col(key).isNotNull()
    quotes = right.where(known).select(
        *by, F.unix_micros(F.col(ts)).alias("_at"), F.lit(0).alias("_kind"), newest_first(ts, ties).alias("_order"),
        pay.alias("_quote"), F.lit(None).alias("_row"), F.lit(0).cast("long").alias("_spread"))
    probes = left.where(usable).select(
        *by, F.unix_micros(F.col(cutoff)).alias("_at"), F.lit(1).alias("_kind"), F.lit(None).alias("_order"),
        F.lit(None).alias("_quote"), F.struct(*left.columns).alias("_row"), spread(left).alias("_spread"))
    # Within one instant the best quote must come last, and probes after all quotes.
    order = [F.asc("_at"), F.asc("_kind"), F.desc("_order"), F.asc("_spread")]
    seen = by_size(quotes.unionByName(probes), by, lambda rows: window_last(rows, by, order, ["_quote"]),
                   lambda rows: ranged_last(rows, by, order, ["_quote"]))
    found = seen.where("_kind = 1").select("_row.*", *[F.col(f"_quote.{prefix}{c}") for c in payload])
    alone = left.where(~usable)
    types = {f.name: f.dataType for f in found.schema.fields}
    return found.unionByName(alone.select(*left.columns, *[F.lit(None).cast(types[f"{prefix}{c}"]).alias(f"{prefix}{c}") for c in payload]))


LINE_FIELDS = ["spread_home_relative", "total_points", "moneyline_home", "moneyline_away"]


def promote_lines(games: DataFrame, pinned: DataFrame, key: str = "game_id", kickoff: str = "kickoff",
                  policy: str = "latest", ties: list[str] | None = None,
                  markets: tuple[str, str, str] = ("spreads", "totals", "h2h")) -> DataFrame:
    """Best quote per (game, market) by (fetch time, book), markets turned into columns.

    ``policy="closing"`` looks only at quotes at or before kickoff and falls back to the newest
    quote where a market has none. The newest promoted quote names the primary book.
    """
    if policy not in ("latest", "closing"):
        raise ValueError(f"unknown policy: {policy}")
    ties = ties or []
    fields = [f for f in LINE_FIELDS if f in pinned.columns]
    quotes = pinned.where(F.col(key).isNotNull() & F.col("market").isNotNull() & F.col("book").isNotNull()
                          & F.col("fetch_ts").isNotNull())
    quotes = quotes.select(key, *dict.fromkeys(["market", "book", "fetch_ts", *fields, *ties]))
    if policy == "closing":
        quotes = skew_join(quotes, games.select(key, F.col(kickoff).alias("_kick")), [key],
                           spread_by=["fetch_ts", "book", "market", *ties])
        early = F.col("fetch_ts") <= F.col("_kick")
    else:
        quotes = skew_join(quotes, games.select(key), [key], spread_by=["fetch_ts", "book", "market", *ties])
        early = F.lit(False)

    # Newest quote per book first: this is what shrinks a hot game before anything else.
    # Early quotes sort before late ones, so one pass serves both policies.
    age = (-F.unix_micros("fetch_ts")).alias("age")
    per_book = quotes.groupBy(key, "market", "book").agg(
        F.min_by(F.struct("fetch_ts", *fields, early.alias("early")),
                 F.struct((~early).cast("int").alias("late"), age, *ties)).alias("q"))
    # Within one instant the greatest book name wins.
    per_market = per_book.groupBy(key, "market").agg(
        F.max_by(F.struct("book", "q"), F.struct(F.col("q.early").cast("int"), F.unix_micros("q.fetch_ts"),
                                                 F.col("book"))).alias("m"),
        F.count(F.lit(1)).alias("books"))

    spreads, totals, h2h = markets

    def pick(market: str, field: str) -> Column:
        source = F.col(f"m.q.{field}") if field in fields else F.lit(None).cast("double")
        return F.max(F.when(F.col("market") == market, source)).alias(field)

    newest = F.struct(F.unix_micros("m.q.fetch_ts"), F.col("market"))
    per_game = per_market.groupBy(key).agg(
        pick(spreads, "spread_home_relative"), pick(totals, "total_points"),
        pick(h2h, "moneyline_home"), pick(h2h, "moneyline_away"),
        F.max_by("m.book", newest).alias("odds_source"),
        F.max_by("m.q.fetch_ts", newest).alias("snapshot_at"),
        F.coalesce(F.max(F.when(F.col("market") == spreads, F.col("m.q.early"))), F.lit(False)).alias("is_closing"),
        F.sum("books").alias("used_records"), F.count(F.lit(1)).alias("markets"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(
            F.col("market"), F.struct(F.col("m.book").alias("book"), F.col("m.q.fetch_ts").alias("fetch_ts")))))
        ).alias("provenance"))
    return per_game.select(
        key, "spread_home_relative", lines.favored_side("spread_home_relative").alias("favored_side"),
        lines.favored_spread("spread_home_relative").alias("spread_favored_team"),
        F.col("total_points").alias("total"), "moneyline_home", "moneyline_away", "odds_source", "snapshot_at",
        "is_closing", "used_records", "markets", "provenance")


def closing_line(games: DataFrame, sources: list[tuple[str, DataFrame]], key: str = "game_id",
                 kickoff: str = "kickoff", spread: str = "spread_home_relative",
                 ties: list[str] | None = None) -> DataFrame:
    """Closing spread from the first source that has a quote at or before kickoff.

    ``sources`` are (label, quotes) in order of trust; every quote needs the key, ``fetch_ts``,
    ``book`` and the spread. All sources are read in one pass: the source's place is the first
    part of the ordering.
    """
    ties = ties or []
    tagged = None
    for place, (label, quotes) in enumerate(sources):
        part = quotes.where(F.col(spread).isNotNull()).select(
            key, F.lit(place).alias("_place"), F.lit(label).alias("source"), "book", "fetch_ts",
            F.col(spread).cast("double").alias("closing_spread"), *ties)
        tagged = part if tagged is None else tagged.unionByName(part)
    seen = skew_join(tagged, games.select(key, F.col(kickoff).alias("_kick")), [key],
                     spread_by=["fetch_ts", "book", *ties]).where("fetch_ts <= _kick")
    best = seen.groupBy(key).agg(F.min_by(
        F.struct("source", "book", "fetch_ts", "closing_spread"),
        F.struct("_place", (-F.unix_micros("fetch_ts")).alias("age"), "book", *ties)).alias("c"))
    return best.select(key, F.col("c.source").alias("source"), F.col("c.book").alias("book"),
                       F.col("c.fetch_ts").alias("fetched_ts"), "c.closing_spread",
                       lines.favored_side("c.closing_spread").alias("favored_side"))


def flatten_odds(events: DataFrame, token=compact_key) -> DataFrame:
    """Provider events (event -> book -> market -> outcomes) to one row per book and market."""
    books = events.select(
        F.col("id").alias("event_id"), parse_utc("commence_time").alias("event_start"),
        F.col("home_team").alias("home_raw"), F.col("away_team").alias("away_raw"),
        token("home_team").alias("home_token"), token("away_team").alias("away_token"),
        F.explode("bookmakers").alias("b"))
    rows = books.select("event_id", "event_start", "home_raw", "away_raw", "home_token", "away_token",
                        F.coalesce("b.key", F.lit("unknown")).alias("book"), F.col("b.title").alias("book_title"),
                        F.explode("b.markets").alias("m"))
    outcomes = F.transform("m.outcomes", lambda o: F.struct(
        o["name"].alias("name"), token(o["name"]).alias("token"),
        F.rint(to_number(o["price"])).try_cast("int").alias("price"), parse_number(o["point"]).alias("point")))
    return rows.select("event_id", "event_start", "home_raw", "away_raw", "home_token", "away_token", "book",
                       "book_title", F.col("m.key").alias("market"), parse_utc("m.last_update").alias("market_last_update"),
                       outcomes.alias("outcomes"))


def _first(outcomes: Column, test) -> Column:
    return F.try_element_at(F.filter(outcomes, test), F.lit(1))


def extract_lines(rows: DataFrame, home: str = "home_token", away: str = "away_token",
                  swapped: str | None = "role_swapped", outcomes: str = "outcomes") -> DataFrame:
    """Line columns from an outcomes array; ``swapped`` rows read the roles the other way round."""
    arr = F.col(outcomes)
    flip = F.coalesce(F.col(swapped), F.lit(False)) if swapped else F.lit(False)
    home_token = F.when(flip, F.col(away)).otherwise(F.col(home))
    away_token = F.when(flip, F.col(home)).otherwise(F.col(away))
    is_spread, is_total, is_money = (F.col("market") == m for m in ("spreads", "totals", "h2h"))
    # Each outcome is searched for once; prices and lines are then plain field reads.
    found = rows.select(
        "*",
        F.when(is_spread | is_money, _first(arr, lambda o: o["token"] == home_token)).alias("_home"),
        F.when(is_spread | is_money, _first(arr, lambda o: o["token"] == away_token)).alias("_away"),
        F.when(is_total, _first(arr, lambda o: F.lower(o["name"]).startswith("over"))).alias("_over"),
        F.when(is_total, _first(arr, lambda o: F.lower(o["name"]).startswith("under"))).alias("_under"),
        F.when(is_total, F.try_element_at(arr, F.lit(1))).alias("_any"))
    found = found.withColumn("_spread", F.when(is_spread, F.coalesce("_home.point", -F.col("_away.point"))))
    return found.select(
        *rows.columns, F.col("_spread").alias("spread_home_relative"),
        lines.favored_side("_spread").alias("favored_side"), lines.favored_spread("_spread").alias("spread_favored_team"),
        F.when(is_spread, F.col("_home.price")).alias("home_price"),
        F.when(is_spread, F.col("_away.price")).alias("away_price"),
        F.coalesce("_over.point", "_under.point", "_any.point").alias("total_points"),
        F.col("_over.price").alias("over_price"), F.col("_under.price").alias("under_price"),
        F.when(is_money, F.col("_home.price")).alias("moneyline_home"),
        F.when(is_money, F.col("_away.price")).alias("moneyline_away"))


def pick_book(books, preferred: str = "pinnacle") -> Column:
    """The preferred bookmaker of an array by key or title, else the first."""
    arr = F.col(books) if isinstance(books, str) else books
    wanted = _first(arr, lambda b: (F.lower(b["key"]) == preferred) | (F.lower(b["title"]) == preferred))
    return F.coalesce(wanted, F.try_element_at(arr, F.lit(1)))


def snapshot_counts(rows: DataFrame, levels: tuple[str, str] = ("market", "book")) -> DataFrame:
    """Row counts per (market, book), per market and in total; missing names count as unknown."""
    named = rows.select(*[F.coalesce(F.col(c), F.lit("unknown")).alias(c) for c in levels])
    return named.rollup(*levels).agg(F.count(F.lit(1)).alias("n"))


def reason_counts(rows: DataFrame, known: list[str], reason: str = "why") -> DataFrame:
    """Counts per reason; reasons outside the known list go to "other"."""
    bucket = F.when(F.col(reason).isin(known), F.col(reason)).otherwise("other")
    return rows.groupBy(bucket.alias("reason")).agg(F.count(F.lit(1)).alias("n"))
