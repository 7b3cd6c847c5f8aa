"""Team-centric rows, season-to-date totals and records, for all cutoffs in one plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import lines
from .prefix import running_sums
from .skew import calendar


def to_team_rows(games: DataFrame, keep: list[str], home: str = "home_id", away: str = "away_id",
                 home_score: str = "home_score", away_score: str = "away_score", spread: str | None = "spread",
                 stats: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """Two rows per game, one per side, from one scan (no union, no shuffle).

    ``stats`` maps an output name to its (home column, away column); the other side's
    value comes along as ``opp_<name>``.
    """
    stats = stats or {}

    def side(own: int) -> Column:
        us, them = (home, away) if own == 0 else (away, home)
        pf, pa = (home_score, away_score) if own == 0 else (away_score, home_score)
        fields = [
            F.col(us).alias("team"), F.col(them).alias("opp"),
            F.lit("H" if own == 0 else "A").alias("site"),
            F.col(pf).alias("pf"), F.col(pa).alias("pa"), (F.col(pf) - F.col(pa)).alias("margin"),
        ]
        if spread is not None:
            line = F.col(spread).cast("double")
            fields.append((line if own == 0 else -line).alias("line"))
        for name, pair in stats.items():
            fields.append(F.col(pair[own]).alias(name))
            fields.append(F.col(pair[1 - own]).alias(f"opp_{name}"))
        return F.struct(*fields)

    return (games.select(*keep, F.explode(F.array(side(0), side(1))).alias("_side"))
            .select(*keep, "_side.*"))


def outcome_flags(pf="pf", pa="pa", line="line", eps: float = lines.EPS) -> dict[str, Column]:
    """0/1 columns for straight-up and against-the-line outcomes; games without a score give 0."""
    result = lines.result(pf, pa)
    ats = lines.ats_outcome(F.col(pf) - F.col(pa), line, eps)

    def flag(c: Column) -> Column:
        return F.coalesce(c, F.lit(False)).cast("int")

    return {"w": flag(result == "W"), "l": flag(result == "L"), "t": flag(result == "T"),
            "ats_w": flag(ats == "W"), "ats_l": flag(ats == "L"), "ats_p": flag(ats == "P")}


def season_records(team_rows: DataFrame, by: list[str]) -> DataFrame:
    """Points, straight-up and line records per group."""
    flags = outcome_flags()
    return team_rows.groupBy(*by).agg(
        F.count("pf").alias("gp"), F.coalesce(F.sum("pf"), F.lit(0)).cast("long").alias("pf_total"),
        F.coalesce(F.sum("pa"), F.lit(0)).cast("long").alias("pa_total"),
        *[F.sum(c).cast("long").alias(n) for n, c in flags.items()])


def opponent_mirror(team_week: DataFrame, on: list[str], stats: list[str], team: str = "team",
                    opp: str = "opp") -> DataFrame:
    """Each row gains what its opponent did in the same slot: their offence, our defence."""
    theirs = team_week.select(*on, F.col(team).alias("_their_team"), F.col(opp).alias("_their_opp"),
                              *[F.col(s).alias(f"{s}_allowed") for s in stats])
    match = (F.col(f"t.{opp}") == F.col("o._their_team")) & (F.col(f"t.{team}") == F.col("o._their_opp"))
    for key in on:
        match = match & (F.col(f"t.{key}") == F.col(f"o.{key}"))
    return (team_week.alias("t").join(theirs.alias("o"), match, "left")
            .select("t.*", *[f"o.{s}_allowed" for s in stats]))


def weekly_totals(team_rows: DataFrame, sums: dict[str, Column], by: list[str], week: str = "wk",
                  team: str = "team") -> DataFrame:
    """Pre-aggregate to one row per (season, team, week): a hot team shrinks to its weeks."""
    return team_rows.groupBy(*by, team, week).agg(
        F.count(F.lit(1)).alias("gp"),
        *[F.sum(F.coalesce(c, F.lit(0))).alias(n) for n, c in sums.items()])


def to_date(weekly: DataFrame, sums: list[str], by: list[str], week: str = "wk", team: str = "team",
            last_week: DataFrame | None = None, played: str | None = None) -> DataFrame:
    """Totals over earlier weeks only, for every (season, team, week).

    Every team of a season has every week up to the season's last, bye weeks included; weeks start at 1, or at the team's
    own first week if that is earlier. A weekly row's running totals hold from the week after it to the team's next one, so
    they are repeated over these weeks in the task that summed them, and only weekly rows are shuffled and sorted.
    ``played`` names a flag for the weeks that ``weekly`` has.
    """
    if last_week is None:
        last_week = weekly.groupBy(*by).agg(F.max(week).alias("_last"))
    own = Window.partitionBy(*by, team).orderBy(week)
    run = own.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = weekly.join(calendar(last_week), by).select(
        *by, team, F.col(week), F.greatest(F.lit(1), "_last").alias("_end"), *[F.sum(s).over(run).alias(s) for s in sums],
        F.lead(week).over(own).alias("_next"), F.lead(F.lit(1)).over(own).isNull().alias("_is_last"),
        (F.row_number().over(own) == 1).alias("_is_first"))

    def span(low: Column, high: Column, ok: Column, zero: bool) -> Column:
        weeks = F.when(ok & (low <= high), F.sequence(low, high)).otherwise(F.array())
        return F.transform(weeks, lambda w: F.struct(w.alias("_w"), F.lit(zero).alias("_zero"), w.eqNullSafe(
            F.col(week) if zero else F.col("_next")).alias("_played")))

    known, end = F.col(week).isNotNull(), F.col("_end")
    upto = F.least(F.col("_next"), end)
    # Nothing is known before the first week; totals without a week come before all weeks.
    spans = F.concat(
        span(F.least(F.lit(1), F.col(week)), F.least(F.col(week), end), known & F.col("_is_first"), True),
        span(F.when(known, F.col(week) + 1).otherwise(F.least(F.lit(1), "_next")), upto,
             known | F.col("_next").isNotNull() | F.col("_is_last"), False))
    grid = placed.select(*by, team, *sums, F.explode(spans).alias("_s"))
    return grid.select(*by, team, F.col("_s._w").alias(week),
                       *[F.coalesce(F.when(~F.col("_s._zero"), F.col(s)), F.lit(0)).alias(s) for s in sums],
                       *([F.col("_s._played").alias(played)] if played else []))


def season_to_date(team_rows: DataFrame, stats: list[str], by: list[str], week: str = "wk",
                   team: str = "team") -> DataFrame:
    """Per-game means over earlier weeks for every week.

    A null counts as 0 and every stat row counts as a game.
    """
    weekly = weekly_totals(team_rows, {s: F.col(s) for s in stats}, by, week, team)
    totals = to_date(weekly, ["gp", *stats], by, week, team)
    return totals.select(*by, team, week, "gp", *stats,
                         *[F.try_divide(F.col(s), F.col("gp")).alias(f"{s}_pg") for s in stats])


def cutoff_slots(team_rows: DataFrame, games: DataFrame, by: list[str], week: str = "wk",
                 kickoff: str = "kickoff") -> tuple[DataFrame, DataFrame]:
    """Cutoff "kickoff before the week's first kickoff".

    Weeks are put in the order of their first kickoff. Returns the team rows with ``slot``
    (how many weeks had begun at kickoff, so the game counts for later slots) and the weeks
    with their own slot number. The list of week starts is as long as a season has weeks.
    """
    starts = games.groupBy(*by, week).agg(F.min(kickoff).alias("first_kickoff"))
    order = Window.partitionBy(*by).orderBy("first_kickoff")
    # rank() - 1 = number of weeks that began strictly earlier.
    weeks = starts.select(*by, week, F.rank().over(order).alias("slot"), "first_kickoff")
    lists = weeks.groupBy(*by).agg(F.array_sort(F.collect_list("first_kickoff")).alias("_starts"))
    slotted = (team_rows.join(calendar(lists), by)
               .withColumn("slot", F.size(F.filter("_starts", lambda s: s <= F.col(kickoff))))
               .drop("_starts"))
    return slotted, weeks.drop("first_kickoff")


def season_to_date_first_kickoff(team_rows: DataFrame, games: DataFrame, stats: list[str], by: list[str],
                                 week: str = "wk", team: str = "team", kickoff: str = "kickoff") -> DataFrame:
    """As :func:`season_to_date` with the cutoff at the week's first kickoff."""
    slotted, weeks = cutoff_slots(team_rows, games, by, week, kickoff)
    weekly = weekly_totals(slotted, {s: F.col(s) for s in stats}, by, "slot", team)
    last = weeks.groupBy(*by).agg(F.max("slot").alias("_last"))
    totals = to_date(weekly, ["gp", *stats], by, "slot", team, last)
    return (totals.join(calendar(weeks), [*by, "slot"])
            .select(*by, team, week, "gp", *stats,
                    *[F.try_divide(F.col(s), F.col("gp")).alias(f"{s}_pg") for s in stats]))


def running_record(team_rows: DataFrame, by: list[str], team: str = "team", kickoff: str = "kickoff",
                   tie: str = "game_id") -> DataFrame:
    """W-L-T after each scored game, in kickoff order."""
    flags = outcome_flags()
    scored = team_rows.where(F.col("pf").isNotNull() & F.col("pa").isNotNull())
    return running_sums(scored, [*by, team], [kickoff, tie],
                        {"run_w": flags["w"], "run_l": flags["l"], "run_t": flags["t"]}, "through")


def record_before(team_rows: DataFrame, by: list[str], team: str = "team", kickoff: str = "kickoff") -> DataFrame:
    """Straight-up and line record before each kickoff; games of the same instant are not seen."""
    flags = outcome_flags()
    timed = team_rows.withColumn("_at", F.unix_micros(F.col(kickoff)))
    out = running_sums(timed, [*by, team], ["_at"],
                       {f"{n}_before": c for n, c in flags.items()}, "before")
    return out.drop("_at")


def favorite_ats(games: DataFrame, by: list[str], week: str = "wk", home: str = "home_id", away: str = "away_id",
                 side: str = "favored_side", favored_spread: str = "spread_favored_team",
                 eps: float = lines.EPS) -> DataFrame:
    """Line tallies from favoured side and favoured spread, weeks before each week."""
    margin = F.col("home_score") - F.col("away_score")
    valid = games.where(margin.isNotNull() & F.upper(F.col(side)).isin("HOME", "AWAY", "PICK")
                        & F.col(favored_spread).isNotNull())
    cover = (F.when(F.upper(F.col(side)) == "AWAY", -margin).otherwise(margin) + F.col(favored_spread))
    home_is_fav = F.upper(F.col(side)) != "AWAY"

    def tally(c: Column, team: str, is_fav: Column) -> Column:
        win, lose = c > eps, c < -eps
        return F.struct(F.col(team).alias("team"),
                        F.when(is_fav, win).otherwise(lose).cast("int").alias("w"),
                        F.when(is_fav, lose).otherwise(win).cast("int").alias("l"),
                        (~win & ~lose).cast("int").alias("p"))

    rows = (valid.select(*by, week, F.explode(F.array(
        tally(cover, home, home_is_fav), tally(cover, away, ~home_is_fav))).alias("_t"))
        .select(*by, week, "_t.*"))
    weekly = weekly_totals(rows, {c: F.col(c) for c in ("w", "l", "p")}, by, week)
    last = games.groupBy(*by).agg(F.max(week).alias("_last"))
    return to_date(weekly, ["w", "l", "p"], by, week, last_week=last)


def apply_records(games: DataFrame, tallies: DataFrame, by: list[str], week: str = "wk", home: str = "home_id",
                  away: str = "away_id") -> DataFrame:
    """Write record text and its parts to both sides; a side without a lined game gets null."""
    keys = [*by, week]
    out = games
    for prefix, team in (("home", home), ("away", away)):
        text = lines.format_record("w", "l", "p", "ats_or_null")
        lined = F.col("w") + F.col("l") + F.col("p") > 0
        dim = tallies.select(*keys, F.col("team").alias(team), text.alias(f"{prefix}_ats_new"),
                             *[F.when(lined, F.col(c)).alias(f"{prefix}_ats_{c}") for c in ("w", "l", "p")])
        out = out.join(dim, [*keys, team], "left")
        old = F.col(f"{prefix}_ats") if f"{prefix}_ats" in games.columns else F.lit(None).cast("string")
        out = out.withColumn(f"{prefix}_ats_changed", ~old.eqNullSafe(F.col(f"{prefix}_ats_new")))
        out = out.withColumn(f"{prefix}_ats", F.col(f"{prefix}_ats_new")).drop(f"{prefix}_ats_new")
    return (out.withColumn("ats_changed", F.col("home_ats_changed") | F.col("away_ats_changed"))
            .drop("home_ats_changed", "away_ats_changed"))


def roster_totals(team_rows: DataFrame, roster: DataFrame, stats: list[str], by: list[str] | None = None,
                  team: str = "team") -> DataFrame:
    """Season sums for every team of the roster; a team without games keeps null means."""
    by = by or []
    flags = outcome_flags()
    both = [*stats, *[f"opp_{s}" for s in stats]]
    totals = team_rows.groupBy(*by, team).agg(
        F.count(F.lit(1)).alias("gp"),
        *[F.sum(F.coalesce(F.col(s), F.lit(0))).cast("long").alias(s) for s in both],
        F.sum(F.coalesce(F.col("pf"), F.lit(0))).cast("long").alias("pf"),
        F.sum(F.coalesce(F.col("pa"), F.lit(0))).cast("long").alias("pa"),
        *[F.sum(flags[n]).cast("long").alias(n) for n in ("w", "l", "t")])
    measures = ["gp", *both, "pf", "pa", "w", "l", "t"]
    joined = roster.join(totals, [*by, team], "left")
    out = joined.select(*roster.columns, *[F.coalesce(F.col(m), F.lit(0)).alias(m) for m in measures])
    return out.select("*", *[F.try_divide(F.col(m), F.col("gp")).alias(f"{m}_pg") for m in [*both, "pf", "pa"]])


def trailing_form(values: DataFrame, by: list[str], week: str = "wk", team: str = "team", value: str = "pr",
                  span: int = 5) -> DataFrame:
    """Mean of the last ``span`` snapshots before each, step to the previous one, and last
    season's final value. One row per (season, team, week) must come in."""
    season = by[-1]
    order = Window.partitionBy(*by, team).orderBy(week)
    form = values.select(
        *by, team, week, value,
        F.avg(value).over(order.rowsBetween(-span, -1)).alias(f"{value}_last{span}"),
        (F.col(value) - F.lag(value).over(order)).alias(f"{value}_trend"))
    final = (values.groupBy(*by, team).agg(F.max_by(value, week).alias(f"{value}_last_year"))
             .withColumn(season, F.col(season) + 1))
    return form.join(final, [*by, team], "left")


def final_season(metrics: DataFrame, records: DataFrame, by: list[str], team: str = "team") -> DataFrame:
    """Prior-season table: metrics and records aligned by team, rows on one side survive."""
    return metrics.join(records, [*by, team], "full_outer")
