"""Nested payloads: team statistics, HTML tables, timeline arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import NUMBER_PATTERN, as_col, has_text, parse_number, to_int, to_number

# Statistic names of the provider payload.
STAT_CATEGORIES = {
    "rush": ["rushingYards"],
    "pass": ["netPassingYards", "passingYards"],
    "total": ["totalYards"],
    "turnovers": ["turnovers"],
}


def flatten_team_stats(games: DataFrame, key: list[str], teams: str = "teams") -> DataFrame:
    """game -> teams[] -> stats[] to one row per team with its opponent's numbers.

    Games with fewer than two team entries are dropped. The opponent is the other element.
    """
    rows = games.where(F.size(teams) >= 2).select(*key, F.posexplode(teams).alias("_i", "_own"), F.col(teams).alias("_t"))
    other = F.element_at("_t", F.when(F.col("_i") == 0, 2).otherwise(1))
    rows = rows.select(*key, "_own", other.alias("_other"))

    def text(side: str, name: str) -> Column:
        """Last text of the first category present, so an unreadable text is not replaced."""
        stats = F.col(f"{side}.stats")
        found = None
        for category in STAT_CATEGORIES[name]:
            hit = _last_stat(stats, category)
            found = hit if found is None else F.coalesce(found, hit)
        return found["stat"]

    sides = {"_own": "", "_other": "opp_"}
    # Texts first, numbers after: each array is searched once per statistic.
    texts = rows.select(*key, F.col("_own.team").alias("team"), F.col("_other.team").alias("opp"),
                        *[F.col(f"{s}.points").alias(f"{p}points") for s, p in sides.items()],
                        *[text(s, n).alias(f"{p}{n}") for s, p in sides.items() for n in STAT_CATEGORIES])
    numbers = texts.select(*key, "team", "opp", *[to_int(f"{p}points").alias(f"{p}points") for p in sides.values()],
                           *[to_number(f"{p}{n}").alias(f"{p}{n}") for p in sides.values() for n in STAT_CATEGORIES])
    out = []
    for p in sides.values():
        rush, passing = F.coalesce(f"{p}rush", F.lit(0.0)), F.coalesce(f"{p}pass", F.lit(0.0))
        out += [F.col(f"{p}points"), rush.alias(f"{p}rush"), passing.alias(f"{p}pass"),
                F.coalesce(f"{p}total", rush + passing).alias(f"{p}total"),
                F.coalesce(f"{p}turnovers", F.lit(0.0)).alias(f"{p}turnovers")]
    return numbers.select(*key, "team", "opp", *out)


def _last_stat(stats: Column, category: str) -> Column:
    """A category listed twice keeps its last value."""
    return F.try_element_at(F.filter(stats, lambda s: s["category"] == category), F.lit(-1))


def table_cells(markup) -> Column:
    """All tables of a page as array<table<row<cell text>>>; works inside the row."""
    def texts(row: Column) -> Column:
        cells = F.regexp_extract_all(row, F.lit(r"(?is)<t[hd][^>]*>(.*?)</t[hd]>"), F.lit(1))
        return F.transform(cells, lambda c: F.trim(F.regexp_replace(c, r"(?s)<[^>]+>", "")))

    tables = F.regexp_extract_all(as_col(markup), F.lit(r"(?is)<table[^>]*>(.*?)</table>"), F.lit(1))
    return F.transform(tables, lambda t: F.transform(
        F.regexp_extract_all(t, F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1)), texts))


def extract_html_tables(pages: DataFrame, page: list[str], markup: str, season: Column | None = None,
                        label: str = "Team") -> DataFrame:
    """(label, value) rows of each page's first usable table.

    The value column is the one named after the season, else the newest four-digit year,
    else the first numeric column.
    """
    wanted = season.cast("string") if season is not None else F.lit(None).cast("string")
    base = pages.select(*page, wanted.alias("_want"), table_cells(markup).alias("_tables"))

    def choose(table: Column) -> Column:
        header = table[0]
        body = F.slice(table, 2, F.greatest(F.size(table) - 1, F.lit(0)))
        label_at = F.array_position(header, label)
        places = F.sequence(F.lit(1), F.size(header))

        def numeric(i: Column) -> Column:
            # One number at least, and no text.
            cells = F.filter(F.transform(body, lambda r: F.try_element_at(r, i)), has_text)
            return (F.size(cells) > 0) & F.forall(cells, lambda c: c.rlike(NUMBER_PATTERN))

        options = F.filter(places, lambda i: (i != label_at.cast("int")) & numeric(i))
        by_name = F.nullif(F.array_position(header, F.col("_want")).cast("int"), F.lit(0))
        years = F.filter(options, lambda i: F.element_at(header, i).rlike(r"^\d{4}$"))
        newest = F.array_max(F.transform(years, lambda i: F.struct(F.element_at(header, i), i.alias("i"))))["i"]
        value_at = F.coalesce(by_name, newest, F.try_element_at(options, F.lit(1)))
        return F.struct(label_at.cast("int").alias("label_at"), value_at.alias("value_at"), body.alias("body"),
                        F.try_element_at(header, value_at).alias("header"))

    nonempty = F.filter("_tables", lambda t: (F.size(t) > 0) & F.exists(t, lambda r: F.size(r) > 0))
    usable = F.filter(F.transform(nonempty, choose),
                      lambda t: (t["label_at"] > 0) & t["value_at"].isNotNull())
    picked = base.select(*page, F.try_element_at(usable, F.lit(1)).alias("_t")).where("_t IS NOT NULL")
    rows = picked.select(*page, "_t.label_at", "_t.value_at", F.col("_t.header").alias("column"),
                         F.explode("_t.body").alias("_row"))
    name = F.regexp_replace(F.try_element_at("_row", F.col("label_at")), r"[*+]+$", "")
    return rows.select(*page, F.trim(name).alias("label"), "column",
                       parse_number(F.try_element_at("_row", F.col("value_at"))).alias("value"))


def page_links(markup) -> Column:
    """Targets of all links of a page."""
    return F.regexp_extract_all(as_col(markup), F.lit(r'(?i)<a\s[^>]*?href="([^"]*)"'), F.lit(1))


def update_timeline_entry(entries, season, week, ats, margin) -> Column:
    """Fill a blank outcome and margin on the first entry of (season, week)."""
    arr, season, week = as_col(entries), as_col(season), as_col(week)
    ats, margin = as_col(ats), as_col(margin)
    at = F.array_position(F.transform(arr, lambda e: (e["season"] == season) & (e["week"] == week)), True)

    def fill(entry: Column, i: Column) -> Column:
        new_ats = F.when(has_text(entry["ats"]), entry["ats"]).otherwise(ats)
        new_margin = F.coalesce(F.when(~F.isnan(entry["to_margin"]), entry["to_margin"]), F.round(margin, 2))
        changed = entry.withField("ats", new_ats).withField("to_margin", new_margin)
        return F.when(i + 1 == at, changed).otherwise(entry)

    return F.transform(arr, fill)


def timeline_record(entries, season, through_week) -> Column:
    """struct(w, l, p, games, margin_sum, margin_n) of one season up to a week, from the array."""
    arr = F.filter(as_col(entries), lambda e: (e["season"] == as_col(season)) & (e["week"] <= as_col(through_week)))

    def count(word: str) -> Column:
        return F.size(F.filter(arr, lambda e: F.upper(F.trim(e["ats"])) == word))

    margins = F.filter(F.transform(arr, lambda e: e["to_margin"].cast("double")),
                       lambda m: m.isNotNull() & ~F.isnan(m))
    total = F.aggregate(margins, F.lit(0.0), lambda acc, m: acc + m)
    return F.struct(count("W").alias("w"), count("L").alias("l"), count("P").alias("p"), F.size(arr).alias("games"),
                    total.alias("margin_sum"), F.size(margins).alias("margin_n"))


def rollup_records(entries) -> Column:
    """Straight-up and line counts of an array; the margin decides where the label is missing."""
    arr = as_col(entries)

    def line(e: Column) -> Column:
        label = F.upper(e["ats"])
        m = e["to_margin"].cast("double")
        return F.when(label.isin("W", "L", "P"), label).when(m > 0, "W").when(m < 0, "L").when(m == 0, "P")

    def count(test) -> Column:
        return F.size(F.filter(arr, test))

    return F.struct(
        count(lambda e: F.upper(e["result"]) == "W").alias("su_w"),
        count(lambda e: F.upper(e["result"]) == "L").alias("su_l"),
        count(lambda e: line(e) == "W").alias("ats_w"), count(lambda e: line(e) == "L").alias("ats_l"),
        count(lambda e: line(e) == "P").alias("ats_p"))
