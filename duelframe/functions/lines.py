"""Spreads, ratings, outcomes and records.

Spreads are home-relative: negative means the home side is favoured.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .numbers import as_col

EPS = 1e-9


def side_view(value, side) -> Column:
    """Home-relative number as seen from one side."""
    value = as_col(value)
    return F.when(F.upper(as_col(side)).isin("HOME", "H"), value).otherwise(-value)


def rating_diff(pr_home, pr_away, hfa=None) -> Column:
    diff = as_col(pr_home) - as_col(pr_away)
    return diff if hfa is None else diff + F.coalesce(as_col(hfa), F.lit(0.0))


def rating_vs_line(diff, line) -> Column:
    """Rating difference minus what the line already expects (line < 0 = favoured)."""
    return as_col(diff) + as_col(line)


def favored_side(spread, fallback_diff=None) -> Column:
    """HOME, AWAY or PICK from the spread, else from the rating difference."""
    spread = as_col(spread)
    out = F.when(spread < 0, "HOME").when(spread > 0, "AWAY").when(spread == 0, "PICK")
    if fallback_diff is not None:
        diff = as_col(fallback_diff)
        out = out.when(diff >= 0, "HOME").when(diff < 0, "AWAY")
    return out


def favored_spread(spread) -> Column:
    """Spread of the favoured side: zero or negative."""
    return -F.abs(as_col(spread))


def favored_edge(pr_home, pr_away, hfa, side) -> Column:
    """Rating edge of the favoured side, home advantage counted."""
    diff = rating_diff(pr_home, pr_away, hfa)
    side = as_col(side)
    return F.when(side.isin("HOME", "PICK"), diff).when(side == "AWAY", -diff)


def edge_columns(pr_home="home_pr", pr_away="away_pr", hfa="hfa", spread="spread",
                 use_hfa: bool = True, digits: int | None = None) -> dict[str, Column]:
    """All rating-against-line columns, computed after the spread is final."""
    diff = rating_diff(pr_home, pr_away, hfa if use_hfa else None)
    side = favored_side(spread)
    edge = favored_edge(pr_home, pr_away, hfa, side)
    cols = {
        "rating_diff": diff,
        "rating_vs_odds": rating_vs_line(diff, spread),
        "favored_side": side,
        "spread_favored_team": favored_spread(spread),
        "rating_diff_favored_team": edge,
        "rating_vs_odds_favored_team": edge + favored_spread(spread),
    }
    if digits is not None:
        for name in ("rating_diff", "rating_vs_odds", "rating_diff_favored_team", "rating_vs_odds_favored_team"):
            cols[name] = F.round(cols[name], digits)
    return cols


def sos_diff(own, other) -> Column:
    """Schedule-strength surplus; shown only when positive."""
    diff = as_col(own) - as_col(other)
    return F.when(diff > 0, diff)


def ats_outcome(margin, line, eps: float = EPS) -> Column:
    """W, L or P against the line, null without a line."""
    cover = as_col(margin) + as_col(line)
    return F.when(F.abs(cover) < eps, "P").when(cover > 0, "W").when(cover < 0, "L")


def result(pf, pa) -> Column:
    pf, pa = as_col(pf), as_col(pa)
    return F.when(pf > pa, "W").when(pf < pa, "L").when(pf == pa, "T")


def format_record(w, l, t, style: str = "ats") -> Column:
    """Record text.

    ``su``: third part only when it is not zero. ``ats``: always three parts.
    ``ats_or_null``: three parts, null for no games. ``ats_or_dash``: third part only
    when not zero, a dash for no games.
    """
    w, l, t = (F.coalesce(as_col(c), F.lit(0)).cast("long") for c in (w, l, t))
    three = F.concat_ws("-", w.cast("string"), l.cast("string"), t.cast("string"))
    two = F.concat_ws("-", w.cast("string"), l.cast("string"))
    short = F.when(t != 0, three).otherwise(two)
    if style == "su":
        return short
    if style == "ats":
        return three
    if style == "ats_or_null":
        return F.when(w + l + t > 0, three)
    if style == "ats_or_dash":
        return F.when(w + l + t > 0, short).otherwise(F.lit("—"))
    raise ValueError(f"unknown record style: {style}")


def parse_record(c) -> Column:
    """"W-L" or "W-L-T" text -> struct(w, l, t, gp); other text -> null."""
    text = F.trim(as_col(c))
    parts = F.split(text, "-")
    w = F.try_element_at(parts, F.lit(1)).try_cast("int")
    l = F.try_element_at(parts, F.lit(2)).try_cast("int")
    t = F.coalesce(F.try_element_at(parts, F.lit(3)).try_cast("int"), F.lit(0))
    return F.when(text.rlike(r"^\d+-\d+(-\d+)?$"),
                  F.struct(w.alias("w"), l.alias("l"), t.alias("t"), (w + l + t).alias("gp")))
