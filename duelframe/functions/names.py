"""Name keys, event keys and text tests."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .numbers import as_col
from .times import kickoff_token

# Words read as true and as false in a neutral-site flag.
TRUE_WORDS = ["true", "t", "yes", "y", "1", "neutral", "neutral_site"]
FALSE_WORDS = ["false", "f", "no", "n", "0", "home"]


def slug(c) -> Column:
    """Lower case, every run of other characters becomes one underscore."""
    return F.trim(F.regexp_replace(F.lower(as_col(c)), "[^a-z0-9]+", "_"), F.lit("_"))


def compact_key(c) -> Column:
    """Lower case, '&' spelt out, only letters and digits kept."""
    text = F.regexp_replace(F.lower(as_col(c)), "&", "and")
    return F.regexp_replace(text, "[^a-z0-9]", "")


def lookup_text(c) -> Column:
    """Form in which free-text aliases are compared."""
    text = F.translate(F.lower(as_col(c)), "\u00a0.-,", "    ")
    text = F.regexp_replace(text, "&", "and")
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def game_key(kickoff, away, home) -> Column:
    """The one event key used everywhere: minute of kickoff, away side, home side."""
    return F.concat_ws("_", kickoff_token(kickoff), slug(away), slug(home))


def to_bool(c, numeric: bool = False) -> Column:
    """Tri-state: known words to a boolean, anything else null.

    ``numeric`` is for number columns, where every non-zero whole part is true.
    """
    c = as_col(c)
    if numeric:
        return F.when(~F.isnan(c.cast("double")), c.cast("double").try_cast("long") != 0)
    word = F.lower(F.trim(c.cast("string")))
    return F.when(word.isin(TRUE_WORDS), True).when(word.isin(FALSE_WORDS), False)


def search_text(query: str, *cols) -> Column:
    """Case-insensitive containment in any of the columns; an empty query keeps all."""
    needle = query.strip().lower()
    if not needle:
        return F.lit(True)
    hits = [F.coalesce(F.contains(F.lower(as_col(c).cast("string")), F.lit(needle)), F.lit(False)) for c in cols]
    out = hits[0]
    for hit in hits[1:]:
        out = out | hit
    return out
