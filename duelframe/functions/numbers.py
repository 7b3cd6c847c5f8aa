"""Tolerant numeric coercion and blank tests as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

NUMBER_PATTERN = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"
# A number, or the number before the first dash of a text such as "12-34".
LEADING_NUMBER = (r"^(?:[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"
                  r"|\+?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE]\+?[0-9]+)?(?=-))")


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_number(c) -> Column:
    """Text to double; anything that is not a plain decimal number is null."""
    # The pattern keeps out spellings only the JVM accepts, such as "1d" or "0x1p3".
    return finite(F.regexp_extract(F.trim(as_col(c).cast("string")), NUMBER_PATTERN, 0).try_cast("double"))


def finite(c) -> Column:
    """NaN and infinities become null (NaN compares as greater than infinity)."""
    c = as_col(c)
    return F.when(F.abs(c) < F.lit(float("inf")), c)


def to_number(c) -> Column:
    """Like :func:`parse_number`, also "1,234" -> 1234 and "12-34" -> 12."""
    text = F.translate(F.trim(as_col(c).cast("string")), ",", "")
    return finite(F.regexp_extract(text, LEADING_NUMBER, 0).try_cast("double"))


def to_int(c) -> Column:
    """Nearest integer of :func:`to_number`, half to even, null when out of range."""
    return F.rint(to_number(c)).try_cast("int")


def has_text(c) -> Column:
    return F.coalesce(F.trim(as_col(c)) != "", F.lit(False))


def has_value(c, dtype: str = "string") -> Column:
    """True unless null, blank text, an empty container or NaN."""
    c = as_col(c)
    if dtype == "string":
        return has_text(c)
    if dtype.startswith(("array", "map")):
        return F.coalesce(F.size(c) > 0, F.lit(False))
    if dtype in ("double", "float"):
        return c.isNotNull() & ~F.isnan(c)
    return c.isNotNull()


def is_blank(c, dtype: str = "string") -> Column:
    return ~has_value(c, dtype)


def has_numeric(c) -> Column:
    return parse_number(c).isNotNull()


def first_present(*cols, cast: str = "double") -> Column:
    """First candidate that survives the cast."""
    if cast in ("double", "float"):
        return F.coalesce(*[parse_number(c) for c in cols])
    if cast == "string":
        return F.coalesce(*[F.when(has_text(as_col(c).cast("string")), F.trim(as_col(c).cast("string")))
                            for c in cols])
    return F.coalesce(*[as_col(c).cast("string").try_cast(cast) for c in cols])


def resolve_column(columns: list[str], *candidates: str) -> str | None:
    """First candidate present in ``columns``, exact spelling before any case."""
    lowered = {name.lower(): name for name in reversed(columns)}
    for candidate in candidates:
        if candidate in columns:
            return candidate
        if candidate.lower() in lowered:
            return lowered[candidate.lower()]
    return None


def round_to(c, digits: int) -> Column:
    return F.round(as_col(c).cast("double"), digits)
