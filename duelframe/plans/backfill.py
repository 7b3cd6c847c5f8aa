"""Fill missing line outcomes of finished games from their closing line."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import lines
from ..functions.numbers import has_text


def backfill_ats(games: DataFrame, closing: DataFrame, key: str = "game_id", home: str = "home_id",
                 away: str = "away_id") -> DataFrame:
    """Two rows per game: outcome and margin against the closing line where they were blank.

    ``first_record`` is the one-game record used when a side has no timeline yet.
    """
    joined = games.join(closing.select(key, "closing_spread", "source", "book"), key, "left")
    margin = F.col("home_score") - F.col("away_score")

    def side(own: str, prefix: str, sign: int) -> F.Column:
        cover = (margin + F.col("closing_spread")) * sign
        outcome = F.when(F.abs(cover) < lines.EPS, "P").when(cover > 0, "W").when(cover < 0, "L")
        stored = F.when(has_text(f"{prefix}_ats"), F.col(f"{prefix}_ats"))
        return F.struct(F.col(own).alias("team"), stored.alias("stored"), outcome.alias("outcome"),
                        F.round(cover, 2).alias("to_margin"))

    rows = joined.select(key, "source", "book", F.explode(F.array(
        side(home, "home", 1), side(away, "away", -1))).alias("_s")).select(key, "source", "book", "_s.*")
    blank = F.col("stored").isNull()
    first = F.when(F.col("outcome") == "W", "1-0-0").when(F.col("outcome") == "L", "0-1-0").when(
        F.col("outcome") == "P", "0-0-1")
    return rows.select(key, "team", "source", "book", F.coalesce("stored", "outcome").alias("ats"), "to_margin",
                       (blank & F.col("outcome").isNotNull()).alias("filled"), F.when(blank, first).alias("first_record"))
