"""Labels to canonical names: alias dimensions joined, not looked up row by row."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import fixed_values
from ..functions.names import compact_key, lookup_text
from ..functions.numbers import as_col, has_text
from .skew import skew_join

# Alias tiers, strongest first.
ABBREVIATION, FULL_NAME, SYNONYM, CITY = 1, 2, 3, 4


def alias_rows(names: DataFrame, abbreviation: str, full: str) -> DataFrame:
    """Alias dimension (form, alias, tier, canonical) derived from abbreviations and full names.

    The last word of a full name is a nickname; the words before it are a city label where
    only one name has them.
    """
    both = names.select(F.col(abbreviation).alias("abbr"), F.col(full).alias("canonical")).distinct()
    raw = both.select("canonical", F.explode(F.array(
        F.struct(F.lower("abbr").alias("alias"), F.lit(ABBREVIATION).alias("tier")),
        F.struct(F.lower("canonical").alias("alias"), F.lit(FULL_NAME).alias("tier")))).alias("a"))
    raw = raw.select(F.lit("raw").alias("form"), "a.alias", "a.tier", "canonical")
    clean = lookup_text("canonical")
    parts = both.select("canonical").distinct().select(
        "canonical", F.regexp_extract(clean, r"^(.*) \S+$", 1).alias("city"),
        F.regexp_extract(clean, r" (\S+)$", 1).alias("nickname"), clean.alias("full"))
    one_city = (parts.where("city <> ''").groupBy("city")
                .agg(F.count(F.lit(1)).alias("n"), F.min("canonical").alias("canonical"))
                .where("n = 1"))
    one_nick = (parts.where("nickname <> ''").groupBy("nickname")
                .agg(F.count(F.lit(1)).alias("n"), F.min("canonical").alias("canonical"))
                .where("n = 1"))
    free = (one_nick.select(F.col("nickname").alias("alias"), F.lit(SYNONYM).alias("tier"), "canonical")
            .unionByName(parts.select(F.col("full").alias("alias"), F.lit(SYNONYM).alias("tier"), "canonical"))
            .unionByName(one_city.select(F.col("city").alias("alias"), F.lit(CITY).alias("tier"), "canonical")))
    return raw.unionByName(free.select(F.lit("free").alias("form"), "alias", "tier", "canonical"))


def extra_aliases(spark: SparkSession, aliases: dict[str, str], tier: int) -> DataFrame:
    rows = [("free", alias, tier, canonical) for alias, canonical in aliases.items()]
    return spark.createDataFrame(rows, "form string, alias string, tier int, canonical string")


def pro_alias_dim(spark: SparkSession) -> DataFrame:
    """Alias dimension of the 32 professional teams."""
    names = spark.createDataFrame(list(fixed_values.PRO_ABBREVIATIONS.items()), "abbr string, full string")
    return (alias_rows(names, "abbr", "full")
            .unionByName(extra_aliases(spark, fixed_values.PRO_SYNONYMS, SYNONYM))
            .unionByName(extra_aliases(spark, fixed_values.PRO_CITIES, CITY)))


def resolve_entity(df: DataFrame, label: str, dim: DataFrame, name: str) -> DataFrame:
    """Canonical name of a label: abbreviation, full name, synonym, city, else the label trimmed."""
    best = dim.groupBy("form", "alias").agg(F.min_by("canonical", F.struct("tier", "canonical")).alias("canonical"))
    raw = best.where("form = 'raw'").select(F.col("alias").alias("_raw"), F.col("canonical").alias("_by_raw"))
    free = best.where("form = 'free'").select(F.col("alias").alias("_free"), F.col("canonical").alias("_by_free"))
    keyed = df.withColumns({"_raw": F.lower(F.trim(label)), "_free": lookup_text(label)})
    out = skew_join(keyed, raw, ["_raw"], "left")
    out = skew_join(out, free, ["_free"], "left")
    return out.select(*df.columns, F.coalesce("_by_raw", "_by_free", F.trim(label)).alias(name))


def merge_key(df: DataFrame, label: str, dim: DataFrame, name: str) -> DataFrame:
    """Join key of a label: canonical name in lower case, only letters and digits."""
    out = resolve_entity(df, label, dim, "_canonical")
    return out.select(*df.columns, compact_key("_canonical").alias(name))


def clean_label(c) -> Column:
    text = F.regexp_replace(F.lower(F.trim(as_col(c))), "&", "and")
    return F.regexp_replace(text, r"\s+", " ")


def _literal_map(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def normalize_label(c, display: dict[str, str] = fixed_values.COLLEGE_DISPLAY) -> Column:
    """Display name of a label: known names from the list, otherwise words capitalised."""
    text = clean_label(c)
    known = F.try_element_at(_literal_map(display), text) if display else F.lit(None).cast("string")
    return F.when(has_text(c), F.coalesce(known, F.initcap(text))).otherwise("")


def college_key(c) -> Column:
    return compact_key(normalize_label(c))


def strip_suffix_words(c, aliases: dict[str, str] = fixed_values.COLLEGE_FEED_ALIASES,
                       phrases: list[str] = fixed_values.COLLEGE_SUFFIX_PHRASES,
                       words: list[str] = fixed_values.COLLEGE_SUFFIX_WORDS,
                       display: dict[str, str] = fixed_values.COLLEGE_DISPLAY) -> Column:
    """Label without nickname: feed alias, then one suffix phrase, then trailing suffix words.

    At least one word always remains.
    """
    text = clean_label(normalize_label(c, display))
    if aliases:
        table = _literal_map(aliases)
        text = F.coalesce(clean_label(F.coalesce(
            F.try_element_at(table, text),
            F.try_element_at(table, F.regexp_replace(text, " ", "")))), text)
    if phrases:
        ends = "|".join(re.escape(p) for p in phrases)
        text = F.trim(F.regexp_replace(text, rf"(?<=.)(?:{ends})$", ""))
    if words:
        ends = "|".join(re.escape(w) for w in words)
        text = F.regexp_replace(text, rf"(?: (?:{ends}))+$", "")
    return text


def override_key(df: DataFrame, key: str, dim: DataFrame, alias: str = "alias", target: str = "target") -> DataFrame:
    """Source-specific key spellings replaced through a small dimension."""
    small = dim.select(F.col(alias).alias(key), F.col(target).alias("_target"))
    return (skew_join(df, small, [key], "left")
            .withColumn(key, F.coalesce("_target", key)).select(*df.columns))


def alias_debt(unmatched: DataFrame, k: int = 50, reason: str = "why", home: str = "home_norm",
               away: str = "away_norm", reasons: tuple[str, ...] = ("no_schedule_candidate", "name_mismatch")
               ) -> DataFrame:
    """The k most frequent tokens among events left unmatched for reasons of naming."""
    tokens = (unmatched.where(F.col(reason).isin(*reasons))
              .select(F.explode(F.array(home, away)).alias("token")).where(has_text("token")))
    return (tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), F.asc("token")).limit(k))


def multi_key_lookup(df: DataFrame, tries: list[Column], dim: DataFrame, dim_keys: list[Column], position: list[str],
                     value: str, name: str) -> DataFrame:
    """Look a value up under several spellings of both sides; the first try that hits wins.

    A spelling claimed by several dimension rows belongs to the first by ``position``.
    """
    spelled = dim.select(F.explode(F.array_distinct(F.array(*dim_keys))).alias("_key"), value, *position)
    index = (spelled.where(has_text("_key")).groupBy("_key")
             .agg(F.min_by(value, F.struct(*position)).alias("_value")))
    out = df
    found = []
    for i, key in enumerate(tries):
        keyed = out.withColumn("_key", key)
        out = (skew_join(keyed, index, ["_key"], "left").drop("_key")
               .withColumnRenamed("_value", f"_hit{i}"))
        found.append(f"_hit{i}")
    return out.select(*df.columns, F.coalesce(*found).alias(name))
