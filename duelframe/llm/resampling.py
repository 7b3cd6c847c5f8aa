"""Importance resampling: hashed n-gram models of a target and of the raw texts weigh every text, Gumbel noise and an
exact top-k sample it.

A text's weight is the log ratio of its unigrams and bigrams under both models; the noise comes from a hash of its
identifier and the seed, so that retries and reruns agree. The k largest keys are the sample, which is a draw without
replacement in proportion to the weights.

Null and empty texts have weight 0. Repeated rows have equal keys; ties at the border go to smaller identifiers.
Without target rows all weights are 0. Empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import textops as t
from .storage import Stored

BUCKETS = 1 << 14
#: Target rows used for the target model, drawn by hash (about that many). The raw model counts all rows.
TARGET_ROWS = 20_000


def _grams(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all unigrams and bigrams, and the number of the text of each."""
    buf, offsets = t.text_buffer(part.column("text"))
    words = t.Words(t.LOWER[buf], offsets)
    h = t.RangeHash(words.buf)(words.starts, words.ends)
    pair = np.flatnonzero(words.doc[1:] == words.doc[:-1])
    two = t.mix(h[pair] * t.U64(0x9FB21C651E98DF25) + h[pair + 1])
    mask = t.U64(BUCKETS - 1)
    return (np.concatenate([h & mask, two & mask]).astype(np.int64), np.concatenate([words.doc, words.doc[pair]]))


def gram_counts(docs: DataFrame) -> np.ndarray:
    """Bucket counts of all texts; every task sends at most BUCKETS rows, and so does the sum."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = np.zeros(BUCKETS, np.int64)
        for part in t.slices(batches, "text"):
            have += np.bincount(_grams(part)[0], minlength=BUCKETS)
        at = np.flatnonzero(have)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(have[at])], ["bucket", "n"])

    got = docs.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(BUCKETS)
    out[got.column("bucket").to_numpy()] = got.column("n").to_numpy()
    return out


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    if not target.sum():
        return np.zeros(BUCKETS)
    return np.log((target + 1) / (target.sum() + BUCKETS)) - np.log((raw + 1) / (raw.sum() + BUCKETS))


def keys(docs: DataFrame, ratio: np.ndarray, seed: int = 0) -> DataFrame:
    """doc_id, log_weight, key (weight plus Gumbel noise), place (key as a sortable long)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in t.slices(batches, "text"):
            bucket, doc = _grams(part)
            weight = np.bincount(doc, weights=ratio[bucket], minlength=part.num_rows).astype(np.float64)
            ids = part.column("doc_id").fill_null(-1).to_numpy().astype(np.uint64)
            u = ((t.mix(ids * t.U64(0x9E3779B97F4A7C15) + t.U64(seed + 1)) >> t.U64(11)).astype(np.float64) + 0.5) / 2**53
            key = weight - np.log(-np.log(u))
            bits = key.view(np.int64)
            place = np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(weight), pa.array(key), pa.array(place)],
                                             ["doc_id", "log_weight", "key", "place"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, log_weight double, key double, place long")


def select_top(scored: DataFrame, k: int) -> DataFrame:
    """Adds selected: true for the k largest places. Exact: four counts by 16 bits find the border, ties go by doc_id."""
    rest, border, found = k, [], scored.withColumn("unsigned", F.col("place").bitwiseXOR(F.lit(-(1 << 63))))
    digit = [F.shiftrightunsigned("unsigned", 48 - 16 * i).bitwiseAND(F.lit(0xFFFF)) for i in range(4)]
    within = found
    for i in range(4):
        counts = sorted(((r[0], r[1]) for r in within.groupBy(digit[i].alias("d")).count().collect()), reverse=True)
        for value, n in counts:  # at most 65,536 rows
            if rest <= n:
                border.append(value)
                break
            rest -= n
        else:
            return scored.withColumn("selected", F.lit(True))
        within = within.where(digit[i] == border[-1])
    edge = sum(v << (48 - 16 * i) for i, v in enumerate(border))
    edge = (edge ^ (1 << 63)) - (1 << 64) * ((edge ^ (1 << 63)) >> 63)
    # Only rows with exactly the border's key are ranked.
    ties = scored.where(F.col("place") == edge).withColumn("nth", F.row_number().over(Window.partitionBy("place").orderBy("doc_id")))
    return (scored.where(F.col("place") != edge).withColumn("selected", F.col("place") > edge)
            .union(ties.select(*scored.columns, (F.col("nth") <= rest).alias("selected"))))


def resample(spark: SparkSession, docs: DataFrame, target_ids: DataFrame, share: float, seed: int = 0,
             target_rows: int = TARGET_ROWS) -> DataFrame:
    """doc_id, log_weight, key, selected for every row; share of the rows is selected. target_ids(doc_id) name the target."""
    ids = target_ids.select("doc_id").where("doc_id is not null").distinct()
    total = ids.count()
    if total > target_rows:
        ids = ids.where(F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(1 << 20)) < int((1 << 20) * target_rows / total))
    target = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id", "left_semi")
    ratio = log_ratio(gram_counts(target), gram_counts(docs))
    scored = Stored(spark, "resample").save(keys(docs, ratio, seed))
    return select_top(scored, round(share * scored.count())).select("doc_id", "log_weight", "key", "selected")
