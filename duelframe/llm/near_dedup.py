"""Near-duplicate classes of documents: MinHash bands find candidates, odd sketches screen them, full shingle sets decide.

An odd sketch folds a document's MinHash samples into a bitmap of parities; the number of bits set in the XOR of two
sketches estimates how many samples differ, most precisely where the similarity is high. Candidates are first compared
by it (with a margin below the wanted similarity) and then by their whole shingle sets.

Documents with equal shingle sets are one class from the start. In a band's bucket, members are compared with one leader:
first the document whose buckets are the most crowded (the original of a family of copies, which need not be linked with
each other), then one chosen by hash. Only members of classes that are still apart are then compared with each other, so
a large group of copies costs comparisons in proportion to its size.

Words, shingles and links are those of the op1 contract: A-Z lower-cased, words without white space, five-word shingles
(one shorter shingle for fewer words), a link from 75 percent of the union. Null, empty and blank texts have no shingles
and no links. Equal rows form a class. Rows that share a doc_id, or have none, count by their own texts. Other columns are ignored.
With 32 bands of 4 samples a pair at exactly 0.75 is missed once in 200,000 times, a pair at 0.8 once in 10 million.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textops as t
from .storage import Stored, components, few_tasks, spread_join

WORDS = 5
BANDS, ROWS = 32, 4
SAMPLES, SKETCH_BITS = 1024, 4096
#: Pairs whose sketches suggest less than this are no candidates. The estimate deviates by 0.018 at a similarity of 0.75,
#: so a pair at exactly 0.75 is lost by it once in 200,000 times.
SCREEN = 0.67
PERCENT = 75

#: Keys of candidates that are sent to all tasks at most (8 bytes each); more of them meet the texts in a shuffle.
SENT_IDS = 2_000_000

#: Rows of a task that carry sketches or whole shingle sets.
WIDE_ROWS = 4_000

_RNG = np.random.default_rng(75)
_XOR = _RNG.integers(0, 2**32, SAMPLES, dtype=np.uint32)
_ODD = _RNG.integers(0, 2**31, SAMPLES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def shingle_sets(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text, and their bounds."""
    low = t.LOWER[buf]
    words = t.Words(low, offsets)
    values, bounds = t.shingles(t.RangeHash(low)(words.starts, words.ends), words.bounds, WORDS)
    sets = [np.unique(values[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
    return (np.concatenate(sets) if sets else values), np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)


def min_hashes(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """uint32 samples [text, SAMPLES]; the bands use the first BANDS * ROWS of them."""
    out = np.zeros((len(bounds) - 1, SAMPLES), np.uint32)
    low = (values >> t.U64(32)).astype(np.uint32)
    high = np.uint32(0xFFFFFFFF)
    for k in range(SAMPLES):
        out[:, k] = t.doc_reduce(np.minimum, (low ^ _XOR[k]) * _ODD[k], bounds, high)
    return out


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """int64 words [text, SKETCH_BITS / 64]: bit b is the parity of the samples that fall on b."""
    n = len(samples)
    bit = (t.mix(samples.astype(np.uint64) * t.U64(SAMPLES) + np.arange(SAMPLES, dtype=np.uint64)) % t.U64(SKETCH_BITS)).astype(np.int64)
    parity = np.bincount((np.arange(n)[:, None] * SKETCH_BITS + bit).ravel(), minlength=n * SKETCH_BITS) & 1
    return np.packbits(parity.astype(np.uint8).reshape(n, SKETCH_BITS), axis=1).view(np.int64)


def band_keys(samples: np.ndarray) -> np.ndarray:
    """int64 keys [text, BANDS], different for different bands."""
    out = np.empty((len(samples), BANDS), np.uint64)
    for b in range(BANDS):
        key = np.full(len(samples), b + 1, np.uint64)
        for k in range(b * ROWS, (b + 1) * ROWS):
            key = t.mix(key * t.U64(0x9FB21C651E98DF25) + samples[:, k])
        out[:, b] = key
    return out.view(np.int64)


def _row_keys(docs: DataFrame) -> DataFrame:
    """docs with two 64-bit hashes: key of doc_id and text, check of the text alone."""
    return docs.select("*", F.xxhash64("doc_id", "text").alias("key"), F.xxhash64(F.lit("row"), "text").alias("check"))


def _digests(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.array([hashlib.blake2b(values[a:b].tobytes(), digest_size=16).digest() if b > a else None
                     for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())], pa.binary())


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, key, check, n_shingles, digest of the shingle set (null without shingles), bands, sketch: one row per row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in t.slices(batches, "text"):
            values, bounds = shingle_sets(*t.text_buffer(part.column("text")))
            samples = min_hashes(values, bounds)
            n = part.num_rows
            keys, sketch = band_keys(samples), odd_sketches(samples)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("key"), part.column("check"), pa.array(np.diff(bounds)), _digests(values, bounds),
                 pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * BANDS), pa.array(keys.ravel())),
                 pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * sketch.shape[1]), pa.array(sketch.ravel()))],
                ["doc_id", "key", "check", "n_shingles", "digest", "bands", "sketch"])

    return _row_keys(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).mapInArrow(
        run, "doc_id long, key long, check long, n_shingles long, digest binary, bands array<long>, sketch array<long>")


def _sets(docs: DataFrame) -> DataFrame:
    """digest and shingle hashes of every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in t.slices(batches, "text"):
            values, bounds = shingle_sets(*t.text_buffer(part.column("text")))
            raw = values.tobytes()
            yield pa.RecordBatch.from_arrays(
                [_digests(values, bounds), pa.array([raw[8 * a:8 * b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())], pa.binary())],
                ["digest", "items"])

    return docs.select("text").mapInArrow(run, "digest binary, items binary")


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose whole sets share enough."""
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("x"), batch.column("y")):
            p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            at = np.searchsorted(p, q)
            at[at == len(p)] = 0
            common = int((p[at] == q).sum()) if len(p) else 0
            keep.append(100 * common >= PERCENT * (len(p) + len(q) - common))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def screen(n_a, n_b, sketch_a, sketch_b):
    """Column: sizes and sketches allow the wanted similarity."""
    odd = F.aggregate(F.zip_with(sketch_a, sketch_b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    # The expected number of set bits for 2 * SAMPLES * (1 - SCREEN) differing samples.
    most = int(SKETCH_BITS / 2 * (1 - np.exp(-4 * SAMPLES * (1 - SCREEN) / SKETCH_BITS)))
    return (F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * PERCENT) & (odd <= most)


def _screened(pairs: DataFrame, known: DataFrame, rows: int) -> DataFrame:
    """The candidate pairs (a, b), about ``rows``, that the screen lets through; known has the sizes and sketches."""
    one = known.select(F.col("node").alias("a"), F.col("n_shingles").alias("n_a"), F.col("sketch").alias("s_a"))
    two = known.select(F.col("node").alias("b"), F.col("n_shingles").alias("n_b"), F.col("sketch").alias("s_b"))
    return few_tasks(few_tasks(pairs.join(one, "a"), rows, WIDE_ROWS).join(two, "b"), rows, WIDE_ROWS).where(screen(F.col("n_a"), F.col("n_b"), F.col("s_a"), F.col("s_b"))).select("a", "b")


def _verified(store: Stored, docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The screened pairs (a, b) of classes whose whole sets are linked.

    The text of a class is fetched by the key of its first row; texts of other classes that share the key have another digest.
    """
    likely = store.save(pairs)
    n_pairs = likely.count()
    if not n_pairs:
        return likely
    nodes = few_tasks(likely.select(F.col("a").alias("node")).union(likely.select("b")).distinct(), 2 * n_pairs)
    wanted = store.save(few_tasks(classes.select("node", "digest", F.col("first.key").alias("key")).join(nodes, "node"), 2 * n_pairs))
    keys, n_wanted = wanted.select("key"), wanted.count()
    if n_wanted <= SENT_IDS:
        keys = F.broadcast(keys)
    texts = _row_keys(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).join(keys, "key", "left_semi")
    found = few_tasks(_sets(texts).join(wanted.select("node", "digest"), "digest"), n_wanted, WIDE_ROWS)
    sets = store.save(few_tasks(found.dropDuplicates(["node"]), n_wanted, WIDE_ROWS).select("node", "items"))
    left = few_tasks(likely.join(sets.select(F.col("node").alias("a"), F.col("items").alias("x")), "a"), n_pairs, WIDE_ROWS)
    both = few_tasks(left.join(sets.select(F.col("node").alias("b"), F.col("items").alias("y")), "b"), n_pairs, WIDE_ROWS)
    links = store.save(both.select("a", "b", "x", "y").mapInArrow(_linked, "a long, b long"))
    store.drop(likely, sets, wanted)
    return links


def _components(spark: SparkSession, store: Stored, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(node, component) of the classes that are linked with others; classes has node, n_shingles, bands and sketch."""
    known = classes.select("node", "n_shingles", "bands", "sketch")
    bands = known.select("node", F.posexplode("bands").alias("nth", "band"))
    n_classes = known.count()
    crowded = few_tasks(bands.groupBy("band").agg(F.count("*").alias("crowd")).where("crowd > 1"), BANDS * n_classes)
    shared = store.save(few_tasks(bands.join(crowded, "band"), BANDS * n_classes))
    n_shared = shared.count()
    score = few_tasks(shared.groupBy("node").agg(F.sum("crowd").alias("score")), n_shared)
    scored = few_tasks(shared.join(score, "node"), n_shared)
    lead = few_tasks(scored.groupBy("band").agg(F.max_by("node", F.struct("score", -F.col("node"))).alias("lead")), n_shared)
    pairs = few_tasks(shared.join(lead, "band"), n_shared).where("node <> lead").select(
        F.least("lead", "node").alias("a"), F.greatest("lead", "node").alias("b"))
    # Each class meets few leaders, mostly that of all its bands.
    links = _verified(store, docs, classes, _screened(few_tasks(pairs.distinct(), n_shared), known, 2 * n_classes))
    found = components(spark, links, store)
    for last in (False, True):
        # Buckets that still hold several components.
        held = few_tasks(shared.join(found, "node", "left"), n_shared).select(
            "band", "nth", "node", F.coalesce("component", "node").alias("component"))
        apart = few_tasks(held.groupBy("band").agg(F.min("component").alias("c0"), F.max("component").alias("c1"), F.min_by(
            F.struct("node", "component"), F.xxhash64("node")).alias("lead")).where("c0 < c1"), n_shared)
        if not last:
            pairs = few_tasks(held.join(apart, "band"), n_shared).where("component <> lead.component").select(
                F.least("node", "lead.node").alias("a"), F.greatest("node", "lead.node").alias("b"))
            pairs = _screened(few_tasks(pairs.distinct(), n_shared), known, 2 * n_classes)
        else:
            open_ = store.save(few_tasks(held.join(apart.select("band"), "band", "left_semi"), n_shared))
            n_open = open_.count()
            left = store.save(few_tasks(open_.join(known, "node"), n_open, WIDE_ROWS))
            store.drop(open_)
            x, y = left.alias("x"), left.alias("y")
            # A pair meets in the first of the bands it shares only.
            first = F.array_position(F.zip_with("x.bands", "y.bands", lambda p, q: p == q), True) == F.col("x.nth") + 1
            pairs = x.join(y, (F.col("x.band") == F.col("y.band")) & (F.col("x.component") < F.col("y.component")) & first
                           & screen(F.col("x.n_shingles"), F.col("y.n_shingles"), F.col("x.sketch"), F.col("y.sketch")))
            pairs = few_tasks(pairs, n_open, WIDE_ROWS).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
        more = _verified(store, docs, classes, pairs)
        if not more.isEmpty():
            links = store.save(links.union(more))
            found = components(spark, links, store)
    store.drop(shared)
    return found


def _grouped(spark: SparkSession, store: Stored, docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, key, check, n_shingles, and first, the first row (nameless, doc_id, key, check) of its group.

    first is null without shingles. Rows with equal shingle sets are one class; classes are numbered as they are written.
    """
    marks = store.save(signatures(docs))
    rows = store.save(marks.select("doc_id", "key", "check", "n_shingles", "digest"))
    head = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "key", "check")).alias("first")
    sets = marks.where("digest is not null").groupBy("digest").agg(
        head, F.count("*").alias("n_rows"), *(F.first(c).alias(c) for c in ("n_shingles", "bands", "sketch")))
    classes = store.save(few_tasks(sets, rows.count(), WIDE_ROWS).withColumn("node", F.monotonically_increasing_id()))
    store.drop(marks)
    found = _components(spark, store, docs, classes)
    narrow = classes.select("node", "digest", "n_rows", "first")
    linked = store.save(narrow.select("node", "first").join(found, "node"))
    groups = linked.groupBy("component").agg(F.min("first").alias("group_first"), F.count("*").alias("n_classes"))
    linked = spread_join(linked.select("node", "component"), store.save(groups), "component", "n_classes").select("node", "group_first")
    table = store.save(narrow.join(linked, "node", "left").select("digest", "n_rows", F.coalesce("group_first", "first").alias("first")))
    store.drop(classes)
    named = spread_join(rows.where("digest is not null"), table, "digest", "n_rows")
    lone = rows.where("digest is null").withColumn("first", F.lit(None).cast(table.schema["first"].dataType))
    return named.unionByName(lone)


def near_duplicates(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of docs.

    Rows that share a doc_id are told apart by their texts. component_id is null where the whole group has no doc_id; such
    rows are kept, other rows without doc_id are not.
    """
    rows = _grouped(spark, Stored(spark, "near"), docs)
    component = F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))


def keep_one(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of docs that stay when each group keeps one row, that with the smallest doc_id (none: last).

    Of rows with equal doc_id and text in a group any one stays. Rows without shingles are in no group and stay.
    Columns may have any name and type.
    """
    store = Stored(spark, "keep")
    rows = _grouped(spark, store, docs).where("first is not null")
    gone = (F.col("key") != F.col("first.key")) | (F.col("check") != F.col("first.check"))
    fate = store.save(rows.groupBy("key", "check").agg(F.max(gone).alias("gone"), F.count("*").alias("n_rows")).where("gone or n_rows > 1"))
    # The columns travel in one struct, so that no name can clash.
    held = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                       F.xxhash64(F.col("doc_id").cast("long"), "text").alias("key"), F.xxhash64(F.lit("row"), "text").alias("check"))
    # Texts whose key is in no fate need no shuffle: only the others meet it. Which of them share just the key, the check tells.
    apart = None
    if fate.count() <= SENT_IDS:
        keys = F.broadcast(fate.select("key"))
        apart, held = held.join(keys, "key", "left_anti").select("row"), held.join(keys, "key", "left_semi")
    met = spread_join(held, fate, ["key", "check"], "n_rows")
    stay = met.where("gone is null").select("row")
    if apart is not None:
        stay = apart.union(stay)
    once = met.where("not gone").dropDuplicates(["key", "check"]).select("row")
    return stay.union(once).select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
