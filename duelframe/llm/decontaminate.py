"""Benchmark decontamination: a BM25 inverted index of test items, searched with every passage of every text.

Texts are cut into passages of WINDOW words, STEP apart. Items are indexed in blocks. An item's weakest terms, which
together weigh at most half its threshold, cannot retrieve it alone; of the other terms the index keeps the largest
impact in each block, and a block is scored for a passage only if the sum of these bounds reaches what the block's
items need at least (block-max WAND), so no item above its threshold is lost. A retrieved item is then verified on the whole
text: question (all but the last sentence) and answer (the last sentence) must each share OVERLAP of their five-word
shingles with it. Words are lower-cased (A-Z) runs without white space and ASCII punctuation, so marks around a passage
do not hide it. Items of fewer than five words must appear whole.

The index of one group of about GROUP items travels with the tasks; more items are searched group after group, each a
pass over the texts. Document frequencies, number and mean length are those of all items, so that grouping changes no score. Null or empty texts and items match nothing, repeated rows match alike, equal items are each
reported, and other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textops as t
from .storage import Stored

WINDOW, STEP = 128, 64
#: Share of an item's own score that a passage has to reach, for the part of the item that fits a step.
THRESHOLD = 0.6
OVERLAP = 0.75
K1, B = 1.2, 0.75
BLOCK = 8
GROUP = 4096

SCHEMA = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"


@dataclass
class Item:
    item_id: int
    question: np.ndarray
    answer: np.ndarray
    short: bytes | None


@dataclass
class Index:
    items: list[Item]
    vocabulary: np.ndarray  # sorted term hashes
    start: np.ndarray       # postings of term v in block b: start[v * blocks + b] to the next
    item: np.ndarray
    impact: np.ndarray
    strong: np.ndarray      # bool by term: some item needs it
    bound: np.ndarray       # float32 [term, block], of items that need the term
    threshold: np.ndarray   # by item
    least: np.ndarray       # by block: what strong terms have to give


def _words(text: str) -> tuple[list[bytes], np.ndarray, int]:
    """Lower-cased words, their hashes, and the number of words before the last sentence."""
    raw = np.frombuffer(text.encode(), np.uint8)
    buf = t.LOWER[raw]
    words = t.Words(buf, np.array([0, len(buf)]), t.IS_MARK)
    data = buf.tobytes()
    tokens = [data[a:b] for a, b in zip(words.starts.tolist(), words.ends.tolist())]
    ends = [m.end() for m in re.finditer(rb"[.!?](?=[\x20\x09-\x0D]|$)|\n", data)]
    ends = [e for e in ends if data[e:].strip()]
    return tokens, t.RangeHash(buf)(words.starts, words.ends), int(np.searchsorted(words.starts, ends[-1])) if ends else 0


@dataclass
class Statistics:
    """What BM25 takes from all items with words."""
    n: int
    mean_length: float
    term: np.ndarray  # sorted term hashes, those of the items to index at least
    df: np.ndarray


def build_index(rows: list[tuple[int, str | None]], whole: Statistics | None = None) -> Index:
    """Index of the rows; without ``whole`` they are all items there are."""
    items, terms, lengths = [], [], []
    for item_id, text in rows:
        tokens, hashes, cut = _words(text or "")
        if item_id is None or not tokens:
            continue
        # Question and answer need five words each; otherwise both are the whole item.
        cut = min(cut, len(hashes) - 5)
        parts = (hashes[:cut], hashes[cut:]) if cut >= 5 else (hashes, hashes)
        grams = [np.unique(t.shingles(p, np.array([0, len(p)]), 5)[0]) for p in parts]
        items.append(Item(item_id, *grams, b" " + b" ".join(tokens) + b" " if len(tokens) < 5 else None))
        terms.append(np.unique(hashes, return_counts=True))
        lengths.append(len(hashes))
    n = len(items)
    blocks = max(1, -(-n // BLOCK))
    if not n:
        return Index([], np.zeros(0, t.U64), np.zeros(1, np.int64), *(np.zeros(0, k) for k in (np.int64, np.float32, bool)),
                     np.zeros((0, 1), np.float32), np.zeros(0), np.full(1, np.inf))
    order = sorted(range(n), key=lambda i: (lengths[i], items[i].item_id))
    items, terms, lengths = [items[i] for i in order], [terms[i] for i in order], np.array([lengths[i] for i in order])
    term = np.concatenate([x[0] for x in terms])
    tf = np.concatenate([x[1] for x in terms]).astype(np.float64)
    owner = np.repeat(np.arange(n), [len(x[0]) for x in terms])
    vocabulary, term = np.unique(term, return_inverse=True)
    if whole is None:
        whole = Statistics(n, lengths.mean(), vocabulary, np.bincount(term))
    df = whole.df[np.searchsorted(whole.term, vocabulary)]
    idf = np.log(1 + (whole.n - df + 0.5) / (df + 0.5))
    impact = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[owner] / whole.mean_length))
    own = np.bincount(owner, weights=impact, minlength=n)
    threshold = THRESHOLD * own * np.minimum(1, STEP / lengths)
    slot = term * blocks + owner // BLOCK
    by = np.argsort(slot, kind="stable")
    start = np.searchsorted(slot[by], np.arange(len(vocabulary) * blocks + 1))
    rise = np.lexsort((impact, owner))
    sums = np.cumsum(impact[rise])
    heads = np.flatnonzero(np.r_[True, owner[rise][1:] != owner[rise][:-1]])
    sums -= np.repeat(sums[heads] - impact[rise][heads], np.diff(np.r_[heads, len(rise)]))
    weak = np.zeros(len(impact), bool)
    weak[rise] = sums <= threshold[owner[rise]] / 2
    need = threshold - np.bincount(owner[weak], weights=impact[weak], minlength=n)
    strong = np.zeros(len(vocabulary), bool)
    strong[term[~weak]] = True
    bound = np.zeros(len(vocabulary) * blocks, np.float32)
    np.maximum.at(bound, slot[~weak], impact[~weak].astype(np.float32))
    least = np.array([need[b * BLOCK:(b + 1) * BLOCK].min() for b in range(blocks)])
    return Index(items, vocabulary, start, owner[by], impact[by].astype(np.float32), strong, bound.reshape(-1, blocks), threshold, least)


def search(index: Index, hashes: np.ndarray, bounds: np.ndarray) -> dict[tuple[int, int], float]:
    """(text, item) to the best passage score, for every passage that reaches the item's threshold."""
    if not index.items or not len(hashes):
        return {}
    place = np.searchsorted(index.vocabulary, hashes)
    place[place == len(index.vocabulary)] = 0
    known = index.vocabulary[place] == hashes
    at = np.flatnonzero(known & index.strong[place])
    if not len(at):
        return {}
    term = place[at]
    counts = np.diff(bounds)
    first = np.concatenate([[0], np.cumsum(-(-counts // STEP))])
    doc = np.searchsorted(bounds, at, side="right") - 1
    step = (at - bounds[doc]) // STEP
    # A word belongs to the passage that starts in its step and to the one before.
    passage = np.concatenate([first[doc] + step, (first[doc] + step - 1)[step > 0]])
    v = len(index.vocabulary)
    pairs = np.unique(passage * v + np.concatenate([term, term[step > 0]]))
    passage, term = pairs // v, pairs % v
    heads = np.flatnonzero(np.r_[True, passage[1:] != passage[:-1]])
    blocks = index.bound.shape[1]
    hits = []
    for low in range(0, blocks, 16):  # bounds of some blocks at a time keep the arrays small
        bound = np.add.reduceat(index.bound[term, low:low + 16], heads, axis=0)
        row, block = np.nonzero(bound >= index.least[low:low + 16] * (1 - 1e-4))
        hits.append(np.stack([passage[heads[row]], block + low], 1))
    number, block = np.concatenate(hits).T
    found: dict[tuple[int, int], float] = {}
    if not len(number):
        return found
    # All terms of the passages that are left, then the postings of their blocks.
    wanted, row = np.unique(number, return_inverse=True)
    text = np.searchsorted(first, wanted, side="right") - 1
    begin = bounds[text] + (wanted - first[text]) * STEP
    size = np.minimum(begin + WINDOW, bounds[text + 1]) - begin
    word = np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())
    owner = np.repeat(np.arange(len(wanted)), size)[known[word]]
    pairs = np.unique(owner * v + place[word[known[word]]])
    owner, term = pairs // v, pairs % v
    heads = np.searchsorted(owner, np.arange(len(wanted) + 1))
    size = np.diff(heads)[row]
    hit = np.repeat(np.arange(len(row)), size)
    slot = term[np.repeat(heads[row] - np.cumsum(size) + size, size) + np.arange(size.sum())] * blocks + block[hit]
    size = index.start[slot + 1] - index.start[slot]
    post = np.repeat(index.start[slot] - np.cumsum(size) + size, size) + np.arange(size.sum())
    cell = np.repeat(hit, size) * BLOCK + index.item[post] % BLOCK
    scores = np.bincount(cell, weights=index.impact[post], minlength=len(row) * BLOCK).reshape(-1, BLOCK)
    item = block[:, None] * BLOCK + np.arange(BLOCK)
    least = np.append(index.threshold, np.inf)[np.minimum(item, len(index.items))] * (1 - 1e-4)
    for k, j in zip(*np.nonzero(scores >= least)):
        key = (int(text[row[k]]), int(item[k, j]))
        found[key] = max(float(scores[k, j]), found.get(key, 0.0))
    return found


def matches(index: Index, buf: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, float, float, float]]:
    """(text, item number, score, question overlap, answer overlap) of all verified pairs."""
    low = t.LOWER[buf]
    words = t.Words(low, offsets, t.IS_MARK)
    hashes = t.RangeHash(low)(words.starts, words.ends)
    out, grams, cached = [], None, -1
    for (text, number), score in sorted(search(index, hashes, words.bounds).items()):
        item = index.items[number]
        a, b = words.bounds[text], words.bounds[text + 1]
        if item.short is not None:
            data = b" " + b" ".join(low[s:e].tobytes() for s, e in zip(words.starts[a:b], words.ends[a:b])) + b" "
            if item.short in data:
                out.append((text, number, score, 1.0, 1.0))
            continue
        if cached != text:
            grams, cached = np.unique(t.shingles(hashes[a:b], np.array([0, b - a]), 5)[0]), text
        shares = [float(np.isin(g, grams).mean()) for g in (item.question, item.answer)]
        if min(shares) >= OVERLAP:
            out.append((text, number, score, *shares))
    return out


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """part, term (hash) and number of words of every item; a term once per item, length on its first row only."""
    for batch in batches:
        for part, text in zip(batch.column("part").to_pylist(), batch.column("text").to_pylist()):
            hashes = _words(text or "")[1]
            if len(hashes):
                term = np.unique(hashes)
                length = np.zeros(len(term), np.int64)
                length[0] = len(hashes)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(term), part, np.int64)), pa.array(term.view(np.int64)), pa.array(length)],
                                                 ["part", "term", "length"])


def _groups(spark: SparkSession, items: DataFrame) -> Iterator[Index]:
    """Indexes of groups of about GROUP items, fetched one after another, with the statistics of all items."""
    items = items.where("item_id is not null").select("item_id", "text")
    parts = max(1, -(-items.count() // GROUP))
    store = Stored(spark, "items")
    items = items.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)))
    terms = store.save(items.mapInArrow(_item_terms, "part long, term long, length long"))
    n, words = terms.agg(F.count_if(F.col("length") > 0), F.sum("length")).first()
    df = terms.groupBy("term").agg(F.count("*").alias("df"))
    df = store.save(terms.select("part", "term").distinct().join(df, "term"))
    for k in range(parts):
        mine = items.where(F.col("part") == k).collect()
        found = df.where(F.col("part") == k).select("term", "df").toArrow()
        term = found.column("term").to_numpy().view(t.U64)
        order = np.argsort(term)
        whole = Statistics(n, (words or 0) / max(n, 1), term[order], found.column("df").to_numpy()[order])
        yield build_index(sorted(((r[0], r[1]) for r in mine), key=lambda r: (r[0], r[1] or "")), whole)


def find(spark: SparkSession, docs: DataFrame, items: DataFrame) -> DataFrame:
    """Verified pairs of docs(doc_id, text) and items(item_id, text), see SCHEMA."""
    out = spark.createDataFrame([], SCHEMA)
    for index in _groups(spark, items):
        handle = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], handle=handle) -> Iterator[pa.RecordBatch]:
            index = handle.value
            for part in t.slices(batches, "text"):
                got = matches(index, *t.text_buffer(part.column("text")))
                if got:
                    text, number, score, question, answer = zip(*got)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id").take(pa.array(text)), pa.array([index.items[k].item_id for k in number], pa.int64()),
                         pa.array(score, pa.float64()), pa.array(question, pa.float64()), pa.array(answer, pa.float64())],
                        ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])

        out = out.unionByName(docs.select("doc_id", "text").mapInArrow(run, SCHEMA))
    return out


def clean(spark: SparkSession, docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of docs that hold no item, with all their columns."""
    at = docs.columns.index("text")
    for index in _groups(spark, items):
        handle = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], handle=handle) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in t.slices(iter([batch]), batch.schema.names[at]):
                    keep = np.ones(part.num_rows, bool)
                    keep[[m[0] for m in matches(handle.value, *t.text_buffer(part.column(at)))]] = False
                    yield part.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
