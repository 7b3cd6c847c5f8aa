"""Ranked lexical search by dual trees: the k best documents of every item, exactly.

Terms, weights and scores are integers (see :func:`weight` and :func:`impact`), so sums in doubles are exact. A score is
the product of an item's vector (weight per term) and a document's (impact per term). Items form a tree by shared terms
and each block of documents forms one by likeness; a node holds the largest value of every coordinate below it, so the
product of two nodes bounds every score between them. A pair of nodes goes on only if its bound reaches the weakest k-th
best score of the node's items, and single items against single documents are scores.

Jobs: one reads the texts and writes each document's item terms; one counts documents, lengths and document frequencies
over all of them; a bounded sample of SEEDS documents gives each item a first k-th best score (a valid floor, since its
documents are ranked too); one searches all documents, each task keeping k documents an item; a window merges them.
Items go in groups of at most GROUP_TERMS different terms (one item at least), fetched one after another, each with jobs of
its own over the whole table; the statistics are those of all documents, whatever the grouping.

Null and empty texts and items have no terms: they rank and are ranked nowhere, nor do they count. Rows without doc_id
count and are ranked, after equal scores with one; rows without item_id are ranked under a null id. Repeated rows are
ranked each, equal items too; which of two rows with equal doc_id and score comes first is open. Empty tables give no
rows. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .storage import Stored

TOP = 10
#: Different terms of one group of items.
GROUP_TERMS = 1 << 17
#: Different terms of one item tree, and coordinates of one block of documents.
TREE_TERMS, BLOCK_CELLS = 1 << 12, 1 << 22
SEEDS = 20_000
LEAF, FAN = 16, 8
#: The runs of letters and digits of the contract, in bytes: every byte of a character beyond ASCII belongs to one.
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")

VECTORS = "doc_id long, n long, terms binary, counts binary"
RANKED = "item int, doc_id long, score long"


def terms_of(text: str) -> list[bytes]:
    """Terms in order, A-Z lower-cased."""
    return _TERM.findall(text.encode().lower())


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impact(tf: np.ndarray, n: np.ndarray, n_docs: int, length: int) -> np.ndarray:
    """Integer saturation of tf occurrences in documents of n terms; ``length``: all terms of all documents.

    Python's integers carry the product of n and n_docs, which outgrows 64 bits at scale.
    """
    sizes, row = np.unique(n, return_inverse=True)
    m = np.array([100 - 90 + (90 * x * n_docs) // length for x in sizes.tolist()], np.int64)[row]
    return (1_000_000_000 * tf.astype(np.int64)) // (1000 * tf.astype(np.int64) + 8 * m)


@dataclass
class Node:
    """Part of an item tree: items, their terms (columns of the tree) and the largest weight of each."""
    items: np.ndarray
    terms: np.ndarray
    weights: np.ndarray
    children: list["Node"] = field(default_factory=list)


@dataclass
class Tree:
    vocabulary: np.ndarray  # sorted term numbers of the group; the tree's columns
    root: Node


def item_trees(item_terms: list[np.ndarray], weights: np.ndarray) -> list[Tree]:
    """Trees over items (sorted arrays of term numbers) of at most TREE_TERMS terms each, one item at least.

    Items are put in the order of their heaviest terms, so that neighbours share some.
    """
    order = sorted((i for i in range(len(item_terms)) if len(item_terms[i])),
                   key=lambda i: sorted(item_terms[i].tolist(), key=lambda t: (-weights[t], t)))
    out, mine, seen = [], [], set()
    for i in order:
        more = seen.union(item_terms[i].tolist())
        if mine and len(more) > TREE_TERMS:
            out.append(mine)
            mine, more = [], set(item_terms[i].tolist())
        mine.append(i)
        seen = more
    return [_tree(items, item_terms, weights) for items in [*out, mine] if items]


def _tree(items: list[int], item_terms: list[np.ndarray], weights: np.ndarray) -> Tree:
    vocabulary = np.unique(np.concatenate([item_terms[i] for i in items]))
    level = [Node(np.array([i]), at := np.searchsorted(vocabulary, item_terms[i]), weights[vocabulary[at]].astype(float)) for i in items]
    while len(level) > 1:
        level = [_above(level[k:k + FAN]) for k in range(0, len(level), FAN)]
    return Tree(vocabulary, level[0])


def _above(children: list[Node]) -> Node:
    terms, at = np.unique(np.concatenate([c.terms for c in children]), return_inverse=True)
    weights = np.zeros(len(terms))
    np.maximum.at(weights, at, np.concatenate([c.weights for c in children]))
    return Node(np.concatenate([c.items for c in children]), terms, weights, children)


class Best:
    """The k best (score, doc_id) of every item so far; ``floor`` is what a further document has to reach."""

    def __init__(self, n_items: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, np.maximum(floor, 1.0)
        self.rows: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0), np.zeros(0, np.int64))] * n_items

    def add(self, item: int, scores: np.ndarray, places: np.ndarray, rank: np.ndarray) -> None:
        """``places``: rows of the caller's table, ``rank``: orders them by doc_id."""
        old_scores, old_places = self.rows[item]
        scores, places = np.concatenate([old_scores, scores]), np.concatenate([old_places, places])
        best = np.lexsort((rank[places], -scores))[:self.k]
        self.rows[item] = scores[best], places[best]
        if len(best) == self.k:
            self.floor[item] = max(self.floor[item], scores[best[-1]])


class Block:
    """Documents against the columns of one item tree, as levels of coordinate maxima; the last level is the documents."""

    def __init__(self, owner: np.ndarray, column: np.ndarray, value: np.ndarray, width: int):
        """(owner, column, value) cells; owners are 0, 1, ... and columns below ``width``."""
        n = int(owner[-1]) + 1
        cells = np.zeros((n, width), np.float32)  # impacts are below 2**24
        cells[owner, column] = value
        # Documents of one heaviest column lie together.
        self.order = np.lexsort((-cells.max(1), cells.argmax(1)))
        self.levels = [cells[self.order]]
        size = LEAF
        while len(self.levels[0]) > 1:
            self.levels.insert(0, np.maximum.reduceat(self.levels[0], np.arange(0, len(self.levels[0]), size), axis=0))
            size = FAN
        self.sizes = [FAN] * (len(self.levels) - 2) + [LEAF]

    def children(self, level: int, rows: np.ndarray) -> np.ndarray:
        size = self.sizes[level]
        below = (rows[:, None] * size + np.arange(size)).ravel()
        return below[below < len(self.levels[level + 1])]


def search(tree: Tree, block: Block, best: Best, places: np.ndarray, rank: np.ndarray) -> int:
    """Offer the block's documents (``places`` of the caller's table) to ``best``; gives the number of products."""
    work = 0
    stack = [(tree.root, 0, np.zeros(1, np.int64))]
    last = len(block.levels) - 1
    while stack:
        node, level, rows = stack.pop()
        bounds = block.levels[level][np.ix_(rows, node.terms)].astype(float) @ node.weights
        work += len(rows)
        live = bounds >= best.floor[node.items].min()
        rows = rows[live]
        if not len(rows):
            continue
        if node.children:
            # Items first down to one, documents after each step.
            below, level = (block.children(level, rows), level + 1) if level < last else (rows, level)
            stack += [(child, level, below) for child in node.children]
        elif level < last:
            stack.append((node, level + 1, block.children(level, rows)))
        else:
            best.add(int(node.items[0]), bounds[live], places[rows], rank)
    return work


class Search:
    """Searches the rows of ``add`` in blocks; ``result`` has the k best of every item."""

    def __init__(self, trees: list[Tree], n_items: int, n_terms: int, n_docs: int, length: int, k: int, floor: np.ndarray):
        self.trees, self.n_docs, self.length, self.k = trees, n_docs, length, k
        self.best = Best(n_items, k, floor)
        self.columns = []
        for tree in trees:
            column = np.full(n_terms, -1, np.int64)
            column[tree.vocabulary] = np.arange(len(tree.vocabulary))
            self.columns.append(column)
        self.doc_ids: list = []  # of the rows that are among the best, and of the batch

    def add(self, batch: pa.RecordBatch) -> None:
        sizes = np.array([len(x.as_buffer() or b"") // 4 for x in batch.column("terms")], np.int64)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        term = np.frombuffer(b"".join(batch.column("terms").to_pylist()), np.int32)
        tf = np.frombuffer(b"".join(batch.column("counts").to_pylist()), np.int32)
        if not len(term):
            return
        value = impact(tf, batch.column("n").to_numpy()[owner], self.n_docs, self.length)
        start = len(self.doc_ids)
        self.doc_ids += batch.column("doc_id").to_pylist()
        known = np.array([d is not None for d in self.doc_ids])
        ids = np.array([d or 0 for d in self.doc_ids], np.int64)
        rank = np.empty(len(ids), np.int64)
        rank[np.lexsort((ids, ~known))] = np.arange(len(ids))
        for tree, column in zip(self.trees, self.columns):
            at = column[term]
            inside = at >= 0
            docs, row = np.unique(owner[inside], return_inverse=True)
            step = max(LEAF, BLOCK_CELLS // len(tree.vocabulary))
            cuts = np.searchsorted(row, np.arange(0, len(docs) + step, step))
            for a, b, first in zip(cuts[:-1], cuts[1:], range(0, len(docs), step)):
                block = Block(row[a:b] - first, at[inside][a:b], value[inside][a:b], len(tree.vocabulary))
                search(tree, block, self.best, start + docs[first:first + step][block.order], rank)
        self._forget()

    def _forget(self) -> None:
        """Keep the doc_ids of the best only."""
        kept, at = np.unique(np.concatenate([places for _, places in self.best.rows]), return_inverse=True)
        self.doc_ids = [self.doc_ids[p] for p in kept.tolist()]
        ends = np.cumsum([len(places) for _, places in self.best.rows])
        self.best.rows = [(scores, at[e - len(scores):e]) for (scores, _), e in zip(self.best.rows, ends.tolist())]

    def result(self) -> pa.RecordBatch:
        item = np.repeat(np.arange(len(self.best.rows)), [len(s) for s, _ in self.best.rows])
        ids = [self.doc_ids[p] for _, places in self.best.rows for p in places.tolist()]
        scores = np.concatenate([s for s, _ in self.best.rows] or [np.zeros(0)])
        return pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(ids, pa.int64()), pa.array(scores.astype(np.int64))],
                                          ["item", "doc_id", "score"])


def _vectors(docs: DataFrame, handle) -> DataFrame:
    """VECTORS of every document with a term: its number of terms, and number and count of the items' terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = handle.value
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                found = terms_of(text.as_py() or "")
                if found:
                    counts = Counter(found)
                    hits = [(number[t], counts[t]) for t in counts.keys() & number.keys()]
                    terms, tf = np.array(sorted(hits), np.int32).reshape(-1, 2).T
                    rows.append((doc_id, len(found), terms.tobytes(), tf.tobytes()))
            doc_ids, n, terms, tf = zip(*rows) if rows else ((),) * 4
            yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(n, pa.int64()), pa.array(terms, pa.binary()),
                                              pa.array(tf, pa.binary())], ["doc_id", "n", "terms", "counts"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, VECTORS)


def _frequencies(vectors: DataFrame, n_terms: int) -> np.ndarray:
    """Documents that hold each term; each task counts its own first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(n_terms, np.int64)
        for batch in batches:
            df += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int32), minlength=n_terms)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(df[some])], ["term", "df"])

    out = np.zeros(n_terms, np.int64)
    rows = vectors.select("terms").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()
    for term, df in rows:
        out[term] = df
    return out


def _best(vectors: DataFrame, make) -> DataFrame:
    """The k best documents of every item in each partition, merged; ``make`` gives a task's Search."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = make()
        for batch in batches:
            mine.add(batch)
        yield mine.result()

    rows = vectors.mapInArrow(run, RANKED)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order))


def _groups(items: DataFrame) -> Iterator[list[tuple]]:
    """(item_id, terms) of all items with a term, in groups of at most GROUP_TERMS different terms."""
    group, seen = [], set()
    for item_id, text in items.select("item_id", "text").toLocalIterator():
        terms = set(terms_of(text or ""))
        if not terms:
            continue
        if group and len(seen | terms) > GROUP_TERMS:
            yield group
            group, seen = [], set()
        group.append((item_id, terms))
        seen |= terms
    if group:
        yield group


def rank(spark: SparkSession, docs: DataFrame, items: DataFrame, k: int = TOP, seeds: int = SEEDS) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best docs(doc_id, text) of each of items(item_id, text)."""
    store, out = Stored(spark, "dual-tree"), None
    for group in _groups(items):
        words = sorted(set().union(*(terms for _, terms in group)))
        number = {word: i for i, word in enumerate(words)}
        item_terms = [np.array(sorted(number[t] for t in terms), np.int64) for _, terms in group]
        vectors = store.save(_vectors(docs, spark.sparkContext.broadcast(number)))
        n_docs, length = vectors.agg(F.count("*"), F.sum("n")).first()
        if not n_docs:
            break
        df = _frequencies(vectors, len(words))
        weights = np.array([weight(n_docs, int(x)) for x in df], np.int64)
        handle = spark.sparkContext.broadcast((item_trees(item_terms, weights), len(group), len(words), n_docs, length, k))
        floor = np.zeros(len(group))
        if n_docs > 2 * seeds:
            first = _best(vectors.sample(seeds / n_docs, seed=7), lambda: Search(*handle.value, np.zeros(handle.value[1])))
            for item, score in first.where(F.col("rank") == k).select("item", "score").collect():
                floor[item] = score
        floors = spark.sparkContext.broadcast(floor)
        ranked = _best(vectors, lambda handle=handle, floors=floors: Search(*handle.value, floors.value.copy())).where(F.col("rank") <= k)
        ids = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(group)], "item int, item_id long")
        mine = ranked.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")
        out = mine if out is None else out.unionByName(mine)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if out is None else out
