"""Toxicity scores from a learned, weighted lexicon matched by Aho-Corasick over folded text.

Folding lower-cases, maps look-alike letters of other scripts and digits or signs inside words to one letter each, and
keeps the words only. Lexicon entries are whole words or word beginnings whose training texts are far more often toxic
than others; a word counts once, with its heaviest entry. Exception phrases (two words that hold a hit but stand in clean
texts) void the hits inside them. The weights of a text are normalised by its length and turned into a probability.

Null and empty texts have no hits and get the score of a text without hits. Without both labels among the training rows
all scores are 0. Labels other than 0 and 1 count as null. Repeated training rows count once per text. Columns other than those named are ignored.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled rows used for the fit, drawn by hash (about that many).
TRAIN_ROWS = 20_000
#: Toxic training texts that an entry needs: this many, and this share of them. A text of n different words and beginnings
#: supports n entries, so there are at most n / SUPPORT_SHARE entries, n averaged over the drawn toxic texts.
SUPPORT, SUPPORT_SHARE = 4, 0.004
#: Least weight of an entry, in nats of odds.
LEAST_WEIGHT = 2.0
PREFIXES = (4, 5, 6, 7)

# Characters that look like Latin letters. Lower-case l, digit one and the bar all become i.
LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x",
    "і": "i", "ї": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ſ": "s",
}
# Digits and signs that stand for letters inside words.
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "|": "i", "!": "i"}
_LOOK = re.compile("[" + "".join(LOOKALIKES) + "]")
_LOOK_MAP = str.maketrans(LOOKALIKES)
_MARKED = re.compile(r"[013-57-9@$|!]*[^\W\d_](?:[\w@$|!]*[\w])?")
_DIGIT_MAP = str.maketrans(DIGITS)
_HAS_MARK = re.compile(r"[013-57-9@$|!][^\W\d_]|[^\W\d_][013-57-9]")
_WORD = re.compile(r"[^\W\d_]+")


def fold(text: str | None) -> str:
    """The folded words, each after one blank, and a blank at the end."""
    if not text:
        return " "
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    text = text.lower()
    if not text.isascii() and _LOOK.search(text):
        text = text.translate(_LOOK_MAP)
    if _HAS_MARK.search(text):
        text = _MARKED.sub(lambda m: m.group().translate(_DIGIT_MAP), text)
    return f" {' '.join(_WORD.findall(text))} ".replace("l", "i")


@dataclass
class Model:
    entries: dict[str, float]  # ' word ' or ' beginning' -> weight
    exceptions: list[str]      # ' one two '
    coefficients: tuple[float, float, float]

    def automaton(self) -> ahocorasick.Automaton:
        out = ahocorasick.Automaton()
        for entry, weight in self.entries.items():
            out.add_word(entry, (len(entry), weight))
        for phrase in self.exceptions:
            out.add_word(phrase, (len(phrase), 0.0))
        if len(out):
            out.make_automaton()
        return out


def hits(automaton: ahocorasick.Automaton, folded: str) -> dict[int, float]:
    """Heaviest weight by the place of the blank before a word, without words inside exception phrases."""
    found: dict[int, float] = {}
    void = []
    if not len(automaton):
        return found
    for end, (size, weight) in automaton.iter(folded):
        start = end - size + 1
        if weight == 0.0:
            void.append((start, end))
        elif weight > found.get(start, 0.0):
            found[start] = weight
    for start, end in void:
        for place in [p for p in found if start <= p < end]:
            del found[place]
    return found


def _features(total: float, n_words: int) -> tuple[float, float]:
    return math.log1p(total), math.log1p(total / math.sqrt(max(1, n_words)))


def train(docs: DataFrame, labelled: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Fit on docs(doc_id, text) and labelled(doc_id, toxic); labels other than 0 and 1 are left out.

    Three of four drawn texts give the lexicon and exceptions, the rest the probability. The driver gets the
    entries and phrases with enough support among the drawn rows and one pair of numbers for each row of the last part.
    """
    labelled = labelled.where("toxic in (0, 1) and doc_id is not null").withColumn("toxic", F.col("toxic").cast("int"))
    known = labelled.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    total = known.count()
    if total > rows:
        known = known.where(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 20)) < int((1 << 20) * rows / total))
    # At most about ``rows`` identifiers are broadcast, so the texts of all other rows stay where they are.
    drawn = (docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").groupBy("text").agg(F.max("toxic").alias("toxic"))
             .withColumn("part", F.pmod(F.xxhash64("text"), F.lit(4))))
    first, last = drawn.where("part < 3"), drawn.where("part = 3")

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, list[int]] = defaultdict(lambda: [0, 0])
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                words = set(fold(text).split())
                seen = {f" {w} " for w in words if len(w) > 2}
                seen |= {f" {w[:k]}" for w in words for k in PREFIXES if len(w) > k}
                for entry in seen:
                    sums[entry][toxic] += 1
                sums[""][toxic] += 1
        yield _counted(sums)

    schema = "entry string, clean long, toxic long"
    counted = first.mapInArrow(entries, schema).groupBy("entry").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    counted = counted.where(f"entry = '' or toxic >= {SUPPORT}").persist()
    base = counted.where("entry = ''").first()
    if base is None or not base.clean or not base.toxic:
        counted.unpersist()
        return Model({}, [], (0.0, 0.0, -40.0))
    odds = F.log((F.col("toxic") + 0.5) / (base.toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (base.clean + 1.0))
    weight = odds * F.col("toxic") / (F.col("toxic") + 3.0)
    best = (counted.where("entry <> ''").select("entry", weight.alias("weight"), (weight * F.col("toxic")).alias("evidence"))
            .where((F.col("weight") >= LEAST_WEIGHT) & (F.col("toxic") >= SUPPORT_SHARE * base.toxic)).orderBy(F.desc("evidence"), "entry").collect())
    counted.unpersist()
    model = Model({r.entry: float(r.weight) for r in best}, [], (0.0, 0.0, 0.0))

    def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, sums = model.automaton(), defaultdict(lambda: [0, 0])
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                folded = fold(text)
                seen = set()
                for start in hits(automaton, folded):
                    stop = folded.index(" ", start + 1)
                    before = folded.rfind(" ", 0, start)
                    after = folded.find(" ", stop + 1)
                    if before >= 0:
                        seen.add(folded[before:stop + 1])
                    if after >= 0:
                        seen.add(folded[start:after + 1])
                for phrase in seen:
                    sums[phrase][toxic] += 1
        yield _counted(sums)

    if model.entries:
        rare = (first.mapInArrow(phrases, schema).groupBy("entry").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
                .where("clean >= 3 and clean >= 20 * toxic").orderBy(F.desc("clean"), "entry").collect())
        model.exceptions = [r.entry for r in rare]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = model.automaton()
        for batch in batches:
            got = [_features(sum(hits(automaton, f := fold(x)).values()), f.count(" ") - 1) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.float64()), pa.array([g[1] for g in got], pa.float64()),
                                              batch.column("toxic").cast(pa.float64())], ["a", "b", "toxic"])

    got = last.mapInArrow(sums, "a double, b double, toxic double").toArrow()
    model.coefficients = _logistic(*(got.column(c).to_numpy() for c in ("a", "b", "toxic")))
    return model


def _counted(sums: dict[str, list[int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([v[0] for v in sums.values()], pa.int64()),
                                       pa.array([v[1] for v in sums.values()], pa.int64())], ["entry", "clean", "toxic"])


def _logistic(a: np.ndarray, b: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Ridge logistic regression by Newton steps; without rows of both kinds, one hit is taken as toxic."""
    if not len(y) or y.min() == y.max():
        return (4.0, 0.0, -4.0)
    x = np.stack([a, b, np.ones(len(a))], 1)
    w = np.zeros(3)
    ridge = np.diag([0.1, 0.1, 1e-6])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w = w + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
    return tuple(float(v) for v in w)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (probability of label 1), predicted (1 from 0.5), n_hits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = model.automaton()
        wa, wb, w0 = model.coefficients
        for batch in batches:
            scores, n_hits = [], []
            for text in batch.column("text").to_pylist():
                folded = fold(text)
                found = hits(automaton, folded)
                a, b = _features(sum(found.values()), folded.count(" ") - 1)
                scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, wa * a + wb * b + w0)))))
                n_hits.append(len(found))
            s = pa.array(scores, pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), s, pa.array([int(x >= 0.5) for x in scores], pa.int32()),
                                              pa.array(n_hits, pa.int64())], ["doc_id", "score", "predicted", "n_hits"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, predicted int, n_hits long")
