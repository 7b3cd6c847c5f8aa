"""Language of a text and of its spans: scripts narrow the candidates, Viterbi over word scores labels the spans.

Words are scored with byte trigrams under each learned language. A language is a candidate for a word if at least one
percent of its training words are in the word's script (all languages if none is). The best label sequence pays
SWITCH for every change of language, so that single odd words do not start a span. A text gets the language that
covers most letters.

Null texts and texts without letters get 'und' and score 0. Ties go to the language first in alphabetical order.
Without any training rows every text gets 'und'. Repeated rows are labelled alike; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as t

#: Trigram buckets of the model.
BUCKETS = 1 << 16
#: Training rows are drawn by hash so that about this many are read.
TRAIN_ROWS = 20_000
#: Price of a change of language between two words, in nats.
SWITCH = 12.0
SCRIPTS = 9
#: Texts that are long enough to be labelled on their own, per slice.
FEW = 8

# Lower-case letters as bytes; digits, punctuation and white space become a blank.
_LETTER = np.full(256, 0x20, np.uint8)
_LETTER[0x61:0x7B] = np.arange(0x61, 0x7B)
_LETTER[0x41:0x5B] = np.arange(0x61, 0x7B)
_LETTER[0x80:] = np.arange(0x80, 0x100)
_LETTER[[0xC2, 0xE2, 0xEF]] = 0x20
# Script by the first byte of a character: 0 none, 1 Latin, 2 Greek, 3 Cyrillic, 4 Hebrew and Arabic, 5 Indic and
# south-east Asian, 6 kana, 7 Han, 8 Hangul.
_SCRIPT = np.zeros(256, np.int8)
for _low, _high, _kind in ((0x41, 0x5A, 1), (0x61, 0x7A, 1), (0xC3, 0xCA, 1), (0xCD, 0xCF, 2), (0xD0, 0xD4, 3), (0xD5, 0xDD, 4),
                           (0xE0, 0xE1, 5), (0xE3, 0xE3, 6), (0xE4, 0xE9, 7), (0xEA, 0xED, 8)):
    _SCRIPT[_low:_high + 1] = _kind


@dataclass
class Model:
    langs: list[str]
    logp: np.ndarray      # float32 [bucket, language]
    candidate: np.ndarray  # bool [script, language]


def _features(buf: np.ndarray, offsets: np.ndarray) -> tuple[t.Words, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words, trigram bucket at each byte, bytes that start a trigram of a word, script of each word, letters of each word."""
    words = t.Words(buf, offsets)
    low = _LETTER[buf]
    upper = np.zeros(len(buf), bool)
    upper[1:] = (buf[:-1] == 0xC3) & (buf[1:] >= 0x80) & (buf[1:] <= 0x9E)
    low[upper] += 0x20
    pad = np.full(len(buf) + 2, 0x20, np.uint8)
    pad[1:-1] = low
    cuts = offsets[1:-1]
    wide = pad.astype(np.uint32)
    left, right = wide[:-2].copy(), wide[2:].copy()
    left[cuts[cuts < len(buf)]] = 0x20
    right[cuts[cuts > 0] - 1] = 0x20
    h = (left * np.uint32(0x9E3779B1) + wide[1:-1] * np.uint32(0x85EBCA77) + right * np.uint32(0xC2B2AE3D))
    bucket = ((h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(16)).astype(np.int64)
    live = low != 0x20
    letters = _SCRIPT[buf]
    place = np.concatenate([[0], np.cumsum(letters > 0)])
    n_letters = place[words.ends] - place[words.starts]
    script = t.doc_reduce(np.maximum, letters, np.append(words.starts, len(buf)), 0) if len(words.starts) else np.zeros(0, np.int8)
    return words, bucket, live, script.astype(np.int64), n_letters


def train(docs: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Trigram and script counts by lang, from about ``rows`` rows of docs(text, lang) with both set, drawn by hash.

    What comes to the driver is bounded by languages times buckets.
    """
    known = docs.select("text", "lang").where("text is not null and lang is not null")
    total = known.count()
    if total > rows:
        known = known.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < int((1 << 20) * rows / total))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for part in t.slices(batches, "text"):
            words, bucket, live, script, _ = _features(*t.text_buffer(part.column("text")))
            lang = np.array(part.column("lang").to_pylist(), object)
            byte_doc = np.repeat(np.arange(len(lang)), np.diff(words.offsets))
            for name in set(lang.tolist()):
                mine = lang == name
                have = sums.setdefault(name, np.zeros(BUCKETS + SCRIPTS, np.int64))
                have[:BUCKETS] += np.bincount(bucket[live & mine[byte_doc]], minlength=BUCKETS)
                have[BUCKETS:] += np.bincount(script[mine[words.doc]], minlength=SCRIPTS)
        for name, have in sums.items():
            at = np.flatnonzero(have)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at)), pa.array(at), pa.array(have[at])], ["lang", "slot", "n"])

    got = known.mapInArrow(run, "lang string, slot long, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(got.column("lang").to_pylist()))
    counts = np.zeros((BUCKETS + SCRIPTS, len(langs)))
    index = {name: k for k, name in enumerate(langs)}
    counts[got.column("slot").to_numpy(), [index[x] for x in got.column("lang").to_pylist()]] = got.column("n").to_numpy()
    grams, scripts = counts[:BUCKETS] + 0.5, counts[BUCKETS:]
    share = scripts[1:] / np.maximum(1, scripts[1:].sum(0))
    candidate = np.concatenate([np.ones((1, len(langs)), bool), share >= 0.01])
    candidate[~candidate.any(1)] = True
    return Model(langs, np.log(grams / grams.sum(0)).astype(np.float32), candidate)


def viterbi(scores: np.ndarray, counts: np.ndarray, switch: float) -> np.ndarray:
    """Best label of each row of scores [word, label]; rows of a text follow each other, counts has the rows by text.

    All texts step together: they are taken in order of length, so those still running are a prefix. The few longest
    go word by word instead.
    """
    n, k = scores.shape
    label = np.zeros(n, np.int64)
    if not n or not k:
        return label
    usual = np.sort(counts)[::-1][min(FEW, len(counts)) - 1]
    long = counts > usual if len(counts) > FEW else np.ones(len(counts), bool)
    ends = np.cumsum(counts)
    for i in np.flatnonzero(long).tolist():
        a, b = ends[i] - counts[i], ends[i]
        label[a:b] = _viterbi_one(scores[a:b].tolist(), switch)
    others = np.repeat(~long, counts)
    label[others] = _viterbi_many(scores[others], counts[~long], switch)
    return label


def _viterbi_one(scores: list[list[float]], switch: float) -> list[int]:
    """One text; the same choices as for many."""
    if not scores:
        return []
    state, back = list(scores[0]), []
    for row in scores[1:]:
        top = max(state)
        jump = top - switch
        back.append((state.index(top), [jump > s for s in state]))
        state = [(jump if jump > s else s) + x for s, x in zip(state, row)]
    now = state.index(max(state))
    out = [now]
    for best, jumped in reversed(back):
        if jumped[now]:
            now = best
        out.append(now)
    return out[::-1]


def _viterbi_many(scores: np.ndarray, counts: np.ndarray, switch: float) -> np.ndarray:
    n, k = scores.shape
    starts = np.concatenate([[0], np.cumsum(counts)])[:-1]
    order = np.argsort(-counts, kind="stable")
    starts, counts = starts[order], counts[order]
    running = np.searchsorted(-counts, -np.arange(counts[0] if len(counts) else 0), side="left")
    back = np.zeros((n, k), bool)  # the best way in comes from the best label of the word before
    best_before = np.zeros(n, np.int64)
    state = np.zeros((len(counts), k), np.float64)
    for step, live in enumerate(running.tolist()):
        at = starts[:live] + step
        if step:
            best = state[:live].argmax(1)
            jump = state[np.arange(live), best] - switch
            back[at] = jump[:, None] > state[:live]
            best_before[at] = best
            state[:live] = np.maximum(state[:live], jump[:, None])
        state[:live] += scores[at]
    label = np.zeros(n, np.int64)
    now = state.argmax(1) if k else np.zeros(len(counts), np.int64)
    for step in range(len(running) - 1, -1, -1):
        live = int(running[step])
        at = starts[:live] + step
        label[at] = now[:live]
        if step:
            now[:live] = np.where(back[at, now[:live]], best_before[at], now[:live])
    return label


def label_words(model: Model, buf: np.ndarray, offsets: np.ndarray, switch: float = SWITCH) -> tuple[t.Words, np.ndarray, np.ndarray]:
    """Words, label of each word, letters of each word."""
    words, bucket, live, script, letters = _features(buf, offsets)
    k = len(model.langs)
    scores = np.zeros((len(words.starts), k))
    for j in range(k):
        sums = np.concatenate([[0.0], np.cumsum(np.where(live, model.logp[bucket, j], 0.0), dtype=np.float64)])
        scores[:, j] = sums[words.ends] - sums[words.starts]
    scores[~model.candidate[script]] -= 1e4
    scores[letters == 0] = 0
    return words, viterbi(scores, words.counts, switch), letters


def predict(docs: DataFrame, model: Model, switch: float = SWITCH) -> DataFrame:
    """doc_id, lang_pred, score (share of letters in that language), n_spans (runs of words of one language)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in t.slices(batches, "text"):
            buf, offsets = t.text_buffer(part.column("text"))
            words, label, letters = label_words(model, buf, offsets, switch)
            n, k = len(offsets) - 1, max(1, len(model.langs))
            held = np.bincount(words.doc * k + label, weights=letters, minlength=n * k).reshape(n, k)
            best, total = held.argmax(1), held.sum(1)
            change = np.ones(len(label), bool)
            change[1:] = (label[1:] != label[:-1]) | (words.doc[1:] != words.doc[:-1])
            spans = np.bincount(words.doc[change], minlength=n)
            names, scores = [], []
            for i, text in enumerate(part.column("text").to_pylist()):
                if not model.langs or text is None or not any(map(str.isalpha, text)):
                    names.append("und")
                    scores.append(0.0)
                else:
                    names.append(model.langs[best[i]])
                    scores.append(float(held[i, best[i]] / total[i]) if total[i] else 0.0)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64()),
                                              pa.array(spans, pa.int64())], ["doc_id", "lang_pred", "score", "n_spans"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double, n_spans long")


def spans(docs: DataFrame, model: Model, switch: float = SWITCH) -> DataFrame:
    """doc_id, start, stop (UTF-8 byte range), lang of every run of words of one language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in t.slices(batches, "text"):
            buf, offsets = t.text_buffer(part.column("text"))
            words, label, _ = label_words(model, buf, offsets, switch)
            if not len(label) or not model.langs:
                continue
            first = np.flatnonzero(np.r_[True, (label[1:] != label[:-1]) | (words.doc[1:] != words.doc[:-1])])
            last = np.r_[first[1:], len(label)] - 1
            doc = words.doc[first]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(pa.array(doc)), pa.array(words.starts[first] - offsets[doc]),
                 pa.array(words.ends[last] - offsets[doc]), pa.array([model.langs[x] for x in label[first]], pa.string())],
                ["doc_id", "start", "stop", "lang"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, start long, stop long, lang string")
