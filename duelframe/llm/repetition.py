"""Quality rules: base counts of a text, and repetition measured with a suffix array over its words.

The longest-common-prefix intervals of the suffix array give the maximal repeated word sequences; the union of their
spans and the longest one decide. Works text by text without a shuffle.

Null, empty and blank texts have zero counts and fail the base rule; repeated rows are judged alike; other columns,
whatever their names, are not read by ``measure`` and pass through ``keep_good`` unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as t
from .suffixes import maximal_repeats, neighbour_lcp, suffix_ranks

#: Words of the shortest repeat that counts.
LEAST_REPEAT = 10
#: Highest share of words inside such repeats, in percent.
MAX_COVERED = 30
#: Words of the longest repeat that is accepted.
MAX_REPEAT = 100
#: The characters that count as symbols.
SYMBOLS = b"#*$%&|<>"

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "n_covered_words long, longest_repeat long, n_repeats long")
_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))


def _covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    depth = np.bincount(starts, minlength=n + 1) - np.bincount(starts + lengths, minlength=n + 1)
    return np.cumsum(depth[:n]) > 0


def measure_texts(buf: np.ndarray, offsets: np.ndarray, least: int) -> dict[str, np.ndarray]:
    words = t.Words(buf, offsets)
    n, bounds = len(words.starts), words.bounds
    chars = np.concatenate([[0], np.cumsum(t.STARTS_CHAR[buf])])
    ids = t.RangeHash(buf)(words.starts, words.ends).view(np.int64)
    levels = suffix_ranks(ids, bounds)
    sa, lcp = neighbour_lcp(levels, bounds)
    longest = np.zeros(n, np.int64)
    longest[sa] = np.maximum(lcp, np.append(lcp[1:], 0)) if n else lcp
    twice = np.flatnonzero(longest >= 3)
    repeat = np.flatnonzero(longest >= least)
    raw = buf.tobytes()
    dup_lines = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        lines = [line for line in raw[a:b].split(b"\n") if line.strip()]
        dup_lines.append(len(lines) - len(set(lines)))
    rows = np.array([words.doc[sa[first]] for first, _, _ in maximal_repeats(sa, lcp, ids, bounds, least)], np.int64)
    return {
        "n_words": words.counts,
        "word_chars": t.doc_reduce(np.add, chars[words.ends] - chars[words.starts], bounds, 0),
        "n_symbols": t.doc_reduce(np.add, _SYMBOL[buf].astype(np.int64), offsets, 0),
        "n_dup_lines": np.array(dup_lines, np.int64),
        "n_repeat_words": t.doc_reduce(np.add, _covered(twice, np.full(len(twice), 3), n).astype(np.int64), bounds, 0),
        "n_covered_words": t.doc_reduce(np.add, _covered(repeat, longest[repeat], n).astype(np.int64), bounds, 0),
        "longest_repeat": t.doc_reduce(np.maximum, longest, bounds, 0),
        "n_repeats": np.bincount(rows, minlength=len(offsets) - 1),
    }


def measure(docs: DataFrame, least: int = LEAST_REPEAT) -> DataFrame:
    """Counts of every text, see SCHEMA; n_covered_words are the words inside maximal repeats of ``least`` words or more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in t.slices(batches, "text"):
            got = measure_texts(*t.text_buffer(part.column("text")), least)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(x, pa.int64()) for x in got.values())], ["doc_id", *got])

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def judge(measured: DataFrame, max_covered: int = MAX_COVERED, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """Adds base_failed and kept."""
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    good = (F.col("n_covered_words") * 100 <= F.col("n_words") * max_covered) & (F.col("longest_repeat") <= max_repeat)
    return measured.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & good)


def keep_good(docs: DataFrame, least: int = LEAST_REPEAT, max_covered: int = MAX_COVERED, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """The rows of docs whose text passes, with all their columns."""
    schema = docs.schema
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in t.slices(iter([batch]), batch.schema.names[at]):
                got = measure_texts(*t.text_buffer(part.column(at)), least)
                n = got["n_words"]
                keep = ((n >= 50) & (100 * got["n_repeat_words"] <= 50 * n) & (100 * got["n_covered_words"] <= max_covered * n)
                        & (got["longest_repeat"] <= max_repeat))
                yield part.filter(pa.array(keep))

    return docs.mapInArrow(run, schema)
