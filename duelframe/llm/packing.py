"""Order-preserving packing of token sequences into windows, by dynamic programming over possible cuts.

Documents are laid out in the order of their partition. Windows may end after a document (free), after a sentence, or,
inside long sentences only, every GRID tokens; cuts inside a document cost penalties in tokens. The cheapest set of cuts
minimises padding plus penalties. Since a window's padding is the capacity less its tokens, the best predecessor of a cut
is the cheapest cut at most one capacity before it, which a monotone queue of candidates gives in constant time.

A task works through its partition in stretches of STRETCH tokens and carries the last windows of each over to the next,
so memory is bounded by a stretch and one document; nothing is shuffled.

Added tokens of a tokenizer file are matched inside texts, as ``tokenizers`` does by default; without that file every
character is plain text.

Null and empty texts are one token (the end token). Repeated rows are packed each. Rows with a null doc_id are packed
under a null id. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from array import array
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame

CAPACITY = 2048
END_TOKEN = 1
SENTENCE_CUT, MID_CUT = 48, 160
GRID = 64
STRETCH = 1 << 17
CARRY = 8
#: Words whose tokens a Python worker remembers.
REMEMBERED = 700_000

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

# In texts of these characters all white space is a blank, a tab or a line end.
_PLAIN = re.compile("[\t\n\r\x20-\x7e¡-ɏ]*")
_CUT = 48, 160
GRID = 64
STRETCH = 1 << 17
CARRY = 8
#: Words whose tokens a Python worker remembers.
REMEMBERED = 700_000

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

# In texts of these characters all white space is a blank, a tab or a line end.
_PLAIN = re.compile("[\t\n\r\x20-\x7e¡-ɏ]*")
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_PIECE = re.compile(rf"'(?:[sdmt]|ll|ve|re)| ?[{_LETTERS}]+| ?[0-9]+| ?[^\s{_LETTERS}0-9]+|\s+(?!\S)|\s+")
_CUT = re.compile(r"\S(?= [A-Za-z])")
# Without these, every blank starts a piece of its own, so a text can be split at its blanks.
_BLANKS = re.compile(r" [ \t\n\r]")


class Tokenizer:
    """Byte-pair ids (little-endian uint32) of whole texts, word by word from memory where the text allows it.

    Texts are first cut at ``added`` tokens, the longest one of a place; what lies between is tokenized by itself.
    """

    def __init__(self, ranks_path: str, added: dict[str, int] | None = None):
        self.added = {a: np.array([number], np.uint32) for a, number in (added or {}).items()}
        self.split = re.compile(f"({'|'.join(map(re.escape, sorted(self.added, key=len, reverse=True)))})")
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.plain = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.ends = np.zeros(max(ranks.values()) + 1, bool)
        for token, number in ranks.items():
            self.ends[number] = token.endswith((b".", b"!", b"?", b"\n"))
        self.memory = _Memory(self.plain)

    def __call__(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint32)
        if any(a in text for a in self.added):
            parts = self.split.split(text)  # plain texts and added tokens in turn
            return np.concatenate([self.added[x] if i % 2 else self._ids(x) for i, x in enumerate(parts)])
        return self._ids(text)

    def _ids(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint32)
        if not _PLAIN.fullmatch(text):
            return np.asarray(self.plain.encode_ordinary(text), np.uint32)
        out, start = [], 0
        while len(text) - start > 1 << 20:  # a word that follows a blank starts a new piece
            cut = None
            for cut in _CUT.finditer(text, start + (1 << 19), start + (1 << 20)):
                break
            if cut is None:
                break
            out.append(self._pieces(text[start:cut.end()]))
            start = cut.end()
        out.append(self._pieces(text[start:] if start else text))
        return np.frombuffer(b"".join(out), np.uint32)

    def _pieces(self, text: str) -> bytes:
        if len(self.memory) > REMEMBERED:
            self.memory.clear()
        if _BLANKS.search(text):
            return array("I", self.plain.encode_ordinary(text)).tobytes()
        first, *rest = text.split(" ")
        return array("I", self.plain.encode_ordinary(first)).tobytes() + b"".join(map(self.memory.__getitem__, rest))


def added_tokens(tokenizer_path: str) -> dict[str, int]:
    """Added tokens of a tokenizer file and their ids; none of them may take more of a text than its own characters."""
    with open(tokenizer_path, encoding="utf-8") as file:
        tokens = json.load(file)["added_tokens"]
    odd = [t["content"] for t in tokens if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]]
    if odd:
        raise ValueError(f"added tokens with matching rules of their own: {odd}")
    return {t["content"]: t["id"] for t in tokens}


class _Memory(dict):
    """Ids of a blank and the characters up to the next one."""

    def __init__(self, encoding: tiktoken.Encoding):
        super().__init__()
        self.encode = encoding.encode_ordinary

    def __missing__(self, piece: str) -> bytes:
        out = self[piece] = array("I", self.encode(" " + piece)).tobytes()
        return out


def possible_cuts(ids: np.ndarray, doc_ends: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of a stretch where a window may end, and the penalty of each; the last place is the end."""
    penalty = np.full(len(ids) + 1, -1, np.int64)
    known = ids < len(ends)
    penalty[1:][known & ends[np.where(known, ids, 0)]] = SENTENCE_CUT
    penalty[doc_ends] = 0
    penalty[len(ids)] = 0
    at = np.flatnonzero(penalty >= 0)
    gaps = np.diff(np.r_[0, at])
    for place, gap in zip(at[gaps > 2 * GRID].tolist(), gaps[gaps > 2 * GRID].tolist()):
        penalty[np.arange(place - gap + GRID, place - GRID + 1, GRID)] = MID_CUT
    at = np.flatnonzero(penalty[1:] >= 0) + 1
    return at, penalty[at]


def best_cuts(places: list[int], penalties: list[int], capacity: int) -> list[int]:
    """Window ends with the least padding plus penalties; windows are capacity tokens at most."""
    cost, back = [0], [0]
    where = [0, *places]
    queue: deque[int] = deque([0])
    for j, (place, penalty) in enumerate(zip(places, penalties), 1):
        floor = place - capacity
        while where[queue[0]] < floor:
            queue.popleft()
        best = queue[0]
        mine = cost[best] + capacity + penalty
        cost.append(mine)
        back.append(best)
        while queue and cost[queue[-1]] >= mine:
            queue.pop()
        queue.append(j)
    out, j = [], len(places)
    while j:
        out.append(where[j])
        j = back[j]
    return out[::-1]


class Packer:
    """Packs the documents given to ``add`` in order; ``rows`` has the pieces of finished windows."""

    def __init__(self, ends: np.ndarray, capacity: int, first_sequence: int):
        self.ends, self.capacity, self.sequence = ends, capacity, first_sequence
        self.parts: list[tuple[int | None, np.ndarray, int, int]] = []  # document, its tokens from start on, start, all
        self.size = 0
        self.rows: list[tuple] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.parts.append((doc_id, ids, 0, len(ids)))
        self.size += len(ids)
        while self.size > STRETCH:
            before = self.size
            self.flush(last=False)
            if self.size == before:
                break

    def flush(self, last: bool) -> None:
        if not self.parts:
            return
        ids = np.concatenate([p[1] for p in self.parts])
        sizes = np.array([len(p[1]) for p in self.parts])
        doc_ends = np.cumsum(sizes)
        places, penalties = possible_cuts(ids, doc_ends, self.ends)
        cuts = best_cuts(places.tolist(), penalties.tolist(), self.capacity)
        if not last:
            cuts = cuts[:-CARRY]
        if not cuts:
            return
        stop = cuts[-1]
        edges = np.unique(np.concatenate([[0], cuts, doc_ends[doc_ends < stop]]))
        doc = np.searchsorted(doc_ends, edges[:-1], side="right")
        window = np.searchsorted(cuts, edges[:-1], side="right")
        heads = np.r_[0, cuts[:-1]]
        for a, b, d, w in zip(edges[:-1].tolist(), edges[1:].tolist(), doc.tolist(), window.tolist()):
            doc_id, _, start, total = self.parts[d]
            self.rows.append((doc_id, start + a - int(doc_ends[d] - sizes[d]), b - a, zlib.crc32(ids[a:b].tobytes()), total,
                              self.sequence + w, a - int(heads[w])))
        self.sequence += len(cuts)
        d = int(np.searchsorted(doc_ends, stop, side="right"))
        rest = self.parts[d:]
        if rest:
            doc_id, own, start, total = rest[0]
            skip = stop - int(doc_ends[d] - sizes[d])
            rest[0] = (doc_id, own[skip:], start + skip, total)
        self.parts, self.size = rest, int(len(ids) - stop)


def pack(docs: DataFrame, capacity: int = CAPACITY, ranks_path: str | None = None, tokenizer_path: str | None = None) -> DataFrame:
    """The pieces of all documents, see SCHEMA. Sequence ids are unique: the partition's number and a count.

    ``tokenizer_path``: the file with the added tokens to match in texts.
    """
    path = ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    added = added_tokens(tokenizer_path) if tokenizer_path else {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer(path, added)
        packer = Packer(tokenizer.ends, capacity, TaskContext.get().partitionId() << 32)
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                packer.add(doc_id, np.append(tokenizer(text.as_py()), np.uint32(END_TOKEN)))
                if len(packer.rows) > 4096:
                    yield _rows(packer)
        packer.flush(last=True)
        yield _rows(packer)

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def pack_added(docs: DataFrame) -> DataFrame:
    """The pieces of all documents with the ids of ``tokenizers``, which matches added tokens inside texts."""
    return pack(docs, tokenizer_path=public_tokenizers.path("byte_bpe_50k.json"))


def _rows(packer: Packer) -> pa.RecordBatch:
    columns = list(zip(*packer.rows)) or [[]] * 7
    packer.rows = []
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                      ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
