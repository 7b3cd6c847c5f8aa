"""Exact removal of long byte strings that also start in a document with a smaller identifier.

Every window of SIZE bytes is keyed by the least hash of the GRAM-byte strings inside it. Neighbouring windows with one
key form a stretch, so equal windows always meet under their key while each stretch travels once, and only if its key
occurs in several documents. Under the keys of a bucket the stretches are indexed with a run-compressed
Burrows-Wheeler transform (:mod:`run_index`), whose streamed matches tell the smallest document of each window.

Steps, all keyed by blocks of documents so that a passage that fills a third of all rows is sent once per block:
keys per block -> keys seen twice -> stretches of these keys -> smallest document per window -> removal per document.
The documents of a block travel packed, whole and with what is carried, and are unpacked where the block is worked on;
stretches and removal are one plan, in which they travel once and are read twice. A block sends a bucket one row, and a
bucket answers a block in one row.
Keys seen in HOT blocks or HOT_DOCS documents are dealt out window by window instead, so that no bucket gathers them. Of documents
with equal texts only the first sends stretches; the others lose everything.

Null and empty texts have zero bytes and lose nothing. Rows with a null doc_id lose nothing and remove nothing; rows
that share a doc_id do not remove each other's text. Other columns are not read here.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textops as t
from .run_index import RunIndex
from .storage import Stored

SIZE, GRAM = 50, 18
#: Documents of consecutive identifiers that travel together; below 2^16.
BLOCK_DOCS = 2048
#: Blocks that share a key from which its windows are dealt out one by one; so are keys that HOT_DOCS documents have.
HOT = 256
HOT_DOCS = 1 << 17
#: Windows of a stretch at most; longer runs of one key (periodic texts) are cut.
LONGEST = 64
#: Parts of a bucket that are indexed one after another.
CELLS = 16
#: Bytes of documents that a task gathers before it packs them by blocks.
PACKED = 32 << 20
#: Keys that a task gathers before it sends them.
GATHERED = 2_000_000
NONE = np.iinfo(np.int64).max

SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string"


class Stretches:
    """Runs of windows with one key: start, number of windows, key and text number."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray):
        self.buf, self.offsets = buf, offsets
        self.hash = t.RangeHash(buf)
        n = len(buf) - SIZE + 1
        if n <= 0:
            self.start = self.count = self.doc = np.zeros(0, np.int64)
            self.key = np.zeros(0, t.U64)
            return
        at = np.arange(len(buf) - GRAM + 1)
        low = self.hash(at, at + GRAM)
        span, wide = 1, SIZE - GRAM + 1
        while span * 2 <= wide:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if span < wide:
            low = np.minimum(low[:span - wide], low[wide - span:])
        ends = np.repeat(offsets[1:], np.diff(offsets))[:n]
        valid = np.arange(n) + SIZE <= ends
        head = valid.copy()
        head[1:] &= (low[1:] != low[:-1]) | ~valid[:-1]
        starts = offsets[:-1][offsets[:-1] < n]
        head[starts] = valid[starts]
        self.start = np.flatnonzero(head)
        total = np.concatenate([[0], np.cumsum(valid)])
        count = np.diff(np.append(total[self.start], total[-1]))
        pieces = -(-count // LONGEST)
        nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        self.start = np.repeat(self.start, pieces) + nth * LONGEST
        self.count = np.minimum(np.repeat(count, pieces) - nth * LONGEST, LONGEST)
        self.key = t.mix(low[self.start] ^ t.U64(0x5851F42D4C957F2D))
        self.doc = np.searchsorted(offsets, self.start, side="right") - 1

    def content(self, which: np.ndarray) -> np.ndarray:
        return self.hash(self.start[which], self.start[which] + self.count[which] + SIZE - 1)

    def windows(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start of every window of these stretches, and the text number of each."""
        count = self.count[which]
        inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return np.repeat(self.start[which], count) + inner, np.repeat(self.doc[which], count)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts, sizes)


def _pieces(buf: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return buf[_ranges(starts, sizes)]


def _packed(values: np.ndarray, level: int = 1) -> bytes:
    return zstandard.compress(np.ascontiguousarray(values).tobytes(), level)


def _unpacked(blob: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(blob), kind)


def _packed_keys(keys: np.ndarray) -> bytes:
    """Differences of neighbours (modulo 2^32), byte by byte: the upper bytes of ascending keys are mostly zero."""
    steps = np.diff(keys, prepend=np.uint32(0))
    return _packed(steps.view(np.uint8).reshape(-1, 4).T)


def _unpacked_keys(blob: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(_unpacked(blob, np.uint8).reshape(4, -1).T).view(np.uint32).ravel(), dtype=np.uint32)


def _joined(column: pa.ChunkedArray | pa.Array, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of docs as they are, compressed together for each block: a row per block and PACKED bytes."""
    def flush(found: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(found).sort_by("block").combine_chunks()
        block = table.column("block").to_numpy()
        cuts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]]).tolist()
        for at in range(0, len(cuts), 64):
            blobs = []
            for a, b in zip(cuts[at:at + 64], [*cuts[1:], len(block)][at:at + 64]):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, table.schema) as out:
                    out.write_table(table.slice(a, b - a))
                blobs.append(zstandard.compress(sink.getvalue(), 5))
            yield pa.RecordBatch.from_arrays([pa.array(block[cuts[at:at + 64]]), pa.array(blobs, pa.binary())], ["block", "docs"])

    gathered, size = [], 0
    for batch in batches:
        if batch.num_rows:
            gathered.append(batch)
            size += batch.nbytes
        if size > PACKED:
            yield from flush(gathered)
            gathered, size = [], 0
    if gathered:
        yield from flush(gathered)


def _unpack(table: pa.Table) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(zstandard.decompress(x)).read_all() for x in table.column("docs").to_pylist()])


def _block_keys(parts: int):
    """Distinct keys of the documents of each block, a row per bucket; holders: how many of its documents have each.

    Keys are gathered over GATHERED of them, so the number of rows does not depend on the order of the documents.
    """
    def flush(found: list[tuple]) -> pa.RecordBatch:
        key, ids = map(np.concatenate, zip(*found))
        block, bucket = ids // BLOCK_DOCS, (key % t.U64(parts)).astype(np.int64)
        order = np.lexsort((ids, key, block, bucket))
        key, ids, block, bucket = key[order], ids[order], block[order], bucket[order]
        head = np.r_[True, (key[1:] != key[:-1]) | (block[1:] != block[:-1])]
        fresh = np.flatnonzero(head)
        holders = np.add.reduceat(head | np.r_[True, ids[1:] != ids[:-1]], fresh, dtype=np.int64).astype(np.uint16)
        short, block, bucket = (key[fresh] >> t.U64(32)).astype(np.uint32), block[fresh], bucket[fresh]
        cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        spans = list(zip(cuts.tolist(), np.r_[cuts[1:], len(short)].tolist()))
        return pa.RecordBatch.from_arrays(
            [pa.array(bucket[cuts].astype(np.int32)),
             *(pa.array([pack(x[a:b]) for a, b in spans], pa.binary()) for pack, x in ((_packed_keys, short), (_packed, holders), (_packed, block)))],
            ["bucket", "keys", "holders", "blocks"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, size = [], 0
        for part in t.slices(batches, "text"):
            found = Stretches(*t.text_buffer(part.column("text")))
            gathered.append((found.key, part.column("doc_id").to_numpy()[found.doc]))
            size += len(found.key)
            if size > GATHERED:
                yield flush(gathered)
                gathered, size = [], 0
        if size:
            yield flush(gathered)

    return run


def _shared_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys that several documents have, sent back to each of their blocks; hot: those of many blocks."""
    rows = [b for b in batches if b.num_rows]
    if not rows:
        return
    table = pa.Table.from_batches(rows)
    short = np.concatenate([_unpacked_keys(x) for x in table.column("keys").to_pylist()])
    holders = np.concatenate([_unpacked(x, np.uint16) for x in table.column("holders").to_pylist()])
    blocks = [_unpacked(x, np.int64) for x in table.column("blocks").to_pylist()]
    bucket = np.repeat(table.column("bucket").to_numpy(), [len(x) for x in blocks])
    block = np.concatenate(blocks)
    order = np.lexsort((block, short, bucket))
    bucket, short, block, holders = bucket[order], short[order], block[order], holders[order]
    first = np.flatnonzero(np.r_[True, (short[1:] != short[:-1]) | (bucket[1:] != bucket[:-1])])
    n = np.diff(np.r_[first, len(short)])
    total = np.add.reduceat(holders, first, dtype=np.int64)
    known, hot = np.repeat((n > 1) | (total > 1), n), np.repeat((n >= HOT) | (total >= HOT_DOCS), n)
    at = np.flatnonzero(known)
    at = at[np.lexsort((block[at], bucket[at]))]
    if not len(at):
        return
    cuts = np.flatnonzero(np.r_[True, (block[at][1:] != block[at][:-1]) | (bucket[at][1:] != bucket[at][:-1])])
    spans = list(zip(cuts.tolist(), np.r_[cuts[1:], len(at)].tolist()))
    yield pa.RecordBatch.from_arrays(
        [pa.array(block[at[cuts]]), pa.array(bucket[at[cuts]].astype(np.int32)),
         pa.array([_packed_keys(short[at[a:b]]) for a, b in spans], pa.binary()),
         pa.array([_packed_keys(short[x][hot[x]]) if hot[x].any() else b"" for x in (at[a:b] for a, b in spans)], pa.binary())],
        ["block", "bucket", "keys", "hot"])


def _full_keys(table: pa.Table, column: str) -> np.ndarray:
    """bucket << 32 | upper half of the key, sorted."""
    table = table.filter(pc.greater_equal(table.column("bucket"), 0))
    none = np.zeros(0, np.uint32)
    short = [_unpacked_keys(x) if x else none for x in table.column(column).to_pylist()]
    bucket = np.repeat(table.column("bucket").to_numpy(), [len(x) for x in short])
    return np.sort((bucket.astype(np.uint64) << t.U64(32)) | np.concatenate([none, *short]))


def _member(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), bool)
    at = np.searchsorted(known, values)
    at[at == len(known)] = 0
    return known[at] == values


def _in_order(table: pa.Table) -> pa.Table:
    return table.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def _copies(table: pa.Table) -> dict[int, set[bytes]]:
    """Documents of the block whose text an earlier document has (bucket -1), with the digests of such texts."""
    table = table.filter(pc.equal(table.column("bucket"), -1))
    out: dict[int, set[bytes]] = {}
    for doc, digest in zip(table.column("copy").to_pylist(), table.column("digest").to_pylist()):
        out.setdefault(doc, set()).add(digest)
    return out


def _is_copy(docs: pa.Table | pa.RecordBatch, copies: dict[int, set[bytes]]) -> np.ndarray:
    """Rows whose own text is a copy; rows that share a doc_id are told apart by their texts."""
    ids, text = docs.column("doc_id").to_numpy(), docs.column("text")
    out = np.isin(ids, np.array(list(copies), np.int64))
    for i in np.flatnonzero(out).tolist():
        out[i] = text[i].is_valid and hashlib.sha256(text[i].as_buffer()).digest() in copies[int(ids[i])]
    return out


def _send_stretches(parts: int):
    """Distinct stretches with shared keys of a block, by bucket and cell, with their smallest document in the block.

    more: several documents of the block have it.
    """
    def run(docs: pa.Table, keys: pa.Table) -> pa.Table:
        shared, hot = _full_keys(keys, "keys"), _full_keys(keys, "hot")
        docs = docs.select(["doc_id", "text", "block"])
        block = int(docs.column("block")[0].as_py())
        docs = docs.filter(pa.array(~_is_copy(docs, _copies(keys))))
        found_ = []
        for part in t.slices(iter(docs.combine_chunks().to_batches()), "text"):
            found = Stretches(*t.text_buffer(part.column("text")))
            ids = part.column("doc_id").to_numpy()
            full = ((found.key % t.U64(parts)) << t.U64(32)) | (found.key >> t.U64(32))
            mine = _member(full, shared)
            warm = _member(full, hot) & mine
            cool = np.flatnonzero(mine & ~warm)
            start, doc = found.windows(np.flatnonzero(warm))
            for first, size, text, value, key in (
                    (found.start[cool], found.count[cool] + SIZE - 1, found.doc[cool], found.content(cool), found.key[cool]),
                    (start, np.full(len(start), SIZE), doc, (h := found.hash(start, start + SIZE)), h)):
                order = np.argsort(value, kind="stable")  # texts are in order of doc_id
                head = np.flatnonzero(np.r_[True, value[order][1:] != value[order][:-1]][:len(order)])
                if len(head):
                    owner = ids[text[order]]
                    pick = order[head]
                    found_.append((value[pick], np.minimum.reduceat(owner, head), np.maximum.reduceat(owner, head),
                                   (key[pick] % t.U64(parts)).astype(np.int64) * CELLS + (t.mix(key[pick]) % t.U64(CELLS)).astype(np.int64),
                                   size[pick], _pieces(found.buf, first[pick], size[pick])))
        columns = ["bucket", "block", "data", "sizes", "owners", "more", "cells"]
        if not found_:
            return pa.table([pa.array([], k) for k in (pa.int32(), pa.int64(), *[pa.binary()] * 5)], names=columns)
        content, low, high, cell, sizes, data = map(np.concatenate, zip(*found_))
        place = np.cumsum(sizes) - sizes
        order = np.lexsort((content, cell))
        head = np.flatnonzero(np.r_[True, content[order][1:] != content[order][:-1]])
        low, high = np.minimum.reduceat(low[order], head), np.maximum.reduceat(high[order], head)
        pick = order[head]
        cell, sizes, place = cell[pick], sizes[pick], place[pick]
        bucket = cell // CELLS
        cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        spans = list(zip(cuts.tolist(), np.r_[cuts[1:], len(bucket)].tolist()))
        return pa.table([
            pa.array(bucket[cuts].astype(np.int32)), pa.array([block] * len(cuts), pa.int64()),
            pa.array([_packed(_pieces(data, place[a:b], sizes[a:b]), 3) for a, b in spans], pa.binary()),
            pa.array([_packed(sizes[a:b].astype(np.uint16)) for a, b in spans], pa.binary()),
            pa.array([_packed((low[a:b] - block * BLOCK_DOCS).astype(np.uint16)) for a, b in spans], pa.binary()),
            pa.array([_packed(low[a:b] != high[a:b]) for a, b in spans], pa.binary()),
            pa.array([np.bincount(cell[a:b] % CELLS, minlength=CELLS).astype(np.uint32).tobytes() for a, b in spans], pa.binary())],
            names=columns)

    return run


def smallest_owners(data: np.ndarray, bounds: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest owner of every window of distinct strings, one string after another, and the bounds of its windows.

    Strings that share no window with another one are left out of the index: nothing else can own their windows.
    """
    counts = np.diff(bounds) - SIZE + 1
    heads = np.concatenate([[0], np.cumsum(counts)])
    owner = np.repeat(np.arange(len(counts)), counts)
    start = np.arange(heads[-1]) - np.repeat(heads[:-1], counts) + np.repeat(bounds[:-1], counts)
    value = t.RangeHash(data)(start, start + SIZE)
    order = np.argsort(value)
    same = value[order][1:] == value[order][:-1]
    other = same & (owner[order][1:] != owner[order][:-1])
    linked = np.zeros(len(counts), bool)
    linked[owner[order][1:][other]] = True
    linked[owner[order][:-1][other]] = True
    least = np.repeat(owners, counts)
    texts = np.flatnonzero(linked)
    if len(texts):
        texts = texts[np.argsort(owners[texts], kind="stable")]
        sizes = np.diff(bounds)[texts]
        piece = _pieces(data, bounds[:-1][texts], sizes)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        got = RunIndex(piece, ends, owners[texts], SIZE).owners(piece, ends, NONE)
        n = counts[texts]
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        least[np.repeat(heads[:-1][texts], n) + inner] = got[np.repeat(ends[:-1], n) + inner]
    return least, heads


def _match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Smallest document of every window of a partition's stretches, sent back to each block that can use it."""
    rows = []
    for batch in batches:
        for block, data, sizes, owners, more, cells in zip(*(batch.column(c).to_pylist() for c in ("block", "data", "sizes", "owners", "more", "cells"))):
            sizes = _unpacked(sizes, np.uint16).astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(np.frombuffer(cells, np.uint32))]).astype(np.int64)
            rows.append((block, data, np.concatenate([[0], np.cumsum(sizes)]), sizes, _unpacked(owners, np.uint16) + np.int64(block * BLOCK_DOCS),
                         _unpacked(more, bool), ends))
    found: list[tuple] = []
    for group in range(0, CELLS, 4):  # each row is unpacked once for four cells
        parts: list[list] = [[] for _ in range(4)]
        for block, packed, at, sizes, owners, more, ends in rows:
            data = _unpacked(packed, np.uint8)
            for k in range(4):
                a, b = ends[group + k], ends[group + k + 1]
                if b > a:
                    parts[k].append((data[at[a]:at[b]].copy(), sizes[a:b], owners[a:b], more[a:b], np.full(b - a, block)))
        for part in parts:
            if part:
                found.append(_answers(*map(np.concatenate, zip(*part))))
    if not sum(len(x[0]) for x in found):
        return
    block, value, runs, length, least = map(np.concatenate, zip(*found))
    head = np.cumsum(runs) - runs
    order = np.argsort(block, kind="stable")
    block, value = block[order], value[order]
    at, ends = _ranges(head[order], runs[order]), np.concatenate([[0], np.cumsum(runs[order])])
    runs, length, least = runs[order], length[at], least[at]
    cuts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
    spans = list(zip(cuts.tolist(), np.r_[cuts[1:], len(block)].tolist()))
    for first in range(0, len(spans), 1024):
        some = spans[first:first + 1024]
        blobs = zip(*((value[a:b].tobytes(), _packed(runs[a:b].astype(np.uint32)), *(_packed(x[ends[a]:ends[b]].astype(np.uint16)) for x in (length, least)))
                      for a, b in some))
        yield pa.RecordBatch.from_arrays([pa.array(block[[a for a, _ in some]], pa.int64()), pa.array([0] * len(some), pa.int32()), *(pa.array(b, pa.binary()) for b in blobs)],
                                         ["block", "bucket", "content", "runs", "lengths", "least"])


def _answers(data: np.ndarray, sizes: np.ndarray, owner: np.ndarray, more: np.ndarray, block: np.ndarray) -> tuple:
    """For the blocks that can use it: block, content of a stretch, its number of runs, and windows and smallest document of each run.

    Documents count from 1 in the block asked; those before it are 0, those behind it BLOCK_DOCS + 1.
    """
    ends = np.concatenate([[0], np.cumsum(sizes)])
    value = t.RangeHash(data)(ends[:-1], ends[1:])
    order = np.argsort(value)
    fresh = np.flatnonzero(np.r_[True, value[order][1:] != value[order][:-1]])
    pick = order[fresh]
    number = np.empty(len(value), np.int64)
    number[order] = np.repeat(np.arange(len(fresh)), np.diff(np.r_[fresh, len(order)]))
    low = np.minimum.reduceat(owner[order], fresh)
    bounds = np.concatenate([[0], np.cumsum(sizes[pick])])
    least, heads = smallest_owners(_pieces(data, ends[:-1][pick], sizes[pick]), bounds, low)
    # Runs of windows with one smallest document.
    first = np.zeros(len(least), bool)
    first[heads[:-1]] = True
    first[1:] |= least[1:] != least[:-1]
    run = np.flatnonzero(first)
    length = np.diff(np.r_[run, len(least)])
    run_head = np.searchsorted(run, heads)
    best = np.minimum.reduceat(least, heads[:-1])
    use = np.flatnonzero(more | (best[number] < owner))
    mine, start = number[use], block[use] * BLOCK_DOCS
    n = run_head[mine + 1] - run_head[mine]
    at, start = _ranges(run_head[mine], n), np.repeat(start, n)
    own, last = least[run[at]], start + (BLOCK_DOCS - 1)
    near = np.where(own < start, 0, np.where(own > last, BLOCK_DOCS + 1, own - start + 1))
    if not len(use):
        return block[use], value[use], n, near, near
    # To a block, owners outside of it are alike.
    first = np.zeros(len(near), bool)
    first[np.cumsum(n) - n] = True
    first[1:] |= near[1:] != near[:-1]
    kept = np.flatnonzero(first)
    return block[use], value[use], np.add.reduceat(first, np.cumsum(n) - n, dtype=np.int64), np.add.reduceat(length[at], kept), near[kept]


def _remove(parts: int, carried: list[str]):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        hot = _full_keys(answers, "hot")
        copies = _copies(answers)
        known = answers.filter(pc.is_valid(answers.column("content")))
        content = _joined(known.column("content"), np.uint64)
        runs, lengths, least = (np.concatenate([np.zeros(0, kind), *(_unpacked(x, kind) for x in known.column(c).to_pylist())])
                                for c, kind in (("runs", np.uint32), ("lengths", np.uint16), ("least", np.uint16)))
        runs, lengths = runs.astype(np.int64), lengths.astype(np.int64)
        order = np.argsort(content)
        content, head = content[order], (np.cumsum(runs) - runs)[order]
        runs = runs[order]
        out = []
        for part in t.slices(iter(docs.combine_chunks().to_batches()), "text"):
            buf, offsets = t.text_buffer(part.column("text"))
            ids = part.column("doc_id").fill_null(-1).to_numpy()
            live = np.asarray(part.column("doc_id").is_valid())
            found = Stretches(buf, offsets)
            gone = np.zeros(len(buf) + 1, np.int64)
            if len(content):
                full = ((found.key % t.U64(parts)) << t.U64(32)) | (found.key >> t.U64(32))
                warm = _member(full, hot)
                start, doc = found.windows(np.flatnonzero(warm))
                cool = np.flatnonzero(~warm)
                for first, text, value in ((found.start[cool], found.doc[cool], found.content(cool)),
                                           (start, doc, found.hash(start, start + SIZE))):
                    at = np.searchsorted(content, value)
                    at[at == len(content)] = 0
                    hit = np.flatnonzero((content[at] == value) & live[text])
                    n = runs[at[hit]]
                    place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(head[at[hit]], n)
                    size = lengths[place]
                    before = np.cumsum(size) - size
                    begin = before + np.repeat(first[hit] - before[np.cumsum(n) - n], n)
                    cut = least[place] < np.repeat(ids[text[hit]] % BLOCK_DOCS + 1, n)
                    np.add.at(gone, begin[cut], 1)
                    np.add.at(gone, begin[cut] + size[cut] + SIZE - 1, -1)
            copy = np.flatnonzero(_is_copy(part, copies) & (np.diff(offsets) >= SIZE))
            np.add.at(gone, offsets[copy], 1)
            np.add.at(gone, offsets[copy + 1], -1)
            lost = np.cumsum(gone[:-1]) > 0
            edge = lost.copy()
            edge[1:] &= ~lost[:-1]
            starts = offsets[:-1][offsets[:-1] < len(buf)]
            edge[starts] = lost[starts]
            removed = t.doc_reduce(np.add, lost.astype(np.int64), offsets, 0)
            spans = t.doc_reduce(np.add, edge.astype(np.int64), offsets, 0)
            kept = buf[~lost].tobytes()
            ends = np.cumsum(np.diff(offsets) - removed)
            texts = [kept[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]
            out.append(pa.table([part.column("doc_id"), pa.array(np.diff(offsets)), pa.array(removed), pa.array(spans),
                                 pa.array([hashlib.sha256(x).hexdigest() for x in texts]),
                                 pa.array([x.decode(errors="ignore") for x in texts], pa.string()), *(part.column(c) for c in carried)],
                                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text", *carried]))
        return pa.concat_tables(out)

    return run


def remove_repeats(spark: SparkSession, docs: DataFrame, carry: bool = False) -> DataFrame:
    """One row per document, see SCHEMA (with carry also all other columns, prefixed by ``carried_``): bytes, removed bytes and runs, and what stays.

    kept_sha256 is over the exact bytes; kept_text leaves out characters of which only some bytes stay.
    """
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    store = Stored(spark, "repeats")
    others = [c for c in docs.columns if c not in ("doc_id", "text")] if carry else []
    texts = docs.select("doc_id", "text", F.expr(f"(doc_id - pmod(doc_id, {BLOCK_DOCS})) div {BLOCK_DOCS}").alias("block"), *(F.col(c).alias(f"carried_{c}") for c in others))
    known = texts.where("doc_id is not null")
    keys = known.where(f"octet_length(text) >= {SIZE}").select("doc_id", "text").mapInArrow(
        _block_keys(parts), "bucket int, keys binary, holders binary, blocks binary")
    # All but the first document of each text, long enough to lose anything.
    long = known.select("doc_id", "text", "block").where(f"octet_length(text) >= {SIZE}")
    digest = store.save(long.select("doc_id", "block", F.unhex(F.sha2("text", 256)).alias("digest")))
    low = digest.groupBy("digest").agg(F.min("doc_id").alias("low"), F.count("*").alias("n")).where("n > 1")
    copies = digest.join(low, "digest").where("doc_id > low").select("block", F.lit(-1).alias("bucket"), F.col("doc_id").alias("copy"), "digest")
    shared = store.save(keys.repartitionById(parts, F.col("bucket")).mapInArrow(
        _shared_keys, "block long, bucket int, keys binary, hot binary").unionByName(copies, allowMissingColumns=True))
    store.drop(digest)
    packed = known.mapInArrow(_packs, "block long, docs binary")
    sent = (packed.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(
        _with_docs(_send_stretches(parts)), "bucket int, block long, data binary, sizes binary, owners binary, more binary, cells binary"))
    kinds = "block long, bucket int, content binary, runs binary, lengths binary, least binary"
    # Answers are not written: in one plan with the removal, Spark takes the shuffled documents a second time.
    answers = sent.repartitionById(parts, F.col("bucket")).mapInArrow(_match, kinds).unionByName(
        shared.where("octet_length(hot) > 0 or bucket = -1").select("block", "bucket", "hot", "copy", "digest"), allowMissingColumns=True)
    schema = T.StructType([*T.StructType.fromDDL(SCHEMA), *(T.StructField(f"carried_{c}", docs.schema[c].dataType) for c in others)])
    left = packed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _with_docs(_remove(parts, [f"carried_{c}" for c in others])), schema)
    # Rows without doc_id lose nothing and need no block.
    text, none = F.coalesce("text", F.lit("")), F.lit(0).cast("long")
    whole = {"doc_id": F.lit(None).cast("long"), "n_bytes": F.octet_length(text).cast("long"), "n_removed": none, "n_spans": none,
             "kept_sha256": F.sha2(text.cast("binary"), 256), "kept_text": text}
    return left.union(texts.where("doc_id is null").select(*(whole.get(c, F.col(c)).alias(c) for c in schema.names)))


def _with_docs(work):
    """Documents are unpacked and taken in order."""
    def run(docs: pa.Table, other: pa.Table) -> pa.Table:
        return work(_in_order(_unpack(docs)), other)

    return run
