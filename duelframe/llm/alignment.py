"""Cross-tokenizer alignment of every text, with an identity-map fast path.

A text after one space is encoded by a byte-level BPE (A) and by a sentence-piece BPE (B, which adds the space itself).
Byte offsets where tokens of both end cut the tokens into groups; inside a group every A and B token whose bytes overlap
are linked. A group of one A and one B token that is the identity map's B id of the same bytes is *regular*: its link is
told by the A id alone. Corpus-wide, regular links are counted in vectors as long as A's vocabulary; only links of
irregular groups go through the pair shuffle, summed in each task before.

Jobs: one encodes the texts and writes each row's counts, groups hash and distinct links; one sums the vectors; one sums
the irregular pairs. The counts of a pair add both, since tokens of equal bytes may also overlap at different offsets.
Then every row's links get their counts. Regular ones come from a vector. The table of irregular pairs travels with the
tasks while it has at most PAIRS rows (16 bytes each); beyond that the irregular links of all rows are joined with it by
pair and summed by row, with the same result.

Blanks that stand alone before a character that is not white space always start a token of both (no piece of B holds a
blank after another character, which is checked), so the different stretches between them are encoded once for some texts
together, and each worker remembers short ones.

Texts that are null or empty, or whose joined token bytes differ from the text, get zeros and an empty hash. Repeated rows
count each. Rows without doc_id count and get their row under a null id. An empty table gives no rows. Other columns are
ignored. The vocabulary files must lie at the same path on every machine.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import Stored
from .textops import slices

#: Rows of irregular pairs that travel with tasks at most.
PAIRS = 1 << 20
#: Stretches in each of two generations of a worker's memory, and characters of one; bytes of text encoded together.
REMEMBERED, SHORT, SLICE = 200_000, 40, 1 << 20
#: Bits of a B id in a pair; a regular link has A's id and this flag instead.
_B_BITS = 15
_REGULAR = np.uint32(1 << 31)
_STARTS = re.compile(r"(?<! ) (?=\S)")
_SPACE_PIECE = "▁"

ROWS = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "same array<int>, same_n array<int>, odd array<int>, odd_n array<int>")
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


#: Groups as text, link codes, and the number of A tokens.
Stretch = tuple[bytes, bytes, int]


class Aligner:
    """Encodes texts by both vocabularies and aligns the tokens."""

    def __init__(self, ranks_path: str, model_path: str):
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.a = tiktoken.Encoding("alignment", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=model_path)
        if self.b.get_piece_size() > 1 << _B_BITS or max(ranks.values()) >= 1 << 31 - _B_BITS:
            raise ValueError("a vocabulary is too large for the pair codes")
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(_SPACE_PIECE in p.lstrip(_SPACE_PIECE) for p in pieces):
            raise ValueError("a piece holds a blank after another character")
        self.a_bytes = {number: token for token, number in ranks.items()}
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else b"" if self.b.is_control(i) else p.replace(_SPACE_PIECE, " ").encode()
                        for i, p in enumerate(pieces)]
        # The identity map; of B ids with the same bytes the last one, a piece rather than a single byte.
        by_bytes = {token: number for number, token in enumerate(self.b_bytes)}
        self.same = np.full(max(self.a_bytes) + 1, -1, np.int64)
        self.a_size = np.zeros(len(self.same), np.int64)
        for number, token in self.a_bytes.items():
            self.same[number] = by_bytes.get(token, -1)
            self.a_size[number] = len(token)
        self.b_size = np.array([len(token) for token in self.b_bytes])
        # Two generations of stretches: what the older one does not lend to the younger is forgotten with it.
        self.young: dict[str, Stretch | None] = {}
        self.old: dict[str, Stretch | None] = {}

    def align(self, parts: list[str]) -> list[Stretch | None]:
        """Each part (after its blank) by itself; None if its bytes are not kept. All are encoded in one call."""
        if not parts:
            return []
        text = " " + " ".join(parts)
        ids_a = np.array(self.a.encode_ordinary(text), np.int64)
        ids_b = np.array(list(chain.from_iterable(self.b.encode(parts, num_threads=1))), np.int64)
        data = text.encode()
        if (b"".join(map(self.a_bytes.__getitem__, ids_a.tolist())) != data
                or b"".join(map(self.b_bytes.__getitem__, ids_b.tolist())) != data):
            half = len(parts) // 2
            return self.align(parts[:half]) + self.align(parts[half:]) if half else [None]
        ends = np.cumsum([len(part.encode()) + 1 for part in parts])
        end_a, end_b = np.cumsum(self.a_size[ids_a]), np.cumsum(self.b_size[ids_b])
        # The stretches between neighbouring token ends are the links: each lies in one token of A and one of B.
        at = np.union1d(end_a, end_b)
        i, j = np.searchsorted(end_a, at), np.searchsorted(end_b, at)
        last = np.flatnonzero((end_a[i] == at) & (end_b[j] == at))
        first = np.append(0, last[:-1] + 1)
        group = np.repeat(np.arange(len(last)), last - first + 1)
        a, b = ids_a[i], ids_b[j]
        regular = (last == first)[group] & (self.same[a] == b)
        codes = np.where(regular, a | int(_REGULAR), a << _B_BITS | b).astype(np.uint32).tobytes()
        names_a, names_b = list(map(str, ids_a.tolist())), list(map(str, ids_b.tolist()))
        groups = [names_a[p] + "|" + names_b[r] if p == q and r == s else ",".join(names_a[p:q + 1]) + "|" + ",".join(names_b[r:s + 1])
                  for p, q, r, s in zip(i[first].tolist(), i[last].tolist(), j[first].tolist(), j[last].tolist())]
        g, c, t = (np.searchsorted(x, ends, side="right") for x in (at[last], at, end_a))
        if (at[last][g - 1] != ends).any():
            raise ValueError("a token goes over the blank before a stretch")
        return [(";".join(groups[g0:g1]).encode(), codes[4 * c0:4 * c1], t1 - t0) for g0, g1, c0, c1, t0, t1 in
                zip(*(x.tolist() for v in (g, c, t) for x in (np.append(0, v[:-1]), v)))]

    def _stretches(self, parts: set[str]) -> dict[str, Stretch | None]:
        found, new = {}, []
        for part in parts:
            if part in self.young:
                found[part] = self.young[part]
            elif part in self.old:
                found[part] = self.young[part] = self.old[part]
            elif _SPACE_PIECE in part:
                found[part] = None  # B takes it for a blank
            else:
                new.append(part)
        # Only a part that begins with a character other than white space may follow another one.
        free = [part for part in new if not part or part[0].isspace()]
        inner = [part for part in new if part and not part[0].isspace()]
        made = dict(zip(inner, self.align(inner))) | {part: self.align([part])[0] for part in free}
        self.young |= {part: stretch for part, stretch in made.items() if len(part) <= SHORT}
        if len(self.young) > REMEMBERED:
            self.young, self.old = {}, self.young
        return found | made

    def __call__(self, texts: list[str]) -> list[tuple[int, int, int, int, str, np.ndarray, np.ndarray] | None]:
        """Of each text: counts of A and B tokens, groups and links, the groups' hash, distinct link codes and how often each occurs."""
        split = []
        for text in texts:
            first, *rest = _STARTS.split(" " + text)
            split.append(([first[1:]] if first else []) + rest)
        found = self._stretches(set(chain.from_iterable(split)))
        return [self._text([found[part] for part in parts]) for parts in split]

    @staticmethod
    def _text(parts: list[Stretch | None]) -> tuple | None:
        if None in parts:
            return None
        groups, codes, n_a = zip(*parts)
        joined = b";".join(groups)
        codes = np.frombuffer(b"".join(codes), np.uint32)
        n_a, n_groups = sum(n_a), joined.count(b"|")
        # A group of p and q tokens has p + q - 1 links.
        return (n_a, len(codes) + n_groups - n_a, n_groups, len(codes), hashlib.sha256(joined).hexdigest(),
                *np.unique(codes, return_counts=True))


@cache
def aligner(ranks_path: str, model_path: str) -> Aligner:
    """One for each Python worker."""
    return Aligner(ranks_path, model_path)


def _lists(values: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))


def encode(docs: DataFrame, ranks_path: str | None = None, model_path: str | None = None) -> DataFrame:
    """ROWS of all documents: distinct regular links (A ids) and irregular ones (pair codes) with their numbers."""
    paths = ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), model_path or public_tokenizers.path("piece_bpe_32k.model")
    nothing = np.zeros(0, np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = aligner(*paths)
        for batch in slices(batches, "text", SLICE):
            texts = batch.column("text").to_pylist()
            found = iter(align([text for text in texts if text]))
            rows = [(next(found) if text else None) or (0, 0, 0, 0, "", nothing, nothing) for text in texts]
            n_a, n_b, n_groups, n_links, digest, codes, counts = zip(*rows) if rows else ((),) * 7
            regular = [c >= _REGULAR for c in codes]
            lists = [_lists([x[r] for x, r in zip(values, which)]) for which in (regular, [~r for r in regular])
                     for values in ([c & ~_REGULAR for c in codes], counts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in (n_a, n_b, n_groups, n_links)),
                 pa.array(digest, pa.string()), *lists], [c.split()[0] for c in ROWS.split(", ")])

    # The row's number only lives in the written table, which is read from then on.
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, ROWS)


def _flat(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False)


def regular_counts(rows: DataFrame, size: int) -> np.ndarray:
    """Corpus-wide number of regular links by A id; each task sends one vector's non-zero entries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(_flat(batch.column(0)), weights=_flat(batch.column(1)), minlength=size).astype(np.int64)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], ["a", "n"])

    out = np.zeros(size, np.int64)
    for a, n in rows.select("same", "same_n").mapInArrow(run, "a int, n long").groupBy("a").agg(F.sum("n")).collect():
        out[a] = n
    return out


def irregular_counts(rows: DataFrame) -> DataFrame:
    """(pair, n): corpus-wide number of links of irregular groups by pair code; each task sums its own first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {"pair": np.zeros(0, np.int32), "n": np.zeros(0, np.int64)}
        for batch in batches:
            pairs, at = np.unique(np.concatenate([total["pair"], _flat(batch.column(0))]), return_inverse=True)
            weights = np.concatenate([total["n"], _flat(batch.column(1))])
            total = {"pair": pairs, "n": np.bincount(at, weights=weights, minlength=len(pairs)).astype(np.int64)}
        yield pa.RecordBatch.from_pydict(total, schema=pa.schema([("pair", pa.int32()), ("n", pa.int64())]))

    return rows.select("odd", "odd_n").mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def align(spark: SparkSession, docs: DataFrame, ranks_path: str | None = None, model_path: str | None = None,
          max_pairs: int = PAIRS) -> DataFrame:
    """RESULT, one row for each row of docs(doc_id, text)."""
    store = Stored(spark, "alignment")
    rows = store.save(encode(docs, ranks_path, model_path))
    names = aligner(ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), model_path or public_tokenizers.path("piece_bpe_32k.model"))
    size = len(names.same)
    # Pairs that occur in both kinds of groups add up; there are at most as many regular ones as A has ids.
    vector = regular_counts(rows, size)
    a = np.flatnonzero(vector)
    regular = spark.createDataFrame([(int(i), int(i) << _B_BITS | int(names.same[i]), int(vector[i])) for i in a], "a int, pair int, n long")
    both = irregular_counts(rows).unionByName(regular.select("pair", "n")).groupBy("pair").agg(F.sum("n").alias("n"))
    both = store.save(both)
    b = F.col("pair").bitwiseAND((1 << _B_BITS) - 1)
    # At most one row for each B id.
    most = both.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    pairs = store.save(both.withColumn("b", b).join(F.broadcast(most), "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")))
    vectors = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for i, n, best in pairs.join(F.broadcast(regular.select("a", "pair")), "pair").select("a", "n", "best").collect():
        vectors[0][i], vectors[1][i] = n, best
    if pairs.count() <= max_pairs:
        table = pairs.orderBy("pair").toArrow()
        codes, n, best = (table.column(c).to_numpy() for c in ("pair", "n", "best"))
        handle = spark.sparkContext.broadcast((*vectors, codes, n, best.astype(np.int64)))
        return rows.mapInArrow(lambda batches: (_scored(batch, *handle.value) for batch in batches), RESULT)
    none = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
    handle = spark.sparkContext.broadcast((*vectors, *none))
    regular_part = rows.withColumns({"odd": F.array().cast("array<int>"), "odd_n": F.array().cast("array<int>")}).mapInArrow(
        lambda batches: (_scored(batch, *handle.value, keep_row=True) for batch in batches), f"row long, {RESULT}")
    links = rows.select("row", F.explode(F.arrays_zip("odd", "odd_n")).alias("x")).select("row", F.col("x.odd").alias("pair"), F.col("x.odd_n").alias("times"))
    sums = links.join(pairs, "pair").groupBy("row").agg(F.sum(F.col("times") * F.col("n")).alias("s"),
                                                       F.sum(F.col("times") * F.col("best").cast("int")).alias("m"))
    return regular_part.join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("m", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("s", F.lit(0))).alias("count_sum"), "groups_sha256")


def _scored(batch: pa.RecordBatch, count: np.ndarray, best: np.ndarray, codes: np.ndarray, n: np.ndarray, tops: np.ndarray,
            keep_row: bool = False) -> pa.RecordBatch:
    """n_best and count_sum of each row from its distinct links."""
    same, odd = _flat(batch.column("same")), _flat(batch.column("odd"))
    at = np.searchsorted(codes, odd)
    sums = []
    for by_id, by_pair in ((best, tops), (count, n)):
        total = np.zeros(batch.num_rows, np.int64)
        for column, times, values in (("same", "same_n", by_id[same]), ("odd", "odd_n", by_pair[at])):
            row = np.repeat(np.arange(batch.num_rows), np.diff(batch.column(column).offsets.to_numpy()))
            np.add.at(total, row, _flat(batch.column(times)) * values)
        sums.append(pa.array(total))
    kept = ["row"] * keep_row + ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    return pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *sums, batch.column("groups_sha256")],
                                      [*kept, "n_best", "count_sum", "groups_sha256"])
