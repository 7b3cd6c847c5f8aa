"""Reversible line dedup: sharded cuckoo filters backed by exact reference counts.

A line's key is the line without the white space around it, A-Z lower-cased, as a 128-bit hash. The index is three logs
in the shared folder, one part per update:

* ``refs``: (key, doc_id, sign), +1 where a document began to hold a key and -1 where it stopped;
* ``counts``: (key, n_docs, last_doc) of the keys an update touched; the newest part counts;
* ``filters``: cuckoo filters of the shards an update touched; they hold the keys of at least ``min_docs`` documents.

``insert`` and ``delete`` only add parts: keys that reach ``min_docs`` enter their shard's filter, keys that fall below
leave it, and a deletion looks the next largest document up in the references. An index after deletions gives the same
lines as one that never held the documents, so removed lines come back. A part counts once its filters are written; a
retry after a failure writes a new folder.

``clean`` probes the filters with the lines of every document. They travel to the tasks in groups of shards of at most
FILTER_BYTES, so a very common line needs no shuffle to be found; what hits is looked up in the exact counts, which sorts
out wrong hits, and joined to its documents.

A document is told by its doc_id; rows that share one are one document to the counts and are each cleaned. Rows without
doc_id count nowhere and keep all lines. Null and empty texts are one empty line. Repeated rows change nothing. Other
columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .cuckoo import Cuckoo
from .storage import Stored, shared_dir
from .textops import U64

MIN_DOCS, MIN_CHARS = 3, 20
#: Keys a shard is planned for; its filter takes about 6 bytes a key.
SHARD_KEYS = 1 << 12
#: Bytes of filters that travel with one job.
FILTER_BYTES = 64 << 20
_SPACE = " \t\n\x0b\x0c\r"
_KEY = ["k1", "k2"]
_COUNTS = "k1 long, k2 long, n_docs long, last_doc long"
_REFS = "k1 long, k2 long, doc_id long, sign int"
_FILTERS = "shard int, filter binary"


def line_key(line: str, min_chars: int) -> bytes | None:
    """128-bit hash of a line's key, None if the key is too short."""
    core = line.strip(_SPACE) if len(line) >= min_chars else ""
    return hashlib.blake2b(core.encode().lower(), digest_size=16).digest() if len(core) >= min_chars else None


def _numbered(docs: DataFrame) -> DataFrame:
    """(doc_id, text, digest); doc_id and digest tell a row's document and text."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn(
        "digest", F.xxhash64("text"))


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, digest, k1, k2): the distinct keys of each row with a doc_id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column("text"):
                keys = {line_key(line, min_chars) for line in (text.as_py() or "").split("\n")}
                keys.discard(None)
                found.append(keys)
            row = np.repeat(np.arange(len(found)), [len(keys) for keys in found])
            halves = np.frombuffer(b"".join(b"".join(keys) for keys in found), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(row)), batch.column("digest").take(pa.array(row)),
                                              pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy())],
                                             ["doc_id", "digest", *_KEY])

    rows = _numbered(docs).where("doc_id is not null and text is not null")
    return rows.select("doc_id", "text", "digest").mapInArrow(run, "doc_id long, digest long, k1 long, k2 long")


class LineIndex:
    """See the module's text. ``open`` continues an index that an earlier session wrote to ``base``."""

    def __init__(self, spark: SparkSession, base: str | None = None, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS):
        self.spark, self.base = spark, base or f"{shared_dir(spark)}/line-index-{uuid.uuid4().hex}"
        self.min_docs, self.min_chars = min_docs, min_chars
        self.parts: list[str] = []
        self.shard_bits = 0

    @classmethod
    def open(cls, spark: SparkSession, base: str, **options) -> "LineIndex":
        out = cls(spark, base, **options)
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path
        fs = path(base).getFileSystem(conf)
        names = sorted(f.getPath().getName() for f in fs.listStatus(path(base)))
        out.parts = [n for n in names if not n.startswith("parts-")]
        if out.parts:
            out.shard_bits = int(out.parts[0].split("-")[1])
        return out

    # -- what the index holds ------------------------------------------------------------------------------------------

    def _read(self, name: str, schema: str) -> DataFrame:
        """All parts of a log with the number of their update."""
        if not self.parts:
            return self.spark.createDataFrame([], f"{schema}, part int")
        out = None
        for n, part in enumerate(self.parts):
            rows = self.spark.read.schema(schema).parquet(f"{self.base}/{part}/{name}").withColumn("part", F.lit(n))
            out = rows if out is None else out.unionByName(rows)
        return out

    def refs(self) -> DataFrame:
        """(k1, k2, doc_id) of every key a document holds."""
        rows = self._read("refs", _REFS)
        if len(self.parts) < 2:
            return rows.select(*_KEY, "doc_id")
        return rows.groupBy(*_KEY, "doc_id").agg(F.sum("sign").alias("n")).where("n > 0").drop("n")

    def counts(self) -> DataFrame:
        """(k1, k2, n_docs, last_doc) of every key that a document holds."""
        rows = self._read("counts", _COUNTS)
        if len(self.parts) > 1:
            newest = rows.groupBy(*_KEY).agg(F.max_by(F.struct("n_docs", "last_doc"), "part").alias("c"))
            rows = newest.select(*_KEY, "c.n_docs", "c.last_doc")
        return rows.select(*_KEY, "n_docs", "last_doc").where("n_docs > 0")

    def filters(self) -> DataFrame:
        """(shard, filter): the newest filter of each shard."""
        rows = self._read("filters", _FILTERS)
        return rows.groupBy("shard").agg(F.max_by("filter", "part").alias("filter"))

    def _shard(self) -> Column:
        return F.shiftrightunsigned("k1", 64 - self.shard_bits).cast("int") if self.shard_bits else F.lit(0)

    # -- updates -------------------------------------------------------------------------------------------------------

    def insert(self, docs: DataFrame, keys: DataFrame | None = None) -> None:
        """Add documents; ``keys``: their ``line_keys`` where they are already at hand. References that are known stay."""
        keys = line_keys(docs, self.min_chars) if keys is None else keys
        new = keys.select(*_KEY, "doc_id").distinct()
        if self.parts:
            new = new.join(self.refs(), [*_KEY, "doc_id"], "left_anti")
        self._update(new.withColumn("sign", F.lit(1)))

    def delete(self, doc_ids: DataFrame) -> None:
        """Take documents out by their doc_id; unknown ones are ignored."""
        gone = doc_ids.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
        self._update(self.refs().join(gone, "doc_id", "left_semi").select(*_KEY, "doc_id").withColumn("sign", F.lit(-1)))

    def _update(self, change: DataFrame) -> None:
        folder = f"{len(self.parts):06d}"
        written = f"{self.base}/parts-{uuid.uuid4().hex}"
        change.write.parquet(f"{written}/refs")
        change = self.spark.read.schema(_REFS).parquet(f"{written}/refs")
        # The references are spread by (key, doc_id); of a hot key each task sends one row.
        step = change.groupBy(*_KEY).agg(F.sum("sign").alias("step"), F.max(F.when(F.col("sign") > 0, F.col("doc_id"))).alias("came"),
                                         F.max(F.when(F.col("sign") < 0, F.col("doc_id"))).alias("went"))
        if self.parts:
            step = step.join(self.counts(), _KEY, "left")
        else:
            step = step.withColumns({"n_docs": F.lit(None).cast("long"), "last_doc": F.lit(None).cast("long")})
        was = F.coalesce("n_docs", F.lit(0))
        step = step.select(*_KEY, was.alias("was"), (was + F.col("step")).alias("n_docs"), "came", "went", "last_doc")
        kept = step.withColumn("last_doc", F.greatest("last_doc", "came"))
        if self.parts:
            # Where the largest document went, the references tell the next one.
            lost = step.where("went >= last_doc and n_docs > 0").select(*_KEY)
            left = (self.refs().join(lost, _KEY, "left_semi").join(change.where("sign < 0"), [*_KEY, "doc_id"], "left_anti")
                    .groupBy(*_KEY).agg(F.max("doc_id").alias("next")))
            kept = kept.join(left, _KEY, "left").withColumn("last_doc", F.coalesce("next", "last_doc"))
        kept.select(*_KEY, "n_docs", "last_doc", "was").write.parquet(f"{written}/counts")
        counts = self.spark.read.schema(f"{_COUNTS}, was long").parquet(f"{written}/counts")
        moved = counts.select(*_KEY, (F.col("n_docs") >= self.min_docs).alias("now"), (F.col("was") >= self.min_docs).alias("before")).where("now <> before")
        if not self.parts:
            self.shard_bits = max(0, (moved.count() // SHARD_KEYS).bit_length())
        self._write_filters(moved.select(self._shard().alias("shard"), "k2", "now"), f"{written}/filters")
        self._publish(written, f"{folder}-{self.shard_bits}")

    def _write_filters(self, moved: DataFrame, path: str) -> None:
        def update(key: tuple, old: pa.Table, moves: pa.Table) -> pa.Table:
            if not moves.num_rows:
                return pa.table({"shard": pa.array([], pa.int32()), "filter": pa.array([], pa.binary())})
            hashes = moves.column("k2").to_numpy().view(U64)
            now = moves.column("now").to_numpy()
            cuckoo = Cuckoo.from_bytes(old.column("filter")[0].as_py()) if old.num_rows else Cuckoo(int(now.sum()))
            cuckoo.delete(hashes[~now])
            cuckoo.insert(hashes[now])
            return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "filter": pa.array([cuckoo.to_bytes()], pa.binary())})

        # A shard's keys are distinct and dealt by hash: SHARD_KEYS of them on the first update.
        self.filters().groupBy("shard").cogroup(moved.groupBy("shard")).applyInArrow(update, _FILTERS).write.parquet(path)

    def _publish(self, written: str, name: str) -> None:
        """One rename makes an update visible."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path
        if not path(written).getFileSystem(conf).rename(path(written), path(f"{self.base}/{name}")):
            raise RuntimeError(f"the update could not be published as {name}")
        self.parts.append(name)

    # -- use -----------------------------------------------------------------------------------------------------------

    def _groups(self) -> Iterator[dict[int, Cuckoo]]:
        """The filters in groups of at most FILTER_BYTES (one at least), fetched one after another."""
        sizes = self.filters().select("shard", F.length("filter").alias("n")).orderBy("shard").toLocalIterator()
        group, total = [], 0
        for shard, n in sizes:
            if group and total + n > FILTER_BYTES:
                yield self._fetch(group)
                group, total = [], 0
            group.append(shard)
            total += n
        if group:
            yield self._fetch(group)

    def _fetch(self, shards: list[int]) -> dict[int, Cuckoo]:
        rows = self.filters().where(F.col("shard").between(shards[0], shards[-1])).collect()
        return {shard: Cuckoo.from_bytes(bytes(data)) for shard, data in rows}

    def drops(self, keys: DataFrame) -> DataFrame:
        """The rows of ``keys`` (see ``line_keys``) that their documents lose."""
        hits = None
        for group in self._groups():
            handle = self.spark.sparkContext.broadcast(group)

            def probe(batches: Iterator[pa.RecordBatch], handle=handle) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    shard, k2 = batch.column("shard").to_numpy(), batch.column("k2").to_numpy().view(U64)
                    found = np.zeros(len(shard), bool)
                    for number in np.unique(shard).tolist():
                        at = np.flatnonzero(shard == number)
                        found[at] = handle.value[number].contains(k2[at]) if number in handle.value else False
                    yield batch.filter(pa.array(found))

            part = keys.select("doc_id", "digest", *_KEY, self._shard().alias("shard")).where(F.col("shard").between(min(group), max(group)))
            part = part.mapInArrow(probe, part.schema).drop("shard")
            hits = part if hits is None else hits.unionByName(part)
        if hits is None:
            return keys.where(F.lit(False))
        shared = self.counts().where(F.col("n_docs") >= self.min_docs)
        return hits.join(shared, _KEY).where("doc_id < last_doc").select("doc_id", "digest", *_KEY)

    def clean(self, docs: DataFrame, keys: DataFrame | None = None, with_text: bool = True) -> DataFrame:
        """(doc_id, n_lines, n_dropped, kept_sha256, kept_text) of documents of the index, one row each.

        ``keys``: their ``line_keys`` where they are at hand; ``with_text=False`` leaves kept_text out.
        """
        keys = line_keys(docs, self.min_chars) if keys is None else keys
        lists = self.drops(keys).groupBy("doc_id", "digest").agg(F.collect_set(F.struct(*_KEY)).alias("drops"))
        rows = _numbered(docs)
        joined = rows.join(lists, ["doc_id", "digest"], "left").select("doc_id", "text", "drops")
        schema = "doc_id long, n_lines long, n_dropped long, kept_sha256 string" + ", kept_text string" * with_text
        min_chars = self.min_chars

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [_kept(text.as_py() or "", _dropped(drops), min_chars)
                        for text, drops in zip(batch.column("text"), batch.column("drops"))]
                lines, gone, texts = zip(*rows) if rows else ((), (), ())
                arrays = [batch.column("doc_id"), pa.array(lines, pa.int64()), pa.array(gone, pa.int64()),
                          pa.array([hashlib.sha256(x.encode()).hexdigest() for x in texts], pa.string())]
                yield pa.RecordBatch.from_arrays(arrays + [pa.array(texts, pa.string())] * with_text,
                                                 ["doc_id", "n_lines", "n_dropped", "kept_sha256"] + ["kept_text"] * with_text)

        return joined.mapInArrow(run, schema)


def _dropped(drops: pa.ListScalar) -> set[bytes]:
    if not drops.is_valid:
        return set()
    halves = np.stack([drops.values.field(0).to_numpy(), drops.values.field(1).to_numpy()], 1)
    data = np.ascontiguousarray(halves).tobytes()
    return {data[i:i + 16] for i in range(0, len(data), 16)}


def _kept(text: str, dropped: set[bytes], min_chars: int) -> tuple[int, int, str]:
    if not dropped:
        return text.count("\n") + 1, 0, text
    lines = text.split("\n")
    left = [line for line in lines if line_key(line, min_chars) not in dropped]
    return len(lines), len(lines) - len(left), "\n".join(left)


def dedup_lines(spark: SparkSession, docs: DataFrame, with_text: bool = True) -> DataFrame:
    """Index all documents and clean them."""
    keys = Stored(spark, "lines").save(line_keys(docs))
    index = LineIndex(spark)
    index.insert(docs, keys)
    return index.clean(docs, keys, with_text)
