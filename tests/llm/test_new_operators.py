"""Tokenizer alignment, dual-tree search and reversible line dedup against brute force and edge cases."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

pytest.importorskip("duelframe.llm")

import public_tokenizers  # noqa: E402
import sentencepiece  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from duelframe.llm import alignment, dual_tree, line_dedup  # noqa: E402
from duelframe.llm.cuckoo import Cuckoo  # noqa: E402

# Columns with names that the operators use themselves.
SCHEMA = "doc_id long, text string, digest string, row string, n long, k1 string, item int, rank int, shard string, map map<string,int>"


def frame(spark, rows):
    return spark.createDataFrame([(d, x, "clash", "r", -1, "k", 0, 0, "s", {"a": 1}) for d, x in rows], SCHEMA)


# op11
@pytest.fixture(scope="module")
def encoders():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def byte_table():
    """The printable stand-in of each byte in a byte-level vocabulary."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


BYTES = byte_table()


def tokens(encoders, text):
    """Ids and byte ends of both encodings of the whole text, None if bytes differ."""
    a, b = encoders
    out = []
    ids = a.encode(" " + text, add_special_tokens=False).ids
    out.append((ids, [bytes(BYTES[c] for c in a.id_to_token(i)) for i in ids]))
    ids = b.encode(text)
    out.append((ids, [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids]))
    if any(b"".join(parts) != (" " + text).encode() for _, parts in out):
        return None
    return [(ids, np.cumsum([len(p) for p in parts]), [len(p) for p in parts]) for ids, parts in out]


def plain_alignment(encoders, texts):
    links, rows = [], []
    for text in texts:
        found = tokens(encoders, text) if text else None
        if found is None:
            links.append([])
            rows.append([0, 0, 0, ""])
            continue
        (ids_a, ends_a, size_a), (ids_b, ends_b, size_b) = found
        cuts = np.intersect1d(ends_a, ends_b)
        groups = [([], []) for _ in cuts]
        for side, (ids, ends) in enumerate(((ids_a, ends_a), (ids_b, ends_b))):
            for i, g in zip(ids, np.searchsorted(cuts, ends)):
                groups[g][side].append(i)
        links.append([(ids_a[i], ids_b[j]) for i in range(len(ids_a)) for j in range(len(ids_b))
                      if ends_a[i] - size_a[i] < ends_b[j] and ends_b[j] - size_b[j] < ends_a[i]])
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        rows.append([len(ids_a), len(ids_b), len(cuts), hashlib.sha256(text.encode()).hexdigest()])
    counts = Counter(pair for mine in links for pair in mine)
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return [(a, b, g, len(mine), sum(counts[p] == most[p[1]] for p in mine), sum(counts[p] for p in mine), digest)
            for (a, b, g, digest), mine in zip(rows, links)]


TEXTS = [None, "", " ", "a", "aaaa aaa aa a aaaaaaa", "  two  blanks   three ", "tab\there\nline \n end\r\n", "Zürich ß 漢字 😀 é",
         "<s> </s> <|endoftext|> <unk>", "literal ▁ mark", "　wide\xa0space \x1c x \x85 y", "don't you'll 's 'S 12345 3.14 [MASK]!!",
         "\x00 null", "the cat sat on the mat " * 40, "a" * 3000, "x y " * 3000, "the cat sat on the mat " * 40, " lead and trail "]


@pytest.mark.parametrize("max_pairs", [alignment.PAIRS, 0])
def test_alignment_equals_brute_force(spark, encoders, max_pairs):
    rows = [(i, x) for i, x in enumerate(TEXTS)] + [(3, "repeated id"), (None, "no id the cat")]
    got = alignment.align(spark, frame(spark, rows), max_pairs=max_pairs).collect()
    want = [(d, *r) for (d, _), r in zip(rows, plain_alignment(encoders, [x for _, x in rows]))]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert alignment.align(spark, frame(spark, [])).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab c\n\té▁ 　'1.😀é"), max_size=40))
def test_stretches_equal_whole_texts(encoders, text):
    align = alignment.aligner(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model"))
    if text:
        found, whole = align([text])[0], tokens(encoders, text)
        assert (found is None) == (whole is None)
        if found:
            (ids_a, ends_a, _), (ids_b, ends_b, _) = whole
            assert found[:3] == (len(ids_a), len(ids_b), len(np.intersect1d(ends_a, ends_b)))


# op12
def plain_ranks(docs, items, k=10):
    def terms(x):
        low = (x or "").translate({c: c + 32 for c in range(65, 91)})
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)

    bags = [(d, Counter(t), len(t)) for d, x in docs if (t := terms(x))]
    length, df = sum(n for *_, n in bags), Counter(t for _, bag, _ in bags for t in bag)
    out = []
    for item, text in items:
        scores = []
        for d, bag, n in bags:
            m = 100 - 90 + (90 * n * len(bags)) // length
            score = sum(math.floor(1000 * math.log((2 * len(bags) + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 8 * m))
                        for t in set(terms(text)) if bag[t])
            if score > 0:
                scores.append((-score, d is None, d))
        out += [(item, r, d, -s) for r, (s, _, d) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("seeds", [dual_tree.SEEDS, 40])
def test_ranks_equal_brute_force(spark, monkeypatch, seeds):
    # Small groups, trees and blocks, so that all of them meet.
    monkeypatch.setattr(dual_tree, "GROUP_TERMS", 60)
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(60)] + ["É", "straße", "X1"]
    weights = 1 / np.arange(1, len(words) + 1)
    make = lambda n: " ".join(rng.choice(words, n, p=weights / weights.sum()))
    docs = [(i, make(int(rng.integers(0, 30)))) for i in range(400)]
    docs += [(500 + i, "w1 w2 W3; w4, straße") for i in range(30)] + [(None, "w1 w2 w59"), (600, None), (601, ""), (602, " .;\n"), (603, "w5 " * 5000)]
    items = [(i, make(int(rng.integers(1, 12)))) for i in range(30)] + [(30, "w1 w2 w3 w4"), (30, "STRASSE straße"), (31, None), (32, "!?"), (33, "nowhere"), (34, "w5 w5")]
    got = dual_tree.rank(spark, frame(spark, docs).repartition(5), spark.createDataFrame(items, "item_id long, text string"), seeds=seeds).collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain_ranks(docs, items)


def test_ranks_with_small_trees_and_blocks():
    rng = np.random.default_rng(6)
    n_terms, weights = 50, np.array([7 * (i + 1) for i in range(50)])
    items = [np.unique(rng.integers(0, n_terms, 6)) for _ in range(20)]
    trees = [dual_tree._tree(part, items, weights) for part in (list(range(12)), list(range(12, 20)))]
    best = dual_tree.Best(20, 3, np.zeros(20))
    cells, work = {}, 0
    for start in range(0, 400, 100):
        bags = [{int(t): int(rng.integers(1, 10**6)) for t in rng.integers(0, n_terms, 1 + i % 4)} for i in range(100)]
        cells |= {start + i: b for i, b in enumerate(bags)}
        for tree in trees:
            rows = [(i, int(np.searchsorted(tree.vocabulary, t)), v) for i, b in enumerate(bags) for t, v in sorted(b.items()) if t in tree.vocabulary]
            owner, column, value = map(np.array, zip(*rows))
            docs, owner = np.unique(owner, return_inverse=True)
            block = dual_tree.Block(owner, column, value, len(tree.vocabulary))
            work += dual_tree.search(tree, block, best, start + docs[block.order], np.arange(400))
    for i, terms in enumerate(items):
        scores = sorted(((-sum(int(weights[t]) * b.get(int(t), 0) for t in terms), d) for d, b in cells.items()))[:3]
        assert [(-int(s), int(d)) for s, d in zip(*best.rows[i])] == [x for x in scores if x[0] < 0]
    assert work < 20 * 400  # fewer products than pairs


def test_no_rows_without_documents_or_items(spark):
    items = spark.createDataFrame([(1, "w1")], "item_id long, text string")
    assert dual_tree.rank(spark, frame(spark, []), items).count() == 0
    assert dual_tree.rank(spark, frame(spark, [(1, None), (2, "")]), items).count() == 0
    assert dual_tree.rank(spark, frame(spark, [(1, "w1")]), items.where("false")).count() == 0


# op13
def plain_lines(rows):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    held = defaultdict(set)
    for d, x in rows:
        for line in (x or "").split("\n") if d is not None else ():
            if len(key(line)) >= 20:
                held[key(line)].add(d)
    out = []
    for d, x in rows:
        lines = (x or "").split("\n")
        kept = [line for line in lines if d is None or len(held[key(line)]) < 3 or d == max(held[key(line)])]
        out.append((d, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest(), "\n".join(kept)))
    return sorted(out, key=repr)


def some_rows(seed, n=60, first=0):
    rng = np.random.default_rng(seed)
    lines = [f"a line that is shared number {i}" for i in range(12)] + ["short", "", "Exactly twenty chars", "nineteen characters", " \tÉté é été é été É été\r"]
    forms = [str.upper, str.lower, lambda s: f"  {s}\t", lambda s: s]
    return [(first + i, "\n".join(forms[rng.integers(0, 4)](lines[j]) for j in rng.integers(0, len(lines), rng.integers(1, 6)))) for i in range(n)]


def cleaned(index, spark, rows):
    return sorted((tuple(r) for r in index.clean(frame(spark, rows)).collect()), key=repr)


def test_lines_equal_brute_force(spark):
    rows = some_rows(1) + [(900, None), (901, ""), (902, "\n\n"), (903, "long line " * 3000 + "\n" + "x" * 50000), (None, "a line that is shared number 1"),
                           (5, "a line that is shared number 2\nown line of a repeated id"), (904, "a line that is shared number 3\n" * 500)]
    rows += [rows[0]] * 5
    got = sorted((tuple(r) for r in line_dedup.dedup_lines(spark, frame(spark, rows)).collect()), key=repr)
    assert got == plain_lines(rows)
    assert line_dedup.dedup_lines(spark, frame(spark, [])).count() == 0


def test_line_index_is_reversible(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 2)  # several shards
    monkeypatch.setattr(line_dedup, "FILTER_BYTES", 1000)  # and several groups of them
    a, b, c = some_rows(2, 40), some_rows(3, 30, 40), some_rows(4, 30, 70)
    index = line_dedup.LineIndex(spark)
    index.insert(frame(spark, a))
    assert index.shard_bits and len(list(index._groups())) > 1
    index.insert(frame(spark, b + a[:5]))  # known documents change nothing
    assert cleaned(index, spark, a + b) == plain_lines(a + b)
    index.insert(frame(spark, c))
    index.delete(frame(spark, b + [(10**6, "unknown"), (None, None)]))
    assert cleaned(index, spark, a + c) == plain_lines(a + c)
    index.delete(frame(spark, c))  # the largest documents go, the next ones hold the lines
    assert cleaned(index, spark, a) == plain_lines(a)
    index.insert(frame(spark, b))
    again = line_dedup.LineIndex.open(spark, index.base)
    assert again.parts == index.parts and cleaned(again, spark, a + b) == plain_lines(a + b)
    plain = line_dedup.LineIndex(spark)
    plain.insert(frame(spark, a + b))
    assert sorted(index.counts().collect()) == sorted(plain.counts().collect())


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 3000), st.integers(0, 5))
def test_cuckoo_filter(seed, n, parts):
    rng = np.random.default_rng(seed)
    keys = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
    keys[:len(keys) // 4] |= np.uint64(0xFFFFFFFF00000000)  # many equal fingerprints
    keys = rng.permutation(np.unique(keys))
    cuckoo = Cuckoo()
    for part in np.array_split(keys, parts + 1):
        cuckoo.insert(part)
    cuckoo = Cuckoo.from_bytes(cuckoo.to_bytes())
    assert cuckoo.contains(keys).all() and cuckoo.size == len(keys)
    gone = keys[::3]
    cuckoo.delete(gone)
    left = np.setdiff1d(keys, gone)
    assert cuckoo.contains(left).all()
    cuckoo.delete(left)
    assert not cuckoo.contains(keys).any() and cuckoo.size == 0
