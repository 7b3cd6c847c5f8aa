"""Operators for training data against brute force, round trips and edge cases on small fixtures."""

import hashlib
import json
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

pytest.importorskip("duelframe.llm")

from duelframe.llm import (decontaminate, language, near_dedup, packing, repetition, resampling, sharding,  # noqa: E402
                           storage, suffix_dedup, tool_calls, toxicity)
from duelframe.llm.run_index import RunIndex  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string"
BASE = " ".join(f"w{i}" for i in range(200))


def docs_of(spark, texts, first=0):
    rows = [(first + i, x, "en", "src", len(x or ""), "clash") for i, x in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


ODD = [None, "", "   \n\t", "a", "Zürich ß 1", "x " * 3000, "ab" * 20000, BASE, BASE, BASE.replace("w7 ", "q ")]


def words_of(x):
    return re.findall(r"[^\x20\x09-\x0D]+", x or "")


# op1
def jaccard_classes(texts):
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = []
    for x in texts:
        w = words_of((x or "").translate(low))
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    parent = list(range(len(texts)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((top(i), top(j)))
                parent[b] = a
    return [(i, len(sets[i]), top(i)) for i in range(len(texts))]


def test_near_duplicates_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    base = [f"t{i}" for i in range(80)]
    family = [" ".join(w if rng.random() > 0.02 else f"r{rng.integers(9999)}" for w in base) for _ in range(60)]
    texts = ODD + family + ["one two", "One two", "one  two\n", "x " * 4]
    got = near_dedup.near_duplicates(spark, docs_of(spark, texts)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == jaccard_classes(texts)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    kept = near_dedup.keep_one(spark, docs_of(spark, texts))
    assert kept.count() == sum(r.kept for r in got) and kept.columns == docs_of(spark, texts).columns
    assert near_dedup.near_duplicates(spark, docs_of(spark, [])).count() == 0


def test_near_duplicates_tell_rows_of_one_id_apart(spark):
    rng = np.random.default_rng(11)
    say = lambda n: [f"z{rng.integers(10**6)}" for _ in range(n)]
    one, two, three, four = (say(60) for _ in range(4))
    near = " ".join(["other", *two[1:]])
    one, two, three, four = (" ".join(x) for x in (one, two, three, four))
    rows = [(1, one), (1, two), (2, two), (3, near), (None, two), (None, three), (None, three), (None, near.upper()), (4, four), (4, four),
            (4, four + " "), (5, one), (None, None), (None, ""), (6, None), (6, "")]
    docs = spark.createDataFrame([(i, x, {"a": 1}, 1, 2) for i, x in rows], "doc_id long, text string, extra map<string,int>, nth_row_ int, key int")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(spark, docs).collect()), key=str)
    want = [(1, 56, 1, True), (1, 56, 1, True), (2, 56, 1, False), (3, 56, 1, False), (None, 56, 1, False), (None, 56, None, True), (None, 56, None, True),
            (None, 56, 1, False), (4, 56, 4, True), (4, 56, 4, True), (4, 56, 4, True), (5, 56, 1, False), (None, 0, None, True), (None, 0, None, True),
            (6, 0, 6, True), (6, 0, 6, True)]
    assert got == sorted(want, key=str)
    kept = near_dedup.keep_one(spark, docs)
    assert kept.schema == docs.schema
    left = Counter((r.doc_id, (r.text or "").strip()) for r in kept.collect())
    assert left == Counter([(1, one), (1, two), (None, three), (4, four), (None, ""), (None, ""), (6, ""), (6, "")])


def test_heavy_keys_join_alike(spark, monkeypatch):
    rows = spark.createDataFrame([(i, f"k{0 if i % 3 else i}", None) for i in range(300)], "i int, k string, x int")
    table = rows.groupBy("k").agg(F.count("*").alias("n"), F.min("i").alias("low")).where("k <> 'k9'")
    want = None
    for heavy in (10**6, 100, 2, 0):
        monkeypatch.setattr(storage, "HEAVY", heavy)
        got = storage.spread_join(rows, table, "k", "n")
        assert sorted(got.columns) == ["i", "k", "low", "x"]
        got = sorted((r.i, r.k, str(r.low)) for r in got.collect())
        want = want or got
        assert got == want and len(got) == 300


def test_odd_sketch_estimates_similarity():
    a = np.arange(1000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    b = np.concatenate([a[:900], a[:100] + np.uint64(1)])
    samples = near_dedup.min_hashes(np.concatenate([np.sort(a), np.sort(b)]), np.array([0, 1000, 2000]))
    bits = np.unpackbits(near_dedup.odd_sketches(samples).view(np.uint8), axis=1)
    z, n, k = (bits[0] ^ bits[1]).sum(), near_dedup.SKETCH_BITS, near_dedup.SAMPLES
    assert abs(1 + n / (4 * k) * np.log(1 - 2 * z / n) - 900 / 1100) < 0.08


# op2
@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=40), min_size=1, max_size=4))
def test_repeats_equal_brute_force(texts):
    raw = [" ".join(x).encode() for x in texts]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
    got = repetition.measure_texts(np.frombuffer(b"".join(raw), np.uint8), offsets, 4)
    for i, w in enumerate(texts):
        for name, k in (("n_repeat_words", 3), ("n_covered_words", 4)):
            seen = Counter(tuple(w[j:j + k]) for j in range(len(w) - k + 1))
            assert got[name][i] == len({p for j in range(len(w) - k + 1) if seen[tuple(w[j:j + k])] > 1 for p in range(j, j + k)})
        longest = max((k for k in range(1, len(w)) if max(Counter(tuple(w[j:j + k]) for j in range(len(w) - k + 1)).values()) > 1), default=0)
        assert got["longest_repeat"][i] == longest
        repeats = set()
        for k in range(4, len(w)):
            for gram, n in Counter(tuple(w[j:j + k]) for j in range(len(w) - k + 1)).items():
                at = [j for j in range(len(w) - k + 1) if tuple(w[j:j + k]) == gram]
                if n > 1 and len({w[j - 1] if j else ("start", j) for j in at}) > 1 and len({w[j + k] if j + k < len(w) else ("end", j) for j in at}) > 1:
                    repeats.add(gram)
        assert got["n_repeats"][i] == len(repeats)


def test_quality_rules_edge_cases(spark):
    rows = repetition.judge(repetition.measure(docs_of(spark, ODD))).orderBy("doc_id").collect()
    assert [r.kept for r in rows] == [False] * 7 + [True] * 3 and rows[5].base_failed
    good = repetition.keep_good(docs_of(spark, ODD))
    assert sorted(r.doc_id for r in good.collect()) == [7, 8, 9]
    # A passage twice in a text that is otherwise fresh.
    twice = BASE + " " + BASE
    assert not repetition.judge(repetition.measure(docs_of(spark, [twice]))).first().kept


# op3
def test_language_spans_and_held_out(spark):
    en, de = "the cat and the dog of this that with", "der Hund und die Katze mit dem nicht über"
    docs = spark.createDataFrame([(i, en if i % 2 else de, "en" if i % 2 else "de") for i in range(40)], "doc_id long, text string, lang string")
    model = language.train(docs)
    mixed = docs_of(spark, [en * 3, de * 3, f"{en} {en} {en} {de} {de} {de}", None, "", "123 --", "!"])
    got = {r.doc_id: r for r in language.predict(mixed, model).collect()}
    assert [got[i].lang_pred for i in (0, 1, 3, 4, 5, 6)] == ["en", "de", "und", "und", "und", "und"]
    assert got[2].n_spans == 2 and all(0 <= r.score <= 1 for r in got.values())
    spans = language.spans(mixed.where("doc_id = 2"), model).orderBy("start").collect()
    assert [s.lang for s in spans] == ["en", "de"]
    empty = language.train(docs.limit(0))
    assert {r.lang_pred for r in language.predict(mixed, empty).collect()} == {"und"}


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 30), min_size=1, max_size=30), st.integers(0, 999))
def test_viterbi_equals_one_by_one(counts, seed):
    counts = np.array(counts)
    scores = np.random.default_rng(seed).normal(size=(counts.sum(), 3)) * 5
    ends = np.cumsum(counts)
    one = [x for a, b in zip(ends - counts, ends) for x in language._viterbi_one(scores[a:b].tolist(), 4.0)]
    assert language._viterbi_many(scores, counts, 4.0).tolist() == one == language.viterbi(scores, counts, 4.0).tolist()


# op4
def test_tool_calls(spark):
    calls = spark.createDataFrame([
        (1, "a", None, "get", '{"b": 1, "a": "é"}', 0), (1, "b", "a", "get", '{"a": "y"}', 2), (1, "a", None, "get", '{"a": "z"}', 3),
        (1, "c", "zz", "get", '{"a": "y"}', 4), (1, "d", "e", "get", '{"a": "y"}', 5), (1, "e", "d", "get", '{"a": "y"}', 6),
        (1, "f", "a", "get", "not json", 7), (1, "g", "b", "get", '{"a": 3}', 8), (1, None, None, "get", '{"a": "y"}', 9), (2, "h", None, "other", "{}", 0),
    ], "conv_id long, call_id string, parent_id string, name string, arguments string, turn long")
    results = spark.createDataFrame([(1, "a", "ok", 1), (1, "a", "late", 5), (1, "x", "lost", 2), (1, None, "null", 3)],
                                    "conv_id long, call_id string, content string, turn long")
    schema = {"get": {"type": "object", "required": ["a"], "properties": {"a": {"type": "string"}, "b": {"type": "integer", "maximum": 3}}}}
    got = tool_calls.link_calls(spark, calls, results, schema).collect()
    by = {(r.conv_id, r.call_id, r.turn): r for r in got}
    status = {k: r.status for k, r in by.items()}
    assert status == {(1, "a", 0): "ok", (1, "b", 2): "missing_result", (1, "a", 3): "duplicate_id", (1, "c", 4): "bad_parent", (1, "d", 5): "cycle",
                      (1, "e", 6): "cycle", (1, "f", 7): "invalid_arguments", (1, "g", 8): "invalid_arguments", (1, None, 9): "missing_result",
                      (2, "h", 0): "invalid_arguments"}
    assert by[1, "a", 0].message == '{"arguments":{"a":"é","b":1},"id":"a","name":"get","result":"ok"}'
    assert sorted(r.position for r in got if r.conv_id == 1) == list(range(9)) and by[1, "g", 8].depth == 2
    assert all(json.loads(r.message)["id"] == r.call_id for r in got)
    assert {r.call_id for r in tool_calls.orphan_results(calls, results).collect()} == {"x", None}
    assert tool_calls.link_calls(spark, calls.limit(0), results, schema).count() == 0


# op5
def brute_repeats(texts):
    owner = defaultdict(set)
    raw = [(x or "").encode() for x in texts]
    for i, x in enumerate(raw):
        for j in range(len(x) - 49):
            owner[x[j:j + 50]].add(i)
    out = []
    for i, x in enumerate(raw):
        gone = np.zeros(len(x) + 1, bool)
        for j in range(len(x) - 49):
            if min(owner[x[j:j + 50]]) < i:
                gone[j:j + 50] = True
        kept = bytes(c for c, g in zip(x, gone) if not g)
        out.append((i, len(x), int(gone.sum()), int((gone[:-1] & ~np.r_[False, gone[:-2]]).sum()) if len(x) else 0, hashlib.sha256(kept).hexdigest()))
    return out


def test_repeat_removal_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(5)
    passage = " ".join(f"ü{rng.integers(1000)}" for _ in range(60))
    texts = ODD + [f"{rng.integers(10**9)} {passage[k:]} {rng.integers(10**9)} {passage[:90 + k]}" for k in range(0, 200, 7)] + ["é" * 300, "é" * 120 + "x" * 60]
    want = brute_repeats(texts)
    for hot in (256, 2):
        monkeypatch.setattr(suffix_dedup, "HOT", hot)
        got = suffix_dedup.remove_repeats(spark, docs_of(spark, texts))
        assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect()) == want
    wide = suffix_dedup.remove_repeats(spark, docs_of(spark, texts), carry=True)
    assert "carried_kept" in wide.columns and wide.count() == len(texts)
    assert suffix_dedup.remove_repeats(spark, docs_of(spark, [])).count() == 0


def test_repeat_removal_tells_rows_of_one_id_apart(spark):
    first, other = "".join(f"a{i} " for i in range(40)), "".join(f"b{i} " for i in range(40))
    big = (1 << 60) + 511
    rows = [(1, first), (2, first), (2, other), (3, other), (None, first), (None, None), (big, first), (-1, "short"), (-5, other[:60])]
    docs = spark.createDataFrame([(i, x, "en") for i, x in rows], "doc_id long, text string, lang string")
    out = suffix_dedup.remove_repeats(spark, docs, carry=True)
    plan = out._jdf.queryExecution().analyzed().toString()
    assert "isnull(doc_id" in plan  # rows without doc_id go round the cogroup
    got = Counter((r.doc_id, r.n_bytes, r.kept_text, r.kept_sha256 == hashlib.sha256(r.kept_text.encode()).hexdigest(), r.carried_lang) for r in out.collect())
    kept = [(1, first, first), (2, first, ""), (2, other, other[60:]), (3, other, ""), (None, first, first), (None, "", ""), (big, first, ""),
            (-1, "short", "short"), (-5, other[:60], other[:60])]
    assert got == Counter((i, len(x), y, True, "en") for i, x, y in kept)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", min_size=1, max_size=30), min_size=1, max_size=6), st.lists(st.text("abc", min_size=1, max_size=30), min_size=1, max_size=4))
def test_run_index_finds_smallest_owner(texts, queries):
    pack = lambda xs: (np.frombuffer("".join(xs).encode(), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in xs])]))
    buf, bounds = pack(texts)
    q, ends = pack(queries)
    got = RunIndex(buf, bounds, np.arange(len(texts)), 4).owners(q, ends, 99)
    for x, a in zip(queries, ends):
        for j in range(len(x)):
            want = min((i for i, y in enumerate(texts) if len(x) - j >= 4 and x[j:j + 4] in y), default=99)
            assert got[a + j] == want


# op6
def test_packing_round_trip(spark):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    texts = ODD + ["Ein Satz. Noch einer!\n\n b  c \n d 12.5% c_d's I'll", "日本語 ½ text\x1cx", " lead", "tail ", "<|endoftext|>"]
    rows = packing.pack(docs_of(spark, texts)).collect()
    ids = {i: np.array(tokenizer.encode(x or "", add_special_tokens=False).ids + [1], np.uint32) for i, x in enumerate(texts)}
    held = defaultdict(list)
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes()) and r.doc_tokens == len(ids[r.doc_id])
        held[r.sequence_id].append((r.offset, r.length))
    assert sum(r.length for r in rows) == sum(map(len, ids.values()))
    for pieces in held.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY


def test_packing_matches_added_tokens(spark, tmp_path):
    """The queries take the ids that the tokenizer gives by default."""
    from corpus_pipeline import STAGES
    from duelframe.llm.queries import QUERIES
    from public_tokenizers import path
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path("byte_bpe_50k.json"))
    texts = ODD + ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>x", "x<|endoftext|>  \n y ",
                   "日本<|endoftext|>語\n\n", "<|endoftext|", "w " * 5000 + "<|endoftext|>" + "é " * 5000, "<|<|endoftext|>|>"]
    assert tokenizer.encode(texts[len(ODD)], add_special_tokens=False).ids == [64, 220, 50256, 275]
    docs = docs_of(spark, texts)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    ids = {i: np.array(tokenizer.encode(x or "", add_special_tokens=False).ids + [1], np.uint32) for i, x in enumerate(texts)}
    for rows in (QUERIES["op6_packing"](spark, str(tmp_path)).collect(), dict(STAGES)["packing"](spark, docs, str(tmp_path)).collect()):
        assert sum(r.length for r in rows) == sum(map(len, ids.values()))
        for r in rows:
            assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes()) and r.doc_tokens == len(ids[r.doc_id])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 9), st.sampled_from([0, 3, 7])), min_size=1, max_size=12))
def test_cuts_are_the_cheapest(steps):
    places, penalties = np.cumsum([s for s, _ in steps]).tolist(), [p for _, p in steps]
    cost = {0: 0}
    for j, p in zip(places, penalties):
        cost[j] = min(c + 10 + p for i, c in cost.items() if j - i <= 10)
    cuts = packing.best_cuts(places, penalties, 10)
    assert cuts[-1] == places[-1] and all(b - a <= 10 for a, b in zip([0, *cuts], cuts))
    assert sum(10 + penalties[places.index(c)] for c in cuts) == cost[places[-1]]


# op7
def test_shards_are_even_and_keep_groups(spark):
    texts = ODD + [f"text {i // 3}" for i in range(600)] + ["hot"] * 300
    rows = sharding.shard_documents(spark, docs_of(spark, texts)).collect()
    sizes = Counter(r.shard for r in rows)
    assert set(sizes) == set(range(40)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard, n in sizes.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(n))
    by = defaultdict(set)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert r.size == len(raw) + 16 and r.text_crc32 == zlib.crc32(raw)
        by[texts[r.doc_id]].add(r.shard)
    assert sum(len(by[f"text {i}"]) == 1 for i in range(200)) > 150 and len(by["hot"]) < 40
    assert sharding.shard_documents(spark, docs_of(spark, [])).count() == 0


# op8
def test_resampling_is_exact_and_prefers_the_target(spark):
    texts = ["good clean prose here"] * 50 + ["### $$$ junk ###"] * 50 + [None, ""]
    docs = docs_of(spark, texts)
    rows = resampling.resample(spark, docs, docs.where("doc_id < 40").select("doc_id"), 0.5).collect()
    assert sum(r.selected for r in rows) == 51
    assert min(r.key for r in rows if r.selected) >= max(r.key for r in rows if not r.selected)
    assert sum(r.selected for r in rows if r.doc_id < 50) > 45
    assert resampling.resample(spark, docs.limit(0), docs.limit(0).select("doc_id"), 0.5).count() == 0


# op9
def test_decontamination_equals_brute_force(spark):
    rng = np.random.default_rng(8)
    vocabulary = [f"v{i}" for i in range(3000)]
    say = lambda n: " ".join(rng.choice(vocabulary, n))
    items = [f"{say(20)}. {say(9)}." for _ in range(30)] + [None, "", "tiny item here"]
    texts = [say(300) for _ in range(20)] + [f"{say(150)}\n{items[k].upper()}%%% {say(100)}" for k in range(30)] + ODD + ["a Tiny, item here!"]
    texts += [f"{say(40)} {items[3].split('.')[0]}. {say(40)}"]  # the question without its answer
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = decontaminate.find(spark, docs_of(spark, texts), bench).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(20 + k, k) for k in range(30)} | {(50 + len(ODD), 32)}
    clean = decontaminate.clean(spark, docs_of(spark, texts), bench)
    assert clean.count() == len(texts) - 31 and clean.columns == docs_of(spark, []).columns
    assert decontaminate.find(spark, docs_of(spark, texts), bench.limit(0)).count() == 0


def plain_bm25(texts, items):
    """(text, item) to its best passage score, and the items' thresholds, item by item and passage by passage."""
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    words = lambda x: re.findall(r"[^\x00-\x20!-/:-@\[-`{-~\x7f]+", (x or "").translate(low))
    bags = [Counter(words(x)) for x in items]
    n, mean = sum(bool(b) for b in bags), sum(b.total() for b in bags) / max(1, sum(bool(b) for b in bags))
    df = Counter(w for b in bags for w in b)
    impact = [{w: np.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * b.total() / mean)) for w, tf in b.items()} for b in bags]
    least = [0.6 * sum(i.values()) * min(1, 64 / max(1, b.total())) for i, b in zip(impact, bags)]
    best = {}
    for d, x in enumerate(texts):
        w = words(x)
        for p in range(0, len(w), 64):
            passage = set(w[p:p + 128])
            for k, i in enumerate(impact):
                score = sum(v for term, v in i.items() if term in passage)
                if i and score >= least[k]:
                    best[d, k] = max(best.get((d, k), 0.0), score)
    return best


def test_retrieval_equals_exhaustive_bm25_in_any_grouping(spark, monkeypatch):
    rng = np.random.default_rng(9)
    vocabulary = np.array([f"v{i}" for i in range(400)])
    weight = 1 / np.arange(1, 401)
    say = lambda n: rng.choice(vocabulary, n, p=weight / weight.sum()).tolist()
    items = [" ".join(say(rng.integers(3, 90))) for _ in range(60)] + [None, "", "v1 v1 v2"]
    texts = []
    for k in range(60):  # items with a part of their words replaced, between other words
        edited = [w if rng.random() > 0.3 * (k % 3) else f"new{rng.integers(99)}" for w in items[k].split()]
        texts.append(" ".join(say(int(rng.integers(0, 200))) + edited + say(int(rng.integers(0, 200)))))
    texts += [None, "", "v1"]
    want = plain_bm25(texts, items)
    bench = spark.createDataFrame([*enumerate(items), (None, "v5 v6 v7")], "item_id long, text string")
    raw = [(x or "").encode() for x in texts]
    low = decontaminate.t.LOWER[np.frombuffer(b"".join(raw), np.uint8)]
    words = decontaminate.t.Words(low, np.concatenate([[0], np.cumsum([len(x) for x in raw])]), decontaminate.t.IS_MARK)
    hashes = decontaminate.t.RangeHash(low)(words.starts, words.ends)
    assert len(want) > 100
    for group in (4096, 7):
        monkeypatch.setattr(decontaminate, "GROUP", group)
        got = {}
        for index in decontaminate._groups(spark, bench):
            got |= {(d, index.items[k].item_id): x for (d, k), x in decontaminate.search(index, hashes, words.bounds).items()}
        assert got.keys() == want.keys()
        assert all(abs(got[k] - want[k]) < 1e-3 * want[k] for k in want)


# op10
def test_toxicity(spark):
    rng = np.random.default_rng(4)
    calm = [" ".join(rng.choice([f"n{chr(97 + i)}{chr(97 + j)}o" for i in range(26) for j in range(20)], 60)) for _ in range(400)]
    texts = [x + (" you moron idiot" if i % 5 == 0 else "") for i, x in enumerate(calm)]
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(400)] + [(400, None)], "doc_id long, toxic int")
    model = toxicity.train(docs_of(spark, texts), labels)
    probe = [calm[1] + " m0r0n іdiot", calm[2], None, "", "MORON"]
    got = {r.doc_id: r for r in toxicity.score(docs_of(spark, probe), model).collect()}
    assert [got[i].predicted for i in range(5)] == [1, 0, 0, 0, 1] and all(0 <= r.score <= 1 for r in got.values())
    model.exceptions = [toxicity.fold("idiot savant")]
    assert not toxicity.hits(model.automaton(), toxicity.fold("an idiot savant"))
    empty = toxicity.train(docs_of(spark, texts), labels.limit(0))
    assert toxicity.score(docs_of(spark, probe), empty).where("predicted = 1").count() == 0


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(100, 101), (101, 102), (7, 7)], "a long, b long")
    got = storage.components(spark, edges, storage.Stored(spark, "test")).collect()
    assert {(r.node, r.component) for r in got} == {(i, 0) for i in range(31)} | {(i, 100) for i in (100, 101, 102)}


def test_components_of_small_tables_take_few_tasks(spark):
    conf = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    files = []

    class Watched(storage.Stored):
        def save(self, df):
            out = super().save(df)
            files.append(len(out.inputFiles()))
            return out

    edges = spark.createDataFrame([(10 * i, 10 * i + k) for i in range(100) for k in (1, 2, 3)], "a long, b long")
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = storage.components(spark, edges, Watched(spark, "test")).collect()
        assert {(r.node, r.component) for r in got} == {(10 * i + k, 10 * i) for i in range(100) for k in range(4)}
        assert max(files) <= 4
        # More rows than the shuffle's tasks hold keep all of these.
        assert storage.few_tasks(edges.repartition("a"), 300, 1).rdd.getNumPartitions() == 64
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_texts_outside_of_groups_are_not_shuffled(spark, monkeypatch):
    family = " ".join(f"w{k}" for k in range(60))
    docs = docs_of(spark, [family, family + " x", family, *(f"other text number {i} of its own kind {i * i}" for i in range(20)), None])
    whole = sorted(r.doc_id for r in near_dedup.keep_one(spark, docs).collect())
    assert whole == [0, *range(3, 24)]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        kept = near_dedup.keep_one(spark, docs)
        assert "BroadcastHashJoin LeftAnti" in kept._sc._jvm.PythonSQLUtils.explainString(kept._jdf.queryExecution(), "formatted")
        assert sorted(r.doc_id for r in kept.collect()) == whole
        monkeypatch.setattr(near_dedup, "SENT_IDS", 0)
        assert sorted(r.doc_id for r in near_dedup.keep_one(spark, docs).collect()) == whole
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("packed", [1, 1 << 20])
def test_packed_documents_are_whole_and_smaller(monkeypatch, packed):
    monkeypatch.setattr(suffix_dedup, "PACKED", packed)
    n = 3000
    rows = pa.table({"doc_id": pa.array(range(n)), "text": [None if i % 7 == 0 else f"some words of text {i % 11} " * 20 for i in range(n)],
                     "block": pa.array([(i * 37 % n) // 512 for i in range(n)]), "carried_lang": pa.array([None if i % 3 else "en" for i in range(n)])})
    out = [b for b in suffix_dedup._packs(iter(rows.to_batches(max_chunksize=700)))]
    table = pa.Table.from_batches(out)
    assert table.nbytes < rows.nbytes / 4
    got = []
    for block in set(table.column("block").to_pylist()):
        part = suffix_dedup._unpack(table.filter(pc.equal(table.column("block"), block)))
        assert part.schema == rows.schema and set(part.column("block").to_pylist()) == {block}
        got += part.to_pylist()
    assert sorted(got, key=lambda r: r["doc_id"]) == rows.to_pylist()


@pytest.mark.parametrize("keys", [[], [0], [7, 7, 2**32 - 1, 0, 5], sorted(hash((i, "k")) % 2**32 for i in range(5000))])
def test_packed_keys_are_whole(keys):
    keys = np.array(keys, np.uint32)
    blob = suffix_dedup._packed_keys(keys)
    back = suffix_dedup._unpacked_keys(blob)
    assert back.dtype == np.uint32 and back.tolist() == keys.tolist()
    assert len(keys) < 5000 or len(blob) < 0.8 * keys.nbytes


def repeats_over_blocks(blocks):
    """Three documents in each block, the first one far below zero: their own words, parts of one passage, near copies of it."""
    rng = np.random.default_rng(3)
    words = [f"w{rng.integers(10**6)}" for _ in range(200)]
    texts = []
    for i in range(3 * blocks):
        some = words[rng.integers(150):][:60]
        some[rng.integers(len(some))] = f"new{i % 5}"
        texts.append(f"{i} {' '.join(some)} {i * i} " + " ".join(words[(i * 7) % 90:][:90]) + "é" * (i % 3))
    ids = [(i // 3 - blocks // 2) * suffix_dedup.BLOCK_DOCS + i % 3 * 200 for i in range(3 * blocks)]
    return ids, texts, [(ids[i], *rest) for i, *rest in brute_repeats(texts)]


@pytest.mark.parametrize("hot, hot_docs", [(256, 1 << 17), (2, 1 << 17), (256, 5)])
def test_stretches_of_many_blocks_are_matched_whole(monkeypatch, hot, hot_docs):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "HOT_DOCS", hot_docs)
    parts = 16
    ids, texts, want = repeats_over_blocks(20)
    docs = pa.table({"doc_id": pa.array(ids), "text": texts, "block": pa.array([i // suffix_dedup.BLOCK_DOCS for i in ids])})
    keys = [pa.Table.from_batches(suffix_dedup._block_keys(parts)(iter(docs.slice(at, 6).to_batches()))) for at in range(0, len(ids), 6)]
    shared = pa.Table.from_batches(suffix_dedup._shared_keys(iter(pa.concat_tables(keys).to_batches())))
    none = pa.nulls(len(shared))
    shared = shared.append_column("copy", none.cast(pa.int64())).append_column("digest", none.cast(pa.binary()))
    one = lambda x, block: x.filter(pc.equal(x.column("block"), block))
    blocks = sorted(set(docs.column("block").to_pylist()))
    sent = pa.concat_tables([suffix_dedup._send_stretches(parts)(one(docs, b), one(shared, b)) for b in blocks])
    buckets = sorted(set(sent.column("bucket").to_pylist()))
    answers = [pa.Table.from_batches(out) for b in buckets
               if (out := list(suffix_dedup._match(iter(sent.filter(pc.equal(sent.column("bucket"), b)).to_batches()))))]
    assert all(len(set(x.column("block").to_pylist())) == len(x) for x in answers)
    answers = pa.concat_tables([*answers, shared.select(["block", "bucket", "hot", "copy", "digest"])], promote_options="default")
    got = pa.concat_tables([suffix_dedup._remove(parts, [])(one(docs, b), one(answers, b)) for b in blocks]).to_pylist()
    assert sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == want


def test_stretches_and_answers_take_few_rows(spark):
    ids, texts, want = repeats_over_blocks(40)
    old = {x: spark.conf.get(x) for x in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "6")
        out = suffix_dedup.remove_repeats(spark, spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string"))
        assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out.collect()) == want
        todo, rows = [out._jdf.queryExecution().executedPlan()], []
        while todo:
            node = todo.pop()
            todo += [node.children().apply(i) for i in range(node.children().size())]
            if node.nodeName() == "Exchange":
                rows.append(node.metrics().apply("shuffleRecordsWritten").value())
        assert len(rows) >= 4 and max(rows) <= 2 * 40 * 6  # a row for each block and bucket at most, besides its keys
    finally:
        for x, value in old.items():
            spark.conf.set(x, value)


def test_documents_travel_once_for_stretches_and_removal(spark):
    passage = "".join(f"p{i} " for i in range(40))
    texts = [None, "", "short", *(f"{i} {passage}{i * i}" for i in range(40))]
    old = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        out = suffix_dedup.remove_repeats(spark, docs_of(spark, texts), carry=True)
        plan = out._sc._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted")
        assert re.search(r"\(\d+\) ReusedExchange \[Reuses operator id: \d+\]\nOutput \[\d+\]: \[.*docs#\d+\]", plan)
        assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out.collect()) == brute_repeats(texts)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def test_pipeline(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = storage.documents(spark, sf)
    counts = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = storage.Stored(spark, "test").save(stage(spark, docs, sf))
        assert docs.columns == storage.documents(spark, sf).columns, name
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0
    pieces = corpus_pipeline.packing_stage(spark, docs, sf)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()}


# Inputs that once ended a job or gave a wrong answer.
def test_odd_arguments_are_invalid(spark):
    deep = "[" * 100_000 + "]" * 100_000
    bad = ['{"a": 1e400}', '{"a": Infinity}', '{"a": -Infinity}', '{"a": NaN}', '{"a": "\\ud800"}', f'{{"a": {deep}}}', '{"a": true}', '{"a": 1.5}', "[]", "", None]
    good = ['{"a": 1}', '{"a": 1.0}', '{"a": 3}']
    rows = [(1, f"c{i:02d}", None, "f", x, i) for i, x in enumerate(bad + good)]
    calls = spark.createDataFrame(rows, "conv_id long, call_id string, parent_id string, name string, arguments string, turn long")
    results = spark.createDataFrame([(1, r[1], "r", 99) for r in rows], "conv_id long, call_id string, content string, turn long")
    schema = {"f": {"type": "object", "properties": {"a": {"type": "integer", "enum": [1, 3, [True, {"x": 1}]]}}}}
    got = {r.call_id: r for r in tool_calls.link_calls(spark, calls, results, schema).collect()}
    assert [got[r[1]].status for r in rows] == ["invalid_arguments"] * len(bad) + ["ok"] * len(good)

    def strict(x):
        raise AssertionError(x)

    for r in got.values():
        message = json.loads(r.message, parse_constant=strict)
        assert list(message) == sorted(message) and message["id"] == r.call_id
    assert tool_calls.same([1, {"a": 2.0}], [1.0, {"a": 2}]) and not tool_calls.same([1], [True]) and not tool_calls.same(0, False)


def test_calls_without_id_follow_their_parent(spark):
    schema = "conv_id long, call_id string, parent_id string, name string, arguments string, turn long"
    calls = spark.createDataFrame([(1, "a", None, "f", "{}", 0), (1, "b", "a", "f", "{}", 1), (1, None, "b", "f", "{}", 2), (1, None, "nobody", "f", "{}", 3),
                                   (1, None, None, "f", "{}", 4), (1, "x", "y", "f", "{}", 5), (1, "y", "x", "f", "{}", 6), (1, None, "x", "f", "{}", 7),
                                   (None, None, "a", "f", "{}", 8)], schema)
    results = spark.createDataFrame([], "conv_id long, call_id string, content string, turn long")
    got = {r.turn: (r.status, r.depth) for r in tool_calls.link_calls(spark, calls, results, {"f": {}}).collect()}
    assert got == {0: ("missing_result", 0), 1: ("missing_result", 1), 2: ("missing_result", 2), 3: ("bad_parent", None), 4: ("missing_result", 0),
                   5: ("cycle", None), 6: ("cycle", None), 7: ("cycle", None), 8: ("bad_parent", None)}


def test_texts_without_letters_have_no_language(spark):
    texts = ["×", "÷ ÷", "。。。", "٣٤٥", "12 + 3", "", None, "é", "漢", "le chat"]
    model = language.train(spark.createDataFrame([("the cat is here", "en"), ("le chat est là", "fr")], "text string, lang string"))
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(docs_of(spark, texts), model).collect()}
    assert [got[i][0] == "und" for i in range(len(texts))] == [True] * 7 + [False] * 3
    assert all(got[i][1] == 0.0 for i in range(7))


def test_other_label_values_are_left_out(spark):
    docs = docs_of(spark, [f"clean words number {i} here" for i in range(60)] + [f"vile filth number {i} here" for i in range(60)] + ["more"] * 3)
    labels = [(i, int(i >= 60)) for i in range(120)]
    odd = [(120, 2), (121, -1), (122, None), (None, 1)]
    models = [toxicity.train(docs, spark.createDataFrame(x, "doc_id long, toxic int")) for x in (labels, labels + odd)]
    assert models[0] == models[1] and " viie " in models[0].entries  # l and i fold alike
