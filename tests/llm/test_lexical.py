import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from riskloom.llm import lexical
from riskloom.session import stage

SCHEMA = "item_id bigint, text string, term string, shard bigint, score double"


def items_of(make, rows):
    return make([(i, t, "k", 1, None) for i, t in rows], SCHEMA)


def words(text):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", folded)


def brute(rows, items, k=10):
    """Every document scored for every item."""
    docs = [(i, Counter(words(t))) for i, t in rows]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    total = sum(n for _, _, n in docs)
    df = Counter(w for _, c, _ in docs for w in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(words(text))
    out = []
    for item, terms in asked.items():
        weight = {t: math.floor(1000 * math.log((2 * len(docs) + 2) / (2 * df[t] + 1))) for t in terms if df[t]}
        scores = []
        for i, c, n in docs:
            m = 100 - 90 + (90 * n * len(docs)) // total
            score = sum(w * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t, w in weight.items() if c[t])
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def found(make, documents, rows, items, k=10):
    index = stage(lexical.build_index(documents(rows).repartition(3)), "index")
    got = lexical.search(index, items_of(make, items), k).collect()
    return sorted([(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got], key=str)


@pytest.fixture
def small_shards(monkeypatch):
    monkeypatch.setattr(lexical, "SHARD_BYTES", 3000)
    monkeypatch.setattr(lexical, "PIECE_BYTES", 500)
    monkeypatch.setattr(lexical, "BLOCK", 4)


def corpus(n=400, seed=1):
    rng = random.Random(seed)
    # A few words are in most documents, and many documents are equal.
    vocabulary = [f"w{i}" for i in range(500)] + ["Thé"]
    weight = [1 / (i + 1) for i in range(501)]
    texts = [" ".join(rng.choices(vocabulary, weight, k=rng.choice([1, 5, 30, 60, 300]))) for _ in range(n)]
    return [(i, texts[0] if i % 3 == 0 else t) for i, t in enumerate(texts)]


def test_ranks_equal_brute_force(make, documents, small_shards):
    rng = random.Random(2)
    items = [(i, " ".join(f"W{rng.randrange(700) ** 2 // 1000}" for _ in range(rng.choice([1, 3, 20])))) for i in range(25)]
    for k in (1, 10):
        assert found(make, documents, corpus(), items, k) == brute(corpus(), items, k)


def test_several_searches_find_the_same(make, documents, small_shards, monkeypatch):
    items = [(i, f"w{i} w{3 * i} w{100 + i}") for i in range(20)]
    monkeypatch.setattr(lexical, "QUERY_BYTES", 200)
    assert found(make, documents, corpus(90), items) == brute(corpus(90), items)


def test_blocks_are_rejected_before_decompression():
    """A document that leads by far closes the blocks of common words elsewhere."""
    texts = [b"rare rare rare common"] + [b"common " + b"filler " * 40] * 2000
    batch = lexical._shard(0, list(range(len(texts))), texts)
    count, total = batch.column("n")[0].as_py(), batch.column("words")[0].as_py()
    rows = dict(zip(batch.column("term").to_pylist(), zip(batch.column("blocks").to_pylist(), batch.column("postings").to_pylist())))
    shard = lexical.Shard(batch.column("docs")[0], batch.column("lengths")[0], count, total)
    for term in ("rare", "common"):
        shard.add(term, *rows[term])
    best = lexical.Best(1, np.array([10]), np.array([-1]), np.array([False]))
    best.score[0] = shard.block("rare", 0)[1][0] * 5000
    shard._open.clear()
    shard.search([("rare", 5000), ("common", 10)], best)
    assert best.id.tolist() == [0] and set(shard._open) == {("rare", 0), ("common", 0)}
    assert len(shard.lists["common"][0]) == 32


def test_lists_decode_to_what_was_encoded(small_shards):
    rng = np.random.default_rng(3)
    document = np.sort(rng.choice(200_000, 900, replace=False))
    tf = rng.choice([1, 1, 1, 2, 300, 70_000], 900)
    code = np.repeat([0, 1, 2], [1, 500, 399])
    length = rng.integers(1, 9, 200_000)
    meta, blocks, data, at = lexical.encode_lists(code, document, tf, length, 3)
    shard = lexical.Shard(*(lexical.pa.array([x], lexical.pa.list_(lexical.pa.int64()))[0] for x in (np.arange(200_000), length)), 10, 10)
    for term in range(3):
        shard.add(str(term), meta[blocks[term] : blocks[term + 1]].tobytes(), data[at[term] : at[term + 1]].tobytes())
        docs, scores = shard.blocks(str(term), range(blocks[term + 1] - blocks[term]))
        assert np.array_equal(docs, document[code == term])
        assert np.array_equal(scores, lexical.impact(tf[code == term], shard.m[docs]))


def test_norms_beyond_64_bits():
    n = np.array([10**6, 5], dtype=np.int64)
    got = lexical.length_norms(n, 10**12, 10**15)
    assert got.tolist() == [10 + 90 * 10**6 * 10**12 // 10**15, 10]


def test_odd_rows(make, documents, odd_rows):
    items = [(1, None), (2, ""), (3, "!!"), (4, "word"), (5, "the cat A B 日本語"), (5, "mat"), (None, "e D"), (6, "nowhere")]
    assert found(make, documents, odd_rows, items) == brute(odd_rows, items)
    assert found(make, documents, [], items) == found(make, documents, odd_rows, []) == []
    assert found(make, documents, [(1, None), (2, "")], items) == []
