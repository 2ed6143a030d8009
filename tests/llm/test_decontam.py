import random

import numpy as np
import pyarrow as pa
import pytest

from riskloom.llm import common, decontam

SCHEMA = "item_id bigint, text string, key string, score double"


def items_of(make, rows):
    return make([(i, t, "k", None) for i, t in rows], SCHEMA)


@pytest.fixture
def benchmark():
    rng = random.Random(1)
    words = [f"v{n}" for n in range(400)] + ["the", "of", "and"] * 40
    return [(n, " ".join(rng.choice(words) for _ in range(rng.choice([8, 20, 45, 64, 65, 150])))) for n in range(60)]


def test_planted_items_are_found(make, documents, benchmark):
    rng = random.Random(2)
    rows, want = [], set()
    for n in range(80):
        filler = [f"f{rng.randrange(3000)}" for _ in range(rng.choice([0, 5, 63, 64, 200, 700]))]
        if n % 2:
            item, text = rng.choice(benchmark)
            at = rng.randrange(len(filler) + 1)
            filler[at:at] = text.upper().replace(" ", "!! ").split() if n % 3 == 0 else text.split()
            want.add((n, item))
        rows.append((n, " ".join(filler)))
    got = decontam.contaminated(documents(rows), items_of(make, benchmark)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want
    assert all(r["question_overlap"] == r["answer_overlap"] == 1.0 for r in got)
    clean = {r["doc_id"] for r in decontam.without_benchmark(documents(rows), items_of(make, benchmark)).collect()}
    assert clean == {n for n, _ in rows} - {n for n, _ in want}


def test_question_without_answer_is_no_leak(make, documents, benchmark):
    item, text = next((i, t) for i, t in benchmark if len(t.split()) == 45)
    words = text.split()
    rows = [(1, " ".join(words[:31])), (2, " ".join(words[31:])), (3, text)]
    got = decontam.contaminated(documents(rows), items_of(make, [(item, text)])).collect()
    assert [r["doc_id"] for r in got] == [3]


def test_most_of_an_item_is_a_leak(make, documents, benchmark):
    """34 of 45 words verbatim, without the last quarter; a null item id stays null."""
    _, text = next((i, t) for i, t in benchmark if len(t.split()) == 45)
    rows = [(1, "before " + " ".join(text.split()[:34]) + " after"), (None, text)]
    got = decontam.contaminated(documents(rows), items_of(make, [(None, text), (7, text)])).collect()
    assert sorted(((r["doc_id"], r["item_id"]) for r in got), key=str) == [(1, 7), (1, None), (None, 7), (None, None)]


def test_a_batch_takes_bounded_memory(make, monkeypatch):
    """Postings that are looked at together are bounded, whatever passages and items share."""
    rng = random.Random(4)
    words = [f"v{n}" for n in range(60)]
    benchmark = [(n, " ".join(rng.choice(words) for _ in range(40))) for n in range(300)]
    [index] = list(decontam.build_indexes(items_of(make, benchmark)))
    texts = [" ".join(rng.choice(words) for _ in range(500)).encode() for _ in range(20)]
    whole = decontam.find_items(texts, index)
    most = []
    spread = decontam.Index._spread
    monkeypatch.setattr(decontam.Index, "_spread", staticmethod(lambda b, t: (most.append(spread(b, t)), most[-1])[1]))
    monkeypatch.setattr(decontam, "SPREAD", 50_000)
    assert decontam.find_items(texts, index) == whole
    assert len(most) > 20 and max(len(place) for place, _ in most) <= 50_000
    monkeypatch.setattr(common, "SLICE_BYTES", 5000)
    batch = pa.RecordBatch.from_arrays([pa.array([None, *(t.decode() for t in texts), ""])], ["text"])
    parts = list(common.slices(batch))
    assert len(parts) > 5 and [t for _, part in parts for t in part] == [b"", *texts, b""]
    assert [at for at, _ in parts] == np.cumsum([0, *(len(part) for _, part in parts)])[:-1].tolist()


def test_pruning_loses_nothing(make, benchmark):
    """Block maxima against scoring every segment for every passage."""
    [index] = list(decontam.build_indexes(items_of(make, benchmark)))
    rng = np.random.default_rng(3)
    passages = [np.unique(rng.integers(0, len(index.vocabulary), n)) for n in (1, 20, 60, 120, 200) for _ in range(20)]
    for n, owner in enumerate(index.owner):
        at = np.flatnonzero(index.segment == n)
        word = np.searchsorted(index.bounds, at, side="right") - 1
        passages.append(word[: max(1, len(word) * 2 // 3)])
    want = {}
    for p, terms in enumerate(passages):
        score = np.zeros(len(index.owner))
        for t in terms.tolist():
            at = slice(index.bounds[t], index.bounds[t + 1])
            score[index.segment[at]] += index.score[at]
        want |= {(p, int(s)): score[s] for s in np.flatnonzero(score >= decontam.THRESHOLD - 1e-9)}
    pairs = np.repeat(np.arange(len(passages)), [len(p) for p in passages]), np.concatenate(passages)
    got = {(p, s): v for p, s, v in index.above(*pairs, len(passages))}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_several_passes_find_the_same(make, documents, benchmark, monkeypatch):
    rows = [(n, t) for n, t in benchmark]
    key = lambda r: (r["doc_id"], r["item_id"], round(r["score"], 9))
    once = sorted(map(key, decontam.contaminated(documents(rows), items_of(make, benchmark)).collect()))
    monkeypatch.setattr(decontam, "INDEX_BYTES", 4000)
    assert sorted(map(key, decontam.contaminated(documents(rows), items_of(make, benchmark)).collect())) == once


def test_odd_rows(make, documents, odd_rows):
    odd_items = items_of(make, [(1, None), (2, ""), (3, "!!"), (4, "word"), (5, "the cat sat on the mat"), (5, None)])
    got = decontam.contaminated(documents(odd_rows), odd_items).collect()
    hits = {(r["doc_id"], r["item_id"]) for r in got}
    assert hits == {(n, 5 if t.startswith("the cat") else 4) for n, t in odd_rows if t and (t == "word" or t.startswith("the cat"))}
    assert decontam.contaminated(documents([]), odd_items).collect() == []
    assert decontam.without_benchmark(documents(odd_rows), items_of(make, [])).count() == len(odd_rows)
