import random
import zlib

import numpy as np
import pytest

from riskloom.llm import toxicity

LABELS = "doc_id bigint, quality int, toxic int"


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 7))) for _ in range(400)]
    bad = ["vile", "rotten", "crétin", "zzgrob"]
    rows, labels = [], []
    for n in range(600):
        text = [rng.choice(words) for _ in range(rng.choice([20, 80, 400]))]
        toxic = n % 6 == 0
        for _ in range(max(3, len(text) // 20) if toxic else 0):
            text.insert(rng.randrange(len(text)), rng.choice(bad) + rng.choice(["", "s", "ing"]))
        rows.append((n, " ".join(text)))
        labels.append((n, 1, int(toxic)))
    return rows, labels


def test_held_out_rows_are_predicted(make, documents, corpus):
    rows, labels = corpus
    df = documents(rows)
    model = toxicity.fit(df, make(labels, LABELS))
    got = {r["doc_id"]: r for r in toxicity.score_documents(df, model).collect()}
    assert all(got[n]["held_out"] == (zlib.crc32(str(n).encode()) % 5 == 0) for n, _ in rows)
    right = [got[n]["predicted"] == y for n, _, y in labels if got[n]["held_out"]]
    assert len(right) > 80 and np.mean(right) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())
    kept = toxicity.without_toxic(df, model)
    assert kept.schema == df.schema
    assert {r["doc_id"] for r in kept.collect()} == {n for n, r in got.items() if not r["predicted"]}


def test_labels_of_held_out_rows_are_not_read(make, documents, corpus):
    rows, labels = corpus
    turned = [(n, q, 1 - y if zlib.crc32(str(n).encode()) % 5 == 0 else y) for n, q, y in labels]
    df = documents(rows)
    one = toxicity.fit(df, make(labels, LABELS))
    two = toxicity.fit(df, make(turned, LABELS))
    assert one.lexicon.stems == two.lexicon.stems and np.allclose(one.weights, two.weights)


def test_label_model_finds_accuracies_without_labels():
    rng = np.random.default_rng(0)
    hidden = rng.random(4000) < 0.2
    rates = np.array([[0.05, 0.02, 0.1, 0.05], [0.8, 0.6, 0.7, 0.9]])
    seen = (rng.random((4000, 4)) < rates[hidden.astype(int)]).astype(float)
    # A voter that only repeats another brings no new evidence.
    seen = np.concatenate([seen, seen[:, :1]], axis=1)
    posterior = toxicity.label_model(seen, seen.sum(axis=1) >= 3)
    assert np.mean((posterior >= 0.5) == hidden) > 0.95


def test_stems_are_counted_at_word_starts():
    lexicon = toxicity.Lexicon([b"vile", "crétin".encode(), b"averyverylongst"])
    texts = [toxicity.folded(t) for t in ["Vile vilest evil VILE!", None, "CRÉTIN crétins averyverylongstem", ""]]
    counts, words = lexicon.counts(texts)
    assert counts.tolist() == [[3, 0, 0], [0, 0, 0], [0, 2, 1], [0, 0, 0]] and words.tolist() == [4, 0, 3, 0]


def test_odd_rows(make, documents, odd_rows, corpus):
    model = toxicity.fit(documents(corpus[0]), make(corpus[1], LABELS))
    got = toxicity.score_documents(documents(odd_rows), model).collect()
    assert len(got) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in got)
    assert not any(r["predicted"] for r in got)


def test_without_labels_nothing_is_toxic(make, documents, odd_rows):
    for labels in ([], [(1, 1, None), (None, 1, 1), (2, 0, 1)]):
        model = toxicity.fit(documents(odd_rows), make(labels, LABELS))
        assert {r["score"] for r in toxicity.score_documents(documents(odd_rows), model).collect()} == {0.0}
    assert toxicity.score_documents(documents([]), model).collect() == []
