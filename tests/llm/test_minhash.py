import random
import re
from itertools import combinations

import numpy as np
import pytest

from riskloom.llm import minhash


def shingles(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def by_hand(rows):
    """Smallest id reachable over all links, found by comparing every pair."""
    sets = {i: shingles(t) for i, t in rows}
    label = {i: i for i in sets}
    links = [
        (a, b) for a, b in combinations(sets, 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
    ]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return sorted((i, len(sets[i]), label[i], label[i] == i) for i in sets)


def edited(rng, words, changes):
    out = list(words)
    for at in rng.sample(range(len(out)), changes):
        out[at] = f"new{rng.randrange(10**6)}"
    return " ".join(out)


def corpus(seed):
    """Families of near copies around the threshold, chains, exact copies and short texts."""
    rng = random.Random(seed)
    texts = []
    for _ in range(12):
        base = [f"w{rng.randrange(500)}" for _ in range(rng.choice([6, 12, 30, 80, 300, 900]))]
        texts.append(" ".join(base))
        texts += [edited(rng, base, max(0, round(len(base) * share))) for share in (0, 0.005, 0.01, 0.015, 0.02, 0.03, 0.1)]
    chain = [f"c{n}" for n in range(200)]
    for n in range(15):
        chain = edited(rng, chain, 2).split()
        texts.append(" ".join(chain).upper())
    texts += ["same text here"] * 5 + ["one two three four five six"] * 3
    order = list(range(len(texts)))
    rng.shuffle(order)
    return [(i, t) for i, t in zip(order, texts)]


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_equal_all_pairs(documents, seed):
    rows = corpus(seed)
    got = minhash.near_duplicates(documents(rows))
    assert sorted(map(tuple, got.collect())) == by_hand(rows)


def test_classes_without_broadcast_ids(documents, monkeypatch):
    monkeypatch.setattr(minhash, "FEW_IDS", 0)
    rows = corpus(3)
    assert sorted(map(tuple, minhash.near_duplicates(documents(rows)).collect())) == by_hand(rows)


def test_large_group_of_borderline_copies(documents):
    """Many texts with a common passage, of which few reach the threshold with any one."""
    rng = random.Random(5)
    base = [f"w{n}" for n in range(150)]
    rows = [(n, edited(rng, base, rng.choice([2, 3, 4]))) for n in range(150)]
    assert sorted(map(tuple, minhash.near_duplicates(documents(rows)).collect())) == by_hand(rows)


def test_odd_rows(documents, odd_rows):
    rows = [r for r in odd_rows[:-3]]
    got = minhash.near_duplicates(documents(rows))
    assert sorted(map(tuple, got.collect())) == by_hand(rows)
    every = minhash.near_duplicates(documents(odd_rows)).collect()
    assert len(every) == len(odd_rows)
    assert all(r["component_id"] is None and r["kept"] for r in every if r["doc_id"] is None)


def test_filter_leaves_one_of_each_class(documents):
    rows = corpus(3)
    df = documents(rows)
    kept = minhash.without_near_copies(df)
    assert kept.schema == df.schema
    assert sorted(r["doc_id"] for r in kept.collect()) == [i for i, _, _, own in by_hand(rows) if own]


def test_estimate_follows_similarity():
    rng = np.random.default_rng(0)
    for share in (0.5, 0.85, 0.95):
        both = rng.integers(0, 1 << 63, 4000).astype(np.uint64)
        n = round(2000 * share * 2 / (1 + share))
        a = np.unique(np.concatenate([both[:n], both[n:2000]]))
        b = np.unique(np.concatenate([both[:n], both[2000 : 4000 - n]]))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        one, two = minhash.signatures([a, b])
        assert abs(minhash.estimate(one, two) - true) < 0.13


def test_components_of_a_path_and_a_cycle(make):
    links = [(n, n + 1) for n in range(40)] + [(100, 101), (101, 102), (102, 100), (7, 7)]
    got = dict(map(tuple, minhash.components(make(links, "a bigint, b bigint")).collect()))
    assert got == {n: 0 for n in range(1, 41)} | {101: 100, 102: 100}


def test_empty_table(documents):
    assert minhash.near_duplicates(documents([])).collect() == []
    assert minhash.without_near_copies(documents([(1, None)])).count() == 1


def test_left_over_members_settle_in_one_pass(documents, monkeypatch):
    """Whatever is borderline in a bucket, components are made anew once before and once after, also over several blocks."""
    made, compared = [], []
    components, left = minhash.components, minhash._compared
    monkeypatch.setattr(minhash, "components", lambda links: made.append(1) or components(links))
    monkeypatch.setattr(minhash, "_compared", lambda *a: compared.append(1) or left(*a))
    monkeypatch.setattr(minhash, "BLOCK", 20)
    rng = random.Random(9)
    base = [f"w{n}" for n in range(150)]
    rows = [(n, edited(rng, base, rng.choice([2, 3, 4]))) for n in range(100)]
    assert sorted(map(tuple, minhash.near_duplicates(documents(rows)).collect())) == by_hand(rows)
    assert len(made) == 2 and len(compared) == 1


def test_bands_are_moved_once(spark):
    bands = spark.createDataFrame([(7, 1), (7, 5), (7, 3), (8, 2), (9, 4), (9, 4)], "key bigint, id bigint")
    members = minhash.bucket_members(bands)
    assert sorted(map(tuple, members.collect())) == [(7, i, 1, 5, 3) for i in (1, 3, 5)]
    plan = members._jdf.queryExecution().sparkPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan


def test_only_sets_still_compared_travel(documents, monkeypatch):
    """Sets that took no part in the left-over buckets are not dealt to blocks."""
    seen = []
    left = minhash._compared
    monkeypatch.setattr(minhash, "_compared", lambda able, sets, p: seen.append((able, sets)) or left(able, sets, p))
    rows = corpus(4)
    assert sorted(map(tuple, minhash.near_duplicates(documents(rows)).collect())) == by_hand(rows)
    able, sets = seen[0]
    assert {r.id for r in sets.select("id").collect()} == {r.id for r in able.select("id").collect()}
