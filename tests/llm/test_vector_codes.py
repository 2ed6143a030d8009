import hashlib

import numpy as np
import pytest

from riskloom.llm import vector_codes
from riskloom.llm.vector_codes import BoxTree, assign

SCHEMA = "vec_id bigint, embedding array<float>, label string, id string, vec int, code int, error string"


@pytest.fixture
def vectors(make):
    return lambda rows: make([(i, v, l, "x", 1, 2, "y") for i, v, l in rows], SCHEMA)


def nearest(points, book):
    gap = points[:, None] - book[None]
    return np.argmin((gap * gap).sum(axis=2), axis=1)


def brute(rows, parts=4, rounds=4):
    """Lloyd's rounds comparing every part with every entry."""
    kept = [(i, v, l) for i, v, l in rows if v and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0))
    ints = np.array([np.floor(1024 * np.float32(v).astype(float)) for _, v, _ in kept]).astype(np.int64)
    split = np.split(ints, parts, axis=1)
    books = [x[:256].copy() for x in split]
    for _ in range(rounds):
        for x, book in zip(split, books):
            codes = nearest(x, book)
            for e in set(codes.tolist()):
                book[e] = x[codes == e].sum(axis=0) // (codes == e).sum()
    codes = [nearest(x, book) for x, book in zip(split, books)]
    errors = sum(((x - b[c]) ** 2).sum(axis=1) for x, b, c in zip(split, books, codes))
    text = ",".join(str(v) for b in books for v in b.reshape(-1).tolist())
    by_label = {}
    for (_, _, label), error in zip(kept, errors.tolist()):
        by_label[label] = by_label.get(label, 0) + error
    rows = [(i, "".join(f"{c[n]:02x}" for c in codes), int(errors[n]), by_label[l]) for n, (i, _, l) in enumerate(kept)]
    return sorted(rows, key=str), hashlib.sha256(text.encode()).hexdigest()


def found(vectors, rows):
    coded, books = vector_codes.compress(vectors(rows))
    got = vector_codes.with_label_error(coded).collect()
    return sorted([(r["vec_id"], r["code"], r["error"], r["label_error"]) for r in got], key=str), vector_codes.codebooks_digest(books)


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_assignment_equals_all_pairs(spread):
    rng = np.random.default_rng(4)
    centres = rng.integers(-900, 900, (40, 5))
    points = (centres[rng.integers(40, size=700)] + rng.normal(size=(700, 5)) * spread * 300).astype(np.int64)
    book = np.concatenate([points[:90], points[:6]])
    tree = BoxTree.build(points, 8)
    again = BoxTree.from_bytes(tree.to_bytes(), len(points), 8)
    assert all(np.array_equal(a, b) for a, b in zip(tree.sums + tree.low, again.sums + again.low))
    codes, counts, sums = assign(again, BoxTree.build(book, 1))
    want = nearest(points, book)
    assert np.array_equal(codes, want) and np.array_equal(counts, np.bincount(want, minlength=96))
    assert all(np.array_equal(sums[e], points[want == e].sum(axis=0)) for e in range(96))


def test_close_nodes_are_assigned_whole():
    """Tight groups with an entry each are settled by boxes and kept sums, without comparing their parts."""
    rng = np.random.default_rng(5)
    centres = rng.integers(-10**5, 10**5, (8, 4))
    points = np.repeat(centres, 64, axis=0) + rng.integers(-3, 4, (512, 4))
    tree = BoxTree.build(points, 8)
    tree.points = np.full_like(tree.points, 10**6)  # wrong parts: only the boxes and sums can be right
    codes, counts, sums = assign(tree, BoxTree.build(centres, 1))
    assert counts.tolist() == [64] * 8 and np.array_equal(sums[3], points[192:256].sum(axis=0))


def test_codes_equal_brute_force(vectors, monkeypatch):
    monkeypatch.setattr(vector_codes, "BLOCK_ROWS", 150)
    rng = np.random.default_rng(6)
    rows = [(int(i), rng.normal(size=8).astype(np.float32).tolist(), "abc"[i % 3] if i % 7 else None) for i in rng.permutation(900)]
    # A third of all rows share one vector.
    rows = [(i, rows[0][1] if n % 3 == 0 else v, l) for n, (i, v, l) in enumerate(rows)]
    got, digest = found(vectors, rows)
    want, want_digest = brute(rows)
    assert digest == want_digest and got == want


def test_odd_rows(vectors):
    nan, inf = float("nan"), float("inf")
    odd = [(1, None, "a"), (2, [], "a"), (3, [1.0, None, 0.0, 0.0], "a"), (4, [nan] * 4, "a"), (5, [inf] * 4, None)]
    assert found(vectors, []) == found(vectors, odd) == ([], hashlib.sha256(b"").hexdigest())
    good = [(7, [0.0] * 4, None), (7, [0.0] * 4, None), (8, [-0.5, 0.1, 2.0, -3.0], "b"), (None, [1.0, 1.0, 1.0, 1.0], "b")]
    assert found(vectors, [*odd, *good, (9, [1.0] * 8, "a")]) == brute(good)
    with pytest.raises(ValueError):
        vector_codes.compress(vectors([(1, [1.0] * 6, "a")]))
