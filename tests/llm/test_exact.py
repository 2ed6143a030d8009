import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest

from riskloom.llm import exact


def by_hand(rows):
    groups = defaultdict(list)
    for key, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((key, text or ""))
    out = []
    for norm, some in groups.items():
        best = min(some, key=lambda r: (-len(r[1]), r[0] is None, r[0] or 0))[0]
        out += [(k, best, len(some), hashlib.sha256(norm.encode()).hexdigest()) for k, _ in some]
    return sorted(map(str, out))


def test_groups_of_odd_rows(documents, odd_rows):
    rows = [*odd_rows, *((100 + n, "many copies of this " + " " * (n % 7)) for n in range(60))]
    got = exact.exact_groups(documents(rows)).collect()
    assert sorted(str((r[0], r[1], r[2], r[4])) for r in got) == by_hand(rows)
    assert sum(r["kept"] for r in got) == len({r["text_sha256"] for r in got})
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


def test_filter_keeps_one_row_of_each_text(documents, odd_rows):
    df = documents(odd_rows)
    kept = exact.without_copies(df)
    assert kept.schema == df.schema
    norms = [re.sub(r"[\x20\x09-\x0D]", "", r["text"] or "") for r in kept.collect()]
    assert sorted(norms) == sorted({re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in odd_rows})


@pytest.mark.parametrize("n", [0, 1, 2, 1000])
def test_perfect_hash_is_minimal(n):
    digests = np.frombuffer(b"".join(hashlib.sha256(str(i).encode()).digest() for i in range(n)), "u1").reshape(-1, 32)
    made = exact.PerfectHash.build(digests)
    assert sorted(made.slots(digests).tolist()) == list(range(n))
    again = exact.PerfectHash.loads([len(b) for b in made.levels], made.dumps())
    assert again.slots(digests).tolist() == made.slots(digests).tolist()


def test_strangers_are_told_apart(documents):
    rows = exact.digest_rows(documents([(n, f"text {n}") for n in range(200)]))
    old, new = rows.where("key < 120"), rows.where("key >= 100")
    groups, found = exact.deduplicate(old, new)
    assert found.where("locator IS NOT NULL").count() == 20
    assert found.where("locator IS NULL").count() == 80
    assert groups.count() == 200


def test_repeated_digests_cannot_be_indexed():
    with pytest.raises(ValueError):
        exact.PerfectHash.build(np.zeros((2, 32), "u1"))


def test_empty_table(documents):
    assert exact.exact_groups(documents([])).collect() == []
