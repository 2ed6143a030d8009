import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskloom.llm import ranges, token_counts
from riskloom.session import scratch_path


def test_counts_equal_the_encoder(spark, documents, odd_rows):
    path = scratch_path(spark, "flat")
    token_counts.write_flat_tokens(documents(odd_rows).repartition(3), path)
    got = token_counts.document_token_counts(spark, path).collect()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    want = [(k, len(library.encode(t or "", add_special_tokens=False).ids)) for k, t in odd_rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


@pytest.mark.parametrize("block", [2, 6, 10, 4096])
def test_blocks_of_any_size(spark, make, block):
    """Against a search in one piece; files may end without a separator."""
    rng = np.random.default_rng(1)
    files = [rng.integers(0, 4, size=n) for n in (1, 2, 57, 200)] + [np.array([3, 3, 3]), np.array([0, 1, 3])]
    path = scratch_path(spark, "raw")
    rows = make([(f"f{n}", f[:-1].astype("<u2").tobytes()) for n, f in enumerate(files)], "name string, data binary")
    # The last id of each file is written as the writer's separator.
    for n, ids in enumerate(files):
        one = rows.where(F.col("name") == f"f{n}").coalesce(1)
        ranges.write_bytes(one, "data", f"{path}/{n}", ids[-1:].astype("<u2").tobytes())
    for n, ids in enumerate(files):
        want, length = [], 0
        for i in ids.tolist():
            if i == 3:
                want, length = [*want, length], 0
            else:
                length += 1
        want += [length] if length else []
        got = token_counts.count_tokens(spark, f"{path}/{n}", end_id=3, block_bytes=block).orderBy("ordinal").collect()
        assert [r["n_tokens"] for r in got] == want
        assert [r["ordinal"] for r in got] == list(range(len(want)))


def test_empty_table(spark, documents):
    path = scratch_path(spark, "flat")
    token_counts.write_flat_tokens(documents([(1, None)]), path)
    assert [tuple(r) for r in token_counts.document_token_counts(spark, path).collect()] == [(1, 0)]
