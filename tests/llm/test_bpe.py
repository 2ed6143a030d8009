import hashlib
import random
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from riskloom.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return np.array(library.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(), st.text(alphabet="ab '\n\t1.é…　s\0<|>")), max_size=5))
def test_encoding_equals_library(texts):
    library = Tokenizer.from_file(PATH)
    encoder = bpe.byte_bpe(PATH)
    assert encoder.encode_batch(texts) == [ids_of(library, t) for t in texts]


def test_no_token_crosses_a_cut(library):
    encoder = bpe.byte_bpe(PATH)
    data = ("The cats' 12 homes, … naïve\t\tx " * 20).encode()
    ends = set(np.cumsum([len(encoder.bytes_of[i]) for i in library.encode(data.decode()).ids]).tolist())
    cuts = encoder.boundaries(data).tolist()
    assert cuts and set(cuts) <= ends


def test_a_full_cache_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_FRAGMENTS", 3)
    encoder = bpe.ByteBpe(PATH)
    texts = [f"some words number {n} here" for n in range(50)]
    assert [encoder.encode_batch([t])[0] for t in texts] == [ids_of(library, t) for t in texts]


def test_special_strings(library):
    assert bpe.byte_bpe(PATH).encode_batch(["a<|endoftext|>"])[0] == ids_of(library, "a<|endoftext|>")
    plain = np.frombuffer(bpe.byte_bpe(PATH, special=False).encode_batch(["<|endoftext|>"])[0], "<u4")
    assert 50256 not in plain.tolist()


def test_bytes_that_are_no_text_are_replaced(library):
    encoder = bpe.byte_bpe(PATH)
    half = encoder.encode_batch(["é"])[0][:4]
    lone = [i for i, b in enumerate(encoder.bytes_of) if b == b"\xc3"]
    assert encoder.decode(np.array(lone, "<u4").tobytes()).decode() == library.decode(lone, skip_special_tokens=False)
    assert encoder.decode(half) == "é".encode()


def test_round_trip_of_odd_rows(documents, odd_rows, library):
    got = bpe.round_trip(documents(odd_rows)).collect()
    want = []
    for key, text in odd_rows:
        ids = ids_of(library, text)
        back = (text or "").encode()
        want.append((key, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back).hexdigest()))
    order = lambda r: (r[0] is None, r)
    assert sorted(map(tuple, got), key=lambda r: str(order(r))) == sorted(want, key=lambda r: str(order(r)))


def test_encode_then_decode(documents, odd_rows):
    rows = [r for r in odd_rows if r[0] is not None]
    back = bpe.decode_documents(bpe.encode_documents(documents(rows))).collect()
    assert sorted(map(tuple, back)) == sorted((i, t or "") for i, t in rows)


def test_empty_table(documents):
    assert bpe.round_trip(documents([])).collect() == []


def test_memory_of_texts_full_of_new_fragments():
    """Texts of many unlike words, as a long-lived worker meets them."""
    rng = random.Random(1)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=4))
    texts = pa.array([" ".join(word() for _ in range(4000)) for _ in range(400)])
    encoder = bpe.ByteBpe(PATH)
    tracemalloc.start()
    try:
        for _, part in bpe.text_batches(pa.RecordBatch.from_arrays([texts], ["text"]), "text"):
            for _ in bpe.encoded(part, encoder):
                pass
        assert tracemalloc.get_traced_memory()[1] < 110e6
    finally:
        tracemalloc.stop()
