"""Byte-pair encoding by forced boundaries, and decoding.

A merge only ever makes a token of the vocabulary. Two neighbouring bytes that
stand side by side in no token can therefore never end up in one token: the
text may be cut between them, and the fragments encoded apart give the ids of
the whole. A table over all 65,536 byte pairs finds the cuts of a text at once.

The tokenizer splits a text by a pattern before it merges, so a cut must also
leave that splitting alone. It does unless white space stands before the cut
(the pattern looks ahead behind white space), an apostrophe after it (which
might open a contraction), or the cut halves a character; such pairs are no cuts.

Fragments are short and repeat, so each is encoded once and then looked up.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import bounded_batches, public_vocabulary

#: Fragments a worker keeps. Beyond it the worker starts afresh; results do not change.
CACHE_FRAGMENTS = 200_000

# Letters below this one have been letters in every version of the character tables.
_STABLE = "\u0530"

# White space ends with one of these bytes, in ASCII or in the last byte of a
# longer character.
_AFTER_SPACE = [*range(9, 14), *range(28, 33), *range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]


def byte_characters() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary.

    Printable bytes stand for themselves; the others are numbered from U+0100.
    """
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {chr(b): b for b in printable}
    others = (b for b in range(256) if b not in set(printable))
    return shown | {chr(256 + n): b for n, b in enumerate(others)}


_MIX = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64
)

#: Fragments up to this many bytes are compared as 8-byte words.
_WORD_BYTES = 32


def _distinct(data: bytes, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of each fragment's kind, and one fragment of each kind.

    Fragments are sorted by a mix of their bytes and told apart by the bytes
    themselves; two kinds may then hold the same bytes, but never one kind two.
    """
    words = np.ndarray((len(data) + 1,), dtype="<u8", buffer=data + bytes(_WORD_BYTES), strides=(1,))
    kind = np.zeros(len(starts), dtype=np.int64)
    firsts: list[np.ndarray] = []
    found = 0
    for low, high in ((0, 8), (8, 16), (16, _WORD_BYTES)):
        rows = np.flatnonzero((lengths > low) & (lengths <= high))
        if not len(rows):
            continue
        begin, size = starts[rows], lengths[rows]
        columns = [size.astype(np.uint64)]
        for k in range(high // 8):
            spare = np.clip(8 * (k + 1) - size, 0, 8)
            inside = spare < 8
            word = words[np.where(inside, begin + 8 * k, 0)]
            bits = (np.where(inside, spare, 0) * 8).astype(np.uint64)
            columns.append(np.where(inside, word & (np.uint64(0xFFFFFFFFFFFFFFFF) >> bits), 0))
        mixed = columns[0] * _MIX[3]
        for k, column in enumerate(columns[1:]):
            mixed = (mixed ^ column) * _MIX[k]
            mixed ^= mixed >> np.uint64(29)
        order = np.argsort(mixed)
        new = np.ones(len(rows), dtype=bool)
        new[1:] = False
        for column in columns:
            placed = column[order]
            new[1:] |= placed[1:] != placed[:-1]
        number = np.cumsum(new) - 1 + found
        kind[rows[order]] = number
        firsts.append(rows[order[new]])
        found += len(firsts[-1])
    long = np.flatnonzero(lengths > _WORD_BYTES)
    kind[long] = found + np.arange(len(long))
    return kind, np.concatenate([*firsts, long])


class ByteBpe:
    """Encoder and decoder of one byte-level vocabulary file."""

    def __init__(self, vocabulary: str, special: bool = True):
        """``special``: a special token's string in a text becomes that token."""
        with open(vocabulary, encoding="utf-8") as file:
            spec = json.load(file)
        self._library = Tokenizer.from_file(vocabulary)
        self._library.no_truncation()
        self._library.no_padding()
        self._library.encode_special_tokens = True
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for token in spec["added_tokens"]:
            if token["lstrip"] or token["rstrip"] or token["single_word"] or not token["special"]:
                raise ValueError(f"added token {token['content']!r} changes its surroundings")
        self._added = added if special else {}
        by_length = sorted(map(re.escape, self._added), key=len, reverse=True)
        self._split = re.compile(f"({'|'.join(by_length)})") if by_length else None
        value = byte_characters()
        self._byte_names = {b: ord(c) for c, b in value.items()}
        tokens = {i: bytes(value[c] for c in t) for t, i in spec["model"]["vocab"].items() if t not in added}
        tokens |= {i: t.encode() for t, i in added.items()}
        self.size = max(tokens) + 1
        self.bytes_of = [tokens.get(i, b"") for i in range(self.size)]
        self.cuts = self._cut_table(tokens[i] for i in tokens if i not in added.values())
        self._kept: dict[bytes, bytes] = {}

    @staticmethod
    def _cut_table(tokens: Iterator[bytes]) -> np.ndarray:
        """For each byte pair, as ``256 * first + second``, whether it forces a usable cut."""
        table = np.ones((256, 256), dtype=bool)
        for token in tokens:
            for a, b in zip(token, token[1:]):
                table[a, b] = False
        table[_AFTER_SPACE, :] = False
        table[:, 0x80:0xC0] = False
        table[:, ord("'")] = False
        return table.reshape(-1)

    def boundaries(self, data: bytes) -> np.ndarray:
        """Every place in ``data`` where it may be cut, its start and end left out."""
        codes = np.frombuffer(data, dtype=np.uint8).astype(np.uint16)
        return np.flatnonzero(self.cuts[codes[:-1] << 8 | codes[1:]]) + 1

    def _learn(self, fragments: list[bytes]) -> None:
        """Encode fragments not met before with the library and keep their ids."""
        rest, kept, tokenize, names = [], self._kept, self._library.model.tokenize, self._byte_names
        for fragment in fragments:
            text = fragment.decode()
            # A run of common letters, with or without a space before it, is one
            # piece of the pattern, so the merges apply to it as it stands.
            letters = text[1:] if text[0] == " " else text
            if letters.isalpha() and (letters.isascii() or max(letters) < _STABLE):
                named = fragment.decode("latin-1").translate(names)
                kept[fragment] = array("I", [token.id for token in tokenize(named)]).tobytes()
            else:
                rest.append(fragment)
        found = self._library.encode_batch_fast([f.decode() for f in rest], add_special_tokens=False)
        for fragment, encoding in zip(rest, found):
            kept[fragment] = array("I", encoding.ids).tobytes()

    def _encode_parts(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all parts on end, and how many ids each part has."""
        data = b"".join(parts)
        sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
        edges = np.concatenate([[0], np.cumsum(sizes)])
        if not data:
            return np.zeros(0, "<u4"), np.zeros(len(parts), np.int64)
        mark = np.zeros(len(data) + 1, dtype=bool)
        mark[self.boundaries(data)] = True
        mark[edges] = True
        at = np.flatnonzero(mark)
        starts, lengths = at[:-1], np.diff(at)
        kind, first = _distinct(data, starts, lengths)
        kept = self._kept
        begin, size = starts[first].tolist(), lengths[first].tolist()
        names = [data[i : i + n] for i, n in zip(begin, size)]
        self._learn([name for name in names if name not in kept])
        ids = [kept[name] for name in names]
        if len(kept) > CACHE_FRAGMENTS:
            self._kept = {}
        flat = np.frombuffer(b"".join(ids), dtype="<u4")
        count = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
        each = count[kind]
        source = (np.cumsum(count) - count)[kind]
        ends = np.cumsum(each)
        out = flat[np.repeat(source - (ends - each), each) + np.arange(ends[-1])]
        upto = np.concatenate([[0], ends])[np.searchsorted(at, edges)]
        return out, np.diff(upto)

    def encode_batch(self, texts: Sequence[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; null counts as empty."""
        parts: list[bytes] = []
        owner: list[tuple[int, bytes | None]] = []
        for row, text in enumerate(texts):
            if text and self._split and any(t in text for t in self._added):
                for piece in self._split.split(text):
                    known = self._added.get(piece)
                    owner.append((row, None if known is None else np.array([known], "<u4").tobytes()))
                    parts.append(b"" if known is not None else piece.encode())
            else:
                owner.append((row, None))
                parts.append((text or "").encode())
        ids, counts = self._encode_parts(parts)
        ends = (np.cumsum(counts) * 4).tolist()
        packed = memoryview(ids.tobytes())
        if len(parts) == len(texts):
            return [bytes(packed[i:j]) for i, j in zip([0, *ends[:-1]], ends)]
        out: list[list[bytes]] = [[] for _ in texts]
        for (row, token), i, j in zip(owner, [0, *ends[:-1]], ends):
            out[row].append(token or bytes(packed[i:j]))
        return [b"".join(pieces) for pieces in out]

    def decode(self, ids: bytes) -> bytes:
        """The text of little-endian unsigned 32-bit ids, special tokens kept, in UTF-8.

        Bytes that are no UTF-8 become the replacement character.
        """
        table = self.bytes_of
        data = b"".join([table[i] for i in np.frombuffer(ids, dtype="<u4").tolist()])
        return data.decode("utf-8", errors="replace").encode()


@lru_cache(maxsize=4)
def byte_bpe(vocabulary: str, special: bool = True) -> ByteBpe:
    """The encoder of this worker process."""
    return ByteBpe(vocabulary, special)


#: Texts are encoded this many characters at a time, so that fragments of a batch stay few.
_CHUNK_CHARS = 1 << 20


def encoded(texts: Sequence[str | None], bpe: ByteBpe) -> Iterator[bytes]:
    """Ids of each text in turn, holding the fragments of about ``_CHUNK_CHARS`` characters."""
    held: list[str | None] = []
    size = 0
    for text in texts:
        held.append(text)
        size += len(text or "")
        if size >= _CHUNK_CHARS:
            yield from bpe.encode_batch(held)
            held, size = [], 0
    yield from bpe.encode_batch(held)


def text_batches(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, list[str | None]]]:
    """Runs of ``column``'s texts with their first row, a small part of the batch at a time."""
    step = max(1, int(batch.num_rows * _CHUNK_CHARS // max(1, batch.column(column).nbytes)))
    for at in range(0, batch.num_rows, step):
        yield at, batch.column(column).slice(at, step).to_pylist()


def encode_documents(
    documents: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None
) -> DataFrame:
    """Token ids of every text: (key, n_tokens, ids), ids as little-endian unsigned 32-bit.

    A null or empty text has no ids; rows with equal keys stay rows of their
    own; other columns, whatever their names, are left out. An empty table
    gives an empty result.
    """
    vocabulary = vocabulary or public_vocabulary()
    bounded_batches(documents.sparkSession)
    kind = documents.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(vocabulary)
        for batch in batches:
            for at, texts in text_batches(batch, "_text"):
                ids = list(encoded(texts, bpe))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_key").slice(at, len(texts)),
                        pa.array([len(i) // 4 for i in ids], pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    ["key", "n_tokens", "ids"],
                )

    narrow = documents.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    out = narrow.mapInArrow(run, f"key {kind}, n_tokens bigint, ids binary")
    return out.withColumnRenamed("key", key)


def decode_documents(
    encoded_rows: DataFrame, key: str = "doc_id", ids: str = "ids", vocabulary: str | None = None
) -> DataFrame:
    """Texts of token ids: (key, text). Null ids give an empty text."""
    vocabulary = vocabulary or public_vocabulary()
    bounded_batches(encoded_rows.sparkSession)
    kind = encoded_rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(vocabulary)
        for batch in batches:
            texts = [bpe.decode(i or b"").decode() for i in batch.column("_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_key"), pa.array(texts, pa.string())], ["key", "text"]
            )

    narrow = encoded_rows.select(F.col(key).alias("_key"), F.col(ids).alias("_ids"))
    return narrow.mapInArrow(run, f"key {kind}, text string").withColumnRenamed("key", key)


def round_trip(
    documents: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None
) -> DataFrame:
    """Encode and decode every text: (key, n_tokens, ids_sha256, decoded_sha256).

    Encoding and decoding follow each other in one pass, so that no ids travel.
    Edge cases are those of ``encode_documents``.
    """
    vocabulary = vocabulary or public_vocabulary()
    bounded_batches(documents.sparkSession)
    kind = documents.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(vocabulary)
        for batch in batches:
            for at, texts in text_batches(batch, "_text"):
                ids = list(encoded(texts, bpe))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_key").slice(at, len(texts)),
                        pa.array([len(i) // 4 for i in ids], pa.int64()),
                        pa.array([hashlib.sha256(i).hexdigest() for i in ids]),
                        pa.array([hashlib.sha256(bpe.decode(i)).hexdigest() for i in ids]),
                    ],
                    ["key", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    narrow = documents.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    out = narrow.mapInArrow(
        run, f"key {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
    return out.withColumnRenamed("key", key)
