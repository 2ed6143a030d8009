"""Ranked lexical search by Block-Max MaxScore over a sharded inverted index.

Each shard of documents has a list for every term, in blocks of compressed
postings. A block names its largest term frequency and its shortest document,
which bound what any of its postings scores under whatever the corpus counts
turn out to be, so shards are indexed once, without looking at each other.

A task searches its shards one after the other and keeps the best documents of
every item, whose last score is the threshold. In each shard the bounds of whole
lists, added from the least, part the lists: documents found only in lists
that add up to less than the threshold can't matter, so candidates come from the
others, the essential ones. On the rest the block's bound rejects a candidate
before the block is decompressed. The tasks' heaps are merged at the end.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .common import bounded_batches, runs
from .decontam import item_words
from .minhash import word_spans

#: Text of one shard, about; a longer document is a shard of its own.
SHARD_BYTES = 8 << 20

#: Text that is split into terms at a time.
PIECE_BYTES = 2 << 20

#: Postings of one block.
BLOCK = 64

#: Terms of items that one search holds. More items are searched for in several.
QUERY_BYTES = 8 << 20

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_BETWEEN = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_GAP = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")

#: What a block says of itself.
_META = np.dtype(
    [("first", "<i4"), ("count", "<i4"), ("max_tf", "<i4"), ("min_length", "<i8"), ("offset", "<i8"), ("gap", "u1"), ("tf", "u1")]
)

INDEX_SCHEMA = (
    "shard bigint, term string, n bigint, words bigint, blocks binary, postings binary, docs array<bigint>, lengths array<bigint>"
)


#: Columns that a search reads, in the order its tasks take them.
INDEX_COLUMNS = ["shard", "term", "blocks", "postings", "docs", "lengths"]


def _pieces(texts: list[bytes]) -> Iterator[tuple[list[int], list[bytes]]]:
    """Documents and their text in pieces of bounded size, long texts cut between terms."""
    documents: list[int] = []
    parts: list[bytes] = []
    size = 0
    for number, text in enumerate(texts):
        at = 0
        while at < len(text):
            end = len(text)
            if end - at > PIECE_BYTES:
                cut = _GAP.search(text, at + PIECE_BYTES)
                end = cut.start() + 1 if cut else end
            documents.append(number)
            parts.append(text[at:end])
            size += end - at
            at = end
            if size >= PIECE_BYTES:
                yield documents, parts
                documents, parts, size = [], [], 0
    if parts:
        yield documents, parts


def _terms(parts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """All terms of the parts in order, and how many of them lie before each part's end."""
    data = b"\n".join(parts).translate(_FOLD)
    starts, ends = word_spans(data, _BETWEEN)
    raw = np.frombuffer(data, dtype=np.uint8)
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    packed = pa.py_buffer(raw[~_BETWEEN[raw]].tobytes())
    terms = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets.tobytes()), packed)
    return terms, np.searchsorted(starts, np.cumsum([len(p) + 1 for p in parts]))


def postings(texts: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(terms, code, document, frequency): one posting per term and document, by code, then document."""
    names, codes, documents, counts = [], [], [], []
    before = 0
    for numbers, parts in _pieces(texts):
        terms, upto = _terms(parts)
        coded = terms.dictionary_encode()
        document = np.repeat(np.array(numbers), np.diff(upto, prepend=0))
        many = max(1, len(coded.dictionary))
        both, count = np.unique(document * many + coded.indices.to_numpy(), return_counts=True)
        names.append(coded.dictionary)
        codes.append(both % many + before)
        documents.append(both // many)
        counts.append(count)
        before += len(coded.dictionary)
    if not names:
        none = np.zeros(0, dtype=np.int64)
        return pa.array([], pa.string()), none, none, none
    # Pieces name their terms apart, and a long text lies in several.
    coded = pa.chunked_array(names).combine_chunks().dictionary_encode()
    code = coded.indices.to_numpy().astype(np.int64)[np.concatenate(codes)]
    document = np.concatenate(documents)
    order = np.lexsort((document, code))
    code, document, count = code[order], document[order], np.concatenate(counts)[order]
    new = np.ones(len(code), dtype=bool)
    new[1:] = (code[1:] != code[:-1]) | (document[1:] != document[:-1])
    at = np.flatnonzero(new)
    return coded.dictionary, code[at], document[at], np.add.reduceat(count, at) if len(at) else count


def _width(most: np.ndarray) -> np.ndarray:
    return np.where(most < 1 << 8, 1, np.where(most < 1 << 16, 2, 4))


def encode_lists(code: np.ndarray, document: np.ndarray, tf: np.ndarray, length: np.ndarray, terms: int):
    """Compressed lists: (blocks, their bounds by term, bytes, their bounds by term).

    A block holds the gaps between its documents, then the frequencies less one
    (none if all are one), each in as many bytes as its largest needs.
    """
    first = np.searchsorted(code, np.arange(terms + 1))
    blocks_of = -(-np.diff(first) // BLOCK)
    block_bounds = np.concatenate([[0], np.cumsum(blocks_of)])
    term = np.repeat(np.arange(terms), blocks_of)
    start = first[term] + BLOCK * (np.arange(len(term)) - block_bounds[term])
    count = np.minimum(first[term + 1] - start, BLOCK)
    block = np.repeat(np.arange(len(term)), count)
    gap = np.diff(document, prepend=0)
    gap[start] = 0
    gap_width = _width(np.maximum.reduceat(gap, start))
    most = np.maximum.reduceat(tf, start)
    tf_width = np.where(most == 1, 0, _width(most - 1))
    size = count * (gap_width + tf_width)
    offset = np.cumsum(size) - size
    within = np.arange(len(code)) - start[block]
    out = np.zeros(int(size.sum()), dtype=np.uint8)
    for value, width, base in ((gap, gap_width, offset), (tf - 1, tf_width, offset + count * gap_width)):
        place = base[block] + within * width[block]
        for byte in range(4):
            go = width[block] > byte
            out[place[go] + byte] = (value[go] >> (8 * byte)) & 255
    byte_bounds = np.concatenate([offset, [len(out)]])[block_bounds]
    meta = np.zeros(len(term), dtype=_META)
    meta["first"], meta["count"], meta["max_tf"] = document[start], count, most
    meta["min_length"] = np.minimum.reduceat(length[document], start)
    meta["offset"], meta["gap"], meta["tf"] = offset - byte_bounds[term], gap_width, tf_width
    return meta, block_bounds, out, byte_bounds


def _binary(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    offsets = (bounds * data.itemsize).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])


def _shard(number: int, ids: list[int | None], texts: list[bytes]) -> pa.RecordBatch:
    """Rows of a shard: one that names its documents, under the empty term, then one per term."""
    terms, code, document, tf = postings(texts)
    length = np.bincount(document, tf, len(texts)).astype(np.int64)
    some = len(terms)
    if some:
        meta, block_bounds, data, byte_bounds = encode_lists(code, document, tf, length, some)
        blocks, lists = _binary(meta, block_bounds), _binary(data, byte_bounds)
        holding = np.bincount(code, minlength=some)
    else:
        blocks = lists = pa.array([], pa.binary())
        holding = np.zeros(0, dtype=np.int64)
    none = [None] * some
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(some + 1, number)),
            pa.array([""]).cast(pa.string()) if not some else pa.concat_arrays([pa.array([""]), terms]),
            pa.array(np.concatenate([[int((length > 0).sum())], holding])),
            pa.array([int(length.sum()), *none], pa.int64()),
            pa.concat_arrays([pa.array([None], pa.binary()), blocks]),
            pa.concat_arrays([pa.array([None], pa.binary()), lists]),
            pa.array([ids, *none], pa.list_(pa.int64())),
            pa.array([length, *none], pa.list_(pa.int64())),
        ],
        ["shard", "term", "n", "words", "blocks", "postings", "docs", "lengths"],
    )


def build_index(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """An inverted index of all terms of all documents, for ``search``; store it before use.

    A row is one term's list in one shard. Terms are runs of letters A-Z in lower
    case, digits and all characters beyond ASCII; a null text has none. Keys are whole
    numbers. Memory follows SHARD_BYTES, or the longest text if that is longer.
    """
    bounded_batches(documents.sparkSession)
    narrow = documents.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids: list[int | None] = []
        texts: list[bytes] = []
        size = 0
        for batch in batches:
            for name, words in zip(batch.column("id").to_pylist(), batch.column("text").cast(pa.binary())):
                ids.append(name)
                texts.append(words.as_py() or b"")
                size += len(texts[-1])
                if size >= SHARD_BYTES:
                    yield _shard(number, ids, texts)
                    ids, texts, size, number = [], [], 0, number + 1
        if texts:
            yield _shard(number, ids, texts)

    return narrow.mapInArrow(run, INDEX_SCHEMA)


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a posting scores for each unit of its term's weight."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def length_norms(lengths: np.ndarray, documents: int, words: int) -> np.ndarray:
    """100 - 90 + (90 * n * N) div L of each length n; through Python's integers where 64 bits are too few."""
    if len(lengths) and int(lengths.max()) * 90 * documents >= 1 << 63:
        lengths = lengths.astype(object)
    return (10 + (90 * lengths * documents) // max(1, words)).astype(np.int64)


@dataclass
class Best:
    """The best documents of an item so far: highest score first, then smallest id, null ids last."""

    k: int
    score: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    id: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    nameless: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=bool))

    @property
    def threshold(self) -> int:
        """No document below this score can come in."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def offer(self, score: np.ndarray, id: np.ndarray, nameless: np.ndarray) -> None:
        score = np.concatenate([self.score, score])
        id, nameless = np.concatenate([self.id, id]), np.concatenate([self.nameless, nameless])
        order = np.lexsort((id, nameless, -score))[: self.k]
        self.score, self.id, self.nameless = score[order], id[order], nameless[order]


class Shard:
    """The lists of one shard that a search asks for, decompressed block by block as needed."""

    def __init__(self, docs: pa.ListScalar, lengths: pa.ListScalar, documents: int, words: int):
        self.nameless = docs.values.is_null().to_numpy(zero_copy_only=False)
        self.ids = pc.fill_null(docs.values, 0).to_numpy()
        self._norm = lambda n: length_norms(n, documents, words)
        self.m = self._norm(lengths.values.to_numpy())
        self.lists: dict[str, tuple[np.ndarray, bytes, np.ndarray]] = {}
        self._open: dict[tuple[str, int], tuple[np.ndarray, np.ndarray]] = {}

    def add(self, term: str, blocks: bytes, data: bytes) -> None:
        meta = np.frombuffer(blocks, _META)
        bound = impact(meta["max_tf"].astype(np.int64), self._norm(meta["min_length"].astype(np.int64)))
        self.lists[term] = meta, data, bound

    def block(self, term: str, number: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, impacts) of a block."""
        if (term, number) not in self._open:
            meta, data, _ = self.lists[term]
            first, count, _, _, at, gap, width = meta[number].tolist()
            docs = np.cumsum(np.frombuffer(data, f"<u{gap}", count, at), dtype=np.int64) + first
            tf = np.ones(count, dtype=np.int64)
            if width:
                tf += np.frombuffer(data, f"<u{width}", count, at + count * gap)
            self._open[term, number] = docs, impact(tf, self.m[docs])
        return self._open[term, number]

    def blocks(self, term: str, numbers: list[int]) -> tuple[np.ndarray, np.ndarray]:
        opened = [self.block(term, n) for n in numbers]
        return np.concatenate([d for d, _ in opened]), np.concatenate([i for _, i in opened])

    def search(self, query: list[tuple[str, int]], best: Best) -> None:
        """Block-Max MaxScore: offer ``best`` every document of the shard that may come in."""
        held = [(weight * int(self.lists[term][2].max()), weight, term) for term, weight in query if term in self.lists]
        held.sort()
        upto = np.cumsum([0, *(bound for bound, _, _ in held)])
        least = best.threshold
        if upto[-1] < least:
            return
        # Documents of the first lists alone stay below the threshold.
        essential = int(np.searchsorted(upto[1:], least))
        score = np.zeros(len(self.ids), dtype=np.int64)
        seen = np.zeros(len(self.ids), dtype=bool)
        for _, weight, term in held[essential:]:
            docs, scores = self.blocks(term, range(len(self.lists[term][0])))
            score[docs] += weight * scores
            seen[docs] = True
        found = np.flatnonzero(seen)
        for number in range(essential - 1, -1, -1):
            found = found[score[found] + upto[number + 1] >= least]
            if not len(found):
                return
            _, weight, term = held[number]
            meta, _, bound = self.lists[term]
            block = np.searchsorted(meta["first"], found, side="right") - 1
            most = np.where(block >= 0, weight * bound[block], 0)
            stay = score[found] + most + upto[number] >= least
            found, block = found[stay], block[stay]
            asked = np.unique(block[block >= 0])
            if len(asked):
                docs, scores = self.blocks(term, asked.tolist())
                place = np.minimum(np.searchsorted(docs, found), len(docs) - 1)
                score[found] += np.where(docs[place] == found, weight * scores[place], 0)
        found = found[score[found] >= least]
        best.offer(score[found], self.ids[found], self.nameless[found])


_FOUND = "item bigint, doc bigint, score bigint"


def _queries(items: DataFrame, weights: DataFrame) -> Iterator[list[tuple[int | None, list[tuple[str, int]]]]]:
    """Items with their weighted terms, QUERY_BYTES of terms at a time."""
    asked = stage(items.join(weights, "term").select("item", "term", "weight"), "weighted-terms")
    total = asked.agg(F.sum(F.octet_length("term") + 16)).first()[0] or 0
    passes = ceil(total / QUERY_BYTES)
    for number in range(passes):
        part = asked.where(F.pmod(F.xxhash64("item"), F.lit(passes)) == number)
        rows = part.groupBy("item").agg(F.sort_array(F.collect_list(F.struct("term", "weight"))).alias("terms")).collect()
        yield [(r["item"], [(t["term"], t["weight"]) for t in r["terms"]]) for r in rows]


def search(
    index: DataFrame,
    items: DataFrame,
    k: int = 10,
    item_key: str = "item_id",
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """The k best documents of each item: (item_key, rank, key, score).

    Weights and lengths count over the whole index. Documents score above 0; equal
    scores go by the smaller key, a null key last. Items without a term, such
    as null or empty ones, find nothing, and items that repeat a key are one with the
    terms of all. Documents that repeat a key are ranked each. Keys are whole numbers;
    empty tables give no rows.
    """
    spark = index.sparkSession
    bounded_batches(spark)
    asked = items.select(F.col(item_key).cast("long").alias("item"), F.explode(item_words(text)).alias("term"))
    asked = stage(asked.distinct(), "asked-terms")
    documents, words = index.where("term = ''").agg(F.sum("n"), F.sum("words")).first()
    found = spark.createDataFrame([], _FOUND)
    if not documents:
        asked = asked.limit(0)
    held = index.join(asked.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("n").alias("df"))
    weight = F.floor(1000 * F.log((2.0 * (documents or 0) + 2) / (2 * F.col("df") + 1)))
    for queries in _queries(asked, held.select("term", weight.alias("weight"))):
        sent = spark.sparkContext.broadcast(queries)
        wanted = spark.createDataFrame([(t,) for t in sorted({t for _, terms in queries for t, _ in terms})], "term string")
        rows = index.where("term <> ''").join(wanted, "term", "left_semi").unionByName(index.where("term = ''"))
        rows = rows.repartition("shard").sortWithinPartitions("shard", "term").select(*INDEX_COLUMNS)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            queries = sent.value
            best = [Best(k) for _ in queries]
            now, shard = None, None

            def close() -> None:
                for (_, terms), so_far in zip(queries, best):
                    shard.search(terms, so_far)

            for number, part in runs(batches, "shard"):
                lists = zip(*(part.column(c) for c in INDEX_COLUMNS[1:]))
                if number != now:
                    if shard is not None:
                        close()
                    # A shard's first row is under the empty term.
                    _, _, _, docs, lengths = next(lists)
                    now, shard = number, Shard(docs, lengths, documents, words)
                for term, blocks, data, _, _ in lists:
                    shard.add(term.as_py(), blocks.as_py(), data.as_py())
            if shard is not None:
                close()
            ids = [item for (item, _), so_far in zip(queries, best) for _ in so_far.score]
            if ids:
                docs = pa.array(np.concatenate([b.id for b in best]), mask=np.concatenate([b.nameless for b in best]))
                scores = pa.array(np.concatenate([b.score for b in best]))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), docs, scores], ["item", "doc", "score"])

        found = found.unionByName(rows.mapInArrow(run, _FOUND))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("item").alias(item_key), "rank", F.col("doc").alias(key), "score")
