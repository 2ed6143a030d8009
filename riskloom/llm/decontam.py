"""Benchmark decontamination: every training passage asks an index of test items.

Test items are indexed as segments of at most SEGMENT_WORDS words, scored by
BM25 and divided by what a segment scores against itself, so one threshold
serves all. Passages overlap by half and are twice as long as a segment, so a
whole segment always lies within one.

The threshold is fixed, so the pivot test of WAND is one sum: a passage whose
words' highest scores do not add up to it is done; next, blocks of segments
whose block maxima do not add up to it are passed over; only segments in the
blocks left are scored. Nothing above the threshold is lost, and there is no
cap on what is retrieved.

A retrieved item counts only if the document holds at least half of the
five-word sequences of its question (the first three quarters) and of its
answer (the last quarter), or at least seven tenths of all its sequences: an item
without an answer column has no marked answer, and most of it verbatim is a leak.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, lean, slices, whole
from .minhash import mix, word_hashes, word_spans

SEGMENT_WORDS = 64
PASSAGE_STEP = 64
GRAM_WORDS = 5

#: Share of its own score that a segment must reach, and shares of an item's
#: question and answer sequences that a document must hold.
THRESHOLD = 0.5
OVERLAP = 0.5

#: Share of all of an item's sequences that is enough by itself.
WHOLE_OVERLAP = 0.7

#: BM25's usual settings.
K1, B = 1.2, 0.75

#: Segments in one block of the index.
BLOCK = 16

#: Item texts that one index holds. More items are asked in several passes, each
#: with an index of this size, which is what is sent to every worker.
INDEX_BYTES = 8 << 20

#: Postings that are looked at together; passages beyond it wait.
SPREAD = 1 << 20

# Words are runs of letters A-Z, digits and all characters beyond ASCII.
_WORD = r"[0-9a-z\x{80}-\x{10FFFF}]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_BETWEEN = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def item_words(text: str | Column) -> Column:
    return F.regexp_extract_all(F.translate(whole(text), _UPPER, _LOWER), F.lit(_WORD), F.lit(0))


def _hashed(text: bytes) -> np.ndarray:
    data = text.translate(_FOLD)
    starts, ends = word_spans(data, _BETWEEN)
    return word_hashes(data, starts, ends)


def grams(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words."""
    out = np.full(max(0, len(words) - size + 1), size, dtype=np.uint64)
    for k in range(size):
        out = mix(out) ^ words[k : len(words) - size + 1 + k]
    return mix(out)


@dataclass
class Item:
    """A test item as its document would show it."""

    id: int | None
    size: int
    question: np.ndarray
    answer: np.ndarray

    @classmethod
    def of(cls, key: int | None, words: np.ndarray) -> Item:
        size = min(GRAM_WORDS, len(words))
        runs = grams(words, size)
        last = max(1, len(runs) // 4)
        return cls(key, size, runs[:-last] if len(runs) > last else runs, runs[-last:])

    def overlaps(self, words: np.ndarray) -> tuple[float, float, float]:
        """Shares of the question's, the answer's and all sequences that lie in ``words``."""
        held = grams(words, self.size)
        question, answer = (np.isin(part, held) for part in (self.question, self.answer))
        # An item of one sequence is question and answer at once.
        every = answer if len(question) == len(answer) == 1 else np.concatenate([question, answer])
        return float(question.mean()), float(answer.mean()), float(every.mean())


class Index:
    """Inverted index of test segments with a maximum per word and per block."""

    def __init__(self, items: list[tuple[int | None, list[str]]], weights: dict[str, float], mean_words: float):
        """``weights``: the inverse document frequency of each word over all segments."""
        self.items: list[Item] = []
        self.owner: list[int] = []
        entries: list[tuple[int, int, float]] = []
        for key, words in items:
            hashes = np.array([_hashed(w.encode())[0] for w in words], dtype=np.uint64)
            self.items.append(Item.of(key, hashes))
            for at in range(0, len(words), SEGMENT_WORDS):
                part = words[at : at + SEGMENT_WORDS]
                scores = {}
                for word, code in zip(part, hashes[at : at + SEGMENT_WORDS].tolist()):
                    n = part.count(word)
                    long = K1 * (1 - B + B * len(part) / mean_words)
                    scores[code] = weights[word] * n * (K1 + 1) / (n + long)
                own = sum(scores.values())
                entries.extend((code, len(self.owner), score / own) for code, score in scores.items())
                self.owner.append(len(self.items) - 1)
        entries.sort()
        codes = np.array([e[0] for e in entries], dtype=np.uint64)
        self.vocabulary, first = np.unique(codes, return_index=True)
        self.bounds = np.append(first, len(entries))
        self.segment = np.array([e[1] for e in entries], dtype=np.int64)
        self.score = np.array([e[2] for e in entries])
        word = np.repeat(np.arange(len(first)), np.diff(self.bounds))
        block = self.segment // BLOCK
        new = np.ones(len(entries), dtype=bool)
        new[1:] = (word[1:] != word[:-1]) | (block[1:] != block[:-1])
        at = np.flatnonzero(new)
        self.block = block[at]
        self.block_bounds = np.searchsorted(at, self.bounds)
        self.block_max = np.maximum.reduceat(self.score, at) if len(at) else np.zeros(0)
        self.word_max = np.maximum.reduceat(self.score, first) if len(first) else np.zeros(0)
        self.blocks = -(-len(self.owner) // BLOCK)

    def terms(self, words: np.ndarray) -> np.ndarray:
        """Number of each word in the vocabulary, or -1."""
        if not len(self.vocabulary):
            return np.full(len(words), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == words, at, -1)

    @staticmethod
    def _spread(bounds: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of all postings of ``terms``, and which of the terms each belongs to."""
        count = bounds[terms + 1] - bounds[terms]
        asked = np.repeat(np.arange(len(terms)), count)
        ends = np.cumsum(count)
        return np.repeat(bounds[terms] - (ends - count), count) + np.arange(len(asked)), asked

    def above(self, passage: np.ndarray, term: np.ndarray, passages: int) -> list[tuple[int, int, float]]:
        """(passage, segment, score) at or above the threshold.

        ``passage`` and ``term`` name each distinct word of each passage.
        """
        bound = np.bincount(passage, self.word_max[term], passages)
        go = bound[passage] >= THRESHOLD - 1e-9
        passage, term = passage[go], term[go]
        # Passages in groups whose postings are bounded, whatever the number of items.
        order = np.argsort(passage, kind="stable")
        passage, term = passage[order], term[order]
        cost = np.cumsum(self.bounds[term + 1] - self.bounds[term])
        starts = np.flatnonzero(np.diff(passage, prepend=-1)) if len(passage) else []
        found, at = [], 0
        for number, start in enumerate(starts):
            end = starts[number + 1] if number + 1 < len(starts) else len(term)
            last = number + 1 == len(starts)
            if last or cost[(starts[number + 2] if number + 2 < len(starts) else len(term)) - 1] - (cost[at - 1] if at else 0) > SPREAD:
                found += self._above(passage[at:end], term[at:end])
                at = end
        return found

    def _above(self, passage: np.ndarray, term: np.ndarray) -> list[tuple[int, int, float]]:
        floor = THRESHOLD - 1e-9
        place, asked = self._spread(self.block_bounds, term)
        cell = passage[asked] * self.blocks + self.block[place]
        cells, where = np.unique(cell, return_inverse=True)
        hot = cells[np.bincount(where, self.block_max[place], len(cells)) >= floor]
        if not len(hot):
            return []
        go = np.isin(passage, hot // self.blocks)
        passage, term = passage[go], term[go]
        place, asked = self._spread(self.bounds, term)
        near = np.isin(passage[asked] * self.blocks + self.segment[place] // BLOCK, hot)
        place, asked = place[near], asked[near]
        cell = passage[asked] * len(self.owner) + self.segment[place]
        cells, where = np.unique(cell, return_inverse=True)
        score = np.bincount(where, self.score[place], len(cells))
        return [
            (int(c) // len(self.owner), int(c) % len(self.owner), float(s))
            for c, s in zip(cells[score >= floor], score[score >= floor])
        ]


def passages_of(counts: list[int], terms: np.ndarray, most: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Passages over the words of several documents on end.

    Returns the document of each passage, and the distinct (passage, term) pairs; with
    the highest score of each term as ``most``, those of passages that may pass.
    A passage is two steps of words; a document of n steps has max(1, n - 1) passages.
    """
    size = np.array(counts, dtype=np.int64)
    steps = np.maximum(1, -(-size // PASSAGE_STEP))
    many = np.maximum(1, steps - 1)
    first = np.cumsum(many) - many
    document = np.repeat(np.arange(len(size)), size)
    within = np.arange(len(terms)) - np.repeat(np.cumsum(size) - size, size)
    known = terms >= 0
    document, step, term = document[known], within[known] // PASSAGE_STEP, terms[known]
    own = step < many[document]
    before = step >= 1
    passage = np.concatenate([(first[document] + step)[own], (first[document] + step - 1)[before]])
    term = np.concatenate([term[own], term[before]])
    if most is not None:
        # Repeated words only add: a passage that fails with them fails without.
        go = np.bincount(passage, most[term], int(many.sum()))[passage] >= THRESHOLD - 1e-9
        passage, term = passage[go], term[go]
    vocabulary = int(term.max()) + 1 if len(term) else 1
    both = np.unique(passage * vocabulary + term)
    return np.repeat(np.arange(len(size)), many), both // vocabulary, both % vocabulary


def find_items(texts: list[bytes], index: Index) -> list[list[tuple[int | None, float, float, float]]]:
    """Verified items of each text: (item id, best score, question overlap, answer overlap)."""
    words = [_hashed(t) for t in texts]
    terms = index.terms(np.concatenate([*words, np.zeros(0, np.uint64)]))
    document, passage, term = passages_of([len(w) for w in words], terms, index.word_max)
    best: dict[tuple[int, int], float] = {}
    for at, segment, score in index.above(passage, term, len(document)):
        pair = int(document[at]), index.owner[segment]
        best[pair] = max(score, best.get(pair, 0.0))
    out: list[list[tuple[int | None, float, float, float]]] = [[] for _ in texts]
    for (row, number), score in sorted(best.items()):
        item = index.items[number]
        question, answer, every = item.overlaps(words[row])
        if question >= OVERLAP and answer >= OVERLAP or every >= WHOLE_OVERLAP:
            out[row].append((item.id, score, question, answer))
    return out


def build_indexes(items: DataFrame, key: str = "item_id", text: str = "text") -> Iterator[Index]:
    """Indexes that together hold every item, each over INDEX_BYTES of text at most, about.

    Word weights and the mean length are of all items. Items without a word,
    such as null or empty ones, match nothing.
    """
    worded = items.select(F.col(key).cast("long").alias("id"), item_words(text).alias("words"))
    worded = worded.where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.size("words"), F.lit(SEGMENT_WORDS))
    segments = worded.select(F.explode(F.transform(starts, lambda s: F.slice("words", s, SEGMENT_WORDS))).alias("words"))
    whole_size = segments.agg(
        F.count("*").alias("n"),
        F.avg(F.size("words")).alias("mean"),
        F.sum(F.octet_length(F.concat_ws(" ", "words"))).alias("bytes"),
    ).first()
    if not whole_size["n"]:
        return
    seen = segments.select(F.explode(F.array_distinct("words")).alias("word")).groupBy("word").count()
    weight = F.log1p((whole_size["n"] - F.col("count") + 0.5) / (F.col("count") + 0.5))
    weights = seen.select("word", weight.alias("weight"))
    passes = ceil(whole_size["bytes"] / INDEX_BYTES)
    for number in range(passes):
        part = worded.where(F.pmod(F.xxhash64("id", "words"), F.lit(passes)) == number)
        used = part.select(F.explode("words").alias("word")).distinct()
        known = {r["word"]: r["weight"] for r in weights.join(used, "word").collect()}
        rows = sorted(((r["id"], r["words"]) for r in part.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        yield Index(rows, known, whole_size["mean"])


_FOUND = "key bigint, item_id bigint, score double, question_overlap double, answer_overlap double"


def contaminated(
    documents: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id"
) -> DataFrame:
    """Verified pairs: (key, item id, score, question_overlap, answer_overlap).

    One row per document row and item, its best passage's score with it. Null
    and empty texts match nothing; repeated items are found as often as they
    stand in the table; a null key of either table stays null; empty tables give no
    rows. Keys are whole numbers.
    """
    spark = documents.sparkSession
    bounded_batches(spark)
    narrow = documents.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    found = spark.createDataFrame([], _FOUND)
    for index in build_indexes(items, item_key):
        sent = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keys = batch.column("key").to_pylist()
                rows = []
                for at, texts in slices(batch):
                    hits = find_items(texts, sent.value)
                    rows += [(k, *hit) for k, some in zip(keys[at : at + len(texts)], hits) for hit in some]
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
                columns = list(zip(*rows)) or [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds)],
                    ["key", "item_id", "score", "question_overlap", "answer_overlap"],
                )

        found = found.unionByName(narrow.mapInArrow(lean(run), _FOUND))
    return found.withColumnsRenamed({"key": key, "item_id": item_key})


def without_benchmark(documents: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id") -> DataFrame:
    """The documents that hold no test item, with all their columns."""
    spark = documents.sparkSession
    bounded_batches(spark)
    kept = documents
    for index in build_indexes(items, item_key):
        sent = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = [not some for _, texts in slices(batch, text) for some in find_items(texts, sent.value)]
                yield batch.filter(pa.array(clean, pa.bool_()))

        kept = kept.mapInArrow(lean(run), documents.schema)
    return kept
