"""Toxicity by weak supervision.

Voters look at a text and vote or abstain: lexicon voters for stems that are
far more common in toxic texts, and pattern voters for how many of them there are
and how densely they stand. A generative model with one hidden class explains the
votes alone; it estimates how accurate every voter is and, from what its
class leaves unexplained, how far voters merely repeat each other. Its posterior
is the label a linear classifier is trained on, and that classifier scores texts.

Stems are mined, and all models fitted, from at most SAMPLE_ROWS labelled rows,
drawn by a hash of their key. The fit runs on the driver on the votes of these
rows; scoring sends each worker the stems and one weight per feature.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import bounded_batches
from .minhash import mix, word_spans

#: Labelled rows that stems and models are learned from, at most about.
SAMPLE_ROWS = 20_000

#: Stems in the lexicon, their length in bytes, and how much more common they
#: must be in toxic texts than in others.
STEMS = 96
SHORTEST, LONGEST = 3, 16
RATE_RATIO = 5.0

#: Least log-likelihood ratio of a stem against chance.
EVIDENCE = 30.0

#: Thresholds of the pattern voters: different stems met, and stems per 1000
#: words, of which at least two. Plain numbers of stems would grow with a text's length.
DIFFERENT = (2, 3)
DENSITIES = (5.0, 8.0, 12.0, 20.0, 30.0, 50.0)

#: Texts below this many words count as this long where density is an amount.
SHORT_WORDS = 50

_LETTERS = np.array([b >= 128 or chr(b).isalpha() for b in range(256)])


def folded(text: str | None) -> bytes:
    return (text or "").lower().encode()


def _prefix_codes(data: bytes, starts: np.ndarray, length: int) -> np.ndarray:
    """A code of the first ``length`` bytes (at most 16) from each start."""
    words = np.ndarray((len(data) + 1,), dtype="<u8", buffer=data + bytes(24), strides=(1,))
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    low = words[starts] & (full >> np.uint64(8 * max(0, 8 - length)))
    if length <= 8:
        return low
    high = words[np.minimum(starts + 8, len(data))] & (full >> np.uint64(8 * (16 - length)))
    return mix(low) ^ high


@dataclass
class Lexicon:
    """Stems, found at the beginning of words."""

    stems: list[bytes]

    def __post_init__(self) -> None:
        self._by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for length in sorted({len(s) for s in self.stems}):
            some = [(n, s) for n, s in enumerate(self.stems) if len(s) == length]
            codes = np.concatenate([_prefix_codes(s, np.zeros(1, np.int64), length) for _, s in some])
            order = np.argsort(codes)
            self._by_length[length] = codes[order], np.array([n for n, _ in some])[order]

    def counts(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """How often each text has each stem (texts, stems), and its number of words."""
        data = b"\n".join(texts)
        starts, ends = word_spans(data, ~_LETTERS)
        edges = np.cumsum([0, *(len(t) + 1 for t in texts)])
        upto = np.searchsorted(starts, edges)
        out = np.zeros((len(texts), len(self.stems)), dtype=np.int64)
        document = np.repeat(np.arange(len(texts)), np.diff(upto))
        for length, (codes, number) in self._by_length.items():
            rows = np.flatnonzero(ends - starts >= length)
            mine = _prefix_codes(data, starts[rows], length)
            at = np.minimum(np.searchsorted(codes, mine), len(codes) - 1)
            hit = codes[at] == mine
            np.add.at(out, (document[rows[hit]], number[at[hit]]), 1)
        return out, np.diff(upto)


def votes(counts: np.ndarray, words: np.ndarray) -> np.ndarray:
    """What each voter says: 1 for toxic, 0 for nothing. (texts, voters)."""
    hits = counts.sum(axis=1)
    different = (counts > 0).sum(axis=1)
    density = 1000 * hits / np.maximum(words, 1)
    columns = [counts > 0]
    columns += [(different >= n)[:, None] for n in DIFFERENT]
    columns += [((density >= d) & (hits >= 2))[:, None] for d in DENSITIES]
    return np.concatenate(columns, axis=1).astype(np.float64)


def features(counts: np.ndarray, words: np.ndarray) -> np.ndarray:
    """What the linear classifier sees: votes, and the amounts behind the patterns."""
    hits = counts.sum(axis=1)
    density = 1000 * hits / np.maximum(words, SHORT_WORDS)
    different = (counts > 0).sum(axis=1)
    amounts = np.stack([np.log1p(density), np.log1p(different)], axis=1)
    return np.concatenate([votes(counts, words), amounts], axis=1)


def label_model(seen: np.ndarray, start: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Posterior of the hidden class for each row of votes.

    Expectation maximisation of class-wise vote rates from ``start``, a first
    guess of the class. Voters that agree more than the class explains share
    their weight: each counts by one over the sum of its excess correlations.
    """
    posterior = np.clip(start.astype(np.float64), 0.02, 0.98)
    weight = np.ones(seen.shape[1])
    for step in range(rounds):
        mass = np.stack([1 - posterior, posterior])
        total = mass.sum(axis=1, keepdims=True)
        rate = np.clip((mass @ seen + 0.5 * seen.mean(axis=0)) / (total + 0.5), 1e-4, 1 - 1e-4)
        prior = np.clip(total[:, 0] / len(seen), 1e-3, 1)
        if step % 10 == 0:
            weight = _shares(seen, posterior, rate)
        odds = log(prior[1] / prior[0]) + (
            seen @ (weight * np.log(rate[1] / rate[0])) + (1 - seen) @ (weight * np.log((1 - rate[1]) / (1 - rate[0])))
        )
        now = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        if np.abs(now - posterior).max() < 1e-5:
            return now
        posterior = now
    return posterior


def _shares(seen: np.ndarray, posterior: np.ndarray, rate: np.ndarray) -> np.ndarray:
    """Weights of voters from the correlations that remain within the classes."""
    rest = seen - (np.outer(1 - posterior, rate[0]) + np.outer(posterior, rate[1]))
    spread = np.sqrt((rest**2).mean(axis=0)) + 1e-9
    excess = np.clip((rest.T @ rest) / len(seen) / np.outer(spread, spread), 0, 1)
    excess[excess < 0.05] = 0
    np.fill_diagonal(excess, 1)
    return 1 / excess.sum(axis=1)


def fit_linear(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3) -> np.ndarray:
    """Logistic regression on soft labels, by Newton steps; the last weight is the constant."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    ridge = penalty * len(x) * np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + ridge @ w
        curve = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + ridge
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class Model:
    """Stems and the weights of the features; ``weights`` of None scores 0 throughout."""

    lexicon: Lexicon
    weights: np.ndarray | None

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.weights is None or not texts:
            return np.zeros(len(texts))
        x = features(*self.lexicon.counts([folded(t) for t in texts]))
        odds = x @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def held_out(key: Column) -> Column:
    """One row in five, by a checksum of its key; such rows are never learned from."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(5)) == 0


def labelled_sample(
    documents: DataFrame, labels: DataFrame, key: str, text: str, label: str, rows: int = SAMPLE_ROWS
) -> DataFrame:
    """(text, label) of about ``rows`` labelled rows that are not held out, at most."""
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"))
    known = known.where(F.col("label").isin(0, 1) & F.col("key").isNotNull() & ~held_out(F.col("key")))
    known = known.groupBy("key").agg(F.max("label").alias("label"))
    share = min(1.0, rows / max(1, known.count()))
    parts = 1 << 20
    drawn = known.where(F.pmod(F.xxhash64("key"), F.lit(parts)) < int(share * parts))
    narrow = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    # Bounded by ``rows``, whatever the data.
    return stage(narrow.join(F.broadcast(drawn), "key").select("text", "label"), "labelled")


def mine_stems(sample: DataFrame) -> list[bytes]:
    """Beginnings of words whose rate in toxic texts is far above that in others.

    A word counts once in each text, so a text that repeats one proves nothing.
    Of stems that begin one another only the one with most evidence stays.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[tuple[bytes, int]] = Counter()
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                data = folded(text)
                starts, ends = word_spans(data, ~_LETTERS)
                spans = zip(starts.tolist(), ends.tolist())
                seen.update({(data[i : min(j, i + LONGEST)], label) for i, j in spans})
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([w for w, _ in seen], pa.binary()),
                pa.array([y for _, y in seen], pa.int32()),
                pa.array(list(seen.values()), pa.int64()),
            ],
            ["word", "label", "n"],
        )

    words = sample.mapInArrow(run, "word binary, label int, n bigint").groupBy("word").pivot("label", [0, 1])
    words = words.agg(F.sum("n")).select("word", F.coalesce("0", F.lit(0)).alias("a"), F.coalesce("1", F.lit(0)).alias("b"))
    words = stage(words, "words")
    total = words.agg(F.sum("a").alias("a"), F.sum("b").alias("b")).first()
    if not total["a"] or not total["b"]:
        return []
    lengths = F.sequence(F.lit(SHORTEST), F.octet_length("word"))
    begun = words.where(F.octet_length("word") >= SHORTEST).select(
        F.explode(F.transform(lengths, lambda n: F.substring("word", F.lit(1), n))).alias("stem"), "a", "b"
    )
    each = begun.groupBy("stem").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    share = total["b"] / (total["a"] + total["b"])
    met = F.col("a") + F.col("b")
    gain = F.col("b") * F.log(F.col("b") / (met * share)) + F.when(
        F.col("a") > 0, F.col("a") * F.log(F.col("a") / (met * (1 - share)))
    ).otherwise(0)
    ratio = (F.col("b") / total["b"]) / ((F.col("a") + 0.5) / total["a"])
    good = each.where((F.col("b") >= 3) & (ratio >= RATE_RATIO)).withColumn("gain", 2 * gain)
    best = good.where(F.col("gain") >= EVIDENCE).orderBy(F.desc("gain"), F.desc(F.octet_length("stem")), "stem")
    chosen: list[bytes] = []
    for row in best.limit(STEMS * 40).collect():
        stem = bytes(row["stem"])
        if len(chosen) < STEMS and not any(stem.startswith(c) or c.startswith(stem) for c in chosen):
            chosen.append(stem)
    return chosen


def fit(
    documents: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    rows: int = SAMPLE_ROWS,
) -> Model:
    """Learn stems, the label model and the classifier from labelled rows that are not held out.

    Without labelled rows of both classes, or without any stem, all scores are 0.
    """
    bounded_batches(documents.sparkSession)
    sample = labelled_sample(documents, labels, key, text, label, rows)
    lexicon = Lexicon(mine_stems(sample))
    if not lexicon.stems:
        return Model(lexicon, None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, words = lexicon.counts([folded(t) for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts.astype(np.int32)), pa.list_(pa.int32())), pa.array(words, pa.int64())],
                ["counts", "words"],
            )

    # As many rows as the sample, of a few hundred bytes each.
    found = sample.mapInArrow(run, "counts array<int>, words bigint").toPandas()
    found = found.sort_values("words", kind="stable")
    counts, words = np.stack(found["counts"].to_numpy()), found["words"].to_numpy()
    seen = votes(counts, words)
    start = (counts.sum(axis=1) >= 3) & (1000 * counts.sum(axis=1) / np.maximum(words, 1) >= 5)
    return Model(lexicon, fit_linear(features(counts, words), label_model(seen, start)))


def score_documents(documents: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, score, predicted) of every row; null and empty texts are scored as empty."""
    bounded_batches(documents.sparkSession)
    sent = documents.sparkSession.sparkContext.broadcast(model)
    kind = documents.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = sent.value.scores(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(scores)], ["key", "score"])

    narrow = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    scored = narrow.mapInArrow(run, f"key {kind}, score double")
    return scored.select(
        F.col("key").alias(key),
        F.coalesce(held_out(F.col("key")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def without_toxic(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents scored below one half, with all their columns."""
    bounded_batches(documents.sparkSession)
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(sent.value.scores(batch.column(text).to_pylist()) < 0.5))

    return documents.mapInArrow(run, documents.schema)
