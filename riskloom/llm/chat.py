"""Conversations as token sequences with a loss mask.

A turn is ``<turn>`` role ``<says>`` text ``</turn>``. Role and text are encoded
apart from the marks, whose ids are reserved and lie above the vocabulary, so
no text can produce one. Shown as text, a turn stays readable in one way only:
a backslash goes before every backslash and every mark inside a role or text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import ByteBpe, byte_bpe, encoded, text_batches
from .common import bounded_batches, public_vocabulary, whole

#: Marks in the order of their reserved ids, which follow the vocabulary's.
MARKS = ("<turn>", "<says>", "</turn>")

#: The role whose texts count for the loss.
LEARNED_ROLE = "assistant"

_CONTROL = r"\\|" + "|".join(map(re.escape, MARKS))


def escape(text: str) -> str:
    return re.sub(_CONTROL, lambda found: "\\" + found[0], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def assemble(role: bytes, text: bytes, first_mark: int, learned: bool) -> tuple[np.ndarray, np.ndarray]:
    """Ids and loss mask of a turn whose role and text are encoded already.

    The mask is the running sum of what opens (+1) and closes (-1) the loss.
    """
    parts = [np.frombuffer(part, "<u4") for part in (role, text)]
    marks = [np.array([first_mark + n], "<u4") for n in range(len(MARKS))]
    segments = [marks[0], parts[0], marks[1], parts[1], marks[2]]
    ids = np.concatenate(segments)
    ends = np.cumsum([len(segment) for segment in segments])
    change = np.zeros(len(ids) + 1, dtype=np.int8)
    if learned:
        change[ends[2]] += 1
        change[ends[3]] -= 1
    return ids, np.cumsum(change)[:-1].astype(np.uint8)


def format_chats(
    conversations: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    vocabulary: str | None = None,
) -> DataFrame:
    """Turns as token segments: (conv, place, start, n_ids, ids, mask).

    Joined by ``place``, the segments of a conversation are its sequence;
    ``start`` is where a segment begins in it. ``ids`` are little-endian 32-bit,
    ``mask`` has a byte per id. Turns are ordered by ``turn``, nulls first, then
    by role and a digest of the text. Null roles and texts count as empty; rows without a
    conversation id belong together; repeated rows are turns of their own.
    """
    vocabulary = vocabulary or public_vocabulary()
    bounded_batches(conversations.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(vocabulary, special=False)
        for batch in batches:
            for at, texts in text_batches(batch, "text"):
                some = batch.slice(at, len(texts))
                roles = some.column("role").to_pylist()
                names = encoded([escape(r) for r in roles], bpe)
                bodies = encoded([escape(t) for t in texts], bpe)
                made = [
                    assemble(n, b, bpe.size, r == LEARNED_ROLE) for n, b, r in zip(names, bodies, roles)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column("conv"),
                        some.column("turn"),
                        some.column("role"),
                        pa.array([hashlib.sha256(t.encode()).digest() for t in texts], pa.binary()),
                        pa.array([len(ids) for ids, _ in made], pa.int64()),
                        pa.array([ids.tobytes() for ids, _ in made], pa.binary()),
                        pa.array([mask.tobytes() for _, mask in made], pa.binary()),
                    ],
                    ["conv", "turn", "role", "tie", "n_ids", "ids", "mask"],
                )

    narrow = conversations.select(
        F.col(conv).cast("long").alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        whole(role).alias("role"),
        whole(text).alias("text"),
    )
    schema = "conv bigint, turn bigint, role string, tie binary, n_ids bigint, ids binary, mask binary"
    made = narrow.mapInArrow(run, schema)
    ordered = Window.partitionBy("conv").orderBy("turn", "role", "tie", "ids")
    placed = made.withColumn("place", F.row_number().over(ordered).cast("long")).withColumn(
        "start", F.sum("n_ids").over(ordered.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_ids")
    )
    return placed.select(F.col("conv").alias(conv), "place", "start", "n_ids", "ids", "mask")


class _Reading:
    """Digests of one conversation, fed segment by segment."""

    def __init__(self, conv: int | None):
        self.conv = conv
        self.turns = self.loss = self.formatted = 0
        self.all, self.learned = hashlib.sha256(), hashlib.sha256()

    def add(self, bpe: ByteBpe, ids: bytes, mask: bytes) -> None:
        codes = np.frombuffer(ids, "<u4")
        at = np.flatnonzero(codes >= bpe.size)
        shown = [MARKS[n] for n in (codes[at] - bpe.size).tolist()]
        if tuple(shown) != MARKS or at[0] != 0 or at[2] != len(codes) - 1:
            raise ValueError(f"conversation {self.conv} holds a damaged turn")
        role = bpe.decode(codes[1 : at[1]].tobytes()).decode()
        text = bpe.decode(codes[at[1] + 1 : at[2]].tobytes()).decode()
        masked = bpe.decode(codes[np.frombuffer(mask, "u1") == 1].tobytes()).decode()
        self.turns += 1
        self.formatted += len(role) + len(text) + sum(map(len, MARKS))
        self.all.update(f"{unescape(role)}\n{unescape(text)}\n".encode())
        learned = unescape(masked)
        self.loss += len(learned)
        self.learned.update(learned.encode())

    def row(self) -> tuple:
        return (self.conv, self.turns, self.all.hexdigest(), self.loss, self.learned.hexdigest(), self.formatted)


def read_chats(segments: DataFrame, conv: str = "conv_id", vocabulary: str | None = None) -> DataFrame:
    """What formatted conversations say, read back from their ids and masks.

    (conv, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars).
    Each conversation streams through its task turn by turn, so that a long
    one takes time but no memory: a digest over its turns has to see them in order.
    """
    vocabulary = vocabulary or public_vocabulary()
    bounded_batches(segments.sparkSession)
    names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(vocabulary, special=False)
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        reading: _Reading | None = None
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if reading is None or row["conv"] != reading.conv:
                    done.extend([reading.row()] if reading else [])
                    reading = _Reading(row["conv"])
                reading.add(bpe, row["ids"], row["mask"])
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), kinds)], names)
        if reading:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(reading.row(), kinds)], names)

    placed = segments.select(F.col(conv).alias("conv"), "place", "ids", "mask")
    placed = placed.repartition("conv").sortWithinPartitions("conv", "place").drop("place")
    schema = "conv bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return placed.mapInArrow(run, schema).withColumnRenamed("conv", conv)
