"""Loss and gradient of the fraud network as one job, and a descent that keeps its state."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows stored together, and those of them computed together, which the processor's cache
# holds; steps remembered for the curvature; trials of one step's length.
PACKED_ROWS = 16_384
BLOCK_ROWS = 1000
MEMORY = 10
TRIALS = 12
# Steps over which MLlib's optimizer compares losses, and the gradient it takes for none.
LOSSES = 20
FLAT = 1e-8

PACKED = "packed"

Batches = Iterator[pa.RecordBatch]


def pack(rows: DataFrame, checked: bool = True) -> DataFrame:
    """``rows`` in blocks of up to ``PACKED_ROWS``, a row each, ``checked`` here once for all passes.

    ``rows`` has the label, 0 or 1, and then the inputs, all doubles. A block is stored by
    column, so that a pass hands a few bytes a row to Python instead of every value.
    """
    most = PACKED_ROWS

    def stored(table: pa.Table) -> pa.RecordBatch:
        label, *inputs = (column.to_numpy() for column in table.columns)
        if checked and not np.isin(label, (0, 1)).all():
            raise ValueError("labels must be 0 or 1")
        if checked and not all(np.isfinite(column).all() for column in inputs):
            raise ValueError("inputs must be finite")
        sink = pa.BufferOutputStream()
        pq.write_table(table, sink, compression="none", write_statistics=False)
        return pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()])], ["packed"])

    def run(batches: Batches) -> Batches:
        waiting, count = [], 0
        for batch in batches:
            waiting.append(batch)
            count += batch.num_rows
            if count >= most:
                table = pa.Table.from_batches(waiting)
                for start in range(0, count - most + 1, most):
                    yield stored(table.slice(start, most))
                waiting, count = table.slice(count - count % most).to_batches(), count % most
        if count:
            yield stored(pa.Table.from_batches(waiting))

    return rows.mapInArrow(run, f"{PACKED} binary")


def _packed(rows: DataFrame, checked: bool) -> DataFrame:
    return rows if rows.columns == [PACKED] else pack(rows, checked)


def loss_and_gradient(rows: DataFrame, sizes: list[int], weights: np.ndarray) -> tuple[float, np.ndarray]:
    """Mean cross-entropy of a sigmoid network with softmax output, and its gradient.

    ``rows`` are those of ``pack``, or what it takes. Weights lie as in MLlib's network. A task
    sends its sums, whose number the layers fix; they are added up before they reach the driver.
    """
    found = _packed(rows, True).mapInArrow(_sums(sizes, weights), "place int, value double")
    sums = np.zeros(len(weights) + 2)
    # As many rows as there are weights.
    total = found.groupBy("place").agg(F.sum("value").alias("value")).toArrow()
    sums[total["place"].to_numpy()] = total["value"].to_numpy()
    loss, count, *gradient = sums
    if not count:
        raise ValueError("no rows to train on")
    return loss / count, np.array(gradient) / count


def probabilities(
    rows: DataFrame, sizes: list[int], weights: np.ndarray, output: str, label: str | None = None
) -> DataFrame:
    """The label and the probability of class 1, as MLlib's network with these weights gives it.

    ``rows`` as for ``loss_and_gradient``; packed ones do not know what the ``label`` was called.
    """
    label = label or rows.columns[0]
    _, pieces, forward = _network(sizes, weights)

    def run(batches: Batches) -> Batches:
        for actual, values in pieces(batches):
            with np.errstate(over="ignore"):
                found = 1 / (1 + np.exp(-forward(values)))
            yield pa.RecordBatch.from_arrays([pa.array(actual, from_pandas=True), pa.array(found)], [label, output])

    return _packed(rows, False).mapInArrow(run, f"`{label}` double, `{output}` double")


def _network(sizes: list[int], weights: np.ndarray):
    """Each layer's weights by input, the bias as one more, and the functions that read packed rows and run them forward.

    They are closures, so that they travel with the tasks.
    """
    layers, first, most = [], 0, BLOCK_ROWS
    for a, b in zip(sizes, sizes[1:]):
        place = slice(first, first + (a + 1) * b)
        layers.append((place, weights[place].reshape(a + 1, b)))
        first = place.stop
    # Of two outputs only the difference counts.
    *hidden, last = (matrix.T.copy() for _, matrix in layers)
    hidden, last = [-matrix for matrix in hidden], last[1] - last[0]

    def pieces(batches: Batches) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
        """Labels, and the inputs of each layer by column, the first ones filled in, of rows computed together.

        The last input is one. The arrays are the same ones for all pieces: new memory is dearer
        than what is computed in it.
        """
        space = [np.ones((size + 1, most)) for size in sizes[:-1]]
        for batch in batches:
            for block in batch.column(0):
                table = pq.ParquetFile(pa.BufferReader(block.as_buffer())).read(use_threads=False)
                label, *columns = (column.to_numpy() for column in table.columns)
                for start in range(0, len(label), most):
                    actual = label[start : start + most]
                    values = [array[:, : len(actual)] for array in space]
                    for value, column in zip(values[0], columns):
                        value[:] = column[start : start + most]
                    yield actual, values

    def forward(values: list[np.ndarray]) -> np.ndarray:
        """Fills in the inputs of the later layers; returns the logarithm of the odds of class 1."""
        for matrix, before, after in zip(hidden, values, values[1:]):
            out = np.matmul(matrix, before, out=after[:-1])
            with np.errstate(over="ignore"):
                np.exp(out, out=out)
            out += 1
            np.reciprocal(out, out=out)
        return last @ values[-1]

    return layers, pieces, forward


def _sums(sizes: list[int], weights: np.ndarray) -> Callable[[Batches], Batches]:
    layers, pieces, forward = _network(sizes, weights)
    most = BLOCK_ROWS

    def run(batches: Batches) -> Batches:
        loss, count, gradient = 0.0, 0, np.zeros_like(weights)
        space = [np.empty((size, most)) for size in sizes]
        for label, values in pieces(batches):
            odds = forward(values)
            errors = [array[:, : len(label)] for array in space]
            # The loss is log(1 + exp(-odds)) of the actual class.
            small = np.exp(-np.abs(odds))
            loss += (np.maximum(odds, 0) - odds * label + np.log1p(small)).sum()
            count += len(label)
            error = errors[-1]
            np.subtract(np.where(odds < 0, small, 1.0) / (1 + small), label, out=error[1])
            np.negative(error[1], out=error[0])
            for n in reversed(range(len(layers))):
                (place, matrix), value = layers[n], values[n]
                gradient[place] += (value @ error.T).ravel()
                if n:
                    error, value = np.matmul(matrix[:-1], error, out=errors[n]), value[:-1]
                    error *= value
                    error *= np.subtract(1, value, out=value)
        if count:
            places = pa.array(np.arange(len(weights) + 2, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([places, pa.array(np.array([loss, count, *gradient]))], ["place", "value"])

    return run


class Descent:
    """Limited-memory BFGS, one step at a time, from where the last one ended.

    ``evaluate`` gives loss and gradient at some weights and is the dear part. A step
    lowers the loss enough for its length and, as far as ``TRIALS`` allow, flattens the slope.
    """

    def __init__(self, evaluate: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray):
        self._evaluate = evaluate
        self.weights = start
        self._loss, self._gradient = evaluate(start)
        self._pairs: list[tuple[np.ndarray, np.ndarray]] = []
        self._ended = False

    def _direction(self) -> np.ndarray:
        way, parts = -self._gradient, []
        for moved, turned in reversed(self._pairs):
            part = moved @ way / (moved @ turned)
            way = way - part * turned
            parts.append(part)
        if self._pairs:
            moved, turned = self._pairs[-1]
            way = way * (moved @ turned / (turned @ turned))
        for (moved, turned), part in zip(self._pairs, reversed(parts)):
            way = way + (part - turned @ way / (moved @ turned)) * moved
        return way

    def run(self, steps: int, tolerance: float) -> None:
        """Up to ``steps`` steps; fewer once they end, under the rules MLlib's optimizer stops by."""
        least, losses = tolerance * self._loss, deque([np.inf], LOSSES)
        for _ in range(steps):
            self.step()
            losses.append(self._loss)
            flat = np.linalg.norm(self._gradient) <= max(tolerance * self._loss, FLAT)
            if self._ended or flat or max(losses) - self._loss <= least:
                return

    def step(self) -> None:
        """Move once; the weights stay where nothing lower is found."""
        way = self._direction()
        slope = way @ self._gradient
        if self._ended or not slope < 0:
            return
        length = 1.0 if self._pairs else 1 / np.linalg.norm(self._gradient)
        low, high, found = 0.0, np.inf, None
        for _ in range(TRIALS):
            point = self.weights + length * way
            loss, gradient = self._evaluate(point)
            if not loss <= self._loss + 1e-4 * length * slope:
                high = length
            else:
                found, low = (point, loss, gradient), length
                if gradient @ way >= 0.9 * slope:
                    break
            length = 2 * low if high == np.inf else (low + high) / 2
        if found is None:
            # Once more without what is remembered, then no more.
            self._ended = not self._pairs
            self._pairs = []
            return
        point, loss, gradient = found
        moved, turned = point - self.weights, gradient - self._gradient
        if moved @ turned > 0:
            self._pairs = [*self._pairs, (moved, turned)][-MEMORY:]
        self.weights, self._loss, self._gradient = point, loss, gradient
