"""Perceptron training: tasks multiply blocks of rows, the driver holds only the weights.

The function that is minimised, its start and its stop are those of Spark ML's perceptron
(sigmoid hidden layers, softmax, mean cross entropy, L-BFGS); the products go through NumPy.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 512
DIRECT = 32
HISTORY = 10
WINDOW = 20
TRIALS = 20


def _layers(weights: np.ndarray, sizes: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Views of each layer's matrix (inputs x outputs) and offsets, in Spark ML's order."""
    found, at = [], 0
    for inputs, outputs in zip(sizes, sizes[1:]):
        end = at + inputs * outputs
        found.append((weights[at:end].reshape(inputs, outputs), weights[end:end + outputs]))
        at = end + outputs
    return found


def first_weights(sizes: Sequence[int], seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    parts = [
        rng.uniform(-2.4, 2.4, (inputs + 1) * outputs) / np.sqrt(inputs)
        for inputs, outputs in zip(sizes, sizes[1:])
    ]
    return np.concatenate(parts)


def _add_slopes(
    weights: np.ndarray, sizes: Sequence[int], x: np.ndarray, y: np.ndarray, slopes: np.ndarray
) -> float:
    """Cross entropy summed over the rows of a block; its slopes are added to ``slopes``."""
    layers = _layers(weights.astype(np.float32), sizes)
    values = [x]
    for matrix, offsets in layers[:-1]:
        z = values[-1] @ matrix
        z += offsets
        np.negative(z, out=z)
        np.exp(np.minimum(z, 80, out=z), out=z)
        z += 1
        values.append(np.reciprocal(z, out=z))
    z = (values[-1] @ layers[-1][0]).astype(np.float64) + layers[-1][1]
    z -= z.max(axis=1, keepdims=True)
    rows = np.arange(len(y))
    right = z[rows, y]
    np.exp(z, out=z)
    total = z.sum(axis=1)
    loss = float((np.log(total) - right).sum())
    z /= total[:, None]
    z[rows, y] -= 1
    error = z.astype(np.float32)
    places = _layers(slopes, sizes)
    for i in range(len(layers) - 1, -1, -1):
        places[i][0][...] += values[i].T @ error
        places[i][1][...] += error.sum(axis=0, dtype=np.float64)
        if i:
            v = values[i]
            error = error @ layers[i][0].T
            error *= v
            error *= 1 - v
    return loss


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (features, class) as one row each: the bytes of their arrays."""
    for batch in batches:
        if batch.num_rows:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.float32)
            y = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            yield pa.RecordBatch.from_pydict({"x": [x.tobytes()], "y": [y.tobytes()]})


def _arrays(row) -> tuple[np.ndarray, np.ndarray]:
    y = np.frombuffer(row["y"], np.int64)
    return np.frombuffer(row["x"], np.float32).reshape(len(y), -1), y


def _direction(slopes: np.ndarray, past: deque) -> np.ndarray:
    d, alphas = -slopes, []
    for step, change in reversed(past):
        a = step @ d / (step @ change)
        alphas.append(a)
        d -= a * change
    if past:
        step, change = past[-1]
        d *= (step @ change) / (change @ change)
    for (step, change), a in zip(past, reversed(alphas)):
        d += (a - change @ d / (step @ change)) * step
    return d


def _line_search(
    cost: Callable, w: np.ndarray, loss: float, slopes: np.ndarray, d: np.ndarray, t: float
):
    """A step that lowers the loss enough and flattens the slope (weak Wolfe conditions);
    without one, the best step seen, or None."""
    down, low, high, best = slopes @ d, 0.0, np.inf, None
    for _ in range(TRIALS):
        at = w + t * d
        value, there = cost(at)
        if np.isfinite(value) and value <= loss + 1e-4 * t * down:
            if best is None or value <= best[1]:
                best = at, value, there
            if there @ d >= 0.9 * down:
                return at, value, there
            low = t
        else:
            high = t
        t = (low + high) / 2 if np.isfinite(high) else 2 * t
    return best


def minimise(cost: Callable, w: np.ndarray, iterations: int, tolerance: float) -> np.ndarray:
    """L-BFGS; ends after ``iterations``, or when the loss has not fallen by ``tolerance`` of
    the first one over the last steps, or the slopes are as good as zero."""
    loss, slopes = cost(w)
    start = loss
    past: deque = deque(maxlen=HISTORY)
    losses = deque([loss], maxlen=WINDOW)
    for _ in range(iterations):
        if np.linalg.norm(slopes) <= max(tolerance * abs(loss), 1e-8):
            break
        d = _direction(slopes, past)
        if d @ slopes >= 0:
            past.clear()
            d = -slopes
        found = _line_search(
            cost, w, loss, slopes, d, 1.0 if past else 1 / max(1.0, float(np.linalg.norm(d)))
        )
        if found is None:
            if not past:
                break
            past.clear()
            continue
        at, value, there = found
        step, change = at - w, there - slopes
        if step @ change > 1e-12 * (change @ change):
            past.append((step, change))
        w, loss, slopes = at, value, there
        losses.append(loss)
        if len(losses) == WINDOW and losses[0] - loss <= tolerance * start:
            break
    return w


def fit_weights(
    df: DataFrame, features: str, label: str, sizes: Sequence[int], iterations: int, seed: int,
    tolerance: float = 1e-6,
) -> np.ndarray:
    """Weights of a perceptron of ``sizes``, for a vector column and numbered classes. Every
    step reads all rows; tasks send slopes, which are added up in a tree."""
    context = df.sparkSession.sparkContext
    rows = df.select(vector_to_array(features, "float32").alias("x"), F.col(label).cast("long").alias("y"))
    blocks = rows.mapInArrow(_blocks, "x binary, y binary").rdd.map(_arrays)
    blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
    sizes = list(sizes)
    depth = 1 if blocks.getNumPartitions() <= DIRECT else 2

    def cost(w: np.ndarray) -> tuple[float, np.ndarray]:
        sent = context.broadcast(w)

        def task(parts: Iterator) -> Iterator[tuple[int, float, np.ndarray]]:
            slopes, loss, n = np.zeros(len(sent.value)), 0.0, 0
            for x, y in parts:
                for i in range(0, len(y), BLOCK_ROWS):
                    part = slice(i, i + BLOCK_ROWS)
                    loss += _add_slopes(sent.value, sizes, x[part], y[part], slopes)
                n += len(y)
            yield n, loss, slopes

        n, loss, slopes = blocks.mapPartitions(task).treeReduce(
            lambda a, b: (a[0] + b[0], a[1] + b[1], a[2] + b[2]), depth
        )
        sent.destroy()
        return loss / n, slopes / n

    try:
        return minimise(cost, first_weights(sizes, seed), iterations, tolerance)
    finally:
        blocks.unpersist()
