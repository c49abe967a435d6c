"""Training a dense network by mini-batches where the rows are."""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators.ranges import in_order

# Hidden layers and batch of the network this trains, and the usual settings of Adam.
HIDDEN = (32, 64, 128, 256)
BATCH = 32
RATE, BETA1, BETA2, EPSILON = 1e-3, 0.9, 0.999, 1e-7
ROWS = 256  # that a trained network takes at a time
ZERO = np.zeros(())  # which costs numpy less than a Python number
LEAST = 1e-7  # probabilities are kept so far from 0 and 1 in logarithms
MEETINGS = 64  # of tasks that go on alone in between, per epoch at most


def initial(sizes: Sequence[int], seed: int) -> list[np.ndarray]:
    """Weights and biases of each layer, weights uniform within the limit for equal variances."""
    draw = np.random.default_rng(seed)
    out = []
    for a, b in zip(sizes, sizes[1:]):
        limit = np.sqrt(6.0 / (a + b))
        out += [draw.uniform(-limit, limit, (a, b)), np.zeros(b)]
    return out


def forward(weights: Sequence[np.ndarray], x: np.ndarray) -> list[np.ndarray]:
    """What every layer gives: rectified inside, a sigmoid for each class at the end."""
    layers = [x]
    for i in range(0, len(weights), 2):
        z = layers[-1] @ weights[i] + weights[i + 1]
        last = i == len(weights) - 2
        layers.append(1.0 / (1.0 + np.exp(-np.clip(z, -500, 500))) if last else np.maximum(z, 0.0))
    return layers


def losses(outputs: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cross-entropy of the classes' shares of the outputs, per row."""
    share = outputs[np.arange(len(y)), y] / np.maximum(outputs.sum(axis=1), LEAST)
    return -np.log(np.clip(share, LEAST, 1.0))


def gradient(weights: Sequence[np.ndarray], x: np.ndarray, y: np.ndarray) -> tuple[list[np.ndarray], float]:
    """The sum of the gradients over the rows, and the sum of their losses."""
    layers = forward(weights, x)
    out = layers[-1]
    rows = np.arange(len(y))
    # d loss / d z: the share of a class times (1 - output), less (1 - output) where it is the right one
    delta = out * (1 - out) / np.maximum(out.sum(axis=1, keepdims=True), LEAST)
    delta[rows, y] -= 1 - out[rows, y]
    found: list[np.ndarray] = []
    for i in range(len(weights) - 2, -1, -2):
        before = layers[i // 2]
        found = [before.T @ delta, delta.sum(axis=0), *found]
        if i:
            delta = (delta @ weights[i].T) * (before > 0)
    return found, float(losses(out, y).sum())


def _scale(steps: int, rate: float) -> float:
    return rate * np.sqrt(1 - BETA2**steps) / (1 - BETA1**steps)


def _moved(m: np.ndarray, v: np.ndarray, g: np.ndarray, scale: float, a: np.ndarray, b: np.ndarray) -> None:
    """Moments after a gradient, and in ``b`` what weights lose; ``a`` is room that is kept from step to step."""
    # (1 - b1) (g - m), (1 - b2) (g g - v) and scale m / (sqrt(v) + e)
    np.subtract(g, m, out=a)
    a *= 1 - BETA1
    m += a
    np.multiply(g, g, out=a)
    a -= v
    a *= 1 - BETA2
    v += a
    np.sqrt(v, out=a)
    a += EPSILON
    np.multiply(m, scale, out=b)
    b /= a


@dataclass
class Adam:
    """Weights with their running moments."""

    weights: list[np.ndarray]
    first: list[np.ndarray] = field(default_factory=list)
    second: list[np.ndarray] = field(default_factory=list)
    steps: int = 0
    scratch: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list, repr=False)

    def __post_init__(self):
        if not self.first:
            self.first = [np.zeros_like(w) for w in self.weights]
            self.second = [np.zeros_like(w) for w in self.weights]

    def step(self, gradients: Sequence[np.ndarray], rate: float = RATE) -> None:
        self.steps += 1
        scale = _scale(self.steps, rate)
        if not self.scratch:
            self.scratch = [(np.empty_like(w), np.empty_like(w)) for w in self.weights]
        for w, m, v, g, (a, b) in zip(self.weights, self.first, self.second, gradients, self.scratch):
            _moved(m, v, g, scale, a, b)
            w -= b


@dataclass(frozen=True)
class Network:
    """A trained network over named feature columns, and how its training went."""

    features: tuple[str, ...]
    weights: list[np.ndarray]
    history: tuple[dict, ...]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """Rows go through the layers a few at a time: what the layers of a whole table give leaves the core's cache."""
        x = np.asarray(x, np.float64)
        out = np.empty((len(x), self.weights[-1].size))
        for at in range(0, len(x), ROWS):
            out[at : at + ROWS] = forward(self.weights, x[at : at + ROWS])[-1]
        return out

    def loader(self) -> Callable[[], Callable[[np.ndarray], np.ndarray]]:
        """For ``models.foreign_scorer``."""
        return lambda: self.probabilities


def _flat(arrays: Sequence[np.ndarray]) -> np.ndarray:
    return np.concatenate([a.ravel() for a in arrays])


def _views(flat: np.ndarray, shapes: Sequence[tuple[int, ...]]) -> list[np.ndarray]:
    ends = np.cumsum([0, *[np.prod(s) for s in shapes]])
    return [flat[a:b].reshape(s) for a, b, s in zip(ends, ends[1:], shapes)]


def _pairs(arrays: Sequence[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    return list(zip(arrays[::2], arrays[1::2]))


def _shaped(flat: np.ndarray, like: Sequence[np.ndarray]) -> list[np.ndarray]:
    out, at = [], 0
    for a in like:
        out.append(flat[at : at + a.size].reshape(a.shape).copy())
        at += a.size
    return out


class Learner:
    """Weights and moments of one task, in one array each, and the room that its batches need.

    What it learns from a batch is what ``gradient`` and ``Adam`` do, operation by operation; it keeps all arrays of
    their size and takes one step for all layers.
    """

    def __init__(self, state: Adam, rate: float = RATE):
        self.shapes, self.steps, self.rate = [w.shape for w in state.weights], state.steps, rate
        self.weights, self.first, self.second = _flat(state.weights), _flat(state.first), _flat(state.second)
        self.slopes = np.empty_like(self.weights)
        self.scratch = np.empty_like(self.weights), np.empty_like(self.weights)
        self.layers = _pairs(_views(self.weights, self.shapes))
        self.found = _pairs(_views(self.slopes, self.shapes))
        self.rooms = {}

    def _room(self, n: int) -> tuple[list, list, list, np.ndarray]:
        """For so many rows: what layers give, its slopes, where it is above 0, and the rows' numbers."""
        if n not in self.rooms:  # only the last batch is of another size
            widths = [w.shape[1] for w, _ in self.layers]
            self.rooms = {n: tuple([np.empty((n, w), t) for w in widths] for t in (float, float, bool)) + (np.arange(n),)}
        return self.rooms[n]

    def learn(self, x: np.ndarray, y: np.ndarray) -> float:
        """One step by the mean gradient of a batch; the sum of its losses."""
        n, last = len(y), len(self.layers) - 1
        outputs, deltas, on, rows = self._room(n)
        z = x
        for i, (w, b) in enumerate(self.layers):
            z = np.matmul(z, w, out=outputs[i])
            z += b
            if i < last:
                np.maximum(z, ZERO, out=z)
        np.maximum(z, -500, out=z)
        np.minimum(z, 500, out=z)
        np.negative(z, out=z)
        np.exp(z, out=z)
        z += 1.0
        out = np.divide(1.0, z, out=z)
        total = np.maximum(np.add.reduce(out, axis=1), LEAST)
        share = out[rows, y] / total
        loss = -float(np.add.reduce(np.log(np.minimum(np.maximum(share, LEAST), 1.0))))
        rest = 1 - out
        delta = np.multiply(out, rest, out=deltas[last])
        delta /= total[:, None]
        delta[rows, y] -= rest[rows, y]
        delta /= n
        for i in range(last, -1, -1):
            w, b = self.found[i]
            np.matmul((outputs[i - 1] if i else x).T, deltas[i], out=w)
            np.add.reduce(deltas[i], axis=0, out=b)
            if i:
                np.matmul(deltas[i], self.layers[i][0].T, out=deltas[i - 1])
                deltas[i - 1] *= np.greater(outputs[i - 1], ZERO, out=on[i - 1])
        self.steps += 1
        a, b = self.scratch
        _moved(self.first, self.second, self.slopes, _scale(self.steps, self.rate), a, b)
        self.weights -= b
        return loss


def _gathered(context: BarrierTaskContext, values: np.ndarray) -> np.ndarray:
    """The sum over all tasks, added in the order of the tasks, so all tasks see the same number."""
    parts = context.allGather(base64.b64encode(values.astype(np.float64).tobytes()).decode())
    return np.sum([np.frombuffer(base64.b64decode(p)) for p in parts], axis=0)


def _batches(records: Iterable[pa.RecordBatch], features: int, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of the task in groups of ``size``, whatever the records' sizes."""
    x, y = np.zeros((0, features)), np.zeros(0, np.int64)
    for record in records:
        columns = [record.column(i).to_numpy(zero_copy_only=False) for i in range(features + 1)]
        x = np.concatenate([x, np.stack(columns[:-1], axis=1).astype(np.float64)])
        y = np.concatenate([y, columns[-1].astype(np.int64)])
        whole = len(y) // size * size
        for at in range(0, whole, size):
            yield x[at : at + size], y[at : at + size]
        x, y = x[whole:], y[whole:]
    if len(y):
        yield x, y


def _epoch(state: Adam, features: int, share: int, rate: float, every: int, alone: bool):
    """One pass over a task's rows, together with the other tasks."""

    def together(context, mine: Adam, batches) -> tuple[float, float]:
        """One batch of all tasks, their gradients summed; its loss and rows."""
        sums = np.zeros(sum(w.size for w in mine.weights) + 2)
        batch = next(batches, None)
        if batch is not None:
            found, loss = gradient(mine.weights, *batch)
            sums = np.concatenate([_flat(found), [loss, len(batch[1])]])
        sums = sums if alone else _gathered(context, sums)  # a task that has run out adds nothing
        if sums[-1]:
            mine.step(_shaped(sums[:-2] / sums[-1], mine.weights), rate)
        return float(sums[-2]), float(sums[-1])

    def apart(context, mine: Learner, batches) -> tuple[float, float]:
        """So many batches of each task by itself, then the mean of what they hold, by rows."""
        before, loss, n = mine.steps, 0.0, 0
        for batch in islice(batches, every):
            loss, n = loss + mine.learn(*batch), n + len(batch[1])
        if alone:
            return loss, float(n)
        held = np.concatenate([mine.weights, mine.first, mine.second])
        sums = _gathered(context, np.concatenate([held * n, [loss, n]]))
        if sums[-1]:
            mine.weights[:], mine.first[:], mine.second[:] = np.split(sums[:-2] / sums[-1], 3)
            mine.steps = before + every
        return float(sums[-2]), float(sums[-1])

    def run(records: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = BarrierTaskContext.get()
        if every == 1:
            mine = Adam([w.copy() for w in state.weights], [m.copy() for m in state.first], [v.copy() for v in state.second], state.steps)
        else:
            mine = Learner(state, rate)
        total = seen = 0.0
        batches = _batches(records, features, share)
        while True:
            loss, n = (together if every == 1 else apart)(context, mine, batches)
            if not n:
                break
            total, seen = total + loss, seen + n
        if context.partitionId() == 0:
            parts = [_flat(a).tobytes() for a in (mine.weights, mine.first, mine.second)]
            yield pa.RecordBatch.from_arrays(
                [*[pa.array([p], pa.binary()) for p in parts], pa.array([mine.steps]), pa.array([total]), pa.array([seen])],
                names=["weights", "first", "second", "steps", "loss", "rows"],
            )

    return run


def _evaluated(weights: list[np.ndarray], features: int):
    def run(records: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, y in _batches(records, features, 8192):
            out = forward(weights, x)[-1]
            sure = out >= 0.5
            right = int(sure[np.arange(len(y)), y].sum())
            values = [
                len(y), float(losses(out, y).sum()), int((out.argmax(axis=1) == y).sum()), right, int(sure.sum()),
            ]
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in values], names=["n", "loss", "hits", "right", "sure"])

    return run


def evaluate(df: DataFrame, features: Sequence[str], label: str, weights: list[np.ndarray]) -> dict:
    """Loss, accuracy, and precision and recall of all class outputs at one half; counted where the rows are."""
    rows = df.select(*[F.col(c).cast("double") for c in features], F.col(label).cast("bigint"))
    sums = rows.mapInArrow(_evaluated(weights, len(features)), "n bigint, loss double, hits bigint, right bigint, sure bigint")
    s = sums.agg(*[F.sum(c).alias(c) for c in sums.columns]).first()
    n = s["n"] or 0
    ratio = lambda a, b: a / b if b else None
    return {
        "rows": n, "loss": ratio(s["loss"], n), "accuracy": ratio(s["hits"], n), "precision": ratio(s["right"], s["sure"]),
        "recall": ratio(s["right"], n),
    }


def between_meetings(rows: int, batch: int, every: int) -> int:
    """Batches a task takes by itself, of so many rows: ``every``, or as many as make no more than ``MEETINGS`` of an epoch."""
    return max(every, -(-(-(-rows // batch)) // MEETINGS))


def train_network(
    df: DataFrame, features: Sequence[str], label: str, n_classes: int, unique: str, epochs: int = 2, seed: int = 42,
    validation: DataFrame | None = None, hidden: Sequence[int] = HIDDEN, batch: int = BATCH, workers: int | None = None,
    rate: float = RATE, every: int = 1,
) -> Network:
    """A dense network trained by Adam on batches of ``batch`` rows, drawn in a seeded order that epochs share.

    Rows are shuffled once by the hash of ``unique`` and the seed, and dealt
    to ``workers`` tasks (by default as many as there are cores), which run
    together in a barrier stage. With ``every`` 1 each task brings its share of
    every batch, and after each batch the gradients are summed in the order of
    the tasks, which is the training of one process at the price of a meeting
    of all tasks per batch, which takes Spark about a second. With more, each task takes so many batches of its own rows, and
    then all go on with the mean of their weights and moments; where that
    would make more than ``MEETINGS`` meetings of an epoch, it takes as many
    batches as make so few. Every row is learned from in every epoch. Either way all
    hold the same numbers and a run can be repeated. A task holds one batch of Arrow records at a time. Weights and
    moments come back to the driver after an epoch, so what a lost executor
    costs is an epoch. Rows with a missing feature or label are left out.
    """
    features = list(features)
    spark = df.sparkSession
    workers = workers or spark.sparkContext.defaultParallelism
    if every == 1:
        workers = min(workers, batch)
    share = -(-batch // workers) if every == 1 else batch
    columns = [*[F.col(c).cast("double").alias(c) for c in features], F.col(label).cast("bigint").alias("_label")]
    known = df.select(*columns, F.xxhash64(F.col(unique), F.lit(seed)).alias("_draw"), F.col(unique).alias("_unique")).dropna()
    for c in features:
        known = known.where(~F.isnan(c))
    shuffled = in_order(known, ["_draw", "_unique"])  # in the shared folder
    dealt = shuffled.withColumn("_worker", F.pmod(F.col("_pos"), F.lit(workers)).cast("int"))
    if every > 1 and workers > 1:
        every = between_meetings(dealt.groupBy("_worker").count().agg(F.max("count")).first()[0] or 0, batch, every)
    state = Adam(initial([len(features), *hidden, n_classes], seed))
    history = []
    for epoch in range(epochs):
        rows = dealt.repartitionById(workers, F.col("_worker")).sortWithinPartitions("_part", "_pos").select(*features, "_label")
        done = rows.mapInArrow(
            _epoch(state, len(features), share, rate, every, workers == 1),
            "weights binary, first binary, second binary, steps bigint, loss double, rows double", barrier=True,
        ).collect()  # one row: the state after the epoch, of the size of the network; none if there was nothing to learn
        entry = {"epoch": epoch + 1, "loss": None}
        if done and done[0]["rows"]:
            parts = [_shaped(np.frombuffer(done[0][c]), state.weights) for c in ("weights", "first", "second")]
            state = Adam(*parts, done[0]["steps"])
            entry["loss"] = done[0]["loss"] / done[0]["rows"]
        if validation is not None:
            entry |= {f"val_{k}": v for k, v in evaluate(validation, features, label, state.weights).items() if k != "rows"}
        history.append(entry)
    return Network(tuple(features), state.weights, tuple(history))


def train_here(
    x: np.ndarray, y: np.ndarray, n_classes: int, epochs: int, seed: int, hidden: Sequence[int] = HIDDEN, batch: int = BATCH,
    rate: float = RATE,
) -> tuple[list[np.ndarray], list[float]]:
    """The same training of rows in hand, in their order, in one process: what tests hold the distributed one against."""
    state, found = Adam(initial([x.shape[1], *hidden, n_classes], seed)), []
    for _ in range(epochs):
        total = 0.0
        for at in range(0, len(y), batch):
            part = slice(at, at + batch)
            sums, loss = gradient(state.weights, x[part], y[part])
            state.step([g / len(y[part]) for g in sums], rate)
            total += loss
        found.append(total / len(y))
    return state.weights, found
