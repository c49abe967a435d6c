"""Quality scores by co-training a content view and a metadata view.

One logistic classifier sees how a text is written, the other what is known of
the page: source, language and length. Both start from the labelled sample. In
each round, each hands the unlabelled rows of which it is most certain, with
its verdict, to the other one's training set. In the end both are calibrated
together on labelled rows that neither was trained on: a logistic model of the
two log-odds gives the score of every document.

Of the labelled rows a bounded sample is used, which the driver holds as a few
megabytes of numbers and which stands for all of them by its weight. All other
documents can teach: both views of each are written once, and every step reads
them in Spark. What a view hands over is a share of the table, so it grows with
it. Which rows those are follows from the models and cuts of the rounds so far,
and a fit needs sums over them only, so nothing but these comes to the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Generator, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.llm.quality_rules import MEASURES, _sums, measure
from tablewright.llm.textbytes import Texts, batches_of, mixed
from tablewright.sources.workspace import stage

LABELLED_ROWS = 20_000  # labelled rows used, by a hash of the id
ROUNDS = 3
PER_ROUND = 400  # most pseudo-labels of a class that a view gives in a round
SHARE = 0.02  # of the unlabelled rows, if that is more
CERTAIN = 0.95
STEPS = 30  # most Newton steps of a fit
CALIBRATION_SHARE = 5  # one labelled row in so many calibrates
THRESHOLD = 0.5
LEVELS = 4096  # of certainty, between which a cut is placed; rows of one level are told apart by a hash
MOST_LOGIT = 40.0
SUM_TASKS = 256  # most tasks of a step, each of which sends its sums to the driver

# Kinds of bytes: other, lower, upper, digit, blank, line break, sentence mark,
# other ASCII mark.
KINDS = 8
_KIND = np.zeros(256, np.uint8)
_KIND[ord("a") : ord("z") + 1] = 1
_KIND[ord("A") : ord("Z") + 1] = 2
_KIND[ord("0") : ord("9") + 1] = 3
_KIND[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = 4
_KIND[0x0A] = 5
_KIND[list(b".,;:?'\"-")] = 6
_KIND[list(b"!#$%&()*+/<=>@[\\]^_`{|}~")] = 7

SOURCES, LANGUAGES, LENGTHS = 64, 32, 20


def content_view(texts: Texts) -> np.ndarray:
    """Numbers that say how each text is written; a row per text."""
    n = len(texts)
    size = np.maximum(np.diff(texts.offsets), 1)
    kind = _KIND[texts.data].astype(np.int64)
    doc = np.repeat(np.arange(n), np.diff(texts.offsets))
    pairs = np.zeros((n, KINDS * KINDS))
    if len(kind):
        inside = doc[1:] == doc[:-1]
        index = (doc[1:] * KINDS * KINDS + kind[:-1] * KINDS + kind[1:])[inside]
        pairs = np.bincount(index, minlength=n * KINDS * KINDS).reshape(n, -1) / size[:, None]
    found = dict(zip(MEASURES, measure(texts)))
    start, end, first = texts.words()
    words = np.maximum(found["n_words"], 1)
    spelled = texts.spans_hash(texts.prefix(), start, end)
    owner = np.repeat(np.arange(n), np.diff(first))
    order = np.lexsort((spelled, owner))
    new = np.ones(len(order), bool)
    s, o = spelled[order], owner[order]
    new[1:] = (s[1:] != s[:-1]) | (o[1:] != o[:-1])
    distinct = np.bincount(o[new], minlength=n)
    twice = _sums((spelled[1:] == spelled[:-1]) & (owner[1:] == owner[:-1]), np.minimum(first, max(len(spelled) - 1, 0)))
    lines = np.bincount(doc[texts.data == 0x0A], minlength=n) + 1
    return np.column_stack(
        [
            np.log1p(found["n_words"]), found["word_chars"] / words, found["n_symbols"] / size, found["n_dup_lines"] / lines,
            found["n_repeat_words"] / words, distinct / words, twice / words, np.log1p(words / lines),
            found["n_words"] < 20, found["n_words"] < 50, np.sqrt(pairs),
        ]
    ).astype(np.float32)


CONTENT = 10 + KINDS * KINDS


def metadata_numbers(source: Column, lang: Column, n_chars: Column) -> tuple[Column, Column, Column]:
    """Hashed source and language, and the logarithm of the length."""
    return (
        F.pmod(F.xxhash64(source), F.lit(SOURCES)), F.pmod(F.xxhash64(lang), F.lit(LANGUAGES)),
        F.log2(F.greatest(F.coalesce(n_chars, F.lit(0)), F.lit(0)).cast("double") + 1),
    )


def metadata_columns(source: Column, lang: Column, n_chars: Column) -> Column:
    """Source and language as hashed indicators, the length as an indicator of its power of two and a number."""
    source_at, lang_at, length = metadata_numbers(source, lang, n_chars)

    def indicators(value: Column, width: int) -> list[Column]:
        return [F.coalesce((value == i).cast("float"), F.lit(0.0).cast("float")) for i in range(width)]

    return F.array(
        *indicators(source_at, SOURCES),
        *indicators(lang_at, LANGUAGES),
        *indicators(F.least(F.floor(length), F.lit(LENGTHS - 1)), LENGTHS),
        length.cast("float"),
    )


def metadata_view(source: np.ndarray, lang: np.ndarray, length: np.ndarray) -> np.ndarray:
    """What ``metadata_columns`` gives, from the numbers of source and language and the length's logarithm."""
    out = np.zeros((len(length), SOURCES + LANGUAGES + LENGTHS + 1))
    row = np.arange(len(length))
    out[row, source] = 1
    out[row, SOURCES + lang] = 1
    out[row, SOURCES + LANGUAGES + np.minimum(length.astype(np.int64), LENGTHS - 1)] = 1
    out[:, -1] = length.astype(np.float32)
    return out


def _content(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in batches_of(batches, "_text"):
        view = content_view(texts)
        at = np.arange(0, view.size + 1, CONTENT, dtype=np.int32) if view.size else np.zeros(len(texts) + 1, np.int32)
        content = pa.ListArray.from_arrays(pa.array(at), pa.array(view.ravel()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("__row"), batch.column("__metadata"), content], names=["__row", "__metadata", "__content"]
        )


@dataclass(frozen=True)
class Logistic:
    """A fitted linear model of the log-odds."""

    weights: np.ndarray
    intercept: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights + self.intercept

    def column(self, features: str) -> Column:
        weights = F.array(*[F.lit(float(w)) for w in self.weights])
        product = F.zip_with(features, weights, lambda x, w: x * w)
        return F.aggregate(product, F.lit(self.intercept), lambda s, x: s + x)


@dataclass
class Sums:
    """What a step of a fit needs of weighted rows: moments of the features, and loss, slope and curvature at a model."""

    rows: float
    positive: float
    loss: float
    x: np.ndarray
    squares: np.ndarray
    slope: np.ndarray
    curvature: np.ndarray

    @classmethod
    def of(cls, x: np.ndarray, y: np.ndarray, model: Logistic, weight: float = 1.0) -> Sums:
        t = model.logit(x)
        p = 1 / (1 + np.exp(-np.clip(t, -MOST_LOGIT, MOST_LOGIT)))
        z = np.column_stack([x, np.ones(len(x))])
        return cls(
            weight * len(y), weight * float(y.sum()), weight * float(np.logaddexp(0, t).sum() - t @ y),
            weight * x.sum(axis=0), weight * (x * x).sum(axis=0), weight * (z.T @ (p - y)),
            weight * ((z.T * np.maximum(p * (1 - p), 1e-9)) @ z),
        )

    def flat(self) -> np.ndarray:
        return np.concatenate([[self.rows, self.positive, self.loss], self.x, self.squares, self.slope, self.curvature.ravel()])

    @classmethod
    def from_flat(cls, flat: np.ndarray, width: int) -> Sums:
        x, squares, slope, curvature = np.split(flat[3:], [width, 2 * width, 3 * width + 1])
        return cls(*flat[:3].tolist(), x, squares, slope, curvature.reshape(width + 1, width + 1))

    @staticmethod
    def size(width: int) -> int:
        return 3 + 2 * width + (width + 1) + (width + 1) ** 2


def newton(start: Logistic, ridge: float = 1e-3) -> Generator[Logistic, Sums, Logistic]:
    """A logistic model of 0/1 labels, by Newton steps on standardised features; a constant if only one class is there.

    Yields the models at which it needs the sums over the rows. Features that
    ``start`` uses must vary in the rows.
    """
    s = yield start
    width = len(s.x)
    if s.positive <= 0 or s.positive >= s.rows:
        return Logistic(np.zeros(width), 3.0 if s.rows <= 0 or s.positive > 0 else -3.0)
    mean = s.x / s.rows
    scale = np.sqrt(np.maximum(s.squares / s.rows - mean * mean, 0))
    used = np.flatnonzero(scale > 1e-6)
    # weights of raw features and intercept, from those of standardised ones
    raw = np.zeros((width + 1, len(used) + 1))
    raw[used, np.arange(len(used))] = 1 / scale[used]
    raw[-1, :-1] = -mean[used] / scale[used]
    raw[-1, -1] = 1
    penalty = np.full(len(used) + 1, ridge * s.rows)
    penalty[-1] = 1e-9  # not on the intercept
    w = np.append(start.weights[used] * scale[used], start.intercept + start.weights @ mean)
    now = s.loss + (penalty * w * w).sum() / 2
    for _ in range(STEPS):
        gradient = raw.T @ s.slope + penalty * w
        step = np.linalg.solve(raw.T @ s.curvature @ raw + np.diag(penalty), gradient)
        if gradient @ step < 1e-8 * s.rows:
            break  # what a step could still gain
        size = 1.0
        while True:
            trial = w - size * step
            both = raw @ trial
            s = yield Logistic(both[:-1], float(both[-1]))
            after = s.loss + (penalty * trial * trial).sum() / 2
            if after <= now or size < 1e-6:
                break
            size /= 2
        if after > now:
            break
        w, now = trial, after
    both = raw @ w
    return Logistic(both[:-1], float(both[-1]))


def fitted(fits: dict[str, Generator], total: Callable[[dict[str, Logistic]], dict[str, Sums]]) -> dict[str, Logistic]:
    """The results of several fits that take their steps together."""
    asked = {name: next(fit) for name, fit in fits.items()}
    done: dict[str, Logistic] = {}
    while asked:
        sums = total(asked)
        for name in list(asked):
            try:
                asked[name] = fits[name].send(sums[name])
            except StopIteration as end:
                done[name] = end.value
                del asked[name]
    return done


@dataclass(frozen=True)
class CoTrained:
    """Both views' models and the model that joins their log-odds."""

    content: Logistic
    metadata: Logistic
    joined: Logistic

    def score(self) -> Column:
        z = F.array(F.col("content_logit"), F.col("metadata_logit"))
        return 1 / (1 + F.exp(-F.aggregate(
            F.zip_with(z, F.array(*[F.lit(float(w)) for w in self.joined.weights]), lambda x, w: x * w),
            F.lit(self.joined.intercept), lambda s, x: s + x,
        )))


def _views(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of each row as ``__row``, and both its views."""
    flat = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("__row"),
        metadata_columns(F.col("source"), F.col("lang"), F.col("n_chars")).alias("__metadata"),
        F.col("text").alias("_text"),
    )
    floats = T.ArrayType(T.FloatType())
    return flat.mapInArrow(
        _content, T.StructType([flat.schema["__row"], T.StructField("__metadata", floats), T.StructField("__content", floats)])
    )


def clear_labels(labels: DataFrame, label: str = "quality") -> DataFrame:
    """(doc_id, label) of the documents whose labels are there and agree."""
    return (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id")
        .agg(F.min(label).cast("int").alias("label"), F.max(label).cast("int").alias("_other"))
        .where("label = _other AND label IN (0, 1)").drop("_other")
    )


@dataclass(frozen=True)
class Handed:
    """What the views hand to each other in a round: their models, and per view and verdict the cut.

    Of the rows at the level of the cut, the part that the cut names goes,
    all above it do.
    """

    models: dict[str, Logistic]
    cuts: dict[tuple[str, int], tuple[int, float]]


WIDTHS = {"content": CONTENT, "metadata": SOURCES + LANGUAGES + LENGTHS + 1}
TEACHES = {"content": "metadata", "metadata": "content"}
_LEAST_LOGIT = math.log(CERTAIN / (1 - CERTAIN))


def levels(logit: np.ndarray) -> np.ndarray:
    """Levels of certainty that the label is 1; below 0 if it is not certain."""
    part = (np.minimum(logit, MOST_LOGIT) - _LEAST_LOGIT) / (MOST_LOGIT - _LEAST_LOGIT)
    return np.where(part < 0, -1, np.minimum(part * LEVELS, LEVELS - 1)).astype(np.int64)


def pseudo_labels(views: dict[str, np.ndarray], marks: np.ndarray, rounds: list[Handed]) -> dict[str, np.ndarray]:
    """Labels that each view's training set has of some unlabelled rows after some rounds; nan where none."""
    given = {view: np.full(len(marks), np.nan) for view in views}
    for turn, handed in enumerate(rounds):
        after = {}
        for i, (view, other) in enumerate(TEACHES.items()):
            logit = handed.models[view].logit(views[view])
            drawn = mixed(marks ^ mixed(np.array([2 * turn + i + 1], np.uint64))) / 2.0**64
            after[other] = given[other].copy()
            for verdict, sign in ((1, 1), (0, -1)):
                level, (cut, part) = levels(sign * logit), handed.cuts[view, verdict]
                take = (level > cut) | ((level == cut) & (drawn < part))
                after[other][take & (level >= 0) & np.isnan(given[other])] = verdict
        given = after
    return given


def cut_of(counts: np.ndarray, most: int) -> tuple[int, float]:
    """The level that the first ``most`` rows from the top reach, and the part of its rows that are among them."""
    above = np.append(np.cumsum(counts[::-1])[::-1], 0)
    if above[0] <= most:
        return -1, 0.0
    level = int(np.flatnonzero(above > most)[-1])
    return level, float((most - above[level + 1]) / counts[level])


def _stored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept = ["doc_id", "label", "spare", "mark", "source", "lang", "length"]
    for batch, texts in batches_of(batches, "_text"):
        view = content_view(texts)
        rows = pa.array([row.tobytes() for row in view], pa.binary())
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], rows], names=[*kept, "content"])


def _views_of(rows: pa.RecordBatch | pa.Table) -> dict[str, np.ndarray]:
    content = np.frombuffer(b"".join(rows.column("content").to_pylist()), np.float32).astype(np.float64)
    numbers = [np.asarray(rows.column(c)) for c in ("source", "lang", "length")]
    return {"content": content.reshape(-1, CONTENT), "metadata": metadata_view(*numbers)}


def _summed(rows: DataFrame, size: int, of: Callable[[dict[str, np.ndarray], np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of ``of`` (``size`` numbers) over all batches of stored rows, added up in the order of the tasks."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += of(_views_of(batch), np.asarray(batch.column("mark")).view(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["total"])

    tasks = min(2 * rows.sparkSession.sparkContext.defaultParallelism, SUM_TASKS)
    found = rows.coalesce(tasks).mapInArrow(run, "total binary").collect()
    return sum((np.frombuffer(r["total"], np.float64) for r in found), np.zeros(size))


def co_train(
    docs: DataFrame, labels: DataFrame, label: str = "quality", labelled_rows: int = LABELLED_ROWS, rounds: int = ROUNDS,
    per_round: int = PER_ROUND, share: float = SHARE,
) -> CoTrained:
    """Fit both views on at most ``labelled_rows`` labelled documents, chosen by a hash of the id, and all others.

    In a round, a view gives at most ``per_round`` of the others to each
    class, or a ``share`` of them if that is more. Labelled documents beyond
    ``labelled_rows`` are among the others.
    """
    known = clear_labels(labels, label).join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    known = stage(known, "labels")
    sample = stage(known.orderBy(F.xxhash64("doc_id", F.lit(11)), "doc_id").limit(labelled_rows), "labelled")
    source, lang, length = metadata_numbers(F.col("source"), F.col("lang"), F.col("n_chars"))
    spare = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(CALIBRATION_SHARE)) == 0
    # bounded: labelled_rows rows of two numbers
    needed = docs.select("doc_id", "text", "source", "lang", "n_chars").join(F.broadcast(sample), "doc_id", "left")
    flat = needed.select(
        "doc_id", "label", spare.alias("spare"), F.xxhash64("doc_id", "text").alias("mark"), source.cast("int").alias("source"),
        lang.cast("int").alias("lang"), length.alias("length"), F.col("text").alias("_text"),
    )
    kind = flat.schema["doc_id"].dataType.simpleString()
    stored = stage(flat.mapInArrow(
        _stored,
        f"doc_id {kind}, label int, spare boolean, mark bigint, source int, lang int, length double, content binary",
    ), "views")
    labelled = stored.where("label IS NOT NULL").dropDuplicates(["doc_id"]).toArrow().sort_by("doc_id")
    weight = known.count() / max(len(labelled), 1)
    return _exchange(labelled, weight, stored.where("label IS NULL"), rounds, per_round, share)


def _exchange(
    labelled: pa.Table, weight: float, others: DataFrame, rounds: int, per_round: int, share: float
) -> CoTrained:
    """The rounds of co-training; a labelled row counts ``weight`` times."""
    views = _views_of(labelled)
    label = labelled.column("label").to_numpy().astype(np.float64)
    spare = labelled.column("spare").to_numpy().astype(bool)
    handed: list[Handed] = []

    def total(models: dict[str, Logistic]) -> dict[str, Sums]:
        """Sums over a view's training set: labelled rows here, pseudo-labelled ones where they are."""
        order = sorted(models)
        found = {v: Sums.of(views[v][~spare], label[~spare], models[v], weight) for v in order}
        if not handed:
            return found

        def of(x: dict[str, np.ndarray], marks: np.ndarray) -> np.ndarray:
            given = pseudo_labels(x, marks, handed)
            there = {v: ~np.isnan(given[v]) for v in order}
            return np.concatenate([Sums.of(x[v][there[v]], given[v][there[v]], models[v]).flat() for v in order])

        sizes = [Sums.size(WIDTHS[v]) for v in order]
        parts = np.split(_summed(others, sum(sizes), of), np.cumsum(sizes)[:-1])
        return {v: Sums.from_flat(found[v].flat() + part, WIDTHS[v]) for v, part in zip(order, parts)}

    keys = [(view, verdict) for view in TEACHES for verdict in (1, 0)]
    models = {view: Logistic(np.zeros(width), 0.0) for view, width in WIDTHS.items()}
    for turn in range(rounds + 1):
        models = fitted({view: newton(models[view]) for view in WIDTHS}, total)
        if turn == rounds:
            break

        def certain(x: dict[str, np.ndarray], marks: np.ndarray) -> np.ndarray:
            """Rows, and those without a label from the view yet at each level, by view and verdict."""
            given, counts = pseudo_labels(x, marks, handed), []
            for view, verdict in keys:
                level = levels(models[view].logit(x[view]) * (1 if verdict else -1))
                free = (level >= 0) & np.isnan(given[TEACHES[view]])
                counts.append(np.bincount(level[free], minlength=LEVELS))
            return np.concatenate([[len(marks)], *counts]).astype(np.float64)

        found = _summed(others, 1 + len(keys) * LEVELS, certain)
        most = max(per_round, math.ceil(share * found[0]))
        cuts = {key: cut_of(c, most) for key, c in zip(keys, found[1:].reshape(len(keys), LEVELS))}
        handed.append(Handed(models, cuts))
    z = np.column_stack([models[view].logit(x) for view, x in views.items()])[spare]
    start = {"joined": newton(Logistic(np.zeros(2), 0.0))}
    joined = fitted(start, lambda m: {"joined": Sums.of(z, label[spare], m["joined"])})["joined"]
    if not joined.weights.any():
        joined = Logistic(np.array([1.0, 0.0]), 0.0)  # nothing to calibrate on: the content view alone
    return CoTrained(models["content"], models["metadata"], joined)


def score(docs: DataFrame, model: CoTrained, keep: list[str] | None = None) -> DataFrame:
    """Every row with content_logit, metadata_logit and score, the probability of label 1.

    ``keep`` names the columns passed on, by default all; columns named like
    an added one are replaced. A missing text counts as empty, a missing
    source, language or length as none. Repeated rows get equal scores. An
    empty table gives an empty one.
    """
    added = ["content_logit", "metadata_logit", "score"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added]
    seen = _views(docs, keep).select(
        "__row.*", model.content.column("__content").alias("content_logit"),
        model.metadata.column("__metadata").alias("metadata_logit"),
    )
    return seen.withColumn("score", model.score())
