"""Directed search for the nearest input with another outcome."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.models import REACHED, SEED, STEPS, Scorer, proposed
from tablewright.operators.ranges import parts_for
from tablewright.sources.workspace import stage

BEAM = 4  # points of a row that are carried from round to round
GRID = 16  # places tried at once between one that fails and one that reaches
BISECTIONS = 3  # narrowings of a feature's way back, each by GRID
ROWS_PER_TASK = 200_000  # points tried
_FAR = 1e9  # the estimate of a point that does not lead towards the goal

_POINT = ["est", "d", "p", "x"]


def _once(value: Column) -> Column:
    """The value, computed once: a generator keeps the optimiser from writing the expression into all its uses."""
    return F.explode(F.array(value))


def _distance(x: Column, origin: Column) -> Column:
    moved = F.zip_with(x, origin, lambda a, b: F.abs(a - b))
    return F.aggregate(moved, F.lit(0.0), lambda total, v: total + v)


def _scored(points: DataFrame, features: Sequence[str], score: Scorer, class_index: int) -> DataFrame:
    """``points`` (with the array ``x``) and the probability ``p`` of the class."""
    wide = points.withColumns({c: F.col("x")[j] for j, c in enumerate(features)})
    return score(wide).withColumn("p", _once(F.col("probabilities")[class_index].cast("double"))).drop(*features, "probabilities")


def _with(x: Column, j: Column, value: Column) -> Column:
    return F.transform(x, lambda v, i: F.when(i == j, value).otherwise(v))


def _explored(tried: DataFrame, threshold: float, beam: int) -> DataFrame:
    """Of the points tried for a row: the ways to go on with, the ways that reach, and the nearest point that reaches.

    A point's estimate is the distance at which the goal would be met if the
    probability went on rising from the row's own as it did up to the point.
    """
    gain = F.col("p") - F.col("p0")
    est = F.when(gain > 0, F.col("d") * (F.lit(threshold) - F.col("p0")) / gain).otherwise(F.lit(_FAR) + F.col("d"))
    points = tried.withColumn("est", F.round(est, 9)).withColumn("point", _once(F.struct(*_POINT)))
    reached = F.col("p") >= threshold
    # bounded sets: the moves from the points of one beam
    first = lambda array: F.slice(F.array_sort(array), 1, beam)
    found = points.groupBy("id").agg(
        F.first("x0").alias("x0"), F.first("p0").alias("p0"), F.first("last").alias("last"),
        first(F.collect_set(F.when(F.col("way") & ~reached, F.col("point")))).alias("beam"),
        F.collect_set(F.when(F.col("way") & reached, F.col("point"))).alias("_new"),
        F.first("goals").alias("goals"),
        F.min(F.when(reached, F.struct("d", "p", "x"))).alias("best"),
    )
    return found.withColumn("goals", first(F.array_union(F.col("goals"), F.col("_new")))).drop("_new")


def _moves(state: DataFrame, n: int, seed: int, round_: int) -> DataFrame:
    """The points to try next: each of the beam with one more feature at a bound, and changes of the nearest that reaches.

    These are every feature at 0, at 1, back, half way back, and at a seeded
    place, and the point itself. What is tried from the beam is a way.
    """
    per_feature = 5
    best = F.struct(
        F.lit(False).alias("way"), F.coalesce(F.col("best.x"), F.col("x0")).alias("x"),
    )
    sources = F.concat(F.transform("beam", lambda b: F.struct(F.lit(True).alias("way"), b["x"].alias("x"))), F.array(best))
    points = state.select("id", "x0", "p0", "goals", F.col("best").alias("last"), F.explode(sources).alias("from"))
    tried = points.withColumn("m", F.explode(F.sequence(F.lit(-1), F.lit(per_feature * n - 1))))
    j, kind = F.expr(f"m div {per_feature}").cast("int"), F.col("m") % per_feature
    own, origin = F.element_at("from.x", j + 1), F.element_at("x0", j + 1)
    drawn = F.pmod(F.xxhash64("id", "m", F.lit(f"{seed}/{round_}")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    target = (
        F.when(kind == 0, F.lit(0.0)).when(kind == 1, F.lit(1.0)).when(kind == 2, origin)
        .when(kind == 3, (own + origin) / 2).otherwise(drawn)
    )
    further = (F.col("m") >= 0) & (kind < 2) & (own != target)
    tried = tried.where(~F.col("from.way") | further)
    x = F.when(F.col("m") < 0, F.col("from.x")).otherwise(_with(F.col("from.x"), j, target))
    return tried.select("id", "x0", "p0", "goals", "last", F.col("from.way").alias("way"), _once(x).alias("x"))


def _back(state: DataFrame, features: Sequence[str], score: Scorer, class_index: int, threshold: float) -> DataFrame:
    """Move the one feature of each row's best point back to the original whose way back is longest and still reaches.

    Every feature is tried by itself: its way is narrowed between a share that
    reaches and one that does not, by ``GRID`` places at a time.
    """
    n = len(features)
    # numbers in columns of their own and bits of places: a grouped row stays a few words, and nothing is sorted
    ways = state.where(F.col("best").isNotNull()).select(
        "id", *[F.col("x0")[i].alias(f"_o{i}") for i in range(n)], *[F.col("best.x")[i].alias(f"_y{i}") for i in range(n)],
        F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("j"),
    ).withColumns({"low": F.lit(-1.0 / GRID), "high": F.lit(1.0)})
    kept = [*[f"_o{i}" for i in range(n)], *[f"_y{i}" for i in range(n)], "low", "high"]
    share_at = lambda t: F.greatest(F.col("low") + (F.col("high") - F.col("low")) * t / GRID, F.lit(0.0))
    for _ in range(BISECTIONS):
        tried = ways.withColumn("t", F.explode(F.sequence(F.lit(1), F.lit(GRID - 1)))).withColumn("share", _once(share_at(F.col("t"))))
        moved = [
            F.when(F.col("j") == i, F.col(f"_o{i}") + F.col("share") * (F.col(f"_y{i}") - F.col(f"_o{i}"))).otherwise(F.col(f"_y{i}"))
            for i in range(n)
        ]
        found = _scored(tried.withColumn("x", _once(F.array(*moved))), features, score, class_index)
        bits = lambda there: F.bit_or(F.when(there, F.expr("shiftleft(1, t)")))
        # rows of an id lie together, so this moves nothing
        ways = found.groupBy("id", "j").agg(
            *[F.first(c).alias(c) for c in kept],
            F.coalesce(bits(F.col("p") >= threshold), F.lit(0)).alias("_hit"), F.coalesce(bits(F.col("p") < threshold), F.lit(0)).alias("_miss"),
        )
        # the first place that reaches, and the last before it that does not
        before = F.when(F.col("_hit") != 0, F.expr("_miss & ((_hit & -_hit) - 1)")).otherwise(F.col("_miss"))
        first, last = F.expr("bit_count((_hit & -_hit) - 1)"), F.length(F.bin(before)) - 1
        ways = ways.select(
            "id", "j", *kept[:-2],
            F.when(before != 0, F.greatest(F.col("low"), share_at(last))).otherwise(F.col("low")).alias("low"),
            F.when(F.col("_hit") != 0, F.least(F.col("high"), share_at(first))).otherwise(F.col("high")).alias("high"),
        )
    arrays = [F.array(*[F.col(f"_{c}{i}") for i in range(n)]).alias(name) for c, name in (("o", "x0"), ("y", "y"))]
    ways = ways.select("id", "j", "high", *arrays)
    origin, own = F.element_at("x0", F.col("j") + 1), F.element_at("y", F.col("j") + 1)
    gain = (1 - F.col("high")) * F.abs(own - origin)
    moved = _with(F.col("y"), F.col("j"), F.when(F.col("high") < 1, origin + F.col("high") * (own - origin)).otherwise(own))
    picked = ways.withColumns({"gain": gain, "x": moved}).groupBy("id").agg(
        F.max_by("x", F.struct("gain", "j")).alias("_moved"), F.max("gain").alias("_gain")
    )
    out = state.join(picked, "id", "left")
    best = F.when(
        F.col("_gain") > 0,
        F.struct(_distance(F.col("_moved"), F.col("x0")).alias("d"), F.col("best.p").alias("p"), F.col("_moved").alias("x")),
    ).otherwise(F.col("best"))
    return out.withColumn("best", best).drop("_moved")


def nearest_counterfactual(
    df: DataFrame, unique: str, features: Sequence[str], score: Scorer, class_index: int, threshold: float = REACHED,
    rounds: int = STEPS, beam: int = BEAM, seed: int = SEED, precision: float = 1e-4,
) -> DataFrame:
    """The least change of a row's features, within [0, 1], that reaches a probability; distances are sums of changes.

    Every row begins with itself and the seeded random proposals of
    ``counterfactual_search``, so the answer is never farther than theirs.
    In each round one more feature of every point in its beam goes to a bound
    and its nearest point is varied, all points of all rows are scored as one
    table, and the ways that come furthest for their distance stay. After a
    round per feature at least, the rounds end when no row's nearest point
    comes nearer by ``precision``, or after ``rounds``. Then features are moved back
    towards the original as far as the goal allows, the one that saves most
    first, until none saves so much, from the nearest point and from the
    points of a beam of those that reach. Result: one row per id and feature;
    ``proposed`` is null where nothing tried reached the threshold. Rows of
    equal id must be equal; a missing feature is never moved and the row
    counts as out of reach.
    """
    features, n = list(features), len(features)
    # tasks of bounded rows from here to the end, however few files the rows lie in
    parts = parts_for(df, df.count() * (STEPS + 1), ROWS_PER_TASK)
    flat = df.select(F.col(unique).alias("id"), *[F.col(c).cast("double").alias(f"_o{i}") for i, c in enumerate(features)])
    rows = flat.repartition(parts, "id").dropDuplicates(["id"]).select("id", F.array(*[f"_o{i}" for i in range(n)]).alias("x0"))
    own = _scored(rows.withColumn("x", F.col("x0")), features, score, class_index).withColumnRenamed("p", "p0")
    base = stage(own.drop("x"), "origin")
    drawn = base.withColumns({f"_x_{c}": F.col("x0")[j] for j, c in enumerate(features)}).withColumn(
        "_step", F.explode(F.sequence(F.lit(0), F.lit(STEPS)))
    )
    none = F.lit(None).cast("struct<d: double, p: double, x: array<double>>").alias("last")
    nowhere = F.array().cast("array<struct<est: double, d: double, p: double, x: array<double>>>").alias("goals")
    x = _once(F.array(*[proposed("id", c, STEPS, seed) for c in features])).alias("x")
    # the row itself, proposal 0, is where its ways begin
    drawn = drawn.select("id", "x0", "p0", nowhere, none, (F.col("_step") == 0).alias("way"), x)

    def step(points: DataFrame) -> DataFrame:
        tried = _scored(points, features, score, class_index).withColumn("d", _once(_distance(F.col("x"), F.col("x0"))))
        return stage(_explored(tried, threshold, beam), "search")

    state = step(drawn.repartition(parts, "id"))
    open_rows = F.col("p0") < threshold  # a row that is there already has distance 0
    saved = F.coalesce(F.col("last.d"), F.lit(float(n + 1))) - F.coalesce(F.col("best.d"), F.lit(float(n + 1)))
    searched = state.where(open_rows)
    for round_ in range(rounds):
        searched = step(_moves(searched.repartition(parts, "id"), n, seed, round_))
        # to reach the goal at all may take a round per feature
        if round_ + 1 >= n and not searched.where(saved > precision).limit(1).count():
            break
    # the nearest point may have no shorter way back than another that overshot
    starts = F.array_union(F.array("best"), F.transform("goals", lambda g: F.struct(g["d"].alias("d"), g["p"].alias("p"), g["x"].alias("x"))))
    current = stage(
        searched.where(F.col("best").isNotNull()).select("id", "x0", F.posexplode(starts).alias("k", "best"))
        .select(F.struct("id", "k").alias("id"), "x0", "best"), "starts",
    )
    for _ in range(n):
        current = stage(_back(current.select("id", "x0", "best").repartition(parts, "id"), features, score, class_index, threshold), "back")
        if not current.where(F.col("_gain") > precision).limit(1).count():
            break
    nearest = current.select("id.id", "best").repartition(parts, "id").groupBy("id").agg(F.min("best").alias("best"))
    there = base.where(F.col("p0") >= threshold).select("id", F.struct(F.lit(0.0).alias("d"), F.col("p0").alias("p"), F.col("x0").alias("x")).alias("best"))
    current = base.repartition(parts, "id").join(nearest.unionByName(there).repartition(parts, "id"), "id", "left")
    cells = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col("x0")[j].alias("original"), F.col("best.x")[j].alias("proposed"))
        for j, c in enumerate(features)
    ])
    long = current.select(F.col("id").alias(unique), F.inline(cells))
    return long.withColumn("difference", F.col("proposed") - F.col("original"))
