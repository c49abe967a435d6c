"""Summaries: describe, quantiles, correlation, means, classification metrics."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators.slicing import join_null_safe
from tablewright.sources.workspace import local_table

QUARTILES = (0.25, 0.5, 0.75)
# The sketch that brackets a quantile: its size, and how far (in ranks, as a
# share) the ends of the bracket are put from the wanted rank.
SKETCH_SIZE, SKETCH_WIDTH = 4096, 0.002
# Sketches meet in so many groups first, then in one.
SKETCH_GROUPS = 64
# A bracket with more rows is bracketed again.
BRACKET_ROWS = 1_000_000


def numeric_columns(df: DataFrame) -> list[str]:
    """Columns that count as numbers (not booleans, strings or times)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per numeric column: count, mean, std, min, quartiles, max.

    Quartiles are exact with linear interpolation, found in the same way for
    tables of every size. Null and NaN are missing. Quartiles are found apart
    from the plain sums, which then stay in generated code and combine on the
    map side.
    """
    columns = list(columns or numeric_columns(df))
    basics = []
    for i, c in enumerate(columns):
        v = _value(c)
        basics += [
            F.count(v).alias(f"count_{i}"),
            F.avg(v).alias(f"mean_{i}"),
            _spread(F.stddev_samp(v), v).alias(f"std_{i}"),
            F.min(v).alias(f"min_{i}"),
            F.max(v).alias(f"max_{i}"),
        ]
    fields = ["count", "mean", "std", "min", "max"]
    entries = [
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"{f}_{i}").alias(f) for f in fields])
        for i, c in enumerate(columns)
    ]
    out = df.agg(*basics).select(F.inline(F.array(*entries)))
    wide = exact_quantiles(df, columns, QUARTILES).groupBy("column_name").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(f"q{j}") for j, p in enumerate(QUARTILES)]
    )
    return join_null_safe(out, wide, ["column_name"]).select(
        "column_name", "count", "mean", "std", "min", F.col("q0").alias("p25"), F.col("q1").alias("p50"),
        F.col("q2").alias("p75"), "max",
    )


def _spread(measure: Column, v: Column) -> Column:
    """A variance or deviation of ``v``, exactly zero where all values are equal."""
    return F.when(measure.isNotNull() & (F.min(v) == F.max(v)), F.lit(0.0)).otherwise(measure)


def _value(name: str) -> Column:
    as_double = F.col(name).cast("double")
    return F.when(~F.isnan(as_double), as_double)


def _sketched(df: DataFrame, asked: dict[str, tuple[Column, list[float]]]) -> dict[str, list[float]]:
    """Approximate quantiles of named values: one mergeable sketch each, merged in two steps."""
    salted = df.groupBy((F.spark_partition_id() % SKETCH_GROUPS).alias("_group")).agg(
        *[F.kll_sketch_agg_double(v, SKETCH_SIZE).alias(name) for name, (v, _) in asked.items()],
        *[F.count(v).alias(f"n_{name}") for name, (v, _) in asked.items()],
    )
    merged = salted.agg(
        *[F.kll_merge_agg_double(F.when(F.col(f"n_{name}") > 0, F.col(name))).alias(name) for name in asked],
        *[F.sum(f"n_{name}").alias(f"n_{name}") for name in asked],
    )
    ranks = {name: F.array(*map(F.lit, probs)) for name, (_, probs) in asked.items()}
    row = merged.select(
        *[F.when(F.col(f"n_{name}") > 0, F.kll_sketch_get_quantile_double(name, r)).alias(name) for name, r in ranks.items()]
    ).first()
    return {name: row[name] for name in asked if row[name] is not None}


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Exact interpolated quantiles of columns of any size: (column_name, prob, quantile).

    A sketch gives for each quantile two values that bracket it; one count
    says how many rows lie below the bracket and in it. A bracket that misses
    its rank is widened, one with too many rows is bracketed again inside, and
    the few rows of the last one are counted value by value to reach the exact
    rank. All passes combine on the map side, and no task holds more than the
    distinct values of a bracket.
    """
    spark, columns, probs = df.sparkSession, list(columns), list(probs)
    values = {c: _value(c) for c in columns}
    pairs = [(c, p) for c in columns for p in probs]
    name = {pair: f"q{i}" for i, pair in enumerate(pairs)}
    bounds: dict[tuple[str, float], tuple[float, float, int, int]] = {}
    inside_of = dict.fromkeys(pairs, 0)
    width = dict.fromkeys(pairs, SKETCH_WIDTH)
    todo = pairs
    while todo:
        asked, read = {}, {}
        for c, p in todo:
            v, near = values[c], p
            shared = (c, p) not in bounds
            if not shared:  # again, among the rows of its bracket
                low, high, below, n = bounds[c, p]
                v, near = F.when(v.between(F.lit(low), F.lit(high)), v), (p * (n - 1) - below) / inside_of[c, p]
            ends = [min(1.0, max(0.0, near + side)) for side in (-width[c, p], width[c, p])]
            key = f"c{columns.index(c)}" if shared else name[c, p]  # one sketch of a whole column serves all its quantiles
            asked.setdefault(key, (v, []))[1].extend(ends)
            read[c, p] = (key, len(asked[key][1]) - 2)
        sketch = _sketched(df, asked)
        found = {pair: sketch[key][at : at + 2] for pair, (key, at) in read.items() if key in sketch}
        if not found:
            break
        counted = []
        for (c, _), (low, high) in found.items():
            v = values[c]
            counted += [F.count(v), F.count_if(v < F.lit(low)), F.count_if(v <= F.lit(high))]
        counts = df.agg(*[x.alias(f"_{i}") for i, x in enumerate(counted)]).first()
        todo = []
        for i, ((c, p), (low, high)) in enumerate(found.items()):
            n, below, upto = counts[3 * i : 3 * i + 3]
            first, last = math.floor(p * (n - 1)), math.ceil(p * (n - 1))
            had = inside_of[c, p]
            if not (below <= first and last < upto):
                width[c, p] *= 4
                todo.append((c, p))
                continue
            if had and upto - below >= had:
                continue  # equal values cannot be told apart further
            bounds[c, p], inside_of[c, p] = (low, high, below, n), upto - below
            if upto - below > BRACKET_ROWS and low < high:
                width[c, p] = SKETCH_WIDTH
                todo.append((c, p))
    if not bounds:
        return local_table(spark, [], "column_name string, prob double, quantile double")
    wanted = []
    for (c, p), (_, _, below, n) in bounds.items():
        at = p * (n - 1)
        wanted += [(c, p, below, side, rank, at - math.floor(at)) for side, rank in enumerate((math.floor(at), math.ceil(at)))]
    targets = local_table(spark, wanted, "column_name string, prob double, _below bigint, _side int, _rank bigint, _part double")
    inside = {
        (c, p): (values[c] >= F.lit(low)) & (values[c] <= F.lit(high)) for (c, p), (low, high, _, _) in bounds.items()
    }
    near = F.lit(False)
    for condition in inside.values():
        near = near | F.coalesce(condition, F.lit(False))
    cells = [
        F.when(condition, F.struct(F.lit(c).alias("column_name"), F.lit(p).alias("prob"), values[c].alias("_v")))
        for (c, p), condition in inside.items()
    ]
    found = df.where(near).select(F.explode(F.array(*cells)).alias("_cell")).where(F.col("_cell").isNotNull())
    rising = Window.partitionBy("column_name", "prob").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (
        found.select("_cell.*")
        .groupBy("column_name", "prob", "_v")
        .agg(F.count(F.lit(1)).alias("_c"))
        .withColumn("_upto", F.sum("_c").over(rising))
    )
    # two ranks per quantile, a table of a few rows
    hit = join_null_safe(ranked, targets, ["column_name", "prob"], "inner").where(
        (F.col("_rank") < F.col("_below") + F.col("_upto"))
        & (F.col("_rank") >= F.col("_below") + F.col("_upto") - F.col("_c"))
    )
    low, high = (F.max(F.when(F.col("_side") == i, F.col("_v"))) for i in (0, 1))
    part = F.max("_part")
    return hit.groupBy("column_name", "prob").agg(((1 - part) * low + part * high).alias("quantile"))


def correlations(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> dict[tuple[str, str], float | None]:
    """Pearson's r of pairs of columns over the rows where both are present.

    The first pass takes mean, extremes and gaps of every column, the second
    the products of deviations. Columns without gaps share their sums; a pair
    with gaps gets sums over its own rows. A constant, told by its extremes
    and not by a variance that may miss zero by a rounding, has no r (None).
    """
    columns = list(dict.fromkeys(c for pair in pairs for c in pair))
    values = {c: _value(c) for c in columns}
    first = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(columns):
        v = values[c]
        first += [F.count(v).alias(f"n{i}"), F.avg(v).alias(f"m{i}"), F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}")]
    stats = df.agg(*first).first()
    at = {c: i for i, c in enumerate(columns)}
    varies = {c: stats[f"n{i}"] > 0 and stats[f"lo{i}"] < stats[f"hi{i}"] for c, i in at.items()}
    whole = {c: stats[f"n{i}"] == stats["_n"] for c, i in at.items()}
    used = [(x, y) for x, y in pairs if varies[x] and varies[y]]
    # a pair with gaps has means of its own, over the rows where both are there
    both = {
        (x, y): values[x].isNotNull() & values[y].isNotNull() for x, y in used if not (whole[x] and whole[y])
    }
    means = {(x, y): (stats[f"m{at[x]}"], stats[f"m{at[y]}"], stats["_n"]) for x, y in used}
    if both:
        own = []
        for (x, y), here in both.items():
            a, b = F.when(here, values[x]), F.when(here, values[y])
            own += [F.avg(a), F.avg(b), F.count_if(here), F.min(a), F.max(a), F.min(b), F.max(b)]
        row = df.agg(*[v.alias(f"_{i}") for i, v in enumerate(own)]).first()
        for i, pair in enumerate(both):
            a, b, n, a_low, a_high, b_low, b_high = row[7 * i : 7 * i + 7]
            means[pair] = (a, b, n)
            if not n or a_low == a_high or b_low == b_high:
                used.remove(pair)
    sums: dict[str, Column] = {}
    parts = {}
    for x, y in used:
        a, b = values[x] - F.lit(means[x, y][0]), values[y] - F.lit(means[x, y][1])
        i, j = at[x], at[y]
        here, tag = both.get((x, y)), f"_{i}_{j}" if (x, y) in both else ""
        names = [f"s{i}{tag}", f"s{j}{tag}y" if tag else f"s{j}", f"p{i}_{i}{tag}", f"p{j}_{j}{tag}y" if tag else f"p{j}_{j}"]
        names.append("p{}_{}".format(*sorted((i, j))) + (f"{tag}xy" if tag else ""))
        for key, value in zip(names, (a, b, a * a, b * b, a * b)):
            sums.setdefault(key, F.sum(value if here is None else F.when(here, value)).alias(key))
        parts[x, y] = names
    row = df.agg(*sums.values()).first() if sums else None
    out: dict[tuple[str, str], float | None] = dict.fromkeys(pairs)
    for pair, names in parts.items():
        sa, sb, saa, sbb, sab = (row[k] for k in names)
        n = means[pair][2]
        spread = math.sqrt(max(saa - sa**2 / n, 0.0)) * math.sqrt(max(sbb - sb**2 / n, 0.0))
        out[pair] = 1.0 if pair[0] == pair[1] else (sab - sa * sb / n) / spread if spread else None
    return out


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All pairwise correlations as (x, y, r)."""
    columns = list(columns)
    found = correlations(df, [(x, y) for i, x in enumerate(columns) for y in columns[i:]])
    cells = [(a, b, r) for (x, y), r in found.items() for a, b in sorted({(x, y), (y, x)})]
    return local_table(df.sparkSession, cells, "x string, y string, r double")


def corr_target(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Correlation of every column with ``target``, strongest first."""
    found = correlations(df, [(c, target) for c in columns])
    cells = [(c, r) for (c, _), r in found.items()]
    table = local_table(df.sparkSession, cells, "column_name string, r double")
    return table.orderBy(F.desc_nulls_last("r"), "column_name")


def group_mean(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Mean of each column per key; rows with a missing key belong to no group."""
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    return df.where(present).groupBy(*keys).agg(*[F.avg(_value(c)).alias(c) for c in columns])


def accuracy(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Share of rows whose prediction is right."""
    hit = F.col(actual).eqNullSafe(F.col(predicted))
    return df.agg(F.try_divide(F.count_if(hit), F.count(F.lit(1))).alias("accuracy"))


def confusion_matrix(
    df: DataFrame, actual: str, predicted: str, classes: Sequence[int | str] | None = None
) -> DataFrame:
    """Count per (actual, predicted), a missing class as a class of its own.

    Only pairs that occur have a row. With a declared list of ``classes``, all
    pairs of them do, absent ones as 0: as many rows as the list's square.
    """
    counts = df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )
    if classes is None:
        return counts
    schema = f"actual {counts.schema['actual'].dataType.simpleString()}, predicted {counts.schema['predicted'].dataType.simpleString()}"
    grid = local_table(df.sparkSession, [(a, p) for a in classes for p in classes], schema)
    absent = join_null_safe(grid, counts, ["actual", "predicted"], "left_anti")
    return counts.unionByName(absent.withColumn("n", F.lit(0).cast("bigint")))


def precision_recall(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Per class: predicted, actual and right counts, precision and recall.

    Every row is counted once as its actual and once as its predicted class,
    then one grouped sum gives both totals.
    """
    a, p = F.col(actual), F.col(predicted)
    hit = a.eqNullSafe(p).cast("bigint")
    sides = F.array(
        F.struct(a.alias("label"), F.lit(1).alias("is_actual"), F.lit(0).alias("is_predicted"), hit.alias("right")),
        F.struct(p.alias("label"), F.lit(0).alias("is_actual"), F.lit(1).alias("is_predicted"), F.lit(0).cast("bigint").alias("right")),
    )
    return (
        df.select(F.inline(sides))
        .where(F.col("label").isNotNull())
        .groupBy("label")
        .agg(
            F.sum("is_actual").alias("n_actual"),
            F.sum("is_predicted").alias("n_predicted"),
            F.sum("right").alias("n_right"),
        )
        .withColumn("precision", F.try_divide(F.col("n_right"), F.col("n_predicted")))
        .withColumn("recall", F.try_divide(F.col("n_right"), F.col("n_actual")))
    )


def binary_precision_recall(df: DataFrame, truth: Column, score: Column, threshold: float = 0.5) -> DataFrame:
    """Precision and recall of ``score > threshold`` over all rows."""
    positive = score > F.lit(threshold)
    return df.agg(
        F.count_if(positive & truth).alias("true_positive"),
        F.count_if(positive).alias("n_positive"),
        F.count_if(truth).alias("n_truth"),
    ).select(
        F.try_divide(F.col("true_positive"), F.col("n_positive")).alias("precision"),
        F.try_divide(F.col("true_positive"), F.col("n_truth")).alias("recall"),
    )


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight per class: rows / (classes * rows of the class)."""
    counts = df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes")).first()  # two numbers
    weight = F.lit(total["rows"] or 0) / (F.lit(total["classes"]) * F.col("n"))
    return counts.select("label", "n", weight.alias("weight"))
