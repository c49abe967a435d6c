"""Column and row-level operators that add a rule to plain select/where."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lowercase_columns(df: DataFrame) -> DataFrame:
    """All column names in lower case; names that would collide are an error."""
    names = [c.lower() for c in df.columns]
    clash = sorted({n for n in names if names.count(n) > 1})
    if clash:
        raise ValueError(f"columns collide in lower case: {clash}")
    return df.toDF(*names)


def add_ingest_time(df: DataFrame, at: datetime, name: str = "event_timestamp") -> DataFrame:
    """Stamp every row with the load time; a parameter, so that runs repeat."""
    return df.withColumn(name, F.lit(at.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz"))


def parse_date(col: Column | str, fmt: str = "yyyy-MM-dd", strict: bool = True) -> Column:
    """Text to a zone-less timestamp; a bad value fails, or is null if not strict."""
    col = F.col(col) if isinstance(col, str) else col
    parsed = F.to_timestamp(col, fmt) if strict else F.try_to_timestamp(col, F.lit(fmt))
    return parsed.cast("timestamp_ntz")


def to_utc(col: Column | str) -> Column:
    """Read a zone-less time as UTC."""
    return F.to_utc_timestamp(F.col(col) if isinstance(col, str) else col, "UTC").cast("timestamp")


def nan_to_null(df: DataFrame) -> DataFrame:
    """One notion of missing: NaN becomes null."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def numeric(df: DataFrame, columns: Sequence[str], to: str = "double") -> DataFrame:
    """Cast the named columns (booleans count as 0 and 1)."""
    return df.withColumns({c: F.col(c).cast(to) for c in columns})


def in_time_range(df: DataFrame, ts: str, start: datetime, end: datetime) -> DataFrame:
    """Rows with ``start <= ts < end``; plain comparisons, so the scan prunes."""
    low, high = (F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz") for t in (start, end))
    return df.where((F.col(ts) >= low) & (F.col(ts) < high))


def replace_values(
    df: DataFrame, column: str, mapping: Mapping, to: str | None = None, unmapped: str = "keep"
) -> DataFrame:
    """Replace the values found in ``mapping``; a missing value may be mapped as well.

    ``to`` is the result's type, by default the column's own. Values without a
    replacement stay if ``unmapped`` is ``"keep"`` (cast to the type, missing
    where they cannot be) or become missing if it is ``"null"``. The mapping
    joins as a table of its own, whatever its size.
    """
    if unmapped not in ("keep", "null"):
        raise ValueError(unmapped)
    kind = to or df.schema[column].dataType.simpleString()
    source = df.schema[column].dataType.simpleString()
    if not mapping:
        return df.withColumn(column, F.col(column).cast(kind))
    values = T.StructType.fromDDL(f"_to {kind}")["_to"].dataType
    schema = T.StructType([T.StructField("_from", df.schema[column].dataType), T.StructField("_to", values)])
    pairs = df.sparkSession.createDataFrame(list(mapping.items()), schema).withColumn("_known", F.lit(True))
    joined = df.join(pairs, F.col(column).eqNullSafe(F.col("_from")), "left")
    rest = F.col(column).try_cast(kind) if source != kind else F.col(column)
    other = rest if unmapped == "keep" else F.lit(None).cast(kind)
    return joined.withColumn(column, F.when(F.col("_known"), F.col("_to")).otherwise(other)).select(*df.columns)


def unpivot(df: DataFrame, ids: Sequence[str], values: Sequence[str], to: str = "double") -> DataFrame:
    """Columns to (name, value) rows, all values cast to one type."""
    return numeric(df, values, to).unpivot(list(ids), list(values), "name", "value")


@dataclass(frozen=True)
class Rule:
    """What a column must satisfy."""

    column: str
    not_null: bool = False
    low: float | None = None
    high: float | None = None
    unique: bool = False


def schema_violations(df: DataFrame, expected: Mapping[str, str]) -> list[str]:
    """Differences between a table's schema and the declared one."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    missing = [f"{c}: missing" for c in expected if c not in actual]
    wrong = [f"{c}: {actual[c]} instead of {t}" for c, t in expected.items() if c in actual and actual[c] != t]
    return missing + wrong


def validate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Number of violating rows per rule: (column_name, rule, violations).

    All row rules are counted in one pass; a uniqueness rule adds a grouped
    count, which combines on the map side.
    """
    counted: list[tuple[str, str, Column]] = []
    for r in rules:
        c = F.col(r.column)
        if r.not_null:
            counted.append((r.column, "not_null", F.count_if(c.isNull())))
        if r.low is not None:
            counted.append((r.column, "low", F.count_if(c < F.lit(r.low))))
        if r.high is not None:
            counted.append((r.column, "high", F.count_if(c > F.lit(r.high))))
    out = None
    if counted:
        one = df.agg(*[expr.alias(f"_v{i}") for i, (_, _, expr) in enumerate(counted)])
        entries = [
            F.struct(
                F.lit(column).alias("column_name"), F.lit(rule).alias("rule"), F.col(f"_v{i}").alias("violations")
            )
            for i, (column, rule, _) in enumerate(counted)
        ]
        out = one.select(F.inline(F.array(*entries)))
    for r in rules:
        if r.unique:
            repeated = (
                df.groupBy(r.column)
                .agg(F.count(F.lit(1)).alias("n"))
                .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations"))
                .select(F.lit(r.column).alias("column_name"), F.lit("unique").alias("rule"), "violations")
            )
            out = repeated if out is None else out.unionByName(repeated)
    if out is None:
        raise ValueError("no rule given")
    return out


def require_valid(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Return ``df`` if it keeps every rule, else raise with the counts."""
    broken = [r for r in validate(df, rules).collect() if r["violations"]]  # one row per rule
    if broken:
        raise ValueError("; ".join(f"{r['column_name']}/{r['rule']}: {r['violations']}" for r in broken))
    return df
