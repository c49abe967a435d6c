"""On-demand features: columns computed from view features and from what a request brings along.

A derived feature names its inputs and gives one column expression of them.
Inputs are features of stored views (``view:feature``), columns of the request
(``request:column``) or other derived features (``on_demand_view:feature``).
The features asked for, and all they need, form a graph; it is ordered once,
and the same ordered expressions are put on the rows of a point-in-time join
and on those of a lookup in the serving tables. Everything stays a column
expression, so a derived feature costs no shuffle and no Python.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators.features import FeatureService, FeatureView, OnlineTable, historical_features

REQUEST = "request"


@dataclass(frozen=True)
class Derived:
    """One computed feature: ``compute`` gets a column for each input, in their order."""

    name: str
    kind: T.DataType
    inputs: tuple[str, ...]
    compute: Callable[..., Column]


@dataclass(frozen=True)
class OnDemandView:
    """A named set of derived features."""

    name: str
    features: tuple[Derived, ...]


@dataclass(frozen=True)
class Plan:
    """What a list of feature references needs, in the order in which it can be computed.

    ``stored`` has the features to fetch of each view, ``levels`` the derived
    features: those of one level need only stored features, request columns
    and earlier levels.
    """

    refs: tuple[str, ...]
    stored: tuple[tuple[FeatureView, tuple[str, ...]], ...]
    request: tuple[str, ...]
    levels: tuple[tuple[tuple[str, Derived], ...], ...] = field(default=())


def _inner(ref: str) -> str:
    """The column of a reference while features are computed; a name of its own whatever the tables hold."""
    return f"__{ref}"


def plan(
    refs: Sequence[str], views: Sequence[FeatureView], derived: Sequence[OnDemandView] = (),
    request: T.StructType | None = None,
) -> Plan:
    """Resolve references, follow their inputs, and order derived features by what they need.

    Only what the references need is planned. A reference or input that nobody
    declares, a name declared twice and a cycle are errors.
    """
    by_view = {v.name: v for v in views}
    by_ref: dict[str, Derived] = {}
    for view in derived:
        if view.name in by_view or view.name == REQUEST:
            raise ValueError(f"the name {view.name!r} is taken")
        for f in view.features:
            if by_ref.setdefault(f"{view.name}:{f.name}", f) is not f:
                raise ValueError(f"{view.name}:{f.name} is declared twice")
    if len(by_view) < len(views) or len({v.name for v in derived}) < len(derived) or REQUEST in by_view:
        raise ValueError("view names must differ")
    of_request = set(request.names) if request else set()
    stored: dict[str, list[str]] = {}
    asked: list[str] = []
    level: dict[str, int] = {}

    def resolve(ref: str, path: tuple[str, ...]) -> int:
        """The level of a reference: 0 if it is fetched, else one more than that of its inputs."""
        if ref in path:
            raise ValueError("features need each other: " + " -> ".join([*path[path.index(ref) :], ref]))
        if ref in level:
            return level[ref]
        owner, _, name = ref.partition(":")
        if ref in by_ref:
            level[ref] = 1 + max((resolve(i, (*path, ref)) for i in by_ref[ref].inputs), default=0)
        elif owner in by_view and name in by_view[owner].schema.names:
            level[ref] = 0
            stored.setdefault(owner, []).append(name)
        elif owner == REQUEST and name in of_request:
            level[ref] = 0
            asked.append(name)
        else:
            raise ValueError(f"unknown feature reference {ref!r}" + (f", an input of {path[-1]}" if path else ""))
        return level[ref]

    for ref in refs:
        resolve(ref, ())
    names = [ref.partition(":")[2] for ref in refs]
    if len(set(names)) < len(names):
        raise ValueError(f"features of the same name: {names}")
    levels = [[(r, by_ref[r]) for r, at in level.items() if at == k] for k in range(1, max(level.values(), default=0) + 1)]
    return Plan(
        tuple(refs), tuple((by_view[v], tuple(f)) for v, f in stored.items()), tuple(asked), tuple(map(tuple, levels))
    )


def _compute(rows: DataFrame, wanted: Plan, keep: Sequence[str]) -> DataFrame:
    """Add the derived features level by level, and give the asked ones their plain names."""
    rows = rows.withColumns({_inner(f"{REQUEST}:{c}"): F.col(f"`{c}`") for c in wanted.request})
    for level in wanted.levels:
        rows = rows.withColumns(
            {
                _inner(ref): f.compute(*[F.col(f"`{_inner(i)}`") for i in f.inputs]).cast(f.kind)
                for ref, f in level
            }
        )
    clash = [ref for ref in wanted.refs if ref.partition(":")[2] in keep]
    if clash:
        raise ValueError(f"{clash} already present")
    out = [F.col(f"`{_inner(ref)}`").alias(ref.partition(":")[2]) for ref in wanted.refs]
    return rows.select(*[F.col(f"`{c}`") for c in keep], *out)


def _needs(df: DataFrame, columns: Sequence[str], what: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks {missing}")


def historical(entities: DataFrame, wanted: Plan, entity_ts: str, unmatched: str = "null", **options) -> DataFrame:
    """The entity rows with stored features as of their time and the derived features over them.

    Columns of the request are columns of the entity rows; one that is missing
    in a row is null, as is a feature without a value, and what a derived
    feature makes of null is up to its expression. Feature names may clash
    between views as long as the asked ones differ.
    """
    _needs(entities, wanted.request, "the entity table")
    projections = []
    for view, names in wanted.stored:
        inner = {n: _inner(f"{view.name}:{n}") for n in names}
        source = view.table(names).withColumnsRenamed(inner)
        schema = T.StructType([T.StructField(inner[n], view.schema[n].dataType) for n in names])
        projections.append((replace(view, source=source, schema=schema), tuple(inner.values())))
    joined = historical_features(entities, FeatureService("on demand", tuple(projections)), entity_ts, unmatched, **options)
    return _compute(joined, wanted, entities.columns)


def online(request: DataFrame, wanted: Plan, tables: Mapping[str, OnlineTable]) -> DataFrame:
    """The request rows with the newest stored features of their keys and the derived features over them.

    ``tables`` has the serving table of each view by the view's name. Every
    request row survives, also where rows or keys repeat.
    """
    _needs(request, wanted.request, "the request")
    rows = request
    for view, names in wanted.stored:
        _needs(request, view.keys, "the request")
        found = tables[view.name].features(request.select(*view.keys).distinct(), FeatureService("", ((view, names),)))
        renamed = found.select(
            *[F.col(k).alias(f"__key {k}") for k in view.keys],
            *[F.col(n).alias(_inner(f"{view.name}:{n}")) for n in names],
        )
        same = F.lit(True)
        for k in view.keys:
            same = same & F.col(f"`{k}`").eqNullSafe(F.col(f"`__key {k}`"))
        rows = rows.join(renamed, same, "left").drop(*[f"__key {k}" for k in view.keys])
    return _compute(rows, wanted, request.columns)
