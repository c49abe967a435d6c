"""Feature views, services, point-in-time training sets and the serving table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators.asof import AsOf, asof_views
from tablewright.operators.incremental import upsert_unique
from tablewright.operators.joins import lookup
from tablewright.operators.ordering import latest_per_key
from tablewright.operators.versions import VersionedTable


@dataclass(frozen=True)
class FeatureView:
    """Timestamped feature rows of an entity: the table and what it must contain."""

    name: str
    keys: tuple[str, ...]
    ts: str
    schema: T.StructType
    source: DataFrame
    created: str | None = None
    ttl: timedelta | None = None

    def table(self, features: Sequence[str] | None = None) -> DataFrame:
        """Key, time and the declared features, cast to their declared types."""
        declared = {f.name: f.dataType for f in self.schema.fields}
        wanted = list(features) if features is not None else list(declared)
        needed = [*self.keys, self.ts, *([self.created] if self.created else []), *wanted]
        missing = [c for c in needed if c not in self.source.columns]
        unknown = [c for c in wanted if c not in declared]
        if missing or unknown:
            raise ValueError(f"view {self.name}: missing {missing}, not declared {unknown}")
        head = [F.col(c) for c in needed if c not in wanted]
        return self.source.select(*head, *[F.col(c).cast(declared[c]).alias(c) for c in wanted])

    @property
    def tie_break(self) -> list[str]:
        return [self.created] if self.created else []


@dataclass(frozen=True)
class FeatureService:
    """A named, ordered choice of features from one or more views."""

    name: str
    projections: tuple[tuple[FeatureView, tuple[str, ...]], ...]

    @property
    def features(self) -> list[str]:
        return [f for _, names in self.projections for f in names]


def service_from_refs(refs: Sequence[str], views: Sequence[FeatureView], name: str = "refs") -> FeatureService:
    """Turn ``"view:feature"`` references into a service, in the order given."""
    by_name = {v.name: v for v in views}
    picked: dict[str, list[str]] = {}
    for ref in refs:
        view, sep, feature = ref.partition(":")
        if not sep or view not in by_name:
            raise ValueError(f"unknown feature reference {ref!r}")
        picked.setdefault(view, []).append(feature)
    return FeatureService(name, tuple((by_name[v], tuple(f)) for v, f in picked.items()))


def historical_features(
    entities: DataFrame, service: FeatureService, entity_ts: str, unmatched: str = "null", **options
) -> DataFrame:
    """The entity rows with the value each feature had at that row's time.

    Views that share their keys are matched in one pass over one ordered
    stream (see ``asof_views``).
    """
    by_keys: dict[tuple[str, ...], list[AsOf]] = {}
    present = set(entities.columns)
    for view, features in service.projections:
        clash = [f for f in features if f in present]
        if clash:
            raise ValueError(f"view {view.name}: {clash} already present")
        present |= set(features)
        rows = AsOf(view.table(features), view.ts, tuple(features), tuple(view.tie_break), view.ttl)
        by_keys.setdefault(tuple(view.keys), []).append(rows)
    out = entities
    for keys, views in by_keys.items():
        out = asof_views(out, views, keys, entity_ts, unmatched, **options)
    return out.select(*entities.columns, *service.features)


class OnlineTable:
    """The latest feature row per key, as a versioned table with a time mark."""

    def __init__(self, spark: SparkSession, view: FeatureView, root: str | None = None):
        self.view = view
        self.store = VersionedTable(spark, root)

    def _latest(self, start: Column | None, end: datetime) -> DataFrame:
        rows = self.view.table()
        if start is not None:
            rows = rows.where(F.col(self.view.ts) > start)
        return latest_per_key(rows, self.view.keys, self.view.ts, self.view.tie_break, end=_ntz(end))

    def materialize(self, start: datetime, end: datetime) -> DataFrame:
        """Fill the table from the view's rows in ``[start, end]``."""
        rows = latest_per_key(
            self.view.table(), self.view.keys, self.view.ts, self.view.tie_break, _ntz(start), _ntz(end)
        )
        self.store.write(rows, note=end.isoformat(sep=" "))
        return self.read()

    def mark(self) -> datetime:
        """Up to what time the table is filled."""
        return datetime.fromisoformat(self.store.entry()["note"])

    def materialize_incremental(self, end: datetime) -> DataFrame:
        """Bring the table from its mark up to ``end``; a newer row is never replaced by an older one."""
        current = self.store.entry()
        recent = self._latest(_ntz(datetime.fromisoformat(current["note"])), end)
        # both have unique keys, and whatever is recent lies after the mark
        rows = upsert_unique(self.store.read_entry(current), recent, self.view.keys)
        self.store.write(rows, note=end.isoformat(sep=" "), after=current)
        return self.read()

    def read(self) -> DataFrame:
        return self.store.read()

    def features(self, keys: DataFrame, service: FeatureService | None = None) -> DataFrame:
        """Latest values for the given keys in the service's order; a miss is null."""
        names = service.features if service else [f.name for f in self.view.schema.fields]
        return lookup(keys, self.read(), self.view.keys, names)


def _ntz(at: datetime) -> Column:
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")
