"""A push source: one stream of feature rows into the offline history and the online table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tablewright.operators.features import FeatureView
from tablewright.operators.joins import lookup
from tablewright.operators.ordering import pick_per_key
from tablewright.streaming.log import BATCH, BatchLog

HISTORY, ONLINE = "history", "online"
COMPACT_EVERY = 16


@dataclass(frozen=True)
class PushSource:
    """Rows pushed under a name: keys, event time, tie-break and features, and the log that holds both tables."""

    name: str
    keys: tuple[str, ...]
    ts: str
    schema: T.StructType
    log: BatchLog
    created: str
    ttl: timedelta | None = None
    compact_every: int = COMPACT_EVERY

    @property
    def _columns(self) -> list[str]:
        return list(dict.fromkeys([*self.keys, self.ts, self.created, *self.schema.names]))

    def _newest(self, rows: DataFrame) -> DataFrame:
        return pick_per_key(rows, self.keys, [self.ts, self.created], "last")

    def push(self, rows: DataFrame, batch_id: int) -> bool:
        """Put a batch into both tables; False, and nothing changed, if it was there already.

        The history gets every row, however late. The online table gets the
        newest row of each key of the batch; the one that is newest by event
        time answers, so a late row never replaces a newer one. Both appear
        with one commit. Batches come in rising order of their ids.
        """
        if batch_id <= self.log.last_batch():
            return False
        history = self.log.stage(HISTORY, rows.select(*self._columns), batch_id)
        # from the written rows: a source that is read again cannot tell the two tables apart
        online = self.log.stage(ONLINE, self._newest(self.log.read_staged(history)), batch_id)
        self.log.commit(history, online)
        if self.log.batches_since_base(ONLINE) >= self.compact_every:
            self.compact()
        return True

    def compact(self) -> None:
        """Fold the online table's batches into one row per key; the history keeps its batches."""
        self.log.compact({ONLINE: self._newest})

    def run(self, stream: DataFrame) -> StreamingQuery:
        """Push all that the stream has, batch by batch, and stop; a later call goes on from there."""
        query = (
            stream.writeStream.outputMode("append")
            .foreachBatch(lambda rows, batch_id: self.push(rows, batch_id) and None)
            .option("checkpointLocation", f"{self.log.root}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return query

    def history(self) -> DataFrame:
        return self.log.read(HISTORY).drop(BATCH)

    def online(self) -> DataFrame:
        """The newest row per key, from one base and the batches after it."""
        return self._newest(self.log.read(ONLINE)).drop(BATCH)

    def view(self) -> FeatureView:
        """The history as a feature view, for point-in-time joins and for filling serving tables."""
        return FeatureView(self.name, self.keys, self.ts, self.schema, self.history(), self.created, self.ttl)

    def features(self, request: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
        """The newest values for the given keys; a miss is null."""
        return lookup(request, self.online(), self.keys, list(names or self.schema.names))


def push_source(
    spark: SparkSession, name: str, keys: Sequence[str], ts: str, created: str, schema: T.StructType, root: str | None = None,
    compact_every: int = COMPACT_EVERY,
) -> PushSource:
    return PushSource(name, tuple(keys), ts, schema, BatchLog(spark, root), created, None, compact_every)
