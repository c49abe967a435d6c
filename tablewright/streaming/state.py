"""Keyed state of streams, in Spark's state store."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from datetime import timedelta

import pandas as pd
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


def _missing(x) -> bool:
    return x is None or x is pd.NaT or (isinstance(x, float) and math.isnan(x))


def _rank(row: Sequence) -> tuple:
    """Rows by time, then by the unique column; missing ones before all others."""
    return tuple((not _missing(x), 0 if _missing(x) else x) for x in row[:2])


def newest_of_batch(keys: list[str], n: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Of each group of rows in hand, the newest ``n`` of every key: what is shuffled of a hot key shrinks to that."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            ordered = frame.sort_values(["_at", "_unique"], ascending=False, na_position="last", kind="stable")
            yield ordered.groupby(keys, dropna=False, sort=False).head(n)

    return run


class NewestRows(StatefulProcessor):
    """The newest ``n`` rows of a key in as many slots of a map; gives their mean and number whenever rows arrive.

    Rows are (_at, _unique, _value). A row older than all of a full map changes
    nothing; a newer one is written into the slot of the oldest. With a
    ``ttl``, rows that are so much older than the key's newest row by their own
    time are forgotten, and rows without a time with them.
    """

    def __init__(self, keys: list[str], row: T.StructType, n: int, ttl: timedelta | None = None):
        self.keys, self.row, self.n = keys, row, n
        self.ttl = int(ttl.total_seconds() * 1_000_000) if ttl else None

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.slots = handle.getMapState("slots", "slot int", self.row)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = {k[0]: tuple(v) for k, v in self.slots.iterator()} if self.slots.exists() else {}
        fresh: list[tuple] = []
        for frame in rows:
            # by place: the columns of a row come last, and reach the processor without their names
            columns = [frame.iloc[:, i].astype(object).tolist() for i in (-3, -2, -1)]
            fresh += [tuple(None if _missing(x) else x for x in r) for r in zip(*columns)]
            fresh = sorted(fresh, key=_rank, reverse=True)[: self.n]
        entering = [(r, None) for r in fresh] + [(r, slot) for slot, r in held.items()]
        kept = sorted(entering, key=lambda e: _rank(e[0]), reverse=True)[: self.n]
        if self.ttl and kept and kept[0][0][0] is not None:
            kept = [e for e in kept if e[0][0] is not None and e[0][0] >= kept[0][0][0] - self.ttl]
        for slot in set(held) - {slot for _, slot in kept}:
            self.slots.removeKey((slot,))
        free = iter(sorted(set(range(self.n)) - {slot for _, slot in kept if slot is not None}))
        for row, slot in kept:
            if slot is None:
                self.slots.updateValue((next(free),), row)
        values = [r[2] for r, _ in kept if not _missing(r[2])]
        mean = math.fsum(values) / len(values) if values else None
        yield pd.DataFrame({**{c: [k] for c, k in zip(self.keys, key)}, "mean_value": [mean], "n": [len(kept)]})

    def close(self) -> None:
        pass
