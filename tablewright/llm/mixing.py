"""Mixing sources to target weights by Pfair scheduling.

The rows of a source are cut into blocks, and the schedule has one slot per
block. In the ideal, fluid schedule every source that still has blocks is
served at a rate proportional to its weight; the rates grow when a source runs
out, so that no row is dropped or repeated. The j-th block of a source is
released in the slot in which its fluid service begins and is due in the one
in which it ends. Earliest deadline first meets all these windows, since unit
jobs with whole release times and deadlines that can be served in fractions
can also be served whole. So no source is ever a whole block ahead of or
behind its fluid share.

The number of blocks is a parameter: blocks grow with the table and the
schedule does not. It is a driver-side plan of ``blocks`` plus one entry per
source at most; rows only meet it in a join.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right
from collections.abc import Mapping, Sequence
from fractions import Fraction
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators.ranges import ROWS_PER_PART, row_number_in_key
from tablewright.sources.workspace import local_table

BLOCKS = 16_384
MAX_SOURCES = 10_000


def windows(blocks: Sequence[int], weights: Sequence[int]) -> list[tuple[int, int, int, int]]:
    """(release, deadline, source, block) of every block, by the fluid schedule.

    In virtual time source s ends its block j at (j + 1) / weight; the real
    time is the service all sources have had by then. Whole numbers only.
    """
    ends = sorted(range(len(blocks)), key=lambda s: Fraction(blocks[s], weights[s]))
    finish = [Fraction(blocks[s], weights[s]) for s in ends]
    served = [0, *accumulate(blocks[s] for s in ends)]  # by those that have ended
    rate = [sum(weights), *(sum(weights) - x for x in accumulate(weights[s] for s in ends))]

    def real(j: int, weight: int, up: bool) -> int:
        at = bisect_right(finish, Fraction(j, weight))
        whole, rest = divmod(rate[at] * j, weight)
        return served[at] + whole + (up and rest > 0)

    return [
        (real(j, w, False), real(j + 1, w, True), s, j) for s, (n, w) in enumerate(zip(blocks, weights)) for j in range(n)
    ]


def schedule(blocks: Sequence[int], weights: Sequence[int]) -> list[tuple[int, int, int, int, int]]:
    """(source, block, release, deadline, slot): earliest deadline first, every slot used.

    Ties go to the source that comes first.
    """
    waiting = sorted(windows(blocks, weights), reverse=True)
    ready: list[tuple[int, int, int, int]] = []
    out = []
    for slot in range(len(waiting)):
        while waiting and waiting[-1][0] <= slot:
            release, deadline, source, block = waiting.pop()
            heapq.heappush(ready, (deadline, source, block, release))
        deadline, source, block, release = heapq.heappop(ready)
        if deadline <= slot:
            raise AssertionError("a window was missed")
        out.append((source, block, release, deadline, slot))
    return out


def source_sizes(df: DataFrame, source: str, max_sources: int = MAX_SOURCES) -> list[tuple[str | None, int]]:
    """Rows per source in order of the name, missing first; an error beyond ``max_sources``."""
    found = df.groupBy(F.col(source).alias("source")).agg(F.count(F.lit(1)).alias("n")).limit(max_sources + 1).collect()
    if len(found) > max_sources:
        raise ValueError(f"more than {max_sources} sources; mix groups of sources instead")
    return sorted(((r["source"], r["n"]) for r in found), key=lambda x: (x[0] is not None, str(x[0])))


def tempered(sizes: Sequence[tuple[str | None, int]], power: float = 0.5, unit: int = 1_000_000) -> dict[str | None, int]:
    """Weights as a power of the sizes, as whole parts of about ``unit``."""
    total = sum(n**power for _, n in sizes)
    return {s: max(1, round(unit * n**power / total)) for s, n in sizes}


def mix(
    df: DataFrame, source: str, order_by: Sequence[str], weights: Mapping[str | None, int] | None = None,
    blocks: int = BLOCKS, seed: int = 29, max_sources: int = MAX_SOURCES, rows_per_part: int = ROWS_PER_PART,
) -> DataFrame:
    """Every row of ``df`` with its place in the mixture.

    Added: weight, source_row (from 0, in a seeded order within the source),
    block, release, deadline, slot and position (dense from 0 over all rows).
    ``weights`` are whole numbers per source, by default in proportion to the
    square root of the sizes; each source of the table must have a positive
    one. A missing source is a source of its own. ``order_by`` identifies a
    row and breaks ties of the seeded order; rows equal in it are
    interchangeable. An empty table gives an empty one. Columns of ``df`` that
    are named like an added one are replaced.
    """
    added = ["weight", "source_row", "block", "release", "deadline", "slot", "position"]
    kept = [c for c in df.columns if c not in added]
    sizes = source_sizes(df, source, max_sources)
    weights = dict(weights) if weights is not None else tempered(sizes)
    if bad := [s for s, _ in sizes if weights.get(s, 0) < 1]:
        raise ValueError(f"no positive weight for {bad[:5]}")
    total = sum(n for _, n in sizes)
    block_rows = max(1, -(-total // blocks))
    plan, start = [], 0
    for s, block, release, deadline, slot in schedule([-(-n // block_rows) for _, n in sizes], [weights[s] for s, _ in sizes]):
        name, n = sizes[s]
        plan.append((name, block, weights[name], release, deadline, slot, start))
        start += min(block_rows, n - block * block_rows)
    table = local_table(
        df.sparkSession, plan,
        "_source string, _block bigint, weight bigint, release bigint, deadline bigint, slot bigint, _start bigint",
    )
    shuffled = df.select(*kept).withColumn("_random", F.xxhash64(F.lit(seed), *order_by))
    numbered = row_number_in_key(shuffled, [source], ["_random", *order_by], "source_row", rows_per_part, total)
    numbered = numbered.withColumn("block", F.expr(f"source_row div {block_rows}L"))
    # bounded: one row per block, blocks + max_sources at most
    placed = numbered.join(F.broadcast(table), F.col(source).eqNullSafe(F.col("_source")) & (F.col("block") == F.col("_block")))
    position = F.col("_start") + F.col("source_row") % block_rows
    return placed.select(*kept, "weight", "source_row", "block", "release", "deadline", "slot", position.alias("position"))


def mixed_order(df: DataFrame, source: str, order_by: Sequence[str], rows_per_part: int = ROWS_PER_PART, **options) -> DataFrame:
    """The rows of ``df`` themselves, in the order of the mixture across partitions and inside them."""
    placed = mix(df, source, order_by, rows_per_part=rows_per_part, **options)
    return placed.repartitionByRange("position").sortWithinPartitions("position").select(*df.columns)
