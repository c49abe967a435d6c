"""The prefix trie of conversations: shared beginnings, their size and what they would save.

Conversations are rebuilt, every prefix of turns gets a 128-bit name, and the
distinct names are the nodes. Totals over subtrees are made by bands of fixed
height: a node sends its values only to its ancestors inside its band, and the
totals of band roots, completed by the same rule in bands of bands, are then
handed to the band above. With a height of 16 a node is sent at most 16 times
a level, and a trie of depth D has log16(D) levels, each one step up and one
step down.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.operators.ranges import ROWS_PER_PART, in_order, parts_for
from tablewright.sources.workspace import stage

HEIGHT = 16
SLICE = 1 << 16  # turns of a conversation that share a row of its facts when these are joined back

# Fixed values of the contract: whose beginning a conversation takes over, and how much of it at most.
FAMILY = 100
HEAD_TURNS = 6

_SUMS = ["s0", "s1", "s2", "s3"]
_NODE = ["depth", "k1", "k2"]
_LOW = 0xFFFFFFFF


def numbered_turns(conversations: DataFrame, rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """conv_id, place (from 1), a 128-bit hash (a, b) of role and text, and points (code points of the text).

    Turns are ordered by ``turn``, missing first, turns of the same number by
    their hashes. A missing role or text is an empty one. Rows without
    ``conv_id`` belong to no conversation. No task needs a whole conversation.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.xxhash64(role, text).alias("a"), F.xxhash64(F.lit("b"), text, role).alias("b"),
        F.length(text).cast("bigint").alias("points"),
    )
    ordered = in_order(turns, ["conv_id", "turn", "a", "b"], rows_per_part, conversations.count())
    # the first conversation of a partition may have begun in partitions before: one row per partition
    sizes = ordered.groupBy("_part", "conv_id").agg(F.count(F.lit(1)).alias("n"))
    edges = sizes.groupBy("_part").agg(
        F.min("conv_id").alias("_first"), F.max("conv_id").alias("_last"), F.max_by("n", "conv_id").alias("_n")
    )
    so_far = F.sum("_n").over(Window.partitionBy("_last").orderBy("_part"))
    by_part = Window.orderBy("_part")
    before = edges.withColumn("_so_far", so_far).select(
        "_part", "_first",
        F.when(F.lag("_last").over(by_part) == F.col("_first"), F.lag("_so_far").over(by_part)).otherwise(0).alias("_begun"),
    )
    here = F.col("_pos") - F.min("_pos").over(Window.partitionBy("_part", "conv_id")) + 1
    begun = F.when(F.col("conv_id") == F.col("_first"), F.col("_begun")).otherwise(0)
    placed = ordered.join(F.broadcast(before), "_part").withColumn("place", here + begun)
    return stage(placed.select("conv_id", "place", "a", "b", "points"), "turns")


def head_turns(conv: Column) -> Column:
    """How many turns a conversation takes from the first of its family."""
    return F.pmod(F.crc32(conv.cast("string").cast("binary")), F.lit(HEAD_TURNS))


def rebuilt(turns: DataFrame) -> DataFrame:
    """conv_id, depth (from 1), a, b, points, length of the rebuilt conversations; a row of depth 0 stands for each of them.

    A conversation begins with the first h turns of conversation
    conv_id - conv_id % 100, all if it has fewer and none if it is absent, and
    goes on with its own turns after its first h.
    """
    conv = F.col("conv_id")
    first = conv - conv % FAMILY
    heads = turns.where((conv == first) & (F.col("place") < HEAD_TURNS)).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("place", "a", "b", "points"))).alias("heads")
    )
    sizes = turns.groupBy("conv_id").agg(F.max("place").alias("n")).withColumns({"h": head_turns(conv), "first": first})
    facts = sizes.join(heads.withColumnRenamed("conv_id", "first"), "first", "left").withColumn(
        "heads", F.coalesce(F.slice("heads", F.lit(1), F.col("h")), F.array())
    )
    facts = facts.withColumn("m", F.size("heads").cast("bigint"))
    facts = stage(facts.withColumn("length", F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "conversations")
    # a long conversation meets its facts slice by slice
    sliced = facts.select("conv_id", "m", "length", F.explode(F.expr(f"sequence(0, (n - 1) div {SLICE})")).alias("slice"))
    own = turns.withColumn("h", head_turns(conv)).where("place > h").withColumn("slice", F.expr(f"(place - 1) div {SLICE}"))
    own = own.join(sliced, ["conv_id", "slice"]).withColumn("depth", F.col("m") + F.col("place") - F.col("h"))
    columns = ["conv_id", "depth", "a", "b", "points", "length"]
    taken = facts.select("conv_id", "length", F.posexplode("heads")).select(
        "conv_id", (F.col("pos") + 1).cast("bigint").alias("depth"), "col.a", "col.b", "col.points", "length"
    )
    zero = F.lit(0).cast("bigint")
    start = facts.select(
        "conv_id", zero.alias("depth"), zero.alias("a"), zero.alias("b"), zero.alias("points"), "length"
    )
    return own.select(*columns).unionByName(taken).unionByName(start)


def _running(items: DataFrame, index: str, top: int, height: int) -> DataFrame:
    """``items`` (conv_id, index, sums) with the sums of all rows of the conversation up to the row's own.

    Sums run inside blocks of ``height`` rows, and over the blocks' totals by the same rule.
    """
    block = F.expr(f"{index} div {height}")
    window = Window.partitionBy("conv_id", "_block").orderBy(index)
    inside = items.withColumn("_block", block).withColumns({s: F.sum(s).over(window) for s in _SUMS})
    if top < height:
        return inside.drop("_block")
    totals = items.groupBy("conv_id", block.alias("_index")).agg(*[F.sum(s).alias(s) for s in _SUMS])
    before = _running(totals, "_index", top // height, height).select(
        "conv_id", (F.col("_index") + 1).alias("_block"), *[F.col(s).alias(f"_{s}") for s in _SUMS]
    )
    joined = inside.join(before, ["conv_id", "_block"], "left")
    return joined.withColumns({s: F.col(s) + F.coalesce(F.col(f"_{s}"), F.lit(0)) for s in _SUMS}).drop(
        "_block", *[f"_{s}" for s in _SUMS]
    )


def prefixes(rows: DataFrame, deepest: int, height: int = HEIGHT) -> DataFrame:
    """conv_id, depth, the name (k1, k2) of the prefix of that depth and of the one before it (p1, p2), points, ends.

    A name is the hash of the depth and of the sums of four 32-bit hashes of
    all its turns with their depths, so it needs no chain along the
    conversation; two different prefixes share one with a chance of about
    2 ** -128.
    """
    first, second = F.xxhash64("depth", "a", "b"), F.xxhash64(F.lit("s"), "b", "depth", "a")
    own = rows.withColumns(
        {
            "o0": F.when(F.col("depth") == 0, 0).otherwise(first.bitwiseAND(_LOW)),
            "o1": F.when(F.col("depth") == 0, 0).otherwise(F.shiftrightunsigned(first, 32)),
            "o2": F.when(F.col("depth") == 0, 0).otherwise(second.bitwiseAND(_LOW)),
            "o3": F.when(F.col("depth") == 0, 0).otherwise(F.shiftrightunsigned(second, 32)),
        }
    ).drop("a", "b")
    summed = _running(own.withColumns({f"s{i}": F.col(f"o{i}") for i in range(4)}), "depth", deepest, height)

    def name(depth: Column, sums: list[Column]) -> list[Column]:
        return [F.xxhash64(depth, *sums), F.xxhash64(F.lit("k"), *sums[::-1], depth)]

    here = name(F.col("depth"), [F.col(s) for s in _SUMS])
    above = name(F.col("depth") - 1, [F.col(f"s{i}") - F.col(f"o{i}") for i in range(4)])
    return summed.select(
        "conv_id", "depth", here[0].alias("k1"), here[1].alias("k2"), above[0].alias("p1"), above[1].alias("p2"),
        "points", (F.col("depth") == F.col("length")).alias("ends"),
    )


def _texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of each run of equal nodes as comma-joined texts of bounded size."""
    for batch in batches:
        rows = list(zip(*(batch.column(c).to_pylist() for c in (*_NODE, "conv_id"))))
        out, at = [], 0
        for i in range(1, len(rows) + 1):
            if i == len(rows) or rows[i][:3] != rows[at][:3]:
                out.append((*rows[at], ",".join(str(r[3]) for r in rows[at:i])))
                at = i
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out), [pa.int64()] * 4 + [pa.string()])], names=[*_NODE, "conv_id", "ids"]
        )


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The SHA-256 of the texts of each node, which follow each other."""
    node, digest, out = None, None, []

    def flush(rows: list) -> pa.RecordBatch:
        columns = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 3 + [pa.string()])], names=[*_NODE, "ends_sha256"]
        )

    for batch in batches:
        for *key, ids in zip(*(batch.column(c).to_pylist() for c in (*_NODE, "ids"))):
            if key != node:
                if node:
                    out.append((*node, digest.hexdigest()))
                node, digest = key, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        if len(out) >= 10_000:
            yield flush(out)
            out = []
    if node:
        yield flush([*out, (*node, digest.hexdigest())])


def ends(paths: DataFrame, rows: int) -> DataFrame:
    """Per node in which conversations end, the SHA-256 of their ids in rising order, joined by commas.

    The digest of one node is a chain by its nature. Ids are therefore sorted
    and joined into texts of up to a batch of rows wherever they lie, and only
    these texts pass, one after another, through the task of their node.
    """
    last = paths.where("ends").select(*_NODE, "conv_id")
    parts = parts_for(paths, rows)
    ordered = last.repartitionByRange(parts, *_NODE, "conv_id").sortWithinPartitions(*_NODE, "conv_id")
    texts = ordered.mapInArrow(_texts, "depth bigint, k1 bigint, k2 bigint, conv_id bigint, ids string")
    together = texts.repartition(parts, *_NODE).sortWithinPartitions(*_NODE, "conv_id")
    return together.select(*_NODE, "ids").mapInArrow(_digests, "depth bigint, k1 bigint, k2 bigint, ends_sha256 string")


def rollup(nodes: DataFrame, paths: DataFrame, values: list[str], deepest: int, height: int = HEIGHT) -> DataFrame:
    """depth, k1, k2 and the sums of ``values`` over the subtree of every node.

    ``nodes`` has a member conversation of each node (conv_id), whose rows in
    ``paths`` are the node's ancestors. On level l the nodes are those whose
    depth is a multiple of height ** l, and a band holds ``height`` of their
    depths. Going up, the totals inside a band become the values of its root on
    the next level; going down, the completed totals of roots are handed to all
    nodes of the band above that lie over them.
    """

    def on_level(table: DataFrame, step: int) -> DataFrame:
        return table.where(F.col("depth") % step == 0).withColumn("_band", F.expr(f"depth div {step * height}"))

    def summed(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy(*_NODE).agg(*[F.sum(v).alias(v) for v in values])

    steps = [1]
    while steps[-1] * height <= deepest:
        steps.append(steps[-1] * height)
    members = nodes.select("conv_id", *_NODE)
    ways = [on_level(paths.select("conv_id", *_NODE), s) for s in steps]
    totals: list[DataFrame] = []
    below = nodes.select("conv_id", "depth", *values)
    for step, way in zip(steps, ways):
        sender = on_level(below, step).withColumnRenamed("depth", "_from")
        inside = summed(sender.join(way, ["conv_id", "_band"]).where("depth <= _from"))
        totals.append(stage(members.join(inside, _NODE), "band"))  # every node of the level sends to itself
        below = totals[-1].select("conv_id", "depth", *values)
    complete = totals[-1]
    for level in range(len(steps) - 2, -1, -1):
        roots = complete.where("depth > 0").select("conv_id", "depth", *values)
        # the band of this level that ends above the root
        roots = roots.withColumn("_band", F.expr(f"depth div {steps[level] * height} - 1")).drop("depth")
        handed = roots.join(ways[level], ["conv_id", "_band"]).select(*_NODE, *values)
        both = summed(totals[level].select(*_NODE, *values).unionByName(handed))
        complete = stage(members.join(both, _NODE), "complete")
    return complete.select(*_NODE, *values)


def trie(conversations: DataFrame, height: int = HEIGHT, rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """One row per node of the prefix trie of the rebuilt conversations, the textless root (depth 0) among them.

    conv_id (smallest member), depth, parent_conv_id (null for the root),
    n_convs (members), n_children, n_leaves (childless nodes of its subtree),
    saved_tokens (over its subtree, members but one times the code points of
    the last text) and ends_sha256 (of the ids of the conversations that end
    there). Equal conversations share their nodes, also where whole rows are
    repeated under another id; rows repeated inside a conversation are turns of
    their own. Missing values are described at ``numbered_turns``. A table
    without conversations gives no row. Other columns are not read.
    """
    rows = rebuilt(numbered_turns(conversations, rows_per_part))
    # one number each, known before names are made
    deepest = rows.agg(F.max("length")).first()[0]
    paths = stage(prefixes(rows, deepest or 0, height), "prefixes")
    nodes = paths.groupBy(*_NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("points").alias("points"),
        F.max("p1").alias("p1"), F.max("p2").alias("p2"),
    )
    nodes = stage(nodes, "nodes")
    below = nodes.where("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"))
    children = below.groupBy(*_NODE).agg(F.count(F.lit(1)).alias("n_children"))
    counted = nodes.join(children, _NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    valued = stage(
        counted.withColumns(
            {
                "n_leaves": (F.col("n_children") == 0).cast("bigint"),
                "saved_tokens": (F.col("n_convs") - 1) * F.col("points"),
            }
        ),
        "valued",
    )
    totals = rollup(valued, paths, ["n_leaves", "saved_tokens"], deepest or 0, height)
    above = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    out = valued.drop("n_leaves", "saved_tokens").join(above, ["depth", "p1", "p2"], "left")
    out = out.join(totals, _NODE).join(ends(paths, valued.count()), _NODE, "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


ORACLE = """
WITH RECURSIVE tab AS (
  SELECT list(c ORDER BY i) AS tab FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) t(i))),
bytes AS (
  SELECT conv_id, hex(CAST(conv_id AS VARCHAR)) AS x FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)),
heads AS (
  SELECT conv_id, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(0, length(x), 2),
      lambda i: CAST('0x' || x[i + 1:i + 2] AS BIGINT))), lambda c, o: xor(tab[(xor(c, o) & 255) + 1], c >> 8))) % 6 AS h
  FROM bytes, tab),
own AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
built AS (
  SELECT o.conv_id, list_concat(list_slice(coalesce(b.turns, []), 1, h), list_slice(o.turns, h + 1, len(o.turns))) AS turns
  FROM own o JOIN heads USING (conv_id) LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 100),
paths AS (SELECT conv_id, d, list_slice(turns, 1, d) AS p, d = len(turns) AS ends FROM built, unnest(range(0, len(turns) + 1)) AS t(d)),
nodes AS (
  SELECT p, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    (count(*) - 1) * coalesce(length(any_value(p[-1].t)), 0) AS saved,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM paths GROUP BY p),
kids AS (SELECT list_slice(p, 1, depth - 1) AS p, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
full_nodes AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (p)),
sent AS (
  SELECT list_slice(p, 1, d) AS p, CAST(sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves,
    CAST(sum(saved) AS BIGINT) AS saved_tokens
  FROM full_nodes, unnest(range(0, depth + 1)) AS t(d) GROUP BY 1)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves, saved_tokens, n.ends_sha256
FROM full_nodes n JOIN sent USING (p) LEFT JOIN nodes u ON u.p = list_slice(n.p, 1, n.depth - 1) AND n.depth > 0
"""
