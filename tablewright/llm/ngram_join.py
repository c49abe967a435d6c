"""Join of documents by the Jaccard similarity of their word n-grams, on count vectors.

Hashing sends every n-gram of a document into a group; the counts of the
groups are a point, and the overlap of two documents is at most the sum of the
smaller counts. It works on keys:

* The groups are dealt into blocks, one more than two linked documents of that
  size can differ in n-grams. So linked documents have the same counts in all
  groups of at least one block, and a block's counts, as a key, bring them
  together. (Boxes over whole points do not prune here: documents of equal
  length have nearly equal coarse counts, and the bound of a box that holds
  many of them is always large enough.)
* Keys that hold the same nodes count as one, with their number as its weight.

Components come first, and most pairs need not be seen for them: in a round
each node is verified against one other, of those at the centres of its keys
the one with which it shares the most. A few rounds leave few keys with more
than one component. The small ones of these make pairs, which bounds by count
vectors thin out before they are verified on the full sets; the members of
large ones are cut into leaves by size, and a task compares leaf with leaf by
their count vectors. Nodes that these could link, directly or by others, in
whatever keys, make a group, in which they are compared once more: few pairs go
the way of the small keys' pairs, and where pairs outnumber nodes the texts are
sent, and a task verifies leaf against leaf and hands on no more links than
connect what it holds. The components of the exact link graph do not depend on
which links were found first.

All links lie inside components. To count them, a component's nodes are cut
into leaves as well, and a task counts for each node of a leaf the partners in
another. No pair leaves a task: rows grow with the nodes, and with the leaves
that a component of more than one fills; only the comparisons inside tasks
grow with the square of a component. Documents with equal sets are one node
from the start, and count as many links as it has members.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.base import keep_rows, release
from tablewright.llm.components import components
from tablewright.llm.textbytes import Texts, batches_of, lower_ascii, mixed, windows
from tablewright.operators.ranges import row_number_in_key
from tablewright.sources.workspace import stage

GROUPS_PER_BLOCK = 4096
POINT = 32  # groups of the points
ROUNDS = 3  # of one verified pair per node, before the keys that are left are searched
SMALL_KEY = 16  # members of a key that make pairs
LEAF, LEAF_GRAMS = 128, 1 << 18  # nodes of a leaf, and about so many n-grams at most (16 nodes in any case)
TIE_LEAF, MEET_LEAF, POINT_BYTES = 2048, 512, 1 << 18  # nodes of leaves compared by fine points, and the points' bytes
BOUND_ROWS = 256  # fine points of a leaf held at once against those of another
COLUMNS = 4096  # n-grams compared at once
NO_ID = -(2**63)


@dataclass(frozen=True)
class Similarity:
    """Word n-grams and the least similarity, in percent, that links."""

    words: int = 3
    percent: int = 90

    @property
    def apart(self) -> Fraction:
        """N-grams in which linked documents may differ, per n-gram of both."""
        return Fraction(100 - self.percent, 100 + self.percent)

    def bands(self, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Lower ends of the size bands up to ``most``, allowed difference and number of blocks of each.

        A pair belongs to the band of its smaller document. Some blocks are
        to spare, so that blocks that say too little need not be sent.
        """
        first = 1
        while int((first + first * 100 // self.percent) * self.apart) < 1:
            first += 1  # smaller sets link only if they are equal
        ends = [first]
        while ends[-1] <= most:
            ends.append(ends[-1] * 3 // 2 + 1)
        differ = [int((a - 1 + (a - 1) * 100 // self.percent) * self.apart) for a in ends[1:]]
        blocks = [d + 1 + -(-d * 8 // 100) + (d >= 3) for d in differ]
        return np.array(ends[:-1] or [first], np.int64), np.array(differ or [0], np.int64), np.array(blocks or [1], np.int64)

    @property
    def little(self) -> int:
        """Blocks with so many n-grams or fewer say too little."""
        return 1 if self.percent >= 88 else 0


def shingle_sets(texts: Texts, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of every text in order, and where each text's begin (and the end).

    A text with fewer words has its whole sequence as its only n-gram.
    """
    lower = Texts(lower_ascii(texts.data), texts.offsets)
    start, end, first = lower.words()
    spelled = lower.spans_hash(lower.prefix(), start, end)
    found, where = windows(spelled, first, words)
    parts = []
    for i, n in enumerate(np.diff(first).tolist()):
        if 0 < n < words:
            h = np.array([n], np.uint64)
            for at in range(first[i], first[i + 1]):
                h = mixed(h) + spelled[at : at + 1]
            parts.append(mixed(h))
        else:
            parts.append(found[where[i] : where[i + 1]])
            parts[-1].sort()
    flat = np.concatenate(parts) if parts else found
    where = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    new = np.ones(len(flat), bool)
    new[1:] = flat[1:] != flat[:-1]
    new[where[:-1][where[:-1] < len(flat)]] = True
    kept = np.concatenate([[0], np.cumsum(new)])
    return flat[new], kept[where]


def _totals(values: np.ndarray, where: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return total[where[1:]] - total[where[:-1]]


def marks(sets: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit marks of every set."""
    return (
        _totals(mixed(sets ^ np.uint64(0x5851F42D4C957F2D)), where).view(np.int64),
        _totals(mixed(sets ^ np.uint64(0x14057B7EF767814F)), where).view(np.int64),
    )


def points(sets: np.ndarray, where: np.ndarray) -> np.ndarray:
    n = len(where) - 1
    doc = np.repeat(np.arange(n), np.diff(where))
    group = (mixed(sets ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(POINT)).astype(np.int64)
    return np.bincount(doc * POINT + group, minlength=n * POINT).astype(np.int32)


def fine_points(sets: np.ndarray, where: np.ndarray) -> list[bytes]:
    """Counts in a power of two of groups, about one for four n-grams, a byte each; 255 stands for that many or more."""
    group = mixed(sets ^ np.uint64(0x2545F4914F6CDD1D)).astype(np.int64)
    out = []
    for a, b in zip(where[:-1].tolist(), where[1:].tolist()):
        size = max(16, 1 << ((b - a) // 4).bit_length())
        out.append(np.minimum(np.bincount(group[a:b] & (size - 1), minlength=size), 255).astype(np.uint8).tobytes())
    return out


def most_shared(a: bytes, b: bytes) -> int:
    """The sum of the smaller counts; the finer point is folded onto the groups of the coarser."""
    x, y = (np.frombuffer(v, np.uint8).astype(np.int64) for v in (a, b))
    x[x == 255], y[y == 255] = 1 << 40, 1 << 40
    size = min(len(x), len(y))
    return int(np.minimum(x.reshape(-1, size).sum(axis=0), y.reshape(-1, size).sum(axis=0)).sum())


def block_keys(sets: np.ndarray, where: np.ndarray, like: Similarity, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text and key of every block that is sent, for the texts that are wanted."""
    size = np.diff(where)
    ends, differ, blocks = like.bands(int(size.max(initial=1)))
    band = np.searchsorted(ends, size, "right") - 1
    docs_out, keys_out = [], []
    for lower in (0, 1):
        # a document also meets the smaller band if a partner there is large enough
        of = band - lower
        ok = wanted & (of >= 0)
        if lower:
            ok &= -(-size * like.percent // 100) < ends[np.maximum(band, 0)]
        docs = np.flatnonzero(ok)
        if not len(docs):
            continue
        count, spare = blocks[of[docs]], blocks[of[docs]] - differ[of[docs]]
        offset = np.concatenate([[0], np.cumsum(count)])
        inside = np.repeat(ok, size)
        local = np.repeat(np.arange(len(docs)), size[docs])
        h = mixed(sets[inside] ^ np.uint64(0x9FB21C651E98DF25))
        block = ((h & np.uint64(0xFFFFFFFF)) * count[local].astype(np.uint64)) >> np.uint64(32)
        slot = offset[local] + block.astype(np.int64)
        # a fixed number per group, added up: one number that stands for the block's counts
        counts = np.zeros(offset[-1], np.uint64)
        np.add.at(counts, slot, mixed((h >> np.uint64(32)) % np.uint64(GROUPS_PER_BLOCK) + np.uint64(1)))
        held = np.bincount(slot, minlength=offset[-1])
        owner = np.repeat(np.arange(len(docs)), count)
        says_little = held <= like.little
        lacking = np.bincount(owner[says_little], minlength=len(docs)) >= spare
        # two documents agree in ``spare`` blocks or more, so if one has fewer
        # blocks that say little, they agree in another one too
        send = ~says_little | lacking[owner]
        number = (np.arange(offset[-1]) - offset[:-1][owner]).astype(np.uint64)
        key = mixed(counts + number * np.uint64(0x9E3779B97F4A7C15))
        key = mixed(key + of[docs][owner].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + held.astype(np.uint64))
        docs_out.append(docs[owner[send]])
        keys_out.append(key[send].view(np.int64))
    if not docs_out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(docs_out), np.concatenate(keys_out)


def _indexed(words: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in batches_of(batches, "_text"):
            sets, where = shingle_sets(texts, words)
            first, second = marks(sets, where)
            at = np.arange(0, (len(texts) + 1) * POINT, POINT, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in ("_id", "_order", "_mark")],
                    pa.array(np.diff(where), pa.int64()), pa.array(first), pa.array(second),
                    pa.ListArray.from_arrays(pa.array(at), pa.array(points(sets, where))),
                    pa.array(fine_points(sets, where), pa.binary()),
                ],
                names=["_id", "_order", "_mark", "n", "mark1", "mark2", "point", "fine"],
            )

    return run


def _keyed(like: Similarity):
    """The keys of every set; copies in a task send theirs once."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[tuple[int, int]] = set()
        for _, texts in batches_of(batches, "_text"):
            sets, where = shingle_sets(texts, like.words)
            size = np.diff(where)
            first, second = marks(sets, where)
            wanted = size > 0
            for i, mark in enumerate(zip(first.tolist(), second.tolist())):
                if mark in sent:
                    wanted[i] = False
                sent.add(mark)
            docs, keys = block_keys(sets, where, like, wanted)
            order = np.argsort(docs, kind="stable")
            per_doc = np.searchsorted(docs[order], np.arange(len(texts) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(size, pa.int64()), pa.array(first), pa.array(second),
                    pa.ListArray.from_arrays(pa.array(per_doc), pa.array(keys[order], pa.int64())),
                ],
                names=["n", "mark1", "mark2", "keys"],
            )

    return run


def _shared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (key, node) in order the different ones of keys with more than one node."""
    key = node = np.zeros(0, np.int64)
    sent = False  # the last row of the batch before
    for batch in batches:
        key, node = (np.concatenate([v, np.asarray(batch.column(c))]) for v, c in ((key, "key"), (node, "node")))
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
        key, node = key[new], node[new]
        if not len(key):
            continue
        shared = np.zeros(len(key), bool)
        shared[1:] = key[1:] == key[:-1]
        shared[:-1] |= shared[1:]
        shared[0] |= sent
        out = shared.copy()
        out[0] &= not sent
        yield pa.RecordBatch.from_arrays([pa.array(key[out]), pa.array(node[out])], names=["key", "node"])
        key, node, sent = key[-1:], node[-1:], bool(shared[-1])


def _sets(words: int):
    """The sets of the rows whose marks are those asked for."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in batches_of(batches, "_text"):
            sets, where = shingle_sets(texts, words)
            first, second = marks(sets, where)
            fits = (first == np.asarray(batch.column("mark1"))) & (second == np.asarray(batch.column("mark2")))
            rows = np.flatnonzero(fits).tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node").take(pa.array(rows, pa.int64())),
                    pa.array([sets[where[i] : where[i + 1]].tobytes() for i in rows], pa.binary()),
                ],
                names=["node", "set"],
            )

    return run


def _bounded(percent: int):
    """The pairs whose fine points allow the overlap that the sizes ask for."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least = percent * (np.asarray(batch.column("n_a")) + np.asarray(batch.column("n_b")))
            shared = [
                most_shared(x.as_py(), y.as_py()) for x, y in zip(batch.column("fine_a"), batch.column("fine_b"))
            ]
            keep = np.flatnonzero((100 + percent) * np.array(shared, np.int64) >= least)
            yield batch.select(["a", "b"]).take(pa.array(keep))

    return run


def _verified(percent: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i, (x, y) in enumerate(zip(batch.column("set_a"), batch.column("set_b"))):
                a, b = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate([a, b])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                if 100 * common >= percent * (len(both) - common):
                    keep.append(i)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    return run


def overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets in ``a`` with all in ``b``."""
    flat = [np.concatenate(x) for x in (a, b)]
    row = [np.repeat(np.arange(len(x)), [len(v) for v in x]) for x in (a, b)]
    grams = np.intersect1d(*flat)
    out = np.zeros((len(a), len(b)), np.int64)
    for at in range(0, len(grams), COLUMNS):
        part = grams[at : at + COLUMNS]
        held = []
        for sets, values, of in zip((a, b), flat, row):
            place = np.minimum(np.searchsorted(part, values), len(part) - 1)
            has = part[place] == values
            held.append(np.zeros((len(sets), len(part)), np.float32))
            held[-1][of[has], place[has]] = 1
        out += (held[0] @ held[1].T).astype(np.int64)
    return out


def _forest(links: np.ndarray, a: list[int], b: list[int]) -> Iterator[tuple[int, int]]:
    """Links that connect as much as all of them."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = x = root.setdefault(up, up)
        return x

    for i, j in zip(*(v.tolist() for v in np.nonzero(links))):
        x, y = find(a[i]), find(b[j])
        if x != y:
            root[max(x, y)] = min(x, y)
            yield a[i], b[j]


def most_shared_of_all(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """``most_shared`` of all fine points in ``a`` with all in ``b``, or more; all are folded onto the coarsest."""
    size = min(len(x) for x in [*a, *b])
    p, q = (
        np.stack([np.minimum(np.frombuffer(x, np.uint8).reshape(-1, size).sum(axis=0), 255).astype(np.uint8) for x in v])
        for v in (a, b)
    )
    out = np.empty((len(p), len(q)), np.int64)
    for i, counts in enumerate(p):
        out[i] = np.minimum(q, counts).sum(axis=1, dtype=np.uint32)
    many = [np.flatnonzero((v == 255).any(axis=1)) for v in (p, q)]
    if len(many[0]) and len(many[1]):
        met = (p[many[0]] == 255).astype(np.float32) @ (q[many[1]] == 255).astype(np.float32).T
        out[np.ix_(*many)] += (met > 0) * np.int64(1 << 40)
    return out


def _leaf_candidates(percent: int, tie: bool):
    """Of neighbouring rows with the same ``_pair`` (two leaves): the pairs of unconnected nodes that the fine points allow.

    To ``tie``, only as many as connect all that these connect. Else, where
    they outnumber the nodes, the nodes that have such a partner, without b.
    """

    def compared(rows: list[tuple]) -> list[tuple]:
        p, q = ([r for r in rows if r[1] != other] for other in (1, 0))  # a leaf that meets itself has rows of side 2
        if not p or not q:
            return []
        n, component = ([np.array([r[at] for r in x], np.int64) for x in (p, q)] for at in (3, 4))
        may = np.zeros((len(p), len(q)), bool)
        for at in range(0, len(p), BOUND_ROWS):
            some = slice(at, at + BOUND_ROWS)
            shared = most_shared_of_all([r[5] for r in p[some]], [r[5] for r in q])
            may[some] = (100 + percent) * shared >= percent * (n[0][some, None] + n[1])
        may &= component[0][:, None] != component[1]
        nodes = [[r[2] for r in x] for x in (p, q)]
        if tie:
            return [(a, b, None, None) for a, b in _forest(may, *nodes)]
        itself = p[0][1] == 2
        if itself:
            may = np.triu(may)
        if np.count_nonzero(may) <= len(rows):
            return [(nodes[0][i], nodes[1][j], None, None) for i, j in zip(*(v.tolist() for v in np.nonzero(may)))]
        held = [may.any(axis=1), may.any(axis=0)]
        met = [(p, held[0] | held[1])] if itself else [(p, held[0]), (q, held[1])]
        return [(x[i][2], None, *x[i][:2]) for x, of in met for i in np.flatnonzero(of).tolist()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("_pair", pa.string()), ("side", pa.int32())])

        def out(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in found], f.type) for i, f in enumerate(schema)], schema=schema)

        pair, held, found = None, [], []
        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in ("_pair", "side", "node", "n", "component", "fine")]):
                if row[0] != pair:
                    found += compared(held)
                    pair, held = row[0], []
                held.append(row)
            if found:
                yield out(found)
                found = []
        yield out(compared(held))

    return run


def _leaf_links(like: Similarity, count: bool):
    """Of neighbouring rows with the same ``_pair`` (two leaves): each node's number of links, or links that connect all."""

    def compared(rows: list[tuple]) -> list[tuple[int, int]]:
        sides = []
        for other in (1, 0):  # a leaf that meets itself has rows of side 2; rows may share id and set
            sides.append(list({r[1]: r for r in rows if r[0] != other}.values()))
        p, q = sides
        if not p or not q:
            return []
        common = overlaps([r[3] for r in p], [r[3] for r in q])
        size = [np.array([len(r[3]) for r in x], np.int64) for x in sides]
        links = 100 * common >= like.percent * (size[0][:, None] + size[1][None, :] - common)
        nodes = [[r[1] for r in x] for x in sides]
        links &= np.array(nodes[0])[:, None] != np.array(nodes[1])[None, :]
        if not count:
            return list(_forest(links, *nodes))
        copies = [np.array([r[2] for r in x], np.int64) for x in sides]
        found = list(zip(nodes[0], (links @ copies[1]).tolist()))
        if p[0][0] != 2:
            found += zip(nodes[1], (links.T @ copies[0]).tolist())
        return [x for x in found if x[1]]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(found: list[tuple[int, int]]) -> pa.RecordBatch:
            a, b = zip(*found) if found else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        pair, held, found = None, [], []
        for batch, texts in batches_of(batches, "_text"):
            sets, where = shingle_sets(texts, like.words)
            first, second = marks(sets, where)
            fits = (first == np.asarray(batch.column("mark1"))) & (second == np.asarray(batch.column("mark2")))
            columns = [batch.column(c).to_pylist() for c in ("_pair", "side", "node", "copies")]
            for i, (of, side, node, copies) in enumerate(zip(*columns)):
                if of != pair:
                    found += compared(held)
                    pair, held = of, []
                if fits[i]:
                    held.append((side, node, copies, sets[where[i] : where[i + 1]].copy()))
            if found:
                yield out(found)
                found = []
        yield out(compared(held))

    return run


def _may_link(a: str, b: str, percent: int) -> Column:
    """The sum of the smaller counts reaches the overlap that the sizes ask for."""
    most = f"aggregate(zip_with({a}.point, {b}.point, (x, y) -> least(x, y)), 0, (s, x) -> s + x)"
    return F.expr(f"{100 + percent}L * {most} >= {percent}L * ({a}.n + {b}.n)")


class _Search:
    """The steps of the search over one table of nodes."""

    def __init__(self, docs: DataFrame, id_column: str, text: str, like: Similarity):
        self.like = like
        flat = docs.select(
            F.col(id_column).alias("_id"),
            F.coalesce(F.col(id_column).cast("bigint"), F.lit(NO_ID)).alias("_order"),
            F.xxhash64(text).alias("_mark"),
            F.col(text).alias("_text"),
        )
        kind = flat.schema["_id"].dataType.simpleString()
        self.indexed = stage(
            flat.mapInArrow(
                _indexed(like.words),
                f"_id {kind}, _order bigint, _mark bigint, n bigint, mark1 bigint, mark2 bigint, point array<int>, fine binary",
            ),
            "indexed",
        )
        classes = self.indexed.where("n > 0").groupBy("n", "mark1", "mark2").agg(
            F.min("_order").alias("_first"), F.first("point").alias("point"), F.first("fine").alias("fine"),
            F.count(F.lit(1)).alias("copies"),
        )
        # documents with equal sets are one node; ids may be shared, so they do not name it
        node = F.xxhash64("n", "mark1", "mark2")
        self.nodes = stage(classes.withColumn("node", node), "nodes")
        # most keys are held by one document: they are only made on the way into the one shuffle that finds the others
        keyed = flat.select("_text").mapInArrow(_keyed(like), "n bigint, mark1 bigint, mark2 bigint, keys array<bigint>")
        postings = keyed.select(F.explode("keys").alias("key"), node.alias("node")).repartition("key")
        members = stage(postings.sortWithinPartitions("key", "node").mapInArrow(_shared, "key bigint, node bigint"), "postings")
        del classes, keyed, postings
        release(docs.sparkSession)
        self.members = stage(self._merged(members), "members")
        del members
        release(docs.sparkSession)
        self.texts = flat.select(F.col("_order").alias("_first"), "_text")

    @staticmethod
    def _open(members: DataFrame, label: str) -> DataFrame:
        """The members of keys that hold more than one label."""
        more = members.groupBy("key").agg(F.min(label).alias("_l"), F.max(label).alias("_h")).where("_l <> _h").select("key")
        return members.join(more, "key", "left_semi")

    @staticmethod
    def _merged(members: DataFrame) -> DataFrame:
        """The members of one of the keys that hold the same nodes, with the number of these keys."""
        held = members.groupBy("key").agg(
            F.count(F.lit(1)).alias("_c"), F.bit_xor(F.xxhash64("node")).alias("_x"),
            F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("_y"),
        )
        one = held.groupBy("_c", "_x", "_y").agg(F.min("key").alias("key"), F.count(F.lit(1)).alias("weight"))
        return members.join(one.select("key", "weight", F.col("_c").alias("size")), "key")

    def labelled(self, found: DataFrame | None) -> DataFrame:
        if found is None:
            return self.members.withColumn("component", F.col("node"))
        known = self.members.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
        return self._open(known, "component")

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that pass the bound and the threshold."""
        percent = self.like.percent
        one, two = self.nodes.select("node", "n", "point").alias("p"), self.nodes.select("node", "n", "point").alias("q")
        near = (
            pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
            .join(one, F.col("a") == F.col("p.node")).join(two, F.col("b") == F.col("q.node"))
            .where(_may_link("p", "q", percent)).select("a", "b")
        )
        # coarse points bound long documents loosely; the fine ones are longer and meet fewer pairs
        fine = [self.nodes.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("fine").alias(f"fine_{c}")) for c in "ab"]
        close = near.join(fine[0], "a").join(fine[1], "b").mapInArrow(_bounded(percent), "a bigint, b bigint")
        close = stage(close, "close")
        # the full sets of the documents that are left, from their texts
        left = close.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        asked = stage(left.join(self.nodes.select("node", "_first", "mark1", "mark2"), "node"), "asked")
        texts = self.texts.join(asked, "_first")
        # two rows that share id and set give a link twice, which does no harm
        sets = texts.mapInArrow(_sets(self.like.words), "node bigint, set binary")
        full = close.join(sets.select(F.col("node").alias("a"), F.col("set").alias("set_a")), "a").join(
            sets.select(F.col("node").alias("b"), F.col("set").alias("set_b")), "b"
        )
        return full.mapInArrow(_verified(percent), "a bigint, b bigint")

    def star(self, found: DataFrame | None) -> DataFrame:
        """A pair for each member that its key's centre is not connected with: with the centre it shares the most keys with.

        Centres are the smallest members, of the largest component once some are known.
        """
        known = self.labelled(found)
        pick = F.min("node") if found is None else F.max(F.struct("component", "node"))["node"]
        label = F.min("component") if found is None else F.max("component")
        centre = known.groupBy("key").agg(pick.alias("a"), label.alias("_c"))
        met = known.join(centre, "key").where("node <> a AND component <> _c")
        shared = met.groupBy("node", "a").agg(F.sum("weight").alias("_s"))
        return shared.groupBy(F.col("node").alias("b")).agg(F.max(F.struct("_s", "a"))["a"].alias("a")).select("a", "b")

    def small(self, known: DataFrame) -> DataFrame:
        """The pairs of unconnected members of the small keys."""
        few = known.where(f"size <= {SMALL_KEY}").join(self.nodes.select("node", "n"), "node").select("key", "node", "n", "component")
        p, q = few.alias("p"), few.alias("q")
        percent = self.like.percent
        return p.join(q, "key").where(
            (F.col("p.node") < F.col("q.node")) & (F.col("p.component") != F.col("q.component"))
            & (F.least("p.n", "q.n") * 100 >= F.greatest("p.n", "q.n") * percent)
        ).select(F.col("p.node").alias("a"), F.col("q.node").alias("b"))

    def candidates(self, rows: DataFrame, tie: bool) -> DataFrame:
        """What the fine points allow inside the groups (group, node, component), see ``_leaf_candidates``."""
        # a fine point has a byte for two to four n-grams
        met = self.leaves(rows, f"greatest(16, least({TIE_LEAF if tie else MEET_LEAF}, {2 * POINT_BYTES} >> band))", False)
        dealt = met.join(self.nodes.select("node", "n", "fine"), "node").repartition("_pair").sortWithinPartitions("_pair")
        found = dealt.mapInArrow(_leaf_candidates(self.like.percent, tie), "a bigint, b bigint, _pair string, side int")
        return stage(found, "candidates")

    def large(self, known: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The pairs of unconnected members of the large keys that pass the fine bound, and leaves with too many of them.

        Large keys mostly repeat each other, so what may link in any of them is first brought together once.
        """
        many = known.where(f"size > {SMALL_KEY}").select(F.col("key").alias("group"), "node", "component")
        tied = components(self.candidates(many, True).select("a", "b")).withColumnRenamed("component", "group")
        found = self.candidates(tied.join(many.select("node", "component").distinct(), "node"), False)
        return found.where("b IS NOT NULL").select("a", "b"), found.where("b IS NULL").select("_pair", "side", F.col("a").alias("node"))

    def leaves(self, rows: DataFrame, each: str, count: bool) -> DataFrame:
        """_pair, side, node, component of all pairs of leaves of each group (group, node, component) whose sizes allow links."""
        sized = rows.join(self.nodes.select("node", "n"), "node").withColumn("band", F.floor(F.log2("n")).cast("int"))
        numbered = row_number_in_key(sized, ["group", "band"], ["n", "node"], "_row")
        packed = stage(numbered.withColumn("leaf", F.expr(f"_row div {each}")).drop("_row"), "leaves")
        boxes = packed.groupBy("group", "band", "leaf").agg(
            F.min("n").alias("n"), F.max("n").alias("most"), F.min("component").alias("low"), F.max("component").alias("top")
        )
        p, q = boxes.alias("p"), boxes.alias("q")
        same = (F.col("p.band") == F.col("q.band")) & (F.col("p.leaf") == F.col("q.leaf"))
        ok = F.struct("p.band", "p.leaf") <= F.struct("q.band", "q.leaf")
        ok = ok & (F.col("p.most") * 100 >= F.col("q.n") * self.like.percent)
        if not count:  # of one component, all is known
            ok = ok & (F.least("p.low", "q.low") < F.greatest("p.top", "q.top"))
        place = lambda x, side: F.struct(F.col(f"{x}.band").alias("band"), F.col(f"{x}.leaf").alias("leaf"), side.alias("side"))
        sides = F.when(same, F.array(place("p", F.lit(2)))).otherwise(F.array(place("p", F.lit(0)), place("q", F.lit(1))))
        met = p.join(q, "group").where(ok).select(
            "group", F.concat_ws("/", "group", "p.band", "p.leaf", "q.band", "q.leaf").alias("_pair"), F.explode(sides).alias("_s")
        ).select("group", "_pair", "_s.*")
        return met.join(packed.select("group", "band", "leaf", "node", "component"), ["group", "band", "leaf"]).select(
            "_pair", "side", "node", "component"
        )

    def in_leaves(self, placed: DataFrame, count: bool) -> DataFrame:
        """What the tasks find on the full sets in pairs of leaves (_pair, side, node)."""
        named = placed.join(self.nodes.select("node", "_first", "mark1", "mark2", "copies"), "node")
        dealt = self.texts.join(named, "_first").drop("_first").repartition("_pair").sortWithinPartitions("_pair")
        return dealt.mapInArrow(_leaf_links(self.like, count), "a bigint, b bigint")


def _components(search: _Search) -> DataFrame:
    """(node, component) of the nodes that link, by as few pairs as that takes."""
    spark = search.nodes.sparkSession
    found = None

    def joined(more: DataFrame) -> DataFrame:
        if found is None:
            return components(more)
        return components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))

    for _ in range(ROUNDS):
        found = joined(search.links(search.star(found)))
        release(spark)
    other = F.when(F.col("component") != F.col("node"), F.col("component")).alias("component")
    known = stage(search.labelled(found).select("key", "node", "size", other), "open")
    known = known.withColumn("component", F.coalesce("component", "node"))
    if known.isEmpty():
        return found
    pairs, dense = search.large(known)
    release(spark)
    more = stage(search.links(search.small(known).unionByName(pairs)), "links")
    release(spark)
    found = joined(more if dense.isEmpty() else more.unionByName(search.in_leaves(dense, False)))
    del more, known, pairs, dense
    release(spark)
    return found


def _links_of(search: _Search, found: DataFrame) -> DataFrame:
    """node and _linked, the rows of other nodes it links with."""
    rows = found.select(F.col("component").alias("group"), "node", "component").distinct()
    placed = search.leaves(rows, f"greatest(16, least({LEAF}, {LEAF_GRAMS} >> band))", True).drop("component")
    counted = search.in_leaves(placed, True)
    return counted.groupBy(F.col("a").alias("node")).agg(F.sum("b").alias("_linked"))


def _of_rows(search: _Search, found: DataFrame, linked: DataFrame | None = None) -> DataFrame:
    """_id, _order, _mark, n, _group and _component (its smallest id) of every row; without words, the group is missing.

    With ``linked`` (see ``_links_of``) also n_links, the number of other rows that a row links with.
    """
    nodes = search.nodes.drop("point", "fine")
    grouped = nodes.join(found, "node", "left").withColumn("_group", F.coalesce("component", "node"))
    n_links = []
    if linked is not None:
        grouped = grouped.join(linked, "node", "left").withColumn(
            "n_links", F.col("copies") - 1 + F.coalesce("_linked", F.lit(0))
        )
        n_links = ["n_links"]
    smallest = grouped.groupBy("_group").agg(F.min("_first").alias("_named"))
    named = grouped.select("n", "mark1", "mark2", "_group", *n_links).join(smallest, "_group")
    result = search.indexed.drop("point", "fine").join(named, ["n", "mark1", "mark2"], "left")
    return result.select("_id", "_order", "_mark", "n", "_group", F.coalesce("_named", "_order").alias("_component"), *n_links)


def near_duplicates(docs: DataFrame, id_column: str, text: str, like: Similarity = Similarity()) -> DataFrame:
    """id, n_shingles, component_id, n_links of every row; a component is named by its smallest id.

    Words are runs of anything but blanks, with A-Z in lower case; a document
    is the set of its n-grams. Two documents link if the sets' overlap is at
    least ``like.percent`` of their union; documents without words link with
    nothing and are components of their own, as is a missing text. Rows with
    equal sets are linked, so repeated rows fall together. ``n_links`` is the
    number of other rows with which a row links. A missing id counts
    as the smallest and names its component as missing. Ids are whole
    numbers. Other columns are not read. An empty table gives an empty one.
    Sets are compared by 64-bit hashes of their n-grams.
    """
    search = _Search(docs, id_column, text, like)
    found = _components(search)
    linked = stage(_links_of(search, found), "linked")
    release(docs.sparkSession)
    return _of_rows(search, found, linked).select(
        F.col("_id").alias(id_column), F.col("n").alias("n_shingles"),
        F.when(F.col("_component") != NO_ID, F.col("_component")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
    )


def without_near_duplicates(docs: DataFrame, id_column: str, text: str, like: Similarity = Similarity()) -> DataFrame:
    """``docs`` with one row of each component, the one with the smallest id; all columns stay as they are.

    Documents without words all stay. Rows equal in id and text count as one.
    """
    search = _Search(docs, id_column, text, like)
    found = stage(_of_rows(search, _components(search)), "components")
    first = found.where("n > 0").groupBy("_group").agg(F.min(F.struct("_order", "_mark", "_id")).alias("_f"))
    keys = first.select("_f._id", "_f._mark").unionByName(found.where("n = 0").select("_id", "_mark"))
    return keep_rows(docs, id_column, F.xxhash64(text), keys)
