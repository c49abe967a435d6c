"""Removing passages that an earlier document has already, by suffix sorting.

Passages of ``WIDTH`` bytes are compared across the whole corpus. So that
equal ones meet in one task, each passage belongs to its anchor, the smallest
hash of the short byte strings in it; neighbours in a text mostly share their
anchor, and a run of them travels as one segment of text.

Documents are dealt into groups of bounded size, and anchors into buckets. A
first round trip tells each group which of its anchors other documents have as
well; only segments with such an anchor are sent, packed by bucket. In a
bucket, segments are sorted in two stages: only suffixes smaller than their
successor are sorted directly; the others follow by scanning the buckets of
first bytes in order, since a suffix larger than its successor is ordered by
its first byte and the place of that successor. Neighbours in the sorted order
with a common prefix of ``WIDTH`` bytes are equal passages; all but those of
the smallest document go.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.textbytes import INVERSE, Texts, mixed, powers, slices

WIDTH = 50
ANCHOR = 16  # bytes of the strings whose smallest hash a passage belongs to
GROUP_BYTES = 8 << 20  # text of a group of documents; there are as many buckets
SORT_BYTES = 8 << 20  # of segments sorted at once, more only for a single anchor

_SEGMENT = ["rows", "ids", "starts", "lengths", "anchors"]
_SPAN = ["rows", "begin", "end"]


def _compress(raw: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _decompress(blob: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(blob)


def _pack(values: np.ndarray) -> bytes:
    """Whole numbers as the compressed differences of neighbours, wide enough for them."""
    steps = np.diff(values, prepend=values.dtype.type(0))
    return _compress(steps.tobytes())


def _unpack(blob: bytes, kind=np.int64) -> np.ndarray:
    return np.cumsum(np.frombuffer(_decompress(blob), kind), dtype=kind)


def anchors(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, number of passages and smallest hash of every run of passages that share it."""
    n, none = len(texts.data), np.zeros(0, np.int64)
    count = n - WIDTH + 1
    if count < 1:
        return none, none, np.zeros(0, np.uint64)
    prefix = texts.prefix()
    low = mixed((prefix[ANCHOR:] - prefix[:-ANCHOR]) * powers(INVERSE, n - ANCHOR + 1))
    reach, span = 1, WIDTH - ANCHOR + 1
    while reach * 2 <= span:  # minimum over 2, 4, 8 .. strings
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    low = np.minimum(low[: count], low[span - reach :][:count])
    whole = np.zeros(n + 1, np.int32)  # passages that lie inside one text
    long = np.diff(texts.offsets) >= WIDTH
    np.add.at(whole, texts.offsets[:-1][long], 1)
    np.add.at(whole, texts.offsets[1:][long] - WIDTH + 1, -1)
    inside = np.cumsum(whole)[:count] > 0
    begins = texts.starts()[:count]
    new = inside.copy()
    new[1:] &= ~inside[:-1] | begins[1:] | (low[1:] != low[:-1])
    start = np.flatnonzero(new)
    stop = np.flatnonzero(inside & np.append(new[1:] | ~inside[1:], True)) + 1
    return start, stop - start, low[start]


def _smallest_of_equal(keys: list[np.ndarray], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flags of the rows with the smallest id among rows of equal keys, and of the rows with a larger id."""
    n = len(ids)
    order = np.lexsort([ids, *keys])
    head = np.ones(n, bool)
    head[1:] = False
    for k in keys:
        s = k[order]
        head[1:] |= s[1:] != s[:-1]
    group = np.cumsum(head) - 1
    smallest = ids[order][head][group]
    larger = np.zeros(n, bool)
    larger[order] = ids[order] > smallest
    return ~larger, larger


class _Group:
    """The documents of one group, in the order of their ids, with the anchors of their segments."""

    def __init__(self, table: pa.Table, buckets: int, spell: bool):
        order = np.lexsort((np.asarray(table.column("_mark")), np.asarray(table.column("_order"))))
        self.table = table.take(pa.array(order))
        ids = np.asarray(self.table.column("_order"))
        found: list[tuple] = []
        self.raw: list[bytes] = []
        for part in slices(self.table.column("_text")):
            start, count, low = anchors(part)
            length = count + WIDTH - 1
            doc = np.searchsorted(part.offsets, start, "right") - 1
            keys = part.spans_hash(part.prefix(), start, start + length) if spell else low
            piece = np.full(len(start), len(self.raw))
            self.raw.append(part.data.tobytes() if spell else b"")
            found.append((doc + part.first, start - part.offsets[doc], length, low, keys, piece, start))
        none = np.zeros(0, np.int64)
        columns = [np.concatenate(x) for x in zip(*found)] if found else [none] * 7
        self.rows, self.starts, self.lengths, low, self.keys, self.piece, self.at = columns
        spread = mixed(low.astype(np.uint64))
        self.anchors = (spread >> np.uint64(32)).astype(np.int64)
        self.buckets = (spread % np.uint64(buckets)).astype(np.int64)
        self.ids = ids[self.rows] if len(self.rows) else none

    def by_bucket(self) -> Iterator[tuple[int, np.ndarray]]:
        """Each bucket with its segments, by anchor and document."""
        order = np.lexsort((self.rows, self.anchors, self.buckets))
        edges = np.flatnonzero(np.diff(self.buckets[order], prepend=-1)).tolist()
        for a, b in zip(edges, [*edges[1:], len(order)]):
            yield int(self.buckets[order[a]]), order[a:b]

    def distinct(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flags of the first segment of every anchor, and for each anchor whether several ids have it."""
        head = np.diff(self.anchors[rows], prepend=-1) != 0
        at = np.flatnonzero(head)
        ids = self.ids[rows]
        return head, np.minimum.reduceat(ids, at) != np.maximum.reduceat(ids, at)


def _announce(buckets: int):
    """The anchors of a group, one row per bucket, with flags of those that several of its documents have."""

    def run(table: pa.Table) -> pa.Table:
        group = _Group(table, buckets, spell=False)
        out: dict[str, list] = {"anchor_bucket": [], "bucket": [], "anchors": [], "several": []}
        for bucket, rows in group.by_bucket():
            head, several = group.distinct(rows)
            out["anchor_bucket"].append(bucket)
            out["bucket"].append(table.column("bucket")[0].as_py())
            out["anchors"].append(_pack(group.anchors[rows][head]))
            out["several"].append(np.packbits(several).tobytes())
        return pa.table(out, schema=pa.schema(
            [("anchor_bucket", pa.int64()), ("bucket", pa.int64()), ("anchors", pa.binary()), ("several", pa.binary())]
        ))

    return run


def _answer(table: pa.Table) -> pa.Table:
    """For each group, flags of its anchors that several documents of the corpus have."""
    lists = [_unpack(b) for b in table.column("anchors").to_pylist()]
    several = [np.unpackbits(np.frombuffer(b, np.uint8), count=len(x)) for b, x in zip(table.column("several").to_pylist(), lists)]
    values, inverse, count = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    shared = count > 1
    np.logical_or.at(shared, inverse, np.concatenate(several).astype(bool))
    flags = np.split(shared[inverse], np.cumsum([len(x) for x in lists])[:-1])
    return pa.table(
        {
            "bucket": table.column("bucket"),
            "anchor_bucket": table.column("anchor_bucket"),
            "shared": pa.array([np.packbits(f).tobytes() for f in flags], pa.binary()),
        }
    )


def _smallest_of_equal(keys: list[np.ndarray], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flags of the rows with the smallest id among rows of equal keys, and of the rows with a larger id."""
    n = len(ids)
    order = np.lexsort([ids, *keys])
    head = np.ones(n, bool)
    head[1:] = False
    for k in keys:
        s = k[order]
        head[1:] |= s[1:] != s[:-1]
    group = np.cumsum(head) - 1
    smallest = ids[order][head][group]
    larger = np.zeros(n, bool)
    larger[order] = ids[order] > smallest
    return ~larger, larger


def _send(buckets: int):
    """The segments of a group whose anchor is shared, one row per bucket.

    Of segments that are equal in the group only the smallest id's are sent;
    the others are known to go, and travel as spans.
    """

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        names = ["anchor_bucket", "bucket", *_SEGMENT, "body", *[f"known_{c}" for c in _SPAN]]
        kinds = [pa.int64(), pa.int64(), *[pa.binary()] * (len(names) - 2)]
        out: list[list] = []
        shared = dict(zip(answers.column("anchor_bucket").to_pylist(), answers.column("shared").to_pylist()))
        if len(table):
            group = _Group(table, buckets, spell=True)
            own = table.column("bucket")[0].as_py()
            for bucket, rows in group.by_bucket():
                head, several = group.distinct(rows)
                flags = np.unpackbits(np.frombuffer(shared[bucket], np.uint8), count=len(several)).astype(bool)
                rows = rows[flags[np.cumsum(head) - 1]]
                if not len(rows):
                    continue
                first, larger = _smallest_of_equal([group.keys[rows], group.anchors[rows], group.lengths[rows]], group.ids[rows])
                send, known = np.sort(rows[first]), np.sort(rows[larger])
                body = b"".join([
                    group.raw[p][a : a + n]
                    for p, a, n in zip(group.piece[send].tolist(), group.at[send].tolist(), group.lengths[send].tolist())
                ])
                segment = [x[send] for x in (group.rows, group.ids, group.starts, group.lengths, group.anchors)]
                spans = [group.rows[known], group.starts[known], group.starts[known] + group.lengths[known]]
                out.append([bucket, own, *map(_pack, segment), _compress(body), *map(_pack, spans)])
        return pa.table([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=names)

    return run


def sort_passages(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Starts of all passages of the segments, so that equal ones are neighbours: two-stage suffix sorting.

    The segments lie behind each other in ``data``; ``starts`` and ``lengths``
    say where. The order is lexicographic by ``WIDTH`` bytes.
    """
    n = len(data)
    ends = starts + lengths
    # larger than the successor, or not; equal bytes go with what follows, and
    # a segment's last byte counts as smaller than what is not there
    following = np.empty(n, data.dtype)
    following[:-1] = data[1:]
    decided = data != np.append(data[1:], 0)
    decided[ends - 1] = True
    falls = data > np.append(data[1:], 0)
    falls[ends - 1] = False
    where = np.where(decided, np.arange(n), n - 1)
    falls = falls[np.minimum.accumulate(where[::-1])[::-1]]

    passages = np.zeros(n + 1, np.int32)
    passages[starts] += 1
    passages[ends - WIDTH + 1] -= 1
    passage = np.cumsum(passages[:-1]) > 0
    # a falling last passage is ordered by its successors up to the first that rises
    rising = np.where(falls, n, np.arange(n))
    next_rise = np.minimum.accumulate(rising[::-1])[::-1]
    member = passage.copy()
    last = ends - WIDTH
    for s in last[falls[last]].tolist():
        member[s + 1 : next_rise[s] + 1] = True
    falls &= member

    direct = np.flatnonzero(member & ~falls)
    direct = direct[_order_by_bytes(data, direct)]
    letters = data[direct]
    edges = np.searchsorted(letters, np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    out: list[np.ndarray] = []

    def induce(found: np.ndarray, letter: int) -> np.ndarray:
        """Hand the falling predecessors on to their buckets; those of this one are returned."""
        before = found[found > 0] - 1
        before = before[falls[before]]
        first = data[before]
        order = np.argsort(first, kind="stable")
        before, first = before[order], first[order]
        cuts = np.flatnonzero(np.diff(first)) + 1
        own = before[:0]
        for group in np.split(before, cuts) if len(before) else []:
            if data[group[0]] == letter:
                own = group
            else:
                waiting[data[group[0]]].append(group)
        return own

    for letter in range(256):
        found = np.concatenate(waiting[letter]) if waiting[letter] else direct[:0]
        waiting[letter] = []
        while len(found):
            out.append(found)
            found = induce(found, letter)
        found = direct[edges[letter] : edges[letter + 1]]
        if len(found):
            out.append(found)
            induce(found, letter)
    order = np.concatenate(out) if out else direct
    return order[passage[order]]


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position as one number, in byte order."""
    padded = np.concatenate([data, np.zeros(WIDTH + 8, np.uint8)])
    return np.ndarray((len(padded) - 7,), ">u8", padded.tobytes(), strides=(1,))


def _order_by_bytes(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Order of the positions by the bytes from there, eight at a time, as long as there are ties."""
    words = _words(data)
    order = np.argsort(words[at].astype(np.uint64), kind="stable")
    key = words[at[order]].astype(np.uint64)
    new = np.ones(len(at), bool)
    new[1:] = key[1:] != key[:-1]
    for skip in range(8, WIDTH, 8):
        tied = ~new
        tied[:-1] |= ~new[1:]
        some = np.flatnonzero(tied)
        if not len(some):
            break
        group = np.cumsum(new[some])
        key = words[at[order[some]] + skip].astype(np.uint64)
        inner = np.lexsort((key, group))
        order[some] = order[some][inner]
        key = key[inner]
        again = np.ones(len(some), bool)
        again[1:] = (group[1:] != group[:-1]) | (key[1:] != key[:-1])
        new[some] = again
    return order


def repeated(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segment, first and last byte (exclusive) of the runs that a smaller document has too."""
    order = sort_passages(data, starts, lengths)
    segment = np.searchsorted(starts, order, "right") - 1
    words = _words(data)
    same = np.ones(max(len(order) - 1, 0), bool)  # common prefix of WIDTH bytes with the one before
    for skip in [*range(0, WIDTH - 7, 8), WIDTH - 8]:
        key = words[order + skip]
        same &= key[1:] == key[:-1]
    head = np.append(True, ~same)[: len(order)]
    at = np.flatnonzero(head)
    smallest = np.minimum.reduceat(ids[segment], at) if len(at) else ids[:0]
    gone = ids[segment] > np.repeat(smallest, np.diff(np.append(at, len(order))))
    flag = np.zeros(len(data) + 1, bool)
    flag[order[gone]] = True
    first = np.flatnonzero(flag[:-1] & ~np.append(False, flag[:-1])[:-1])
    stop = np.flatnonzero(flag[:-1] & ~flag[1:]) + 1
    # a run of flags never passes a segment's end: its last bytes begin no passage
    return np.searchsorted(starts, first, "right") - 1, first, stop + WIDTH - 1


def _find(sort_bytes: int):
    """Spans of one bucket's segments that smaller documents have too, one row per group of documents."""

    def run(table: pa.Table) -> pa.Table:
        def joined(name: str, kind=np.int64) -> np.ndarray:
            return np.concatenate([_unpack(b, kind) for b in table.column(name).to_pylist()])

        def groups(name: str) -> np.ndarray:
            return np.repeat(np.asarray(table.column("bucket")), [len(_unpack(b)) for b in table.column(name).to_pylist()])

        rows, ids, starts, lengths, low = (joined(c) for c in _SEGMENT)
        owner = groups("rows")
        data = np.frombuffer(b"".join(_decompress(b) for b in table.column("body").to_pylist()), np.uint8)
        found = [(groups("known_rows"), *(joined(f"known_{c}") for c in _SPAN))]
        offset = np.cumsum(lengths) - lengths
        order = np.argsort(low, kind="stable")
        size = np.diff(np.append(np.flatnonzero(np.diff(low[order], prepend=-1)), len(low)))
        # whole anchors are sorted together, as many as fit
        if len(size):
            ends = np.cumsum(size)
            part = (np.cumsum(lengths[order])[ends - 1] - 1) // sort_bytes
            cuts = [0, *ends[np.flatnonzero(np.diff(part, append=-1))].tolist()]
            for a, b in zip(cuts[:-1], cuts[1:]):
                some = order[a:b]
                data_of, where = _gather(data, offset[some], lengths[some])
                texts = Texts(data_of, where)
                keys = texts.spans_hash(texts.prefix(), where[:-1], where[1:])
                first, larger = _smallest_of_equal([keys, low[some], lengths[some]], ids[some])
                known = some[larger]
                found.append((owner[known], rows[known], starts[known], starts[known] + lengths[known]))
                some = some[first]
                data_of, where = _gather(data, offset[some], lengths[some])
                which, begin, end = repeated(data_of, where[:-1], lengths[some], ids[some])
                shift = starts[some[which]] - where[:-1][which]
                found.append((owner[some[which]], rows[some[which]], begin + shift, end + shift))
        owner, *spans = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((spans[1], spans[0], owner))
        edges = np.flatnonzero(np.diff(owner[order], prepend=-1)).tolist()
        parts = [order[a:b] for a, b in zip(edges, [*edges[1:], len(order)])]
        return pa.table(
            {
                "bucket": pa.array([int(owner[p[0]]) for p in parts], pa.int64()),
                **{c: pa.array([_pack(x[p]) for p in parts], pa.binary()) for c, x in zip(_SPAN, spans)},
            }
        )

    return run


def _gather(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The segments behind each other, and where each begins (and the end)."""
    raw = data.data
    out = b"".join([raw[a : a + m] for a, m in zip(starts.tolist(), lengths.tolist())])
    return np.frombuffer(out, np.uint8), np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def _cut(docs: pa.Table, spans: pa.Table) -> pa.Table:
    """The documents of one group without the spans found for them."""
    none = np.zeros(0, np.int64)
    rows, begin, end = (np.concatenate([none, *map(_unpack, spans.column(c).to_pylist())]) for c in _SPAN)
    order = np.lexsort((begin, rows))
    rows, begin, end = rows[order], begin[order], end[order]
    order = np.lexsort((np.asarray(docs.column("_mark")), np.asarray(docs.column("_order"))))
    docs = docs.take(pa.array(order))
    edges = np.searchsorted(rows, np.arange(len(docs) + 1)).tolist()
    removed, kept, sizes = [], [], []
    for i, text in enumerate(docs.column("_text").to_pylist()):
        raw = text.encode() if text else b""
        runs: list[list[int]] = []
        part = slice(edges[i], edges[i + 1])
        for a, b in zip(begin[part].tolist(), end[part].tolist()):
            if runs and a <= runs[-1][1]:
                runs[-1][1] = max(runs[-1][1], b)
            else:
                runs.append([a, b])
        at, rest = 0, []
        for a, b in runs:
            rest.append(raw[at:a])
            at = b
        sizes.append(len(raw))
        removed.append([{"from": a, "to": b} for a, b in runs])
        kept.append(b"".join([*rest, raw[at:]]))
    kind = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
    return pa.table(
        {
            "_id": docs.column("_id"),
            "n_bytes": pa.array(sizes, pa.int64()),
            "spans": pa.array(removed, kind),
            "kept": pa.array(kept, pa.binary()),
        }
    )


def cut_repeats(
    docs: DataFrame, id_column: str, text: str, group_bytes: int = GROUP_BYTES, sort_bytes: int = SORT_BYTES
) -> DataFrame:
    """id, n_bytes, the removed spans (bytes from, to) and the kept bytes of every row.

    A byte goes if it lies in a passage of ``WIDTH`` bytes that also begins in
    a row with a smaller id; passages are judged in the input, and none
    reaches across documents. A missing text counts as empty and shorter texts
    are left alone. A missing id counts as the smallest. Rows that share an id
    are not compared with each other. Ids are whole numbers. Other columns are
    not read. An empty table gives an empty one.

    The shuffle that deals documents into groups is used three times. An
    anchor that many documents share reaches its bucket as one segment per
    group, whatever the number of copies. Sorting is exact; whole segments
    count as equal if their 64-bit hashes, their anchors and lengths agree.
    """
    flat = docs.select(
        F.col(id_column).alias("_id"),
        F.coalesce(F.col(id_column).cast("bigint"), F.lit(-(2**63)).cast("bigint")).alias("_order"),
        F.col(text).alias("_text"),
    ).withColumn("_mark", F.xxhash64("_order", "_text"))
    total = flat.agg(F.sum(F.octet_length("_text")).alias("n")).first()["n"] or 0
    buckets = max(1, -(-total // group_bytes))
    grouped = flat.withColumn("bucket", F.pmod("_mark", F.lit(buckets))).groupBy("bucket")
    announced = grouped.applyInArrow(
        _announce(buckets), "anchor_bucket bigint, bucket bigint, anchors binary, several binary"
    )
    answers = announced.groupBy("anchor_bucket").applyInArrow(_answer, "bucket bigint, anchor_bucket bigint, shared binary")
    binaries = ", ".join(f"{c} binary" for c in [*_SEGMENT, "body", *[f"known_{c}" for c in _SPAN]])
    segments = grouped.cogroup(answers.groupBy("bucket")).applyInArrow(
        _send(buckets), f"anchor_bucket bigint, bucket bigint, {binaries}"
    )
    spans = segments.groupBy("anchor_bucket").applyInArrow(
        _find(sort_bytes), "bucket bigint, " + ", ".join(f"{c} binary" for c in _SPAN)
    )
    kind = flat.schema["_id"].dataType.simpleString()
    out = grouped.cogroup(spans.groupBy("bucket")).applyInArrow(
        _cut, f"_id {kind}, n_bytes bigint, spans array<struct<from:bigint,to:bigint>>, kept binary"
    )
    return out.withColumnRenamed("_id", id_column)


def digests(cut: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The numbers of removed bytes and spans, and a checksum of what is left."""
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["to"] - s["from"])
    return cut.select(
        id_column, "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
