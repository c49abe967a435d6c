"""Exact duplicates by recipes of content-defined chunks.

Each text is cut where a rolling hash of its last bytes has a given form, so
equal passages are cut alike wherever they stand. A document becomes a recipe,
the ordered list of its chunks. Chunk bytes travel once, and only once per
task for repeated ones; they are grouped by their hash and compared byte by
byte, which gives each distinct chunk an identifier: its hash and its rank
among the different chunks with that hash. Documents are then compared by
their lists of identifiers, never by their texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.base import keep_rows
from tablewright.llm.textbytes import INVERSE, Texts, batches_of, powers
from tablewright.sources.workspace import stage

WINDOW = 48  # bytes that decide a cut
LEAST, MOST = 512, 16_384  # bytes of a chunk
CUT_BITS = 11  # one position of 2 ** 11 is a cut


def chunk_ends(texts: Texts, prefix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the chunks of all texts, and the number of chunks of each text."""
    n = len(texts.data)
    wanted = np.zeros(0, np.int64)
    if n >= WINDOW:
        rolling = (prefix[WINDOW:] - prefix[:-WINDOW]) * powers(INVERSE, n - WINDOW + 1)
        wanted = np.flatnonzero(rolling >> np.uint64(64 - CUT_BITS) == 0) + WINDOW
    ends: list[int] = []
    counts = np.zeros(len(texts), np.int64)
    spans = np.searchsorted(wanted, texts.offsets).tolist()
    offsets = texts.offsets.tolist()
    for i in range(len(texts)):
        start, stop, had = offsets[i], offsets[i + 1], len(ends)
        first = start + WINDOW  # a window must not reach into the text before
        for cut in wanted[spans[i] : spans[i + 1]].tolist():
            if cut < first:
                continue
            while cut - start > MOST:
                start += MOST
                ends.append(start)
            if cut - start >= LEAST and cut < stop:
                ends.append(cut)
                start = cut
        while stop - start > MOST:
            start += MOST
            ends.append(start)
        if stop > start:
            ends.append(stop)
        counts[i] = len(ends) - had
    return np.array(ends, np.int64), counts


def _digest(chunk: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(chunk, digest_size=8).digest(), "big", signed=True)


def _cut(texts: Texts) -> tuple[list[int], list[int], list[bytes]]:
    """First chunk of each text (and the end), and hash and bytes of every chunk."""
    prefix = texts.prefix()
    ends, counts = chunk_ends(texts, prefix)
    first = np.concatenate([[0], np.cumsum(counts)])
    starts = np.empty_like(ends)
    starts[1:] = ends[:-1]
    some = counts > 0
    starts[first[:-1][some]] = texts.offsets[:-1][some]
    hashes = texts.spans_hash(prefix, starts, ends).view(np.int64)
    raw = texts.data.tobytes()
    return first.tolist(), hashes.tolist(), [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())]


_ID = pa.struct([("h", pa.int64()), ("g", pa.int64())])


def _recipes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in batches_of(batches, "_text"):
        first, hashes, chunks = _cut(texts)
        ids = pa.StructArray.from_arrays(
            [pa.array(hashes, pa.int64()), pa.array([_digest(c) for c in chunks], pa.int64())], fields=list(_ID)
        )
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("_id"),
                pa.array([hashlib.sha256(texts.bytes_of(i)).hexdigest() for i in range(len(texts))], pa.string()),
                pa.ListArray.from_arrays(pa.array(first, pa.int32()), ids),
            ],
            names=["_id", "text_sha256", "recipe"],
        )


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every chunk the task has not sent before."""
    sent: set[tuple[int, int]] = set()
    for _, texts in batches_of(batches, "_text"):
        h, g, out = [], [], []
        for x, chunk in zip(*_cut(texts)[1:]):
            if (key := (x, _digest(chunk))) not in sent:
                sent.add(key)
                h.append(x)
                g.append(key[1])
                out.append(chunk)
        yield pa.RecordBatch.from_arrays(
            [pa.array(h, pa.int64()), pa.array(g, pa.int64()), pa.array(out, pa.binary())], names=["h", "g", "chunk"]
        )


def exact_groups(
    docs: DataFrame, id_column: str, text: str, normalise: Callable[[Column], Column] = lambda c: c
) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256, n_chunks.

    Texts are equal if they are identical after ``normalise``; a missing text
    counts as empty, and all empty texts are equal. Of equal texts the row
    with the largest id stays; a missing id is the smallest, and of rows that
    share the id one stays. Other columns are not read. An empty table gives
    an empty one.

    A chunk's identifier is a pair of independent 64-bit hashes. The bytes of
    all chunks are grouped by it and compared; should one identifier ever
    stand for different bytes, the documents that contain it are compared by
    their SHA-256 as well.
    """
    flat = docs.select(F.col(id_column).alias("_id"), normalise(F.col(text)).alias("_text"))
    kind = flat.schema["_id"].dataType.simpleString()
    recipes = flat.mapInArrow(
        _recipes, f"_id {kind}, text_sha256 string, recipe array<struct<h:bigint,g:bigint>>"
    ).withColumn("_row", F.monotonically_increasing_id())
    recipes = stage(recipes, "recipes")  # pins the row numbers
    # one shuffle serves both groupings: rows of one identifier are together
    chunks = flat.select("_text").mapInArrow(_chunks, "h bigint, g bigint, chunk binary").repartition("h", "g")
    different = chunks.groupBy("h", "g", "chunk").agg(F.lit(1).alias("_one"))
    unclear = different.groupBy("h", "g").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select("h", "g")
    suspects = (
        recipes.select("_row", F.explode("recipe").alias("_c")).select("_row", "_c.h", "_c.g")
        .join(unclear, ["h", "g"], "left_semi").select("_row").distinct().withColumn("_unclear", F.lit(True))
    )
    keyed = recipes.join(suspects, "_row", "left").select(
        "_id", "_row", "text_sha256", "recipe", F.when(F.col("_unclear"), F.col("text_sha256")).alias("_also")
    )
    groups = keyed.groupBy(F.col("recipe").alias("_recipe"), F.col("_also").alias("_group")).agg(
        F.count(F.lit(1)).alias("group_size"), F.max(F.struct("_id", "_row")).alias("_keep")
    )
    joined = keyed.join(groups, (F.col("recipe") == F.col("_recipe")) & F.col("_also").eqNullSafe(F.col("_group")))
    return joined.select(
        F.col("_id").alias(id_column),
        F.col("_keep._id").alias("keep_id"),
        "group_size",
        (F.col("_row") == F.col("_keep._row")).alias("kept"),
        "text_sha256",
        F.size("recipe").alias("n_chunks"),
    )


def without_copies(
    docs: DataFrame, id_column: str, text: str, normalise: Callable[[Column], Column] = lambda c: c
) -> DataFrame:
    """``docs`` with one row of each set of equal texts, the one with the largest id; all columns stay as they are."""
    groups = exact_groups(docs, id_column, text, normalise)
    mark = F.sha2(F.coalesce(normalise(F.col(text)), F.lit("")), 256)
    return keep_rows(docs, id_column, mark, groups.where("kept").select(id_column, "text_sha256"))


ORACLE = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
