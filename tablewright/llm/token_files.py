"""Corpora as files of token ids from which any token can be read by itself.

Documents are encoded, dealt into ranges of their ids and written in rising
order; a range is one or several files of directly addressable codes (see
``token_codes``). Files are written and read by Spark's own writer and reader,
so a lost or repeated task leaves no half file behind and any file system
serves. The folder of a file names its place in the order and its number of
tokens, so listing the folder is enough to know where every token lies.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewright.llm.base import batches_below
from tablewright.llm.textbytes import slices
from tablewright.llm.token_codes import Codes, encode
from tablewright.llm.word_ids import text_encoder
from tablewright.operators.ranges import parts_for

END = 1
FILE_TOKENS = 4_000_000  # a file ends with the document that reaches so many
ROWS_PER_RANGE, BYTES_PER_RANGE = 500_000, 64 << 20
OUT_ROWS = 2048  # documents in a batch that leaves a task
OUT_BYTES = 8 << 20
SLICE_BYTES = 2 << 20  # of texts encoded at once


def _number_type(tokenizer: str, end: int) -> str:
    """The smallest type that holds all ids of a file."""
    from tokenizers import Tokenizer

    largest = max(end, *Tokenizer.from_file(tokenizer).get_vocab(with_added_tokens=True).values())
    return "<u2" if largest < 1 << 16 else "<u4"


def _encoder(path: str, end: int, bounds: np.ndarray, kind: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts = text_encoder(path)
        tail = np.array([end], kind).tobytes()
        for batch in batches:
            for texts in slices(batch.column("_text"), SLICE_BYTES):
                rows = batch.slice(texts.first, len(texts))
                ids, lengths = encode_texts(rows.column("_text"))
                ids, to = ids.astype(kind), np.cumsum(lengths).tolist()
                number = rows.column("_id")
                values = number.fill_null(0).to_numpy(zero_copy_only=False)
                part = np.where(number.is_null().to_numpy(zero_copy_only=False), 0, np.searchsorted(bounds, values, "right"))
                tokens = [ids[a:b].tobytes() + tail for a, b in zip([0, *to], to)]
                yield pa.RecordBatch.from_arrays(
                    [number, rows.column("_tie"), pa.array(part, pa.int32()), pa.array(tokens, pa.binary())],
                    names=["_id", "_tie", "part", "tokens"],
                )

    return run


def _writer(file_tokens: int, kind: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held = None, 0, 0
        names: list[int | None] = []
        tokens: list[np.ndarray] = []

        def file() -> pa.RecordBatch:
            data = encode(names, [len(t) for t in tokens], np.concatenate(tokens))
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([seq], pa.int64()), pa.array([held], pa.int64()), pa.array([data], pa.binary())],
                names=["part", "seq", "tokens", "data"],
            )

        for batch in batches:
            for p, doc_id, data in zip(
                batch.column("part").to_pylist(), batch.column("_id").to_pylist(), batch.column("tokens")
            ):
                if held and (p != part or held >= file_tokens):
                    yield file()
                    seq, held, names, tokens = (seq + 1 if p == part else 0), 0, [], []
                part = p
                names.append(doc_id)
                tokens.append(np.frombuffer(data.as_buffer(), kind).copy())
                held += len(tokens[-1])
        if held:
            yield file()

    return run


def _bounds(ids: DataFrame, parts: int) -> np.ndarray:
    """Ids at which the ranges begin, one for each range but the first."""
    if parts == 1:
        return np.zeros(0, np.int64)
    ranged = ids.where(F.col("_id").isNotNull()).repartitionByRange(parts, "_id")
    first = ranged.groupBy(F.spark_partition_id().alias("p")).agg(F.min("_id").alias("first"))
    return np.sort(np.array([r["first"] for r in first.collect()], np.int64))[1:]


def write_tokens(
    docs: DataFrame, id_column: str, text: str, tokenizer: str, path: str, end: int = END, file_tokens: int = FILE_TOKENS,
) -> None:
    """Write the token ids of all documents below ``path``, in rising order of the documents.

    The ids are those of the tokenizers library for the whole text without
    special tokens added, with ``end`` behind them; a missing or empty text is
    that id alone. A missing document id comes first, rows that share an id
    are written each, in an order that follows from their texts, other columns
    are not read, and an empty table leaves one file without documents. What
    the driver holds is one id per range of documents.
    """
    spark = docs.sparkSession
    flat = docs.select(
        F.col(id_column).cast("bigint").alias("_id"), F.xxhash64(text).alias("_tie"), F.col(text).alias("_text")
    )
    size = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(text)).alias("b")).first()
    parts = max(parts_for(docs, size["n"], ROWS_PER_RANGE), -(-(size["b"] or 0) // BYTES_PER_RANGE))
    bounds = _bounds(flat.select("_id"), parts)
    kind = _number_type(tokenizer, end)
    encoded = flat.mapInArrow(_encoder(tokenizer, end, bounds, kind), "_id bigint, _tie bigint, part int, tokens binary")
    ranged = encoded.repartitionById(len(bounds) + 1, F.col("part")).sortWithinPartitions(
        "part", F.col("_id").asc_nulls_first(), "_tie"
    )
    files = ranged.select("part", "_id", "tokens").mapInArrow(
        _writer(file_tokens, kind), "part bigint, seq bigint, tokens bigint, data binary"
    )
    # closes the corpus: its folder is never empty
    last = spark.createDataFrame([(len(bounds) + 1, 0, 0, bytearray(encode([], [], np.zeros(0, np.uint32))))], files.schema)
    # one row is one file; the line break the text writer adds lies behind the codes
    rows = files.unionByName(last).select("part", "seq", "tokens", F.col("data").cast("string").alias("value"))
    with batches_below(spark, SLICE_BYTES):  # texts are worked on in slices of that size, larger batches only take memory
        rows.write.partitionBy("part", "seq", "tokens").text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    found = spark.read.format("binaryFile").option("basePath", path).load(path)
    return found.withColumns({c: F.col(c).cast("bigint") for c in ("part", "seq", "tokens")})


def directory(spark: SparkSession, path: str) -> DataFrame:
    """part, seq, tokens and the number of tokens in all files before, one row per file; no file is opened."""
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    files = _files(spark, path).select("part", "seq", "tokens")
    return files.withColumn("first_token", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def _reader(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data, first in zip(batch.column("content"), batch.column("first_token").to_pylist()):
            codes = Codes(data.as_buffer())
            names, starts, k = codes.doc_ids, codes.starts, 0
            while k < codes.n_docs:
                to = int(np.searchsorted(starts, starts[k] + OUT_BYTES // 4, "right")) - 1
                to = min(max(to, k + 1), k + OUT_ROWS, codes.n_docs)
                low, at = int(starts[k]), starts[k : to + 1] - starts[k]
                ids = codes.span(low, int(starts[to])).astype("<u4")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names[k:to], pa.int64()),
                        pa.array(first + starts[k:to], pa.int64()),
                        pa.array(np.diff(at), pa.int64()),
                        pa.array([ids[a:b].tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist())], pa.binary()),
                    ],
                    names=["_id", "start", "n_tokens", "ids"],
                )
                k = to


def read_tokens(spark: SparkSession, path: str, id_column: str = "doc_id") -> DataFrame:
    """Every document of the files: its id, the place of its first token, their number and the ids (32-bit, little-endian)."""
    # one row per file of millions of tokens
    placed = _files(spark, path).join(F.broadcast(directory(spark, path).drop("tokens")), ["part", "seq"])
    out = placed.select("content", "first_token").mapInArrow(
        _reader, "_id bigint, start bigint, n_tokens bigint, ids binary"
    )
    return out.withColumnRenamed("_id", id_column)


def _taker(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data, first, wanted in zip(
            batch.column("content"), batch.column("first_token").to_pylist(), batch.column("wanted")
        ):
            at = np.sort(wanted.values.to_numpy(zero_copy_only=False).astype(np.int64))
            for k in range(0, len(at), 1 << 16):
                part = at[k : k + (1 << 16)]
                ids = Codes(data.as_buffer()).take(part - first)
                yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(ids.astype(np.int64))], names=["place", "token"])


def tokens_at(spark: SparkSession, path: str, places: DataFrame) -> DataFrame:
    """The token at each distinct place of the corpus named in column ``place``; places outside it are left out.

    A place meets its file by the files' first tokens (one number per file,
    which the driver holds); a file is handed as many places as it has tokens
    at most, and only their chunks are decoded.
    """
    rows = directory(spark, path).where("tokens > 0").orderBy("first_token").collect()
    first = np.array([r["first_token"] for r in rows], np.int64)
    total = rows[-1]["first_token"] + rows[-1]["tokens"] if rows else 0

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("place")
            k = np.searchsorted(first, at.to_numpy(zero_copy_only=False), "right") - 1
            yield pa.RecordBatch.from_arrays([at, pa.array(first[k])], names=["place", "first_token"])

    inside = places.select(F.col("place").cast("bigint").alias("place")).where(F.col("place").between(0, total - 1)).distinct()
    by_file = inside.mapInArrow(find, "place bigint, first_token bigint").groupBy("first_token").agg(
        F.collect_list("place").alias("wanted")
    )
    where = F.broadcast(directory(spark, path).where("tokens > 0").drop("tokens"))
    files = _files(spark, path).join(where, ["part", "seq"]).join(by_file, "first_token")
    return files.select("content", "first_token", "wanted").mapInArrow(_taker, "place bigint, token bigint")
