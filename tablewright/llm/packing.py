"""Packing documents into token sequences of equal length and balanced cost.

The cost of a piece is linear in its tokens plus quadratic for attention
inside it. Full-length pieces of long documents are sequences of their own;
what remains of every document goes, the costliest first, to the lowest-cost
sequence that has room for it, and is cut only where no sequence has room for
the whole of it. Since there are just as many sequences as the tokens need,
less than one sequence per group is padding.

A group is a bounded run of a task's documents, so nothing is shuffled, memory
is bounded, a lost task is simply run again, and the order in which a corpus
was mixed is kept up to a group.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LENGTH = 1024
END = 0  # the id that ends a document
GROUP_TOKENS, GROUP_DOCS = 2_000_000, 4096
# Tokens at which attention costs as much as everything linear.
ATTENTION_AT = 4096
TEXT_PART = 1 << 20  # characters given to the tokenizer at once


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else the next from 256."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def encoder(path: str) -> Callable[[str], np.ndarray]:
    """Text to ids by a byte-level BPE file of the tokenizers library: the ids of the library, special tokens included.

    The file's vocabulary is run by tiktoken, which takes the order of merges
    from the ids, between the special tokens of a text. Where a file's merges
    are not in that order, or its special tokens take more than their own
    characters, the library the file was made for runs it, at a fraction of
    the speed.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, added = spec["model"], spec.get("added_tokens") or []
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    vocab, letters = model["vocab"], byte_letters()
    literal = not any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added)
    if literal and all(vocab.get(a + b) == 256 + i for i, (a, b) in enumerate(merges)):
        import tiktoken
        from public_tokenizers import PATTERN

        ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items() if i < 256 + len(merges)}
        plain = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_to_numpy
        special = {t["content"]: t["id"] for t in added}
        if not special:
            return plain
        # the longest first, so that none hides behind its beginning
        cut = re.compile("(" + "|".join(re.escape(t) for t in sorted(special, key=len, reverse=True)) + ")")

        def between(text: str) -> np.ndarray:
            parts = cut.split(text)
            if len(parts) == 1:
                return plain(text)
            found = [np.array([special[p]], np.uint32) if i % 2 else plain(p) for i, p in enumerate(parts)]
            return np.concatenate([np.asarray(x, np.uint32) for x in found])

        return between

    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    return lambda text: np.array(library.encode(text, add_special_tokens=False).ids, np.uint32)


# A single blank between a printing character and a letter always begins a
# token, so a text may be cut before it.
_SAFE = re.compile(r"(?<=\S) (?=[^\W\d_])")


def token_ids(encode: Callable[[str], np.ndarray], text: str) -> np.ndarray:
    """Ids of a text with the id that ends it; long texts are encoded in parts."""
    parts, at = [], 0
    while at < len(text):
        cut = _SAFE.search(text, at + TEXT_PART) if len(text) - at > TEXT_PART else None
        to = cut.start() if cut else len(text)
        parts.append(np.asarray(encode(text[at:to]), np.uint32))
        at = to
    return np.concatenate([*parts, np.array([END], np.uint32)])


def cost(tokens):
    return tokens + tokens * tokens / ATTENTION_AT


def pack(lengths: np.ndarray, length: int = LENGTH) -> list[tuple[int, int, int, int, int]]:
    """(document, start, tokens, sequence, offset) of every piece of a group."""
    pieces: list[tuple[int, int, int, int, int]] = []
    used = 0
    for d in np.flatnonzero(lengths >= length).tolist():
        for k in range(int(lengths[d]) // length):
            pieces.append((d, k * length, length, used, 0))
            used += 1
    rest = lengths % length
    room = np.full(-(-int(rest.sum()) // length), length, np.int64)
    spent = np.zeros(len(room))
    for d in np.argsort(-rest, kind="stable").tolist():
        left, start = int(rest[d]), int(lengths[d] - rest[d])
        while left:
            fits = room >= left
            if not fits.any():
                fits = room > 0
            s = int(np.where(fits, spent, np.inf).argmin())
            take = min(left, int(room[s]))
            pieces.append((d, start, take, used + s, length - int(room[s])))
            room[s] -= take
            spent[s] += cost(take)
            start, left = start + take, left - take
    return pieces


def in_order(pieces: list[tuple[int, int, int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """The pieces with the sequences numbered by the mean place of their tokens' documents in the group."""
    doc, _, tokens, seq, _ = (np.array(x, np.int64) for x in zip(*pieces))
    place = np.bincount(seq, weights=doc * tokens) / np.bincount(seq, weights=tokens)
    number = np.empty(len(place), np.int64)
    number[np.argsort(place, kind="stable")] = np.arange(len(place))
    return [(d, start, n, int(number[s]), offset) for d, start, n, s, offset in pieces]


def _packer(path: str, length: int, group_tokens: int, group_docs: int, ordered: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        sequence = TaskContext.get().partitionId() << 40
        names: list[pa.Array] = []
        ids: list[np.ndarray] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal names, ids, held, sequence
            if ids:
                lengths = np.array([len(x) for x in ids], np.int64)
                pieces = pack(lengths, length)
                if ordered:
                    pieces = in_order(pieces)
                doc, start, tokens, seq, offset = (np.array(x, np.int64) for x in zip(*pieces))
                per_doc = pa.concat_arrays(names)
                for at in range(0, len(pieces), 2048):  # bounded batches out
                    part = slice(at, at + 2048)
                    yield pa.RecordBatch.from_arrays(
                        [
                            per_doc.take(pa.array(doc[part])),
                            pa.array(start[part]),
                            pa.array(tokens[part]),
                            pa.array([ids[d][s : s + n].astype("<u4").tobytes() for d, s, n, *_ in pieces[part]], pa.binary()),
                            pa.array(lengths[doc[part]]),
                            pa.array(sequence + seq[part]),
                            pa.array(offset[part]),
                        ],
                        names=["_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
                    )
                sequence += int(seq.max()) + 1
            names, ids, held = [], [], 0

        for batch in batches:
            first = 0
            for i, text in enumerate(batch.column("_text")):
                ids.append(token_ids(encode, text.as_py() or ""))
                held += len(ids[-1])
                if held >= group_tokens or len(ids) >= group_docs:
                    names.append(batch.column("_id").slice(first, i + 1 - first))
                    first = i + 1
                    yield from flush()
            names.append(batch.column("_id").slice(first))
        yield from flush()

    return run


def packed(
    docs: DataFrame, id_column: str, text: str, tokenizer: str, length: int = LENGTH, group_tokens: int = GROUP_TOKENS,
    group_docs: int = GROUP_DOCS, ordered: bool = False,
) -> DataFrame:
    """The pieces of all documents: id, start, length, ids, doc_tokens, sequence_id, offset.

    ``ids`` are the token ids as little-endian 32-bit numbers. A document ends
    with id 0; an empty or missing text is that id alone. Every id lies in one
    piece, offsets in a sequence are gapless, a missing document id is passed
    on, and rows that share an id are packed each. Other columns are not read.
    An empty table gives an empty one. ``sequence_id`` depends on how the
    table is split into tasks. With ``ordered``, the rows come in an order
    across partitions and inside them, and sequences are numbered along it:
    groups follow each other, and the sequences of a group do by the mean
    place of their documents.
    """
    flat = docs.select(F.col(id_column).alias("_id"), F.col(text).alias("_text"))
    kind = flat.schema["_id"].dataType.simpleString()
    out = flat.mapInArrow(
        _packer(tokenizer, length, group_tokens, group_docs, ordered),
        f"_id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint",
    )
    return out.withColumnRenamed("_id", id_column)


def piece_digests(pieces: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The pieces with a checksum in place of the ids, and the estimated cost of each."""
    n = F.col("length")
    return pieces.select(
        id_column, "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
        (n + n * n / ATTENTION_AT).alias("cost"),
    )
