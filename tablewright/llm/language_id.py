"""Language identification by bit-sliced Bloom filters of n-grams.

One table of bit masks stands for a Bloom filter per language: slot i holds a
bit for every language that set bit i in its filter. Looking an n-gram up is
the AND of a few slots, and the mask that comes out names at once all the
languages that contain it. A document's bits are counted per language, the
hits expected by chance (the language's filter answers yes to an unknown
n-gram with a known rate) are taken off, and the largest share decides.

A filter holds the n-grams that are common in its language: counted by
document over all training rows, kept where they occur in at least a given
share of the language's documents. So the filters stay as small as the
languages' common stock, however large the corpus is.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.textbytes import mixed
from tablewright.sources.workspace import local_table

SIZES = (3, 4)  # characters of an n-gram
HASHES = 3
BITS_PER_GRAM = 16
MOST_GRAMS = 50_000  # per language; the commonest are kept
MIN_SHARE = 0.02  # of a language's documents
FEW_DOCUMENTS = 10  # of a language; with fewer, an n-gram of one of them is kept
PART = 1 << 18  # characters worked on at once
UNKNOWN = "und"

_LETTER = np.array([chr(c).isalpha() for c in range(0x10000)])


def letters_of(text: str) -> np.ndarray:
    """The text's lower-case letters as numbers, with one 0 for each run of anything else, and around the text."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = np.ones(len(points), bool)
    low = points < 0x10000
    letter[low] = _LETTER[points[low]]
    if (high := np.flatnonzero(~low)).size:
        letter[high] = [chr(c).isalpha() for c in points[high].tolist()]
    if not letter.any():
        return np.zeros(0, np.uint32)
    out = np.where(letter, points, np.uint32(0))
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first of a run of others
    body = out[keep]  # begins with a letter
    return np.concatenate([[0], body, [0] if body[-1] else []]).astype(np.uint32)


def grams(letters: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` numbers that hold two letters next to each other or more."""
    if len(letters) < n:
        return np.zeros(0, np.uint64)
    wide = letters.astype(np.uint64)
    m = len(wide) - n + 1
    h = np.full(m, n, np.uint64)
    for i in range(n):
        h = h * np.uint64(0x100000001B3) + wide[i : i + m]
    return mixed(h)


def parts_of(texts: Iterable[str | None], limit: int = PART) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """Letters of some texts behind each other, where each begins (and the end), first and last text.

    Texts are kept apart by n-1 zeros at least, since each is surrounded by one.
    """
    held: list[np.ndarray] = []
    size = first = 0
    i = -1
    for i, text in enumerate(texts):
        held.append(letters_of(text or ""))
        size += len(held[-1])
        if size >= limit:
            yield _joined(held, first, i + 1)
            held, size, first = [], 0, i + 1
    if held:
        yield _joined(held, first, i + 1)


def _joined(held, first, last):
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in held])]).astype(np.int64)
    return (np.concatenate(held) if held else np.zeros(0, np.uint32)), offsets, first, last


def _grams_of(letters: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """n-gram hashes of several texts, none across two of them, and where each text's begin (and the end)."""
    h = grams(letters, n)
    counts = np.maximum(np.diff(offsets) - (n - 1), 0)
    where = np.concatenate([[0], np.cumsum(counts)])
    at = np.arange(where[-1]) + np.repeat(offsets[:-1] - where[:-1], counts)
    return (h[at] if len(h) else np.zeros(0, np.uint64)), where


def _counted(languages: list[str]):
    """Documents of a task in which each n-gram occurs, per language."""
    index = {x: i for i, x in enumerate(languages)}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = np.array([index[x] for x in batch.column("_lang").to_pylist()], np.uint64)
            seen = []
            for letters, offsets, first, last in parts_of(x.as_py() for x in batch.column("_text")):
                for n in SIZES:
                    h, where = _grams_of(letters, offsets, n)
                    for i in range(last - first):  # once per document
                        seen.append((np.unique(h[where[i] : where[i + 1]]), lang[first + i]))
            if not seen:
                continue
            h = np.concatenate([x for x, _ in seen])
            of = np.repeat(np.array([x for _, x in seen], np.uint64), [len(x) for x, _ in seen])
            order = np.lexsort((of, h))
            h, of = h[order], of[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (of[1:] != of[:-1])
            at = np.flatnonzero(new)
            count = np.diff(np.append(at, len(h)))
            for a in range(0, len(at), 1 << 16):
                p = slice(a, a + (1 << 16))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[at[p]].view(np.int64)), pa.array(of[at[p]].astype(np.int32)), pa.array(count[p])],
                    names=["gram", "language", "n"],
                )

    return run


@dataclass(frozen=True)
class Filters:
    """The bit-sliced filters: ``masks[slot]`` has bit l where language l set its bit.

    Beyond 64 languages a slot is a row of words of 64 bits.
    """

    languages: list[str]
    masks: np.ndarray
    by_chance: list[float]

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """The languages that contain each n-gram, as bits."""
        out = self.masks[_slots(hashes, 0, len(self.masks))]
        for k in range(1, HASHES):
            out = out & self.masks[_slots(hashes, k, len(self.masks))]
        return out

    def holds(self, bits: np.ndarray, language: int) -> np.ndarray:
        """1 where ``bits``, as looked up, name the language, else 0."""
        if bits.ndim > 1:
            bits, language = bits[:, language // 64], language % 64
        return (bits >> bits.dtype.type(language)) & bits.dtype.type(1)


def _slots(hashes: np.ndarray, k: int, size: int) -> np.ndarray:
    """The k-th slot of each hash; ``size`` is a power of two."""
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    return ((hashes + np.uint64(k) * step) & np.uint64(size - 1)).astype(np.int64)


def build(languages: list[str], grams_of: list[np.ndarray]) -> Filters:
    most = max([len(g) for g in grams_of], default=0)
    size = 1 << max(10, math.ceil(math.log2(BITS_PER_GRAM * max(most, 1))))
    words = -(-len(languages) // 64)
    kinds = (np.uint8, np.uint16, np.uint32, np.uint64)
    kind = next((t for t in kinds if len(languages) <= 8 * t().itemsize), np.uint64)
    masks, chance = np.zeros((size, words) if words > 1 else size, kind), []
    for i, g in enumerate(grams_of):
        slots = np.unique(np.concatenate([_slots(g, k, size) for k in range(HASHES)])) if len(g) else np.zeros(0, np.int64)
        if words > 1:
            masks[slots, i // 64] |= kind(1 << (i % 64))
        else:
            masks[slots] |= kind(1 << i)
        chance.append((len(slots) / size) ** HASHES)
    return Filters(languages, masks, chance)


def train(docs: DataFrame, text: str, lang: str, rows: Column) -> Filters:
    """Filters from the rows of ``docs`` that ``rows`` selects and whose language is not missing.

    All their whole texts are counted. What comes to the driver are at most
    ``MOST_GRAMS`` n-grams for each language, as plain numbers.
    """
    chosen = docs.where(rows & F.col(lang).isNotNull()).select(F.col(text).alias("_text"), F.col(lang).alias("_lang"))
    sizes = {r["_lang"]: r["n"] for r in chosen.groupBy("_lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    counted = chosen.mapInArrow(_counted(languages), "gram bigint, language int, n bigint")
    total = counted.groupBy("language", "gram").agg(F.sum("n").alias("n"))
    kept: list[np.ndarray] = []
    for i, x in enumerate(languages):
        kept.append(np.zeros(0, np.uint64))
    if languages:
        least = [(i, max(2.0 if sizes[x] >= FEW_DOCUMENTS else 1.0, MIN_SHARE * sizes[x])) for i, x in enumerate(languages)]
        least = local_table(docs.sparkSession, least, "language int, _least double")
        # bounded: one row per language
        common = total.join(F.broadcast(least), "language").where("n >= _least")
        # the commonest of each language; ties by the hash
        top = F.slice(F.sort_array(F.collect_list(F.struct("n", "gram")), asc=False), 1, MOST_GRAMS)
        found = common.groupBy("language").agg(F.transform(top, lambda g: g["gram"]).alias("top")).toArrow()
        for i, grams_of in zip(found.column("language").to_pylist(), found.column("top")):
            kept[i] = np.asarray(grams_of.values, np.int64).view(np.uint64)
    return build(languages, kept)


def decide(filters: Filters, texts: Iterable[str | None], default: int = 0) -> Iterator[tuple[list[str], np.ndarray]]:
    """Language and score of every text, in runs of them."""
    chance = np.array(filters.by_chance)
    for letters, offsets, first, last in parts_of(texts):
        hits = np.zeros((last - first, len(filters.languages)))
        looked_up = np.zeros(last - first)
        for n in SIZES:
            h, where = _grams_of(letters, offsets, n)
            bits = filters.lookup(h)
            looked_up += np.diff(where)
            total = np.zeros(len(bits) + 1, np.int64)
            for i in range(len(filters.languages)):
                np.cumsum(filters.holds(bits, i), out=total[1:])
                hits[:, i] += total[where[1:]] - total[where[:-1]]
        real = np.maximum(hits - looked_up[:, None] * chance, 0) / np.maximum(1 - chance, 1e-9)
        whole = real.sum(axis=1)
        best = np.where(whole > 0, real.argmax(axis=1), default)
        score = np.divide(real.max(axis=1), whole, out=np.zeros(len(whole)), where=whole > 0)
        some = looked_up > 0
        yield [filters.languages[b] if s else UNKNOWN for b, s in zip(best.tolist(), some)], np.where(some, score, 0.0)


def _predicted(filters: Filters):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not filters.languages:
                names, scores = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            else:
                found = list(decide(filters, (x.as_py() for x in batch.column("_text"))))
                names = [x for part, _ in found for x in part]
                scores = np.concatenate([s for _, s in found]) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(names, pa.string()), pa.array(scores)], names=["_id", "lang_pred", "score"]
            )

    return run


def predict(docs: DataFrame, id_column: str, text: str, filters: Filters) -> DataFrame:
    """id, lang_pred and score (0 to 1) of every row, from its whole text alone.

    The score is the best language's part of all corrected hits. A text that
    is missing or has no letter is ``und`` with score 0; a text none of whose
    n-grams is known gets the first language with score 0, as do all if no
    language was learned (then ``und``). Repeated rows and missing ids are
    passed on.
    """
    flat = docs.select(F.col(id_column).alias("_id"), F.col(text).alias("_text"))
    kind = flat.schema["_id"].dataType.simpleString()
    out = flat.mapInArrow(_predicted(filters), f"_id {kind}, lang_pred string, score double")
    return out.withColumnRenamed("_id", id_column)


def held_out(id_column: str = "doc_id") -> Column:
    """Rows kept from training: the checksum of the id, as text, leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, id_column: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Train on the rows that are not held out, and predict all: id, held_out, lang_pred, score."""
    filters = train(docs, text, lang, ~held_out(id_column))
    return predict(docs, id_column, text, filters).select(id_column, held_out(id_column).alias("held_out"), "lang_pred", "score")
