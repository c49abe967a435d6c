"""Token ids of a tokenizer that drops white space, by its distinct words.

Such a tokenizer gives the ids of the words of a text one after another, so a
batch of texts is cut into words, every distinct word is encoded once and the
ids are put together by position. Words go to the tokenizers library, except
plain ones (Latin letters, then perhaps marks), whose merges tiktoken runs at
several times the speed; it is used only if the file has the form for which
both give the same ids.
"""

from __future__ import annotations

import json
import re
import sys
import types
from collections.abc import Callable
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tablewright.llm.packing import byte_letters

MOST_WORDS = 150_000  # distinct words whose ids are remembered by a worker process

# Letters whose lower case is one letter and which are composed already, and
# marks that neither begin a contraction nor a special token.
_PLAIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+[!#-&(-/:;=?@*|_~^`+-]*")
_PIECE = re.compile(r"[a-zß-öø-ÿ]+|[^a-zß-öø-ÿ]+")
_WORD_END = b"\xff"  # a byte that no UTF-8 text holds

# Fixed value: the split of the word-level file for which the plain way is right.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def drops_white_space(spec: dict) -> bool:
    """Whether the file cuts at white space and forgets it, so that words may be encoded apart."""
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
    cut = steps[0] if steps else {}
    return cut.get("type") == "Split" and cut.get("invert") is True and cut.get("pattern", {}).get("Regex") == SPLIT


def _plain_merges(spec: dict) -> tuple[Callable[[bytes], list[int]], list[int]] | None:
    """Ranks of a piece by tiktoken and the id of each rank, or None where the file's merges are not in the order of its ids."""
    model, letters = spec["model"], byte_letters()
    vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    in_order = sorted(vocab, key=vocab.get)
    single = len(in_order) - len(merges)
    if not suffix or [a + b for a, b in merges] != in_order[single:]:
        return None
    import tiktoken

    ranks: dict[bytes, int] = {bytes([b]): b for b in range(256)}
    ids = [0] * 256
    for token in in_order:
        end = token.endswith(suffix)
        raw = bytes(letters[c] for c in (token[: -len(suffix)] if end else token)) + _WORD_END * end
        if ranks.setdefault(raw, len(ranks)) == len(ids):
            ids.append(0)
        ids[ranks[raw]] = vocab[token]
    encode = tiktoken.Encoding("words", pat_str=".", mergeable_ranks=ranks, special_tokens={})._core_bpe
    return encode.encode_single_piece, ids


def word_encoder(path: str) -> tuple[Callable[[str], list[int]], np.ndarray]:
    """Numbers of a word's tokens, and the id that each number stands for, which are those of the tokenizers library."""
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    library = Tokenizer.from_file(path)
    merges = _plain_merges(spec) if drops_white_space(spec) else None
    if merges is None:
        size = 1 + max(library.get_vocab(with_added_tokens=True).values())
        return lambda word: library.encode(word, add_special_tokens=False).ids, np.arange(size, dtype=np.uint32)
    plain, ids = merges
    base = len(ids)  # the library's own ids follow the numbers of the merges
    size = 1 + max(library.get_vocab(with_added_tokens=True).values())

    def one(word: str) -> list[int]:
        if word.isascii() and word.isalpha():
            return plain(word.lower().encode() + _WORD_END)
        if _PLAIN.fullmatch(word):
            return [i for p in _PIECE.findall(word.lower()) for i in plain(p.encode() + _WORD_END)]
        return [base + i for i in library.encode(word, add_special_tokens=False).ids]

    return one, np.array([*ids, *range(size)], np.uint32)


def _kept(path: str) -> dict:
    """What this worker process remembers of a tokenizer: its encoder and the words it has met.

    Functions of this library travel with their tasks and lose their globals
    with them, so it is kept by a module of the process.
    """
    store = sys.modules.setdefault("_tablewright_words", types.ModuleType("_tablewright_words")).__dict__
    if path not in store:
        one, ids = word_encoder(path)
        store[path] = {"one": one, "ids": ids, "known": {}}
    return store[path]


def text_encoder(path: str) -> Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]:
    """Ids of a column of texts, one text after another, and the number of ids of each; a missing text is empty."""
    with open(path, encoding="utf-8") as f:
        by_words = drops_white_space(json.load(f))
    if not by_words:
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)

        def whole(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
            found = [np.array(library.encode(t or "", add_special_tokens=False).ids, np.uint32) for t in texts.to_pylist()]
            return np.concatenate([np.zeros(0, np.uint32), *found]), np.array([len(x) for x in found], np.int64)

        return whole

    kept = _kept(path)
    one, number_ids, known = kept["one"], kept["ids"], kept["known"]

    def packed(words: list[str]) -> dict[str, bytes]:
        """The numbers of each word as bytes, a fifth of what a list takes."""
        numbers = [one(w) for w in words]
        raw = np.fromiter(chain.from_iterable(numbers), np.uint32).tobytes()
        ends = list(accumulate(4 * len(x) for x in numbers))
        return {w: raw[a:b] for w, a, b in zip(words, [0, *ends], ends)}

    def run(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        words = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
        per_text = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = words.flatten().dictionary_encode()
        del words
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        fresh = packed([w for w in distinct if w not in known])
        if len(known) + len(fresh) <= MOST_WORDS:
            known.update(fresh)
            found = list(map(known.__getitem__, distinct))
        else:
            found = [fresh[w] if (x := known.get(w)) is None else x for w in distinct]
            if 5 * len(fresh) > 4 * len(distinct):  # the texts have changed: most words are others than those remembered
                known.clear()
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat = number_ids[np.frombuffer(b"".join(found), np.uint32)]
        first = np.cumsum(size) - size
        at = coded.indices.to_numpy(zero_copy_only=False)
        del coded, distinct, found, fresh
        sizes = size[at]
        ends = np.cumsum(sizes)
        ids = np.empty(int(ends[-1]) if len(ends) else 0, np.uint32)
        for lo in range(0, len(at), 1 << 18):  # bounded index arrays, however long the texts are
            part = slice(lo, lo + (1 << 18))
            base = int(ends[lo] - sizes[lo])
            total = int(ends[min(lo + (1 << 18), len(at)) - 1]) - base
            shift = np.repeat(first[at[part]] - (ends[part] - sizes[part] - base), sizes[part])
            ids[base : base + total] = flat[shift + np.arange(total)]
        bounds = np.concatenate([[0], np.cumsum(per_text)])
        totals = np.concatenate([[0], ends])[bounds]
        return ids, np.diff(totals)

    return run
