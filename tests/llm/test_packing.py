import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tablewright.llm.packing import cost, encoder, pack, packed, piece_digests, token_ids

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def slow():
    return Tokenizer.from_file(PATH)


def check(rows, texts, slow):
    """Pieces give every text's ids once, sequences are gapless and full but for one per group."""
    of_doc, of_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        of_doc[r["doc_id"]].append(r)
        of_sequence[r["sequence_id"]].append(r)
    for doc_id, text in texts.items():
        ids, at = np.array([*slow.encode(text or "", add_special_tokens=False).ids, 0], "<u4"), 0
        for r in sorted(of_doc[doc_id], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for pieces in of_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= 1024
    return len(of_sequence)


def test_whole_table(docs, texts, slow):
    rows = piece_digests(packed(docs, "doc_id", "text", PATH)).collect()
    sequences = check(rows, texts, slow)
    assert sequences * 1024 - sum(r["length"] for r in rows) < 1024 * docs.rdd.getNumPartitions()


def test_messy_documents(messy, empty, slow):
    plain = messy.dropDuplicates(["doc_id"]).where("doc_id IS NOT NULL")
    check(piece_digests(packed(plain, "doc_id", "text", PATH, group_docs=4)).collect(),
          {r["doc_id"]: r["text"] for r in plain.collect()}, slow)
    rows = packed(messy, "doc_id", "text", PATH).collect()
    want = sum(len(slow.encode(r["text"] or "").ids) + 1 for r in messy.collect())
    assert sum(r["length"] for r in rows) == want
    assert packed(empty, "doc_id", "text", PATH).count() == 0


@pytest.mark.parametrize("text", ["", " ", "a", "it's  x\n\n y <|endoftext|> z", "Größe 東京 🎉", "  lead " * 5000, "ab " * 500_000])
def test_ids_are_the_library_s(slow, text):
    assert token_ids(encoder(PATH), text).tolist() == [*slow.encode(text, add_special_tokens=False).ids, 0]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 300), min_size=1, max_size=60))
def test_packs_any_lengths(lengths):
    pieces = pack(np.array(lengths), 64)
    assert sum(p[2] for p in pieces) == sum(lengths)
    used = defaultdict(int)
    for doc, start, n, sequence, offset in sorted(pieces, key=lambda p: (p[3], p[4])):
        assert used[sequence] == offset
        used[sequence] += n
    assert max(used.values()) <= 64 and len(used) == sum(x // 64 for x in lengths) + -(-sum(x % 64 for x in lengths) // 64)


def test_costs_are_balanced():
    lengths = np.random.default_rng(3).integers(20, 600, 400)
    spent = defaultdict(float)
    for _, _, n, sequence, _ in pack(lengths):
        spent[sequence] += cost(n)
    in_order, have, at = [0.0], 0, 0
    for n in lengths:  # the same documents laid out one after the other
        if have + n > 1024:
            in_order.append(0.0)
            have = 0
        in_order[-1] += cost(n)
        have += n
    assert np.std(list(spent.values())) < 0.5 * np.std(in_order)


def test_special_tokens_in_texts_are_the_library_s(slow):
    encode = encoder(PATH)
    for text in ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>x", "<|endoftext", "x" * 50 + "<|endoftext|>\n"]:
        assert token_ids(encode, text).tolist() == [*slow.encode(text, add_special_tokens=False).ids, 0]


def test_the_packer_travels_by_value():
    from pyspark import cloudpickle

    from tablewright.llm.packing import _packer

    assert b"tablewright.llm.packing\x94\x8c\x07encoder" not in cloudpickle.dumps(_packer(PATH, 1024, 100, 10, False))
