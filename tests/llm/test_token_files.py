import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tablewright.llm.token_codes import Codes, best_widths, encode
from tablewright.llm.token_files import directory, read_tokens, tokens_at, write_tokens
from tablewright.llm.word_ids import _kept, text_encoder
from tablewright.sources.workspace import new_dir

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 40) | st.integers(0, 50_000), max_size=1500), st.randoms())
def test_codes_give_every_token_back(ids, rnd):
    ids = np.array(ids, np.uint32)
    widths = rnd.choice([None, [32], [8, 8, 8, 8], [1, 3, 28], [13, 19]])
    codes = Codes(encode([5], [len(ids)], ids, widths) + b"\n")
    assert codes.span(0, len(ids)).tolist() == ids.tolist() and codes.document(0).tolist() == ids.tolist()
    a = rnd.randint(0, len(ids))
    b = rnd.randint(a, len(ids))
    assert codes.span(a, b).tolist() == ids[a:b].tolist()
    if len(ids):
        at = [rnd.randrange(len(ids)) for _ in range(50)]
        assert codes.take(at).tolist() == ids[at].tolist() and codes.token(at[0]) == ids[at[0]]


def test_widths_are_the_cheapest():
    r = np.random.default_rng(3)
    ids = (2 ** r.uniform(0, 15.6, 4000)).astype(np.uint32)
    size = lambda widths: sum(
        (w + (k < len(widths) - 1)) * int((ids >> np.uint32(sum(widths[:k]))).astype(bool).sum() if k else len(ids))
        for k, w in enumerate(widths)
    )
    best = best_widths(ids)
    assert sum(best) == 16
    assert all(size(best) <= size([a, b, 16 - a - b]) for a in range(1, 14) for b in range(1, 16 - a))
    assert all(size(best) <= size([a, 16 - a]) for a in range(1, 16)) and size(best) <= size([16])
    with pytest.raises(ValueError):
        encode([1], [1], np.array([300], np.uint32), [8])


def test_files_refuse_other_data_and_places_outside():
    with pytest.raises(ValueError):
        Codes(b"x" * 100)
    with pytest.raises(ValueError):
        encode([1], [2], np.array([1], np.uint32))
    codes = Codes(encode([None, 2], [0, 3], np.array([1, 2, 3], np.uint32)))
    assert codes.doc_ids == [None, 2] and codes.document(0).tolist() == []
    for place in (-1, 3):
        with pytest.raises(IndexError):
            codes.token(place)


def awkward():
    r = random.Random(9)
    letters = "abcdefgstmdrelv'’ÀéßÿøŒœ.,!?#$%&*|<>=-_/\\1234567890 \t\n\r\v\f  ́İΣ東京🎉​"
    mixed = ["".join(r.choice(letters) for _ in range(r.randrange(60))) for _ in range(400)]
    words = ["It's", "we'LL", "<|endoftext|>", "a<|startoftext|>b", "<|endoftext", "Été", "ΣΑΣ", "İstanbul", "ẞ", "ª", "x" * 3000, "a­b"]
    return ["", " ", "\n", *words, *mixed, " ".join(words), "Straße, " * 500]


def test_ids_are_those_of_the_library(library):
    texts = awkward()
    ids, lengths = text_encoder(PATH)(pa.array([None, *texts]))
    assert lengths[0] == 0
    at = 0
    for text, n in zip(texts, lengths[1:]):
        assert ids[at : at + n].tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)
        at += n


def test_few_words_are_remembered(library):
    # a stream of ever new words beside some that come in every slice
    encode_texts, known = text_encoder(PATH), _kept(PATH)["known"]
    known.clear()
    usual = [f"usual{i:x}" for i in range(20_000)]
    for k in range(12):
        fresh = [f"new{k:x}z{i:x}" for i in range(30_000)]
        ids, lengths = encode_texts(pa.array([" ".join(usual), " ".join(fresh)]))
        assert len(known) <= 160_000
    assert ids[: lengths[0]].tolist() == library.encode(" ".join(usual), add_special_tokens=False).ids
    assert ids[lengths[0] :].tolist() == library.encode(" ".join(fresh), add_special_tokens=False).ids


def test_every_plain_token_is_its_own_word(library):
    # the merges of the file, run by tiktoken, give the library's ids for the words its vocabulary is made of
    vocabulary = sorted(t[:-4] for t in library.get_vocab() if t.endswith("</w>"))
    words = [w for w in vocabulary if w.isascii() and w.isalpha()]
    r = random.Random(4)
    words += [r.choice(words) + r.choice(words) for _ in range(20_000)]
    ids, lengths = text_encoder(PATH)(pa.array(words))
    want = [e.ids for e in library.encode_batch(words, add_special_tokens=False)]
    assert ids.tolist() == [i for x in want for i in x] and lengths.tolist() == [len(x) for x in want]


def test_a_tokenizer_that_keeps_white_space():
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = ["a  b", "", "x\n\n<|endoftext|> y", "1234 été"]
    ids, lengths = text_encoder(path)(pa.array(texts))
    library = Tokenizer.from_file(path)
    assert ids.tolist() == [i for t in texts for i in library.encode(t, add_special_tokens=False).ids]
    assert lengths.tolist() == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def expected(rows, library):
    """(doc_id, start, ids) of rows in rising order, equal ids in any order."""
    at, out = 0, []
    for r in rows:
        ids = np.array([*library.encode(r["text"] or "", add_special_tokens=False).ids, 1], "<u4")
        out.append((r["doc_id"], at, ids))
        at += len(ids)
    return out, at


def test_files_hold_the_corpus_in_order(spark, docs, library):
    path = new_dir(spark, "tokens")
    write_tokens(docs, "doc_id", "text", PATH, path, file_tokens=20_000)
    want, total = expected(docs.orderBy("doc_id").collect(), library)
    got = read_tokens(spark, path).withColumn("crc", F.crc32("ids")).orderBy("doc_id").collect()
    assert [(r["doc_id"], r["start"], r["n_tokens"], r["crc"]) for r in got] == [
        (d, s, len(ids), zlib.crc32(ids.tobytes())) for d, s, ids in want
    ]
    files = directory(spark, path).orderBy("first_token").collect()
    assert len(files) > 5 and files[-1]["first_token"] == total
    stream = np.concatenate([ids for *_, ids in want])
    r = random.Random(5)
    at = [r.randrange(total) for _ in range(300)] + [0, total - 1, total, -1]
    found = tokens_at(spark, path, spark.createDataFrame([(p,) for p in at], "place bigint")).collect()
    assert {x["place"]: x["token"] for x in found} == {p: int(stream[p]) for p in at if 0 <= p < total}


def test_missing_and_repeated_ids_and_texts(spark, messy, library):
    path = new_dir(spark, "tokens")
    write_tokens(messy, "doc_id", "text", PATH, path, file_tokens=1000)
    got = read_tokens(spark, path).orderBy("start").collect()
    rows = messy.collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r["doc_id"]) for r in rows)
    assert [r["doc_id"] for r in got] == sorted((r["doc_id"] for r in rows), key=lambda d: (d is not None, d or 0))
    want = sorted((str(d), ids.tobytes()) for d, _, ids in expected(rows, library)[0])
    assert sorted((str(r["doc_id"]), bytes(r["ids"])) for r in got) == want
    at = 0
    for r in got:
        assert r["start"] == at and r["n_tokens"] * 4 == len(r["ids"])
        at += r["n_tokens"]


def test_an_empty_table(spark, empty):
    path = new_dir(spark, "tokens")
    write_tokens(empty, "doc_id", "text", PATH, path)
    assert read_tokens(spark, path).collect() == []
    assert tokens_at(spark, path, spark.createDataFrame([(0,)], "place bigint")).collect() == []
