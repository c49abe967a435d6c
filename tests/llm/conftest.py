import random

import pytest

from tablewright.llm.base import documents, prepare

SF = "/root/testdata/sf0.001"

# Columns beside those of documents, named like columns that operators add.
CLASHING = [
    "kept", "text_sha256", "position", "slot", "shard", "n_shingles", "component_id", "score", "spans", "matches", "key",
    "bucket", "node", "block", "weight", "row_number", "label", "_order", "_mark", "_text", "_id",
]
SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(
    f"{c} string" for c in CLASHING
))


def words(seed, n, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


def messy_rows():
    long = words(1, 60_000)
    texts = [
        (1, words(2, 120)), (2, words(2, 120)), (3, words(2, 119) + " changed"), (4, None), (5, None), (6, ""), (7, " \n\t "),
        (8, long), (9, long + " more"), (10, "one"), (11, "one two"), (12, "Größe 東京 🎉 été"), (13, words(3, 90)),
        (13, words(3, 90)), (13, words(4, 90)), (None, words(2, 120)), (None, words(5, 60)), (14, "x" * 5000), (15, "y " * 3000),
        (16, words(2, 60) + "\n" + words(2, 60) + "\n" + words(2, 60)), (17, words(6, 200) + " " + words(2, 120)),
    ]
    out = []
    for i, (doc_id, text) in enumerate(texts):
        lang = [None, "en", "de", ""][i % 4]
        source = [None, "a", "a", "a", "b", ""][i % 6]
        n_chars = None if i % 5 == 0 else len(text or "")
        out.append((doc_id, text, lang, source, n_chars, *["z"] * len(CLASHING)))
    return out


@pytest.fixture(scope="session")
def messy(spark):
    prepare(spark)
    return spark.createDataFrame(messy_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    prepare(spark)
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    prepare(spark)
    return documents(spark, SF)


@pytest.fixture(scope="session")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
