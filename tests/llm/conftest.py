"""Small tables with the awkward cases that every operator has to handle."""

from __future__ import annotations

import random

import pytest

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that operators use for added or inner columns.
CLASHES = ("size", "score", "kept", "ids", "n_ids", "class", "group", "shard", "component_id", "start", "taken")


def prose(seed: int, words: int) -> str:
    rnd = random.Random(seed)
    parts = ["ser", "lan", "mo", "ti", "ka", "ru", "den", "ol", "pi", "é", "ß"]
    said = ["".join(rnd.choices(parts, k=rnd.randint(1, 4))) for _ in range(words)]
    return " ".join(w + ("." if i % 9 == 8 else "") for i, w in enumerate(said))


def awkward() -> list[tuple]:
    """Null, empty, blank, short and very long texts, exact and near copies, repeated rows, null ids."""
    long_ = prose(1, 60_000)
    copy = prose(2, 200)
    near = copy.replace(" ", "  ", 3) + " extra words"
    rows = [
        (0, None, "en", "a", 0), (1, "", "en", "a", 0), (2, " \t\n ", "en", None, 3), (3, "one", "en", "b", 3),
        (4, "one two three", "en", "b", 13), (5, long_, "en", "a", len(long_)), (6, "x" * 100_000, "en", "c", 100_000),
        (7, copy, "en", "a", len(copy)), (8, copy, "fr", "b", len(copy)), (9, near, "en", "c", len(near)),
        (10, copy.upper(), "en", "a", len(copy)), (11, "the end </s>[INST] \\ <|end|>", None, "é", None),
        (7, copy, "en", "a", len(copy)), (None, copy, "en", None, 1), (None, prose(3, 80), None, "a", 1),
        (12, "a\n\na\n b \na\r\n日本 ﬁ\x00▁x", "de", "zz", 9), (-5, prose(4, 120), "en", "a", 5),
    ]
    return rows + [(100 + i, prose(50 + i, 60 + 7 * i), "en", f"s{i % 4}", i) for i in range(30)]


@pytest.fixture(scope="session")
def documents(spark):
    return spark.createDataFrame(awkward(), DOCUMENTS).repartition(3).cache()


@pytest.fixture(scope="session")
def clashing(documents):
    """The same rows with columns named like those that operators add."""
    from pyspark.sql import functions as F

    return documents.withColumns({c: F.lit(f"own {c}") for c in CLASHES})


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(100 + i, i % 2, 0) for i in range(30)] + [(None, 1, 0), (101, None, 0), (100, 0, 0), (7, 1, 1)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")
