"""Small tables with the awkward rows that every operator has to take."""

from __future__ import annotations

import pytest

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def _sentence(start: int, count: int) -> str:
    return " ".join(f"w{start}x{place}" for place in range(count))


def awkward_documents() -> list[tuple]:
    base = _sentence(1, 60)
    words = base.split()
    near = " ".join([*words[:30], "changed", *words[31:]])
    texts = [
        (1, base, "en", "a"),
        (2, base, "en", "b"),
        (3, near, "en", None),
        (4, _sentence(2, 40), None, "b"),
        (5, None, "en", "a"),
        (6, "", "de", "c"),
        (7, " \n\t ", "de", "c"),
        (8, "one two", None, None),
        (9, "Ünï çödé 😀 " * 30, "fr", "é"),
        (10, _sentence(3, 30_000), "en", "a"),
        (None, _sentence(4, 25), "en", "b"),
        (None, None, None, None),
        (12, _sentence(5, 50), "en", "b"),
        (12, _sentence(5, 50), "en", "b"),
    ]
    return [(*row, len(row[1]) if row[1] is not None else None) for row in texts]


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty and long texts, copies, near copies, repeated rows and ids,
    and extra columns with names that operators might use themselves."""
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(awkward_documents(), DOCUMENTS)
    extra = ("size", "key", "tile", "taken", "_size", "_range", "_score", "symbols", "rep", "kept")
    return docs.select("*", *(F.lit("x").alias(name) for name in extra))


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)
