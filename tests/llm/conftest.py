"""Small document tables with the awkward cases every operator must take."""

from __future__ import annotations

import pytest

from mercato.llm.tables import small_batches

DOCS = "doc_id long, text string, lang string, source string, n_chars int"


def frame(spark, rows, schema=DOCS):
    small_batches(spark)
    return spark.createDataFrame(rows, schema)


def documents(spark, texts):
    """(id, text) pairs as a documents table."""
    return frame(spark, [(i, t, "en", "s", len(t or "")) for i, t in texts])


@pytest.fixture(scope="session")
def awkward(spark):
    """Null and empty texts, no words, a null key, a repeated row, a long text, non-ASCII text."""
    long_ = " ".join(f"w{i * 7919 % 3001}" for i in range(30_000))
    return documents(
        spark,
        [
            (1, None),
            (2, ""),
            (3, " \t\n "),
            (4, "one"),
            (4, "one"),
            (5, "one"),
            (None, "no key but some words in it"),
            (6, long_),
            (7, "Été ÇA va? naïve — 中文 🎉 ▁x"),
            (8, "1234 5678 !!"),
        ],
    )


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def by_id(df, key="doc_id"):
    out = {}
    for r in df.collect():
        out.setdefault(r[key], []).append(r)
    return out
