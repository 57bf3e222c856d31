from __future__ import annotations

import pytest

DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


@pytest.fixture
def documents(spark):
    """Documents from (id, text) pairs or longer tuples."""

    def build(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(3)

    return build


@pytest.fixture
def odd(documents):
    """Nulls, empty and very long texts, ties, repeated rows."""
    long = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
    return documents([(1, None), (2, ""), (3, " \n\t "), (4, "a"), (4, "a"), (None, "a b c"), (None, None), (5, long), (6, long), (7, "é ü 中 文"), (8, "x\ny\nx\ny")])
