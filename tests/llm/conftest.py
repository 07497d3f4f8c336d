from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source), with columns whose names clash with results."""

    def make(rows, extra: bool = False):
        full = [(r[0], r[1], *(r[2:] or ("en", "s")), None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        if extra:
            for name in ("kept", "size", "copies", "label", "n_words", "class_id", "row", "shard", "block", "t"):
                df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return make
