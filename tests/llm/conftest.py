from __future__ import annotations

import public_tokenizers
import pytest


@pytest.fixture(scope="session")
def word_bpe() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) pairs, with columns whose names operators use themselves."""

    def build(rows):
        return spark.createDataFrame([(i, t, "en", "s", 0, "x") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, label string")

    return build
