from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def tokenizer():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    from tallywright.llm.scratch import ship

    ship(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark, documents):
    """Null ids and texts, empty and blank ones, repeated rows, a long text, and columns with clashing names."""
    long = " ".join(f"word{i % 5000} thing{i}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "one two"), (6, "One  TWO"), (None, "one two"), (None, None), (7, long), (8, long + " end"), (9, "a b c d e f g h"), (9, "a b c d e f g h"), (10, "ÀÉ ß 中文 😀 end")]
    names = "key int, unit int, n int, a int, b int, block int, row int, part int, digest string, ids string, id int, rep int"
    return spark.createDataFrame([(d, t, "en", "s", len(t or ""), *range(8), "x", "y", 1, 2) for d, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, " + names)


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.where("false")
