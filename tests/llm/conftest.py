from __future__ import annotations

import re

import pytest

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text: str) -> str:
    """A-Z to lower case and nothing else."""
    return text.translate({c: c + 32 for c in range(65, 91)})


def words(text: str | None) -> list[str]:
    return WORD.findall(lower(text or ""))


@pytest.fixture(scope="session")
def small(spark):
    """The documents of sf0.001 as (doc_id, text) and their DataFrame."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return df, sorted((r.doc_id, r.text or "") for r in df.collect())


@pytest.fixture(scope="session")
def odd(spark):
    """Null ids and texts, empty, blank and very long texts, ties, repeated rows and columns whose
    names the operators use themselves."""
    long = " ".join(f"word{n % 977} and" for n in range(60_000))
    texts = [
        (1, "alpha beta gamma delta epsilon zeta"), (1, "alpha beta gamma delta epsilon zeta"), (1, "another text under the same id"),
        (2, None), (3, ""), (4, " \n\t "), (5, long), (6, "x" * 300_000), (7, "All RIGHTS   reserved. cc by CC-BY"),
        (None, "a document without an id"), (None, None), (8, "日本語のテキスト 😀 é"), (9, "alpha beta gamma delta epsilon zeta"),
    ]
    rows = [(i, t, "en", "src", len(t or ""), k, "kept", 1.5, "x") for k, (i, t) in enumerate(texts)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, _key int, _value string, _ratio double, fp string"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_documents(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def odd_labels(spark):
    rows = [(1, 1, 0), (1, 1, 1), (2, 0, 0), (3, None, None), (None, 1, 1), (99, 0, 1), (5, 1, 0)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")
