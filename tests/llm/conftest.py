from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.001"
#: Extra columns whose names meet names that operators use themselves.
CLASHING = "doc_id bigint, text string, lang string, source string, n_chars bigint, n bigint, class bigint, " \
    "marks string, FOUND string, row_key int, Added string, size int, shard int, words string, features int, score double"


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from (doc_id, text[, lang[, source]]), with more columns of clashing names."""

    def make(*rows):
        width = len(CLASHING.split(","))
        data = [tuple(row) + (None,) * (width - len(row)) for row in rows]
        return spark.createDataFrame(data, CLASHING)

    return make


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="session")
def edge(docs):
    """Nulls, empty and very long texts, repeated rows and ids, texts without letters or words."""
    long = " ".join(f"word{i % 977} tok" for i in range(60_000))
    return docs(
        (1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n", "de", None), (4, "12 34 !!", None, "b"),
        (None, "some text without an id at all here", "en", "b"), (5, long, "en", "c"), (6, "x" * 200_000, "en", "c"),
        (7, "equal text in two rows with some words", "en", "a"), (7, "equal text in two rows with some words", "en", "a"),
        (8, "Équal ﬁ 日本語 text ß\x00\x1c  end", "fr", "d"), (9, "1" * 50_000, "en", "d"), (10, "+1 " + "9 " * 30_000, "en", "d"),
    )


@pytest.fixture(scope="session")
def none(docs):
    return docs()


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns or df.columns) for r in df.collect()), key=repr)
