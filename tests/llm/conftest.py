import pytest

SF = "/root/testdata/sf0.001"
#: Columns whose names clash with those that the operators make.
EXTRA = "doc_id long, text string, lang string, source string, n_chars long, pos int, hash long, bucket int, seg int, count long, rid string, item long, score string"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows and clashing columns."""
    long = "the quick brown fox jumps over the lazy dog " * 4000
    texts = [None, "", "  \n\t ", "x", "é" * 300, long, "Straße ÄÖ 日本 a@b.co 1.2.3.4", "same words here " * 60, "same words here " * 60, None]
    ids = [1, 2, 3, 4, 5, 6, 7, 8, 8, None]
    return spark.createDataFrame(
        [(i, t, "en" if i and i % 2 else None, None, 0, 1, 2, 3, 4, 5, "r", 6, "s") for i, t in zip(ids, texts)], EXTRA
    )


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
