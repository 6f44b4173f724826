import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows, ties, and columns that clash with internal names."""
    rows = [(1, "The quick brown fox jumps over the lazy dog near the river bank today", "a", "x"),
            (1, "The quick brown fox jumps over the lazy dog near the river bank today", "a", "x"),
            (2, "THE quick brown fox jumps over the lazy dog near the river bank today", "a", "y"),
            (3, None, None, None), (4, "", "b", "z"), (5, " \n\t ", "b", "z"), (6, "two words", None, "q"), (7, "two words", "c", "q"),
            (None, "some text without an id but with enough words to pass the base rules", "c", "w"),
            (8, "naïve café 日本語 " * 3000, "c", "w"), (9, "a" * 30000, "d", None)]
    data = [(i, t, s, k, k, 0, 0.5, [1], k, 1, True) for i, t, s, k in rows]
    return spark.createDataFrame(data, "doc_id long, text string, source string, id string, uid string, n int, score double, words array<int>, host string, h int, kept boolean")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
