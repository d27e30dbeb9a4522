import pytest

#: NULLs, empty and white texts, repeated rows, a repeated id with another text, a long text, a clashing column.
LONG = "Some words that go on, and on. " * 3000


@pytest.fixture(scope="session")
def odd(spark):
    rows = [
        (1, "", "en", "src1", 0), (2, None, None, None, None), (None, "A text without an id stands here for all.", "en", "src1", 5),
        (3, " \t\n ", "en", "src2", 4), (4, "one word", "en", "src2", 8), (4, "one word", "en", "src2", 8), (4, "Another text for id four", "en", "src2", 8),
        (5, LONG, "en", "src3", len(LONG)), (6, LONG, "en", "src3", len(LONG)), (7, "<|endoftext|> é İ 日本   ½ x\x00y 'll", "de", "src3", 9),
    ]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    return spark.createDataFrame([(*r, "own", 1) for r in rows], schema + ", fp string, _fingerprint int")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def documents(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark, small):
    return spark.read.parquet(f"{small}/labels.parquet")
