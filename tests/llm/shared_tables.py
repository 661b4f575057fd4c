import pytest

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def table(spark):
    """A table of shared test data, as rows."""
    def read(name):
        return [r.asDict() for r in spark.read.parquet(f"{SF}/{name}.parquet").collect()]
    return read


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls in every column, empty and long texts, ties, repeated rows and an extra column with a clashing name."""
    long = "alpha beta gamma delta " * 20_000
    rows = [(1, "one two three four five six seven", "en", "a", 33), (1, "one two three four five six seven", "en", "a", 33), (2, None, None, None, None), (None, "x y", "en", None, 3),
            (3, "", "en", "b", 0), (4, "   \n\t ", None, "b", 6), (5, long, "en", "b", len(long)), (6, "One TWO three four five six SEVEN", "en", "a", 33), (None, None, None, None, None)]
    return spark.createDataFrame([(*r, "kept", 1.5) for r in rows], DOCS + ", length string, score double")
