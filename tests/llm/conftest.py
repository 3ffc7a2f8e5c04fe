import pytest


@pytest.fixture(scope="session")
def docs(spark, check_dir):
    return spark.read.parquet(f"{check_dir}/documents.parquet")


ODD_TEXTS = [
    None, "", " \n\t ", "word", "ñ", "漢字 " * 40, "1234 5678", "a b c d", "same words again and again " * 30,
    "x" * 5000, "\x00\x1f control", "tie tie tie", "tie tie tie", "ends with space ", "  double  spaces  ",
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty, long and repeated texts, and columns whose names clash with those used inside."""
    rows = [(i, t, None, "s", len(t or ""), "k", "x") for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[3], (None, "no id at all", "en", None, None, None, None)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, key string, spans string"
    )


@pytest.fixture(scope="session")
def empty(spark, odd):
    return odd.where("doc_id < 0")
