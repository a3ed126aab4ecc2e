import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """Rows with nulls, empty and long texts, repeats and a clashing column."""
    def make(rows):
        return spark.createDataFrame(
            [(i, t, "en", s, len(t or ""), 1) for i, t, s in rows],
            "doc_id long, text string, lang string, source string, n_chars long, _row int")
    return make
