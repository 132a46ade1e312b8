import pytest


@pytest.fixture(scope="session")
def corpus(spark):
    """Builds a documents table from (doc_id, text[, lang]) rows, with a column that clashes with internal names."""

    def build(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", None if r[1] is None else len(r[1]), "x") for r in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, score string")

    return build
