import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, sid string, row string, copies string"


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, source), with extra columns whose names operators use inside."""
    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1]), "x", "y", "z") for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make
