import pytest

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang) rows."""

    def make(*rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1]) if r[1] is not None else None) for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(3)

    return make
