import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from postline.llm import language, pieces, secret_scan
from postline.llm.queries import MODEL_FILE
from tests.llm.conftest import SF
from tests.llm.test_decontaminate import brute
from tests.llm.test_near_dedup import brute_kept


@pytest.fixture(scope="module")
def stages(spark):
    """The rows before the first stage and after each."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    after = [docs.collect()]
    for _, function in corpus_pipeline.STAGES:
        made = function(spark, docs, SF)
        after.append(made.collect())
        assert made.columns == docs.columns or function is corpus_pipeline.STAGES[-1][1]
        docs = spark.createDataFrame(after[-1], made.schema)
    return after


def texts(rows):
    return {r.doc_id: r.text for r in rows}


def test_languages(spark, stages):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    network = language.fit(docs)
    judge, least = language.Judge(network), corpus_pipeline.least_score(len(network.languages))
    found, scores = judge([r.text for r in stages[0]])
    kept = {r.doc_id for r, lang, s in zip(stages[0], found, scores) if lang != "und" and s >= least}
    assert {r.doc_id for r in stages[1]} == kept and len(kept) >= 0.98 * len(stages[0])


def test_least_score_is_above_a_guess():
    scores = [corpus_pipeline.least_score(n) for n in range(1, 50)]
    assert scores == sorted(scores, reverse=True) and scores[0] == 1
    assert all(1 / n < score < 1 for n, score in list(enumerate(scores, 1))[1:])


def test_near_copies(stages):
    assert sorted(texts(stages[2])) == brute_kept(sorted(texts(stages[1]).items()))


def test_leaks(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {i for i, text in texts(stages[2]).items() if not brute(text, items)}
    assert set(texts(stages[3])) == clean < set(texts(stages[2]))


def test_secrets(stages):
    before, after = texts(stages[3]), texts(stages[4])
    assert before.keys() == after.keys()
    for i, text in before.items():
        if secret_scan.base_spans(text):
            assert secret_scan.MASK in after[i] and not secret_scan.base_spans(after[i])
    assert sum(before[i] == after[i] for i in before) > 0.7 * len(before)


def test_tokens(stages):
    with open(MODEL_FILE, "rb") as file:
        transducer = pieces.compiled(file.read())
    text = texts(stages[4])
    assert {r.doc_id: r.ids for r in stages[5]} == {i: list(transducer.encode(t)) for i, t in text.items()}


def test_run_is_its_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r.doc_id, r.ids) for r in got) == sorted((r.doc_id, r.ids) for r in stages[-1])


def test_odd_rows(spark, make):
    docs = make((1, None), (2, ""), (3, "12"), (None, "the words of a text"), (4, "the words of a text"), (4, "the words of a text"), (5, "of the other and one token = abcdefghijklmnop"))
    docs = docs.withColumn("score", F.lit(1)).withColumn("matches", F.lit("m"))
    for _, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, SF)
    assert sorted(r.doc_id for r in docs.collect()) == [4, 5]


@pytest.mark.parametrize("rows", [[(1, "clean words", None), (2, "12", None), (3, None, None)], [(None, "clean words", "xx"), (None, "", "xx")]])
def test_documents_stay_where_no_language_can_be_learned(spark, make, rows):
    kept = corpus_pipeline.keep_known_languages(spark, make(*rows), SF).collect()
    assert [(r.doc_id, r.text, r.lang) for r in kept] == rows[:1]


def test_registered():
    names = [f"op{n}_" for n in range(1, 14)]
    found = [k for k in __spark_entry__.queries() if k.startswith("op")]
    assert len(found) == 13 and all(any(k.startswith(n) for k in found) for n in names)
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
