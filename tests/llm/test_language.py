import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from postline.llm import language

ALPHABETS = {"xx": "abcdeé", "yy": "ghijkñ", "zz": "mnopqü"}


def text_of(rng, lang, words):
    return " ".join("".join(rng.choices(ALPHABETS[lang], k=rng.randint(2, 8))) for _ in range(words))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    return [(i, text_of(rng, lang, rng.randint(20, 400)), lang) for i in range(240) for lang in [rng.choice(sorted(ALPHABETS))]]


@pytest.fixture(scope="module")
def network(rows):
    return language.train([(text, lang) for _, text, lang in rows[:150]])


def test_held_out_accuracy(spark, make, rows):
    docs = make(*rows)
    network = language.fit(docs)
    found = language.identify(docs.drop("lang", "source"), network, ["doc_id"]).withColumn("held_out", language.fold() == 0)
    got = {r.doc_id: r for r in found.collect()}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _, _ in rows)
    held = [(i, lang) for i, _, lang in rows if got[i].held_out]
    assert len(held) > 20
    assert sum(got[i].lang_pred == lang for i, lang in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_only_fold_and_label_decide_what_is_learned(make, rows):
    docs = make(*rows, (None, "no id", "xx"), (-5, "no label", None), (-6, None, "yy"))
    sample = language.training_sample(docs, most=30)
    known = {text: (i, lang) for i, text, lang in rows}
    assert 20 <= len(sample) <= 30 and sample == language.training_sample(docs.repartition(7), most=30)
    for piece, lang in sample:
        whole = next(t for t in known if piece in t)
        assert known[whole][1] == lang and zlib.crc32(str(known[whole][0]).encode()) % 5 != 0


def test_pairs_of_bytes_give_what_single_bytes_give(network):
    cut = np.random.default_rng(0).integers(0, 256, (20, language.WINDOW)).astype(np.uint8)
    judge = language.Judge(network)
    pooled = np.concatenate([a.max(axis=1) for a in language._answers(network.tables, cut)], axis=1)
    hidden = np.concatenate([np.maximum(pooled, 0), np.ones((20, 1))], axis=1)
    assert np.allclose(judge._window_scores(cut), language._softmax(hidden @ network.dense), atol=1e-4)


def test_whole_texts_count(network):
    """What is far behind the first windows decides as well, however texts are batched."""
    rng = random.Random(2)
    long = text_of(rng, "xx", 100) + " " + text_of(rng, "yy", 40_000)
    texts = [long, text_of(rng, "zz", 3), text_of(rng, "xx", 50)]
    judge = language.Judge(network)
    found, scores = judge(texts)
    assert found == ["yy", "zz", "xx"]
    alone = [judge([t]) for t in texts]
    assert [a[0][0] for a in alone] == found and np.allclose([a[1][0] for a in alone], scores, atol=1e-5)


def test_odd_rows(make, network):
    docs = make((1, None), (2, ""), (3, "12 .. 34"), (None, "gh ij"), (4, "g"), (4, "g")).withColumn("score", F.lit("x"))
    found = language.identify(docs, network, ["doc_id"]).collect()
    assert sorted((str(r.doc_id), r.lang_pred) for r in found) == [
        ("1", "und"), ("2", "und"), ("3", "und"), ("4", "yy"), ("4", "yy"), ("None", "yy")
    ]
    assert all(r.score == 0 for r in found if r.lang_pred == "und")
    nothing = make((1, "abc", None))
    assert language.fit(nothing) is None
    assert [tuple(r) for r in language.identify(nothing, None, ["doc_id"]).collect()] == [(1, "und", 0.0)]
    assert language.identify(docs.limit(0), network, ["doc_id"]).count() == 0
