import itertools
import random

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postline.llm import pieces
from postline.llm.queries import MODEL_FILE
from tests.llm.conftest import SF


@pytest.fixture(scope="module")
def both():
    with open(MODEL_FILE, "rb") as file:
        return pieces.compiled(file.read()), sentencepiece.SentencePieceProcessor(model_file=MODEL_FILE)


ODD = ["", " ", "  a  b ", "a\tb\r\nc", "héllo ﬁ Ⅷ", "\xa0x", "<s>hi</s>", "<0x0A>", "\x00a", "日本𠮷", " " * 40 + "x", "aaaaaaaaaaaaaaaaaaaaaaaa", "▁x a▁b"]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts_are_encoded_as_by_the_library(both, text):
    ours, library = both
    ids = list(ours.encode(text))
    assert ids == library.encode(text)
    assert ours.decode(ids) == library.decode(ids) == text.replace("▁", " ")


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(both, text):
    ours, library = both
    ids = list(ours.encode(text))
    assert ids == library.encode(text)
    assert ours.decode(ids) == text.replace("▁", " ")


def test_the_whole_table(spark, both):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    encoded = pieces.encode_documents(docs, MODEL_FILE, ["doc_id"])
    found = {r.doc_id: r for r in encoded.collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert found.keys() == texts.keys()
    for i, text in texts.items():
        assert found[i].ids == both[1].encode(text) and found[i].round_trip and found[i].n_tokens == len(found[i].ids)
    back = pieces.decode_documents(encoded, MODEL_FILE, ["doc_id"]).collect()
    assert {r.doc_id: r.text for r in back} == texts


def small(kind, names, scores, **flags):
    kinds = [pieces.UNKNOWN] + [pieces.NORMAL] * len(names)
    model = pieces.Model(["<unk>", *names], [0.0, *scores], kinds, kind == pieces.MERGES, flags.get("prefix", False), flags.get("squeeze", False))
    model.ids = {name: i + 1 for i, name in enumerate(names)}
    return pieces.Transducer(model)


def test_unigram_path_is_the_lightest_of_all():
    """Against every way to cut the text into pieces."""
    rng = random.Random(4)
    names = sorted({"".join(rng.choices("abc", k=k)) for k in (1, 1, 1, 2, 2, 2, 3, 3, 4) for _ in range(3)} - {"c"})
    scores = [-rng.uniform(1, 9) for _ in names]
    transducer = small(pieces.UNIGRAM, names, scores)
    weight = dict(zip(names, scores))
    for _ in range(200):
        text = "".join(rng.choices("abcd", k=rng.randint(1, 9)))
        best = float("inf")
        for cuts in itertools.product([0, 1], repeat=len(text) - 1):
            parts, at = [], 0
            for i, cut in enumerate([*cuts, 1], 1):
                if cut:
                    parts.append(text[at:i])
                    at = i
            if all(p in weight or len(p) == 1 for p in parts):
                best = min(best, sum(-weight[p] if p in weight else pieces.UNKNOWN_PENALTY - transducer.worst for p in parts))
        ids = transducer.encode(text)
        total = sum(pieces.UNKNOWN_PENALTY - transducer.worst if i == 0 else -scores[i - 1] for i in ids)
        assert total == pytest.approx(best)


def test_squeezed_spaces():
    transducer = small(pieces.UNIGRAM, ["▁", "a", "▁a"], [-3.0, -2.0, -1.0], prefix=True, squeeze=True)
    assert list(transducer.encode("  a   a ")) == [3, 3] and transducer.decode([3, 3]) == "a a" == transducer.plain("  a   a ")


def test_odd_rows(make):
    docs = make((1, None), (2, ""), (None, "a b"), (3, "x " * 200_000), (4, "y"), (4, "y")).withColumn("ids", F.lit("i"))
    found = pieces.encode_documents(docs, MODEL_FILE, ["doc_id"]).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in found) == [("1", 0), ("2", 0), ("3", 200_001), ("4", 1), ("4", 1), ("None", 2)]
    assert all(r.round_trip and len(r.ids) == r.n_tokens for r in found)
    assert pieces.encode_documents(docs.limit(0), MODEL_FILE, ["doc_id"]).count() == 0
