import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from postline.llm import queries, spelling
from tests.llm.conftest import SF


def brute_words(rows, least=5, times=3, drop=97):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % drop == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {word: n for word, n in counts.items() if len(word) >= least and n >= times}


def edits(word, letters):
    """All that one edit makes of the word."""
    cuts = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    return {a + b[1:] for a, b in cuts if b} | {a + c + b for a, b in cuts for c in letters} | {
        a + c + b[1:] for a, b in cuts if b for c in letters
    } - {word}


def brute_variants(words, ratio=2):
    letters = sorted({c for word in words for c in word})
    near = {word: [other for other in edits(word, letters) - {word} if other in words] for word in words}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[word] = best if best is not None and words[best] >= ratio * words[word] else None
    rows = []
    for word in words:
        root = word
        while form[root] is not None:
            root = form[root]
        rows.append((word, form[word], root, words[word], len(near[word]), words.get(form[word])))
    return sorted(rows)


def rows_of(found):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in found.collect())


@pytest.mark.parametrize("inserted", [False, True])
def test_near_pairs_against_all_pairs(inserted):
    rng = np.random.default_rng(5)
    own = np.unique(rng.integers(97, 100, (700, 7), dtype=np.uint8), axis=0)
    asking = np.unique(rng.integers(97, 101, (500, 6 if inserted else 7), dtype=np.uint8), axis=0)
    found = spelling.near_pairs(own, asking, inserted)
    letters = "abcd"
    places = {row.tobytes().decode(): i for i, row in enumerate(own)}
    want = {
        (q, places[other])
        for q, row in enumerate(asking)
        for other in edits(row.tobytes().decode(), letters)
        if other in places and other != row.tobytes().decode()
    }
    assert len(want) > 100 and len(found[0]) == len(want) and set(zip(*(side.tolist() for side in found))) == want


@pytest.mark.parametrize("leaf", [1, 16, 1000])
def test_every_word_in_reach_is_in_a_leaf_that_is_reached(leaf):
    rng = np.random.default_rng(leaf)
    counts = rng.integers(0, 3, (300, 256)).astype(np.int32)
    nodes = spelling.grow(counts, leaf)
    root = nodes[0]
    own = spelling.own_leaves(root, counts)
    leaves = {n.number: n.words for n in nodes if n.left is None}
    assert all((own[rows] == number).all() for number, rows in leaves.items())
    assert sorted(np.concatenate(list(leaves.values())).tolist()) == list(range(300))
    letter = rng.integers(0, 256, (300, 2))
    for down in (False, True):
        moved = counts.copy()
        moved[np.arange(300), letter[:, 0]] += 1
        if down:
            moved[np.arange(300), letter[:, 1]] -= 1
        reached = {(node.number, int(q)) for node, rows in spelling.leaves_in_reach(root, counts, down) for q in rows}
        assert {(int(a), q) for q, a in enumerate(spelling.own_leaves(root, moved))} <= reached
        assert len(reached) == sum(len(rows) for _, rows in spelling.leaves_in_reach(root, counts, down))


def test_words_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = spelling.word_counts(docs).collect()
    assert len(found) == len({r.word for r in found})
    assert {r.word: r.n for r in found} == brute_words([(r.doc_id, r.text) for r in docs.collect()])


def test_the_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    words = brute_words([(r.doc_id, r.text) for r in docs.collect()])
    want = brute_variants(words)
    assert sum(row[1] is not None for row in want) > 20
    assert rows_of(queries.op12_spelling_variants(spark, SF)) == want


def made_words(rng, n):
    """Words with many near ones: hubs, anagrams, chains of forms, accents."""
    words = {}
    for _ in range(n):
        word = "".join(rng.choices("abé", k=rng.randint(5, 8)))
        words[word] = rng.choice([3, 6, 12, 12, 50, 100])
    return words | {"a" * k: 2**k for k in range(5, 40)}


@pytest.mark.parametrize(("sample", "box", "chunk"), [(1 << 16, 8192, 1 << 14), (200, 40, 1 << 14), (1 << 16, 20, 7)])
def test_variants_against_all_edits(spark, monkeypatch, sample, box, chunk):
    """The same however the words are cut into boxes and chunks."""
    monkeypatch.setattr(spelling, "CHUNK", chunk)
    words = made_words(random.Random(box), 600)
    frame = spark.createDataFrame(list(words.items()), "word string, n bigint").repartition(3)
    assert rows_of(spelling.variants(frame, 2, sample, box)) == brute_variants(words)


def test_roots_of_long_chains(spark):
    chain = [(f"w{i:03}", f"w{i + 1:03}") for i in range(100)]
    found = {r.word: r.root for r in spelling.roots(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert found == {word: "w100" for word, _ in chain}


def test_odd_rows(spark, make, monkeypatch):
    long = "x" * 40 + " " + "Wörter " * 300 + "y" * 500 + "×÷ÿ" * 2
    rows = [(1, None), (2, ""), (None, "Straße STRASSE straße"), (None, "Straße STRASSE straße"), (3, long), (3, long), (4, long + "Āwörter İ K wôrter wôrter wôrter")]
    docs = make(*rows).withColumn("word", F.lit("w")).withColumn("n", F.lit(1)).withColumn("box", F.lit(1))
    words = brute_words(rows)
    assert {"y" * 500 + "×÷ÿ" * 2, "wörter", "strasse"} >= {w for w in words if w in ("strasse",) or len(w) > 400}
    found = spelling.variants(spelling.word_counts(docs))
    assert rows_of(found) == brute_variants(words)
    # Texts that are cut into stretches give the same words.
    monkeypatch.setattr(spelling, "STRETCH", 50)
    counts = {}
    for doc_id, text in rows:
        spelling.count_words(doc_id, text or "", 97, counts)
    assert {w.decode("latin-1"): n for w, n in counts.items() if len(w) >= 5 and n >= 3} == words
    assert spelling.variants(spelling.word_counts(docs.limit(0))).count() == 0
    assert spelling.variants(spelling.word_counts(docs.limit(1))).columns == ["word", "form", "root", "n", "n_near", "form_n"]
