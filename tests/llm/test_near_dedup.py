import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from postline.llm import bitslice, near_dedup
from postline.llm.components import components
from tests.llm.conftest import SF


@pytest.mark.parametrize(("words", "radius"), [(1, 4), (1, 0), (2, 38), (2, 127)])
def test_close_pairs_against_all_pairs(words, radius):
    rng = np.random.default_rng(words)
    base = rng.integers(0, 2**63, (20, words)).astype(np.uint64)
    prints = base[rng.integers(0, 20, 400)] ^ (np.uint64(1) << rng.integers(0, 64, (400, words)).astype(np.uint64))
    group = np.sort(rng.integers(0, 30, 400))
    group = np.cumsum(np.r_[0, (group[1:] != group[:-1]).astype(int)])
    first, second = bitslice.close_pairs(prints, group, radius)
    want = {
        (i, j)
        for i in range(400)
        for j in range(i + 1, 400)
        if group[i] == group[j] and np.bitwise_count(prints[i] ^ prints[j]).sum() <= radius
    }
    assert set(zip(first.tolist(), second.tolist())) == want and len(first) == len(want)


def test_stars():
    assert bitslice.stars(6, np.array([4, 1, 0]), np.array([5, 4, 2])).tolist() == [0, 1, 0, 3, 1, 1]


def roots(ids, pairs):
    root = {i: i for i in ids}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


def test_components_of_chains_stars_and_repeats(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(130, 129), (129, 130), (7, 7), (200, 200)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    real = [link for link in links if link[0] != link[1]]
    want = roots({x for link in real for x in link}, real)
    assert found == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def print_of(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute_classes(rows):
    prints = [print_of(text) for _, text in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    top = roots(range(len(rows)), pairs)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[top[i]] = min(least.get(top[i], doc_id), doc_id)
    return sorted((str(d), f"{prints[i]:016x}", str(least.get(top[i]))) for i, (d, _) in enumerate(rows))


def test_classes_against_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = near_dedup.fingerprint_classes(docs).collect()
    want = brute_classes([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in found) == want


def test_classes_of_odd_rows(spark, make):
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "a b c d e"), (4, "A B c D e"), (4, "A B c D e"), (None, "lone words here now"), (5, "x"), (6, "é " * 3000)]
    docs = make(*rows).withColumn("print", F.lit("p")).withColumn("component_id", F.lit(0)).withColumn("key", F.lit(1))
    found = near_dedup.fingerprint_classes(docs).collect()
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in found) == brute_classes(rows)
    assert near_dedup.fingerprint_classes(docs.limit(0)).count() == 0


def test_more_blocks_give_the_same(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert len(near_dedup._masks(4, 100)) == 5 and len(near_dedup._masks(4, 10**7)) == 15
    before = sorted(near_dedup.fingerprint_classes(docs).collect())
    monkeypatch.setattr(near_dedup, "CROWD", 1e-9)
    assert len(near_dedup._masks(4, 100)) > 15
    assert sorted(near_dedup.fingerprint_classes(docs).collect()) == before


def brute_kept(rows):
    """Ids of the first document of each class of texts, linked at four bits or fewer."""
    prints = [print_of(text) for _, text in rows]
    top = roots(range(len(rows)), [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4])
    best = {}
    for i, (doc_id, _) in enumerate(rows):
        best[top[i]] = min(best.get(top[i], doc_id), doc_id)
    return sorted(best.values())


@pytest.fixture(scope="module")
def copies():
    """Texts with near copies of many distances, and a passage that many others share."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    rows, passage = [], [word() for _ in range(60)]
    for base in range(6):
        text = [word() for _ in range(rng.randint(200, 900))]
        for _ in range(25):
            changed = list(text)
            for _ in range(rng.randint(0, 12)):
                changed[rng.randrange(len(changed))] = word()
            rows.append((len(rows), " ".join(changed)))
    for _ in range(80):
        text = [word() for _ in range(80)]
        rows.append((len(rows), " ".join(text[:40] + passage + text[40:])))
    return rows


def test_dedup_against_all_pairs(make, copies, monkeypatch):
    want = brute_kept(copies)
    assert 80 < len(want) < len(copies)
    assert sorted(r.doc_id for r in near_dedup.keep_first(make(*copies)).collect()) == want
    # The same with chunks of a few rows, that is with many meetings of one key.
    monkeypatch.setattr(near_dedup, "CHUNK", 8)
    assert sorted(r.doc_id for r in near_dedup.keep_first(make(*copies)).collect()) == want


def test_dedup_of_odd_rows(make):
    text = "one two three four five six seven"
    docs = make((3, text), (2, text.upper() + " "), (2, text.upper() + " "), (None, text), (4, None), (4, None), (5, ""), (6, "other"), (None, "only null id"))
    kept = near_dedup.keep_first(docs.withColumn("print", F.lit(1)).withColumn("_raw", F.lit("h")).withColumn("_key", F.lit(2))).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in kept) == sorted(
        [("2", text.upper() + " "), ("4", "None"), ("6", "other"), ("None", "only null id")]
    )
    assert all(r.print == 1 and r._raw == "h" and r._key == 2 for r in kept)
    assert near_dedup.keep_first(docs.limit(0)).count() == 0
