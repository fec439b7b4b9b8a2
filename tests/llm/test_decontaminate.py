import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from postline.llm import decontaminate
from tests.llm.conftest import SF


def bag(words, size):
    return Counter(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def brute(text, items, least=0.8):
    """The best similarity of any item-sized window, for the items that reach the least."""
    words, found = decontaminate.words_of(text), {}
    for item, passage in items:
        own = decontaminate.words_of(passage)
        if not own:
            continue
        size = min(5, len(own))
        mine = bag(own, size)
        if not mine.keys() & bag(words, size).keys():
            continue
        for start in range(max(1, len(words) - len(own) + 1)):
            window = bag(words[start : start + len(own)], size)
            both = sum((mine & window).values())
            total = sum(mine.values()) + sum(window.values()) - both
            if both and both / total >= least - 1e-9:
                found[item] = max(found.get(item, 0), both / total)
    return found


@pytest.fixture(scope="module")
def cases():
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(2, 8)))
    items = [(i, " ".join(word() for _ in range(rng.randint(1, 60)))) for i in range(60)] + [(99, "a a b a a b a a b a a")]
    texts = []
    for _ in range(300):
        item = rng.choice(items)[1].split()
        for _ in range(rng.choice([0, 1, 1, 2, 4])):
            i = rng.randrange(len(item))
            item[i : i + 1] = rng.choice([[word()], [], [item[i], word()]])
        around = [word() for _ in range(rng.randint(0, 60))]
        at = rng.randint(0, len(around))
        texts.append(" ".join([*around[:at], *item, *around[at:]]))
    return items, texts


def test_matches_against_all_windows(cases):
    items, texts = cases
    index = decontaminate.Index(tuple(items), decontaminate.RADIUS, 0.8)
    for text in texts:
        want = brute(text, items)
        got = {m["item_id"]: m["similarity"] for m in index.matches(text)}
        assert got == pytest.approx(want), text


def test_multi_index_misses_nothing_within_the_radius():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 2**63, 4000).astype(np.uint64)
    b = a.copy()
    for _ in range(24):
        b ^= np.uint64(1) << rng.integers(0, 64, 4000).astype(np.uint64)
    b[2000:] = rng.integers(0, 2**63, 2000).astype(np.uint64)
    for radius in (0, 6, 22):
        near, within = decontaminate.near_blocks(a, b, radius), np.bitwise_count(a ^ b) <= radius
        assert (near | ~within).all() and not near.all()


def test_meetings_are_all_windows_and_items_that_share_a_shingle(cases, monkeypatch):
    """In tiles of any size."""
    items, texts = cases
    index = decontaminate.Index(tuple(items), 22, 0.8)
    for tile in (1, 50, decontaminate.TILE):
        monkeypatch.setattr(decontaminate, "TILE", tile)
        for text in texts[:40]:
            hashes = decontaminate._word_hashes(decontaminate.words_of(text))
            for size in index.sizes:
                shingles = decontaminate._shingles(hashes, size.shingle)
                held = min(size.words - size.shingle + 1, len(shingles))
                if not len(shingles):
                    continue
                got = set()
                for at, who in size.meetings(shingles, np.arange(len(shingles)), held):
                    found = list(zip(*(x.tolist() for x in decontaminate._windows_of(at, who, held, len(shingles) - held))))
                    assert len(found) == len(set(found))
                    got |= set(found)
                want = {
                    (start, item)
                    for start in range(len(shingles) - held + 1)
                    for item, bag_of in enumerate(size.bags)
                    if set(shingles[start : start + held].tolist()) & set(bag_of.tolist())
                }
                assert got == want


def test_work_does_not_grow_with_items_that_a_text_does_not_share():
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    items = [(i, " ".join(word() for _ in range(50))) for i in range(30_000)]
    text = " ".join([word() for _ in range(3000)] + items[7][1].split() + [word() for _ in range(3000)] + items[2000][1].split())
    counts = []
    for n in (3_000, 30_000):
        index = decontaminate.Index(tuple(items[:n]), decontaminate.RADIUS, 0.8)
        shingles = decontaminate._shingles(decontaminate._word_hashes(decontaminate.words_of(text)), 5)
        shared = index._shared(shingles, 5)
        pairs = [len(decontaminate._windows_of(*m, 46, len(shingles) - 46)[0]) for m in index.sizes[0].meetings(shingles, shared, 46)]
        counts.append(sum(pairs))
        assert [m["item_id"] for m in index.matches(text)] == [7, 2000]
    assert counts[0] <= counts[1] <= 2 * counts[0]


def test_the_whole_table(spark):
    docs, benchmark = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    found = decontaminate.contaminated(docs, benchmark).collect()
    want = {(r.doc_id, i) for r in docs.collect() for i in brute(r.text, items)}
    assert {(r.doc_id, r.item_id) for r in found} == want and len(found) == len(want)
    kept = decontaminate.decontaminate(docs, benchmark)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - {d for d, _ in want}


def test_passes_give_the_same(spark, monkeypatch):
    docs, benchmark = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    before = sorted(decontaminate.contaminated(docs, benchmark).collect())
    monkeypatch.setattr(decontaminate, "PASS_CHARS", 3000)
    assert len(list(decontaminate._passes(benchmark))) > 1
    assert sorted(decontaminate.contaminated(docs, benchmark).collect()) == before


def test_odd_rows(spark, make):
    item = "alpha beta gamma delta epsilon zeta eta theta"
    benchmark = spark.createDataFrame([(1, item), (2, None), (3, ""), (None, item), (4, "one two"), (1, item)], "item_id bigint, text string")
    docs = make((1, None), (2, ""), (None, f"x {item} y"), (3, item.upper()), (3, item.upper()), (4, "of one two of"), (5, "alpha"), (6, f"{'w ' * 30000}{item}"))
    extra = docs.withColumn("matches", F.lit(1)).withColumn("item_id", F.lit(2)).withColumn("_before", F.lit(3))
    found = decontaminate.contaminated(extra, benchmark).collect()
    assert sorted((str(r.doc_id), r.item_id, r.start) for r in found) == [
        ("3", 1, 0), ("3", 1, 0), ("4", 4, 1), ("6", 1, 30000), ("None", 1, 1)
    ]
    kept = decontaminate.decontaminate(extra, benchmark).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["1", "2", "5"] and all(r.matches == 1 and r._before == 3 for r in kept)
    assert decontaminate.contaminated(docs.limit(0), benchmark).count() == 0
    assert decontaminate.contaminated(docs, benchmark.limit(0)).count() == 0
