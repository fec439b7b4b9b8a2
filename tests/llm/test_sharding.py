import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postline.llm import sharding
from tests.llm.conftest import SF


def brute_capacity(sizes, shards):
    """The least greatest sum, by trying all cuts."""
    best = {(0, 0): 0}
    for k in range(1, shards + 1):
        for end in range(len(sizes) + 1):
            best[k, end] = min(
                (max(best[k - 1, start], sum(sizes[start:end])) for start in range(end + 1) if (k - 1, start) in best), default=0
            )
    return best[shards, len(sizes)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=9), st.integers(1, 5))
def test_smallest_capacity(sizes, shards):
    assert sharding.smallest_capacity(sizes, shards) == brute_capacity(sizes, shards)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=30), st.integers(1, 6))
def test_cuts_stay_within_the_capacity(sizes, shards):
    line = [sharding.Stretch(i, 64, size, True) for i, size in enumerate(sizes)]
    capacity = sharding.smallest_capacity(sizes, shards)
    cuts = sharding._cut(line, shards, capacity)
    assert len(cuts) < shards
    edges = [0, *cuts, len(sizes)]
    assert edges == sorted(edges) and max(sum(sizes[a:b]) for a, b in zip(edges, edges[1:])) <= capacity


def check(rows, shards):
    """The laws of a sharding; returns the bytes of each shard."""
    by_text, slots, totals = {}, {}, {}
    for r in rows:
        by_text.setdefault(r.text, set()).add(r.shard)
        slots.setdefault(r.shard, []).append(r.slot)
        totals[r.shard] = totals.get(r.shard, 0) + r.size
        assert r.size == len((r.text or "").encode()) + 16
        assert r.text_crc32 == (None if r.text is None else zlib.crc32(r.text.encode()))
    assert all(len(found) == 1 for found in by_text.values())
    assert all(sorted(found) == list(range(len(found))) for found in slots.values())
    assert all(0 <= shard < shards for shard in totals)
    return totals


def sharded(docs, shards, limit=sharding.LIMIT):
    # Ids are distinct here, so the texts can be put back.
    return sharding.shard_documents(docs, shards, limit).join(docs.select("doc_id", "text"), "doc_id").collect()


@pytest.mark.parametrize("limit", [64, sharding.LIMIT])
def test_capacity_is_the_least_over_the_order_of_hashes(spark, limit):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    groups = docs.groupBy(F.xxhash64("text").alias("h")).agg(F.sum(F.octet_length("text") + 16).alias("s")).orderBy("h").collect()
    sizes = [g.s for g in groups]
    # Without any group beyond an equal share, the plan is the minimax of the whole line.
    shards = 5
    assert max(sizes) * shards <= sum(sizes)
    totals = check(sharded(docs, shards, limit), shards)
    assert max(totals.values()) <= sharding.smallest_capacity(sizes, shards) and len(totals) == shards


def test_a_hot_text_has_a_shard_of_its_own(make):
    docs = make(*[(i, "same " * 20) for i in range(60)], *[(100 + i, f"text {i}") for i in range(60)])
    totals = check(sharded(docs, 4), 4)
    others = sorted(totals.values())[:-1]
    assert len(totals) == 4 and max(others) - min(others) <= 2 * 24


def test_nulls_repeats_and_empty_tables(spark, make):
    docs = make((1, None), (2, None), (3, ""), (None, "a"), (4, "b" * 5000), (4, "b" * 5000))
    rows = sharding.shard_documents(docs.withColumn("shard", F.lit(9)).withColumn("size", F.lit(1)), 3).collect()
    assert len(rows) == 6
    assert [(r.size, r.text_crc32) for r in rows if r.doc_id in (1, 2)] == [(16, None)] * 2
    assert len({r.shard for r in rows if r.doc_id == 4}) == 1 and sorted(r.slot for r in rows if r.doc_id == 4) == [0, 1]
    assert sharding.shard_documents(docs.limit(0), 3).count() == 0


def test_no_python_on_the_main_path(make):
    plan = sharding.shard_documents(make((1, "a"), (2, "b")), 2)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
