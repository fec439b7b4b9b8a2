import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from postline.llm import filter_audit, queries
from tests.llm.conftest import SF
from tests.oracle import connect, difference


def fails(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return [
        len(words) < 50,
        100 * len(set(words)) < 65 * len(words),
        100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
        bool(re.search("[#$%&*|]", text)),
    ]


def brute(rows, labels):
    """Every order applied to every document, step by step. rows: (doc_id, text, source); labels: (doc_id, quality, toxic)."""
    failing = []
    for doc_id, text, _ in rows:
        copy = doc_id is not None and any(i is not None and i < doc_id and (t or "") == (text or "") for i, t, _ in rows)
        failing.append([*fails(text), copy])
    good = {i for i, quality, _ in labels if quality == 1 and i is not None}
    toxic = {i for i, _, is_toxic in labels if is_toxic == 1 and i is not None}
    made = []
    for part in {source or "" for *_, source in rows}:
        own = [k for k, row in enumerate(rows) if (row[2] or "") == part]
        shapley, found = Counter(), []
        for order in permutations(range(5)):
            left = list(own)
            for step, f in enumerate(order):
                removed = [k for k in left if failing[k][f]]
                left = [k for k in left if not failing[k][f]]
                shapley[f] += len(removed)
                found.append((
                    "".join("ABCDE"[x] for x in order), step + 1, f, len(left), len(removed),
                    sum(failing[k][f] for k in own) - len(removed),
                    sum(failing[k][f] and sum(failing[k]) == 1 for k in own),
                    sum(rows[k][0] in good for k in removed), sum(rows[k][0] in toxic for k in removed),
                ))
        made += [(part, order, step, *counts, shapley[f]) for order, step, f, *counts in found]
    return sorted(made)


def rows_of(found):
    names = ["part", "filter_order", "step", *filter_audit.MADE]
    return sorted(tuple(row) for row in found.select(*names).collect())


def test_the_query_and_its_sql(spark):
    found = queries.op11_filter_audit(spark, SF)
    assert difference(found, filter_audit.AUDIT_SQL, connect(SF)) is None
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    want = brute([(r.doc_id, r.text, r.source) for r in docs], [(r.doc_id, r.quality, r.toxic) for r in labels])
    assert rows_of(found) == want


@pytest.mark.parametrize("filters", [1, 3, 5])
def test_contractions_against_single_rows(filters):
    rng = np.random.default_rng(filters)
    rows = rng.integers(0, 2, (200, filters))
    tensor = np.zeros((2,) * filters, np.int64)
    np.add.at(tensor, tuple(rows.T), 1)
    found = filter_audit.audit_tensors({"n": tensor, "good": tensor * 2, "toxic": tensor * 0})
    for i, order in enumerate(permutations(range(filters))):
        left = rows
        for step, f in enumerate(order):
            failing = left[:, f] == 1
            assert found["removed"][i, step] == failing.sum() == found["good_lost"][i, step] / 2
            left = left[~failing]
            assert found["kept"][i, step] == len(left) and found["toxic_lost"][i, step] == 0
            assert found["redundant"][i, step] == rows[:, f].sum() - failing.sum()
            assert found["unique_fails"][i, step] == ((rows[:, f] == 1) & (rows.sum(axis=1) == 1)).sum()
    for step in range(filters):
        for f in range(filters):
            of = [(i, o.index(f)) for i, o in enumerate(permutations(range(filters)))]
            assert all(found["shapley"][i, at] == sum(found["removed"][j, k] for j, k in of) for i, at in of)


def odd_rows():
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefghij", k=4))
    long = " ".join(word() for _ in range(60))
    rows = [
        (1, None, None), (2, "", ""), (None, "", "s"), (3, " \t\x0b\x0c\r\n", "s"), (5, long, "s"), (4, long, "t"), (4, long, "t"),
        (None, long, "t"), (6, long.upper(), None), (7, "a " * 100, "s"), (8, long + " é #", "s"), (8, long, "s"), (9, "É" * 50 + "AB", "u"),
        (10, " ".join(word() for _ in range(20000)), "u"), (11, "A" * 5 + "b" * 95, "u"), (12, "A" * 6 + "b" * 94, "u"),
    ]
    labels = [(4, 1, 0), (4, 0, 1), (6, None, 1), (7, 1, None), (None, 1, 1), (99, 1, 1), (8, 0, 0), (8, 1, 0)]
    return rows, labels


def test_odd_rows(spark):
    rows, labels = odd_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(3)
    for name in ("part", "A", "E", "good", "_text", "_id", "n"):
        docs = docs.withColumn(name, F.lit("x"))
    known = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").withColumn("good", F.lit(5)).withColumn("text", F.lit("t"))
    assert rows_of(filter_audit.audit(docs, known)) == brute(rows, labels)
    assert filter_audit.audit(docs.limit(0), known).count() == 0
    assert rows_of(filter_audit.audit(docs, known.limit(0))) == brute(rows, [])
