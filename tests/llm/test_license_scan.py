import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postline.llm import license_scan
from tests.llm.conftest import SF


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 20), max_size=9, unique=True))
def test_longest_rising(values):
    import itertools

    run = [values[i] for i in license_scan.longest_rising(values)]
    assert run == sorted(run)
    assert len(run) == max(k for k in range(len(values) + 1) for c in itertools.combinations(values, k) if list(c) == sorted(c))


def plain_patience(a, b, ties):
    """The method as it is stated, by recursion on slices; `ties` gets a gap that has several longest runs."""
    if not a or not b:
        return []
    unique = [w for w in a if a.count(w) == 1 and b.count(w) == 1]
    runs = [[w for k, w in enumerate(unique) if mask >> k & 1] for mask in range(1 << len(unique))]
    runs = [run for run in runs if [b.index(w) for w in run] == sorted(b.index(w) for w in run)]
    best = max(runs, key=len)
    if sum(len(run) == len(best) for run in runs) > 1:
        ties.append((a, b))
    if not best:
        head = 0
        while head < min(len(a), len(b)) and a[head] == b[head]:
            head += 1
        tail = 0
        while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
            tail += 1
        return [(i, i) for i in range(head)] + [(len(a) - tail + i, len(b) - tail + i) for i in range(tail)]
    found, at, bt = [], 0, 0
    for w in [*best, None]:
        i, j = (a.index(w), b.index(w)) if w is not None else (len(a), len(b))
        found += [(x + at, y + bt) for x, y in plain_patience(a[at:i], b[bt:j], ties)]
        if w is not None:
            found.append((i, j))
        at, bt = i + 1, j + 1
    return found


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abcdefg"), max_size=10), st.lists(st.sampled_from("abcdefg"), max_size=10))
def test_patience(a, b):
    found = license_scan.patience(a, b)
    assert all(a[i] == b[j] for i, j in found)
    assert [i for i, _ in found] == sorted({i for i, _ in found}) and [j for _, j in found] == sorted({j for _, j in found})
    # Of several longest runs of anchors any may be taken.
    ties = []
    want = sorted(plain_patience(a, b, ties))
    assert ties or found == want


def test_the_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = {r.doc_id: r for r in license_scan.scan_licenses(docs, ["doc_id"]).collect()}
    lines = {"Licensed under the Apache License, Version 2.0.": "apache-2.0", "Released under the MIT License.": "mit", "Licensed under CC BY-NC 4.0.": "cc-by-nc-4.0",
             "This work is licensed under the GNU General Public License, version 3.": "gpl-3.0"}
    for r in docs.collect():
        want = {name for line, name in lines.items() if line in r.text}
        got = found[r.doc_id]
        assert {n.license for n in got.notices} == want and (got.license in want if want else got.license is None)
        for n in got.notices:
            assert r.text[n.start : n.end] in next(line for line, name in lines.items() if name == n.license)


def test_changed_notices():
    rng = random.Random(6)
    for template in license_scan.TEMPLATES:
        words = template.text.split()
        changed = [w.upper() if rng.random() < 0.3 else w + "," for w in words]
        if len(words) > 12:
            changed.insert(len(words) // 2, "indeed")
        text = "of the and 3 mit " + " \n ".join(changed) + " in to"
        found = license_scan.notices(text)
        assert [n[2] for n in found] == [template.license], template
    assert license_scan.notices("Released under the Foo License, by permission granted") == []
    assert license_scan.notices("Licensed under the Foo License, Version 2.0") == []
    twice = "Released under the MIT License. " * 2
    assert [(n[2], twice[n[0] : n[1]]) for n in license_scan.notices(twice)] == [("mit", "Released under the MIT License")] * 2


@pytest.mark.parametrize(
    ("text", "license"),
    [
        ("This work is licensed under the GNU Lesser General Public License, version 3.", "lgpl-3.0"),
        ("This work is licensed under the GNU Affero General Public License, version 3.", "agpl-3.0"),
        ("This work is licensed under the GNU General Public License, version 2.", "gpl-2.0"),
        ("This work is licensed under the GNU Lesser General Public License, version 2.1.", "lgpl-2.1"),
        (
            "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License "
            "as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.", "lgpl-2.1",
        ),
        (
            "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License "
            "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "lgpl-3.0",
        ),
        (
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License "
            "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "agpl-3.0",
        ),
        ("Licensed under CC BY-SA 4.0.", "cc-by-sa-4.0"), ("Licensed under CC BY-ND 4.0.", "cc-by-nd-4.0"), ("Licensed under CC BY 4.0.", "cc-by-4.0"),
        ("Licensed under CC BY-NC-SA 4.0.", "cc-by-nc-sa-4.0"), ("Licensed under CC BY-NC-ND 4.0", "cc-by-nc-nd-4.0"), ("CC BY-SA 3.0", "cc-by-sa-3.0"),
        ("the Creative Commons Attribution-NonCommercial 4.0 International License", "cc-by-nc-4.0"),
        ("the Creative Commons Attribution 4.0 International License", "cc-by-4.0"),
        ("subject to the terms of the Mozilla Public License, version 2.0", "mpl-2.0"), ("Licensed under the ISC License", "isc"), ("Licensed under CC0 1.0", "cc0-1.0"),
        ("SPDX-License-Identifier: MIT", "mit"), ("SPDX-License-Identifier: CC-BY-SA-4.0", "cc-by-sa-4.0"), ("SPDX-License-Identifier: GPL-2.0-only", "gpl-2.0"),
        ("under the GNU Public License, version 9", None), ("CC BY the author, version 4", None), ("Licensed under the GNU Library General Public License, version 2", None),
    ],
)
def test_relatives_are_told_apart(text, license):
    found = license_scan.notices(f"Some words before. {text} And some after that 3 of them.")
    assert [n[2] for n in found] == ([license] if license else [])


def brute_notices(words, templates):
    """All stretches of a short text against all templates: covered words, by the plain alignment; None if it has ties."""
    found, ties = [], []
    for order, template in enumerate(templates):
        for at, word in enumerate(words):
            if word != template.names[0]:
                continue
            size = len(template.words)
            place, slack = template.words.index(word), int(license_scan.SLACK * size) + 1
            low, high = max(0, at - place - slack), min(len(words), at - place + size + slack)
            pairs = sorted(plain_patience(words[low:high], template.words, ties))
            if not pairs or len(pairs) < license_scan.COVERAGE * size - 1e-9:
                continue
            span = range(low + pairs[0][0], low + pairs[-1][0] + 1)
            named = set(template.names) <= {template.words[j] for _, j in pairs}
            if named and not set(template.strange) & {words[i] for i in span}:
                found.append((-len(pairs), -len(pairs) / size, order, span, template.license))
    kept = []
    for *_, span, license in sorted(found, key=lambda f: f[:3]):
        if not any(set(span) & set(other) for other, _ in kept):
            kept.append((span, license))
    return None if ties else sorted((span[0], span[-1], license) for span, license in kept)


def test_notices_against_plain_alignment():
    """Short notices, alone and clashing, with words changed, dropped and put in."""
    rng = random.Random(8)
    templates = tuple(t for t in license_scan.TEMPLATES if len(t.words) <= 9)
    hits = 0
    for _ in range(300):
        template = rng.choice(templates)
        words = [w for w in template.words if rng.random() < 0.95]
        if rng.random() < 0.4:
            words.insert(rng.randint(0, len(words)), rng.choice(["lesser", "nc", "sa", "x", "affero", "mit"]))
        words = [*rng.choices(["p", "q", "r", "under", "license"], k=3), *words, *rng.choices(["s", "t", "version"], k=2)]
        text, want = " ".join(words), brute_notices(words, templates)
        got = [(len(text[:s].split()), len(text[:e].split()) - 1, license) for s, e, license, _ in license_scan.notices(text, templates)]
        assert want is None or got == want, text
        hits += bool(want)
    assert hits > 100


def test_templates_from_a_table(spark, make):
    table = spark.createDataFrame([("house", "Use as our house rules of 2020 allow", ["house", "2020"], None), ("mit", "Released under the MIT License", None, ["not"])],
                                  "license string, text string, names array<string>, strange array<string>")
    docs = make((1, "Use as our house rules of 2020 allow."), (2, "Released under the MIT License"), (3, "Released under not the MIT License"))
    found = license_scan.scan_licenses(docs, ["doc_id"], license_scan.templates_of(table)).collect()
    assert {r.doc_id: r.license for r in found} == {1: "house", 2: "mit", 3: None}


def test_odd_rows(make):
    notice = "Released under the MIT License."
    docs = make((1, None), (2, ""), (None, notice), (3, "w " * 100_000 + notice), (4, notice), (4, notice)).withColumn("license", F.lit(1))
    found = license_scan.scan_licenses(docs, ["doc_id"]).collect()
    assert sorted((str(r.doc_id), str(r.license), len(r.notices)) for r in found) == [
        ("1", "None", 0), ("2", "None", 0), ("3", "mit", 1), ("4", "mit", 1), ("4", "mit", 1), ("None", "mit", 1)
    ]
    assert license_scan.scan_licenses(docs.limit(0), ["doc_id"]).count() == 0
