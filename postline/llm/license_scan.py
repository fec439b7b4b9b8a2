"""Licence notices in texts, by patience alignment with templates.

A text and a template are words. Words that are unique in both are anchors;
the longest run of anchors that is in order in both is kept, and the gaps
between them are aligned in the same way. The share of the template's words
that are aligned is its coverage. A notice names its licence, so each template
has words that must be aligned, and others that name a relative of it and may
not stand in the notice; the text is aligned around its first name.
"""

import re
from bisect import bisect_left
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from postline.llm.batches import map_text

COVERAGE = 0.8
# Words of the text around a name, beyond the template's, as a share of the template.
SLACK = 0.5
WORD = re.compile(r"[A-Za-z0-9]+")


@dataclass(frozen=True)
class Template:
    """A notice; `names` are words of it that stand for the licence, `strange` words that stand for another."""

    license: str
    text: str
    names: tuple[str, ...]
    strange: tuple[str, ...] = ()

    @cached_property
    def words(self) -> list[str]:
        return list(words_of(self.text))


# The wording of common notices.
GNU = {
    "gpl-2.0": ("General", "2", ("lesser", "library", "affero", "3", "1")),
    "gpl-3.0": ("General", "3", ("lesser", "library", "affero", "2")),
    "lgpl-2.1": ("Lesser General", "2.1", ("affero", "3")),
    "lgpl-3.0": ("Lesser General", "3", ("affero", "2")),
    "agpl-3.0": ("Affero General", "3", ("lesser", "library", "2")),
}
CREATIVE_COMMONS = {
    "by": "Attribution",
    "by-sa": "Attribution-ShareAlike",
    "by-nd": "Attribution-NoDerivatives",
    "by-nc": "Attribution-NonCommercial",
    "by-nc-sa": "Attribution-NonCommercial-ShareAlike",
    "by-nc-nd": "Attribution-NonCommercial-NoDerivatives",
}
IDENTIFIERS = (
    "Apache-2.0 MIT ISC MPL-2.0 BSD-2-Clause BSD-3-Clause GPL-2.0 GPL-3.0 LGPL-2.1 LGPL-3.0 AGPL-3.0 CC0-1.0 "
    "CC-BY-4.0 CC-BY-SA-4.0 CC-BY-ND-4.0 CC-BY-NC-4.0 CC-BY-NC-SA-4.0 CC-BY-NC-ND-4.0 Unlicense"
).split()


def words_of(text: str) -> tuple[str, ...]:
    return tuple(word.lower() for word in WORD.findall(text))


def _gnu(license: str, kind: str, version: str, strange: tuple[str, ...]) -> list[Template]:
    names = ("gnu", *words_of(kind), *words_of(version))
    published = f"modify it under the terms of the GNU {kind} Public License as published by the Free Software Foundation"
    either = f"either version {version} of the License, or (at your option) any later version"
    return [
        Template(license, f"This work is licensed under the GNU {kind} Public License, version {version}", names, strange),
        Template(license, f"GNU {kind} Public License version {version}", names, strange),
        Template(license, f"GNU {kind} Public License v{version}", ("gnu", *words_of(kind), *words_of(f"v{version}")), strange),
        # What is licensed may itself be a library.
        *(
            Template(license, f"This {what} is free software: you can redistribute it and/or {published}, {either}", names, tuple(w for w in strange if w != "library"))
            for what in ("program", "library")
        ),
    ]


def _creative_commons(kind: str, title: str, version: str) -> list[Template]:
    own = {*words_of(f"{kind} {title}")}
    strange = tuple(sorted({word for k, t in CREATIVE_COMMONS.items() for word in words_of(f"{k} {t}")} - own))
    license, names = f"cc-{kind}-{version}", ("cc", *words_of(kind), version[0])
    long_names = ("creative", *words_of(title), version[0])
    return [
        Template(license, f"Licensed under CC {kind} {version}", names, strange),
        Template(license, f"CC {kind} {version}", names, strange),
        Template(license, f"Creative Commons {title} {version} International License", long_names, strange),
        Template(license, f"Creative Commons {title} {version}", long_names, strange),
    ]


TEMPLATES = (
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0", ("apache", "2")),
    Template("apache-2.0", "Apache License, Version 2.0", ("apache", "2")),
    Template(
        "apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at",
        ("apache", "2"),
    ),
    Template("mit", "Released under the MIT License", ("mit", "license")),
    Template("mit", "Licensed under the MIT License", ("mit", "license")),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction",
        ("permission", "granted"),
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies",
        ("fee", "granted"),
    ),
    Template("isc", "Licensed under the ISC License", ("isc", "license")),
    Template(
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at",
        ("mozilla", "2"),
    ),
    Template("mpl-2.0", "Mozilla Public License, version 2.0", ("mozilla", "2")),
    Template("mpl-2.0", "Mozilla Public License 2.0", ("mozilla", "2")),
    Template("cc0-1.0", "Creative Commons Zero 1.0 Universal", ("creative", "zero")),
    Template("cc0-1.0", "CC0 1.0 Universal (CC0 1.0) Public Domain Dedication", ("cc0", "dedication")),
    Template("cc0-1.0", "Licensed under CC0 1.0", ("cc0", "1")),
    Template(
        "unlicense", "This is free and unencumbered software released into the public domain", ("unencumbered", "domain")
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
        ("redistribution", "binary"),
    ),
    Template(
        "bsd-3-clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission",
        ("neither", "endorse"),
    ),
    Template("bsd-2-clause", "Licensed under the BSD 2-Clause License", ("bsd", "2")),
    Template("bsd-3-clause", "Licensed under the BSD 3-Clause License", ("bsd", "3")),
    *(template for license, how in GNU.items() for template in _gnu(license, *how)),
    *(
        template
        for version in ("4.0", "3.0")
        for kind, title in CREATIVE_COMMONS.items()
        for template in _creative_commons(kind, title, version)
    ),
    *(
        Template(name.lower(), f"SPDX-License-Identifier: {name}", ("spdx", *words_of(name)), ("nc", "nd", "sa"))
        if name == "CC-BY-4.0"
        else Template(name.lower(), f"SPDX-License-Identifier: {name}", ("spdx", *words_of(name)))
        for name in IDENTIFIERS
    ),
)


def templates_of(table: DataFrame) -> tuple[Template, ...]:
    """Templates from a table of license, text, names and strange (lists of words); it is small and goes to every task."""
    rows = table.orderBy("license", "text").collect()
    return tuple(Template(r.license, r.text, tuple(r.names or words_of(r.text)), tuple(r.strange or ())) for r in rows)


def _unique(words: list[str], low: int, high: int) -> dict[str, int]:
    """Places of the words that occur once from `low` to `high`."""
    seen: dict[str, int] = {}
    for i in range(low, high):
        seen[words[i]] = -1 if words[i] in seen else i
    return {word: i for word, i in seen.items() if i >= 0}


def longest_rising(values: list[int]) -> list[int]:
    """Places of a longest strictly rising run of the values."""
    ends: list[int] = []
    at: list[int] = []
    before: list[int] = []
    for i, value in enumerate(values):
        k = bisect_left(ends, value)
        before.append(at[k - 1] if k else -1)
        ends[k : k + 1], at[k : k + 1] = [value], [i]
    run, i = [], at[-1] if at else -1
    while i >= 0:
        run.append(i)
        i = before[i]
    return run[::-1]


def patience(text: list[str], template: list[str]) -> list[tuple[int, int]]:
    """Aligned places (text, template), rising in both.

    A gap without anchors is aligned as far as its words are equal from either end.
    """
    found: list[tuple[int, int]] = []
    gaps = [(0, len(text), 0, len(template))]
    while gaps:
        a, a_end, b, b_end = gaps.pop()
        if a >= a_end or b >= b_end:
            continue
        ours, theirs = _unique(text, a, a_end), _unique(template, b, b_end)
        shared = sorted((i, theirs[word]) for word, i in ours.items() if word in theirs)
        anchors = [shared[k] for k in longest_rising([j for _, j in shared])]
        if anchors:
            found += anchors
            edges = [(a - 1, b - 1), *anchors, (a_end, b_end)]
            gaps += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:])]
            continue
        while a < a_end and b < b_end and text[a] == template[b]:
            found.append((a, b))
            a, b = a + 1, b + 1
        while a < a_end and b < b_end and text[a_end - 1] == template[b_end - 1]:
            a_end, b_end = a_end - 1, b_end - 1
            found.append((a_end, b_end))
    return sorted(found)


def _around(words: list[str], template: Template, name: str) -> list[tuple[int, int, float]]:
    """(first word, end, coverage) of each place where the template's first name stands in a notice."""
    found: list[tuple[int, int, float]] = []
    size, slack = len(template.words), int(SLACK * len(template.words)) + 1
    place, known, not_here = template.words.index(name), set(template.words), set(template.strange)
    taken = 0
    for at, word in enumerate(words):
        if word != name or at < taken:
            continue
        low, high = max(taken, at - place - slack), min(len(words), at - place + size + slack)
        if sum(w in known for w in words[low:high]) < COVERAGE * size:
            continue
        pairs = patience(words[low:high], template.words)
        aligned = {template.words[j] for _, j in pairs}
        coverage = len(pairs) / size
        strange = not_here.intersection(words[low + pairs[0][0] : low + pairs[-1][0] + 1]) if pairs else not_here
        if coverage >= COVERAGE - 1e-9 and aligned.issuperset(template.names) and not strange:
            found.append((low + pairs[0][0], low + pairs[-1][0] + 1, coverage))
            taken = found[-1][1]
    return found


def notices(text: str | None, templates: tuple[Template, ...] = TEMPLATES) -> list[tuple[int, int, str, float]]:
    """(start, end, licence, coverage) of each notice, places in code points.

    Of templates that match the same place, the one that covers most words stands.
    """
    small = (text or "").lower()
    able = [t for t in templates if all(name in small for name in t.names)]
    if not able:
        return []
    places = list(WORD.finditer(text))
    words = [m[0].lower() for m in places]
    found = []
    for order, template in enumerate(able):
        for first, end, coverage in _around(words, template, template.names[0]):
            covered = round(coverage * len(template.words))
            found.append((-covered, -coverage, order, first, end, template.license))
    kept: list[tuple[int, int, str, float]] = []
    for _, coverage, _, first, end, license in sorted(found):
        if not any(first < e and s < end for s, e, _, _ in kept):
            kept.append((first, end, license, -coverage))
    return [(places[s].start(), places[e - 1].end(), license, coverage) for s, e, license, coverage in sorted(kept)]


def scan_licenses(docs: DataFrame, keep: list[str], templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """The kept columns and, for every whole text, its `notices` and its `license`.

    `license` is the licence with the best covered notice, the first of equals;
    NULL if there is none, as in NULL and empty texts. Where notices clash, the
    one that covers most words stands. Repeated rows are all returned; an empty
    table gives no rows.
    """

    def start():
        def apply(texts: list[str | None]) -> list:
            found = [notices(text, templates) for text in texts]
            best = [max(f, key=lambda n: (n[3], -n[0]))[2] if f else None for f in found]
            names = ("start", "end", "license", "coverage")
            return [best, [[dict(zip(names, n, strict=True)) for n in f] for f in found]]

        return apply

    schema = "license string, notices array<struct<start:bigint,end:bigint,license:string,coverage:double>>"
    return map_text(docs, "text", keep, schema, start)
