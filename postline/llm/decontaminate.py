"""Benchmark items that a text holds, by SimHash of item-sized windows.

A window has as many words as the item. Its fingerprint and the item's are sums
over their shingles of five words; a window slides by taking one shingle off
and adding one, so all windows of a size come from running sums. A window
meets the items that share a shingle with it, which a list per shingle names;
with all others its similarity is 0, so nothing is lost by that. What meets is
compared by multi-index: of 8 blocks of 8 bits, fingerprints within the radius
have one that differs in radius / 8 bits or fewer. What is within the radius
is then verified on the shingles themselves, each weighted by how often it
occurs. So the work of a text depends on the items it shares words with, and
not on how many there are.
"""

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postline.llm.batches import map_text, unused

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BLOCKS = 8
# Of 64 bits some 10 differ at similarity 0.8, with a deviation of 3.
RADIUS = 22
# Items in one pass over the documents, by their characters: they travel with every task.
PASS_CHARS = 8_000_000
MATCH = "array<struct<item_id:bigint,start:bigint,n_words:bigint,distance:int,similarity:double>>"
WORD = re.compile(r"\w+")
GATE_BITS = 20
# Pairs of a window and an item that are compared at once.
TILE = 1 << 18
BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def _word_hashes(words: list[str]) -> np.ndarray:
    """Numbers that equal words share within one process."""
    return np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)


def _shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    n = len(hashes) - size + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    joined = hashes[:n].copy()
    for k in range(1, size):
        joined *= BASE
        joined += hashes[k : k + n]
    joined ^= joined >> np.uint64(29)
    joined *= np.uint64(0xBF58476D1CE4E5B9)
    return joined ^ joined >> np.uint64(32)


def _bits(shingles: np.ndarray) -> np.ndarray:
    return np.unpackbits(shingles.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _prints(shingles: np.ndarray, size: int) -> np.ndarray:
    """The SimHash of each run of `size` shingles."""
    sums = np.zeros((len(shingles) + 1, 64), np.int32)
    np.cumsum(_bits(shingles), axis=0, out=sums[1:], dtype=np.int32)
    counts = sums[size:] - sums[:-size]
    return np.packbits(counts * 2 > size, axis=1, bitorder="little").view("<u8")[:, 0]


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard of two bags of shingles."""
    left, right = Counter(a.tolist()), Counter(b.tolist())
    both = sum((left & right).values())
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 0.0


def near_blocks(a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    """Whether a block of the fingerprints differs in few enough bits; true for all that are within the radius."""
    apart = np.bitwise_count((a ^ b).view(np.uint8).reshape(-1, BLOCKS))
    return (apart <= radius // BLOCKS).any(axis=1)


@dataclass
class _Size:
    """The items of one number of words, and for each of their shingles the items that have it."""

    words: int
    shingle: int
    ids: list[int] = field(default_factory=list)
    bags: list[np.ndarray] = field(default_factory=list)
    prints: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    known: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    starts: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    owners: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def close(self) -> None:
        self.prints = np.concatenate([_prints(bag, len(bag)) for bag in self.bags])
        owners = np.repeat(np.arange(len(self.bags)), [len(bag) for bag in self.bags])
        shingles = np.concatenate(self.bags)
        order = np.lexsort((owners, shingles))
        owners, shingles = owners[order], shingles[order]
        first = np.r_[True, (shingles[1:] != shingles[:-1]) | (owners[1:] != owners[:-1])]
        self.owners, shingles = owners[first], shingles[first]
        self.known, places = np.unique(shingles, return_index=True)
        self.starts = np.r_[places, len(shingles)]

    def meetings(self, shingles: np.ndarray, shared: np.ndarray, held: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(window start, item) for the items that share a shingle with the window, some TILE pairs at a time."""
        place = np.minimum(np.searchsorted(self.known, shingles[shared]), len(self.known) - 1)
        own = self.known[place] == shingles[shared]
        at, place = shared[own], place[own]
        n = self.starts[place + 1] - self.starts[place]
        ends = np.cumsum(n)
        done = 0
        while done < len(at):
            # Shared shingles, one after the other, as many as fill a tile; windows that hold several come again.
            base = ends[done - 1] if done else 0
            until = max(done + 1, int(np.searchsorted(ends, base + max(1, TILE // held), side="right")))
            part, many = at[done:until], n[done:until]
            offset = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            items = self.owners[np.repeat(self.starts[place[done:until]], many) + offset]
            yield np.repeat(part, many), items
            done = until


def _windows_of(at: np.ndarray, items: np.ndarray, held: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (window start, item) of the windows that hold the shingles at these places."""
    low, high = np.maximum(at - held + 1, 0), np.minimum(at, last)
    order = np.lexsort((low, items))
    low, high, items = low[order], high[order], items[order]
    # Per item: a stretch goes on from where the one before ends.
    reach = np.maximum.accumulate(high + items * (last + 2))[:-1] - items[1:] * (last + 2)
    low = np.r_[low[:1], np.maximum(low[1:], reach + 1)]
    n = np.maximum(0, high - low + 1)
    start = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return start, np.repeat(items, n)


class Index:
    """Benchmark items by size; made once per worker process, as word hashes differ between processes."""

    def __init__(self, items: tuple[tuple[int, str], ...], radius: int, least: float):
        self.radius, self.least = radius, least
        sizes: dict[int, _Size] = {}
        for item, text in items:
            words = words_of(text)
            if words:
                shingle = min(SHINGLE_WORDS, len(words))
                size = sizes.setdefault(len(words), _Size(len(words), shingle))
                size.ids.append(item)
                size.bags.append(_shingles(_word_hashes(words), shingle))
        self.sizes = list(sizes.values())
        # Per number of words in a shingle: the shingles of the items, and which sizes have them.
        self.known: dict[int, np.ndarray] = {}
        self.gates: dict[int, np.ndarray] = {}
        for size in self.sizes:
            size.close()
            self.known[size.shingle] = np.concatenate([self.known.get(size.shingle, np.zeros(0, np.uint64)), *size.bags])
        for shingle, known in self.known.items():
            self.known[shingle] = np.unique(known)
            gate = np.zeros(1 << GATE_BITS, bool)
            gate[self.known[shingle] >> np.uint64(64 - GATE_BITS)] = True
            self.gates[shingle] = gate

    def _shared(self, shingles: np.ndarray, shingle: int) -> np.ndarray:
        at = np.flatnonzero(self.gates[shingle][shingles >> np.uint64(64 - GATE_BITS)])
        known = self.known[shingle]
        place = np.minimum(np.searchsorted(known, shingles[at]), len(known) - 1)
        return at[known[place] == shingles[at]]

    def _in_windows(self, size: _Size, shingles: np.ndarray, shared: np.ndarray) -> Iterator[tuple]:
        """Matches in the windows of one size that hold a shared shingle."""
        held = min(size.words - size.shingle + 1, len(shingles))
        # Stretches of window starts; starts that follow each other share their sums.
        first = np.maximum(shared - held + 1, 0)
        last = np.minimum(shared, len(shingles) - held)
        new = np.r_[True, first[1:] > np.maximum.accumulate(last)[:-1] + 1]
        lows = first[new]
        highs = np.r_[np.maximum.accumulate(last)[:-1][new[1:]], last.max()]
        prints = np.zeros(len(shingles) - held + 1, np.uint64)
        for low, high in zip(lows.tolist(), highs.tolist(), strict=True):
            prints[low : high + 1] = _prints(shingles[low : high + held], held)
        for at, items in size.meetings(shingles, shared, held):
            starts, items = _windows_of(at, items, held, len(prints) - 1)
            near = near_blocks(prints[starts], size.prints[items], self.radius)
            starts, items = starts[near], items[near]
            distance = np.bitwise_count(prints[starts] ^ size.prints[items])
            for k in np.flatnonzero(distance <= self.radius).tolist():
                start, item = int(starts[k]), int(items[k])
                found = similarity(shingles[start : start + held], size.bags[item])
                if found >= self.least - 1e-9:
                    yield size.ids[item], start, int(distance[k]), found

    def matches(self, text: str | None) -> list[dict]:
        """One match per item that the text holds: its most similar window, the first of equals."""
        words = words_of(text)
        hashes = _word_hashes(words)
        best: dict[int, tuple] = {}
        made: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size in self.sizes:
            if size.shingle not in made:
                shingles = _shingles(hashes, size.shingle)
                made[size.shingle] = shingles, self._shared(shingles, size.shingle)
            shingles, shared = made[size.shingle]
            if len(shared):
                for item, start, distance, found in self._in_windows(size, shingles, shared):
                    if item not in best or (-found, start) < best[item][:2]:
                        best[item] = (-found, start, distance, min(size.words, len(words)))
        return [
            {"item_id": item, "start": start, "n_words": n, "distance": distance, "similarity": -found}
            for item, (found, start, distance, n) in sorted(best.items())
        ]


@lru_cache(maxsize=1)
def _index(items: tuple[tuple[int, str], ...], radius: int, least: float) -> Index:
    return Index(items, radius, least)


def _passes(benchmark: DataFrame) -> Iterator[tuple[tuple[int, str], ...]]:
    """The items in groups of about PASS_CHARS characters, one after the other.

    Items are dealt to groups by their ids, so a benchmark of any size can be used, in more passes.
    """
    items = benchmark.filter(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select(
        F.col("item_id").cast("bigint").alias("item_id"), "text"
    )
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    groups = -(-chars // PASS_CHARS) or 1
    dealt = F.pmod(F.xxhash64("item_id"), F.lit(groups))
    for group in range(groups):
        rows = items.filter(dealt == group).orderBy("item_id", "text").collect()
        yield tuple((row.item_id, row.text) for row in rows)


def with_matches(
    docs: DataFrame, benchmark: DataFrame, keep: list[str], radius: int = RADIUS, least: float = SIMILARITY
) -> DataFrame:
    """The kept columns and `matches`: per item that a text holds, its best window.

    Texts and items are sequences of lower-cased words; an item shorter than a
    shingle is one shingle, a text shorter than an item is one window. NULL and
    empty texts match nothing, items that are NULL or have no words are left
    out. Repeated rows are all returned; an empty table of either kind gives no
    matches. Word positions count from 0.
    """
    made, before = docs, unused(docs, "_before")
    for i, items in enumerate(_passes(benchmark)):

        def start(items=items):
            index = _index(items, radius, least)
            return lambda texts: [[index.matches(text) for text in texts]]

        held = keep if i == 0 else [*keep, before]
        if i:
            made = made.withColumnRenamed("matches", before)
        names = list(dict.fromkeys([*held, "text"]))
        made = map_text(made, "text", names, f"matches {MATCH}", start)
        if i:
            made = made.withColumn("matches", F.concat(before, "matches")).drop(before)
    return made.select(*keep, "matches")


def contaminated(docs: DataFrame, benchmark: DataFrame, radius: int = RADIUS, least: float = SIMILARITY) -> DataFrame:
    """One row per document and item that it holds; documents without any have no row (see `with_matches`)."""
    found = with_matches(docs, benchmark, ["doc_id"], radius, least)
    return found.select("doc_id", F.inline("matches"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, radius: int = RADIUS, least: float = SIMILARITY) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns (see `with_matches`)."""
    own = unused(docs, "_matches")
    kept = docs.withColumnRenamed("matches", own)
    found = with_matches(kept, benchmark, kept.columns, radius, least).filter(F.size("matches") == 0).drop("matches")
    return found.withColumnRenamed(own, "matches").select(*docs.columns)
