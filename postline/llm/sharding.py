"""Shards of near-equal bytes by minimax contiguous partition. DataFrame functions only.

The line that is cut is the order of text hashes; all copies of a text are one
atomic group, at one place of it. The smallest shard capacity for which the line
can be cut greedily into the given number of shards is found by binary search.

The line is not gathered: the driver sees it as at most some `LIMIT` stretches
of hashes with their sizes. For every capacity that is still possible, a cut
lies in one of a few stretches; only those are measured more finely, in one
aggregation per round, until each holds a single group. So the result is that
of the search over all groups, at any size of the table.
"""

from bisect import bisect_left, bisect_right
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postline.operators.layout import surrogate_id
from postline.session import stage

ROW_BYTES = 16
# Stretches that one round may add; they pass through the driver.
LIMIT = 1 << 15
LOW = -(1 << 63)


@dataclass(frozen=True)
class Stretch:
    """The hashes from `low`, of which the leading `bits` are fixed. Whole: it holds one group."""

    low: int
    bits: int
    size: int
    whole: bool

    @property
    def high(self) -> int:
        return self.low + (1 << (64 - self.bits)) - 1


@dataclass(frozen=True)
class Plan:
    """`alone[i]`, a hash, is shard `len(cuts) + 1 + i`; of the rest, `cuts` are the first hashes of shards 1, 2, .."""

    capacity: int
    cuts: list[int]
    alone: list[int]


def _fits(ends: list[int], shards: int, capacity: int) -> bool:
    """Whether filling shard after shard gets to the end of the line."""
    at = 0
    for _ in range(shards):
        at = bisect_right(ends, ends[at] + capacity) - 1
        if at == len(ends) - 1:
            return True
    return False


def smallest_capacity(sizes: list[int], shards: int) -> int:
    """The least capacity with which `shards` shards take the sizes in their order."""
    ends = [0, *accumulate(sizes)]
    low = max(max(sizes, default=0), -(-ends[-1] // shards))
    high = low + max(sizes, default=0)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if _fits(ends, shards, middle) else (middle + 1, high)
    return low


def _oversized(line: list[Stretch], shards: int) -> list[Stretch]:
    """What exceeds an equal share, and so gets a shard of its own, the largest first."""
    rest, found = sum(s.size for s in line), []
    for stretch in sorted(line, key=lambda s: -s.size)[: shards - 1]:
        if stretch.size * (shards - len(found)) <= rest:
            break
        found.append(stretch)
        rest -= stretch.size
    return found


def _undecided(line: list[Stretch], shards: int, capacity: int) -> list[Stretch]:
    """The stretches of several groups in which a cut may lie, for any capacity that is possible."""
    ends = [0, *accumulate(s.size for s in line)]
    least = max(max((s.size for s in line if s.whole), default=0), -(-ends[-1] // shards))
    first = last = 0
    found: set[int] = set()
    for _ in range(shards):
        first = bisect_right(ends, ends[first] + least) - 1
        last = bisect_right(ends, ends[last] + capacity) - 1
        if last < len(line) and not line[last].whole:
            last += 1
        found.update(range(first, min(last + 1, len(line))))
    return [line[i] for i in sorted(found) if not line[i].whole]


def _cut(line: list[Stretch], shards: int, capacity: int) -> list[int]:
    """Cuts within the capacity, each as near as may be to an equal share of what is left.

    Filling up every shard would leave the last ones short; `earliest` keeps
    the rest of the line within what the other shards can take.
    """
    ends = [0, *accumulate(s.size for s in line)]
    earliest = [len(line)]
    for _ in range(shards):
        earliest.append(bisect_left(ends, ends[earliest[-1]] - capacity))
    at, cuts = 0, []
    for left in range(shards, 1, -1):
        full = bisect_right(ends, ends[at] + capacity) - 1
        target = ends[at] + (ends[-1] - ends[at]) / left
        near = bisect_left(ends, target)
        if near > at and target - ends[near - 1] < ends[min(near, len(line))] - target:
            near -= 1
        at = min(max(near, earliest[left - 1]), full)
        cuts.append(line[at].low if at < len(line) else None)
    return [cut for cut in cuts if cut is not None]


def _stretches(sized: DataFrame, within: Column | None, bits: int) -> list[Stretch]:
    rows = sized if within is None else sized.filter(within)
    parts = rows.groupBy(F.shiftright("_hash", 64 - bits).alias("part")).agg(
        F.sum("size").alias("size"), F.min("_hash").alias("first"), F.max("_hash").alias("last")
    )
    return [
        Stretch(row.part << (64 - bits), bits, row.size, row.first == row.last) for row in parts.collect()
    ]


def plan_shards(sized: DataFrame, shards: int, limit: int = LIMIT) -> Plan:
    """The cuts for rows with `_hash` and `size`."""
    bits = min(64, limit.bit_length() - 1)
    line = sorted(_stretches(sized, None, bits), key=lambda s: s.low)
    while True:
        alone = _oversized(line, shards)
        finer = [s for s in alone if not s.whole]
        rest = [s for s in line if s not in set(alone)]
        if not finer:
            capacity = smallest_capacity([s.size for s in rest], shards - len(alone))
            finer = _undecided(rest, shards - len(alone), capacity)
        if not finer:
            cuts = _cut(rest, shards - len(alone), capacity)
            return Plan(capacity, cuts, [s.low if s.bits == 64 else _only(sized, s) for s in alone])
        bits = min(s.bits for s in finer)
        finer = [s for s in finer if s.bits == bits]
        more = max(1, (limit // len(finer)).bit_length() - 1)
        pieces = _stretches(sized, _in_any(finer), min(64, bits + more))
        line = sorted([*set(line).difference(finer), *pieces], key=lambda s: s.low)


def _only(sized: DataFrame, stretch: Stretch) -> int:
    return sized.filter(F.col("_hash").between(stretch.low, stretch.high)).agg(F.max("_hash")).first()[0]


def _in_any(stretches: list[Stretch]) -> Column:
    """Neighbouring stretches are one range, so there is about one range per cut."""
    ranges: list[list[int]] = []
    for s in sorted(stretches, key=lambda s: s.low):
        if ranges and ranges[-1][1] + 1 == s.low:
            ranges[-1][1] = s.high
        else:
            ranges.append([s.low, s.high])
    return _any([F.col("_hash").between(low, high) for low, high in ranges])


def _any(conditions: list[Column]) -> Column:
    """A balanced tree, which stays flat however many conditions there are."""
    if len(conditions) == 1:
        return conditions[0]
    half = len(conditions) // 2
    return _any(conditions[:half]) | _any(conditions[half:])


def _shard(plan: Plan) -> Column:
    in_line = reduce(lambda a, b: a + b, [(F.col("_hash") >= cut).cast("int") for cut in plan.cuts], F.lit(0))
    for i, group in enumerate(plan.alone):
        in_line = F.when(F.col("_hash") == group, F.lit(len(plan.cuts) + 1 + i)).otherwise(in_line)
    return in_line.cast("int")


def shard_documents(docs: DataFrame, shards: int = 40, limit: int = LIMIT) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot: copies of a text in one shard, bytes near equal.

    The size is the text's UTF-8 bytes and 16; a NULL text has no bytes, a NULL
    checksum, and all of them are one group. Repeated rows each get a slot; an
    empty table gives no rows. A group beyond an equal share has a shard of its
    own. Slots count from 0 in each shard, without gaps, in an order of hashes
    that mixes sources. Other columns of `docs` are left out.
    """
    sized = stage(
        docs.select(
            "doc_id",
            (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES).cast("bigint").alias("size"),
            F.crc32(F.encode("text", "UTF-8")).alias("text_crc32"),
            F.xxhash64("text").alias("_hash"),
        ),
        "sized",
    )
    placed = sized.withColumn("shard", _shard(plan_shards(sized, shards, limit)))
    numbered = surrogate_id(placed, ["shard", "_hash", "doc_id"], start=0, id_column="_place")
    # One row per shard.
    firsts = stage(numbered.groupBy("shard").agg(F.min("_place").alias("_first")), "shard_starts")
    return numbered.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("_place") - F.col("_first")).alias("slot")
    )
