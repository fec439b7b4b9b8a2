"""Near-duplicates by SimHash, compared in bit planes.

Fingerprints within a radius are linked. Of the blocks that the bits are cut
into, two fingerprints within the radius agree in all but `radius`; so they
meet in the table of one choice of blocks, and none is missed. What meets is
compared in bit planes (`bitslice`); classes are the components of the links.

A group of rows that meet is cut into chunks, and every two chunks meet in a
group of their own; no task gets more than two chunks of one group. From a
group come only as many links as connect what it has connected.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postline.llm.batches import map_text, unused, with_slots
from postline.llm.bitslice import close_pairs, stars
from postline.llm.components import components
from postline.session import stage

SEED = 42
BITS = 64
# Rows of one chunk of a group; a task compares two.
CHUNK = 256
# Rows that a task compares at once, whole groups.
PACK = 1 << 15
# Expected rows that meet by chance in a table of blocks.
CROWD = 64


def words_of(text: str | None) -> list[bytes]:
    """The words of the text with A-Z lower-cased, cut at ASCII white space."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """XXH64 of each run of `size` words, joined by spaces; of all words, if they are fewer."""
    if not words:
        return np.zeros(0, np.uint64)
    line, ends, at = b" ".join(words), [], -1
    for word in words:
        at += len(word) + 1
        ends.append(at)
    n = max(1, len(words) - size + 1)
    starts = [0, *(end + 1 for end in ends[: n - 1])]
    digest = xxhash.xxh64_intdigest
    stops = ends[min(size, len(words)) - 1 :]
    return np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts, stops, strict=True)), np.uint64, n)


def simhash(hashes: np.ndarray) -> int:
    """64 bits, as a signed number: a bit is 1 if it is set in more than half of the hashes."""
    counts = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 1 << 16):
        part = hashes[start : start + (1 << 16)]
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, keep: list[str], shingle_words: int = 4, text: str = "text") -> DataFrame:
    """The kept columns and `print`, the 64-bit SimHash as a bigint; 0 for a text without words."""

    def start():
        return lambda texts: [[simhash(shingle_hashes(words_of(t), shingle_words)) for t in texts]]

    return map_text(docs, text, keep, "print bigint", start)


def _masks(radius: int, rows: int) -> list[int]:
    """The bits of each table: choices of blocks such that any two prints within the radius agree on one.

    More blocks make longer keys and more tables; there are as many as keep
    groups near CROWD rows, which changes the work and not the result.
    """
    blocks = radius + 1
    while 2 ** (BITS * (blocks - radius) // blocks) * CROWD < rows and blocks < radius + 6:
        blocks += 1
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    bits = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(blocks)]
    return [sum(chosen) for chosen in combinations(bits, blocks - radius)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _meetings(rows: DataFrame, keys: list[str], member: Column) -> DataFrame:
    """The rows with `_meet`, a number per pair of chunks of their key; keys with one row are left out.

    A key with rows for c chunks makes c (c - 1) / 2 meetings, of two chunks each.
    """
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1")
    chunks = F.ceil(F.col("_rows") / CHUNK)
    own = F.pmod(F.xxhash64(member), chunks)
    others = F.when(chunks == 1, F.array(F.lit(0).cast("bigint"))).otherwise(
        F.array_remove(F.sequence(F.lit(0).cast("bigint"), chunks - 1), own)
    )
    met = rows.join(sizes, keys).withColumn("_own", own).withColumn("_other", F.explode(others))
    pair = F.struct(F.least("_own", "_other"), F.greatest("_own", "_other"))
    return met.withColumn("_meet", F.xxhash64(*keys, pair)).drop("_rows", "_own", "_other")


def _packs(batches: Iterator[pa.RecordBatch], at_most: int) -> Iterator[pd.DataFrame]:
    """Whole runs of equal `_meet`, about `at_most` rows at a time."""
    held: list[pd.DataFrame] = []
    size = 0
    for batch in batches:
        frame = batch.to_pandas()
        held.append(frame)
        size += len(frame)
        if size >= at_most:
            frame = pd.concat(held, ignore_index=True)
            last = int(np.searchsorted(frame["_meet"].to_numpy(), frame["_meet"].iloc[-1]))
            if last:
                yield frame[:last]
            held, size = [frame[last:].reset_index(drop=True)], len(frame) - last
    if size:
        yield pd.concat(held, ignore_index=True)


def _group_numbers(meet: np.ndarray) -> np.ndarray:
    return np.cumsum(np.r_[0, (meet[1:] != meet[:-1]).astype(int)])


def _dealt(meetings: DataFrame) -> DataFrame:
    return meetings.repartition("_meet").sortWithinPartitions("_meet")


def _link_near(meetings: DataFrame, prints: list[str], node: str, radius: int) -> DataFrame:
    """Links (a, b) that connect, within each meeting, the rows within the radius."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in _packs(batches, PACK):
            words = frame[prints].to_numpy().view(np.uint64)
            first, second = close_pairs(words, _group_numbers(frame["_meet"].to_numpy()), radius)
            root = stars(len(frame), first, second)
            moved = np.flatnonzero(root != np.arange(len(frame)))
            nodes = frame["_node"].to_numpy()
            yield pa.RecordBatch.from_pydict({"a": nodes[moved], "b": nodes[root[moved]]})

    dealt = _dealt(meetings.select("_meet", *prints, F.col(node).alias("_node")))
    return dealt.mapInArrow(run, "a bigint, b bigint").distinct()


def _classes(distinct: DataFrame, radius: int) -> DataFrame:
    """print and root, a number per class, of stored rows with a `print` of their own each."""
    tables = F.array(
        *[
            F.struct(F.lit(i).alias("table"), F.col("print").bitwiseAND(F.lit(_signed(mask))).alias("key"))
            for i, mask in enumerate(_masks(radius, distinct.count()))
        ]
    )
    rows = distinct.select("print", F.inline(tables))
    links = _link_near(_meetings(rows, ["table", "key"], F.col("print")), ["print"], "print", radius)
    reached = stage(components(links), "components")
    rooted = distinct.join(reached, distinct["print"] == reached["node"], "left")
    return rooted.select("print", F.coalesce("root", "print").alias("root"))


def fingerprint_classes(docs: DataFrame, radius: int = 4, shingle_words: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: the smallest doc_id that links reach.

    Links join fingerprints that differ in `radius` bits or fewer, equal ones
    included. A NULL or blank text has fingerprint zero and is linked by it like
    any other. A NULL doc_id is no id: it is never a component_id, except
    that a component without any id has NULL. Repeated rows are all returned;
    an empty table gives no rows; other columns are left out.
    """
    printed = stage(fingerprints(docs.select("doc_id", "text"), ["doc_id"], shingle_words), "fingerprints")
    distinct = stage(printed.groupBy("print").agg(F.min("doc_id").alias("doc_id")), "distinct_prints")
    rooted = distinct.join(_classes(distinct, radius), "print")
    rooted = stage(rooted, "rooted_prints")
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    classes = stage(rooted.join(least, "root").select("print", "component_id"), "classes")
    hexed = F.lower(F.lpad(F.hex("print"), 16, "0"))
    return printed.join(classes, "print").select("doc_id", hexed.alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, radius: int = 4, shingle_words: int = 4) -> DataFrame:
    """The documents without all but one of each class of `fingerprint_classes`: that of the smallest doc_id stays.

    So of texts that are NULL or blank one stays. A NULL doc_id counts as the
    largest; of several texts of one doc_id, and of repeated rows, one stays.
    All columns are kept. An empty table gives no rows.
    """
    rows = docs.select("doc_id", F.xxhash64("text").alias("_raw"), "text")
    printed = stage(fingerprints(rows, ["doc_id", "_raw"], shingle_words), "fingerprints")
    counted = printed.groupBy("print", "doc_id", "_raw").agg(F.count(F.lit(1)).alias("n"))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_raw", "n")
    distinct = stage(counted.groupBy("print").agg(F.min(order).alias("first")), "distinct_prints")
    classed = distinct.join(_classes(distinct, radius), "print")
    kept = stage(classed.groupBy("root").agg(F.min("first").alias("first")).select("first.*"), "kept_texts")

    # Texts are matched with what goes, which is the smaller side; repeated rows that stay are added once.
    once = kept.filter("n = 1").select(F.col("doc_id").alias("_kid"), F.col("_raw").alias("_kraw"))
    is_kept = F.col("doc_id").eqNullSafe(F.col("_kid")) & (F.col("_raw") == F.col("_kraw"))
    gone = printed.select("doc_id", "_raw").distinct().join(once, is_kept, "left_anti")
    key, gone_id, gone_key = (unused(docs, name) for name in ("_key", "_gone_id", "_gone_key"))
    names = F.col("doc_id").alias(gone_id), F.col("_raw").alias(gone_key)
    gone = stage(gone.select(*names), "gone_texts")
    repeated = stage(kept.filter("n > 1").select(*names), "repeated_texts")
    named = docs.withColumn(key, F.xxhash64("text"))
    is_gone = F.col("doc_id").eqNullSafe(F.col(gone_id)) & (F.col(key) == F.col(gone_key))
    # Texts that surely stay are not shuffled.
    clear = with_slots(named, F.col(key), gone, gone_key, "left_anti")
    unclear = with_slots(named, F.col(key), gone, gone_key, "left_semi").join(gone, is_gone, "left_anti")
    stays = clear.unionByName(unclear)
    if not repeated.isEmpty():
        among = with_slots(named, F.col(key), repeated, gone_key, "left_semi")
        stays = stays.unionByName(among.join(repeated, is_gone, "left_semi").dropDuplicates(["doc_id", key]))
    return stays.select(*docs.columns)
