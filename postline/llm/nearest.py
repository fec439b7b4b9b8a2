"""Approximate nearest neighbours by inner product, with cross-polytope hashing.

A vector is turned by a fast pseudo-rotation (three rounds of random signs and
a Hadamard transform) and belongs to the cell of the signed axis nearest to it.
Several rotations give as many tables; a query looks into the cells of the axes
nearest to it in each (multiprobe), and what it meets there is ranked by the
exact inner product in double precision.

Cells go by direction. Rows are cut into bands of like length, in which the
nearest by direction are about the nearest by product, and every band is
searched. How many tables and cells of a band are looked into follows from one
rule: the least work with which a row as near as the last of an answer, were
the band's rows spread evenly, is missed with a chance of MISS at most. In a
band of few rows that is all of it; it is never more than all of it. Queries
that still meet fewer rows than an answer can hold are answered exactly,
against all rows.

All rows are indexed. A vector that many ids have counts for as many of them,
the smallest, as an answer can hold. Cells are cut into chunks and
queries too, so that a task gets at most one chunk of each.
"""

import math
from dataclasses import dataclass
from functools import cache
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postline.llm.batches import map_text
from postline.session import stage

NEAREST = 20
TABLES = 10
MISS = 0.1
ROUNDS = 3
SEED = 5
CHUNK = 4096
QUERY_CHUNK = 1024
# Ratio of the lengths in a band.
BAND = 2**0.25
# Pairs of vectors by which the chance of a miss is found.
TRIALS = 4000


def hadamard(x: np.ndarray) -> np.ndarray:
    """The transform of each row; the number of columns is a power of two."""
    rows, n = x.shape
    half = 1
    while half < n:
        pairs = x.reshape(rows, -1, 2, half)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(rows, n)
        half *= 2
    return x / math.sqrt(n)


def signs(tables: int, size: int) -> np.ndarray:
    return np.random.default_rng(SEED).choice(np.array([-1.0, 1.0]), (tables, ROUNDS, size))


def rotated(x: np.ndarray, flips: np.ndarray) -> np.ndarray:
    for flip in flips:
        x = hadamard(x * flip)
    return x


def cells(x: np.ndarray, flips: np.ndarray, probes: int) -> np.ndarray:
    """(rows, tables * probes): numbers of the cells of the signed axes nearest to each row, table by table."""
    size = x.shape[1]
    found = []
    for table, flip in enumerate(flips):
        turned = rotated(x, flip)
        both = np.concatenate([turned, -turned], axis=1)
        best = both.argmax(axis=1)[:, None] if probes == 1 else np.argpartition(-both, probes - 1, axis=1)[:, :probes]
        found.append(best + table * 2 * size)
    return np.concatenate(found, axis=1)


@cache
def _trials(size: int) -> tuple[np.ndarray, ...]:
    """Random unit vectors, others at a right angle to them, and the signed axes nearest to the first."""
    rng = np.random.default_rng(SEED)
    first, second = rng.normal(size=(2, TRIALS, size))
    first /= np.linalg.norm(first, axis=1, keepdims=True)
    second -= (second * first).sum(axis=1, keepdims=True) * first
    second /= np.maximum(np.linalg.norm(second, axis=1, keepdims=True), 1e-300)
    return first, second, np.concatenate([first, -first], axis=1).argmax(axis=1)


@dataclass(frozen=True)
class Search:
    """The tables of a band and the cells that are looked into in each; with one table and no cells, all of the band."""

    tables: int
    probes: int


@cache
def plan_search(rows: int, dims: int, size: int, most: int, tables: int, miss: float) -> Search:
    """The search of least work, counted in products a row and query."""
    everything = Search(1, 0)
    share = 1 - most / rows
    if share <= 0.5 or not miss:
        return everything
    # The cosine that `most` of so many evenly spread vectors exceed.
    near = min(0.999, NormalDist().inv_cdf(share) / math.sqrt(dims))
    row, aside, cell = _trials(size)
    query = near * row + math.sqrt(1 - near * near) * aside
    both = np.concatenate([query, -query], axis=1)
    rank = (both > np.take_along_axis(both, cell[:, None], axis=1)).sum(axis=1)
    missed = 1 - np.cumsum(np.bincount(rank, minlength=2 * size)) / TRIALS
    found = [Search(t, 1 + int(np.argmax(missed**t <= miss))) for t in range(1, tables + 1)]
    best = min(found, key=lambda s: (s.tables * s.probes, s.tables))
    return best if best.tables * best.probes < 2 * size else everything


def _matrix(column: pa.ListArray, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size).astype(np.float64)


def _valid(vectors: DataFrame) -> DataFrame:
    usable = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    nonzero = F.exists("embedding", lambda x: x != 0)
    found = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    return found.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & usable & nonzero)


def _with_cells(vectors: DataFrame, keep: list[str], dims: int, tables: int, cells_of) -> DataFrame:
    """The kept columns, embedding and cells: what `cells_of` makes of unit vectors and the sign flips, row by row."""
    size = 1 << max(0, dims - 1).bit_length()

    def start():
        flips = signs(tables, size)

        def apply(lists: list) -> list:
            x = np.array(lists, np.float64).reshape(-1, dims)
            x /= np.abs(x).max(axis=1, keepdims=True)
            padded = np.zeros((len(x), size))
            padded[:, :dims] = x / np.linalg.norm(x, axis=1, keepdims=True)
            return [list(cells_of(padded, flips))]

        return apply

    return map_text(vectors, "embedding", [*keep, "embedding"], "cells array<bigint>", start, read=2048)


def _banded(index: DataFrame) -> DataFrame:
    """The rows with `_band`: the logarithm of the length."""
    length = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x))
    band = F.coalesce(F.floor(F.log(length) / math.log(BAND) + 0.5).cast("bigint"), F.lit(-(1 << 62)))
    return index.withColumn("_band", band)


def _best(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, most: int) -> tuple:
    """The `most` nearest ids of each query, each with its nearest row, with all ties at the end; scores do not depend on the chunk."""
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    heads = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
    products = q @ x.T
    of_ids = products if len(heads) == len(ids) else np.maximum.reduceat(products, heads, axis=1)
    if len(heads) > most:
        least = np.partition(of_ids, len(heads) - most, axis=1)[:, len(heads) - most]
        keep = products >= (least - 1e-9 * np.maximum(1, np.abs(least)))[:, None]
    else:
        keep = np.ones(products.shape, bool)
    rows, columns = np.nonzero(keep)
    scores = np.einsum("ij,ij->i", q[rows], x[columns])
    order = np.lexsort((-scores, ids[columns], rows))
    rows, columns, scores = rows[order], columns[order], scores[order]
    if len(heads) < len(ids):
        nearest_row = np.r_[True, (rows[1:] != rows[:-1]) | (ids[columns[1:]] != ids[columns[:-1]])]
        rows, columns, scores = rows[nearest_row], columns[nearest_row], scores[nearest_row]
    order = np.lexsort((ids[columns], -scores, rows))
    rows, columns, scores = rows[order], columns[order], scores[order]
    rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
    first = rank < most
    return query_ids[rows[first]], ids[columns[first]], scores[first]


def nearest(
    vectors: DataFrame, queries: DataFrame, most: int = NEAREST, tables: int = TABLES, miss: float = MISS
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the nearest found of each query, its own vec_id left out.

    With `miss` 0 the answer is exact. Vectors that are NULL, zero, or hold
    NULL or non-finite components take no part, nor do rows without vec_id or
    with another number of components than most have. Ties go to the smaller
    vec_id. Repeated rows count once; a vec_id with several vectors counts with
    its nearest one, as a candidate and as a query: ranks come once. Queries
    without any candidate, and empty tables, give no rows. Other columns are
    left out.
    """
    usable = _valid(vectors)
    shapes = usable.groupBy(F.size("embedding").alias("dims")).agg(F.count(F.lit(1)).alias("n"))
    shape = shapes.orderBy(F.desc("n"), "dims").first()
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if shape is None:
        return vectors.sparkSession.createDataFrame([], schema)
    dims = shape["dims"]
    size = 1 << max(0, dims - 1).bit_length()

    # With its own id, `most` more of one vector's ids may be in an answer; ahead of the shuffle each task keeps no more.
    copies = Window.partitionBy("embedding").orderBy("vec_id")
    once = usable.filter(F.size("embedding") == dims).distinct()
    index = once.withColumn("_copy", F.row_number().over(copies)).filter(F.col("_copy") <= most + 1).drop("_copy")
    index = stage(_banded(index), "bands")
    # A few bands per power of two of the lengths.
    counts = {row["_band"]: row["n"] for row in index.groupBy("_band").agg(F.count(F.lit(1)).alias("n")).collect()}
    plans = {band: plan_search(n, dims, size, most, tables, miss) for band, n in counts.items()}
    stride = tables * 2 * size
    first_cell = {band: i * stride for i, band in enumerate(sorted(plans))}

    def own_cells(search: Search, first: int):
        def cells_of(x: np.ndarray, flips: np.ndarray) -> np.ndarray:
            if not search.probes:
                return np.full((len(x), 1), first, np.int64)
            return first + cells(x, flips[: search.tables], 1)

        return cells_of

    def probed_cells(x: np.ndarray, flips: np.ndarray) -> np.ndarray:
        found = {search: cells(x, flips[: search.tables], search.probes) for search in {*plans.values()} if search.probes}
        whole = np.zeros((len(x), 1), np.int64)
        return np.concatenate([first + found.get(plans[band], whole) for band, first in first_cell.items()], axis=1)

    # The rows of bands that are searched alike are hashed in one pass; a band's first cell is added to theirs.
    indexed = None
    for search in sorted({*plans.values()}, key=lambda s: (s.tables, s.probes)):
        own = [band for band in plans if plans[band] == search]
        hashed = _with_cells(index.filter(F.col("_band").isin(own)), ["vec_id", "_band"], dims, tables, own_cells(search, 0))
        starts = F.create_map(*[F.lit(x) for band in own for x in (band, first_cell[band])])
        moved = hashed.withColumn("cells", F.transform("cells", lambda c: c + F.element_at(starts, F.col("_band"))))
        indexed = moved if indexed is None else indexed.unionByName(moved)
    indexed = stage(indexed.select("vec_id", "embedding", "cells"), "indexed")

    asked = stage(_valid(queries).filter(F.size("embedding") == dims).distinct(), "queries")
    distinct = stage(asked.select("embedding").distinct().withColumn("_q", F.monotonically_increasing_id()), "distinct_queries")
    probing = stage(_with_cells(distinct, ["_q"], dims, tables, probed_cells), "probing")

    def chunks(rows: DataFrame, name: str, chunk: int) -> DataFrame:
        counts = rows.select(F.explode("cells").alias("cell")).groupBy("cell").count()
        return counts.select("cell", F.ceil(F.col("count") / chunk).alias(name))

    def dealt(rows: DataFrame, key: str, met: DataFrame, own: str, own_chunk: str, other: str, other_chunk: str) -> DataFrame:
        each = rows.select(key, "embedding", F.explode("cells").alias("cell")).join(met, "cell")
        return each.select(
            key, "embedding", "cell",
            F.pmod(F.xxhash64(key), F.col(own)).alias(own_chunk),
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(other) - 1)).alias(other_chunk),
        )

    def meet(rows: pa.Table, questions: pa.Table) -> pa.Table:
        if not rows.num_rows or not questions.num_rows:
            query, found, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        else:
            x, q = (_matrix(table["embedding"].combine_chunks(), dims) for table in (rows, questions))
            query, found, score = _best(rows["vec_id"].to_numpy(), x, questions["_q"].to_numpy(), q, most + 1)
        return pa.table({"_q": query, "vec_id": found, "score": score})

    def answers(indexed: DataFrame, probing: DataFrame) -> DataFrame:
        """_q, answers: the best of what the vectors of `probing` meet in their cells."""
        met = stage(chunks(indexed, "_i", CHUNK).join(chunks(probing, "_a", QUERY_CHUNK), "cell"), "cells")
        keys = ["cell", "_ic", "_ac"]
        left = dealt(indexed, "vec_id", met, "_i", "_ic", "_a", "_ac").groupBy(*keys)
        right = dealt(probing, "_q", met, "_a", "_ac", "_i", "_ic").groupBy(*keys)
        found = left.cogroup(right).applyInArrow(meet, "_q bigint, vec_id bigint, score double")
        once = found.repartition("_q").groupBy("_q", "vec_id").agg(F.max("score").alias("score"))
        by_score = Window.partitionBy("_q").orderBy(F.desc("score"), "vec_id")
        ranked = once.withColumn("_rank", F.row_number().over(by_score)).filter(F.col("_rank") <= most + 1)
        return ranked.groupBy("_q").agg(F.collect_list(F.struct("vec_id", "score")).alias("answers"))

    found = stage(answers(indexed, probing), "found")
    most_found = indexed.select("vec_id").distinct().limit(most + 1).count()
    full = found.filter(F.size("answers") >= most_found)
    every = F.array(F.lit(-1).cast("bigint"))
    short = stage(probing.join(full, "_q", "left_anti").withColumn("cells", every), "short")
    if most_found and not short.isEmpty():
        full = full.unionByName(answers(indexed.withColumn("cells", every), short))
    # An id with several vectors has the best of their answers.
    named = asked.select(F.col("vec_id").alias("query_id"), "embedding").join(distinct, "embedding").select("query_id", "_q")
    each = named.join(full, "_q").select("query_id", F.inline("answers")).filter(F.col("vec_id") != F.col("query_id"))
    best = each.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
