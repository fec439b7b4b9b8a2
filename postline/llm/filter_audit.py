"""Interaction of text filters, by contractions of contingency tensors.

Every document passes or fails each of five filters. Per part, the documents
are counted in a tensor with one axis per filter (0: passes, 1: fails). What a
filter does at its place in an order is then a contraction: for each axis a
vector selects what passes (1, 0), what fails (0, 1) or all (1, 1). So the
documents are read once, and all orders are worked out from 32 counts a part.
"""

from collections.abc import Callable
from functools import cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postline.session import stage

FILTERS = "ABCDE"
PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)
WHITE_SPACE = r"[\x20\x09-\x0D]+"
LEAST_WORDS, LEAST_DISTINCT, MOST_UPPER = 50, 65, 5
MARKS = "[#$%&*|]"
COUNTS = ("n", "good", "toxic")
MADE = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def text_failures(text: Column) -> dict[str, Column]:
    """Whether the text fails A, B, C and D; NULL is an empty text."""
    whole = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(whole, WHITE_SPACE), lambda word: word != "")
    # A-Z are one byte each, and no byte of another character is one of theirs.
    upper = F.octet_length(whole) - F.octet_length(F.regexp_replace(whole, "[A-Z]+", ""))
    return {
        "A": F.size(words) < LEAST_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < LEAST_DISTINCT * F.size(words),
        "C": 100 * upper.cast("bigint") > MOST_UPPER * F.char_length(whole),
        "D": whole.rlike(MARKS),
    }


def _one_label_per_id(labels: DataFrame) -> DataFrame:
    """doc_id, good and toxic; an id with several labels has what any of them says."""
    known = labels.select(F.col("doc_id").alias("_id"), F.col("quality") == 1, F.col("toxic") == 1).toDF("_id", "_g", "_t")
    either = [F.coalesce(F.max(F.col(c).cast("int")), F.lit(0)).alias(name) for c, name in (("_g", "good"), ("_t", "toxic"))]
    return known.filter("_id IS NOT NULL").groupBy("_id").agg(*either)


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, A to E, good and toxic (1 or 0) of every document.

    E needs the smallest doc_id of each text. It is found per text, and met
    again under the text and the id together, so that a text with very many
    copies is many keys in that join.
    """
    flags = text_failures(F.col("text"))
    judged = docs.select(
        "doc_id",
        F.coalesce("source", F.lit("")).alias("part"),
        F.unhex(F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256)).alias("_text"),
        *[failed.alias(name) for name, failed in flags.items()],
    )
    judged = stage(judged, "judged")
    first = judged.groupBy("_text").agg(F.min("doc_id").alias("_first"))
    first = first.select(F.col("_text").alias("_its"), F.col("_first").alias("_id"))
    is_first = (F.col("_text") == F.col("_its")) & (F.col("doc_id") == F.col("_id"))
    repeated = F.col("doc_id").isNotNull() & F.col("_its").isNull()
    told = judged.join(first, is_first, "left").withColumn("E", repeated).drop("_its", "_id")
    known = told.join(_one_label_per_id(labels), F.col("doc_id") == F.col("_id"), "left")
    zero = F.lit(0)
    return known.select("part", *FILTERS, F.coalesce("good", zero).alias("good"), F.coalesce("toxic", zero).alias("toxic"))


@cache
def selectors(filters: int) -> tuple[list[tuple[int, ...]], dict[str, np.ndarray]]:
    """All orders of the axes, and per kind of count the (orders, steps, axes, 2) vectors that select it."""
    orders = list(permutations(range(filters)))
    shape = (len(orders), filters, filters, 2)
    made = {name: np.empty(shape, np.int64) for name in ("kept", "removed", "failing", "unique")}
    for i, order in enumerate(orders):
        for step, axis in enumerate(order):
            before = order[:step]
            for other in range(filters):
                made["kept"][i, step, other] = PASS if other in before or other == axis else ALL
                made["removed"][i, step, other] = FAIL if other == axis else PASS if other in before else ALL
                made["failing"][i, step, other] = FAIL if other == axis else ALL
                made["unique"][i, step, other] = FAIL if other == axis else PASS
    return orders, made


def contract(tensor: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """(orders, steps): the tensor, 2 along each axis, added up over what the vectors select."""
    axes = "abcdefgh"[: tensor.ndim]
    vectors = [chosen[:, :, axis] for axis in range(tensor.ndim)]
    return np.einsum(f"{axes},{','.join(f'xy{a}' for a in axes)}->xy", tensor, *vectors, optimize=True)


def audit_tensors(tensors: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The (orders, steps) counts of a part from its tensors of all, good and toxic documents."""
    orders, chosen = selectors(tensors["n"].ndim)
    removed = contract(tensors["n"], chosen["removed"])
    axes = np.array(orders)
    shapley = np.zeros(axes.shape[1], np.int64)
    np.add.at(shapley, axes, removed)
    return {
        "kept": contract(tensors["n"], chosen["kept"]),
        "removed": removed,
        "redundant": contract(tensors["n"], chosen["failing"]) - removed,
        "unique_fails": contract(tensors["n"], chosen["unique"]),
        "good_lost": contract(tensors["good"], chosen["removed"]),
        "toxic_lost": contract(tensors["toxic"], chosen["removed"]),
        "shapley": shapley[axes],
    }


def audit_orders(failed: DataFrame, part: str = "part", filters: str = FILTERS) -> DataFrame:
    """part, filter_order, step and counts (see `MADE`) for every part, order of the filters and step.

    `failed` has a column per filter, true where a row fails it, and the
    weights good and toxic. A filter's name is one letter. NULL for a filter
    is a pass, NULL for the part a part of its own. Rows are added up before
    they are shuffled; a part is then a row per cell of its tensor at most.
    """
    cells = failed.groupBy(F.col(part).alias("part"), *[F.coalesce(F.col(f), F.lit(False)).alias(f) for f in filters]).agg(
        F.count(F.lit(1)).alias("n"), F.sum("good").cast("bigint").alias("good"), F.sum("toxic").cast("bigint").alias("toxic")
    )
    names = ["".join(filters[axis] for axis in order) for order in permutations(range(len(filters)))]

    def one_part(table: pa.Table) -> pa.Table:
        place = tuple(table[f].to_numpy().astype(int) for f in filters)
        tensors = {}
        for name in COUNTS:
            tensors[name] = np.zeros((2,) * len(filters), np.int64)
            tensors[name][place] = table[name].to_numpy()
        counts = audit_tensors(tensors)
        rows = len(names) * len(filters)
        columns = {
            "part": pa.array([table["part"][0].as_py()] * rows, pa.string()),
            "filter_order": pa.array(np.repeat(names, len(filters))),
            "step": pa.array(np.tile(np.arange(1, len(filters) + 1, dtype=np.int32), len(names))),
        }
        return pa.table(columns | {name: pa.array(counts[name].ravel()) for name in MADE})

    schema = "part string, filter_order string, step int, " + ", ".join(f"{name} bigint" for name in MADE)
    return cells.groupBy("part").applyInArrow(one_part, schema)


def audit(docs: DataFrame, labels: DataFrame, failing: Callable[[DataFrame, DataFrame], DataFrame] = failures) -> DataFrame:
    """The audit of `failing` over the documents, a part per source.

    A NULL source is the empty one, a NULL text an empty one: no words, so it
    fails A alone, and E behind the first. A document without doc_id fails E
    never and makes no other fail it; repeated rows of one doc_id are all
    counted, and the smallest id of a text stays whole. An id with several
    labels is good or toxic if any says so; without a label it is neither. An
    empty table has no parts and gives no rows. Other columns are left out.
    """
    return audit_orders(failing(docs.select("doc_id", "text", "source"), labels.select("doc_id", "quality", "toxic")))


AUDIT_SQL = f"""
WITH words AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
flags AS (
  SELECT doc_id, part,
         (len(w) < {LEAST_WORDS})::INT AS a,
         (100 * len(list_distinct(w)) < {LEAST_DISTINCT} * len(w))::INT AS b,
         (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > {MOST_UPPER} * length(t))::INT AS c,
         regexp_matches(t, '{MARKS}')::INT AS d,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS e FROM words),
known AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
cells AS (
  SELECT part, a + 2 * b + 4 * c + 8 * d + 16 * e AS bits, count(*) AS n,
         sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM flags LEFT JOIN known USING (doc_id) GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
  SELECT p.f || q.f || r.f || s.f || t.f AS filter_order, [p.bit, q.bit, r.bit, s.bit, t.bit] AS bits
  FROM letters p, letters q, letters r, letters s, letters t WHERE p.bit + q.bit + r.bit + s.bit + t.bit = 31
       AND len(list_distinct([p.bit, q.bit, r.bit, s.bit, t.bit])) = 5),
steps AS (
  SELECT filter_order, step::INT AS step, bits[step] AS own, coalesce(list_sum(list_slice(bits, 1, step - 1)), 0)::INT AS before
  FROM orders, range(1, 6) AS r(step)),
counted AS (
  SELECT part, filter_order, step, own,
         coalesce(sum(n) FILTER ((bits & (before | own)) = 0), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER ((bits & before) = 0 AND (bits & own) <> 0), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER ((bits & before) <> 0 AND (bits & own) <> 0), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (bits = own), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER ((bits & before) = 0 AND (bits & own) <> 0), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER ((bits & before) = 0 AND (bits & own) <> 0), 0)::BIGINT AS toxic_lost
  FROM cells, steps GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM counted"""
