"""Connected components of links, by alternating large and small stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postline.session import stage


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Hang each node's greater (large star) or smaller (small star) neighbours on its smallest one.

    The minimum of a node is aggregated ahead of the shuffle, and stored before
    it meets the links: then both sides of the join are plain shuffles, of which
    adaptive execution splits the parts of a node with very many links, or the
    minima are small and no link is shuffled.
    """
    sides = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else links
    least = stage(sides.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least")), "least")
    joined = sides.join(least, "a")
    if large:
        hung = joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        hung = joined.select(F.explode(F.array("a", "b")).alias("a"), F.col("least").alias("b"))
    return hung.filter(F.col("a") > F.col("b")).distinct()


def _print_of(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node that a link (a, b) of two bigints names, root the smallest reachable node.

    Links may repeat, in either direction, or join a node to itself. The rounds
    grow with the logarithm of the longest chain; each is stored, so that
    lineage stays short and lost executors cost one round.
    """
    ordered = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = stage(ordered.filter(F.col("a") > F.col("b")).distinct(), "links")
    before = _print_of(links)
    while before[0]:
        links = stage(_star(_star(links, True), False), "links")
        now = _print_of(links)
        if now == before:
            break
        before = now
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
