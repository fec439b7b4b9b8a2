"""Physical order of rows, and generated ids."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postline.session import stage

# monotonically_increasing_id puts the partition above this bit and the row below.
SLOT_BITS = 33


def sort_key_layout(
    df: DataFrame, sort_key: list[str], tie_break: list[str] | None = None, partitions: int | None = None
) -> DataFrame:
    """Ranges of the sort key, sorted within; the files then have narrow min/max statistics.

    The ranges are cut over the sort key and the tie-break together, so that a
    value that many rows share spreads over several partitions.
    """
    order = [*sort_key, *(tie_break or [])]
    ranged = df.repartitionByRange(*([partitions] if partitions else []), *order)
    return ranged.sortWithinPartitions(*order)


def surrogate_id(
    df: DataFrame,
    order: list[str],
    start: int = 1,
    id_column: str = "id",
    partitions: int | None = None,
) -> DataFrame:
    """Number the rows start, start+1, .. in an order without ties, with no gaps.

    The rows are sorted by range and stored with their place (partition, row
    within it). Only the number of rows per partition then passes through one
    task, to give each partition its first id. Storing comes before counting,
    so that both see the same ranges even if a task must be repeated.
    """
    placed = stage(
        sort_key_layout(df, order, partitions=partitions).withColumn(
            "_slot", F.monotonically_increasing_id()
        ),
        "placed",
    )
    partition = F.shiftright("_slot", SLOT_BITS)
    row = F.col("_slot").bitwiseAND(F.lit((1 << SLOT_BITS) - 1))
    sizes = placed.groupBy(partition.alias("_partition")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select(
        "_partition", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_first")
    )
    # One row per shuffle partition, whatever the size of the data.
    return (
        placed.withColumn("_partition", partition)
        .join(F.broadcast(firsts), "_partition")
        .select(
            (F.col("_first") + row + F.lit(start)).cast("bigint").alias(id_column), *df.columns
        )
    )
