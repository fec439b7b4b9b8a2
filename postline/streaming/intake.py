"""Process what has landed since the last run, each file once, each post once.

The scheduled run in stream form: the source remembers which landing files it
has read, so a run without new files does nothing. Collections overlap: a post
comes again in later files, in other micro-batches and in later runs. The
state of the stream has the posts that were collected within a delay of the
newest collection seen, and lets a post through once.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from postline import fixed_values as fixed
from postline import schemas
from postline.operators.posts import transform_posts
from postline.sources.landing import READ_OPTIONS
from postline.sources.processed import by_date

FILES_PER_BATCH = 10_000


def watch_landing(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    return (
        spark.readStream.schema(schema)
        .options(
            **READ_OPTIONS,
            pathGlobFilter=fixed.LANDING_GLOB,
            maxFilesPerTrigger=files_per_batch,
        )
        .csv(path)
    )


def first_of_posts(
    landed: DataFrame, delay: str, keys: list[str] = schemas.POST_KEY, time: str = "collected_at"
) -> DataFrame:
    """The landed posts, each once: rows of a key that was seen within the delay are dropped.

    Time is that of the collection, so a post may be of any age. The watermark
    trails the newest collection of earlier micro-batches by `delay`; a row
    collected before it is late and dropped, as it cannot be told from a copy
    (`late_rows` counts these). State is a row per post within the delay. Every
    row must have a key and a time; rows without stay out of the stream's state
    and are processed by `process_landed` without this.
    """
    known = landed.filter(F.col(time).isNotNull()).dropna(subset=keys)
    return known.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def late_rows(query: StreamingQuery) -> int:
    """Rows that a run has dropped as late."""
    return sum(op["numRowsDroppedByWatermark"] for progress in query.recentProgress for op in progress["stateOperators"])


def process_landed(landed: DataFrame, path: str, state: str) -> StreamingQuery:
    """Clean the landed posts into the processed zone, then stop.

    Each micro-batch writes its own folder and replaces it if it is repeated
    after a failure, so every landed row is processed exactly once. `state` is
    a shared folder that stays between runs.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        by_date(batch).write.mode("overwrite").partitionBy("date").parquet(
            f"{path.rstrip('/')}/load={batch_id}"
        )

    return (
        transform_posts(landed)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )


def read_intake(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All processed rows, without the folder number."""
    dated = T.StructType([*schema.fields, T.StructField("date", T.DateType())])
    return spark.read.schema(dated).option("basePath", path).parquet(path).select(*dated.fieldNames())
