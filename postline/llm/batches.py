"""Running a numpy function over a column inside tasks, with bounded memory."""

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text held as Python strings at once; a single longer text is a chunk of its own.
CHUNK_CHARS = 2_000_000
SPAN = 1 << 40


def chunks(texts: list[str], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, list[str]]]:
    """Runs of whole texts of about `limit` characters, each with the place of its first text."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield first, texts[first:i]
            first, size = i, 0
        size += len(text)
    if first < len(texts):
        yield first, texts[first:]


def unused(df: DataFrame, name: str) -> str:
    """The name, with as many underscores in front as it takes to be no column of the frame."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def map_text(
    df: DataFrame,
    text: str,
    keep: list[str],
    schema: str,
    function: Callable[[], Callable[[list[str | None]], list[Iterable]]],
    read: int = 256,
) -> DataFrame:
    """The kept columns and what `function` makes of the text column, row by row.

    `function` is called once per task and returns the function from texts to
    one sequence per column of `schema`. A row gives a row, so nothing is
    matched by key and repeated or NULL ids do no harm. `read` rows at a time
    are taken from a batch, so that long texts do not pile up.
    """
    made = T._parse_datatype_string(schema)
    names = keep if text in keep else [*keep, text]
    kept = df.select(*[F.col(f"`{name}`").alias(f"_k{i}") for i, name in enumerate(names)])
    out = T.StructType([*kept.schema.fields[: len(keep)], *made.fields])
    source = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        apply = function()
        arrow = to_arrow_schema(out)
        for batch in batches:
            for start in range(0, batch.num_rows, read):
                part = batch.slice(start, read)
                columns = apply(part.column(source).to_pylist())
                arrays = [
                    column if isinstance(column, pa.Array) else pa.array(column, type=field.type)
                    for column, field in zip(columns, list(arrow)[len(keep) :], strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in range(len(keep))), *arrays],
                    names=[field.name for field in out],
                )

    result = kept.mapInArrow(run, out)
    return result.select(*[F.col(f"_k{i}").alias(name) for i, name in enumerate(keep)], *made.names)


# Slots that keys are thrown into; a set of slots is broadcast, and this bounds it.
SLOTS = 1 << 20


def slot(hashed: Column) -> Column:
    return F.pmod(hashed, F.lit(SLOTS))


def with_slots(df: DataFrame, hashed: Column, keys: DataFrame, key: str, how: str) -> DataFrame:
    """The rows of `df` that may have (left_semi), or surely do not have (left_anti), one of the keys.

    Keys are hashes. Only their slots are broadcast, SLOTS rows at most, so wide
    rows that meet no key are told apart without a shuffle. With very many keys
    all slots are taken and no row is told apart; what follows must be exact.
    """
    taken = unused(df, "_slot")
    slots = keys.select(slot(F.col(key)).alias(taken)).distinct()
    return df.join(F.broadcast(slots), slot(hashed) == F.col(taken), how)


def place(*columns: str) -> Column:
    """A number from 0 to SPAN - 1 that the columns' values decide, evenly spread."""
    return F.pmod(F.xxhash64(*[F.col(f"`{name}`").cast("string") for name in columns]), F.lit(SPAN))


def sample_rows(df: DataFrame, key: str, most: int) -> DataFrame:
    """At most `most` rows, those with the smallest places of the key: the same ones on every run.

    Cut to a little more than that by the place alone first, so that no task sorts or sends many rows.
    """
    share = min(1.0, 1.5 * most / max(1, df.count()) + 1e-6)
    few = df.filter(place(key) < F.lit(int(share * SPAN)))
    return few.orderBy(place(key), key).limit(most)
