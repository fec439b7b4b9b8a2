"""Folders of any store that Spark reads: size, presence, removal."""

from pyspark.sql import SparkSession

# Files that are packed, and about how many times their bytes they unpack to.
PACKED, UNPACKED = ".gz", 3

def _at(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    there = jvm.org.apache.hadoop.fs.Path(path)
    return there, there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    there, store = _at(spark, path)
    return store.exists(there)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that this package has written; nothing if it is not there."""
    there, store = _at(spark, path)
    store.delete(there, True)


def size_of(spark: SparkSession, glob: str) -> int:
    """Bytes of the files that the pattern names; packed ones, there or in the folders named, count for what they unpack to."""
    there, store = _at(spark, glob)
    found = store.globStatus(there) or []
    inside = store.globStatus(_at(spark, f"{glob.rstrip('/')}/*{PACKED}")[0]) or []
    packed = [one for one in (*found, *inside) if one.isFile() and one.getPath().getName().endswith(PACKED)]
    size = sum(store.getContentSummary(one.getPath()).getLength() for one in found)
    return size + (UNPACKED - 1) * sum(one.getLen() for one in packed)


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies in the folder, by name; nothing if it is not there."""
    there, store = _at(spark, path)
    return [one.getPath().getName() for one in store.listStatus(there)] if store.exists(there) else []
