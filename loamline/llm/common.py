"""What the operators of this subpackage share: tables in the shared folder, size-checked broadcasts."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.session import shared_dir, ship

#: Rows, and bytes as written, of a table that may be broadcast; beyond either the joins shuffle.
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 16 << 20
#: Bytes, as shuffled, of a partition that a join may hold in memory; some three times that unpacked.
HASHED_BYTES = 64 << 20


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/loamline/{name}-{uuid.uuid4().hex}"


@contextmanager
def set_to(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """What runs inside has this setting of the session."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def short_shuffles(spark: SparkSession):
    """What runs inside leaves no shuffle files behind: they go when its last stage has ended, not when the driver
    happens to collect its garbage."""
    return set_to(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def hash_joins(spark: SparkSession):
    """What runs inside joins without sorting where each partition, as it was shuffled, is of at most HASHED_BYTES."""
    return set_to(spark, "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", str(HASHED_BYTES))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a table in the shared folder and reads it back: lineage ends there, lost executors or not."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    with short_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def _path(spark: SparkSession, name: str):
    """A path and its file system, whatever that is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def discard(*tables: DataFrame) -> None:
    """Deletes tables that materialize() wrote and that nothing reads any more."""
    for t in tables:
        path, store = _path(t.sparkSession, t.written_at)
        store.delete(path, True)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hints a broadcast only if df (already materialized) has at most `rows` rows and BROADCAST_BYTES; else Spark shuffles."""
    if (at := vars(df).get("written_at")) and _path(df.sparkSession, at)[1].getContentSummary(_path(df.sparkSession, at)[0]).getLength() > BROADCAST_BYTES:
        return df
    return F.broadcast(df) if df.count() <= rows else df


def trimmed(of: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """of, a function over a task's batches, whose worker hands freed memory back when the task has ended."""

    def run(batches: Iterator) -> Iterator:
        import ctypes

        import pyarrow as pa

        yield from of(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):  # another C library
            pass

    return run


def columns(df: DataFrame, *names: str) -> DataFrame:
    """The named columns of df by exact name, whatever else df has; absent ones are null."""
    have = set(df.columns)
    return df.select(*[df[f"`{n}`"] if n in have else F.lit(None).alias(n) for n in names])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
