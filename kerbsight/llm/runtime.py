"""What the operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
import sys
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def crc_bucket(id_col: str, n: int = 5):
    """crc32 of the id written as text, modulo ``n``."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % n


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of input, as Spark sizes it, for which there is at least one partition.
PARTITION_BYTES = 256 << 20
#: From so many bytes on a size is Spark's word for an unknown one.
UNKNOWN = 1 << 60


def partitions_for(df: DataFrame) -> int:
    """Into how many partitions work on ``df`` is cut: ``spark.sql.shuffle.partitions``, or more where its bytes ask for it.

    Its bytes are those of the files and tables that it reads, as the planner knows them; rows that come from elsewhere
    have no known size and count as none. No job runs.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size())]
    size = sum(x for x in sizes if x < UNKNOWN)
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // PARTITION_BYTES))


#: Slots of the bitmap of wanted rows.
MARKS = 1 << 23


def flagged(rows: DataFrame, wanted: DataFrame, keys: list[str], flag: str) -> DataFrame:
    """Adds ``flag``: whether a row's keys may be among the wanted ones, by a broadcast bitmap of ``MARKS`` slots (1 MB).

    No wanted key is missed; others are flagged where they share a slot with one.
    """
    part, place, bits = unused([*rows.columns, *keys, flag], "_part", "_place", "_bits")
    slot = F.pmod(F.xxhash64(*keys), F.lit(MARKS)) + 1
    number, position = F.bitmap_bucket_number(slot), F.bitmap_bit_position(slot)
    maps = wanted.groupBy(number.alias(part)).agg(F.bitmap_construct_agg(position).alias(bits))
    byte = F.conv(F.hex(F.substring(F.col(bits), F.floor(F.col(place) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.coalesce(F.floor(byte / F.pow(F.lit(2), F.col(place) % 8)) % 2 == 1, F.lit(False))
    return rows.withColumns({part: number, place: position}).join(F.broadcast(maps), part, "left").withColumn(flag, bit).drop(part, place, bits)


def marked(rows: DataFrame, wanted: DataFrame, id_col: str) -> DataFrame:
    """Rows whose id may be among the wanted ones.

    A filter before a shuffled join on the id, so that texts of other rows mostly stay where they are.
    """
    (flag,) = unused([*rows.columns, id_col], "_flag")
    return flagged(rows, wanted, [id_col], flag).where(flag).drop(flag)


@contextlib.contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most so many rows for what runs within; whole texts make batches large, on both sides."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), rows) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def returned() -> None:
    """Gives memory that this Python worker no longer uses back to the machine; workers live on from stage to stage."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def lean(f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """A function for ``mapInArrow`` that gives memory back at the end of each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from f(batches)
        returned()

    return run


def unused(columns: Iterable[str], *names: str) -> list[str]:
    """The names, with as many underscores behind each as it takes not to be among the columns, in any case."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
