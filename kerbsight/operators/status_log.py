"""An append-only status log with snapshots, so that reads touch the last snapshot and what came after it.

Entries are written in numbered batches, one folder each. Compaction folds a snapshot and the batches behind it into the
next snapshot, ``upto`` the last of them: the watermark below which no batch is read again. Nothing is changed in place: a
batch or snapshot that was being written when its job died has no ``_SUCCESS`` file, isn't read, and is written anew.

One writer appends and compacts; any number of readers may read meanwhile.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENTRY = "status string, processed_at timestamp"


class StatusLog:
    """Entries ``(id, status, processed_at)`` below a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str, id_col: str = "detection_id", id_type: str = "long"):
        self.spark, self.path, self.id_col = spark, path.rstrip("/"), id_col
        self.schema = f"`{id_col}` {id_type}, {ENTRY}"

    def _complete(self, kind: str, name: str) -> list[int]:
        """Numbers of the folders of a kind that were written to the end, ascending. Only names are listed."""
        jvm = self.spark.sparkContext._jvm
        top = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}")
        fs = top.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(top):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(top) if s.isDirectory()]
        numbers = sorted(int(n.partition("=")[2]) for n in names if n.startswith(f"{name}="))
        return [k for k in numbers if fs.exists(jvm.org.apache.hadoop.fs.Path(top, f"{name}={k}/_SUCCESS"))]

    def _read(self, kind: str, name: str, numbers: list[int]) -> DataFrame:
        """Rows of these folders with their number as ``_batch``."""
        if not numbers:
            return self.spark.createDataFrame([], f"{self.schema}, _batch long")
        found = self.spark.read.schema(f"{self.schema}, `{name}` long").option("basePath", f"{self.path}/{kind}").parquet(*[f"{self.path}/{kind}/{name}={k}" for k in numbers])
        return found.withColumnRenamed(name, "_batch")

    def watermark(self) -> int:
        """The last batch that a snapshot holds; 0 without one."""
        return max(self._complete("snapshots", "upto"), default=0)

    def snapshot(self) -> DataFrame:
        """The status of every id up to the watermark, with the batch that set it."""
        upto = self.watermark()
        if not upto:
            return self._read("snapshots", "upto", [])
        return self.spark.read.schema(f"{self.schema}, _batch long").parquet(f"{self.path}/snapshots/upto={upto}")

    def tail(self) -> DataFrame:
        """Entries behind the watermark, with their batch."""
        upto = self.watermark()
        return self._read("entries", "batch", [k for k in self._complete("entries", "batch") if k > upto])

    def append(self, entries: DataFrame, batch: int | None = None) -> int:
        """Writes entries as a batch and returns its number, the next one if none is given.

        A batch that is there already is replaced, so that a repeated job leaves its entries once. Batches that a
        snapshot holds can't be replaced any more.
        """
        upto = self.watermark()
        if batch is None:
            batch = max([upto, *self._complete("entries", "batch")]) + 1
        if batch <= upto:
            raise ValueError(f"batch {batch} is part of the snapshot up to {upto}")
        rows = entries.select(*[F.col(f).alias(f) for f in (self.id_col, "status", "processed_at")]).to(self._type())
        rows.write.mode("overwrite").parquet(f"{self.path}/entries/batch={batch}")
        return batch

    def _type(self):
        return self.spark.createDataFrame([], self.schema).schema

    def _folded(self, rows: DataFrame) -> DataFrame:
        """The last entry of each id: by time, entries without one first, then by batch, then by status."""
        last = F.max_by(F.struct("status", "processed_at", "_batch"), F.struct("processed_at", "_batch", "status")).alias("e")
        return rows.where(F.col(self.id_col).isNotNull()).groupBy(self.id_col).agg(last).select(self.id_col, "e.*")

    def compact(self) -> int:
        """Folds snapshot and tail into the next snapshot and returns its watermark. Without a tail nothing is done."""
        upto = self.watermark()
        behind = [k for k in self._complete("entries", "batch") if k > upto]
        if not behind:
            return upto
        merged = self._folded(self.snapshot().unionByName(self._read("entries", "batch", behind)))
        merged.repartitionByRange(self.id_col).sortWithinPartitions(self.id_col).write.mode("overwrite").parquet(f"{self.path}/snapshots/upto={behind[-1]}")
        return behind[-1]

    def current(self) -> DataFrame:
        """``(id, status, processed_at)``: the last entry of every id, from snapshot and tail."""
        return self._folded(self.snapshot().unionByName(self.tail())).drop("_batch")

    def with_status(self, rows: DataFrame) -> DataFrame:
        """Rows with their current status, their own where the log has none.

        The tail is folded by itself; the snapshot, one row for each id, is joined as it is.
        """
        tag = lambda df, name: df.select(self.id_col, F.struct("processed_at", "_batch", "status").alias(name))
        joined = rows.join(tag(self.snapshot(), "_old"), self.id_col, "left").join(tag(self._folded(self.tail()), "_new"), self.id_col, "left")
        last = F.greatest("_old", "_new")
        return joined.withColumn("status", F.coalesce(last["status"], F.col("status"))).select(*rows.columns)

    def drop_folded(self) -> list[int]:
        """Deletes batches and snapshots below the watermark and returns the batches' numbers."""
        jvm, upto = self.spark.sparkContext._jvm, self.watermark()
        gone = [k for k in self._complete("entries", "batch") if k <= upto]
        old = [f"entries/batch={k}" for k in gone] + [f"snapshots/upto={k}" for k in self._complete("snapshots", "upto") if k < upto]
        for name in old:
            p = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
            p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        return gone
