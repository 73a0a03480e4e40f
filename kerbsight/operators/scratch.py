"""Tables written to the folder that the cluster shares, to cut lineage and give the planner true sizes."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_held: ContextVar[list[str] | None] = ContextVar("held", default=None)


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``. Where that is unset, a temporary one, in local mode only."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        jvm = spark.sparkContext._jsc.sc().getCheckpointDir()
        path = jvm.get() if jvm.isDefined() else None
    if not path:
        master = spark.sparkContext.master
        if master.split("[")[0] != "local":
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        path = "file://" + tempfile.mkdtemp(prefix="kerbsight-")
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it again."""
    path = f"{scratch_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    if (held := _held.get()) is not None:
        held.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def dropped_after(spark: SparkSession) -> Iterator[None]:
    """Deletes what :func:`written` writes within, at the end, also after an error.

    Results are lazy and read those tables, so write or collect them within::

        with dropped_after(spark):
            query(spark, folder).write.parquet(target)
    """
    token = _held.set([])
    try:
        yield
    finally:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in _held.get():
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)
        _held.reset(token)
