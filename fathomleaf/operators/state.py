"""Results that must not be computed twice, such as a model's answers."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``); only a local session without that setting gets one of its own."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        if not root and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(root or f"file://{tempfile.mkdtemp(prefix='fathomleaf-')}")
    return (root or sc._jsc.sc().getCheckpointDir().get()).rstrip("/")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder in it."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder, its lineage cut: a lost executor costs nothing of it."""
    shared_root(df.sparkSession)
    return df.checkpoint()


@contextlib.contextmanager
def arrow_rows(spark: SparkSession, n: int) -> Iterator[None]:
    """Within it, batches of at most ``n`` rows go to Python: for wide rows, of which several batches are in memory at once."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, before)
