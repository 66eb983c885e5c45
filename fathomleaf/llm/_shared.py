"""Things the training-data operators share: tables, shared folders, files that executors read and write."""

from __future__ import annotations

import os
import posixpath
import tempfile
import uuid
from urllib.parse import urlsplit

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables, always through Spark's own reader.

    Texts that come in fewer partitions than there are cores (a file or two) are dealt out first; larger inputs are not.
    """
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    n = spark.sparkContext.defaultParallelism
    return df.repartition(n) if name in ("documents", "pages") and df.rdd.getNumPartitions() < n else df


def checkpoint_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; one of our own only where it is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = current.get() if current.isDefined() else None
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = f"file://{tempfile.mkdtemp(prefix='fathomleaf-')}"
        spark.sparkContext.setCheckpointDir(root)
    return root


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: cuts lineage and survives the loss of any executor."""
    path = work_dir(df.sparkSession, name)
    df.write.options(**{"compression": "zstd", **options}).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _resolve(uri: str) -> tuple[pafs.FileSystem, str]:
    parts = urlsplit(uri)
    if parts.scheme in ("", "file"):
        return pafs.LocalFileSystem(), parts.path or uri
    return pafs.FileSystem.from_uri(uri)


def write_file(uri: str, data: bytes) -> None:
    """Write the whole file under another name, then move it: a lost or repeated task leaves no half of a file."""
    fs, path = _resolve(uri)
    fs.create_dir(posixpath.dirname(path), recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.tmp"
    with fs.open_output_stream(part, compression=None) as out:
        out.write(data)
    fs.move(part, path)


class Writer:
    """As ``write_file``, for data that come piece by piece; ``close`` gives the file its name."""

    def __init__(self, uri: str) -> None:
        self.fs, self.path = _resolve(uri)
        self.fs.create_dir(posixpath.dirname(self.path), recursive=True)
        self.part = f"{self.path}.{uuid.uuid4().hex}.tmp"
        self.out = self.fs.open_output_stream(self.part, compression=None)
        self.at = 0

    def write(self, data: bytes) -> int:
        began = self.at
        self.out.write(data)
        self.at += len(data)
        return began

    def close(self) -> None:
        self.out.close()
        self.fs.move(self.part, self.path)


def read_file(uri: str) -> bytes:
    fs, path = _resolve(uri)
    with fs.open_input_file(path) as src:
        return src.read()


def remove_file(uri: str) -> None:
    """Remove a file that no later step reads; that it is gone already is no fault."""
    fs, path = _resolve(uri)
    if fs.get_file_info(path).type != pafs.FileType.NotFound:
        fs.delete_file(path)


def open_file(uri: str):
    """A random-access file: ``read_at(n, offset)`` reads a range."""
    fs, path = _resolve(uri)
    return fs.open_input_file(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has it (case does not count)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def whole_text(col: str = "text"):
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def cores(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), 1)


os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
