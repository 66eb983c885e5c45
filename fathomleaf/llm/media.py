"""Media columns: content-addressed payloads in tar shards.

A payload is stored as an 8-bit grey PNG of width 64. Each task of the scan writes its own shards, one member a
distinct payload, named by the payload's digest; rows carry digest, shard, offset and length. ``with_headers`` fills the
metadata columns from ranges of 33 bytes; ``read_back`` reads whole members. Payloads never pass through a shuffle, and
the rows that point to them are written once, so a lost task writes its shards again and nothing else.

Defined results: null text counts as empty; an empty text's payload is one row of 64 zero bytes; equal texts give equal
values; repeated rows share a member within a shard; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import struct
import tarfile
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from fathomleaf.llm._shared import Writer, open_file, staged, table, whole_text, work_dir

WIDTH = 64
LEVEL = 2
SHARD_BYTES = 256 << 20
HEADER = 33
SIGNATURE = b"\x89PNG\r\n\x1a\n"


def payload_of(text: bytes) -> bytes:
    return text + bytes(-len(text) % WIDTH if text else WIDTH)


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def to_png(payload: bytes) -> bytes:
    rows = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    raw = np.zeros((len(rows), WIDTH + 1), np.uint8)
    raw[:, 1:] = rows
    return SIGNATURE + _chunk(
        b"IHDR", struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    ) + _chunk(b"IDAT", zlib.compress(raw.tobytes(), LEVEL)) + _chunk(b"IEND", b"")


def png_header(data: bytes) -> tuple[int, int, int]:
    """(width, height, bits) from the first 33 bytes."""
    if data[:8] != SIGNATURE or data[12:16] != b"IHDR":
        raise ValueError("not a PNG")
    return struct.unpack(">IIB", data[16:25])


def from_png(data: bytes) -> bytes:
    width, height, _ = png_header(data)
    at, packed = 8, []
    while at < len(data):
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        body = data[at + 8 : at + 8 + size]
        if zlib.crc32(kind + body) != struct.unpack(">I", data[at + 8 + size : at + 12 + size])[0]:
            raise ValueError("PNG chunk is damaged")
        if kind == b"IDAT":
            packed.append(body)
        at += 12 + size
    raw = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8).reshape(height, width + 1)
    if raw[:, 0].any():
        raise ValueError("only filter 0 is written")
    return raw[:, 1:].tobytes()


class ShardWriter:
    """Members of one task; a new shard after ``SHARD_BYTES``."""

    def __init__(self, folder: str, part: int) -> None:
        self.folder, self.part, self.out, self.name = folder, part, None, ""
        self.members: dict[str, tuple[int, int]] = {}

    def put(self, digest: str, payload: bytes) -> tuple[str, int, int]:
        if self.out is not None and self.out.at >= SHARD_BYTES:
            self.close()
        if self.out is None:
            self.name = f"{self.folder}/{self.part:06d}-{uuid.uuid4().hex}.tar"
            self.out, self.members = Writer(self.name), {}
        if (found := self.members.get(digest)) is None:
            data = to_png(payload)
            info = tarfile.TarInfo(f"{digest}.png")
            info.size = len(data)
            self.out.write(info.tobuf(tarfile.USTAR_FORMAT))
            found = self.members[digest] = (self.out.write(data), len(data))
            self.out.write(bytes(-len(data) % 512))
        return (self.name, *found)

    def close(self) -> None:
        if self.out is not None:
            self.out.write(bytes(1024))
            self.out.close()
            self.out = None


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the shards; (id, n_bytes, digest, shard, offset, length), one row a document."""
    folder = work_dir(docs.sparkSession, "shards")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = ShardWriter(folder, TaskContext.get().partitionId())
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                data = text.encode()
                payload = payload_of(data)
                digest = hashlib.sha256(payload).hexdigest()
                rows.append((len(data), digest, *shards.put(digest, payload)))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *(pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()), strict=True)),
                ],
                names=out.names,
            )
        shards.close()

    out = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("digest", T.StringType()),
            T.StructField("shard", T.StringType()),
            T.StructField("offset", T.LongType()),
            T.StructField("length", T.LongType()),
        ]
    )
    return staged(docs.select(id_col, whole_text(text_col).alias("text_")).mapInArrow(run, out), "media")


class _Shard:
    """The open shard: rows of one task mostly point into one."""

    def __init__(self) -> None:
        self.name, self.src = None, None

    def read(self, name: str, offset: int, length: int) -> bytes:
        if name != self.name:
            self.close()
            self.name, self.src = name, open_file(name)
        return self.src.read_at(length, offset)

    def close(self) -> None:
        if self.src is not None:
            self.src.close()


def with_headers(rows: DataFrame) -> DataFrame:
    """``rows`` with width, height and bits, from header ranges only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = _Shard()
        for batch in batches:
            told = [png_header(shard.read(s, o, HEADER)) for s, o in zip(batch.column("shard").to_pylist(), batch.column("offset").to_pylist(), strict=True)]
            cols = list(zip(*told, strict=True)) if told else [[]] * 3
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, pa.int64()) for c in cols)], names=out.names)
        shard.close()

    out = T.StructType([*rows.schema, *(T.StructField(n, T.LongType()) for n in ("width", "height", "bits"))])
    return rows.mapInArrow(run, out)


def feature_of(payload: bytes) -> str:
    """Whole numbers only: the samples' sum, the non-zero ones, and eight histogram bins."""
    x = np.frombuffer(payload, np.uint8)
    bins = np.bincount(x >> 5, minlength=8)
    return f"sum={int(x.sum(dtype=np.int64))};used={int(np.count_nonzero(x))};bins={','.join(map(str, bins.tolist()))}"


def read_back(rows: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Read each row's member, restore the payload, and compute its columns from what was read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = _Shard(), {}
        for batch in batches:
            told = []
            for s, o, n in zip(*(batch.column(c).to_pylist() for c in ("shard", "offset", "length")), strict=True):
                if (found := held.get((s, o))) is None:
                    media = shard.read(s, o, n)
                    payload = from_png(media)
                    found = (
                        len(payload),
                        hashlib.sha256(payload).hexdigest(),
                        zlib.crc32(payload[-WIDTH:]),
                        len(media),
                        hashlib.sha256(media).hexdigest(),
                        feature_of(payload),
                    )
                    if len(held) >= 50_000:
                        held.clear()
                    held[s, o] = found
                told.append(found)
            cols = list(zip(*told, strict=True)) if told else [[]] * 6
            kept = [batch.column(c) for c in (id_col, "n_bytes")]
            yield pa.RecordBatch.from_arrays(
                [*kept, *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True)), *(batch.column(c) for c in ("width", "height"))], names=out.names
            )
        shard.close()

    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
    long, text = T.LongType(), T.StringType()
    out = T.StructType(
        [
            rows.schema[id_col],
            T.StructField("n_bytes", long),
            T.StructField("payload_bytes", long),
            T.StructField("payload_sha256", text),
            T.StructField("tail_crc32", long),
            T.StructField("media_bytes", long),
            T.StructField("media_sha256", text),
            T.StructField("feature", text),
            T.StructField("width", long),
            T.StructField("height", long),
        ]
    )
    return rows.mapInArrow(run, out)


def op2_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_back(with_headers(store(table(spark, sf_dir, "documents"))))


QUERIES = {"op2_media_columns": op2_media_columns}
ORACLE_SQL: dict[str, str] = {}
