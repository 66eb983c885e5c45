"""Token ids in binary files: frequency-ranked, byte-aligned variable length, control bytes apart.

Ids are replaced by their rank in the whole corpus, so frequent ones take one byte. A control byte holds the lengths
of four ranks; data bytes follow apart, and numpy decodes both by table lookup. Documents are tokenised once and
written; ranks come from sums over the tasks (at most one row a vocabulary entry reaches the driver); documents are
dealt out by ranges of ids, sorted, and each task writes its files; starts come from the files' totals.

A file: the length of its index (8 bytes), the index (an Arrow stream of id, tokens), the number of ids (8 bytes), the
control bytes, the data bytes.

Defined results: null or empty text is the end id alone; null ids come first; rows of equal ids follow in the order of a
hash of their ids; repeated rows are written as often as they occur; extra columns are ignored; an empty table gives none.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomleaf.llm._shared import cores, read_file, staged, table, tokenizer_path, whole_text, work_dir, write_file
from fathomleaf.llm.wordids import word_ids

FILE_IDS = 4_000_000
STEP = 1 << 19  # integers coded at a time; whole control bytes
ROWS = 1000  # texts in memory as objects
_LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.int64) + 1


def encode(ranks: np.ndarray) -> bytes:
    """Control bytes, then data bytes, of unsigned 32-bit integers."""
    control, data = [], []
    for at in range(0, len(ranks), STEP):
        r = np.ascontiguousarray(ranks[at : at + STEP], "<u4")
        extra = (r > 0xFF).astype(np.uint8) + (r > 0xFFFF) + (r > 0xFFFFFF)
        padded = np.zeros(-(-len(r) // 4) * 4, np.uint8)
        padded[: len(r)] = extra
        four = padded.reshape(-1, 4)
        control.append((four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6).astype(np.uint8).tobytes())
        data.append(r.view(np.uint8).reshape(-1, 4)[np.arange(4) <= extra[:, None]].tobytes())
    return b"".join(control + data)


def decode(data: bytes, n: int, at: int = 0) -> np.ndarray:
    """The ``n`` integers that ``encode`` wrote at ``at``; lengths by table lookup, ``STEP`` integers at a time."""
    body, out = at + -(-n // 4), np.empty(n, "<u4")
    raw = np.frombuffer(data, np.uint8)
    for k in range(0, n, STEP):
        some = min(STEP, n - k)
        lens = _LENGTHS[raw[at + k // 4 : at + k // 4 + -(-some // 4)]].reshape(-1)[:some]
        ends = np.cumsum(lens)
        starts = body + ends - lens
        own = raw[starts].astype("<u4")
        for j in (1, 2, 3):
            more = np.flatnonzero(lens > j)
            own[more] |= raw[starts[more] + j].astype("<u4") << np.uint32(8 * j)
        out[k : k + some] = own
        body += int(ends[-1])
    return out


def tokenize(docs: DataFrame, tokenizer: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids_ binary of unsigned 16- or 32-bit integers, wide_, tally_); a task's last row has only its tally of ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, tail, tally, kind = word_ids(tokenizer), np.array([end_id], "<u4").tobytes(), np.zeros(1, np.int64), None
        for batch in (b.slice(k, ROWS) for b in batches for k in range(0, b.num_rows, ROWS)):
            kind = batch.column(0).type
            ids, wide = [], []
            for raw in asked.of(batch.column(1).to_pylist()):
                x = np.frombuffer(raw + tail, "<u4")
                wide.append(bool(x.max() > 0xFFFF))
                ids.append(x.tobytes() if wide[-1] else x.astype("<u2").tobytes())
            for flag, dtype in ((False, "<u2"), (True, "<u4")):
                c = np.bincount(np.frombuffer(b"".join([x for x, w in zip(ids, wide, strict=True) if w == flag]), dtype), minlength=len(tally))
                c[: len(tally)] += tally
                tally = c
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.binary()), pa.array(wide, pa.bool_()), pa.nulls(len(ids), pa.binary())], names=out.names
            )
        if kind is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, kind), pa.nulls(1, pa.binary()), pa.nulls(1, pa.bool_()), pa.array([tally.astype("<i8").tobytes()])], names=out.names
            )

    out = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField("ids_", T.BinaryType()),
            T.StructField("wide_", T.BooleanType()),
            T.StructField("tally_", T.BinaryType()),
        ]
    )
    return docs.select(id_col, whole_text(text_col).alias("text_")).mapInArrow(run, out)


def _ids(raw: bytes, wide: bool) -> np.ndarray:
    return np.frombuffer(raw, "<u4" if wide else "<u2").astype("<u4")


def frequencies(tokens: DataFrame) -> DataFrame:
    """(token, n) over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                c = np.frombuffer(raw, "<i8")
                seen = np.nonzero(c)[0]
                yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int64)), pa.array(c[seen])], names=["token", "n"])

    return tokens.filter("tally_ is not null").select("tally_").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def write(docs: DataFrame, tokenizer: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the files; (part, file, path, n_ids, n_docs, ranks), one row a file, in the order of the ids."""
    spark = docs.sparkSession
    folder = work_dir(spark, "token-files")
    tokens = staged(tokenize(docs, tokenizer, end_id, id_col, text_col), "tokens")
    order = [r[0] for r in frequencies(tokens).orderBy(F.desc("n"), "token").collect()]  # at most the vocabulary
    by_rank = np.array(order or [end_id], "<u4")
    ranks = f"{folder}/ranks.u4"
    write_file(ranks, by_rank.tobytes())
    rank_of = np.zeros(int(by_rank.max()) + 1, "<u4")
    rank_of[by_rank] = np.arange(len(by_rank))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rows = TaskContext.get().partitionId(), []
        keys: list[pa.Array] = []
        held: list[np.ndarray] = []

        def flush() -> None:
            if not held:
                return
            counts = pa.array([len(x) for x in held], pa.int64())
            index = pa.RecordBatch.from_arrays([pa.concat_arrays(keys), counts], names=["id", "tokens"])  # keys: slices of batches
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, index.schema) as w:
                w.write_batch(index)
            head, ids = sink.getvalue().to_pybytes(), np.concatenate(held)
            path = f"{folder}/{part:06d}-{len(rows):04d}-{uuid.uuid4().hex}.ids"
            write_file(path, len(head).to_bytes(8, "little") + head + len(ids).to_bytes(8, "little") + encode(rank_of[ids]))
            rows.append((part, len(rows), path, len(ids), len(held), ranks))
            keys.clear()
            held.clear()

        size = 0
        for batch in batches:
            begun = 0
            for k, (raw, wide) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                x = _ids(raw, wide)
                if size and size + len(x) > FILE_IDS:
                    keys.append(batch.column(0).slice(begun, k - begun))
                    flush()
                    begun, size = k, 0
                held.append(x)
                size += len(x)
            keys.append(batch.column(0).slice(begun))
        flush()
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)],
            names=["part", "file", "path", "n_ids", "n_docs", "ranks"],
        )

    tied = tokens.filter("tally_ is null").withColumn("tie_", F.xxhash64("ids_"))
    sorted_ = tied.repartitionByRange(cores(spark), id_col, "tie_").sortWithinPartitions(id_col, "tie_", "ids_").select(id_col, "ids_", "wide_")
    return staged(sorted_.mapInArrow(run, "part int, file int, path string, n_ids long, n_docs long, ranks string"), "token-files")


def read(files: DataFrame, id_type: T.DataType, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32), one row a document, from the files' bytes."""
    n = files.count()
    before = lambda w: F.coalesce(F.sum("n_ids").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # Where a part starts, from one row a part (a range of ids, one task each); then where a file starts inside its part.
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n_ids")).select("part", before(Window.orderBy("part")).alias("part_"))
    starts = files.withColumn("in_", before(Window.partitionBy("part").orderBy("file"))).join(parts, "part").withColumn("start_", F.col("part_") + F.col("in_"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, ranks, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                by_rank, data = np.frombuffer(read_file(ranks), "<u4"), read_file(path)
                head = int.from_bytes(data[:8], "little")
                index = pa.ipc.open_stream(data[8 : 8 + head]).read_all()
                n_ids = int.from_bytes(data[8 + head : 16 + head], "little")
                ids = by_rank[decode(data, n_ids, 16 + head)].astype("<u4").tobytes()
                counts = index.column("tokens").to_numpy()
                ends = np.cumsum(counts)
                crcs = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip((ends - counts).tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [index.column("id").combine_chunks(), pa.array(start + ends - counts), pa.array(counts), pa.array(crcs, pa.int64())],
                    names=out.names,
                )

    out = T.StructType(
        [
            T.StructField(id_col, id_type),
            T.StructField("start", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
        ]
    )
    return starts.select("path", "ranks", "start_").repartition(max(1, min(n, 4 * cores(files.sparkSession))), "path").mapInArrow(run, out)


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return read(write(docs, tokenizer_path("byte_bpe_50k.json")), docs.schema["doc_id"].dataType)


QUERIES = {"op4_token_files": op4_token_files}
ORACLE_SQL: dict[str, str] = {}
