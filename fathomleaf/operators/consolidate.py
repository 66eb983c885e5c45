"""One text a company, windows over it, and where each window came from.

``files`` has (company, ord, file, text). Texts are concatenated per company by an ordered aggregate; offsets are running
sums. A company's text is one value by definition of the operator, so its size is bounded by what one row may hold (2 GB);
``windows_by_file`` and ``company_digests`` work without that value for companies of any size.
"""

from __future__ import annotations

import ctypes
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomleaf.config import EngineConfig
from fathomleaf.functions import text as X
from fathomleaf.operators.state import arrow_rows, kept, shared_folder

RULE = "=" * 80


def banner(file: Column) -> Column:
    return F.concat(F.lit(f"\n{RULE}\n[SOURCE FILE: "), file, F.lit(f"]\n{RULE}\n"))


def _kept(files: DataFrame) -> DataFrame:
    return files.filter(F.length(X.strip("text")) > 0)


BUCKET = 4096


def running_before(rows: DataFrame, value: str, out: str, by: str = "company", order: str = "ord") -> DataFrame:
    """``rows`` with the sum of ``value`` over the rows before, per ``by`` in ``order`` (a whole number).

    In two levels, so that no group of one company is sorted in one task: sums over buckets of the order, sums within.
    """
    rows = rows.withColumn("bucket_", F.floor(F.col(order) / BUCKET))
    sums = rows.groupBy(by, "bucket_").agg(F.sum(value).alias("sum_"))
    before = F.coalesce(F.sum("sum_").over(Window.partitionBy(by).orderBy("bucket_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = F.coalesce(F.sum(value).over(Window.partitionBy(by, "bucket_").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    joined = rows.withColumn("within_", within).join(sums.withColumn("before_", before).drop("sum_"), [by, "bucket_"])
    return joined.withColumn(out, F.col("before_") + F.col("within_")).drop("bucket_", "before_", "within_")


def source_offsets(files: DataFrame) -> DataFrame:
    """(company, ord, file, start_char, end_char) of each non-blank file in its company's text."""
    rows = _kept(files).select("company", "ord", "file", F.length(banner(F.col("file"))).alias("head_"), F.length("text").alias("len_"))
    rows = running_before(rows.withColumn("all_", F.col("head_") + F.col("len_") + 2), "all_", "at_")
    rows = rows.withColumn("start_char", F.col("at_") + F.col("head_"))
    return rows.select("company", "ord", "file", "start_char", (F.col("start_char") + F.col("len_")).alias("end_char"))


def windows_by_file(files: DataFrame, config: EngineConfig = EngineConfig()) -> DataFrame:
    """(company, id, text, char_start, char_end): windows of characters over a company's text, without building it.

    Each file's piece is cut into the parts that fall into each window; a window gathers its few parts.
    """
    size, step = config.chunk_size * config.chars_per_token, (config.chunk_size - config.chunk_overlap) * config.chars_per_token
    rows = _kept(files).select("company", "ord", F.concat(banner(F.col("file")), "text", F.lit("\n\n")).alias("p_")).withColumn("len_", F.length("p_"))
    rows = running_before(rows, "len_", "at_")
    total = rows.groupBy("company").agg(F.sum("len_").alias("n_"))
    rows = rows.join(total, "company")
    last = F.greatest(F.ceil((F.col("n_") - (size - step)) / F.lit(step)) - 1, F.lit(0))
    from_ = F.greatest(F.floor((F.col("at_") - size) / F.lit(step)) + 1, F.lit(0))
    upto = F.least(F.floor((F.col("at_") + F.col("len_") - 1) / F.lit(step)), last)
    rows = rows.filter(from_ <= upto).withColumn("id", F.explode(F.sequence(from_, upto)))
    start, stop = F.col("id") * step, F.least(F.col("id") * step + size, F.col("n_"))
    a, b = F.greatest(start, F.col("at_")) - F.col("at_"), F.least(stop, F.col("at_") + F.col("len_")) - F.col("at_")
    part = F.substring("p_", (a + 1).cast("int"), (b - a).cast("int"))
    own = rows.select(
        "company",
        F.col("id").cast("int").alias("id"),
        start.alias("char_start"),
        stop.alias("char_end"),
        F.struct("ord", part.alias("part")).alias("s"),
    )
    return own.groupBy("company", "id", "char_start", "char_end").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("s")), lambda x: x["part"]), "").alias("text")
    )


def company_docs(files: DataFrame) -> DataFrame:
    """(company, full_text, source_files, total_chars, total_tokens): one row a company."""
    rows = _kept(files).select("company", F.struct("ord", "file", F.concat(banner(F.col("file")), "text", F.lit("\n\n")).alias("piece")).alias("s"))
    own = rows.groupBy("company").agg(F.array_sort(F.collect_list("s")).alias("s"))
    out = own.select(
        "company",
        F.array_join(F.transform("s", lambda x: x["piece"]), "").alias("full_text"),
        F.transform("s", lambda x: x["file"]).alias("source_files"),
    )
    return out.withColumn("total_chars", F.length("full_text")).withColumn("total_tokens", X.token_count("full_text"))


SEGMENT, SEGMENT_IDS = 1 << 26, 256  # characters of a company that one task digests, but for the ids of one bucket


class Md5:
    """MD5 whose state is plain memory (OpenSSL's context), so that another task can go on from it."""

    def __init__(self, state: bytes | None = None) -> None:
        self.lib, self.at = self.library(), ctypes.create_string_buffer(256)
        if state is None:
            self.lib.MD5_Init(self.at)
        else:
            self.at[: len(state)] = state

    @staticmethod
    def library() -> ctypes.CDLL | None:
        try:
            import _hashlib

            lib = ctypes.CDLL(_hashlib.__file__)
            return lib if lib.MD5_Init and lib.MD5_Update and lib.MD5_Final else None
        except (ImportError, OSError, AttributeError):
            return None

    def update(self, data: pa.Buffer) -> None:
        self.lib.MD5_Update(self.at, ctypes.c_void_p(data.address), ctypes.c_size_t(data.size))

    def state(self) -> bytes:
        return self.at.raw

    def hexdigest(self) -> str:
        out = ctypes.create_string_buffer(16)
        self.lib.MD5_Final(out, ctypes.create_string_buffer(self.at.raw, 256))
        return out.raw.hex()


def _digest(batches: Iterator[pa.RecordBatch], handed_on: bool) -> Iterator[pa.RecordBatch]:
    """(company, state, text_md5) of rows (company, piece, state) in order; a state stands before what it goes on with."""
    company, own = None, None

    def done() -> pa.RecordBatch:
        state = own.state() if handed_on else None
        return pa.RecordBatch.from_arrays(
            [pa.array([company], kind), pa.array([state], pa.binary()), pa.array([own.hexdigest()])], names=["company", "state_", "text_md5"]
        )

    for batch in batches:
        kind = batch.column(0).type
        for k, c in enumerate(batch.column(0).to_pylist()):
            state = batch.column(2)[k].as_py()
            if own is None or c != company:
                if own is not None:
                    yield done()
                company, own = c, Md5(state) if handed_on else hashlib.md5(usedforsecurity=False)
            if state is None and (data := batch.column(1)[k].as_buffer()).size:
                own.update(data)
    if own is not None:
        yield done()


def company_digests(files: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """(company, text_md5, n_files, total_chars, total_tokens) of the texts of ``company_docs``, which are not built.

    Counts are sums over files. A company's pieces are sorted and digested as they pass by; a company of more than ``segment``
    characters is digested in rounds, each of which goes on from the state that the one before it left, so that no task reads
    more than a segment of a company.
    """
    spark = files.sparkSession
    rows = _kept(files).select(
        "company", "ord", "file", F.concat(banner(F.col("file")), "text", F.lit("\n\n")).alias("piece_"), F.floor(F.col("ord") / SEGMENT_IDS).alias("bucket_")
    )
    sums = kept(
        rows.groupBy("company", "bucket_").agg(
            F.count(F.lit(1)).alias("n_"), F.sum(F.length("piece_")).alias("chars_"), F.sum(X.token_count("piece_")).alias("tokens_")
        )
    )
    before = F.sum("chars_").over(Window.partitionBy("company").orderBy("bucket_").rowsBetween(Window.unboundedPreceding, -1))
    places = sums.select("company", "bucket_", F.floor(F.coalesce(before, F.lit(0)) / segment).alias("segment_"))
    # Where the segments begin, of companies with more than one: a few rows, as each has over ``segment`` characters.
    starts = places.groupBy("company", "segment_").agg(F.min("bucket_").alias("b_")).groupBy(F.col("company").alias("c_")).agg(
        F.collect_list("b_").alias("starts_")
    )
    large = kept(starts.filter(F.size("starts_") > 1))
    last = (large.agg(F.max(F.size("starts_"))).first()[0] or 1) - 1 if Md5.library() else 0
    cols = ["company", "ord", "file", "piece_"]
    if last:
        path = shared_folder(spark, "segments")
        met = rows.join(F.broadcast(large), F.col("company").eqNullSafe(F.col("c_")), "left")
        number = F.size(F.filter(F.coalesce("starts_", F.array().cast("array<bigint>")), lambda b: b <= F.col("bucket_"))) - 1
        met.select(*cols, F.greatest(number, F.lit(0)).alias("segment_")).write.partitionBy("segment_").parquet(path)
    out = T.StructType([files.schema["company"], T.StructField("state_", T.BinaryType()), T.StructField("text_md5", T.StringType())])
    states = None
    for k in range(last + 1):
        own = (spark.read.parquet(path).filter(F.col("segment_") == k) if last else rows).select(*cols, F.lit(None).cast("binary").alias("state_"))
        if states is not None:
            own = own.unionByName(states.select("company", "state_"), allowMissingColumns=True)
        order = ["company", F.col("state_").isNull(), "ord", "file", "piece_"]
        with arrow_rows(spark, 256):
            states = kept(
                own.repartition("company").sortWithinPartitions(*order).select("company", "piece_", "state_").mapInArrow(
                    lambda batches, handed_on=last > 0: _digest(batches, handed_on), out
                )
            )
    totals = sums.groupBy(F.col("company").alias("c_")).agg(
        F.sum("n_").alias("n_files"), F.sum("chars_").alias("total_chars"), F.sum("tokens_").alias("total_tokens")
    )
    return states.join(totals, F.col("company").eqNullSafe(F.col("c_"))).select("company", "text_md5", "n_files", "total_chars", "total_tokens")


def window_starts(n: Column, size: int, overlap: int) -> Column:
    """Starts of windows over ``n`` units: null for none."""
    step = size - overlap
    count = F.greatest(F.ceil((n - overlap) / F.lit(step)), F.lit(1)).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), count - 1), lambda k: k * step))


TOKEN = re.compile(r"[^ \t\n\r\f\x0B]+")


def token_windows(docs: DataFrame, config: EngineConfig = EngineConfig()) -> DataFrame:
    """(company, id, text, token_count, token_start, token_end, char_start, char_end, is_last) of ``full_text``.

    Tokens are runs of non-blanks; a window runs from its first token's start to its last token's end. One pass over a text
    finds where its tokens are, and each window is a slice of the text: batched Python, as SQL arrays would be copied for
    every window. A null text has no windows.
    """
    size, step = config.chunk_size, config.chunk_size - config.chunk_overlap

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, rows = [], []
            for k, text in enumerate(batch.column(1).to_pylist()):
                spans = [m.span() for m in TOKEN.finditer(text or "")]
                n = len(spans)
                for i in range(max(-(-(n - config.chunk_overlap) // step), 1) if n else 0):
                    lo, hi = i * step, min(i * step + size, n)
                    at.append(k)
                    rows.append((i, text[spans[lo][0] : spans[hi - 1][1]], hi - lo, lo, hi, spans[lo][0], spans[hi - 1][1], hi == n))
                if len(rows) >= 1000:
                    yield batch_of(batch, at, rows)
                    at, rows = [], []
            yield batch_of(batch, at, rows)

    def batch_of(batch: pa.RecordBatch, at: list[int], rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(at, pa.int64())), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True))], names=out.names
        )

    kinds = [pa.int32(), pa.string(), *[pa.int32()] * 5, pa.bool_()]
    number = [T.StructField(c, T.IntegerType()) for c in ("token_count", "token_start", "token_end", "char_start", "char_end")]
    out = T.StructType(
        [
            docs.schema["company"],
            T.StructField("id", T.IntegerType()),
            T.StructField("text", T.StringType()),
            *number,
            T.StructField("is_last", T.BooleanType()),
        ]
    )
    return docs.select("company", "full_text").mapInArrow(run, out)


def char_windows(docs: DataFrame, config: EngineConfig = EngineConfig(), key: str = "company", text_col: str = "full_text") -> DataFrame:
    """(key, id, text, token_count, char_start, char_end, is_last): windows of characters, for want of a tokenizer."""
    size, overlap = config.chunk_size * config.chars_per_token, config.chunk_overlap * config.chars_per_token
    rows = docs.select(key, F.col(text_col).alias("t_"), F.length(text_col).alias("n_"))
    rows = rows.select(key, "t_", "n_", F.posexplode(window_starts(F.col("n_"), size, overlap)).alias("id", "char_start"))
    rows = rows.withColumn("char_end", F.least(F.col("char_start") + size, F.col("n_")))
    text = F.substring("t_", F.col("char_start") + 1, F.col("char_end") - F.col("char_start"))
    return rows.select(
        key,
        "id",
        text.alias("text"),
        F.floor((F.col("char_end") - F.col("char_start")) / config.chars_per_token).cast("int").alias("token_count"),
        "char_start",
        "char_end",
        (F.col("char_end") == F.col("n_")).alias("is_last"),
    )


STRETCH = 1 << 13  # characters


def chunk_sources(chunks: DataFrame, refs: DataFrame) -> DataFrame:
    """(company, id, file): each overlap of a window and a file.

    Both are told by the stretches of text that they touch and meet by (company, stretch), so that a company of any size is
    spread out; a pair counts in the first stretch that both touch.
    """
    first, last = (lambda a: F.floor(F.col(a) / STRETCH)), (lambda a, b: F.floor(F.greatest(F.col(b) - 1, F.col(a)) / STRETCH))
    c = chunks.select("company", "id", "char_start", "char_end", F.explode(F.sequence(first("char_start"), last("char_start", "char_end"))).alias("stretch_"))
    r = refs.select("company", "file", "start_char", "end_char", F.explode(F.sequence(first("start_char"), last("start_char", "end_char"))).alias("stretch_"))
    met = c.join(r, ["company", "stretch_"]).filter("start_char < char_end and end_char > char_start")
    return met.filter(F.col("stretch_") == F.greatest(first("char_start"), first("start_char"))).select("company", "id", "file")


def with_sources(chunks: DataFrame, refs: DataFrame) -> DataFrame:
    found = chunk_sources(chunks, refs).groupBy("company", "id").agg(F.array_sort(F.collect_set("file")).alias("source_files"))
    return chunks.join(found, ["company", "id"], "left").withColumn("source_files", F.coalesce("source_files", F.array().cast("array<string>")))


def source_ranges(chunks: DataFrame, refs: DataFrame) -> DataFrame:
    """(company, file, start_chunk, end_chunk): first and last window of each file; -1 for none."""
    found = chunk_sources(chunks, refs).groupBy("company", "file").agg(F.min("id").alias("start_chunk"), F.max("id").alias("end_chunk"))
    return refs.select("company", "file").join(found, ["company", "file"], "left").na.fill(-1, ["start_chunk", "end_chunk"])


def coverage(chunks: DataFrame, docs: DataFrame, start: str = "token_start", stop: str = "token_end", total: str = "total_tokens") -> DataFrame:
    """(company, covered, total, share, complete, gaps): what the windows leave out, with the first ten gaps."""
    seen = F.max(stop).over(Window.partitionBy("company").orderBy(start, stop).rowsBetween(Window.unboundedPreceding, -1))
    rows = chunks.withColumn("until_", F.coalesce(seen, F.lit(0)))
    gap = F.when(F.col(start) > F.col("until_"), F.struct(F.col("until_").alias("start"), F.col(start).alias("stop")))
    fresh = F.greatest(F.col(stop) - F.greatest(F.col(start), F.col("until_")), F.lit(0))
    own = rows.groupBy("company").agg(F.sum(fresh).alias("covered"), F.array_sort(F.collect_list(gap)).alias("inner_"), F.max(stop).alias("end_"))
    out = docs.select("company", F.col(total).alias("total")).join(own, "company", "left").withColumn("covered", F.coalesce("covered", F.lit(0)))
    tail = F.when(
        F.coalesce(F.col("end_"), F.lit(0)) < F.col("total"),
        F.array(F.struct(F.coalesce(F.col("end_"), F.lit(0)).alias("start"), F.col("total").alias("stop"))),
    )
    share = F.when(F.col("total") > 0, F.col("covered") / F.col("total")).otherwise(1.0)
    gaps = F.slice(
        F.concat(
            F.coalesce("inner_", F.array().cast("array<struct<start:int,stop:int>>")),
            F.coalesce(tail, F.array().cast("array<struct<start:int,stop:int>>")),
        ),
        1,
        10,
    )
    return out.select(
        "company",
        F.col("covered").cast("long").alias("covered"),
        F.col("total").cast("long").alias("total"),
        share.alias("share"),
        (share >= 0.999).alias("complete"),
        gaps.alias("gaps"),
    )


def extraction_plan(chunks: DataFrame, most: int = 6) -> DataFrame:
    """(company, call, ids): all windows in one call, or runs of ``most`` that share two."""
    n = chunks.groupBy("company").agg(F.count(F.lit(1)).cast("int").alias("n_"))
    step = most - 2
    starts = F.when(F.col("n_") <= most, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("n_") - 1, F.lit(step)))
    rows = n.select("company", "n_", F.posexplode(starts).alias("call", "from_"))
    return rows.select("company", "call", F.sequence(F.col("from_"), F.least(F.col("from_") + most, F.col("n_")) - 1).alias("ids"))


def section_windows(chunks: DataFrame, retrieved: DataFrame, config: EngineConfig = EngineConfig()) -> DataFrame:
    """(company, section, ids): runs of three windows with something not yet retrieved, the first few of a company.

    A window counts as retrieved if the first 300 characters of one that was (``retrieved``: company, text) are its own.
    """
    rows = chunks.select(
        "company", "id", F.substring("text", 1, 300).alias("start_"), F.floor(F.col("id") / config.section_window).cast("int").alias("section")
    )
    known = retrieved.select("company", F.substring("text", 1, 300).alias("start_")).distinct().withColumn("known_", F.lit(True))
    rows = rows.join(known, ["company", "start_"], "left")
    own = rows.groupBy("company", "section").agg(
        F.array_sort(F.collect_list("id")).alias("ids"), F.bool_and(F.coalesce("known_", F.lit(False))).alias("covered_")
    ).filter("not covered_")
    n = F.row_number().over(Window.partitionBy("company").orderBy("section"))
    return own.withColumn("n_", n).filter(F.col("n_") <= config.section_passes).select("company", "section", "ids")


def not_done(rows: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys are not among those done already."""
    return rows.join(done.select(*keys).distinct(), keys, "left_anti")


def companies(files: DataFrame, only: str | None = None) -> DataFrame:
    """Distinct companies, or the one asked for."""
    own = files.select("company").distinct()
    return own.filter(F.col("company") == only) if only else own


def annotated(chunks: DataFrame, ids: DataFrame) -> DataFrame:
    """(company, text): the asked-for windows with their sources, joined in order."""
    own = chunks.join(ids.select("company", "id").distinct(), ["company", "id"], "left_semi")
    piece = F.concat(F.lit("[From: "), F.array_join("source_files", ", "), F.lit("]\n"), "text")
    return own.groupBy("company").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", piece.alias("p")))), lambda s: s["p"]), "\n\n---\n\n").alias("text")
    )
