"""Substring dedup by hashed lines, and by hashed sentences inside lines.

Units are lines (with their line feed) and, inside lines, runs up to sentence marks and the space after them. A unit
counts if it has at least ``WORDS`` words; it is normalised (A-Z lower-cased, blanks to one space, ends trimmed) and
hashed to 128 bits. Of equal units the one of the least (id, row, offset) stays, all others go, and the removed ranges
are kept as offsets into the original text. Grouping is an aggregate with partial sums, so a line that a third of all
documents share costs one row a task; only repeated digests come back to the units.

Defined results: null text counts as empty and comes back as an empty text without ranges; rows with a null id rank
last; repeated rows are ranked by their place in the input, so all but one lose their units; extra columns are ignored
by ``remove_repeats`` and kept by ``clean``; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomleaf.llm._shared import free_name, staged, table, whole_text

WORDS = 8
SENTENCE = re.compile(r"[^.!?]+[.!?]* ?|[.!?]+ ?")
WIDE_SENTENCE = re.compile(r"[^.!?。！？]+[.!?。！？]* ?|[.!?。！？]+ ?")
UNSPACED = re.compile(r"[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")  # Thai to Khmer, kana, Han


def units(text: str, words: int = WORDS) -> Iterator[tuple[bytes, int, int]]:
    """(digest, start, stop) of each counted unit, lines and sentences; a line that is one sentence is told once."""
    at = 0
    for line in text.split("\n"):
        stop = at + len(line)
        own = line.encode().lower().split()
        if len(own) >= words:
            yield hashlib.md5(b"l " + b" ".join(own)).digest(), at, min(stop + 1, len(text))
            for m in SENTENCE.finditer(line):
                if m.end() - m.start() == len(line):
                    break
                part = m.group().encode().lower().split()
                if len(part) >= words:
                    yield hashlib.md5(b"s " + b" ".join(part)).digest(), at + m.start(), at + m.end()
        at = stop + 1


def weight(line: str) -> int:
    """Blank-separated words; in scripts without blanks two characters count as a word."""
    return max(len(line.encode().split()), len(UNSPACED.findall(line)) // 2)


def all_units(text: str, words: int = WORDS) -> Iterator[tuple[bytes, int, int]]:
    """As ``units``, and also sentences and lines of scripts without blanks, and runs of short lines.

    From each line below ``words``, a run goes on over short lines (blank ones between them count nothing) until it
    reaches ``words``, so that a passage is found wherever its lines begin. Equal runs of a text that overlap are told once.
    """
    yield from units(text, words)
    short: list[tuple[str, int, int, int]] = []  # normalised line, weight, start, stop
    told: dict[bytes, int] = {}
    at = 0
    for line in [*text.split("\n"), None]:
        size = words if line is None else weight(line)
        if line is not None and size < words:
            if size:
                short.append((b" ".join(line.encode().lower().split()), size, at, min(at + len(line) + 1, len(text))))
            at += len(line) + 1
            continue
        j, total = 0, 0
        for i in range(len(short)):
            while j < len(short) and total < words:
                total += short[j][1]
                j += 1
            if total < words:
                break
            digest = hashlib.md5(b"r " + b"\n".join(x[0] for x in short[i:j])).digest()
            if told.get(digest, 0) <= short[i][2]:
                told[digest] = short[j - 1][3]
                yield digest, short[i][2], short[j - 1][3]
            total -= short[i][1]
        short = []
        if line is None:
            break
        if UNSPACED.search(line):
            parts = [m.span() for m in WIDE_SENTENCE.finditer(line)]
            if len(line.encode().split()) < words:
                yield hashlib.md5(b"l " + b" ".join(line.encode().lower().split())).digest(), at, min(at + len(line) + 1, len(text))
            for a, b in parts:
                if weight(line[a:b]) >= words:
                    yield hashlib.md5(b"w " + b" ".join(line[a:b].encode().lower().split())).digest(), at + a, at + b
        at += len(line) + 1


def _units(docs: DataFrame, row: str, id_col: str, text_col: str, words: int, every: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, found = [], []
            for k, text in enumerate(batch.column(2).to_pylist()):
                for digest, start, stop in told(text, words):
                    keys.append(k)
                    found.append((*struct.unpack("<qq", digest), start, stop))
            at = pa.array(keys, pa.int64())
            cols = list(zip(*found, strict=True)) if found else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True))], names=out.names
            )

    told = all_units if every else units
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
    out = T.StructType(
        [
            T.StructField("id_", docs.schema[id_col].dataType),
            T.StructField("row_", T.LongType()),
            T.StructField("h1_", T.LongType()),
            T.StructField("h2_", T.LongType()),
            T.StructField("start_", T.IntegerType()),
            T.StructField("stop_", T.IntegerType()),
        ]
    )
    return docs.select(F.col(id_col).alias("id_"), F.col(row).alias("row_"), whole_text(text_col).alias("text_")).mapInArrow(run, out)


def _mark(rows: DataFrame, row: str, id_col: str, text_col: str, words: int, every: bool) -> DataFrame:
    """(row, spans_): for each row that loses something its removed ranges."""
    found = staged(_units(rows, row, id_col, text_col, words, every), "units")
    # The repeated digests are written before they are joined: both sides of that join then come from a shuffle of their
    # own, so that adaptive execution can split the digest of a line that very many documents have.
    rank = F.struct(F.col("id_").isNull().alias("none"), F.col("id_").alias("id"), F.col("row_").alias("row"), F.col("start_").alias("start"))
    repeated = staged(
        found.groupBy("h1_", "h2_")
        .agg(F.count(F.lit(1)).alias("n_"), F.min(rank).alias("first_"))
        .filter("n_ > 1")
        .select("h1_", "h2_", "first_.row", "first_.start"),
        "repeated",
    )
    gone = found.join(repeated, ["h1_", "h2_"]).filter("row_ <> row or start_ <> start")
    return gone.groupBy(F.col("row_").alias(row)).agg(
        F.array_sort(F.collect_list(F.struct(F.col("start_").alias("start"), F.col("stop_").alias("stop")))).alias("spans_")
    )


def _cut(rows: DataFrame, marks: DataFrame, row: str, text_col: str) -> DataFrame:
    """``rows`` with the text cut and a column spans_ of merged ranges."""
    names = [c for c in rows.columns if c != row]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = [], []
            for text, own in zip(batch.column(text_col).to_pylist(), batch.column("spans_").to_pylist(), strict=True):
                text, merged = text or "", []
                for s in own or ():
                    if merged and s["start"] <= merged[-1]["stop"]:
                        merged[-1]["stop"] = max(merged[-1]["stop"], s["stop"])
                    else:
                        merged.append(dict(s))
                at, kept = 0, []
                for s in merged:
                    kept.append(text[at : s["start"]])
                    at = s["stop"]
                kept.append(text[at:])
                texts.append("".join(kept))
                spans.append(merged)
            cols = [pa.array(texts, pa.string()) if c == text_col else batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))], names=[*names, "spans_"]
            )

    span = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())]))
    out = T.StructType([*(T.StructField(c, T.StringType()) if c == text_col else rows.schema[c] for c in names), T.StructField("spans_", span)])
    return rows.join(marks, row, "left").select(*names, "spans_").mapInArrow(run, out)


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, every: bool = False) -> DataFrame:
    """``docs`` with repeated units (``every``: those of ``all_units``) cut from the text, the removed ranges in ``spans_``; other columns stay, but for one of that name."""
    docs = docs.drop("spans_")
    row = free_name(docs, "row_")
    rows = staged(docs.withColumn(row, F.monotonically_increasing_id()), "documents")
    return _cut(rows, _mark(rows, row, id_col, text_col, words, every), row, text_col)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """(id, text, removed): what is left of each text, and the removed ranges as (start, stop) in code points."""
    return clean(docs.select(id_col, text_col), id_col, text_col, words).select(id_col, F.col(text_col).alias("text"), F.col("spans_").alias("removed"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"))
    ranges = F.array_join(F.transform("removed", lambda s: F.concat_ws("-", s["start"].cast("string"), s["stop"].cast("string"))), ",")
    return out.select("doc_id", "text", F.size("removed").cast("long").alias("n_removed"), ranges.alias("removed_ranges"))


ORACLE = """
WITH rows_ AS (SELECT row_number() OVER (ORDER BY doc_id) AS row_, doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT row_, doc_id, line, k, start, length(text) AS total FROM (
    SELECT row_, doc_id, text, line, k, coalesce(sum(length(line) + 1) OVER (PARTITION BY row_ ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
    FROM (SELECT row_, doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS k FROM rows_))),
parts AS (
  SELECT row_, doc_id, part, start + coalesce(sum(length(part)) OVER (PARTITION BY row_, k ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM (SELECT row_, doc_id, k, start, unnest(p) AS part, generate_subscripts(p, 1) AS j
        FROM (SELECT *, regexp_extract_all(line, '[^.!?]+[.!?]* ?|[.!?]+ ?') AS p FROM lines) WHERE len(p) > 1)),
raw AS (
  SELECT row_, doc_id, 'l ' AS kind, line AS unit, start, least(start + length(line) + 1, total) AS stop FROM lines
  UNION ALL SELECT row_, doc_id, 's ', part, start, start + length(part) FROM parts),
words AS (SELECT *, list_filter(string_split_regex(translate(unit, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \\t-\\r]+'), lambda x: x <> '') AS w FROM raw),
counted AS (SELECT row_, doc_id, kind || array_to_string(w, ' ') AS key, start, stop FROM words WHERE len(w) >= 8),
gone AS (SELECT row_, start, stop FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id, row_, start) AS n FROM counted) WHERE n > 1),
flags AS (SELECT *, CASE WHEN start <= max(stop) OVER (PARTITION BY row_ ORDER BY start, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM gone),
islands AS (SELECT *, sum(fresh) OVER (PARTITION BY row_ ORDER BY start, stop ROWS UNBOUNDED PRECEDING) AS island FROM flags),
spans AS (SELECT row_, island, min(start) AS start, max(stop) AS stop FROM islands GROUP BY ALL),
chars AS (
  SELECT row_, list(start ORDER BY start) AS a, list(stop ORDER BY start) AS b, count(*) AS n,
         string_agg(CAST(start AS BIGINT) || '-' || CAST(stop AS BIGINT), ',' ORDER BY start) AS ranges FROM spans GROUP BY row_)
SELECT doc_id,
  CASE WHEN n IS NULL THEN text ELSE array_to_string(list_transform(range(0, n + 1), lambda i: substr(text, CAST(CASE WHEN i = 0 THEN 0 ELSE b[i] END AS BIGINT) + 1, CAST(CASE WHEN i = n THEN length(text) ELSE a[i + 1] END - CASE WHEN i = 0 THEN 0 ELSE b[i] END AS BIGINT))), '') END AS text,
  coalesce(n, 0) AS n_removed, coalesce(ranges, '') AS removed_ranges
FROM rows_ LEFT JOIN chars USING (row_)
"""

QUERIES = {"op3_substring_dedup": op3_substring_dedup}
ORACLE_SQL = {"op3_substring_dedup": ORACLE}
