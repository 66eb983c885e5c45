"""Quality classifier by compression: zstandard dictionaries from good and from bad labelled text.

A whole text is compressed window by window with either dictionary. What is scored is the difference of the compressed
sizes, normalised once by the text's and once by the compressed size, beside the log of the compressed share; a
logistic calibration, fitted on labelled rows that no dictionary has seen, makes it a probability of label 1.

The fit takes a bounded sample: at most ``SAMPLE`` labelled rows of either class of at most ``LONGEST`` characters, the
first in the order of a hash of the id. Every row is scored.

Defined results: null text counts as empty, and empty texts get a score like any other; a null id is not held out; rows
with null labels teach nothing; when a class has no labelled rows, every score is the share of label 1 (1.0 if none);
repeated rows each give a row; extra columns are ignored (``scored`` keeps them); an empty table gives no rows.
"""

from __future__ import annotations

import functools
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomleaf.llm._shared import free_name, table, whole_text

SAMPLE = 3000
LONGEST = 20_000
WINDOW = 1000
DICTIONARY = 112_640
LEVEL = 3
FRAME = 9
THRESHOLD = 0.7


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary; the texts themselves where there are too few of them to train one."""
    parts = [t[i : i + 2 * WINDOW] for t in texts for i in range(0, len(t), 2 * WINDOW)]
    try:
        return zstandard.train_dictionary(DICTIONARY, parts).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(parts)[:DICTIONARY]


@functools.lru_cache(maxsize=8)
def _compressor(data: bytes) -> zstandard.ZstdCompressor:
    own = zstandard.ZstdCompressionDict(data)
    own.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=own, write_content_size=False, write_checksum=False, write_dict_id=False)


def _size(data: bytes, with_dictionary: bytes) -> int:
    compress = _compressor(with_dictionary).compress
    return max(1, sum(len(compress(data[i : i + WINDOW])) - FRAME for i in range(0, max(1, len(data)), WINDOW)))


def features(text: bytes, good: bytes, bad: bytes) -> tuple[float, float, float]:
    g, b, n = _size(text, good), _size(text, bad), max(1, len(text))
    return 10 * (b - g) / n, 10 * (b - g) / (b + g), float(np.log(g / n))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    x, w = np.c_[np.ones(len(x)), x], np.zeros(x.shape[1] + 1)
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (p - y) + ridge * w)
    return w


class Model:
    """Two dictionaries and the calibration; ``share`` alone if a class was missing."""

    def __init__(self, rows: list[tuple[str, int]]) -> None:
        self.good = self.bad = b""
        self.weights: list[float] | None = None
        labels = [q for _, q in rows]
        self.share = float(np.mean(labels)) if rows else 1.0
        if len(set(labels)) < 2:
            return
        by = {q: [t.encode() for t, x in rows if x == q] for q in (0, 1)}
        half = {q: max(1, len(v) // 2) for q, v in by.items()}
        self.bad, self.good = (dictionary(by[q][: half[q]]) for q in (0, 1))
        rest = {q: v[half[q] :] or v for q, v in by.items()}
        x = np.array([features(t, self.good, self.bad) for q in (0, 1) for t in rest[q]])
        self.weights = _logistic(x, np.repeat([0.0, 1.0], [len(rest[0]), len(rest[1])])).tolist()

    def score(self, text: str) -> float:
        if self.weights is None:
            return self.share
        x = np.dot(self.weights, (1.0, *features(text.encode(), self.good, self.bad)))
        return float(1 / (1 + np.exp(-np.clip(x, -30, 30))))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """Fit on labelled rows that are not held out."""
    known = labels.filter(
        F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col)
    ).groupBy(id_col).agg(F.min(label_col).cast("int").alias("label_")).withColumn("at_", F.xxhash64(id_col))
    chosen = known.filter("label_ = 0").orderBy("at_", id_col).limit(SAMPLE).unionByName(known.filter("label_ = 1").orderBy("at_", id_col).limit(SAMPLE))
    texts = docs.select(id_col, whole_text(text_col).alias("text_")).filter(F.length("text_") <= LONGEST)
    rows = texts.join(F.broadcast(chosen), id_col).orderBy("at_", id_col, "text_").limit(2 * SAMPLE).select("text_", "label_").collect()  # bounded by SAMPLE and LONGEST
    return Model([(r[0], r[1]) for r in rows])


def scored(docs: DataFrame, model: Model, text_col: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with a column ``score``, which takes the place of one of that name."""
    docs = docs.drop(score)
    packed = pickle.dumps(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pickle.loads(packed)
        for batch in batches:
            told = [own.score(t or "") for t in batch.column(text_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(told, pa.float64())], names=out.names)

    out = T.StructType([*docs.schema, T.StructField(score, T.DoubleType())])
    return docs.mapInArrow(run, out)


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose score is at least ``threshold``, with all their columns."""
    score = free_name(docs, "score_")
    return scored(docs, fit(docs, labels, id_col, text_col), text_col, score).filter(F.col(score) >= threshold).drop(score)


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = scored(docs, fit(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


QUERIES = {"op10_quality_classifier": op10_quality_classifier}
ORACLE_SQL: dict[str, str] = {}
