"""Exact top-k search by inner product with vector-approximation files.

Every task of the scan writes its vectors in blocks: one file with a 4-bit cell for each component, one with the exact
integers. A search task takes one group of queries through one slice of blocks: the cells give an upper and a lower
bound for each score, exact vectors are read in the order of the upper bounds, and a block is done when the kth score
found is above every bound left. Queries are never broadcast and pairs are never rows: only k rows a query and slice
leave a task.

Defined results: vectors that are null, empty, or hold null or non-finite components take no part; vectors are compared
with vectors of their own length only; of repeated ids each row is a query and a candidate of its own; a row is not
its own candidate; null ids are candidates, ranked after others, but no queries; scores beyond 64 bits are held at
the limit; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fathomleaf.llm._shared import cores, open_file, read_file, staged, table, work_dir, write_file

K, EVERY, SCALE = 20, 20, 64
BLOCK_ROWS, GROUP_QUERIES, LEAST_QUERIES, SLICE_BLOCKS = 32_768, 2048, 256, 64
BOUNDS = 1 << 22  # numbers in a matrix of bounds
CELLS = 16
LARGE = 1 << 26
LIMIT = (1 << 63) - 1


def _integers(values: list | None) -> np.ndarray | None:
    """floor(64 x), or None for a vector that takes no part."""
    if not values or any(v is None for v in values):
        return None
    x = np.array(values, np.float64)
    if not np.isfinite(x).all():
        return None
    x = np.floor(SCALE * x)
    return np.clip(x, -(2.0**62), 2.0**62).astype(np.int64)


def _write_block(folder: str, part: int, ids: list, vectors: list[np.ndarray], nulls: list[bool]) -> tuple:
    name = f"{folder}/{part}-{uuid.uuid4().hex}"
    x = np.stack(vectors)
    low = x.min(axis=0)
    width = np.maximum(1, (x.max(axis=0) - low) // CELLS + 1)
    cells = ((x - low) // width).astype(np.uint8)
    if cells.shape[1] % 2:
        cells = np.pad(cells, ((0, 0), (0, 1)))
    out = io.BytesIO()
    np.savez(out, ids=np.array(ids, np.int64), nulls=np.array(nulls), low=low, width=width, cells=cells[:, ::2] << 4 | cells[:, 1::2])
    write_file(f"{name}.cells", out.getvalue())
    write_file(f"{name}.exact", x.astype("<i8").tobytes())
    queries = sum(not z and i % EVERY == 0 for i, z in zip(ids, nulls, strict=True))
    return name, x.shape[1], len(x), queries


def build(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Write the files; (path, dims, n, queries), one row a block."""
    folder = work_dir(vectors.sparkSession, "va")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = TaskContext.get().partitionId(), {}
        rows = []

        def flush(d: int) -> None:
            if d in held:
                rows.append(_write_block(folder, part, *held.pop(d)))

        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x = _integers(v)
                if x is None:
                    continue
                ids, xs, nulls = held.setdefault(len(x), ([], [], []))
                ids.append(i or 0)
                nulls.append(i is None)
                xs.append(x)
                if len(ids) == BLOCK_ROWS:
                    flush(len(x))
        for d in list(held):
            flush(d)
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int32(), pa.int64(), pa.int64()), strict=True)],
            names=["path", "dims", "n", "queries"],
        )

    return staged(
        vectors.select(
            F.col(id_col).cast("long"), F.col(vector_col).cast("array<double>")
        ).mapInArrow(run, "path string, dims int, n long, queries long"),
        "va-blocks",
    )


class Block:
    """One block's cells; exact vectors are read when asked for."""

    def __init__(self, path: str) -> None:
        self.path = path
        z = np.load(io.BytesIO(read_file(f"{path}.cells")))
        self.ids, self.nulls, self.low, self.width = z["ids"], z["nulls"], z["low"], z["width"]
        both = z["cells"]
        self.dims = len(self.low)
        self.cells = np.stack((both >> 4, both & 15), axis=2).reshape(len(both), -1)[:, : self.dims]
        self.large = bool((np.abs(self.low.astype(np.float64)) + CELLS * self.width.astype(np.float64)).max() > LARGE)
        self._all: np.ndarray | None = None

    def exact(self, rows: np.ndarray) -> np.ndarray:
        if self._all is None and len(rows) * 8 < len(self.ids):
            size = 8 * self.dims
            with open_file(f"{self.path}.exact") as src:
                return np.stack([np.frombuffer(src.read_at(size, int(r) * size), "<i8") for r in rows])
        if self._all is None:
            self._all = np.frombuffer(read_file(f"{self.path}.exact"), "<i8").reshape(-1, self.dims)
        return self._all[rows]

    def queries(self) -> np.ndarray:
        return np.nonzero(~self.nulls & (self.ids % EVERY == 0))[0]


def _products(x: np.ndarray, q: np.ndarray, large: bool) -> np.ndarray:
    if not large:
        return x @ q
    return np.array([max(-LIMIT - 1, min(LIMIT, sum(int(a) * int(b) for a, b in zip(row, q, strict=True)))) for row in x], np.int64)


class Best:
    """The k best so far of one query: by score, then known before null ids, then smaller id."""

    def __init__(self, k: int, floor: float = -np.inf) -> None:
        self.k, self.rows, self.floor = k, [], floor

    def add(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        new = list(zip((-scores).tolist() if (scores > -LIMIT).all() else [-int(s) for s in scores], nulls.tolist(), ids.tolist(), strict=True))
        self.rows = sorted(self.rows + new)[: self.k]

    def kth(self) -> float:
        """What a score must reach; ``floor`` is what k rows found elsewhere have reached."""
        return max(self.floor, -self.rows[-1][0]) if len(self.rows) == self.k else self.floor


def scan(block: Block, queries: np.ndarray, own: np.ndarray, best: list[Best], large: bool) -> None:
    """Take queries (rows of integers) through one block; ``own``: each one's row in it, or -1.

    The bounds of a few queries at a time are in memory, ``BOUNDS`` numbers.
    """
    some = max(1, BOUNDS // max(1, len(block.ids)))
    for at in range(0, len(queries), some):
        _scan(block, queries[at : at + some], own[at : at + some], best[at : at + some], large or block.large)


def _scan(block: Block, queries: np.ndarray, own: np.ndarray, best: list[Best], large: bool) -> None:
    q = queries.astype(np.float64)
    step = q * block.width
    spare = q * (block.width - 1.0)
    middle = step @ block.cells.T.astype(np.float64) + (q @ block.low.astype(np.float64))[:, None]
    slack = np.abs(middle).max(axis=1) * 1e-9 + 1.0 if large else np.zeros(len(q))
    up, down = np.maximum(spare, 0).sum(axis=1) + slack, np.minimum(spare, 0).sum(axis=1) - slack
    for i in range(len(q)):
        bound, found = middle[i] + up[i], best[i]
        if own[i] >= 0:
            bound[own[i]] = -np.inf
        floor = found.kth()
        if len(bound) > found.k:
            floor = max(floor, np.partition(bound, len(bound) - found.k)[-found.k] - up[i] + down[i])
        rows = np.nonzero((bound >= floor) & (bound > -np.inf))[0]
        rows = rows[np.argsort(-bound[rows], kind="stable")]
        for at in range(0, len(rows), 256):
            some = rows[at : at + 256]
            if bound[some[0]] < found.kth():
                break
            found.add(_products(block.exact(some), queries[i], large), block.ids[some], block.nulls[some])


def search(blocks: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score) over the blocks that ``build`` wrote."""
    spark = blocks.sparkSession
    n_blocks, n_queries = blocks.agg(F.count(F.lit(1)), F.coalesce(F.sum("queries"), F.lit(0))).first()
    size = max(LEAST_QUERIES, min(GROUP_QUERIES, -(-n_queries // max(1, cores(spark)))))
    each = Window.partitionBy("dims").orderBy("path")
    numbered = blocks.withColumn("slice_", F.floor((F.row_number().over(each) - 1) / SLICE_BLOCKS))
    parts = numbered.filter("queries > 0").select("dims", "path", F.explode(F.sequence(F.lit(0), F.floor((F.col("queries") - 1) / size))).alias("part_"))
    slices = numbered.groupBy("dims", "slice_").agg(F.array_sort(F.collect_list("path")).alias("paths"))
    work = parts.join(slices, "dims").select("path", "part_", "paths").repartition(max(1, min(4096, n_blocks * (1 + n_queries // max(1, n_blocks * size)))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, part, paths in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                home = Block(path)
                rows = home.queries()[part * size : (part + 1) * size]
                vectors, best = home.exact(rows), [Best(k) for _ in rows]
                if path not in paths:  # the home block's kth score bounds what the slice must look at
                    scan(home, vectors, rows, best, home.large)
                    best = [Best(k, b.kth()) for b in best]
                for p in paths:
                    block = home if p == path else Block(p)
                    scan(block, vectors, rows if p == path else np.full(len(rows), -1), best, home.large)
                out = [(f"{path}:{r}", int(home.ids[r]), None if z else i, -s) for r, b in zip(rows.tolist(), best, strict=True) for s, z, i in b.rows]
                cols = list(zip(*out, strict=True)) if out else [[]] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                    names=["key_", "query_id", "vec_id", "score"],
                )

    found = work.mapInArrow(run, "key_ string, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("key_").orderBy(F.desc("score"), F.asc_nulls_last("vec_id")))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(build(table(spark, sf_dir, "embeddings")))


ORACLE = """
WITH v AS (SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, q.n AS qn, c.vec_id AS vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.n <> c.n AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY qn ORDER BY score DESC, vec_id NULLS LAST) AS r FROM s) WHERE r <= 20
"""

QUERIES = {"op6_exact_top_k": op6_exact_top_k}
ORACLE_SQL = {"op6_exact_top_k": ORACLE}
