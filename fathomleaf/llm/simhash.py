"""SimHash near-duplicate detection over whole texts.

Fingerprints that differ in at most two of 64 bits share two of four 16-bit blocks, so each of the six pairs of blocks
is one table of buckets; fingerprints meet in a bucket and the Hamming distance decides. Equal fingerprints count
once. Buckets over ``BUCKET`` fingerprints do not enumerate pairs: there, two fingerprints are within two bits exactly
if they, or one-bit changes of them, coincide, and at most 65 fingerprints can meet in such a value.

Defined results: null or blank text has fingerprint zero and is linked like any other; repeated rows each give a row;
null ids never name a component unless all its ids are null; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomleaf.llm._shared import cores, free_name, staged, table, whole_text
from fathomleaf.operators.state import arrow_rows
from fathomleaf.llm.components import components

BUCKET = 32
BLOCKS = 4
BITS = 2
SEED = 42


def fingerprint(text: str, words: int = 3) -> int:
    """The majority, bit by bit, of the XXH64 of all word shingles; unsigned."""
    h = _hashes(text, words)
    return _majority(h) if len(h) else 0


def _hashes(text: str, words: int) -> np.ndarray:
    """XXH64 of every shingle; of the whole sequence of fewer words."""
    own = text.encode("utf-8").lower().split()
    if not own:
        return np.zeros(0, np.uint64)
    joined = b" ".join(own)
    if len(own) <= words:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        stops = np.cumsum([len(w) + 1 for w in own])
        ends = (stops - 1)[words - 1 :].tolist()
        starts = [0, *stops[: len(own) - words].tolist()]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends, strict=True)]
    return np.array(hashes, np.uint64)


def _majority(h: np.ndarray) -> int:
    ones = np.zeros(64, np.int64)
    for k in range(0, len(h), 1 << 16):
        ones += np.unpackbits(h[k : k + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, keep: list[str], text_col: str = "text", words: int = 3) -> DataFrame:
    """The columns ``keep`` and ``fp_`` (long, the fingerprint's bits)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, words) for t in batch.column(batch.num_columns - 1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fps)], names=out.names)

    out = T.StructType([*(docs.schema[c] for c in keep), T.StructField("fp_", T.LongType())])
    return docs.select(*keep, whole_text(text_col).alias("text_")).mapInArrow(run, out)


def links(fps: DataFrame) -> DataFrame:
    """(a, b): pairs of different fingerprints at most two bits apart, enough of them to connect all such pairs."""
    width = 64 // BLOCKS
    block = [F.shiftrightunsigned("fp_", width * k).bitwiseAND(F.lit((1 << width) - 1)) for k in range(BLOCKS)]
    keys = [F.shiftleft(block[i], width).bitwiseOR(block[j]).bitwiseOR(F.lit(t << 32)) for t, (i, j) in enumerate(combinations(range(BLOCKS), BLOCKS - BITS))]
    members = fps.select("fp_", F.explode(F.array(*keys)).alias("key_"))
    sizes = members.groupBy("key_").agg(F.count(F.lit(1)).alias("n_")).filter("n_ > 1")
    met = members.join(sizes, "key_")
    few = met.filter(F.col("n_") <= BUCKET)
    left, right = few.select("key_", F.col("fp_").alias("a")), few.select("key_", F.col("fp_").alias("b"))
    pairs = left.join(right, "key_").filter((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= BITS)).select("a", "b")
    crowd = met.filter(F.col("n_") > BUCKET).select("fp_").distinct()
    values = F.transform(
        F.sequence(F.lit(-1), F.lit(63)),
        lambda k: F.when(k < 0, F.col("fp_")).otherwise(F.col("fp_").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), k))),
    )
    hubs = crowd.select("fp_", F.explode(values).alias("value_")).groupBy("value_").agg(F.collect_set("fp_").alias("all_")).filter(F.size("all_") > 1)
    near = hubs.select(F.array_min("all_").alias("a"), F.explode("all_").alias("b")).filter("a <> b")
    return pairs.unionByName(near).distinct()


def near_components(rows: DataFrame, id_col: str) -> DataFrame:
    """(fp_, component_id) for every fingerprint of ``rows`` (id, fp_), written before: least id reachable."""
    firsts = staged(rows.groupBy("fp_").agg(F.min(id_col).alias("first_")), "firsts")
    linked = components(links(firsts.select("fp_"))).withColumnRenamed("node", "fp_")
    named = linked.join(firsts, "fp_")
    roots = named.groupBy("root").agg(F.min("first_").alias("least_"))
    least = staged(named.select("fp_", "root").join(roots, "root").select("fp_", "least_"), "components")
    return firsts.join(least, "fp_", "left").select("fp_", F.coalesce("least_", "first_").alias("component_id"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(id, fingerprint hex, component_id), one row a document."""
    rows = staged(fingerprints(docs, [id_col], text_col, words), "fingerprints")
    return rows.join(near_components(rows, id_col), "fp_").select(id_col, F.lower(F.lpad(F.hex("fp_"), 16, "0")).alias("fingerprint"), "component_id")


class Wide:
    """A long SimHash for similarity thresholds that 64 bits cannot tell apart.

    Shingles are count-sketched into ``bits`` signed buckets, and the signs of a Hadamard transform are the fingerprint.
    Two texts of Jaccard similarity J (cosine 2J / (1 + J) for sets) differ in a share acos(cosine) / pi of the bits. The
    fingerprint is split into ``blocks`` of ``width`` bits, and so many that two texts at the threshold share one with
    probability ``RECALL``, whatever the width; more alike texts share many. The width only sets the work: ``width_for`` is
    wide enough that ``n`` unlike texts seldom share a block. The fingerprints choose candidates, and two texts of a
    block whose numbers of shingles differ too much for the threshold are none; ``_alike`` decides by the sets of shingles
    themselves, so that no pair below the threshold is ever linked.
    """

    RECALL = 0.98

    def __init__(self, width: int, similarity: float = 0.8, words: int = 5, bits: int = 4096) -> None:
        self.words, self.similarity, self.width = words, similarity, width
        share = float(np.arccos(2 * similarity / (1 + similarity)) / np.pi)
        self.blocks = int(np.ceil(np.log(1 - self.RECALL) / np.log1p(-((1 - share) ** self.width))))
        self.bits = max(bits, 1 << int(np.ceil(np.log2(self.width * self.blocks))))
        spread = 2 * (share * (1 - share) / self.bits) ** 0.5
        self.distance = int(self.bits * (share + spread))
        self.near = int(FIRST * share + 3.5 * (FIRST * share * (1 - share)) ** 0.5)  # for the first bits alone

    @staticmethod
    def width_for(n: int) -> int:
        return min(40, max(12, int(np.ceil(np.log2(max(2, n)))) + 1))

    def close_sizes(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether sets of these sizes can be as alike as the threshold asks."""
        return np.minimum(x, y) >= self.similarity * np.maximum(x, y) - 1e-9

    @staticmethod
    def brief(packed: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The first bits of fingerprints above the sizes of their sets (as far as they fit), in one integer each."""
        first = np.ascontiguousarray(packed[:, :8]).view("<u8")[:, 0] << np.uint64(64 - FIRST)
        return (first | np.minimum(size, SIZES).astype(np.uint64)).view(np.int64)

    def may_be_close(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether two ``brief`` integers leave it open that their texts are alike."""
        x, y = x.view(np.uint64), y.view(np.uint64)
        a, b = ((v & np.uint64(SIZES)).astype(np.int64) for v in (x, y))
        return (np.bitwise_count((x ^ y) >> np.uint64(64 - FIRST)) <= self.near) & (self.close_sizes(a, b) | (np.maximum(a, b) == SIZES))

    def shingles(self, text: str) -> np.ndarray:
        """The hashes of the different shingles, sorted."""
        return np.unique(_hashes(text, self.words))

    def sketch(self, text: str) -> np.ndarray:
        out = np.zeros(self.bits, np.float32)
        h = self.shingles(text)
        if len(h):
            np.add.at(out, (h >> np.uint64(1)).astype(np.int64) & (self.bits - 1), np.where(h & np.uint64(1), np.float32(1), np.float32(-1)))
        return out

    def fingerprints(self, texts: list[str]) -> np.ndarray:
        """One row of bits a text."""
        x = np.stack([self.sketch(t) for t in texts]) if texts else np.zeros((0, self.bits), np.float32)
        signs = np.where(np.random.default_rng(SEED).random(self.bits) < 0.5, np.float32(-1), np.float32(1))
        x *= signs
        h = 1
        while h < self.bits:
            y = x.reshape(len(x), -1, 2, h)
            x = np.stack((y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]), axis=2).reshape(len(x), self.bits)
            h *= 2
        return x > 0

    def keys(self, packed: np.ndarray) -> np.ndarray:
        """Block keys, one row a fingerprint: the block's number above its bits."""
        bits = np.unpackbits(packed, axis=1)[:, : self.blocks * self.width].reshape(len(packed), self.blocks, self.width)
        return bits.astype(np.int64) @ (1 << np.arange(self.width, dtype=np.int64)) + (np.arange(self.blocks, dtype=np.int64) << 40)


FIRST = 48  # bits of a fingerprint that go with a block's key, above the size of its set
SIZES = (1 << (64 - FIRST)) - 1
CROWD = 8
TILE = 256
CHUNK = 256
BATCH = 2000  # rows with texts, fingerprints or sets of shingles that are in memory together


def _wide(rows: DataFrame, keep: list[str], text_col: str, w: Wide) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                texts = part.column(part.num_columns - 1).to_pylist()
                packed = np.packbits(w.fingerprints(texts), axis=1)
                sets = [w.shingles(t) for t in texts]
                own = [hashlib.md5(x.tobytes()).digest() for x in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns[:-1],
                        pa.array([p.tobytes() for p in packed], pa.binary()),
                        pa.array(own, pa.binary()),
                        pa.array([len(x) for x in sets], pa.int32()),
                    ],
                    names=out.names,
                )

    out = T.StructType(
        [
            *(rows.schema[c] for c in keep),
            T.StructField("fp_", T.BinaryType()),
            T.StructField("set_", T.BinaryType()),
            T.StructField("size_", T.IntegerType()),
        ]
    )
    return rows.select(*keep, whole_text(text_col).alias("text_")).mapInArrow(run, out)


def _groups(batches: Iterator[pa.RecordBatch], by: int) -> Iterator[list[np.ndarray]]:
    """Columns of sorted rows, cut only where the first ``by`` columns change."""
    rest: list[np.ndarray] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if rest is not None:
            cols = [np.concatenate(x) for x in zip(rest, cols, strict=True)]
        cut = len(cols[0]) - int(np.argmin(np.append(np.logical_and.reduce([c == c[-1] for c in cols[:by]])[::-1], False)))
        if cut:
            yield [c[:cut] for c in cols]
        rest = [c[cut:] for c in cols]
    if rest is not None:
        yield rest


def _begins(*keys: np.ndarray) -> np.ndarray:
    """Places where one of ``keys`` changes, and the end."""
    return np.flatnonzero(np.concatenate(([True], np.logical_or.reduce([k[1:] != k[:-1] for k in keys]), [True])))


def _wide_links(nodes: DataFrame, w: Wide, blocks: tuple[int, int], whole: bool = True) -> DataFrame:
    """(a, b): nodes (node, fp_, root, size_) of different roots whose fingerprints are within ``w.distance`` bits.

    One shuffle deals out (block key, node, first bits and size, root), sorted. Members of a block meet in pairs; blocks of more
    than ``CROWD`` members are cut into tiles of ``TILE``, and any two tiles (and each with itself) are a cell that some
    task gets with the whole fingerprints, so that every pair of a block is compared and only close ones are listed.
    Members go by root, and cells of one root are left out. Not ``whole``: in crowded blocks each meets only the block's
    first and the one before it in the order of the first bits, which is enough to make dense groups one root.
    """
    lo, hi = blocks

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                packed = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint8).reshape(part.num_rows, -1)
                node, root, size = (part.column(c).to_numpy(zero_copy_only=False) for c in (0, 2, 3))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(x) for x in (
                            w.keys(packed)[:, lo:hi].reshape(-1), *(np.repeat(v, hi - lo) for v in (node, w.brief(packed, size), root))
                        )
                    ],
                    names=["key", "node", "sig", "root"],
                )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs (a, b, -1, 0), and members of cells (node, tile, key, cell)."""
        for key, node, sig, root in _groups(batches, 1):
            begin = _begins(key)
            size = np.diff(begin)
            crowded = np.repeat(size > CROWD, size)
            hub = np.repeat(begin[:-1], size)
            a, b = [], []
            for k in range(0, CROWD):
                x, y = (hub, np.arange(len(key))) if k == 0 else (np.arange(len(key) - k), np.arange(k, len(key)))
                ok = (key[x] == key[y]) & (node[x] != node[y]) & (root[x] != root[y]) & w.may_be_close(sig[x], sig[y])
                ok &= ~crowded[y] if k > 1 or whole else True
                a.append(node[x[ok]])
                b.append(node[y[ok]])
            a, b = np.concatenate(a), np.concatenate(b)
            pairs = np.unique(np.stack((np.minimum(a, b), np.maximum(a, b)), axis=1), axis=0) if len(a) else np.zeros((0, 2), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (pairs[:, 0], pairs[:, 1], np.full(len(pairs), -1), np.zeros(len(pairs), np.int64))],
                names=["a", "b", "key", "cell"],
            )
            for g in np.flatnonzero(size > CROWD) if whole else ():
                at = slice(begin[g], begin[g + 1])
                order = np.lexsort((node[at], root[at]))
                own, of = node[at][order], root[at][order]
                for i in range(0, len(own), TILE):
                    for j in range(i, len(own), TILE):
                        if of[i] != of[min(j + TILE, len(of)) - 1]:
                            some = own[i : i + TILE] if i == j else np.concatenate((own[i : i + TILE], own[j : j + TILE]))
                            tile = np.arange(len(some)) // TILE
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(x) for x in (some, tile, np.full(len(some), key[at][0]), np.full(len(some), i // TILE << 32 | j // TILE))],
                                names=["a", "b", "key", "cell"],
                            )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, cell, node, tile, root, count, fp in _groups(batches, 2):
            begin = _begins(key, cell)
            for lo, hi in zip(begin[:-1], begin[1:], strict=True):
                at = lo + np.argsort(tile[lo:hi], kind="stable")
                bits = np.frombuffer(b"".join(fp[at]), "<u8").reshape(len(at), -1)
                second = int(np.searchsorted(tile[at], 1))
                inner = second == len(at)
                a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                for x in range(second):
                    y = np.arange(x + 1 if inner else second, len(at))
                    y = y[(root[at[y]] != root[at[x]]) & w.close_sizes(count[at[y]], count[at[x]])]
                    y = y[np.bitwise_count(bits[y] ^ bits[x]).sum(axis=1, dtype=np.int64) <= w.distance]
                    a.append(np.minimum(node[at[y]], node[at[x]]))
                    b.append(np.maximum(node[at[y]], node[at[x]]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u8").reshape(batch.num_rows, -1) for c in (2, 3))
            ok = pa.array(np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64) <= w.distance)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(ok), batch.column(1).filter(ok)], names=["a", "b"])

    n = cores(nodes.sparkSession)
    keys = nodes.select("node", "fp_", "root", "size_").mapInArrow(explode, "key long, node long, sig long, root long")
    dealt = keys.repartition(n, "key").sortWithinPartitions("key", "sig", "node")
    met = staged(dealt.mapInArrow(meet, "a long, b long, key long, cell long"), "pairs")
    pairs = met.filter("key < 0").select("a", "b").distinct()
    left, right = nodes.select(F.col("node").alias("a"), F.col("fp_").alias("x_")), nodes.select(F.col("node").alias("b"), F.col("fp_").alias("y_"))
    close = pairs.join(left, "a").join(right, "b").select("a", "b", "x_", "y_").mapInArrow(verify, "a long, b long")
    if not whole:
        return close
    members = met.filter("key >= 0").select(
        "key", "cell", F.col("a").alias("node"), F.col("b").alias("tile")
    ).join(nodes, "node").select("key", "cell", "node", "tile", "root", "size_", "fp_")
    cells = members.repartition(n, "key", "cell").sortWithinPartitions("key", "cell")
    return close.unionByName(cells.mapInArrow(compare, "a long, b long")).distinct()


def _alike(pairs: DataFrame, rows: DataFrame, row: str, text_col: str, w: Wide) -> DataFrame:
    """Those of ``pairs`` (a, b: rows of ``rows``) whose sets of shingles have at least that Jaccard similarity."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([w.shingles(t).tobytes() for t in part.column(1).to_pylist()], pa.binary())], names=["node", "own_"]
                )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(both >= w.similarity * (len(x) + len(y) - both) - 1e-9)
            ok = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(ok), batch.column(1).filter(ok)], names=["a", "b"])

    pairs = staged(pairs, "candidates")
    asked = pairs.select(F.explode(F.array("a", "b")).alias(row)).distinct()
    texts = rows.join(asked, row, "left_semi").select(row, whole_text(text_col).alias("text_"))
    own = staged(texts.mapInArrow(sets, "node long, own_ binary"), "sets")
    left, right = own.select(F.col("node").alias("a"), F.col("own_").alias("x_")), own.select(F.col("node").alias("b"), F.col("own_").alias("y_"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x_", "y_").mapInArrow(verify, "a long, b long")


def _near(rows: DataFrame, row: str, id_col: str, text_col: str, w: Wide) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(row, set_) of all rows; (node, set_, first_) of different sets of shingles; (node, root) of the linked ones."""
    rank = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col(row).alias("row"))
    every = staged(_wide(rows, [row, id_col], text_col, w), "sets")
    own = every.groupBy("set_").agg(F.min(rank).alias("first_"), F.first("fp_").alias("fp_"), F.first("size_").alias("size_"))
    first = staged(own.select("fp_", "size_", "set_", "first_", F.col("first_.row").alias("node")), "firsts")
    # A few blocks first: copies that share most blocks are one root before the others are dealt out.
    few = max(1, w.blocks // 6)
    early = staged(_alike(_wide_links(first.withColumn("root", F.col("node")), w, (0, few), whole=False), rows, row, text_col, w), "links")
    roots = first.join(components(early), "node", "left").select("node", "fp_", "size_", F.coalesce("root", "node").alias("root"))
    late = _alike(_wide_links(roots, w, (0, w.blocks)), rows, row, text_col, w)
    return every.select(row, "set_"), first.select("node", "set_", "first_"), components(early.unionByName(late))


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: float = 0.8, width: int | None = None) -> DataFrame:
    """(id, group), one row a document: ``group`` is the id of the one that ``keep_one`` keeps."""
    row = free_name(docs, "row_")
    rows = staged(docs.select(id_col, text_col).withColumn(row, F.monotonically_increasing_id()), "documents")
    w = Wide(width or Wide.width_for(rows.count()), similarity, words)
    with arrow_rows(docs.sparkSession, BATCH):
        every, first, linked = _near(rows, row, id_col, text_col, w)
    named = first.join(linked, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("first_").alias("least_"))
    by_set = named.join(least, "root").select("set_", F.col("least_.id").alias("group"))
    return every.join(by_set, "set_").join(rows.select(row, id_col), row).select(id_col, "group")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: float = 0.8, width: int | None = None) -> DataFrame:
    """Of each group of near copies the row with the least id (nulls last; of equal ids the first read); all columns stay.

    ``width`` of the blocks: None takes ``Wide.width_for`` the number of rows. Null and blank texts are copies of each other;
    a text of fewer than ``words`` words is one shingle; an empty table gives no rows.
    """
    row = free_name(docs, "row_")
    rows = staged(docs.withColumn(row, F.monotonically_increasing_id()), "documents")
    w = Wide(width or Wide.width_for(rows.count()), similarity, words)
    with arrow_rows(docs.sparkSession, BATCH):
        _, first, linked = _near(rows, row, id_col, text_col, w)
    ranks = first.select("node", "first_")
    keep = linked.join(ranks, "node").groupBy("root").agg(F.min("first_").alias("first_")).select(F.col("first_.row").alias(row))
    alone = ranks.join(linked, "node", "left_anti").select(F.col("first_.row").alias(row))
    return rows.join(keep.unionByName(alone), row, "left_semi").drop(row)


def op7_simhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {"op7_simhash_near_dup": op7_simhash_near_dup}
ORACLE_SQL: dict[str, str] = {}
