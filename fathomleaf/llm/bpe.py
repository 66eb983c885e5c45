"""Byte-level BPE encoding and decoding.

Pre-tokenisation runs without regex (which only fills the table of code point classes, once in a worker). Each code point gets a class, classes and their right neighbours give a symbol,
and each symbol is a function on eight scanner states. Functions compose associatively, so the state before every
position comes from a blocked prefix scan over elements of the (small, finite) monoid that the symbols generate.
Slices between boundaries go through pair merging with a bounded cache; token offsets are kept for decoding.

Defined results: null text counts as empty; empty text has no tokens, the sha256 of nothing for ids and bytes; repeated
rows and repeated or null ids each give their own row; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from fathomleaf.llm._shared import table, tokenizer_path, whole_text

# Scanner states: what the last code point belongs to.
LETTER, NUMBER, OTHER, SPACES, PREFIX, ENDED, ONE_MORE, TWO_MORE = range(8)
# Symbols. Blanks: before another blank or the end; a plain space before a non-blank; another blank before a non-blank.
# Apostrophes: before s, t, m or d; before re, ve or ll. From FIRST on the same symbols at a document's start.
S_L, S_N, S_O, S_WS, S_SP, S_WX, S_A1, S_A2 = range(8)
FIRST = 8
_BEGIN = {S_L: LETTER, S_N: NUMBER, S_O: OTHER, S_WS: SPACES, S_SP: PREFIX, S_WX: ENDED, S_A1: ONE_MORE, S_A2: TWO_MORE}
_GOES_ON = {
    LETTER: {S_L: LETTER}, NUMBER: {S_N: NUMBER}, OTHER: {S_O: OTHER, S_A1: OTHER, S_A2: OTHER}, SPACES: {S_WS: SPACES},
    PREFIX: {S_L: LETTER, S_N: NUMBER, S_O: OTHER, S_A1: OTHER, S_A2: OTHER}, ENDED: {}, ONE_MORE: {S_L: ENDED}, TWO_MORE: {S_L: ONE_MORE},
}
BLOCK = 256
NEVER = 1 << 60
CACHE = 200_000
SCAN_CHARS = 2_000_000


@functools.cache
def char_classes() -> np.ndarray:
    """For each code point its class as a symbol: letter, number, other, blank (S_WX), plain space (S_SP).

    Where two Unicode versions at hand disagree, the library that fixes the results is asked: it may merge a byte pair
    across two code points only if both belong to one pre-token.
    """
    kind = np.full(0x110000, S_O, np.uint8)
    every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    ranks = {bytes([b]): b for b in range(256)} | {bytes([b]) + end: 256 + b + 256 * k for k, end in enumerate((b"a", b"1")) for b in range(0x80, 0xC0)}
    ask = tiktoken.Encoding("classes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for pattern, symbol, major, partner in ((r"\p{L}", S_L, "L", "a"), (r"\p{N}", S_N, "N", "1")):
        for c in regex.findall(pattern, every):
            if unicodedata.category(c)[0] == major or len(ask.encode_ordinary(c + partner)) == len(c.encode()):
                kind[ord(c)] = symbol
    kind[np.frombuffer("".join(regex.findall(r"\p{Z}", every)).encode("utf-32-le"), np.uint32)] = S_WX
    kind[[0x9, 0xA, 0xB, 0xC, 0xD, 0x85]] = S_WX
    kind[0x20] = S_SP
    return kind


@functools.cache
def monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(symbol -> element, element x element -> composed element, element x state -> state, state x symbol -> boundary)."""
    step = np.zeros((8, 16), np.int64)
    bound = np.ones((8, 16), bool)
    for state in range(8):
        for s in range(8):
            on = _GOES_ON[state].get(s)
            step[state, s] = _BEGIN[s] if on is None else on
            bound[state, s] = on is None
            step[state, s + FIRST] = _BEGIN[s]
    found: dict[tuple[int, ...], int] = {}
    order: list[tuple[int, ...]] = []

    def number(f: tuple[int, ...]) -> int:
        if f not in found:
            found[f] = len(order)
            order.append(f)
        return found[f]

    symbol = np.array([number(tuple(step[:, s])) for s in range(16)])
    number(tuple(range(8)))
    at = 0
    while at < len(order):  # every product with a generator; closed under these, closed under all
        for s in range(16):
            number(tuple(step[x, s] for x in order[at]))
        at += 1
    n = len(order)
    acts = np.array(order)
    compose = np.empty((n, n), np.int64)
    for a in range(n):
        for b in range(n):
            compose[a, b] = found[tuple(acts[b][acts[a]])]
    return symbol, compose, acts, bound


def _prefixes(elements: np.ndarray) -> np.ndarray:
    """Inclusive prefix products: columns of blocks in parallel, then the blocks' totals by the same scan."""
    symbol, compose, acts, _ = monoid()
    size, n = len(acts), len(elements)
    flat = (compose * size).ravel()
    if n <= BLOCK:
        out = np.empty(n, np.int64)
        if n:
            out[0] = elements[0]
        for i in range(1, n):
            out[i] = compose[out[i - 1], elements[i]]
        return out
    identity = int(np.nonzero((acts == np.arange(8)).all(axis=1))[0][0])
    rows = -(-n // BLOCK)
    padded = np.full(rows * BLOCK, identity, np.int64)
    padded[:n] = elements
    grid = np.ascontiguousarray(padded.reshape(rows, BLOCK).T)
    grid[0] *= size
    for j in range(1, BLOCK):
        grid[j] = flat.take(grid[j - 1] + grid[j])
    before = np.concatenate(([identity], _prefixes(grid[-1] // size)[:-1]))
    return flat.take((before * size)[None, :] + grid // size).T.reshape(-1)[:n] // size


def boundaries(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where pre-tokens start in ``points`` (code points of documents one after another; ``starts``: of the non-empty ones)."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    symbol, _, acts, bound = monoid()
    kind = char_classes()[points]
    blank = kind >= S_SP
    first = np.zeros(n + 1, bool)
    first[starts] = True
    first[n] = True
    last = first[1:]
    more = np.empty(n, bool)  # a blank or the end follows
    more[:-1] = blank[1:]
    more |= last
    more[-1] = True
    s = np.where((kind == S_SP) & ~more, S_SP, np.where(blank, np.where(more, S_WS, S_WX), kind)).astype(np.int64)
    marks = np.nonzero(points == 0x27)[0]
    if len(marks):
        wide = np.concatenate((points, np.zeros(2, points.dtype)))
        a, b = wide[marks + 1], wide[marks + 2]
        inside = ~last[marks]
        inside2 = inside & ~last[np.minimum(marks + 1, n - 1)]
        s[marks[inside & np.isin(a, [0x73, 0x74, 0x6D, 0x64])]] = S_A1
        s[marks[inside2 & (((b == 0x65) & np.isin(a, [0x72, 0x76])) | ((a == 0x6C) & (b == 0x6C)))]] = S_A2
    s[starts] += FIRST
    upto = _prefixes(symbol[s])
    state = np.empty(n, np.int64)
    state[0] = ENDED
    state[1:] = acts[upto[:-1], ENDED]
    starting = bound[state, s]
    starting[starts] = True
    return np.nonzero(starting)[0]


def merge_pairs(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """Ids of one pre-token: the pair of lowest rank is merged first, the leftmost of equals."""
    if (whole := ranks.get(piece)) is not None:
        return (whole,)
    n = len(piece)
    if n < 48:
        get = ranks.get
        parts = [piece[i : i + 1] for i in range(n)]
        pairs = [get(piece[i : i + 2], NEVER) for i in range(n - 1)]
        while pairs and (low := min(pairs)) < NEVER:
            i = pairs.index(low)
            parts[i] += parts.pop(i + 1)
            del pairs[i]
            if i < len(pairs):
                pairs[i] = get(parts[i] + parts[i + 1], NEVER)
            if i:
                pairs[i - 1] = get(parts[i - 1] + parts[i], NEVER)
        return tuple([ranks[p] for p in parts])
    left, right, end = list(range(-1, n - 1)), list(range(1, n + 1)), list(range(1, n + 1))
    heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    alive = bytearray(b"\1" * n)
    while heap:
        _, i, mid, stop = heapq.heappop(heap)
        if not alive[i] or end[i] != mid or mid >= n or not alive[mid] or end[mid] != stop:
            continue
        alive[mid] = 0
        end[i], right[i] = stop, right[mid]
        if right[i] < n:
            left[right[i]] = i
            if (r := ranks.get(piece[i : end[right[i]]])) is not None:
                heapq.heappush(heap, (r, i, stop, end[right[i]]))
        if left[i] >= 0 and (r := ranks.get(piece[left[i] : stop])) is not None:
            heapq.heappush(heap, (r, left[i], i, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return tuple(out)


class Codec:
    """Encoder and decoder for one file of ranks."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as src:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, src)}
        self.bytes_of = {r: b for b, r in self.ranks.items()}
        self.lens = np.zeros(max(self.bytes_of) + 1, np.int64)
        for r, b in self.bytes_of.items():
            self.lens[r] = len(b)
        self.cache: dict[str, tuple[tuple[int, ...], str]] = {}
        self.older: dict[str, tuple[tuple[int, ...], str]] = {}

    def _miss(self, piece: str) -> tuple[tuple[int, ...], str]:
        if len(self.cache) >= CACHE:  # what the next CACHE pieces ask for again comes back from the older half
            self.older = dict(self.cache)
            self.cache.clear()
        if (found := self.older.get(piece)) is None:
            ids = merge_pairs(piece.encode("utf-8"), self.ranks)
            found = (ids, ",".join(map(str, ids)))
        self.cache[piece] = found
        return found

    def pieces(self, texts: list[str]) -> Iterator[list[tuple[tuple[int, ...], str]]]:
        """For each text its pre-tokens' ids, each also as decimals."""
        at = 0
        while at < len(texts):
            size, upto = 0, at
            while upto < len(texts) and (upto == at or size + len(texts[upto]) <= SCAN_CHARS):
                size += len(texts[upto])
                upto += 1
            joined = "".join(texts[at:upto])
            points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
            ends = np.cumsum([len(t) for t in texts[at:upto]])
            begins = np.concatenate(([0], ends[:-1]))
            cut = boundaries(points, begins[ends > begins])
            where = np.searchsorted(cut, np.concatenate((begins, [len(joined)])))
            cuts = [*cut.tolist(), len(joined)]
            get, miss = self.cache.get, self._miss
            for a, b in zip(where[:-1].tolist(), where[1:].tolist(), strict=True):
                own = [joined[x:y] for x, y in zip(cuts[a:b], cuts[a + 1 : b + 1], strict=True)]
                yield [get(p) or miss(p) for p in own]
            at = upto

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(ids for ids, _ in next(self.pieces([text])))) if text else []

    def offsets(self, ids: list[int]) -> list[int]:
        """Where each token starts in the decoded bytes."""
        at, out = 0, []
        for i in ids:
            out.append(at)
            at += len(self.bytes_of[i])
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@functools.cache
def codec(path: str) -> Codec:
    return Codec(path)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>, offsets array<long>): token ids and where each token starts in the text's UTF-8."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in batches:
            ids = [list(chain.from_iterable(i for i, _ in own)) for own in c.pieces(batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array([c.offsets(x) for x in ids], pa.list_(pa.int64()))],
                names=[id_col, "ids", "offsets"],
            )

    out = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField("ids", T.ArrayType(T.IntegerType())),
            T.StructField("offsets", T.ArrayType(T.LongType())),
        ]
    )
    return docs.select(id_col, whole_text(text_col).alias("text")).mapInArrow(run, out)


def decode_documents(encoded: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, text_bytes binary) from ``ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([c.decode(x or []) for x in batch.column(1).to_pylist()], pa.binary())], names=[id_col, "text_bytes"]
            )

    out = T.StructType([T.StructField(id_col, encoded.schema[id_col].dataType), T.StructField("text_bytes", T.BinaryType())])
    return encoded.select(id_col, "ids").mapInArrow(run, out)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, then decode the ids, and keep digests: (id, n_tokens, ids_sha256, decoded_sha256, offsets_crc32).

    Offsets (where each token starts in the UTF-8) go into their checksum as little-endian unsigned 64-bit integers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in batches:
            rows = []
            for own in c.pieces(batch.column(1).to_pylist()):
                ids = list(chain.from_iterable([i for i, _ in own]))
                told = ",".join([s for _, s in own])
                at = c.lens[np.array(ids, np.int64)]
                offsets = zlib.crc32((np.cumsum(at) - at).astype("<u8").tobytes())
                rows.append((len(ids), hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(c.decode(ids)).hexdigest(), offsets))
            cols = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(cols[0], pa.int64()),
                    pa.array(cols[1], pa.string()),
                    pa.array(cols[2], pa.string()),
                    pa.array(cols[3], pa.int64()),
                ],
                names=out.names,
            )

    out = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
            T.StructField("offsets_crc32", T.LongType()),
        ]
    )
    return docs.select(id_col, whole_text(text_col).alias("text")).mapInArrow(run, out)


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_multi_50k.tiktoken"))


QUERIES = {"op1_byte_bpe": op1_byte_bpe}
ORACLE_SQL: dict[str, str] = {}
