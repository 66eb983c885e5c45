"""Best-fit packing of documents into sequences of a fixed number of tokens.

Lengths are whole numbers from 1 to the capacity, so an instance is a histogram of bounded size, however many pieces
there are. The plan is made on it: dominance reduction first fixes small sets of lengths that can replace whatever
else an optimal packing puts beside their largest member; the rest goes best-fit, longest first. A plan entry says
where the pieces of one length with ranks from ``lo`` to ``hi`` go; ranks come from counts of (task, length).

Defined results: null or empty text is one piece with the end id alone; repeated rows are packed as often as they occur;
extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomleaf.llm._shared import staged, table, tokenizer_path, whole_text
from fathomleaf.llm.wordids import word_ids

CAPACITY = 4096
END_ID = 1
ROWS = 1000  # texts in memory as objects


class Plan:
    """Entries (length, lo, hi, sequence, offset, each): the piece of rank r goes to ``sequence + (r - lo) // each``."""

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY) -> None:
        self.capacity = capacity
        self.left = {n: c for n, c in counts.items() if c}
        self.used: dict[int, int] = defaultdict(int)
        self.entries: list[tuple[int, int, int, int, int, int]] = []
        self.sequences = 0
        self.fixed = 0
        self._reduce()
        self.fixed = self.sequences
        self._best_fit()

    def _take(self, length: int, count: int, sequence: int, offset: int, each: int = 1) -> None:
        lo = self.used[length]
        self.used[length] = lo + count
        self.entries.append((length, lo, lo + count, sequence, offset, each))
        self.left[length] -= count
        if not self.left[length]:
            del self.left[length]

    def _fix(self, *members: int) -> None:
        """As many sequences of just these pieces as there can be."""
        n = min(self.left[x] // members.count(x) for x in members)
        at, self.sequences, offset = self.sequences, self.sequences + n, 0
        for x in members:
            self._take(x, n, at, offset)
            offset += x

    def _reduce(self) -> None:
        """Martello and Toth's criteria for sets of one, two and three members.

        A set with the piece ``a`` is fixed if it dominates every other set with ``a``: {a} if nothing fits beside it; {a, b},
        b the longest that fits, if a and b fill the sequence, if no two pieces fit, or if no three do and b is at least the
        best two; {a, b, c}, c the longest that fits beside both, if no three pieces fit beside a and the shorter of any
        two that do is at most c.
        """
        again = True
        while again and self.left:
            again = False
            lengths = sorted(self.left)
            for a in reversed(lengths):
                if a not in self.left:
                    continue
                room = self.capacity - a
                small = self._smallest(lengths, a)
                if not small or small[0] > room:  # nothing fits beside it
                    self._fix(a)
                    again = True
                    continue
                b = self._largest(lengths, room, a)
                if b is None:
                    continue
                no_pair = len(small) < 2 or small[0] + small[1] > room
                no_triple = len(small) < 3 or sum(small) > room
                if a + b == self.capacity or no_pair or no_triple and b >= self._best_pair(lengths, room, a):
                    self._fix(a, b)
                    again = True
                elif no_triple:
                    c = self._largest(lengths, room - b, a, b)
                    if c is not None and self._shorter(lengths, room, a) <= c:
                        self._fix(a, b, c)
                        again = True

    def _smallest(self, lengths: list[int], a: int) -> list[int]:
        """The three shortest pieces besides one ``a``."""
        out: list[int] = []
        for n in lengths:
            if n in self.left:
                out += [n] * min(3, self.left[n] - (n == a))
            if len(out) >= 3:
                break
        return out[:3]

    def _largest(self, lengths: list[int], room: int, *taken: int) -> int | None:
        """The longest piece of at most ``room`` besides those taken."""
        i = bisect.bisect_right(lengths, room) - 1
        while i >= 0:
            n = lengths[i]
            if self.left.get(n, 0) - taken.count(n) > 0:
                return n
            i -= 1
        return None

    def _shorter(self, lengths: list[int], room: int, a: int) -> int:
        """The longest that the shorter of two pieces besides ``a`` can be if both fit in ``room``; 0 for none."""
        above = self.capacity + 1
        for n in reversed(lengths):
            have = self.left.get(n, 0) - (n == a)
            if have > 0:
                if n + (n if have > 1 else above) <= room:
                    return n
                above = n
        return 0

    def _best_pair(self, lengths: list[int], room: int, a: int) -> int:
        """The greatest sum of two pieces besides ``a`` that fits in ``room``."""
        own = [n for n in lengths if self.left.get(n, 0) - (n == a) > 0 and n < room]
        lo, hi, best = 0, len(own) - 1, 0
        while lo <= hi:
            if own[lo] + own[hi] > room or lo == hi and self.left[own[lo]] - (own[lo] == a) < 2:
                hi -= 1
            else:
                best = max(best, own[lo] + own[hi])
                lo += 1
        return best

    def _best_fit(self) -> None:
        rooms: list[int] = []  # sorted; open[room]: groups (first sequence, how many, tokens in each)
        groups: dict[int, list[tuple[int, int, int]]] = defaultdict(list)

        def put(room: int, group: tuple[int, int, int]) -> None:
            if room and group[1]:
                if not groups[room]:
                    bisect.insort(rooms, room)
                groups[room].append(group)

        for a in sorted(self.left, reverse=True):
            while n := self.left.get(a, 0):
                i = bisect.bisect_left(rooms, a)
                if i < len(rooms):
                    room = rooms[i]
                    first, many, filled = groups[room].pop()
                    if not groups[room]:
                        rooms.pop(i)
                else:
                    room, filled = self.capacity, 0
                    many = -(-n // (room // a))
                    first, self.sequences = self.sequences, self.sequences + many
                each = room // a
                whole = min(many, n // each)
                if whole:
                    self._take(a, whole * each, first, filled, each)
                    put(room - each * a, (first, whole, filled + each * a))
                rest = min(n - whole * each, each) if whole < many else 0
                if rest:
                    self._take(a, rest, first + whole, filled, rest)
                    put(room - rest * a, (first + whole, 1, filled + rest * a))
                put(room, (first + whole + bool(rest), many - whole - bool(rest), filled))

    def arrays(self) -> tuple[np.ndarray, ...]:
        e = np.array(sorted(self.entries), np.int64).reshape(-1, 6)
        return tuple(np.ascontiguousarray(e[:, k]) for k in range(6))


def cut(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of at most ``capacity`` ids: (id, piece, start, length, ids_crc32[, ids binary], part_, rank_).

    ``rank_`` counts the pieces of one length within the task ``part_``; write the result once before use.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, tail, part = word_ids(tokenizer), np.array([end_id], "<u4").tobytes(), TaskContext.get().partitionId()
        seen: dict[int, int] = defaultdict(int)
        for batch in (b.slice(k, ROWS) for b in batches for k in range(0, b.num_rows, ROWS)):
            keys, rows = [], []
            for k, ids in enumerate(asked.of(batch.column(1).to_pylist())):
                ids += tail
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at : at + 4 * capacity]
                    n = len(own) // 4
                    keys.append(k)
                    rows.append((piece, at // 4, n, zlib.crc32(own), *([own] if with_ids else []), part, seen[n]))
                    seen[n] += 1
            cols = list(zip(*rows, strict=True)) if rows else [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keys, pa.int64())), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True))], names=out.names
            )

    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), *([pa.binary()] if with_ids else []), pa.int32(), pa.int64()]
    out = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField("piece", T.IntegerType()),
            *(T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32")),
            *([T.StructField("ids", T.BinaryType())] if with_ids else []),
            T.StructField("part_", T.IntegerType()),
            T.StructField("rank_", T.LongType()),
        ]
    )
    return docs.select(id_col, whole_text(text_col).alias("text")).mapInArrow(run, out)


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Give each of ``cut``'s written pieces its ``sequence_id`` and ``offset``."""
    counts = pieces.groupBy("length", "part_").agg(F.count(F.lit(1)).alias("n_"))
    before = counts.withColumn(
        "before_", F.coalesce(F.sum("n_").over(Window.partitionBy("length").orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("n_")).collect()}  # at most ``capacity`` rows
    length, lo, _, sequence, offset, each = Plan(histogram, capacity).arrays()
    key = (length << 44) + lo

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank_").to_numpy(zero_copy_only=False) + batch.column("before_").to_numpy(zero_copy_only=False)
            i = np.searchsorted(key, (n << 44) + rank, side="right") - 1
            of, within = np.divmod(rank - lo[i], each[i])
            cols = [batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(sequence[i] + of), pa.array(offset[i] + within * n)], names=out.names)

    keep = [c for c in pieces.columns if c not in ("part_", "rank_")]
    out = T.StructType([*(pieces.schema[c] for c in keep), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return pieces.join(before.select("length", "part_", "before_"), ["length", "part_"]).mapInArrow(run, out)


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids], sequence_id, offset), one row a piece."""
    return place(staged(cut(docs, tokenizer, capacity, end_id, id_col, text_col, with_ids), "pieces"), capacity)


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


QUERIES = {"op9_best_fit_packing": op9_best_fit_packing}
ORACLE_SQL: dict[str, str] = {}
