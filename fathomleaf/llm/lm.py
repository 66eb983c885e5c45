"""Language-model scores from a hierarchical Pitman-Yor model of words and the words before them.

A word's restaurant is its context, the word before it, by a hash into ``CONTEXTS`` restaurants, so that every frequent
word has one of its own but for rare ones that fall into it. All contexts share one parent, the root, whose base is
uniform over the known words and one unknown. Discounts are one half: the number of ways to seat c customers at t tables
is then a closed formula, and the tables of a dish can be drawn from their exact distribution at any count.

Seating is sampled by Gibbs in blocks: all customers of a dish in a restaurant leave together and are seated again, from
their joint distribution given everybody else. Three auxiliary draws make that distribution a product over dishes, so
that all dishes may be seated at once and on many machines without an approximation (``Root``, ``leaf_tables``): the root's
measure itself (gamma and inverse Gaussian masses, as the half-stable subordinator has), its latent scale, and a latent
scale for each context. Predictive probabilities are averaged over the sweeps after the burn-in. Random numbers come from
hashes of word, context and sweep, so that results do not depend on how the words are dealt out.

How it is spread: a scan task counts (word, context) pairs of its blocks of documents and writes each block's tokens as
references into its own pairs. Pairs are dealt out by word, so a word's counts at all levels meet in one task, and no
word has more pairs than there are contexts; what is shared by all words, tables by context, is one sum over the tasks
of a sweep, a vector of ``CONTEXTS`` numbers. Every count comes from all training texts.

Defined results: null text counts as empty; an empty text is one end token; a null id trains (its remainder is none);
repeated rows train and are scored as often as they occur; words unknown to training share the base's unknown word; with
no training text at all every probability is the base's; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomleaf.llm._shared import cores, read_file, remove_file, staged, table, whole_text, work_dir, write_file

END = b"\n"  # no word holds a line feed
CONTEXTS = 1 << 20
BLOCK_TOKENS = 4_000_000
BURN_IN, SAMPLES = 2, 3
DISCOUNT = 0.5  # of both levels; the closed formulas hold for one half only
STRENGTH, ROOT_STRENGTH = 5.0, 50.0
SEED = 8
WINDOW = 1 << 21  # numbers of tables weighed at once


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 1, F.lit(False))


def words_of(text: str) -> list[bytes]:
    """A-Z lower-cased, cut at the six ASCII blanks, then the end; words as UTF-8."""
    return [*text.encode().lower().split(), END]


def context_of(word: bytes) -> int:
    """The restaurant after ``word``."""
    return zlib.crc32(word) % CONTEXTS


# --- random numbers from hashes ---------------------------------------------------------------------------------------


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniform(key: np.ndarray, *salt: int) -> np.ndarray:
    """In (0, 1), from 64-bit keys and a few numbers that tell the draws of one key apart."""
    for n in salt:
        key = mix(key + np.uint64((n + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    return ((key >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def normal(key: np.ndarray, *salt: int) -> np.ndarray:
    return np.sqrt(-2 * np.log(uniform(key, *salt, 0))) * np.cos(2 * np.pi * uniform(key, *salt, 1))


def gamma(shape: np.ndarray, key: np.ndarray, *salt: int) -> np.ndarray:
    """Gamma variates of rate 1 by Marsaglia and Tsang; shapes below 1 from one more and a power of a uniform number."""
    a = np.where(shape < 1, shape + 1, shape) - 1 / 3
    out, todo, n = np.empty(len(a)), np.arange(len(a)), 0
    while len(todo):
        d, k = a[todo], key[todo]
        x = normal(k, *salt, 2, n)
        v = (1 + x / np.sqrt(9 * d)) ** 3
        with np.errstate(invalid="ignore", divide="ignore"):
            ok = (v > 0) & (np.log(uniform(k, *salt, 3, n)) < 0.5 * x * x + d - d * v + d * np.log(v))
        out[todo[ok]] = (d * v)[ok]
        todo, n = todo[~ok], n + 1
    return np.where(shape < 1, out * uniform(key, *salt, 4) ** (1 / np.maximum(shape, 1e-9)), out)


def inverse_gaussian(mean: float, shape: float, key: np.ndarray, *salt: int) -> np.ndarray:
    """Michael, Schucany and Haas, by the larger root, which loses no digits."""
    y = normal(key, *salt, 5) ** 2 * mean
    big = mean + mean * (y + np.sqrt(y * (4 * shape + y))) / (2 * shape)
    small = mean * mean / big
    return np.where(uniform(key, *salt, 6) * (mean + small) <= mean, small, big)


# --- the sampler ------------------------------------------------------------------------------------------------------


def draw_tables(c: np.ndarray, x: np.ndarray, u: np.ndarray) -> np.ndarray:
    """For each dish of c >= 1 customers a number of tables t from 1 to c with probability in proportion to S(c, t) x^t.

    S(c, t) = (2c-t-1)! / ((t-1)! (c-t)!) 4^(t-c) counts the seatings at a discount of one half, so the ratio of
    neighbours is 4x (c-t) / (t (2c-t-1)), which falls with t. Weights are laid out around the mode as far as they matter to
    a double, and ``u`` inverts their sum: the same way for all counts.
    """
    out = np.ones(len(c), np.int64)
    live = np.flatnonzero(c > 1)
    n, x, u = c[live].astype(np.float64), x[live], u[live]
    b = 2 * n - 1 + 4 * x
    mode = np.clip(np.ceil(8 * x * n / (b + np.sqrt(b * b - 16 * x * n))), 1, n)
    reach = np.ceil(9 * np.sqrt(mode)) + 40
    lo, hi = np.maximum(1, mode - reach).astype(np.int64), np.minimum(n, mode + reach).astype(np.int64)
    size = hi - lo + 1
    ends = np.cumsum(size)
    at = 0
    while at < len(live):
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + WINDOW, "right")))
        s, m, f = size[at:upto], lo[at:upto], np.cumsum(size[at:upto]) - size[at:upto]
        of = np.repeat(np.arange(len(s)), s)
        t = (np.arange(len(of)) - f[of] + m[of]).astype(np.float64)
        nn, xx = n[at:upto][of], x[at:upto][of]
        before = t - 1  # the step from t-1 to t; none into the first
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.log(4 * xx * (nn - before) / (before * (2 * nn - before - 1)))
        step[f] = 0.0
        total = np.cumsum(step)
        log = total - total[f][of]
        w = np.exp(log - np.maximum.reduceat(log, f)[of])
        cum = np.cumsum(w)
        base = cum[f] - w[f]
        target = base + u[at:upto] * (cum[f + s - 1] - base)
        k = np.clip(np.searchsorted(cum, target), f, f + s - 1)
        out[live[at:upto]] = k - f + m
        at = upto
    return out


def scales(tables: np.ndarray, contexts: np.ndarray, sweep: int) -> np.ndarray:
    """The latent scale of each context (the square root of its half-stable tilt) given its tables."""
    return gamma(tables + STRENGTH / DISCOUNT, mix(contexts.astype(np.uint64) + np.uint64(1 << 40)), SEED, sweep, 1)


def leaf_tables(c: np.ndarray, share: np.ndarray, scale: np.ndarray, key: np.ndarray, sweep: int) -> np.ndarray:
    """Tables of dishes in contexts: ``share`` is the root's measure of the word, ``scale`` the context's."""
    return draw_tables(c, DISCOUNT * scale * share, uniform(key, SEED, sweep, 2))


@dataclass
class Root:
    """What all words share at the root: known words, customers, mass (in units of 1 / scale^2) and tables."""

    known: int
    customers: int = 0
    mass: float = 1.0
    scale: float = 1.0
    tables: int = 0
    unknown: float = 0.0

    @property
    def base(self) -> float:
        return 1.0 / (self.known + 1)

    def rescale(self, sweep: int) -> None:
        """Draw the latent scale given the measure and the customers that came from it."""
        own = mix(np.array([1 << 41], np.uint64))
        tilt = gamma(np.array([ROOT_STRENGTH + self.customers]), own, SEED, sweep, 3)[0] / (self.mass / self.scale**2)
        self.scale = float(np.sqrt(tilt))

    def seat(self, c: np.ndarray, key: np.ndarray, sweep: int) -> tuple[np.ndarray, np.ndarray]:
        """(tables, masses) of words with c customers, given the scale."""
        t = draw_tables(c, np.full(len(c), DISCOUNT * self.scale * self.base), uniform(key, SEED, sweep, 4))
        return t, gamma(c - DISCOUNT * t, key, SEED, sweep, 5) + self.fresh(key, sweep)

    def fresh(self, key: np.ndarray, sweep: int) -> np.ndarray:
        """Mass at a word from beyond the seated tables."""
        return self.scale**2 * inverse_gaussian(self.base / (2 * self.scale), self.base**2 / 2, key, SEED, sweep, 6)

    def close(self, mass: float, tables: int, sweep: int) -> None:
        """Take over what the known words add up to."""
        self.unknown = float(self.fresh(mix(np.array([1 << 42], np.uint64)), sweep)[0])
        self.mass, self.tables = mass + self.unknown, tables

    def probability(self, lead: np.ndarray) -> np.ndarray:
        """Predictive probability of words whose customers less discounted tables are ``lead``; 0 for the unknown word."""
        return (lead + (ROOT_STRENGTH + DISCOUNT * self.tables) * self.base) / (ROOT_STRENGTH + self.customers)


FIXED = float(1 << 20)  # masses are added up as whole multiples of 1 / FIXED, so that order does not matter


def start(known: int, customers: int) -> Root:
    """Before the first sweep: one table a dish, masses in proportion to customers."""
    out = Root(known, customers, mass=float(max(customers, 1)))
    out.scale = ROOT_STRENGTH / DISCOUNT + known / 2 + 1
    out.unknown = out.base
    out.mass += out.unknown
    return out


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays, byte plane by byte plane, compressed."""
    out = io.BytesIO()
    for x in arrays:
        x = np.ascontiguousarray(x)
        np.lib.format.write_array(out, np.array([x.dtype.str, str(len(x))]))
        out.write(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.dtype.itemsize).T).tobytes())
    return zlib.compress(out.getvalue(), 1)


def unpack(data: bytes) -> list[np.ndarray]:
    src, out = io.BytesIO(zlib.decompress(data)), []
    end = len(src.getbuffer())
    while src.tell() < end:
        kind, n = np.lib.format.read_array(src)
        size = np.dtype(kind).itemsize
        planes = np.frombuffer(src.read(size * int(n)), np.uint8).reshape(size, int(n))
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind) if int(n) else np.zeros(0, kind))
    return out


class _Numbers(dict):
    """Numbers words as they come."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


class _Counter:
    """Tokens of one block of documents."""

    def __init__(self) -> None:
        self.number = _Numbers()
        self.tokens: list[np.ndarray] = []
        self.train: list[bool] = []
        self.keys: list[pa.Array] = []
        self.size = 0

    def add(self, text: str, train: bool) -> None:
        words = words_of(text)
        self.tokens.append(np.fromiter(map(self.number.__getitem__, words), np.int32, len(words)))
        self.train.append(train)
        self.size += len(words)

    def flush(self, path: str, parts: int) -> list[bytes]:
        """Write the block; for each share of the words their pairs, in the order that the file refers to.

        The file has, for each token, its pair's place among the pairs of all shares one after another.
        """
        words = list(self.number)
        share = np.fromiter((zlib.crc32(w) % parts for w in words), np.int64, len(words))
        order = np.argsort(share, kind="stable")
        rank = np.empty(len(words), np.int64)
        rank[order] = np.arange(len(words))
        after = np.fromiter(map(context_of, words), np.int64, len(words))
        lens = np.array([len(t) for t in self.tokens])
        ids = np.concatenate(self.tokens)
        ends = np.cumsum(lens)
        before = np.concatenate(([0], after[ids[:-1]]))
        before[np.concatenate(([0], ends[:-1]))] = context_of(END)  # a text starts after an end
        pairs, at = np.unique(rank[ids] * CONTEXTS + before, return_inverse=True)
        train = np.repeat(self.train, lens)
        counts = np.bincount(at, weights=train, minlength=len(pairs)).astype("<u4")
        stream = pa.BufferOutputStream()
        keys = pa.RecordBatch.from_arrays([pa.concat_arrays(self.keys)], names=["id"])
        with pa.ipc.new_stream(stream, keys.schema) as w:
            w.write_batch(keys)
        head = stream.getvalue().to_pybytes()
        of_word = np.bincount(pairs // CONTEXTS, minlength=len(words)).astype("<u4")  # at most CONTEXTS pairs a word
        write_file(path, len(head).to_bytes(8, "little") + head + pack(at.astype("<u4"), lens.astype("<i8"), ~np.array(self.train), of_word))
        out, sorted_share = [], share[order]
        edges = np.searchsorted(sorted_share, np.arange(parts + 1))
        bounds = np.concatenate(([0], np.cumsum(of_word.astype(np.int64))))
        for k in range(parts):
            lo, hi = int(edges[k]), int(edges[k + 1])
            own = slice(int(bounds[lo]), int(bounds[hi]))
            text = np.frombuffer(END.join([words[i] for i in order[lo:hi]]), np.uint8) if hi > lo else np.zeros(0, np.uint8)
            sizes = np.array([len(words[i]) for i in order[lo:hi]], "<u4")
            out.append(pack(text, sizes, of_word[lo:hi], (pairs[own] % CONTEXTS).astype("<u4"), counts[own]))
        return out


def _block(folder: str, block: int) -> str:
    return f"{folder}/block-{block:012d}.z"


def count(docs: DataFrame, parts: int, folder: str, id_col: str, text_col: str) -> DataFrame:
    """Write the blocks; (block, part, pairs): a block's pairs of one share of the words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held, n = TaskContext.get().partitionId(), _Counter(), 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held, n
            if held.size:
                block = task * 100_000 + n
                blobs = held.flush(_block(folder, block), parts)
                held, n = _Counter(), n + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * parts, pa.int64()), pa.array(np.arange(parts, dtype=np.int32)), pa.array(blobs, pa.binary())],
                    names=["block", "part", "pairs"],
                )

        for batch in batches:
            begun = 0
            for k, (text, out) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                held.add(text, not out)
                if held.size >= BLOCK_TOKENS:
                    held.keys.append(batch.column(0).slice(begun, k + 1 - begun))
                    begun = k + 1
                    yield from flush()
            if begun < batch.num_rows:
                held.keys.append(batch.column(0).slice(begun))
        yield from flush()

    rows = docs.select(id_col, whole_text(text_col).alias("text_"), held_out(id_col).alias("out_"))
    return rows.mapInArrow(run, "block long, part int, pairs binary")


def _words(folder: str, part: int) -> str:
    return f"{folder}/words-{part:06d}.z"


def _state(folder: str, part: int, step: int) -> str:
    return f"{folder}/state-{part:06d}-{step}.z"


def deal(pairs: DataFrame, parts: int, folder: str) -> DataFrame:
    """Write, for each share of the words, their pairs and which block asks for them; (part, known, tokens)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, codes, counts, blocks, lens = _Numbers(), [], [], [], []
        part = None
        for batch in batches:
            part = batch.column("part")[0].as_py()
            for block, blob in zip(batch.column("block").to_pylist(), batch.column("pairs").to_pylist(), strict=True):
                text, sizes, n, context, c = unpack(blob)
                raw, ends = text.tobytes(), np.cumsum(sizes.astype(np.int64) + 1) - 1
                own = [raw[b - s : b] for b, s in zip(ends.tolist(), sizes.tolist(), strict=True)]
                word = np.fromiter(map(numbers.__getitem__, own), np.int64, len(own))
                codes.append(np.repeat(word, n) * CONTEXTS + context)
                counts.append(c.astype(np.int64))
                blocks.append(block)
                lens.append(len(context))
        unique, at = np.unique(np.concatenate(codes), return_inverse=True)
        total = np.bincount(at, weights=np.concatenate(counts), minlength=len(unique)).astype(np.int64)
        write_file(f"{folder}/asked-{part:06d}.z", pack(at.astype("<u4"), np.array(blocks, "<i8"), np.array(lens, "<i8")))
        hashes = np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in numbers), np.uint64, len(numbers))
        share = Share.fresh(unique, total, hashes)
        share.save(_words(folder, part), _state(folder, part, 0))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([part], pa.int32()),
                pa.array([int((share.n > 0).sum())], pa.int64()),
                pa.array([int(total.sum())], pa.int64()),
                pa.array([share.sums(share.c)]),
                pa.array([share.sums(share.t)]),
            ],
            names=["part", "known", "tokens", "customers", "tables"],
        )

    return staged(
        pairs.repartition(parts, "part")
        .sortWithinPartitions("part", "block")
        .mapInArrow(lambda b: _by_part(b, run), "part int, known long, tokens long, customers binary, tables binary"),
        "lm-parts",
    )


def _by_part(batches: Iterator[pa.RecordBatch], run) -> Iterator[pa.RecordBatch]:
    """Call ``run`` with the batches of one part after another; a task may hold several parts or none."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        part = batch.column("part").to_numpy(zero_copy_only=False)
        cut = [0, *(np.nonzero(part[1:] != part[:-1])[0] + 1).tolist(), len(part)]
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            piece = batch.slice(a, b - a)
            if held and held[-1].column("part")[0] != piece.column("part")[0]:
                yield from run(iter(held))
                held = []
            held.append(piece)
    if held:
        yield from run(iter(held))


class Share:
    """One share of the words, with all their pairs: what is fixed, and the state of the sampler."""

    def __init__(self, words: str, state: str) -> None:
        word, self.leaf, self.c, self.hash = unpack(read_file(words))
        self._index(np.cumsum(word.astype(np.int64)), self.leaf.astype(np.int64), self.c.astype(np.int64))
        t, self.mass, sum_t, *self.leads = unpack(read_file(state))
        self.t = np.minimum(self.c, 1)
        self.t[self.many] = t
        self.sum_t = sum_t.astype(np.int64)

    def _index(self, word: np.ndarray, leaf: np.ndarray, c: np.ndarray) -> None:
        self.word, self.leaf, self.c = word, leaf, c
        self.words = len(self.hash)
        self.many = np.flatnonzero(c > 1)  # a dish of one customer has one table for certain
        self.n = self.by_word(c)

    def by_word(self, x: np.ndarray) -> np.ndarray:
        return np.bincount(self.word, weights=x, minlength=self.words).astype(np.int64)

    @classmethod
    def fresh(cls, codes: np.ndarray, counts: np.ndarray, hashes: np.ndarray) -> Share:
        """Codes (word * CONTEXTS + context) in order; one table a dish."""
        out = cls.__new__(cls)
        out.hash = hashes
        out._index(codes // CONTEXTS, codes % CONTEXTS, counts)
        out.t, out.sum_t, out.leads = np.minimum(counts, 1), np.zeros(len(out.many), np.int64), []
        out.mass = out.by_word(out.t).astype(np.float64)
        return out

    def save(self, words: str | None, state: str) -> None:
        small = lambda x: x.astype("<u4") if len(x) and x.max() > 0xFFFF else x.astype("<u2")
        if words:
            write_file(
                words,
                pack(
                    np.diff(self.word, prepend=0).astype("<u1"),
                    small(self.leaf),
                    self.c.astype("<u8") if len(self.c) and self.c.max() > 0xFFFFFFFF else small(self.c),
                    self.hash,
                ),
            )
        write_file(state, pack(small(self.t[self.many]), self.mass, small(self.sum_t), *self.leads))

    def seat_leaves(self, tables: Vector, root: Root, sweep: int) -> None:
        """New tables of all dishes in contexts, given the measure of the root and the contexts' scales."""
        leaf, word = self.leaf[self.many], self.word[self.many]
        seen, at = np.unique(leaf, return_inverse=True)
        key = mix(self.hash[word] + np.uint64(0x9E3779B97F4A7C15) * leaf.astype(np.uint64))
        self.t[self.many] = leaf_tables(self.c[self.many], self.mass[word] / root.mass, scales(tables[seen], seen, sweep)[at], key, sweep)

    def seat_root(self, root: Root, sweep: int, sample: bool) -> tuple[int, int]:
        """New tables and masses of the words at the root; (mass in whole multiples of 1 / FIXED, tables)."""
        c, known = self.by_word(self.t), np.flatnonzero(self.n)
        t, mass = root.seat(c[known], self.hash[known], sweep)
        whole = np.maximum(np.rint(mass * FIXED), 1).astype(np.int64)
        self.mass = np.zeros(self.words)
        self.mass[known] = whole / FIXED
        if sample:
            lead = c.astype(np.float64)
            lead[known] -= DISCOUNT * t
            self.leads.append(lead.astype("<f4"))
            self.sum_t += self.t[self.many]
        return int(whole.sum(dtype=object) if len(whole) else 0), int(t.sum())

    def probabilities(self, fitted: Fitted) -> np.ndarray:
        """Mean predictive probability of each pair."""
        t = self.t * len(fitted.roots)
        t[self.many] = self.sum_t
        own = self.c - DISCOUNT * t / len(fitted.roots)
        for root, tables, lead in zip(fitted.roots, fitted.tables, self.leads, strict=True):
            own = own + (STRENGTH + DISCOUNT * tables[self.leaf]) * root.probability(lead.astype(np.float64))[self.word] / len(fitted.roots)
        return own / (STRENGTH + fitted.customers[self.leaf])

    def sums(self, x: np.ndarray) -> bytes:
        """This share's part of a total by context."""
        return pack(np.bincount(self.leaf, weights=x, minlength=CONTEXTS).astype("<i8"))


class Vector:
    """A number for each context; it goes to the tasks compressed."""

    def __init__(self, values: np.ndarray) -> None:
        self.values = values

    def __getstate__(self) -> bytes:
        return pack(self.values)

    def __setstate__(self, state: bytes) -> None:
        self.values = unpack(state)[0]

    def __getitem__(self, at):
        return self.values[at]


@dataclass
class Fitted:
    """Customers by context, and for each sample the root and the tables by context."""

    customers: Vector
    roots: list[Root] = field(default_factory=list)
    tables: list[Vector] = field(default_factory=list)


def _total(rows: DataFrame, col: str, parts: int) -> Vector:
    """The sum of vectors of a fixed length: in about the square root of their number, then in one task, then here."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for x in batch.column("sums").to_pylist():
                total = unpack(x)[0] if total is None else total + unpack(x)[0]
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([pack(total)], pa.binary())], names=["sums"])

    some = rows.select("part", F.col(col).alias("sums")).repartition(max(1, int(parts**0.5)), "part").select("sums").mapInArrow(add_up, "sums binary")
    found = some.repartition(1).mapInArrow(add_up, "sums binary").first()
    return Vector(unpack(found[0])[0] if found else np.zeros(CONTEXTS, np.int64))


def fit(parts: DataFrame, n_parts: int, folder: str, known: int) -> tuple[Fitted, int]:
    """Gibbs sweeps, each in two steps (contexts, root); the samples and the number of the last state."""
    fitted = Fitted(_total(parts, "customers", n_parts))
    tables = _total(parts, "tables", n_parts)
    root = start(known, int(tables.values.sum()))
    todo = parts.select("part").repartition(n_parts, "part")
    last = BURN_IN + SAMPLES

    def each(batches: Iterator[pa.RecordBatch], step: int, work) -> Iterator[tuple[int, object]]:
        """Every part's share, worked on and saved as the state after ``step``; a state is read by the next step only."""
        for batch in batches:
            for part in batch.column(0).to_pylist():
                share = Share(_words(folder, part), _state(folder, part, step - 1))
                got = work(share)
                share.save(None, _state(folder, part, step))
                if step > 1:
                    remove_file(_state(folder, part, step - 2))
                yield part, got

    for sweep in range(1, last + 1):

        def leaves(batches: Iterator[pa.RecordBatch], sweep: int = sweep, root: Root = root, tables: Vector = tables) -> Iterator[pa.RecordBatch]:
            def work(share: Share) -> bytes:
                share.seat_leaves(tables, root, sweep)
                return share.sums(share.t)

            for part, sums in each(batches, 2 * sweep - 1, work):
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([sums])], names=["part", "sums"])

        tables = _total(todo.mapInArrow(leaves, "part int, sums binary"), "sums", n_parts)
        root = Root(known, int(tables.values.sum()), root.mass, root.scale)
        root.rescale(sweep)

        def words(batches: Iterator[pa.RecordBatch], sweep: int = sweep, root: Root = root) -> Iterator[pa.RecordBatch]:
            for _, (mass, t) in each(batches, 2 * sweep, lambda share: share.seat_root(root, sweep, sweep > BURN_IN)):
                yield pa.RecordBatch.from_arrays([pa.array([str(mass)]), pa.array([t], pa.int64())], names=["mass", "tables"])

        mass, t = todo.mapInArrow(words, "mass string, tables long").agg(F.sum(F.col("mass").cast("decimal(38,0)")), F.sum("tables")).first()
        root.close(int(mass or 0) / FIXED, int(t or 0), sweep)
        if sweep > BURN_IN:
            fitted.roots.append(root)
            fitted.tables.append(tables)
    return fitted, 2 * last


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row a document."""
    spark = docs.sparkSession
    folder, n_parts = work_dir(spark, "lm"), cores(spark)
    parts = deal(count(docs, n_parts, folder, id_col, text_col), n_parts, folder)
    known, tokens = parts.agg(F.coalesce(F.sum("known"), F.lit(0)), F.coalesce(F.sum("tokens"), F.lit(0))).first()
    fitted, last = fit(parts, n_parts, folder, known)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.column(0).to_pylist():
                share = Share(_words(folder, part), _state(folder, part, last))
                logs = np.log10(share.probabilities(fitted)).astype("<f4")
                of_word = share.n.astype("<u8")
                at, blocks, lens = unpack(read_file(f"{folder}/asked-{part:06d}.z"))
                upto = np.cumsum(lens)
                for block, a, b in zip(blocks.tolist(), (upto - lens).tolist(), upto.tolist(), strict=True):
                    own = at[a:b].astype(np.int64)
                    word = share.word[own]
                    first = np.concatenate(([True], word[1:] != word[:-1])) if len(word) else np.zeros(0, bool)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([block], pa.int64()),
                            pa.array([part], pa.int32()),
                            pa.array([pack(of_word[word[first]])], pa.binary()),
                            pa.array([pack(logs[own])], pa.binary()),
                        ],
                        names=["block", "part", "counts", "logs"],
                    )

    def tell(found: pa.Table) -> pa.Table:
        data = read_file(_block(folder, found.column("block")[0].as_py()))
        head = int.from_bytes(data[:8], "little")
        keys = pa.ipc.open_stream(data[8 : 8 + head]).read_all().column("id").combine_chunks()
        at, size, held, of_word = unpack(data[8 + head :])
        order = np.argsort(found.column("part").to_numpy())
        counts, logs = (
            np.concatenate([unpack(blobs[i])[0] for i in order]) for blobs in (found.column("counts").to_pylist(), found.column("logs").to_pylist())
        )
        pair_log, pair_count = logs.astype(np.float64), np.repeat(counts.astype(np.float64), of_word)
        pair_base = np.log10((pair_count + 0.5) / (tokens + 0.5 * (known + 1)))
        starts = np.cumsum(size) - size
        total = lambda x: np.add.reduceat(x[at], starts)
        return pa.table(
            [
                keys,
                pa.array(held),
                pa.array(size),
                pa.array(total((pair_count > 0).astype(np.int64))),
                pa.array(np.full(len(size), tokens, np.int64)),
                pa.array(total(pair_base)),
                pa.array(total(pair_log)),
            ],
            names=out.names,
        )

    out = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField("held_out", T.BooleanType()),
            *(T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known", "train_tokens")),
            T.StructField("base_score", T.DoubleType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
    answers = parts.select("part").repartition(n_parts, "part").mapInArrow(answer, "block long, part int, counts binary, logs binary")
    return answers.groupBy("block").applyInArrow(tell, out)


def op8_pitman_yor_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))


def perplexity(scores: DataFrame) -> DataFrame:
    """(held_out, base, model): perplexities by token, from ``score``'s rows."""
    ten = lambda c: F.pow(F.lit(10.0), -F.sum(c) / F.sum("n_tokens"))
    return scores.groupBy("held_out").agg(ten("base_score").alias("base"), ten("score").alias("model"))


QUERIES = {"op8_pitman_yor_lm": op8_pitman_yor_lm}
ORACLE_SQL: dict[str, str] = {}
