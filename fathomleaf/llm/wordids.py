"""Ids of whole texts from the tokenizers library, which is asked once for each distinct piece of text in a while.

Both vocabularies split a text before they merge: the byte-level one always before a single space between two
non-blanks, around a single line feed and before a mark that follows a word; the lower-casing one at every blank and
around marks. So a text's ids are its pieces' ids one after another, and the pieces repeat. Texts with any other pattern
of blanks or marks are cut more coarsely or go to the library whole, and so do texts with one of its special tokens,
which the library looks for first.

Pieces are found, hashed to 128 bits and looked up as arrays, without a Python object for each.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np

CACHE, KEPT = 800_000, 500_000
CHARS = 2_000_000
JOINED = 500  # keys learned in one text
# Blanks (Unicode White_Space) beyond ASCII; U+001C to U+001F are blanks for Python only.
_OTHER = "\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_OTHER_BLANK, _SEPARATOR = re.compile(f"[{_OTHER}]"), re.compile("[\x1c-\x1f]")
GLUED, HEAD = "\x01", "\x02"  # before pieces that follow without a space, and that begin a line
# Blanks other than single spaces and single line feeds, and the two marks above.
_UNEVEN, _STRANGE = ("  ", " \n", "\n ", "\n\n"), re.compile(f"[\t\x0b\x0c\r{GLUED}{HEAD}]")


def _wordlike(c: str) -> bool:
    """A letter or digit that is nothing else once composed and lower-cased: not İ, which turns into i and a mark."""
    return all(x.isalnum() for x in unicodedata.normalize("NFC", c).lower())


# A full stop or comma that does not come right after a letter or digit (\w is those and the underscore).
_LOOSE = re.compile(r"[.,](?<![^\W_][.,])")


@functools.cache
def _crowded() -> re.Pattern[str]:
    """A full stop or comma beside something other than a letter, a digit, a blank or an end."""
    odd = "_" + "".join(c for c in map(chr, range(0x110000)) if c.isalnum() and not _wordlike(c))
    return re.compile(rf"[.,](?:(?<=[^\w\s][.,])|(?<=[{odd}][.,])|(?=[^\w\s])|(?=[{odd}]))")


_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)  # a word's first k bytes


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashes(data: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of pieces of ``data`` (bytes, eight of them behind the last piece)."""
    words = np.ndarray(len(data) - 7, "<u8", data, 0, (1,))  # the eight bytes from each byte on
    g = lens.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h = ~g
    at, k = np.arange(len(starts)), 0
    while len(at):
        rest = lens[at] - 8 * k
        w = words[starts[at] + 8 * k] & _FIRST[np.minimum(rest, 8)]
        if len(at) == len(h):
            h, g = _mix(h ^ w), _mix(g + w)
        else:
            h[at], g[at] = _mix(h[at] ^ w), _mix(g[at] + w)
        at, k = at[rest > 8], k + 1
    return h, g


def _grown(x: np.ndarray, n: int) -> np.ndarray:
    """``x`` with room for at least ``n``; what is not used yet takes no memory."""
    if n <= len(x):
        return x
    out = np.zeros(n + n // 2, x.dtype)
    out[: len(x)] = x
    return out


class _Table:
    """Numbers of hashes in open addressing, all looked up at once."""

    BITS = 22

    def __init__(self) -> None:
        self.slots = np.full(1 << self.BITS, -1, np.int32)
        self.h, self.g, self.count = np.zeros(1 << 12, np.uint64), np.zeros(1 << 12, np.uint64), 0

    def find(self, h: np.ndarray, g: np.ndarray) -> np.ndarray:
        """The number of each, -1 for none."""
        out = np.full(len(h), -1, np.int64)
        at, slot = np.arange(len(h)), (h >> np.uint64(64 - self.BITS)).astype(np.int64)
        while len(at):
            n = self.slots[slot]
            there = n >= 0
            at, slot, n = at[there], slot[there], n[there]
            same = (self.h[n] == h[at]) & (self.g[n] == g[at])
            out[at[same]] = n[same]
            at, slot = at[~same], (slot[~same] + 1) & (len(self.slots) - 1)
        return out

    def add(self, h: np.ndarray, g: np.ndarray) -> None:
        """Number hashes that are not in it, all different."""
        upto = self.count + len(h)
        if upto * 2 > len(self.slots):
            raise ValueError("the table is too full")
        self.h, self.g = _grown(self.h, upto), _grown(self.g, upto)
        new = np.arange(self.count, upto, dtype=np.int32)
        self.h[self.count : upto], self.g[self.count : upto], self.count = h, g, upto
        slot = (h >> np.uint64(64 - self.BITS)).astype(np.int64)
        while len(new):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = new[free]  # of several for one slot the last stays, and the others go on
            left = self.slots[slot] != new
            new, slot = new[left], (slot[left] + 1) & (len(self.slots) - 1)


class WordIds:
    """``of(texts)``: for each text its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.blind = self.ask(["a b"]) == self.ask(["a  b"])  # blanks leave no trace in the ids
        self.cut: Callable[[str], str | None] = self.at_blanks if self.blind else self.at_spaces
        self.blank = np.zeros(256, bool)  # bytes between pieces
        self.blank[[32, *(range(9, 14) if self.blind else ())]] = True
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        edge = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end (or, byte-level, begin) a word
        for word, n in vocabulary.items():
            edge[n] = word.endswith("</w>") if self.blind else word.startswith("Ġ")
        self.edge = edge
        self.line = np.zeros(len(edge), bool)
        if not self.blind:
            self.line[np.frombuffer(self.ask(["\n"])[0], "<u4")] = True
        self.table = _Table()
        self.starts, self.lens, self.seen = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int32), np.zeros(1 << 12, np.int32)
        self.flat, self.filled = np.zeros(1 << 14, "<u4"), 0

    def forget(self) -> None:
        """Keep the keys asked for most often, drop the rest."""
        n = self.table.count
        best = np.argpartition(-self.seen[:n], min(KEPT, n - 1))[:KEPT]
        starts, lens = self.starts[best], self.lens[best].astype(np.int64)
        ends = np.cumsum(lens)
        flat = self.flat[np.repeat(starts - ends + lens, lens) + np.arange(int(ends[-1]))]
        h, g = self.table.h[best], self.table.g[best]
        self.table, self.seen = _Table(), np.zeros(len(self.seen), np.int32)
        self.table.add(h, g)
        self.starts[: len(best)], self.lens[: len(best)] = ends - lens, lens
        self.flat[: len(flat)], self.filled = flat, len(flat)

    def split(self, text: str) -> str | None:
        """The text with blanks between pieces whose ids make up its own; None: the library must have it whole."""
        low = text.lower()  # pieces may be lower-cased, and must not turn into a special token by that
        return None if any(t in text or t in low for t in self.special) else self.cut(text)

    @staticmethod
    def at_blanks(text: str) -> str | None:
        if _SEPARATOR.search(text):
            return None
        if not text.isascii() and _OTHER_BLANK.search(text):
            text = " ".join(text.split())
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            pass
        else:
            text = text.lower()
        if "'" not in text and not _crowded().search(text):
            text = text.replace(".", " . ").replace(",", " , ")
        return text

    @staticmethod
    def at_spaces(text: str) -> str | None:
        if text[:1] in (" ", "\n") or text[-1:] in (" ", "\n") or any(x in text for x in _UNEVEN) or _STRANGE.search(text) or (
            not text.isascii() and _OTHER_BLANK.search(text)
        ):
            return None
        if not _LOOSE.search(text):
            text = text.replace(", ", " \x01, ").replace(". ", " \x01. ").replace(".\n", " \x01.\n").replace(",\n", " \x01,\n")
            if text[-1:] in (".", ","):
                text = f"{text[:-1]} \x01{text[-1]}"
        return HEAD + text.replace("\n", " \x01\n \x02")

    def ask(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _joined(self, keys: list[str], sep: str, edge: np.ndarray, after: bool) -> tuple[np.ndarray, np.ndarray] | None:
        """(ids, lengths) of keys encoded as one text; ``edge`` marks ids that end a key (``after``) or begin one."""
        text = sep.join(keys)
        ids = np.array(self.tokenizer.encode_batch_fast([text if after else sep + text], add_special_tokens=False)[0].ids, "<u4")
        at = np.nonzero(edge[ids])[0]
        if len(at) != len(keys):
            return None
        return ids, np.diff(at, prepend=-1) if after else np.diff(at, append=len(ids))

    def _learn(self, keys: list[str]) -> None:
        """Ids of new keys: many in one text, told apart at edges, where that is safe; all others one by one."""
        first = self.table.count - len(keys)
        if self.blind:
            own = [[k for k, w in enumerate(keys) if w.isalpha()], []]
        else:
            own = [[k for k, w in enumerate(keys) if w[0] > HEAD], [k for k, w in enumerate(keys) if w[0] == HEAD and w[1:].isalpha()]]
        order: list[int] = []
        lens: list[np.ndarray] = []
        flat: list[np.ndarray] = []
        for which, group in enumerate(own):
            for at in range(0, len(group), JOINED):
                some = group[at : at + JOINED]
                names = [keys[k][1:] for k in some] if which else [keys[k] for k in some]
                found = self._joined(names, "\n" if which else " ", self.line if which else self.edge, self.blind)
                if found:
                    ids, n = found
                    if which:  # without the line feeds
                        ids, n = ids[~self.line[ids]], n - 1
                    order += some
                    flat.append(ids)
                    lens.append(n)
        done = set(order)
        rest = [k for k in range(len(keys)) if k not in done]
        told = [keys[k] if self.blind else keys[k][1:] if keys[k][:1] in (GLUED, HEAD) else " " + keys[k] for k in rest]
        for at in range(0, len(rest), 20_000):
            for ids in self.ask(told[at : at + 20_000]):
                flat.append(np.frombuffer(ids, "<u4"))
                lens.append(np.array([len(ids) // 4]))
        ids, n, where = np.concatenate(flat), np.concatenate(lens), np.array(order + rest, np.int64) + first
        upto = first + len(keys)
        self.starts, self.lens, self.seen = _grown(self.starts, upto), _grown(self.lens, upto), _grown(self.seen, upto)
        self.flat = _grown(self.flat, self.filled + len(ids))
        self.lens[where] = n
        self.starts[where] = self.filled + np.cumsum(n) - n
        self.flat[self.filled : self.filled + len(ids)] = ids
        self.filled += len(ids)

    def numbers(self, cut: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of all pieces, how many each text has); pieces not seen before are learned."""
        data = np.frombuffer(b" ".join(cut) + bytes(8), np.uint8)
        blank = self.blank[data[: max(0, len(data) - 8)]]
        edges = np.flatnonzero(np.diff(np.concatenate(([True], blank, [True]))))
        starts, lens = edges[::2], edges[1::2] - edges[::2]
        stops = np.cumsum([len(x) + 1 for x in cut])
        counts = np.diff(np.searchsorted(starts, stops), prepend=0)
        h, g = hashes(data, starts, lens)
        found = self.table.find(h, g)
        lost = np.flatnonzero(found < 0)
        if len(lost):
            _, first, same = np.unique(h[lost], return_index=True, return_inverse=True)
            new = lost[first]
            if (g[new][same] != g[lost]).any():
                raise RuntimeError("two pieces of a batch with one 64-bit hash")
            raw = data.tobytes()
            self.table.add(h[new], g[new])
            self._learn([raw[a : a + n].decode() for a, n in zip(starts[new].tolist(), lens[new].tolist(), strict=True)])
            found[lost] = self.table.count - len(new) + same
        return found, counts

    def of(self, texts: list[str]) -> Iterator[bytes]:
        at = 0
        while at < len(texts):
            size, upto = 0, at
            while upto < len(texts) and (upto == at or size + len(texts[upto]) <= CHARS):
                size += len(texts[upto])
                upto += 1
            split = [self.split(t) if t else "" for t in texts[at:upto]]
            if self.table.count > CACHE:
                self.forget()
            index, counts = self.numbers([x.encode() if x else b"" for x in split])
            self.seen[: self.table.count] += np.bincount(index, minlength=self.table.count).astype(np.int32)
            lens = self.lens[index].astype(np.int64)
            ends = np.cumsum(lens)
            where = np.repeat(self.starts[index] - ends + lens, lens)
            where += np.arange(len(where))
            data = self.flat[where].tobytes()
            bounds = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(counts)))] * 4
            for t, own, a, b in zip(texts[at:upto], split, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                yield data[a:b] if own is not None else self.ask([t])[0]
            at = upto


@functools.cache
def word_ids(path: str) -> WordIds:
    return WordIds(path)
