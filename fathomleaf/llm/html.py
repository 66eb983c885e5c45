"""Main text of web pages by two passes of block rules.

A page is cut into blocks at block-level tags. Blocks in page furniture are out: by tag, role or hiding; by a class or id
that names comments, adverts or consent; and by one that names other furniture (a sidebar, a widget), unless that element
holds the page's text itself, with hardly any text outside it. The first pass then decides what it can: blocks mostly made
of links are out; blocks with many stop words, and long ones with some, are in. The rest is ambiguous, short blocks above
all, and in the second pass takes the label of the nearest decided neighbour in its own region (an article element, or
the page); where both are as near and disagree, or none is decided, the region's own: in for an article element, and
elsewhere in for long blocks of few links. On pages without stop words of any language listed, length and links decide.

Defined results: null or empty html, and pages without a kept block, have an empty text of 0 characters; an unclosed
comment, script or style hides the rest, as in browsers; repeated rows each give a row; null ids and urls stay null;
extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomleaf.llm._shared import table

STOP_WORDS = frozenset(
    "the of and to in is that for it as was with be by on not he his are this at from or an which you have had they were but their one all we"
    " her she there been if more when will would who so no "
    "de la le les et des en un une du que qui dans pour par sur pas plus au avec ce il est sont ne se aux ou mais nous vous elle son sa ses"
    " leur cette ces comme "
    "der die das und ist nicht mit von den dem ein eine einer eines auf für im sich auch es an werden aus er hat dass sie nach bei um am sind"
    " noch wie über so zum zur haben nur oder aber vor bis mehr durch man "
    "el los las y del que se por con una para es al lo como más su sus o pero le ha me si sin sobre este ya entre cuando todo esta ser son dos también fue había".split()
)
RAW = ("script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp", "template", "noscript")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
OUT_TAGS = frozenset("nav footer aside form menu dialog select button fieldset datalist object svg canvas audio video map".split())
OUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
# Names in a class or id: of what is never the text, and of what an element around the text may be called as well.
NEVER_CUES = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored sponsors cookie cookies consent gdpr comment comments commentlist disqus reply replies respond hidden".split()
)
CUES = frozenset(
    "promo promoted promotion promotions banner notice notices notification notifications alert popup modal overlay newsletter subscribe"
    " subscription signup login register sidebar rail widget widgets "
    "related recommended recommendations menu nav navbar navigation breadcrumb breadcrumbs masthead header footer copyright share sharing social pagination pager toolbar search skip paywall".split()
)
INLINE_CUES = NEVER_CUES | frozenset("promo promoted share sharing social".split())
ARTICLE_CUES = frozenset("comment comments reply replies ad advert sponsored promo related teaser".split())
NOT_BEFORE, NOT_AFTER = frozenset("with has have no non without".split()), frozenset("enabled disabled open closed on off".split())  # has-sidebar, comments-closed
LONG_CHARS, DENSE, LINKS, MOSTLY_LINKS, SOME_CHARS = 140, 0.2, 0.33, 0.5, 40
NO_STOP_WORDS = 0.02  # a page's density below which its language is none of those listed
OUTSIDE = 0.25  # an element of a furniture name is the text's own if no more than this share of its text stands outside

_TOKEN = re.compile(r"<!--|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|</?[a-zA-Z][^>]*+>?|<[!?/][^>]*+>?")
_ATTR = re.compile(r"([^\s=/\"'>]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?+")
_CUE = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_COMMENT_END = re.compile(r"--!?>")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*+>?", re.I) for name in RAW}
_LETTERS = re.compile(r"[^\W\d_]+")


_UNSPACED = re.compile(r"[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uac00-\ud7af]")  # Thai to Khmer, kana, Han, Hangul


@dataclass
class Block:
    region: int
    in_article: bool
    out: bool
    named: tuple[int, ...]  # the elements of furniture names around it
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""
    size: int = 0
    links: float = 0.0
    dense: float = 0.0

    def close(self) -> None:
        self.text = " ".join("".join(self.parts).split())
        if self.text:
            words = self.text.lower().split()
            self.size = len(self.text) + (0 if self.text.isascii() else 2 * len(_UNSPACED.findall(self.text)))
            self.links = self.linked / len("".join(words))
            self.dense = sum((m := _LETTERS.search(w)) is not None and m.group() in STOP_WORDS for w in words) / len(words)


@dataclass
class _Open:
    tag: str
    out: bool
    named: tuple[int, ...]
    region: int
    article: bool


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(raw)} if raw.strip(" /") else {}


def _cues(attrs: dict[str, str]) -> set[str]:
    """Words of the names in class and id that say what the element is, not what it goes with."""
    out = set()
    for k in ("class", "id"):
        for name in attrs.get(k, "").split():
            words = [m.lower() for m in _CUE.findall(name)]
            for i, w in enumerate(words):
                if not (i and words[i - 1] in NOT_BEFORE) and not (i + 1 < len(words) and words[i + 1] in NOT_AFTER):
                    out.add(w)
    return out


def _hidden(attrs: dict[str, str]) -> bool:
    style = attrs.get("style", "").replace(" ", "").lower()
    return "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" or "display:none" in style or "visibility:hidden" in style


def blocks(page: str) -> list[Block]:
    """Blocks in page order, blank ones left out."""
    found: list[Block] = []
    stack: list[_Open] = [_Open("", False, (), 0, False)]
    regions, named, links, at = 1, 0, 0, 0
    current: Block | None = None
    skipped: tuple[str, int, int] | None = None  # an inline element that does not count: its tag, how often open, height of the stack

    def finish() -> None:
        nonlocal current
        if current is not None:
            current.close()
            if current.text:
                found.append(current)
            current = None

    def text(raw: str) -> None:
        nonlocal current
        if not raw or skipped:
            return
        raw = entities.unescape(raw) if "&" in raw else raw
        if current is None:
            if raw.isspace():
                return
            top = stack[-1]
            current = Block(top.region, top.article, top.out, top.named)
        current.parts.append(raw)
        if links:
            current.linked += len("".join(raw.split()))

    while True:
        m = _TOKEN.search(page, at)
        text(page[at : m.start()] if m else page[at:])
        if m is None:
            break
        at = m.end()
        if m.group() == "<!--":
            end = _COMMENT_END.search(page, at)
            at = end.end() if end else len(page)
            continue
        if not m[2]:
            continue
        tag, closing = m[2].lower(), bool(m[1])
        if tag in INLINE:
            if skipped and tag == skipped[0]:
                skipped = (tag, skipped[1] + (-1 if closing else 1), skipped[2])
                if not skipped[1]:
                    skipped = None
            elif not skipped and not closing and tag not in VOID and m[3].strip(" /"):
                attrs = _attributes(m[3])
                if _hidden(attrs) or _cues(attrs) & INLINE_CUES:
                    skipped = (tag, 1, len(stack))
            if tag == "a":
                links = 0 if closing else 1
            elif tag == "br":
                text(" ")
            continue
        finish()
        if tag in RAW:
            if not closing:
                end = _RAW_END[tag].search(page, at)
                at = end.end() if end else len(page)
            continue
        if closing:
            links = 0
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
            if skipped and len(stack) < skipped[2]:
                skipped = None
            continue
        if tag in VOID:
            continue
        if tag in ("p", "li", "dt", "dd", "tr", "td", "th", "option") and stack[-1].tag == tag:
            stack.pop()
        top, attrs = stack[-1], _attributes(m[3])
        role = attrs.get("role", "").lower()
        article = tag in ("article", "main") or role in ("main", "article") or attrs.get("itemprop", "").lower() == "articlebody"
        cues = _cues(attrs) if tag not in ("html", "body") else set()
        around = top.named
        if article:
            out = _hidden(attrs) or bool(cues & ARTICLE_CUES) or (top.out and any(o.tag in ("aside", "footer") or o.article for o in stack if o.out))
            around = () if not top.article else around
        else:
            out = top.out or _hidden(attrs) or tag in OUT_TAGS or (tag == "header" and not top.article) or role in OUT_ROLES or bool(cues & NEVER_CUES)
            if not out and cues & (CUES - {"header"} if top.article else CUES):
                around, named = (*around, named), named + 1
        region = top.region
        if article and not top.article:
            region, regions = regions, regions + 1
        stack.append(_Open(tag, out, around, region, article or top.article))
    finish()
    return found


def _settle_names(all_: list[Block]) -> None:
    """Blocks in elements of furniture names are out, unless such an element is where the page's text is."""
    if not any(b.named for b in all_):
        return
    good = [0 if b.out or b.size < SOME_CHARS or b.links > LINKS else b.size for b in all_]
    plain = sum(n for b, n in zip(all_, good, strict=True) if not b.named)
    article = any(n and b.in_article and not b.named for b, n in zip(all_, good, strict=True))
    held: dict[int, int] = {}
    for b, n in zip(all_, good, strict=True):
        for k in b.named:
            held[k] = held.get(k, 0) + n
    most = max(held.values())
    own = {k for k, n in held.items() if n and not article and plain <= OUTSIDE * n and n > most / 2}
    for b in all_:
        b.out = b.out or not own.issuperset(b.named)


def _decide(b: Block, listed: bool) -> bool | None:
    """The first pass: in, out, or not yet known. ``listed``: stop words of the page's language are known."""
    if b.out or b.links > MOSTLY_LINKS:
        return False
    if b.links > LINKS:
        return None if b.in_article else False
    if b.size >= LONG_CHARS:
        return True if b.dense >= DENSE / 2 or not listed else None
    return True if b.size >= SOME_CHARS and b.dense >= DENSE else None


def _inherit(own: list[Block], labels: list[bool | None]) -> list[bool]:
    """The second pass, over the blocks of one region in page order."""
    before, after = [None] * len(own), [None] * len(own)
    for found, order in ((before, range(len(own))), (after, range(len(own) - 1, -1, -1))):
        last = None
        for k in order:
            last = k if labels[k] is not None else last
            found[k] = last
    out = []
    for k, b in enumerate(own):
        x, y = before[k], after[k]
        if x is not None and (y is None or k - x < y - k or labels[x] == labels[y]):
            out.append(labels[x])
        elif y is not None and (x is None or y - k < k - x):
            out.append(labels[y])
        else:
            out.append(b.in_article or (b.size >= LONG_CHARS and b.links <= LINKS))
    return out


def extract(page: str | None) -> str:
    """The main text: kept blocks in page order, joined by one space."""
    if not page:
        return ""
    all_ = blocks(page)
    _settle_names(all_)
    regions: dict[int, list[Block]] = {}
    for b in all_:
        if not b.out:
            regions.setdefault(b.region, []).append(b)
    long = [b for own in regions.values() for b in own if b.size >= SOME_CHARS]
    listed = sum(b.dense * b.size for b in long) >= NO_STOP_WORDS * sum(b.size for b in long)
    kept = set()
    for own in regions.values():
        kept.update(id(b) for b, keep in zip(own, _inherit(own, [_decide(b, listed) for b in own]), strict=True) if keep)
    return " ".join(b.text for b in all_ if id(b) in kept)


def main_text(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns ``keep``, text and n_chars."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(h) for h in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=out.names
            )

    out = T.StructType([*(pages.schema[c] for c in keep), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return pages.select(*keep, F.col(html_col).alias("html_")).mapInArrow(run, out)


def op5_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


QUERIES = {"op5_html_main_text": op5_html_main_text}
ORACLE_SQL: dict[str, str] = {}
