"""Tokens, media, html, dedup, quality: against libraries, brute force, or an exact round trip."""

import base64
import hashlib
import itertools
import random
import re
import tarfile
import zlib
from collections import Counter
from html.parser import HTMLParser
from urllib.parse import urlsplit

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from fathomleaf.llm import bpe, html, media, packing, quality, simhash, substring, tokenfiles
from fathomleaf.llm import wordids as W

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ODD = "abC 's't're've'll'm'd\n\t\x0b　\xa0 é1²!?'\"\U0001f600́中 \x1c\x85Σς.,_<|endoftext|>"


def texts(n=400, seed=1):
    r = random.Random(seed)
    words = ["".join(r.choice("aeinrst") for _ in range(r.randrange(1, 9))) for _ in range(60)]
    out = ["".join(r.choice(ODD) for _ in range(r.randrange(0, 50))) for _ in range(n)]
    out += [" ".join(r.choice(words) + r.choice(["", "", ".", ",", "!!", "%"]) for _ in range(r.randrange(1, 80))).replace(". ", ".\n") for _ in range(n)]
    return ["", " ", "\n", "a" * 3000, "x.y", ", a", "a , b", "\x01", *out]


def frame(spark, rows, schema="doc_id long, text string, lang string, source string, n_chars long"):
    return spark.createDataFrame(rows, schema)


def docs(spark, values):
    return frame(spark, [(i, t, "en", "s", len(t or "")) for i, t in values])


AWKWARD = [
    (1, None),
    (2, ""),
    (3, "same words here and there for all of us to see"),
    (3, "same words here and there for all of us to see"),
    (None, "same words here and there for all of us to see"),
    (None, None),
    (5, "z" * 60_000),
    (6, "\n\n ."),
]


def test_bpe_as_tiktoken():
    own = bpe.Codec(MULTI)
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    every = texts()
    for t, pieces in zip(every, own.pieces(every), strict=True):
        ids = [i for p, _ in pieces for i in p]
        assert ids == enc.encode_ordinary(t) and own.decode(ids) == t.encode()
        offsets = own.offsets(ids)
        assert all(t.encode()[o : o + len(own.bytes_of[i])] == own.bytes_of[i] for o, i in zip(offsets, ids, strict=True))


def test_bpe_classes_as_the_library():
    kind = bpe.char_classes()
    r = random.Random(3)
    own = bpe.Codec(MULTI)
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    some = [chr(c) for c in r.sample([c for c in range(0x110000) if not 0xD800 <= c < 0xE000], 3000)]
    joined = ["a" + c + "a1" + c for c in some]
    assert [[i for p, _ in x for i in p] for x in own.pieces(joined)] == enc.encode_ordinary_batch(joined, num_threads=1)
    assert kind[ord("a")] == bpe.S_L and kind[ord("1")] == bpe.S_N


def test_bpe_documents(spark):
    got = bpe.round_trip(docs(spark, AWKWARD), MULTI).collect()
    assert len(got) == len(AWKWARD)
    empty = hashlib.sha256(b"").hexdigest()
    assert {(r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got if r.doc_id in (1, 2)} == {(0, empty, empty)}
    encoded = bpe.encode_documents(docs(spark, AWKWARD[2:]), MULTI)
    assert sorted(bytes(r.text_bytes) for r in bpe.decode_documents(encoded, MULTI).collect()) == sorted((t or "").encode() for _, t in AWKWARD[2:])
    assert bpe.round_trip(docs(spark, AWKWARD).limit(0), MULTI).count() == 0


def odd_texts(n, seed):
    """Random texts over characters that normalisers and pre-tokenisers treat in their own way, and whole special tokens."""
    r = random.Random(seed)
    pool = [
        *ODD,
        "İ",
        "ı",
        "\u0301",
        "\u0307",
        "e\u0301",
        "\u0958",
        "\u09dc",
        "ﬁ",
        "Å",
        "Ⅷ",
        "①",
        "½",
        "ß",
        "\u1100\u1161",
        "\u200d",
        "\u0345",
        "<|endoftext|>",
        "<|startoftext|>",
        "<|ENDOFTEXT|>",
        *"aZ09",
        " ",
        " ",
        ".",
        ",",
        ". ",
        ", ",
    ]
    return ["".join(r.choice(pool) for _ in range(r.randrange(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_word_ids_as_the_library(name, monkeypatch):
    """The library as it comes: special tokens whole in a text have their own ids."""
    t = Tokenizer.from_file(public_tokenizers.path(name))
    monkeypatch.setattr(W, "CACHE", 3000)
    monkeypatch.setattr(W, "KEPT", 1000)
    monkeypatch.setattr(W, "CHARS", 30_000)
    every = [*texts(seed=2), *odd_texts(10_000, 5), "İ,", "DENİZLİ. İzmir, x", "hello <|endoftext|> world"]
    want = [e.ids for e in t.encode_batch(every, add_special_tokens=False)]
    for text, ids, own in zip(every, W.WordIds(public_tokenizers.path(name)).of(every), want, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == own, text


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_word_ids_around_every_letter(name):
    """Each letter and digit of Unicode beside a comma and a full stop."""
    t = Tokenizer.from_file(public_tokenizers.path(name))
    every = [f"x{c}, {c}.{c}y. {c}" for c in map(chr, range(0x110000)) if c.isalnum()]
    want = [e.ids for e in t.encode_batch(every, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in W.WordIds(public_tokenizers.path(name)).of(every)] == want


def test_media_round_trip(spark):
    stored = media.store(docs(spark, AWKWARD))
    got = media.read_back(media.with_headers(stored)).collect()
    assert len(got) == len(AWKWARD)
    by = {t: None for _, t in AWKWARD}
    for r in stored.collect():
        name = urlsplit(r.shard).path
        with open(name, "rb") as src:
            src.seek(r.offset)
            payload = media.from_png(src.read(r.length))
        assert hashlib.sha256(payload).hexdigest() == r.digest
        with tarfile.open(name) as tar:
            assert f"{r.digest}.png" in tar.getnames()
    for _, t in AWKWARD:
        raw = (t or "").encode()
        payload = raw + bytes(-len(raw) % 64 if raw else 64)
        by[t] = (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
    assert {(r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in got} == set(by.values())
    assert len({(r.media_sha256, r.feature) for r in got}) == len({p[2] for p in by.values()})
    assert all(r.width == 64 and r.width * r.height == r.payload_bytes for r in got)


def test_variable_length_coding():
    r = np.random.default_rng(1)
    for n in (0, 1, 3, 4, 5, 1000):
        x = (r.integers(0, 2**32, n, dtype=np.uint64) >> r.integers(0, 32, n, dtype=np.uint64)).astype("<u4")
        assert (tokenfiles.decode(b"??" + tokenfiles.encode(x), n, 2) == x).all()


def test_token_files(spark, monkeypatch):
    monkeypatch.setattr(tokenfiles, "FILE_IDS", 50)
    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    values = [(i * 7 % 31, x) for i, x in enumerate(texts(10))] + AWKWARD[:3]
    table = docs(spark, values)
    got = sorted(tokenfiles.read(tokenfiles.write(table, path), table.schema["doc_id"].dataType).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted(i for i, _ in values)
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got[:-1])]).tolist()
    want = sorted(
        (
            i, len(ids) + 1, zlib.crc32(np.array([*ids, 0], "<u4").tobytes())
        ) for i, x in values for ids in [t.encode(x or "", add_special_tokens=False).ids]
    )
    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want


def fewest(lengths, capacity):
    """The least number of sequences, by going through the sets of pieces (small ones only)."""
    n = len(lengths)
    best = [(0, 0)] + [(n + 1, 0)] * ((1 << n) - 1)  # sequences closed, tokens in the open one
    for mask in range(1 << n):
        closed, used = best[mask]
        for k in range(n):
            if not mask >> k & 1:
                new = (closed, used + lengths[k]) if used + lengths[k] <= capacity else (closed + 1, lengths[k])
                best[mask | 1 << k] = min(best[mask | 1 << k], new)
    return best[-1][0] + bool(best[-1][1])


def test_reduction_keeps_the_optimum():
    r, triples = random.Random(14), 0
    for _ in range(400):
        capacity = r.choice([20, 37, 60])
        lengths = [r.randrange(2, capacity + 1) if r.random() < 0.4 else r.randrange(2, capacity // 2) for _ in range(r.randrange(1, 11))]
        counts = Counter(lengths)
        plan = packing.Plan(dict(counts), capacity)
        members = Counter()
        fixed = Counter()
        for n, lo, hi, seq, _, each in plan.entries:
            for rank in range(lo, hi):
                s = seq + (rank - lo) // each
                members[s] += 1
                if s < plan.fixed:
                    fixed[n] += 1
        triples += sum(members[s] == 3 for s in range(plan.fixed))
        assert plan.fixed + fewest(list((counts - fixed).elements()), capacity) == fewest(lengths, capacity), lengths
    assert triples > 20


def test_plan_is_whole_and_tight():
    r = random.Random(4)
    for _ in range(25):
        counts: dict[int, int] = {}
        for _ in range(r.choice([1, 3, 30, 600])):
            n = r.choice([4096, r.randrange(1, 4097), r.randrange(1, 60), r.randrange(1000, 2100)])
            counts[n] = counts.get(n, 0) + 1
        plan, used, at = packing.Plan(counts), {}, {}
        for n, lo, hi, first, offset, each in plan.entries:
            for k in range(lo, hi):
                q, w = divmod(k - lo, each)
                used.setdefault(first + q, []).append((offset + w * n, n))
                at.setdefault(n, []).append(k)
        assert {n: sorted(v) for n, v in at.items()} == {n: list(range(c)) for n, c in counts.items()}
        for v in used.values():
            end = 0
            for offset, n in sorted(v):
                assert offset == end
                end += n
            assert end <= 4096
        least = -(-sum(n * c for n, c in counts.items()) // 4096)
        assert len(used) == plan.sequences and plan.sequences <= max(least + 2, 1.05 * least)


def test_pack_documents(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    values = [*AWKWARD, (9, "word " * 9000)]
    rows = packing.pack(docs(spark, values), path).collect()
    want = []
    for i, x in values:
        ids = [*t.encode(x or "", add_special_tokens=False).ids, 1]
        want += [
            (
                str(i), p, a, len(ids[a : a + 4096]), zlib.crc32(np.array(ids[a : a + 4096], "<u4").tobytes())
            ) for p, a in enumerate(range(0, len(ids), 4096))
        ]
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    for s in {r.sequence_id for r in rows}:
        own = sorted((r.offset, r.length) for r in rows if r.sequence_id == s)
        assert [o for o, _ in own] == np.cumsum([0, *(n for _, n in own[:-1])]).tolist() and sum(n for _, n in own) <= 4096
    assert packing.pack(docs(spark, AWKWARD).limit(0), path).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>t</title><script>var a="</p>";</script></head><body class="has-sidebar"><nav><a href=x>Home of the site</a></nav><div class="ad">Buy the best of the things in the world for you and for me today and the day after.</div>
<article><h1>Du le.</h1><p><b>First &amp; second&nbsp;line<br>of the text<p>Short<aside>Related to the thing</aside><div id="cookie-notice"><p>We use cookies on this site and you have to accept them to go on with it, all of the time and in all of the places.</p></div></article>
<section id=comments><p>I think that this is the best of all the articles that I have read in the time that I have been here on the site.</p></section><footer>&copy; foot</footer><!-- open"""


def test_html():
    assert html.extract(PAGE) == "Du le. First & second line of the text Short"
    assert html.extract(None) == html.extract("") == html.extract("<script>x") == html.extract("<!-- <p>hidden") == ""
    long = "This is the text of it and it is long enough to be taken for the main part of the page by the rules that are used in the first of the two passes."
    assert html.extract(f"<div><a>x</a></div><p>{long}</p><p>tiny</p><p>{long}</p><div>menu</div>").count("tiny") == 1
    assert html.extract("<p " + "a='" * 5000 + ">x" + "<" * 5000) is not None


class _Tree(HTMLParser):
    """A page as nested [tag, attributes, children]; texts are strings."""

    def __init__(self):
        super().__init__()
        self.root = ["", {}, []]
        self.path = [self.root]

    def handle_starttag(self, tag, attrs):
        node = [tag, {k: v or "" for k, v in attrs}, []]
        self.path[-1][2].append(node)
        if tag not in html.VOID:
            self.path.append(node)

    def handle_endtag(self, tag):
        assert self.path[-1][0] == tag, "the pages of this test are well formed"
        self.path.pop()

    def handle_data(self, data):
        self.path[-1][2].append(data)


def slow_extract(page):
    """The rules of ``html`` once more, over a tree and with plain searches. Articles are not nested in these pages."""
    tree = _Tree()
    tree.feed(page)
    tree.close()
    found, names, regions = [], [], itertools.count(1)

    def cues(attrs):
        out = set()
        for name in f"{attrs.get('class', '')} {attrs.get('id', '')}".split():
            words = re.findall("[A-Z]*[a-z]+", name)
            for i, w in enumerate(words):
                if not (i > 0 and words[i - 1] in html.NOT_BEFORE) and not (i < len(words) - 1 and words[i + 1] in html.NOT_AFTER):
                    out.add(w.lower())
        return out

    def hidden(attrs):
        return "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in attrs.get("style", "").replace(" ", "")

    def walk(node, state, block, link):
        tag, attrs, children = node
        if tag in html.RAW:
            return None
        if tag in html.INLINE:
            if hidden(attrs) or cues(attrs) & html.INLINE_CUES:
                return block
            link = link or tag == "a"
        elif tag:
            block = None
            own = cues(attrs)
            if tag in ("article", "main"):
                bad = hidden(attrs) or bool(own & html.ARTICLE_CUES) or (state["out"] and state["beside"])
                state = {"out": bad, "beside": state["beside"], "region": next(regions), "article": True, "named": []}
            else:
                bad = state["out"] or hidden(attrs) or tag in html.OUT_TAGS or (tag == "header" and not state["article"]) or bool(own & html.NEVER_CUES)
                state = {**state, "out": bad, "beside": state["beside"] or (bad and tag in ("aside", "footer"))}
                if not bad and own & (html.CUES - ({"header"} if state["article"] else set())):
                    names.append(node)
                    state["named"] = [*state["named"], len(names) - 1]
        for child in children:
            if isinstance(child, str):
                if block is None and child.strip():
                    block = {**state, "raw": "", "linked": 0}
                    found.append(block)
                if block is not None:
                    block["raw"] += child
                    block["linked"] += len("".join(child.split())) if link else 0
            elif child[0] == "br":
                if block is not None:
                    block["raw"] += " "
            else:
                block = walk(child, state, block, link)
        return block if tag in html.INLINE else None

    walk(tree.root, {"out": False, "beside": False, "region": 0, "article": False, "named": []}, None, False)
    for b in found:
        b["text"] = " ".join(b["raw"].split())
        words = b["text"].lower().split()
        b["n"], b["links"] = len(b["text"]), b["linked"] / len("".join(words))
        b["dense"] = sum((m := re.search(r"[^\W\d_]+", w)) is not None and m[0] in html.STOP_WORDS for w in words) / len(words)
    good = lambda b: b["n"] if not b["out"] and b["n"] >= 40 and b["links"] <= 0.33 else 0
    held = {k: sum(good(b) for b in found if k in b["named"]) for k in range(len(names)) if any(k in b["named"] for b in found)}
    plain = sum(good(b) for b in found if not b["named"])
    in_article = any(good(b) and b["article"] for b in found if not b["named"])
    fine = [k for k, n in held.items() if n and not in_article and plain <= 0.25 * n and 2 * n > max(held.values())]
    for b in found:
        b["out"] = b["out"] or any(k not in fine for k in b["named"])
    some = [b for b in found if not b["out"] and b["n"] >= 40]
    listed = sum(b["dense"] * b["n"] for b in some) >= 0.02 * sum(b["n"] for b in some)
    kept = []
    for b in found:
        if b["out"]:
            continue
        label = lambda x: False if x["links"] > 0.5 else (None if x["article"] else False) if x["links"] > 0.33 else (True if x["dense"] >= 0.1 or not listed else None) if x["n"] >= 140 else True if x["n"] >= 40 and x["dense"] >= 0.2 else None
        near = [x for x in found if not x["out"] and x["region"] == b["region"]]
        k = next(i for i, x in enumerate(near) if x is b)
        known = sorted((abs(i - k), label(x)) for i, x in enumerate(near) if label(x) is not None)
        closest = {y for d, y in known if d == known[0][0]}
        if closest == {True} or (len(closest) != 1 and (b["article"] or (b["n"] >= 140 and b["links"] <= 0.33))):
            kept.append(b["text"])
        elif len(closest) == 2:  # as near on both sides
            pass
    return " ".join(kept)


def random_page(r):
    stop, other = ["the", "of", "and", "is", "der", "que", "la"], ["zog", "mirt", "plon", "quex", "vard", "&amp;", "&eacute;t"]

    def text(n, share):
        return " ".join(r.choice(stop) if r.random() < share else r.choice(other) for _ in range(n))

    def part(depth):
        kind = r.randrange(12)
        if kind < 4:
            return f"<p>{text(r.choice([2, 5, 12, 40, 60]), r.choice([0, 0.1, 0.4]))}</p>"
        if kind == 4:
            return f"<p>{text(r.choice([1, 6, 30]), 0.3)} <a href='x'>{text(r.choice([1, 6, 30]), 0.3)}</a></p>"
        if kind == 5:
            return f"<p>{text(9, 0.3)} <span {r.choice(['hidden', 'class=ad', 'style=&quot;display: none&quot;', 'id=no-ads', 'class=x'])}>{text(4, 0.3)} <b>{text(1, 0)}</b></span>{text(9, 0.3)}<br>{text(3, 0)}</p>"
        if kind == 6:
            return "<ul>" + "".join(f"<li>{text(2, 0)}</li>" for _ in range(3)) + "</ul>"
        if kind == 7:
            return f"<script>var x = '<p>{text(5, 0.3)}</p>';</script><!-- <p>{text(5, 0.3)}</p> -->"
        if depth > 2:
            return text(3, 0.3)
        names = [
            "",
            "class='sidebar'",
            "class='article-with-sidebar'",
            "id='content' class='widget'",
            "class='comments'",
            "class='comments-closed'",
            "class='cookieBanner'",
            "class='post body'",
            "style='display:none'",
            "class='header'",
        ]
        tag = r.choice(["div", "div", "div", "section", "nav", "aside", "header", "footer", "form"])
        return f"<{tag} {r.choice(names)}>" + "".join(part(depth + 1) for _ in range(r.randrange(1, 5))) + f"</{tag}>"

    body = [part(0) for _ in range(r.randrange(1, 7))]
    if r.random() < 0.5:
        body.insert(
            r.randrange(len(body) + 1),
            f"<article {r.choice(['', '', 'class=comment'])}><h1>{text(4, 0)}</h1>" + "".join(
                part(1) for _ in range(r.randrange(1, 6))
            ) + "</article>",
        )
    return "<!DOCTYPE html><html><head><title>t</title></head><body class='has-sidebar'>" + "".join(body) + "</body></html>"


def test_html_rules_read_once_more():
    r = random.Random(21)
    pages = [random_page(r) for _ in range(3000)]
    kept = 0
    for page in pages:
        assert html.extract(page) == slow_extract(page), page
        kept += bool(html.extract(page))
    assert 1000 < kept < 3000


LONG = "This is the text of it and it is long enough to be taken for the main part of the page by the rules that are used in the first of the two passes of it."


@pytest.mark.parametrize(
    "page,want",
    [
        (f'<div class="article-with-sidebar"><p>{LONG}</p></div>', LONG),
        (f'<div id="content" class="widget"><p>{LONG}</p><div class="sidebar"><p>this is beside it and of no use</p></div></div>', LONG),
        (f'<article><p>{LONG} <span style="display:none">gone</span><span class="ad">buy <span>now</span></span> End</p></article>', LONG + " End"),
        (f'<div class="post"><p>{LONG}</p></div><div class="comments"><p>{LONG} {LONG}</p><p>{LONG}</p></div>', LONG),
        (f'<div class="text"><p>{LONG}</p></div><div class="sidebar"><p>{LONG}</p><p>{LONG}</p></div>', LONG),
        (f"<article><h1>Title</h1><p>{LONG}</p><p><a>Click here</a> <a>Share</a> <a>Print</a></p></article>", "Title " + LONG),
        ("<div><p>" + "Это длинный текст статьи. " * 8 + "</p></div><nav>меню</nav>", ("Это длинный текст статьи. " * 8).strip()),
        ("<div><p>" + "这是一个足够长的中文段落，应当被当作正文。" * 4 + "</p></div>", "这是一个足够长的中文段落，应当被当作正文。" * 4),
    ],
)
def test_html_pages_that_names_or_languages_mislead(page, want):
    assert html.extract(page) == want


def clash(spark, values):
    """Documents with extra columns whose names the operators use themselves."""
    names = [
        "row_",
        "text_",
        "fp_",
        "set_",
        "size_",
        "ids_",
        "wide_",
        "spans_",
        "score",
        "label_",
        "at_",
        "n_",
        "tokens",
        "start",
        "digest",
        "component_id",
        "fingerprint",
        "ids",
        "offsets",
        "piece",
        "length",
    ]
    df = docs(spark, values)
    for n in names:
        df = df.withColumn(n, F.lit("clash"))
    return df


LONG_TEXT = " ".join(f"w{k % 977} x{k}" for k in range(30_000)) + "\n" + "q" * 100_000
CASES = [*AWKWARD, (7, LONG_TEXT), (8, LONG_TEXT), (9, " \n\t "), (None, LONG_TEXT)]


@pytest.mark.parametrize(
    "run",
    [
        lambda df: bpe.round_trip(df, MULTI),
        lambda df: media.read_back(media.with_headers(media.store(df))),
        lambda df: substring.remove_repeats(df),
        lambda df: substring.clean(df),
        lambda df: tokenfiles.read(tokenfiles.write(df, public_tokenizers.path("byte_bpe_50k.json")), df.schema["doc_id"].dataType),
        lambda df: simhash.near_duplicates(df),
        lambda df: simhash.groups(df),
        lambda df: packing.pack(df, public_tokenizers.path("word_bpe_49k.json")).filter("piece = 0"),
        lambda df: quality.scored(df, quality.Model([("a good text", 1), ("###", 0)])),
    ],
    ids=["bpe", "media", "substring", "clean", "tokenfiles", "simhash", "groups", "packing", "quality"],
)
def test_awkward_tables(spark, run):
    """Clashing names, nulls, repeated rows and long texts give a row each; an empty table gives none."""
    df = clash(spark, CASES)
    got = run(df)
    assert len(set(got.columns)) == len(got.columns)
    assert Counter(r.doc_id for r in got.collect()) == Counter(i for i, _ in CASES)
    assert run(df.limit(0)).count() == 0


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=[n for n, _ in corpus_pipeline.STAGES])
def test_pipeline_stages_on_awkward_tables(spark, data, stage):
    name, run = stage
    got = run(spark, clash(spark, CASES), data)
    if name != "packing":
        assert got.columns == list(corpus_pipeline.COLUMNS)
    ids = [r.doc_id for r in got.collect()]
    assert set(ids) <= {i for i, _ in CASES}
    if name == "near_duplicates":  # null and blank ones are copies; so are equal texts
        assert sorted(ids, key=lambda i: (i is None, i or 0)) == [1, 3, 5, 6, 7]
    assert run(spark, clash(spark, CASES).limit(0), data).count() == 0


def test_html_pages(spark):
    rows = [(1, "u", None, "x"), (2, None, PAGE, "y"), (2, None, PAGE, "y")]
    got = html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert sorted((r.page_id, r.n_chars) for r in got) == [(1, 0), (2, 44), (2, 44)]


def slow_dedup(values):
    """Keep the first of equal units by (id, place), with plain loops."""
    order = sorted(range(len(values)), key=lambda k: (values[k][0] is None, values[k][0] or 0, k))
    seen, out = set(), {}
    for k in order:
        text = values[k][1] or ""
        keep = [True] * len(text)
        for digest, a, b in sorted(substring.units(text), key=lambda u: u[1:]):
            if digest in seen:
                keep[a:b] = [False] * (b - a)
            seen.add(digest)
        out[k] = "".join(c for c, y in zip(text, keep, strict=True) if y)
    return [out[k] for k in range(len(values))]


def test_substring_dedup(spark):
    r = random.Random(5)
    pool = [" ".join(r.choice("ab cd ef gh ij kl".split()) for _ in range(9)) + r.choice([".", "!", ""]) for _ in range(8)]
    values = [(i, r.choice(["\n", " "]).join(r.choice(pool) for _ in range(r.randrange(1, 7)))) for i in range(40)] + AWKWARD
    table = docs(spark, values).coalesce(1)
    got = substring.clean(table).collect()
    assert sorted((r.doc_id or -1, r.text) for r in got) == sorted((i or -1, t) for (i, _), t in zip(values, slow_dedup(values), strict=True))
    for r_, (_, t) in zip(sorted(got, key=lambda x: (x.doc_id or -1, x.text)), sorted(((i or -1, x) for i, x in values), key=str), strict=False):
        assert all(s.start < s.stop for s in r_.spans_)
    assert substring.remove_repeats(docs(spark, AWKWARD).limit(0)).count() == 0


def test_a_long_passage_inside_lines_goes_once(spark):
    passage = (
        "the very long passage that is shared goes on here for a while. and then it says some more of the same things to fill it up. at last it comes"
        " to its end after all of these many words."
    )
    table = docs(spark, [(1, "own start. " + passage + " own end"), (2, "another own beginning. " + passage + " another close")])
    by = {r.doc_id: r.text for r in substring.remove_repeats(table).collect()}
    assert by[1] == "own start. " + passage + " own end" and "passage that is shared" not in by[2] and by[2].startswith("another own beginning.")


def labelled(n=120, seed=6):
    r = random.Random(seed)
    good = [" ".join(r.choice(["the", "of", "river", "house", "walked", "slowly", "and", "morning"]) for _ in range(60)) + "." for _ in range(n)]
    bad = [" ".join(r.choice(["BUY", "NOW", "FREE", "CLICK", "$$$", "WIN"]) + "!!" for _ in range(60)) for _ in range(n)]
    return [(i, t, q) for i, (t, q) in enumerate([*((g, 1) for g in good), *((b, 0) for b in bad)])]


def test_quality(spark):
    rows = labelled()
    table = docs(spark, [(i, t) for i, t, _ in rows] + [(None, None), (None, "")])
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in rows] + [(None, 1, 0), (1, None, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(table, labels)
    got = quality.scored(table, model).collect()
    truth = {i: q for i, _, q in rows}
    held = [r for r in got if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(got) == len(rows) + 2 and all(0 <= r.score <= 1 for r in got)
    assert np.mean([(r.score >= 0.7) == (truth[r.doc_id] == 1) for r in held]) > 0.97
    none = quality.fit(table, labels.limit(0))
    assert {r.score for r in quality.scored(table, none).collect()} == {1.0}
    assert quality.keep_good(table.withColumnRenamed("lang", "score_"), labels).columns == ["doc_id", "text", "score_", "source", "n_chars"]


def test_ranks_file_is_whole():
    with open(MULTI, "rb") as src:
        assert len(bpe.codec(MULTI).ranks) == sum(1 for x in src if base64.b64decode(x.split()[0]))


def test_every_long_passage_falls_into_units(spark):
    """Passages laid out in short lines, and texts of scripts without blanks."""
    verse = "".join(f"short line number {k}\n" for k in range(14))
    han = "".join(chr(0x4E00 + 37 * k % 2000) for k in range(60))
    values = [(1, f"first\n{verse}one"), (2, f"second one\nand more\n{verse}two"), (3, f"{han}。"), (4, f"前{han[:9]}。{han}。"), (5, "la la la\n" * 9)]
    by = {r.doc_id: r.text for r in substring.clean(docs(spark, values), every=True).collect()}
    assert by[1] == values[0][1] and by[3] == values[2][1]
    assert by[2] == "second one\nand more\ntwo"
    assert by[4] == f"前{han[:9]}。"
    assert by[5] == "la la la\n" * 3  # of runs of three lines, the first stays
    assert {r.doc_id: r.text for r in substring.clean(docs(spark, values)).collect()} == dict(values)
