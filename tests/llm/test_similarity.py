"""SimHash, components, top-k, and the language model, against brute force."""

import itertools
import math
import pickle
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from fathomleaf.llm import components, lm, quality, simhash, substring, topk
from fathomleaf.llm._shared import staged, table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, values):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in values], SCHEMA)


def roots(links):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in parent}


def test_components(spark):
    r = random.Random(1)
    links = [(i, i + 1) for i in range(100, 140)] + [
        (r.randrange(60), r.randrange(60)) for _ in range(30)
    ] + [(200, k) for k in range(201, 260)] + [(-5, 7), (7, 7)]
    df = spark.createDataFrame([*links, (None, 3)], "a long, b long")
    got = {x.node: x.root for x in components.components(df).collect()}
    want = roots([(a, b) for a, b in links if a != b])
    assert got == want
    assert components.components(df.limit(0)).count() == 0


def slow_fingerprint(text):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def test_simhash_as_brute_force(spark):
    r = random.Random(2)
    words = ["w%d" % i for i in range(40)]
    values = [(i, " ".join(r.choice(words) for _ in range(r.randrange(0, 40)))) for i in range(60)]
    values += [(100 + i, values[i][1]) for i in range(10)] + [
        (None, values[3][1]), (200, None), (201, ""), (202, " \n"), (202, " \n"), (203, "One Two"), (204, "one two")
    ]
    got = simhash.near_duplicates(docs(spark, values)).collect()
    fps = [slow_fingerprint(t or "") for _, t in values]
    assert sorted(x.fingerprint for x in got) == sorted(f"{f:016x}" for f in fps)
    own = sorted(set(fps))
    comp = roots([(a, b) for a in own for b in own if a <= b and (a ^ b).bit_count() <= 2])
    least = {}
    for (i, _), f in zip(values, fps, strict=True):
        if i is not None:
            least[comp[f]] = min(least.get(comp[f], i), i)
    want = {f"{f:016x}": least.get(comp[f]) for f in fps}
    assert {x.fingerprint: x.component_id for x in got} == want
    assert simhash.near_duplicates(docs(spark, values).limit(0)).count() == 0


def test_links_in_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET", 3)
    r = random.Random(3)
    own = {0}
    while len(own) < 80:  # a cloud of fingerprints a few bits apart, and some far ones
        own.add(r.choice(sorted(own)) ^ (1 << r.randrange(12)) ^ (1 << r.randrange(12)))
    own |= {r.getrandbits(63) for _ in range(40)}
    df = spark.createDataFrame([(x,) for x in own], "fp_ long")
    got = [(x.a, x.b) for x in simhash.links(df).collect()]
    assert all((a ^ b).bit_count() <= 2 for a, b in got)
    want = roots([(a, b) for a in own for b in own if a < b and (a ^ b).bit_count() <= 2])
    assert roots(got) == want


def test_keep_one_finds_near_copies(spark):
    r = random.Random(4)
    words = ["w%d" % i for i in range(3000)]
    base = [[r.choice(words) for _ in range(120)] for _ in range(60)]
    values = [(i, " ".join(b)) for i, b in enumerate(base)]
    for i in range(20):  # one word changed: similarity above 0.9
        b = list(base[i])
        b[r.randrange(10, 110)] = "changed"
        values.append((1000 + i, " ".join(b)))
    values += [(2000 + i, " ".join(base[0])) for i in range(15)] + [
        (0, " ".join(base[0])), (None, " ".join(base[1])), (None, "alone it stands here"), (3000, None), (3001, "")
    ]
    kept = simhash.keep_one(docs(spark, values).withColumn("row_", F.lit(1))).collect()
    assert sorted(x.doc_id if x.doc_id is not None else -1 for x in kept) == [-1, *range(60), 3000]
    assert kept[0].__fields__ == ["doc_id", "text", "lang", "source", "n_chars", "row_"]
    assert simhash.keep_one(docs(spark, values).limit(0)).count() == 0


def jaccard_pairs(texts, words=5, least=0.8):
    """(pairs of different shingle sets at least so alike, sets by text) by counting shared shingles, every one of them."""
    sets, posts, shared = {}, {}, Counter()
    for t in texts:
        own = t.encode().lower().split()
        sets.setdefault(frozenset(b" ".join(own[k : k + words]) for k in range(max(1, len(own) - words + 1))) if own else frozenset(), len(sets))
    for own, k in sets.items():
        for x in own:
            posts.setdefault(x, []).append(k)
    for at in posts.values():
        shared.update(itertools.combinations(at, 2))
    size = {k: len(own) for own, k in sets.items()}
    return [p for p, n in shared.items() if n >= least * (size[p[0]] + size[p[1]] - n) - 1e-9], sets


def recall(spark, rows):
    """The share of pairs at least 0.8 alike that ``groups`` has in one group; those it joins without a chain of such pairs."""
    pairs, sets = jaccard_pairs([t or "" for _, t in rows])
    got = {r.doc_id: r.group for r in simhash.groups(docs(spark, rows)).collect()}
    assert len(got) == len(rows)
    key = lambda t: [*(own := (t or "").encode().lower().split()), 0] and (frozenset(b" ".join(own[k : k + 5]) for k in range(max(1, len(own) - 4))) if own else frozenset())
    of = {}
    for i, t in rows:
        of.setdefault(sets[key(t)], set()).add(got[i])
    assert all(len(g) == 1 for g in of.values())  # equal sets are one group
    group = {k: g.pop() for k, g in of.items()}
    root = {k: k for k in group}

    def find(k):
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for a, b in pairs:
        root[find(a)] = find(b)
    wrong = {(group[k], find(k)) for k in group}
    assert len({g for g, _ in wrong}) >= len({r for _, r in wrong}) and all(len({find(k) for k in group if group[k] == g}) == 1 for g in set(group.values()))
    return sum(group[a] == group[b] for a, b in pairs) / max(1, len(pairs)), len(pairs)


def test_recall_of_near_copies_on_whole_documents(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, "/root/testdata/sf0.01", "documents").collect()]
    share, n = recall(spark, rows)
    assert n and share >= 0.95, (share, n)  # few there are: most copies are exact or far


def test_recall_in_a_family_around_the_threshold(spark):
    """Three hundred texts on one template, pairwise 0.6 to 0.95 alike, among others: every block of theirs is crowded."""
    r = random.Random(12)
    words = ["v%d" % i for i in range(4000)]
    template = [r.choice(words) for _ in range(150)]
    rows = []
    for i in range(300):
        own = list(template)
        for _ in range(r.randrange(0, 5)):
            own[r.randrange(len(own))] = f"own{i}x{r.random()}"
        rows.append((i, " ".join(own)))
    rows += [(1000 + i, " ".join(r.choice(words) for _ in range(150))) for i in range(100)]
    share, n = recall(spark, rows)
    assert n > 1000 and share >= 0.95, (share, n)


def test_dense_group_is_one(spark):
    r = random.Random(5)
    base = ["w%d" % r.randrange(3000) for _ in range(150)]
    values = []
    for i in range(120):
        b = list(base)
        b[r.randrange(150)] = f"x{i}"
        values.append((i, " ".join(b)))
    assert [x.doc_id for x in simhash.keep_one(docs(spark, values)).collect()] == [0]


def shingles(text, words=5):
    own = text.lower().split()
    return {tuple(own[i : i + words]) for i in range(max(1, len(own) - words + 1))}


def jaccard(x, y):
    return len(x & y) / len(x | y)


def test_template_family_as_brute_force(spark):
    """Many unlike rows on one template crowd the blocks; the alike ones among them still meet."""
    r = random.Random(11)

    def changed(own, n):
        own = list(own)
        for k in r.sample(range(0, len(own), 5), n):
            own[k] = "x%d" % r.randrange(1 << 40)
        return own

    template = ["w%d" % r.randrange(3000) for _ in range(400)]
    family = [changed(template, 9) for _ in range(1200)]
    values = [(i, " ".join(f)) for i, f in enumerate(family)] + [(10_000 + i, " ".join(changed(family[i], 6))) for i in range(100)]
    sets = {i: shingles(t) for i, t in values}
    want = {i for i in sets if i >= 10_000 and jaccard(sets[i], sets[i - 10_000]) >= 0.8}
    assert len(want) > 90 and all(jaccard(sets[i], sets[j]) < 0.74 for i in range(0, 1200, 40) for j in range(i))
    # Unlike sets: of short texts whose fingerprints may coincide, of one passage told again and again, and just below 0.8.
    passage, own = " ".join("p%d" % k for k in range(60)), ["s%d" % k for k in range(190)]
    other = [(20_000 + i, " ".join([passage] * 10 + [f"q{i}w{k}" for k in range(100)])) for i in range(2)]
    other += [(30_000, " ".join(own)), (30_001, " ".join(changed(own, 5)))]
    other += [(40_000 + i, f"a{i} b") for i in range(300)]
    assert 0.76 < jaccard(shingles(other[2][1]), shingles(other[3][1])) < 0.8
    kept = {x.doc_id for x in simhash.keep_one(docs(spark, values + other)).collect()}
    assert len(want - kept) >= 0.95 * len(want)
    assert kept >= {*range(1200), *(i for i, _ in other)}


def test_cells_find_every_close_pair(spark, monkeypatch):
    """Tiles of a crowded block meet across tasks: as all pairs, whatever the tile."""
    monkeypatch.setattr(simhash, "CROWD", 2)
    monkeypatch.setattr(simhash, "TILE", 7)
    r = np.random.default_rng(12)
    w = simhash.Wide(simhash.Wide.width_for(2))
    own = np.repeat(r.integers(0, 2, (1, w.bits)), 60, axis=0)
    for x in own:  # the blocks agree, the rest differs
        x[w.blocks * w.width :] ^= r.random(w.bits - w.blocks * w.width) < r.choice([0.05, 0.12, 0.2])
    rows = [(k, np.packbits(x).tobytes(), k // 3, 50) for k, x in enumerate(own)]
    got = simhash._wide_links(spark.createDataFrame(rows, "node long, fp_ binary, root long, size_ int"), w, (0, 2)).collect()
    want = {(a, b) for a in range(60) for b in range(a) if a // 3 != b // 3 and (own[a] != own[b]).sum() <= w.distance}
    assert 0 < len(want) < 60 * 59 // 2
    assert sorted((x.b, x.a) for x in got) == sorted(want)


def slow_top(rows, k=20):
    own = []
    for n, (i, v) in enumerate(rows):
        if v and all(x is not None and math.isfinite(x) for x in v):
            own.append((n, i, [math.floor(64 * x) for x in v]))
    out = []
    for n, i, v in own:
        if i is not None and i % 20 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j is None, j or 0) for m, j, w in own if m != n and len(w) == len(v))[:k]
            out += [(i, rank + 1, None if none else j, -s) for rank, (s, none, j) in enumerate(best)]
    return Counter(out)


def test_top_k_is_exact(spark):
    r = random.Random(6)
    rows = [(i, [r.gauss(0, 0.3) for _ in range(7)]) for i in range(300)]
    rows += [(400 + i, rows[20][1]) for i in range(40)] + [
        (20, rows[20][1]),
        (None, rows[3][1]),
        (500, None),
        (501, [1.0, None]),
        (520, [float("nan")] * 7),
        (540, []),
        (560, [0.0] * 7),
        (580, [1.0, 2.0]),
        (581, [2.0, 1.0]),
        (600, [1e9] * 7),
    ]
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<double>, label int, score string")
    got = Counter((x.query_id, x["rank"], x.vec_id, x.score) for x in topk.search(topk.build(df)).collect())
    assert got == slow_top(rows)
    assert topk.search(topk.build(df.limit(0))).count() == 0


def test_language_model(spark):
    r = random.Random(7)
    values = [(i, " ".join(r.choice(["the cat", "the dog", "a bird"]) + r.choice([" sat", " ran", " Flew"]) for _ in range(30))) for i in range(60)]
    values += [(100, None), (101, ""), (102, "unknown words only xyz"), (103, values[0][1]), (103, values[0][1]), (None, "the cat sat"), (104, "x" * 50_000)]
    got = lm.score(docs(spark, values).withColumn("score", F.lit("clash"))).collect()
    assert len(got) == len(values)
    counts, total = Counter(), 0
    for i, t in values:
        if i is None or zlib.crc32(str(i).encode()) % 5 != 1:
            counts.update(lm.words_of(t or ""))
    total, known = sum(counts.values()), len(counts)
    want = Counter()
    for i, t in values:
        w = lm.words_of(t or "")
        want[
            i,
            i is not None and zlib.crc32(str(i).encode()) % 5 == 1,
            len(w),
            sum(counts[x] > 0 for x in w),
            total,
            round(sum(math.log10((counts[x] + 0.5) / (total + 0.5 * (known + 1))) for x in w), 6),
        ] += 1
    assert Counter((x.doc_id, x.held_out, x.n_tokens, x.n_known, x.train_tokens, round(x.base_score, 6)) for x in got) == want
    held = [x for x in got if x.held_out and x.doc_id < 60]
    assert sum(x.score for x in held) > sum(x.base_score for x in held)
    assert lm.score(docs(spark, values).limit(0)).count() == 0


def sampled(pairs, sweeps, burn_in=50):
    """The sampler of ``lm`` in memory over {(word, context): count}: (share, what it fitted)."""
    order = sorted(pairs)
    words = 1 + max(w for w, _ in order)
    share = lm.Share.fresh(np.array([w * lm.CONTEXTS + x for w, x in order]), np.array([pairs[k] for k in order]), lm.mix(np.arange(words, dtype=np.uint64)))
    by_context = lambda x: lm.Vector(np.bincount(share.leaf, weights=x, minlength=lm.CONTEXTS).astype(np.int64))
    tables = by_context(share.t)
    assert (lm.unpack(share.sums(share.t))[0] == tables.values).all() and (pickle.loads(pickle.dumps(tables)).values == tables.values).all()
    root = lm.start(int((share.n > 0).sum()), int(tables.values.sum()))
    fitted = lm.Fitted(by_context(share.c))
    for sweep in range(1, sweeps + 1):
        share.seat_leaves(tables, root, sweep)
        tables = by_context(share.t)
        root = lm.Root(root.known, int(tables.values.sum()), root.mass, root.scale)
        root.rescale(sweep)
        mass, t = share.seat_root(root, sweep, sweep > burn_in)
        root.close(mass / lm.FIXED, t, sweep)
        if sweep > burn_in:
            fitted.roots.append(root)
            fitted.tables.append(tables)
    return share, fitted


def log_ways(c, t):
    """Of all seatings of c customers at t tables at a discount of one half: the logarithm of their summed weights."""
    return math.lgamma(2 * c - t) - math.lgamma(t) - math.lgamma(c - t + 1) + (2 * t - 2 * c) * math.log(2)


def exact(pairs):
    """Predictive probabilities by going through every number of tables of every dish; also those of the unknown word."""
    rows, leaves = sorted(pairs), sorted({x for _, x in pairs})
    known = len({w for (w, _), c in pairs.items() if c})
    base, rise = 1 / (known + 1), lambda a, d, n: sum(math.log(a + d * i) for i in range(n))
    total, mean = 0.0, Counter()
    live = [k for k in rows if pairs[k]]
    for ts in itertools.product(*(range(1, pairs[k] + 1) for k in live)):
        t = dict(zip(live, ts, strict=True))
        by_leaf, by_word = Counter(), Counter()
        for (w, x), n in t.items():
            by_leaf[x] += n
            by_word[w] += n
        log = sum(rise(lm.STRENGTH, 0.5, by_leaf[x]) for x in leaves) + sum(log_ways(pairs[k], t[k]) for k in live)
        for ms in itertools.product(*(range(1, c + 1) for c in by_word.values())):
            m = dict(zip(by_word, ms, strict=True))
            n, tables = sum(by_word.values()), sum(ms)
            weight = math.exp(
                log + rise(lm.ROOT_STRENGTH, 0.5, tables) - rise(lm.ROOT_STRENGTH, 1, n) + sum(
                    log_ways(by_word[w], m[w]) for w in m
                ) + tables * math.log(base)
            )
            total += weight
            p = lambda w: ((by_word[w] - 0.5 * m.get(w, 0)) + (lm.ROOT_STRENGTH + 0.5 * tables) * base) / (lm.ROOT_STRENGTH + n)  # noqa: E731, B023
            for w, x in rows:
                customers = sum(c for (_, y), c in pairs.items() if y == x)
                mean[w, x] += weight * (pairs[w, x] - 0.5 * t.get((w, x), 0) + (lm.STRENGTH + 0.5 * by_leaf[x]) * p(w)) / (lm.STRENGTH + customers)
    return {k: v / total for k, v in mean.items()}


@pytest.mark.parametrize("strength,root_strength", [(0.5, 0.7), (5.0, 50.0)])
def test_model_agrees_with_going_through_every_seating(monkeypatch, strength, root_strength):
    monkeypatch.setattr(lm, "CONTEXTS", 64)
    monkeypatch.setattr(lm, "STRENGTH", strength)
    monkeypatch.setattr(lm, "ROOT_STRENGTH", root_strength)
    pairs = {(0, 3): 4, (0, 5): 2, (1, 3): 1, (1, 5): 3, (2, 3): 2, (2, 5): 0, (3, 3): 0, (3, 5): 0}
    share, fitted = sampled(pairs, 20_050)
    want = exact(pairs)
    got = dict(zip(sorted(pairs), share.probabilities(fitted), strict=True))
    assert all(abs(got[k] - want[k]) < 0.004 for k in want), (got, want)
    assert max(abs(got[k] / want[k] - 1) for k in want) < 0.02


def test_tables_of_one_dish_at_any_count():
    r = np.random.default_rng(3)
    for c, x in ((2, 0.3), (7, 2.0), (40, 1e-3), (200, 30.0)):
        n = 100_000
        t = lm.draw_tables(np.full(n, c), np.full(n, x), r.random(n))
        logs = np.array([log_ways(c, k) + k * math.log(x) for k in range(1, c + 1)])
        p = np.exp(logs - logs.max())
        assert abs(np.bincount(t, minlength=c + 1)[1:] / n - p / p.sum()).max() < 0.007
    t = lm.draw_tables(np.array([10**9, 1, 10**12, 3]), np.array([1e6, 5.0, 1e3, 1e-9]), r.random(4))
    assert 1.9e6 < t[0] < 2.1e6 and t[1] == 1 and 1.8e3 < t[2] < 2.2e3 and t[3] == 1


def test_model_probabilities_sum_to_one(monkeypatch):
    monkeypatch.setattr(lm, "CONTEXTS", 64)
    r = np.random.default_rng(8)
    pairs = {(w, x): int(r.integers(0, 200) * r.integers(0, 2)) for w in range(30) for x in (0, 1, 17, 40)}
    pairs |= {(30, x): 0 for x in (0, 1, 17, 40)}  # the unknown word
    share, fitted = sampled(pairs, 8, 3)
    p = share.probabilities(fitted)
    for x in (0, 1, 17, 40):
        own, seen = p[share.leaf == x], share.n[share.word[share.leaf == x]] > 0
        assert abs(own[seen].sum() + own[~seen].max() - 1) < 1e-6
    assert (share.t <= share.c).all() and (share.t[share.c > 0] > 0).all()


def test_model_scores_do_not_depend_on_partitions(spark, data):
    df, got = table(spark, data, "documents"), []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("2", "3", "8"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got.append(sorted(map(tuple, lm.score(df.repartition(int(n))).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got[0] == got[1] == got[2]


def slow_clean(rows):
    """Of equal units all but the first by (id, place) go; texts that lose all they had are left out."""
    first = {}
    for i, text in rows:
        for digest, at, _ in substring.all_units(text):
            first[digest] = min(first.get(digest, (i, at)), (i, at))
    out = {}
    for i, text in rows:
        keep, cut = [True] * len(text), False
        for digest, at, stop in substring.all_units(text):
            if first[digest] != (i, at):
                keep[at:stop], cut = [False] * (stop - at), True
        left = "".join(c for c, k in zip(text, keep, strict=True) if k)
        if left or not cut:
            out[i] = left
    return out


def test_pipeline_as_brute_force(spark):
    """Each stage on all that the one before it kept, against plain loops over the same documents."""
    sf = "/root/testdata/sf0.01"
    docs_, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    texts = {r.doc_id: r.text or "" for r in docs_.collect()}
    model = quality.fit(docs_, labels)
    kept = staged(corpus_pipeline.quality_filter(spark, docs_, sf), "kept")
    good = {i for i, t in texts.items() if model.score(t) >= quality.THRESHOLD}
    assert {r.doc_id for r in kept.collect()} == good and 0.5 < len(good) / len(texts) < 1
    alone = staged(corpus_pipeline.near_duplicates(spark, kept, sf), "alone")
    pairs, sets = jaccard_pairs([texts[i] for i in sorted(good)])
    root = {k: k for k in sets.values()}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in pairs:
        root[find(a)] = find(b)
    least = {}
    for i in sorted(good):
        own = texts[i].encode().lower().split()
        key = frozenset(b" ".join(own[k : k + 5]) for k in range(max(1, len(own) - 4))) if own else frozenset()
        least.setdefault(find(sets[key]), i)
    left = {r.doc_id for r in alone.collect()}
    assert left >= set(least.values()) and len(left) <= 1.01 * len(least) and len(left) < len(good)
    cut = staged(corpus_pipeline.repeated_passages(spark, alone, sf), "cut")
    rows = {r.doc_id: (r.text, r.n_chars) for r in cut.collect()}
    want = slow_clean([(i, texts[i]) for i in sorted(left)])
    assert rows == {i: (t, len(t)) for i, t in want.items()}
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    ids = {i: [*e.ids, 1] for (i, (t, _)), e in zip(rows.items(), tokenizer.encode_batch([t for t, _ in rows.values()], add_special_tokens=False), strict=True)}
    pieces = corpus_pipeline.pack(spark, cut, sf).collect()
    want = {
        (
            i, k, at, len(own[at : at + 4096]), zlib.crc32(np.array(own[at : at + 4096], "<u4").tobytes())
        ) for i, own in ids.items() for k, at in enumerate(range(0, len(own), 4096))
    }
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in pieces} == want and len(pieces) == len(want)
    by = {}
    for r in pieces:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by.values():
        ends = [0, *(a + n for a, n in sorted(own))]
        assert [a for a, _ in sorted(own)] == ends[:-1] and ends[-1] <= 4096
    assert len(by) <= 1.02 * sum(map(len, ids.values())) / 4096 + 1


def test_quality_on_labels_it_has_not_seen(spark):
    sf = "/root/testdata/sf0.01"
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    rows = quality.op10_quality_classifier(spark, sf).filter("held_out").join(labels, "doc_id").collect()
    good, bad = [r.score for r in rows if r.quality == 1], [r.score for r in rows if r.quality == 0]
    assert len(good) > 20 and len(bad) > 5
    auc = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    right = sum(r.predicted == r.quality for r in rows) / len(rows)
    assert auc > 0.9 and right > 0.85, (auc, right)


def test_pipeline(spark, data):
    frame = table(spark, data, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frame, data)
        assert out.columns == frame.columns, name
        assert out.count() <= frame.count()
        frame = out
    rows = corpus_pipeline.run(spark, data)
    left = {r[0] for r in frame.select("doc_id").collect()}
    assert {r[0] for r in rows.select("doc_id").collect()} == left
    assert rows.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 4096").count() == 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "repeated_passages", "packing"]
