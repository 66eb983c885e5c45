import random

from pyspark.sql import functions as F

from fathomleaf import registry as R
from fathomleaf.config import EngineConfig
from fathomleaf.functions import normalize as N
from fathomleaf.operators import consolidate as C
from fathomleaf.operators import deep as D
from fathomleaf.operators import extract as E
from fathomleaf.operators import quality as Q
from fathomleaf.operators import retrieval as S
from fathomleaf.operators import structure as T


def test_registry():
    assert len(R.FIELDS) == 72 and len(R.ALL_FIELDS) == 76 and set(R.FIELDS) == set(R.ALL_FIELDS) - set(R.METADATA) and len(R.GROUPS) == 13


def test_window_starts(spark):
    for n, size, overlap, want in [(0, 10, 2, None), (5, 10, 2, [0]), (10, 10, 2, [0]), (11, 10, 2, [0, 8]), (26, 10, 2, [0, 8, 16])]:
        assert spark.range(1).select(C.window_starts(F.lit(n), size, overlap)).first()[0] == want
    assert len(spark.range(1).select(C.window_starts(F.lit(136_472), 2000, 400)).first()[0]) == 86


def slow_pack(sizes, size, overlap):
    out, chunk, total = [], [], 0
    for k, n in enumerate(sizes):
        if chunk and total + n > size:
            out.append((chunk[0], chunk[-1] + 1, total))
            keep, kept = [], 0
            for j in reversed(chunk):
                if kept + sizes[j] > overlap:
                    break
                keep.insert(0, j)
                kept += sizes[j]
            chunk, total = keep, kept
        chunk.append(k)
        total += n
    return [*out, (chunk[0], chunk[-1] + 1, total)] if chunk else out


def test_pack_like_a_list():
    r = random.Random(1)
    for _ in range(500):
        sizes = [r.randrange(0, 30) for _ in range(r.randrange(0, 25))]
        assert T.pack(sizes, 40, 12) == slow_pack(sizes, 40, 12)


def test_tables_at_the_end_are_left_out(spark):
    df = spark.createDataFrame([(1, "H\na|b\nc|d\ne|f\nend"), (2, "a|b\nc|d\ne|f"), (3, "a|b\nc|d\nend"), (4, None)], "k int, text string")
    rows = T.tables(df, ["k"]).collect()
    assert [(r.k, r.start, r.stop, r.content) for r in rows] == [(1, 1, 4, "a|b\nc|d\ne|f")]


def test_windows_by_file_is_the_concatenation(spark):
    r = random.Random(2)
    rows = [
        ("c", i * 5000, f"f{i}", "".join(r.choice("ab \n") for _ in range(r.randrange(1, 90))) + "x") for i in range(30)
    ] + [("d", 1, "g", "   "), ("e", 1, "h", None)]
    files = spark.createDataFrame(rows, "company string, ord long, file string, text string")
    config = EngineConfig(chunk_size=50, chunk_overlap=10)
    full = {x.company: x.full_text for x in C.company_docs(files).collect()}
    assert set(full) == {"c"}
    want = {x.id: (x.text, x.char_start, x.char_end) for x in C.char_windows(C.company_docs(files), config).collect()}
    got = {x.id: (x.text, x.char_start, x.char_end) for x in C.windows_by_file(files, config).collect()}
    assert got == want
    refs = C.source_offsets(files).collect()
    assert all(full["c"][x.start_char : x.end_char] == {a[2]: a[3] for a in rows}[x.file] for x in refs)


def test_merge_passes(spark):
    cases = [
        ([("A", "MEDIUM", "x"), ("B", "HIGH", "y")], ("B", "HIGH", "y")),
        ([("A", "HIGH", "x"), ("B", "HIGH", "xyz")], ("B", "HIGH", "xyz")),
        ([("A", "HIGH", "xyz"), ("B", "HIGH", "abc")], ("A", "HIGH", "xyz")),
        ([("A", "LOW", "")], ("NOT_FOUND", "LOW", "")),
        ([("A", "LOW", "x")], ("A", "LOW", "x")),
        ([("EXTRACTION_ERROR", "LOW", "")], ("NOT_FOUND", "LOW", "")),
        ([("POSSIBLY_PRESENT", "HIGH", "z"), ("NOT_FOUND", "LOW", "")], ("POSSIBLY_PRESENT", "LOW", "")),
        ([("A", "odd", "long evidence")], ("NOT_FOUND", "LOW", "")),
    ]
    rows = [("c", i, "g", "f", p, *v) for i, (ps, _) in enumerate(cases) for p, v in enumerate(ps)]
    df = spark.createDataFrame(
        rows, "company string, facility_idx int, `group` string, field string, pass_idx int, value string, confidence string, evidence string"
    )
    got = {r.facility_idx: (r.value, r.confidence, r.evidence) for r in E.merge_passes(df).collect()}
    assert got == {i: w for i, (_, w) in enumerate(cases)}


def test_minmax_and_hybrid_rank(spark):
    df = spark.createDataFrame(
        [("c", "q", 1, 1.0), ("c", "q", 2, 3.0), ("c", "q", 3, 2.0), ("c", "p", 1, 2.0), ("c", "p", 2, 2.0)],
        "company string, query string, id int, score double",
    )
    got = {(r["query"], r["id"]): r["norm"] for r in S.minmax(df).collect()}
    assert got == {("q", 1): 0.0, ("q", 2): 1.0, ("q", 3): 0.5, ("p", 1): 1.0, ("p", 2): 1.0}


def test_queries_of_all_languages_and_of_one_field(spark):
    rows = S.facility_queries(spark, {"xx": ["one two"]}).select("language", "query").distinct().groupBy("language").count().collect()
    assert {r[0]: r[1] for r in rows} == {"en": 5, "es": 8, "fr": 5, "de": 5, "nl": 5, "pt": 5, "it": 5, "pl": 5, "xx": 1}
    assert S.field_query("Spread [%]") == "Spread [%] Margin over base rate" and len(S.SYNONYMS) == 65


def test_expand_synonyms():
    look = S.lookup_table({"a": ["b c d"], "b": ["x"]})
    assert S.expand(["a", "a"], look, 2) == ["a", "a", "b", "c", "d"]


def test_patterns_and_rules(spark):
    assert D.candidates_of("the applicable margin is 2.5% then 75 bps", D.STRATEGIES["Spread [%]"]) == ["2.5", "75"]
    df = spark.createDataFrame(
        [("c", 0, "g", "Is a Sponsor linked to the project?", "No", "e", "HIGH"), ("c", 0, "g", "Sponsor Name", "Acme", "e", "HIGH")],
        "company string, facility_idx int, `group` string, field string, value string, evidence string, confidence string",
    )
    checked = D.cross_reference(df)
    assert checked.first().fixes == ["Is a Sponsor linked to the project?"]
    assert {(r.field, r.value, r.confidence) for r in D.auto_fix(df, checked).collect()} == {
        ("Is a Sponsor linked to the project?", "Yes", "MEDIUM"), ("Sponsor Name", "Acme", "HIGH")
    }


def test_company_column_and_resolve():
    assert Q.company_column(["x", "My Client"]) == "My Client" and Q.company_column(["x"]) is None
    assert Q.resolve_columns([" borrower name ", "Q"], {"Q": "Spread [%]"}) == {" borrower name ": "Borrower name", "Q": "Spread [%]"}
    assert Q.diagnose(["Borrower name", "zz"])["extra"] == ["zz"]


def test_empty_inputs(spark):
    files = spark.createDataFrame([], "company string, ord long, file string, text string")
    assert C.windows_by_file(files).count() == 0 and C.source_offsets(files).count() == 0 and C.company_docs(files).count() == 0
    chunks = spark.createDataFrame([], "company string, id long, text string")
    assert S.bm25_search(chunks, S.make_queries(spark, {"q": "a"})).count() == 0


def test_sources_of_windows_in_one_large_company(spark):
    """One company holds nearly all files; ranges of every kind, empty and touching ones too."""
    r = random.Random(8)
    refs, at = [], 0
    for i in range(400):
        n = r.choice([0, 1, 50, 3000, 30_000])
        refs.append(("hot", f"f{i}", at, at + n))
        at += n + r.choice([0, 5])
    refs.append(("cold", "x", 3, 9))
    windows = [("hot", i, i * 6400, i * 6400 + 8000) for i in range(at // 6400 + 1)] + [("cold", 0, 0, 4), ("cold", 1, 9, 12)]
    got = C.chunk_sources(
        spark.createDataFrame(windows, "company string, id int, char_start long, char_end long"),
        spark.createDataFrame(refs, "company string, file string, start_char long, end_char long"),
    )
    want = {(c, i, f) for c, i, a, b in windows for d, f, x, y in refs if c == d and x < b and y > a}
    rows = [tuple(x) for x in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want


def test_token_windows_of_a_long_text(spark):
    words = [f"w{i}" for i in range(60_000)]
    text = "  " + " \n ".join(words) + " "
    docs = spark.createDataFrame([("a", text), ("b", None), ("c", " \t"), ("d", "one")], "company string, full_text string")
    rows = C.token_windows(docs, EngineConfig(chunk_size=200, chunk_overlap=40)).orderBy("company", "id").collect()
    assert [r.id for r in rows if r.company == "a"] == list(range(375)) and {r.company for r in rows} == {"a", "d"}
    for x in rows[:375]:
        assert text[x.char_start : x.char_end] == x.text and x.text.split() == words[x.token_start : x.token_end]
    assert [x.is_last for x in rows] == [False] * 374 + [True, True]


def test_companies_meet_by_a_key(spark):
    r = random.Random(9)
    names = ["", "a", "AB", "Acme", "acme bank", *("".join(r.choice("abC ") for _ in range(r.randrange(1, 9))) for _ in range(150)), None]
    g, e = (spark.createDataFrame([(n,) for n in r.sample(names, 90)] + [("Acme",)], "company string") for _ in range(2))
    found = Q.match_companies(g, e)
    want = {(x, y) for (x,) in g.distinct().collect() for (y,) in e.distinct().collect() if x is not None and y is not None and x.lower() in y.lower()}
    rows = [tuple(x) for x in found.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()


def test_budget_as_one_by_one(spark):
    r = random.Random(10)
    rows = [("hot", " ".join("x" * r.randrange(0, 40)) + f" {i}", float(r.randrange(5))) for i in range(600)] + [("cold", "a b", 1.0), ("none", "", 1.0)]
    got = {
        (x.company, x.place): (x.text, x.tokens) for x in S.pack_budget(
            spark.createDataFrame(rows, "company string, text string, score double"), 300
        ).collect()
    }
    want, used = {}, {}
    places = {}
    for c, t, _ in sorted(rows, key=lambda x: (-x[2], x[1])):
        places[c] = places.get(c, 0) + 1
        n = len(t.split())
        if used.get(c, 0) < 300:
            left = 300 - used.get(c, 0)
            want[c, places[c]] = (t if n <= left else " ".join(t.split()[:left]), min(n, left))
        used[c] = used.get(c, 0) + n
    assert got == want


def test_dense_search_as_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK_QUERIES", 5)
    r = random.Random(11)
    vectors = [(f"c{i % 3}", i, [r.gauss(0, 1) for _ in range(4)]) for i in range(60)] + [
        ("c0", 70, None), ("c0", 71, [1.0]), ("c0", 72, [1.0, None, 0.0, 0.0]), ("c1", 73, [0.0] * 4)
    ]
    queries = [(i, vectors[i][2]) for i in range(0, 60, 5)] + [(99, None)]
    got = S.dense_search(
        spark.createDataFrame(vectors, "company string, id long, vector array<double>"),
        spark.createDataFrame(queries, "query long, vector array<double>"),
        4,
    ).collect()
    unit = lambda v: [x / sum(y * y for y in v) ** 0.5 for x in v]
    want = {}
    for q, v in queries[:-1]:
        for c in ("c0", "c1", "c2"):
            best = sorted((-round(sum(a * b for a, b in zip(unit(v), unit(w), strict=True)), 9), i) for d, i, w in vectors[:60] if d == c)[:4]
            want |= {(c, q, n + 1): (i, -s) for n, (s, i) in enumerate(best) if s < 0}
    assert {(x.company, x["query"], x["rank"]): (x.id, round(x.score, 9)) for x in got} == want


def test_bm25_of_each_companys_own_queries(spark):
    chunks = spark.createDataFrame([("a", 1, "x y"), ("a", 2, "y z"), ("b", 1, "x y"), ("c", 1, "x")], "company string, id long, text string")
    own = spark.createDataFrame([("a", 1, "z", 1), ("b", 7, "x", 1), ("b", 7, "q", 1)], "company string, query int, term string, qtf int")
    assert sorted((r.company, r["query"], r.id) for r in S.bm25_scores(chunks, own).collect()) == [("a", 1, 2), ("b", 7, 1)]


def test_reports(spark):
    found = spark.createDataFrame(
        [("c", 0, True, "f", "1", "1", "exact_match"), ("c", 0, True, "g", "1", "2", "mismatch")],
        "company string, facility_index int, matched boolean, field string, golden string, extracted string, result string",
    )
    parts = Q.comparison_report(found)
    assert parts["summary"].first().accuracy == 0.5 and parts["per_company"].count() == 1 and parts["mismatches_detail"].first().field == "g"
    one = Q.coverage_report(spark.createDataFrame([("1", ""), ("2", "")], "a string, b string"), ["a", "b"]).first()
    assert (
        one.total_rows, one.total_fields, one.average_coverage, one.field_coverage, one.low_coverage_fields, one.high_coverage_fields
    ) == (2, 2, "50.0%", '{"a":"100.0%","b":"0.0%"}', ["b"], ["a"])


def test_normalised_amounts_and_filters(spark):
    rows = spark.createDataFrame([("Acme",), ("Zeta",)], "company string")
    assert [r[0] for r in Q.filter_company(rows, "^ac").collect()] == ["Acme"] and [r[0] for r in C.companies(rows, "Zeta").collect()] == ["Zeta"]
    assert Q.common_fields(spark.createDataFrame([], "a int, b int, Comments int"), spark.createDataFrame([], "b int, Comments int")) == ["b"]
    assert spark.range(1).select(N.normalize_amount(F.lit(" EUR  1 "))).first()[0] is not None


def test_company_digests_in_rounds(spark):
    """A company's digest goes on from round to round, so that no value and no task holds its whole text."""
    import hashlib

    from fathomleaf.operators import consolidate as C

    rows = [(c, i * 100, f"f{i}", t * (i + 1)) for c, n in (("big", 12), ("small", 1), (None, 3)) for i in range(n) for t in ["é b "]]
    files = spark.createDataFrame([*rows, ("big", 50, "blank", "  "), ("none", 1, "blank", "")], "company string, ord long, file string, text string")
    want = {r["company"]: r for r in C.company_docs(files).collect()}
    for segment in (C.SEGMENT, 700):
        got = {r["company"]: r for r in C.company_digests(files, segment).collect()}
        assert set(got) == set(want) == {"big", "small", None}
        for c, r in want.items():
            text = hashlib.md5(r["full_text"].encode()).hexdigest()
            assert tuple(got[c])[1:] == (text, len(r["source_files"]), r["total_chars"], r["total_tokens"])


def test_table_line_of_a_long_text_is_tried(spark):
    """A value in a table reaches the row though no window with it is retrieved and twenty fields before it are missing too."""
    from fathomleaf.plans import document

    busy = "interest rate spread margin basis points bps floor cap pricing base tenor fix credit premium loan. " * 70
    text = f"{busy}\n" * 8 + "filler words " * 900 + "\nGENERAL TERMS AND CONDITIONS\na | b\nSpread [%] | 1.25%\nc | d\nclosing line\n" + "plain words " * 300
    files = spark.createDataFrame([("c", 0, "a.txt", text)], "company string, ord int, file string, text string")
    assert [r["Spread [%]"] for r in document.run(spark, files).rows.collect()] == ["1.25%"]


def test_dense_tiles_give_the_whole_ranking(spark, monkeypatch):
    """Tiles smaller than a company, ties, vectors of another length and odd ones: the same as every pair by hand."""
    import numpy as np

    rng = np.random.default_rng(3)
    rows = [(f"c{i % 3}", i, [float(x) for x in rng.integers(-2, 3, 4)]) for i in range(60)]
    rows += [("c0", 100, [1.0, 2.0]), ("c1", 101, None), ("c1", 102, [1.0, None, 0.0, 0.0]), (None, 103, [1.0, 0.0, 1.0, 0.0])]
    vectors = spark.createDataFrame(rows, "company string, id long, vector array<double>")
    queries = vectors.filter("id % 7 = 0 or id > 99").selectExpr("id as query", "vector")
    monkeypatch.setattr(S, "TILE_ROWS", 7)
    monkeypatch.setattr(S, "TILE_QUERIES", 2)
    unit = {i: (c, np.array(v) / (np.linalg.norm(v) or 1)) for c, i, v in rows if v and None not in v}
    want = []
    for q in (i for i in unit if i % 7 == 0 or i > 99):
        for c in {c for c, _ in unit.values()}:
            found = sorted((-round(float(v @ unit[q][1]), 9), i) for i, (d, v) in unit.items() if d == c and len(v) == len(unit[q][1]))[:20]
            want += [(str(c), q, i, n + 1) for n, (s, i) in enumerate(found) if s < 0]
    for k in (20, 3):
        got = [(str(r["company"]), r["query"], r["id"], r["rank"]) for r in S.dense_search(vectors, queries, k).filter("score > 1e-9").collect()]
        assert sorted(got) == sorted(w for w in want if w[3] <= k)
    assert max(t[3] for t in want) > 3


def test_only_what_is_asked_goes_to_python(spark):
    """Rows of model calls and sentences go to Python a hundred at a time, not whole frames of them."""
    docs = spark.createDataFrame([(i, f"One {i}. Two. " * 3) for i in range(5)], "doc_id long, text string")
    prompts = docs.selectExpr("doc_id", "'s' as system", "text as prompt", "1 as max_tokens", "text as more")
    for df in (E.call_model(prompts), T.sentence_chunks(docs, ["doc_id"], 5, 2)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" in plan and "MapIn" not in plan
    assert E.call_model(prompts).columns == [*prompts.columns, "response", "error", "tries", "seconds"]


def test_languages_words_are_split_once(spark):
    from fathomleaf.functions import text as X

    rows = spark.createDataFrame([("The cat of AND",), ("der die\tdas nicht",), ("",), (None,), ("le le the the",)], "text string")
    df = rows.select(X.language("text").alias("code"))
    assert [r[0] for r in df.collect()] == ["en", "de", "en", "en", "en"]
    assert df._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1


def test_csv_of_many_rows_goes_to_many_files(spark, tmp_path):
    """A file of rows with line feeds cannot be split, so that none may grow with the rows."""
    from fathomleaf.sources import readers, sinks

    rows = spark.range(2 * sinks.CSV_ROWS + 1).coalesce(1).selectExpr("concat('a\n', id) as Comments")
    sinks.write_csv(rows, str(tmp_path / "out"))
    assert len(list((tmp_path / "out").glob("*.csv"))) == 3
    back = readers.read_csv(spark, str(tmp_path / "out"))
    assert back.count() == back.distinct().count() == 2 * sinks.CSV_ROWS + 1 and back.filter("Comments = 'a\n7'").count() == 1


def test_queries_of_model_calls_send_no_frames(spark, data):
    from fathomleaf.plans import catalog

    for name in ("field_group_extraction", "verification_pass", "retried_extraction", "facility_detection"):
        plan = catalog.QUERIES[name](spark, data)._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" in plan and "MapInPandas" not in plan, name


def test_patterns_send_no_frames(spark, data):
    """Texts go to the patterns a hundred at a time too, and only those of fields that have patterns."""
    from fathomleaf.plans import catalog

    for name in ("deep_single_field", "pattern_candidates"):
        plan = catalog.QUERIES[name](spark, data)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("BatchEvalPython") == (2 if name == "deep_single_field" else 1) and "MapInPandas" not in plan, name
    text = "the applicable margin is 2.5% then 75 bps"
    rows = spark.createDataFrame([("a", "Spread [%]", text), ("b", "Tenor", text), ("c", "Spread [%]", None), ("d", None, text)], "company string, field string, text string")
    got = {r["company"]: r["candidates"] for r in D.field_candidates(rows).collect()}
    assert got == {"a": ["2.5", "75"], "b": [], "c": [], "d": []}
    got = D.pattern_candidates(rows.drop("field"), "company", "text").collect()
    assert sorted(map(tuple, got)) == [(c, "Spread [%]", ["2.5", "75"]) for c in "abd"]
