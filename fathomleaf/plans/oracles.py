"""DuckDB SQL that gives the catalogue's rows, written for that engine and not from the plans."""

from __future__ import annotations

from fathomleaf import registry as R
from fathomleaf.functions.normalize import MONTHS
from fathomleaf.functions.text import LANGUAGE_NAMES, LANGUAGE_WORDS
from fathomleaf.plans import catalog as K
from fathomleaf.plans import inputs as I

TOK = "list_filter(regexp_extract_all(lower({0}), '[\\p{{L}}\\p{{N}}_]+'), lambda t: regexp_full_match(t, '[a-z0-9]+'))"
WS = "[ \\t\\n\\r\\f\\x0B]"
STRIP = f"regexp_replace({{0}}, '^{WS}+|{WS}+$', '', 'g')"
RULE = "repeat('=', 80)"
BANNER = f"chr(10) || {RULE} || chr(10) || '[SOURCE FILE: ' || {{0}} || ']' || chr(10) || {RULE} || chr(10)"


def strip(x: str) -> str:
    return STRIP.format(x)


def words(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '{WS}+'), lambda t: t <> '')"


# --- retrieval -------------------------------------------------------------------------------------------------------

_CHUNKS = (
    f"ch AS (SELECT source AS company, doc_id AS id, text, {TOK.format('text')} AS toks FROM documents),"
    f" st AS (SELECT company, count(*) AS n, avg(len(toks)) AS avgdl FROM ch GROUP BY company), tf AS (SELECT company, id, term, count(*) AS tf"
    f" FROM (SELECT company, id, unnest(toks) AS term FROM ch) GROUP BY ALL), df AS (SELECT company, term, count(*) AS df FROM tf GROUP BY ALL),"
    f" idf AS (SELECT df.company, term, df, ln((n - df + 0.5) / (df + 0.5) + 1) AS idf, avgdl FROM df JOIN st USING (company))"
)


def bm25(queries: dict[str, list[tuple[str, int]]], ctes: str = _CHUNKS, name: str = "sc") -> str:
    rows = ", ".join(f"('{q}', '{t}', {n})" for q, ts in queries.items() for t, n in ts)
    return f"{name}q(query, term, qtf) AS (VALUES {rows}), {name} AS (SELECT tf.company, query, tf.id, CAST(sum(CAST(qtf * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len(toks) / avgdl)) AS DECIMAL(38, 12))) AS DOUBLE) AS score FROM tf JOIN {name}q USING (term) JOIN idf ON idf.company = tf.company AND idf.term = tf.term JOIN ch ON ch.company = tf.company AND ch.id = tf.id GROUP BY ALL)"


def ranked(k: int, src: str = "sc", cols: str = "company, query, id, round(score, 6) AS score, rank", where: str = "score > 0") -> str:
    return f"SELECT {cols} FROM (SELECT *, CAST(row_number() OVER (PARTITION BY company, query ORDER BY round(score, 9) DESC, id) AS INTEGER) AS rank FROM {src} WHERE {where}) WHERE rank <= {k}"


def q(**texts: str) -> dict[str, list[tuple[str, int]]]:
    return {k: [(t, v.lower().split().count(t)) for t in dict.fromkeys(v.lower().split())] for k, v in texts.items()}


_DOT = "list_sum(list_transform(list_zip({0}, {1}), lambda z: z[1] * z[2]))"
_UNIT = (
    "v0 AS (SELECT 'l' || label AS company, vec_id AS id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e0 FROM embeddings),"
    " v AS (SELECT company, id, list_transform(e0, lambda x: x / sqrt(list_sum(list_transform(e0, lambda y: y * y)))) AS e FROM v0)"
)
_TERMS = bm25(q(**{k: v for k, v in K.TERMS.items()}))
SQL: dict[str, str] = {
    "bm25_topk": f"WITH {_CHUNKS}, {bm25(q(q='the of and license version'))} {ranked(5, cols='company, id, round(score, 6) AS score, rank')}",
    "bm25_term_stats": f"WITH {_CHUNKS} SELECT company, term, df, round(idf, 6) AS idf FROM idf",
    "bm25_doc_stats": f"SELECT source AS company, doc_id AS id, CAST(len({TOK.format('text')}) AS BIGINT) AS dl FROM documents",
    "bm25_multi_query_topk": f"WITH {_CHUNKS}, {_TERMS} {ranked(3)}",
    "group_query_topk": f"WITH {_CHUNKS}, {bm25(q(general='version work license terms the'))} {ranked(8)}",
    "synonym_lookup": "WITH g(g, phrases) AS (VALUES (0, ['the', 'of', 'a', 'and']), (1, ['license', 'licensed', 'the', 'work']), (2, ['und', 'der', 'die',"
    " 'das'])), t AS (SELECT g, unnest(phrases) AS token, generate_subscripts(phrases, 1) AS at FROM g),"
    " p AS (SELECT a.token, b.token AS synonym, min(b.g * 100 + b.at) AS first FROM t a JOIN t b USING (g) GROUP BY ALL)"
    " SELECT token, synonym, CAST(row_number() OVER (PARTITION BY token ORDER BY first) AS INTEGER) AS rank FROM p",
    # license -> licensed, the, work; und -> der, die, das; the -> of, a, and (first), then licensed... for its second occurrence
    "synonym_expanded_search": f"WITH {_CHUNKS}, {bm25(q(q1='license und licensed the work der die das', q2='the the of a and license licensed work'))} {ranked(4)}",
    "dense_topk": f"WITH {_UNIT}, s AS (SELECT v.company, q.id AS query, v.id, {_DOT.format('v.e', 'q.e')} AS score FROM v, v q WHERE q.id % 20 = 0)"
    f" SELECT company, query, id, round(score, 6) AS score, rank"
    f" FROM (SELECT *, CAST(row_number() OVER (PARTITION BY company, query ORDER BY round(score, 9) DESC, id) AS INTEGER) AS rank FROM s)"
    f" WHERE rank <= 3 AND score > 0",
    "minmax_scores": f"WITH {_CHUNKS}, {_TERMS} SELECT company, query, id, round(CASE WHEN max(score) OVER w = min(score) OVER w THEN 1.0"
    f" ELSE (score - min(score) OVER w) / (max(score) OVER w - min(score) OVER w) END, 6) AS norm FROM sc WINDOW"
    f" w AS (PARTITION BY company, query)",
    "hybrid_topk": f"WITH {_CHUNKS}, {bm25(q(q1='the of and', q2='license version'), name='a0')}, {_UNIT}, b0 AS (SELECT ch.company, CASE q.id"
    f" WHEN 0 THEN 'q1' ELSE 'q2' END AS query, ch.id, {_DOT.format('v.e', 'q.e')} AS score FROM v JOIN ch ON ch.id = v.id, v q"
    f" WHERE q.id IN (0, 20)), "
    + ", ".join(
        f"{x} AS (SELECT company, query, id, CASE WHEN max(score) OVER w = min(score) OVER w THEN 1.0"
        f" ELSE (score - min(score) OVER w) / (max(score) OVER w - min(score) OVER w) END AS s"
        f" FROM ({ranked(9, x + '0', 'company, query, id, score', 'true')}) WHERE score > 0 WINDOW w AS (PARTITION BY company, query))" for x in "ab"
    )
    + f", h AS (SELECT company, query, id, 0.5 * coalesce(a.s, 0) + 0.5 * coalesce(b.s, 0) AS score FROM a FULL"
    f" JOIN b USING (company, query, id)) SELECT company, query, id, score, rank FROM ({ranked(3, 'h', where='true')}) WHERE score > 0",
    "facility_candidates_dedupe": f"WITH {_CHUNKS}, {_TERMS}, hits AS (SELECT r.company, c.text, r.score FROM ({ranked(3, cols='company, query, id, score')}) r"
    f" JOIN ch c ON c.company = r.company AND c.id = r.id), c AS (SELECT * FROM hits UNION ALL SELECT company, left(text, 800), 0.1 FROM ch"
    f" UNION ALL SELECT company, right(text, 500), 0.05 FROM ch WHERE length(text) > 2000),"
    f" p AS (SELECT *, {strip('substr(text, 1, 200)')} AS prefix FROM c) SELECT company, md5(text) AS text_md5, round(score, 6) AS score"
    f" FROM (SELECT *, row_number() OVER (PARTITION BY company, prefix ORDER BY score DESC, length(text) DESC, text DESC) AS n FROM p)"
    f" WHERE n = 1",
    "greedy_token_budget": f"WITH t AS (SELECT source AS company, text, doc_id AS score, {words('text')} AS w FROM documents),"
    f" b AS (SELECT *, coalesce(sum(len(w)) OVER (PARTITION BY company ORDER BY score DESC, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1"
    f" PRECEDING), 0) AS before, row_number() OVER (PARTITION BY company ORDER BY score DESC, text) AS place FROM t)"
    f" SELECT company, CAST(place AS INTEGER) AS place, md5(CASE WHEN before + len(w) <= 5000 THEN text"
    f" ELSE array_to_string(w[1:CAST(5000 - before AS BIGINT)], ' ') END) AS text_md5, CAST(least(len(w), 5000 - before) AS INTEGER) AS tokens"
    f" FROM b WHERE before < 5000",
    "context_union_dedupe": f"WITH {_CHUNKS}, {_TERMS}, r AS ({ranked(4)}), h AS (SELECT r.company, CAST(substr(query, 2) AS INTEGER) - 1 AS strategy, rank, r.id, text"
    f" FROM r JOIN ch ON ch.company = r.company AND ch.id = r.id),"
    f" f AS (SELECT *, row_number() OVER (PARTITION BY company, text ORDER BY strategy, rank) AS nth FROM h)"
    f" SELECT company, strategy, rank, id, place FROM (SELECT *, CAST(row_number() OVER (PARTITION BY company ORDER BY strategy, rank) AS"
    f" INTEGER) AS place FROM f WHERE nth = 1 OR strategy = 0) WHERE place <= 6",
    "verification_context": f"WITH {_CHUNKS}, {_TERMS}, r AS ({ranked(2)}), h AS (SELECT r.company, query, rank, text FROM r"
    f" JOIN ch ON ch.company = r.company AND ch.id = r.id),"
    f" f AS (SELECT *, row_number() OVER (PARTITION BY company, substr(text, 1, 200) ORDER BY query, rank) AS nth FROM h),"
    f" p AS (SELECT *, row_number() OVER (PARTITION BY company ORDER BY query, rank) AS place FROM f WHERE nth = 1),"
    f" j AS (SELECT company, string_agg(text, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY place) AS t FROM p WHERE place <= 6"
    f" GROUP BY company), d AS (SELECT company, arg_min(text, id) AS full_text FROM ch GROUP BY company),"
    f" x AS (SELECT company, coalesce(t, left(full_text, 5000)) AS t FROM d LEFT JOIN j USING (company)) SELECT company, md5(CASE"
    f" WHEN len({words('t')}) <= 4000 THEN t ELSE array_to_string({words('t')}[1:4000], ' ') END) AS text_md5 FROM x",
}

# --- text and structure ----------------------------------------------------------------------------------------------

_FORMED = f"f AS (SELECT doc_id, {I.FORMED.replace('string', 'varchar')} AS text FROM documents)"
_CLEAN = "array_to_string(list_filter(string_split(regexp_replace(regexp_replace(regexp_replace(coalesce({0}, ''), '\\b(NaN|Unnamed:\\s*\\d+)\\b', '', 'g'), '[ \\t]+', ' ', 'g'), '\\n{{4,}}', chr(10) || chr(10) || chr(10), 'g'), chr(10)), lambda x: length(" + strip(
    "x"
) + ") > 2 OR " + strip("x") + " IN ('|', '-', '+')), chr(10))"
_LINES = (
    "l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS BIGINT) AS"
    " line_no FROM f)"
)
_IS_HEADER = f"(length({strip('line')}) BETWEEN 3 AND 100 AND (regexp_matches({strip('line')}, '^(SECTION|ARTICLE|PART|SCHEDULE|ANNEX|APPENDIX|EXHIBIT)\\s+[\\dIVXA-Z]+') OR regexp_matches({strip('line')}, '^[\\d]+\\.[\\d]*\\s+[A-Z][A-Za-z\\s]+$') OR regexp_matches({strip('line')}, '^[A-Z][A-Z\\s]{{10,}}$') OR regexp_matches({strip('line')}, '^\\d+\\.\\s+[A-Z]')))".replace(
    "{{", "{"
).replace("}}", "}")
_IS_TABLE = (
    "(contains(line, '|') OR length(line) - length(replace(line, chr(9), '')) >= 2 OR regexp_matches(line,"
    " '^\\s*[\\d,\\.]+\\s+[\\d,\\.]+\\s+[\\d,\\.]+') OR regexp_matches(line, '^\\s*[-=+]+\\s*$'))"
)
_MARKED = (
    f"{_FORMED}, {_LINES}, m AS (SELECT *, CASE WHEN {_IS_HEADER} THEN {strip('line')} END AS header, {_IS_TABLE} AS tab, max(line_no) OVER"
    f" (PARTITION BY doc_id) AS last FROM l), i AS (SELECT *, line_no - row_number() OVER (PARTITION BY doc_id, tab ORDER BY line_no) AS isl FROM m),"
    f" r AS (SELECT *, count(*) OVER w AS n, min(line_no) OVER w AS start, max(line_no) OVER w AS fin FROM i WINDOW"
    f" w AS (PARTITION BY doc_id, tab, isl)), t AS (SELECT *, tab AND n >= 3 AND fin < last AS in_table, last_value(header IGNORE NULLS) OVER"
    f" (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS above, count(header) OVER (PARTITION BY doc_id"
    f" ORDER BY line_no) AS sec, last_value(header IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS under"
    f" FROM r), tables AS (SELECT doc_id, start, max(line_no) + 1 AS stop, string_agg(line, chr(10) ORDER BY line_no) AS content, arg_min(above,"
    f" line_no) FILTER (line_no = start) AS header FROM t WHERE in_table GROUP BY doc_id, start),"
    f" secs AS (SELECT doc_id, 0 AS kind, sec AS pos, 'text' AS type, max(under) AS header, string_agg(line, chr(10) ORDER BY line_no) AS content"
    f" FROM t WHERE header IS NULL AND NOT in_table GROUP BY doc_id, sec UNION ALL SELECT doc_id, 1, start, 'table', header, content FROM tables)"
)
_SENT = "string_split(regexp_replace(text, '([.!?])\\s+([A-Z])', concat('\\1', chr(1), '\\2'), 'g'), chr(1))"


def _fold(size: int, overlap: int) -> str:
    """Sentence packing, one sentence a step: the open chunk is (first, total); closed chunks leave the recursion as rows."""
    back = f"coalesce(list_max(list_filter(range(0, k - first + 1), lambda j: list_sum(n[k - j + 1 : k]) <= {overlap} OR j = 0)), 0)"
    return f"""WITH RECURSIVE s AS (SELECT doc_id, {_SENT} AS s FROM documents WHERE text IS NOT NULL), c AS (SELECT doc_id, s, list_transform(s, lambda x: len({words('x')})) AS n FROM s),
 f AS (SELECT doc_id, n, 0 AS k, 0 AS first, CAST(0 AS HUGEINT) AS total, -1 AS a, -1 AS b, CAST(0 AS HUGEINT) AS t, 0 AS id FROM c
  UNION ALL SELECT doc_id, n, k + 1, CASE WHEN cut THEN k - back ELSE first END, CASE WHEN cut THEN coalesce(list_sum(n[k - back + 1 : k]), 0) ELSE total END + n[k + 1], CASE WHEN cut THEN first ELSE -1 END, CASE WHEN cut THEN k ELSE -1 END, total, id + CASE WHEN cut THEN 1 ELSE 0 END
  FROM (SELECT *, total + n[k + 1] > {size} AND first < k AS cut, {back} AS back FROM f WHERE k < len(n))),
 o AS (SELECT doc_id, id - 1 AS id, a, b, t FROM f WHERE a >= 0 UNION ALL SELECT doc_id, id, first, k, total FROM f WHERE k = len(n))
 SELECT o.doc_id, CAST(o.id AS BIGINT) AS id, md5(array_to_string(c.s[a + 1 : b], ' ')) AS text_md5, CAST(t AS BIGINT) AS token_count, CAST(b - a AS BIGINT) AS sentence_count FROM o JOIN c USING (doc_id)"""


_LANG = {k: ", ".join(f"'{w}'" for w in v) for k, v in LANGUAGE_WORDS.items()}
_LANG_N = ", ".join(f"len(list_filter(w, lambda x: x IN ({v}))) AS n_{k}" for k, v in _LANG.items())
_MOST = f"greatest({', '.join(f'n_{k}' for k in _LANG)})"
_LANG_CODE = f"CASE WHEN {_MOST} = 0 THEN 'en' " + " ".join(f"WHEN n_{k} = {_MOST} THEN '{k}'" for k in _LANG) + " END"
_HINTS = " ".join(
    f"WHEN '{k}' THEN 'The document is written in {n}. Answer in English; keep quotes in the original language.'" for k, n in LANGUAGE_NAMES.items() if k != "en"
)
SQL |= {
    "clean_text": f"WITH {_FORMED} SELECT doc_id, {strip(_CLEAN.format('text'))} AS cleaned FROM f",
    "line_noise_filter": f"WITH t AS (SELECT doc_id, {strip(_CLEAN.format('text'))} AS t FROM documents)"
    f" SELECT doc_id, length(t) AS n_clean, len(string_split(t, chr(10))) AS n_lines FROM t WHERE length({strip('t')}) > 0",
    "section_headers": f"WITH {_FORMED}, {_LINES} SELECT doc_id, line_no, {strip('line')} AS header FROM l WHERE {_IS_HEADER}",
    "table_runs": f"WITH {_MARKED} SELECT doc_id, start, stop, content FROM tables",
    "table_header_asof": f"WITH {_MARKED} SELECT doc_id, start, header FROM tables",
    "section_rollup": f"WITH {_MARKED} SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY kind, pos) - 1 AS seq, type, header, md5(content) AS"
    f" content_md5 FROM secs",
    "document_structure": f"WITH {_MARKED} SELECT f.doc_id, (SELECT count(*) FROM secs WHERE secs.doc_id = f.doc_id) AS total_sections, (SELECT count(*) FROM tables"
    f" WHERE tables.doc_id = f.doc_id) AS tables_found, coalesce((SELECT string_agg(header, '|' ORDER BY line_no) FROM m"
    f" WHERE m.doc_id = f.doc_id AND header IS NOT NULL), '') AS headers FROM f",
    "sentence_split": f"SELECT doc_id, CAST(generate_subscripts(s, 1) - 1 AS BIGINT) AS n, unnest(s) AS sentence FROM (SELECT doc_id, {_SENT} AS s FROM documents"
    f" WHERE text IS NOT NULL)",
    "sentence_chunks": _fold(60, 15),
    "language_profile": f"WITH t AS (SELECT lang, string_split_regex(lower(regexp_replace(substr(text, 1, 8000), '={{3,}}|\\[PAGE \\d+\\]|\\[SOURCE"
    f" FILE:[^\\]]*\\]', '', 'g')), '{WS}+') AS w FROM documents), c AS (SELECT lang, {_LANG_N} FROM t),"
    f" b AS (SELECT lang, {_LANG_CODE} AS code FROM c) SELECT lang, code, count(*) AS n, CASE code {_HINTS} ELSE '' END AS hint FROM b"
    f" GROUP BY lang, code",
    "safe_names": "SELECT page_id, regexp_replace(url, '[^a-zA-Z0-9_-]', '_', 'g') AS safe FROM pages",
}

# --- consolidation ---------------------------------------------------------------------------------------------------

_PIECES = (
    f"p AS (SELECT source AS company, doc_id AS ord, 'doc_' || doc_id || '.txt' AS file, text,"
    f" {BANNER.format(chr(39) + 'doc_' + chr(39) + ' || doc_id || ' + chr(39) + '.txt' + chr(39))} AS head FROM documents"
    f" WHERE length({strip('text')}) > 0), o AS (SELECT *, CAST(coalesce(sum(length(head) + length(text) + 2) OVER (PARTITION BY company ORDER BY ord"
    f" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS BIGINT) AS a FROM p),"
    f" refs AS (SELECT company, file, a AS start_char, a + length(text) AS end_char FROM o),"
    f" full_ AS (SELECT company, string_agg(head || text || chr(10) || chr(10), '' ORDER BY ord) AS t, count(*) AS n FROM p GROUP BY company),"
    f" w AS (SELECT company, id, CAST(id * 6400 AS BIGINT) AS s, least(id * 6400 + 8000, length(t)) AS e, t"
    f" FROM (SELECT company, t, unnest(range(0, CAST(greatest(ceil((length(t) - 1600) / 6400.0), 1) AS BIGINT))) AS id FROM full_)),"
    f" ov AS (SELECT w.company, id, file FROM w JOIN refs r ON r.company = w.company AND r.start_char < e AND r.end_char > s)"
)
_TOKWIN = (
    f"d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WS}*[^ \\t\\n\\r\\f\\x0B]+') AS p FROM documents),"
    f" tw AS (SELECT doc_id, p, id, CAST(id * 160 AS INTEGER) AS a, CAST(least(id * 160 + 200, len(p)) AS INTEGER) AS b"
    f" FROM (SELECT doc_id, p, unnest(range(0, CAST(greatest(ceil((len(p) - 40) / 160.0), 1) AS BIGINT))) AS id FROM d WHERE len(p) > 0)),"
    f" tx AS (SELECT *, array_to_string(p[a + 1 : b], '') AS raw FROM tw)"
)
_LEAD = "(length(raw) - length(regexp_replace(raw, '^" + WS + "+', '')))"
SQL |= {
    "company_concat": f"WITH {_PIECES} SELECT company, md5(t) AS text_md5, n AS n_files, length(t) AS total_chars, CAST(len({words('t')}) AS BIGINT) AS"
    f" total_tokens FROM full_",
    "source_offsets": f"WITH {_PIECES} SELECT company, file, start_char, end_char FROM refs",
    "char_windows": f"WITH {_PIECES} SELECT company, id, s AS char_start, e AS char_end, md5(substr(t, s + 1, e - s)) AS text_md5 FROM w",
    "token_windows": f"WITH {_TOKWIN} SELECT doc_id, id, a AS token_start, b AS token_end, CAST(length(array_to_string(p[1 : a], '')) + {_LEAD} AS BIGINT) AS"
    f" char_start, md5(substr(raw, {_LEAD} + 1)) AS text_md5, b = len(p) AS is_last FROM tx",
    "chunk_source_overlap": f"WITH {_PIECES} SELECT w.company, w.id, coalesce(string_agg(DISTINCT file, '|' ORDER BY file), '') AS source_files FROM w LEFT"
    f" JOIN ov ON ov.company = w.company AND ov.id = w.id GROUP BY w.company, w.id",
    "source_chunk_range": f"WITH {_PIECES} SELECT refs.company, refs.file, coalesce(min(id), -1) AS start_chunk, coalesce(max(id), -1) AS end_chunk FROM refs LEFT"
    f" JOIN ov ON ov.company = refs.company AND ov.file = refs.file GROUP BY refs.company, refs.file",
    "coverage_gaps": f"WITH {_TOKWIN}, x AS (SELECT *, coalesce(max(b) OVER (PARTITION BY doc_id ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),"
    f" 0) AS u FROM (SELECT doc_id, a, greatest(b - 60, a) AS b FROM tw)),"
    f" g AS (SELECT doc_id, sum(greatest(b - greatest(a, u), 0)) AS covered, max(b) AS fin, list_filter(list(CASE"
    f" WHEN a > u THEN u || '-' || a END ORDER BY a), lambda z: z IS NOT NULL) AS gaps FROM x GROUP BY doc_id),"
    f" y AS (SELECT d.doc_id, CAST(coalesce(covered, 0) AS BIGINT) AS covered, CAST(len(p) AS BIGINT) AS total, list_concat(coalesce(gaps, []),"
    f" CASE WHEN coalesce(fin, 0) < len(p) THEN [coalesce(fin, 0) || '-' || len(p)] ELSE [] END) AS gaps FROM d LEFT JOIN g USING (doc_id))"
    f" SELECT doc_id, covered, total, round(CASE WHEN total > 0 THEN covered / total ELSE 1.0 END, 6) AS share, CASE"
    f" WHEN total > 0 THEN covered / total ELSE 1.0 END >= 0.999 AS complete, array_to_string(gaps[1:10], ',') AS gaps FROM y",
    "extraction_plan": f"WITH {_PIECES}, n AS (SELECT company, count(*) AS n FROM w GROUP BY company), s AS (SELECT company, n, CASE WHEN n <= 6 THEN [0]"
    f" ELSE range(0, n, 4) END AS f FROM n) SELECT company, CAST(generate_subscripts(f, 1) - 1 AS BIGINT) AS call,"
    f" array_to_string(range(unnest(f), least(unnest(f) + 6, n)), ',') AS ids FROM s",
    "section_windows": f"WITH {_PIECES}, c AS (SELECT company, id, substr(t, s + 1, e - s) AS x, substr(substr(t, s + 1, e - s), 1, 300) AS h FROM w),"
    f" k AS (SELECT DISTINCT company, h FROM c WHERE contains(x, 'icense')),"
    f" g AS (SELECT c.company, id // 3 AS section, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS ids, bool_and(k.h IS NOT NULL) AS done"
    f" FROM c LEFT JOIN k ON k.company = c.company AND k.h = c.h GROUP BY ALL) SELECT company, section, ids"
    f" FROM (SELECT *, row_number() OVER (PARTITION BY company ORDER BY section) AS n FROM g WHERE NOT done) WHERE n <= 2",
    "skip_existing_antijoin": "SELECT source AS company, doc_id AS ord, 'doc_' || doc_id || '.txt' AS file FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "companies": "SELECT DISTINCT source AS company FROM documents",
}

# --- normalisers -----------------------------------------------------------------------------------------------------

_SKIP = "('', 'NOT_FOUND', 'N/A', 'POSSIBLY_PRESENT', 'NOT_EXTRACTED')"
_NUM = "(\\d+(?:\\.\\d+)?)"


def duck(sql: str) -> str:
    """The raw values' expressions in DuckDB's words."""
    import re

    sql = re.sub(
        r"date_format\((\w+), '([^']*)'\)",
        lambda m: f"strftime({m[1]},"
        f" '{m[2].replace('yyyy', '%Y').replace('MM', '%m').replace('dd', '%d').replace('d', '%-d') if m[2] != 'dd/MM/yyyy' and m[2] != 'yyyy-MM-dd' else m[2].replace('yyyy', '%Y').replace('MM', '%m').replace('dd', '%d')}')",
        sql,
    )
    return sql.replace("as string", "as varchar").replace("cast(l_quantity as int)", "cast(l_quantity as integer)")


def date_of(v: str) -> str:
    s = strip(v)
    named = " ".join(
        f"WHEN regexp_matches(lower({s}), '{m}\\s+\\d{{4}}') THEN '{n:02d}/' || regexp_extract(lower({s}), '{m}\\s+(\\d{{4}})', 1)" for m, n in MONTHS
    )
    return f"CASE WHEN {v} IS NULL OR {v} IN {_SKIP} THEN {v} WHEN regexp_matches({s}, '^\\d{{1,2}}/\\d{{4}}$') AND CAST(split_part({s}, '/', 1) AS INTEGER) BETWEEN 1 AND 12 THEN lpad(split_part({s}, '/', 1), 2, '0') || '/' || split_part({s}, '/', 2) {named} WHEN regexp_matches({s}, '^\\d{{4}}-\\d{{1,2}}') THEN lpad(regexp_extract({s}, '^(\\d{{4}})-(\\d{{1,2}})', 2), 2, '0') || '/' || left({s}, 4) WHEN regexp_matches({s}, '^\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}') AND CAST(split_part({s}, '/', 2) AS INTEGER) BETWEEN 1 AND 12 THEN lpad(split_part({s}, '/', 2), 2, '0') || '/' || left(split_part({s}, '/', 3), 4) WHEN regexp_matches({s}, '(?i)Q([1-4])\\s+(\\d{{4}})') THEN printf('%02d', 3 * CAST(regexp_extract({s}, '(?i)Q([1-4])\\s+(\\d{{4}})', 1) AS INTEGER)) || '/' || regexp_extract({s}, '(?i)Q([1-4])\\s+(\\d{{4}})', 2) ELSE {s} END"


def percent_of(v: str) -> str:
    s, bps, pct = strip(v), f"(?i){_NUM}\\s*(?:bps|bp|basis\\s+points?)", f"(?i){_NUM}\\s*(?:per\\s*cent|percent|%)"
    return f"CASE WHEN {v} IS NULL OR {v} IN {_SKIP} THEN {v} WHEN regexp_matches({s}, '{bps}') THEN printf('%.2f', CAST(regexp_extract({s}, '{bps}', 1) AS DOUBLE) / 100) || '%' WHEN regexp_matches({s}, '{pct}') THEN printf('%.2f', CAST(regexp_extract({s}, '{pct}', 1) AS DOUBLE)) || '%' ELSE {s} END"


def ratio_of(v: str) -> str:
    s, forms = strip(v), (f"(?i)^{_NUM}x$", f"{_NUM}\\s*:\\s*1", f"(?i){_NUM}\\s+to\\s+1")
    cases = " ".join(f"WHEN regexp_matches({s}, '{f}') THEN printf('%.2f', CAST(regexp_extract({s}, '{f}', 1) AS DOUBLE)) || 'x'" for f in forms)
    return f"CASE WHEN {v} IS NULL OR {v} IN {_SKIP} THEN {v} {cases} ELSE {s} END"


def yes_no_of(v: str) -> str:
    s = f"lower({strip(v)})"
    return f"CASE WHEN {v} IS NULL OR {v} IN {_SKIP} THEN {v} WHEN {s} IN ('yes', 'true', 'y', 'affirmative', 'confirmed', 'applicable') OR {s} LIKE 'yes%' THEN 'Yes' WHEN {s} IN ('no', 'false', 'n', 'negative', 'not applicable', 'n/a', 'none') OR {s} LIKE 'no%' THEN 'No' ELSE {strip(v)} END"


SQL |= {
    "norm_date": f"SELECT o_orderkey, raw, {date_of('raw')} AS date FROM (SELECT o_orderkey, {duck(K.DATES)} AS raw FROM orders)",
    "norm_percentage": f"SELECT l_orderkey, l_linenumber, raw, {percent_of('raw')} AS percentage FROM (SELECT l_orderkey, l_linenumber, {duck(K.PERCENTS)} AS raw"
    f" FROM lineitem)",
    "norm_ratio": f"SELECT p_partkey, raw, {ratio_of('raw')} AS ratio FROM (SELECT p_partkey, {duck(K.RATIOS)} AS raw FROM part)",
    "norm_yes_no": f"SELECT c_custkey, raw, {yes_no_of('raw')} AS yes_no FROM (SELECT c_custkey, {duck(K.YESNO)} AS raw FROM customer)",
    "norm_dispatch": f"WITH x AS (SELECT c_custkey, ['Spread [%]', 'Hedging: effective date', 'Is facility syndicated?', 'Borrower name'][c_custkey % 4 + 1] AS"
    f" field, ['percentage', 'date', 'yes_no', 'text'][c_custkey % 4 + 1] AS kind, CASE c_custkey % 3 WHEN 0 THEN ' 250bps '"
    f" WHEN 1 THEN '2024-05-01' ELSE 'yes of course' END AS raw FROM customer) SELECT c_custkey, field, kind, CASE kind"
    f" WHEN 'date' THEN {date_of('raw')} WHEN 'percentage' THEN {percent_of('raw')} WHEN 'yes_no' THEN {yes_no_of('raw')}"
    f" ELSE {strip('raw')} END AS value FROM x",
}

# --- quality ---------------------------------------------------------------------------------------------------------

def empty(v: str) -> str:
    return f"({v} IS NULL OR {strip(v)} IN ('NOT_FOUND', 'N/A', 'NOT_EXTRACTED', 'EXTRACTION_ERROR', 'POSSIBLY_PRESENT', '', 'nan', 'None'))"


def plain(v: str) -> str:
    return f"regexp_replace(regexp_replace(lower({strip(f'coalesce({v}, {chr(39)}{chr(39)})')}), '[,;. \\t\\n\\r\\f\\x0B]+$', ''), '{WS}+', ' ', 'g')"


def number(v: str) -> str:
    return f"TRY_CAST(nullif(regexp_extract(regexp_replace({v}, '[€$£¥, \\t\\n]', '', 'g'), '{_NUM}', 1), '') AS DOUBLE)"


def month_of(v: str) -> str:
    named = " ".join(
        f"WHEN regexp_matches({v}, '{m}\\s+\\d{{4}}') THEN {n} + 100 * CAST(regexp_extract({v}, '{m}\\s+(\\d{{4}})', 1) AS INTEGER)" for m, n in sorted(
            MONTHS, key=lambda x: (x[1], len(x[0]))
        )
    )
    return f"CASE WHEN regexp_matches({v}, '^\\d{{1,2}}/\\d{{4}}') THEN CAST(split_part({v}, '/', 1) AS INTEGER) + 100 * CAST(regexp_extract({v}, '/(\\d{{4}})', 1) AS INTEGER) WHEN regexp_matches({v}, '^\\d{{4}}-\\d{{1,2}}') THEN CAST(regexp_extract({v}, '-(\\d{{1,2}})', 1) AS INTEGER) + 100 * CAST(left({v}, 4) AS INTEGER) {named} END"


_FACTS = f"""g0 AS ({I.GOLDEN.replace('as string', 'as varchar')}), e0 AS ({I.EXTRACTED.replace('as string', 'as varchar')}),
 g AS (SELECT *, row_number() OVER (PARTITION BY company ORDER BY ord) - 1 AS i FROM g0), names AS (SELECT DISTINCT a.company AS gc, b.company AS ec FROM (SELECT DISTINCT company FROM g0) a JOIN (SELECT DISTINCT company FROM e0) b ON contains(lower(b.company), lower(a.company))),
 e AS (SELECT e0.*, gc, row_number() OVER (PARTITION BY gc ORDER BY ec, ord) - 1 AS i FROM e0 JOIN names ON ec = e0.company),
 pairs AS (SELECT g.company, g.i AS facility_index, g.company IN (SELECT gc FROM names) AS matched, g.ord AS golden_ord, e.ord AS extracted_ord, {', '.join(f'g.{f} AS g_{f}, e.{f} AS e_{f}' for f in I.QUALITY_FIELDS)} FROM g LEFT JOIN e ON e.gc = g.company AND e.i = g.i WHERE e.ord IS NOT NULL OR g.company NOT IN (SELECT gc FROM names)),
 long AS ({' UNION ALL '.join(f"SELECT company, facility_index, matched, '{f}' AS field, g_{f} AS golden, e_{f} AS extracted FROM pairs" for f in I.QUALITY_FIELDS)}),
 n AS (SELECT *, {plain('golden')} AS gn, {plain('extracted')} AS en, {empty('golden')} AS ge, {empty('extracted')} AS ee, {number('golden')} AS gx, {number('extracted')} AS ex FROM long),
 facts AS (SELECT company, facility_index, matched, field, golden, extracted, CASE WHEN NOT matched AND ge THEN 'both_missing' WHEN NOT matched THEN 'golden_only' WHEN ge AND ee THEN 'both_missing' WHEN ge THEN 'extracted_only' WHEN ee THEN 'golden_only' WHEN gn = en THEN 'exact_match' WHEN contains(en, gn) OR contains(gn, en) THEN 'fuzzy_match'
  WHEN gx IS NOT NULL AND ex IS NOT NULL AND ((gx = 0 AND ex = 0) OR (gx <> 0 AND ex <> 0 AND abs(gx - ex) / greatest(gx, ex) < 0.01)) THEN 'fuzzy_match'
  WHEN (gn IN ('yes', 'true', 'y') AND en IN ('yes', 'true', 'y')) OR (gn IN ('no', 'false', 'n') AND en IN ('no', 'false', 'n')) THEN 'exact_match' WHEN {month_of('gn')} = {month_of('en')} THEN 'fuzzy_match'
  WHEN abs(TRY_CAST(nullif(regexp_extract(gn, '^{_NUM}(x|\\s*:\\s*1)', 1), '') AS DOUBLE) - TRY_CAST(nullif(regexp_extract(en, '^{_NUM}(x|\\s*:\\s*1)', 1), '') AS DOUBLE)) < 0.01 THEN 'fuzzy_match' ELSE 'mismatch' END AS result FROM n)"""
_COUNTS = ", ".join(
    f"count(*) FILTER (result = '{o}') AS {o}" for o in ("exact_match", "fuzzy_match", "mismatch", "both_missing", "golden_only", "extracted_only")
)
_ACC = "(exact_match + fuzzy_match) / nullif(exact_match + fuzzy_match + mismatch + golden_only, 0)"
_COV = "coalesce((exact_match + fuzzy_match + mismatch + extracted_only) / nullif(exact_match + fuzzy_match + mismatch + golden_only + extracted_only, 0), 0.0)"
_NONE = "('NOT_FOUND', 'N/A', '', 'NOT_EXTRACTED')"
SQL |= {
    "compare_values_matrix": f"WITH {_FACTS} SELECT company, facility_index, field, golden, extracted, result FROM facts",
    "quality_overall": f"WITH {_FACTS}, c AS (SELECT count(DISTINCT (company, facility_index)) AS rows_compared, count(*) AS fields_compared, {_COUNTS}"
    f" FROM facts) SELECT *, round(coalesce({_ACC}, 0.0), 6) AS accuracy FROM c",
    "quality_by_field": f"WITH {_FACTS}, c AS (SELECT field, {_COUNTS} FROM facts WHERE matched GROUP BY field)"
    f" SELECT *, coalesce(printf('%.1f', 100.0 * {_ACC}) || '%', 'N/A') AS accuracy FROM c",
    "quality_by_company": f"WITH {_FACTS}, c AS (SELECT company, facility_index, {_COUNTS} FROM facts GROUP BY company, facility_index)"
    f" SELECT *, round(coalesce({_ACC}, 0.0), 6) AS accuracy, round({_COV}, 6) AS coverage FROM c",
    "mismatch_detail": f"WITH {_FACTS} SELECT company, facility_index, field, golden, extracted, result FROM facts"
    f" WHERE matched AND result IN ('mismatch', 'golden_only')",
    "field_coverage": f"WITH g AS ({I.GOLDEN.replace('as string', 'as varchar')}), c AS ({' UNION ALL '.join(f'''SELECT '{f}' AS field, avg(CASE WHEN {f} IS NULL OR {f} IN {_NONE} THEN 0.0 ELSE 100.0 END) AS coverage FROM g''' for f in I.QUALITY_FIELDS)}) SELECT field, round(coverage, 6) AS coverage, CASE WHEN coverage < 30 THEN 'low' WHEN coverage > 70 THEN 'high' ELSE 'middle' END AS level FROM c",
    "company_join_contains": f"WITH {_FACTS} SELECT gc AS golden_company, ec AS extracted_company FROM names",
    "positional_pairing": f"WITH {_FACTS} SELECT company, facility_index, matched, golden_ord, coalesce(extracted_ord, -1) AS extracted_ord FROM pairs",
    "conform_golden": f"WITH g AS ({I.GOLDEN.replace('as string', 'as varchar')})"
    f" SELECT company AS client, coalesce(name, '') AS borrower, coalesce(amount, '') AS amount, '' AS spread, CAST(ord AS VARCHAR) AS extra,"
    f" CAST({len(R.ALL_FIELDS) + 1} AS BIGINT) AS n_columns FROM g",
}

# --- extraction ------------------------------------------------------------------------------------------------------

_MISS = "('NOT_FOUND', 'N/A', '', 'POSSIBLY_PRESENT')"
_RANK = "CASE confidence WHEN 'HIGH' THEN 3 WHEN 'MEDIUM' THEN 2 WHEN 'LOW' THEN 1 ELSE 0 END"
_P = (
    f"p AS ({I.PASSES.replace('as string', 'as varchar').replace('as int)', 'as integer)')}), k AS (SELECT *, {_RANK} AS rk FROM p),"
    f" best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY company, facility_idx, field ORDER BY rk DESC, length(evidence) DESC,"
    f" pass_idx) AS n FROM k WHERE value NOT IN {_MISS} AND (rk > 1 OR (rk = 1 AND length(evidence) > 0))) WHERE n = 1),"
    f" merged AS (SELECT a.company, a.facility_idx, a.field, coalesce(b.value, CASE WHEN a.maybe THEN 'POSSIBLY_PRESENT'"
    f" ELSE 'NOT_FOUND' END) AS value, coalesce(b.evidence, '') AS evidence, coalesce(b.confidence, 'LOW') AS confidence"
    f" FROM (SELECT company, facility_idx, field, bool_or(value = 'POSSIBLY_PRESENT') AS maybe FROM p GROUP BY ALL) a LEFT"
    f" JOIN best b ON b.company = a.company AND b.facility_idx = a.facility_idx AND b.field = a.field)"
)
_WEIGHT = "CASE confidence WHEN 'HIGH' THEN 1.0 WHEN 'MEDIUM' THEN 0.6 ELSE 0.3 END"
_FOUND = "value NOT IN ('NOT_FOUND', 'N/A', 'EXTRACTION_ERROR', '', 'POSSIBLY_PRESENT')"
_SCORES = (
    f"scores AS (SELECT company, facility_idx, CAST(coalesce(avg(CASE WHEN {_FOUND} THEN CAST({_WEIGHT} AS DOUBLE) END), 0.0) AS DOUBLE) AS score"
    f" FROM merged GROUP BY company, facility_idx), cscores AS (SELECT company, avg(score) AS score FROM scores GROUP BY company)"
)
_ORD = "CASE field " + " ".join(f"WHEN '{f}' THEN {R.FIELDS.index(f)}" for f in K.PIVOT) + " END"
_PIV = ", ".join(f"coalesce(max(v) FILTER (field = '{f}'), 'NOT_EXTRACTED') AS {n}" for f, n in zip(K.PIVOT, ("spread", "base", "floor", "cap"), strict=True))
_RULED = (
    "r AS (SELECT CAST(o_orderkey AS INTEGER) AS facility_idx, CASE o_orderkey % 3 WHEN 0 THEN 'Yes' ELSE 'No' END AS synd, CASE o_orderkey % 4"
    " WHEN 0 THEN '10%' ELSE '' END AS share, CASE o_orderkey % 2 WHEN 0 THEN 'no' ELSE 'Yes' END AS cov, CASE o_orderkey % 5 WHEN 0 THEN '1.2x'"
    " ELSE '' END AS icr, 2020 + o_orderkey % 7 AS mat, CASE o_orderkey % 6 WHEN 0 THEN NULL ELSE 2024 END AS inc FROM orders),"
    " x AS (SELECT *, list_filter([CASE WHEN synd = 'Yes' AND share = '' THEN '1: syndicated without a share' END, CASE"
    " WHEN cov = 'Yes' AND icr = '' THEN '4: covenants without a ratio' END, CASE"
    " WHEN cov = 'no' AND icr <> '' THEN '4: no covenants but with a ratio' END, CASE"
    " WHEN mat < inc THEN '12: maturity before inception' END], lambda i: i IS NOT NULL) AS issues, cov = 'no' AND icr <> '' AS fix FROM r)"
)
SQL |= {
    "merge_passes": f"WITH {_P} SELECT * FROM merged",
    "merge_evidence": f"""WITH RECURSIVE {_P}, z AS (SELECT *, CASE WHEN value IN {_MISS} THEN -1 ELSE rk END AS z FROM k), t AS (SELECT * FROM (SELECT *, max(z) OVER (PARTITION BY company, facility_idx, field) AS top FROM z) WHERE z = top), o AS (SELECT *, row_number() OVER (PARTITION BY company, facility_idx, field ORDER BY pass_idx) AS n, count(*) OVER (PARTITION BY company, facility_idx, field) AS m FROM t),
 s AS (SELECT company, facility_idx, field, value, confidence, evidence AS ev, n, CASE WHEN top < 0 THEN 1 ELSE m END AS m FROM o WHERE n = 1 UNION ALL SELECT s.company, s.facility_idx, s.field, s.value, s.confidence, CASE WHEN o.evidence = '' OR contains(s.ev, o.evidence) THEN s.ev ELSE s.ev || ' | ' || o.evidence END, s.n + 1, s.m FROM s JOIN o ON o.company = s.company AND o.facility_idx = s.facility_idx AND o.field = s.field AND o.n = s.n + 1 WHERE s.n < s.m)
 SELECT company, facility_idx, field, value, ev AS evidence, confidence FROM s WHERE n = m""",
    "complete_calls": f"WITH {_P} SELECT company, facility_idx FROM p WHERE facility_idx % 3 > 0 OR (confidence = 'HIGH' AND value NOT IN {_MISS})"
    f" GROUP BY company, facility_idx HAVING bool_and(value NOT IN {_MISS} AND confidence = 'HIGH')",
    "apply_corrections": f"WITH {_P} SELECT company, facility_idx, field, CASE WHEN hit THEN '1.00%' ELSE value END AS value, CASE"
    f" WHEN hit THEN evidence || ' [CORRECTED: see clause]' ELSE evidence END AS evidence, CASE WHEN hit THEN 'MEDIUM'"
    f" ELSE confidence END AS confidence FROM (SELECT *, field = 'Spread [%]' AND value = '250 bps' AS hit FROM merged)",
    "confidence_score": f"WITH {_P}, {_SCORES} SELECT company, facility_idx, round(score, 6) AS score FROM scores",
    "company_confidence": f"WITH {_P}, {_SCORES} SELECT company, round(score, 6) AS score FROM cscores",
    "facility_pivot": f"WITH {_P}, {_SCORES}, v AS (SELECT company, facility_idx, field, CASE WHEN value = 'POSSIBLY_PRESENT' THEN 'NOT_FOUND'"
    f" WHEN value = 'EXTRACTION_ERROR' THEN value WHEN field = 'Base Rate of the facility' THEN {strip('value')}"
    f" ELSE {percent_of('value')} END AS v FROM merged), w AS (SELECT company, facility_idx, {_PIV} FROM v GROUP BY company, facility_idx)"
    f" SELECT w.company AS client, 'f_' || w.company AS sources, '' AS comments, printf('%.2f', cscores.score * 100) || '%' AS score, spread,"
    f" base, floor, cap, count(*) AS n FROM w JOIN cscores ON cscores.company = w.company GROUP BY ALL",
    "deep_targets": f"WITH {_P}, t AS (SELECT *, CASE WHEN value = 'POSSIBLY_PRESENT' THEN 0"
    f" WHEN value IN ('NOT_FOUND', 'N/A', 'EXTRACTION_ERROR', '') OR confidence = 'LOW' THEN 1 END AS late FROM merged)"
    f" SELECT company, facility_idx, field, priority FROM (SELECT *, CAST(row_number() OVER (PARTITION BY company, facility_idx ORDER BY late,"
    f" {_ORD}) AS INTEGER) AS priority FROM t WHERE late IS NOT NULL) WHERE priority <= 2",
    "cross_reference_rules": f"WITH {_RULED} SELECT facility_idx, array_to_string(issues, ';') AS issues, CASE WHEN fix THEN 'If covenants specified?'"
    f" ELSE '' END AS fixes FROM x",
    "auto_fix": f"WITH {_RULED} SELECT facility_idx, CASE WHEN fix THEN 'Yes' ELSE cov END AS value, CASE WHEN fix THEN 'e [AUTO-FIXED from no]'"
    f" ELSE 'e' END AS evidence, CASE WHEN fix THEN 'MEDIUM' ELSE 'HIGH' END AS confidence FROM x",
    "json_parse_fields": "SELECT event_id, event_id % 6 < 4 AND props IS NOT NULL AS ok, CASE WHEN event_id % 6 < 4 THEN json_extract_string(props, '$.k') END AS k"
    " FROM events",
    "schema_validate": "SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'Field ''b'' missing ''confidence'' key'"
    " WHEN 1 THEN 'Field ''a'' is not a dict;Missing field: b' WHEN 2 THEN 'Missing ''fields'' key' WHEN 3 THEN 'Result is not a dict'"
    " ELSE '' END AS issues FROM events",
    "fuzzy_key_remap": "SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN 'type of tranche used' ELSE 'Type' END AS tranche, CASE"
    " WHEN n_nationkey % 3 = 0 THEN 'limit of credit' END AS amount, CASE WHEN n_nationkey % 5 <> 0 THEN 'sponsor' END AS sponsor FROM nation",
    "pattern_candidates": "SELECT doc_id, 'Spread [%]' AS field, doc_id % 50 || '.5;75' AS candidates FROM documents UNION ALL"
    " SELECT doc_id, 'Project location [Country]', 'Spain;Italy' FROM documents",
    "table_cell_lookup": "SELECT doc_id, 'Spread [%]' AS field, doc_id % 7 || '.25%' AS value FROM documents",
    "field_group_extraction": f"WITH f AS (SELECT unnest([{', '.join(repr(x) for g in R.GROUPS if g[0] == 'pricing' for x in g[3])}]) AS field)"
    f" SELECT CAST(doc_id AS INTEGER) AS facility_idx, field, CASE WHEN field = 'Spread [%]' THEN doc_id % 7 || '.25%'"
    f" ELSE 'NOT_FOUND' END AS value, CASE WHEN field = 'Spread [%]' THEN 'HIGH' ELSE 'LOW' END AS confidence FROM documents CROSS JOIN f",
}
SQL |= {
    "row_normalise": "SELECT c_custkey, '0.75%' AS spread, '05/2021' AS date, c_name AS borrower FROM customer",
    "annotated_chunks": f"WITH {_PIECES}, x AS (SELECT w.company, w.id, substr(t, s + 1, e - s) AS text, (SELECT string_agg(DISTINCT file, ', ' ORDER BY file)"
    f" FROM ov WHERE ov.company = w.company AND ov.id = w.id) AS f FROM w)"
    f" SELECT company, md5(string_agg('[From: ' || coalesce(f, '') || ']' || chr(10) || text, chr(10) || chr(10) || '---' || chr(10) || chr(10)"
    f" ORDER BY id)) AS text_md5 FROM x WHERE contains(text, 'icense') GROUP BY company",
    "facility_detection": "SELECT doc_id, CAST(0 AS BIGINT) AS facility_idx, CASE WHEN doc_id % 5 = 0 THEN 'Primary Facility' ELSE 'Term Loan A' END AS name, CASE"
    " WHEN doc_id % 5 = 0 THEN 'Unknown' ELSE 'Term Loan' END AS type, CASE WHEN doc_id % 5 = 0 THEN 'N/A'"
    " ELSE 'EUR ' || doc_id END AS amount, CASE WHEN doc_id % 5 = 0 THEN '' ELSE 'senior' END AS characteristics FROM documents UNION ALL"
    " SELECT doc_id, 1, 'RCF B', 'RCF', 'USD 5', '' FROM documents WHERE doc_id % 5 > 0 AND doc_id % 3 = 0",
    "retried_extraction": "SELECT CAST(doc_id AS INTEGER) AS facility_idx, CAST(CASE WHEN doc_id % 7 % 2 = 1 OR doc_id % 7 = 6 THEN 2"
    " ELSE 1 END AS INTEGER) AS tries, CASE WHEN doc_id % 7 = 6 THEN 'EXTRACTION_ERROR' ELSE doc_id % 7 || '.25%' END AS value, CASE"
    " WHEN doc_id % 7 = 6 THEN 'LOW' ELSE 'HIGH' END AS confidence FROM documents",
    "verification_pass": "SELECT CAST(doc_id AS VARCHAR) AS company, doc_id % 7 || '.25%' AS value, CASE WHEN doc_id % 2 = 0 THEN 'e'"
    " ELSE 'e [CORRECTED: not in the text]' END AS evidence, CASE WHEN doc_id % 2 = 0 THEN 'HIGH' ELSE 'MEDIUM' END AS confidence"
    " FROM documents",
    "deep_single_field": "SELECT CAST(doc_id AS VARCHAR) AS company, field, CASE WHEN field = 'Spread [%]' THEN doc_id % 7 || '.25%'"
    " ELSE 'NOT_FOUND' END AS value, CASE WHEN field <> 'Spread [%]' THEN 'LOW' WHEN doc_id % 7 % 2 = 1 OR doc_id % 7 = 6 THEN 'MEDIUM'"
    " ELSE 'HIGH' END AS confidence FROM documents, (VALUES ('Spread [%]'), ('Base Rate of the facility')) f(field)",
    "end_to_end": "SELECT 'c' || doc_id AS client, CAST(CASE WHEN doc_id % 5 > 0 AND doc_id % 3 = 0 THEN 2"
    " ELSE 1 END AS BIGINT) AS facilities, doc_id % 7 || '.25%' AS least_spread, doc_id % 7 || '.25%' AS most_spread, 'a.txt' AS files"
    " FROM documents",
    "csv_round_trip": f"WITH g AS ({I.GOLDEN.replace('as string', 'as varchar')})"
    f" SELECT company AS client, coalesce(name, '') AS borrower, 'say \"a\", ' || coalesce(amount, '') AS comments, CAST({len(R.ALL_FIELDS)} AS"
    f" BIGINT) AS n_columns FROM g",
    "tables_round_trip": f"WITH {_PIECES} SELECT company, file, start_char, end_char FROM refs",
    "scanned_tree": "SELECT 'folder=n' || n_nationkey AS company, 'text' AS type, 'text of ' || n_name AS text FROM nation",
    "json_round_trip": f"WITH {_FACTS}, c AS (SELECT field, {_COUNTS} FROM facts WHERE matched GROUP BY field)"
    f" SELECT field, coalesce(printf('%.1f', 100.0 * {_ACC}) || '%', 'N/A') AS accuracy, exact_match, fuzzy_match, mismatch FROM c",
    "coverage_report": f"WITH g AS ({I.GOLDEN.replace('as string', 'as varchar')}), c AS ({' UNION ALL '.join(f"""SELECT '{f}' AS field, avg(CASE WHEN {f} IS NULL OR {f} IN {_NONE} THEN 0.0 ELSE 100.0 END) AS coverage FROM g""" for f in I.QUALITY_FIELDS)}) SELECT (SELECT count(*) FROM g) AS total_rows, CAST({len(I.QUALITY_FIELDS)} AS BIGINT) AS total_fields, coalesce(string_agg(field, ',' ORDER BY field) FILTER (coverage < 30), '') AS low, coalesce(string_agg(field, ',' ORDER BY field) FILTER (coverage > 70), '') AS high FROM c",
    "embedding_store": f"WITH {_UNIT} SELECT id, round(sqrt({_DOT.format('e', 'e')}), 6) AS length, round(e[1], 6) AS first FROM v",
    "verification_corrections": "SELECT n_name AS company, 'Spread [%]' AS field, CAST(n_nationkey AS VARCHAR) AS verified_value, 'r' AS correction_reason FROM nation"
    " WHERE n_nationkey % 2 = 0",
    "group_flatten": f"WITH {_P} SELECT company, facility_idx, field, 'fees' AS \"group\", 'later ' || value AS value FROM merged",
    "event_windows": "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n, round(sum(value), 4) AS total"
    " FROM events GROUP BY ALL",
    "few_shot_prompt": "SELECT doc_id, md5('ask' || chr(10) || 'EXAMPLE' || chr(10) || 'Text: ' || coalesce(text, '') || chr(10) || 'Answer: {}' || chr(10) ||"
    " chr(10) || 'DOCUMENT TEXT:' || chr(10) || 'x DOCUMENT TEXT: y') AS prompt_md5 FROM documents",
}
