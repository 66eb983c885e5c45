"""The whole way from files to one row a facility, as DataFrames; a company is a key, never a loop.

Model answers are written before anything reads them (``kept``), so that each call is made once.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fathomleaf import registry as R
from fathomleaf.config import EngineConfig
from fathomleaf.functions import text as X
from fathomleaf.operators import consolidate as C
from fathomleaf.operators import deep as D
from fathomleaf.operators import extract as E
from fathomleaf.operators import retrieval as S
from fathomleaf.operators.state import kept

Embedder = Callable[[], Callable[[list[str]], list[list[float]]]]
Searcher = Callable[[Mapping[str, str], int], DataFrame]


@dataclass
class Result:
    extractions: DataFrame
    rows: DataFrame
    issues: DataFrame
    facilities: DataFrame
    traces: list[DataFrame] = field(default_factory=list)  # one a step, for ``sinks.write_traces``


def searcher(spark: SparkSession, chunks: DataFrame, config: EngineConfig, embedder: Embedder | None = None) -> Searcher:
    """A search of named texts, of the kind that the configuration names; dense kinds need an embedder."""
    lookup = S.lookup_table()
    if config.retriever == "bm25":
        return lambda texts, k: S.bm25_search(chunks, S.make_queries(spark, texts, lookup, config.max_expansion), k, config)
    if embedder is None:
        raise ValueError(f"{config.retriever} needs an embedder")
    vectors = kept(S.embed(chunks, embedder, batch=config.embedding_batch, most=config.embedding_max_length))

    def search(texts: Mapping[str, str], k: int) -> DataFrame:
        asked = spark.createDataFrame([(n, f"{S.INSTRUCTION}{t}") for n, t in texts.items()], "query string, text string")
        of_queries = S.embed(asked, embedder, ["query"], config.embedding_batch, config.embedding_max_length)
        return S.retriever(config.retriever, vectors, of_queries, config)(chunks, S.make_queries(spark, texts, lookup, config.max_expansion), k)

    return search


def detect(spark: SparkSession, files: DataFrame, chunks: DataFrame, search: Searcher, model: type | None, config: EngineConfig) -> tuple[DataFrame, DataFrame]:
    """(facilities, answers): what the model makes of the best pieces for English queries and those of the company's language."""
    language = chunks.filter("id = 0").select("company", X.language(X.without_banners("text")).alias("language"))
    texts = {f"{code}{i:02d}": t for code, own in S.FACILITY_QUERIES.items() for i, t in enumerate(own)}
    hits = search(texts, 3).withColumn("of_", F.substring("query", 1, 2)).join(language, "company").filter("of_ = 'en' or of_ = language")
    pool = S.candidates(hits.join(chunks.select("company", "id", "text"), ["company", "id"]), C.company_docs(files))
    packed = S.pack_budget(pool, config.detection_budget)
    answers = kept(E.call_model(E.detection_prompts(packed), model, "facilities"))
    return E.facilities(answers), answers


def group_contexts(chunks: DataFrame, search: Searcher, config: EngineConfig) -> tuple[DataFrame, DataFrame]:
    """(contexts by company and group, the retrieved texts)."""
    hits = search({g: S.group_query(words, own) for g, _, words, own in R.GROUPS}, config.max_chunks_per_group)
    texts = kept(hits.join(chunks.select("company", "id", "text"), ["company", "id"]))
    return texts.groupBy("company", F.col("query").alias("group")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "text"))), lambda s: s["text"]).alias("texts")
    ), texts


def verify(extractions: DataFrame, chunks: DataFrame, docs: DataFrame, model: type | None, config: EngineConfig) -> tuple[DataFrame, DataFrame]:
    """(corrected extractions, answers): found values checked against the chunks that speak of them."""
    order = extractions.sparkSession.createDataFrame([(f, i) for i, f in enumerate(R.FIELDS)], "field string, ord int")
    found = extractions.filter(~F.coalesce("value", F.lit("")).isin(*R.MISSING_IN_CONFIDENCE)).join(F.broadcast(order), "field")
    first = found.withColumn("n_", F.row_number().over(Window.partitionBy("company").orderBy("facility_idx", "ord"))).filter("n_ <= 8")
    asked = first.select(
        "company", F.col("n_").alias("query"), F.explode(X.tokens(F.concat_ws(" ", "field", "value"))).alias("term")
    ).groupBy("company", "query", "term").agg(F.count(F.lit(1)).cast("int").alias("qtf"))
    hits = S.top_k(S.bm25_scores(chunks, asked, config), 2).join(
        chunks.select("company", "id", "text"), ["company", "id"]
    ).select("company", F.col("query").alias("nth"), "rank", "text")
    contexts = S.verification_context(hits, docs, config)
    answers = kept(E.call_model(E.verification_prompts(extractions, contexts), model, "verified_fields"))
    return E.apply_corrections(extractions, E.corrections(answers)), answers


def field_contexts(spark: SparkSession, targets: DataFrame, chunks: DataFrame, search: Searcher, k: int = 6) -> DataFrame:
    """(company, field, text) of the targets: keywords first, then the field's name, then its description, equal texts once."""
    numbers = {f: i for i, f in enumerate(R.FIELDS)}
    texts = {f"0|{i}": " ".join(D.STRATEGIES[f].keywords) for f, i in numbers.items() if f in D.STRATEGIES} | {f"1|{i}": f for f, i in numbers.items()}
    more = {f"2|{i}": R.describe(f) for f, i in numbers.items() if R.describe(f) != f}
    hits = search(texts, k).unionByName(search(more, k // 2))
    names = spark.createDataFrame([(str(i), f) for f, i in numbers.items()], "n_ string, field string")
    parts = F.split("query", r"\|")
    named = hits.select(
        "company", "id", "rank", parts[0].cast("int").alias("strategy"), parts[1].alias("n_")
    ).join(F.broadcast(names), "n_").join(targets.select("company", "field").distinct(), ["company", "field"], "left_semi")
    rows = S.context_union(named.join(chunks.select("company", "id", "text"), ["company", "id"]), k)
    return rows.groupBy("company", "field").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "text"))), lambda s: s["text"]), "\n\n").alias("text")
    )


def deepen(
    spark: SparkSession, extractions: DataFrame, files: DataFrame, chunks: DataFrame, search: Searcher, model: type | None, config: EngineConfig
) -> tuple[DataFrame, DataFrame]:
    """(extractions, answers): a second attempt at what is missing, one field at a time."""
    fields = R.fields(spark)
    found = kept(
        D.table_lookup(files, fields, ["company", "ord"]).groupBy("company", "field").agg(
            F.min_by("value", "ord").alias("value"), F.min_by("line", "ord").alias("line")
        )
    )
    # A field that a table line names is tried beyond the number of attempts, and with that line: retrieval may miss it in a long text.
    named = D.open_fields(extractions).join(found, ["company", "field"], "left_semi").select("company", "facility_idx", "field")
    first = D.deep_targets(extractions, fields, config).select("company", "facility_idx", "field")
    targets = kept(first.unionByName(named).distinct())
    lines = targets.select("company", "field").distinct().join(found.select("company", "field", "line"), ["company", "field"])
    contexts = kept(
        field_contexts(spark, targets, chunks, search).join(lines, ["company", "field"], "full").select(
            "company", "field", F.coalesce("text", F.lit("")).alias("text"), "line"
        )
    )
    candidates = D.with_table_values(D.field_candidates(contexts), found)
    answers = kept(E.call_model(E.deep_prompts(targets, contexts, candidates, fields, config), model, "value", 1))
    return D.replace_found(extractions, E.deep_answers(answers)), answers


def run(spark: SparkSession, files: DataFrame, model: type | None = None, config: EngineConfig = EngineConfig(), embedder: Embedder | None = None) -> Result:
    """``files``: (company, ord, file, text). One row a facility that the model finds in a company."""
    files = files.withColumn("text", X.clean_text("text")).filter(F.length("text") > 0)
    chunks = kept(C.with_sources(C.windows_by_file(files, config), C.source_offsets(files)))
    fields, groups = R.fields(spark), R.groups(spark)
    search = searcher(spark, chunks, config, embedder)
    facilities, detected = detect(spark, files, chunks, search, model, config)
    contexts, texts = group_contexts(chunks, search, config)
    named = facilities.withColumn(
        "facility", F.when(F.count(F.lit(1)).over(Window.partitionBy("company")) > 1, F.col("name"))
    ).select("company", "facility_idx", "facility")
    calls = named.join(contexts, "company").withColumn("pass_idx", F.lit(0))
    first = kept(E.call_model(E.prompts(calls, groups, config), model, "fields"))
    sections = C.section_windows(chunks, texts.select("company", "text"), config)
    more = sections.select("company", F.explode("ids").alias("id")).join(
        chunks.select("company", "id", "text"), ["company", "id"]
    ).groupBy("company").agg(F.transform(F.array_sort(F.collect_list(F.struct("id", "text"))), lambda s: s["text"]).alias("texts"))
    passes = E.answers_to_fields(first, fields)
    again = E.still_open(calls.drop("texts", "pass_idx"), passes).join(more, "company").withColumn("pass_idx", F.lit(1))
    second = kept(E.call_model(E.prompts(again, groups, config), model, "fields"))
    merged = kept(E.flatten(E.merge_passes(passes.unionByName(E.answers_to_fields(second, fields))), groups))
    verified, checks = verify(merged, chunks, C.company_docs(files).select("company", "full_text"), model, config)
    verified = kept(verified)
    deep, attempts = deepen(spark, verified, files, chunks, search, model, config)
    deep = kept(deep)
    checked = D.cross_reference(deep)
    fixed = D.auto_fix(deep, checked)
    names = C.source_offsets(files).groupBy("company").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "file"))), lambda s: s["file"]), ", ").alias("source_files")
    ).withColumn("comments", F.lit(""))
    rows = E.rows_wide(fixed, fields, names, E.company_scores(merged))
    steps = {"facility_detection": detected, "extract": first, "extract_sections": second, "verification": checks, "deep_extract": attempts}
    return Result(fixed, rows, checked, facilities, [E.stored_traces(a, s) for s, a in steps.items()])
