"""Headers, tables, sections and sentence-packed chunks of texts.

Every operator takes (keys, text) and explodes lines or sentences; window functions then work within one document, so
nothing gathers more than a document in a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomleaf.functions import text as X

LEAST_TABLE_LINES = 3


def line_table(docs: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """(keys, line_no, line, header, in_table): one row a line; ``header`` is null on other lines.

    Runs of at least three table lines are tables, unless they reach the end of the text.
    """
    rows = docs.select(*keys, F.posexplode(X.lines(text_col)).alias("line_no", "line"))
    rows = rows.withColumn("header", F.when(X.is_header(F.col("line")), X.strip("line"))).withColumn("tabular", X.is_table_line(F.col("line")))
    by_line = Window.partitionBy(*keys).orderBy("line_no")
    flips = F.sum(F.when(F.col("tabular"), 0).otherwise(1)).over(by_line)
    rows = rows.withColumn("run_", F.when(F.col("tabular"), flips))
    run = Window.partitionBy(*keys, "run_")
    last = F.max("line_no").over(Window.partitionBy(*keys))
    rows = rows.withColumn("in_table", F.col("tabular") & (F.count(F.lit(1)).over(run) >= LEAST_TABLE_LINES) & (F.max("line_no").over(run) < last))
    return rows.withColumn("table_start", F.when(F.col("in_table"), F.min("line_no").over(run))).drop("tabular", "run_")


def headers(docs: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """(keys, line_no, header)."""
    rows = docs.select(*keys, F.posexplode(X.lines(text_col)).alias("line_no", "line"))
    return rows.filter(X.is_header(F.col("line"))).select(*keys, "line_no", X.strip("line").alias("header"))


def tables(docs: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """(keys, start, stop, content, header): half-open runs of lines, under the nearest header before them."""
    rows = line_table(docs, keys, text_col)
    before = F.last("header", ignorenulls=True).over(Window.partitionBy(*keys).orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("above", before).filter("in_table")
    content = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda s: s["line"]), "\n")
    return rows.groupBy(*keys, F.col("table_start").alias("start")).agg(
        (F.max("line_no") + 1).alias("stop"), content.alias("content"), F.min_by("above", "line_no").alias("header")
    )


def sections(docs: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """(keys, seq, type, header, content): text between headers in order, then the tables."""
    rows = line_table(docs, keys, text_col)
    by_line = Window.partitionBy(*keys).orderBy("line_no")
    rows = rows.withColumn("section_", F.count("header").over(by_line)).withColumn("under", F.last("header", ignorenulls=True).over(by_line))
    own = rows.filter("header is null and not in_table")
    content = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda s: s["line"]), "\n")
    texts = own.groupBy(*keys, "section_").agg(F.first("under", ignorenulls=True).alias("header"), content.alias("content"))
    texts = texts.select(*keys, F.lit(0).alias("kind_"), F.col("section_").cast("long").alias("at_"), F.lit("text").alias("type"), "header", "content")
    found = tables(docs, keys, text_col).select(
        *keys, F.lit(1).alias("kind_"), F.col("start").cast("long").alias("at_"), F.lit("table").alias("type"), "header", "content"
    )
    order = Window.partitionBy(*keys).orderBy("kind_", "at_")
    return texts.unionByName(found).withColumn("seq", F.row_number().over(order) - 1).drop("kind_", "at_")


def structure(docs: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """(keys, total_sections, tables_found, headers_found): one row a document."""
    counts = sections(docs, keys, text_col).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_sections"), F.count_if(F.col("type") == "table").alias("tables_found")
    )
    found = headers(docs, keys, text_col).groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("line_no", "header"))), lambda s: s["header"]).alias("headers_found")
    )
    return docs.select(*keys).join(counts, keys, "left").join(found, keys, "left").select(
        *keys,
        F.coalesce("total_sections", F.lit(0)).alias("total_sections"),
        F.coalesce("tables_found", F.lit(0)).alias("tables_found"),
        F.coalesce("headers_found", F.array().cast("array<string>")).alias("headers_found"),
    )


def pack(sizes: list[int], size: int, overlap: int) -> list[tuple[int, int, int]]:
    """(first, stop, tokens) of each chunk of sentences.

    A chunk is closed before the sentence that would take it over ``size``; the next one begins with the longest run of
    closing sentences of at most ``overlap`` tokens.
    """
    out, first, total = [], 0, 0
    for k, n in enumerate(sizes):
        if total + n > size and first < k:
            out.append((first, k, total))
            back, first = 0, k
            while first > out[-1][0] and back + sizes[first - 1] <= overlap:
                first -= 1
                back += sizes[first]
            total = back
        total += n
    return [*out, (first, len(sizes), total)] if sizes else out


def sentence_chunks(docs: DataFrame, keys: list[str], size: int = 2000, overlap: int = 400, text_col: str = "text") -> DataFrame:
    """(keys, id, text, token_count, sentence_count). Boundaries depend on the chunk before: a fold, row by row.

    Sentences are split and counted natively; only the counts go to Python, a hundred rows at a time. Null text has no chunk;
    an empty text has one empty chunk.
    """
    rows = docs.select(*keys, X.sentences(text_col).alias("sentences_")).filter("sentences_ is not null").withColumn(
        "sizes_", F.transform("sentences_", X.token_count)
    )
    spans = T.ArrayType(T.StructType([T.StructField(n, T.IntegerType()) for n in ("id", "first", "length", "token_count")]))
    fold = F.udf(lambda sizes: [(i, a + 1, b - a, n) for i, (a, b, n) in enumerate(pack(sizes, size, overlap))], spans, useArrow=False)
    found = rows.withColumn("chunks_", fold("sizes_")).select(*keys, "sentences_", F.explode("chunks_").alias("c"))
    return found.select(
        *keys,
        "c.id",
        F.array_join(F.slice("sentences_", F.col("c.first"), F.col("c.length")), " ").alias("text"),
        "c.token_count",
        F.col("c.length").alias("sentence_count"),
    )
