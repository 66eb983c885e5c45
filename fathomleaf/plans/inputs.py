"""The driver's tables as the inputs of the operators: a document is a file or a chunk, its source a company."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A table; texts in fewer partitions than there are cores (a file or two) are dealt out first."""
    df = spark.read.parquet(f"{d}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if name in ("documents", "pages", "conversations") and df.rdd.getNumPartitions() < cores else df


def files(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(
        F.col("source").alias("company"),
        F.col("doc_id").alias("ord"),
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("file"),
        "text",
    )


def chunks(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(F.col("source").alias("company"), F.col("doc_id").alias("id"), "text")


#: Texts with headers and tables, the same in both dialects.
FORMED = (
    "'SECTION ' || cast(doc_id % 9 + 1 as string) || chr(10) || coalesce(text, '') || chr(10) || 'GENERAL TERMS AND CONDITIONS' || chr(10) || 'a | b'"
    " || chr(10) || 'c | d' || chr(10) || 'Spread [%] | ' || cast(doc_id % 7 as string) || '.25%' || chr(10) || 'closing line' || chr(10) || 'x | y'"
    " || chr(10) || 'z | w' || chr(10) || 'q | r'"
)


def formed(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.expr(FORMED).alias("text"))


#: Lines on facilities: none, one or two.
FACILITY_LINES = (
    "case when doc_id % 5 = 0 then '' else 'FACILITY: Term Loan A | Term Loan | EUR ' || cast(doc_id as string) || ' | senior' || chr(10) || case"
    " when doc_id % 3 = 0 then 'FACILITY: RCF B | RCF | USD 5' || chr(10) else '' end end"
)
#: A document's text, well before a sentence with values in it.
PHRASED = (
    "coalesce(text, '') || repeat(' -', 160) || ' The applicable margin is ' || cast(doc_id % 50 as string) || '.5% and the project is located in"
    " Spain, then Italy. A spread of 75 bps.'"
)


def documents(spark: SparkSession, d: str, **columns: str) -> DataFrame:
    """doc_id and columns of SQL over the documents."""
    return table(spark, d, "documents").select("doc_id", *(F.expr(sql).alias(name) for name, sql in columns.items()))


#: Raw field values in many forms; (company, ord, then a value a column).
GOLDEN = """select c_mktsegment as company, c_custkey as ord,
 case c_custkey % 6 when 0 then 'NOT_FOUND' when 1 then c_name else upper(c_name) end as name,
 case c_custkey % 5 when 0 then '' when 1 then '03/2024' when 2 then '2024-03' when 3 then 'March 2024' else '12/2031' end as maturity,
 case c_custkey % 4 when 0 then 'Yes' when 1 then 'true' when 2 then 'no' else 'N/A' end as syndicated,
 case c_custkey % 7 when 0 then '1.20x' when 1 then '1.20:1' when 2 then null else 'EUR ' || cast(c_custkey as string) || ',000' end as amount
 from customer"""
EXTRACTED = """select lower(c_mktsegment) || ' folder' as company, c_custkey as ord,
 case c_custkey % 4 when 0 then 'POSSIBLY_PRESENT' when 1 then lower(c_name) || '.' when 2 then c_name || ' Ltd' else 'other' end as name,
 case c_custkey % 3 when 0 then 'March 2024' when 1 then '2024-03-15' else 'nan' end as maturity,
 case c_custkey % 5 when 0 then 'y' when 1 then 'yes' when 2 then 'n' when 3 then 'false' else 'NOT_FOUND' end as syndicated,
 case c_custkey % 3 when 0 then '1.2 : 1' when 1 then cast(c_custkey * 1000 as string) || ' EUR' else 'USD 99' end as amount
 from customer where c_mktsegment <> 'MACHINERY'"""
QUALITY_FIELDS = ["name", "maturity", "syndicated", "amount"]

#: Extraction passes made from conversations: a conversation is a facility, a turn a pass of one of four fields.
PASSES = """select 'c' || cast(conv_id % 7 as string) as company, cast(conv_id as int) as facility_idx, 'pricing' as grp,
 case turn % 4 when 0 then 'Spread [%]' when 1 then 'Base Rate of the facility' when 2 then 'Interest rate floor %' else 'Interest rate cap %' end as field, cast(turn as int) as pass_idx,
 case (conv_id + turn) % 7 when 0 then 'NOT_FOUND' when 1 then 'POSSIBLY_PRESENT' when 2 then '250 bps' when 3 then 'EXTRACTION_ERROR' when 4 then '' else text end as value,
 case (conv_id * 3 + turn) % 5 when 0 then '' else text end as evidence,
 case (conv_id * 5 + turn * 3) % 4 when 0 then 'HIGH' when 1 then 'MEDIUM' when 2 then 'LOW' else 'odd' end as confidence
 from conversations"""


def sql_view(spark: SparkSession, d: str, table_name: str, sql: str) -> DataFrame:
    """``sql`` over one of the tables, without leaving a view behind."""
    return spark.sql(sql.replace(f"from {table_name}", "from {t}"), t=table(spark, d, table_name))
