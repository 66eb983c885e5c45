"""Writers: tables by company, CSV in the output's order, JSON reports, traces."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomleaf import registry as R
from fathomleaf.functions.text import safe_name


def write_table(df: DataFrame, path: str, by: str = "company", mode: str = "overwrite") -> None:
    """Parquet, one folder a company; the rows of one company may be written by many tasks."""
    df.write.mode(mode).partitionBy(by).parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def ordered(df: DataFrame) -> DataFrame:
    """The registry's columns in order, then any others."""
    own = [c for c in R.ALL_FIELDS if c in df.columns]
    return df.select(*(F.col(f"`{c}`") for c in [*own, *(c for c in df.columns if c not in set(own))]))


CSV_ROWS = 20_000


def write_csv(df: DataFrame, path: str) -> None:
    """Files of ``CSV_ROWS`` rows at most: values may hold line feeds, so a file is read by one task."""
    ordered(df).write.mode("overwrite").option("header", True).option("escape", '"').option("encoding", "UTF-8").option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).option("maxRecordsPerFile", CSV_ROWS).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_report(parts: dict[str, DataFrame], path: str) -> None:
    """A folder of JSON lines for each part of a report."""
    for name, df in parts.items():
        write_json(df, f"{path.rstrip('/')}/{name}")


def write_detailed(df: DataFrame, path: str) -> None:
    """``detailed_json`` rows, one folder a company by its safe name."""
    df.withColumn("safe", safe_name("company")).select("safe", "json").write.mode("overwrite").partitionBy("safe").text(path)


def write_embeddings(df: DataFrame, name: str, buckets: int = 64) -> None:
    """A table bucketed by company, so that joins with chunks need no shuffle."""
    df.write.mode("overwrite").bucketBy(buckets, "company").sortBy("company", "id").saveAsTable(name)


def write_traces(df: DataFrame, path: str) -> None:
    append(df, path)
