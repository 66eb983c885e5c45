"""Golden against extracted records: conforming, matching, comparing, reporting. All values are strings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathomleaf import registry as R
from fathomleaf.functions import normalize as N

OUTCOMES = ["exact_match", "fuzzy_match", "mismatch", "both_missing", "golden_only", "extracted_only"]


def resolve_columns(columns: Sequence[str], renames: Mapping[str, str], schema: Sequence[str] = R.ALL_FIELDS) -> dict[str, str]:
    """Column -> schema name: by the given map, then as it is, then whatever its case; else unchanged (stripped)."""
    by_case = {s.lower(): s for s in schema}
    return {c: renames.get(n := c.strip()) or (n if n in schema else by_case.get(n.lower(), n)) for c in columns}


def diagnose(columns: Sequence[str], schema: Sequence[str] = R.ALL_FIELDS) -> dict[str, list[str]]:
    own = set(columns)
    return {"mapped": [s for s in schema if s in own], "missing": [s for s in schema if s not in own], "extra": [c for c in columns if c not in set(schema)]}


def conform(df: DataFrame, renames: Mapping[str, str] | None = None, schema: Sequence[str] = R.ALL_FIELDS) -> DataFrame:
    """Schema columns in order (missing ones empty), extras after them, nulls to ''."""
    to = resolve_columns(df.columns, renames or {}, schema)
    at: dict[str, str] = {}
    for c, n in to.items():
        at.setdefault(n, c)
    text = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    return df.select(*((text(at[s]) if s in at else F.lit("")).alias(s) for s in schema), *(text(c).alias(n) for n, c in at.items() if n not in set(schema)))


def company_column(columns: Sequence[str]) -> str | None:
    """``Client Folder``, else the first column whose name speaks of a company, client or folder."""
    if "Client Folder" in columns:
        return "Client Folder"
    return next((c for c in columns if any(w in c.lower() for w in ("company", "client", "folder"))), None)


def common_fields(golden: DataFrame, extracted: DataFrame) -> list[str]:
    return sorted(set(golden.columns) & set(extracted.columns) - set(R.METADATA))


def filter_company(df: DataFrame, pattern: str, company: str = "company") -> DataFrame:
    return df.filter(F.col(company).rlike(f"(?i){pattern}"))


GRAM = 3


def match_companies(golden: DataFrame, extracted: DataFrame, company: str = "company") -> DataFrame:
    """(golden company, extracted company): the golden name is contained in the extracted one, whatever the case.

    Names are made distinct first and meet by an equal key: the first ``GRAM`` characters of the golden name, which must be
    among the runs of as many characters of the extracted one. An empty name is contained in every name.
    """
    g = golden.select(F.col(company).alias("golden_company")).distinct().withColumn("g_", F.lower("golden_company"))
    e = extracted.select(F.col(company).alias("extracted_company")).distinct().withColumn("e_", F.lower("extracted_company"))

    def run(n: int) -> Column:
        return F.transform(F.sequence(F.lit(1), F.length("e_")), lambda i: F.substr(F.col("e_"), i, F.lit(n)))

    runs = [run(n) for n in range(1, GRAM + 1)]
    grams = F.when(F.length("e_") > 0, F.array_distinct(F.concat(F.array(F.lit("")), *runs))).otherwise(F.array(F.lit("")))
    met = g.withColumn("key_", F.substring("g_", 1, GRAM)).join(e.filter("e_ is not null").withColumn("key_", F.explode(grams)), "key_")
    return met.filter(F.col("e_").contains(F.col("g_"))).select("golden_company", "extracted_company")


def unpivot(df: DataFrame, ids: Sequence[str], fields: Sequence[str], name: str = "value") -> DataFrame:
    return df.unpivot([F.col(i) for i in ids], [F.col(f"`{f}`").cast("string").alias(f) for f in fields], "field", name)


def pair_rows(golden: DataFrame, extracted: DataFrame, order: str = "ord", company: str = "company") -> DataFrame:
    """(company, facility_index, matched, golden row g, extracted row e): the i-th with the i-th of the matched company.

    Golden rows beyond the extracted ones are left out; all rows of a company without a match stay, unmatched.
    """
    names = match_companies(golden, extracted, company)
    g = golden.withColumn(
        "facility_index", F.row_number().over(Window.partitionBy(company).orderBy(order)) - 1
    ).select(F.col(company).alias("golden_company"), "facility_index", F.struct("*").alias("g"))
    e = extracted.join(names, F.col(company) == F.col("extracted_company")).withColumn(
        "facility_index", F.row_number().over(Window.partitionBy("golden_company").orderBy("extracted_company", order)) - 1
    )
    e = e.select("golden_company", "facility_index", F.struct(*(c for c in extracted.columns)).alias("e"))
    known = names.select("golden_company").distinct().withColumn("matched", F.lit(True))
    rows = g.join(known, "golden_company", "left").join(e, ["golden_company", "facility_index"], "left")
    return rows.withColumn("matched", F.coalesce("matched", F.lit(False))).filter("not matched or e is not null").select(
        F.col("golden_company").alias("company"), "facility_index", "matched", "g", "e"
    )


def comparisons(golden: DataFrame, extracted: DataFrame, fields: Sequence[str], order: str = "ord", company: str = "company") -> DataFrame:
    """(company, facility_index, matched, field, golden, extracted, result): long, the fact table of all reports."""
    rows = pair_rows(golden, extracted, order, company)
    entry = F.array(
        *(
            F.struct(
                F.lit(f).alias("field"), F.col(f"g.`{f}`").cast("string").alias("golden"), F.col(f"e.`{f}`").cast("string").alias("extracted")
            ) for f in fields
        )
    )
    long = rows.select("company", "facility_index", "matched", F.explode(entry).alias("c")).select("company", "facility_index", "matched", "c.*")
    alone = F.when(N.is_empty("golden"), "both_missing").otherwise("golden_only")
    return long.withColumn("result", F.when(F.col("matched"), N.compare_values("golden", "extracted")).otherwise(alone))


def _counts() -> list[Column]:
    return [F.count_if(F.col("result") == o).alias(o) for o in OUTCOMES]


def accuracy() -> Column:
    n = F.col("exact_match") + F.col("fuzzy_match") + F.col("mismatch") + F.col("golden_only")
    return F.when(n > 0, (F.col("exact_match") + F.col("fuzzy_match")) / n)


def coverage() -> Column:
    n = F.col("exact_match") + F.col("fuzzy_match") + F.col("mismatch") + F.col("golden_only") + F.col("extracted_only")
    return F.when(n > 0, (F.col("exact_match") + F.col("fuzzy_match") + F.col("mismatch") + F.col("extracted_only")) / n).otherwise(0.0)


def percent(c: Column, digits: str = "0.0") -> Column:
    return F.concat(F.call_function("format_number", c * 100, F.lit(digits)), F.lit("%"))


def by_company(found: DataFrame) -> DataFrame:
    own = found.groupBy("company", "facility_index").agg(*_counts())
    return own.withColumn("accuracy", F.coalesce(accuracy(), F.lit(0.0))).withColumn("coverage", coverage())


def overall(found: DataFrame) -> DataFrame:
    own = found.agg(F.count_distinct("company", "facility_index").alias("rows_compared"), F.count(F.lit(1)).alias("fields_compared"), *_counts())
    return own.withColumn("accuracy", F.coalesce(accuracy(), F.lit(0.0)))


def by_field(found: DataFrame) -> DataFrame:
    """Companies without a match do not count here. Worst first; N/A last."""
    own = found.filter("matched").groupBy("field").agg(*_counts()).withColumn("share_", accuracy())
    shown = F.coalesce(percent(F.col("share_")), F.lit("N/A"))
    return own.withColumn("accuracy", shown).orderBy(F.expr("try_cast(replace(accuracy, '%', '') as double)").asc_nulls_last(), "field").drop("share_")


def mismatches(found: DataFrame, most: int | None = None) -> DataFrame:
    rows = found.filter("matched and result in ('mismatch', 'golden_only')").select("company", "facility_index", "field", "golden", "extracted", "result")
    return rows.orderBy("company", "facility_index", "field").limit(most) if most else rows


def field_coverage(rows: DataFrame, fields: Sequence[str]) -> DataFrame:
    """(field, coverage, level): share of rows with a value; EXTRACTION_ERROR counts as one."""
    n = [
        F.avg(
            F.when(F.col(f"`{f}`").isNull() | F.col(f"`{f}`").isin(*R.MISSING_IN_COVERAGE), 0.0).otherwise(100.0)
        ).alias(f"c{i}_") for i, f in enumerate(fields)
    ]
    one = rows.agg(*n)
    long = one.select(
        F.explode(
            F.array(*(F.struct(F.lit(f).alias("field"), F.coalesce(f"c{i}_", F.lit(0.0)).alias("coverage")) for i, f in enumerate(fields)))
        ).alias("s")
    ).select("s.*")
    return long.withColumn("level", F.when(F.col("coverage") < 30, "low").when(F.col("coverage") > 70, "high").otherwise("middle"))


def coverage_report(rows: DataFrame, fields: Sequence[str]) -> DataFrame:
    """One row: when, how many rows and fields, the average, coverage by field as JSON, and the fields of low and high coverage."""
    own = field_coverage(rows, fields)
    entry = F.array_sort(F.collect_list(F.struct("field", percent(F.col("coverage") / 100).alias("shown"))))
    named = lambda level: F.array_sort(F.collect_list(F.when(F.col("level") == level, F.col("field"))))
    out = own.agg(
        F.to_json(F.map_from_entries(entry)).alias("field_coverage"),
        percent(F.avg("coverage") / 100).alias("average_coverage"),
        named("low").alias("low_coverage_fields"),
        named("high").alias("high_coverage_fields"),
    )
    return out.crossJoin(rows.agg(F.count(F.lit(1)).alias("total_rows"))).select(F.current_timestamp().alias("timestamp"), "total_rows", F.lit(len(fields)).alias("total_fields"), "average_coverage", "field_coverage", "low_coverage_fields", "high_coverage_fields")  # one row by one


def comparison_report(found: DataFrame) -> dict[str, DataFrame]:
    """The report's parts, each a table of any size: summary, per field (worst first), per company, mismatches."""
    return {"summary": overall(found), "per_field_accuracy": by_field(found), "per_company": by_company(found), "mismatches_detail": mismatches(found)}
