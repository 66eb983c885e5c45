"""Second attempts at missing fields, and consistency rules between fields."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomleaf import registry as R
from fathomleaf.config import EngineConfig
from fathomleaf.functions import text as X


@dataclass(frozen=True)
class Strategy:
    keywords: tuple[str, ...]
    contexts: tuple[str, ...]
    value: str


_MONTHS = r"(\d{1,2}[\/\-]\d{4}|\d{4}[\/\-]\d{1,2}|\w+\s+\d{4})"
# Keywords, context patterns and value patterns by field.
STRATEGIES = {
    "Borrower name": Strategy(
        ("borrower", "company", "obligor", "debtor"),
        (r'("the borrower"|"borrower means"|borrower:?\s*)', r'("the company"|company name)'),
        r"(?:borrower|company|obligor)[\s:]*([A-Z][A-Za-z\s&.,]+(?:Ltd|LLC|Inc|Corp|B\.V\.|S\.A\.|GmbH|Plc)?)",
    ),
    "Credit limit ['000]": Strategy(
        ("credit", "limit", "facility", "amount", "commitment", "aggregate"),
        (r"(credit limit|facility amount|aggregate commitment|total commitment)",),
        r"(?:EUR|USD|GBP|\$|€|£)\s*[\d,]+(?:\.\d+)?(?:\s*(?:million|m|bn|billion))?",
    ),
    "Spread [%]": Strategy(
        ("spread", "margin", "basis points", "bps", "plus"),
        (r"(applicable margin|interest margin|margin means|spread of)",),
        r"(\d+(?:\.\d+)?)\s*(?:%|percent|basis points|bps)",
    ),
    "Maturity date [MM/YYYY] of the facility": Strategy(
        ("maturity", "termination", "final", "expiry", "repayment date"), (r"(final maturity|termination date|maturity date|facility ends)",), _MONTHS
    ),
    "Base Rate of the facility": Strategy(
        ("EURIBOR", "SOFR", "LIBOR", "base rate", "reference rate", "benchmark"),
        (r"(reference rate|base rate|benchmark rate)",),
        r"(EURIBOR|SOFR|LIBOR|SONIA|ESTR|Term SOFR)",
    ),
    "Inception date [MM/YYYY] of the facility": Strategy(
        ("inception", "signing", "effective date", "commencement", "dated"), (r"(effective date|signing date|dated as of|entered into)",), _MONTHS
    ),
    "Project location [Country]": Strategy(
        ("location", "country", "jurisdiction", "situated", "located"),
        (r"(located in|situated in|project location|jurisdiction)",),
        r"(Spain|Germany|France|Netherlands|UK|United"
        r" Kingdom|Italy|Poland|Belgium|Portugal|Ireland|Greece|Austria|Sweden|Denmark|Norway|Finland|Czech|Romania|Hungary|Bulgaria|Croatia|Slovakia|Slovenia|Luxembourg|Estonia|Latvia|Lithuania|Cyprus|Malta)",
    ),
    "Covenant leading to dividend lock-up: Backward-looking DSCR (B-DSCR)": Strategy(
        ("DSCR", "debt service coverage", "backward", "historical", "covenant"),
        (r"(historical DSCR|backward.looking DSCR|DSCR covenant|debt service coverage ratio)",),
        r"(\d+(?:\.\d+)?)[:\s]*(?:1|x|times)",
    ),
    "ING share [%]": Strategy(
        ("ING", "commitment", "share", "participation", "proportion"), (r"(ING Bank|ING's commitment|ING participation)",), r"(\d+(?:\.\d+)?)\s*%"
    ),
}


def open_fields(extractions: DataFrame) -> DataFrame:
    """What a second attempt may better, with ``late_``: 0 for POSSIBLY_PRESENT, 1 for missing or LOW."""
    maybe = F.col("value") == "POSSIBLY_PRESENT"
    lost = F.coalesce("value", F.lit("")).isin(*R.MISSING_IN_DEEP) | (F.coalesce("confidence", F.lit("LOW")) == "LOW")
    return extractions.withColumn("late_", F.when(maybe, 0).when(lost, 1)).filter("late_ is not null")


def deep_targets(extractions: DataFrame, fields: DataFrame, config: EngineConfig = EngineConfig()) -> DataFrame:
    """(company, facility_idx, field, priority): POSSIBLY_PRESENT first, then missing or LOW, in registry order, the first 20."""
    rows = open_fields(extractions).join(F.broadcast(fields.select("field", "ord")), "field")
    n = F.row_number().over(Window.partitionBy("company", "facility_idx").orderBy("late_", "ord"))
    return rows.withColumn("priority", n).filter(F.col("priority") <= config.deep_fields_per_facility).select("company", "facility_idx", "field", "priority")


def candidates_of(text: str, strategy: Strategy) -> list[str]:
    """Values near a context match, in the order of their first places."""
    out: dict[str, None] = {}
    for pattern in strategy.contexts:
        for m in re.finditer(pattern, text, re.I):
            for v in re.findall(strategy.value, text[max(0, m.start() - 100) : m.end() + 200], re.I):
                out.setdefault(v if isinstance(v, str) else v[0])
    return list(out)


def pattern_candidates(docs: DataFrame, key: str = "company", text_col: str = "full_text", strategies: dict[str, Strategy] = STRATEGIES) -> DataFrame:
    """(key, field, candidates). Places of matches are not visible to SQL patterns, so this is Python, row by row."""
    found = T.ArrayType(T.StructType([T.StructField("field", T.StringType()), T.StructField("candidates", T.ArrayType(T.StringType()))]))
    # As for model calls: a hundred rows at a time, not whole frames of texts.
    match = F.udf(lambda text: [(f, c) for f, s in strategies.items() if (c := candidates_of(text or "", s))], found, useArrow=False)
    match = match.asNondeterministic()  # else the filter that explode implies is pushed below, and texts are matched twice
    return docs.select(key, match(text_col).alias("found_")).select(key, F.explode("found_").alias("f_")).select(key, "f_.field", "f_.candidates")


def field_candidates(contexts: DataFrame, strategies: dict[str, Strategy] = STRATEGIES) -> DataFrame:
    """(company, field, candidates) of contexts (company, field, text): each by its own field's patterns, none for other fields."""
    match = F.udf(lambda f, t: candidates_of(t or "", strategies[f]) if f in strategies else [], T.ArrayType(T.StringType()), useArrow=False)
    text = F.when(F.col("field").isin(*strategies), F.col("text"))  # texts of other fields stay in the JVM
    return contexts.select("company", "field", match("field", text).alias("candidates"))


def with_table_values(candidates: DataFrame, found: DataFrame) -> DataFrame:
    """``candidates`` with the value of a table (company, field, value) put first, unless it is among them."""
    rows = candidates.join(found.select("company", "field", F.col("value").alias("cell_")), ["company", "field"], "left")
    new = F.col("cell_").isNotNull() & ~F.array_contains("candidates", F.col("cell_"))
    return rows.select("company", "field", F.when(new, F.concat(F.array("cell_"), "candidates")).otherwise(F.col("candidates")).alias("candidates"))


FIELDS_AT_MOST = 500


def table_lookup(docs: DataFrame, fields: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """(keys, field, value, line): on the first line that names a field, the cell after the one that names it.

    Names are looked for in lower case, without marks, and (as ever) without spaces but with capitals, which never match
    a lower-cased line unless the name has none. ``fields``: (field), a bounded table.
    """
    names = sorted(r[0] for r in fields.select("field").distinct().limit(FIELDS_AT_MOST + 1).collect())
    if len(names) > FIELDS_AT_MOST:
        raise ValueError(f"more than {FIELDS_AT_MOST} fields")
    variants = [(f, n, v) for f in names for n, v in enumerate((f.lower(), f.replace(" ", ""), re.sub(r"[^\w\s]", "", f).lower()))]
    rows = docs.select(
        *keys, F.posexplode(X.lines(text_col)).alias("line_no", "line")
    ).filter(F.col("line").rlike(r"[|:\t]")).withColumn("low_", F.lower("line"))
    # One pass over the lines: those that hold any variant go on with the ones that they hold; no join.
    rows = rows.filter(F.col("low_").rlike("|".join(re.escape(v) for v in sorted({v for *_, v in variants}))))
    held = F.array_compact(
        F.array(
            *(
                F.when(
                    F.col("low_").contains(v), F.struct(F.lit(f).alias("field"), F.lit(n).alias("variant_no"), F.lit(v).alias("variant"))
                ) for f, n, v in variants
            )
        )
    )
    cells = rows.select(*keys, "line_no", "line", F.explode_outer(held).alias("v_")).filter("v_ is not null").select(
        *keys, "v_.field", "line_no", "line", "v_.variant_no", "v_.variant", F.split("line", r"[|:\t]", -1).alias("cells_")
    )
    cells = cells.select(*keys, "field", "line_no", "line", "variant_no", "variant", "cells_", F.posexplode("cells_").alias("cell_no", "cell"))
    value = X.strip(F.get(F.col("cells_"), F.col("cell_no") + 1))
    cells = cells.filter(
        F.lower("cell").contains(F.col("variant"))
    ).withColumn("value", value).filter("value is not null").filter(~F.lower("value").isin("", "n/a", "nan"))
    order = F.struct("line_no", "variant_no", "cell_no")
    return cells.groupBy(*keys, "field").agg(F.min_by("value", order).alias("value"), F.min_by("line", order).alias("line"))


def replace_found(extractions: DataFrame, found: DataFrame) -> DataFrame:
    """Any accepted value of a second attempt replaces the first, whatever its confidence."""
    good = found.filter(~F.coalesce("value", F.lit("")).isin("NOT_FOUND", "N/A", "", "POSSIBLY_PRESENT")).select(
        "company", "facility_idx", "field", F.struct("value", "evidence", "confidence").alias("new_")
    )
    keep = [c for c in extractions.columns if c not in ("value", "evidence", "confidence")]
    rows = extractions.join(good, ["company", "facility_idx", "field"], "left")
    return rows.select(*keep, *(F.coalesce(f"new_.{c}", c).alias(c) for c in ("value", "evidence", "confidence")))


# --- consistency -----------------------------------------------------------------------------------------------------

_RATIOS = [f for f in R.FIELDS if f.startswith("Covenant leading to dividend lock-up: ")][2:7]
# A yes/no field, the field that must go with it, other details that speak for Yes, and the names in messages.
PAIRS = [
    ("If D&C Contractor specified?", "Name of the D&C Contractor", [], "D&C Contractor", "name"),
    ("If completion guarantees specified?", "Guarantee Development sponsors name", [], "Completion guarantees", "guarantor name"),
    (
        "If revenue mitigating factors specified?",
        "Type of mitigating factor",
        ["Contractual or regulatory factor guarantor"],
        "Revenue mitigating factors",
        "type",
    ),
    ("Is a Sponsor linked to the project?", "Sponsor Name", [], "Sponsor", "sponsor name"),
    ("Is a HoldCo linked to the project?", "Name of the HoldCo linked to the project", [], "HoldCo", "HoldCo name"),
    ("Is there a cash sweep mechanism applicable to the facility?", "Cash sweep structure", [], "Cash sweep", "structure"),
]
RULE_FIELDS = list(dict.fromkeys([
    "Is facility syndicated?",
    "ING share [%]",
    "Hedging: is the facility hedged?",
    "Hedging: how is the facility hedged",
    "Hedging: notional",
    "Hedging: fixed rate",
    "Hedging: spread",
    "Readiness [In operation / Construction needed]",
    "If construction needed: Readiness year",
    "If covenants specified?",
    *_RATIOS,
    *(x for p in PAIRS for x in (p[0], p[1], *p[2])),
    "Base Rate of the facility",
    "Fix interest rate [%]",
    "Spread [%]",
    "Inception date [MM/YYYY] of the facility",
    "Maturity date [MM/YYYY] of the facility",
]))


def rules(v) -> list[tuple[int, Column, str, str | None]]:
    """(rule, condition, issue, field to set to Yes). ``v(field)`` is its value, '' where missing."""
    yes = lambda f: F.lower(X.strip(v(f))) == "yes"
    no = lambda f: F.lower(X.strip(v(f))) == "no"
    has = lambda f: v(f) != ""
    some = lambda fs: F.greatest(*(has(f).cast("int") for f in fs), F.lit(0)) == 1
    ready, year = "Readiness [In operation / Construction needed]", "If construction needed: Readiness year"
    hedged, cov = "Hedging: is the facility hedged?", "If covenants specified?"
    details = ["Hedging: how is the facility hedged", "Hedging: fixed rate", "Hedging: notional", "Hedging: spread"]
    base, fixed, spread = "Base Rate of the facility", "Fix interest rate [%]", "Spread [%]"
    start, end = (
        F.regexp_extract(v(f), r"(\d{4})", 1).try_cast("int") for f in (
            "Inception date [MM/YYYY] of the facility", "Maturity date [MM/YYYY] of the facility"
        )
    )
    building = F.lower(v(ready)).contains("construction")
    out = [
        (1, yes("Is facility syndicated?") & ~has("ING share [%]"), "syndicated without a share", None),
        (2, yes(hedged) & (~has(details[0]) | ~has(details[2])), "hedged without details", None),
        (2, no(hedged) & some(details), "not hedged but with details", None),
        (3, building & ~has(year), "construction without a year", None),
        (3, ~building & F.lower(v(ready)).contains("operation") & has(year), "in operation but with a year", None),
        (4, yes(cov) & ~some(_RATIOS), "covenants without a ratio", None),
        (4, no(cov) & some(_RATIOS[:4]), "no covenants but with a ratio", cov),
    ]
    for i, (flag, name, more, label, what) in enumerate(PAIRS):
        out += [
            (5 + i, yes(flag) & ~has(name), f"{label}=Yes without {what}", None),
            (5 + i, no(flag) & some([name, *more]), f"{label}=No but details found", flag),
        ]
    return [
        *out,
        (11, has(base) & has(fixed), "base rate and fixed rate", None),
        (11, has(base) & ~has(spread), "base rate without a spread", None),
        (12, end < start, "maturity before inception", None),
    ]


def cross_reference(extractions: DataFrame) -> DataFrame:
    """(company, facility_idx, issues, fixes): the twelve rules over a facility's fields, one aggregate and no join."""
    ids = {f: f"f{i}_" for i, f in enumerate(RULE_FIELDS)}
    value = F.when(F.col("value").isNull() | F.col("value").isin(*R.MISSING_IN_RULES), "").otherwise(F.col("value"))
    wide = extractions.groupBy("company", "facility_idx").agg(
        *(F.coalesce(F.max(F.when(F.col("field") == f, value)), F.lit("")).alias(c) for f, c in ids.items())
    )
    found = rules(lambda f: F.col(ids[f]))
    issues = F.array_compact(F.array(*(F.when(cond, F.concat(F.lit(f"{n}: "), F.lit(text))) for n, cond, text, _ in found)))
    fixes = F.array_compact(F.array(*(F.when(cond, F.lit(fix)) for _, cond, _, fix in found if fix)))
    return wide.select("company", "facility_idx", issues.alias("issues"), fixes.alias("fixes"))


def auto_fix(extractions: DataFrame, checked: DataFrame) -> DataFrame:
    """Set the fields that the rules set to Yes, noting what was there."""
    fixes = checked.select("company", "facility_idx", F.explode("fixes").alias("field")).withColumn("fix_", F.lit(True))
    keep = [c for c in extractions.columns if c not in ("value", "evidence", "confidence")]
    rows = extractions.join(fixes, ["company", "facility_idx", "field"], "left")
    hit = F.coalesce("fix_", F.lit(False))
    return rows.select(
        *keep, F.when(hit, "Yes").otherwise(F.col("value")).alias("value"),
        F.when(hit, F.concat(F.coalesce("evidence", F.lit("")), F.lit(" [AUTO-FIXED from "), F.coalesce("value", F.lit("")), F.lit("]")))
        .otherwise(F.col("evidence"))
        .alias("evidence"),
        F.when(hit, "MEDIUM").otherwise(F.col("confidence")).alias("confidence"),
    )
