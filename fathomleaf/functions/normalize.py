"""Canonical forms of dates, percentages, ratios and yes/no, and the comparison of two values. Columns only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fathomleaf import registry as R
from fathomleaf.functions.text import col, strip

# Months in the order in which they are looked for.
MONTHS = [
    ("january", 1),
    ("jan", 1),
    ("february", 2),
    ("feb", 2),
    ("march", 3),
    ("mar", 3),
    ("april", 4),
    ("apr", 4),
    ("may", 5),
    ("june", 6),
    ("jun", 6),
    ("july", 7),
    ("jul", 7),
    ("august", 8),
    ("aug", 8),
    ("september", 9),
    ("sep", 9),
    ("sept", 9),
    ("october", 10),
    ("oct", 10),
    ("november", 11),
    ("nov", 11),
    ("december", 12),
    ("dec", 12),
]
NUMBER = r"(\d+(?:\.\d+)?)"
YES, NO = ["yes", "true", "y", "affirmative", "confirmed", "applicable"], ["no", "false", "n", "negative", "not applicable", "n/a", "none"]


def _found(c: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match, or null."""
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def _fixed(number: Column) -> Column:
    """Two decimals, rounded from the exact binary value."""
    return F.call_function("format_number", number, F.lit("0.00"))


def _passes(c: Column) -> Column:
    return c.isNull() | c.isin(*R.MISSING_IN_NORMALISER)


def _first(*cases: Column) -> Column:
    return F.coalesce(*cases)


def _named_month(low: Column, months: list[tuple[str, int]]) -> Column:
    """(month, year) of the month name that comes first in ``months`` and has blanks and a year after it, or null.

    No name ends another one, so each year has one name at most; of equal names the first place counts.
    """
    pattern = F.lit("(" + "|".join(m for m, _ in months) + r")\s+(\d{4})")
    names, years = (F.regexp_extract_all(low, pattern, F.lit(g)) for g in (1, 2))
    known = F.array(*(F.lit(m) for m, _ in months))
    best = F.array_min(F.transform(names, lambda n, i: F.struct(F.array_position(known, n).alias("place"), i.alias("i"), F.get(years, i).alias("year"))))
    return F.when(
        best.isNotNull(),
        F.struct(F.element_at(F.array(*(F.lit(n) for _, n in months)), best["place"].cast("int")).alias("month"), best["year"].alias("year")),
    )


def normalize_date(value: Column | str) -> Column:
    """MM/YYYY; what fits no form is only stripped. ISO months are not checked, as ever."""
    raw = col(value)
    s = strip(raw)
    low = F.lower(s)
    found = _named_month(low, MONTHS)
    named = F.when(found.isNotNull(), F.concat(F.lpad(found["month"].cast("string"), 2, "0"), F.lit("/"), found["year"]))
    month_year = _month(s, r"^(\d{1,2})/(\d{4})$", 1, 2)
    iso = F.when(
        s.rlike(r"^\d{4}-\d{1,2}"),
        F.concat(F.lpad(F.regexp_extract(s, r"^(\d{4})-(\d{1,2})", 2), 2, "0"), F.lit("/"), F.regexp_extract(s, r"^(\d{4})-(\d{1,2})", 1)),
    )
    day_first = _month(s, r"^\d{1,2}/(\d{1,2})/(\d{4})", 1, 2)
    quarter = r"(?i)Q([1-4])\s+(\d{4})"
    quarters = F.when(
        s.rlike(quarter),
        F.concat(F.lpad((F.regexp_extract(s, quarter, 1).try_cast("int") * 3).cast("string"), 2, "0"), F.lit("/"), F.regexp_extract(s, quarter, 2)),
    )
    return F.when(_passes(raw), raw).otherwise(_first(month_year, named, iso, day_first, quarters, s))


def _month(s: Column, pattern: str, month: int, year: int) -> Column:
    m = F.regexp_extract(s, pattern, month)
    return F.when(s.rlike(pattern) & m.try_cast("int").between(1, 12), F.concat(F.lpad(m, 2, "0"), F.lit("/"), F.regexp_extract(s, pattern, year)))


def normalize_percentage(value: Column | str) -> Column:
    raw = col(value)
    s = strip(raw)
    points = _found(s, rf"(?i){NUMBER}\s*(?:bps|bp|basis\s+points?)")
    percent = _found(s, rf"(?i){NUMBER}\s*(?:per\s*cent|percent|%)")
    return F.when(_passes(raw), raw).otherwise(
        _first(F.concat(_fixed(points.try_cast("double") / 100), F.lit("%")), F.concat(_fixed(percent.try_cast("double")), F.lit("%")), s)
    )


def normalize_ratio(value: Column | str) -> Column:
    raw = col(value)
    s = strip(raw)
    number = _first(_found(s, rf"(?i)^{NUMBER}x$"), _found(s, rf"{NUMBER}\s*:\s*1"), _found(s, rf"(?i){NUMBER}\s+to\s+1"))
    return F.when(_passes(raw), raw).otherwise(F.coalesce(F.concat(_fixed(number.try_cast("double")), F.lit("x")), s))


def normalize_amount(value: Column | str) -> Column:
    return F.when(_passes(col(value)), col(value)).otherwise(strip(value))


def normalize_yes_no(value: Column | str) -> Column:
    raw = col(value)
    s = strip(raw)
    low = F.lower(s)
    return F.when(_passes(raw), raw).when(low.isin(*YES), "Yes").when(low.isin(*NO), "No").when(
        low.startswith("yes"), "Yes"
    ).when(low.startswith("no"), "No").otherwise(s)


def normalize_value(kind: Column, value: Column | str) -> Column:
    """Dispatch by the field's kind."""
    raw = col(value)
    skip = _passes(raw) | (raw == "EXTRACTION_ERROR")
    return F.when(skip, raw).when(kind == "date", normalize_date(raw)).when(
        kind == "percentage", normalize_percentage(raw)
    ).when(kind == "ratio", normalize_ratio(raw)).when(kind == "yes_no", normalize_yes_no(raw)).otherwise(strip(raw))


def normalize_row(row: Column | str) -> Column:
    """A map of field -> value with every value in its canonical form."""
    kinds = F.create_map(*(F.lit(x) for kv in R.KIND_OF.items() for x in kv))
    return F.transform_values(col(row), lambda k, v: normalize_value(F.coalesce(F.try_element_at(kinds, k), F.lit("text")), v))


def is_empty(value: Column | str) -> Column:
    return col(value).isNull() | strip(value).isin(*R.MISSING_IN_COMPARISON)


def for_comparison(value: Column | str) -> Column:
    s = F.lower(strip(F.coalesce(col(value), F.lit(""))))
    return F.regexp_replace(F.regexp_replace(s, r"(?U)[,;.\s]+$", ""), r"(?U)\s+", " ")


def first_number(value: Column | str) -> Column:
    return _found(F.regexp_replace(col(value), r"(?U)[€$£¥,\s]", ""), NUMBER).try_cast("double")


def numbers_match(a: Column | str, b: Column | str) -> Column:
    x, y = first_number(a), first_number(b)
    near = F.abs(x - y) / F.greatest(F.abs(x), F.abs(y)) < 0.01
    return F.when(x.isNull() | y.isNull(), False).when((x == 0) & (y == 0), True).when((x == 0) | (y == 0), False).otherwise(near)


def month_year(s: Column) -> Column:
    """month + 100 * year of a lower-cased value, or null."""

    def at(pattern: str, month: int, year: int) -> Column:
        return F.when(s.rlike(pattern), F.regexp_extract(s, pattern, month).try_cast("int") + 100 * F.regexp_extract(s, pattern, year).try_cast("int"))

    found = _named_month(s, _BY_MONTH)
    return _first(at(r"^(\d{1,2})/(\d{4})", 1, 2), at(r"^(\d{4})-(\d{1,2})", 2, 1), found["month"] + 100 * found["year"].try_cast("int"))


_BY_MONTH = sorted(MONTHS, key=lambda m: (m[1], len(m[0])))


def ratio(s: Column) -> Column:
    return _first(_found(s, rf"^{NUMBER}x"), _found(s, rf"^{NUMBER}\s*:\s*1")).try_cast("double")


def compare_values(golden: Column | str, extracted: Column | str) -> Column:
    """One of exact_match, fuzzy_match, mismatch, both_missing, golden_only, extracted_only."""
    g, e = for_comparison(golden), for_comparison(extracted)
    no_g, no_e = is_empty(golden), is_empty(extracted)
    yes, no = ["yes", "true", "y"], ["no", "false", "n"]
    return (
        F.when(no_g & no_e, "both_missing").when(no_g, "extracted_only").when(no_e, "golden_only")
        .when(g == e, "exact_match")
        .when(e.contains(g) | g.contains(e), "fuzzy_match")
        .when(numbers_match(golden, extracted), "fuzzy_match")
        .when((g.isin(yes) & e.isin(yes)) | (g.isin(no) & e.isin(no)), "exact_match")
        .when(month_year(g) == month_year(e), "fuzzy_match")
        .when(F.abs(ratio(g) - ratio(e)) < 0.01, "fuzzy_match")
        .otherwise("mismatch")
    )
