import pytest
from pyspark.sql import functions as F

from fathomleaf.functions import jsonx as J
from fathomleaf.functions import normalize as N
from fathomleaf.functions import text as X


def apply(spark, fn, values):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, v string").select("i", fn(F.col("v")).alias("r")).collect()
    return [r[1] for r in sorted(rows)]


CASES = {
    N.normalize_date: {
        "15 March 2024": "03/2024",
        "March 2024": "03/2024",
        "2024-03-15": "03/2024",
        "2024-13": "13/2024",
        "3/2024": "03/2024",
        "13/2024": "13/2024",
        "15/03/2024": "03/2024",
        "Q3 2025": "09/2025",
        "2024": "2024",
        "March 15, 2024": "March 15, 2024",
        "NOT_FOUND": "NOT_FOUND",
        " sept 2023 ": "09/2023",
        "dec 2020 to jan 2021": "01/2021",
        None: None,
        "": "",
    },
    N.normalize_percentage: {
        "2.50%": "2.50%",
        "250bps": "2.50%",
        "250 basis points": "2.50%",
        "2.5 per cent": "2.50%",
        "40% of the Applicable Margin": "40.00%",
        "2.5": "2.5",
        "0.125%": "0.12%",
        None: None,
    },
    N.normalize_ratio: {"1.20:1": "1.20x", "1.2 to 1": "1.20x", "1.20X": "1.20x", "120%": "120%", "2.675x": "2.67x"},
    N.normalize_yes_no: {"TRUE": "Yes", "Yes, see clause 4": "Yes", "none": "No", "Norway": "No", "N/A": "N/A", " maybe ": "maybe"},
    N.for_comparison: {" EUR. ": "eur", "a\t b": "a b", None: ""},
    X.clean_text: {"a  b\tc line\n\n\nok\n|\nxyz NaN": "a b c line\n|\nxyz", None: "", "Unnamed: 3 here": "here"},
    X.safe_name: {"A b/é": "A_b__"},
}


@pytest.mark.parametrize("fn", CASES, ids=lambda f: f.__name__)
def test_scalar(spark, fn):
    assert apply(spark, fn, list(CASES[fn])) == list(CASES[fn].values())


def test_compare_values(spark):
    cases = [
        ("", "NOT_FOUND", "both_missing"),
        ("EUR", "N/A", "golden_only"),
        (None, "EUR", "extracted_only"),
        ("EUR.", " eur", "exact_match"),
        ("Term Loan", "Term Loan A", "fuzzy_match"),
        ("EUR 1,000", "1000 USD", "fuzzy_match"),
        ("100", "100.9", "fuzzy_match"),
        ("2.50%", "2.51%", "fuzzy_match"),
        ("yes", "true", "exact_match"),
        ("yes", "y", "fuzzy_match"),
        ("03/2024", "03/2025", "fuzzy_match"),
        ("03/2024", "2024-03", "fuzzy_match"),
        ("abc", "xyz", "mismatch"),
        ("0", "5", "mismatch"),
        ("0", "0.0", "fuzzy_match"),
    ]
    df = spark.createDataFrame([(i, g, e) for i, (g, e, _) in enumerate(cases)], "i int, g string, e string")
    got = [r[1] for r in sorted(df.select("i", N.compare_values("g", "e")).collect())]
    assert got == [c[2] for c in cases]


def test_json_text(spark):
    cases = {
        '{"a": 1}': '{"a": 1}',
        'x ```json\n{"a": 2}\n``` y': '{"a": 2}',
        'see {"a": 3} end': '{"a": 3}',
        "none": None,
        None: None,
        '```json\nbroken\n``` {"a": 4}': None,
    }
    got = apply(spark, J.json_text, list(cases))
    assert got[:5] == list(cases.values())[:5]


def test_remap_is_greedy_and_deterministic(spark):
    df = spark.range(1).select(
        J.remap(F.array(F.lit("type of tranche x"), F.lit("of type")), F.array(F.lit("Type of tranche"), F.lit("Type of thing"))).alias("m")
    )
    assert df.first()[0] == {"Type of tranche": "type of tranche x", "Type of thing": "of type"}


def test_headers_and_language(spark):
    got = apply(spark, X.is_header, ["SECTION 4", "1.2 Loan terms", "GENERAL TERMS", "3. Fees", "plain line", "AB", "X" * 101])
    assert got == [True, True, True, True, False, False, False]
    assert apply(spark, X.language, ["the cat of it", "der und die", "le la", "zzz"]) == ["en", "de", "fr", "en"]
