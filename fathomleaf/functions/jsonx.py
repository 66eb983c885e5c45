"""Robust JSON of model answers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomleaf.functions.text import col

FIELD = T.StructType([T.StructField(n, T.StringType()) for n in ("value", "evidence", "confidence")])
FIELD_RESPONSE = T.StructType(
    [
        T.StructField("fields", T.MapType(T.StringType(), FIELD)),
        T.StructField("facilities_detected", T.ArrayType(T.StringType())),
        T.StructField("notes", T.StringType()),
    ]
)
FACILITY = T.StructType([T.StructField(n, T.StringType()) for n in ("name", "type", "amount", "characteristics")])
FACILITY_RESPONSE = T.StructType(
    [
        T.StructField("total_facilities", T.IntegerType()),
        T.StructField("facilities", T.ArrayType(FACILITY)),
        T.StructField("is_single_facility", T.BooleanType()),
        T.StructField("notes", T.StringType()),
    ]
)
CORRECTION = T.StructType(
    [
        T.StructField("original_value", T.StringType()),
        T.StructField("verified_value", T.StringType()),
        T.StructField("is_correct", T.BooleanType()),
        T.StructField("correction_reason", T.StringType()),
    ]
)
VERIFICATION = T.StructType(
    [
        T.StructField("verified_fields", T.MapType(T.StringType(), CORRECTION)),
        T.StructField("missing_information", T.ArrayType(T.StringType())),
        T.StructField("inconsistencies", T.ArrayType(T.StringType())),
    ]
)
MARKED, FENCED, BRACED = r"(?s)```json\s*(.*?)\s*```", r"(?s)```\s*(.*?)\s*```", r"(?s)\{.*\}"


def _valid(s: Column) -> Column:
    return F.when(F.call_function("try_parse_json", s).isNotNull(), s)


def _braced(s: Column) -> Column:
    """From the first brace on; a text without one gets one before it."""
    return F.when(s.startswith("{"), s).otherwise(F.concat(F.lit("{"), F.regexp_replace(s, r"(?s)^[^{]*\{", "")))


def json_text(response: Column | str) -> Column:
    """The JSON in an answer: the whole, else the first valid fenced block, else the widest braces; null if none parses."""
    s = col(response)

    def first(pattern: str, group: int) -> Column:
        found = F.transform(F.regexp_extract_all(s, F.lit(pattern), F.lit(group)), lambda x: _valid(_braced(x)))
        return F.get(F.filter(found, lambda x: x.isNotNull()), F.lit(0))

    return F.coalesce(_valid(s), first(MARKED, 1), first(FENCED, 1), first(BRACED, 0))


def parse(response: Column | str, schema: T.StructType) -> Column:
    return F.from_json(json_text(response), schema)


def entries(response: Column | str) -> Column:
    """Field name -> raw JSON of its entry; null where there is no object of fields."""
    return F.from_json(F.get_json_object(json_text(response), "$.fields"), T.MapType(T.StringType(), T.StringType()))


def schema_issues(response: Column | str, expected: Column) -> Column:
    """What is wrong with an answer, as messages in the order of the expected fields."""
    text = json_text(response)
    fields = F.get_json_object(text, "$.fields")
    own = F.from_json(fields, T.MapType(T.StringType(), T.StringType()))

    def check(name: Column) -> Column:
        raw = F.try_element_at(own, name)
        keys = F.json_object_keys(raw)
        quoted = F.concat(F.lit("Field '"), name, F.lit("'"))
        missing = F.array_compact(
            F.array(*(F.when(~F.array_contains(keys, k), F.concat(quoted, F.lit(f" missing '{k}' key"))) for k in ("value", "confidence")))
        )
        return F.when(
            ~F.array_contains(F.map_keys(own), name), F.array(F.concat(F.lit("Missing field: "), name))
        ).when(keys.isNull(), F.array(F.concat(quoted, F.lit(" is not a dict")))).otherwise(missing)

    return (
        F.when(text.isNull() | ~text.rlike(r"(?s)^\s*\{"), F.array(F.lit("Result is not a dict")))
        .when(fields.isNull(), F.array(F.lit("Missing 'fields' key")))
        .when(~fields.rlike(r"(?s)^\s*\{"), F.array(F.lit("'fields' is not a dict")))
        .otherwise(F.flatten(F.transform(expected, check)))
    )


def _overlap(a: Column, b: Column) -> Column:
    x, y = F.lower(a), F.lower(b)
    words = lambda c: F.array_distinct(F.filter(F.split(c, r"\s+"), lambda w: w != ""))
    return F.size(F.array_intersect(words(x), words(y))) + F.when(x.startswith(y) | y.startswith(x), 3).otherwise(0)


def remap(present: Column, expected: Column) -> Column:
    """Expected field -> the unexpected key that stands for it.

    Fields in their given order each take the best key left, by common words and three more for a common start, of at
    least two; the first in alphabetical order of equals. At most as many steps as fields.
    """
    spare = F.array_sort(F.array_except(present, expected))
    pair = T.StructType([T.StructField("field", T.StringType()), T.StructField("key", T.StringType())])
    start = F.struct(spare.alias("left"), F.array().cast(T.ArrayType(pair)).alias("found"))

    def step(state: Column, name: Column) -> Column:
        scored = F.transform(state["left"], lambda k: F.struct((-_overlap(name, k)).alias("score"), k.alias("key")))
        best = F.array_min(F.filter(scored, lambda s: s["score"] <= -2))
        return F.when(best.isNull(), state).otherwise(
            F.struct(
                F.array_remove(state["left"], best["key"]).alias("left"),
                F.array_append(state["found"], F.struct(name.alias("field"), best["key"].alias("key"))).alias("found"),
            )
        )

    return F.map_from_entries(F.aggregate(F.array_except(expected, present), start, step)["found"])
