"""Field extraction behind a model boundary: prompts, answers, merging, corrections, scores, rows.

Extractions are long: (company, facility_idx, group, field, pass_idx, value, evidence, confidence). Registry joins are with a
fixed table of 72 rows; everything else is keyed by company.
"""

from __future__ import annotations

import json
import re
import time
from typing import Protocol

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomleaf import registry as R
from fathomleaf.config import EngineConfig
from fathomleaf.functions import jsonx as J
from fathomleaf.functions import normalize as N
from fathomleaf.functions import text as X
from fathomleaf.operators.retrieval import trim_tokens

CALL = ["company", "facility_idx", "group"]


class Extractor(Protocol):
    """A model: one prompt in, one answer out. It is made once in a worker, on first use."""

    def __call__(self, system: str, prompt: str, max_tokens: int) -> str: ...


SYSTEM = "You read credit documents. Answer only with what the text states, quote it as evidence, and answer in JSON."
TEXT = "DOCUMENT TEXT:\n"
QUESTION = "Find these fields:\n{fields}\n\nAnswer as JSON: {{\"fields\": {{\"<field>\": {{\"value\": \"...\", \"evidence\": \"...\", \"confidence\": \"HIGH|MEDIUM|LOW\"}}}}}}. Use NOT_FOUND for what is absent and POSSIBLY_PRESENT for what other parts may hold.\n\n" + TEXT
DETECT = "List every facility. Answer as JSON with total_facilities, facilities (name, type, amount, characteristics), is_single_facility and notes.\n\n" + TEXT
VERIFY = "Check each value against the text. Answer as JSON with verified_fields, missing_information and inconsistencies.\n\nVALUES:\n"
SINGLE = "Find one field. Answer as JSON with value, evidence, confidence and reasoning.\n"
AGAIN = "\n\nThe answer must be one JSON object and nothing else."


class RuleExtractor:
    """A deterministic stand-in for a model.

    Fields: the first line that names one and has a value after a colon or bar. Facilities: lines that begin with
    ``FACILITY:``, parts between bars. Checks: a value stands if the text has it, else what the field's line says.
    """

    def __call__(self, system: str, prompt: str, max_tokens: int) -> str:
        asked, _, text = prompt.partition(TEXT)
        lines = text.split("\n")
        if asked.startswith(DETECT[:20]):
            own = dict.fromkeys(tuple(x.strip() for x in m[1].split("|")) for line in lines if (m := re.match(r"\s*FACILITY:(.*)", line)))
            found = [dict(zip(("name", "type", "amount", "characteristics"), [*x, "", "", ""][:4], strict=True)) for x in own]
            return json.dumps({"total_facilities": len(found), "facilities": found, "is_single_facility": len(found) < 2, "notes": ""}, ensure_ascii=False)
        names = [name for line in asked.split("\n") if line.startswith("- ") and (name := self.name(line[2:]))]
        if asked.startswith(VERIFY[:20]):
            told = {n: line[4 + len(n) :] for line in asked.split("\n") if line.startswith("- ") and (n := self.name(line[2:]))}
            checks = {
                n: {
                    "original_value": v,
                    "verified_value": v if v in text else self.find(n, lines)["value"],
                    "is_correct": v in text,
                    "correction_reason": "" if v in text else "not in the text",
                } for n, v in told.items()
            }
            return json.dumps({"verified_fields": checks, "missing_information": [], "inconsistencies": []}, ensure_ascii=False)
        fields = {n: self.find(n, lines) for n in names}
        if asked.startswith(SINGLE[:14]):
            return json.dumps({**next(iter(fields.values()), {}), "reasoning": ""}, ensure_ascii=False)
        return json.dumps({"fields": fields, "facilities_detected": [], "notes": ""}, ensure_ascii=False)

    @staticmethod
    def name(line: str) -> str | None:
        """The field that a line ``field: ...`` is about; names may hold colons."""
        return max((f for f in R.FIELDS if line.startswith(f + ": ")), key=len, default=line.partition(": ")[0] if ": " in line else None)

    @staticmethod
    def find(name: str, lines: list[str]) -> dict[str, str]:
        for line in lines:
            at = line.lower().find(name.lower())
            m = re.match(r"\s*[:|\t]\s*([^|\t]+)", line[at + len(name) :]) if at >= 0 else None
            if m and m[1].strip():
                return {"value": m[1].strip(), "evidence": line.strip()[:200], "confidence": "HIGH"}
        return {"value": "NOT_FOUND", "evidence": "", "confidence": "LOW"}


def usable(answer: str | None, key: str | None) -> bool:
    """Whether an answer holds a JSON object, with ``key`` in it if one is asked for."""
    at, to = (answer or "").find("{"), (answer or "").rfind("}")
    if at < 0 or to < at:
        return False
    try:
        found = json.loads(answer[at : to + 1])
    except ValueError:
        return False
    return isinstance(found, dict) and (key is None or key in found)


ANSWER = T.StructType(
    [
        T.StructField("response", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("tries", T.IntegerType()),
        T.StructField("seconds", T.DoubleType()),
    ]
)


def call_model(prompts: DataFrame, make: type | None = None, key: str | None = None, tries: int = 2) -> DataFrame:
    """``prompts`` (..., system, prompt, max_tokens) with ``response``, ``error``, ``tries`` and ``seconds``.

    A call whose answer is not ``usable`` is made again, with a line that asks for nothing but JSON, ``tries`` times in
    all; then the last answer stays. A failed call is a row, not a failed job.
    """
    kind, made = make or RuleExtractor, []

    def run(system: str, prompt: str, most: int) -> tuple[str | None, str | None, int, float]:
        if not made:
            made.append(kind())
        answer, error, began = None, None, time.monotonic()
        for count in range(1, tries + 1):
            try:
                answer, error = made[0](system, prompt + AGAIN if count > 1 else prompt, int(most)), None
            except Exception as e:  # a row's own failure stays in its row
                answer, error = None, f"{type(e).__name__}: {e}"
            if usable(answer, key):
                break
        return answer, error, count, time.monotonic() - began

    # Row by row: Spark pickles a hundred rows at a time, and columns that are not asked about stay in the JVM.
    ask = F.udf(run, ANSWER, useArrow=False).asNondeterministic()
    return prompts.withColumn("answer_", ask("system", "prompt", "max_tokens")).select(*(f"`{c}`" for c in prompts.columns), "answer_.*")


def detection_prompts(contexts: DataFrame) -> DataFrame:
    """(company, system, prompt, max_tokens) from the pieces packed for a company (company, place, text)."""
    own = contexts.groupBy("company").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "text"))), lambda s: s["text"]), "\n\n---\n\n").alias("t_")
    )
    return own.select("company", F.lit(SYSTEM).alias("system"), F.concat(F.lit(DETECT), "t_").alias("prompt"), F.lit(2048).alias("max_tokens"))


def with_examples(prompt: Column, examples: Column) -> Column:
    """Examples before the first ``DOCUMENT TEXT:``."""
    at = F.instr(prompt, "DOCUMENT TEXT:")
    return F.when(at > 0, F.concat(F.substring(prompt, F.lit(1), at - 1), examples, F.lit("\n\n"), F.substr(prompt, at))).otherwise(prompt)


def format_example(text: Column, answer: Column) -> Column:
    """One worked example for a prompt: a passage and the JSON it should give."""
    return F.concat(F.lit("EXAMPLE\nText: "), text, F.lit("\nAnswer: "), answer)


def verification_prompts(extractions: DataFrame, contexts: DataFrame) -> DataFrame:
    """(company, facility_idx, system, prompt, max_tokens): the found values of a facility and the text to check them against."""
    found = extractions.filter(~F.coalesce("value", F.lit("")).isin(*R.MISSING_IN_CONFIDENCE))
    line = F.concat(F.lit("- "), "field", F.lit(": "), "value")
    own = found.groupBy("company", "facility_idx").agg(F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("values_"))
    ask = F.concat(F.lit(VERIFY), "values_", F.lit("\n\n" + TEXT), "text")
    return own.join(contexts, "company").select("company", "facility_idx", F.lit(SYSTEM).alias("system"), ask.alias("prompt"), F.lit(1024).alias("max_tokens"))


def deep_prompts(targets: DataFrame, contexts: DataFrame, candidates: DataFrame, fields: DataFrame, config: EngineConfig = EngineConfig()) -> DataFrame:
    """One prompt a target field with a context (company, field, text), with the first five candidates as a hint.

    A ``line`` of a context, if it has that column, stands before its text, outside the budget. Targets without a context are
    left out: they stay as they are.
    """
    body = trim_tokens(F.col("text"), config.deep_budget)
    rows = targets.join(contexts, ["company", "field"]).join(
        candidates.select("company", "field", "candidates"), ["company", "field"], "left"
    ).join(F.broadcast(fields.select("field", "description")), "field", "left")
    hint = F.when(F.size("candidates") > 0, F.concat(F.lit("Candidates: "), F.array_join(F.slice("candidates", 1, 5), "; "), F.lit("\n"))).otherwise("")
    ask = F.concat(
        F.lit(SINGLE + "- "),
        "field",
        F.lit(": "),
        F.coalesce("description", "field"),
        F.lit("\n"),
        F.coalesce(hint, F.lit("")),
        F.lit("\n" + TEXT),
        F.concat_ws("\n\n", "line", body) if "line" in contexts.columns else body,
    )
    return rows.select("company", "facility_idx", "field", "candidates", F.lit(SYSTEM).alias("system"), ask.alias("prompt"), F.lit(500).alias("max_tokens"))


def deep_answers(answers: DataFrame) -> DataFrame:
    """(company, facility_idx, field, value, evidence, confidence); of an answer that cannot be read the first candidate, MEDIUM."""
    parsed = J.parse("response", J.FIELD)
    first = F.try_element_at("candidates", F.lit(1))
    rows = answers.select("company", "facility_idx", "field", parsed.alias("p_"), first.alias("first_"))
    value = F.when(F.col("p_").isNotNull(), F.coalesce("p_.value", F.lit("NOT_FOUND"))).otherwise(F.coalesce("first_", F.lit("NOT_FOUND")))
    evidence = F.when(F.col("p_").isNotNull(), F.coalesce("p_.evidence", F.lit(""))).when(F.col("first_").isNotNull(), "matched by pattern").otherwise("")
    confidence = F.when(F.col("p_").isNotNull(), F.coalesce("p_.confidence", F.lit("LOW"))).when(F.col("first_").isNotNull(), "MEDIUM").otherwise("LOW")
    return rows.select("company", "facility_idx", "field", value.alias("value"), evidence.alias("evidence"), confidence.alias("confidence"))


def prompts(contexts: DataFrame, groups: DataFrame, config: EngineConfig = EngineConfig()) -> DataFrame:
    """(company, facility_idx, group, pass_idx, system, prompt, max_tokens) from contexts with an array ``texts``."""
    bullets = F.array_join(F.zip_with("fields", "descriptions", lambda f, d: F.concat(F.lit("- "), f, F.lit(": "), d)), "\n")
    own = groups.select("group", bullets.alias("fields_"), "max_tokens")
    body = trim_tokens(F.array_join("texts", "\n\n---\n\n"), config.prompt_budget)
    before, after = QUESTION.split("{fields}")
    text = F.concat(
        F.when(F.col("facility").isNotNull(), F.concat(F.lit("Facility: "), "facility", F.lit("\n"))).otherwise(""),
        F.lit(before),
        "fields_",
        F.lit(after.replace("{{", "{").replace("}}", "}")),
        body,
    )
    return contexts.join(F.broadcast(own), "group").select(
        *CALL,
        "pass_idx",
        F.lit(SYSTEM).alias("system"),
        text.alias("prompt"),
        F.least("max_tokens", F.lit(config.max_new_tokens)).alias("max_tokens"),
    )


def answers_to_fields(answers: DataFrame, fields: DataFrame) -> DataFrame:
    """Long extractions of answers (..., response): validated, keys remapped, gaps filled, failures marked.

    An answer that is no JSON gives EXTRACTION_ERROR for all fields of its group; a missing field NOT_FOUND.
    """
    expected = fields.groupBy("group").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "field"))), lambda s: s["field"]).alias("expected"))
    rows = answers.join(F.broadcast(expected), "group").withColumn("own_", J.entries("response")).withColumn("ok_", F.col("own_").isNotNull())
    rows = rows.withColumn("other_", F.when(F.col("ok_"), J.remap(F.map_keys("own_"), F.col("expected"))))
    rows = rows.select(*CALL, "pass_idx", "ok_", "own_", "other_", F.explode("expected").alias("field"))
    raw = F.coalesce(F.try_element_at("own_", F.col("field")), F.try_element_at("own_", F.try_element_at("other_", F.col("field"))))
    parsed = F.from_json(raw, J.FIELD)
    is_object = raw.rlike(r"(?s)^\s*\{")
    value = F.when(~F.col("ok_"), "EXTRACTION_ERROR").when(raw.isNull(), "NOT_FOUND").when(
        is_object, F.coalesce(parsed["value"], F.lit("NOT_FOUND"))
    ).otherwise(F.regexp_replace(raw, r'^"|"$', ""))
    evidence = F.when(is_object, F.coalesce(parsed["evidence"], F.lit(""))).otherwise("")
    confidence = F.when(is_object, F.coalesce(parsed["confidence"], F.lit("LOW"))).otherwise("LOW")
    return rows.select(*CALL, "field", "pass_idx", value.alias("value"), evidence.alias("evidence"), confidence.alias("confidence"))


def facilities(answers: DataFrame) -> DataFrame:
    """(company, facility_idx, name, type, amount, characteristics) of detection answers; one stand-in where none is found."""
    own = J.parse("response", J.FACILITY_RESPONSE)["facilities"]
    default = F.array(
        F.struct(
            F.lit("Primary Facility").alias("name"), F.lit("Unknown").alias("type"), F.lit("N/A").alias("amount"), F.lit("").alias("characteristics")
        )
    )
    return answers.select(
        "company",
        F.posexplode(F.when(F.size(F.coalesce(own, F.array().cast(T.ArrayType(J.FACILITY)))) > 0, own).otherwise(default)).alias("facility_idx", "f"),
    ).select("company", "facility_idx", "f.*")


def complete_calls(extractions: DataFrame) -> DataFrame:
    """Calls whose fields were all found with HIGH confidence: later passes leave them out."""
    found = ~F.coalesce("value", F.lit("")).isin(*R.MISSING_IN_MERGE) & (F.col("confidence") == "HIGH")
    return extractions.groupBy(*CALL).agg(F.bool_and(F.coalesce(found, F.lit(False))).alias("done_")).filter("done_").drop("done_")


def still_open(calls: DataFrame, extractions: DataFrame) -> DataFrame:
    return calls.join(complete_calls(extractions), CALL, "left_anti")


def confidence_rank(c: Column) -> Column:
    return F.when(c == "HIGH", 3).when(c == "MEDIUM", 2).when(c == "LOW", 1).otherwise(0)


def merge_passes(extractions: DataFrame, fields: DataFrame | None = None) -> DataFrame:
    """The best of each field's passes: by confidence, then longer evidence, then the earlier pass.

    A LOW value without evidence and a value of unknown confidence are never taken; POSSIBLY_PRESENT only if nothing is.
    """
    keys = [*CALL, "field"]
    rows = extractions.withColumn("rank_", confidence_rank(F.col("confidence"))).withColumn("len_", F.length(F.coalesce("evidence", F.lit(""))))
    empty = F.coalesce("value", F.lit("")).isin(*R.MISSING_IN_MERGE)
    taken = ~empty & ((F.col("rank_") > 1) | ((F.col("rank_") == 1) & (F.col("len_") > 0)))
    best = F.max_by(
        F.when(taken, F.struct("value", "confidence", F.coalesce("evidence", F.lit("")).alias("evidence"))),
        F.when(taken, F.struct("rank_", "len_", -F.col("pass_idx"))),
    )
    own = rows.groupBy(*keys).agg(best.alias("b_"), F.bool_or(F.col("value") == "POSSIBLY_PRESENT").alias("maybe_"))
    none = F.when(F.col("maybe_"), "POSSIBLY_PRESENT").otherwise("NOT_FOUND")
    return own.select(
        *keys,
        F.coalesce("b_.value", none).alias("value"),
        F.coalesce("b_.evidence", F.lit("")).alias("evidence"),
        F.coalesce("b_.confidence", F.lit("LOW")).alias("confidence"),
    )


def merge_evidence(extractions: DataFrame) -> DataFrame:
    """The variant that keeps evidence of equally confident passes, joined by bars, each once."""
    keys = [*CALL, "field"]
    rows = extractions.withColumn("empty_", F.coalesce("value", F.lit("")).isin(*R.MISSING_IN_MERGE)).withColumn(
        "rank_", F.when(F.col("empty_"), -1).otherwise(confidence_rank(F.col("confidence")))
    )
    top = F.max("rank_").over(Window.partitionBy(*keys))
    kept = rows.withColumn("top_", top).filter("rank_ = top_")
    own = kept.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("pass_idx", "value", "confidence", F.coalesce("evidence", F.lit("")).alias("evidence")))).alias("s"),
        F.max("top_").alias("top_"),
    )
    add = lambda a, x: F.when((x["evidence"] == "") | a.contains(x["evidence"]), a).otherwise(F.concat(a, F.lit(" | "), x["evidence"]))
    joined = F.aggregate(F.slice("s", F.lit(2), F.size("s")), F.col("s")[0]["evidence"], add)
    return own.select(
        *keys,
        F.col("s")[0]["value"].alias("value"),
        F.when(F.col("top_") < 0, F.col("s")[0]["evidence"]).otherwise(joined).alias("evidence"),
        F.col("s")[0]["confidence"].alias("confidence"),
    )


def corrections(answers: DataFrame) -> DataFrame:
    """(company, facility_idx, field, verified_value, correction_reason) of verification answers that correct something."""
    rows = answers.select("company", "facility_idx", F.explode(J.parse("response", J.VERIFICATION)["verified_fields"]).alias("field", "c"))
    return rows.filter("c.is_correct = false and c.verified_value is not null and c.verified_value <> ''").select(
        "company", "facility_idx", "field", "c.verified_value", F.coalesce("c.correction_reason", F.lit("")).alias("correction_reason")
    )


def apply_corrections(extractions: DataFrame, found: DataFrame) -> DataFrame:
    rows = extractions.join(found, ["company", "facility_idx", "field"], "left")
    hit = F.col("verified_value").isNotNull()
    return rows.select(
        *CALL, "field", F.when(hit, F.col("verified_value")).otherwise(F.col("value")).alias("value"),
        F.when(hit, F.concat(F.coalesce("evidence", F.lit("")), F.lit(" [CORRECTED: "), "correction_reason", F.lit("]")))
        .otherwise(F.col("evidence"))
        .alias("evidence"),
        F.when(hit, "MEDIUM").otherwise(F.col("confidence")).alias("confidence"),
    )


def flatten(extractions: DataFrame, groups: DataFrame) -> DataFrame:
    """One row a field of a facility; of a field in several groups the later group's."""
    order = groups.select("group", F.col("ord").alias("g_"))
    rows = extractions.join(F.broadcast(order), "group")
    return rows.groupBy("company", "facility_idx", "field").agg(
        F.max_by(F.struct("group", "value", "evidence", "confidence"), "g_").alias("b")
    ).select("company", "facility_idx", "field", "b.*")


def confidence_scores(extractions: DataFrame) -> DataFrame:
    """(company, facility_idx, score): mean weight of found values, 0.0 for none."""
    weight = F.when(F.col("confidence") == "HIGH", 1.0).when(F.col("confidence") == "MEDIUM", 0.6).otherwise(0.3)
    found = ~F.coalesce("value", F.lit("")).isin(*R.MISSING_IN_CONFIDENCE)
    return extractions.groupBy("company", "facility_idx").agg(F.coalesce(F.avg(F.when(found, weight)), F.lit(0.0)).alias("score"))


def company_scores(extractions: DataFrame) -> DataFrame:
    return confidence_scores(extractions).groupBy("company").agg(F.avg("score").alias("score"))


def rows_wide(extractions: DataFrame, fields: DataFrame, sources: DataFrame, scores: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row a facility in the output's columns. ``sources``: (company, source_files string, comments)."""
    names = columns or R.FIELDS
    kinds = fields.select("field", "kind")
    long = extractions.join(F.broadcast(kinds), "field", "left").withColumn(
        "v_", F.when(F.col("value") == "POSSIBLY_PRESENT", "NOT_FOUND").otherwise(N.normalize_value(F.coalesce("kind", F.lit("text")), "value"))
    )
    wide = long.groupBy("company", "facility_idx").pivot("field", names).agg(F.first("v_"))
    score = F.concat(F.call_function("format_number", F.col("score") * 100, F.lit("0.00")), F.lit("%"))
    out = wide.join(sources, "company", "left").join(scores.select("company", "score"), "company", "left")
    own = [F.coalesce(F.col(f"`{n}`"), F.lit("NOT_EXTRACTED")).alias(n) for n in names]
    return out.select(
        F.col("company").alias("Client Folder"),
        F.col("source_files").alias("Source Files"),
        F.coalesce("comments", F.lit("")).alias("Comments"),
        score.alias("Confidence Score"),
        *own,
    )


def detailed_json(extractions: DataFrame) -> DataFrame:
    """(company, json): facilities with value, evidence and confidence of every field."""
    entry = F.struct("field", F.struct("value", "evidence", "confidence").alias("e"))
    own = extractions.groupBy("company", "facility_idx").agg(
        F.map_from_entries(
            F.array_sort(F.collect_list(entry), lambda a, b: F.when(a["field"] < b["field"], -1).when(a["field"] > b["field"], 1).otherwise(0))
        ).alias("fields")
    )
    return own.groupBy("company").agg(
        F.to_json(
            F.struct(
                F.first("company").alias("company"),
                F.array_sort(
                    F.collect_list(F.struct("facility_idx", "fields")), lambda a, b: a["facility_idx"] - b["facility_idx"]
                ).alias("facilities"),
            )
        ).alias("json")
    )


def stored_traces(answers: DataFrame, step: str) -> DataFrame:
    """Rows for an append-only trace of the calls of one step."""
    tokens = X.token_count("prompt")
    return answers.select(
        "company",
        F.lit(step).alias("step"),
        F.current_timestamp().alias("at"),
        tokens.alias("input_tokens"),
        "tries",
        "seconds",
        (tokens / F.when(F.col("seconds") > 0, F.col("seconds"))).alias("tokens_per_second"),
        "prompt",
        "response",
        J.json_text("response").isNotNull().alias("parsed_ok"),
        J.json_text("response").alias("parsed"),
    )
