"""Text scalar functions as Column expressions. Blanks are Unicode blanks, as in the patterns' ``(?U)``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of structure detection.
HEADER_PATTERNS = [
    r"^(?:SECTION|ARTICLE|PART|SCHEDULE|ANNEX|APPENDIX|EXHIBIT)\s+[\dIVXA-Z]+",
    r"^[\d]+\.[\d]*\s+[A-Z][A-Za-z\s]+$",
    r"^[A-Z][A-Z\s]{10,}$",
    r"^\d+\.\s+[A-Z]",
]
NUMBER_COLUMNS = r"^\s*[\d,\.]+\s+[\d,\.]+\s+[\d,\.]+"
SEPARATOR_LINE = r"^\s*[-=+]+\s*$"
SENTENCE_BREAK = r"(?<=[.!?])\s+(?=[A-Z])"
ARTEFACTS = r"\b(NaN|Unnamed:\s*\d+)\b"
WHOLE_WORDS = r"(?<![\p{L}\p{N}_])[a-z0-9]++(?![\p{L}\p{N}_])"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    return F.regexp_replace(col(c), r"(?U)^\s+|\s+$", "")


def lines(c: Column | str) -> Column:
    return F.split(col(c), "\n", -1)


def clean_text(c: Column | str) -> Column:
    """Drop table artefacts, squeeze blanks inside lines, and drop blank and very short lines."""
    squeezed = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.coalesce(col(c), F.lit("")), ARTEFACTS, ""), r"[ \t]+", " "), r"\n{4,}", "\n\n\n")
    kept = F.filter(lines(squeezed), lambda x: (F.length(strip(x)) > 2) | strip(x).isin("|", "-", "+"))
    return strip(F.array_join(kept, "\n"))


def is_header(line: Column) -> Column:
    s = strip(line)
    return F.length(s).between(3, 100) & s.rlike("(?U)" + "|".join(f"(?:{p})" for p in HEADER_PATTERNS))


def is_table_line(line: Column) -> Column:
    tabs = F.length(line) - F.length(F.regexp_replace(line, "\t", ""))
    return line.contains("|") | (tabs >= 2) | line.rlike(NUMBER_COLUMNS) | line.rlike(SEPARATOR_LINE)


def sentences(c: Column | str) -> Column:
    return F.split(col(c), SENTENCE_BREAK, -1)


def tokens(c: Column | str) -> Column:
    """Runs of a-z and 0-9 that are whole words among Unicode letters, digits and underscores."""
    return F.regexp_extract_all(F.lower(col(c)), F.lit(WHOLE_WORDS), F.lit(0))


def blank_tokens(c: Column | str) -> Column:
    """The default tokenizer: runs of non-blanks."""
    return F.filter(F.split(col(c), r"[ \t\n\r\f\x0B]+", -1), lambda t: t != "")


def token_count(c: Column | str) -> Column:
    return F.size(blank_tokens(c))


def safe_name(c: Column | str) -> Column:
    """A file-system safe identifier."""
    return F.regexp_replace(col(c), r"[^a-zA-Z0-9_-]", "_")


def without_banners(c: Column | str, chars: int = 8000) -> Column:
    """The start of a text without page and file banners, for language detection."""
    return F.regexp_replace(F.substring(col(c), 1, chars), r"={3,}|\[PAGE \d+\]|\[SOURCE FILE:[^\]]*\]", "")


# Frequent words that tell languages apart.
LANGUAGE_WORDS = {
    "en": ["the", "of", "and", "to", "in", "is", "that", "for", "with", "was"],
    "fr": ["le", "la", "les", "des", "et", "du", "une", "que", "dans", "est"],
    "de": ["der", "die", "das", "und", "ist", "nicht", "von", "den", "mit", "ein"],
    "es": ["el", "los", "las", "del", "y", "una", "por", "con", "para", "se"],
    "it": ["il", "gli", "della", "di", "che", "sono", "nel", "alla", "anche", "non"],
    "nl": ["het", "een", "van", "dat", "niet", "zijn", "voor", "op", "aan", "ook"],
    "pt": ["os", "da", "do", "em", "um", "uma", "não", "ao", "pelo", "são"],
    "pl": ["się", "nie", "jest", "na", "że", "oraz", "przez", "dla", "od", "jak"],
}


def _among(own: list[str]):
    return lambda w: w.isin(*own)


def language(c: Column | str, default: str = "en") -> Column:
    """The language with most stop words; ties in the order above; ``default`` if there are none.

    The words are split once and only stop words of some language counted: a column that a lambda names is evaluated once.
    """
    words = F.filter(F.split(F.lower(col(c)), r"[ \t\n\r\f\x0B]+", -1), _among(sorted({w for own in LANGUAGE_WORDS.values() for w in own})))

    def best(w: Column) -> Column:
        counts = [
            F.struct(
                F.size(F.filter(w, _among(own))).alias("n"), F.lit(-i).alias("order"), F.lit(k).alias("code")
            ) for i, (k, own) in enumerate(LANGUAGE_WORDS.items())
        ]
        return F.array_max(F.array(*counts))

    code = F.transform(F.transform(F.array(words), best), lambda b: F.when(b["n"] > 0, b["code"]).otherwise(default))
    return F.get(code, F.lit(0))


# Names of languages by code.
LANGUAGE_NAMES = {
    "en": "English",
    "es": "Spanish",
    "fr": "French",
    "de": "German",
    "nl": "Dutch",
    "pt": "Portuguese",
    "it": "Italian",
    "pl": "Polish",
    "ro": "Romanian",
    "cs": "Czech",
    "da": "Danish",
    "sv": "Swedish",
    "nb": "Norwegian",
    "fi": "Finnish",
    "hu": "Hungarian",
    "el": "Greek",
    "tr": "Turkish",
    "ru": "Russian",
    "uk": "Ukrainian",
    "ja": "Japanese",
    "zh-cn": "Chinese",
    "ko": "Korean",
    "ar": "Arabic",
}


def language_hint(code: Column) -> Column:
    """A line for prompts; empty for English; an unknown code in capitals stands for its name."""
    names = F.create_map(*(F.lit(x) for kv in LANGUAGE_NAMES.items() for x in kv))
    name = F.coalesce(F.try_element_at(names, code), F.upper(code))
    return F.when(code == "en", "").otherwise(
        F.concat(F.lit("The document is written in "), name, F.lit(". Answer in English; keep quotes in the original language."))
    )
