"""Text functions as column expressions (native but for Unicode normalization, which runs over Arrow batches)."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space as Unicode has it; the engines' own ``\s`` is ASCII only.
SPACE = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
NOT_SPACE = r"[^\s\x0b\x1c-\x1f\x85\p{Z}]"
NOT_WORD = r"[^\p{L}\p{N}_]+"

TEXT_COLUMNS = ("content", "text", "cleaned_title", "title")
FORMS = ("NFC", "NFD", "NFKC", "NFKD")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once: inside a lambda a plain expression would be computed again for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def normalized(text: Column, form: str = "NFC") -> Column:
    """text in a Unicode normalization form; null becomes ''."""
    if form not in FORMS:
        raise ValueError(f"unknown normalization form {form!r}")

    @F.pandas_udf("string")
    def run(values: pd.Series) -> pd.Series:
        return values.str.normalize(form)

    # ASCII is every form of itself, so only the rest goes through Python
    plain = F.coalesce(text, F.lit(""))
    return F.when(plain.rlike(r"^[\x00-\x7f]*$"), plain).otherwise(run(plain))


def normalize_columns(df: DataFrame, form: str = "NFC", columns: tuple[str, ...] = TEXT_COLUMNS) -> DataFrame:
    """df with each of the text columns that it has and that are strings normalized; all else is left alone."""
    kinds = dict(df.dtypes)
    return df.withColumns({c: F.when(F.col(c).isNotNull(), normalized(F.col(c), form)) for c in columns if kinds.get(c) == "string"})


def change_stats(before: Column, after: Column) -> Column:
    """struct(changed, length_diff, original_length, normalized_length)."""
    a, b = F.coalesce(before, F.lit("")), F.coalesce(after, F.lit(""))
    return F.struct(
        (a != b).alias("changed"), (F.length(b) - F.length(a)).alias("length_diff"), F.length(a).alias("original_length"), F.length(b).alias("normalized_length")
    )


def strip(text: Column) -> Column:
    """text without white space at its ends."""
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def words(text: Column) -> Column:
    """The words of a text: runs without white space."""
    return F.regexp_extract_all(text, F.lit(f"({NOT_SPACE}+)"), F.lit(1))


def word_count(text: Column) -> Column:
    """The number of words; of null 0."""
    return F.coalesce(F.regexp_count(text, F.lit(f"{NOT_SPACE}+")), F.lit(0))


def paragraphs(text: Column, separator: str = r"\n\s*\n") -> Column:
    """The non-empty paragraphs of a text, stripped, in order."""
    return F.filter(F.transform(F.split(text, separator), strip), lambda p: p != "")


def is_valid(text: Column, min_length: int = 10) -> Column:
    """Whether a text has at least min_length characters between its ends and an ASCII letter or digit."""
    return F.coalesce((F.length(strip(text)) >= min_length) & text.rlike("[a-zA-Z0-9]"), F.lit(False))


# Rewrites of a post's text, in order.
POST_REWRITES = (
    (r"(?i)\[removed\]", ""),
    (r"(?i)\[deleted\]", ""),
    (r"(?i)\[automoderator\]", ""),
    (r"\*\*([^*]+)\*\*", r"\1"),
    (r"__([^_]+)__", r"\1"),
    (r"\*([^*\s][^*]*[^*\s])\*", r"\1"),
    (r"_([^_\s][^_]*[^_\s])_", r"\1"),
    (r"\[([^\]]+)\]\([^)]+\)", r"\1"),
    (f"https?://{NOT_SPACE}+", ""),
    ("[\u2018\u2019]", "'"),
    ("[\u201c\u201d]", '"'),
    ("[\u2014\u2013]", "-"),
    ("\u2026", "..."),
    ("\u00a0", " "),
)


def clean_post(text: Column, decompose: bool = True) -> Column:
    """A post's text without removal marks, markdown and addresses, with plain quotes, dashes and spaces."""
    out = F.coalesce(text, F.lit(""))
    for pattern, to in POST_REWRITES:
        out = F.regexp_replace(out, pattern, to.replace(r"\1", "$1"))
    if decompose:
        out = normalized(out, "NFKD")
    return strip(F.regexp_replace(out, f"{SPACE}+", " "))


# The lines between which a public-domain e-book has its text.
_EDGE = r"(?i)\*\*\* ?{} OF (?:THIS|THE) PROJECT GUTENBERG EBOOK .+? ?\*\*\*"


def between_markers(text: Column) -> Column:
    """A book's text between its start and end lines, stripped; without them the whole text."""
    start, end = _EDGE.format("START"), _EDGE.format("END")
    after = F.when(text.rlike(start), F.regexp_replace(text, f"(?s)^.*?(?-s:{start})", "")).otherwise(text)
    return strip(F.when(after.rlike(end), F.regexp_replace(after, f"(?s)(?-s:{end}).*$", "")).otherwise(after))


# Chapter headings, in order of precedence.
CHAPTERS = (r"^(CHAPTER\s+[IVXLCDM]+)", r"^(Chapter\s+\d+)", r"^(CHAPTER\s+\w+)", r"^([IVXLCDM]+\.)")


def chapter_marker(paragraph: Column) -> Column:
    """The chapter heading a paragraph begins with; null if none."""
    found = [F.nullif(F.regexp_extract(paragraph, p, 1), F.lit("")) for p in CHAPTERS]
    return F.coalesce(*found)


# How speech is attributed, and words that are no names.
_NAME = r"([\p{L}\p{N}_]+)"
ATTRIBUTIONS = (rf"(?i){_NAME}\s+said", rf"(?i)said\s+{_NAME}", rf"(?i){_NAME}\s+replied", rf"(?i){_NAME}\s+asked", rf"(?i){_NAME}\s+exclaimed")
NOT_NAMES = ("he", "she", "i", "we", "they", "it", "the", "a", "an")


def speaker_names(paragraph: Column) -> Column:
    """The names to which a paragraph attributes speech, distinct and sorted."""
    low, none = F.lower(paragraph), F.array().cast("array<string>")
    verbs = [p.replace(_NAME, "").replace("(?i)", "").replace(r"\s+", "") for p in ATTRIBUTIONS]
    # a plain search for the verb spares most texts the costly patterns
    found = F.flatten(F.array(*[F.when(low.contains(v), F.regexp_extract_all(paragraph, F.lit(p), F.lit(1))).otherwise(none) for p, v in zip(ATTRIBUTIONS, verbs)]))
    named = F.filter(found, lambda n: ~F.lower(n).isin(*NOT_NAMES))
    return F.array_sort(F.array_distinct(F.transform(named, lambda n: F.concat(F.upper(F.left(n, F.lit(1))), F.lower(F.substring(n, 2, 1 << 20))))))


def token_estimate(text: Column) -> Column:
    """A rough number of tokens: a quarter of the characters."""
    return F.floor(F.length(F.coalesce(text, F.lit(""))) / 4)


def contains_any(text: Column, phrases: list[str]) -> Column:
    """Whether a text holds any of the phrases, whatever their case."""
    low, out = F.lower(F.coalesce(text, F.lit(""))), F.lit(False)
    for p in phrases:
        out = out | low.contains(p.lower())
    return out


def tool_id(original: Column, size: int = 9) -> Column:
    """A tool call's id as its last ``size`` letters and digits, filled with zeros from the left."""
    kept = F.regexp_replace(original, r"[^\p{L}\p{N}]", "")
    return F.right(F.concat(F.lit("0" * size), kept), F.lit(size))


def first_text(df: DataFrame, columns: tuple[str, ...] = TEXT_COLUMNS) -> Column:
    """The first of the text columns that a row has and that is not empty."""
    return F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in columns if c in df.columns], F.lit(None).cast("string"))
