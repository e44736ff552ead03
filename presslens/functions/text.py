"""Column expressions for names, labels, numbers and dates."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

# Label texts read as true or false.
TRUE_TEXTS = ("true", "yes", "1")
FALSE_TEXTS = ("false", "no", "0")
PRESENCE_FALSE_TEXTS = ("nan", "false", "0")

# Headline keywords and the document prefix expected by the embedder.
BREACH_KEYWORDS = ("breach", "data", "hack", "record", "leak")
DOCUMENT_PREFIX = "search_document: "
QUERY_PREFIX = "search_query: "


def normalise_name(name: Column) -> Column:
    """Lower case without punctuation; null becomes the empty string."""
    # Java's \w and \s are ASCII only, so the classes are spelled out.
    kept = F.regexp_replace(F.coalesce(name, F.lit("")), r"[^\p{L}\p{N}_\s\p{Z}]", "")
    return F.lower(kept)


def lower_key(name: Column) -> Column:
    return F.lower(name)


def to_bool(label: Column, mode: str = "lenient") -> Column:
    """Read a dirty label as boolean, never null.

    lenient: any other non-empty text is true.
    strict: any other text is false.
    presence: true unless empty, nan, false or 0 (no trimming).
    """
    text = F.lower(F.coalesce(label.cast("string"), F.lit("nan")))
    if mode == "presence":
        return (F.length(text) > 0) & ~text.isin(*PRESENCE_FALSE_TEXTS)
    text = F.trim(text)
    if mode == "strict":
        return text.isin(*TRUE_TEXTS)
    if mode != "lenient":
        raise ValueError(f"unknown mode {mode!r}")
    return (
        F.when(text == "nan", F.lit(False))
        .when(text.isin(*TRUE_TEXTS), F.lit(True))
        .when(text.isin(*FALSE_TEXTS), F.lit(False))
        .otherwise(text != "")
    )


def parse_grouped_number(text: Column) -> Column:
    """'1,234,567' as bigint; unparsable text becomes null."""
    return F.regexp_replace(text, ",", "").try_cast("bigint")


def parse_month_year(text: Column) -> Column:
    """'Aug 2014' or 'Aug2014' as the first day of that month."""
    return F.try_to_date(F.regexp_replace(text, " ", ""), "MMMyyyy")


def parse_yyyymmdd(number: Column) -> Column:
    return F.try_to_date(number.cast("string"), "yyyyMMdd")


def epoch_to_ts(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def year_of_yyyymmdd(number: Column) -> Column:
    return F.floor(number / 10000).cast("int")


def split_year_month(text: Column) -> tuple[Column, Column]:
    parts = F.split(text, "-", 2)
    return parts[0].cast("int"), parts[1].cast("int")


def contains_keyword(text: Column, words: Iterable[str] = BREACH_KEYWORDS) -> Column:
    """A keyword at the start of the text or after white space, in any case."""
    pattern = r"(?i)(\s|^)(" + "|".join(words) + ")"
    return F.coalesce(text, F.lit("nan")).rlike(pattern)


def file_safe(text: Column) -> Column:
    return F.regexp_replace(text, r"[^A-Za-z0-9_\-]", "_")


def percent_text(ratio: Column, digits: int = 2) -> Column:
    return F.concat(F.bround(ratio * 100, digits).cast("string"), F.lit("%"))


def with_document_prefix(text: Column) -> Column:
    prefixed = text.startswith(DOCUMENT_PREFIX) | text.startswith(QUERY_PREFIX)
    return F.when(prefixed, text).otherwise(F.concat(F.lit(DOCUMENT_PREFIX), text))


def sorted_tokens(name: Column) -> Column:
    """Space-separated tokens in sorted order, single-spaced."""
    tokens = F.filter(F.split(name, r"\s+"), lambda t: t != "")
    return F.array_join(F.array_sort(tokens), " ")
