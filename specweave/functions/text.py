"""Text kernels as Column expressions.

Patterns carry the flags that give ``\\w``, ``\\s``, ``\\b`` and case folding their Unicode meaning.  Null in, null out.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode classes; with case folding.
U, UI = "(?U)", "(?iuU)"
SENTENCE_GAP = r"(?<=[.!?])\s+(?=[A-Z])"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def extract(text: Column, pattern: Column, group: int) -> Column:
    """A group of the first match of a pattern that differs by row; empty if there is none."""
    return F.call_function("regexp_extract", text, pattern, F.lit(group))


def norm(text: Column) -> Column:
    """Lower case, outer blanks removed, inner blanks single."""
    return F.regexp_replace(strip(F.lower(text)), r"(?U)\s+", " ")


def quoted(term: Column) -> Column:
    """A term as a literal part of a pattern."""
    return F.concat(F.lit(r"\Q"), F.regexp_replace(term, r"\\E", ""), F.lit(r"\E"))


def word_pattern(term: Column, plural: bool = True) -> Column:
    return F.concat(F.lit(UI + r"\b"), quoted(term), F.lit(r"s?\b" if plural else r"\b"))


def sentences(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, U + SENTENCE_GAP), strip), lambda s: s != "")


def sentence_spans(text: Column) -> Column:
    """Array of struct(start, length), 1-based, of the sentences; slices of a range of them are literal substrings."""
    start = F.struct(F.lit(1).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(acc: Column, s: Column) -> Column:
        begin = F.call_function("locate", s, text, acc["at"])
        return F.struct((begin + F.char_length(s)).alias("at"), F.concat(acc["spans"], F.array(F.struct(begin.alias("start"), F.char_length(s).alias("length")))).alias("spans"))

    return F.aggregate(F.split(text, U + SENTENCE_GAP), start, step, lambda acc: acc["spans"])


def merged_span(text: Column, needle: Column) -> Column:
    """The stretch from the first to the last sentence with ``needle`` as a word; null if there is none."""
    holding = F.filter(sentence_spans(text), lambda s: F.regexp_like(F.substring(text, s["start"], s["length"]), word_pattern(needle)))
    first, last = F.try_element_at(holding, F.lit(1)), F.try_element_at(holding, F.lit(-1))
    return strip(F.substring(text, first["start"], last["start"] + last["length"] - first["start"]))


def name_words(name: Column) -> Column:
    return F.regexp_extract_all(name, F.lit(r"([A-Za-z0-9']+)"), F.lit(1))


def head_noun(name: Column) -> Column:
    """The last word outside of parentheses, in lower case."""
    bare = strip(F.regexp_replace(name, r"\([^)]*\)", ""))
    return F.lower(F.coalesce(F.try_element_at(name_words(bare), F.lit(-1)), bare))


def camel_case(name: Column) -> Column:
    """``EVC ID`` -> ``evcId``: words joined, acronyms after the first word capitalised."""
    tokens = F.regexp_extract_all(name, F.lit("([A-Za-z0-9]+)"), F.lit(1))

    def part(token: Column, i: Column) -> Column:
        rest = F.substring(token, F.lit(2), F.length(token))
        acronym = (F.length(token) > 1) & (F.upper(token) == token) & token.rlike("[A-Z]")
        later = F.concat(F.upper(F.substring(token, 1, 1)), F.when(acronym, F.lower(rest)).otherwise(rest))
        return F.when(i == 0, F.lower(token)).otherwise(later)

    return F.array_join(F.transform(tokens, part), "")


def token_count(text: Column) -> Column:
    """1.3 tokens per blank-separated word, rounded up."""
    n = F.size(F.filter(F.split(text, r"(?U)\s+"), lambda w: w != ""))
    return F.ceil(n * F.lit(1.3)).cast("int")
