"""Finding terms of a lexicon in texts: a join on words instead of one pattern per term and text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specweave.functions.text import UI, U, extract, quoted, word_pattern

#: Columns of a term that are passed on.
TERM_COLUMNS = ["source", "canonical", "canonical_ord", "term", "term_ord"]
_WORDS = U + r"(\w+)"
#: Words of a term that are compared before its spelling is; longer terms are found by their first ones.
AHEAD = 8


def term_words(terms: DataFrame, plural: bool) -> DataFrame:
    """Terms with their words (and, for ``plural``, those with an s at the end) and the first of them."""
    words = F.regexp_extract_all(F.lower("term"), F.lit(_WORDS), F.lit(1))
    n = F.size(words)
    forms = F.array(words, F.concat(F.slice(words, F.lit(1), n - 1), F.array(F.concat(F.element_at(words, -1), F.lit("s"))))) if plural else F.array(words)
    return terms.filter(n > 0).withColumn("words", F.explode(forms)).withColumn("first", F.col("words")[0]).withColumn("n_words", F.size("words"))


def mentions(texts: DataFrame, keys: list[str], terms: DataFrame, plural: bool = True, by: list[str] | None = None) -> DataFrame:
    """``keys`` and the term columns for every term that stands in a text as whole words, case aside.

    ``texts``: keys and ``text``; ``by``: keys that must also be equal in ``terms`` (terms of one document).  Every word of a
    text meets the terms that begin with it, so cost grows with the text, not with text times terms; the few that meet are
    then looked for in the text as they are written, between word boundaries.
    """
    by = by or []
    prepared = term_words(terms, plural).select(*by, *TERM_COLUMNS, F.slice("words", F.lit(1), F.lit(AHEAD)).alias("words"), "first", F.least("n_words", F.lit(AHEAD)).alias("n_words"))
    words = F.regexp_extract_all(F.lower("text"), F.lit(_WORDS), F.lit(1))
    ahead = F.transform("all_words", lambda w, i: F.struct(w.alias("first"), F.slice("all_words", i + 1, F.lit(AHEAD)).alias("ahead")))
    placed = texts.filter("text is not null").select(*keys, words.alias("all_words")).select(*keys, F.explode(ahead).alias("w")).select(*keys, "w.first", "w.ahead")
    met = placed.join(prepared, [*by, "first"]).filter(F.slice("ahead", F.lit(1), F.col("n_words")) == F.col("words"))
    found = met.select(*keys, *TERM_COLUMNS).distinct()
    spelled = found.join(texts.select(*keys, "text"), keys).filter(F.regexp_like("text", word_pattern(F.col("term"), plural)))
    return spelled.select(*keys, *TERM_COLUMNS)


def matched_text(text, term, plural: bool = False):
    """The first occurrence of a term in a text, as written there."""
    return extract(text, F.concat(F.lit(UI + r"\b"), quoted(term), F.lit(r"s?\b" if plural else r"\b")), 0)
