"""Visually identical text with different characters: script-aware repair of look-alike letters.

Each text is first brought to its base form (``visual``).  Per token the dominant script is the one most of its letters
without a double belong to, or else that of the document.  A token that mixes scripts is substituted into its dominant script
if the result exists in the corpus vocabulary.

Texts are compared by their repaired tokens.  The vocabulary can't decide tokens that consist of doubles of another script
only (they mix nothing) and codes that stand nowhere else; yet they look the same, so in the comparison form, not in the
repaired text, they are read in the document's script if the vocabulary has that, or else in Latin.

Whether a result exists depends only on how the token looks and on scripts that substitution can't change, so texts that
read the same get the same comparison form.

Defined results
    * null texts and texts without visible characters are in no pair and no class;
    * texts of the same characters are no pair; line breaks, numbers of blanks, case, accents and raised digits count;
    * ``p10_found`` lists pairs of texts that differ in characters, as TESTDATA.md asks; ``p10_classes`` has one row per
      document with its class, for classes with two or more different texts.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specweave.llm.visual import CYRILLIC, GREEK, base_form
from specweave.session import Shelf, table

#: Distinct tokens that one task holds before it passes them on.
FLUSH_TOKENS = 200_000

_TOKEN = re.compile(r"[^\W\d_]\w*|\w+")
_TO_LATIN = {ord(k): v for k, v in (CYRILLIC | GREEK).items()}
_SCRIPTS = {
    "latin": _TO_LATIN,
    "cyrillic": {ord(v): k for k, v in CYRILLIC.items()} | {ord(g): c for g, latin in GREEK.items() for c, v in CYRILLIC.items() if v == latin},
    "greek": {ord(v): k for k, v in GREEK.items()} | {ord(c): g for c, latin in CYRILLIC.items() for g, v in GREEK.items() if v == latin},
}
_FOREIGN = re.compile("[" + "".join(CYRILLIC) + "".join(GREEK) + "]")


def _script(c: str) -> str:
    p = ord(c)
    if p < 0x250:
        return "latin" if c.isalpha() else ""
    return "greek" if 0x370 <= p < 0x400 else "cyrillic" if 0x400 <= p < 0x530 else ""


_DOUBLES = set(CYRILLIC) | set(CYRILLIC.values()) | set(GREEK) | set(GREEK.values())


def _weights(text: str) -> dict[str, int]:
    """Letters without a double, by script: what no substitution of look-alikes changes."""
    counts = {"latin": 0, "cyrillic": 0, "greek": 0}
    for c in text:
        if c not in _DOUBLES and (s := _script(c)):
            counts[s] += 1
    return counts


def _dominant(counts: dict[str, int], otherwise: str) -> str:
    best = max(counts, key=lambda s: counts[s])  # the first of equals: latin, cyrillic, greek
    return best if counts[best] else otherwise


def substitutions(base: str) -> dict[str, str]:
    """Token -> its form in the dominant script, of the tokens of a base form that aren't in that form yet."""
    if not _FOREIGN.search(base):
        return {}
    home = _dominant(_weights(base), "latin")
    out = {}
    for token in set(_TOKEN.findall(base)):
        if any(c in _DOUBLES for c in token):
            form = token.translate(_SCRIPTS[_dominant(_weights(token), home)])
            if form != token:
                out[token] = form
    return out


def _digest(text: str) -> bytes:
    return xxhash.xxh3_128_digest(text.encode("utf-8", "surrogatepass"))


def is_mixed(token: str) -> bool:
    return len({_script(c) for c in token} - {""}) > 1


_ROWS = "doc_id bigint, raw binary, key binary, base string, tokens array<string>, forms array<string>, word string"


def _forms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row per text with visible characters, and in between, whenever ``FLUSH_TOKENS`` are held, the partition's tokens."""
    names = [c.split()[0] for c in _ROWS.split(", ")]
    held: set[str] = set()

    def words() -> pd.DataFrame:
        return pd.DataFrame([(None,) * (len(names) - 1) + (w,) for w in held], columns=names, dtype="object")

    for pdf in batches:
        rows = []
        for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
            base = base_form(text)
            if base.strip():
                held.update(_TOKEN.findall(base))
                swaps = substitutions(base)
                rows.append((doc_id, _digest(text), None if swaps else _digest(base), base if swaps else None, list(swaps), list(swaps.values()), None))
        yield pd.DataFrame(rows, columns=names)
        if len(held) >= FLUSH_TOKENS:
            yield words()
            held.clear()
    yield words()


def _repaired(base: str, swaps: dict[str, str], known: set[str]) -> tuple[str, str]:
    """The repaired text (mixed-script tokens only) and the comparison form."""

    def read_as(token: str) -> str:
        form = swaps.get(token, token)
        return form if form == token or form in known else token.translate(_TO_LATIN)

    text = _TOKEN.sub(lambda m: swaps[m.group()] if swaps.get(m.group()) in known and is_mixed(m.group()) else m.group(), base)
    form = _TOKEN.sub(lambda m: read_as(m.group()), base)
    return unicodedata.normalize("NFC", text), unicodedata.normalize("NFC", form)  # an accent may now have a letter to join


def _repair(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for doc_id, raw, base, tokens, forms, known in zip(pdf["doc_id"], pdf["raw"], pdf["base"], pdf["tokens"], pdf["forms"], pdf["known"]):
            text, form = _repaired(base, dict(zip(tokens, forms)), set(known) if known is not None else set())
            rows.append((doc_id, raw, _digest(form), text, text != base))
        yield pd.DataFrame(rows, columns=["doc_id", "raw", "key", "text", "changed"])


def visual_forms(documents: DataFrame, shelf: Shelf | None = None) -> tuple[DataFrame, DataFrame]:
    """(doc_id, raw, key) of every document with visible text, and (doc_id, text) of the repaired ones.

    ``raw`` and ``key`` are 128-bit digests of the text and of its comparison form.  Texts are gone through once, for their
    forms and for the vocabulary.
    """
    shelf = shelf or Shelf(documents.sparkSession)
    texts = documents.select("doc_id", "text").filter("text is not null")
    rows = shelf.keep(texts.mapInPandas(_forms, _ROWS))
    mixed = rows.filter("word is null and key is null").drop("word")
    wanted = mixed.select(F.explode("forms").alias("form")).distinct()
    known = wanted.join(rows.filter("word is not null").select(F.col("word").alias("form")), "form", "left_semi")
    per_document = mixed.select("doc_id", F.explode("forms").alias("form")).join(known, "form").groupBy("doc_id").agg(F.collect_set("form").alias("known"))
    repaired = shelf.keep(mixed.drop("key").join(per_document, "doc_id", "left").mapInPandas(_repair, "doc_id bigint, raw binary, key binary, text string, changed boolean"))
    keyed = rows.filter("key is not null").select("doc_id", "raw", "key").unionByName(repaired.select("doc_id", "raw", "key"))
    return keyed, repaired.filter("changed").select("doc_id", "text")


def _mixed_classes(keyed: DataFrame) -> DataFrame:
    """The keys that two or more different texts share."""
    return keyed.groupBy("key").agg(F.min("raw").alias("a"), F.max("raw").alias("b"), F.min("doc_id").alias("class_id")).filter("a <> b").select("key", "class_id")


def lookalike_pairs(documents: DataFrame) -> DataFrame:
    """doc_id_a < doc_id_b of documents that read the same and are made of different characters.

    As many rows as there are pairs; ``lookalike_classes`` says the same in one row per document.  The members are written
    before they are joined, so that adaptive execution splits a large class.
    """
    shelf = Shelf(documents.sparkSession)
    keyed, _ = visual_forms(documents, shelf)
    shared = shelf.keep(keyed.join(_mixed_classes(keyed), "key").drop("class_id"))
    a = shared.select("key", F.col("doc_id").alias("doc_id_a"), F.col("raw").alias("raw_a"))
    b = shared.select("key", F.col("doc_id").alias("doc_id_b"), F.col("raw").alias("raw_b"))
    return a.join(b, "key").filter("doc_id_a < doc_id_b and raw_a <> raw_b").select("doc_id_a", "doc_id_b")


def lookalike_classes(documents: DataFrame) -> DataFrame:
    """doc_id and class_id (the class's smallest doc_id) of every document that another one reads like."""
    keyed, _ = visual_forms(documents)
    return keyed.join(_mixed_classes(keyed), "key").select("doc_id", "class_id")


def p10_found(spark: SparkSession, root: str) -> DataFrame:
    return lookalike_pairs(table(spark, root, "documents"))


def p10_classes(spark: SparkSession, root: str) -> DataFrame:
    return lookalike_classes(table(spark, root, "documents"))


def p10_repaired(spark: SparkSession, root: str) -> DataFrame:
    """doc_id and repaired text of the documents in which look-alike letters were found."""
    return visual_forms(table(spark, root, "documents"))[1]
