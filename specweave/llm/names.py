"""Mapping freely entered names to the entries of a reference list.

The distinct names are normalised (look-alike letters, case, camelCase, inverted order, articles, brackets, plural), those
that equal an entry's name or alias are settled, all others meet the entries through an inverted index of character
n-grams and are scored by the cosine of idf weights.  Of the entries that pass the threshold, those whose spelling is too
many keystrokes away, word by word, are struck out; a name is mapped to the one with the highest cosine if it leads the next
one by the margin.

Defined results
    * null, blank and stand-in names are in no row of ``p7_found``; every other row has one, 0 where no entry is meant;
    * entries with null or empty aliases have their name only; of entries with equal spellings the smallest id wins;
    * a name whose two best entries are within the margin means neither (0);
    * names are scored once however often they occur, so repeated rows cost nothing.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from specweave.llm.fusion import usable_name
from specweave.llm.visual import latin_form
from specweave.session import Shelf, checkpointed, table

#: Least cosine, of names and of names of fewer than ``SHORT`` letters (of whose n-grams few survive a keystroke), and
#: least lead over the next entry.
THRESHOLD, SHORT_THRESHOLD, SHORT = 0.3, 0.05, 8
MARGIN = 0.02
#: Longest n-gram; shorter ones down to 2 are used too.
GRAM = 3
#: Keystrokes that a name may be apart from its entry, all in all.
MAX_EDITS = 3

#: Words around a name that mean nothing.
ARTICLES = ("the", "a", "an")
TAILS = ("object", "entity", "item", "record")
_NOTE = re.compile(r"\((?:see|ref|cf|e\.g)[^)]*\)|\[[^\]]*\d[^\]]*\]")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_REST = re.compile(r"[^\w]+|_")


def normal_name(name: str) -> str:
    """The comparison form of a name: lower-case words, singular, in natural order."""
    text = _NOTE.sub(" ", latin_form(name)).strip(" \t\n.;:!?-–—\"'()[]{}<>")
    if text.count(",") == 1:
        tail, head = text.split(",")
        if head.strip() and tail.strip():
            text = f"{head} {tail}"
    words = _REST.sub(" ", _CAMEL.sub(" ", text)).casefold().split()
    while len(words) > 1 and words[0] in ARTICLES:
        words = words[1:]
    while len(words) > 1 and words[-1] in TAILS:
        words = words[:-1]
    return " ".join(words)


def singular(name: str) -> str:
    """The name with its last word in the singular."""
    if name.endswith("ies") and len(name) > 4:
        return name[:-3] + "y"
    if name.endswith("s") and not name.endswith("ss") and len(name) > 3:
        return name[:-1]
    return name


def grams(name: str) -> list[str]:
    """The n-grams of a name's words; of short names also what is left without each letter, as a keystroke spoils most of
    their n-grams."""
    padded = " ".join(f"^{w}$" for w in name.split())
    out = {padded[i : i + n] for n in range(2, GRAM + 1) for i in range(len(padded) - n + 1) if " " not in padded[i : i + n]}
    if len(name) <= SHORT:
        out.update(f"-{name[:i]}{name[i + 1 :]}" for i in range(len(name)))
    return sorted(out)


def edits(a: str, b: str, most: int) -> int:
    """Keystrokes (insert, delete, replace, swap of neighbours) from ``a`` to ``b``; more than ``most`` gives most + 1."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, now = [0] * (len(b) + 1), list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        older, before, now = before, now, [i] + [0] * len(b)
        for j, y in enumerate(b, 1):
            now[j] = min(before[j] + 1, now[j - 1] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                now[j] = min(now[j], older[j - 2] + 1)
        if min(now) > most:
            return most + 1
    return now[-1]


def spelled_like(name: str, entry: str, most: int = MAX_EDITS) -> int | None:
    """Keystrokes between two spellings, word by word; None if a word differs too much for its length, or all in all."""
    a, b = name.split(), entry.split()
    if len(a) != len(b):
        apart = edits(name, entry, most)  # a blank was lost or put in
        return apart if apart <= min(most, max(1, len(entry) // 6)) else None
    total = 0
    for x, y in zip(a, b):
        apart = edits(x, y, 2)
        if apart > (2 if len(y) >= 6 else 1 if len(y) >= 4 else 0):
            return None
        total += apart
    return total if total <= most else None


def _normalise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.DataFrame({"name": pdf["name"], "normal": [normal_name(n) for n in pdf["name"]]})


def _grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.DataFrame({"normal": pdf["normal"], "grams": [grams(n) for n in pdf["normal"]]})


def _spelled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The candidates whose spelling is near enough."""
    for pdf in batches:
        near = [spelled_like(n, f) is not None or spelled_like(singular(n), f) is not None for n, f in zip(pdf["normal"], pdf["form"])]
        yield pdf.loc[near, ["normal", "known_id", "cosine"]]


def entry_forms(known: DataFrame) -> DataFrame:
    """known_id, form: the comparison forms of each entry's name and aliases, each form once."""
    spelled = known.select(F.col("known_id").cast("int").alias("known_id"), F.explode(F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("name"))
    normal = spelled.filter("trim(name) <> ''")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"known_id": pdf["known_id"], "form": [normal_name(n) for n in pdf["name"]]})

    return normal.mapInPandas(run, "known_id int, form string").filter("form <> ''").groupBy("form").agg(F.min("known_id").alias("known_id"))


def _floor(name: Column, threshold: float, short_threshold: float) -> Column:
    return F.when(F.char_length(name) < SHORT, F.lit(min(short_threshold, threshold))).otherwise(F.lit(threshold))


def vectors(names: DataFrame, idf: DataFrame, unseen: float) -> DataFrame:
    """normal, gram, w: the weighted n-grams of names; grams that no entry has weigh ``unseen``."""
    grammed = names.select("normal").mapInPandas(_grams, "normal string, grams array<string>").select("normal", F.explode("grams").alias("gram"))
    return grammed.join(idf, "gram", "left").select("normal", "gram", F.coalesce("w", F.lit(unseen)).alias("w"))


def matched_names(names: DataFrame, known: DataFrame, threshold: float = THRESHOLD, short_threshold: float = SHORT_THRESHOLD, margin: float = MARGIN) -> DataFrame:
    """normal, known_id of the normalised names that mean an entry; ``names`` has one row per distinct ``normal``.

    Only the rare n-grams of a name are looked up: the common ones that together can't reach the threshold are left out
    (their part of the name's norm bounds the cosine of an entry that shares no other), so no pair above it is lost.
    """
    shelf = Shelf(names.sparkSession)
    forms = shelf.keep(entry_forms(known))
    plural = F.when(F.col("normal").endswith("ies"), F.regexp_replace("normal", "ies$", "y")).otherwise(F.regexp_replace("normal", "(?<=[^s])s$", ""))
    lookup = forms.select(F.col("form").alias("lookup"), F.col("known_id").alias("found"))
    exact = names.join(lookup, F.col("normal") == F.col("lookup"), "left").drop("lookup")
    exact = exact.join(lookup.withColumnRenamed("found", "found_plural"), plural == F.col("lookup"), "left")
    exact = shelf.keep(exact.select("normal", F.coalesce("found", "found_plural").alias("known_id")))
    open_names = exact.filter("known_id is null").select("normal")

    n_forms = forms.count()
    index = forms.select(F.col("form").alias("normal")).mapInPandas(_grams, "normal string, grams array<string>").select(F.col("normal").alias("form"), F.explode("grams").alias("gram"))
    idf = shelf.keep(index.groupBy("gram").agg(F.log(F.lit(float(n_forms)) / F.count(F.lit(1)) + 1.0).alias("w")))
    entry = index.join(idf, "gram")
    postings = shelf.keep(entry.select("gram", "form"))
    square = F.col("w") * F.col("w")
    entries = shelf.keep(entry.groupBy("form").agg(F.sum(square).alias("form_square"), F.map_from_entries(F.collect_list(F.struct("gram", square.alias("square")))).alias("squares")).join(forms, "form"))

    asked = shelf.keep(vectors(open_names, idf, math.log(n_forms + 1.0)))
    rising = Window.partitionBy("normal").orderBy("w", "gram").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("normal")
    ranked = asked.withColumn("so_far", F.sum(square).over(rising)).withColumn("name_square", F.sum(square).over(whole))
    floor = _floor(F.col("normal"), threshold, short_threshold)
    rare = shelf.keep(ranked.filter(F.col("so_far") >= floor * floor * F.col("name_square") * (1 - 1e-9)).select("normal", "gram"))
    # a form of another length is struck out anyway: MAX_EDITS apart, and up to two letters less in the singular
    apart = F.char_length("normal") - F.char_length("form")
    pairs = rare.join(postings, "gram").filter(apart.between(-MAX_EDITS, MAX_EDITS + 2)).select("normal", "form").distinct()
    profiles = asked.groupBy("normal").agg(F.sum(square).alias("name_square"), F.collect_list("gram").alias("grams"))
    met = pairs.join(profiles, "normal").join(entries, "form")
    dot = F.aggregate(F.array_intersect("grams", F.map_keys("squares")), F.lit(0.0), lambda a, g: a + F.col("squares")[g])
    cosines = met.select("normal", "form", "known_id", (dot / F.sqrt(F.col("name_square") * F.col("form_square"))).alias("cosine")).filter(F.col("cosine") >= floor)
    alike = cosines.mapInPandas(_spelled, "normal string, known_id int, cosine double")
    per_entry = alike.groupBy("normal", "known_id").agg(F.max("cosine").alias("cosine"))
    best_first = Window.partitionBy("normal").orderBy(F.desc("cosine"), "known_id")
    two = per_entry.withColumn("place", F.row_number().over(best_first)).filter("place <= 2")  # limited before the shuffle
    best = two.groupBy("normal").agg(F.min_by("known_id", "place").alias("known_id"), (F.max("cosine") - F.min("cosine")).alias("lead"), F.max("place").alias("n"))
    close = best.filter((F.col("n") == 1) | (F.col("lead") >= margin)).select("normal", "known_id")
    return exact.filter("known_id is not null").unionByName(close)


def mapped(entities: DataFrame, known: DataFrame, column: str = "entity_name") -> DataFrame:
    """record_id, known_id of every row with a usable name; 0 where no entry is meant."""
    usable = entities.filter(usable_name(F.col(column))).select("record_id", F.col(column).alias("name"))
    distinct = usable.select("name").distinct()
    normal = checkpointed(distinct.mapInPandas(_normalise, "name string, normal string"))
    matches = matched_names(normal.select("normal").distinct(), known)
    meant = normal.join(matches, "normal").select("name", "known_id")
    return usable.join(meant, "name", "left").select("record_id", F.coalesce("known_id", F.lit(0)).cast("int").alias("known_id"))


def p7_found(spark: SparkSession, root: str) -> DataFrame:
    return mapped(table(spark, root, "entities"), table(spark, root, "known_entities"))


def p7_unmatched(spark: SparkSession, root: str) -> DataFrame:
    """entity_name and number of rows of the usable names that mean no entry."""
    entities = table(spark, root, "entities")
    return p7_found(spark, root).filter("known_id = 0").join(entities.select("record_id", "entity_name"), "record_id").groupBy("entity_name").agg(F.count(F.lit(1)).alias("n_rows"))
