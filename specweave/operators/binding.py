"""Binding candidates to entities: five scopes in order of priority, as one coalesced struct.

Each scope is a lookup joined to the candidates or an expression over the entities mentioned in the candidate's chunk; a
candidate takes the first that applies.  Confidence falls with the distance of the heading that binds.

Defined results: a candidate that no scope binds is ``dangling`` with confidence 0; ties within a pattern go to the
earliest place, then the longest entity name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specweave.functions.text import UI, extract, norm, quoted
from specweave.operators.candidates import document_terms, heading_entity, tail_items
from specweave.operators.mentions import mentions
from specweave.sources.lexicons import Lexicon

#: Confidence by scope, loss per heading level, and the least share that is left.
SCOPES = {"table_subject": 1.0, "nearest_heading": 0.9, "syntactic": 0.85, "compound_modifier": 0.7, "document_default": 0.5}
DECAY, FLOOR = 0.05, 0.5
BINDING_TYPE = "struct<entity_name:string,scope:string,structural_distance:int,confidence:double,evidence:string>"

# What may follow a bound name; names that patterns can be made of.
_STOP = r"(?=\s+(?:is|are|was|were|takes|of|and|in|such)\b|[.,;]|$)"
_NAMEABLE = r"^[A-Za-z][A-Za-z-]*(?:\s+[A-Za-z][A-Za-z-]*)?$"


def confidence(scope: str, distance: Column) -> Column:
    return F.round(F.lit(SCOPES[scope]) * F.greatest(F.lit(FLOOR), 1 - F.lit(DECAY) * distance), 6)


def bound(entity: Column, scope: str, distance: Column, evidence: Column) -> Column:
    """The binding as a struct, null where there is no entity."""
    made = F.struct(entity.alias("entity_name"), F.lit(scope).alias("scope"), distance.cast("int").alias("structural_distance"), confidence(scope, distance).alias("confidence"), evidence.alias("evidence"))
    return F.when(entity.isNotNull(), made)


def patterns(name: Column, entity: Column) -> list[Column]:
    """Possessive, ``X of the E``, ``the E has X``, in order of priority; the entity is group 1."""
    e = F.concat(F.lit("("), quoted(entity), F.lit(")"))
    x = F.concat(F.lit("(?:"), quoted(name), F.lit(")" + _STOP))
    return [
        F.concat(F.lit(UI + r"\b"), e, F.lit(r"'s\s+"), x),
        F.concat(F.lit(UI + r"\b"), x, F.lit(r"\s+of\s+the\s+"), e, F.lit(r"\b")),
        F.concat(F.lit(UI + r"\bthe\s+"), e, F.lit(r"\s+has\s+(?:an?\s+)?"), x),
    ]


def syntactic(text: Column, name: Column, names: Column) -> Column:
    """struct(entity, evidence) of the first pattern in ``text`` that ties ``name`` to one of ``names``; null if none."""

    def tries(entity: Column) -> Column:
        must = F.concat(F.lit(UI + r"\b(?:each\s+)?("), quoted(entity), F.lit(r")\s+(?:SHALL|MUST)\s+have\s+([^.!?]*)"))
        tried = F.transform(F.array(*patterns(name, entity), must), lambda p, kind: F.struct(kind.alias("kind"), p.alias("p"), extract(text, p, 0).alias("whole")))

        def lists_name(t: Column) -> Column:
            items = F.flatten(F.transform(F.regexp_extract_all(text, t["p"], F.lit(2)), tail_items))
            return F.exists(items, lambda i: (F.lower(i) == F.lower(name)) | (F.lower(i) == F.concat(F.lower(name), F.lit("s"))))

        hits = F.filter(tried, lambda t: (t["whole"] != "") & F.when(t["kind"] == 3, lists_name(t)).otherwise(name.rlike(_NAMEABLE)))
        return F.transform(
            hits, lambda t: F.struct(t["kind"].alias("kind"), F.instr(text, t["whole"]).alias("at"), (-F.length(entity)).alias("short"), extract(text, t["p"], 1).alias("entity"), t["whole"].alias("evidence"))
        )

    near = F.filter(names, lambda e: F.contains(F.lower(text), F.lower(e)))
    return F.array_min(F.flatten(F.transform(near, tries)))


def resolved_names(texts: DataFrame, lexicon: Lexicon, extra: DataFrame) -> DataFrame:
    """document_id, text, entity of texts (document_id, text) that name an entity: by ``X attributes``, by equality, or by
    the longest known name in them."""
    spark = texts.sparkSession
    t = texts.filter("text is not null").distinct().withColumn("implied", heading_entity(F.col("text")))
    lookup = lexicon.entity_lookup(spark).select(F.col("key").alias("k"), F.col("name").alias("known"))
    own = extra.select("document_id", norm(F.col("canonical")).alias("k"), F.col("canonical").alias("own"))
    by_key = (
        t.withColumn("k", norm(F.coalesce("implied", "text")))
        .join(F.broadcast(lookup), "k", "left")
        .join(own, ["document_id", "k"], "left")
        .select("document_id", "text", F.coalesce("known", "own", "implied").alias("entity"))
    )
    keys = ["document_id", "text"]
    inside = t.select("document_id", "text", F.col("text").alias("key_text")).withColumnRenamed("text", "t").withColumnRenamed("key_text", "text")
    terms = lexicon.mention_terms(spark).filter("source = 'entity'")
    held = mentions(inside, ["document_id", "t"], F.broadcast(terms), plural=False).unionByName(mentions(inside, ["document_id", "t"], extra, plural=False, by=["document_id"]))
    longest = held.groupBy("document_id", F.col("t").alias("text")).agg(F.min_by("canonical", F.struct(-F.length("canonical"), "canonical_ord")).alias("inner"))
    return by_key.join(longest, keys, "left").select(*keys, F.coalesce("entity", "inner").alias("entity")).filter("entity is not null")


def default_entities(titles: DataFrame, lexicon: Lexicon, extra: DataFrame) -> DataFrame:
    """document_id, title, entity: the known entity that a title names most often."""
    spark = titles.sparkSession
    terms = lexicon.mention_terms(spark).filter("source = 'entity'")
    text = titles.select("document_id", F.col("title").alias("text"))
    held = mentions(text, ["document_id"], F.broadcast(terms), plural=False).unionByName(mentions(text, ["document_id"], extra, plural=False, by=["document_id"]))
    counted = held.join(titles, "document_id").withColumn("n", F.regexp_count("title", F.concat(F.lit(UI + r"\b"), quoted(F.col("canonical")), F.lit(r"\b"))))
    return counted.groupBy("document_id").agg(F.first("title").alias("title"), F.min_by("canonical", F.struct(-F.col("n"), "canonical_ord")).alias("default_entity"))


def bind(candidates: DataFrame, chunks: DataFrame, blocks: DataFrame, titles: DataFrame, found: DataFrame, lexicon: Lexicon = Lexicon(), default_entity: str | None = None) -> DataFrame:
    """Candidates with ``binding``, and with what scoring needs of their surroundings: source_text, heading_path, names,
    block_kind, page."""
    extra = document_terms(blocks, lexicon)
    subject = F.col("tbl.subject_hint")
    around = blocks.select("document_id", "block_id", F.col("kind").alias("block_kind"), "page", subject.alias("subject"))
    subjects = resolved_names(blocks.select("document_id", subject.alias("text")), lexicon, extra).select("document_id", F.col("text").alias("subject"), F.col("entity").alias("subject_entity"))
    entity_names = found.filter("source = 'entity'").select("document_id", "block_id", F.col("canonical").alias("name"))
    by_chunk = chunks.select("document_id", "chunk_id", F.explode("block_ids").alias("block_id")).join(entity_names, ["document_id", "block_id"]).groupBy("document_id", "chunk_id").agg(F.collect_set("name").alias("names"))

    heads = F.transform(F.reverse("heading_path"), lambda h, i: F.struct(i.alias("i"), h.alias("h"), heading_entity(h).alias("implied")))
    nearest = F.try_element_at(F.filter(heads, lambda x: x["implied"].isNotNull()), F.lit(1))
    paths = chunks.select("document_id", "chunk_id", "source_text", "heading_path", nearest.alias("near"))
    implied = resolved_names(paths.select("document_id", F.col("near.h").alias("text")), lexicon, extra).select("document_id", F.col("text").alias("near_text"), F.col("entity").alias("near_entity"))
    rows = (
        candidates.join(around, ["document_id", "block_id"], "left")
        .join(subjects, ["document_id", "subject"], "left")
        .join(paths, ["document_id", "chunk_id"])
        .withColumn("near_text", F.col("near.h"))
        .join(implied, ["document_id", "near_text"], "left")
        .join(by_chunk, ["document_id", "chunk_id"], "left")
        .join(default_entities(titles, lexicon, extra), "document_id", "left")
        .withColumn("names", F.coalesce("names", F.array().cast("array<string>")))
    )
    text = F.coalesce(F.when(F.col("sentence") != "", F.col("sentence")), F.col("source_text"))
    name = F.col("raw_name")
    # a candidate that a table or heading binds needs the patterns only where they are a signal, in prose
    needed = (F.col("origin") == "prose_regex") | (F.col("subject_entity").isNull() & F.col("near_entity").isNull())
    rows = rows.withColumn("pattern", F.when(needed & F.contains(F.lower(text), F.lower(name)), syntactic(text, name, F.col("names"))))

    rest = lambda e: F.trim(F.substring(name, F.length(e) + 2, F.length(name)))
    opens = lambda e: F.lower(name).startswith(F.concat(F.lower(e), F.lit(" ")))
    head = lambda e: F.lower(F.try_element_at(F.split(rest(e), r"\s+"), F.lit(-1)))
    property_like = lambda e: lexicon.noun_kind(head(e)).isNotNull() | lexicon.gazetteer_match(rest(e)).isNotNull()
    modifiers = F.filter("names", lambda e: opens(e) & (F.length(name) > F.length(e) + 1) & property_like(e))
    modifier = F.array_min(F.transform(modifiers, lambda e: F.struct((-F.length(e)).alias("short"), e.alias("e"))))["e"]
    zero = F.lit(0)
    dangling = F.struct(F.lit(None).cast("string").alias("entity_name"), F.lit("dangling").alias("scope"), F.lit(0).alias("structural_distance"), F.lit(0.0).alias("confidence"), F.lit(None).cast("string").alias("evidence"))
    binding = F.coalesce(
        bound(F.col("subject_entity"), "table_subject", zero, F.col("subject")),
        bound(F.col("near_entity"), "nearest_heading", F.coalesce(F.col("near.i"), zero), F.col("near.h")),
        bound(F.col("pattern.entity"), "syntactic", zero, F.col("pattern.evidence")),
        bound(modifier, "compound_modifier", zero, name),
        bound(F.coalesce(F.lit(default_entity), F.col("default_entity")), "document_default", zero, F.col("title")),
        dangling,
    )
    return rows.withColumn("binding", binding.cast(BINDING_TYPE)).withColumn("patterned", F.col("pattern").isNotNull()).drop("pattern", "near", "near_text", "near_entity", "default_entity", "title", "names")


def bind_counts(bound_rows: DataFrame) -> DataFrame:
    """document_id, entity_key, n: candidates bound to each entity, the entity's own mentions left out."""
    key = norm(F.col("binding.entity_name"))
    return bound_rows.filter(key.isNotNull() & (key != norm(F.col("raw_name")))).groupBy("document_id", key.alias("entity_key")).agg(F.count(F.lit(1)).alias("n"))
