"""Entities: from what attributes are bound to, from promoted candidates, and from lexicon terms in chunks.

Defined results: sources merge per document by name (case aside) and type, the label of the most trusted source stays;
names under two characters, generic names and names of kept attributes are no entities; null chunks and texts are skipped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from specweave.functions.keys import content_id
from specweave.functions.text import norm
from specweave.operators.candidates import LEXICON_SQL, corpus, word_sql
from specweave.operators.cleaning import delivered_once
from specweave.operators.mentions import matched_text, mentions
from specweave.session import table
from specweave.sources.lexicons import Lexicon

#: Weight and rank of a source; thresholds.
ORIGINS = {"binding": 0.9, "promotion": 0.85, "lexicon": 0.6, "llm": 0.7}
MIN_MENTIONS, MIN_CONFIDENCE = 2, 0.5
EVIDENCE = "array<struct<chunk_id:string,text:string>>"


def _item(chunk: Column, text: Column) -> Column:
    return F.when(chunk.isNotNull() & text.isNotNull(), F.struct(chunk.alias("chunk_id"), text.alias("text")))


def _typed(rows: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Adds type and layer of the name: the lexicon's, else Object and Other."""
    look = lexicon.entity_lookup(rows.sparkSession).select(F.col("key").alias("_k"), F.col("layer").alias("_l"), F.col("type").alias("_t"))
    joined = rows.withColumn("_k", norm(F.col("name"))).join(F.broadcast(look), "_k", "left")
    return joined.withColumn("entity_type", F.coalesce("_t", F.lit("Object"))).withColumn("layer", F.coalesce("_l", F.lit("Other"))).drop("_k", "_l", "_t")


def from_bindings(kept: DataFrame, chunks: DataFrame) -> DataFrame:
    """One row per document and bound entity; per chunk the evidence of the lowest attribute whose words are in the chunk."""
    c = chunks.select("document_id", F.col("chunk_id").alias("source_chunk"), F.col("source_text").alias("_text"))
    rows = kept.filter("entity is not null").select("document_id", F.col("entity").alias("name"), "attribute_id", "source_chunk", F.col("binding.evidence").alias("said"), "source_text").join(c, ["document_id", "source_chunk"], "left")
    words = F.when((F.col("said") != "") & F.contains("_text", F.col("said")), F.col("said")).when((F.col("source_text") != "") & F.contains("_text", F.col("source_text")), F.col("source_text"))
    per_chunk = rows.withColumn("words", words).groupBy("document_id", "name", "source_chunk").agg(
        F.collect_set("attribute_id").alias("attrs"), F.min_by("words", F.when(F.col("words").isNotNull(), F.col("attribute_id"))).alias("words")
    )
    return per_chunk.groupBy("document_id", "name").agg(
        F.array_distinct(F.flatten(F.collect_list("attrs"))).alias("attrs"), F.collect_set("source_chunk").alias("chunks"), F.collect_set(_item(F.col("source_chunk"), F.col("words"))).cast(EVIDENCE).alias("evidence")
    ).withColumn("origin", F.lit("binding"))


def from_promotions(discarded: DataFrame, chunks: DataFrame) -> DataFrame:
    """Discarded candidates to which others are bound."""
    c = chunks.select("document_id", F.col("chunk_id").alias("source_chunk"), F.col("source_text").alias("_text"))
    rows = discarded.filter("score.discard_reason = 'promoted'").join(c, ["document_id", "source_chunk"], "left")
    words = F.when(F.contains("_text", F.col("source_text")), F.col("source_text"))
    return rows.groupBy("document_id", F.col("display_name").alias("name")).agg(
        F.array().cast("array<string>").alias("attrs"), F.collect_set("source_chunk").alias("chunks"), F.collect_set(_item(F.col("source_chunk"), words)).cast(EVIDENCE).alias("evidence")
    ).withColumn("origin", F.lit("promotion"))


def from_lexicon(chunks: DataFrame, lexicon: Lexicon, min_mentions: int = MIN_MENTIONS) -> DataFrame:
    """Lexicon terms that stand in at least ``min_mentions`` chunks of a document; evidence is the first term as written."""
    text = chunks.select("document_id", "chunk_id", F.col("source_text").alias("text"))
    met = mentions(text, ["document_id", "chunk_id"], F.broadcast(lexicon.lexicon_terms(chunks.sparkSession)), plural=False)
    first = met.groupBy("document_id", "chunk_id", F.col("canonical").alias("name")).agg(F.min_by("term", "term_ord").alias("term"))
    said = first.join(text, ["document_id", "chunk_id"]).withColumn("words", matched_text(F.col("text"), F.col("term")))
    return said.groupBy("document_id", "name").agg(
        F.array().cast("array<string>").alias("attrs"), F.collect_set("chunk_id").alias("chunks"), F.collect_set(_item(F.col("chunk_id"), F.col("words"))).cast(EVIDENCE).alias("evidence")
    ).filter(F.size("chunks") >= min_mentions).withColumn("origin", F.lit("lexicon"))


def generate(attributes: DataFrame, discarded: DataFrame, chunks: DataFrame, lexicon: Lexicon = Lexicon(), proposals: DataFrame | None = None) -> DataFrame:
    """Entities of a corpus.  ``attributes`` are the kept ones; ``proposals`` (as the other sources) may come from a model."""
    raw = from_bindings(attributes, chunks).unionByName(from_promotions(discarded, chunks)).unionByName(from_lexicon(chunks, lexicon))
    if proposals is not None:
        raw = raw.unionByName(proposals)
    key = F.lower("name")
    taken = attributes.select("document_id", F.lower("attribute_name").alias("key")).union(attributes.select("document_id", F.lower("display_name").alias("key"))).distinct()
    fit = raw.withColumn("key", key).filter((F.length(F.trim("name")) >= 2) & ~F.col("key").isin(*lexicon.generic)).join(taken, ["document_id", "key"], "left_anti")
    rank = F.array_position(F.array(*[F.lit(o) for o in ORIGINS]), F.col("origin"))
    merged = _typed(fit, lexicon).groupBy("document_id", "key", "entity_type").agg(
        F.min_by(F.struct("name", "layer", "origin"), F.struct(rank.alias("rank"), "name")).alias("label"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("attrs")))).alias("attrs"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("chunks")))).alias("chunks"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("evidence")))).alias("evidence"),
    )
    weight = F.try_element_at(F.create_map(*[F.lit(x) for kv in ORIGINS.items() for x in kv]), F.col("label.origin"))
    confidence = weight * F.least(F.lit(1.0), (F.size("chunks") + F.size("attrs")) / F.lit(3.0))
    return merged.withColumn("c", confidence).filter(F.col("c") >= MIN_CONFIDENCE).select(
        "document_id", content_id("ent-", F.col("document_id"), F.col("label.name"), F.col("entity_type")).alias("entity_id"), F.col("label.name").alias("entity_name"), "entity_type", F.col("label.layer").alias("layer"),
        F.col("attrs").alias("source_attributes"), F.col("chunks").alias("source_chunks"), F.col("evidence").alias("supporting_evidence"), F.col("label.origin").alias("origin"), F.round("c", 6).alias("confidence"),
    )


def problems(entities: DataFrame, chunks: DataFrame) -> DataFrame:
    """document_id, entity_id, problem: no evidence, no chunks, evidence that isn't in its chunk."""
    bare = F.when(F.size("supporting_evidence") == 0, F.lit("no evidence")).when(F.size("source_chunks") == 0, F.lit("no chunks"))
    empty = entities.select("document_id", "entity_id", bare.alias("problem")).filter("problem is not null")
    ev = entities.select("document_id", "entity_id", F.explode("supporting_evidence").alias("e")).select("document_id", "entity_id", F.col("e.chunk_id").alias("chunk_id"), F.col("e.text").alias("words"))
    lost = ev.join(chunks.select("document_id", "chunk_id", "source_text"), ["document_id", "chunk_id"], "left").filter("source_text is null or not contains(source_text, words)")
    return empty.unionByName(lost.select("document_id", "entity_id", F.lit("evidence not in chunk").alias("problem")).distinct())


def given_attributes(spark: SparkSession, root: str, once=delivered_once) -> tuple[DataFrame, DataFrame]:
    """Kept and discarded attributes of the given table (first deliveries), with their document's id."""
    a = once(table(spark, root, "attributes"), ["attribute_id"]).withColumn("document_id", F.col("source_document"))
    discarded = F.coalesce(F.col("score.route") == "discard", F.lit(False))
    return a.filter(~discarded), a.filter(discarded)


def q_entities(spark: SparkSession, root: str) -> DataFrame:
    _, chunks, lexicon = corpus(spark, root)
    e = generate(*given_attributes(spark, root), chunks, lexicon)
    return e.select("document_id", "entity_id", "entity_name", "entity_type", "layer", "origin", "confidence", F.size("source_attributes").alias("n_attributes"), F.size("source_chunks").alias("n_chunks"))


def q_binding_sources(spark: SparkSession, root: str) -> DataFrame:
    _, chunks, _ = corpus(spark, root)
    return from_bindings(given_attributes(spark, root)[0], chunks).select("document_id", "name", F.size("attrs").alias("n_attributes"), F.size("chunks").alias("n_chunks"), F.size("evidence").alias("n_evidence"))


def q_problems(spark: SparkSession, root: str) -> DataFrame:
    """What is wrong with the given entities (first deliveries)."""
    _, chunks, _ = corpus(spark, root)
    return problems(delivered_once(table(spark, root, "entities"), ["document_id", "entity_id"]), chunks)


_A = "a as (select *, source_document as document_id from attributes where record_id in (select min(record_id) from attributes group by attribute_id)), c as (select * from chunks where record_id in (select min(record_id) from chunks group by document_id, chunk_id))"
_TERMS = f"""kn as (select name, row_number() over (order by min(known_id)) as o, arg_max(aliases, known_id) as aliases from known_entities where trim(name) <> '' group by name),
tm as (select name, t, generate_subscripts(ts, 1) as n from (select name, list_concat([name], coalesce(aliases, [])) as ts, unnest(list_concat([name], coalesce(aliases, []))) as t from kn)
  union all select b, b, 1 from (select unnest([{", ".join(f"'{b}'" for b in Lexicon().business)}]) as b) where b not in (select name from kn))"""
_ENTITIES = f"""with {_A}, {LEXICON_SQL}, {_TERMS},
ka as (select * from a where coalesce(score.route, '') <> 'discard'), kd as (select * from a where score.route = 'discard' and score.discard_reason = 'promoted'),
r1 as (select ka.document_id, ka.entity as name, 'binding' as origin, 1 as rank, 0.9 as wt, list(distinct attribute_id) as attrs, list(distinct ka.source_chunk) filter (ka.source_chunk is not null) as chunks from ka where entity is not null group by all),
r2 as (select kd.document_id, kd.display_name as name, 'promotion' as origin, 2 as rank, 0.85 as wt, []::varchar[] as attrs, list(distinct kd.source_chunk) filter (kd.source_chunk is not null) as chunks from kd group by kd.document_id, kd.display_name),
r3 as (select document_id, name, 'lexicon' as origin, 3 as rank, 0.6 as wt, []::varchar[] as attrs, list(distinct chunk_id) as chunks from c, tm
  where {word_sql("source_text", "t", False)} group by document_id, name having count(distinct chunk_id) >= {MIN_MENTIONS}),
al as (select * from r1 union all select * from r2 union all select * from r3),
tk as (select document_id, lower(attribute_name) as k from ka union select document_id, lower(display_name) from ka),
ft as (select al.*, lower(al.name) as k, coalesce(lex.ty, 'Object') as ty, coalesce(lex.layer, 'Other') as layer from al left join lex on lex.key = lower(trim(regexp_replace(al.name, '\\s+', ' ', 'g')))
  where length(trim(al.name)) >= 2 and lower(al.name) not in ({", ".join(f"'{g}'" for g in Lexicon().generic)}) and not exists (select 1 from tk where tk.document_id = al.document_id and tk.k = lower(al.name))),
mg as (select document_id, k, ty, min_by(name, (rank, name)) as name, min_by(layer, (rank, name)) as layer, min_by(origin, (rank, name)) as origin, min_by(wt, (rank, name)) as wt,
  len(list_distinct(flatten(list(attrs)))) as n_attributes, len(list_distinct(flatten(list(coalesce(chunks, []))))) as n_chunks from ft group by document_id, k, ty)
select document_id, 'ent-' || left(sha256(coalesce(document_id, '') || '|' || name || '|' || ty), 16) as entity_id, name as entity_name, ty as entity_type, layer, origin, round(wt * least(1.0, (n_chunks + n_attributes) / 3.0), 6)::double as confidence, n_attributes::int as n_attributes, n_chunks::int as n_chunks
  from mg where wt * least(1.0, (n_chunks + n_attributes) / 3.0) >= {MIN_CONFIDENCE}"""
QUERIES = {"entity_problems": q_problems, "entities": q_entities, "entity_binding_sources": q_binding_sources}
ORACLES = {
    "entity_problems": f"""with {_A}, e as (select * from entities where record_id in (select min(record_id) from entities group by document_id, entity_id)), x as (select document_id, entity_id, unnest(supporting_evidence) as ev from e)
select document_id, entity_id, case when len(supporting_evidence) = 0 then 'no evidence' else 'no chunks' end as problem from e where len(supporting_evidence) = 0 or len(source_chunks) = 0
union all select distinct x.document_id, x.entity_id, 'evidence not in chunk' from x left join c on c.document_id = x.document_id and c.chunk_id = x.ev.chunk_id where c.source_text is null or not contains(c.source_text, x.ev.text)""",
    "entities": _ENTITIES,
    "entity_binding_sources": f"""with {_A}, r as (select a.document_id, a.entity as name, attribute_id, a.source_chunk, case when a.binding.evidence <> '' and contains(c.source_text, a.binding.evidence) then a.binding.evidence when a.source_text <> '' and contains(c.source_text, a.source_text) then a.source_text end as w
  from a left join c on c.document_id = a.document_id and c.chunk_id = a.source_chunk where a.entity is not null and coalesce(a.score.route, '') <> 'discard'),
e as (select document_id, name, count(distinct source_chunk) as n from r where w is not null and source_chunk is not null group by all)
select r.document_id, r.name, count(distinct attribute_id)::int as n_attributes, count(distinct source_chunk)::int as n_chunks, coalesce(any_value(e.n), 0)::int as n_evidence from r left join e on e.document_id = r.document_id and e.name = r.name group by 1, 2""",
}
