"""Mapping attributes to canonical entities, with reasons for those that aren't mapped.

Defined results: attributes without bound entity are unmapped without a reason of their own; of entities with one name
the lowest id counts; everything is within one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from specweave.functions.keys import content_id, id_key
from specweave.functions.text import norm
from specweave.operators import quality
from specweave.operators.cleaning import delivered_once
from specweave.session import checkpointed, table
from specweave.sources.lexicons import Lexicon

#: Least confidence; words that make a constraint; scopes that own their attribute.
MIN_CONFIDENCE = 0.5
CONSTRAINT = r"\b(SHALL|MUST|SHOULD|REQUIRED)\b"
OWNING = ("table_subject", "nearest_heading", "syntactic")


def _known(asked: DataFrame, entities: DataFrame, cents: DataFrame, decisions: DataFrame) -> DataFrame:
    """Of each asked name (document_id, _name, _name2) the entity that has it (case aside), else the one that has the lexicon's
    name for it, with its group and the group's decision."""
    named = entities.groupBy("document_id", F.lower("entity_name").alias("_key")).agg(F.min("entity_id").alias("_entity"), F.min_by("entity_name", "entity_id").alias("_entity_name")).filter("_entity is not null")
    tries = asked.select("document_id", "_name", "_name2", F.posexplode(F.array("_name", "_name2")).alias("_try", "_key"))
    found = tries.join(named, ["document_id", "_key"]).groupBy("document_id", "_name", "_name2").agg(F.min_by(F.struct("_entity", "_entity_name"), "_try").alias("_f"))
    status = decisions.select("document_id", "canonical_id", "validation_status", "overall_score")
    member = cents.select("document_id", F.explode("member_ids").alias("_entity"), "canonical_id", F.col("source_chunks").alias("_chunks"))
    return found.select("document_id", "_name", "_name2", "_f.*").join(member, ["document_id", "_entity"], "left").join(status, ["document_id", "canonical_id"], "left")


def targets(attributes: DataFrame, entities: DataFrame, cents: DataFrame, decisions: DataFrame, lexicon: Lexicon = Lexicon(), include_review: bool = False) -> DataFrame:
    """Every attribute with its target and ``rejection`` (null: mapped); texts that aren't needed for that are left out."""
    spark, bound = attributes.sparkSession, F.col("binding.entity_name")
    canonical = lexicon.entity_lookup(spark).select(F.col("key").alias("_k"), F.lower("name").alias("_name2"))
    relation = relationship(F.col("binding.evidence"), F.col("source_text"), F.col("binding.scope"))
    rows = attributes.select(
        "document_id", "attribute_id", "source_chunk", F.lower(bound).alias("_name"), norm(bound).alias("_k"), F.col("binding.evidence").alias("said"), (F.col("binding.confidence") * F.col("confidence")).alias("_sure"), relation.alias("relationship_type")
    )
    a = rows.join(F.broadcast(canonical), "_k", "left").drop("_k")
    names = _known(a.select("document_id", "_name", "_name2").filter("_name is not null").distinct(), entities, cents, decisions)
    names = names.withColumnsRenamed({"document_id": "_d", "_name": "_n", "_name2": "_n2"})
    a = a.join(names, (F.col("document_id") == F.col("_d")) & (F.col("_name") == F.col("_n")) & F.col("_name2").eqNullSafe(F.col("_n2")), "left").drop("_d", "_n", "_n2")
    eligible = F.col("validation_status").isin(*(["ACCEPT", "REVIEW"] if include_review else ["ACCEPT"]))
    score = F.col("_sure") * F.col("overall_score")
    together = F.coalesce(F.array_contains("_chunks", F.col("source_chunk")), F.lit(False)) | F.coalesce((F.col("said") != "") & F.contains(F.lower("said"), F.lower("_entity_name")), F.lit(False))
    why = (
        F.when(F.col("_name").isNull(), F.lit("dangling")).when(F.col("_entity").isNull(), F.lit("unresolved_entity")).when(F.col("canonical_id").isNull(), F.lit("no_canonical_group"))
        .when(~F.coalesce(eligible, F.lit(False)), F.lit("ineligible_entity")).when(~F.coalesce(score >= MIN_CONFIDENCE, F.lit(False)), F.lit("below_min_confidence")).when(~together, F.lit("no_cooccurrence"))
    )
    return a.withColumn("rejection", why).withColumn("mapping_score", score)


def judged(attributes: DataFrame, entities: DataFrame, cents: DataFrame, decisions: DataFrame, chunks: DataFrame, lexicon: Lexicon = Lexicon(), include_review: bool = False) -> DataFrame:
    """``targets`` with the evidence (``supporting``) of those that are mapped."""
    kept = ["document_id", "attribute_id", "canonical_id", "relationship_type", "source_chunk", "said", "mapping_score", "rejection"]
    rows = checkpointed(targets(attributes, entities, cents, decisions, lexicon, include_review).select(*kept))
    mapped, said = rows.filter("rejection is null"), F.col("said")
    # each item of evidence counts if it stands in its own chunk, which needn't be the attribute's
    items = attributes.join(mapped.select("document_id", "attribute_id"), ["document_id", "attribute_id"], "left_semi").select("document_id", "attribute_id", F.explode("evidence").alias("e"))
    own = items.select("document_id", "attribute_id", F.col("e.chunk_id").alias("chunk_id"), F.col("e.text").alias("text"))
    bound = mapped.filter(said != "").select("document_id", "attribute_id", F.col("source_chunk").alias("chunk_id"), said.alias("text"))
    held = own.unionByName(bound).join(chunks.select("document_id", "chunk_id", "source_text"), ["document_id", "chunk_id"]).filter(F.contains("source_text", F.col("text")))
    texts = held.groupBy("document_id", "attribute_id").agg(F.array_sort(F.collect_set(F.struct("chunk_id", "text"))).alias("supporting"))
    none = F.array().cast("array<struct<chunk_id:string,text:string>>")
    return mapped.join(texts, ["document_id", "attribute_id"], "left").withColumn("supporting", F.coalesce("supporting", none)).unionByName(rows.filter("rejection is not null").withColumn("supporting", none))


def mappings(rows: DataFrame, digits: int = 6) -> DataFrame:
    return rows.filter("rejection is null").select(
        "document_id", content_id("map-", F.col("attribute_id"), F.col("canonical_id"), F.col("relationship_type")).alias("mapping_id"), "attribute_id", F.col("canonical_id").alias("entity_id"), "relationship_type", "source_chunk",
        F.col("supporting").alias("supporting_evidence"), F.round("mapping_score", digits).alias("confidence"),
    )


def problems(mapped: DataFrame, attributes: DataFrame, cents: DataFrame) -> DataFrame:
    """document_id, problem: mappings of unknown attributes or entities, ids that occur twice, confidences out of range."""
    said = lambda what: F.concat(F.lit(f"{what}: "), "mapping_id").alias("problem")
    no_attribute = mapped.join(attributes.select("document_id", "attribute_id"), ["document_id", "attribute_id"], "left_anti").select("document_id", said("unknown attribute"))
    no_entity = mapped.join(cents.select("document_id", F.col("canonical_id").alias("entity_id")), ["document_id", "entity_id"], "left_anti").select("document_id", said("unknown entity"))
    twice = mapped.groupBy("document_id", "mapping_id").count().filter("count > 1").select("document_id", said("twice"))
    odd = mapped.filter("confidence is null or confidence < 0 or confidence > 1").select("document_id", said("confidence out of range"))
    return no_attribute.unionByName(no_entity).unionByName(twice).unionByName(odd)


def unmapped(rows: DataFrame) -> DataFrame:
    return rows.filter("rejection is not null").select("document_id", "attribute_id", "rejection")


def rejections(rows: DataFrame) -> DataFrame:
    return rows.filter("rejection is not null").groupBy("rejection").agg(F.count(F.lit(1)).alias("n"))


def _given(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame, Lexicon]:
    """Attributes, entities, canonical entities, decisions, chunks and lexicon."""
    e, cents, chunks, attributes, lexicon = quality.given_canonicals(spark, root)
    decisions = quality.decide(cents, chunks, attributes, lexicon).select("document_id", "canonical_id", "validation_status", "overall_score")
    return attributes, e, cents, checkpointed(decisions), chunks, lexicon


def _given_targets(spark: SparkSession, root: str) -> DataFrame:
    attributes, e, cents, decisions, _, lexicon = _given(spark, root)
    return targets(attributes, e, cents, decisions, lexicon)


def q_mappings(spark: SparkSession, root: str) -> DataFrame:
    said = F.array_join(F.transform("supporting_evidence", lambda e: F.concat_ws(":", e["chunk_id"], F.md5(e["text"]))), ",")
    return mappings(judged(*_given(spark, root)), 8).select("document_id", "mapping_id", "attribute_id", "entity_id", "relationship_type", "source_chunk", "confidence", said.alias("evidence"))


def q_unmapped(spark: SparkSession, root: str) -> DataFrame:
    return unmapped(_given_targets(spark, root))


def q_rejections(spark: SparkSession, root: str) -> DataFrame:
    return rejections(_given_targets(spark, root))


def q_problems(spark: SparkSession, root: str) -> DataFrame:
    """What is wrong with the given mappings (first deliveries)."""
    once = lambda name, key: delivered_once(table(spark, root, name), [key])
    attributes = once("attributes", "attribute_id").withColumn("document_id", F.col("source_document"))
    return problems(once("mappings", "mapping_id"), attributes, once("canonical_entities", "canonical_id"))


def relationship(evidence: Column, text: Column, scope: Column) -> Column:
    """Constraint words make a constraint, strong scopes own the attribute, others refer to it."""
    return F.when(F.concat_ws(" ", evidence, text).rlike(CONSTRAINT), F.lit("constrains")).when(scope.isin(*OWNING), F.lit("has_attribute")).otherwise(F.lit("references"))


def q_relationships(spark: SparkSession, root: str) -> DataFrame:
    a = table(spark, root, "attributes")
    return a.select("record_id", relationship(F.col("binding.evidence"), F.col("source_text"), F.col("binding.scope")).alias("relationship_type"))


def q_unmapped_given(spark: SparkSession, root: str) -> DataFrame:
    """Ids of the given attributes that no given mapping names."""
    mapped = table(spark, root, "mappings").select(id_key(F.col("attribute_id")).alias("attribute_id"))
    return table(spark, root, "attributes").select(id_key(F.col("attribute_id")).alias("attribute_id")).distinct().join(mapped, "attribute_id", "left_anti")


_JUDGED = f"""{quality.DECISIONS_SQL},
nm as (select document_id, lower(entity_name) as nk, min(entity_id) as ent, min_by(entity_name, entity_id) as ename from e group by all),
mm as (select document_id, unnest(member_ids) as m, id as canonical_id, ch, status, greatest(0.0, least(1.0, overall)) as overall_score from qd),
j0 as (select ka.*, lower(ka.binding.entity_name) as nk, ka.binding.evidence as said, coalesce(n1.ent, n2.ent) as ent, coalesce(n1.ename, n2.ename) as ename from ka
  left join lex on lex.key = {quality._NORM.format("ka.binding.entity_name")} left join nm n1 on n1.document_id = ka.document_id and n1.nk = lower(ka.binding.entity_name) left join nm n2 on n2.document_id = ka.document_id and n2.nk = lower(lex.name)),
j1 as (select j0.*, mm.canonical_id, mm.status, mm.ch, j0.binding.confidence * j0.confidence * mm.overall_score as sc, c.source_text as ctext,
  case when regexp_matches(concat_ws(' ', said, j0.source_text), '\\b(SHALL|MUST|SHOULD|REQUIRED)\\b') then 'constrains' when j0.binding.scope in ('table_subject', 'nearest_heading', 'syntactic') then 'has_attribute' else 'references' end as rel
  from j0 left join mm on mm.document_id = j0.document_id and mm.m = j0.ent left join c on c.document_id = j0.document_id and c.chunk_id = j0.source_chunk),
ju as (select *, case when nk is null then 'dangling' when ent is null then 'unresolved_entity' when canonical_id is null then 'no_canonical_group' when coalesce(status, '') <> 'ACCEPT' then 'ineligible_entity'
  when not coalesce(sc >= {MIN_CONFIDENCE}, false) then 'below_min_confidence' when not (coalesce(list_contains(ch, source_chunk), false) or coalesce(said <> '' and contains(lower(said), lower(ename)), false)) then 'no_cooccurrence' end as rejection from j1),
evs as (select x.document_id, x.attribute_id, x.ev.chunk_id as chunk_id, x.ev.text as text from (select document_id, attribute_id, unnest(evidence) as ev from ka) x join c on c.document_id = x.document_id and c.chunk_id = x.ev.chunk_id where contains(c.source_text, x.ev.text)
  union select document_id, attribute_id, source_chunk, said from ju where said <> '' and contains(ctext, said)),
eva as (select document_id, attribute_id, string_agg(chunk_id || ':' || md5(text), ',' order by chunk_id, text) as evidence from evs group by all)"""
QUERIES = {"mapping_problems": q_problems, "mapping_rejections": q_rejections, "mappings": q_mappings, "unmapped_attributes": q_unmapped, "relationship_types": q_relationships, "unmapped_given_attributes": q_unmapped_given}
ORACLES = {
    "mapping_problems": """with m as (select * from mappings where record_id in (select min(record_id) from mappings group by mapping_id)), a as (select *, source_document as document_id from attributes where record_id in (select min(record_id) from attributes group by attribute_id)),
c as (select * from canonical_entities where record_id in (select min(record_id) from canonical_entities group by canonical_id))
select document_id, 'unknown attribute: ' || mapping_id as problem from m where not exists (select 1 from a where a.document_id = m.document_id and a.attribute_id = m.attribute_id)
union all select document_id, 'unknown entity: ' || mapping_id from m where not exists (select 1 from c where c.document_id = m.document_id and c.canonical_id = m.entity_id)
union all select document_id, 'twice: ' || mapping_id from m group by document_id, mapping_id having count(*) > 1
union all select document_id, 'confidence out of range: ' || mapping_id from m where confidence is null or confidence < 0 or confidence > 1""",
    "mappings": f"with recursive {_JUDGED} select ju.document_id, 'map-' || left(sha256(ju.attribute_id || '|' || canonical_id || '|' || rel), 16) as mapping_id, ju.attribute_id, canonical_id as entity_id, rel as relationship_type, source_chunk, round(sc, 8) as confidence, coalesce(eva.evidence, '') as evidence from ju left join eva on eva.document_id = ju.document_id and eva.attribute_id = ju.attribute_id where rejection is null",
    "unmapped_attributes": f"with recursive {_JUDGED} select document_id, attribute_id, rejection from ju where rejection is not null",
    "mapping_rejections": f"with recursive {_JUDGED} select rejection, count(*) as n from ju where rejection is not null group by all",
    "relationship_types": r"""select record_id, case when regexp_matches(concat_ws(' ', binding.evidence, source_text), '\b(SHALL|MUST|SHOULD|REQUIRED)\b') then 'constrains'
  when binding.scope in ('table_subject', 'nearest_heading', 'syntactic') then 'has_attribute' else 'references' end as relationship_type from attributes""",
    "unmapped_given_attributes": "select distinct lower(trim(attribute_id)) as attribute_id from attributes where lower(trim(attribute_id)) not in (select lower(trim(attribute_id)) from mappings where attribute_id is not null)",
}
