"""Quality of canonical entities: eight criteria of equal weight, an overall score and a decision.

Defined results: entities without evidence are rejected; chunks that don't exist count as not mentioning the entity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from specweave.functions.keys import content_id
from specweave.functions.numbers import clamp, precise_sum
from specweave.functions.text import norm
from specweave.operators import duplicates, entities, nearest
from specweave.operators.candidates import LEXICON_SQL, ONCE_SQL
from specweave.operators.cleaning import delivered_once_in_place, few_broadcast
from specweave.session import checkpointed, table
from specweave.sources.lexicons import Lexicon

#: Criteria in order, their weight, thresholds.
CRITERIA = ("specificity", "uniqueness", "real_world_correspondence", "contextual_relevance", "completeness", "source_grounding", "entity_type_correctness", "disambiguation_potential")
WEIGHT, ACCEPT, REVIEW = 0.125, 0.75, 0.50


def closest(cents: DataFrame, lexicon: Lexicon) -> DataFrame:
    """number, nearest: the highest composite of each entity with any other of its document."""
    e = cents.select("document_id", F.col("number").cast("string").alias("entity_id"), F.col("canonical_name").alias("entity_name"), F.col("normalized_name").alias("normalized_entity_name"), "entity_type", "source_chunks", "source_attributes", "supporting_evidence")
    return nearest.nearest(e, lexicon).select(F.col("entity_id").cast("bigint").alias("number"), "nearest")


def headings(cents: DataFrame, chunks: DataFrame) -> DataFrame:
    """number, heads: the headings of each source chunk of an entity, in one text a chunk."""
    heads = chunks.select("document_id", F.col("chunk_id").alias("c"), F.lower(F.array_join("heading_path", " ")).alias("heads"))
    at = cents.select("document_id", "number", F.explode("source_chunks").alias("c")).join(heads, ["document_id", "c"], "left")
    return at.groupBy("number").agg(F.collect_list(F.coalesce("heads", F.lit(""))).alias("heads"))


def attribute_terms(cents: DataFrame, attributes: DataFrame) -> DataFrame:
    """number, more: the names of each entity's attributes in lower case."""
    names = attributes.select("document_id", "attribute_id", F.array(F.lower("display_name"), F.lower("attribute_name")).alias("terms"))
    own = cents.select("document_id", "number", F.explode("source_attributes").alias("attribute_id")).join(names, ["document_id", "attribute_id"])
    return own.groupBy("number").agg(F.flatten(F.collect_list("terms")).alias("more"))


def relevance() -> Column:
    """Share of source chunks whose headings name the entity or its attributes."""
    terms = F.filter(F.concat(F.array(F.lower("canonical_name"), F.lower("normalized_name")), F.coalesce("more", F.array().cast("array<string>"))), lambda t: t != "")
    # the array of one keeps the terms from being made again for every heading
    hits = F.transform(F.array(terms), lambda own: F.size(F.filter("heads", lambda h: F.exists(own, lambda t: F.contains(h, t)))))[0]
    return F.when(F.col("heads").isNotNull(), hits / F.size("heads")).otherwise(0.0)


def grounding(cents: DataFrame, chunks: DataFrame) -> DataFrame:
    """number, grounding: share of the evidence that stands in its chunk."""
    ev = cents.select("document_id", "number", F.explode("supporting_evidence").alias("e")).select("document_id", "number", F.col("e.chunk_id").alias("chunk_id"), F.col("e.text").alias("words"))
    held = ev.join(chunks.select("document_id", "chunk_id", "source_text"), ["document_id", "chunk_id"], "left")
    return held.groupBy("number").agg(F.avg(F.coalesce(F.contains("source_text", F.col("words")), F.lit(False)).cast("double")).alias("grounding"))


def decide(cents: DataFrame, chunks: DataFrame, attributes: DataFrame, lexicon: Lexicon = Lexicon(), adjustments: DataFrame | None = None) -> DataFrame:
    """document_id, canonical_id, the eight scores, overall_score, confidence, validation_status, issues, reason.

    ``adjustments`` (document_id, canonical_id, specificity_delta, real_world_delta) may come from a model; each delta is
    held within 0.2.  Entities are joined by a short ``number``, which they get here if they have none.
    """
    cents = cents if "number" in cents.columns else checkpointed(cents.withColumn("number", F.monotonically_increasing_id()))
    spark, key = cents.sparkSession, ["document_id", "canonical_id"]
    look = lexicon.entity_lookup(spark).select(F.col("key").alias("_k"), F.col("layer").alias("_layer"))
    # only what the scores need goes through the joins
    slim = cents.select("number", *key, "canonical_name", "normalized_name", "entity_type", "layer", "confidence", "origins", F.coalesce(F.size("source_attributes"), F.lit(0)).alias("_attributes"), F.coalesce(F.size("supporting_evidence"), F.lit(0)).alias("_evidence"))
    rows = slim.withColumn("_k", norm(F.col("canonical_name"))).join(F.broadcast(look), "_k", "left").drop("_k")
    for found in (closest(cents, lexicon), grounding(cents, chunks), attribute_terms(cents, attributes), headings(cents, chunks)):
        rows = rows.join(found, "number", "left")
    rows = rows.withColumn("relevance", relevance())
    words = F.filter(F.split("canonical_name", r"\s+"), lambda w: w != "")
    generic = F.size(F.filter(words, lambda w: F.lower(w).isin(*lexicon.generic)))
    name, solid = F.col("canonical_name"), F.replace("canonical_name", F.lit(" "), F.lit(""))
    base = 1.0 - F.least(F.lit(1.0), generic * 0.5)
    base = F.least(F.lit(1.0), base + F.when(F.size(words) >= 2, 0.1).otherwise(0.0))
    base = F.least(F.lit(1.0), base + F.when((F.upper(solid) == solid) & solid.rlike(r"\p{L}") & (F.length(name) <= 6), 0.1).otherwise(0.0))
    n_attrs = F.col("_attributes")
    business = F.lower("canonical_name").isin(*[b.lower() for b in lexicon.business])
    same = F.count(F.lit(1)).over(Window.partitionBy("document_id", F.lower("canonical_name"))) - 1
    scores = {
        "specificity": clamp(base),
        "uniqueness": F.greatest(F.lit(0.0), 1.0 - F.coalesce("nearest", F.lit(0.0))),
        "real_world_correspondence": F.when(F.col("_layer").isNotNull() | business, 1.0).when(n_attrs >= 2, 0.7).when((F.size("origins") == 1) & F.array_contains("origins", "llm"), 0.4).otherwise(0.5),
        "contextual_relevance": F.col("relevance"),
        "completeness": ((F.coalesce((F.col("entity_type") != "") & (F.col("entity_type") != "Object"), F.lit(False))).cast("int") + F.coalesce(F.col("layer") != "Other", F.lit(False)).cast("int") + (n_attrs >= 1).cast("int") + (F.col("_evidence") >= 1).cast("int")) / 4.0,
        "source_grounding": F.coalesce("grounding", F.lit(0.0)),
        "entity_type_correctness": F.when(F.col("_layer").isNull(), 0.5).when(F.col("_layer") == F.col("layer"), 1.0).otherwise(0.0),
        "disambiguation_potential": F.when(same == 0, F.when(n_attrs >= 1, 1.0).otherwise(0.6)).otherwise(F.greatest(F.lit(0.0), 1.0 - same * 0.3)),
    }
    rows = rows.withColumns(scores)
    if adjustments is not None:
        rows = rows.join(adjustments, key, "left")
        for c, d in (("specificity", "specificity_delta"), ("real_world_correspondence", "real_world_delta")):
            rows = rows.withColumn(c, clamp(F.col(c) + clamp(F.coalesce(d, F.lit(0.0)), -0.2, 0.2)))
    rows = rows.withColumn("overall", precise_sum([F.lit(WEIGHT) * F.col(c) for c in CRITERIA]))
    bare = F.col("source_grounding") == 0
    status = F.when(bare, F.lit("REJECT")).when(F.col("overall") >= ACCEPT, F.lit("ACCEPT")).when(F.col("overall") >= REVIEW, F.lit("REVIEW")).otherwise(F.lit("REJECT"))
    issues = F.array_sort(F.array_compact(F.array(*[F.when(F.col(c) < 0.5, F.lit(f"{c}_low")) for c in CRITERIA], F.when(bare, F.lit("no_verified_evidence")))))
    said = F.concat(F.format_string("%s: overall=%.2f -> %s", "canonical_name", "overall", status), F.when(F.size(issues) > 0, F.concat(F.lit(" (issues: "), F.array_join(issues, ", "), F.lit(")"))).otherwise(F.lit("")))
    return rows.select(*key, *CRITERIA, clamp(F.col("overall")).alias("overall_score"), clamp(F.least(F.col("confidence"), F.col("overall"))).alias("confidence"), status.alias("validation_status"), issues.alias("issues"), said.alias("reason"))


def review_items(decisions: DataFrame) -> DataFrame:
    """Queue items of entities to be reviewed."""
    return decisions.filter("validation_status = 'REVIEW'").select("document_id", content_id("hri-", F.lit("entity_review"), F.col("canonical_id")).alias("item_id"), F.lit("entity_review").alias("kind"), F.array("canonical_id").alias("ref_ids"), F.col("overall_score").alias("score"), "reason")


def given_canonicals(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, Lexicon]:
    """The given entities, canonical entities made of them, chunks, attributes and lexicon."""
    lexicon = Lexicon.from_table(table(spark, root, "known_entities"))
    chunks = delivered_once_in_place(table(spark, root, "chunks"), ["document_id", "chunk_id"])
    e = duplicates.given_entities(spark, root, delivered_once_in_place)
    grouped = duplicates.groups(e, checkpointed(duplicates.duplicate_pairs(e, lexicon).select("document_id", "a", "b", "classification")))
    cents = checkpointed(duplicates.canonical_entities(e, few_broadcast(grouped, 500_000)).withColumn("number", F.monotonically_increasing_id()))
    return e, cents, chunks, entities.given_attributes(spark, root, delivered_once_in_place)[0], lexicon


def q_quality(spark: SparkSession, root: str) -> DataFrame:
    _, cents, chunks, attributes, lexicon = given_canonicals(spark, root)
    d = decide(cents, chunks, attributes, lexicon)
    return d.select("document_id", "canonical_id", *[F.round(c, 9).alias(c) for c in CRITERIA], F.round("overall_score", 9).alias("overall_score"), "validation_status", F.array_join("issues", ",").alias("issues"))


_NORM = "lower(trim(regexp_replace({0}, '[\\s\\x1c-\\x1f\\x85\\p{{Z}}]+', ' ', 'g')))"
_LIST = lambda names: "[" + ", ".join(f"'{n}'" for n in names) + "]"
#: ``ka``: the kept given attributes; ``qe``: canonical entities as they are compared; ``qd``: their scores and decisions.
DECISIONS_SQL = f"""{duplicates.GROUPS_SQL}, {ONCE_SQL.split("p as (")[0].rstrip(", \n").removeprefix("b as (select * from blocks where record_id in (select min(record_id) from blocks group by document_id, block_id)),")}, {LEXICON_SQL},
ka as (select *, source_document as document_id from attributes where record_id in (select min(record_id) from attributes group by attribute_id) and coalesce(score.route, '') <> 'discard'),
qe as (select document_id, canonical_id as id, m.name as name, m.n as n, m.ty as ty, m.layer as layer, ch, att, ev, confidence, origins, member_ids from cn),
{duplicates.features_sql("qe", "true", "q")},
near as (select document_id, id, max(composite) as nearest from (select document_id, a as id, composite from cmq union all select document_id, b, composite from cmq) group by all),
own as (select q.document_id, q.id, list(lower(ka.display_name)) || list(lower(ka.attribute_name)) as more from (select document_id, id, unnest(att) as x from qe) q join ka on ka.document_id = q.document_id and ka.attribute_id = q.x group by all),
rel as (select q.document_id, q.id, avg(case when len(list_filter([lower(q.name), lower(q.n)] || coalesce(own.more, []), lambda t: t is not null and t <> '' and contains(coalesce(lower(array_to_string(c.heading_path, ' ')), ''), t))) > 0 then 1.0 else 0.0 end) as relevance
  from (select document_id, id, name, n, unnest(ch) as x from qe) q left join c on c.document_id = q.document_id and c.chunk_id = q.x left join own on own.document_id = q.document_id and own.id = q.id group by all),
grd as (select q.document_id, q.id, avg(case when contains(c.source_text, q.e.text) then 1.0 else 0.0 end) as grounding from (select document_id, id, unnest(ev) as e from qe) q left join c on c.document_id = q.document_id and c.chunk_id = q.e.chunk_id group by all),
qx as (select qe.*, coalesce(nearest, 0) as nearest, coalesce(relevance, 0) as relevance, coalesce(grounding, 0) as grounding, lex.layer as known_layer, lex.key is not null as known, len(att) as n_attrs,
    list_filter(regexp_split_to_array(qe.name, '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '') as ws, replace(qe.name, ' ', '') as solid, count(*) over (partition by qe.document_id, lower(qe.name)) - 1 as same
  from qe left join near using (document_id, id) left join rel using (document_id, id) left join grd using (document_id, id) left join lex on lex.key = {_NORM.format("qe.name")}),
qb as (select *, 1.0 - least(1.0, 0.5 * len(list_filter(ws, lambda w: list_contains({_LIST(Lexicon().generic)}, lower(w))))) as b0 from qx),
qs as (select *, round(greatest(0.0, least(1.0, least(1.0, b0 + case when len(ws) >= 2 then 0.1 else 0.0 end) + case when upper(solid) = solid and regexp_matches(solid, '\\p{{L}}') and length(name) <= 6 then 0.1 else 0.0 end)), 9)::double as specificity,
    greatest(0.0, 1.0 - nearest)::double as uniqueness,
    (case when known_layer is not null or list_contains({_LIST(b.lower() for b in Lexicon().business)}, lower(name)) then 1.0 when n_attrs >= 2 then 0.7 when len(origins) = 1 and list_contains(origins, 'llm') then 0.4 else 0.5 end)::double as real_world_correspondence,
    relevance::double as contextual_relevance,
    ((coalesce(ty <> '' and ty <> 'Object', false)::int + coalesce(layer <> 'Other', false)::int + (n_attrs >= 1)::int + (len(ev) >= 1)::int) / 4.0)::double as completeness,
    grounding::double as source_grounding, (case when known_layer is null then 0.5 when known_layer = layer then 1.0 else 0.0 end)::double as entity_type_correctness,
    (case when same = 0 then case when n_attrs >= 1 then 1.0 else 0.6 end else greatest(0.0, 1.0 - same * 0.3) end)::double as disambiguation_potential from qb),
qo as (select *, {" + ".join(f"{WEIGHT} * {c}" for c in CRITERIA)} as overall from qs),
qd as (select *, case when source_grounding = 0 then 'REJECT' when round(overall, 9) >= {ACCEPT} then 'ACCEPT' when round(overall, 9) >= {REVIEW} then 'REVIEW' else 'REJECT' end as status from qo)"""


def q_quality_reviews(spark: SparkSession, root: str) -> DataFrame:
    _, cents, chunks, attributes, lexicon = given_canonicals(spark, root)
    r = review_items(decide(cents, chunks, attributes, lexicon))
    return r.select("document_id", "item_id", "kind", F.array_join("ref_ids", "|").alias("refs"), F.round("score", 9).alias("score"))


QUERIES = {"quality_scores": q_quality, "quality_reviews": q_quality_reviews}
ORACLES = {
    "quality_scores": f"""with recursive {DECISIONS_SQL} select document_id, id as canonical_id, {", ".join(f"round({c}, 9) as {c}" for c in CRITERIA)}, round(least(1.0, greatest(0.0, overall)), 9) as overall_score, status as validation_status,
  array_to_string(list_sort(list_filter([{", ".join(f"case when {c} < 0.5 then '{c}_low' end" for c in CRITERIA)}, case when source_grounding = 0 then 'no_verified_evidence' end], lambda x: x is not null)), ',') as issues from qd""",
    "quality_reviews": f"with recursive {DECISIONS_SQL} select document_id, 'hri-' || left(sha256('entity_review|' || id), 16) as item_id, 'entity_review' as kind, id as refs, round(overall, 9) as score from qd where status = 'REVIEW'",
}
