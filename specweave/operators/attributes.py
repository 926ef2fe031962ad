"""Attributes: what a scored candidate says about units, values, types and names; merging of repeated ones.

Defined results: of attributes with one id the first stays (``strict`` raises); attributes without entity merge among
themselves by name; values that are neither list nor range are ``free``.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from specweave.functions.keys import content_id
from specweave.functions.text import camel_case, head_noun, norm, strip
from specweave.operators import binding as bindings
from specweave.operators import signals
from specweave.operators.candidates import HEADING_ENTITY, LEXICON_SQL, ONCE_SQL, block_mentions, candidates, corpus, document_terms, word_sql
from specweave.operators.candidates import ORACLES as CANDIDATES_SQL
from specweave.operators.cleaning import delivered_once, titles
from specweave.operators.signals import cell
from specweave.session import checkpointed, table
from specweave.sources.lexicons import Lexicon, lookup

#: Units (base, factor) and type names.
UNIT_BASES = {"mbps": ("bit/s", 1e6), "gbps": ("bit/s", 1e9), "kbps": ("bit/s", 1e3), "bps": ("bit/s", 1.0), "ms": ("s", 1e-3), "s": ("s", 1.0), "bytes": ("byte", 1.0), "byte": ("byte", 1.0), "kb": ("byte", 1e3), "mb": ("byte", 1e6), "gb": ("byte", 1e9), "%": ("percent", 1.0)}
TYPE_NAMES = {"integer": "integer", "int": "integer", "number": "number", "float": "number", "string": "string", "str": "string", "boolean": "boolean", "bool": "boolean", "enum": "enum", "date": "date", "identifier": "identifier"}
_RANGE = r"^\s*(\d+(?:\.\d+)?)\s*[–—-]\s*(\d+(?:\.\d+)?)\s*$"


def unit(raw: Column) -> Column:
    """struct(raw, base, factor); null for blank; unknown units keep their spelling."""
    bare = strip(raw)
    base = lookup({k: b for k, (b, _) in UNIT_BASES.items()}, F.lower(bare))
    factor = lookup({k: repr(f) for k, (_, f) in UNIT_BASES.items()}, F.lower(bare)).cast("double")
    return F.when(bare != "", F.struct(bare.alias("raw"), base.alias("base"), factor.alias("factor")))


def value_domain(text: Column) -> Column:
    """struct(kind, from, to, values, pattern) of a range cell: list with commas, ``n-m``, or free."""
    bare = strip(text)
    ends = [F.regexp_extract(bare, _RANGE, i) for i in (1, 2)]
    none, nothing = F.lit(None).cast("double"), F.lit(None).cast("array<string>")

    def made(kind: str, low: Column, high: Column, values: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), low.alias("from"), high.alias("to"), values.alias("values"), F.lit(None).cast("string").alias("pattern"))

    values = F.filter(F.transform(F.split(bare, ","), strip), lambda v: v != "")
    return F.when(bare.contains(","), made("enum", none, none, values)).when(ends[0] != "", made("range", ends[0].try_cast("double"), ends[1].try_cast("double"), nothing)).when(bare != "", made("free", none, none, F.array(bare)))


def attribute_type(type_cell: Column, name: Column, lexicon: Lexicon) -> Column:
    kind = lexicon.noun_kind(head_noun(name))
    return F.coalesce(lookup(TYPE_NAMES, F.lower(strip(type_cell))), F.when(kind.isin("measure", "identifier"), kind), F.lit("unknown"))


def optionality(text: Column) -> Column:
    mark = F.upper(strip(text))
    return F.when(mark.isin("M", "O", "C"), mark)


def aliases(name: Column, description: Column, lexicon: Lexicon) -> Column:
    """Expansions of an acronym; those that the description quotes, if it quotes any."""
    solid = F.replace(name, F.lit(" "), F.lit(""))
    acronym = (F.upper(solid) == solid) & solid.rlike(r"\p{L}") & F.length(solid).between(2, 8)
    known = lexicon.expansions(lexicon.gazetteer_match(name), lexicon.gazetteer)
    quoted = F.filter(known, lambda e: F.contains(F.lower(F.coalesce(description, F.lit(""))), F.lower(e)))
    return F.when(acronym & known.isNotNull(), F.when(F.size(quoted) > 0, quoted).otherwise(known)).otherwise(F.array().cast("array<string>"))


def evidence_text() -> Column:
    """A table row's own line, else the sentence, else the whole chunk."""
    prefix = F.concat(F.lit("| "), F.col("raw_name"), F.lit(" |"))
    line = F.try_element_at(F.filter(F.split("source_text", "\n"), lambda x: x.startswith(prefix)), F.lit(1))
    return F.when(F.col("origin").isin("spec_table", "kv_pair"), F.coalesce(line, "source_text")).otherwise(F.coalesce(F.when(F.col("sentence") != "", F.col("sentence")), F.col("source_text")))


def build(scored: DataFrame, lexicon: Lexicon = Lexicon()) -> DataFrame:
    """Attribute records of scored candidates, accepted and discarded alike."""
    layers = lexicon.entity_lookup(scored.sparkSession).select(F.col("key").alias("_key"), F.col("layer"))
    rows = scored.withColumn("said", evidence_text()).withColumn("attribute_name", camel_case(F.col("raw_name"))).withColumn("_key", norm(F.col("binding.entity_name"))).join(F.broadcast(layers), "_key", "left")
    made = rows.select(
        "document_id",
        content_id("attr-", F.col("document_id"), F.col("chunk_id"), F.col("attribute_name"), F.col("said")).alias("attribute_id"),
        "attribute_name", F.col("raw_name").alias("display_name"), aliases(F.col("raw_name"), cell("description"), lexicon).alias("aliases"),
        attribute_type(cell("type"), F.col("raw_name"), lexicon).alias("attribute_type"), F.col("binding.entity_name").alias("entity"), "binding", "layer",
        unit(cell("units")).alias("unit"), F.lit(None).cast("string").alias("cardinality"), optionality(cell("optionality")).alias("optionality"), value_domain(cell("range")).alias("value_domain"),
        cell("default").alias("default"), cell("description").alias("description"), F.col("document_id").alias("source_document"), F.col("chunk_id").alias("source_chunk"), F.col("said").alias("source_text"),
        F.struct(F.coalesce("page", F.lit(0)).alias("page"), "block_id").alias("provenance"), F.array(F.struct("chunk_id", F.col("said").alias("text"))).alias("evidence"),
        F.col("score.clamped").alias("confidence"), "score", "origin", F.struct("chunk_id", "pos", "place").alias("cand"),
    )
    return made


def first_of_each_id(attributes: DataFrame, strict: bool = False) -> DataFrame:
    """One row per attribute_id, the first candidate's; ``strict`` raises if there are others."""
    first = attributes.groupBy("document_id", "attribute_id").agg(F.min_by(F.struct(*[c for c in attributes.columns if c not in ("document_id", "attribute_id")]), "cand").alias("a"), F.count(F.lit(1)).alias("n"))
    if strict and not first.filter("n > 1").isEmpty():
        raise ValueError("attribute ids occur twice")
    return first.select("document_id", "attribute_id", "a.*")


def dedup(attributes: DataFrame) -> DataFrame:
    """Kept attributes, one per document, entity (null included) and name: the most confident, then the largest id; the
    others' evidence and names are merged in the order of the candidates."""
    kept = attributes.filter("score.route <> 'discard'")
    item = F.struct("cand", "confidence", "attribute_id", "display_name", "aliases", "evidence")
    merged = kept.groupBy("document_id", "entity", "attribute_name").agg(F.array_sort(F.collect_list(item)).alias("all"))

    def fold(a: Column, b: Column) -> Column:
        b_wins = F.struct(b["confidence"], b["attribute_id"]) > F.struct(a["confidence"], a["attribute_id"])
        keep, other = (lambda f: F.when(b_wins, b[f]).otherwise(a[f])), (lambda f: F.when(b_wins, a[f]).otherwise(b[f]))
        named = F.when(other("display_name") != keep("display_name"), F.array(other("display_name"))).otherwise(F.array().cast("array<string>"))
        return F.struct(
            a["cand"].alias("cand"), keep("confidence").alias("confidence"), keep("attribute_id").alias("attribute_id"), keep("display_name").alias("display_name"),
            F.array_distinct(F.concat(keep("aliases"), named, other("aliases"))).alias("aliases"), F.array_distinct(F.concat(keep("evidence"), other("evidence"))).alias("evidence"),
        )

    won = merged.select("document_id", F.aggregate(F.slice("all", F.lit(2), F.greatest(F.size("all") - 1, F.lit(0))), F.col("all")[0], fold).alias("w"))
    won = won.select("document_id", F.col("w.attribute_id").alias("attribute_id"), F.col("w.aliases").alias("_aliases"), F.col("w.evidence").alias("_evidence"))
    return kept.join(won, ["document_id", "attribute_id"]).withColumn("aliases", F.col("_aliases")).withColumn("evidence", F.col("_evidence")).drop("_aliases", "_evidence")


def review_items(attributes: DataFrame) -> DataFrame:
    """Queue items of the surviving attributes in the review band."""
    return attributes.filter("score.route = 'review'").select(
        "document_id", content_id("hri-", F.lit("attribute_review"), F.col("attribute_id")).alias("item_id"), F.lit("attribute_review").alias("kind"), F.array("attribute_id").alias("ref_ids"), F.col("confidence").alias("score"),
        F.format_string('"%s" scores %.2f, neither accepted nor discarded', "display_name", "confidence").alias("reason"),
    )


def problems(attributes: DataFrame, chunks: DataFrame) -> DataFrame:
    """document_id, attribute_id, problem: unknown chunk, evidence that isn't in its chunk, confidence other than the score."""
    c = chunks.select("document_id", F.col("chunk_id").alias("source_chunk"), F.col("source_text").alias("_text"))
    rows = attributes.join(c, ["document_id", "source_chunk"], "left")
    own = F.filter("evidence", lambda e: e["chunk_id"] == F.col("source_chunk"))
    lost = F.exists(own, lambda e: ~F.contains(F.col("_text"), e["text"]))
    said = F.when(F.col("_text").isNull(), F.lit("unknown chunk")).when(lost, F.lit("evidence not in chunk")).when(F.abs(F.col("confidence") - F.col("score.clamped")) > 1e-9, F.lit("confidence differs"))
    return rows.select("document_id", "attribute_id", said.alias("problem")).filter("problem is not null")


def extract(chunks: DataFrame, blocks: DataFrame, lexicon: Lexicon = Lexicon(), document_titles: DataFrame | None = None, scoring: dict | None = None, default_entity: str | None = None, proposed: DataFrame | None = None) -> DataFrame:
    """All attribute records (kept and discarded) of a corpus: candidates, binding, counting, scoring, building."""
    found = checkpointed(block_mentions(blocks, lexicon))  # used by several steps, as are the next two
    own = candidates(chunks, blocks, lexicon, found)
    proposed = checkpointed(own if proposed is None else own.unionByName(proposed))  # those of a model come last
    bound = checkpointed(bindings.bind(proposed, chunks, blocks, document_titles if document_titles is not None else titles(blocks), found, lexicon, default_entity))
    subjects = bindings.resolved_names(blocks.select("document_id", F.col("tbl.subject_hint").alias("text")), lexicon, document_terms(blocks, lexicon))
    subjects = subjects.select("document_id", norm(F.col("entity")).alias("entity_key")).distinct()
    given = scoring or {}
    registry = tuple(replace(s, weight=given.get("weights", {}).get(s.name, s.weight)) for s in signals.REGISTRY)
    counted = signals.with_counts(bound, bindings.bind_counts(bound), subjects)
    scored = signals.score(counted, lexicon, registry, given.get("accept", signals.ACCEPT), given.get("review", signals.REVIEW))
    return first_of_each_id(build(scored, lexicon))


# -- queries ---------------------------------------------------------------------------------------------------------


def q_bindings(spark: SparkSession, root: str) -> DataFrame:
    blocks, chunks, lexicon = corpus(spark, root)
    found = checkpointed(block_mentions(blocks, lexicon))
    bound = bindings.bind(checkpointed(candidates(chunks, blocks, lexicon, found)), chunks, blocks, titles(blocks), found, lexicon)
    return bound.select("document_id", "chunk_id", "block_id", "raw_name", "origin", "binding.entity_name", "binding.scope", "binding.confidence")


def q_subject_bindings(spark: SparkSession, root: str) -> DataFrame:
    """The bindings by the subject of the candidate's table."""
    return q_bindings(spark, root).filter("scope = 'table_subject'").select("document_id", "chunk_id", "block_id", "raw_name", "origin", "entity_name", "confidence")


def q_default_entities(spark: SparkSession, root: str) -> DataFrame:
    blocks, _, lexicon = corpus(spark, root)
    return bindings.default_entities(titles(blocks), lexicon, document_terms(blocks, lexicon)).select("document_id", "title", "default_entity")


def _given(spark: SparkSession, root: str) -> DataFrame:
    return delivered_once(table(spark, root, "attributes"), ["attribute_id"]).withColumn("document_id", F.col("source_document"))


def q_problems(spark: SparkSession, root: str) -> DataFrame:
    """What is wrong with the given attributes (first deliveries)."""
    _, chunks, _ = corpus(spark, root)
    return problems(_given(spark, root), chunks)


def q_reviews(spark: SparkSession, root: str) -> DataFrame:
    return review_items(_given(spark, root)).select("document_id", "item_id", "kind", F.array_join("ref_ids", "|").alias("refs"), "score")


def q_bound_counts(spark: SparkSession, root: str) -> DataFrame:
    """How many of the given attributes are bound to each entity."""
    return bindings.bind_counts(_given(spark, root).withColumn("raw_name", F.col("display_name")))


def q_extract(spark: SparkSession, root: str) -> DataFrame:
    blocks, chunks, lexicon = corpus(spark, root)
    return extract(chunks, blocks, lexicon)


def q_routed(spark: SparkSession, root: str) -> DataFrame:
    return q_extract(spark, root).select("document_id", "attribute_id", "display_name", "entity", "origin", F.col("score.raw_sum").alias("raw_sum"), F.col("score.route").alias("route"), F.col("score.discard_reason").alias("discard_reason"))


def q_signal_hits(spark: SparkSession, root: str) -> DataFrame:
    return q_extract(spark, root).select(F.explode("score.hits").alias("h")).groupBy("h.name", "h.weight").agg(F.count(F.lit(1)).alias("n"))


def q_dedup(spark: SparkSession, root: str) -> DataFrame:
    return dedup(q_extract(spark, root)).select("document_id", "attribute_id", "attribute_name", "entity", "confidence", F.size("evidence").alias("n_evidence"), F.array_join("aliases", ";").alias("aliases"))


def q_units_domains(spark: SparkSession, root: str) -> DataFrame:
    a = table(spark, root, "attributes")
    words = F.coalesce(F.array_join("value_domain.values", ", "), F.concat(F.col("value_domain.from").cast("bigint").cast("string"), F.lit("–"), F.col("value_domain.to").cast("bigint").cast("string")))
    vd, u = value_domain(words), unit(F.col("unit.raw"))
    return a.select("record_id", u["raw"].alias("raw"), u["base"].alias("base"), u["factor"].alias("factor"), vd["kind"].alias("kind"), vd["from"].alias("low"), vd["to"].alias("high"), attribute_type(F.col("attribute_type"), F.col("display_name"), Lexicon()).alias("atype"), optionality(F.col("optionality")).alias("opt"))


def q_names(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "attributes").select("record_id", camel_case(F.col("display_name")).alias("camel"), head_noun(F.col("display_name")).alias("head"))


def q_ids(spark: SparkSession, root: str) -> DataFrame:
    """Content ids of the given attributes' place and words."""
    made = content_id("attr-", F.col("source_document"), F.col("source_chunk"), F.col("attribute_name"), F.col("source_text"))
    return table(spark, root, "attributes").select("record_id", made.alias("made_id"))


def q_dedup_given(spark: SparkSession, root: str) -> DataFrame:
    """Survivors among the given attributes with a usable confidence, first deliveries only."""
    a = delivered_once(table(spark, root, "attributes"), ["attribute_id"]).filter("confidence is not null and not isnan(confidence) and score.route is not null")
    slim = a.select(F.col("source_document").alias("document_id"), "entity", "attribute_name", "attribute_id", "display_name", "aliases", "evidence", "confidence", "score", F.col("record_id").alias("cand"))
    kept = dedup(slim.withColumn("aliases", F.coalesce("aliases", F.array().cast("array<string>"))).withColumn("evidence", F.coalesce("evidence", F.array().cast(slim.schema["evidence"].dataType))))
    return kept.select("document_id", "entity", "attribute_name", "attribute_id", F.size("evidence").alias("n_evidence"))


_NOUNS = "case head " + " ".join(f"when '{n}' then '{k}'" for n, k in Lexicon().noun_kinds().items() if k in ("measure", "identifier")) + " end"
_KNOWN = "kn as (select name, row_number() over (order by min(known_id)) as o from known_entities where trim(name) <> '' group by name)"
_BOUND = {
    "subject_bindings": rf"""with {ONCE_SQL}, {LEXICON_SQL}, {_KNOWN},
cand as (select *, 'spec_table' as origin from ({CANDIDATES_SQL["spec_rows"]}) union all select *, 'kv_pair' from ({CANDIDATES_SQL["kv_rows"]})),
su as (select distinct document_id, tbl.subject_hint as t from b where tbl.subject_hint is not null),
s1 as (select su.*, nullif(trim(regexp_extract(t, '{HEADING_ENTITY.replace("(?iuU)", "(?i)")}', 1)), '') as implied from su),
s2 as (select s1.*, lex.name as known from s1 left join lex on lex.key = lower(trim(regexp_replace(coalesce(implied, t), '\s+', ' ', 'g')))),
s3 as (select document_id, t, min_by(kn.name, (-length(kn.name), o)) as inner_name from s2, kn where {word_sql("t", "kn.name", False)} group by document_id, t),
re as (select s2.document_id, s2.t, coalesce(known, implied, inner_name) as entity from s2 left join s3 on s3.document_id = s2.document_id and s3.t = s2.t)
select cand.document_id, chunk_id, cand.block_id, raw_name, origin, entity as entity_name, 1.0::double as confidence from cand join b on b.document_id = cand.document_id and b.block_id = cand.block_id
  join re on re.document_id = b.document_id and re.t = b.tbl.subject_hint where entity is not null""",
    "default_entities": rf"""with {ONCE_SQL}, {_KNOWN}, ti as (select document_id, arg_min(text, ord) as title from b where heading_level = 1 group by 1),
ht as (select ti.*, name, o, len(regexp_extract_all(replace(lower(title), lower(name), chr(1)), '(?:^|[^\pL\pN_])\x01')) as n from ti, kn where {word_sql("title", "name", False)})
select document_id, title, min_by(name, (-n, o)) as default_entity from ht group by document_id, title""",
}
_N = r"lower(trim(regexp_replace({0}, '[\s\x1c-\x1f\x85\p{{Z}}]+', ' ', 'g')))"
_GIVEN_SQL = "a as (select *, source_document as document_id from attributes where record_id in (select min(record_id) from attributes group by attribute_id))"
_CHECKED = {
    "attribute_problems": f"""with {_GIVEN_SQL}, c as (select * from chunks where record_id in (select min(record_id) from chunks group by document_id, chunk_id)),
p as (select a.document_id, attribute_id, case when c.source_text is null then 'unknown chunk' when len(list_filter(evidence, lambda e: e.chunk_id = a.source_chunk and not contains(c.source_text, e.text))) > 0 then 'evidence not in chunk'
  when abs(confidence - score.clamped) > 1e-9 then 'confidence differs' end as problem from a left join c on c.document_id = a.document_id and c.chunk_id = a.source_chunk)
select * from p where problem is not null""",
    "attribute_reviews": f"with {_GIVEN_SQL} select document_id, 'hri-' || left(sha256('attribute_review|' || coalesce(attribute_id, '')), 16) as item_id, 'attribute_review' as kind, coalesce(attribute_id, '') as refs, confidence as score from a where score.route = 'review'",
    "bound_counts": f"with {_GIVEN_SQL} select document_id, {_N.format('binding.entity_name')} as entity_key, count(*) as n from a where binding.entity_name is not null and {_N.format('binding.entity_name')} <> {_N.format('display_name')} group by all",
}
QUERIES = {"attribute_problems": q_problems, "attribute_reviews": q_reviews, "bound_counts": q_bound_counts, "subject_bindings": q_subject_bindings, "default_entities": q_default_entities, "bindings": q_bindings, "routed_attributes": q_routed, "signal_hits": q_signal_hits, "dedup_attributes": q_dedup, "units_domains_types": q_units_domains, "camel_and_head_names": q_names, "attribute_ids": q_ids, "dedup_given_attributes": q_dedup_given}
ORACLES = {
    **_BOUND,
    **_CHECKED,
    "attribute_ids": "select record_id, 'attr-' || left(sha256(coalesce(source_document, '') || '|' || coalesce(source_chunk, '') || '|' || coalesce(attribute_name, '') || '|' || coalesce(source_text, '')), 16) as made_id from attributes",
    "dedup_given_attributes": """with a as (select * from attributes where record_id in (select min(record_id) from attributes group by attribute_id) and confidence is not null and not isnan(confidence) and score.route <> 'discard')
, g as (select source_document as d, entity as e, attribute_name as t, len(list_distinct(flatten(list(coalesce(evidence, [])))))::int as n from a group by all)
select source_document as document_id, entity, attribute_name, attribute_id, n as n_evidence from a join g on g.d is not distinct from source_document and g.e is not distinct from entity and g.t is not distinct from attribute_name
qualify row_number() over (partition by source_document, entity, attribute_name order by confidence desc, attribute_id desc) = 1""",
    "camel_and_head_names": r"""with t as (select record_id, regexp_extract_all(display_name, '[A-Za-z0-9]+') as x, trim(regexp_replace(display_name, '\([^)]*\)', '', 'g')) as bare from attributes)
select record_id, array_to_string(list_transform(x, lambda w, i: case when i = 1 then lower(w) when length(w) > 1 and w = upper(w) and regexp_matches(w, '[A-Z]') then upper(w[1]) || lower(w[2:]) else upper(w[1]) || w[2:] end), '') as camel,
  lower(coalesce(regexp_extract_all(bare, '[A-Za-z0-9'']+')[-1], bare)) as head from t""",
    "units_domains_types": r"""with t as (select record_id, trim(unit.raw, e' \t\n') as r0, coalesce(array_to_string(value_domain.values, ', '), trunc(value_domain."from")::bigint || '–' || trunc(value_domain."to")::bigint) as w, lower(trim(attribute_type)) as ty, upper(trim(optionality)) as o, display_name,
  lower(coalesce(regexp_extract_all(trim(regexp_replace(display_name, '\([^)]*\)', '', 'g')), '[A-Za-z0-9'']+')[-1], '')) as head from attributes),
v as (select *, nullif(r0, '') as r, regexp_extract(w, '^\s*(\d+(?:\.\d+)?)\s*[–—-]\s*(\d+(?:\.\d+)?)\s*$', 1) as a, regexp_extract(w, '^\s*(\d+(?:\.\d+)?)\s*[–—-]\s*(\d+(?:\.\d+)?)\s*$', 2) as b from t)
select record_id, r as raw, @B@ as base, @F@ as factor, case when contains(w, ',') then 'enum' when a <> '' then 'range' when w <> '' then 'free' end as kind,
  case when not contains(w, ',') and a <> '' then a::double end as low, case when not contains(w, ',') and a <> '' then b::double end as high, coalesce(@T@, @N@, 'unknown') as atype, case when o in ('M', 'O', 'C') then o end as opt from v""".replace("@B@", "case lower(r) " + " ".join(f"when '{k}' then '{b}'" for k, (b, _) in UNIT_BASES.items()) + " end").replace("@F@", "case lower(r) " + " ".join(f"when '{k}' then {f!r}::double" for k, (_, f) in UNIT_BASES.items()) + " end").replace("@T@", "case ty " + " ".join(f"when '{k}' then '{t}'" for k, t in TYPE_NAMES.items()) + " end").replace("@N@", _NOUNS),
}
