"""Duplicate entities of a document: candidate pairs, seven features, classification, groups, canonical entities.

Pairs are blocked within a document: entities that share the first letter of their normal name or their type.  Of these
only pairs with one normal name or an alias link can pass the thresholds, so only they are made (``candidate_pairs``).

Defined results: null names count as empty; two empty sets have overlap 0; every entity is in exactly one group.
"""

from __future__ import annotations

from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from specweave.functions.keys import content_id
from specweave.functions.numbers import jaccard, precise_sum
from specweave.functions.text import strip
from specweave.operators.cleaning import delivered_once
from specweave.operators.components import connected_components
from specweave.session import checkpointed, table
from specweave.sources.lexicons import Lexicon, plain

#: Weights of the features, in the order in which they are summed; thresholds.
WEIGHTS = {"name_sim": 0.20, "normalized_exact": 0.25, "type_match": 0.15, "chunk_overlap": 0.15, "attribute_overlap": 0.10, "evidence_overlap": 0.05, "alias_link": 0.10}
DUPLICATE, POSSIBLE = 0.90, 0.70


def _common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, one machine word operation per character and word of bits."""
    places: dict[str, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for y in b:
        hit = row & places.get(y, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _likeness(a: str, b: str) -> float:
    return 100.0 * 2 * _common_length(a, b) / (len(a) + len(b)) if a or b else 100.0


@lru_cache(maxsize=200_000)
def token_set_ratio(a: str | None, b: str | None) -> float:
    """Likeness of two names as sets of words, 0 to 100: 100 if one set holds the other."""
    one, two = set((a or "").split()), set((b or "").split())
    if not one or not two:
        return 0.0
    shared, left, right = " ".join(sorted(one & two)), " ".join(sorted(one - two)), " ".join(sorted(two - one))
    if shared and (not left or not right):
        return 100.0
    full_left, full_right = f"{shared} {left}".strip(), f"{shared} {right}".strip()
    tries = [_likeness(full_left, full_right)]
    if shared:
        tries += [_likeness(shared, full_left), _likeness(shared, full_right)]
    return max(tries)


def _name_likeness(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([token_set_ratio(x, y) / 100.0 for x, y in zip(a, b)])


def shingles(evidence: Column) -> Column:
    """Different character trigrams of the evidence texts; a short text is its own."""

    def grams(e: Column) -> Column:
        t = F.lower(F.coalesce(e["text"], F.lit("")))
        cut = F.transform(F.sequence(F.lit(1), F.greatest(F.length(t) - 2, F.lit(1))), lambda i: F.substring(t, i, F.lit(3)))
        return F.when(F.length(t) >= 3, cut).when(t != "", F.array(t)).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.flatten(F.transform(evidence, grams)))


def alias_pairs(lexicon: Lexicon) -> list[tuple[str, str]]:
    """(canonical, alias) in plain form."""
    tables = [lexicon.aliases, {n: more for n, (_, _, more) in lexicon.known.items()}]
    return sorted({(plain(n), plain(a)) for t in tables for n, more in t.items() for a in more})


def compared(entities: DataFrame) -> DataFrame:
    """What pairs are compared by; trigrams are made once per entity, not once per pair."""
    names = ["document_id", "entity_id", "entity_name", "normalized_entity_name", "entity_type", "source_chunks", "source_attributes"]
    return entities.select(*names, shingles(F.col("supporting_evidence")).alias("shingles"))


def _sides(e: DataFrame) -> tuple[DataFrame, DataFrame]:
    side = lambda p: e.select([F.col(c).alias(f"{p}_{c}") for c in e.columns])
    return side("a"), side("b")


def pairs(entities: DataFrame) -> DataFrame:
    """Blocked pairs a < b of a document, each once; columns of both sides prefixed ``a_`` and ``b_``."""
    e = compared(entities).withColumn("letter", F.lower(F.substring(F.coalesce("normalized_entity_name", F.lit("")), 1, 1)))
    a, b = _sides(e)
    same = (F.col("a_document_id") == F.col("b_document_id")) & (F.col("a_entity_id") < F.col("b_entity_id"))
    by_type = a.join(b, same & (F.col("a_entity_type") == F.col("b_entity_type")))
    by_letter = a.join(b, same & (F.col("a_letter") == F.col("b_letter")) & ~F.coalesce(F.col("a_entity_type") == F.col("b_entity_type"), F.lit(False)))
    return by_type.unionByName(by_letter)


def name_keys(side: str = "") -> Column:
    """The names by which an entity has alias links."""
    key = lambda c: F.lower(strip(F.coalesce(c, F.lit(""))))
    return F.array_distinct(F.array(key(F.col(f"{side}entity_name")), key(F.col(f"{side}normalized_entity_name"))))


def _links(entities: DataFrame, lexicon: Lexicon) -> DataFrame:
    links = entities.sparkSession.createDataFrame(alias_pairs(lexicon), "x string, y string")
    return F.broadcast(links.union(links.select("y", "x")).distinct())  # the lexicon is bounded


def candidate_pairs(entities: DataFrame, lexicon: Lexicon = Lexicon()) -> DataFrame:
    """The blocked pairs that can be duplicates at all, as two equi-joins.

    A pair with different normal names and no alias link reaches the sum of the other weights at most.  As long as that is
    below the threshold of possible duplicates, all pairs beyond it have one normal name or an alias link.
    """
    if sum(w for f, w in WEIGHTS.items() if f not in ("normalized_exact", "alias_link")) >= POSSIBLE:
        return pairs(entities)
    e = compared(entities).withColumn("keys", name_keys())
    a, b = _sides(e.drop("keys"))
    same = (F.col("a_document_id") == F.col("b_document_id")) & (F.col("a_entity_id") < F.col("b_entity_id"))
    named = a.join(b, same & (F.col("a_normalized_entity_name") == F.col("b_normalized_entity_name")))
    spoken = e.select("document_id", "entity_id", F.explode("keys").alias("x"))
    heard = spoken.join(_links(entities, lexicon), "x").select("document_id", "entity_id", F.col("y").alias("x"))
    met = heard.withColumnRenamed("entity_id", "p").join(spoken.withColumnRenamed("entity_id", "q"), ["document_id", "x"]).filter("p <> q")
    ids = met.select(F.col("document_id").alias("a_document_id"), F.least("p", "q").alias("a_entity_id"), F.greatest("p", "q").alias("b_entity_id")).distinct()
    letter = lambda p: F.lower(F.substring(F.coalesce(f"{p}_normalized_entity_name", F.lit("")), 1, 1))
    blocked = F.coalesce(F.col("a_entity_type") == F.col("b_entity_type"), F.lit(False)) | (letter("a") == letter("b"))
    aliased = ids.join(a, ["a_document_id", "a_entity_id"]).join(b.withColumn("a_document_id", F.col("b_document_id")), ["a_document_id", "b_entity_id"])
    other = ~F.coalesce(F.col("a_normalized_entity_name") == F.col("b_normalized_entity_name"), F.lit(False))
    return named.unionByName(aliased.filter(blocked & other))


def features(paired: DataFrame, lexicon: Lexicon = Lexicon()) -> DataFrame:
    """The seven features, composite, classification and reason of pairs."""
    rows = paired.withColumn("_ka", name_keys("a_")).withColumn("_kb", name_keys("b_"))
    ids = ["a_document_id", "a_entity_id", "b_entity_id"]
    tied = rows.select(*ids, F.explode("_ka").alias("x"), "_kb").select(*ids, "x", F.explode("_kb").alias("y"))
    linked = tied.join(_links(paired, lexicon), ["x", "y"]).select(*ids).distinct().withColumn("_linked", F.lit(True))
    one = lambda c: F.when(c, F.lit(1.0)).otherwise(F.lit(0.0))
    f = rows.join(linked, ids, "left").withColumns({
        "name_sim": F.pandas_udf(_name_likeness, "double")("a_entity_name", "b_entity_name"),
        "normalized_exact": one(F.col("a_normalized_entity_name") == F.col("b_normalized_entity_name")),
        "type_match": one(F.col("a_entity_type") == F.col("b_entity_type")),
        "chunk_overlap": jaccard(F.col("a_source_chunks"), F.col("b_source_chunks")),
        "attribute_overlap": jaccard(F.col("a_source_attributes"), F.col("b_source_attributes")),
        "evidence_overlap": jaccard(F.col("a_shingles"), F.col("b_shingles")),
        "alias_link": one(F.coalesce("_linked", F.lit(False))),
    })
    return judged(f.withColumns({"document_id": F.col("a_document_id"), "a": F.col("a_entity_id"), "b": F.col("b_entity_id")}))


def judged(f: DataFrame) -> DataFrame:
    """Adds composite, classification and reason to pairs (document_id, a, b) with their features."""
    f = f.withColumn("composite", precise_sum([F.lit(w) * F.col(c) for c, w in WEIGHTS.items()]))
    strong = (F.col("normalized_exact") == 1) | (F.col("alias_link") == 1) | (F.col("attribute_overlap") >= 0.5)
    kind = F.when((F.col("composite") >= DUPLICATE) & (F.col("type_match") == 1) & strong, F.lit("DUPLICATE")).when(F.col("composite") >= POSSIBLE, F.lit("POSSIBLE_DUPLICATE")).otherwise(F.lit("DISTINCT"))
    f = f.withColumn("classification", kind)
    said = F.format_string("%s: composite=%.3f, type_match=%.2f, normalized_exact=%.2f, alias_link=%.2f, attribute_overlap=%.2f, name_sim=%.2f", "classification", "composite", "type_match", "normalized_exact", "alias_link", "attribute_overlap", "name_sim")
    return f.select("document_id", "a", "b", *WEIGHTS, "composite", "classification", said.alias("reason"))


def duplicate_pairs(entities: DataFrame, lexicon: Lexicon = Lexicon()) -> DataFrame:
    """The pairs that are duplicates or may be.

    Beyond ``candidate_pairs``: a pair of one normal name without alias link needs a chunk or an attribute in common, as long
    as the other weights stay below the threshold.
    """
    from specweave.operators import nearest  # it compares by this module's features

    if sum(w for f, w in WEIGHTS.items() if f not in ("chunk_overlap", "attribute_overlap", "alias_link")) >= POSSIBLE or sum(w for f, w in WEIGHTS.items() if f not in ("normalized_exact", "alias_link")) >= POSSIBLE:
        return features(candidate_pairs(entities, lexicon), lexicon).filter("classification <> 'DISTINCT'")
    return judged(nearest.likely_pairs(entities, lexicon)).filter("classification <> 'DISTINCT'")


def groups(entities: DataFrame, found: DataFrame) -> DataFrame:
    """document_id, entity_id, root: the smallest id reached over DUPLICATE pairs, however long the chain; entities without
    such a pair, which are groups of their own, have no row."""
    node = lambda c: F.struct("document_id", F.col(c).alias("entity_id"))
    links = found.filter("classification = 'DUPLICATE'").select(node("a").alias("src"), node("b").alias("dst"))
    return checkpointed(connected_components(links).select("node.document_id", "node.entity_id", F.col("component.entity_id").alias("root")))


def canonical_entities(entities: DataFrame, grouped: DataFrame) -> DataFrame:
    """One row per group: name, type and layer of the member with most chunks (then shortest name, then first), all
    members' attributes, chunks and evidence, and the highest confidence."""
    rows = entities.filter("document_id is not null and entity_id is not null").join(grouped, ["document_id", "entity_id"], "left")
    best = F.struct((-F.size("source_chunks")).alias("few"), F.length("entity_name").alias("long"), "entity_name", "entity_id")
    union = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    several = rows.filter("root is not null").groupBy("document_id", "root").agg(
        F.min_by(F.struct("entity_name", "normalized_entity_name", "entity_type", "layer"), best).alias("m"), F.array_sort(F.collect_set("entity_id")).alias("member_ids"), union("source_attributes").alias("source_attributes"),
        union("source_chunks").alias("source_chunks"), union("supporting_evidence").alias("supporting_evidence"), F.max("confidence").alias("confidence"), F.array_sort(F.collect_set("origin")).alias("origins"),
    )
    alone = lambda c: F.array_sort(F.array_distinct(F.coalesce(F.col(c), F.array().cast(rows.schema[c].dataType))))
    one = rows.filter("root is null").select(
        "document_id", F.col("entity_id").alias("root"), F.struct("entity_name", "normalized_entity_name", "entity_type", "layer").alias("m"), F.array_compact(F.array("entity_id")).alias("member_ids"), alone("source_attributes").alias("source_attributes"),
        alone("source_chunks").alias("source_chunks"), alone("supporting_evidence").alias("supporting_evidence"), "confidence", F.array_compact(F.array("origin")).alias("origins"),
    )
    g = several.unionByName(one)  # most entities are alone and needn't be moved
    return g.select(
        "document_id", F.concat(F.lit("cent-"), F.substring(F.sha2(F.array_join("member_ids", "|"), 256), 1, 16)).alias("canonical_id"), F.col("m.entity_name").alias("canonical_name"), F.col("m.normalized_entity_name").alias("normalized_name"),
        F.col("m.entity_type").alias("entity_type"), F.col("m.layer").alias("layer"), "member_ids", "source_attributes", "source_chunks", "supporting_evidence", F.round("confidence", 6).alias("confidence"), "origins",
    )


def partition_problems(entities: DataFrame, cents: DataFrame, decisions: DataFrame) -> DataFrame:
    """document_id, problem: entities in no group or in several, unknown members, canonical ids that occur twice or don't
    have exactly one decision."""
    said = lambda what, c: F.concat(F.lit(f"{what}: "), F.col(c)).alias("problem")
    members = cents.select("document_id", F.explode("member_ids").alias("entity_id")).groupBy("document_id", "entity_id").agg(F.count(F.lit(1)).alias("n"))
    placed = entities.select("document_id", "entity_id", F.lit(1).alias("here")).join(members, ["document_id", "entity_id"], "full")
    what = F.when(F.col("here").isNull(), "unknown member: ").when(F.col("n").isNull(), "in no group: ").when(F.col("n") > 1, "in several groups: ")
    wrong = placed.select("document_id", F.concat(what, "entity_id").alias("problem")).filter("problem is not null")
    twice = cents.groupBy("document_id", "canonical_id").count().filter("count > 1").select("document_id", said("canonical id twice", "canonical_id"))
    judged = decisions.groupBy("document_id", "canonical_id").agg(F.count(F.lit(1)).alias("n"))
    single = cents.select("document_id", "canonical_id", F.lit(1).alias("here")).join(judged, ["document_id", "canonical_id"], "full").filter("here is null or n is null or n > 1")
    return wrong.unionByName(twice).unionByName(single.select("document_id", said("not exactly one decision", "canonical_id")))


def review_items(found: DataFrame) -> DataFrame:
    """Queue items of possible duplicates."""
    return found.filter("classification = 'POSSIBLE_DUPLICATE'").select(
        "document_id", content_id("hri-", F.lit("possible_duplicate"), F.array_join(F.array_sort(F.array("a", "b")), "|")).alias("item_id"), F.lit("possible_duplicate").alias("kind"), F.array("a", "b").alias("ref_ids"), F.col("composite").alias("score"), "reason"
    )


def given_entities(spark: SparkSession, root: str, once=delivered_once) -> DataFrame:
    """Entities of the given table (first deliveries) that have a name; without a normal name the name in lower case."""
    e = once(table(spark, root, "entities"), ["document_id", "entity_id"]).filter(strip(F.col("entity_name")) != "")
    normal = strip(F.col("normalized_entity_name"))
    return e.withColumn("normalized_entity_name", F.coalesce(F.when(normal != "", normal), F.lower(strip(F.col("entity_name")))))


def q_pairs(spark: SparkSession, root: str) -> DataFrame:
    lexicon = Lexicon.from_table(table(spark, root, "known_entities"))
    f = features(candidate_pairs(given_entities(spark, root), lexicon), lexicon)
    return f.select("document_id", "a", "b", *[F.round(c, 6).alias(c) for c in WEIGHTS], F.round("composite", 6).alias("composite"))


def _given_pairs(spark: SparkSession, root: str) -> DataFrame:
    return duplicate_pairs(checkpointed(given_entities(spark, root)), Lexicon.from_table(table(spark, root, "known_entities")))


def q_duplicates(spark: SparkSession, root: str) -> DataFrame:
    return _given_pairs(spark, root).select("document_id", "a", "b", F.round("composite", 6).alias("composite"), "classification")


def q_groups(spark: SparkSession, root: str) -> DataFrame:
    e = checkpointed(given_entities(spark, root))
    return canonical_entities(e, groups(e, duplicate_pairs(e, Lexicon.from_table(table(spark, root, "known_entities"))))).select("document_id", "canonical_id", "canonical_name", "normalized_name", "entity_type", F.array_join("member_ids", ",").alias("members"), F.size("source_chunks").alias("n_chunks"), "confidence")


def q_reviews(spark: SparkSession, root: str) -> DataFrame:
    return review_items(_given_pairs(spark, root)).select("document_id", "item_id", "kind", F.array_join("ref_ids", "|").alias("refs"), F.round("score", 6).alias("score"))


def q_partition_problems(spark: SparkSession, root: str) -> DataFrame:
    """Where the given canonical entities of documents are no partition of the given entities (first deliveries)."""
    e = delivered_once(table(spark, root, "entities"), ["document_id", "entity_id"])
    c = delivered_once(table(spark, root, "canonical_entities"), ["canonical_id"]).filter("document_id is not null")
    return partition_problems(e, c, c.select("document_id", "canonical_id"))


def common_length_sql(a: str, b: str) -> str:
    """Length of the longest common subsequence of two texts, row by row of the usual table."""
    cell = f"case when ({b})[j] = ch then prev[j] + 1 else greatest(prev[j + 1], acc[j]) end"
    row = f"list_reduce(range(1, length({b}) + 1), lambda acc, j: list_append(acc, {cell}), [0::bigint])"
    return f"list_reduce(string_split({a}, ''), lambda prev, ch: {row}, list_transform(range(length({b}) + 1), lambda i: 0::bigint))[length({b}) + 1]"


def _likeness_sql(a: str, b: str) -> str:
    return f"case when length({a}) = 0 or length({b}) = 0 then 0.0 else 2.0::double * ({common_length_sql(a, b)}) / (length({a}) + length({b})) end"


def overlap_sql(a: str, b: str) -> str:
    size = lambda x: f"(len(list_distinct({x})) + (case when len(list_filter({x}, lambda x: x is null)) > 0 then 1 else 0 end))"
    both = f"list_concat({a}, {b})"
    shared = f"(len(list_distinct(list_intersect({a}, {b}))) + (case when len(list_filter({a}, lambda x: x is null)) > 0 and len(list_filter({b}, lambda x: x is null)) > 0 then 1 else 0 end))"
    return f"case when {size(both)} > 0 then {shared}::double / {size(both)} else 0.0 end"


def features_sql(of: str, pairs_where: str, tag: str = "") -> str:
    """CTEs ``lk`` (links), ``sh`` (entities as compared), ``cp`` (pairs), ``ft`` (features) over a CTE ``of`` with document_id, id,
    name, n (normal name), ty, ch, att, ev; ``pairs_where`` selects pairs of ``a`` and ``b``; ``tag`` is put behind the CTEs' names."""
    values = ", ".join("('{}', '{}')".format(x.replace("'", "''"), y.replace("'", "''")) for x, y in alias_pairs(Lexicon(known={})))
    known = "select lower(trim(name)) as x, lower(trim(unnest(aliases))) as y from known_entities where trim(name) <> ''"
    grams = "case when length(lower(coalesce(x.text, ''))) >= 3 then list_transform(range(1, length(lower(x.text)) - 1), lambda i: lower(x.text)[i:i + 2]) when coalesce(x.text, '') <> '' then [lower(x.text)] else [] end"
    ratio = f"""case when len(wa) = 0 or len(wb) = 0 then 0.0 when sh <> '' and (le = '' or ri = '') then 1.0
      else greatest({_likeness_sql("fl", "fr")}, case when sh <> '' then {_likeness_sql("sh", "fl")} else 0.0 end, case when sh <> '' then {_likeness_sql("sh", "fr")} else 0.0 end) end"""
    return f"""l0{tag} as (select x, y from (values {values}) v(x, y) union {known}), lk{tag} as (select x, y from l0{tag} union select y, x from l0{tag}),
sh{tag} as (select *, list_distinct([lower(trim(coalesce(name, ''))), lower(trim(coalesce(n, '')))]) as ks, coalesce(list_distinct(flatten(list_transform(ev, lambda x: {grams}))), []) as tri,
  list_sort(list_distinct(list_filter(regexp_split_to_array(name, '[\\s\\x1c-\\x1f\\x85\\p{{Z}}]+'), lambda w: w <> ''))) as ws from {of}),
al{tag} as (select distinct a.document_id, a.id as a, b.id as b from (select document_id, id, unnest(ks) as k from sh{tag}) a join lk{tag} lk on lk.x = a.k join (select document_id, id, unnest(ks) as k from sh{tag}) b on b.k = lk.y and b.document_id = a.document_id and a.id < b.id),
cp{tag} as (select a.document_id, a.id as a, b.id as b, a.ws as wa, b.ws as wb, a.n = b.n as ex, coalesce(a.ty = b.ty, false) as tm, al.a is not null as alias,
  {overlap_sql("a.ch", "b.ch")} as chunk_overlap, {overlap_sql("a.att", "b.att")} as attribute_overlap, {overlap_sql("a.tri", "b.tri")} as evidence_overlap
  from sh{tag} a join sh{tag} b on a.document_id = b.document_id and a.id < b.id left join al{tag} al on al.document_id = a.document_id and al.a = a.id and al.b = b.id where {pairs_where}),
w1{tag} as (select *, array_to_string(list_sort(list_intersect(wa, wb)), ' ') as sh, array_to_string(list_filter(wa, lambda w: not list_contains(wb, w)), ' ') as le, array_to_string(list_filter(wb, lambda w: not list_contains(wa, w)), ' ') as ri from cp{tag}),
w2{tag} as (select *, trim(sh || ' ' || le) as fl, trim(sh || ' ' || ri) as fr from w1{tag}),
ft{tag} as (select document_id, a, b, {ratio} as name_sim, coalesce(ex, false)::int::double as normalized_exact, tm::int::double as type_match, chunk_overlap, attribute_overlap, evidence_overlap, alias::int::double as alias_link from w2{tag}),
cm{tag} as (select *, round({" + ".join(f"{w} * {f}" for f, w in WEIGHTS.items())}, 9) as composite from ft{tag}),
cl{tag} as (select *, case when composite >= {DUPLICATE} and type_match = 1 and (normalized_exact = 1 or alias_link = 1 or attribute_overlap >= 0.5) then 'DUPLICATE' when composite >= {POSSIBLE} then 'POSSIBLE_DUPLICATE' else 'DISTINCT' end as classification from cm{tag})"""


GIVEN_SQL = "e as (select *, entity_id as id, entity_name as name, coalesce(nullif(trim(normalized_entity_name), ''), lower(trim(entity_name))) as n, entity_type as ty, coalesce(source_chunks, []) as ch, coalesce(source_attributes, []) as att, supporting_evidence as ev from entities where record_id in (select min(record_id) from entities group by document_id, entity_id) and trim(entity_name) <> '')"
_BLOCKED = "(a.n = b.n or al.a is not null and (coalesce(a.ty = b.ty, false) or lower(a.n[1]) = lower(b.n[1])))"
PAIRS_SQL = f"{GIVEN_SQL}, {features_sql('e', _BLOCKED)}"
#: Groups by the smallest id reached over duplicates, and the canonical entity of each.
GROUPS_SQL = f"""{PAIRS_SQL}, du as (select document_id, a, b from cl where classification = 'DUPLICATE' union select document_id, b, a from cl where classification = 'DUPLICATE'),
reach(document_id, id, seen) as (select document_id, id, id from e union select r.document_id, r.id, du.b from reach r join du on du.document_id = r.document_id and du.a = r.seen),
rt as (select document_id, id, min(seen) as root from reach group by all),
gr as (select e.*, rt.root from e join rt on rt.document_id = e.document_id and rt.id = e.id),
ce as (select document_id, root, min_by(struct_pack(name := name, n := n, ty := ty, layer := layer), (-len(ch), length(name), name, id)) as m, list_sort(list(id)) as member_ids,
  list_sort(list_distinct(flatten(list(ch)))) as ch, list_sort(list_distinct(flatten(list(att)))) as att, list_sort(list_distinct(flatten(list(coalesce(ev, []))))) as ev, max(confidence) as confidence, list_sort(list_distinct(list(origin))) as origins from gr group by document_id, root),
cn as (select *, 'cent-' || left(sha256(array_to_string(member_ids, '|')), 16) as canonical_id from ce)"""
QUERIES = {"partition_problems": q_partition_problems, "pair_features": q_pairs, "duplicate_pairs": q_duplicates, "duplicate_groups": q_groups, "duplicate_reviews": q_reviews}
ORACLES = {
    "partition_problems": """with e as (select * from entities where record_id in (select min(record_id) from entities group by document_id, entity_id)), c as (select * from canonical_entities where record_id in (select min(record_id) from canonical_entities group by canonical_id) and document_id is not null),
m as (select document_id, m, count(*) as n from (select document_id, unnest(member_ids) as m from c) group by all)
select document_id, 'unknown member: ' || m as problem from m where m is not null and not exists (select 1 from e where e.document_id = m.document_id and e.entity_id = m.m)
union all select document_id, 'in no group: ' || entity_id from e where entity_id is not null and not exists (select 1 from m where e.document_id = m.document_id and e.entity_id = m.m)
union all select e.document_id, 'in several groups: ' || entity_id from e join m on e.document_id = m.document_id and e.entity_id = m.m where n > 1""",
    "pair_features": f"with {PAIRS_SQL} select document_id, a, b, {', '.join(f'round({c}, 6) as {c}' for c in (*WEIGHTS, 'composite'))} from cm",
    "duplicate_pairs": f"with {PAIRS_SQL} select document_id, a, b, round(composite, 6) as composite, classification from cl where classification <> 'DISTINCT'",
    "duplicate_groups": f"with recursive {GROUPS_SQL} select document_id, canonical_id, m.name as canonical_name, m.n as normalized_name, m.ty as entity_type, array_to_string(member_ids, ',') as members, len(ch)::int as n_chunks, round(confidence, 6) as confidence from cn",
    "duplicate_reviews": f"with {PAIRS_SQL} select document_id, 'hri-' || left(sha256('possible_duplicate|' || a || '|' || b), 16) as item_id, 'possible_duplicate' as kind, a || '|' || b as refs, round(composite, 6) as score from cl where classification = 'POSSIBLE_DUPLICATE'",
}
