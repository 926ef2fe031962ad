"""Consolidating pairwise matches into groups: large-star / small-star edge rewrites until nothing changes.

The rewrites are those of ``operators.components``; here are the links between entities, and the groups of entity ids.

Defined results
    * ids are compared in lower case and without outer blanks; null and blank ids link nothing;
    * self-links, repeated and reversed links change nothing; an empty table gives no groups;
    * an entity linked to no other entity is in no group (a canonical entity alone doesn't make one).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specweave.functions.keys import id_key
from specweave.operators.components import numbered, numbered_components
from specweave.session import Shelf, table


def entity_links(canonicals: DataFrame, edges: DataFrame) -> DataFrame:
    """The links between entities and canonical entities, as a star around each canonical entity."""
    rows = canonicals.select(id_key(F.col("canonical_id")).alias("c"), F.filter(F.transform("member_ids", id_key), lambda m: m.isNotNull()).alias("m"))
    listed = rows.select(F.coalesce("c", F.array_min("m")).alias("dst"), F.explode("m").alias("src")).select("src", "dst")
    ends = edges.select(id_key(F.col("from_id")).alias("a"), id_key(F.col("to_id")).alias("b"))
    traced = ends.filter("(a like 'ent-%' and b like 'cent-%') or (a like 'cent-%' and b like 'ent-%')").select(F.col("a").alias("src"), F.col("b").alias("dst"))
    return listed.union(traced)


def entity_groups(canonicals: DataFrame, edges: DataFrame) -> DataFrame:
    """entity_id, group_id (the smallest entity_id of the group) of every entity in a group of two or more."""
    shelf = Shelf(canonicals.sparkSession)
    links, names = numbered(entity_links(canonicals, edges), shelf)
    found = numbered_components(links, shelf)
    own = names.filter("id like 'ent-%'")
    entities = shelf.keep(found.join(own, found.node == own.number).select("id", "number", "component"))
    groups = entities.groupBy("component").agg(F.min("number").alias("least"), F.count(F.lit(1)).alias("n")).filter("n >= 2")
    named = shelf.keep(groups.join(own, F.col("least") == own.number).select("component", F.col("id").alias("group_id")))
    return entities.join(named, "component").select(F.col("id").alias("entity_id"), "group_id")


def p5_found(spark: SparkSession, root: str) -> DataFrame:
    return entity_groups(table(spark, root, "canonical_entities"), table(spark, root, "trace_edges"))


SQL_FOUND = """
with recursive links as (
  select lower(trim(m)) as a, lower(trim(canonical_id)) as b from (select canonical_id, unnest(member_ids) as m from canonical_entities) where trim(m) <> ''
  union select lower(trim(from_id)), lower(trim(to_id)) from trace_edges
    where lower(trim(from_id)) like 'ent-%' and lower(trim(to_id)) like 'cent-%' or lower(trim(from_id)) like 'cent-%' and lower(trim(to_id)) like 'ent-%'),
both_ways as (select a, b from links union select b, a from links),
reach(node, seen) as (
  select distinct a, a from both_ways where a like 'ent-%'
  union select r.node, l.b from reach r join both_ways l on l.a = r.seen),
least as (select node, min(seen) filter (seen like 'ent-%') as group_id, count(*) filter (seen like 'ent-%') as n from reach group by node)
select node as entity_id, group_id from least where n >= 2
"""
