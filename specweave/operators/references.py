"""References to records that do not exist.

Every change is a signed delta of one key (target table, id): ``+1`` on its existence count when a row of the id arrives, ``-1``
when that row is withdrawn; ``+1`` on its reference count when a row that refers to it arrives, ``-1`` when that one is
withdrawn.  Keys with positive references and no existence are the current orphan report; a reference is an orphan at its
arrival if the existence count is zero at that moment.

Counts over time are running sums over the distinct moments of a key, in two levels (minutes, then within a minute), so
however many deltas a key has, what a task sums has a bound given by time.  A key's count stays positive from the first
arrival of a row that is never withdrawn on; only references before that moment, and withdrawn rows, need the running sums.

Defined results
    * a null or blank reference, and one whose id begins like no known table, is none;
    * ids are compared in lower case and without outer blanks;
    * a row withdrawn at or before its arrival, or without arrival time, never existed;
    * a reference without arrival time precedes everything, so it is an orphan, with a null period;
    * repeated rows count separately (each has its own record_id); repeated elements of one array count once.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from specweave.functions.keys import id_key
from specweave.session import Shelf, table

#: The tables that can be referred to, their id column and how their ids begin.
TARGETS = {
    "chunks": ("chunk_id", "chunk-"),
    "attributes": ("attribute_id", "attr-"),
    "entities": ("entity_id", "ent-"),
    "mappings": ("mapping_id", "map-"),
    "canonical_entities": ("canonical_id", "cent-"),
}
_CODE = {name: i for i, name in enumerate(TARGETS)}
_BEFORE_ALL = "0001-01-01 00:00:00"


@dataclass(frozen=True)
class Reference:
    """A field that refers to another table; ``target`` None means the id's beginning tells which."""

    table: str
    field: str
    target: str | None
    repeated: bool = False


#: The reference fields of the model.
REFERENCES = (
    Reference("attributes", "source_chunk", "chunks"),
    Reference("mappings", "entity_id", "canonical_entities"),
    Reference("trace_edges", "to_id", None),
    Reference("entities", "source_attributes", "attributes", repeated=True),
)


def _target_of(key: Column) -> Column:
    chain = F.lit(None).cast("tinyint")
    for name, (_, prefix) in reversed(TARGETS.items()):
        chain = F.when(key.startswith(prefix), F.lit(_CODE[name]).cast("tinyint")).otherwise(chain)
    return chain


_KEY = ["target", "key"]


def _gone(rows: DataFrame) -> Column:
    return F.col("deleted_at") if "deleted_at" in rows.columns else F.lit(None).cast("timestamp_ntz")


def lifetimes(rows: DataFrame, name: str) -> DataFrame:
    """target, key, born, gone of the rows of one referenced table that ever lived."""
    lived = rows.select(F.lit(_CODE[name]).cast("tinyint").alias("target"), id_key(F.col(TARGETS[name][0])).alias("key"), F.col("loaded_at").alias("born"), _gone(rows).alias("gone"))
    return lived.filter("key is not null and born is not null and (gone is null or gone > born)")


def references_of(rows: DataFrame, code: int, ref: Reference) -> DataFrame:
    """target, key, at, gone, ref, record_id: the references of one field; ``gone`` is when the referring row is withdrawn."""
    if ref.repeated:
        keys = F.explode(F.array_distinct(F.transform(F.col(ref.field), id_key)))
    else:
        keys = id_key(F.col(ref.field))
    found = rows.select("record_id", F.col("loaded_at").alias("at"), _gone(rows).alias("gone"), keys.alias("key")).filter("key is not null")
    target = F.lit(_CODE[ref.target]).cast("tinyint") if ref.target else _target_of(F.col("key"))
    at = F.coalesce("at", F.lit(_BEFORE_ALL).cast("timestamp_ntz"))
    return found.select(target.alias("target"), "key", at.alias("at"), "gone", F.lit(code).cast("tinyint").alias("ref"), "record_id").filter("target is not null")


def deltas_of(rows: DataFrame, name: str, references: tuple[Reference, ...] = REFERENCES, sign: int = 1) -> DataFrame:
    """target, key, at, refs, exists: all signed deltas that rows of one table bring (``sign`` -1: rows taken back)."""
    parts = []
    if name in TARGETS:
        parts.append(lifetimes(rows, name).select(*_KEY, "born", "gone", F.lit(0).alias("refs"), F.lit(sign).alias("exists")))
    for code, ref in enumerate(references):
        if ref.table == name:
            parts.append(references_of(rows, code, ref).filter("gone is null or gone > at").select(*_KEY, F.col("at").alias("born"), "gone", F.lit(sign).alias("refs"), F.lit(0).alias("exists")))
    both = F.array(F.struct(F.col("born").alias("at"), "refs", "exists"), F.struct(F.col("gone").alias("at"), (-F.col("refs")).alias("refs"), (-F.col("exists")).alias("exists")))
    return reduce(DataFrame.unionByName, parts).select(*_KEY, F.explode(both).alias("d")).filter("d.at is not null").select(*_KEY, "d.at", "d.refs", "d.exists")


def current_orphans(deltas: DataFrame) -> DataFrame:
    """table, ref_id, refs: the keys that are referred to and of which no row lives, with their references."""
    counts = deltas.groupBy(*_KEY).agg(F.sum("refs").alias("refs"), F.sum("exists").alias("exists")).filter("refs > 0 and exists <= 0")
    return counts.select(F.element_at(F.array(*[F.lit(n) for n in TARGETS]), F.col("target").cast("int") + 1).alias("target_table"), F.col("key").alias("ref_id"), "refs")


def moments_without(deltas: DataFrame) -> DataFrame:
    """target, key, at: the moments of ``deltas`` (target, key, at, exists) at which the running existence count is zero."""
    moments = deltas.groupBy(*_KEY, "at").agg(F.sum("exists").alias("net")).withColumn("minute", F.date_trunc("minute", "at"))
    running = lambda by, order, last: Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, last)
    opening = moments.groupBy(*_KEY, "minute").agg(F.sum("net").alias("sum")).withColumn("opening", F.coalesce(F.sum("sum").over(running(_KEY, "minute", -1)), F.lit(0)))
    live = F.sum("net").over(running([*_KEY, "minute"], "at", 0)) + F.col("opening")
    return moments.join(opening.drop("sum"), [*_KEY, "minute"]).withColumn("live", live).filter("live <= 0").select(*_KEY, "at")


def missing_references(tables: dict[str, DataFrame], references: tuple[Reference, ...] = REFERENCES) -> DataFrame:
    """Orphan references: table_name, record_id, ref_field, ref_id, period (``yyyy-MM`` of the reference's arrival).

    What is joined is written before, so that adaptive execution can split the references of a hot id.
    """
    shelf = Shelf(next(iter(tables.values())).sparkSession)
    lives = reduce(DataFrame.unionByName, [lifetimes(tables[name], name) for name in TARGETS])
    lasting = shelf.keep(lives.filter("gone is null").groupBy(*_KEY).agg(F.min("born").alias("lasts_from")))
    refs = reduce(DataFrame.unionByName, [references_of(tables[ref.table], code, ref) for code, ref in enumerate(references)]).drop("gone")
    doubtful = shelf.keep(refs.join(lasting, _KEY, "left").filter("lasts_from is null or at < lasts_from").drop("lasts_from"))
    withdrawn = lives.filter("gone is not null").select(*_KEY, F.explode(F.array(F.struct(F.col("born").alias("at"), F.lit(1).alias("exists")), F.struct(F.col("gone").alias("at"), F.lit(-1).alias("exists")))).alias("d"))
    deltas = withdrawn.select(*_KEY, "d.at", "d.exists").unionByName(doubtful.select(*_KEY, "at", F.lit(0).alias("exists")))
    found = doubtful.join(shelf.keep(moments_without(deltas)), [*_KEY, "at"])
    pick = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("ref").cast("int") + 1)
    return found.select(
        pick([r.table for r in references]).alias("table_name"),
        "record_id",
        pick([r.field for r in references]).alias("ref_field"),
        F.col("key").alias("ref_id"),
        F.when(F.col("at") > F.lit(_BEFORE_ALL).cast("timestamp_ntz"), F.date_format("at", "yyyy-MM")).alias("period"),
    )


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Orphan references and distinct missing ids by table, field and period."""
    return orphans.groupBy("table_name", "ref_field", "period").agg(F.count(F.lit(1)).alias("orphan_refs"), F.countDistinct("ref_id").alias("missing_ids"))


def _tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {name: table(spark, root, name) for name in (*TARGETS, "trace_edges")}


def p2_found(spark: SparkSession, root: str) -> DataFrame:
    return missing_references(_tables(spark, root))


def p2_report(spark: SparkSession, root: str) -> DataFrame:
    return orphan_report(p2_found(spark, root))


def p2_current(spark: SparkSession, root: str) -> DataFrame:
    """The current orphan report: what is referred to now, all changes taken together, and doesn't exist now."""
    tables = _tables(spark, root)
    return current_orphans(reduce(DataFrame.unionByName, [deltas_of(rows, name) for name, rows in tables.items()]))


_SQL_FOUND = """
with rows_of as (
  select 'chunks' as t, lower(trim(chunk_id)) as k, loaded_at as born, deleted_at as gone from chunks
  union all select 'attributes', lower(trim(attribute_id)), loaded_at, deleted_at from attributes
  union all select 'entities', lower(trim(entity_id)), loaded_at, deleted_at from entities
  union all select 'mappings', lower(trim(mapping_id)), loaded_at, deleted_at from mappings
  union all select 'canonical_entities', lower(trim(canonical_id)), loaded_at, deleted_at from canonical_entities),
refs as (
  select 'attributes' as table_name, record_id, 'source_chunk' as ref_field, lower(trim(source_chunk)) as ref_id, loaded_at, 'chunks' as t from attributes
  union all select 'mappings', record_id, 'entity_id', lower(trim(entity_id)), loaded_at, 'canonical_entities' from mappings
  union all select distinct 'entities', record_id, 'source_attributes', lower(trim(x)), loaded_at, 'attributes'
    from (select record_id, loaded_at, unnest(source_attributes) as x from entities)
  union all select 'trace_edges', record_id, 'to_id', lower(trim(to_id)), loaded_at,
    case split_part(lower(trim(to_id)), '-', 1) when 'chunk' then 'chunks' when 'attr' then 'attributes' when 'ent' then 'entities'
      when 'map' then 'mappings' when 'cent' then 'canonical_entities' end from trace_edges),
orphans as (
  select table_name, record_id, ref_field, ref_id, strftime(loaded_at, '%Y-%m') as period from refs r
  where ref_id <> '' and t is not null and not exists (
    select 1 from rows_of e where e.t = r.t and e.k = r.ref_id and e.born <= r.loaded_at and (e.gone is null or e.gone > r.loaded_at)))
"""

_SQL_CURRENT = """
, live_refs as (
  select t, lower(trim(k)) as k from (
    select 'chunks' as t, source_chunk as k from attributes where deleted_at is null
    union all select 'canonical_entities', entity_id from mappings where deleted_at is null
    union all select 'attributes', x from (select distinct record_id, lower(trim(x)) as x from (select record_id, unnest(source_attributes) as x from entities where deleted_at is null))
    union all select case split_part(lower(trim(to_id)), '-', 1) when 'chunk' then 'chunks' when 'attr' then 'attributes' when 'ent' then 'entities'
      when 'map' then 'mappings' when 'cent' then 'canonical_entities' end, to_id from trace_edges))
select t as target_table, k as ref_id, count(*) as refs from live_refs where t is not null and k <> ''
  and not exists (select 1 from rows_of e where e.t = live_refs.t and e.k = live_refs.k and e.born is not null and e.gone is null) group by all
"""

QUERIES = {"p2_found": p2_found, "p2_report": p2_report, "p2_current": p2_current}
ORACLES = {
    "p2_current": _SQL_FOUND + _SQL_CURRENT,
    "p2_found": _SQL_FOUND + "select * from orphans",
    "p2_report": _SQL_FOUND + "select table_name, ref_field, period, count(*) as orphan_refs, count(distinct ref_id) as missing_ids from orphans group by all",
}
