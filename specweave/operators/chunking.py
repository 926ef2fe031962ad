"""Chunking: blocks of a document packed into chunks by page, by token budget, or by headings.

Packing is sequential, so it runs as a stream over blocks sorted within their section (a few blocks in memory, however long
the section); sections, heading paths and chunk numbers are found with running values and windows.

Defined results: documents without blocks give no chunks; null texts count as empty; a block over the budget is never cut;
blocks without page make a page of their own, which counts as page 0 in ids.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, groupby, takewhile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from specweave.functions.running import running_last, running_sum
from specweave.functions.text import token_count
from specweave.operators.cleaning import delivered_once
from specweave.session import table

#: Token budget of a chunk, tokens carried into the next one, and the deepest heading level that starts a section.
MAX_TOKENS, OVERLAP_TOKENS, SPLIT_LEVEL = 800, 100, 3

_PACKED = "document_id string, section bigint, emitted int, heading_path array<string>, id_page int, page_number int, page_end int, block_ids array<string>, source_text string"


def _tail(rows: list[tuple], most: int) -> list[tuple]:
    """The longest end of ``rows`` of at most ``most`` tokens."""
    sums = accumulate(row[4] for row in reversed(rows))
    n = sum(1 for _ in takewhile(lambda s: s <= most, sums))
    return rows[len(rows) - n :]


def _fill(run: Iterator[tuple], lead: list[tuple], most: int, overlap: int) -> Iterator[tuple[list[tuple], list[tuple]]]:
    """The packs of a run of blocks without tables, as (carried rows, new rows); the first one begins with ``lead``."""
    new: list[tuple] = []
    room = most - sum(row[4] for row in lead)
    for row in run:
        if row[4] > room and (lead or new):
            if new:
                yield lead, new
            lead, new = _tail(new, overlap), []
            room = most - sum(r[4] for r in lead)
        new.append(row)
        room -= row[4]
    yield lead, new


def _packed(rows: Iterator[tuple], most: int, overlap: int) -> Iterator[tuple[list[tuple], int]]:
    """Chunks of one section, with the position of their first new block; a row is (block_id, page, kind, text, tokens).

    A table stands alone.  What the pack before it carries on goes to the pack behind it, unless another table follows.
    """
    lead: list[tuple] = []
    for is_table, run in groupby(rows, key=lambda row: row[2] == "table"):
        if is_table:
            for n, row in enumerate(run):
                lead = lead if n == 0 else []
                yield [row], 0
        else:
            new: list[tuple] = []
            for lead, new in _fill(run, lead, most, overlap):
                yield [*lead, *new], len(lead)
            lead = _tail(new, overlap)


def pack(blocks: DataFrame, max_tokens: int = MAX_TOKENS, overlap_tokens: int = OVERLAP_TOKENS) -> DataFrame:
    """Chunks of blocks that carry a ``section`` (and a ``heading_path``): greedy up to the budget, tables alone, overlap
    of new blocks only."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = (r for pdf in batches for r in zip(pdf["document_id"], pdf["section"], pdf["heading_path"], pdf["block_id"], pdf["page"], pdf["kind"], pdf["text"], pdf["tokens"]))
        ahead = next(rows, None)
        out: list[tuple] = []
        while ahead is not None:
            key = ahead[:2]
            path = list(ahead[2]) if ahead[2] is not None else []

            def section() -> Iterator[tuple]:
                nonlocal ahead
                while ahead is not None and ahead[:2] == key:
                    row, ahead = ahead, next(rows, None)
                    yield row[3:]

            for i, (held, fresh) in enumerate(_packed(section(), max_tokens, overlap_tokens)):
                out.append((*key, i, path, held[fresh][1], held[0][1], held[-1][1], [r[0] for r in held], "\n".join(r[3] for r in held)))
                if len(out) >= 2000:
                    yield pd.DataFrame(out, columns=[c.split()[0] for c in _PACKED.split(", ")])
                    out = []
        yield pd.DataFrame(out, columns=[c.split()[0] for c in _PACKED.split(", ")])

    text = F.coalesce("text", F.lit(""))
    ready = blocks.select("document_id", F.col("section").cast("bigint").alias("section"), "heading_path", "block_id", "page", "kind", text.alias("text"), token_count(text).alias("tokens"), "ord")
    ordered = ready.repartition("document_id", "section").sortWithinPartitions("document_id", "section", "ord")
    return ordered.mapInPandas(run, _PACKED)


def numbered(packed: DataFrame, strategy: str) -> DataFrame:
    """Chunks with ids: numbered per document and page of their first new block, in the order they were made."""
    order = Window.partitionBy("document_id", F.coalesce("id_page", F.lit(0))).orderBy("section", "emitted")
    n = F.row_number().over(order) - 1
    return packed.withColumn("n", n).select(
        "document_id",
        F.format_string("chunk-%s-p%04d-%04d", "document_id", F.coalesce("id_page", F.lit(0)), "n").alias("chunk_id"),
        F.col("section").alias("section"), F.col("emitted").alias("emitted"), "page_number", "page_end", "source_text", "block_ids", "heading_path",
        token_count(F.col("source_text")).alias("token_count"), F.lit(strategy).alias("strategy"),
    )


def fixed_tokens(blocks: DataFrame, max_tokens: int = MAX_TOKENS, overlap_tokens: int = OVERLAP_TOKENS) -> DataFrame:
    plain = blocks.withColumn("section", F.lit(0)).withColumn("heading_path", F.array().cast("array<string>"))
    return numbered(pack(plain, max_tokens, overlap_tokens), "fixed_tokens")


def by_page(blocks: DataFrame, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """One chunk per page; pages over the budget are packed without overlap, tables alone."""
    text = F.coalesce("text", F.lit(""))
    whole = blocks.groupBy("document_id", "page").agg(F.sum(F.size(F.filter(F.split(text, r"(?U)\s+"), lambda w: w != ""))).alias("words"))
    fits = whole.select("document_id", "page", (F.ceil(F.col("words") * F.lit(1.3)) <= max_tokens).alias("fits"))
    paged = blocks.join(fits.withColumnRenamed("page", "_page"), (blocks.document_id == fits.document_id) & blocks.page.eqNullSafe(F.col("_page"))).drop(fits.document_id).drop("_page")
    paged = paged.withColumn("section", F.coalesce("page", F.lit(-1))).withColumn("heading_path", F.array().cast("array<string>"))
    small = paged.filter("fits").groupBy("document_id", "page").agg(F.array_sort(F.collect_list(F.struct("ord", "block_id", text.alias("text")))).alias("b"))
    one = small.select(
        "document_id", F.coalesce("page", F.lit(-1)).cast("bigint").alias("section"), F.lit(0).alias("emitted"), F.array().cast("array<string>").alias("heading_path"), F.col("page").alias("id_page"), F.col("page").alias("page_number"),
        F.col("page").alias("page_end"), F.col("b.block_id").alias("block_ids"), F.array_join(F.col("b.text"), "\n").alias("source_text"),
    )
    return numbered(one.unionByName(pack(paged.filter("not fits"), max_tokens, 0)), "by_page")


_STACK = "array<struct<level:int,text:string>>"


def _above(stack: list, headings: list) -> list:
    """The headings that hold after ``headings`` (a stack itself) came upon ``stack``."""
    return [h for h in stack if h[0] < headings[0][0]] + headings if headings else stack


def _stacks(rows: DataFrame, group: list[str], order: str, before: bool) -> DataFrame:
    """Adds ``held``: the headings that hold after each row's own ``stack`` came (``before``: those that held ahead of it),
    going through each group in order with one stack in memory."""
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name in [*group, order])
    names = [f.name for f in rows.schema if f.name in [*group, order]]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, held = None, []
        for pdf in batches:
            out = []
            for own, stack in zip(zip(*[pdf[g] for g in group]), pdf["stack"]):
                if own != key:
                    key, held = own, []
                after = _above(held, [(h["level"], h["text"]) for h in stack])
                out.append([{"level": n, "text": t} for n, t in (held if before else after)])
                held = after
            yield pdf[names].assign(held=out)

    ordered = rows.select(*names, "stack").repartition(*group).sortWithinPartitions(*group, order)
    return ordered.mapInPandas(run, f"{types}, held {_STACK}")


def heading_paths(blocks: DataFrame, split_level: int = SPLIT_LEVEL, bucket: int = 4096) -> DataFrame:
    """document_id, head_ord, section, heading_path of every heading: the headings of any depth that hold from it on.

    In two levels, so that no task goes through all headings of a huge document: the stack within buckets of positions, then
    the stacks of whole buckets carried on.
    """
    heads = blocks.filter("kind = 'heading' and heading_level is not null").select(
        "document_id", F.col("ord").alias("head_ord"), F.floor(F.col("ord") / bucket).alias("bucket"), F.array(F.struct(F.col("heading_level").alias("level"), "text")).cast(_STACK).alias("stack"),
        (F.col("heading_level") <= split_level).cast("int").alias("splits"),
    )
    key = ["document_id", "bucket"]
    inside = _stacks(heads, key, "head_ord", before=False)
    ends = inside.groupBy(*key).agg(F.max_by("held", "head_ord").alias("stack"))
    carried = _stacks(ends, ["document_id"], "bucket", before=True).withColumnRenamed("held", "carried")
    outer = F.filter("carried", lambda h: h["level"] < F.col("held")[0]["level"])
    path = F.transform(F.concat(outer, "held"), lambda h: h["text"])
    paths = inside.join(carried, key).select("document_id", "head_ord", path.alias("heading_path"))
    numbers = running_sum(heads.select("document_id", "head_ord", "splits"), ["document_id"], "head_ord", "splits", "section").drop("splits")
    return paths.join(numbers, ["document_id", "head_ord"])


def heading_state(blocks: DataFrame, split_level: int = SPLIT_LEVEL, bucket: int = 4096) -> DataFrame:
    """Blocks with ``section`` (number of splitting headings so far) and ``heading_path`` (the headings that hold there)."""
    here = F.when((F.col("kind") == "heading") & F.col("heading_level").isNotNull(), F.col("ord"))
    last = running_last(blocks.withColumn("_here", here), ["document_id"], "ord", {"head_ord": "_here"}, bucket=bucket).drop("_here")
    joined = last.join(heading_paths(blocks, split_level, bucket), ["document_id", "head_ord"], "left").drop("head_ord")
    return joined.withColumns({"section": F.coalesce("section", F.lit(0)), "heading_path": F.coalesce("heading_path", F.array().cast("array<string>"))})


def heading_aware(blocks: DataFrame, max_tokens: int = MAX_TOKENS, overlap_tokens: int = OVERLAP_TOKENS, split_level: int = SPLIT_LEVEL) -> DataFrame:
    """Sections begin at headings up to ``split_level``; each is packed by itself.  A section's path is the one at its end."""
    state = heading_state(blocks, split_level)
    ends = state.groupBy("document_id", "section").agg(F.max_by("heading_path", "ord").alias("heading_path"))
    return numbered(pack(state.drop("heading_path").join(ends, ["document_id", "section"]), max_tokens, overlap_tokens), "heading_aware")


STRATEGIES = {"by_page": by_page, "fixed_tokens": fixed_tokens, "heading_aware": heading_aware}


def chunk(blocks: DataFrame, strategy: str = "heading_aware") -> DataFrame:
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}: one of {', '.join(STRATEGIES)}")
    return STRATEGIES[strategy](blocks)


def chunk_problems(chunks: DataFrame, blocks: DataFrame) -> DataFrame:
    """document_id, problem: ids that occur twice, blocks in no chunk, blocks that don't exist."""
    twice = chunks.groupBy("document_id", "chunk_id").count().filter("count > 1").select("document_id", F.concat(F.lit("twice: "), "chunk_id").alias("problem"))
    used = chunks.select("document_id", F.explode("block_ids").alias("block_id")).distinct()
    lost = blocks.select("document_id", "block_id").join(used, ["document_id", "block_id"], "left_anti").select("document_id", F.concat(F.lit("in no chunk: "), "block_id").alias("problem"))
    odd = used.join(blocks.select("document_id", "block_id"), ["document_id", "block_id"], "left_anti").select("document_id", F.concat(F.lit("unknown: "), "block_id").alias("problem"))
    return twice.unionByName(lost).unionByName(odd)


# -- queries ---------------------------------------------------------------------------------------------------------

_OUT = ["document_id", "chunk_id", "page_number", "page_end", "token_count", "block_ids", "heading_path"]


def _blocks(spark: SparkSession, root: str) -> DataFrame:
    return delivered_once(table(spark, root, "blocks"), ["document_id", "block_id"])


def q_token_counts(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "documents").select("doc_id", token_count(F.coalesce("text", F.lit(""))).alias("tokens"))


def q_by_page(spark: SparkSession, root: str) -> DataFrame:
    return by_page(_blocks(spark, root)).select(*_OUT)


def q_fixed(spark: SparkSession, root: str) -> DataFrame:
    return fixed_tokens(_blocks(spark, root)).select(*_OUT)


def q_heading_aware(spark: SparkSession, root: str) -> DataFrame:
    return heading_aware(_blocks(spark, root)).select(*_OUT)


def q_heading_paths(spark: SparkSession, root: str) -> DataFrame:
    return heading_state(_blocks(spark, root)).select("document_id", "block_id", F.col("section").cast("bigint").alias("section"), F.array_join("heading_path", " > ").alias("path"))


def q_chunk_problems(spark: SparkSession, root: str) -> DataFrame:
    """Of the given chunks, all deliveries, against the blocks."""
    return chunk_problems(table(spark, root, "chunks"), _blocks(spark, root))


_ONCE = "b as (select * from blocks where record_id in (select min(record_id) from blocks group by document_id, block_id))"
_HEADS = f"""h as (select document_id, ord, text, heading_level as lvl from b where kind = 'heading' and heading_level is not null),
lives as (select h.*, (select min(g.ord) from h g where g.document_id = h.document_id and g.ord > h.ord and g.lvl <= h.lvl) as dies from h),
s as (select b.*, (select count(*) from h where h.document_id = b.document_id and h.ord <= b.ord and lvl <= {SPLIT_LEVEL}) as section,
  coalesce((select list(l.text order by l.ord) from lives l where l.document_id = b.document_id and l.ord <= b.ord and (dies is null or b.ord < dies)), []) as path from b)"""


def _tokens(text: str) -> str:
    return rf"ceil(len(list_filter(regexp_split_to_array({text}, '[\s\x1c-\x1f\x85\p{{Z}}]+'), lambda x: x <> '')) * 1.3::double)::int"



#: The greedy packing of the rows of ``r`` (d, sec, i, bid, pg, tbl, t, txt; i from 1 within d and sec), block by block.
_PACKING = f"""
walk as (
  select d, sec, i, case when tbl then 0 else t end as size, not tbl as fresh, case when tbl then [] else [i] end as held, 0 as lead, case when tbl then [[i]] else [] end as made, case when tbl then [0] else [] end as leads from r where i = 1
  union all
  select r.d, r.sec, r.i,
    case when r.tbl then w.c_size else case when w.cut then w.c_size else w.size end + r.t end,
    not r.tbl,
    case when r.tbl then w.c_held else list_append(case when w.cut then w.c_held else w.held end, r.i) end,
    case when r.tbl then len(w.c_held) when w.cut then len(w.c_held) else w.lead end,
    list_concat(case when w.cut and w.fresh then [w.held] else [] end, case when r.tbl then [[r.i]] else [] end),
    list_concat(case when w.cut and w.fresh then [w.lead] else [] end, case when r.tbl then [0] else [] end)
  from (
    select w.*, n.tbl or (len(w.held) > 0 and w.size + n.t > @MOST@) as cut,
      case when w.fresh then (select coalesce(list(x.i order by x.i), []) from r x where x.d = w.d and x.sec = w.sec and x.i in (select unnest(w.held[w.lead + 1:]))
        and (select sum(y.t) from r y where y.d = w.d and y.sec = w.sec and y.i between x.i and w.i) <= @OVERLAP@) else [] end as c_held,
      case when w.fresh then (select coalesce(sum(x.t), 0) from r x where x.d = w.d and x.sec = w.sec and x.i in (select unnest(w.held[w.lead + 1:]))
        and (select sum(y.t) from r y where y.d = w.d and y.sec = w.sec and y.i between x.i and w.i) <= @OVERLAP@) else 0 end as c_size
    from walk w join r n on n.d = w.d and n.sec = w.sec and n.i = w.i + 1) w
  join r on r.d = w.d and r.sec = w.sec and r.i = w.i + 1),
made as (
  select d, sec, i, made, leads from walk
  union all select d, sec, i + 1, [held], [lead] from walk w where fresh and i = (select max(i) from r where r.d = w.d and r.sec = w.sec)),
packs as (select d, sec, i, unnest(made) as ids, unnest(leads) as lead, unnest(range(len(made))) as n from made),
full_packs as (
  select p.d, p.sec, p.i, p.n, list(r.bid order by r.i) as block_ids, min_by(r.pg, r.i) as page_number, max_by(r.pg, r.i) as page_end, string_agg(r.txt, chr(10) order by r.i) as txt,
    min_by(r.pg, case when list_position(p.ids, r.i) > p.lead then r.i end) as id_page
  from (select *, unnest(ids) as e from packs) p join r on r.d = p.d and r.sec = p.sec and r.i = p.e group by p.d, p.sec, p.i, p.n)"""


def _packing(most: int, overlap: int) -> str:
    return _PACKING.replace("@MOST@", str(most)).replace("@OVERLAP@", str(overlap))


def _rows(section: str, of: str) -> str:
    return f"""select document_id as d, {section} as sec, row_number() over (partition by document_id, {section} order by ord) as i, block_id as bid, page as pg, coalesce(kind = 'table', false) as tbl,
  {_tokens("coalesce(text, '')")} as t, coalesce(text, '') as txt from {of}"""


def _chunk_sql(path: str, of: str) -> str:
    number = "'chunk-' || d || '-p' || printf('%04d', id_page) || '-' || printf('%04d', row_number() over (partition by d, id_page order by sec, i, n) - 1)"
    return f"select d as document_id, {number} as chunk_id, page_number, page_end, {_tokens('txt')} as token_count, block_ids, {path} as heading_path from {of}"


QUERIES = {"token_counts": q_token_counts, "chunks_by_page": q_by_page, "chunks_fixed_tokens": q_fixed, "chunks_heading_aware": q_heading_aware, "heading_paths": q_heading_paths, "chunk_problems": q_chunk_problems}
ORACLES = {
    "token_counts": r"select doc_id, ceil(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\s\x1c-\x1f\x85\p{Z}]+'), lambda x: x <> '')) * 1.3::double)::int as tokens from documents",
    "heading_paths": f"with {_ONCE}, {_HEADS} select document_id, block_id, section, array_to_string(path, ' > ') as path from s",
    "chunks_fixed_tokens": f"with recursive {_ONCE}, r as ({_rows('0', 'b')}), {_packing(MAX_TOKENS, OVERLAP_TOKENS)} {_chunk_sql('[]::varchar[]', 'full_packs')}",
    "chunks_heading_aware": f"""with recursive {_ONCE}, {_HEADS}, r as ({_rows("section", "s")}), {_packing(MAX_TOKENS, OVERLAP_TOKENS)},
ends as (select document_id, section, max_by(path, ord) as path from s group by all)
{_chunk_sql("path", "full_packs join ends on ends.document_id = d and ends.section = sec")}""",
    "chunks_by_page": f"""with recursive {_ONCE}, w as (select *, {_tokens("string_agg(coalesce(text, ''), ' ') over (partition by document_id, page)")} <= {MAX_TOKENS} as fits from b),
r as ({_rows("page", "w where not fits")}), {_packing(MAX_TOKENS, 0)},
small as (select document_id as d, page as sec, 0 as i, 0 as n, list(block_id order by ord) as block_ids, page as page_number, page as page_end, string_agg(coalesce(text, ''), chr(10) order by ord) as txt, page as id_page from w where fits group by document_id, page),
every as (select * from full_packs union all by name select * from small)
{_chunk_sql("[]::varchar[]", "every")}""",
    "chunk_problems": f"""with {_ONCE}, u as (select distinct document_id, unnest(block_ids) as block_id from chunks)
select document_id, 'twice: ' || chunk_id as problem from chunks group by document_id, chunk_id having count(*) > 1
union all select document_id, 'in no chunk: ' || block_id from b where not exists (select 1 from u where u.document_id = b.document_id and u.block_id = b.block_id)
union all select document_id, 'unknown: ' || block_id from u where not exists (select 1 from b where u.document_id = b.document_id and u.block_id = b.block_id)""",
}
