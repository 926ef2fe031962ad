"""Attribute candidates: rows of specification tables, key/value tables, form fields, and finds in prose.

A candidate carries the place it came from (``place``: position of the block in its chunk, emitter, position within it),
which orders candidates the same way however the data is partitioned.

Defined results: furniture gives none; null and blank names give none; a block carried over into a second chunk gives its
candidates in both; in one block of a chunk a name (case aside) is proposed once, by the first emitter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from specweave.functions.text import UI, U, merged_span, quoted, sentences, strip
from specweave.operators.cleaning import delivered_once
from specweave.operators.mentions import mentions
from specweave.session import table
from specweave.sources.lexicons import Lexicon, lookup

#: Column headers by category.
HEADERS = {
    "name": ["name", "attribute", "parameter", "field", "attribute name", "parameter name"],
    "type": ["type", "datatype", "data type"],
    "units": ["unit", "units"],
    "optionality": ["m/o/c", "moc", "optionality", "mandatory", "opt", "m/o"],
    "default": ["default", "default value"],
    "description": ["description", "desc", "definition"],
    "range": ["range", "values", "allowed values", "domain", "value range", "enumeration"],
}
#: Headings that name an entity; endings of nouns made of verbs.
HEADING_ENTITY = UI + r"^\s*(?:\d+(?:\.\d+)*\s+)?(.+?)\s+(?:service\s+)?attributes\s*$"
NOMINAL = r"(?:tion|ing|ment|ance)$"
_KEYS = ["document_id", "chunk_id", "block_id", "pos"]
_OUT = [*_KEYS, "place", "raw_name", "origin", "cells", "sentence"]


def no_cells() -> Column:
    return F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))


def heading_entity(text: Column) -> Column:
    """``4.3 EVC Service Attributes`` -> ``EVC``; null for other headings."""
    found = strip(F.regexp_extract(text, HEADING_ENTITY, 1))
    return F.when(found != "", found)


def categories(header: Column) -> Column:
    names = {alias: category for category, aliases in HEADERS.items() for alias in aliases}
    return F.transform(header, lambda h: lookup(names, F.lower(strip(h))))


def implied_entities(blocks: DataFrame, lexicon: Lexicon) -> DataFrame:
    """document_id, name, ord: entities that headings and table subjects of a document imply and the lexicon doesn't know."""
    texts = F.array_compact(F.array(F.when(F.col("heading_level").isNotNull(), F.col("text")), F.col("tbl.subject_hint")))
    said = blocks.select("document_id", "ord", F.explode(texts).alias("t")).select("document_id", "ord", heading_entity(F.col("t")).alias("name")).filter("name is not null")
    known = blocks.sparkSession.createDataFrame([(k,) for k in lexicon.entity_keys()], "key string")
    keyed = said.withColumn("key", F.lower(F.regexp_replace("name", r"(?U)\s+", " "))).join(F.broadcast(known), "key", "left_anti")  # the lexicon is bounded
    return keyed.groupBy("document_id", "key").agg(F.min_by("name", "ord").alias("name"), F.min("ord").alias("ord"))


def document_terms(blocks: DataFrame, lexicon: Lexicon) -> DataFrame:
    """The implied entities of each document as terms."""
    return implied_entities(blocks, lexicon).select(
        "document_id", F.lit("entity").alias("source"), F.col("name").alias("canonical"), (F.col("ord") + 1_000_000).alias("canonical_ord"), F.col("name").alias("term"), F.lit(0).alias("term_ord")
    )


def block_mentions(blocks: DataFrame, lexicon: Lexicon) -> DataFrame:
    """document_id, block_id and the terms (entities, gazetteer, implied entities) that stand in each block."""
    texts = blocks.select("document_id", "block_id", "text")
    keys = ["document_id", "block_id"]
    found = mentions(texts, keys, F.broadcast(lexicon.mention_terms(blocks.sparkSession)))  # the lexicon is bounded
    return found.unionByName(mentions(texts, keys, document_terms(blocks, lexicon), by=["document_id"]))


def placed_blocks(chunks: DataFrame, blocks: DataFrame) -> DataFrame:
    """Blocks by chunk, without furniture; ``pos`` is the block's position in the chunk."""
    at = chunks.select("document_id", "chunk_id", F.posexplode("block_ids").alias("pos", "block_id"))
    return at.join(blocks.select("document_id", "block_id", "kind", "text", "tbl"), ["document_id", "block_id"]).filter("kind is null or kind <> 'furniture'")


def _place(emitter: int, first: Column, second: Column | None = None) -> Column:
    return F.struct(F.lit(emitter).alias("emitter"), first.cast("int").alias("a"), (second if second is not None else F.lit(0)).cast("int").alias("b")).alias("place")


def _cell(zipped: Column, category: str) -> Column:
    """The last filled cell of a category."""
    return F.try_element_at(F.filter(zipped, lambda z: (z["c"] == category) & (z["v"] != "")), F.lit(-1))["v"]


def spec_rows(placed: DataFrame) -> DataFrame:
    """Rows of tables with a name column."""
    t = placed.filter("kind = 'table' and size(tbl.rows) > 0").withColumn("cats", categories(F.col("tbl.header"))).filter(F.array_contains("cats", "name"))
    r = t.select(*_KEYS, "cats", F.posexplode("tbl.rows").alias("row", "vals"))
    name = strip(F.get("vals", F.array_position("cats", "name").cast("int") - 1))
    zipped = F.transform(F.arrays_zip("cats", "vals"), lambda z: F.struct(z["cats"].alias("c"), strip(z["vals"]).alias("v")))
    r = r.select(*_KEYS, "row", name.alias("raw_name"), zipped.alias("z")).filter("raw_name <> ''")
    cells = F.map_filter(F.map_from_arrays(F.array(*[F.lit(c) for c in HEADERS]), F.array(*[_cell(F.col("z"), c) for c in HEADERS])), lambda _, v: v.isNotNull())
    return r.select(*_KEYS, _place(0, F.col("row")), "raw_name", F.lit("spec_table").alias("origin"), cells.alias("cells"), F.lit(None).cast("string").alias("sentence"))


def _described(value: Column) -> Column:
    return F.when(value != "", F.create_map(F.lit("description"), value)).otherwise(no_cells())


def kv_rows(placed: DataFrame) -> DataFrame:
    """Rows of two-column tables whose header says nothing."""
    t = placed.filter("kind = 'table' and size(tbl.header) = 2 and size(tbl.rows) > 0").filter(F.size(F.array_compact(categories(F.col("tbl.header")))) == 0)
    r = t.select(*_KEYS, F.posexplode("tbl.rows").alias("row", "vals")).filter("size(vals) >= 2")
    name, value = strip(F.get("vals", F.lit(0))), F.coalesce(strip(F.get("vals", F.lit(1))), F.lit(""))
    return r.filter(name != "").select(*_KEYS, _place(1, F.col("row")), name.alias("raw_name"), F.lit("kv_pair").alias("origin"), _described(value).alias("cells"), F.lit(None).cast("string").alias("sentence"))


def form_fields(placed: DataFrame) -> DataFrame:
    """``label: value`` of form fields."""
    pattern = U + r"^([^:]{1,80}):\s*(.*)$"
    text = strip(F.col("text"))
    name, value = strip(F.regexp_extract(text, pattern, 1)), strip(F.regexp_extract(text, pattern, 2))
    return placed.filter("kind = 'form_field'").filter(name != "").select(
        *_KEYS, _place(0, F.lit(0)), name.alias("raw_name"), F.lit("form_field").alias("origin"), _described(value).alias("cells"), F.lit(None).cast("string").alias("sentence")
    )


def tail_items(tail: Column) -> Column:
    """``an IMSI and an MSISDN`` -> IMSI, MSISDN."""
    trimmed = F.transform(F.split(tail, U + r"\band\b"), lambda p: F.btrim(F.regexp_replace(strip(p), UI + r"^\s*(?:an?|the)\s+", ""), F.lit(" .,;")))
    return F.filter(trimmed, lambda p: p != "")


def obligation(name: Column) -> Column:
    """Pattern of ``[each] NAME SHALL|MUST have ...``."""
    return F.concat(F.lit(UI + r"\b(?:each\s+)?"), quoted(name), F.lit(r"\s+(?:SHALL|MUST)\s+have\s+([^.!?]*)"))


def prose_finds(placed: DataFrame, found: DataFrame) -> DataFrame:
    """Known entities, gazetteer terms, obligations and nominalisations of paragraphs and list items."""
    prose = placed.filter("kind in ('paragraph', 'list_item') and text <> ''").select(*_KEYS, "text")
    named = prose.join(found, ["document_id", "block_id"])
    entities = named.filter("source = 'entity'").select(*_KEYS, "text", _place(0, F.col("canonical_ord")), F.col("canonical").alias("raw_name"), F.lit(None).cast("string").alias("own"))
    first_term = named.filter("source = 'gazetteer'").groupBy(*_KEYS, "canonical", "canonical_ord").agg(F.min_by("term", "term_ord").alias("raw_name"), F.first("text").alias("text"))
    gazetteer = first_term.select(*_KEYS, "text", _place(1, F.col("canonical_ord")), "raw_name", F.lit(None).cast("string").alias("own"))
    said = prose.select(*_KEYS, "text", F.posexplode(sentences(F.col("text"))).alias("n", "s"))
    bound = said.filter(F.col("s").rlike(UI + r"(?:SHALL|MUST)\s+have\s")).join(found.filter("source = 'entity'").select("document_id", "block_id", "canonical"), ["document_id", "block_id"])
    tails = F.regexp_extract_all(F.col("s"), obligation(F.col("canonical")), F.lit(1))
    listed = bound.select(*_KEYS, "text", "n", "s", F.posexplode(F.flatten(F.transform(tails, tail_items))).alias("i", "raw_name"))
    obligations = listed.select(*_KEYS, "text", _place(2, F.col("n"), F.col("i")), "raw_name", F.col("s").alias("own"))
    word = F.regexp_extract("s", r"^([A-Z][a-z]+)\b", 1)
    nominal = said.filter(word.rlike("(?i)" + NOMINAL)).select(*_KEYS, "text", _place(2, F.col("n"), F.lit(1_000_000)), word.alias("raw_name"), F.col("s").alias("own"))
    everything = entities.unionByName(gazetteer).unionByName(obligations).unionByName(nominal)
    key = F.lower(strip(F.col("raw_name")))
    first = everything.filter(key != "").groupBy(*_KEYS, key.alias("key")).agg(F.min_by(F.struct("place", strip(F.col("raw_name")).alias("raw_name"), "text", "own"), "place").alias("c"))
    return first.select(
        *_KEYS, F.col("c.place").alias("place"), F.col("c.raw_name").alias("raw_name"), F.lit("prose_regex").alias("origin"), no_cells().alias("cells"),
        F.coalesce(merged_span(F.col("c.text"), F.col("c.raw_name")), F.col("c.own"), F.col("c.text")).alias("sentence"),
    )


def candidates(chunks: DataFrame, blocks: DataFrame, lexicon: Lexicon = Lexicon(), found: DataFrame | None = None) -> DataFrame:
    """All candidates of the chunks."""
    placed = placed_blocks(chunks, blocks)
    found = block_mentions(blocks, lexicon) if found is None else found
    return spec_rows(placed).unionByName(kv_rows(placed)).unionByName(form_fields(placed)).unionByName(prose_finds(placed, found)).select(*_OUT)


# -- queries ---------------------------------------------------------------------------------------------------------


def corpus(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, Lexicon]:
    """Blocks and chunks (first deliveries) of the given tables, and the lexicon with the given known entities."""
    blocks = delivered_once(table(spark, root, "blocks"), ["document_id", "block_id"])
    chunks = delivered_once(table(spark, root, "chunks"), ["document_id", "chunk_id"])
    return blocks, chunks, Lexicon.from_table(table(spark, root, "known_entities"))


def _named(rows: DataFrame) -> DataFrame:
    return rows.select("document_id", "chunk_id", "block_id", "raw_name", F.array_join(F.array_sort(F.transform(F.map_entries("cells"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ";").alias("cells"))


def q_spec_rows(spark: SparkSession, root: str) -> DataFrame:
    blocks, chunks, _ = corpus(spark, root)
    return _named(spec_rows(placed_blocks(chunks, blocks)))


def q_kv_rows(spark: SparkSession, root: str) -> DataFrame:
    blocks, chunks, _ = corpus(spark, root)
    return _named(kv_rows(placed_blocks(chunks, blocks)))


def q_form_fields(spark: SparkSession, root: str) -> DataFrame:
    blocks, chunks, _ = corpus(spark, root)
    return _named(form_fields(placed_blocks(chunks, blocks)))


def q_entity_mentions(spark: SparkSession, root: str) -> DataFrame:
    blocks, _, lexicon = corpus(spark, root)
    terms = F.broadcast(lexicon.mention_terms(spark).filter("source = 'entity'"))
    return mentions(blocks.select("document_id", "block_id", "text"), ["document_id", "block_id"], terms).select("document_id", "block_id", "canonical")


def q_prose(spark: SparkSession, root: str) -> DataFrame:
    blocks, chunks, lexicon = corpus(spark, root)
    return prose_finds(placed_blocks(chunks, blocks), block_mentions(blocks, lexicon)).select("document_id", "chunk_id", "block_id", "raw_name", "sentence")


def q_sentences(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "documents").select("doc_id", F.posexplode(sentences(F.col("text"))).alias("n", "sentence"))


def q_nominalisations(spark: SparkSession, root: str) -> DataFrame:
    word = F.regexp_extract("sentence", r"^([A-Z][a-z]+)\b", 1)
    return q_sentences(spark, root).select("doc_id", "n", word.alias("word")).filter(F.col("word").rlike(NOMINAL))


ONCE_SQL = """b as (select * from blocks where record_id in (select min(record_id) from blocks group by document_id, block_id)),
c as (select * from chunks where record_id in (select min(record_id) from chunks group by document_id, chunk_id)),
p as (select x.document_id, x.chunk_id, b.* exclude (document_id) from (select document_id, chunk_id, unnest(block_ids) as bid from c) x join b on b.document_id = x.document_id and b.block_id = x.bid where b.kind is null or b.kind <> 'furniture')"""
#: Every spelling of the given known entities; of equal ones the last entity's counts.
LEXICON_SQL = r"""lex as (select key, arg_max(name, known_id) as name, arg_max(layer, known_id) as layer, arg_max(entity_type, known_id) as ty
  from (select known_id, name, layer, entity_type, lower(trim(regexp_replace(unnest(list_concat([name], coalesce(aliases, []))), '\s+', ' ', 'g'))) as key from known_entities where trim(name) <> '') group by key)"""
def word_sql(text: str, term: str, plural: bool = True) -> str:
    """Whether ``term`` stands in ``text`` as a word."""
    found = rf"regexp_matches(replace(lower({text}), lower({term}), chr(1)), '(?:^|[^\pL\pN_])\x01{'s?' if plural else ''}(?:[^\pL\pN_]|$)')"
    return f"case when contains(lower({text}), lower({term})) then {found} else false end"


_S = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
_CAT = "case lower(trim(h)) " + " ".join(f"when '{a}' then '{c}'" for c, names in HEADERS.items() for a in names) + " end"
_CATS = f"list_transform(tbl.header, lambda h: {_CAT})"
_SENT = r"list_filter(list_transform(string_split(regexp_replace(text, '([.!?])[\s\x1c-\x1f\x85\p{Z}]+([A-Z])', '\1' || chr(1) || '\2', 'g'), chr(1)), lambda s: regexp_replace(s, '^[\s\x1c-\x1f\x85\p{Z}]+|[\s\x1c-\x1f\x85\p{Z}]+$', '', 'g')), lambda s: s <> '')"
_GAZETTEER = ", ".join("({}, '{}', {})".format(i, t.replace("'", "''"), j) for i, (n, more) in enumerate(Lexicon().gazetteer.items()) for j, t in enumerate((n, *more)))
_BLANKS = r"[\s\x1c-\x1f\x85\p{Z}]"
_PROSE = rf"""with {ONCE_SQL}, pr as (select document_id, chunk_id, block_id, list_position(c2.block_ids, block_id) as pos, text from p join c c2 using (document_id, chunk_id) where kind in ('paragraph', 'list_item') and text <> ''),
pt as (select *, string_split(regexp_replace(text, '([.!?])({_BLANKS}+)([A-Z])', '\1' || chr(1) || '\2' || chr(2) || '\3', 'g'), chr(1)) as parts from pr),
kn as (select name, row_number() over (order by min(known_id)) - 1 as o from known_entities where trim(name) <> '' group by name),
gz(o, t, n) as (values {_GAZETTEER}),
m0 as (select document_id, chunk_id, block_id, name, o from pt, kn where {word_sql("text", "name")}),
m1 as (select document_id, chunk_id, block_id, min_by(t, n) as t, o from pt, gz where {word_sql("text", "t")} group by document_id, chunk_id, block_id, o),
st as (select document_id, chunk_id, block_id, n, regexp_replace(replace(s, chr(2), ''), '^{_BLANKS}+|{_BLANKS}+$', '', 'g') as s from (select document_id, chunk_id, block_id, unnest(parts) as s, generate_subscripts(parts, 1) - 1 as n from pt)),
ob as (select st.*, unnest(regexp_extract_all(s, '(?i)\b(?:each\s+)?' || regexp_escape(name) || '\s+(?:SHALL|MUST)\s+have\s+([^.!?]*)', 1)) as tail, o from st join m0 using (document_id, chunk_id, block_id) where regexp_matches(s, '(?i)(?:SHALL|MUST)\s+have\s')),
oi as (select *, list_filter(list_transform(regexp_split_to_array(tail, '\band\b'), lambda x: trim(regexp_replace(trim(x), '(?i)^\s*(?:an?|the)\s+', ''), ' .,;')), lambda x: x <> '') as xs from ob),
ev as (
  select document_id, chunk_id, block_id, (0, o, 0) as place, name as raw_name, null as own from m0
  union all select document_id, chunk_id, block_id, (1, o, 0), t, null from m1
  union all select document_id, chunk_id, block_id, (2, n, i - 1), x, s from (select *, unnest(xs) as x, generate_subscripts(xs, 1) as i from oi)
  union all select document_id, chunk_id, block_id, (2, n, 1000000), regexp_extract(s, '^([A-Z][a-z]+)\b', 1), s from st where regexp_matches(regexp_extract(s, '^([A-Z][a-z]+)\b', 1), '(?i){NOMINAL}')),
fi as (select document_id, chunk_id, block_id, min_by(trim(raw_name), place) as raw_name, min_by(coalesce(own, chr(3)), place) as own from ev where trim(raw_name) <> '' group by document_id, chunk_id, block_id, lower(trim(raw_name))),
fs as (select fi.*, text, parts, list_filter(range(1, len(parts) + 1), lambda i: {word_sql("parts[i]", "raw_name")}) as hs from fi join pt using (document_id, chunk_id, block_id))
select document_id, chunk_id, block_id, raw_name, coalesce(case when len(hs) > 0 then regexp_replace(replace(array_to_string(parts[hs[1]:hs[-1]], ''), chr(2), ''), '^{_BLANKS}+|{_BLANKS}+$', '', 'g') end, nullif(own, chr(3)), text) as sentence from fs"""
QUERIES = {
    "spec_rows": q_spec_rows, "kv_rows": q_kv_rows, "form_fields": q_form_fields, "entity_mentions": q_entity_mentions, "prose_candidates": q_prose,
    "sentences": q_sentences, "nominalisations": q_nominalisations,
}
ORACLES = {
    "prose_candidates": _PROSE,
    "spec_rows": f"""with {ONCE_SQL}, t as (select *, {_CATS} as cats from p where kind = 'table' and len(tbl.rows) > 0),
r as (select document_id, chunk_id, block_id, cats, unnest(tbl.rows) as vals, unnest(range(len(tbl.rows))) as n from t where list_contains(cats, 'name')),
z as (select *, {_S.format("vals[list_position(cats, 'name')]")} as raw_name, list_filter(list_transform(range(1, len(cats) + 1), lambda i: struct_pack(c := cats[i], v := {_S.format("vals[i]")}, i := i)), lambda e: e.c is not null and e.v <> '') as cl from r)
select document_id, chunk_id, block_id, raw_name, array_to_string(list_sort(list_transform(list_filter(cl, lambda e: len(list_filter(cl, lambda f: f.c = e.c and f.i > e.i)) = 0), lambda e: e.c || '=' || e.v)), ';') as cells from z where raw_name <> ''""",
    "kv_rows": f"""with {ONCE_SQL}, r as (select document_id, chunk_id, block_id, unnest(tbl.rows) as vals from p where kind = 'table' and len(tbl.header) = 2 and len(tbl.rows) > 0 and len(list_filter({_CATS}, lambda c: c is not null)) = 0)
select document_id, chunk_id, block_id, trim(vals[1]) as raw_name, case when trim(vals[2]) <> '' then 'description=' || trim(vals[2]) else '' end as cells from r where len(vals) >= 2 and trim(vals[1]) <> ''""",
    "form_fields": f"""with {ONCE_SQL}, f as (select document_id, chunk_id, block_id, trim(regexp_extract({_S.format("text")}, '^([^:]{{1,80}}):\\s*(.*)$', 1)) as raw_name, trim(regexp_extract({_S.format("text")}, '^([^:]{{1,80}}):\\s*(.*)$', 2)) as v from p where kind = 'form_field')
select document_id, chunk_id, block_id, raw_name, case when v <> '' then 'description=' || v else '' end as cells from f where raw_name <> ''""",
    "entity_mentions": r"""with b as (select document_id, block_id, text as t from blocks where record_id in (select min(record_id) from blocks group by document_id, block_id)),
k as (select name from known_entities where trim(name) <> '')
select document_id, block_id, k.name as canonical from b, k where """ + word_sql("t", "k.name"),
    "sentences": f"select doc_id, unnest(range(len(x)))::int as n, unnest(x) as sentence from (select doc_id, {_SENT} as x from documents where text is not null)",
    "nominalisations": rf"with s as (select doc_id, unnest(range(len(x)))::int as n, unnest(x) as sentence from (select doc_id, {_SENT} as x from documents where text is not null)) select doc_id, n, regexp_extract(sentence, '^([A-Z][a-z]+)(?:[^\pL\pN_]|$)', 1) as word from s where regexp_matches(word, '{NOMINAL}')",
}
