"""Block cleaning: hyphens, blanks, furniture, table captions and subjects, page and document figures.

All functions take blocks (document_id, ord, block_id, page, kind, text, heading_level, tbl) of a whole corpus; what is
global in one document is grouped by document_id.  Null texts count as empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from specweave.functions.running import running_last
from specweave.functions.text import UI, U, strip
from specweave.session import checkpointed, table
from specweave.sources.lexicons import Lexicon

#: A page with fewer characters needs OCR; a PDF does if more than this share of its pages do.
MIN_PAGE_CHARS = 20
OCR_PAGE_RATIO = 0.5
#: Rows that are broadcast at most.
FEW = 2_000_000


def dehyphenate(text: Column) -> Column:
    return F.regexp_replace(text, U + r"(\w)-\n(\w)", "$1$2")


def collapse_blanks(text: Column) -> Column:
    lines = F.transform(F.split(text, r"\r\n|[\n\r]"), lambda line: strip(F.regexp_replace(line, r"[ \t]+", " ")))
    return strip(F.array_join(lines, "\n"))


def is_caption(text: Column) -> Column:
    return F.coalesce(text.rlike(UI + r"^\s*table\s+\d+\b"), F.lit(False))


def caption_subject(text: Column) -> Column:
    """A caption without ``Table N -``."""
    return strip(F.regexp_replace(text, UI + r"^\s*table\s+\d+\s*[-–—:]?\s*", ""))


def render_rows(header: Column, rows: Column) -> Column:
    """A table as lines of cells between bars, the header first."""
    return F.array_join(F.transform(F.concat(F.array(header), rows), lambda r: F.concat(F.lit("| "), F.array_join(r, " | "), F.lit(" |"))), "\n")


def delivered_once(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The first delivery of each key: rows that were delivered again are left out."""
    first = rows.groupBy(*keys).agg(F.min("record_id").alias("record_id"))
    return rows.join(first.select("record_id"), "record_id", "left_semi")


def delivered_once_in_place(rows: DataFrame, keys: list[str], few: int = FEW) -> DataFrame:
    """``delivered_once`` for wide rows: only ids are moved to find the rows to leave out.  These are broadcast up to ``few``
    of them; if there are more, the rows are joined with them as they are."""
    first = rows.groupBy(*keys).agg(F.min("record_id").alias("record_id"))
    again = checkpointed(rows.select("record_id").filter("record_id is not null").join(first.select("record_id"), "record_id", "left_anti"))
    return rows.filter("record_id is not null").join(few_broadcast(again, few), "record_id", "left_anti")


def few_broadcast(rows: DataFrame, few: int = FEW) -> DataFrame:
    """A written table, to be broadcast if it has ``few`` rows at most."""
    return F.broadcast(rows) if rows.count() <= few else rows


def repeated_edges(blocks: DataFrame) -> DataFrame:
    """(document_id, text) of texts that begin, or that end, two or more pages of a document."""
    b = blocks.select("document_id", "page", "ord", strip(F.col("text")).alias("text")).filter("text <> ''")
    ends = b.groupBy("document_id", "page").agg(F.min_by("text", "ord").alias("first"), F.max_by("text", "ord").alias("last"))
    sides = ends.select("document_id", "page", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("first").alias("text")), F.struct(F.lit(1).alias("side"), F.col("last").alias("text")))).alias("e"))
    return sides.groupBy("document_id", "e.side", "e.text").agg(F.count_distinct("page").alias("n")).filter("n >= 2").select("document_id", "text").distinct()


def mark_furniture(blocks: DataFrame, lexicon: Lexicon = Lexicon()) -> DataFrame:
    """Blocks with kind ``furniture`` where the text matches a pattern or is repeated at page edges."""
    bare = strip(F.coalesce("text", F.lit("")))
    again = repeated_edges(blocks).select("document_id", F.col("text").alias("_bare"), F.lit(True).alias("_again"))
    marked = blocks.withColumn("_bare", bare).join(again, ["document_id", "_bare"], "left")
    kind = F.when((F.col("kind") == "furniture") | F.col("_again") | lexicon.is_furniture(F.col("_bare")), F.lit("furniture")).otherwise(F.col("kind"))
    return marked.withColumn("kind", kind).select(*blocks.columns)


def table_subjects(blocks: DataFrame) -> DataFrame:
    """Table blocks with caption and subject: the caption next to the table (before, then after), else the heading above.

    Neighbours are found by position with equi-joins, the heading above by a running value, so long documents don't
    gather in one task.
    """
    b = blocks.select("document_id", "ord", "block_id", "kind", "text")
    dense = b.filter("kind is null or kind <> 'table'").select("document_id", "ord", "text")
    before = dense.select("document_id", (F.col("ord") + 1).alias("ord"), F.col("text").alias("before"))
    after = dense.select("document_id", (F.col("ord") - 1).alias("ord"), F.col("text").alias("after"))
    headed = running_last(b.withColumn("_heading", F.when(F.col("kind") == "heading", F.col("text"))), ["document_id"], "ord", {"heading": "_heading"}, before=True)
    t = headed.filter("kind = 'table'").join(before, ["document_id", "ord"], "left").join(after, ["document_id", "ord"], "left")
    caption = F.when(is_caption(F.col("before")), F.col("before")).when(is_caption(F.col("after")), F.col("after"))
    return t.select("document_id", "ord", "block_id", caption.alias("caption"), F.when(caption.isNotNull(), caption_subject(caption)).otherwise(F.col("heading")).alias("subject_hint"))


def with_table_subjects(blocks: DataFrame) -> DataFrame:
    """Blocks whose ``tbl`` carries caption and subject."""
    found = table_subjects(blocks).select("document_id", "block_id", F.col("caption").alias("_caption"), F.col("subject_hint").alias("_subject"))
    tbl = F.when(F.col("tbl").isNotNull(), F.col("tbl").withField("caption", F.col("_caption")).withField("subject_hint", F.col("_subject")))
    return blocks.join(found, ["document_id", "block_id"], "left").withColumn("tbl", tbl).select(*blocks.columns)


def page_flags(pages: DataFrame, min_chars: int = MIN_PAGE_CHARS) -> DataFrame:
    """document_id, page_number, ocr_required: pages with hardly any text."""
    return pages.select("document_id", "page_number", (F.length(strip(F.coalesce("text", F.lit("")))) < min_chars).alias("ocr_required"))


def document_ocr(flags: DataFrame, ratio: float = OCR_PAGE_RATIO) -> DataFrame:
    """document_id, pages, ocr_pages, text_coverage, needs_ocr."""
    share = F.col("ocr_pages") / F.col("pages")
    return (
        flags.groupBy("document_id").agg(F.count(F.lit(1)).alias("pages"), F.count_if("ocr_required").alias("ocr_pages"))
        .select("document_id", "pages", "ocr_pages", F.round(1 - share, 6).alias("text_coverage"), (share > ratio).alias("needs_ocr"))
    )


def pages_of(blocks: DataFrame, min_chars: int = MIN_PAGE_CHARS) -> DataFrame:
    """document_id, page_number, ocr_required of the pages that blocks stand on."""
    length = F.sum(F.char_length(strip(F.coalesce("text", F.lit("")))))
    return blocks.groupBy("document_id", F.col("page").alias("page_number")).agg((length < min_chars).alias("ocr_required"))


def titles(blocks: DataFrame) -> DataFrame:
    """document_id, title: the first heading of level 1."""
    return blocks.filter("heading_level = 1").groupBy("document_id").agg(F.min_by("text", "ord").alias("title"))


def dangling_page_blocks(pages: DataFrame, blocks: DataFrame) -> DataFrame:
    """document_id, block_id that a page lists and no block has."""
    return pages.select("document_id", F.explode("block_ids").alias("block_id")).join(blocks.select("block_id"), "block_id", "left_anti").select("document_id", "block_id")


# -- queries ---------------------------------------------------------------------------------------------------------


def _blocks(spark: SparkSession, root: str) -> DataFrame:
    return delivered_once(table(spark, root, "blocks"), ["document_id", "block_id"])


def q_clean_text(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "blocks").filter("kind = 'paragraph' and text is not null").select("record_id", collapse_blanks(dehyphenate(F.col("text"))).alias("clean"))


def q_furniture(spark: SparkSession, root: str) -> DataFrame:
    return mark_furniture(_blocks(spark, root)).filter("kind = 'furniture'").select("document_id", "block_id")


def q_table_subjects(spark: SparkSession, root: str) -> DataFrame:
    return table_subjects(_blocks(spark, root)).select("document_id", "block_id", "caption", "subject_hint")


def q_table_render(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "blocks").filter("tbl is not null").select("record_id", render_rows(F.col("tbl.header"), F.col("tbl.rows")).alias("rendered"))


def q_page_flags(spark: SparkSession, root: str) -> DataFrame:
    return document_ocr(page_flags(delivered_once(table(spark, root, "pages"), ["document_id", "page_number"])))


def q_titles(spark: SparkSession, root: str) -> DataFrame:
    return titles(_blocks(spark, root))


def q_dangling_page_blocks(spark: SparkSession, root: str) -> DataFrame:
    """What is missing if headings are taken away: every listed heading, so that the report has rows."""
    return dangling_page_blocks(table(spark, root, "pages"), _blocks(spark, root).filter("kind is null or kind <> 'heading'"))


_ONCE = "b as (select * from blocks where record_id in (select min(record_id) from blocks group by document_id, block_id))"
_FURNITURE_SQL = "(?i)" + "|".join(f"(?:{p})" for p in Lexicon().furniture)
_STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
QUERIES = {
    "clean_text": q_clean_text,
    "furniture_blocks": q_furniture,
    "table_subjects": q_table_subjects,
    "table_render": q_table_render,
    "page_ocr_flags": q_page_flags,
    "titles": q_titles,
    "dangling_page_blocks": q_dangling_page_blocks,
}
ORACLES = {
    "clean_text": r"""
select record_id, regexp_replace(array_to_string(list_transform(string_split(regexp_replace(text, '([\pL\pN_])-\n([\pL\pN_])', '\1\2', 'g'), chr(10)),
  lambda x: regexp_replace(regexp_replace(x, '[ \t]+', ' ', 'g'), '^\s+|\s+$', '', 'g')), chr(10)), '^\s+|\s+$', '', 'g') as clean
from blocks where kind = 'paragraph' and text is not null""",
    "furniture_blocks": f"""
with {_ONCE}, t as (select document_id, page, ord, {_STRIP.format("text")} as s from b),
ends as (select document_id, page, arg_min(s, ord) as f, arg_max(s, ord) as l from t where s <> '' group by 1, 2),
again as (select document_id, f as s from ends group by 1, 2 having count(distinct page) >= 2
  union select document_id, l from ends group by 1, 2 having count(distinct page) >= 2)
select document_id, block_id from b where kind = 'furniture' or regexp_matches(coalesce({_STRIP.format("text")}, ''), '{_FURNITURE_SQL}')
  or exists (select 1 from again a where a.document_id = b.document_id and a.s = {_STRIP.format("b.text")})""",
    "table_subjects": rf"""
with {_ONCE}, t as (select *, last_value(case when kind = 'heading' then text end ignore nulls) over (partition by document_id order by ord rows between unbounded preceding and 1 preceding) as heading from b),
n as (select t.document_id, t.block_id, p.text as before_, a.text as after_, heading from t
  left join b p on p.document_id = t.document_id and p.ord = t.ord - 1 and (p.kind is null or p.kind <> 'table')
  left join b a on a.document_id = t.document_id and a.ord = t.ord + 1 and (a.kind is null or a.kind <> 'table') where t.kind = 'table'),
c as (select *, case when regexp_matches(before_, '(?i)^\s*table\s+\d+\b') then before_ when regexp_matches(after_, '(?i)^\s*table\s+\d+\b') then after_ end as caption from n)
select document_id, block_id, caption, case when caption is not null then regexp_replace(caption, '(?i)^\s*table\s+\d+\s*[-–—:]?\s*', '') else heading end as subject_hint from c""",
    "table_render": "select record_id, array_to_string(list_transform(list_concat([tbl.header], tbl.rows), lambda r: '| ' || array_to_string(r, ' | ') || ' |'), chr(10)) as rendered from blocks where tbl is not null",
    "page_ocr_flags": f"""
with p as (select * from pages where record_id in (select min(record_id) from pages group by document_id, page_number)),
f as (select document_id, length({_STRIP.format("coalesce(text, '')")}) < {MIN_PAGE_CHARS} as need from p)
select document_id, count(*) as pages, count(*) filter (need) as ocr_pages, round(1 - (count(*) filter (need))::double / count(*), 6) as text_coverage,
  (count(*) filter (need))::double / count(*) > {OCR_PAGE_RATIO} as needs_ocr from f group by 1""",
    "titles": f"with {_ONCE} select document_id, arg_min(text, ord) as title from b where heading_level = 1 group by 1",
    "dangling_page_blocks": "select document_id, x as block_id from (select document_id, unnest(block_ids) as x from pages) where x is not null and x not in (select block_id from blocks where record_id in (select min(record_id) from blocks group by document_id, block_id) and block_id is not null and (kind is null or kind <> 'heading'))",
}
