"""Splitting oversized items at natural boundaries.

One bounded-quantifier pattern consumes an item piece by piece: its alternatives are ordered by boundary strength
(paragraph, sentence, line, word) and each takes up to the limit; the last one takes plain characters.  Array functions
turn the pieces' lengths into offsets and prepend the overlap by looking back from them.

Defined results
    * sizes are code points, nothing is trimmed; null and empty texts are not oversized and give no pieces;
    * every piece, overlap included, has at most ``limit`` characters; without their overlaps the pieces make up the text;
    * chunk ids are hashes of kind, record_id and position, so repeated rows get ids of their own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from specweave.functions.keys import content_id
from specweave.session import table

#: Characters an item may have; and characters repeated from the piece before.
LIMIT = 4000
OVERLAP = 200
#: Pieces whose lengths are summed up in one step.
BLOCK = 256

#: Item kinds, their table and text column.
ITEMS = (("block", "blocks", "text"), ("page", "pages", "text"), ("chunk", "chunks", "source_text"))
#: What a piece ends with, strongest first.
BOUNDARIES = (r"(?:(?<=\n\n)|\z)", r"(?<=[.!?。][\s])", r"(?<=\n)", r"(?<=\s)")


def piece_pattern(size: int) -> str:
    """Pieces of up to ``size`` characters; a boundary counts if it leaves at least half of that."""
    least = max(1, size // 2)
    tail = r"(?:.{1,%d}\z)" % size
    strong = [r".{%d,%d}%s" % (least, size, b) for b in BOUNDARIES]
    return "(?s)" + "|".join([tail, *strong, r".{1,%d}" % size])


def items(tables: dict[str, DataFrame]) -> DataFrame:
    """item_kind, record_id, text of every block, page and chunk."""
    parts = [tables[name].select(F.lit(kind).alias("item_kind"), "record_id", F.col(column).alias("text")) for kind, name, column in ITEMS]
    return reduce(DataFrame.unionByName, parts)


def item_pattern(limit: int, overlap: int) -> str:
    """An item within the limit as a whole, or else its pieces without their overlaps."""
    return r"(?s)\A.{1,%d}\z|" % limit + piece_pattern(limit - overlap).removeprefix("(?s)")


def cut(rows: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """item_kind, record_id, cores: the pieces, still without overlap, of the items that don't fit into the limit."""
    if not 0 <= overlap < limit:
        raise ValueError("the overlap must be less than the limit")
    cores = F.regexp_extract_all("text", F.lit(item_pattern(limit, overlap)), F.lit(0))
    return rows.select("item_kind", "record_id", cores.alias("cores")).filter(F.size("cores") > 1)


def split(rows: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """item_kind, record_id, chunk_id, seq, start, text of the pieces of every oversized item of ``rows``; ``start`` is the
    0-based offset of the piece with its overlap.

    Offsets are sums over blocks of pieces and an overlap is taken from the few pieces before, so a huge text costs in
    proportion to its length.
    """
    least = max(1, (limit - overlap) // 2)
    back = -(-overlap // least)  # so many pieces hold the overlap
    lengths = cut(rows, limit, overlap).withColumn("lengths", F.transform("cores", lambda c: F.char_length(c)))
    total = lambda part: F.aggregate(part, F.lit(0), lambda a, x: a + x)
    n_blocks = F.floor((F.size("lengths") - 1) / F.lit(BLOCK)).cast("int")
    sums = lengths.withColumn("sums", F.transform(F.sequence(F.lit(0), n_blocks), lambda b: total(F.slice("lengths", b * BLOCK + 1, F.lit(BLOCK)))))

    def piece(core: Column, i: Column) -> Column:
        block = F.floor(i / F.lit(BLOCK)).cast("int")
        at = total(F.slice("sums", F.lit(1), block)) + total(F.slice("lengths", block * BLOCK + 1, i % F.lit(BLOCK)))
        first = F.greatest(i - back, F.lit(0))
        before = F.right(F.array_join(F.slice("cores", first + 1, i - first), ""), F.lit(overlap)) if overlap else F.lit("")
        return F.struct((i + 1).alias("seq"), (at - F.char_length(before)).alias("start"), F.concat(before, core).alias("text"))

    pieces = sums.select("item_kind", "record_id", F.explode(F.transform("cores", piece)).alias("p"))
    return pieces.select(
        "item_kind", "record_id", content_id("chunk-", F.col("item_kind"), F.col("record_id"), F.col("p.seq")).alias("chunk_id"), F.col("p.seq").alias("seq"), F.col("p.start").alias("start"), F.col("p.text").alias("text")
    )


def _tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {name: table(spark, root, name) for _, name, _ in ITEMS}


def p6_found(spark: SparkSession, root: str) -> DataFrame:
    """The oversized items: those that the splitter cuts."""
    return cut(items(_tables(spark, root))).select("item_kind", "record_id")


def p6_pieces(spark: SparkSession, root: str) -> DataFrame:
    return split(items(_tables(spark, root)))


SQL_FOUND = " union all ".join(f"select '{kind}' as item_kind, record_id from {name} where length({column}) > {LIMIT}" for kind, name, column in ITEMS)
