"""Connected components of a graph by large-star and small-star edge rewrites.

The nodes are numbered once, in the order of their ids, so that the rounds move pairs of longs and the smallest number is the
smallest id.  A round gives each node the smallest number of its neighbourhood (one shuffle per star, no join) and the edges
never become more, so repetitions needn't be removed.

A node's neighbours meet in one task only up to ``HOT_DEGREE``; the few nodes beyond it (at most ``MOST_HOT``, by the choice
of the bound) get their minimum from a pre-aggregated, broadcast list, and their edges stay where they are.

Defined results
    * null ends and self-links link nothing; repeated and reversed links change nothing; no edges give no components.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from specweave.session import Shelf

#: Neighbours of a node that may meet in one task, and how many nodes with more of them there can be.
HOT_DEGREE = 1_000_000
MOST_HOT = 10_000


def with_least(rows: DataFrame, n_rows: int, hot_degree: int = HOT_DEGREE) -> DataFrame:
    """``rows`` (src, dst) with ``m``, the smallest dst of the row's src."""
    degree = max(hot_degree, n_rows // MOST_HOT)
    least = F.min("dst").over(Window.partitionBy("src"))
    if n_rows <= degree:  # no node can be hot
        return rows.withColumn("m", least)
    hot = F.broadcast(rows.groupBy("src").agg(F.count(F.lit(1)).alias("n"), F.min("dst").alias("m")).filter(F.col("n") > degree).select("src", "m"))
    return rows.join(hot, "src", "left_anti").withColumn("m", least).unionByName(rows.join(hot, "src"))


def large_star(edges: DataFrame, n_edges: int, hot_degree: int = HOT_DEGREE) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node's neighbourhood.  Edges have src > dst."""
    both = edges.select(F.explode(F.array(F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")))).alias("e")).select("e.src", "e.dst")
    least = with_least(both, 2 * n_edges, hot_degree).filter("dst > src")
    return least.select(F.col("dst").alias("src"), F.least("src", "m").alias("dst"))


def small_star(edges: DataFrame, n_edges: int, hot_degree: int = HOT_DEGREE) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them.  Edges have src > dst."""
    least = with_least(edges, n_edges, hot_degree)
    pairs = F.when(F.col("dst") == F.col("m"), F.struct("src", F.col("m").alias("dst"))).otherwise(F.struct(F.col("dst").alias("src"), F.col("m").alias("dst")))
    return least.select(pairs.alias("e")).select("e.src", "e.dst")


def numbered_components(edges: DataFrame, shelf: Shelf, hot_degree: int = HOT_DEGREE) -> DataFrame:
    """node, component (numbers) of every node of ``edges`` (src, dst: numbers)."""
    down = edges.filter("src <> dst").select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
    now = shelf.keep(down)

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first())

    seen = mark(now)
    while True:
        after = shelf.keep(small_star(large_star(now, seen[0], hot_degree), seen[0], hot_degree))
        shelf.drop(now)
        now, found = after, mark(after)
        if found == seen:
            break
        seen = found
    ends = F.array(F.struct(F.col("src").alias("node"), F.col("dst").alias("component")), F.struct(F.col("dst").alias("node"), F.col("dst").alias("component")))
    return shelf.keep(now.select(F.explode(ends).alias("n")).select("n.node", "n.component").distinct())


def numbered(edges: DataFrame, shelf: Shelf) -> tuple[DataFrame, DataFrame]:
    """The edges with numbers for ids, and the dictionary (id, number); numbers are in the order of the ids.

    Both joins are of plain tables, so adaptive execution splits a hub's edges.
    """
    plain = shelf.keep(edges.select("src", "dst").filter("src is not null and dst is not null and src <> dst").distinct())
    ids = plain.select(F.explode(F.array("src", "dst")).alias("id")).distinct().orderBy("id")
    names = shelf.keep(ids.withColumn("number", F.monotonically_increasing_id()))
    side = lambda c: names.select(F.col("id").alias(c), F.col("number").alias(f"{c}_number"))
    out = plain.join(side("src"), "src").select("dst", "src_number").join(side("dst"), "dst")
    return out.select(F.col("src_number").alias("src"), F.col("dst_number").alias("dst")), names


def connected_components(edges: DataFrame, hot_degree: int = HOT_DEGREE) -> DataFrame:
    """node, component (the smallest id of the component), for every node of ``edges`` (src, dst), of any orderable type."""
    shelf = Shelf(edges.sparkSession)
    links, names = numbered(edges, shelf)
    found = numbered_components(links, shelf, hot_degree)
    named = found.join(names, found.node == names.number).select(F.col("id").alias("node"), F.col("component").alias("_c"))
    return named.join(names, F.col("_c") == names.number).select("node", F.col("id").alias("component"))
