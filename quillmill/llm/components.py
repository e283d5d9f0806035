"""Connected components over tables of links: alternating stars, each round settled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm.support import settle

#: Nodes with more than this share of all links are joined by broadcast: 2 * MOST_HEAVY of them at most.
MOST_HEAVY = 10_000
#: Nodes with fewer links than this are never heavy.
LIGHT = 1_000


def connected_components(links: DataFrame) -> DataFrame:
    """(a, b) links between ids -> (node, root): each linked node, smallest id reachable.

    Nulls and loops are ignored; an empty table gives an empty result. A round
    moves every node's larger neighbours to its smallest one and then its
    smaller ones too, so the number of rounds grows with the logarithm of the
    longest path. Links never leave the executors, and a node with a large share
    of them is joined where they lie.
    """
    a, b = F.col("a"), F.col("b")
    edges = settle(links.where(a.isNotNull() & b.isNotNull() & (a != b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct())
    state = _state(edges)
    while state[0]:
        edges = settle(_small_star(settle(_large_star(edges, state[0])), state[0]))
        now = _state(edges)
        if now == state:
            break
        state = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def _with_top(rows: DataFrame, least: DataFrame, links: int) -> DataFrame:
    """rows (a, b) and `top` of their node, from least (a, top, n).

    The nodes that have a hot share of the links are at most 2 * MOST_HEAVY, for
    the shares sum up to two; so these are broadcast, and no task gets a
    node's rows by their hash.
    """
    heavy = F.col("n") > F.lit(max(LIGHT, links // MOST_HEAVY))
    marked = rows.join(F.broadcast(least.where(heavy).select("a", F.col("top").alias("hot"))), "a", "left")
    light = marked.where("hot is null").join(least.where(~heavy), "a").select("a", "b", "top")
    return marked.where("hot is not null").select("a", "b", F.col("hot").alias("top")).union(light)


def _large_star(edges: DataFrame, links: int) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("top"), F.count("*").alias("n"))
    return _with_top(both.where("b > a"), least, links).select(F.col("b").alias("a"), F.col("top").alias("b"))


def _small_star(edges: DataFrame, links: int) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("top"), F.count("*").alias("n"))
    moved = _with_top(edges, least, links).where(F.col("b") > F.col("top")).select(F.col("b").alias("a"), F.col("top").alias("b"))
    return moved.union(least.select("a", F.col("top").alias("b"))).distinct()
