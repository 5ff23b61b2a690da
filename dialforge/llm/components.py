"""Connected components of a link table by alternating large and small stars.

Each round is two small plans of a grouped minimum, a join and a distinct, each
written before the next; no link or component is collected. Rounds end as soon as
the links are stars, which a count over the nodes tells. A node with very many
links is one key of a skewed equi-join, which adaptive execution splits; minima
are combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialforge.llm.store import written


def _two(x, y, z, w) -> Column:
    """The pairs ``x, y`` and ``z, w`` as rows of an array."""
    return F.array(F.struct(x.alias("x"), y.alias("y")), F.struct(z.alias("x"), w.alias("y")))


def _with_minima(pairs: DataFrame) -> DataFrame:
    """``x, y`` -> ``x, y, m``: the least of x and all its neighbours y."""
    least = pairs.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
    return pairs.join(least, "x")


def _large_star(edges: DataFrame) -> DataFrame:
    u, v = F.col("u"), F.col("v")
    return _with_minima(edges.select(F.inline(_two(u, v, v, u)))).where("y > x").select(
        F.col("y").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    x, y, m = F.col("x"), F.col("y"), F.col("m")
    both = _with_minima(edges.select(F.col("u").alias("x"), F.col("v").alias("y"))).select(F.inline(_two(y, m, x, m)))
    return both.select(F.col("x").alias("u"), F.col("y").alias("v")).where("u > v").distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node is either the larger end of one link or the smaller end of any number."""
    ends = edges.select(F.inline(_two(F.col("u"), F.lit(1), F.col("v"), F.lit(0))))
    nodes = ends.groupBy("x").agg(F.sum("y").alias("above"), F.count("*").alias("links"))
    return nodes.where("above > 0 and links > 1").agg(F.count("*")).first()[0] == 0


def connected(links: DataFrame) -> DataFrame:
    """``u, v`` (any order, repeats allowed) -> ``node, component`` for every
    node with a link to another; the component is its smallest node."""
    edges = written(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                    .where("u > v").distinct(), "links")
    while not _are_stars(edges):
        edges = written(_small_star(written(_large_star(edges), "large-stars")), "stars")
    centres = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(centres)
