"""Connected components of a distributed edge table (union-find by stars)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def _fingerprint(edges: DataFrame):
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component): each node of ``edges`` (u, v: any order) with the
    smallest id it reaches.

    Alternates large-star and small-star steps (each a partial ``min`` per node
    and a join on it) until nothing changes: about log(longest path) rounds,
    two for stars. Each round is a table of ``scratch``, the one before it is
    removed; only a count and a checksum come to the driver. Empty edges give an
    empty table. The result is a table of ``scratch``.
    """
    u, v = F.col("u"), F.col("v")
    stars = scratch.keep(edges.filter(u != v)
                         .select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct())
    before = _fingerprint(stars)
    while before[0]:
        both = stars.unionByName(stars.select(v.alias("u"), u.alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.join(least, "u").filter(v > u).select(v.alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u")
                 .select(F.explode(F.array(F.struct(v.alias("u"), F.col("m").alias("v")),
                                           F.struct(u.alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").filter(u != v).distinct())
        last, stars = stars, scratch.keep(small)
        scratch.drop(last)
        after = _fingerprint(stars)
        if after == before:
            break
        before = after
    roots = stars.select(v.alias("node")).distinct()
    found = scratch.keep(stars.select(u.alias("node"), v.alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))))
    scratch.drop(stars)
    return found
