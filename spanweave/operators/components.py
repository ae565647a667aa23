"""Connected components of links by alternating large-star and small-star steps, each stored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanweave.functions.plan import join_hot
from spanweave.functions.stored import discard, materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One large-star (over all neighbours) or small-star (over smaller ones) step on (u, v), v < u."""
    if large:
        edges = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    found = materialize(edges.groupBy("u").agg(F.min("v").alias("low"), F.count("*").alias("n")), "low")
    low = found.select("u", F.least("u", "low").alias("m"), "n")
    told = join_hot(edges, low.select("u", "m"), "u", low.select("u", "n"))
    if large:
        out = told.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = told.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
    made = materialize(out.filter("u <> v").distinct(), "stars")
    discard(found)
    return made


def roots(edges: DataFrame) -> DataFrame:
    """(u, root) for every linked node that is not itself the smallest of its component; edges(u, v), v < u."""
    edges = materialize(edges, "links")
    mark = None
    while True:
        now = edges.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first()
        if now == mark or not now[0]:
            return edges.select("u", F.col("v").alias("root"))
        mark = now
        half = _star(edges, large=True)
        whole = _star(half, large=False)
        discard(edges, half)
        edges = whole
