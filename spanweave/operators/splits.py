"""Development and test splits that share no document group and no similar texts.

Records of a group belong together, and so do records whose token sets are similar. Groups and token sets are nodes,
a record links its own two, a similar pair links two sets; a connected component goes to one side as a whole.

Components are packed to a stated share of each stratum. A component counts for the stratum that most of its records
have (of equal ones the greatest). Those of over 1 / LARGE of a stratum, fewer than LARGE, are taken from the largest down,
each to the development side while it fits; the rest, in the order of a hash, up to what is left. So a stratum's share is
off by less than 1 / LARGE, or by what its large components leave no way around.

Defined cases: a null group is no group; texts without tokens are similar to none; a null stratum is one of its own;
rows with equal ids are in one component if they share a group or a similar text; empty tables give empty splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanweave.functions.hashing import hash32
from spanweave.functions.plan import barrier, join_hot
from spanweave.functions.stored import materialize
from spanweave.functions.text import token_set
from spanweave.operators.components import roots
from spanweave.operators.coverage import token_jaccard_pairs

LARGE = 1000
#: Cells of the hash order within which small components are added up; 2 ** CELL_BITS a stratum.
CELL_BITS = 12


def components(records: DataFrame, similar: DataFrame) -> DataFrame:
    """records(record_id, grp, stratum, set_id) with component; similar(left_set, right_set) links sets."""
    # groups sort before sets, so a linked set is never a root if it has a group; either may be null
    group, own = F.concat(F.lit("g"), F.col("grp").cast("string")), F.concat(F.lit("s"), F.col("set_id"))
    nodes = records.withColumn("g", group).withColumn("s", own)
    held = nodes.filter("g IS NOT NULL AND s IS NOT NULL").select(F.col("s").alias("u"), F.col("g").alias("v"))
    near = similar.select(F.concat(F.lit("s"), F.greatest("left_set", "right_set")).alias("u"), F.concat(F.lit("s"), F.least("left_set", "right_set")).alias("v")).filter("u <> v")
    tree = roots(held.unionByName(near).distinct())
    alone = F.concat(F.lit("r"), F.coalesce(F.col("record_id").cast("string"), F.lit("")))
    placed = nodes.withColumn("node", F.coalesce("g", "s", alone)).drop("g", "s")
    found = join_hot(placed, tree.withColumnRenamed("u", "node"), "node", placed.groupBy("node").agg(F.count("*").alias("n")))
    return found.withColumn("component", F.coalesce("root", "node")).drop("node", "root")


def pack(members: DataFrame, share: float, seed: str) -> DataFrame:
    """(component, stratum, n, side) of members(component, stratum)."""
    counted = members.groupBy("component", "stratum").agg(F.count("*").alias("n"))
    most = F.max(F.struct("n", "stratum")).alias("m")
    whole = materialize(counted.groupBy("component").agg(most, F.sum("n").alias("n")).select("component", "m.stratum", "n", hash32(seed, F.col("component")).alias("h")), "packed")
    total = whole.groupBy(F.col("stratum").alias("of")).agg(F.sum("n").alias("total"))
    large = whole.join(F.broadcast(total), F.col("stratum").eqNullSafe(F.col("of"))).filter(F.col("n") * LARGE > F.col("total"))
    room, put = {r.of: int(r.total * share) for r in total.collect()}, []
    for r in large.orderBy(F.desc("n"), "h", "component").select("stratum", "component", "n").collect():  # fewer than LARGE a stratum
        side = "dev" if r.n <= room[r.stratum] else "test"
        room[r.stratum] -= r.n if side == "dev" else 0
        put.append((r.component, side))
    spark = members.sparkSession
    placed = spark.createDataFrame(put, "component string, large_side string")
    left = F.broadcast(spark.createDataFrame([(k, v) for k, v in room.items()], f"of {whole.schema['stratum'].dataType.simpleString()}, room bigint"))
    rest = whole.join(F.broadcast(placed), "component", "left").withColumn("cell", F.shiftright("h", 32 - CELL_BITS))
    small = rest.filter("large_side IS NULL")
    sums = small.groupBy("stratum", "cell").agg(F.sum("n").alias("in_cell"))
    before = sums.select("stratum", "cell", (F.sum("in_cell").over(Window.partitionBy("stratum").orderBy("cell")) - F.col("in_cell")).alias("before"))
    inside = F.sum("n").over(Window.partitionBy("stratum", "cell").orderBy("h", "component"))
    summed = small.withColumn("inside", inside).alias("a").join(before.alias("b"), F.col("a.stratum").eqNullSafe(F.col("b.stratum")) & (F.col("a.cell") == F.col("b.cell")))
    upto = summed.select("a.component", "a.stratum", "n", (F.col("inside") + F.col("before")).alias("upto")).join(left, F.col("stratum").eqNullSafe(F.col("of")))
    taken = upto.select("component", "stratum", "n", F.when(F.col("upto") <= F.col("room"), "dev").otherwise("test").alias("side"))
    return taken.unionByName(rest.filter("large_side IS NOT NULL").select("component", "stratum", "n", F.col("large_side").alias("side")))


def similar_sets(records: DataFrame, least: float = 0.9) -> DataFrame:
    """(left_set, right_set, jaccard) of records(text), left_set > right_set; stored, since split and check both read it."""
    texts = records.select("text")
    return materialize(token_jaccard_pairs(texts, texts, least, falling=True), "similar")


def leak_proof_split(records: DataFrame, similar: DataFrame, share: float = 0.5, seed: str = "split") -> DataFrame:
    """(record_id, grp, set_id, stratum, component, side) of records(record_id, grp, stratum, text); stored.

    No group, and no pair of similar(left_set, right_set), has records on both sides.
    """
    tokens = barrier(records.select("record_id", "grp", "stratum", token_set(F.col("text")).alias("tokens")))
    sets = tokens.select("record_id", "grp", "stratum", F.when(F.size("tokens") > 0, F.md5(F.array_join("tokens", " "))).alias("set_id"))
    members = materialize(components(sets, similar), "members")
    sides = materialize(pack(members, share, seed), "sides")
    out = join_hot(members, sides.select("component", "side"), "component", sides.select("component", "n"))
    return materialize(out.select("record_id", "grp", "set_id", "stratum", "component", "side"), "split")


def across(split: DataFrame, similar: DataFrame) -> DataFrame:
    """(kind, a, b): groups, and similar pairs of sets, that have records on both sides of split(grp, set_id, side)."""
    both = lambda key: split.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min("side").alias("low"), F.max("side").alias("high"))
    groups = both("grp").filter("low <> high").select(F.lit("group").alias("kind"), F.col("grp").cast("string").alias("a"), F.col("grp").cast("string").alias("b"))
    side = both("set_id")
    same = side.filter("low <> high").select(F.lit("similar").alias("kind"), F.col("set_id").alias("a"), F.col("set_id").alias("b"))
    a = side.select(F.col("set_id").alias("left_set"), F.col("low").alias("a_low"))
    b = side.select(F.col("set_id").alias("right_set"), F.col("low").alias("b_low"))
    near = similar.select("left_set", "right_set").join(a, "left_set").join(b, "right_set").filter("a_low <> b_low").select(F.lit("similar").alias("kind"), F.col("left_set").alias("a"), F.col("right_set").alias("b"))
    return groups.unionByName(same).unionByName(near)
