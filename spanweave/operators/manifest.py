"""Content manifests: a Merkle tree over cells of record ids, stored, and what has changed between two of them.

A record's leaf is (split, record_id, digest of its text). Leaves are stored by cell, the first digits of the id's
digest, so that a changed record stays in its cell. A cell's node digests the sums of its leaves' digests, taken as
whole numbers, so that they are added up before the shuffle and no cell is ever held; every node above digests the
nodes below it, of which there are sixteen at most, and a split's root is on top.
Drift walks two trees from the roots down through the nodes that differ, and then reads the leaves of the differing
cells only: leaves lie in sixteen folders, sorted by cell, so that folders and row groups of other cells are skipped.

Defined cases: a null text is its own content, different from an empty one; rows with equal ids in a split are leaves
of their own, and are compared by id as sums; null ids and splits count as values; empty tables
have no nodes.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Hexadecimal digits of a cell: 16 ** DIGITS cells a split.
DIGITS = 2
#: Digests are added up as so many whole numbers of fifteen hexadecimal digits.
LANES = 4


class Manifest(NamedTuple):
    """Where a manifest is stored: leaves(cell, split, record_id, sha, top) and nodes(split, level, node, sha, leaves)."""

    leaves: DataFrame
    nodes: DataFrame


def _digest(rows: Column) -> Column:
    return F.sha2(F.array_join(rows, "\n").cast("binary"), 256)


def _summed(sha: str) -> Column:
    """An aggregate that digests hexadecimal digests in any order, repeats included."""
    lanes = [F.sum(F.conv(F.substring(sha, 15 * k + 1, 15), 16, 10).cast("decimal(38,0)")).cast("string") for k in range(LANES)]
    return F.sha2(F.concat_ws(" ", *lanes).cast("binary"), 256)


def leaves_of(records: DataFrame, digits: int = DIGITS) -> DataFrame:
    """(cell, split, record_id, sha) of records(record_id, split, text)."""
    record_id = F.coalesce(F.col("record_id").cast("string"), F.lit("\0"))
    content = F.coalesce(F.sha2(F.col("text").cast("binary"), 256), F.lit("none"))
    return records.select(F.substring(F.md5(record_id), 1, digits).alias("cell"), F.coalesce("split", F.lit("\0")).alias("split"), record_id.alias("record_id"), content.alias("sha"))


def nodes_of(leaves: DataFrame, digits: int = DIGITS) -> DataFrame:
    """(split, level, node, sha, leaves): level 0 are the splits' roots, level `digits` the cells."""
    own = leaves.select("split", F.col("cell").alias("node"), F.sha2(F.concat_ws(" ", "record_id", "sha").cast("binary"), 256).alias("own"))
    level = own.groupBy("split", "node").agg(_summed("own").alias("sha"), F.count("*").alias("leaves"))
    levels = [level.withColumn("level", F.lit(digits))]
    for k in range(digits - 1, -1, -1):
        below = F.array_sort(F.collect_list(F.struct("node", "sha")))  # sixteen at most
        level = level.groupBy("split", F.substring("node", 1, k).alias("up")).agg(_digest(F.transform(below, lambda x: F.concat_ws(" ", x["node"], x["sha"]))).alias("sha"), F.sum("leaves").alias("leaves"))
        level = level.withColumnRenamed("up", "node")
        levels.append(level.withColumn("level", F.lit(k)))
    return reduce(DataFrame.unionByName, levels).select("split", "level", "node", "sha", "leaves")


def write(records: DataFrame, path: str, digits: int = DIGITS) -> Manifest:
    """Stores the leaves, a folder a cell, and the tree over them; records are read once."""
    spark = records.sparkSession
    rows = leaves_of(records, digits).withColumn("top", F.substring("cell", 1, 1))
    rows.repartition("cell").sortWithinPartitions("top", "cell").write.mode("overwrite").partitionBy("top").parquet(f"{path}/leaves")
    stored = _leaves(spark, path)
    nodes_of(stored, digits).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")  # a few rows for each cell
    return read(spark, path)


def _leaves(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("cell string, split string, record_id string, sha string, top string").parquet(f"{path}/leaves")


def read(spark: SparkSession, path: str) -> Manifest:
    return Manifest(_leaves(spark, path), spark.read.schema("split string, level int, node string, sha string, leaves bigint").parquet(f"{path}/nodes"))


def differing_cells(before: Manifest, now: Manifest) -> list[tuple[str, str]]:
    """(split, cell) of the cells that differ: a walk from the roots down, into differing nodes only.

    What comes to the driver is at most one row a cell; leaves are not read.
    """
    spark = now.nodes.sparkSession
    digits = max(m.nodes.agg(F.max("level")).first()[0] or 0 for m in (before, now))
    found: list[tuple[str, str]] | None = None
    for level in range(digits + 1):
        a, b = (m.nodes.filter(F.col("level") == level).select("split", "node", F.col("sha").alias(name)) for m, name in ((before, "old"), (now, "new")))
        both = a.join(b, ["split", "node"], "full").filter(~F.col("old").eqNullSafe(F.col("new")))
        if found is not None:
            if not found:
                return []
            parents = spark.createDataFrame(found, "split string, parent string")
            both = both.join(F.broadcast(parents), (both["split"] == parents["split"]) & (F.substring("node", 1, level - 1) == parents["parent"]), "left_semi")
        found = [(r.split, r.node) for r in both.select("split", "node").collect()]
    return sorted(found or [])


def changes(before: Manifest, now: Manifest) -> DataFrame:
    """(split, record_id, change): records that were added, changed or lost; only differing cells are read."""
    spark = now.nodes.sparkSession
    cells = differing_cells(before, now)
    wanted = spark.createDataFrame(cells, "split string, cell string")
    names = sorted({c for _, c in cells})
    tops = sorted({c[:1] for c in names})

    def digests(m: Manifest, name: str) -> DataFrame:
        rows = m.leaves.filter(F.col("top").isin(tops) & F.col("cell").isin(names) if names else F.lit(False)).join(F.broadcast(wanted), ["split", "cell"], "left_semi")
        return rows.groupBy("split", "record_id").agg(_summed("sha").alias(name))

    both = digests(before, "old").join(digests(now, "new"), ["split", "record_id"], "full")
    change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "lost").otherwise("changed")
    return both.filter(~F.col("old").eqNullSafe(F.col("new"))).select("split", "record_id", change.alias("change"))
