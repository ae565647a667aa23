"""Shaping plans that Catalyst would otherwise unfold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Bytes of files a core up to which a table is small: Spark's least split. It cuts larger ones into about a task for each core by itself.
SMALL = 4 << 20


def _file_bytes(df: DataFrame) -> int:
    spark = df.sparkSession.sparkContext
    paths = [spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(f)) for f in df.inputFiles()]
    return sum(p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).getLen() for p in paths)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """df dealt by keys where small files give fewer tasks than there are cores; large inputs stay as they are.

    A Parquet row group is one task at most, so a small table in one file would keep one core busy. This is
    layout only: rows and results are the same either way. What is dealt is on disk once more, so the files may
    have SMALL bytes a core at most, however few tasks they give. It asks for the number of partitions when the
    plan is made (df.rdd lists the files, nothing is read), so it belongs to scans, not to computed frames.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    few = df.rdd.getNumPartitions() < cores and _file_bytes(df) <= cores * SMALL
    return df.repartition(cores, *keys) if few else df


def deal(df: DataFrame, *keys: str) -> DataFrame:
    """df dealt by keys over spark.sql.shuffle.partitions tasks, which adaptive execution does not merge.

    For small rows with much work behind them: merged by bytes, they would end up in a few tasks.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def join_hot(left: DataFrame, right: DataFrame, key: str, weights: DataFrame, share: int = 1000) -> DataFrame:
    """Left join where one key may hold much of the left side; right has each key once.

    weights(key, n) counts left rows by key. Keys with over 1/share of all rows are fewer than
    share, so their right rows are broadcast with a proven bound; the rest are shuffled. Null keys
    match nothing.
    """
    total = F.broadcast(weights.agg(F.sum("n").alias("total")))  # one row
    over = weights.join(total, F.col("n") * share > F.col("total")).filter(F.col(key).isNotNull())
    hot = [r[0] for r in over.select(key).collect()]  # fewer than share
    if not hot:
        return left.join(right, key, "left")
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    return (
        left.filter(is_hot)
        .join(F.broadcast(right.filter(F.col(key).isin(hot))), key, "left")
        .unionByName(left.filter(~is_hot).join(right.filter(~F.col(key).isin(hot)), key, "left"))
    )


def barrier(df: DataFrame) -> DataFrame:
    """The same rows behind a generator of one row each.

    Projections are not merged and filters not pushed through it, so an expression below that is used
    many times above is computed once. Without it a chain of such steps doubles with every step.
    """
    row = F.struct(*[F.col(f"`{c}`").alias(c) for c in df.columns])
    return df.select(F.inline(F.array(row)))
