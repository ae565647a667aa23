"""Importance resampling of documents towards a target distribution, with DuckDB inside of each partition.

In every partition DuckDB unnests the words of the texts, windows them into n-grams of one to n words and puts the
distinct ones into buckets by a registered zlib CRC function; the counts by bucket go to Parquet in the shared folder,
a file for each partition, and Spark merges them. Documents then get the mean gain of their n-grams, again in DuckDB,
and a Gumbel draw from a digest of their id; the draws of a stated share of them come from a histogram of the scores.

The gain of a bucket is the logarithm of its smoothed share in the target over that in the documents, in whole
thousandths. What goes to the driver is one row a bucket, and the histogram of scores: a score is a whole number of
thousandths of at most some tens in either direction, whatever the corpus, so that is bounded too.

Defined cases: null text has no n-grams, which is a weight of 0; a null id counts as an empty one and is the last in
ties; rows with equal ids are rows of their own; extra columns are ignored; empty tables give empty results, and
an empty target gives every bucket its smoothed gain.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanweave.llm.common import materialize, release

BUCKETS = 10_000
SEED = 2024
LEAST_WORDS = 20
#: Characters of text that DuckDB works on at once; a longer text is cut between words.
STEP_CHARS = 4_000_000
COUNTS = "bucket int, n bigint"
_GAP = re.compile(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _ngrams(n: int) -> str:
    """SQL of (doc, feature, size): every run of one to n words of the registered texts(doc, skip, text) that ends behind the first skip words."""
    grams = ["SELECT doc, word AS feature, 1 AS size FROM words WHERE place >= skip"]
    for k in range(2, n + 1):
        run = " || ' ' || ".join(["word", *(f"lead(word, {j}) OVER w" for j in range(1, k))])
        windows = f"SELECT doc, {run} AS feature, place, skip FROM words WINDOW w AS (PARTITION BY doc, piece ORDER BY place)"
        grams.append(f"SELECT doc, feature, {k} FROM ({windows}) WHERE feature IS NOT NULL AND place + {k - 1} >= skip")
    return f"""
        WITH lists AS (SELECT doc, piece, skip, {_WORDS} AS list FROM texts),
             words AS (SELECT doc, piece, skip, unnest(list) AS word, unnest(range(len(list))) AS place FROM lists)
        {" UNION ALL ".join(grams)}"""


def _crc(features: pa.Array | pa.ChunkedArray) -> pa.Array:
    return pa.array(map(zlib.crc32, features.cast(pa.binary()).to_pylist()), pa.uint32())


def _connected() -> duckdb.DuckDBPyConnection:
    con = duckdb.connect(config={"threads": 1, "memory_limit": "600MB", "temp_directory": "", "autoinstall_known_extensions": False})
    con.create_function("crc32", _crc, ["VARCHAR"], "UINTEGER", type="arrow")
    return con


def _pieces(text: str | None, n: int) -> Iterator[tuple[int, str | None]]:
    """(words to skip, text) of about STEP_CHARS, cut between words; each begins with the last n - 1 words of the one before."""
    start, size = 0, len(text or "")
    while size - start > STEP_CHARS and (gap := _GAP.search(text, start + STEP_CHARS)):
        yield _with_last(text, start, gap.start(), n)
        start = gap.start()
    yield _with_last(text, start, size, n) if start else (0, text)


def _with_last(text: str, start: int, end: int, n: int) -> tuple[int, str]:
    """The stretch with the n - 1 words before it, as far as there are any."""
    begin, words = start, 0
    while begin and words < n - 1:
        while begin and _GAP.match(text[begin - 1]):
            begin -= 1
        words += begin > 0
        while begin and not _GAP.match(text[begin - 1]):
            begin -= 1
    return words, text[begin:end]


def _steps(con: duckdb.DuckDBPyConnection, texts: pa.Array, n: int) -> Iterator[None]:
    """Registers texts(doc, piece, skip, text) in steps of about STEP_CHARS; doc is the place in the array, and may go on in the next step."""
    held: list[tuple] = []
    size = 0
    for k in range(len(texts) + 1):
        for skip, text in _pieces(texts[k].as_py(), n) if k < len(texts) else ():
            held.append((k, len(held), skip, text))
            size += len(text or "")
            if size >= STEP_CHARS:
                _register(con, held)
                yield
                held, size = [], 0
    if held:
        _register(con, held)
        yield


def _register(con: duckdb.DuckDBPyConnection, held: list[tuple]) -> None:
    columns = zip(*held, strict=True)
    kinds = {"doc": pa.int64(), "piece": pa.int64(), "skip": pa.int64(), "text": pa.string()}
    con.register("texts", pa.table({name: pa.array(c, t) for (name, t), c in zip(kinds.items(), columns, strict=True)}))


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS, n: int = 1) -> DataFrame:
    """Stored counts (bucket, n) of the n-grams of docs(text), each partition's own."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        con = _connected()
        con.execute("CREATE TABLE held (bucket INTEGER, n BIGINT)")
        for batch in batches:
            for _ in _steps(con, batch.column(0), n):
                con.execute(f"""
                    INSERT INTO held SELECT (crc32(feature) % {buckets})::INTEGER AS bucket, sum(n)::BIGINT
                    FROM (SELECT feature, count(*) AS n FROM ({_ngrams(n)}) GROUP BY feature) GROUP BY bucket""")
        yield from con.sql("SELECT bucket, sum(n)::BIGINT AS n FROM held GROUP BY bucket ORDER BY bucket").to_arrow_table().to_batches()
        con.close()
        release()

    return materialize(docs.select("text").mapInArrow(count, COUNTS), "buckets")


def gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, n: int = 1) -> DataFrame:
    """(bucket, gain): thousandths of the log of each bucket's smoothed share in target over that in docs, rounded down."""
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    for name, side in (("t", target), ("s", docs)):
        told = bucket_counts(side, buckets, n).groupBy("bucket").agg(F.sum("n").alias(name))
        every = every.join(told, "bucket", "left").fillna(0, [name])
    every = materialize(every, "shares")
    t_all, s_all = every.agg(F.sum("t"), F.sum("s")).first()
    t, s = F.col("t").cast("double") + 1, F.col("s").cast("double") + 1
    return every.select("bucket", F.floor(1000 * F.log(t * float(s_all + buckets) / (s * float(t_all + buckets)))).alias("gain"))


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """Thousandths of a Gumbel draw from a digest of the id, rounded down."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.log(-F.log(u)))


def weights(docs: DataFrame, gain: DataFrame, n: int = 1) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of docs(doc_id, text): the floored mean of the gains of a document's n-grams."""
    table = gain.orderBy("bucket").toArrow()  # one row a bucket
    sent = docs.sparkSession.sparkContext.broadcast(table)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        con = _connected()
        con.register("gains", sent.value)
        buckets = sent.value.num_rows
        for batch in batches:
            sums = np.zeros((3, batch.num_rows), np.int64)  # words, features, total gain
            for _ in _steps(con, batch.column(1), n):
                doc, *told = con.execute(f"""
                    WITH features AS MATERIALIZED ({_ngrams(n)}),
                         gained AS (SELECT feature, gain FROM (SELECT DISTINCT feature FROM features) JOIN gains ON bucket = (crc32(feature) % {buckets})::INTEGER)
                    SELECT doc, count(*) FILTER (size = 1)::BIGINT, count(*)::BIGINT, sum(gain)::BIGINT FROM features JOIN gained USING (feature) GROUP BY doc""").fetchnumpy().values()
                for total, x in zip(sums, told, strict=True):
                    total[doc] += np.asarray(x, np.int64)
            columns = [batch.column(0), *map(pa.array, (sums[0], sums[1], sums[2] // np.maximum(sums[1], 1)))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "weight"])
        con.close()
        release()

    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    return rows.mapInArrow(weigh, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, buckets: int = BUCKETS, n: int = 1, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of docs; rank numbers the rows that are drawn, best first, and is null in others.

    Of the documents with at least so many words, so many hundredths are drawn, rounded down.
    """
    scored = weights(docs, gains(docs, target, buckets, n), n).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    scored = materialize(scored, "scored")
    eligible = F.col("n_words") >= least_words
    told = scored.filter(eligible).groupBy("score").count().orderBy(F.desc("score")).collect()  # whole thousandths: bounded, see above
    wanted, above, offsets = percent * sum(r["count"] for r in told) // 100, 0, []
    for r in told:
        if above >= wanted:
            break
        offsets.append((r.score, above))
        above += r["count"]
    spark = docs.sparkSession
    columns = ("doc_id", "n_features", "weight", "score")
    first = offsets[-1][0] if offsets else None
    in_reach = eligible & (F.col("score") >= first) if offsets else F.lit(False)
    sent = F.broadcast(spark.createDataFrame(offsets, "score bigint, above bigint"))
    order = Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), "n_features", "weight")
    ranked = scored.filter(in_reach).join(sent, "score").withColumn("rank", F.col("above") + F.row_number().over(order))
    drawn = ranked.select(*columns, F.when(F.col("rank") <= wanted, F.col("rank")).cast("bigint").alias("rank"))
    return drawn.unionByName(scored.filter(~in_reach).select(*columns, F.lit(None).cast("bigint").alias("rank")))
