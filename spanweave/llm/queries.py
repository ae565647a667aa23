"""The queries op1 to op13 and their SQL twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from spanweave.llm import bpe, contamination, extraction, language, licenses, negatives, pii, repeats, resampling, secrets, simhash, topk, toxicity
from spanweave.llm.common import crc_mod, table, words_of


SQL_WORDS = "regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod(F.col("doc_id"), 3) == 1
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~held_out)
    scored = docs.select("doc_id", held_out.alias("held_out"), toxicity.score(model, spark)("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = table(spark, sf_dir, "documents").select("doc_id", pii.pseudonyms(corpus_pipeline.KEY)("text").alias("r"))
    return told.select("doc_id", "r.n_found", "r.kinds", "r.text")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, decoded=True)
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


OP5_SQL = """
WITH v AS (SELECT row_number() OVER () AS row_no, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e::DOUBLE[], c.e::DOUBLE[])::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 5
"""


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod(F.col("doc_id"), 5) == 0
    infer = language.predict(language.train(docs, ~held_out), spark)
    told = docs.select("doc_id", held_out.alias("held_out"), infer("text").alias("r"))
    return told.select("doc_id", "held_out", "r.lang_pred", "r.score", "r.share", "r.lang_set")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secrets.find(docs, secrets.train(docs))
    return found.select(
        "doc_id",
        *(secrets.count_of("base", k).alias(f"n_{k}") for k in secrets.KINDS[:3]),
        F.sha2(secrets.listed("base").cast("binary"), 256).alias("base_sha256"),
        secrets.listed("spans").alias("spans"),
    )


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", licenses.scan(docs)("text").alias("r")).select("doc_id", "r.*")


def _op8_sql() -> str:
    """Blocks begin before, and hold, one of a template's rarest words, by how many documents hold them."""
    quoted = lambda ws: "[" + ", ".join(f"'{w.decode()}'" for w in ws) + "]"
    words = lambda t: words_of(t.encode())
    phrases = ", ".join(f"({quoted(words(p))}, '{label}')" for p, label in licenses.PHRASES.items())
    rows = [(k, list(dict.fromkeys(words(t))), label, len(words(t))) for k, (label, t) in enumerate(licenses.TEMPLATES)]
    templates = ", ".join(f"({k}, {quoted(v)}, '{label}', {n}, {licenses.needed(len(v))})" for k, v, label, n in rows)
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS row_no, doc_id, {SQL_WORDS.format("coalesce(text, '')")} AS w FROM documents),
o AS MATERIALIZED (SELECT row_no, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
p AS (SELECT row_no, i - 1 AS pos, label FROM (SELECT row_no, w, unnest(range(1, len(w) + 1)) AS i FROM d), (VALUES {phrases}) t(v, label) WHERE list_slice(w, i, i + len(v) - 1) = v),
b AS (SELECT row_no, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM p GROUP BY row_no),
t AS MATERIALIZED (SELECT * FROM (VALUES {templates}) t(k, v, label, n, need)),
f AS (SELECT word, count(DISTINCT row_no) AS often FROM o WHERE word IN (SELECT unnest(v) FROM t) GROUP BY word),
r AS MATERIALIZED (SELECT k, word FROM (SELECT k, word, size, need, row_number() OVER (PARTITION BY k ORDER BY coalesce(often, 0), word) AS nth
      FROM (SELECT k, unnest(v) AS word, len(v) AS size, need FROM t) LEFT JOIN f USING (word)) WHERE nth <= size - need + 1),
c AS (SELECT DISTINCT row_no, k, unnest(range(greatest(1, i - n + 1), i + 1)) AS s FROM o JOIN r USING (word) JOIN t USING (k)),
m AS (SELECT row_no, label, max(held / size::DOUBLE) AS share FROM (SELECT row_no, label, need, len(v) AS size, len(list_intersect(list_slice(w, s, s + n - 1), v)) AS held FROM c JOIN d USING (row_no) JOIN t USING (k)) WHERE held >= need GROUP BY row_no, label),
a AS (SELECT row_no, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT row_no, label FROM p UNION ALL SELECT row_no, label FROM m) GROUP BY row_no),
s AS (SELECT row_no, max(share) AS share FROM m GROUP BY row_no)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(share, 0.0) END::DOUBLE AS score
FROM d LEFT JOIN b USING (row_no) LEFT JOIN a USING (row_no) LEFT JOIN s USING (row_no)
"""


def op9_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    told = pages.select("page_id", "url", extraction.extractor(spark)("html").alias("text"))
    return told.withColumn("n_chars", F.length("text").cast("bigint"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Beside the columns of exact phrases: how many items the document comes near (exact ones among them), and their digest."""
    index = contamination.build_index(table(spark, sf_dir, "documents"))
    found = contamination.search(index, table(spark, sf_dir, "benchmark"), slop=contamination.SLOP)
    digest = lambda c: F.sha2(F.concat_ws(",", F.array_sort(F.transform(c, lambda i: i.cast("string")))).cast("binary"), 256)
    return found.select(
        F.col("key").alias("doc_id"),
        "n_words",
        contamination.covered().alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        digest("items").alias("items_sha256"),
        (F.size("runs") > 0).alias("contaminated"),
        F.size("near_items").cast("bigint").alias("n_near"),
        digest("near_items").alias("near_sha256"),
    )


OP10_SQL = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS row_no, doc_id, {SQL_WORDS.format("coalesce(text, '')")} AS w FROM documents),
b AS (SELECT DISTINCT item_id, {SQL_WORDS.format("coalesce(text, '')")} AS w FROM benchmark WHERE item_id IS NOT NULL),
k AS (SELECT item_id, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0),
q AS MATERIALIZED (SELECT DISTINCT item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS s
      FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM k)),
p AS (SELECT row_no, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS s
      FROM (SELECT row_no, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM k))),
h AS MATERIALIZED (SELECT row_no, i, n, item_id FROM p JOIN q USING (n, s)),
c AS (SELECT row_no, count(DISTINCT x) AS n_hit FROM (SELECT row_no, unnest(range(i, i + n)) AS x FROM h) GROUP BY row_no),
m AS (SELECT row_no, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
      FROM (SELECT DISTINCT row_no, item_id FROM h) GROUP BY row_no),
u AS MATERIALIZED (SELECT s, n, row_number() OVER () AS win FROM (SELECT DISTINCT s, n FROM q)),
v AS MATERIALIZED (SELECT win, n, unnest(string_split(s, ' ')) AS word, unnest(range(n)) AS j FROM u),
o AS MATERIALIZED (SELECT row_no, unnest(w) AS word, unnest(range(len(w))) AS x FROM d),
f AS MATERIALIZED (SELECT word, count(*) AS often FROM o WHERE word IN (SELECT word FROM v) GROUP BY word),
r AS MATERIALIZED (SELECT win, arg_min(word, (coalesce(often, 0), j)) AS word, arg_min(j, (coalesce(often, 0), j)) AS j FROM v LEFT JOIN f USING (word) GROUP BY win),
a AS MATERIALIZED (SELECT DISTINCT win, row_no, x - j + moved AS p0 FROM r JOIN o USING (word), (SELECT unnest(range(-2, 3)) AS moved)),
e AS MATERIALIZED (SELECT win, row_no, p0, j, n, word, p0 + j + slip AS x, slip FROM a JOIN v USING (win), (SELECT unnest(range(-2, 3)) AS slip)),
g AS MATERIALIZED (SELECT DISTINCT win, row_no FROM (SELECT e.win, e.row_no, p0 FROM e JOIN o ON o.row_no = e.row_no AND o.x = e.x AND o.word = e.word
      GROUP BY e.win, e.row_no, p0, n HAVING count(DISTINCT j) = n AND bool_or(slip = 0))),
t AS (SELECT row_no, count(*) AS n_near, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS near
      FROM (SELECT DISTINCT row_no, item_id FROM g JOIN u USING (win) JOIN q USING (s, n)) GROUP BY row_no)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0)::BIGINT AS n_near, sha256(coalesce(near, '')) AS near_sha256
FROM d LEFT JOIN c USING (row_no) LEFT JOIN m USING (row_no) LEFT JOIN t USING (row_no)
"""


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP11_SQL = f"""
WITH crc AS MATERIALIZED (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i))),
d AS MATERIALIZED (SELECT row_number() OVER () AS row_no, doc_id, {SQL_WORDS.format("coalesce(text, '')")} AS w FROM documents),
u AS (SELECT row_no, unnest(w) AS word FROM d),
v AS (SELECT unnest({SQL_WORDS.format("coalesce(text, '')")}) AS word FROM benchmark),
k AS MATERIALIZED (SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(octet_length(encode(word))), lambda j: ('0x' || substr(hex(encode(word)), 2 * j + 1, 2))::BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % {resampling.BUCKETS} AS bucket FROM (SELECT word FROM u UNION SELECT word FROM v), crc),
s AS (SELECT bucket, count(*) AS n FROM u JOIN k USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM v JOIN k USING (word) GROUP BY bucket),
g AS MATERIALIZED (SELECT bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (coalesce((SELECT sum(n) FROM s), 0) + {resampling.BUCKETS})::DOUBLE
      / ((s.n + 1)::DOUBLE * (coalesce((SELECT sum(n) FROM t), 0) + {resampling.BUCKETS})::DOUBLE)))::BIGINT AS gain FROM s LEFT JOIN t USING (bucket)),
m AS (SELECT row_no, floor(sum(gain) / count(*))::BIGINT AS weight FROM u JOIN k USING (word) JOIN g USING (bucket) GROUP BY row_no),
h AS (SELECT row_no, floor(-1000 * ln(-ln((('0x' || substr(sha256('{resampling.SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5)::DOUBLE / 4294967296)))::BIGINT AS drawn FROM d),
f AS (SELECT row_no, doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + drawn AS score FROM d LEFT JOIN m USING (row_no) JOIN h USING (row_no)),
r AS (SELECT *, row_number() OVER (PARTITION BY n_features >= {resampling.LEAST_WORDS} ORDER BY score DESC, doc_id) AS nth, count(*) FILTER (n_features >= {resampling.LEAST_WORDS}) OVER () AS n FROM f)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= {resampling.LEAST_WORDS} AND nth <= 10 * n // 100 THEN nth END AS rank FROM r
"""


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    return negatives.mine(vectors.withColumn("label", label), F.col("vec_id") % 100 == 0)


OP12_SQL = """
WITH v AS MATERIALIZED (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
      FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.e, c.e)::BIGINT AS score FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""


def op13_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


OP13_SQL = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
p AS (SELECT row_no, i, array_to_string(list_slice(w, i, i + {repeats.WINDOW} - 1), ' ') AS s
      FROM (SELECT row_no, w, unnest(range(1, len(w) - {repeats.WINDOW} + 2)) AS i FROM d WHERE len(w) >= {repeats.WINDOW})),
r AS (SELECT row_no, i FROM (SELECT row_no, i, count(*) OVER (PARTITION BY s) AS n FROM p) WHERE n > 1),
x AS MATERIALIZED (SELECT DISTINCT row_no, unnest(range(i, i + {repeats.WINDOW})) AS j FROM r),
o AS MATERIALIZED (SELECT row_no, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM d),
k AS (SELECT row_no, string_agg(word, ' ' ORDER BY j) AS kept, count(*) AS n_kept FROM o ANTI JOIN x USING (row_no, j) GROUP BY row_no)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n_kept, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (row_no)
"""


def queries() -> dict:
    named = (
        op1_toxicity, op2_simhash, op3_pii, op4_bpe, op5_topk, op6_language, op7_secrets, op8_licenses, op9_extraction, op10_decontamination, op11_resampling, op12_hard_negatives, op13_repeats,
    )
    return {f.__name__: f for f in named} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {"op5_topk": OP5_SQL, "op8_licenses": _op8_sql(), "op10_decontamination": OP10_SQL, "op11_resampling": OP11_SQL, "op12_hard_negatives": OP12_SQL, "op13_repeats": OP13_SQL}
