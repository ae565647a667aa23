"""Reports over the annotation store: coverage, composition, splits, agreement, leakage, drift, gates.

records: (record_id, text, source, split, ...); spans: (record_id, start, end, type, polarity).
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanweave.functions.hashing import hash32
from spanweave.functions.plan import barrier
from spanweave.functions.stored import materialize
from spanweave.functions.text import clean, token_set
from spanweave.operators.evaluate import bucket_of, ratio
from spanweave.schema import MAX_CHARS

# Length classes, reports' limits, least support of the development split, and the inventory of
# negation cues, which cue_distance and cue_counts match.
LENGTHS = (("XS", 3), ("S", 10), ("M", 25), ("L", 60), ("XL", 120), ("XXL", None))
SOURCE_TARGETS = {"invoice": 0.35, "manifest": 0.25, "email": 0.20, "webhook": 0.10, "ocr": 0.10}
LEAST_SUPPORT = {"PERSON": 200, "ORG": 250, "ADDRESS": 200, "COMMODITY(POS)": 300, "COMMODITY(NEG)": 150}
CUES = (
    "no", "not", "none", "never", "does not contain", "do not contain", "cannot contain", "without", "lacks", "lacking",
    "excludes", "excluding", "free of", "absent of", "missing", "omitted", "unauthorized", "forbidden", "prohibited",
)

#: Hash buckets of token_order, and rows of a token from which on a similarity join deals them over a grid.
ORDER_BUCKETS = 1 << 16
CELL_ROWS = 20_000
#: 64-bit words of parity bits, to begin with and of the sets that are left: they tell sets of up to some 450, and 9,000,
#: tokens apart.
PARITY_WORDS, FINE_WORDS = 2, 32
#: Most candidate pairs whose sets' ids are broadcast; more are joined by a shuffle.
KEYS_SENT = 500_000


def length_class(n: Column) -> Column:
    out = F.when(n <= LENGTHS[0][1], LENGTHS[0][0])
    for name, top in LENGTHS[1:-1]:
        out = out.when(n <= top, name)
    return out.otherwise(LENGTHS[-1][0])


def split_coverage(records: DataFrame, spans: DataFrame) -> DataFrame:
    """Records, spans by type and polarity, and records without spans, by split."""
    return records.sparkSession.sql(
        """
        SELECT r.split, count(DISTINCT r.record_id) AS record_count,
               count(*) FILTER (WHERE e.type = 'PERSON') AS person_spans,
               count(*) FILTER (WHERE e.type = 'ORG') AS org_spans,
               count(*) FILTER (WHERE e.type = 'ADDRESS') AS address_spans,
               count(*) FILTER (WHERE e.type = 'COMMODITY' AND e.polarity = 'POS') AS commodity_pos_spans,
               count(*) FILTER (WHERE e.type = 'COMMODITY' AND e.polarity = 'NEG') AS commodity_neg_spans,
               count(DISTINCT r.record_id) FILTER (WHERE e.record_id IS NULL) AS zero_entity_records
        FROM {records} r LEFT JOIN {spans} e ON e.record_id = r.record_id GROUP BY r.split
        """,
        records=records.select("record_id", "split"),
        spans=spans.select("record_id", "type", "polarity"),
    )


def length_buckets(spans: DataFrame) -> DataFrame:
    return spans.groupBy("type", length_class(F.col("end") - F.col("start")).alias("bucket")).agg(F.count("*").alias("n"))


def _per_record(records: DataFrame, spans: DataFrame) -> DataFrame:
    """(record_id, n, pos, neg): one aggregate of the spans, left-joined."""
    sums = spans.groupBy("record_id").agg(
        F.count("*").alias("n"),
        F.count_if((F.col("type") == "COMMODITY") & (F.col("polarity") == "POS")).alias("pos"),
        F.count_if(F.col("polarity") == "NEG").alias("neg"),
    )
    return records.select("record_id").join(sums, "record_id", "left").fillna(0)


def entities_per_record(records: DataFrame, spans: DataFrame) -> DataFrame:
    """(entities, records, share): 0 to 4, and 5+."""
    counted = _per_record(records, spans).groupBy(F.when(F.col("n") >= 5, "5+").otherwise(F.col("n").cast("string")).alias("entities")).agg(F.count("*").alias("records"))
    return counted.withColumn("share", F.round(F.col("records") / F.sum("records").over(Window.partitionBy()), 6))


def polarity_buckets(records: DataFrame, spans: DataFrame) -> DataFrame:
    kind = (
        F.when((F.col("neg") > 0) & (F.col("pos") > 0), "mixed")
        .when(F.col("neg") > 1, "multi_target_neg")
        .when(F.col("neg") == 1, "neg_only")
        .when(F.col("pos") > 0, "pos_only")
        .otherwise("no_commodity")
    )
    return _per_record(records, spans).groupBy(kind.alias("bucket")).agg(F.count("*").alias("records"))


def cooccurrence(spans: DataFrame) -> DataFrame:
    """(type_a, type_b, records), type_a <= type_b; on the diagonal records with two or more of the type.

    Types are counted per record first, so a record gives ten rows at most.
    """
    per = spans.groupBy("record_id").agg(F.array_sort(F.collect_set("type")).alias("types"), *(F.count_if(F.col("type") == t).alias(t) for t in ("PERSON", "ORG", "ADDRESS", "COMMODITY")))
    mixed = F.flatten(F.transform("types", lambda a: F.transform(F.filter("types", lambda b: b > a), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    twice = F.filter(F.array(*(F.when(F.col(t) > 1, F.struct(F.lit(t).alias("a"), F.lit(t).alias("b"))) for t in ("PERSON", "ORG", "ADDRESS", "COMMODITY"))), lambda x: x.isNotNull())
    pairs = per.select(F.explode(F.concat(mixed, twice)).alias("p"))
    return pairs.groupBy(F.col("p.a").alias("type_a"), F.col("p.b").alias("type_b")).agg(F.count("*").alias("records"))


def edge_classes(records: DataFrame, limit: int = MAX_CHARS) -> DataFrame:
    """(case, records) of the kinds of texts that are easily got wrong; a text may be of several kinds.

    The kinds are those of the edge-case suite: nothing, white space alone, one token, other dashes than the hyphen,
    words beside a hyphen, a negation, spaces and signs that cleaning takes away, and more characters than serving takes.
    """
    text, cleaned = F.coalesce("text", F.lit("")), F.col("cleaned")
    rows = barrier(records.select(text.alias("text"), clean(text).alias("cleaned")))
    kinds = {
        "empty": F.col("text") == "", "blank": (F.col("text") != "") & (cleaned == ""), "one token": (cleaned != "") & ~cleaned.contains(" "), "dash": cleaned.rlike("[\u2013\u2014]"),
        "hyphen": cleaned.rlike("[A-Za-z]-[A-Za-z]"), "negation": F.lower(cleaned).rlike(r"(^| )(no|not|without|does not contain)( |$)"), "cleaned": F.col("text") != cleaned, "long": F.length(cleaned) > limit,
    }
    counts = rows.agg(*(F.count_if(test).alias(k) for k, test in kinds.items()))
    return counts.select(F.explode(F.array(*(F.struct(F.lit(k).alias("case"), F.col(f"`{k}`").alias("records")) for k in kinds))).alias("x")).select("x.case", "x.records")


def source_mix(records: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """(source, records, share[, target, gap])."""
    mix = records.groupBy("source").agg(F.count("*").alias("records")).withColumn("share", F.round(F.col("records") / F.sum("records").over(Window.partitionBy()), 6))
    if targets:
        goal = F.coalesce(*(F.when(F.col("source") == k, v) for k, v in targets.items()))
        mix = mix.withColumn("target", goal).withColumn("gap", F.round(F.col("share") - goal, 6))
    return mix


def bucket_support(spans: DataFrame, least: dict[str, int] | None = None) -> DataFrame:
    """(bucket, records[, least, passes]): records that hold a bucket at least once, against the least wanted if given."""
    held = spans.select("record_id", bucket_of().alias("bucket")).distinct().groupBy("bucket").agg(F.count("*").alias("records"))
    if least is None:
        return held
    wanted = spans.sparkSession.createDataFrame(list(least.items()), "bucket string, least long")
    return F.broadcast(wanted).join(held, "bucket", "left").fillna(0, ["records"]).withColumn("passes", F.col("records") >= F.col("least"))


def zero_entity(records: DataFrame, gold: DataFrame, pred: DataFrame) -> DataFrame:
    """Records without gold spans, and the share of them with a predicted one."""
    none = records.select("record_id").join(gold.select("record_id").distinct(), "record_id", "left_anti")
    wrong = none.join(pred.select("record_id").distinct().withColumn("hit", F.lit(1)), "record_id", "left")
    sums = wrong.agg(F.count("*").alias("zero_records"), F.count("hit").alias("false_positive_records"))
    return sums.withColumn("false_positive_rate", F.round(ratio(F.col("false_positive_records"), F.col("zero_records")), 6))


def neg_pos_ratio(spans: DataFrame, low: float = 0.15, high: float = 0.45) -> DataFrame:
    c = spans.filter("type = 'COMMODITY'").agg(F.count_if(F.col("polarity") == "NEG").alias("neg"), F.count_if(F.col("polarity") == "POS").alias("pos"))
    r = ratio(F.col("neg"), F.col("pos"))
    return c.withColumn("ratio", F.round(r, 6)).withColumn("passes", (r >= low) & (r <= high))


def template_coverage(records: DataFrame, templates: DataFrame, least: int = 200) -> DataFrame:
    """(template, records, passes) of every template, used or not."""
    used = records.groupBy("template").agg(F.count("*").alias("records"))
    return templates.select("template").join(used, "template", "left").fillna(0).withColumn("passes", F.col("records") >= least)


def _cue_ends(tokens: DataFrame, cues: tuple[str, ...]) -> tuple[DataFrame, list[tuple[str, Column]]]:
    """Tokens with their last words in columns, and a condition for each cue that it ends at the token."""
    by = Window.partitionBy("record_id").orderBy("tok_idx")
    words = tokens.withColumn("w", F.lower(F.regexp_replace("token", r"[^A-Za-z]+$", "")))
    for k in range(1, max(len(c.split()) for c in cues)):
        words = words.withColumn(f"w{k}", F.lag("w", k).over(by))
    tests = []
    for c in cues:
        parts = c.split()[::-1]
        match = F.col("w") == parts[0]
        for k, p in enumerate(parts[1:], 1):
            match = match & (F.coalesce(F.col(f"w{k}"), F.lit("")) == p)
        tests.append((c, match))
    return words, tests


def cue_counts(tokens: DataFrame, cues: tuple[str, ...] = CUES) -> DataFrame:
    """(cue, n) of every cue of the inventory, also of those that never occur; a longer cue does not hide a shorter one in it."""
    words, tests = _cue_ends(tokens, cues)
    ends = words.select(F.explode(F.array_compact(F.array(*(F.when(match, F.lit(c)) for c, match in tests)))).alias("cue"))
    known = tokens.sparkSession.createDataFrame([(c,) for c in cues], "cue string")
    return F.broadcast(known).join(ends.groupBy("cue").agg(F.count("*").alias("n")), "cue", "left").fillna(0)


def cue_distance(tokens: DataFrame, spans: DataFrame, cues: tuple[str, ...] = CUES) -> DataFrame:
    """(distance, spans) of negative spans from the end of the last single- or multi-word cue before them, in tokens.

    Cue ends are found by windows over a record's tokens; the last one is carried forward.
    """
    by = Window.partitionBy("record_id").orderBy("tok_idx")
    words, tests = _cue_ends(tokens, cues)
    hit = reduce(lambda a, b: a | b, (match for _, match in tests))
    carried = words.withColumn("cue", F.max(F.when(hit, F.col("tok_idx"))).over(by.rowsBetween(Window.unboundedPreceding, -1)))
    starts = spans.filter("polarity = 'NEG'").select("record_id", F.col("start").alias("c0"))
    gap = F.col("tok_idx") - F.col("cue") - 1
    placed = starts.join(carried.select("record_id", "c0", "tok_idx", "cue"), ["record_id", "c0"])
    kind = F.when(gap.isNull(), "none").when(gap <= 1, "0-1").when(gap <= 4, "2-4").when(gap <= 10, "5-10").otherwise("11+")
    return placed.groupBy(kind.alias("distance")).agg(F.count("*").alias("spans"))


def content_hash(text: Column) -> Column:
    return F.sha2(clean(text).cast("binary"), 256)


def hash_duplicates(records: DataFrame) -> DataFrame:
    """(content_hash, n, first_id, splits) of contents that occur more than once."""
    keyed = records.select(content_hash(F.col("text")).alias("content_hash"), "record_id", "split")
    return keyed.groupBy("content_hash").agg(F.count("*").alias("n"), F.min("record_id").alias("first_id"), F.count_distinct("split").alias("splits")).filter("n > 1")


def stratified_split(records: DataFrame, spans: DataFrame, seed: str, dev_share: float = 0.5) -> DataFrame:
    """(record_id, stratum, side): within (source, dominant type, negation present) by the order of a hash.

    A stratum's share is cut by its count and a rank within cells of the hash, so that no stratum is sorted
    in one task: ranks are taken within 64 hash cells, and cells add up before them.
    """
    per = spans.groupBy("record_id", "type").agg(F.count("*").alias("n"), F.max((F.col("polarity") == "NEG").cast("int")).alias("neg"))
    main = per.groupBy("record_id").agg(F.max_by("type", F.struct("n", "type")).alias("main"), F.max("neg").alias("neg"))
    keyed = records.select("record_id", "source").join(main, "record_id", "left")
    stratum = F.concat_ws("|", "source", F.coalesce("main", F.lit("none")), F.coalesce("neg", F.lit(0)).cast("string"))
    keyed = keyed.select("record_id", stratum.alias("stratum"), hash32(seed, F.col("record_id")).alias("h")).withColumn("cell", F.shiftright("h", 26))
    sizes = keyed.groupBy("stratum", "cell").agg(F.count("*").alias("n"))
    by = Window.partitionBy("stratum").orderBy("cell")
    before = sizes.withColumn("before", F.sum("n").over(by) - F.col("n")).withColumn("total", F.sum("n").over(Window.partitionBy("stratum"))).drop("n")
    nth = F.row_number().over(Window.partitionBy("stratum", "cell").orderBy("h", "record_id")) + F.col("before")
    placed = keyed.join(before, ["stratum", "cell"]).withColumn("nth", nth)
    return placed.select("record_id", "stratum", F.when(F.col("nth") <= F.ceil(F.col("total") * dev_share), "dev").otherwise("test").alias("side"))


def temporal_split(rows: DataFrame, ts: str = "ts", dev_months: int = 6, test_months: int = 1) -> DataFrame:
    """rows with side: the latest test_months are test, dev_months before them dev, older ones train."""
    last = rows.agg(F.max(ts).alias("last"))
    dated = rows.join(F.broadcast(last))  # one row
    return dated.withColumn(
        "side", F.when(F.col(ts) > F.add_months("last", -test_months), "test").when(F.col(ts) > F.add_months("last", -dev_months - test_months), "dev").otherwise("train")
    ).drop("last")


def group_split(records: DataFrame, group: str, seed: str) -> DataFrame:
    """(record_id, side): all records of a group go to the side that its hash says."""
    return records.select("record_id", F.when(hash32(seed, F.col(group)) % 2 == 0, "dev").otherwise("test").alias("side"))


def token_order(texts: DataFrame) -> bytes:
    """How frequent tokens are: for each of ORDER_BUCKETS hash buckets a byte that grows with its words in texts(text).

    Prefix filters hold for any order that all sets share; this one puts rare tokens first. The table has a fixed
    size whatever the vocabulary, so it travels with the plan and no token is joined with its count.
    """
    words = texts.select(F.explode(F.split(F.lower("text"), r"\s+")).alias("w"))
    told = words.groupBy(F.pmod(F.xxhash64("w"), F.lit(ORDER_BUCKETS)).alias("b")).agg(F.count("*").alias("n")).collect()  # ORDER_BUCKETS rows at most
    table = bytearray(ORDER_BUCKETS)
    for r in told:
        table[r.b] = min(255, int(8 * math.log2(r.n + 1)))
    return bytes(table)


def _token_sets(df: DataFrame) -> DataFrame:
    """(set_id, words, parity) of the distinct token sets, stored: prefixes and the comparison read them.

    A set travels as one string, words, which takes a fourth of what an array does. parity: see _parities.
    """
    made = barrier(df.select(F.array_join(token_set(F.col("text")), " ").alias("words"))).filter("words <> ''")
    sets = made.select(F.unhex(F.md5("words")).alias("set_id"), "words").repartition("set_id").dropDuplicates(["set_id"])
    return materialize(sets.withColumn("parity", _parities(PARITY_WORDS)), "sets")


def _parities(size: int) -> Column:
    """Whether the tokens of a set (words) in each of size * 64 hash buckets are odd in number, as bits.

    A token that only one of two sets has changes one bit, so sets differ in as many tokens as their bits do, or more.
    """

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def run(hashes: pa.Array) -> pa.Array:
        bits, parts = size * 64, []
        for k in range(0, len(hashes), 1000):
            some = hashes.slice(k, 1000)
            row = np.repeat(np.arange(len(some)), some.value_lengths().to_numpy(zero_copy_only=False))
            odd = np.bincount(row * bits + (some.flatten().to_numpy() & (bits - 1)), minlength=len(some) * bits) & 1
            parts.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
        ends = pa.array(np.arange(len(hashes) + 1, dtype=np.int32) * size)
        return pa.ListArray.from_arrays(ends, pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64)))

    return run(F.transform(F.split("words", " "), lambda t: F.xxhash64(t)))


def _apart(left: list[Column], right: list[Column]) -> Column:
    """In how many bits two sets differ."""
    return reduce(lambda a, b: a + b, (F.bit_count(x.bitwiseXOR(y)) for x, y in zip(left, right, strict=True)))


def _prefixes(sets: DataFrame, order: bytes, least: float, side: str) -> DataFrame:
    """(set_id, n, h, place, cells, parity): the hashes of the rarest tokens, of which similar sets share one, and the grid of each."""
    at = lambda t: F.pmod(F.xxhash64(t), F.lit(ORDER_BUCKETS)).cast("int") + 1
    sets = barrier(sets.select("set_id", "parity", F.split("words", " ").alias("tokens")))
    ranked = F.array_sort(F.transform("tokens", lambda t: F.struct(F.substring(F.lit(order), at(t), F.lit(1)).alias("f"), F.xxhash64(t).alias("h"))))
    n = F.size("tokens")
    cut = (n - F.ceil(n * least - 1e-9) + 1).cast("int")
    words = [F.get("parity", k).alias(f"p{k}") for k in range(PARITY_WORDS)]
    rows = sets.select("set_id", n.alias("n"), *words, F.posexplode(F.slice(ranked, F.lit(1), cut)).alias("place", "x"))
    often = F.pow(F.lit(2.0), F.conv(F.hex("x.f"), 16, 10).cast("int") / 8)
    cells = F.greatest(F.lit(1), F.ceil(often / CELL_ROWS)).cast("int")
    held = [f"p{k}" for k in range(PARITY_WORDS)]
    rows = rows.select("set_id", "n", "place", *held, F.col("x.h").alias("h"), cells.alias("cells"), F.xxhash64("set_id", F.lit("cell")).alias("own"))
    own, other = ("i", "j") if side == "l" else ("j", "i")
    every = F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias(other)
    return rows.select("h", F.pmod("own", "cells").cast("int").alias(own), every, *(F.col(c).alias(f"{side}_{c}") for c in ("set_id", "n", "place", *held)))


def token_jaccard_pairs(left: DataFrame, right: DataFrame, least: float = 0.9, falling: bool = False) -> DataFrame:
    """(left_set, right_set, jaccard) of the distinct token sets of two corpora (record_id, text) at or over a similarity.

    Records enter by their token set (md5 of it), so copies are one; token_set_members says which records
    share a set. Prefix filter: within a row, tokens are put in token_order's order, and sets that reach the
    similarity share one of the first n - ceil(least * n) + 1; only those are joined, by the token's hash, with filters
    of length, place and parity bits (which leave out no similar pair), and what is left is compared token by token.
    falling: only pairs with left_set > right_set, for a corpus against itself. The rows of a frequent token are dealt over a grid of
    cells: a left row goes to the cells of its row, a right one to those of its column, so that each pair meets once
    and no task takes the token alone.
    """
    order = token_order(left.select("text").unionByName(right.select("text")))
    tl = _token_sets(left)
    tr = tl if left is right else _token_sets(right)
    ln, rn, lp, rp = (F.col(c) for c in ("l_n", "r_n", "l_place", "r_place"))
    # common tokens: at most those before either place, this one, and those behind both
    most = F.least(lp, rp) + 1 + F.least(ln - lp - 1, rn - rp - 1)
    fits = (ln >= rn * least - 1e-9) & (rn >= ln * least - 1e-9) & (most >= least * (ln + rn - most) - 1e-9)
    # tokens that one side alone has: at least as many as there are differing bits, of similar sets at most this share
    most_apart = (ln + rn) * ((1 - least) / (1 + least)) + 1e-6
    fits = fits & (_apart(*([F.col(f"{side}_p{k}") for k in range(PARITY_WORDS)] for side in "lr")) <= most_apart)
    if falling:
        fits = fits & (F.col("l_set_id") > F.col("r_set_id"))
    met = _prefixes(tl, order, least, "l").join(_prefixes(tr, order, least, "r"), ["h", "i", "j"]).filter(fits)
    near = materialize(met.select("l_set_id", "r_set_id").distinct(), "near")

    def both(near: DataFrame, *told: Column) -> DataFrame:
        """near with what is told of either set; ids are broadcast where they are few, else joined by a shuffle."""
        bounded = near.count() <= KEYS_SENT
        for sets, side in ((tl, "l"), (tr, "r")):
            ids = near.select(F.col(f"{side}_set_id").alias("set_id")).distinct()
            kept = sets.join(F.broadcast(ids) if bounded else ids, "set_id", "left_semi")
            near = near.join(kept.select(F.col("set_id").alias(f"{side}_set_id"), *(c.alias(f"{side}_{k}") for k, c in enumerate(told))), f"{side}_set_id")
        return near

    # longer sets need more bits; only what they leave is sent token by token
    finer = both(near, F.size(F.split("words", " ")), _parities(FINE_WORDS))
    bits = ([F.get(f"{side}_1", k) for k in range(FINE_WORDS)] for side in "lr")
    near = materialize(finer.filter(_apart(*bits) <= (F.col("l_0") + F.col("r_0")) * ((1 - least) / (1 + least)) + 1e-6).select("l_set_id", "r_set_id"), "nearer")
    whole = both(near, F.col("words"))
    whole = barrier(whole.select("l_set_id", "r_set_id", F.split("l_0", " ").alias("l_tokens"), F.split("r_0", " ").alias("r_tokens")))
    common = F.size(F.array_intersect("l_tokens", "r_tokens"))
    compared = barrier(whole.select("l_set_id", "r_set_id", common.alias("common"), (F.size("l_tokens") + F.size("r_tokens")).alias("both")))
    j = F.col("common") / (F.col("both") - F.col("common"))
    named = lambda side: F.lower(F.hex(f"{side}_set_id"))
    return compared.filter(j >= least - 1e-12).select(named("l").alias("left_set"), named("r").alias("right_set"), F.round(j, 6).alias("jaccard"))


def token_set_members(records: DataFrame) -> DataFrame:
    """(record_id, set_id): which token set a record has."""
    return records.select("record_id", F.md5(F.array_join(token_set(F.col("text")), " ")).alias("set_id"))


def kappa(a: DataFrame, b: DataFrame) -> DataFrame:
    """Cohen's kappa over token labels (record_id, tok_idx, label_id) of two annotators."""
    return kappa_of_pairs(a.select("record_id", "tok_idx", F.col("label_id").alias("la")).join(b.select("record_id", "tok_idx", F.col("label_id").alias("lb")), ["record_id", "tok_idx"]))


def kappa_of_pairs(pairs: DataFrame) -> DataFrame:
    """Cohen's kappa over tokens (la, lb) that hold both annotators' labels.

    One aggregate to the confusion matrix, which has as many cells as there are label pairs; agreement by chance
    comes from its row and column sums.
    """
    return kappa_of_cells(pairs.groupBy("la", "lb").agg(F.count("*").alias("n")))


def kappa_of_cells(cells: DataFrame) -> DataFrame:
    """Cohen's kappa of a confusion matrix (la, lb, n)."""
    row = F.sum(F.when(F.col("x.side") == "a", F.col("n")).otherwise(0))
    sides = F.explode(F.array(F.struct(F.lit("a").alias("side"), F.col("la").alias("label")), F.struct(F.lit("b").alias("side"), F.col("lb").alias("label"))))
    same = F.when((F.col("x.side") == "a") & (F.col("la") == F.col("lb")), F.col("n")).otherwise(0)
    by_label = cells.withColumn("x", sides).groupBy("x.label").agg(row.alias("ra"), (F.sum("n") - row).alias("rb"), F.sum(same).alias("same"))
    sums = by_label.agg(F.sum("ra").alias("n"), F.sum("same").alias("same"), F.sum(F.col("ra").cast("double") * F.col("rb")).alias("by_chance"))
    po, pe = F.col("same") / F.col("n"), F.coalesce("by_chance", F.lit(0.0)) / (F.col("n").cast("double") * F.col("n"))
    return sums.select(F.col("n").alias("tokens"), F.round(po, 9).alias("agreement"), F.round(F.when(pe < 1, (po - pe) / (1 - pe)).otherwise(1.0), 9).alias("kappa"))


def agreement_panel(votes: DataFrame, units: tuple[str, ...] = ("record_id", "tok_idx")) -> DataFrame:
    """Agreement of any number of annotators of votes(units, annotator, label_id), some of which may be missing.

    (annotator_a, annotator_b, units, agreement, coefficient): for each pair that shares units the plain agreement and
    Cohen's kappa, and in the row ('all', 'all') the units of two votes or more, the observed agreement and
    Krippendorff's alpha for nominal labels. All of them come from one table of coincidences: how often a pair of
    annotators gave a pair of labels in units of so many votes, which has as many rows as there are such cells.
    A null label is a missing vote; of an annotator's several votes on a unit the smallest label counts. With one label in
    all there is nothing to tell chance from, and the coefficient is 1.
    """
    given = votes.filter(F.col("label_id").isNotNull()).groupBy(*units, "annotator").agg(F.min("label_id").alias("label"))
    unit = given.groupBy(*units).agg(F.array_sort(F.collect_list(F.struct("annotator", "label"))).alias("v"))  # as many as there are annotators
    return _panel(unit.select("v"))


def panel_of_arrays(units: DataFrame) -> DataFrame:
    """agreement_panel of rows v: array<struct<annotator, label>>, one row a unit, without missing votes."""
    return _panel(units.select(F.array_sort("v").alias("v")))


def _panel(units: DataFrame) -> DataFrame:
    later = lambda x, k: F.transform(F.slice("v", k + 2, F.size("v")), lambda y: F.struct(x["annotator"].alias("a"), y["annotator"].alias("b"), x["label"].alias("la"), y["label"].alias("lb")))
    pairs = units.filter(F.size("v") > 1).select(F.size("v").alias("m"), F.explode(F.flatten(F.transform("v", later))).alias("p"))
    return panel_of_cells(pairs.groupBy("p.a", "p.b", "p.la", "p.lb", "m").agg(F.count("*").alias("n")))


def panel_of_cells(cells: DataFrame) -> DataFrame:
    """agreement_panel of how often (n) annotators a < b gave the labels la and lb in units of m votes."""
    # the coincidences are read by every pair and by alpha: a row for each pair, its two labels, and both orders
    sides = F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("la").alias("label"), F.col("lb").alias("other")), F.struct(F.lit(1).alias("side"), F.col("lb").alias("label"), F.col("la").alias("other"))))
    scope = F.explode(F.array(F.struct("a", "b"), F.struct(F.lit("all").alias("a"), F.lit("all").alias("b"))))
    # alpha weighs a unit of m votes by 1 / (m - 1); whole numbers are added up for each m, so sums do not depend on their order
    rows = cells.withColumn("s", scope).select("s.a", "s.b", "m", "n", "la", "lb").withColumn("x", sides)
    rows = rows.withColumn("w", F.when(F.col("a") == "all", F.col("n") / (F.col("m") - 1)).otherwise(F.col("n").cast("double")))
    whole = F.when(F.col("a") == "all", F.col("n") / (F.col("m") * (F.col("m") - 1)) * 2).otherwise(F.col("n").cast("double"))  # units, over their pairs
    by_label = rows.groupBy("a", "b", "x.label").agg(
        F.sum(F.when(F.col("x.side") == 0, F.col("w")).otherwise(0.0)).alias("ra"),
        F.sum(F.when(F.col("x.side") == 1, F.col("w")).otherwise(0.0)).alias("rb"),
        F.sum(F.when((F.col("x.side") == 0) & (F.col("x.label") == F.col("x.other")), F.col("w")).otherwise(0.0)).alias("same"),
        F.sum(F.when(F.col("x.side") == 0, whole).otherwise(0.0)).alias("units"),
    )
    n, both = F.col("n"), F.col("ra") + F.col("rb")
    sums = by_label.groupBy("a", "b").agg(
        F.sum("units").alias("units"), F.sum("ra").alias("n"), F.sum("same").alias("same"), F.sum(F.col("ra") * F.col("rb")).alias("kappa_chance"), F.sum(both * both).alias("squares")
    )
    agreed = F.col("same") / n
    kappa_chance = F.col("kappa_chance") / (n * n)
    # values that can be paired: 2 n; chance agreement without putting a value back
    alpha_chance = (F.col("squares") - 2 * n) / (2 * n * (2 * n - 1))
    chance = F.when(F.col("a") == "all", alpha_chance).otherwise(kappa_chance)
    coefficient = F.when(chance < 1 - 1e-15, (agreed - chance) / (1 - chance)).otherwise(1.0)
    return sums.select(F.col("a").alias("annotator_a"), F.col("b").alias("annotator_b"), F.round("units").cast("bigint").alias("units"), F.round(agreed, 9).alias("agreement"), F.round(coefficient, 9).alias("coefficient"))


def kl_drift(dated: DataFrame, base: DataFrame, alarm: float = 0.05) -> DataFrame:
    """(month, kl, alarm): KL divergence of each month's tokens (month, token) from base tokens (token), add-one smoothed.

    Only tokens that a month has carry mass beyond smoothing; the rest of the vocabulary is summed in closed form.
    """
    months = dated.groupBy("month", "token").agg(F.count("*").alias("n"))
    dev = base.groupBy("token").agg(F.count("*").alias("m"))
    words = dated.select("token").unionByName(base.select("token")).distinct()
    size = words.agg(F.count("*").alias("v"))
    sums = months.groupBy("month").agg(F.sum("n").alias("total"))
    dev_sum = dev.agg(F.coalesce(F.sum("m"), F.lit(0)).alias("m_total"))
    # sum over the vocabulary of p ln(p / q), with p = (n + 1) / (total + v), q = (m + 1) / (m_total + v)
    seen = months.join(dev, "token", "left").fillna(0, ["m"])
    logs = seen.groupBy("month").agg(
        F.sum((F.col("n") + 1) * (F.ln(F.col("n") + 1) - F.ln(F.col("m") + 1)) + F.ln(F.col("m") + 1)).alias("part")
    )
    rest = dev.agg(F.coalesce(F.sum(F.ln(F.col("m") + 1)), F.lit(0.0)).alias("dev_logs"))
    joined = logs.join(sums, "month").join(F.broadcast(size)).join(F.broadcast(dev_sum)).join(F.broadcast(rest))  # one row each
    p_size, q_size = F.col("total") + F.col("v"), F.col("m_total") + F.col("v")
    kl = (F.col("part") - F.col("dev_logs")) / p_size + F.ln(q_size / p_size)
    return joined.select("month", F.round(kl, 6).alias("kl"), (kl >= alarm).alias("alarm"))


def manifest_sha(records: DataFrame, cells: int = 4096) -> DataFrame:
    """(split, manifest_sha) from sorted content hashes: hashed within cells of their first digits, then over the cells.

    Two levels keep every group bounded: a cell holds its part of the hashes, the top holds at most `cells` digests.
    """
    digits = {16: 1, 256: 2, 4096: 3}[cells]
    rows = records.select("split", content_hash(F.col("text")).alias("h")).withColumn("cell", F.substring("h", 1, digits))
    part = rows.groupBy("split", "cell").agg(F.sha2(F.array_join(F.array_sort(F.collect_list("h")), "\n").cast("binary"), 256).alias("sha"))
    top = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("cell", "sha"))), lambda x: x["sha"]), "\n")
    return part.groupBy("split").agg(F.sha2(top.cast("binary"), 256).alias("manifest_sha"))


def manifest_drift(records: DataFrame, manifest: DataFrame) -> DataFrame:
    """(split, manifest_sha, now_sha, drifted): the stored manifest(split, manifest_sha) against the records hashed again.

    A split that only one side has counts as drifted.
    """
    now = manifest_sha(records).withColumnRenamed("manifest_sha", "now_sha")
    return manifest.select("split", "manifest_sha").join(now, "split", "full").withColumn("drifted", ~F.col("manifest_sha").eqNullSafe(F.col("now_sha")))


def least_confident(probs: DataFrame, k: int = 100) -> DataFrame:
    """The k records whose least sure token is least sure: what to label next."""
    return least_sure(probs.select("record_id", F.array_max("probs").alias("sure")), k)


def least_sure(tokens: DataFrame, k: int = 100) -> DataFrame:
    """least_confident of tokens(record_id, sure); rows of a record may be added up before."""
    sure = tokens.groupBy("record_id").agg(F.round(F.min("sure").cast("double"), 6).alias("confidence"))
    return sure.orderBy("confidence", "record_id").limit(k)


def acceptance_gates(values: DataFrame) -> DataFrame:
    """(gate, value, least, most, passes) of values(gate, value, least, most)."""
    ok = (F.col("least").isNull() | (F.col("value") >= F.col("least"))) & (F.col("most").isNull() | (F.col("value") <= F.col("most")))
    return values.withColumn("passes", ok)
