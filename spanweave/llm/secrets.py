"""Secret scans with DataFrame functions only: fixed patterns plus character Markov models.

The three fixed kinds are found by pattern. The method adds the kind markov: runs of at least
LEAST_RUN token characters whose characters follow each other rather as in random strings than as in
ordinary identifiers. Two first-order Markov models are trained from labelled samples (random: digests
in base64, hex and upper-case base32-like forms; ordinary: words of sampled documents, alone and
as they are joined in names, constants, paths, links and dated files, and rules of one sign) and compared by the log-likelihood ratio per character pair. A run
that is not random as a whole is searched for its random stretches: it has one from where LEAST_RUN
characters reach the threshold on to where the next LEAST_RUN no longer do. What the fixed kinds hold
is cut out of the runs first.

Offsets count code points: they add up from the lengths of the pieces between matches. Sums along an
array are made in two levels (blocks of BLOCK elements), so that a text with n matches costs n times the
square root of n at worst, and pieces of text are cut by bytes, which needs no walk from its start.

Defined cases: null text is empty; empty text has no spans; null and repeated doc_id stay rows of
their own; extra columns are ignored; with no text to learn from, the ordinary model is uniform.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ASSIGN = r"""(?:(?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
RUN = r"[A-Za-z0-9+/_=-]{20,}"
KINDS = ("assign", "access", "hex", "markov")
LEAST_VALUE, LEAST_RUN = 12, 20
#: Documents whose words teach the ordinary model (expected number), and random strings of each form.
SAMPLE_DOCS, SAMPLE_RANDOM = 400, 400
#: Least mean log-likelihood ratio per pair of characters.
THRESHOLD = 1.1
#: Share of a model's counts that goes to characters of the same kind: words of other languages have other pairs.
SHARED = {"random": 0.0, "ordinary": 0.5}
_SIDE = 96  # printable ASCII, by code point - 32
_SPAN = "array<struct<s:bigint,k:int,e:bigint>>"
_PLACED = "array<struct<s:bigint,k:int,e:bigint,b:bigint>>"
#: Elements of an array that are folded one after another.
BLOCK = 128


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_random: int = SAMPLE_RANDOM) -> list[float]:
    """Log-likelihood ratios, random over ordinary, of every pair of printable ASCII characters."""
    spark: SparkSession = docs.sparkSession
    digest = F.sha2(F.col("id").cast("string"), 256)
    base64 = F.base64(F.unhex(digest))
    random = spark.range(sample_random).select(F.explode(F.array(base64, F.translate(base64, "+/", "-_"), digest, F.upper(F.translate(base64, "+/=", "ABC")))).alias("s"))
    n = docs.count()
    few = docs.select("text").filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_003)) < min(1.0, sample_docs / max(n, 1)) * 1_000_003)
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[^A-Za-z]+"), lambda w: F.length(w) >= 2)
    words = few.select(F.array_distinct(words).alias("w")).filter(F.size("w") > 0)
    pair = F.transform(F.sequence(F.lit(1), F.size("w") - 1), lambda i: F.slice("w", i, 2))
    joined = F.when(F.size("w") > 1, F.flatten(F.transform(pair, _written)))
    rules = F.array(*(F.lit(x * 40) for x in ("_", "-", "=", "/", "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")))
    ordinary = words.select(F.explode(F.concat("w", F.coalesce(joined, F.array().cast("array<string>")), rules)).alias("s"))
    told = random.withColumn("label", F.lit("random")).unionByName(ordinary.withColumn("label", F.lit("ordinary")))
    pairs = told.filter(F.length("s") > 1).select("label", F.explode(F.transform(F.sequence(F.lit(1), F.length("s") - 1), lambda i: F.substring(F.col("s"), i, F.lit(2)))).alias("pair"))
    counts: dict[str, dict[int, int]] = {"random": {}, "ordinary": {}}
    for r in pairs.groupBy("label", "pair").count().collect():  # two labels, at most 96 x 96 pairs each
        a, b = (ord(c) - 32 for c in r.pair)
        if 0 <= a < _SIDE and 0 <= b < _SIDE:
            counts[r.label][a * _SIDE + b] = r["count"]
    ratio: list[float] = []
    for a in range(_SIDE):
        rows = {k: _smoothed([v.get(a * _SIDE + b, 0) for b in range(_SIDE)], SHARED[k]) for k, v in counts.items()}
        sums = {k: sum(v) for k, v in rows.items()}
        ratio += [math.log(x / sums["random"]) - math.log(y / sums["ordinary"]) for x, y in zip(rows["random"], rows["ordinary"], strict=True)]
    return ratio


def _smoothed(row: list[int], shared: float) -> list[float]:
    """Counts of what follows a character, of which a share is dealt evenly over letters of a case, and over digits."""
    out = [(1 - shared) * x + 0.2 for x in row]
    for low, high in ("az", "AZ", "09"):
        kind = range(ord(low) - 32, ord(high) - 31)
        even = shared * sum(row[b] for b in kind) / len(kind)
        for b in kind:
            out[b] += even
    return out


def _written(pair: Column) -> Column:
    """The ways in which two words stand in names, paths, links, constants and dated files."""
    n = F.pmod(F.xxhash64(pair), F.lit(18_000)).cast("int")
    day = F.date_add(F.lit("1985-01-01").cast("date"), n)
    upper, camel = F.transform(pair, F.upper), F.array_join(F.transform(pair, F.initcap), "")
    first = F.get(pair, F.lit(0))
    numbers = [F.date_format(day, "yyyy-MM-dd"), F.date_format(day, "yyyy/MM/dd"), F.concat(first, F.lit("-"), n.cast("string"), F.lit("-"), F.pmod(n, F.lit(97)).cast("string"))]
    dated = [F.concat(F.initcap(first), F.lit("_"), F.date_format(day, "yyyyMMdd")), F.concat(first, F.pmod(n, F.lit(12)).cast("string"), F.lit("/"))]
    return F.array(*(F.array_join(pair, x) for x in ("_", "-", "/", "")), camel, *(F.array_join(upper, x) for x in ("_", "", "-")), *numbers, *dated)


def _scan(items: Column, zero: Column, step, emit, state: str, out: str) -> Column:
    """emit(state before, x) for each x of an array, where step(state, x) makes the next state; states are small structs.

    state and out: the types of states and of what is emitted.

    The states at the beginnings of blocks are found first, then each block is folded from its own.
    """
    def begin(a: Column, block: Column) -> Column:
        return F.struct(F.aggregate(block, a["now"], step).alias("now"), F.concat(a["all"], F.array(a["now"])).alias("all"))

    def within(block: Column, first: Column) -> Column:
        both = lambda a, x: F.struct(step(a["now"], x).alias("now"), F.concat(a["out"], F.array(emit(a["now"], x))).alias("out"))
        return F.aggregate(block, F.struct(first.alias("now"), F.array().cast(f"array<{out}>").alias("out")), both)["out"]

    def over(blocks: Column) -> Column:
        nothing = F.struct(zero.alias("now"), F.array().cast(f"array<{state}>").alias("all"))
        begins = F.when(F.size(blocks) > 1, F.aggregate(blocks, nothing, begin)["all"]).otherwise(F.array(zero))
        return F.flatten(F.zip_with(blocks, begins, within))

    def cut(every: Column) -> Column:
        last = F.floor((F.size(every) - 1) / BLOCK).cast("int")
        return F.when(F.size(every) > BLOCK, F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(every, i * BLOCK + 1, F.lit(BLOCK)))).otherwise(F.array(every))

    return _let(_let(items, cut), over)


def _let(value: Column, body) -> Column:
    """body(value) with the value made once; what a lambda names from outside is made again for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _spans(text: Column, pattern: str, kind: int, value: int, keep) -> Column:
    """Spans of the pattern's matches, leftmost and non-overlapping, whose group `value` meets keep; b: the start in bytes.

    Matches are ASCII, so they are as many bytes as characters.
    """
    zipped = F.arrays_zip(
        F.split(text, pattern, -1).alias("between"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(value)).alias("value"),
    )
    sizes = F.transform(
        F.filter(zipped, lambda x: x["match"].isNotNull()),
        lambda x: F.struct(F.length(x["between"]).alias("c"), F.octet_length(x["between"]).alias("b"), F.length(x["match"]).alias("m"), keep(x["value"]).alias("keep")),
    )
    state = lambda at, b: F.struct(at.cast("bigint").alias("at"), b.cast("bigint").alias("b"))
    placed = _scan(
        sizes,
        state(F.lit(0), F.lit(0)),
        lambda a, x: state(a["at"] + x["c"] + x["m"], a["b"] + x["b"] + x["m"]),
        lambda a, x: F.struct(
            (a["at"] + x["c"]).cast("bigint").alias("s"), F.lit(kind).alias("k"), (a["at"] + x["c"] + x["m"]).cast("bigint").alias("e"), (a["b"] + x["b"]).cast("bigint").alias("b"), x["keep"].alias("keep")
        ),
        "struct<at:bigint,b:bigint>",
        "struct<s:bigint,k:int,e:bigint,b:bigint,keep:boolean>",
    )
    kept = F.transform(F.filter(placed, lambda x: x["keep"]), lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e"), x["b"].alias("b")))
    return F.when(text.rlike(pattern), kept).otherwise(F.array().cast(_PLACED))


def _cut(data: Column, begin: Column, size: Column) -> Column:
    """So many bytes of a binary from a place on, as text."""
    return F.substring(data, (begin + 1).cast("int"), size.cast("int")).cast("string")


def _pairs(token: Column, ratio: list[float]) -> Column:
    """Log-likelihood ratio of every pair of neighbours in a token of printable ASCII."""
    table = F.split(F.lit(",".join(f"{x:.5f}" for x in ratio)), ",").cast("array<double>")
    codes = F.transform(F.split(token, ""), lambda c: F.ascii(c) - 32)
    n = F.size(codes)
    index = F.zip_with(F.slice(codes, 1, n - 1), F.slice(codes, 2, n - 1), lambda a, b: a * _SIDE + b + 1)
    return F.transform(index, lambda i: F.element_at(table, i))


def _stretches(pairs: Column, threshold: float) -> Column:
    """(s, e) of the stretches of at least LEAST_RUN characters that are random, in order and apart.

    One pass: w is the sum over the last LEAST_RUN - 1 pairs, less the threshold each. A stretch opens
    (at o) when w is not negative and closes when it is; it ends where its own sum b was largest.
    """
    lag = LEAST_RUN - 1
    over = F.transform(pairs, lambda x: x - F.lit(threshold))
    old = F.concat(F.array_repeat(F.lit(0.0), lag), F.slice(over, 1, F.size(over) - lag))
    kinds = {"i": "int", "w": "double", "b": "double", "s": "int", "top": "double", "e": "int", "o": "int", "spans": "array<struct<s:int,e:int>>"}
    pack = lambda **v: F.struct(*(v[k].cast(t).alias(k) for k, t in kinds.items()))
    before = lambda a: F.coalesce(F.try_element_at(a["spans"], F.lit(-1))["e"], F.lit(0))
    closed = lambda a: F.when(a["o"] < 0, a["spans"]).otherwise(F.concat(a["spans"], F.array(F.struct(F.greatest(F.least(a["s"], a["e"] - LEAST_RUN), before(a)).alias("s"), a["e"].alias("e")))))

    def step(a: Column, x: Column) -> Column:
        i, w, b = a["i"], a["w"] + x["over"] - x["old"], a["b"] + x["over"]
        # ordinary characters that came in with the first window go
        trim = (w > b) & (i - a["o"] < lag)
        best, top = F.when(trim, w).otherwise(b), F.when(trim, a["top"] + w - b).otherwise(a["top"])
        more = best >= top
        s = F.when(trim, i - lag + 1).otherwise(a["s"])
        grown = pack(i=i + 1, w=w, b=best, s=s, top=F.greatest(best, top), e=F.when(more, i + 2).otherwise(a["e"]), o=a["o"], spans=a["spans"])
        opened = pack(i=i + 1, w=w, b=w, s=i - lag + 1, top=w, e=i + 2, o=i, spans=a["spans"])
        none = pack(i=i + 1, w=w, b=F.lit(0.0), s=F.lit(0), top=F.lit(0.0), e=F.lit(0), o=F.lit(-1), spans=closed(a))
        return F.when((i < lag - 1) | (w < 0), none).when(a["o"] < 0, opened).otherwise(grown)

    zero = pack(i=F.lit(0), w=F.lit(0.0), b=F.lit(0.0), s=F.lit(0), top=F.lit(0.0), e=F.lit(0), o=F.lit(-1), spans=F.array())
    return F.aggregate(F.arrays_zip(over.alias("over"), old.alias("old")), zero, step, closed)


def random_parts(token: Column, ratio: list[float], threshold: float = THRESHOLD) -> Column:
    """(s, e) within a token: the whole of it if its mean ratio reaches the threshold, else its random stretches."""
    whole = F.array(F.struct(F.lit(0).alias("s"), F.length(token).alias("e")))

    def told(pairs: Column) -> Column:
        mean = F.aggregate(pairs, F.lit(0.0), lambda acc, x: acc + x) / F.size(pairs)
        return F.when(mean >= threshold, whole).otherwise(_stretches(pairs, threshold))

    return F.flatten(F.transform(F.array(_pairs(token, ratio)), told))


def _without(text: Column, data: Column, spans: str) -> Column:
    """The text (data: its bytes) with spaces in place of sorted spans, which may overlap."""
    begin = lambda a, x: F.greatest(a["b"], x["b"])
    end = lambda a, x: F.greatest(a["b"], x["b"] + x["e"] - x["s"])
    state = lambda b: F.struct(b.cast("bigint").alias("b"))
    pieces = _scan(
        F.col(spans),
        state(F.lit(0)),
        lambda a, x: state(end(a, x)),
        lambda a, x: F.concat(_cut(data, a["b"], begin(a, x) - a["b"]), F.repeat(F.lit(" "), (end(a, x) - begin(a, x)).cast("int"))),
        "struct<b:bigint>",
        "string",
    )
    last = F.aggregate(spans, F.lit(0).cast("bigint"), lambda a, x: F.greatest(a, x["b"] + x["e"] - x["s"]))
    return F.when(F.size(spans) > 0, F.concat(F.array_join(pieces, ""), _cut(data, last, F.octet_length(text)))).otherwise(text)


def find(docs: DataFrame, ratio: list[float], threshold: float = THRESHOLD) -> DataFrame:
    """docs(doc_id, text) to doc_id, base (the fixed kinds' spans) and spans (all), as sorted arrays of (s, k, e)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    yes = lambda v: F.lit(True)
    base = F.array_sort(
        F.concat(
            _spans(text, ASSIGN, 0, 1, lambda v: F.length(v) >= LEAST_VALUE),
            _spans(text, ACCESS, 1, 0, yes),
            _spans(text, HEX, 2, 0, yes),
        )
    )
    rows = docs.select("doc_id", text.alias("text"), text.cast("binary").alias("data"), base.alias("base"))
    rows = rows.select("doc_id", "base", _without(F.col("text"), F.col("data"), "base").alias("rest"), "data")
    rows = rows.select("doc_id", "base", _spans(F.col("rest"), RUN, 3, 0, yes).alias("runs"), "data")
    token = lambda r: _cut(F.col("data"), r["b"], r["e"] - r["s"])
    cut = lambda r, p: F.struct((r["s"] + p["s"]).alias("s"), F.lit(3).alias("k"), (r["s"] + p["e"]).alias("e"))
    parts = F.flatten(F.transform("runs", lambda r: F.transform(random_parts(token(r), ratio, threshold), lambda p: cut(r, p))))
    plain = F.transform("base", lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e")))
    return rows.select("doc_id", plain.alias("base"), F.array_sort(F.concat(plain, parts)).alias("spans"))


def listed(spans: str) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def count_of(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["k"] == KINDS.index(kind))).cast("bigint")
