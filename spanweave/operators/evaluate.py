"""Exact-span scores by type and polarity, objectives, and the search for label thresholds.

Spans are rows (record_id, start, end, type, polarity). Counting is one aggregate: gold and predicted
spans are tagged, grouped by their whole key, and summed by bucket, so duplicates collapse and no
join is needed. A search over thresholds counts all of its grid in one pass over the records.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanweave.operators import whole
from spanweave.operators.tokens import best_label, bio_decode
from spanweave.schema import BUCKETS, LABELS

KEY = ("record_id", "start", "end", "type", "polarity")


def bucket_of() -> Column:
    return F.when(F.col("type") == "COMMODITY", F.concat(F.lit("COMMODITY("), "polarity", F.lit(")"))).otherwise(F.col("type"))


def ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 where b is 0."""
    return F.when(b > 0, a / b).otherwise(0.0)


def scores(counts: DataFrame) -> DataFrame:
    p, r = ratio(F.col("tp"), F.col("tp") + F.col("fp")), ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    rows = counts.withColumn("precision", p).withColumn("recall", r)
    f1 = ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return rows.withColumn("f1", f1).withColumn("support", F.col("tp") + F.col("fn")).withColumn("pred_count", F.col("tp") + F.col("fp"))


def all_buckets(sums: DataFrame) -> DataFrame:
    """sums(bucket, tp, fp, fn), added up by bucket, for all buckets, also empty ones."""
    summed = sums.groupBy("bucket").agg(*(F.sum(c).alias(c) for c in ("tp", "fp", "fn")))
    dim = sums.sparkSession.createDataFrame([(b,) for b in BUCKETS], "bucket string")
    return F.broadcast(dim).join(summed, "bucket", "left").fillna(0)  # five rows


def count_matches(pred: DataFrame, gold: DataFrame) -> DataFrame:
    """(bucket, tp, fp, fn) of all buckets, also empty ones."""
    tagged = pred.select(*KEY, F.lit(1).alias("p"), F.lit(0).alias("g")).unionByName(gold.select(*KEY, F.lit(0).alias("p"), F.lit(1).alias("g")))
    pairs = tagged.groupBy(*KEY).agg(F.max("p").alias("p"), F.max("g").alias("g")).withColumn("bucket", bucket_of())
    return all_buckets(pairs.select("bucket", (F.col("p") * F.col("g")).alias("tp"), (F.col("p") * (1 - F.col("g"))).alias("fp"), ((1 - F.col("p")) * F.col("g")).alias("fn")))


def evaluate(pred: DataFrame, gold: DataFrame) -> DataFrame:
    """(bucket, precision, recall, f1, support, pred_count) for all buckets and `micro`."""
    return report(count_matches(pred, gold))


def report(counts: DataFrame) -> DataFrame:
    """evaluate's rows of counts(bucket, tp, fp, fn) of all buckets."""
    summed = counts.rollup("bucket").agg(*(F.sum(c).alias(c) for c in ("tp", "fp", "fn"))).withColumn("bucket", F.coalesce("bucket", F.lit("micro")))
    return scores(summed).select("bucket", "precision", "recall", "f1", "support", "pred_count")


def trainer_metric(probs: DataFrame, gold: DataFrame) -> DataFrame:
    """One row for a training loop: f1, precision, recall, and f1_<bucket> of every bucket, by best labels without thresholds.

    probs: tokens (record_id, tok_idx, c0, c1, probs) of the cleaned texts; gold: spans in their coordinates.
    """
    return trainer_row(evaluate(bio_decode(probs.withColumn("label_id", best_label(F.col("probs")))), gold))


def trainer_row(report: DataFrame) -> DataFrame:
    """trainer_metric's row of a report."""
    of = lambda b, c: F.max(F.when(F.col("bucket") == b, F.col(c)))
    return report.agg(*(of("micro", c).alias(c) for c in ("f1", "precision", "recall")), *(of(b, "f1").alias(f"f1_{b}") for b in BUCKETS))


def macro_f1(report: DataFrame) -> DataFrame:
    """Mean F1 of the buckets with support; 0 where none has any."""
    return report.filter("bucket <> 'micro'").agg(F.coalesce(F.avg(F.when(F.col("support") > 0, F.col("f1"))), F.lit(0.0)).alias("macro_f1"))


def label_support(gold: DataFrame, labels: DataFrame) -> DataFrame:
    """(label, support) of every label; gold spans count for their B- label."""
    name = F.concat(F.lit("B-"), F.when(F.col("polarity") == "NEG", "NEG_").otherwise(""), "type")
    sums = gold.groupBy(name.alias("label")).agg(F.count("*").alias("support"))
    return labels.select("label").join(sums, "label", "left").fillna(0)


def objective(name: str, precision_floor: float = 0.0, recall_floor: float = 0.0) -> Column:
    """The objective as a column over the micro scores, macro_f1 and the map f1_by_bucket."""
    if name == "f1_micro":
        return F.col("f1")
    if name == "f1_macro":
        return F.col("macro_f1")
    if name.startswith("f1_per_type:"):
        return F.coalesce(F.try_element_at("f1_by_bucket", F.lit(name.partition(":")[2])), F.lit(0.0))
    if name == "max_f1_at_precision_floor":
        return F.when(F.col("precision") >= precision_floor, F.col("f1")).otherwise(-1.0)
    if name == "max_f1_at_recall_floor":
        return F.when(F.col("recall") >= recall_floor, F.col("f1")).otherwise(-1.0)
    raise ValueError(f"unknown objective {name!r}")


def grid(step: float = 0.01) -> list[float]:
    n = round(1 / step)
    return [k * (1 - step) / (n - 1) if n > 1 else 0.0 for k in range(n)]


def gate_inputs(probs: DataFrame, gold: DataFrame) -> DataFrame:
    """One row a record: its tokens whose best label is not O, in order, and its gold spans.

    Only these tokens can change with thresholds; breaks says whether an O token stands in front. kind counts
    the buckets; gold spans that no label can give have kind -1 and only add to the support of their bucket.
    """
    by = Window.partitionBy("record_id").orderBy("tok_idx")
    best = probs.filter("NOT (c0 = 0 AND c1 = 0)").select("record_id", "tok_idx", "c0", "c1", best_label(F.col("probs")).alias("label_id"), F.array_max("probs").cast("float").alias("prob"))
    best = best.withColumn("breaks", F.coalesce(F.lag("label_id").over(by) == 0, F.lit(False))).filter("label_id > 0")
    tokens = best.groupBy("record_id").agg(F.array_sort(F.collect_list(F.struct("tok_idx", "c0", "c1", "label_id", "prob", "breaks"))).alias("tokens"))
    place = F.array_position(F.array(*map(F.lit, BUCKETS)), bucket_of()) - 1
    fits = (F.col("type") == "COMMODITY") | (F.col("polarity") == "POS")
    spans = gold.select("record_id", "start", "end", place.cast("int").alias("bucket"), F.when(fits, place).otherwise(-1).cast("int").alias("kind"), "polarity").filter("bucket >= 0")
    spans = spans.groupBy("record_id").agg(F.collect_set(F.struct("start", "end", "bucket", "kind", "polarity")).alias("gold"))
    return tokens.join(spans, "record_id", "full")


def _segments(alive: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first, last, lo, hi) of every stretch of a run that is whole at some place of a threshold p: where lo <= p < hi.

    alive: the places before which tokens stay; begins: where runs begin, the first one at 0. A stretch is a node of the
    run's Cartesian tree and is told by the first of its least tokens, so there are no more stretches than tokens. The
    nearest lesser tokens are found in minima of 1, 2, 4... tokens, up to the longest run.
    """
    n, low = len(alive), -1
    size = np.diff(np.r_[begins, n])
    at = np.arange(n) + np.repeat(np.arange(1, len(begins) + 1), size)  # `low` stands around every run
    least = [np.full(n + len(begins) + 1, low, np.int32)]
    least[0][at] = alive
    for k in range(int(size.max()).bit_length() - 1):
        least.append(np.full(len(least[0]), low, np.int32))
        least[-1][: -(1 << k)] = np.minimum(least[-2][: -(1 << k)], least[-2][1 << k :])
    back, same, on = at.copy(), at.copy(), at + 1
    for k in range(len(least) - 1, -1, -1):
        back -= (least[k][np.maximum(back - (1 << k), 0)] >= alive) * ((back >= 1 << k) << k)
        same -= (least[k][np.maximum(same - (1 << k), 0)] > alive) * ((same >= 1 << k) << k)
        on += (least[k][np.minimum(on, len(least[k]) - 1)] >= alive).astype(np.int64) << k
    own = np.flatnonzero(back == same)
    move = own - at[own]
    lo = np.maximum(least[0][back[own] - 1], least[0][on[own]])
    return back[own] + move, on[own] - 1 + move, np.maximum(lo, 0), alive[own]


#: Tokens that are counted together; a record with more is taken by itself.
AT_ONCE = 1 << 17


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    """(tokens, gold) of some records at a time, of gate_inputs()."""
    for batch in batches:
        for part in whole.cut(batch, batch.column("tokens").value_lengths(), AT_ONCE):
            yield part.column("tokens"), part.column("gold")


def _by_place(gold: list[np.ndarray], found: list[np.ndarray], last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, group, hit) of found spans, by their columns and then by `last`: a group holds equal ones, hit says whether gold has it."""
    n = len(gold[0])
    keys = [np.concatenate([g, f]) for g, f in zip(gold, found, strict=True)]
    order = np.lexsort((np.r_[np.full(n, -1), last], *keys[::-1]))  # gold stands in front
    fresh = np.zeros(len(order), bool)
    fresh[:1] = True
    for k in keys:
        fresh[1:] |= k[order[1:]] != k[order[:-1]]
    group, mine = fresh.cumsum() - 1, order >= n
    return order[mine] - n, group[mine], (order[fresh] < n)[group[mine]]


def count_alive(inputs: DataFrame | whole.Made, values: list[float], base: list[float], label: int | None = None) -> DataFrame:
    """(bucket, cand, tp, pred, support) for thresholds `base` in which one label's (all labels') is each of the values.

    A token under its threshold is O, so a span exists for an interval of values; its ends are found
    per run, and spans are counted by adding and taking away one at them. No token is set against the
    values, nothing but the counts is shuffled.
    """
    order = np.argsort(np.array(values, np.float32), kind="stable")
    grid_, limits = np.array(values, np.float32)[order].astype(float), np.array(base, np.float32)
    n, n_kinds = len(values), len(BUCKETS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pred, tp, support = np.zeros((n_kinds, n + 1), np.int64), np.zeros((n_kinds, n + 1), np.int64), np.zeros(n_kinds, np.int64)
        for tokens, spans in _parts(batches):
            flat, told = tokens.flatten(), spans.flatten()
            field = lambda x, f: x.field(f).to_numpy(zero_copy_only=False)
            sizes, counts = (pc.fill_null(x.value_lengths(), 0).to_numpy(zero_copy_only=False) for x in (tokens, spans))
            record, owner = np.repeat(np.arange(len(sizes)), sizes), np.repeat(np.arange(len(counts)), counts)
            support += np.bincount(field(told, "bucket"), minlength=n_kinds)
            labels, probs, breaks = field(flat, "label_id"), field(flat, "prob").astype(np.float32), field(flat, "breaks").astype(bool)
            kind = (labels - 1) // 2  # labels go B, I by kind
            if label is None:
                v = probs.astype(float)
            else:
                v = np.where(labels == label, probs, np.where(probs < limits[labels], -np.inf, np.inf)).astype(float)
            if not len(v):
                continue
            fresh = (labels % 2 == 1) | breaks | np.r_[True, (kind[1:] != kind[:-1]) | (record[1:] != record[:-1])]
            first, last, a, b = _segments(np.searchsorted(grid_, v, "right"), np.flatnonzero(fresh))
            some = np.flatnonzero(a < b)
            first, last, a, b = first[some], last[some], a[some], b[some]
            gold = [owner, *(field(told, c) for c in ("start", "end", "kind"))]
            at, group, hit = _by_place(gold, [record[first], field(flat, "c0")[first], field(flat, "c1")[last], kind[first]], a)
            if not len(at):
                continue
            # equal spans overlap only where tokens share their place: each adds what those before it leave
            held = np.maximum.accumulate(b[at] + group * (n + 1))
            a = np.maximum(a[at], np.r_[0, held[:-1]] - group * (n + 1))
            b, where = b[at], kind[first[at]] * (n + 1)
            for sums, own in ((pred, a < b), (tp, (a < b) & hit)):
                size = sums.size
                sums += (np.bincount((where + a)[own], minlength=size) - np.bincount((where + b)[own], minlength=size)).reshape(sums.shape)
        cand = np.tile(order, n_kinds)
        bucket = np.repeat(np.arange(n_kinds), n)
        columns = [bucket, cand, tp.cumsum(1)[:, :n].ravel(), pred.cumsum(1)[:, :n].ravel(), np.repeat(support, n)]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=["bucket", "cand", "tp", "pred", "support"])

    sums = inputs.mapInArrow(count, "bucket bigint, cand bigint, tp bigint, pred bigint, support bigint")
    return sums.groupBy("bucket", "cand").agg(*(F.sum(c).alias(c) for c in ("tp", "pred", "support")))


def curve(inputs: DataFrame | whole.Made, values: list[float], name: str, base: list[float] | None = None, label: int | None = None, **floors: float) -> DataFrame:
    """Scores for each of the values as the threshold of one label (of all labels), over gate_inputs()."""
    counts = count_alive(inputs, values, base or [0.0] * len(LABELS), label)
    named = F.get(F.array(*map(F.lit, BUCKETS)), F.col("bucket").cast("int"))
    rows = scores(counts.select(F.col("cand").cast("int").alias("cand"), named.alias("bucket"), "tp", (F.col("pred") - F.col("tp")).alias("fp"), (F.col("support") - F.col("tp")).alias("fn")))
    rows = rows.groupBy("cand").agg(
        *(F.sum(c).alias(c) for c in ("tp", "fp", "fn")),
        F.map_from_entries(F.collect_list(F.struct("bucket", "f1"))).alias("f1_by_bucket"),  # five buckets
        F.coalesce(F.avg(F.when(F.col("support") > 0, F.col("f1"))), F.lit(0.0)).alias("macro_f1"),
    )
    return scores(rows).withColumn("objective", objective(name, **floors)).select("cand", "f1", "precision", "recall", "objective")


def gate_table(inputs: DataFrame | whole.Made, values: list[float]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(tp, pred, support, supported) of every pair of thresholds of a kind, from one pass over gate_inputs().

    A run holds labels of one kind, a B- label at its head at most and I- labels behind it, so what is found of a kind
    depends on the thresholds of these two labels alone: tp and pred are [kind, B- value, I- value]. A span exists for
    a rectangle of the two, and adds one at its corners. What comes to the driver is one row for each kind and pair of
    values at most. support counts gold spans by bucket, supported those that a label of the kind can give.
    """
    n, n_kinds = len(values), len(BUCKETS)
    limits = np.array(values, np.float32)
    assert (np.diff(limits) > 0).all() or n == 1, "values must rise"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, n_kinds, n + 1, n + 1), np.int64)  # tp, pred
        gold_sums = np.zeros((2, n_kinds), np.int64)
        for tokens, spans in _parts(batches):
            flat, told = tokens.flatten(), spans.flatten()
            field = lambda x, f: x.field(f).to_numpy(zero_copy_only=False)
            sizes, counts = (pc.fill_null(x.value_lengths(), 0).to_numpy(zero_copy_only=False) for x in (tokens, spans))
            record, owner = np.repeat(np.arange(len(sizes)), sizes), np.repeat(np.arange(len(counts)), counts)
            gold_kind = field(told, "kind")
            gold_sums += [np.bincount(field(told, "bucket"), minlength=n_kinds), np.bincount(gold_kind[gold_kind >= 0], minlength=n_kinds)]
            labels, breaks = field(flat, "label_id"), field(flat, "breaks").astype(bool)
            if not len(labels):
                continue
            alive = np.searchsorted(limits, field(flat, "prob").astype(np.float32), "right")  # for values before this place
            kind = (labels - 1) // 2
            fresh = (labels % 2 == 1) | breaks | np.r_[True, (kind[1:] != kind[:-1]) | (record[1:] != record[:-1])]
            head = fresh & (labels % 2 == 1)
            heads, tail = np.flatnonzero(head), np.flatnonzero(~head)
            follows = np.r_[~fresh[1:], False][heads]
            areas = [(heads, heads, 0, alive[heads], np.where(follows, np.r_[alive[1:], 0][heads], 0), n)]
            if len(tail):
                starts = fresh[tail] | np.r_[True, head[tail[1:] - 1]]
                x, y, lo, hi = _segments(alive[tail], np.flatnonzero(starts))
                first, last = tail[x], tail[y]
                behind = starts[x] & ~fresh[first]  # a head: alone where the head is gone, else together
                k = np.where(behind, alive[first - 1], 0)
                areas += [(first, last, k, n, lo, hi), (first - 1, last, 0, k, lo, hi)]  # k is 0 without a head
            first, last, b0, b1, i0, i1 = (np.concatenate(c) for c in zip(*(np.broadcast_arrays(*x) for x in areas), strict=True))
            some = np.flatnonzero((b0 < b1) & (i0 < i1))
            first, last, b0, b1, i0, i1 = (c[some] for c in (first, last, b0, b1, i0, i1))
            gold = [owner, *(field(told, c) for c in ("start", "end", "kind"))]
            at, group, hit = _by_place(gold, [record[first], field(flat, "c0")[first], field(flat, "c1")[last], kind[first]], b0)
            if not len(at):
                continue
            where, b0, b1, i0, i1 = (c[at] for c in (kind[first] * (n + 1), b0, b1, i0, i1))
            begins = np.r_[True, group[1:] != group[:-1]]
            alone = begins & np.r_[begins[1:], True]
            for side, own in zip(sums, (alone & hit, alone), strict=True):
                corner = lambda b, i, own=own, where=where: np.bincount(((where + b) * (n + 1) + i)[own], minlength=sums[0].size)
                side += (corner(b0, i0) - corner(b0, i1) - corner(b1, i0) + corner(b1, i1)).reshape(side.shape)
            several = np.flatnonzero(~alone)
            for own in np.split(several, np.flatnonzero(begins[several])[1:]) if len(several) else ():
                for side in sums if hit[own[0]] else sums[1:]:
                    _add(side[where[own[0]] // (n + 1)], [(b0[j], b1[j], i0[j], i1[j]) for j in own])
        at = np.nonzero(sums.any(0))
        rows = [np.concatenate([x, y]) for x, y in zip((*at, sums[0][at], sums[1][at]), (np.arange(n_kinds), np.full(n_kinds, -1), np.full(n_kinds, -1), *gold_sums), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(r.astype(np.int64)) for r in rows], names=["kind", "b", "i", "x", "y"])

    told = inputs.mapInArrow(count, "kind bigint, b bigint, i bigint, x bigint, y bigint")
    rows = told.groupBy("kind", "b", "i").agg(F.sum("x").alias("x"), F.sum("y").alias("y")).toArrow()
    kind, b, i, x, y = (rows[c].to_numpy() for c in ("kind", "b", "i", "x", "y"))
    sums, by_kind = np.zeros((2, n_kinds, n + 1, n + 1), np.int64), np.zeros((2, n_kinds), np.int64)
    cell = b >= 0
    sums[0][kind[cell], b[cell], i[cell]], sums[1][kind[cell], b[cell], i[cell]] = x[cell], y[cell]
    by_kind[0][kind[~cell]], by_kind[1][kind[~cell]] = x[~cell], y[~cell]
    tp, pred = sums.cumsum(2).cumsum(3)[:, :, :n, :n]
    return tp, pred, by_kind[0], by_kind[1]


def _add(sums: np.ndarray, areas: list[tuple[int, int, int, int]]) -> None:
    """Adds one, as differences along both axes, where any of the rectangles is; several are of one span only where tokens share their place."""
    n = len(sums) - 1
    held = np.zeros((n + 2, n + 2), np.int64)
    for b0, b1, i0, i1 in areas:
        held[b0 + 1 : b1 + 1, i0 + 1 : i1 + 1] = 1
    sums += np.diff(np.diff(held, axis=0), axis=1)


@dataclass
class Sweep:
    """What the threshold search found."""

    thresholds: dict[str, float]
    score: float
    feasible: bool
    curve: DataFrame
    notes: list[str] = field(default_factory=list)


def _measured(tp: np.ndarray, pred: np.ndarray, support: np.ndarray, name: str, precision_floor: float = 0.0, recall_floor: float = 0.0) -> np.ndarray:
    """(f1, precision, recall, objective) of candidates in columns; tp and pred are [kind, candidate]."""

    def shares(tp: np.ndarray, pred: np.ndarray, support: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        share = lambda a, b: np.divide(a, b, out=np.zeros(np.broadcast(a, b).shape), where=b > 0)
        p, r = share(tp.astype(float), pred.astype(float)), share(tp.astype(float), np.broadcast_to(support, tp.shape).astype(float))
        return share(2 * p * r, p + r), p, r

    f1, p, r = shares(tp.sum(0), pred.sum(0), support.sum())
    each = shares(tp, pred, support[:, None])[0]
    if name == "f1_micro":
        goal = f1
    elif name == "f1_macro":
        goal = each[support > 0].mean(0) if (support > 0).any() else np.zeros(len(f1))
    elif name.startswith("f1_per_type:"):
        of = name.partition(":")[2]
        goal = each[BUCKETS.index(of)] if of in BUCKETS else np.zeros(len(f1))
    elif name == "max_f1_at_precision_floor":
        goal = np.where(p >= precision_floor, f1, -1.0)
    elif name == "max_f1_at_recall_floor":
        goal = np.where(r >= recall_floor, f1, -1.0)
    else:
        raise ValueError(f"unknown objective {name!r}")
    return np.stack([f1, p, r, goal])


def best_global(inputs: DataFrame | whole.Made, names: tuple[str, ...], step: float = 0.01, **floors: float) -> DataFrame:
    """(name, cand, objective): the first best single threshold for each objective, over gate_inputs()."""
    values = grid(step)
    tp, pred, support, _ = gate_table(inputs, values)
    same = np.arange(len(values))
    rows = []
    for name in names:
        goal = np.round(_measured(tp[:, same, same], pred[:, same, same], support, name, **floors)[3], 9)
        rows.append((name, int(goal.argmax()), float(goal.max())))
    return inputs.sparkSession.createDataFrame(rows, "name string, cand int, objective double")


def sweep(probs: DataFrame, gold: DataFrame, name: str = "f1_micro", step: float = 0.01, **floors: float) -> Sweep:
    """One threshold for all labels, then label by label; the first best grid value wins, an incumbent stays on ties.

    probs: tokens (record_id, tok_idx, c0, c1, probs). One job in all: gate_table() holds the counts of every pair of
    thresholds that a kind can have, and both stages look theirs up in it.
    """
    return sweep_of(gate_inputs(probs, gold), name, step, **floors)


def sweep_of(inputs: DataFrame | whole.Made, name: str = "f1_micro", step: float = 0.01, **floors: float) -> Sweep:
    """sweep over gate_inputs()."""
    values = grid(step)
    tp, pred, support, supported = gate_table(inputs, values)
    kinds = np.arange(len(BUCKETS))
    n, n_kinds, lines, notes = len(values), len(BUCKETS), [], []
    notes += [f"{LABELS[2 * k + 1]} has no gold spans; its threshold is not informed" for k in kinds if not supported[k]]

    def run(b: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Scores of candidates in columns; b and i are [kind, candidate] places of values."""
        at = (kinds[:, None], b, i)
        return _measured(tp[at], pred[at], support, name, **floors)

    every = np.tile(np.arange(n), (n_kinds, 1))
    told = run(every, every)
    lines += [("global", None, values[c], *map(float, told[:, c])) for c in range(n)]
    best = int(told[3].argmax())
    score, chosen = float(told[3, best]), np.full((n_kinds, 2), best)  # places of the B- and the I- value
    if score <= -1.0:
        notes.append("no global threshold meets the objective")
    for k in range(1, len(LABELS)):
        kind, part = divmod(k - 1, 2)
        tried = np.repeat(chosen[:, :, None], n, axis=2)
        tried[kind, part] = np.arange(n)
        told = run(tried[:, 0], tried[:, 1])
        lines += [("per_label", LABELS[k], values[c], *map(float, told[:, c])) for c in range(n)]
        top = int(told[3].argmax())
        if told[3, top] > score:
            score, chosen[kind, part] = float(told[3, top]), top
    limits = {LABELS[k]: values[chosen[divmod(k - 1, 2)]] for k in range(1, len(LABELS))}
    if not any(limits.values()):
        notes.append("no threshold improves the objective")
    schema = "stage string, label string, threshold double, f1 double, precision double, recall double, objective double"
    return Sweep(limits, score, score > -1.0, inputs.sparkSession.createDataFrame(lines, schema), notes)
