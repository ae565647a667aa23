"""Tokens, labels and spans of whole records, as flat arrays within a task.

A record's tokens and spans are made from its text alone, so nothing is dealt, sorted or joined: Spark deals the
texts, each task takes them in pieces of about PIECE bytes (a record is never cut), and only what a query returns
leaves it. The rows are those of operators/tokens.py and of evaluate.count_matches.

Tables here are dicts of equally long numpy arrays. `owner` is the place of the record in its piece, and rows are in
the order of owner and place; spans have start, end and kind (the place in schema.BUCKETS).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from spanweave.schema import BUCKETS, IGNORED, LABELS

#: Bytes of text that are worked on at once; a longer text is taken by itself.
PIECE = 1 << 20
#: By kind, which is (label - 1) // 2.
TYPES = pa.array([b.partition("(")[0] for b in BUCKETS])
POLARITY = pa.array(["NEG" if b.endswith("(NEG)") else "POS" for b in BUCKETS])
Table = dict[str, np.ndarray]


class Piece:
    """Some records(record_id, text): ids, text bytes with the records' bounds, and how many characters are before each byte."""

    def __init__(self, batch: pa.RecordBatch):
        self.ids = batch.column(0).to_numpy(zero_copy_only=False)
        texts = batch.column(1).cast(pa.large_string()).fill_null("")
        _, ends, data = texts.buffers()
        self.ends = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        low, high = int(self.ends[0]), int(self.ends[-1])
        self.data = np.frombuffer(data, np.uint8)[low:high] if high > low else np.zeros(0, np.uint8)
        self.ends = self.ends - low
        self.before = np.concatenate([[0], np.cumsum((self.data & 0xC0) != 0x80)])

    def tokens(self) -> Table:
        """whitespace_tokens: owner, tok_idx, c0, c1, and from, to in bytes."""
        space = self.data == 0x20
        bound = np.zeros(len(space) + 1, bool)
        bound[self.ends] = True
        begins = np.flatnonzero(~space & (bound[:-1] | np.concatenate([[True], space])[:-1]))
        ends = np.flatnonzero(~space & (bound[1:] | np.concatenate([space, [True]])[1:])) + 1
        owner = np.searchsorted(self.ends, begins, "right") - 1
        first = self.ends[owner]
        spaces = np.concatenate([[0], np.cumsum(space)])
        chars = self.before[first]
        return {"owner": owner, "tok_idx": spaces[begins] - spaces[first], "c0": self.before[begins] - chars, "c1": self.before[ends] - chars, "from": begins, "to": ends}

    def texts(self, first: np.ndarray, end: np.ndarray) -> pa.Array:
        """The texts between bytes."""
        size = end - first
        ends = np.concatenate([[0], np.cumsum(size)])
        at = np.arange(ends[-1]) + np.repeat(first - ends[:-1], size)
        return pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(self.data[at])).cast(pa.string())


def cut(batch: pa.RecordBatch, sizes: pa.Array, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of rows whose sizes add up to `most` at most; a larger row is taken by itself."""
    ends = np.cumsum(pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
        yield batch.slice(at, to - at)
        at = to


@dataclass(frozen=True)
class Made:
    """f over all pieces of records(record_id, text), not made yet: what comes next can be done in the same task."""

    records: DataFrame
    f: Callable[[Piece], Iterator[pa.RecordBatch]]

    @property
    def sparkSession(self):  # noqa: N802
        return self.records.sparkSession

    def mapInArrow(self, then: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:  # noqa: N802
        """then over what f gives, piece by piece, in one Python worker."""
        f = self.f

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from then(made for b in batches for piece in cut(b, pc.binary_length(b.column(1)), PIECE) for made in f(Piece(piece)))

        return self.records.select("record_id", "text").mapInArrow(run, schema)


def over(records: DataFrame, f: Callable[[Piece], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """f over all pieces of records(record_id, text)."""
    return Made(records, f).mapInArrow(lambda made: made, schema)


def take(t: Table, at: np.ndarray) -> Table:
    return {k: v[at] for k, v in t.items()}


def runs(tokens: Table, k: np.ndarray) -> Table:
    """Runs of neighbouring tokens of a record with equal k: owner, start, end, k, and from, to in bytes."""
    if not len(k):
        return {c: np.zeros(0, np.int64) for c in ("owner", "start", "end", "k", "from", "to")}
    owner = tokens["owner"]
    first = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | (owner[1:] != owner[:-1])])
    last = np.r_[first[1:], len(k)] - 1
    return {"owner": owner[first], "start": tokens["c0"][first], "end": tokens["c1"][last], "k": k[first], "from": tokens["from"][first], "to": tokens["to"][last]}


def encode(tokens: Table, spans: Table) -> np.ndarray:
    """bio_encode: the label of each token. A token of two spans takes the later-starting one; (0, 0) tokens are ignored."""
    c0, c1, owner = tokens["c0"], tokens["c1"], tokens["owner"]
    out = np.zeros(len(c0), np.int64)
    own = np.flatnonzero((c0 != 0) | (c1 != 0))
    out[(c0 == 0) & (c1 == 0)] = IGNORED
    if not len(own) or not len(spans["start"]):
        return out
    # greatest (start, end, type, polarity) last; POS and NEG differ for one type only
    rank = np.searchsorted(np.sort(TYPES.to_numpy(zero_copy_only=False)), TYPES.to_numpy(zero_copy_only=False))[spans["kind"]] * 2 + (POLARITY.to_numpy(zero_copy_only=False)[spans["kind"]] == "POS")
    s = take(spans, np.lexsort((rank, spans["end"], spans["start"], spans["owner"])))
    s = take(s, np.flatnonzero(s["end"] > 0))
    wide = int(max(c1.max(), s["end"].max(), s["start"].max())) + 2
    first = np.searchsorted(owner[own] * wide + c1[own], s["owner"] * wide + np.maximum(s["start"], -1), "right")
    end = np.searchsorted(owner[own] * wide + c0[own], s["owner"] * wide + s["end"], "left")
    size = np.maximum(end - first, 0)
    starts = np.cumsum(size) - size
    at = np.arange(size.sum()) + np.repeat(first - starts, size)
    label = np.repeat(s["kind"] * 2 + 2, size)
    label[starts[size > 0]] -= 1
    out[own[at]] = label  # the last one of several stays
    return out


def decode(tokens: Table, labels: np.ndarray, strict: bool = False) -> Table:
    """bio_decode: spans owner, start, end, kind. Unknown labels are O, ignored and (0, 0) tokens are passed over."""
    own = np.flatnonzero((labels != IGNORED) & ((tokens["c0"] != 0) | (tokens["c1"] != 0)))
    label, owner = labels[own], tokens["owner"][own]
    label = np.where((label > 0) & (label < len(LABELS)), label, 0)
    kind = np.where(label > 0, (label - 1) // 2, -1)
    named = np.flatnonzero(label > 0)
    if not len(named):
        return {c: np.zeros(0, np.int64) for c in ("owner", "start", "end", "kind")}
    opens = (label % 2 == 1) | np.r_[True, (kind[1:] != kind[:-1]) | (owner[1:] != owner[:-1])]
    first = np.flatnonzero(opens[named])
    at = own[named]
    made = {"owner": owner[named][first], "start": np.minimum.reduceat(tokens["c0"][at], first), "end": np.maximum.reduceat(tokens["c1"][at], first), "kind": kind[named][first]}
    return take(made, np.flatnonzero(label[named][first] % 2 == 1)) if strict else made


def gate(probs: np.ndarray, thresholds: list[float]) -> np.ndarray:
    """gated_label of rows of probabilities: the first best label, or O where another one stays below its threshold (as floats)."""
    best = probs.argmax(1)
    return np.where((best != 0) & (probs.max(1).astype(np.float32) < np.array(thresholds, np.float32)[best]), 0, best)


def counts(pred: Table, gold: Table) -> pa.RecordBatch:
    """(bucket, tp, fp, fn) of two tables of spans; equal spans of a record count once."""
    named = ("owner", "start", "end", "kind")
    keys = [np.concatenate([pred[c], gold[c]]) for c in named]
    n = len(pred["owner"])
    order = np.lexsort(keys)
    keys = [k[order] for k in keys]
    fresh = np.flatnonzero(np.r_[True, np.any([k[1:] != k[:-1] for k in keys], axis=0)]) if len(order) else np.zeros(0, np.int64)
    in_pred = np.logical_or.reduceat(order < n, fresh) if len(fresh) else np.zeros(0, bool)
    in_gold = np.logical_or.reduceat(order >= n, fresh) if len(fresh) else np.zeros(0, bool)
    kind = keys[3][fresh].astype(np.int64)
    sums = [np.bincount(kind[x], minlength=len(BUCKETS)) for x in (in_pred & in_gold, in_pred & ~in_gold, in_gold & ~in_pred)]
    return pa.RecordBatch.from_arrays([pa.array(BUCKETS), *map(pa.array, sums)], names=["bucket", "tp", "fp", "fn"])


def coincidences(labels: np.ndarray, given: np.ndarray, names: tuple[str, ...]) -> pa.RecordBatch:
    """(a, b, la, lb, m, n) for panel_of_cells of labels and whether they are given, by annotator (names rise) and unit."""
    low = int(labels.min()) if labels.size else 0
    wide = (int(labels.max()) if labels.size else 0) - low + 1
    votes = given.sum(0)
    rows: list[tuple] = []
    for x in range(len(names)):
        for y in range(x + 1, len(names)):
            both = given[x] & given[y]
            code = ((labels[x][both] - low) * wide + labels[y][both] - low) * (len(names) + 1) + votes[both]
            n = np.bincount(code)
            rows += [(names[x], names[y], c // (len(names) + 1) // wide + low, c // (len(names) + 1) % wide + low, c % (len(names) + 1), int(n[c])) for c in np.flatnonzero(n).tolist()]
    columns = list(zip(*rows, strict=True)) or [[]] * 6
    kinds = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["a", "b", "la", "lb", "m", "n"])


COINCIDENCES = "a string, b string, la int, lb int, m int, n bigint"
COUNTS = "bucket string, tp bigint, fp bigint, fn bigint"
SPANS = "record_id bigint, start int, end int, type string, polarity string"


def span_rows(piece: Piece, spans: Table, **more: pa.Array) -> pa.RecordBatch:
    """SPANS, and more columns."""
    kind = pa.array(spans["kind"])
    columns = {
        "record_id": pa.array(piece.ids[spans["owner"]]), "start": pa.array(spans["start"].astype(np.int32)), "end": pa.array(spans["end"].astype(np.int32)), "type": TYPES.take(kind), "polarity": POLARITY.take(kind), **more,
    }
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def lists(owner: np.ndarray, n: int, **fields: pa.Array) -> pa.Array:
    """An array of structs for each of n records."""
    ends = np.searchsorted(owner, np.arange(n + 1), "left").astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(list(fields.values()), names=list(fields)))


#: What evaluate.gate_inputs gives.
GATE_INPUTS = (
    "record_id bigint, tokens array<struct<tok_idx:int,c0:int,c1:int,label_id:int,prob:float,breaks:boolean>>, gold array<struct<start:int,end:int,bucket:int,kind:int,polarity:string>>"
)


def gate_inputs(piece: Piece, tokens: Table, probs: np.ndarray, gold: Table) -> pa.RecordBatch:
    """evaluate.gate_inputs of spans that labels can give: a row for each record with a token that is not O or a gold span."""
    own = np.flatnonzero((tokens["c0"] != 0) | (tokens["c1"] != 0))
    best, owner = probs[own].argmax(1), tokens["owner"][own]
    breaks = np.r_[False, (best[:-1] == 0) & (owner[1:] == owner[:-1])] if len(own) else np.zeros(0, bool)
    live = np.flatnonzero(best > 0)
    t = take(tokens, own[live])
    whole = lambda x: pa.array(x.astype(np.int32))
    made = lists(
        t["owner"], len(piece.ids), tok_idx=whole(t["tok_idx"]), c0=whole(t["c0"]), c1=whole(t["c1"]), label_id=whole(best[live]), prob=pa.array(probs[own[live]].max(1).astype(np.float32)), breaks=pa.array(breaks[live])
    )
    held = lists(gold["owner"], len(piece.ids), start=whole(gold["start"]), end=whole(gold["end"]), bucket=whole(gold["kind"]), kind=whole(gold["kind"]), polarity=POLARITY.take(pa.array(gold["kind"])))
    rows = pa.RecordBatch.from_arrays([pa.array(piece.ids), made, held], names=["record_id", "tokens", "gold"])
    some = np.zeros(len(piece.ids), bool)
    some[t["owner"]] = some[gold["owner"]] = True
    return rows.filter(pa.array(some))
