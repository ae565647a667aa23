"""Byte-level BPE over a corpus: every distinct word is encoded once.

encode() splits texts into pre-tokens and lays them out in blocks of about a million. A block keeps
its sequence of word numbers (positions implied, numbers by falling frequency, entropy-coded) and
explodes its distinct words once each, packed by hash bucket: that is the map-side half of the
distinct-word shuffle. The number of buckets follows from the size of the input; each bucket is one
task, encodes each distinct word once and sends the ids back to the blocks that asked; a block then
reassembles its documents by position. No word, however frequent, has more than one entry per block, so
none is hot, and buckets are of one size. A bucket remembers up to MEMORY bytes of words and ids, then
it begins anew: a word may be encoded again, with the same ids. decode() joins ids with the token-byte
table, whose size is that of the vocabulary, on the map side.

Defined cases: null text is empty and has no ids; a null or repeated doc_id stays a row of its own;
extra columns are ignored; empty tables give empty results; decoding an id outside the table fails.
"""

from __future__ import annotations

import base64
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import cache
from itertools import count

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanweave.llm.common import release

BLOCK_WORDS = 1_000_000
#: Bytes of input for each bucket of words, and the least and largest number of buckets.
BUCKET_BYTES, LEAST_BUCKETS, MOST_BUCKETS = 8 << 20, 16, 1024
#: Bytes of words and ids that a bucket remembers.
MEMORY = 96 << 20
PACK = "block string, bucket int, doc_ids array<bigint>, ends binary, seq binary, n_seq bigint, ranks binary, lens binary, payload binary"
_NAMES = [c.split()[0] for c in PACK.split(", ")]
_TYPES = [pa.string(), pa.int32(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]


def _record(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], names=_NAMES)


@cache
def _encoding(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=read_ranks(ranks), special_tokens={})


def read_ranks(lines: bytes) -> dict[bytes, int]:
    """Token bytes and ids from lines of base64 and rank."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines.splitlines()) if a}


def _squeeze(data: bytes) -> bytes:
    return pa.Codec("zstd", compression_level=3).compress(data, asbytes=True)


def _planes(numbers: np.ndarray) -> bytes:
    """uint32 numbers as four compressed byte planes; small numbers cost a byte or less."""
    return _squeeze(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _unplaned(data: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.uint32)
    raw = pa.decompress(data, decompressed_size=4 * n, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, n).T).view("<u4").ravel()


def _sequence(ranks: np.ndarray, n_often: int) -> bytes:
    """Word numbers, compressed. Words seen once (from n_often on, numbered as they come) are all coded
    as 0, the 254 most frequent words as 1 to 254, and the numbers of the rest stand in a second list."""
    once = ranks >= n_often
    head = np.where(once, 0, np.minimum(ranks.astype(np.int64) + 1, 255)).astype(np.uint8)
    tail = _planes((ranks[head == 255] - 254).astype(np.uint32))
    first = _squeeze(head.tobytes())
    return len(first).to_bytes(4, "little") + first + tail


def _unsequence(data: bytes, n: int, n_often: int) -> np.ndarray:
    size = int.from_bytes(data[:4], "little")
    head = np.frombuffer(pa.decompress(data[4 : 4 + size], decompressed_size=n, codec="zstd", asbytes=True), np.uint8) if n else np.zeros(0, np.uint8)
    ranks = head.astype(np.int64) - 1
    once, rest = head == 0, head == 255
    ranks[once] = n_often + np.arange(once.sum())
    ranks[rest] = _unplaned(data[4 + size :], int(rest.sum())).astype(np.int64) + 254
    return ranks


def _cut(payload: bytes, lens: np.ndarray) -> Iterator[bytes]:
    ends = np.cumsum(lens.astype(np.int64)).tolist()
    return (payload[s:e] for s, e in zip([0, *ends], ends, strict=False))


def _gather(flat: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The slices flat[starts[i] : starts[i] + lens[i]], one after another."""
    shift = starts - (np.cumsum(lens) - lens)
    return flat[np.repeat(shift, lens) + np.arange(lens.sum())]


def _buckets(docs: DataFrame) -> int:
    """How many buckets the planner's size of the texts asks for; if it knows none, twice the shuffle partitions."""
    size = int(str(docs.select("text")._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= 1 << 60:
        return 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(MOST_BUCKETS, max(LEAST_BUCKETS, -(-size // BUCKET_BYTES)))


def encode(docs: DataFrame, rank_file: str, pattern: str, buckets: int | None = None, decoded: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids) for every row of docs(doc_id, text); ids: little-endian unsigned 32 bits.

    With decoded, the ids are also joined with the token-byte table, in the worker that holds them, to
    the binary column of that name.
    """
    spark = docs.sparkSession
    with open(rank_file, "rb") as f:
        sent = spark.sparkContext.broadcast(f.read())
    n_buckets = buckets or _buckets(docs)

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        find, part, k = regex.compile(pattern).findall, TaskContext.get().partitionId(), 0
        number: dict[str, int] = defaultdict(count().__next__)
        seqs: list[np.ndarray] = []
        doc_ids: list[int | None] = []

        def close() -> pa.RecordBatch:
            seq = np.concatenate(seqs)
            often = np.bincount(seq, minlength=len(number))
            order = np.argsort(-often, kind="stable")
            rank = np.empty(len(order), np.uint32)
            rank[order] = np.arange(len(order))
            n_often = int((often > 1).sum())
            words = [w.encode() for w in number]
            dealt = np.fromiter((zlib.crc32(w) % n_buckets for w in words), np.int64, len(words))
            by = order[np.argsort(dealt[order], kind="stable")]  # by bucket, then by rank
            cuts = np.searchsorted(dealt[by], np.arange(n_buckets + 1)).tolist()
            block = f"{part}-{k}"
            ends = np.cumsum([len(x) for x in seqs]).astype(np.int64)
            rows = [(block, zlib.crc32(block.encode()) % n_buckets, doc_ids, ends.tobytes(), _sequence(rank[seq], n_often), len(seq), None, n_often.to_bytes(8, "little"), None)]
            for b in range(n_buckets):
                mine = by[cuts[b] : cuts[b + 1]]
                if len(mine):
                    own = [words[i] for i in mine.tolist()]
                    lens = np.fromiter(map(len, own), np.uint32, len(own))
                    rows.append((block, b, None, None, None, None, _planes(np.diff(rank[mine], prepend=np.uint32(0))), _planes(lens), _squeeze(b"".join(own))))
            return _record([(*r[:5], len(by[cuts[r[1]] : cuts[r[1] + 1]]) if r[5] is None else r[5], *r[6:]) for r in rows])

        total = 0
        for batch in batches:
            texts = batch.column(1)
            for i, doc_id in enumerate(batch.column(0).to_pylist()):
                tokens = find(texts[i].as_py() or "")
                seqs.append(np.fromiter(map(number.__getitem__, tokens), np.uint32, len(tokens)))
                doc_ids.append(doc_id)
                total += len(tokens)
                if total >= BLOCK_WORDS or len(doc_ids) >= 100_000:
                    yield close()
                    number, seqs, doc_ids, total, k = defaultdict(count().__next__), [], [], 0, k + 1
        if doc_ids:
            yield close()
        number, seqs = defaultdict(count().__next__), []
        release()

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coded: dict[bytes, bytes] = {}
        room = 0
        one = _encoding(sent.value, pattern)._encode_single_piece  # a whole match: not split again, which fails on very long ones
        for batch in batches:
            rows = []
            for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if r[8] is None:  # a block's own row passes
                    rows.append(r)
                    continue
                found = []
                lens = _unplaned(r[7], r[5])
                words = pa.decompress(r[8], decompressed_size=int(lens.sum()), codec="zstd", asbytes=True)
                for w in _cut(words, lens):
                    if (ids := coded.get(w)) is None:
                        ids = np.array(one(w), "<u4").tobytes()
                        room += len(w) + len(ids) + 150
                        if room > MEMORY:
                            coded.clear()
                            room = 0
                        coded[w] = ids
                    found.append(ids)
                lens = np.fromiter(map(len, found), np.uint32, len(found)) // 4
                flat = np.frombuffer(b"".join(found), "<u4")
                rows.append((*r[:7], _planes(lens), _planes(flat)))
            yield _record(rows)
        coded.clear()
        release()

    def reassemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
        head = next(r for r in got if r[8] is None)
        packs = []
        for r in got:
            if r[8] is not None:
                lens = _unplaned(r[7], r[5]).astype(np.int64)
                packs.append((np.cumsum(_unplaned(r[6], r[5]), dtype=np.int64), lens, _unplaned(r[8], int(lens.sum()))))
        got.clear()
        size = np.zeros(sum(len(p[0]) for p in packs), np.int64)
        start = np.zeros_like(size)
        base = 0
        for ranks, lens, flat in packs:
            size[ranks] = lens
            start[ranks] = base + np.cumsum(lens) - lens
            base += len(flat)
        flat = np.concatenate([p[2] for p in packs]) if packs else np.zeros(0, np.uint32)
        packs.clear()
        seq, ends = _unsequence(head[4], head[5], int.from_bytes(head[7], "little")), np.frombuffer(head[3], np.int64)
        begin, rows, room = 0, [], 0
        table = _token_bytes(sent.value) if decoded else {}
        for doc_id, end in zip(head[2], ends.tolist(), strict=True):
            w = seq[begin:end]
            ids = _gather(flat, start[w], size[w]).astype("<u4")
            rows.append((doc_id, len(ids), ids.tobytes(), *([_joined(ids, table)] if decoded else [])))
            begin, room = end, room + len(ids)
            if room > 500_000:
                yield _ids(rows)
                rows, room = [], 0
        if rows:
            yield _ids(rows)
        release()

    packs = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(explode, PACK)
    coded = packs.repartitionById(n_buckets, F.col("bucket")).mapInArrow(once, PACK)
    return coded.groupBy("block").applyInArrow(reassemble, "doc_id bigint, n_tokens bigint, ids binary" + ", decoded binary" * decoded)


def _ids(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=False)]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids", "decoded"][: len(columns)])


@cache
def _token_bytes(ranks: bytes) -> dict[int, bytes]:
    return {i: b for b, i in read_ranks(ranks).items()}


def _joined(ids: np.ndarray, table: dict[int, bytes]) -> bytes:
    return b"".join(map(table.__getitem__, ids.tolist()))


def decode(tokens: DataFrame, rank_file: str) -> DataFrame:
    """tokens with the column decoded: the bytes of the binary column ids."""
    with open(rank_file, "rb") as f:
        sent = tokens.sparkSession.sparkContext.broadcast(f.read())

    @F.arrow_udf("binary")
    def look_up(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = _token_bytes(sent.value)
        for ids in batches:
            yield pa.array([_joined(np.frombuffer(x or b"", "<u4"), table) for x in ids.to_pylist()], pa.binary())
        release()

    return tokens.withColumn("decoded", look_up("ids"))
