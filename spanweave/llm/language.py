"""Language identification as a mixture: a document's language proportions by expectation-maximisation.

Training counts hashed byte trigrams by language on a sample of labelled documents, at most about
SAMPLE documents a language, drawn by a hash of their ids. A word's likelihood in a language is the
product over its trigrams; EM over the words gives a document's proportions. EM goes on until no
proportion moves by TOLERANCE or more (MOST_ROUNDS at most). The nested sets of the document's most
frequent languages are each fitted again by EM, and the one with the best penalised likelihood is its
language set: log-likelihood less half the logarithm of the number of words for each language beyond
the first (BIC), less RELUCTANCE for each, the prior log-odds against a further language. The largest
proportion is the prediction.

Defined cases: null text and text without a letter are `und` with score 0; with no labelled row all
texts are; a null lang teaches nothing; null and repeated doc_id stay rows of their own; extra columns
are ignored; ties go to the first language in alphabetical order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanweave.llm.common import release

#: Expected number of training documents of each language.
SAMPLE = 1500
SLOTS = 1 << 16
#: Bytes of text that are worked on at once.
CHUNK = 2_000_000
#: EM ends when no proportion of a document moves by as much, or after so many rounds.
TOLERANCE, MOST_ROUNDS = 1e-3, 200
#: Log-odds against each language beyond the first, beside BIC.
RELUCTANCE = 3.0
LETTER = regex.compile(r"\p{L}")
#: Letters and all bytes of 0x80 and above stay, the rest turns into spaces.
LETTER_BYTES = bytes(c if 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def _plain(text: str) -> bytes:
    return b" ".join(text.lower().encode().translate(LETTER_BYTES).split())


def _grams(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the trigrams around each letter of text, which starts and ends with a space; word starts among them."""
    b = np.frombuffer(text, np.uint8)
    at = np.flatnonzero(b != 32)
    code = (b[at - 1].astype(np.uint32) << 16) | (b[at].astype(np.uint32) << 8) | b[at + 1]
    return ((code * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64), np.flatnonzero(b[at - 1] == 32)


def train(docs: DataFrame, learn: Column, sample: int = SAMPLE) -> dict:
    """The model from docs(doc_id, text, lang) where learn holds: languages and a SLOTS x languages table of log-likelihoods."""
    rows = docs.select("doc_id", "text", "lang").filter(learn & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return {"langs": [], "table": np.zeros((SLOTS, 0), np.float32)}
    rate = F.coalesce(*[F.when(F.col("lang") == k, min(1.0, sample / n)) for k, n in sizes.items()])
    drawn = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < rate * 1_000_003)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                slots, _ = _grams(b" " + _plain(text) + b" ")
                seen[lang] = seen.get(lang, 0) + np.bincount(slots, minlength=SLOTS)
        for lang, n in seen.items():
            used = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used, pa.int64()), pa.array(n[used], pa.int64())], names=["lang", "slot", "n"])
        release()

    counted = drawn.select("text", "lang").mapInArrow(tally, "lang string, slot bigint, n bigint").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(sizes)
    counts = np.full((SLOTS, len(langs)), 0.5)
    counts[counted.slot.to_numpy(), np.searchsorted(langs, counted.lang.to_numpy(dtype=str))] += counted.n.to_numpy()
    return {"langs": langs, "table": np.log(counts / counts.sum(0)).astype(np.float32)}


def _proportions(like: np.ndarray, n: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Proportions of each text by EM from the given ones; a language at zero stays out. n: words of each text, in order in like."""
    share = share.copy()
    active = np.arange(len(n))
    for _ in range(MOST_ROUNDS):
        w = like * np.repeat(share[active], n[active], axis=0)
        w /= np.maximum(w.sum(1, keepdims=True), 1e-300)
        new = np.add.reduceat(w, np.cumsum(n[active]) - n[active], axis=0) / n[active, None]
        moving = np.abs(new - share[active]).max(1) >= TOLERANCE
        share[active] = new
        if not moving.any():
            break
        like = like[np.repeat(moving, n[active])]
        active = active[moving]
    return share


def _mixtures(texts: list[bytes], table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Proportions, size of the language set and confidence of each text; texts have a word each."""
    langs = table.shape[1]
    slots, starts = _grams(b" " + b" ".join(texts) + b" ")
    ll = np.add.reduceat(table[slots], starts, axis=0).astype(np.float64)
    n = np.array([t.count(b" ") + 1 for t in texts])
    doc = np.cumsum(n) - n
    peak = ll.max(1)
    like = np.exp(ll - peak[:, None])
    share = _proportions(like, n, np.full((len(texts), langs), 1.0 / langs))
    order = np.argsort(-share, axis=1, kind="stable")
    best = np.full(len(texts), -np.inf)
    chosen, sets = share, np.ones(len(texts), np.int64)
    for size in range(1, langs + 1):
        part = np.zeros_like(share)
        np.put_along_axis(part, order[:, :size], np.maximum(np.take_along_axis(share, order[:, :size], 1), 1e-9), 1)
        part /= part.sum(1, keepdims=True)
        if 1 < size < langs:
            part = _proportions(like, n, part)
        fit = np.add.reduceat(np.log(np.maximum((like * np.repeat(part, n, axis=0)).sum(1), 1e-300)) + peak, doc)
        value = fit - (size - 1) * (0.5 * np.log(n + 1) + RELUCTANCE)
        better = value > best
        chosen = np.where(better[:, None], part, chosen)
        sets, best = np.where(better, size, sets), np.maximum(best, value)
    alone = np.sort(np.add.reduceat(ll, doc, axis=0), axis=1)
    gap = alone[:, -1] - alone[:, -2] if langs > 1 else np.full(len(texts), np.inf)
    return chosen, sets, 1 / (1 + np.exp(-np.minimum(gap, 50)))


def predict(model: dict, spark):
    """A column function text -> struct(lang_pred, score, share, lang_set)."""
    sent = spark.sparkContext.broadcast(model)
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("share", pa.float64()), ("lang_set", pa.string())])

    @F.arrow_udf("lang_pred string, score double, share double, lang_set string")
    def infer(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        langs, table = sent.value["langs"], sent.value["table"]
        for batch in batches:
            out: list[tuple] = [("und", 0.0, 0.0, "und")] * len(batch)
            wait: list[tuple[int, bytes]] = []
            room = 0

            def flush() -> None:
                shares, sets, sure = _mixtures([t for _, t in wait], table)
                order = np.argsort(-shares, axis=1, kind="stable")
                for r, (k, _) in enumerate(wait):
                    top = float(shares[r, order[r, 0]])
                    score = top * float(sure[r]) if sets[r] == 1 else top
                    out[k] = (langs[order[r, 0]], score, top, ",".join(sorted(langs[j] for j in order[r, : sets[r]])))
                wait.clear()

            for k in range(len(batch)):
                text = batch[k].as_py()
                if text is None or not langs or not LETTER.search(text):
                    continue
                plain = _plain(text)
                wait.append((k, plain))
                room += len(plain)
                if room >= CHUNK:
                    flush()
                    room = 0
            if wait:
                flush()
            yield pa.StructArray.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), kind, strict=True)] if out else [pa.array([], t.type) for t in kind], fields=list(kind))
        release()

    return infer
