"""Main text of web pages by gradient-boosted trees over DOM nodes and hierarchical decoding.

The trees give every block node the odds of being article; the page is then labelled as a whole. From
the root down a path may be outside, then kept, then dropped, never otherwise, so no ancestor and
descendant contradict each other; the labelling of least total cost is found by dynamic programming
over the tree. The model is trained on made-up pages (sample_pages), SAMPLE_PAGES of them, once: it is
stored in the shared folder under a digest of the code that makes it, and read from there afterwards.

Defined cases: null html is empty and gives empty text; a page without article gives empty text;
unclosed and stray tags are mended as browsers do in the common cases; a broken page keeps all its
text blocks in play; an unclosed tag at the end of a page is text; null and repeated keys stay rows of
their own; all columns are kept. Parsing, features and decoding are linear in the page, whatever is
nested or left unclosed. A page is one task's work: its size bounds memory.
"""

from __future__ import annotations

import hashlib
import inspect
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from spanweave.llm import boosting, dom, sample_pages
from spanweave.llm.boosting import BoostedTrees
from spanweave.llm.common import release, shared_dir
from spanweave.llm.dom import Node, features, parse
from spanweave.llm.sample_pages import page

SAMPLE_PAGES = 1500
#: Log-odds by which a change from outside to kept, or from kept to dropped, must gain.
SWITCH = 1.0
#: Nodes that are scored at once.
BATCH_NODES = 20_000


def labelled(seed: int) -> tuple[str, list[Node], list[int]]:
    """A made-up page, its nodes, and whether each is article: it begins within the article and in no part set into it."""
    before, article, after = page(seed)
    cuts, at = [], len(before)  # bounds of the article's own stretches
    for k, piece in enumerate(article.replace("\x02", "\x01").split("\x01")):
        if k % 2 == 0:
            cuts.append((at, at + len(piece)))
        at += len(piece)
    html = before + article.replace("\x01", "").replace("\x02", "") + after
    nodes, _ = parse(html)
    return html, nodes, [int(any(s <= x.at < e for s, e in cuts)) for x in nodes]


@cache
def train(pages: int = SAMPLE_PAGES) -> BoostedTrees:
    made = [labelled(seed) for seed in range(pages)]
    return BoostedTrees().fit(features([nodes for _, nodes, _ in made]), np.array([k for _, _, label in made for k in label], float))


def stored(spark: SparkSession) -> BoostedTrees:
    """The trained model from the shared folder, where the first call leaves it."""
    code = "".join(inspect.getsource(m) for m in (boosting, dom, sample_pages)) + inspect.getsource(labelled) + str(SAMPLE_PAGES)
    path = f"{shared_dir(spark)}/extraction-model-{hashlib.sha256(code.encode()).hexdigest()[:16]}"
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done):
        return BoostedTrees.from_json(spark.read.schema("model string").parquet(path).first()[0])
    model = train()
    spark.createDataFrame([(model.to_json(),)], "model string").coalesce(1).write.mode("ignore").parquet(path)
    return model


def decode(nodes: list[Node], odds: list[float]) -> list[bool]:
    """Which nodes are kept, under: outside above kept above dropped."""
    n = len(nodes)
    keep = [min(30.0, max(-30.0, x)) for x in odds]  # gain of kept over not kept
    outside, kept, cut = [0.0] * n, list(keep), [0.0] * n
    for i in range(n - 1, 0, -1):
        up = nodes[i].parent
        outside[up] += max(outside[i], kept[i] - SWITCH)
        kept[up] += max(kept[i], cut[i] - SWITCH)
    state = [0] * n
    state[0] = int(kept[0] - SWITCH > outside[0])
    for i in range(1, n):
        above = state[nodes[i].parent]
        if above == 0:
            state[i] = int(kept[i] - SWITCH > outside[i])
        elif above == 1:
            state[i] = 1 if kept[i] >= cut[i] - SWITCH else 2
        else:
            state[i] = 2
    return [s == 1 for s in state]


def text_of(keep: list[bool], leaves: list[tuple[int, int, str]]) -> str:
    """Kept leaves joined within blocks, white space made one space, blocks joined by a line feed."""
    blocks: list[str] = []
    last, parts = -1, []
    for node, block, text in leaves:
        if keep[node]:
            if block != last:
                blocks.append("".join(parts))
                last, parts = block, []
            parts.append(text)
    blocks.append("".join(parts))
    return "\n".join(t for b in blocks if (t := " ".join(b.split())))


def main_texts(pages: list[str], model: BoostedTrees) -> list[str]:
    parsed = [parse(p) for p in pages]
    odds = model.log_odds(features([nodes for nodes, _ in parsed])).tolist()
    out, at = [], 0
    for nodes, leaves in parsed:
        out.append(text_of(decode(nodes, odds[at : at + len(nodes)]), leaves))
        at += len(nodes)
    return out


def extractor(spark: SparkSession, model: BoostedTrees | None = None):
    """A column function html -> main text."""
    sent = spark.sparkContext.broadcast(model or stored(spark))

    @F.arrow_udf("string")
    def extract(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out: list[str] = []
            wait: list[str] = []
            room = 0
            for k in range(len(batch)):
                wait.append(batch[k].as_py() or "")
                room += wait[-1].count("<") + 1
                if room >= BATCH_NODES:
                    out += main_texts(wait, sent.value)
                    wait, room = [], 0
            yield pa.array(out + (main_texts(wait, sent.value) if wait else []), pa.string())
        release()

    return extract
