"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics of a text come from its byte counts and words, never from its label, language, source
or id. The trees are trained on a bounded sample of labelled rows (``most_rows``, the smallest hashes
of doc_id, so the same rows each time): features are put into quantile bins, gradients are summed
per bin and node, and each tree grows level by level. The trained trees are perfect binary trees
flattened into arrays, which numpy walks for a whole batch at once. Scoring is one pass without
a shuffle.

Defined cases: null and empty texts have all statistics 0 and are scored like others; labels that
are null, or of unknown documents, teach nothing; a document labelled twice counts with its
smaller label; without labels of both kinds the score is the share of label 1, or 1 without any
label; where texts share a labelled doc_id the one with the smallest hash teaches; repeated rows are scored each; an empty table
gives none; texts are read whole, however long. The score is put beside the documents' columns, so a column ``score`` of theirs is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsebar.llm.common import give_back, text_of

MOST_ROWS = 20_000
FOLDS = 5
CUT = 0.3
_MARKS = ["*&$%#@^~", "|", "!", "?", ".", ",", ";:", "<>{}[]()\\=_/", "-'\"", "\n", " "]
_GROUPS = np.zeros((len(_MARKS) + 4, 256))
for _k, _chars in enumerate(_MARKS):
    _GROUPS[_k, list(_chars.encode())] = 1
_GROUPS[-4, 65:91] = _GROUPS[-3, 97:123] = _GROUPS[-2, 48:58] = _GROUPS[-1, 128:] = 1


def statistics(text: str | None) -> np.ndarray:
    """Length, shares of character groups, and how long, varied and repeated the words are."""
    return statistics_of_bytes((text or "").encode("utf-8", "surrogatepass"))


def statistics_of_bytes(raw: bytes) -> np.ndarray:
    """The same of a text in UTF-8."""
    words = raw.split()
    out = np.zeros(len(_GROUPS) + 7)
    if not words:
        return out
    shares = _GROUPS @ np.bincount(np.frombuffer(raw, np.uint8), minlength=256) / len(raw)
    lines = raw.split(b"\n")
    n = len(words)
    out[: len(shares)] = shares
    out[len(shares) :] = (
        np.log1p(n), len(raw) / n, len(set(words)) / n, sum(map(eq, words, words[1:])) / n,
        len(set(lines)) / len(lines), np.log1p(len(raw) / len(lines)), sum(map(bytes.isupper, words)) / n,
    )
    return out


def statistics_of(texts: pa.Array) -> np.ndarray:
    """Statistics of a batch, a row each; its texts are looked at one by one where they lie."""
    out = np.zeros((len(texts), len(_GROUPS) + 7))
    for place, text in enumerate(texts):
        if text.is_valid:
            out[place] = statistics_of_bytes(text.as_buffer().to_pybytes())
    return out


@dataclass
class Trees:
    """Perfect trees of one depth as arrays: node k of a tree has children 2k+1 and 2k+2."""

    start: float
    feature: np.ndarray  # (trees, inner nodes)
    above: np.ndarray  # go right if the feature is larger
    leaf: np.ndarray  # (trees, leaves)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, above, leaf in zip(self.feature, self.above, self.leaf):
            node = np.zeros(len(x), np.int64)
            while inner and len(node) and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > above[node])
            total += leaf[node - inner]
        return 1 / (1 + np.exp(-total))


def train(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 4, rate: float = 0.2, bins: int = 64, least: float = 0.2) -> Trees:
    """Boosted trees for the logistic loss; ``least`` is the smallest sum of weights either side of a split may have."""
    inner, leaves = 2**depth - 1, 2**depth
    share = y.mean() if len(y) else 1.0
    start = float(np.log(np.clip(share, 1e-6, 1 - 1e-6) / (1 - np.clip(share, 1e-6, 1 - 1e-6))))
    if share in (0.0, 1.0):
        return Trees(start, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    offset = np.arange(width) * bins
    total = np.full(n, start)
    out_feature, out_above, out_leaf = [], [], []
    for _ in range(trees):
        chance = 1 / (1 + np.exp(-total))
        slope, weight = y - chance, chance * (1 - chance)
        feature, above = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            place = ((node - first)[:, None] * width * bins + offset + binned).ravel()
            shape = (count, width, bins)
            g, h = (
                np.bincount(place, np.repeat(w, width), count * width * bins).reshape(shape).cumsum(axis=2)
                for w in (slope, weight)
            )
            whole_g, whole_h = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + 1) + (whole_g - g) ** 2 / (whole_h - h + 1) - whole_g**2 / (whole_h + 1)
            gain[(h < least) | (whole_h - h < least)] = 0
            for k in range(count):
                f, b = divmod(int(gain[k].argmax()), bins)
                if gain[k, f, b] > 1e-6 and b < len(edges[f]):
                    feature[first + k], above[first + k] = f, edges[f][b]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > above[node])
        at = node - inner
        leaf = rate * np.bincount(at, slope, leaves) / (np.bincount(at, weight, leaves) + 1)
        total += leaf[at]
        out_feature.append(feature), out_above.append(above), out_leaf.append(leaf)
    return Trees(start, np.stack(out_feature), np.stack(out_above), np.stack(out_leaf))


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def fit(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS) -> Trees:
    """Trees trained on at most ``most_rows`` labelled rows outside the held-out fold."""
    known = labels.where("quality IN (0, 1)").where(fold(F.col("doc_id")) != 0)
    known = known.groupBy(F.col("doc_id").alias("labelled")).agg(F.min("quality").alias("quality"))
    sample = known.orderBy(F.xxhash64("labelled"), "labelled").limit(most_rows)  # the documented bound

    @F.arrow_udf("array<double>")
    def stats(texts: pa.Array) -> pa.Array:
        made = pa.array(list(statistics_of(texts)), pa.list_(pa.float64()))
        give_back()
        return made

    taught = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("labelled"))
    taught = taught.select("labelled", "quality", F.xxhash64(text_of()).alias("hash"), stats(text_of()).alias("x"))
    first = F.min(F.struct("hash", "x")).alias("first")
    rows = taught.groupBy("labelled", "quality").agg(first).select("labelled", "quality", "first.x").toPandas().sort_values("labelled")
    x = np.stack(rows["x"].to_list()) if len(rows) else np.zeros((0, len(_GROUPS) + 7))
    return train(x, rows["quality"].to_numpy(float))


def score(docs: DataFrame, trees: Trees) -> DataFrame:
    """The documents with ``score``, the chance of label 1."""

    @F.arrow_udf("double")
    def chance(texts: pa.Array) -> pa.Array:
        made = pa.array(trees.score(statistics_of(texts)), pa.float64())
        give_back()
        return made

    return docs.withColumn("score", chance(text_of()))
