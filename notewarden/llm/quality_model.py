"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of whole texts are computed in Arrow batches.  Trees are fitted on a bounded sample of
labelled documents (``sample_rows``, chosen by a hash of the id; only their statistics reach the
driver), on ``BINS`` quantile bins of each statistic with logistic loss.  The fitted trees are flattened
into arrays (feature, threshold, children, value), and a batch walks all trees level by level with numpy.

Defined results: null and empty texts have zero statistics and get a score like any other; documents
labelled twice count twice in training; null labels are ignored; without labels, or with only one class,
the score is the smoothed share of label 1 (0.5 without labels); very long texts are measured whole; repeated rows get the same score each; an
empty table gives no rows; ties between splits take the first
statistic and the lowest threshold; labels, language, source and id are never inputs of a score.
A column that is named like a result is replaced by it.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notewarden.llm.common import hash_unit, release_memory

SAMPLE_ROWS = 20_000
TREES = 60
DEPTH = 4
BINS = 48
RATE = 0.15
MIN_LEAF = 8
THRESHOLD = 0.3

STATS = [
    "log_words", "log_bytes", "word_len", "word_len_sd", "upper", "digit", "punct", "symbol", "bang", "pipe", "stops", "non_ascii",
    "lines_per_word", "line_words", "dup_lines", "dup_words", "top_word", "capital_words", "short_words", "long_words",
    "symbol_end", "repeat_pairs", "ends_stop", "comma",
]
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>@~^_{}[]\\+=")] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[[b for b in range(33, 127) if not chr(b).isalnum()]] = True
_END = re.compile(rb"[^\w\s.,;:'\"\x80-\xff]+(?=\s|$)")


def document_stats(text: bytes | None) -> list[float]:
    """The statistics of one whole UTF-8 text, in the order of STATS."""
    text = text or b""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATS)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    size = len(text)
    lens = np.fromiter(map(len, words), np.int64, n)
    lines = [x for x in text.split(b"\n") if x.strip()]
    freq: dict[bytes, int] = {}
    for w in words:
        freq[w] = freq.get(w, 0) + 1
    pairs = len(set(zip(words, words[1:], strict=False)))
    return [
        np.log1p(n), np.log1p(size), lens.mean(), lens.std(),
        counts[65:91].sum() / size, counts[48:58].sum() / size, counts[_PUNCT].sum() / size, counts[_SYMBOL].sum() / size,
        counts[33] / n, counts[124] / n, counts[46] / n, counts[128:].sum() / size,
        len(lines) / n, n / max(1, len(lines)), 1 - len(set(lines)) / max(1, len(lines)), 1 - len(freq) / n, max(freq.values()) / n,
        sum(w[:1].isupper() for w in words) / n, (lens <= 2).mean(), (lens >= 15).mean(),
        len(_END.findall(text)) / n, 1 - pairs / max(1, n - 1), float(text.rstrip()[-1:] in b".!?"), counts[44] / n,
    ]


class Forest(NamedTuple):
    """Trees of equal depth in heap order: inner nodes first, values in the leaves."""

    feature: np.ndarray  # (trees, 2 ** depth - 1)
    threshold: np.ndarray
    value: np.ndarray  # (trees, 2 ** depth)
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        inner = self.feature.shape[1] if self.feature.size else 0
        depth = int(np.log2(inner + 1)) if inner else 0
        rows = np.arange(len(x))[:, None]
        node = np.zeros((len(x), len(self.feature)), np.int64)
        trees = np.arange(len(self.feature))[None, :]
        for _ in range(depth):
            right = x[rows, self.feature[trees, node]] > self.threshold[trees, node]
            node = 2 * node + 1 + right
        if depth:
            total = total + self.value[trees, node - inner].sum(1)
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE, min_leaf: int = MIN_LEAF) -> Forest:
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    if len(y) == 0 or y.min() == y.max():
        return Forest(np.empty((0, 0), np.int64), np.empty((0, 0)), np.empty((0, 0)), base)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1)
    n_feat, inner = x.shape[1], 2**depth - 1
    feature, threshold, value = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1))
    raw = np.full(len(y), base)
    offset = np.arange(n_feat) * bins
    for t in range(trees):
        p = 1 / (1 + np.exp(-raw))
        grad, hess = y - p, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            key = ((node - first)[:, None] * (n_feat * bins) + offset + binned).ravel()
            sums = [np.bincount(key, np.repeat(v, n_feat), width * n_feat * bins).reshape(width, n_feat, bins).cumsum(2) for v in (grad, hess, np.ones(len(y)))]
            g, h, c = sums
            total = [s[:, :, -1:] for s in sums]
            gain = g**2 / (h + 1) + (total[0] - g) ** 2 / (total[1] - h + 1) - total[0] ** 2 / (total[1] + 1)
            gain[(c < min_leaf) | (total[2] - c < min_leaf)] = 0
            best = gain.reshape(width, -1).argmax(1)
            for k in range(width):
                f, b = divmod(int(best[k]), bins)
                if gain[k, f, b] > 1e-9 and b < len(edges[f]):
                    feature[t, first + k], threshold[t, first + k] = f, edges[f][b]
            right = x[np.arange(len(y)), feature[t, node]] > threshold[t, node]
            node = 2 * node + 1 + right
        leaf = node - inner
        g, h = np.bincount(leaf, grad, inner + 1), np.bincount(leaf, hess, inner + 1)
        value[t] = rate * g / (h + 1)
        raw += value[t, leaf]
    return Forest(feature, threshold, value, base)


def stats_udf():
    @F.pandas_udf("array<double>")
    def stats(texts: pd.Series) -> pd.Series:
        return pd.Series([document_stats(t) for t in texts])

    return stats


def learn(documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Forest:
    """Fits on about sample_rows labelled rows, twice as many at most, also where one id is repeated without end."""
    marks = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("__id"), (F.col(label) == 1).cast("int").alias("__y"))
    n = marks.count()
    chosen = F.broadcast(marks.where(hash_unit(F.col("__id"), "quality") < sample_rows / max(n, 1)).limit(2 * sample_rows))
    docs = documents.select(F.col(doc_id).alias("__id"), F.col(text).cast("binary").alias("t"))
    rows = docs.join(chosen, "__id").select("__y", stats_udf()("t").alias("x")).limit(2 * sample_rows).toPandas()
    x = np.array(rows["x"].tolist(), float).reshape(len(rows), len(STATS))
    order = np.lexsort((*x.T, rows["__y"]))  # the fit does not depend on the order of arrival
    return fit(x[order], rows["__y"].to_numpy(float)[order])


def with_score(documents: DataFrame, forest: Forest, text: str = "text", to: str = "score") -> DataFrame:
    shared = documents.sparkSession.sparkContext.broadcast(forest)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        x = np.array([document_stats(t) for t in texts], float).reshape(len(texts), len(STATS))
        release_memory()
        return pd.Series(np.concatenate([shared.value.score(x[a : a + 1000]) for a in range(0, max(1, len(x)), 1000)]))

    return documents.withColumn(to, score(F.col(text).cast("binary")))


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def op5(documents: DataFrame, labels: DataFrame) -> DataFrame:
    docs = documents.select("doc_id", "text")
    forest = learn(docs, labels.where(~held_out(F.col("doc_id"))))
    scored = with_score(docs, forest)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
