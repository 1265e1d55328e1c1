"""A quality classifier: histogram gradient-boosted trees over statistics of a text.

The statistics come from the bytes of whole texts, many texts at once. Trees are grown level by level
from histograms of binned values and flattened into arrays, one row per tree: node k has children
2k + 1 and 2k + 2, so that all texts go down all trees together, one step per level.

Bounds: at most `rows` labelled rows, in order of a hash of the id, are fitted on the driver, each as a
few dozen numbers. Everything else covers all rows.

Rules: NULL is an empty text, whose statistics are all 0. Labels that are NULL are left out. Without
labelled rows every score is 0; with one class only, its label.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, DoubleType

from riskmill.llm.text import PART, WHITE, Words, joined, slices


def _bytes_in(text: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(text.encode())] = True
    return table


UPPER, LOWER, DIGIT = (_bytes_in(x) for x in ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"))
STOPS, BANGS, BARS = _bytes_in(".,;:?'\"()-"), _bytes_in("!"), _bytes_in("|")
SYMBOLS = ~(UPPER | LOWER | DIGIT | STOPS | BANGS | BARS | WHITE)
SYMBOLS[0x80:] = False
OTHER = np.arange(256) >= 0x80
NEWLINE, FULL_STOP = _bytes_in("\n"), _bytes_in(".")
WORD_END = UPPER | LOWER | DIGIT | STOPS | OTHER

STATISTICS = (
    "log_bytes", "log_words", "bytes_per_word", "upper", "digits", "stops", "bangs", "bars", "symbols", "other",
    "lines_per_word", "sentences_per_word", "odd_word_ends", "capital_words", "longest_word", "short_words",
    "distinct_words", "commonest_word", "distinct_triples", "distinct_lines",
)


def _repeats(text: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each text: the share of distinct items, and that of its commonest one."""
    key = np.sort(text.astype(np.uint64) << np.uint64(42) | hashes >> np.uint64(22))
    first = np.flatnonzero(np.diff(key, prepend=key[:1] ^ np.uint64(1)))
    of = (key[first] >> np.uint64(42)).astype(np.int64)
    total = np.maximum(np.bincount(text, minlength=n), 1)
    most = np.zeros(n)
    np.maximum.at(most, of, np.diff(first, append=len(key)))
    return np.bincount(of, minlength=n) / total, most / total


def text_statistics(texts: pa.Array) -> np.ndarray:
    """One row of STATISTICS per text."""
    words = Words(texts)
    n, at, data = len(texts), words.text_at, words.data
    text_of, size, count = words.text_of, np.diff(at), words.counts

    def of_bytes(table: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, np.int64)
        np.cumsum(table[data], out=sums[1:])
        return np.diff(sums[at])

    def of_words(mask: np.ndarray) -> np.ndarray:
        return np.bincount(text_of, mask, n) / np.maximum(count, 1)

    some = np.maximum(size, 1)
    letters = of_bytes(UPPER)
    lengths = words.end - words.start
    longest = np.zeros(n)
    np.maximum.at(longest, text_of, lengths)
    hashes = words.hashes()
    distinct, commonest = _repeats(text_of, hashes, n)
    same = text_of[2:] == text_of[:-2] if len(text_of) > 2 else np.zeros(0, bool)
    triples = joined(joined(hashes[:-2], hashes[1:-1]), hashes[2:])[same] if len(same) else np.zeros(0, np.uint64)
    distinct_triples, _ = _repeats(text_of[2:][same] if len(same) else np.zeros(0, np.int64), triples, n)
    breaks = np.flatnonzero(NEWLINE[data])
    begin = np.union1d(breaks + 1, at[:-1][size > 0])
    begin = begin[begin < len(data)]
    end = np.append(begin[1:], len(data))
    line_of = np.searchsorted(at, begin, "right") - 1
    distinct_lines, _ = _repeats(line_of, words.hash(begin, end), n)
    columns = (
        np.log1p(size), np.log1p(count), size / np.maximum(count, 1),
        letters / np.maximum(letters + of_bytes(LOWER), 1),
        of_bytes(DIGIT) / some, of_bytes(STOPS) / some, of_bytes(BANGS) / some, of_bytes(BARS) / some,
        of_bytes(SYMBOLS) / some, of_bytes(OTHER) / some,
        of_bytes(NEWLINE) / np.maximum(count, 1), of_bytes(FULL_STOP) / np.maximum(count, 1),
        of_words(~WORD_END[data[words.end - 1]] if len(data) else np.zeros(0)),
        of_words(UPPER[data[words.start]] if len(data) else np.zeros(0)),
        np.log1p(longest), of_words(lengths <= 3),
        distinct, commonest, distinct_triples, distinct_lines,
    )
    return np.stack(columns, axis=1) if n else np.zeros((0, len(STATISTICS)))


@dataclass(frozen=True)
class BoostedTrees:
    """Trees of one depth as arrays: feature and threshold by inner node, value by leaf."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    bias: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        trees, inner = self.feature.shape
        node = np.zeros((len(x), trees), np.int64)
        tree, row = np.arange(trees)[None, :], np.arange(len(x))[:, None]
        for _ in range(int(np.log2(inner + 1))):
            right = x[row, self.feature[tree, node]] > self.threshold[tree, node]
            node = 2 * node + 1 + right
        z = self.bias + self.value[tree, node - inner].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_trees(
    x: np.ndarray, y: np.ndarray, *, trees: int = 80, depth: int = 4, bins: int = 64, rate: float = 0.15,
    ridge: float = 1.0, least_rows: int = 10,
) -> BoostedTrees:
    """Boosting with the logistic loss; each level of a tree is one histogram per statistic."""
    inner, n, width = (1 << depth) - 1, len(y), x.shape[1]
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)], axis=1)
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    bias = float(np.log(share / (1 - share)))
    feature = np.zeros((trees, inner), np.int64)
    threshold, value = np.full((trees, inner), np.inf), np.zeros((trees, inner + 1))
    z = np.full(n, bias)
    for t in range(trees):
        p = 1 / (1 + np.exp(-z))
        g, h = p - y, np.maximum(p * (1 - p), 1e-9)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, nodes = (1 << level) - 1, 1 << level
            local = node - first
            best, cut = np.zeros(nodes), np.full((nodes, 2), -1)
            for f in range(width):
                k = len(edges[f]) + 1
                if k == 1:
                    continue
                cell = local * k + binned[:, f]
                hist = [np.bincount(cell, q, nodes * k).reshape(nodes, k) for q in (g, h, None)]
                left = [np.cumsum(q, axis=1)[:, :-1] for q in hist]
                whole = [q.sum(axis=1, keepdims=True) for q in hist]
                gain = left[0] ** 2 / (left[1] + ridge) + (whole[0] - left[0]) ** 2 / (whole[1] - left[1] + ridge)
                gain -= whole[0] ** 2 / (whole[1] + ridge)
                gain[(left[2] < least_rows) | (whole[2] - left[2] < least_rows)] = -1
                at = gain.argmax(axis=1)
                better = gain[np.arange(nodes), at] > best + 1e-9
                best[better] = gain[np.arange(nodes), at][better]
                cut[better] = np.stack([np.full(nodes, f), at], axis=1)[better]
            for k in np.flatnonzero(cut[:, 0] >= 0):
                feature[t, first + k] = cut[k, 0]
                threshold[t, first + k] = edges[cut[k, 0]][cut[k, 1]]
            node = 2 * node + 1 + (x[np.arange(n), feature[t, node]] > threshold[t, node])
        leaf = node - inner
        value[t] = -rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + ridge)
        z += value[t][leaf]
    return BoostedTrees(feature, threshold, value, bias)


def _sliced(texts: pa.Array, function) -> np.ndarray:
    return np.concatenate(
        [function(part.column(0)) for part in slices(pa.record_batch([texts], ["text"]), "text", PART)]
    )


@arrow_udf(ArrayType(DoubleType()))
def statistics_of(texts: pa.Array) -> pa.Array:
    if not len(texts):
        return pa.array([], pa.list_(pa.float64()))
    values = _sliced(texts, text_statistics)
    at = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(at, pa.array(values.ravel()))


def fit_quality(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", *,
    rows: int = 20_000, **fit,
) -> BoostedTrees:
    """A model from the labelled rows of `labels`, whose texts are in `docs`."""
    sample = labels.filter(F.col(label).isin(0, 1)).select(
        F.col(key).alias("sample_key"), F.col(label).cast("int").alias("y"), F.xxhash64(key).alias("draw")
    ).orderBy("draw", "sample_key").limit(rows)
    data = docs.select(key, text).join(F.broadcast(sample), F.col(key) == F.col("sample_key")).select(
        "draw", "y", statistics_of(F.col(text)).alias("x")
    ).limit(rows).toPandas().sort_values("draw", kind="stable")
    y = data.y.to_numpy(float)
    if not len(y) or y.min() == y.max():
        nothing = np.zeros((1, 1), np.int64)
        return BoostedTrees(nothing, np.full((1, 1), np.inf), np.zeros((1, 2)), 30.0 if y.sum() else -30.0)
    return fit_trees(np.stack(data.x.to_list()), y, **fit)


def quality_score(model: BoostedTrees, text: Column) -> Column:
    """The model's probability for each text."""

    @arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        if not len(texts):
            return pa.array([], pa.float64())
        return pa.array(_sliced(texts, lambda part: model.probability(text_statistics(part))))

    return score(text)
