"""A toxicity classifier that is regularised by counterfactuals.

Features of a text are its distinct words and the beginnings of its longer words (insults are
inflected). The model is logistic with weights of at least zero and an L1 penalty, so that only what
speaks for toxicity counts and thousands of ordinary words in a long text add up to nothing.

Counterfactuals: in every sentence of a labelled text that holds an identity term, the term is swapped
for each other term of its group. The training penalises the squared change of the sentence's score,
summed over all these swaps. With presence features the change is the difference between the two
terms' own weights, so the swaps are counted by term and the penalty is exact.

Bounds: at most `rows` labelled rows, in order of a hash of the id, are fitted on the driver, all of them
whatever their length. Which features can get a weight is decided by Spark; the driver gets only those.
Everything else covers all rows.

Rules: NULL and empty texts get the score of a text without features. Labels that are NULL are left
out. Without rows of both classes every score is the share of toxic rows, 0 if there are none.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from riskmill.llm.store import stored
from riskmill.llm.text import NOT_WORD, PART, Words, joined, slices

#: Terms that name groups of people; within a row each can stand for any other.
IDENTITY_TERMS = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "arab"),
    ("gay", "straight", "lesbian", "bisexual"),
    ("transgender", "cisgender"),
    ("immigrants", "natives"),
    ("young", "old"),
    ("french", "german", "spanish", "english", "polish", "turkish"),
)

#: Lengths in bytes of the beginnings that are features of longer words.
PREFIXES = (4, 5, 6)
SENTENCE_END = np.zeros(256, bool)
SENTENCE_END[[0x0A, 0x21, 0x2E, 0x3F]] = True


def word_features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (text, feature), with repeats: each word and each beginning of a longer one."""
    text_of, lengths = words.text_of, words.end - words.start
    texts, features = [text_of], [words.hashes()]
    for k in PREFIXES:
        longer = lengths > k
        start = words.start[longer]
        texts.append(text_of[longer])
        features.append(joined(words.hash(start, start + k), np.full(len(start), k, np.uint64)))
    return np.concatenate(texts), np.concatenate(features)


def _terms_of(groups) -> tuple[list[str], np.ndarray, np.ndarray]:
    flat = [t for g in groups for t in g]
    hashes = Words(pa.array([t.encode() for t in flat], pa.binary()), NOT_WORD).hashes()
    return flat, hashes, np.repeat(np.arange(len(groups)), [len(g) for g in groups])


def labelled_features(groups=IDENTITY_TERMS):
    """A function of texts: distinct features, and the identity term of each sentence that has one."""
    _, term_hashes, _ = _terms_of(groups)
    order = np.argsort(term_hashes)

    @arrow_udf("struct<features: array<long>, terms: array<int>>")
    def features_of(texts: pa.Array) -> pa.Array:
        parts = []
        for part in slices(pa.record_batch([texts], ["text"]), "text", PART):
            words = Words(part.column(0), NOT_WORD)
            text, feature = word_features(words)
            pairs = np.unique(np.stack([text.astype(np.uint64), feature]), axis=1)
            at = np.searchsorted(pairs[0], np.arange(part.num_rows + 1))
            features = pa.ListArray.from_arrays(at.astype(np.int32), pa.array(pairs[1].view(np.int64)))
            place = np.minimum(np.searchsorted(term_hashes[order], words.hashes()), len(order) - 1)
            found = np.flatnonzero(term_hashes[order][place] == words.hashes())
            sentence = np.cumsum(SENTENCE_END[words.data])[words.start[found]] if len(found) else found
            seen = np.unique(np.stack([words.text_of[found], sentence, order[place[found]]]), axis=1)
            at = np.searchsorted(seen[0], np.arange(part.num_rows + 1))
            terms = pa.ListArray.from_arrays(at.astype(np.int32), pa.array(seen[2].astype(np.int32)))
            parts.append(pa.StructArray.from_arrays([features, terms], ["features", "terms"]))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.struct(
            [("features", pa.list_(pa.int64())), ("terms", pa.list_(pa.int32()))]))

    return features_of


@dataclass(frozen=True)
class ToxicityModel:
    """Sorted feature hashes with their weights, and what a text has without any of them."""

    features: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        """The probability of each text, from the whole of it."""
        out = []
        for part in slices(pa.record_batch([texts], ["text"]), "text", PART):
            z = np.full(part.num_rows, self.bias)
            if len(self.features):
                text, feature = word_features(Words(part.column(0), NOT_WORD))
                place = np.minimum(np.searchsorted(self.features, feature), len(self.features) - 1)
                hit = np.flatnonzero(self.features[place] == feature)
                pairs = np.unique(text[hit] * len(self.features) + place[hit])
                z += np.bincount(pairs // len(self.features), self.weights[pairs % len(self.features)], part.num_rows)
            out.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
        return np.concatenate(out) if out else np.zeros(0)


def fit_weights(
    row: np.ndarray, column: np.ndarray, y: np.ndarray, n_columns: int, swaps: np.ndarray, *,
    l1: float = 3e-4, counterfactual: float = 1.0, steps: int = 300,
) -> tuple[np.ndarray, float]:
    """Weights and bias by accelerated proximal gradient steps.

    row, column: where a feature is present; swaps: rows (count, columns of one term, of the other).
    """
    share = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    mass = np.bincount(row, minlength=len(y)).astype(float)
    step = 4.0 / max(1.0, float((share * (mass + 1)).sum())) * 8
    w, b = np.zeros(n_columns), 0.0
    v, c, t = w.copy(), b, 1.0
    total = max(1, sum(n for n, _, _ in swaps))
    last = np.inf
    for _ in range(steps):
        z = c + np.bincount(row, v[column], len(y))
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        loss = -(share * np.where(y == 1, np.log(p + 1e-12), np.log(1 - p + 1e-12))).sum() + l1 * v.sum()
        if loss > last:  # start the momentum anew, with a shorter step
            v, c, t, step = w.copy(), b, 1.0, step * 0.7
        last = loss
        r = share * (p - y)
        g = np.bincount(column, r[row], n_columns)
        for n, one, other in swaps:
            change = v[other].sum() - v[one].sum()
            g[other] += 2 * counterfactual * n / total * change
            g[one] -= 2 * counterfactual * n / total * change
        w_next, b_next = np.maximum(0, v - step * (g + l1)), c - step * r.sum()
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = w_next + (t - 1) / t_next * (w_next - w), b_next + (t - 1) / t_next * (b_next - b)
        v = np.maximum(v, 0)
        w, b, t = w_next, b_next, t_next
    return w, b


def _swaps(counts: np.ndarray, kept: np.ndarray, groups) -> list:
    """For each pair of terms of a group: how many sentences swap one for the other, and their columns."""
    flat, _, group = _terms_of(groups)
    text, feature = word_features(Words(pa.array([t.encode() for t in flat], pa.binary()), NOT_WORD))
    place = np.minimum(np.searchsorted(kept, feature), max(0, len(kept) - 1))
    known = kept[place] == feature if len(kept) else np.zeros(len(feature), bool)
    columns = [place[known & (text == i)] for i in range(len(flat))]
    return [
        (counts[i] + counts[j], columns[i], columns[j])
        for i in range(len(flat)) for j in range(i + 1, len(flat))
        if group[i] == group[j] and counts[i] + counts[j] and (len(columns[i]) or len(columns[j]))
    ]


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", *,
    rows: int = 8000, least_texts: int = 3, groups=IDENTITY_TERMS, **fit,
) -> ToxicityModel:
    """A model from the labelled rows of `labels`, whose texts are in `docs`."""
    sample = labels.filter(F.col(label).isin(0, 1)).select(
        F.col(key).alias("sample_key"), F.col(label).cast("int").alias("y"), F.xxhash64(key).alias("draw")
    ).orderBy("draw", "sample_key").limit(rows)
    found = stored(docs.select(key, text).join(F.broadcast(sample), F.col(key) == F.col("sample_key")).select(
        "draw", "y", labelled_features(groups)(F.col(text)).alias("f")
    ))
    texts, toxic = found.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    if toxic in (0, texts):
        return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), 30.0 if toxic else -30.0)
    # A feature that is no likelier in toxic texts would get weight zero.
    useful = found.select("y", F.explode("f.features").alias("feature")).groupBy("feature").agg(
        F.count("*").alias("n"), F.sum("y").alias("toxic")
    ).filter(
        (F.col("n") >= least_texts) & (F.col("toxic") / F.lit(toxic) > (F.col("n") - F.col("toxic")) / F.lit(texts - toxic))
    ).select("feature").toArrow()
    kept = np.sort(np.asarray(useful["feature"].combine_chunks()).view(np.uint64))
    data = found.select("y", _columns_of(kept)(F.col("f.features")).alias("columns")).toArrow()
    y = np.asarray(data["y"].combine_chunks(), float)
    lists = data["columns"].combine_chunks()
    row = np.repeat(np.arange(len(y), dtype=np.int32), np.asarray(lists.value_lengths()))
    column = np.asarray(lists.flatten())
    counts = np.zeros(len(_terms_of(groups)[0]), int)
    for term, n in found.select(F.explode("f.terms").alias("term")).groupBy("term").count().collect():
        counts[term] = n
    w, b = fit_weights(row, column, y, len(kept), _swaps(counts, kept, groups), **fit)
    return ToxicityModel(kept[w > 0], w[w > 0], float(b))


def _columns_of(kept: np.ndarray):
    """A function of feature lists: the places of those features that are kept."""

    @arrow_udf("array<int>")
    def columns_of(lists: pa.Array) -> pa.Array:
        feature = np.asarray(lists.flatten()).view(np.uint64)
        place = np.searchsorted(kept, feature)
        hit = np.append(kept, np.uint64(0))[place] == feature
        hit &= place < len(kept)
        at = np.concatenate([[0], np.cumsum(hit)])[np.concatenate([[0], np.cumsum(np.asarray(lists.value_lengths()))])]
        return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(place[hit].astype(np.int32)))

    return columns_of


def toxicity_score(model: ToxicityModel, text: Column) -> Column:
    """The model's probability for each text; the model is a bounded list of words."""

    @arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.scores(texts))

    return score(text)
