"""Language-model scores from a weighted backoff automaton of n-grams.

The model is smoothed by interpolation: p(w | h) = (1 - backoff) * c(h w) / c(h) + backoff * p(w | h'), where h' is h
without its first word, down to single words with one added to every count. As an automaton: every history
that training holds is a state; an n-gram that training holds is an arc from its history, with the log of its
smoothed probability, to the longest state that ends it; and a failure arc leads from h to h' with the log
of `backoff`. The empty history has an arc for every word, unknown ones too. A text is read from left to
right: the state is carried on, failure arcs are followed until the word has an arc, and the logs add up. A text
begins in a state of its own.

The model is as large as the corpus, so no task holds all of it. Texts are read in blocks of about `chunk` bytes.
A block asks for the counts of its own n-grams in all training texts (see `tallies`); then it builds, for some
of its texts after the other, that part of the automaton which they can reach. Long texts are read in stretches side by side; a stretch starts in the
state that the words just before it lead to, which is the carried state, since states are at most
`order` - 1 words long.

Blocks are cut from the rows as they are read, which a re-read of the same files repeats; an answer to another
question is an error, never a wrong score.

Rules: words are runs of bytes outside ASCII white space, A-Z in lower case; each text ends in one end
token. NULL and empty texts hold just the end token. Without training texts all counts are 0. N-grams are
known by 63-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from riskmill.llm import tallies
from riskmill.llm.store import stored
from riskmill.llm.text import Words, chunks, joined, slices

END = np.uint64(0x5851F42D4C957F2D)
BEGIN = np.uint64(0x14057B7EF767814F)
#: Questions that every block asks: how many tokens and how many texts training has.
TOKENS, TEXTS = np.uint64(0), np.uint64(2)
ONE = np.uint64(1)

#: Tokens of a stretch that is read side by side with others, and bytes of text that are read with one automaton.
STRETCH, SLICE = 512, 1 << 21
#: Ranges of keys that a block's n-grams are merged in.
RANGES = 32


def token_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, the end of each text among them, and where each text begins."""
    words = Words(texts)
    at = words.word_at + np.arange(len(words.word_at))
    tokens = np.full(at[-1], END)
    inside = np.ones(at[-1], bool)
    inside[at[1:] - 1] = False
    tokens[inside] = words.hashes()
    return tokens, at


def ngrams(tokens: np.ndarray, at: np.ndarray, order: int) -> list[np.ndarray]:
    """For each length from 1, the key of the n-gram that ends at each token; single words are even, others odd.

    A text begins with one mark. What would reach beyond it has the key 0.
    """
    since = np.arange(len(tokens)) - np.repeat(at[:-1], np.diff(at))
    out, whole = [tokens & ~ONE], tokens
    for n in range(2, order + 1):
        before = np.empty_like(whole)  # the n-gram one shorter that ends one token earlier
        before[1:] = whole[:-1]
        before[since == 0] = BEGIN
        whole = joined(before, tokens + np.uint64(n))
        out.append(np.where(since >= n - 2, whole | ONE, np.uint64(0)))
    return out


class Grams:
    """The n-grams of some texts. keys: of each length, sorted and distinct; code: of each length, by token, its place
    among the keys, or -1; at: where each text begins, and the end."""

    def __init__(self, texts: pa.Array, order: int):
        tokens, self.at = token_hashes(texts)
        self.keys, self.code = [], []
        for grams in ngrams(tokens, self.at, order):
            keys, code = np.unique(grams, return_inverse=True)
            none = int(len(keys) > 0 and keys[0] == 0)
            self.keys.append(keys[none:])
            self.code.append((code - none).astype(np.int32))

    def counts(self, asked: np.ndarray, totals: np.ndarray) -> list[np.ndarray]:
        """Training's counts of the n-grams of each length, from those that the block asked for."""
        return [totals[np.searchsorted(asked, k)] for k in self.keys]


def question(table: pa.Table, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of a block's texts in order, and how often its training texts hold each."""
    found, tokens, texts = [], 0, 0
    for batch in table.to_batches():
        for part in slices(batch, "text"):
            grams, learnt_tokens, learnt_texts = _held(part, order)
            found += grams
            tokens, texts = tokens + learnt_tokens, texts + learnt_texts
    found.append((np.array([TOKENS, TEXTS]), np.array([tokens, texts], np.int32)))
    return _merged(found)


def _held(part: pa.RecordBatch, order: int) -> tuple[list, int, int]:
    """The n-grams of a slice with their counts; its tokens and texts in training. All else that it takes goes with it."""
    hashes, at = token_hashes(part.column("text"))
    learnt = np.asarray(part.column("train"))
    train = np.repeat(learnt, np.diff(at))
    found = []
    for grams in ngrams(hashes, at, order):
        found.append(_counted(grams[train & (grams != 0)]))
        others = np.unique(grams[~train & (grams != 0)])
        found.append((others, np.zeros(len(others), np.int32)))
    return found, int(train.sum()), int(learnt.sum())


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = tallies.counted(keys) if len(keys) else (keys, keys)
    return keys, counts.astype(np.int32)


def _merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, their counts added up, from parts in order.

    Ranges of keys are merged one after the other, so that no more than one of them is held several times.
    """
    size = sum(len(keys) for keys, _ in parts)
    every, sums, made = np.empty(size, np.uint64), np.empty(size, np.int32), 0
    edges = np.arange(1, RANGES, dtype=np.uint64) * np.uint64((1 << 64) // RANGES)
    cuts = [[0, *np.searchsorted(keys, edges), len(keys)] for keys, _ in parts]
    for n in range(RANGES):
        keys = np.concatenate([k[at[n] : at[n + 1]] for (k, _), at in zip(parts, cuts)])
        if not len(keys):
            continue
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], np.concatenate([c[at[n] : at[n + 1]] for (_, c), at in zip(parts, cuts)])[order]
        first = np.flatnonzero(np.diff(keys, prepend=keys[:1] ^ ONE))
        every[made : made + len(first)] = keys[first]
        sums[made : made + len(first)] = np.add.reduceat(counts, first)
        made += len(first)
    return every[:made], sums[:made]


class Automaton:
    """The part of the model that a block's n-grams reach.

    States are 0 for the empty history, 1 for the beginning of a text, then the histories that training holds.
    single: log of each word from the empty history; after: the state each word leads to from there; arcs: sorted
    state * words + word; weight, target: of each arc; failure: the state that each state falls back to.
    """

    def __init__(self, grams: Grams, counts: list[np.ndarray], tokens: int, texts: int, types: int, backoff: float):
        order, words = len(counts), len(counts[0])
        first = [_first(code, len(keys)) for code, keys in zip(grams.code, grams.keys)]
        begins = np.zeros(len(grams.code[0]), bool)
        begins[grams.at[:-1]] = True
        chance = (counts[0] + 1) / (tokens + types + 1)  # of each n-gram of the length at hand
        self.words, self.single = words, np.log10(chance)
        state, made = [np.zeros(0, np.int64)] * order, 2
        failure = [np.zeros(2, np.int64)]
        for n in range(order - 1):  # histories of n + 1 words
            seen = counts[n] > 0
            state[n] = np.where(seen, made + np.cumsum(seen) - 1, 0)
            made += int(seen.sum())
            shorter = np.zeros(int(seen.sum()), np.int64) if n == 0 else state[n - 1][grams.code[n - 1][first[n][seen]]]
            failure.append(shorter)
        self.failure = np.concatenate(failure)
        self.after = state[0] if order > 1 else np.zeros(words, np.int64)
        arcs, weights, targets = [], [], []
        for n in range(1, order):  # arcs of n + 1 words
            seen = np.flatnonzero(counts[n] > 0)
            place = first[n][seen]
            start = begins[place]
            before = np.where(start, 0, grams.code[n - 1][place - 1]) if n == 1 else grams.code[n - 1][place - 1]
            often = np.where(start, texts, counts[n - 1][before]) if n == 1 else counts[n - 1][before]
            source = np.where(start, 1, state[n - 1][before]) if n == 1 else state[n - 1][before]
            shorter = chance[grams.code[n - 1][place]]
            chance = np.full(len(counts[n]), np.nan)
            chance[seen] = (1 - backoff) * counts[n][seen] / often + backoff * shorter
            word = grams.code[0][place]
            arcs.append(source * words + word)
            weights.append(np.log10(chance[seen]))
            targets.append(state[n][seen] if n < order - 1 else state[n - 1][grams.code[n - 1][place]])
        arcs = np.concatenate([np.zeros(0, np.int64), *arcs])
        sort = np.argsort(arcs)
        self.arcs = arcs[sort]
        self.weight = np.concatenate([np.zeros(0), *weights])[sort]
        self.target = np.concatenate([np.zeros(0, np.int64), *targets])[sort]
        self.order, self.falls = order, np.log10(backoff)

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Reads one word in each state: the states that follow, and the logs on the way."""
        log, after, left = np.zeros(len(state)), np.zeros(len(state), np.int64), np.arange(len(state))
        at = state
        while len(left):
            empty = at == 0
            here = left[empty]
            log[here] += self.single[word[here]]
            after[here] = self.after[word[here]]
            left, at = left[~empty], at[~empty]
            if not len(left):
                break
            key = at * self.words + word[left]
            place = np.minimum(np.searchsorted(self.arcs, key), len(self.arcs) - 1) if len(self.arcs) else None
            found = self.arcs[place] == key if place is not None else np.zeros(len(left), bool)
            if place is not None:
                log[left[found]] += self.weight[place[found]]
                after[left[found]] = self.target[place[found]]
            left, at = left[~found], self.failure[at[~found]]
            log[left] += self.falls
        return after, log

    def read(self, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The log of every text, each read from left to right."""
        many = -(-np.diff(at) // STRETCH)
        text = np.repeat(np.arange(len(many)), many)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
        start = at[text] + nth * STRETCH
        end = np.minimum(start + STRETCH, at[text + 1])
        order = np.argsort(start - end, kind="stable")  # the longest first, so that those still read come first
        text, nth, start, end = text[order], nth[order], start[order], end[order]
        state = np.where(nth == 0, 1 if self.order > 1 else 0, 0)
        later = np.flatnonzero(nth > 0)
        for k in range(self.order - 1, 0, -1):  # the words just before a stretch lead to its first state
            state[later], _ = self.step(state[later], word[start[later] - k])
        sums, size = np.zeros(len(text)), end - start
        for k in range(int(size.max(initial=0))):
            live = int(np.searchsorted(-size, -k))
            state[:live], log = self.step(state[:live], word[start[:live] + k])
            sums[:live] += log
        return np.bincount(text, sums, len(many))


def _first(code: np.ndarray, size: int) -> np.ndarray:
    """A token at which each n-gram ends."""
    out = np.zeros(size, np.int64)
    places = np.flatnonzero(code >= 0)
    out[code[places]] = places
    return out


def _questions(order: int, chunk: int, parts: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, table in chunks(batches, chunk):
            yield from tallies.question(table.column("task")[0].as_py(), number, *question(table, order), parts)

    return ask


def _blocks(chunk: int):
    """The rows of each block, compressed."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, table in chunks(batches, chunk):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as writer:
                writer.write_table(table)
            data = zstandard.compress(sink.getvalue(), 3)
            yield pa.RecordBatch.from_arrays(
                [pa.array([table.column("task")[0].as_py()]), pa.array([number]), pa.array([data], pa.binary())],
                ["task", "number", "block"],
            )

    return pack


SCORED = pa.schema([
    ("id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()),
    ("base_score", pa.float64()), ("score", pa.float64()),
])


def _scored(order: int, backoff: float, types: int, parts: int):
    def score(key: tuple, blocks: pa.Table, answers: pa.Table) -> pa.Table:
        if not blocks.num_rows:
            return SCORED.empty_table()
        table = pa.ipc.open_stream(zstandard.decompress(blocks["block"][0].as_py())).read_all()
        asked = question(table, order)[0]
        totals, _ = tallies.answer(answers, asked, parts)
        tokens, texts = int(totals[0]), int(totals[1])
        out = []
        for batch in table.to_batches():
            for part in slices(batch, "text", SLICE):
                grams = Grams(part.column("text"), order)
                counts = grams.counts(asked, totals)
                model = Automaton(grams, counts, tokens, texts, types, backoff)
                sums = lambda x: np.add.reduceat(x[grams.code[0]], grams.at[:-1])  # noqa: B023, E731
                known = sums((counts[0] > 0).astype(np.int64))
                out.append(pa.RecordBatch.from_arrays([
                    part.column("id"), pa.array(np.diff(grams.at)), pa.array(known), pa.array(np.full(len(known), tokens)),
                    pa.array(sums(model.single)), pa.array(model.read(grams.code[0], grams.at)),
                ], schema=SCORED))
        return pa.Table.from_batches(out, SCORED)

    return score


def lm_scores(
    docs: DataFrame, key: str, text: str, train: Column, *, order: int = 3, backoff: float = 0.6, chunk: int = 16 << 20,
) -> DataFrame:
    """Per row: key, n_tokens, n_known, train_tokens, base_score, score. order: longest n-gram."""
    if order < 1 or not 0 < backoff < 1:
        raise ValueError("order must be 1 or more, backoff between 0 and 1")
    spark = docs.sparkSession
    rows = docs.select(
        F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"),
        F.coalesce(train, F.lit(False)).alias("train"), F.spark_partition_id().cast("long").alias("task"),
    )
    size = docs.agg(F.coalesce(F.sum(F.octet_length(F.col(text).cast("string"))), F.lit(0))).first()[0]
    parts = tallies.ranges(spark, size * order // 8)
    told = stored(tallies.totals(rows.mapInArrow(_questions(order, chunk, parts), tallies.ASK)))
    types = told.agg(F.coalesce(F.sum("even"), F.lit(0))).first()[0]
    blocks = rows.mapInArrow(_blocks(chunk), "task long, number long, block binary")
    scored = blocks.groupBy("task", "number").cogroup(told.groupBy("task", "number")).applyInArrow(
        _scored(order, backoff, _words(types), parts),
        "id long, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
    return scored.withColumnRenamed("id", key)


def _words(even: int) -> int:
    """Distinct words among the even keys with a total: without the two questions that all blocks ask."""
    return max(0, even - 2)
