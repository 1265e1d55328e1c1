"""A distributed positional inverted index, and exact phrase and proximity search in it.

The index is a stored table of shards. A shard holds the postings of some MB of whole texts: its terms as they
are written, A-Z in lower case, and for each term the sorted places where it stands (a place is the number of
the word in the shard). Test items are looked up in every shard that holds their terms: the list of the
rarest term gives candidates, moved by the offset of that term, and the lists of the other terms, rarest
first, strike out those that they lack. Terms are compared by their bytes, so matches are exact.

Shards are cut by documents, so a word or passage in a third of all texts is a few postings more in each shard,
no task's burden. Test items are read in blocks of `block` bytes, one pass over the index for each; only
one block is held at a time.

Rules: words are runs of ASCII letters, digits and bytes above 0x7F. NULL and empty texts have no words: such a
document is never hit, such an item never matches. Documents that share an id, or have none, are looked
at by themselves; items that share an id count as one, those without one as one with an empty id. Empty tables
give no matches. Only the columns named are read, so other names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from riskmill.llm import tallies
from riskmill.llm.store import stored
from riskmill.llm.text import NOT_WORD, Words, chunks, slices

#: Candidate places that are intersected at a time.
STEP = 1 << 20

MATCHES = "array<struct<item:string,start:long,end:long>>"
_lower = np.arange(256, dtype=np.uint8)
_lower[0x41:0x5B] += 0x20


def terms_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts one after the other, and where each text begins, and the end."""
    words = Words(texts, NOT_WORD)
    at = np.concatenate([[0], np.cumsum(words.end - words.start)])
    data = _lower[words.data[~NOT_WORD[words.data]]]
    flat = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data)]
    )
    return flat, words.word_at


def _tables(table: pa.Table) -> tuple[pa.Array, np.ndarray]:
    found = [terms_of(part.column("text")) for batch in table.to_batches() for part in slices(batch, "text")]
    base = np.cumsum([0, *(at[-1] for _, at in found)])
    starts = [at[:-1] + b for (_, at), b in zip(found, base)]
    return pa.chunked_array([w for w, _ in found], pa.large_binary()).combine_chunks(), np.concatenate([*starts, base[-1:]])


def _index(size: int):
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, table in chunks(batches, size):
            words, at = _tables(table)
            coded = words.dictionary_encode()
            terms = coded.dictionary
            code = np.asarray(coded.indices).astype(np.uint64)
            places = np.sort(code * np.uint64(len(code)) + np.arange(len(code), dtype=np.uint64))
            data = [
                tallies.narrow(at), tallies.narrow(np.asarray(pc.binary_length(terms))),
                zstandard.compress(b"".join(terms.to_pylist()), 1), tallies.pack_keys(places),
            ]
            yield pa.RecordBatch.from_arrays(
                [table.column("task").combine_chunks()[:1], pa.array([number]),
                 pa.array([table.column("key").to_pylist()], pa.list_(table.schema.field("key").type)),
                 pa.array([data], pa.list_(pa.binary()))],
                ["task", "number", "keys", "data"],
            )

    return index


class Shard:
    """Postings of one shard: keys of its texts; at: first word of each text, and the end; terms; begin: where each
    term's list begins, and the end; places: term * words + place, sorted, all lists one after the other."""

    def __init__(self, keys: list, data: list[bytes]):
        self.keys, self.at = keys, tallies.wide(data[0])
        self.words = int(self.at[-1])
        ends = np.concatenate([[0], np.cumsum(tallies.wide(data[1]))])
        self.terms = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [
            None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(zstandard.decompress(data[2])),
        ])
        self.places = tallies.unpack_keys(data[3]).astype(np.int64)
        self.begin = np.searchsorted(self.places, np.arange(len(self.terms) + 1) * max(self.words, 1))

    def lookup(self, terms: pa.Array) -> np.ndarray:
        """The number of each term here, or -1."""
        return np.asarray(pc.fill_null(pc.index_in(terms, self.terms), -1)).astype(np.int64)

    def counts(self, term: np.ndarray) -> np.ndarray:
        return self.begin[term + 1] - self.begin[term]

    def posting(self, term: int) -> np.ndarray:
        return self.places[self.begin[term] : self.begin[term + 1]] - term * self.words

    def has(self, term: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Whether each term stands at each place."""
        key = term * self.words + place
        at = np.minimum(np.searchsorted(self.places, key), len(self.places) - 1)
        return (self.places[at] == key) & (place < self.words) & (place >= 0)

    def text_of(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.at, place, "right") - 1

    def phrases(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each row of `windows` (numbers of terms, none -1) stands as written: rows and places."""
        size = windows.shape[1]
        often = self.counts(windows)
        order = np.argsort(often, axis=1, kind="stable")
        least = often[np.arange(len(often)), order[:, 0]]
        ends = np.cumsum(least)
        rows, found, a = [], [], 0
        while a < len(windows):
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + STEP, "right")))
            row = np.repeat(np.arange(a, b), least[a:b])
            rare = order[row, 0]
            first = self.begin[windows[row, rare]]
            nth = np.arange(len(row)) - np.repeat(ends[a:b] - least[a:b] - (ends[a - 1] if a else 0), least[a:b])
            place = self.places[first + nth] - windows[row, rare] * self.words - rare
            for k in range(1, size):
                offset = order[row, k]
                keep = self.has(windows[row, offset], place + offset)
                row, place = row[keep], place[keep]
            keep = (place >= 0) & (self.text_of(place) == self.text_of(place + size - 1))
            rows.append(row[keep])
            found.append(place[keep])
            a = b
        return np.concatenate([np.zeros(0, np.int64), *rows]), np.concatenate([np.zeros(0, np.int64), *found])

    def near(self, terms: np.ndarray, within: int) -> tuple[np.ndarray, np.ndarray]:
        """The shortest stretches of at most `within` words of one text that hold all the terms: begin, end."""
        lists = sorted((self.posting(t) for t in np.unique(terms)), key=len)
        start = np.unique(np.concatenate([  # where a stretch may begin: a term, close to the rarest one
            p[self._close(p, lists[0], within)] for p in lists
        ]))
        last = start.copy()
        for p in lists:
            nth = np.searchsorted(p, start)
            start, last, nth = start[nth < len(p)], last[nth < len(p)], nth[nth < len(p)]
            last = np.maximum(last, p[nth])
        keep = (last - start < within) & (self.text_of(start) == self.text_of(last))
        start, last = start[keep], last[keep]
        shortest = np.append(last[1:] > last[:-1], True)[: len(last)]
        return start[shortest], last[shortest] + 1

    @staticmethod
    def _close(places: np.ndarray, rare: np.ndarray, within: int) -> np.ndarray:
        after = np.searchsorted(rare, places)
        return (after < len(rare)) & (rare[np.minimum(after, len(rare) - 1)] - places < within)


class Items:
    """A block of test items: names; terms: their distinct words; code: the words of all items, as numbers of terms;
    at: where each item begins, and the end."""

    def __init__(self, rows: pa.Table):
        self.names = [n or "" for n in rows["item"].to_pylist()]
        words, self.at = _tables(rows) if rows.num_rows else (pa.array([], pa.large_binary()), np.zeros(1, np.int64))
        coded = words.dictionary_encode()
        self.terms, self.code = coded.dictionary, np.asarray(coded.indices).astype(np.int64)

    def phrase_spans(self, shard: Shard, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Stretches of a text that occurrences of an item's windows make up: item, begin, end."""
        code = shard.lookup(self.terms)[self.code]
        lacking = np.concatenate([[0], np.cumsum(code < 0)])
        sizes = np.diff(self.at)
        out = []
        for size in np.unique(np.minimum(sizes[sizes > 0], window)).tolist():
            own = sizes >= window if size == window else sizes == size
            many = np.where(own, np.maximum(sizes, size) - size + 1, 0)
            item = np.repeat(np.arange(len(sizes)), many)
            begin = self.at[item] + np.arange(len(item)) - np.repeat(np.cumsum(many) - many, many)
            whole = lacking[begin + size] == lacking[begin]
            item, begin = item[whole], begin[whole]
            if not len(item):
                continue
            row, place = shard.phrases(np.lib.stride_tricks.sliding_window_view(code, size)[begin])
            out.append((item[row], place, place + size))
        return self._merged(shard, out)

    def near_spans(self, shard: Shard, within: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Stretches that hold all words of an item, in any order: item, begin, end."""
        code = shard.lookup(self.terms)[self.code]
        out = []
        for i, (a, b) in enumerate(zip(self.at, self.at[1:])):
            if b > a and (code[a:b] >= 0).all():
                begin, end = shard.near(code[a:b], within)
                out.append((np.full(len(begin), i), begin, end))
        return tuple(np.concatenate([np.zeros(0, np.int64), *x]) for x in (zip(*out) if out else ((), (), ())))

    @staticmethod
    def _merged(shard: Shard, spans: list):
        if not spans:
            return (np.zeros(0, np.int64),) * 3
        item, begin, end = (np.concatenate(x) for x in zip(*spans))
        order = np.lexsort((end, begin, item))
        item, begin, end = item[order], begin[order], end[order]
        text = shard.text_of(begin)
        new = np.ones(len(item), bool)  # windows of an item are equally long, so ends rise with beginnings
        new[1:] = (item[1:] != item[:-1]) | (text[1:] != text[:-1]) | (begin[1:] > end[:-1])
        first = np.flatnonzero(new)
        return item[first], begin[first], end[np.append(first[1:], len(item))[: len(first)] - 1]


def _search(items: Items, how: str, size: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                shard = Shard(row.column("keys")[0], row.column("data")[0].as_py())
                item, begin, end = getattr(items, how)(shard, size)
                text = shard.text_of(begin)
                order = np.lexsort((end, begin, item, text))
                item, begin, end, text = item[order], begin[order], end[order], text[order]
                first = shard.at[text]
                texts = len(shard.at) - 1
                found = pa.StructArray.from_arrays(
                    [pa.array(items.names, pa.string()).take(pa.array(item)), pa.array(begin - first), pa.array(end - first)],
                    ["item", "start", "end"],
                )
                cuts = np.searchsorted(text, np.arange(texts + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(np.asarray(row.column(c)), texts)) for c in ("task", "number")]
                    + [pa.array(np.arange(texts)), row.column("keys").flatten(), pa.array(np.diff(shard.at)),
                       pa.ListArray.from_arrays(pa.array(cuts), found)],
                    ["task", "number", "row", "key", "n_words", "matches"],
                )

    return search


def build_index(docs: DataFrame, key: str, text: str, *, shard: int = 1 << 22) -> DataFrame:
    """The stored index of all texts. shard: bytes of text in a shard; one longer text has its own."""
    kind = docs.schema[key].dataType.simpleString()
    return stored(docs.select(
        F.col(key).alias("key"), F.col(text).cast("string").alias("text"), F.spark_partition_id().cast("long").alias("task"),
    ).mapInArrow(_index(shard), f"task long, number long, keys array<{kind}>, data array<binary>"))


def _searched(index: DataFrame, items: DataFrame, key: str, text: str, how: str, size: int, block: int) -> DataFrame:
    """Per document: task, number, row (which document), key, n_words, matches with all items."""
    if size < 1:
        raise ValueError("a phrase or stretch has at least one word")
    rows = items.select(F.col(key).cast("string").alias("item"), F.col(text).cast("string").alias("text")).filter(
        "text IS NOT NULL"
    ).distinct()
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block))
    kind = index.schema["keys"].dataType.elementType.simpleString()
    out = f"task long, number long, row long, key {kind}, n_words long, matches {MATCHES}"
    passes = []
    for b in range(blocks):
        here = rows.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b).orderBy("item", "text").toArrow()
        passes.append(index.mapInArrow(_search(Items(here), how, size), out))
    if blocks == 1:
        return passes[0]
    every = passes[0]
    for more in passes[1:]:
        every = every.unionByName(more)
    return every.groupBy("task", "number", "row").agg(
        F.first("key").alias("key"), F.max("n_words").alias("n_words"), F.flatten(F.collect_list("matches")).alias("matches")
    )


def phrase_search(
    index: DataFrame, items: DataFrame, key: str, text: str, *, window: int = 10, block: int = 1 << 23,
) -> DataFrame:
    """Per document: key, n_words, matches (item, first word, word after the last) and which document it is.

    A match is a stretch that occurrences of `window` consecutive words of one item make up; an item of
    fewer words is one window.
    """
    return _searched(index, items, key, text, "phrase_spans", window, block)


def proximity_search(
    index: DataFrame, items: DataFrame, key: str, text: str, *, within: int = 20, block: int = 1 << 23,
) -> DataFrame:
    """Like phrase_search; a match is a shortest stretch of at most `within` words with all the item's words."""
    return _searched(index, items, key, text, "near_spans", within, block)


def words_hit(matches: Column) -> Column:
    """Words inside any match of a document."""
    spans = F.array_sort(F.transform(matches, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"))))
    zero = F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).cast("long").alias("upto"))
    return F.aggregate(spans, zero, lambda s, m: F.struct(
        (s["hit"] + F.greatest(F.lit(0), m["end"] - F.greatest(m["start"], s["upto"]))).cast("long").alias("hit"),
        F.greatest(s["upto"], m["end"]).alias("upto"),
    ), lambda s: s["hit"])


def contamination(searched: DataFrame, key: str) -> DataFrame:
    """Per document: key, n_words, n_hit, items (ids of the items that match, sorted), matches."""
    items = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item"])))
    return searched.select(
        F.col("key").alias(key), "n_words", words_hit(F.col("matches")).alias("n_hit"), items.alias("items"), "matches"
    )
