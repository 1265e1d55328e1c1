"""Phrase collocations by SETM: relations of occurrences, extended one word at a time.

The first relation holds every word occurrence as (piece, place, word), sorted, in stored blocks of some MB. Each
round counts the phrases of one length over all blocks (groups are combined in a block before they move, see
`tallies`), keeps the occurrences of frequent phrases (a semi-join with the frequent groups) and stores
them as the next relation. Phrases one word longer come from a merge join of the relation with itself:
two frequent phrases at adjacent places of one piece overlap in all words but the outer two. Relations shrink
with every round, and a lost executor repeats its part of one round only.

A phrase is known by a 64-bit hash of its language and words; distinct phrases of one length would have
to pass some 10^9 before two of them are likely to share one. The block that owns a frequent phrase (one
does) returns its words and the counts of its parts, which the block has had answered before.

Rules: languages and texts may be NULL (`und`, empty); texts without words have no occurrences; repeated rows
count each time; ties in the report go by words in UTF-8 byte order; an empty table gives no rows. Columns
other than the two named are never read, so their names cannot clash.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from riskmill.llm import tallies
from riskmill.llm.store import release, stored
from riskmill.llm.text import Words, chunks, joined, slices

#: ASCII marks and line ends that part pieces, and the blanks within pieces.
PIECE_END = np.zeros(256, bool)
PIECE_END[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
BREAK = PIECE_END.copy()
BREAK[[0x20, 0x09]] = True

RELATION = "task long, number long, data array<binary>"
FOUND = "array<struct<lang:string,key:long,phrase:string,words:int,a:long,parts:array<long>>>"


def _bytes(data: bytes) -> bytes:
    return zstandard.compress(data, 1)


def picked(begin: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches laid end to end: where each begins, and the end; and the places that they are made of."""
    at = np.concatenate([[0], np.cumsum(sizes)])
    return at, np.repeat(begin - at[:-1], sizes) + np.arange(at[-1])


class Relation:
    """Occurrences of one block, in order of piece and place.

    word: number of each occurrence's word, frequent words first; follows: whether the next occurrence is the
    next word of the piece; total: of each word; names, name_at: the words' bytes; lang: of each word, a number
    in langs, each with its salt; keys: the words' hashes, which are not packed; longer: for each length from 2, (number of the frequent phrase that begins here or -1; totals).
    """

    def __init__(self, word, follows, total, names, name_at, lang, langs, longer=()):
        self.word, self.follows, self.total, self.longer = word, follows, total, list(longer)
        self.names, self.name_at, self.lang, self.langs = names, name_at, lang, langs
        salts = np.array([salt for _, salt in langs], np.int64).view(np.uint64)
        self.keys = joined(salts[lang], Words.of(names).hash(name_at[:-1], name_at[1:]))

    def pack(self) -> list[bytes]:
        out = [tallies.narrow(self.word), tallies.narrow(self.follows), tallies.narrow(self.total),
               _bytes(self.names.tobytes()), tallies.narrow(np.diff(self.name_at)), tallies.narrow(self.lang),
               json.dumps(self.langs).encode()]
        for code, total in self.longer:
            out += [tallies.narrow(code + 1), tallies.narrow(total)]
        return out

    @classmethod
    def unpack(cls, data: list[bytes]) -> Relation:
        word, follows, total, names, sizes, lang, langs = data[:7]
        wide = tallies.wide
        longer = [(wide(c) - 1, wide(t)) for c, t in zip(data[7::2], data[8::2])]
        return cls(
            wide(word), wide(follows).astype(bool), wide(total), np.frombuffer(zstandard.decompress(names), np.uint8),
            np.concatenate([[0], np.cumsum(wide(sizes))]), wide(lang), json.loads(langs), longer,
        )

    def level(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """The frequent phrase of a length at each place, or -1, and the totals of phrases."""
        return (self.word, self.total) if length == 1 else self.longer[length - 2]

    def joined(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of phrases of a length, from two frequent ones a word shorter at adjacent places, and their keys."""
        shorter = self.level(length - 1)[0]
        here = np.flatnonzero(self.follows[:-1] & (shorter[:-1] >= 0) & (shorter[1:] >= 0)) if len(shorter) else shorter
        key = self.keys[self.word[here]]
        for k in range(1, length):
            key = joined(key, self.keys[self.word[here + k]])
        return here, key

    def kept(self, keep: np.ndarray) -> Relation:
        """The occurrences kept; what followed an occurrence that goes follows nothing."""
        at = np.flatnonzero(keep)
        follows = self.follows[at] & np.append(np.diff(at) == 1, False)[: len(at)]
        words, word = np.unique(self.word[at], return_inverse=True)
        name_at, chosen = picked(self.name_at[words], np.diff(self.name_at)[words])
        return Relation(
            word, follows, self.total[words], self.names[chosen], name_at, self.lang[words], self.langs,
            [(code[at], total) for code, total in self.longer],
        )

    def text(self, place: int, length: int) -> str:
        at = self.name_at
        return b" ".join(
            self.names[at[w] : at[w + 1]].tobytes() for w in self.word[place : place + length]
        ).decode()


def _sizes(langs: pa.Array, counts: np.ndarray):
    by = pa.table({"lang": langs, "n": counts}).group_by("lang").aggregate([("n", "sum")])
    return by["lang"].to_pylist(), by["n_sum"].to_pylist()


def _first_relation(size: int):
    def relate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, table in chunks(batches, size):
            keys, follows, names, begins, ends, salted, langs, counts = ([] for _ in range(8))
            base = 0
            for batch in table.to_batches():
                for part in slices(batch, "text"):
                    words = Words(part.column("text"), BREAK)
                    passed = np.concatenate([[0], np.cumsum(PIECE_END[words.data], dtype=np.int32)])
                    after = np.append(words.start[1:], len(words.data))
                    same = passed[words.end] == passed[after]
                    same[words.word_at[1:][words.counts > 0] - 1] = False
                    salt = np.asarray(part.column("salt")).view(np.uint64)
                    keys.append(joined(np.repeat(salt, words.counts), words.hashes()))
                    follows.append(same)
                    names.append(words.data)
                    begins.append(words.start + base)
                    ends.append(words.end + base)
                    base += len(words.data)
                    counts.append(words.counts)
                    langs.append(part.column("lang"))
                    salted.append(part.column("salt"))
            _, first, word, total = np.unique(
                np.concatenate(keys), return_index=True, return_inverse=True, return_counts=True
            )
            order = np.argsort(-total, kind="stable")
            first, total = first[order], total[order]
            begin, end = np.concatenate(begins)[first], np.concatenate(ends)[first]
            name_at, chosen = picked(begin, end - begin)
            folded = np.concatenate(names)[chosen].tobytes().lower()  # of bytes: A-Z alone
            every = pa.chunked_array(langs).combine_chunks().dictionary_encode()
            salts = pa.chunked_array(salted).combine_chunks()
            places = [np.flatnonzero(np.asarray(every.indices) == k)[0] for k in range(len(every.dictionary))]
            by_word = np.repeat(np.asarray(every.indices), np.concatenate(counts))[first]
            relation = Relation(
                np.argsort(order)[word], np.concatenate(follows), total, np.frombuffer(folded, np.uint8), name_at, by_word,
                [(l, salts[p].as_py()) for l, p in zip(every.dictionary.to_pylist(), places)],
            )
            names_of, sums = _sizes(every.cast(pa.string()), np.concatenate(counts))
            yield pa.RecordBatch.from_arrays(
                [table.column("task").combine_chunks()[:1], pa.array([number]), pa.array([relation.pack()], pa.list_(pa.binary())),
                 pa.array([names_of], pa.list_(pa.string())), pa.array([sums], pa.list_(pa.int64())),
                 pa.array([len(first)])],
                ["task", "number", "data", "langs", "sizes", "asked"],
            )

    return relate


def _asks(length: int, parts: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                relation = Relation.unpack(row["data"])
                if length == 1:
                    order = np.argsort(relation.keys)
                    keys, counts = relation.keys[order], relation.total[order]
                else:
                    keys, counts = tallies.counted(relation.joined(length)[1])
                yield from tallies.question(row["task"], row["number"], keys, counts, parts)

    return ask


def _found(relation: Relation, keys, first, total, owned, length: int, share: int):
    """The frequent phrases that this block owns, and shorter phrases that these make superfluous."""
    out, covered = [], []
    mine = np.flatnonzero(owned)
    cuts = []
    for k in range(1, length):
        (left, left_total), (right, right_total) = relation.level(k), relation.level(length - k)
        cuts += [left_total[left[first[mine]]], right_total[right[first[mine] + k]]]
    cuts = np.stack(cuts, 1) if cuts else np.zeros((0, 0))
    signed = keys.view(np.int64)
    for j, parts in zip(mine.tolist(), cuts.tolist()):
        place = int(first[j])
        out.append({
            "lang": relation.langs[relation.lang[relation.word[place]]][0], "key": int(signed[j]),
            "phrase": relation.text(place, length), "words": length, "a": int(total[j]), "parts": parts,
        })
    for k in range(2, length):
        code, totals = relation.level(k)
        for offset in range(length - k + 1):
            place = first[mine] + offset
            over = 100 * total[mine] >= share * totals[code[place]]
            key = relation.keys[relation.word[place[over]]]
            for i in range(1, k):
                key = joined(key, relation.keys[relation.word[place[over] + i]])
            covered.append(np.unique(key))
    return out, np.unique(np.concatenate([np.zeros(0, np.uint64), *covered])).view(np.int64)


FOUND_TYPE = pa.list_(pa.struct([
    ("lang", pa.string()), ("key", pa.int64()), ("phrase", pa.string()), ("words", pa.int32()), ("a", pa.int64()),
    ("parts", pa.list_(pa.int64())),
]))


def _next_relation(length: int, least: int, share: int, parts: int):
    """The relation of frequent phrases of a length, and those that the block owns."""
    schema = pa.schema([
        ("task", pa.int64()), ("number", pa.int64()), ("data", pa.list_(pa.binary())), ("found", FOUND_TYPE),
        ("covered", pa.list_(pa.int64())), ("asked", pa.int64()),
    ])

    def relate(key: tuple, rows: pa.Table, told: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return schema.empty_table()
        relation = Relation.unpack(rows["data"][0].as_py())
        found, covered = [], np.zeros(0, np.int64)
        if length == 1:
            order = np.argsort(relation.keys)
            relation.total[order], _ = tallies.answer(told, relation.keys[order], parts)
            keep = relation.total[relation.word] >= least
        else:
            here, phrase = relation.joined(length)
            keys, first, place = np.unique(phrase, return_index=True, return_inverse=True)
            total, owned = tallies.answer(told, keys, parts)
            often = total >= least
            code = np.full(len(relation.word), -1)
            code[here[often[place]]] = (np.cumsum(often) - 1)[place[often[place]]]
            found, covered = _found(relation, keys, here[first], total, owned, length, share)
            relation.longer.append((code, total[often]))
            keep = np.zeros(len(code) + length, bool)
            for k in range(length):
                keep[k : k + len(code)] |= code >= 0
            keep = keep[: len(code)]
        relation = relation.kept(keep)
        return pa.table([
            rows["task"], rows["number"], pa.array([relation.pack()], pa.list_(pa.binary())),
            pa.array([found], FOUND_TYPE), pa.array([covered], pa.list_(pa.int64())), pa.array([len(relation.word)]),
        ], schema=schema)

    return relate


def collocations(
    docs: DataFrame, text: str, lang: str, *, longest: int = 3, least: int = 10, share: int = 50, chunk: int = 6 << 20,
) -> DataFrame:
    """All candidates that no longer one makes superfluous: lang, phrase, words, a, l, r, n, score.

    longest: words of a phrase, 2 at least. least: occurrences of a candidate. share: in percent of a
    phrase's occurrences, from which a longer one around it drops it. The cut with the lowest score counts.
    """
    if longest < 2 or least < 1:
        raise ValueError("longest must be 2 or more, least 1 or more")
    spark = docs.sparkSession
    name = F.coalesce(F.col(lang).cast("string"), F.lit("und"))
    rows = docs.select(
        F.col(text).cast("string").alias("text"), name.alias("lang"), F.xxhash64(name).alias("salt"),
        F.spark_partition_id().cast("long").alias("task"),
    )
    relation = stored(rows.mapInArrow(
        _first_relation(chunk), RELATION + ", langs array<string>, sizes array<long>, asked long"
    ))
    sizes = relation.select(F.explode(F.arrays_zip("langs", "sizes")).alias("s")).groupBy(
        F.col("s.langs").alias("lang")
    ).agg(F.sum("s.sizes").alias("n"))
    sizes = stored(sizes)
    found, covered = [], []
    for length in range(1, longest + 1):
        parts = tallies.ranges(spark, relation.agg(F.coalesce(F.sum("asked"), F.lit(0))).first()[0])
        told = tallies.totals(relation.mapInArrow(_asks(length, parts), tallies.ASK), least)
        following = stored(relation.select("task", "number", "data").groupBy("task", "number").cogroup(
            told.groupBy("task", "number")
        ).applyInArrow(
            _next_relation(length, least, share, parts), f"{RELATION}, found {FOUND}, covered array<long>, asked long"
        ))
        if length < 3:
            release(relation)  # its rows live on in the next one; found phrases stay
        relation = following
        found.append(relation.select(F.explode("found").alias("f")).select("f.*"))
        covered.append(relation.select(F.explode("covered").alias("key")))
    every, dropped = found[1], covered[1]
    for more, drops in zip(found[2:], covered[2:]):
        every, dropped = every.unionByName(more), dropped.unionByName(drops)
    left = every.join(dropped.distinct(), "key", "left_anti")
    scores = F.expr("""transform(sequence(1, words - 1), k -> named_struct(
        'score', (CAST(1000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(15,0)) * CAST(a AS DECIMAL(15,0)))
                 div (CAST(parts[2 * k - 2] AS DECIMAL(18,0)) * CAST(parts[2 * k - 1] AS DECIMAL(18,0))),
        'k', k, 'l', parts[2 * k - 2], 'r', parts[2 * k - 1]))""")
    return left.withColumn("cut", F.array_min(scores)).join(sizes, "lang").select(
        "lang", "phrase", "words", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n",
        F.col("cut.score").alias("score"),
    )


def best_collocations(candidates: DataFrame, report: int, lanes: int = 16) -> DataFrame:
    """The first `report` candidates of each language: lang, rank, phrase, a, l, r, n, score.

    Counts by thousands of the score tell which candidates cannot be among them; of the others each lane of a
    language keeps its own first ones, so that no task ranks all of a large language even if all scores tie.
    """
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    every = stored(candidates.withColumn("step", F.floor(F.col("score") / 1000)))
    above = Window.partitionBy("lang").orderBy(F.col("step").desc()).rowsBetween(Window.unboundedPreceding, -1)
    steps = every.groupBy("lang", "step").count().withColumn("above", F.coalesce(F.sum("count").over(above), F.lit(0)))
    high = every.join(steps.filter(F.col("above") < report).select("lang", "step"), ["lang", "step"], "left_semi")
    within = Window.partitionBy("lang", "lane").orderBy(*order)
    first = high.withColumn("lane", F.pmod(F.xxhash64("phrase"), F.lit(lanes))).withColumn(
        "place", F.row_number().over(within)
    ).filter(F.col("place") <= report)
    over = Window.partitionBy("lang").orderBy(*order)
    return first.withColumn("rank", F.row_number().over(over).cast("long")).filter(F.col("rank") <= report).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
