"""Best-fit packing of tokenised documents into sequences, in bulk-synchronous rounds.

Documents longer than a sequence are cut into whole sequences, after a shorter first piece. A piece is known by its
length and its rank among pieces of that length; a sequence that still has a gap by its number. Both are stored
tables. In each round

- pieces that are left and gaps are counted by size, and the sizes are put in order;
- a sweep over these counts (at most `capacity` of each kind, whatever the number of documents) leads pieces,
  the longest first, to their successors, the smallest gaps that are large enough: a gap takes as many equal pieces as
  fit, and once per round. The longest of the others open sequences, as many as must be opened anyway: one for each
  piece longer than half a sequence, and so many that all gaps can hold what is left, or one if nothing fits;
- conflicts are settled by rank: gaps of a size are ranked, the n-th takes the n-th pieces of the length
  that the sweep led there, by a join of the table of gaps with the sweep's runs;
- gaps are updated and stored, and what found none waits for the next round.

Nothing but how many pieces are left reaches the driver. Ranks are dealt over lanes, so that a length or a gap that a
third of all rows have is no single task's.

Rules: a NULL text is empty and packs as its end mark alone; repeated rows and NULL ids pack like others; an
empty table gives no pieces.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import islice
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskmill.llm.ranks import ranked
from riskmill.llm.store import release, stored
from riskmill.llm.text import PART, slices

#: Words of a byte-level pre-tokenizer with `use_regex`, a fixed value of the file format, in letters that `re` knows.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"""
#: Texts of these characters alone are parted alike by every version of the character tables; numerals that are no
#: digits are left out, since `re` takes them for letters.
PLAIN = r"[\t\n\r -~\u00a1-\u00b1\u00b4-\u00b8\u00ba\u00bb\u00bf-\u024f]*"
#: Words whose ids a task keeps at once, and how many of them, those that came first, the worker's next task still has.
CACHE, FIRST = 1 << 19, 1 << 17


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: the printable ones of Latin-1 stand for themselves,
    the others for letters from 256 on, in order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = sorted(set(range(256)).difference(printable))
    return {b: chr(b) for b in printable} | {b: chr(256 + n) for n, b in enumerate(others)}


def tokenizer_path(name: str) -> str:
    """The place of a public tokenizer's file, which each machine has."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Words(dict):
    """The ids of words as little-endian bytes, found when first asked for; at most `CACHE` are kept."""

    def __init__(self, model):
        self.tokenize, self.letters = model.tokenize, byte_letters()

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHE:
            self.shrink()
        if word.isascii() and word.isprintable():
            letters = word.replace(" ", self.letters[0x20])
        else:
            letters = word.encode().decode("latin-1").translate(self.letters)
        ids = [t.id for t in self.tokenize(letters)]
        self[word] = found = struct.pack(f"<{len(ids)}I", *ids)
        return found

    def shrink(self) -> None:
        """Gives back all but the words that came first, which are the frequent ones."""
        first = dict(islice(self.items(), FIRST))
        self.clear()
        self.update(first)


class Encoder:
    """Token ids as little-endian bytes, by the tokenizers library.

    A byte-level BPE without normalizer encodes word by word, so each word goes through the library's model once and its
    ids are kept for the task. That holds if the file says so and the text has only characters that are parted
    alike everywhere, and no added token; any other text goes through the library as a whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words = Words(self.tokenizer.model)
        file = json.loads(Path(path).read_text())
        parts, model = file.get("pre_tokenizer") or {}, file["model"]
        by_words = (
            file.get("normalizer") is None and parts.get("type") == "ByteLevel" and parts.get("use_regex", True)
            and not parts.get("add_prefix_space", True) and model.get("type") == "BPE" and not model.get("dropout")
            and not file.get("truncation") and not file.get("padding")
        )
        added = [re.escape(t["content"]) for t in file.get("added_tokens") or []]
        self.parts = re.compile(PATTERN).findall if by_words else None
        self.plain = re.compile(PLAIN).fullmatch
        self.added = re.compile("|".join(added)).search if added else lambda text: None

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        return [self._ids(text) for text in texts]

    def _ids(self, text: str) -> bytes:
        if self.parts is None or not self.plain(text) or self.added(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.words.__getitem__, self.parts(text)))


@cache
def encoder(path: str) -> Encoder:
    """One for all tasks of a worker."""
    return Encoder(path)


def _pieces(path: str, end: int, capacity: int, with_ids: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = np.array([end], "<u4").tobytes()
        names = ["id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * with_ids
        try:
            for batch in batches:
                for part in slices(batch, "text", PART):
                    rows = []
                    texts = [text or "" for text in part.column("text").to_pylist()]
                    for key, data in zip(part.column("id").to_pylist(), encoder(path).encode(texts)):
                        data += last
                        n = len(data) // 4
                        head = n % capacity or capacity
                        for k, start in enumerate([0, *range(head, n, capacity)]):
                            length = capacity if k else head
                            ids = data[4 * start : 4 * (start + length)]
                            rows.append((key, k, start, length, zlib.crc32(ids)) + (ids,) * with_ids)
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
        finally:
            encoder(path).words.shrink()  # a worker that goes on with other stages holds little

    return cut


SWEPT = "kind string, gap long, gap_rank long, gaps long, length long, first long, pieces long, each long"


def _successors(sizes: list[int]):
    """Finds the place of the smallest size that is large enough and not used up; `use` takes one out."""
    after = list(range(len(sizes) + 1))

    def find(i: int) -> int:
        while after[i] != i:
            after[i] = after[after[i]]
            i = after[i]
        return i

    def use(i: int) -> None:
        after[i] = i + 1

    return find, use


def sweep(pieces: dict[int, tuple[int, int]], gaps: dict[int, int], capacity: int) -> list[tuple]:
    """One round over counts. pieces: by length, how many are left and the rank of the first; gaps: by size, how many.

    Runs: (fill, gap, rank of the first gap, gaps, length, rank of the first piece, pieces, pieces per gap); (open, the
    same of new sequences); (left, length, first rank and pieces that remain).
    """
    sizes = sorted(gaps)
    free = [gaps[s] for s in sizes]
    find, use = _successors(sizes)
    runs, left, room = [], [], sum(s * n for s, n in gaps.items())
    for length in sorted(pieces, reverse=True):
        many, first = pieces[length]
        i = find(int(np.searchsorted(sizes, length)))
        while many and i < len(sizes):
            each = sizes[i] // length
            taken = min(free[i], -(-many // each))
            placed = min(many, taken * each)
            runs.append(("fill", sizes[i], gaps[sizes[i]] - free[i], taken, length, first, placed, each))
            many, first, free[i], room = many - placed, first + placed, free[i] - taken, room - placed * length
            if not free[i]:
                use(i)
                i = find(i)
        if many:
            left.append((length, many, first))
    alone = sum(n for length, n, _ in left if 2 * length > capacity)  # no two of these share a sequence
    lacking = (sum(length * n for length, n, _ in left) - room) // capacity
    new = max(alone, lacking, int(not runs))
    for length, many, first in left:
        opened = min(many, new)
        new -= opened
        if opened:
            runs.append(("open", capacity, 0, opened, length, first, opened, 1))
        if many > opened:
            runs.append(("left", 0, 0, 0, length, first + opened, many - opened, 0))
    return runs


def _swept(capacity: int):
    def sweep_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for batch in batches for r in batch.to_pylist()]
        pieces = {r["size"]: (r["many"], r["first"]) for r in rows if r["kind"] == "piece"}
        runs = sweep(pieces, {r["size"]: r["many"] for r in rows if r["kind"] == "gap"}, capacity)
        names = [c.split()[0] for c in SWEPT.split(", ")]
        kinds = [pa.string()] + [pa.int64()] * 7
        columns = zip(*runs) if runs else [[]] * 8
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return sweep_counts


def _best_fit(pieces: DataFrame, capacity: int) -> list[DataFrame]:
    """Tables of placements (sequence, offset, length, rank of the first piece, pieces), one for each round.

    pieces: length, rank. A sequence is numbered by its first piece.
    """
    name = (F.col("length") * (1 << 44) + F.col("rank")).alias("sequence")
    left = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("pieces")).select(
        "length", F.lit(0).cast("long").alias("first"), "pieces"
    )
    gaps, rounds = None, []
    while True:
        sizes = left.select(F.lit("piece").alias("kind"), F.col("length").alias("size"), F.col("pieces").alias("many"), "first")
        if gaps is not None:
            sizes = sizes.unionByName(gaps.groupBy(F.col("gap").alias("size")).agg(F.count(F.lit(1)).alias("many")).select(
                F.lit("gap").alias("kind"), "size", "many", F.lit(0).cast("long").alias("first")
            ))
        runs = stored(sizes.repartition(1).mapInArrow(_swept(capacity), SWEPT))  # 2 * capacity rows at most
        # Runs are at most a few times `capacity`, so they can be sent to every task.
        opened = F.broadcast(runs.filter("kind = 'open'").select(F.col("length").alias("of"), "first", F.col("pieces").alias("all"), "each"))
        nth = F.col("rank") - F.col("first")
        now = pieces.join(opened, (F.col("length") == F.col("of")) & (nth >= 0) & (nth < F.col("all")) & (nth % F.col("each") == 0)).select(
            name, F.lit(capacity).cast("long").alias("gap"), "length", F.col("rank").alias("first"),
            F.least(F.col("each"), F.col("all") - nth).alias("pieces"),
        )
        if gaps is not None:
            filled = F.broadcast(runs.filter("kind = 'fill'").select(
                F.col("gap").alias("size"), "gap_rank", "gaps", "length", F.col("first").alias("start"), F.col("pieces").alias("all"), "each"
            ))
            nth = F.col("rank") - F.col("gap_rank")
            now = now.unionByName(ranked(gaps, "gap", ["sequence"]).join(
                filled, (F.col("gap") == F.col("size")) & (nth >= 0) & (nth < F.col("gaps")), "left"
            ).select(
                "sequence", "gap", "length", (F.col("start") + nth * F.col("each")).alias("first"),
                F.coalesce(F.least(F.col("each"), F.col("all") - nth * F.col("each")), F.lit(0)).cast("long").alias("pieces"),
            ))
        used = F.col("pieces") * F.coalesce("length", F.lit(0))
        now = stored(now.select(
            "sequence", (F.lit(capacity) - F.col("gap")).alias("offset"), "length", "first", "pieces", (F.col("gap") - used).alias("gap")
        ))
        rounds.append(now.filter("pieces > 0"))
        left = runs.filter("kind = 'left'").select("length", "first", "pieces")
        shortest = left.agg(F.min("length")).first()[0]
        if shortest is None:
            return rounds
        gaps = now.filter(F.col("gap") >= shortest).select("sequence", "gap")


def pack_documents(
    docs: DataFrame, key: str, text: str, tokenizer: str, *, end: int = 0, capacity: int = 2048, with_ids: bool = False,
) -> DataFrame:
    """Per piece: key, piece, start, length, ids_crc32, sequence_id, offset; and its ids if asked for.

    tokenizer: the path of a tokenizer file on every machine.
    """
    columns = "id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    cut = stored(docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(
        _pieces(tokenizer, end, capacity, with_ids), columns
    ))
    pieces = stored(ranked(cut, "length", ["id", "piece", "start", "ids_crc32"]).select(*cut.columns, "rank"))
    release(cut)
    every = None
    for placed in _best_fit(pieces.select("length", "rank"), capacity):
        every = placed if every is None else every.unionByName(placed)
    nth = F.posexplode(F.array_repeat(F.lit(0), F.col("pieces").cast("int"))).alias("nth", "_")
    places = every.select("sequence", "offset", "length", "first", nth).select(
        "length", (F.col("first") + F.col("nth")).alias("rank"), F.col("sequence").alias("sequence_id"),
        (F.col("offset") + F.col("nth") * F.col("length")).alias("offset"),
    )
    return pieces.join(places, ["length", "rank"]).select(*cut.columns, "sequence_id", "offset").withColumnRenamed("id", key)


def sequences(packed: DataFrame) -> DataFrame:
    """Whole sequences from pieces packed with their ids: sequence_id, ids (little-endian), length."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids", "length")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.aggregate("parts", F.lit(b""), lambda x, p: F.concat(x, p["ids"])).alias("ids"),
        F.aggregate("parts", F.lit(0).cast("long"), lambda x, p: x + p["length"]).alias("length"),
    )
