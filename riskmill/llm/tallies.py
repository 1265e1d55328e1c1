"""Counts over a whole corpus of the keys that each of its blocks asks for.

A block (a few MB of texts, worked on by one task) asks for the distinct 64-bit keys that it needs, each with how
often the block holds it. Askers of one hash range meet in one group, which adds the counts up and answers
every block in the order of its question. A key in all texts is asked for once per block, so it is
no burden; keys of a range are bounded, since the number of ranges follows the number of keys.

Keys travel sorted, as the differences of neighbours, byte plane by byte plane, compressed; counts as the
narrowest integers that hold them. An answer names the digest of its question: an answer to another
question, which a block that was cut otherwise would get, is an error and never a wrong count.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession

ASK = "part long, task long, number long, keys binary, counts binary"
TOLD = "task long, number long, part long, digest long, totals binary, even long"

#: Keys that one group adds up at a time, more or less.
RANGE_KEYS = 4_000_000


def planes(x: np.ndarray) -> bytes:
    """The first bytes of all numbers, then the second ones and so on, which packs better than number by number."""
    return zstandard.compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes(), 1)


def narrow(x: np.ndarray) -> bytes:
    """Non-negative numbers in as few bytes each as the largest needs, compressed."""
    kind = next(k for k in "BHIQ" if len(x) == 0 or int(x.max()) < 1 << (8 * np.dtype(k).itemsize))
    return kind.encode() + planes(np.ascontiguousarray(x).astype("<" + kind))


def wide(data: bytes) -> np.ndarray:
    kind = np.dtype("<" + data[:1].decode())
    flat = np.frombuffer(zstandard.decompress(data[1:]), np.uint8).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(flat.T).view(kind).reshape(-1).astype(np.int64)


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys in few bytes."""
    return planes(np.diff(keys, prepend=np.uint64(0)).astype("<u8"))


def unpack_keys(data: bytes) -> np.ndarray:
    flat = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(flat.T).view("<u8").reshape(-1), dtype=np.uint64)


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often each occurs."""
    every = np.sort(keys)
    first = np.flatnonzero(np.diff(every, prepend=every[:1] ^ np.uint64(1)))
    return every[first], np.diff(first, append=len(every))


def ranges(spark: SparkSession, keys: int) -> int:
    """Hash ranges for about this many asked keys."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-keys // RANGE_KEYS))


def _spread(parts: int) -> np.uint64:
    return np.uint64((1 << 64) // parts + 1)


def question(task: int, number: int, keys: np.ndarray, counts: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    """The rows that ask for sorted distinct keys: one for each hash range that has any."""
    of = (keys // _spread(parts)).astype(np.int64)
    here = np.unique(of)
    cuts = np.searchsorted(of, np.append(here, parts))
    rows = [(int(p), task, number, pack_keys(keys[a:b]), narrow(counts[a:b])) for p, a, b in zip(here, cuts, cuts[1:])]
    if rows:
        kinds = [pa.int64()] * 3 + [pa.binary()] * 2
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["part", "task", "number", "keys", "counts"]
        )


def _added(least: int):
    def add(key: tuple, asks: pa.Table) -> pa.Table:
        asks = asks.sort_by([("task", "ascending"), ("number", "ascending")])
        packed = asks["keys"].to_pylist()
        asked = [unpack_keys(k) for k in packed]
        every = np.concatenate(asked)
        known, first, place = np.unique(every, return_index=True, return_inverse=True)
        total = np.bincount(place, np.concatenate([wide(c) for c in asks["counts"].to_pylist()]), len(known))
        total = total.astype(np.int64)
        total[total < least] = 0
        told = 2 * total[place]
        told[first] += total > 0  # the first asker owns the key
        cuts = np.cumsum([0, *map(len, asked)])
        even = int(((total > 0) & (known & np.uint64(1) == 0)).sum())
        return pa.table({
            "task": asks["task"], "number": asks["number"], "part": asks["part"],
            "digest": pa.array([zlib.crc32(k) for k in packed], pa.int64()),
            "totals": pa.array([narrow(told[a:b]) for a, b in zip(cuts, cuts[1:])], pa.binary()),
            "even": pa.array([even, *[0] * (len(asked) - 1)], pa.int64()),
        })

    return add


def totals(asks: DataFrame, least: int = 1) -> DataFrame:
    """The answers, by block and hash range, to rows of `question`; totals below `least` become 0.

    The column `even` adds up to the number of distinct even keys with a total, so that an asker who keeps one
    kind of key even learns how many of that kind there are.
    """
    return asks.groupBy("part").applyInArrow(_added(least), TOLD)


def answer(told: pa.Table, keys: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """For the sorted keys that a block asked for: the total of each, and whether this block owns it.

    Each key that any block asked for and whose total is above 0 has one owner.
    """
    rows = told.sort_by("part")
    of = (keys // _spread(parts)).astype(np.int64)
    cuts = np.searchsorted(of, np.append(np.unique(of), parts))
    if rows.num_rows != len(cuts) - 1 or any(
        zlib.crc32(pack_keys(keys[a:b])) != d for a, b, d in zip(cuts, cuts[1:], rows["digest"].to_pylist())
    ):
        raise ValueError("a block has other keys than it asked for")
    totals, owned = np.empty(len(keys), np.int64), np.empty(len(keys), bool)
    for a, b, data in zip(cuts, cuts[1:], rows["totals"]):
        both = wide(data.as_py())
        totals[a:b], owned[a:b] = both >> 1, both & 1
    return totals, owned
