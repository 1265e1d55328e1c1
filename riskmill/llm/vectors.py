"""Near-duplicate vectors: cross-polytope hashing after fast rotations, with verified pairs.

Equal vectors become one with a count. Each table of the hash rotates a vector `polytopes` times by
random signs and Hadamard transforms and takes the nearest corner (coordinate and sign) each time; the
corners together name a bucket. A vector stands in its own bucket of every table, and also looks into
the `probes` buckets that it came closest to, by exchanging corners for the next best.

Within a bucket, vectors are compared in blocks by their cosine in double precision. What leaves it is
no list of pairs but, for each vector, how many vectors it links with and the smallest one of its
group there. A pair that meets in several buckets is counted where it meets first, which its two
vectors' bucket numbers tell. Buckets with more than `block` rows are cut into blocks, and each pair
of blocks is compared by a task of its own; nothing is capped.

Rules: vectors that are NULL, empty, zero or hold NULL or non-finite components link with nothing;
vectors of different length do not meet. Repeated rows are vectors of their own that link with each
other. NULL ids are kept: such rows link, but name no component unless all ids there are NULL.

Set `polytopes` so that (2 x dimensions) ** polytopes is near the number of vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from riskmill.llm.components import components
from riskmill.llm.store import stored
from riskmill.llm.text import mixed


def usable(vector: Column) -> Column:
    """Not NULL or empty, and all components finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of rows whose length is a power of two."""
    n, h = x.shape[1], 1
    while h < n:
        x = x.reshape(len(x), -1, 2, h)
        x = np.concatenate([x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]], axis=2).reshape(-1, n)
        h *= 2
    return x


def rotated(x: np.ndarray, seed: int) -> np.ndarray:
    """Three times random signs and a transform: close to a random rotation."""
    width = 1 << max(1, (x.shape[1] - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, width - x.shape[1])))
    signs = np.random.default_rng(seed).integers(0, 2, (3, width)) * 2.0 - 1
    for s in signs:
        x = hadamard(x * s)
    return x


def buckets(x: np.ndarray, tables: int, polytopes: int, probes: int, seed: int) -> np.ndarray:
    """Bucket numbers by row, table, and 0 for its own or 1.. for its probes."""
    n = len(x)
    out = np.zeros((n, tables, 1 + probes), np.uint64)
    rows = np.arange(n)[:, None]
    for t in range(tables):
        corner = np.zeros((n, polytopes, 3), np.uint64)
        cost = np.zeros((n, polytopes, 3))
        for k in range(polytopes):
            y = rotated(x, seed + 7919 * t + 104729 * k)
            top = np.argsort(-np.abs(y), axis=1, kind="stable")[:, :3]
            value = y[rows, top]
            corner[:, k, : top.shape[1]] = (2 * top + (value < 0)).astype(np.uint64)
            corner[:, k, top.shape[1] :] = corner[:, k, :1]
            cost[:, k, : top.shape[1]] = np.abs(value[:, :1]) - np.abs(value)
            cost[:, k, top.shape[1] :] = np.inf
        # The best corner everywhere, then one or all exchanged for the second, or one for the third.
        choices = [[0] * polytopes]
        choices += [[c if j == k else 0 for j in range(polytopes)] for c in (1, 2) for k in range(polytopes)]
        choices.append([1] * polytopes)
        take = np.array(choices)
        at = np.arange(polytopes)
        price = (cost[:, at, take] ** 2).sum(axis=2)
        price[:, 0] = -1
        best = np.argsort(price, axis=1, kind="stable")[:, : 1 + probes]
        number = np.full((n, len(take)), np.uint64(t * 1_000_003 + x.shape[1]))
        for k in range(polytopes):
            number = mixed(number * np.uint64(131) + corner[:, k, take[:, k]] + np.uint64(1))
        found = number[rows, best]
        out[:, t, : found.shape[1]] = found
        out[:, t, found.shape[1] :] = found[:, :1]
    return out


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by the largest component first, so that no square overflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, width)


def _placed(tables: int, polytopes: int, probes: int, seed: int):
    """From the classes: one row for each bucket in which a class stands or looks."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            widths = np.asarray(whole.column("width"))
            for width in np.unique(widths):
                batch = whole.filter(pa.array(widths == width))
                for at in range(0, batch.num_rows, 2048):
                    part = batch.slice(at, 2048)
                    found = buckets(_matrix(part.column("x"), width), tables, polytopes, probes, seed)
                    each = tables * (1 + probes)
                    marks = [m.tobytes() for m in found]
                    take = pa.array(np.repeat(np.arange(part.num_rows), each))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(found.ravel().view(np.int64)),
                        pa.array(np.tile(np.repeat(np.arange(tables), 1 + probes), part.num_rows).astype(np.int32)),
                        pa.array(np.tile(np.arange(1 + probes) == 0, tables * part.num_rows)),
                        part.column("class").take(take), part.column("n").take(take), part.column("width").take(take),
                        pa.array(marks, pa.binary()).take(take), part.column("x").take(take),
                    ], ["bucket", "table", "own", "class", "n", "width", "marks", "x"])

    return place


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n items the smallest item that it reaches by the links (i, j)."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, i, least)
        np.minimum.at(root, j, least)
        root = root[root]
        if (root == before).all():
            return root


def _linked(cosine: float, probes: int):
    """From rows sorted by bucket and pair of blocks: per class its links there and its root."""

    def pairs_of(x, own, block, one, other):
        """Places (i, j) of linked rows, a few thousand rows at a time."""
        left = np.flatnonzero(block == one)
        right = np.flatnonzero(block == other)
        for a in range(0, len(left), 1024):
            i = left[a : a + 1024]
            hit = x[i] @ x[right].T >= cosine
            hit &= own[i][:, None] | own[right][None, :]
            if one == other:
                hit &= i[:, None] < right[None, :]
            p, q = np.nonzero(hit)
            if len(p):
                yield i[p], right[q]

    def group(rows: pa.RecordBatch | pa.Table):
        width = rows.column("width")[0].as_py()
        x = unit(_matrix(rows.column("x").combine_chunks() if isinstance(rows, pa.Table) else rows.column("x"), width))
        own, block = np.asarray(rows.column("own")), np.asarray(rows.column("block"))
        ids, n = np.asarray(rows.column("class")), np.asarray(rows.column("n"))
        marks = np.frombuffer(b"".join(rows.column("marks").to_pylist()), np.uint64).reshape(len(ids), -1, 1 + probes)
        here, bucket = rows.column("table")[0].as_py(), np.uint64(rows.column("bucket")[0].as_py() % (1 << 64))
        one, other = rows.column("one")[0].as_py(), rows.column("other")[0].as_py()
        links, ends = np.zeros(len(ids), np.int64), []
        for i, j in pairs_of(x, own, block, one, other):
            differ = ids[i] != ids[j]
            i, j = i[differ], j[differ]
            ends.append((i, j))
            first = np.ones(len(i), bool)
            for t in range(here + 1):
                a, b = marks[i, t], marks[j, t]
                same = a[:, 0] == b[:, 0]
                a_sees, b_sees = (b[:, :1] == a).any(axis=1), (a[:, :1] == b).any(axis=1)
                if t < here:
                    first &= ~(same | a_sees | b_sees)
                else:  # both may look into the other's bucket: it counts in the smaller one
                    first &= same | ~(a_sees & b_sees) | (np.minimum(a[:, 0], b[:, 0]) == bucket)
            links += np.bincount(i[first], n[j[first]], len(ids)).astype(np.int64)
            links += np.bincount(j[first], n[i[first]], len(ids)).astype(np.int64)
        if not ends:
            return None
        i, j = (np.concatenate(e) for e in zip(*ends))
        order = np.argsort(ids, kind="stable")
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        root = ids[order[_roots(len(ids), rank[i], rank[j])]][rank]
        told = np.unique(np.concatenate([i, j]))
        return ids[told], links[told], root[told]

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(found):
            return pa.RecordBatch.from_arrays([pa.array(f) for f in found], ["class", "links", "root"])

        names = ("bucket", "one", "other")
        rest: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            if rest is not None:
                rows = pa.concat_tables([rest, rows]).combine_chunks()
            keys = np.stack([np.asarray(rows.column(c)) for c in names])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1)]
            done = [f for a, b in zip(cuts, cuts[1:]) if b - a > 1 and (f := group(rows.slice(a, b - a)))]
            if done:
                yield told([np.concatenate(c) for c in zip(*done)])
            rest = rows.slice(cuts[-1])
        if rest is not None and rest.num_rows > 1 and (found := group(rest)):
            yield told(found)

    return link


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes of doubles, -0 as 0; NULL where a vector takes no part."""
    for batch in batches:
        vectors = [None if v is None else np.asarray(v, np.float64) + 0.0 for v in batch.column("v").to_pylist()]
        x = [None if v is None or not v.any() else v.tobytes() for v in vectors]
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(x, pa.binary())], ["id", "x"])


def near_duplicates(
    vectors: DataFrame, key: str, vector: str, *, cosine: float = 0.95, tables: int = 8, polytopes: int = 2,
    probes: int = 2, block: int = 4096, seed: int = 5,
) -> DataFrame:
    """Per row: the key, n_links, component_id (the smallest key it reaches), kept."""
    plain = vectors.select(
        F.col(key).cast("long").alias("id"),
        F.when(usable(F.col(vector)), F.col(vector).cast("array<double>")).alias("v"),
    )
    rows = plain.mapInArrow(_digests, "id long, x binary").withColumn("digest", F.sha2("x", 256))
    # min skips NULL ids: such rows take part, and a class of them alone stands under a number below all ids.
    unnamed = F.lit(-(1 << 63)) + F.pmod(F.xxhash64("digest"), F.lit(1 << 40))
    classes = stored(rows.filter("x IS NOT NULL").groupBy("digest").agg(
        F.min("id").alias("least"), F.count(F.lit(1)).alias("n"), F.min("x").alias("x"),
    ).select(
        "digest", "least", "n", "x", F.coalesce("least", unnamed).alias("class"),
        (F.length("x") / 8).cast("int").alias("width"),
    ))
    placed = classes.select("class", "n", "width", "x").mapInArrow(
        _placed(tables, polytopes, probes, seed),
        "bucket long, table int, own boolean, class long, n long, width int, marks binary, x binary",
    )
    crowded = stored(placed.groupBy("bucket").count().filter(F.col("count") > block)).select(
        "bucket", F.ceil(F.col("count") / block).cast("int").alias("blocks")
    )
    mine = F.pmod(F.xxhash64("class", F.lit(seed)), F.col("blocks")).cast("int")
    dealt = placed.join(crowded, "bucket", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn(
        "block", mine
    ).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumns(
        {"one": F.least("block", "with"), "other": F.greatest("block", "with")}
    )
    by = ["bucket", "one", "other"]
    found = stored(dealt.drop("with", "blocks").repartition(*by).sortWithinPartitions(*by).mapInArrow(
        _linked(cosine, probes), "class long, links long, root long"
    ))
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    groups = components(found, "class", "root").withColumnRenamed("node", "class")
    per_class = classes.select("digest", "least", "class", "n").join(links, "class", "left").join(groups, "class", "left")
    per_class = per_class.select(
        F.col("digest").alias("d"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"),
        F.coalesce("component_id", "class").alias("root"),
    )
    named = F.when(F.col("root") > F.lit(-(1 << 63) + (1 << 40)), F.col("root"))
    return rows.select("id", "digest").join(per_class, F.col("digest") == F.col("d"), "left").select(
        F.col("id").alias(key), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce(named, "id").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(False)))
