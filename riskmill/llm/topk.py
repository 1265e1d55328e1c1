"""Exact top-k by inner product, with a table of distances to pivots.

Vectors are integers: floor(scale * x). For a query q, a candidate x and a pivot p, the distance of q
and x is at least |d(q, p) - d(x, p)|; the largest of these lower bounds over all pivots gives an upper
bound of the inner product, (|q|^2 + |x|^2 - d^2) / 2. Candidates are evaluated in the order of their
bounds until no bound reaches the k-th best score so far.

Queries and candidates are packed into blocks of the smallest integers that hold them; where two blocks meet, the
distances to the pivots are computed. A grid deals the blocks: candidates over its rows, queries over its columns,
and each pair of blocks meets in one cell, so the work of one length is spread over at most as many tasks as there are
shuffle partitions. The grid has the shape that sends the fewest copies. Both sides are shuffled and never broadcast:
Spark's estimates know nothing of the copies, and a broadcast would bring them all to the driver. What leaves a row
is at most k candidates per query. Pivots are the `pivots` rows with the smallest hash of the id: a fixed number.

Rules: vectors that are NULL, empty or hold NULL or non-finite components take no part, and neither do
those with a component whose integer does not fit a long. A score that does not fit a long is an error. Vectors of
different length do not meet. A repeated row is a candidate each time, but a query once; a query skips all rows
with its own id. NULL ids take no part. An empty table has no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskmill.llm.vectors import usable


def _packed(size: int):
    """Rows (id, v) to blocks: ids and components as bytes."""

    def block(ids: np.ndarray, x: np.ndarray) -> dict:
        kind = np.result_type(*(np.min_scalar_type(-abs(int(v)) - 1) for v in (x.min(), x.max())))
        return {"width": x.shape[1], "ids": ids.tobytes(), "x": x.astype(kind).tobytes()}

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("width", pa.int32()), ("ids", pa.binary()), ("x", pa.binary())])
        for batch in batches:
            ids = np.asarray(batch.column("id"))
            lists = batch.column("v")
            widths = np.asarray(lists.value_lengths())
            for width in np.unique(widths):
                chosen = np.flatnonzero(widths == width)
                x = np.asarray(lists.take(pa.array(chosen)).flatten()).reshape(len(chosen), width)
                made = [block(ids[chosen[a : a + size]], x[a : a + size]) for a in range(0, len(chosen), size)]
                if made:
                    yield pa.RecordBatch.from_pylist(made, schema)

    return pack


def _best(q_ids, q, q_d, c_ids, c, c_d, k: int, step: int = 64):
    """Exact best k of the candidates for every query: places of queries, ids and scores."""
    small = max(abs(int(a.max(initial=0))) + abs(int(a.min(initial=0))) for a in (q, c)) ** 2 * q.shape[1] < 2**53
    kind = np.float64 if small else np.int64  # doubles are exact here and much faster; longs may wrap on the way
    whole = (np.zeros((0, 0)), np.zeros((0, 0))) if small else (q.astype(float), c.astype(float))
    q, c = q.astype(kind), c.astype(kind)
    q_norm, c_norm = (q.astype(float) ** 2).sum(axis=1), (c.astype(float) ** 2).sum(axis=1)
    out = []
    for i in range(len(q)):
        lower = np.abs(c_d - q_d[i]).max(axis=1) if q_d.shape[1] else np.zeros(len(c))
        bound = (q_norm[i] + c_norm - lower * lower) / 2
        bound += 1e-9 * (q_norm[i] + c_norm) + 1  # what rounding can take from it
        bound[c_ids == q_ids[i]] = -np.inf
        order, done, width = np.argsort(-bound), 0, step
        ids, scores = np.zeros(0, np.int64), np.zeros(0, kind)
        while done < len(order):
            chunk = order[done : done + width]
            limit = float(scores[k - 1]) if len(scores) >= k else -np.inf
            chunk = chunk[(bound[chunk] >= limit) & (bound[chunk] > -np.inf)]
            if not len(chunk):
                break
            if not small and np.abs(whole[1][chunk] @ whole[0][i]).max() >= 2.0**63:
                raise ValueError(f"a score of {q_ids[i]} does not fit a long")
            new_ids, new = c_ids[chunk], c[chunk] @ q[i]
            if len(scores) >= k:  # what is below the k-th best need not be sorted
                near = new >= scores[k - 1]
                new_ids, new = new_ids[near], new[near]
            ids, scores = np.append(ids, new_ids), np.append(scores, new)
            top = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[top], scores[top]
            done, width = done + width, width * 2
        out.append((np.full(len(ids), q_ids[i]), ids, scores.astype(np.int64)))
    return [np.concatenate(column) for column in zip(*out)]


def _matched(pivots: dict[int, np.ndarray], k: int):
    """Pairs of blocks to the best k candidates for every query."""

    def read(ids: bytes, x: bytes, width: int):
        ids = np.frombuffer(ids, np.int64)
        x = np.frombuffer(x, f"i{len(x) // (len(ids) * width)}").reshape(-1, width).astype(np.int64)
        p = pivots.get(width, np.zeros((0, width)))
        return ids, x, np.sqrt(((x[:, None, :].astype(float) - p[None]) ** 2).sum(axis=2))

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, candidates = None, None  # a join gives a block of candidates with one block of queries after the other
        for batch in batches:
            for row in batch.to_pylist():
                block = row["ids"], row["x"], row["width"]
                if block != held:
                    held, candidates = block, read(*block)
                found = _best(*read(row["q_ids"], row["q_x"], row["width"]), *candidates, k)
                yield pa.RecordBatch.from_arrays([pa.array(f) for f in found], ["query_id", "vec_id", "score"])

    return match


def _grid(candidates: int, queries: int, block: int, query_block: int, cells: int) -> tuple[int, int]:
    """Rows and columns of a grid of at most so many cells, and no more of either than there are blocks.

    A candidate is sent to each column and a query to each row, which costs about twice, as its answers come back.
    """
    most, most_columns = max(1, -(-candidates // block)), max(1, -(-queries // query_block))
    rows = max(1, min(most, cells, round((cells * candidates / (2 * max(1, queries))) ** 0.5)))
    columns = max(1, min(most_columns, cells // rows))
    return min(most, cells // columns), columns


def nearest(
    vectors: DataFrame, key: str, vector: str, is_query: Column, *, k: int = 5, scale: float = 256.0,
    pivots: int = 16, block: int = 2048, query_block: int = 512,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k candidates with the highest inner product per query."""
    whole = vectors.filter(usable(F.col(vector)) & F.col(key).isNotNull()).filter(
        F.forall(vector, lambda x: F.abs(x.cast("double") * scale) < F.lit(2.0**63))
    ).select(
        F.col(key).cast("long").alias("id"), is_query.alias("asks"),
        F.transform(vector, lambda x: F.floor(x.cast("double") * scale)).alias("v"),
    )
    chosen: dict[int, list] = {}
    for row in whole.select("v").orderBy(F.xxhash64("id"), "id").limit(pivots).collect():
        chosen.setdefault(len(row.v), []).append(row.v)
    table = {width: np.array(rows, float) for width, rows in chosen.items()}
    size = whole.agg(F.count(F.lit(1)).alias("all"), F.count_if("asks").alias("asking")).first()
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows, columns = _grid(size["all"], size["asking"], block, query_block, parts)
    place = lambda n: F.pmod(F.xxhash64("ids"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    blocks = "width int, ids binary, x binary"
    candidates = whole.select("id", "v").mapInArrow(_packed(block), blocks).select(
        "width", "ids", "x", place(rows).alias("row"), every(columns).alias("column")
    )
    queries = whole.filter("asks").select("id", "v").dropDuplicates(["id", "v"]).repartition("id").mapInArrow(
        _packed(query_block), blocks
    ).select(
        "width", F.col("ids").alias("q_ids"), F.col("x").alias("q_x"), every(rows).alias("row"), place(columns).alias("column")
    )
    # The stated queries against all rows: every pair of blocks meets in the cell of its row and column.
    met = candidates.join(queries.hint("merge"), ["width", "row", "column"]).mapInArrow(
        _matched(table, k), "query_id long, vec_id long, score long"
    )
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
