"""Conversation repair by weighted CYK interval parsing.

A sound conversation reads (s?(ua)+)? in the initials of its roles. The repair grammar has a nonterminal [p q] for
every two states of that form: what leads from p to q. In Chomsky normal form [p q] -> [p r] [r q], and [p q]
derives a single row by an edit: Keep, Rerole or Delete. The insertion closure puts inserted turns on
both sides of every row. A chart cell holds, for the rows of one span and every nonterminal, the cheapest
(cost, audit); cells of longer spans are combined from those of shorter ones, by length. Of two audits of
one span at one cost none begins with the other (insertions alone could lengthen it, and they cost), so
the least audit of a whole is made of least audits of its parts, and cells of neighbouring spans can be
combined in any order.

That is what keeps long conversations apart: a chart covers a block of `BLOCK` rows, blocks of a conversation are
combined in pairs of equal length, and the rows of all conversations are range partitioned by
conversation and place, so that a conversation with a third of all rows is parsed by many tasks, each of which
returns one cell. Equal rows of one turn are counted before they move. Charts depend on the kinds of rows only and
are kept for conversations alike. The last pass reads the rows of a conversation in order, one at a time, since a
digest of the whole text cannot be put together from parts; it holds one batch.

Rules: NULL role or text counts as one space. Rows go by turn (NULL first), role and text; copies within a
turn stand together. A row's first fault counts: blank, duplicate (role and text seen earlier), truncated. NULL
conversations are one conversation. Conversations whose rows are all absent have zeros, no audit and
the digest of nothing; an empty table has no rows. Columns not named are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from riskmill.llm.store import stored

WHITE = " \t\n\x0b\x0c\r"

#: Fixed values of the repair: costs of the edits, and of leaving a truncated row.
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5

#: What a role's initial does to a state: 0 nothing yet, 1 after s, 2 after u, 3 after a.
STEPS = {"s": ((0, 1),), "u": ((0, 2), (1, 2), (3, 2)), "a": ((2, 3),)}
TURNS = STEPS["u"] + STEPS["a"]
ENDS = (0, 3)
BLOCK = 8

Cell = dict[tuple[int, int], tuple[int, str]]


def _best(cell: Cell, nonterminal: tuple[int, int], item: tuple[int, str]) -> None:
    if nonterminal not in cell or item < cell[nonterminal]:
        cell[nonterminal] = item


def joined(left: Cell, right: Cell) -> Cell:
    """[p q] of two neighbouring spans: the best of all [p r] [r q]."""
    out: Cell = {}
    for (p, r), (cost, audit) in left.items():
        for q in range(4):
            if (r, q) in right:
                more, rest = right[r, q]
                _best(out, (p, q), (cost + more, audit + rest))
    return out


def _closure() -> Cell:
    """Inserted turns alone: from any state to any that they reach."""
    out: Cell = {(q, q): (0, "") for q in range(4)}
    for _ in range(3):
        for (p, r), (cost, audit) in list(out.items()):
            for a, q in TURNS:
                if a == r:
                    _best(out, (p, q), (cost + INSERT, audit + "I"))
    return out


NOTHING = _closure()


@lru_cache(maxsize=None)
def row_cell(kind: str) -> Cell:
    """One row with insertions around it. kind: x must go; else the role's initial (o: another), a capital if truncated."""
    edits: Cell = {(q, q): (DELETE, "D") for q in range(4)}
    if kind != "x":
        left = TRUNCATED * kind.isupper()
        for step in TURNS:
            _best(edits, step, (REROLE + left, "R"))
        for step in STEPS.get(kind.lower(), ()):
            _best(edits, step, (left, "K"))
    return joined(joined(NOTHING, edits), NOTHING)


@lru_cache(maxsize=1 << 14)
def chart(kinds: str) -> Cell:
    """The cell over all rows of a block: every span from its splits, bottom-up by length."""
    n = len(kinds)
    cells = {(i, i + 1): row_cell(k) for i, k in enumerate(kinds)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            best: Cell = {}
            for k in range(i + 1, i + length):
                for nonterminal, item in joined(cells[i, k], cells[k, i + length]).items():
                    _best(best, nonterminal, item)
            cells[i, i + length] = best
    return cells[0, n]


class Parse:
    """The rows of one conversation read so far: cells of blocks, combined in pairs of equal length."""

    def __init__(self):
        self.kinds, self.done = "", []

    def add(self, kinds: str) -> None:
        self.kinds += kinds
        while len(self.kinds) >= BLOCK:
            self._push(1, chart(self.kinds[:BLOCK]))
            self.kinds = self.kinds[BLOCK:]

    def _push(self, size: int, cell: Cell) -> None:
        while self.done and self.done[-1][0] == size:
            cell = joined(self.done.pop()[1], cell)
            size *= 2
        self.done.append((size, cell))

    def cell(self) -> Cell:
        out = chart(self.kinds) if self.kinds else NOTHING
        for _, cell in reversed(self.done):
            out = joined(cell, out)
        return out


def repair(cell: Cell) -> tuple[int, str]:
    """The cheapest way to a sound conversation: cost and audit."""
    return min(cell[0, q] for q in ENDS if (0, q) in cell)


#: A stretch of one conversation in one task, and what joins it to the next stretch.
SEGMENT = (
    "segment int, blank long, duplicate long, truncated long, illegal long, first string, last string, "
    "low long, high long, turns long, first_turn long, last_turn long, costs array<long>, audits array<string>"
)
LEGAL = ("su", "ua", "au")


class Stretch:
    """Counts and parse of neighbouring rows of a conversation."""

    def __init__(self):
        self.parse, self.counts = Parse(), [0, 0, 0, 0]
        self.first = self.last = self.low = self.high = self.first_turn = None
        self.turns = 0

    def add(self, turn, initial, blank, truncated, seen, many) -> None:
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn
        bad = many if blank else 0
        copies = 0 if blank else many - (not seen)
        short = bool(truncated and not blank and not seen)
        legal = self.last is None or self.last + initial in LEGAL
        illegal = many - 1 + (not legal)  # two equal initials are never legal
        self.counts = [a + b for a, b in zip(self.counts, (bad, copies, short, illegal))]
        self.first = initial if self.first is None else self.first
        self.last = initial
        kind = "x" if blank or seen else initial if initial in STEPS else "o"
        self.parse.add((kind.upper() if short else kind) + "x" * (many - 1))

    def row(self) -> tuple:
        cell = self.parse.cell()
        every = [cell.get((p, q)) for p in range(4) for q in range(4)]
        return (*self.counts, self.first, self.last, self.low, self.high, self.turns, self.low, self.high,
                [c and c[0] for c in every], [c and c[1] for c in every])


def _cell(costs: list, audits: list) -> Cell:
    return {(i // 4, i % 4): (c, a) for i, (c, a) in enumerate(zip(costs, audits)) if c is not None}


def _segments(schema: pa.Schema):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, segment, held, out = None, None, None, []
        for batch in batches:
            for key, segment, turn, initial, blank, truncated, seen, many in zip(*(c.to_pylist() for c in batch.columns)):
                if held is None or key != conv:
                    if held is not None:
                        out.append((conv, segment, *held.row()))
                    conv, held = key, Stretch()
                if many:
                    held.add(turn, initial, blank, truncated, seen, many)
            if len(out) > 1000:
                yield _batch(out, schema)
                out = []
        if held is not None:
            out.append((conv, segment, *held.row()))
        if out:
            yield _batch(out, schema)

    return read


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


class Walk:
    """One conversation in the last pass: its stretches joined, then its rows as the audit edits them."""

    def __init__(self):
        self.counts, self.cell, self.last, self.turn = [0, 0, 0, 0], NOTHING, None, None
        self.low = self.high = None
        self.turns, self.audit, self.at, self.state, self.place = 0, None, 0, 0, 0
        self.digest = hashlib.sha256()

    def stretch(self, counts, first, last, low, high, turns, first_turn, last_turn, costs, audits) -> None:
        self.counts = [a + b for a, b in zip(self.counts, counts)]
        if self.last is not None and first is not None:
            self.counts[3] += self.last + first not in LEGAL
        self.last = last if last is not None else self.last
        self.turns += turns - (first_turn is not None and first_turn == self.turn)
        self.turn = last_turn if last_turn is not None else self.turn
        self.low = low if self.low is None else self.low
        self.high = high if high is not None else self.high
        self.cell = joined(self.cell, _cell(costs, audits))

    def _said(self, edit: str, role: str | None, text: str) -> tuple:
        wanted = "a" if self.state == 2 else "u"
        if edit == "K":
            wanted = role[:1]
        else:
            role = "assistant" if wanted == "a" else "user"
        self.state = dict(STEPS[wanted])[self.state]
        self.digest.update(("\n" * (self.place > 0) + f"{role}:{text}").encode())
        self.place += 1
        return self.place - 1, edit, role, text

    def _start(self) -> None:
        if self.audit is None:
            self.cost, self.audit = repair(self.cell)

    def inserted(self) -> Iterator[tuple]:
        self._start()
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            yield self._said("I", None, "")

    def row(self, role: str, text: str) -> Iterator[tuple]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            yield self._said(edit, role, text)

    def result(self) -> tuple:
        self._start()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return gaps, *self.counts, self.cost, self.audit, self.digest.hexdigest()


def _walked(schema: pa.Schema, turns: bool):
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, held, out = None, None, []

        def close():
            rest = [(conv, *x) for x in held.inserted()]
            return rest if turns else [(conv, *held.result())]

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                key, segment, *facts = row[:15]
                if held is None or key != conv:
                    out += close() if held is not None else []
                    conv, held = key, Walk()
                if segment is not None:
                    held.stretch(facts[:4], *facts[4:])
                    continue
                said = held.row(row[15], row[16])
                if turns:
                    out += [(conv, *x) for x in said]
                else:
                    for _ in said:
                        pass
            if len(out) > 1000:
                yield _batch(out, schema)
                out = []
        if held is not None:
            out += close()
        if out:
            yield _batch(out, schema)

    return walk


def _prepared(rows: DataFrame, conv: str, turn: str, role: str, text: str, present: Column):
    said = F.coalesce(F.col(text).cast("string"), F.lit(" "))
    return rows.select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"), said.alias("text"),
        F.unhex(F.sha2(said.cast("binary"), 256)).alias("mark"), F.coalesce(present, F.lit(False)).alias("present"),
    )


def _repair(rows: DataFrame, conv, turn, role, text, present, turns: bool) -> DataFrame:
    every = _prepared(rows, conv, turn, role, text, F.lit(True) if present is None else present)
    kind = every.schema["conv"].dataType.simpleString()
    here = every.filter("present")
    said = F.rtrim(F.col("text"), F.lit(WHITE))
    counted = here.groupBy("conv", "role", "mark", "turn").agg(
        F.count(F.lit(1)).alias("many"), F.first(said == "").alias("blank"),
        F.first(~F.substring(said, -1, 1).isin(".", "!", "?")).alias("truncated"),
    )
    earliest = counted.groupBy(
        F.col("conv").alias("c"), F.col("role").alias("r"), F.col("mark").alias("m")
    ).agg(F.min(F.struct("turn")).alias("earliest"))
    seen = counted.join(
        earliest, F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("mark") == F.col("m"))
    ).select("conv", "turn", "role", "mark", "blank", "truncated", (~F.col("turn").eqNullSafe(F.col("earliest.turn"))).alias("seen"), "many")
    none = every.select("conv").distinct().select(
        "conv", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit(None).cast("binary").alias("mark"),
        F.lit(True).alias("blank"), F.lit(False).alias("truncated"), F.lit(False).alias("seen"), F.lit(0).cast("long").alias("many"),
    )
    place = ["conv", "turn", "role", "mark"]
    ordered = seen.unionByName(none).repartitionByRange(*place).sortWithinPartitions(*place).select(
        "conv", F.spark_partition_id().alias("segment"), "turn", F.substring("role", 1, 1).alias("initial"),
        "blank", "truncated", "seen", "many",
    )
    fields = rows.sparkSession.createDataFrame([], f"conv {kind}, {SEGMENT}").schema
    segments = stored(ordered.mapInArrow(_segments(_arrow(fields)), fields))
    lines = segments.withColumns({
        "role": F.lit(None).cast("string"), "text": F.lit(None).cast("string"), "turn": F.lit(None).cast("long"),
        "mark": F.lit(None).cast("binary"),
    }).unionByName(here.drop("present"), allowMissingColumns=True)
    in_order = lines.withColumn("row", F.col("segment").isNull()).repartition("conv").sortWithinPartitions(
        "conv", "row", "segment", "turn", "role", "mark"
    )
    out = f"conv {kind}, " + (
        "place long, edit string, role string, text string" if turns else
        "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    )
    result = rows.sparkSession.createDataFrame([], out).schema
    facts = [f.name for f in fields]
    return in_order.select(*facts, "role", "text").mapInArrow(
        _walked(_arrow(result), turns), result
    ).withColumnRenamed("conv", conv)


def _arrow(schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def repair_conversations(
    rows: DataFrame, conv: str, turn: str, role: str, text: str, *, present: Column | None = None
) -> DataFrame:
    """Per conversation: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    present: rows that are there; a conversation without any still has its row.
    """
    return _repair(rows, conv, turn, role, text, present, False)


def repaired_turns(
    rows: DataFrame, conv: str, turn: str, role: str, text: str, *, present: Column | None = None
) -> DataFrame:
    """The repaired conversations: conv, place (from 0), edit (K, R or I), role, text."""
    return _repair(rows, conv, turn, role, text, present, True)


def damaged(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows with planted faults, by the hash of conversation and turn; `present` is false for those that go."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(blank(conv), F.lit(":"), blank(turn))) % 20
    said = F.when(fate == 1, F.lit("")).when(fate == 2, F.translate(blank(text), ".!?", "")).otherwise(blank(text))
    return rows.select(
        F.col(conv).alias(conv), F.col(turn).alias(turn),
        F.when(fate == 4, F.lit("user")).otherwise(blank(role)).alias(role), said.alias(text),
        (fate != 0).alias("present"), F.explode(F.array_repeat(F.lit(0), F.when(fate == 3, 2).otherwise(1))).alias("_copy"),
    ).drop("_copy")
