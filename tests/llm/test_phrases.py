"""Positional index, collocations and conversation repair against plain versions, with NULLs, ties and empty tables."""

import hashlib
import heapq
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskmill.llm import collocations, phrases, queries, repair, tallies

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, n_words long, matches string, key long, task long"


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(8)
    common = [f"c{i}" for i in range(25)]
    out = [" ".join(rng.choice(common, int(n))) for n in rng.integers(1, 90, 60)]
    passage = "The quick Brown fox, jumps over; the lazy dog. again and AGAIN it jumps over the fence"
    out += [f"{o} {passage}" for o in out[:12]] + [passage.replace(" ", "\n")] * 3
    out += [None, "", " \n.", "É é İ é É", "fox", "x " * 20_000 + passage, "a a a a a a a a a a a a a a", "ﬁ. c1 c2! c1 c2\tc1 c2"]
    return out


@pytest.fixture(scope="module")
def table(spark, texts):
    rows = [(i, t, [None, "en", "und", "de\nx"][i % 4], "s", 1, "m", 2, 3) for i, t in enumerate(texts)]
    rows += [rows[0], (None, texts[62], None, None, None, None, None, None), (None,) * 8]
    return spark.createDataFrame(rows, DOCS).repartition(4)


ITEMS = [
    (1, "quick brown fox jumps over the lazy dog again and again it jumps over the fence"), (2, "the lazy dog"),
    (3, "a " * 12), (4, "fox"), (5, None), (6, ""), (7, "not in any text at all"), (10, "c1 c2"), (10, "lazy dog"), (None, "É"),
    (12, "c1 c2 c3 c4 c5 c6 c7 c8 c9 c10 c11"),
]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def plain_hits(text, window=10):
    w, spans = words_of(text), defaultdict(set)
    for item, phrase in ITEMS:
        p = words_of(phrase)
        for i in range(max(1, len(p) - window + 1) if p else 0):
            part = p[i : i + window]
            for j in range(len(w) - len(part) + 1):
                if w[j : j + len(part)] == part:
                    spans["" if item is None else str(item)] |= set(range(j, j + len(part)))
    return len(w), len(set().union(*spans.values())), sorted(spans)


@pytest.mark.parametrize("shard, block", [(1 << 22, 1 << 23), (500, 40)])
def test_phrase_hits_equal_a_plain_search(table, items, shard, block):
    index = phrases.build_index(table, "doc_id", "text", shard=shard)
    found = phrases.contamination(phrases.phrase_search(index, items, "item_id", "text", block=block), "doc_id")
    got = Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in found.collect())
    want = Counter()
    for r in table.collect():
        n, hit, ids = plain_hits(r.text)
        want[r.doc_id, n, hit, tuple(ids)] += 1
    assert got == want


def test_proximity_finds_the_shortest_stretches(table, items, texts):
    index = phrases.build_index(table, "doc_id", "text", shard=800)
    found = phrases.proximity_search(index, items, "item_id", "text", within=7).collect()
    short = [r for r in found if r.key is not None and len(words_of(texts[r.key])) < 1000]
    assert any(r.matches for r in short)
    for r in short:
        w, want = words_of(texts[r.key]), set()
        for item, phrase in ITEMS:
            terms = set(words_of(phrase))
            fits = [
                (a, b) for a in range(len(w)) for b in range(a + 1, min(len(w), a + 7) + 1) if terms and terms <= set(w[a:b])
            ]
            want |= {
                ("" if item is None else str(item), a, b) for a, b in fits
                if not any((c, d) != (a, b) and c >= a and d <= b for c, d in fits)
            }
        assert {(m["item"], m["start"], m["end"]) for m in r.matches} == want


def test_index_of_nothing(spark, items):
    none = spark.createDataFrame([], DOCS)
    index = phrases.build_index(none, "doc_id", "text")
    assert phrases.contamination(phrases.phrase_search(index, items, "item_id", "text"), "doc_id").count() == 0
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    index = phrases.build_index(some, "doc_id", "text")
    empty = items.filter("false")
    (row,) = phrases.contamination(phrases.phrase_search(index, empty, "item_id", "text"), "doc_id").collect()
    assert (row.n_words, row.n_hit, row["items"]) == (2, 0, [])


def plain_collocations(rows, longest, least, share, report):
    f, n, out = defaultdict(Counter), Counter(), []
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i : i + k])] += 1
    for lang, counts in f.items():
        often = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        gone = {
            p[i:j] for p, a in often.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
            if j - i < len(p) and 100 * a >= share * counts[p[i:j]]
        }
        ranked = []
        for p, a in often.items():
            if p not in gone:
                score, k = min((10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
                ranked.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for i, (s, a, p, left, right) in enumerate(sorted(ranked)[:report]):
            out.append((lang, i + 1, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


@pytest.mark.parametrize("longest, least, share, report, chunk", [(3, 10, 50, 2000, 6 << 20), (4, 2, 30, 7, 700), (2, 1, 50, 50, 3000)])
def test_collocations_equal_plain_counts(table, longest, least, share, report, chunk):
    found = collocations.collocations(table, "text", "lang", longest=longest, least=least, share=share, chunk=chunk)
    got = sorted(map(tuple, collocations.best_collocations(found, report, lanes=3).collect()))
    assert got == plain_collocations([(r.text, r.lang) for r in table.collect()], longest, least, share, report)
    assert got


def test_collocations_of_nothing(table):
    assert collocations.collocations(table.filter("false"), "text", "lang").count() == 0
    assert collocations.collocations(table.filter("text IS NULL"), "text", "lang").count() == 0


def test_an_answer_to_another_question_is_an_error():
    keys = np.array([3, 9, (1 << 63) + 9], np.uint64)
    asked = pa.Table.from_batches(list(tallies.question(0, 0, keys, np.array([1, 2, 5]), 2)))
    told = pa.concat_tables([
        tallies._added(2)((p,), asked.filter(pa.compute.equal(asked["part"], p))) for p in (0, 1)
    ])
    total, owned = tallies.answer(told, keys, 2)
    assert total.tolist() == [0, 2, 5] and owned.tolist() == [False, True, True]
    with pytest.raises(ValueError):
        tallies.answer(told, keys + np.uint64(1), 2)


def plain_repair(rows):
    """The cheapest way by a search over (row, state), the least audit first."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
    seen, faults, counts = set(), [], [0, 0, 0]
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        fault = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else None
        if fault is not None:
            counts[fault] += 1
        seen.add((role, text))
        faults.append(fault)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    step = lambda q, c: {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}.get(c, {}).get(q)
    heap, done = [(0, "", 0, 0, ())], set()
    while True:
        cost, audit, i, q, said = heapq.heappop(heap)
        if i == len(rows) and q in (0, 3):
            return gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest()
        if (i, q) in done:
            continue
        done.add((i, q))
        new = [(c, role) for c, role in (("u", "user"), ("a", "assistant")) if step(q, c) is not None]
        for c, role in new:
            heapq.heappush(heap, (cost + 5, audit + "I", i, step(q, c), said + (role + ":",)))
        if i < len(rows):
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, q, said))
            if faults[i] in (None, 2):
                more, (_, role, text) = 5 * (faults[i] == 2), rows[i]
                if step(q, role[:1]) is not None:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, step(q, role[:1]), said + (f"{role}:{text}",)))
                for c, other in new:
                    heapq.heappush(heap, (cost + more + 1, audit + "R", i + 1, step(q, c), said + (f"{other}:{text}",)))


CHAT = "conv_id long, turn long, role string, text string, segment int, cost long, conv string, present string"


def chat(spark):
    rng = np.random.default_rng(4)
    roles, lines = ["system", "user", "assistant", "tool", "", None], ["Hi.", "What?", "no end", "ok! ", " \n", None, "", "Well.\n", "uno.", "é?"]
    rows = [
        (int(c) if c else None, [None, *range(12)][rng.integers(13)], roles[min(5, int(rng.integers(9)) % 6)], lines[rng.integers(10)], 1, 2, "x", "y")
        for c in range(60) for _ in range(int(rng.integers(1, 9)))
    ]
    rows += [(100, t, ["user", "assistant"][t % 2], f"turn {t}" + ".?!"[t % 3] * (t % 7 > 0), 1, 2, "x", "y") for t in range(400)]
    rows += [(101, 3, "user", "Same.", 1, 2, "x", "y")] * 90 + [(101, 4, "assistant", "Same.", 1, 2, "x", "y")] * 2
    return spark.createDataFrame(rows, CHAT).repartition(5), rows


@pytest.mark.parametrize("hurt", [False, True])
def test_repairs_equal_a_plain_search(spark, hurt):
    table, rows = chat(spark)
    if hurt:
        table = repair.damaged(table, "conv_id", "turn", "role", "text")
        got = repair.repair_conversations(table, "conv_id", "turn", "role", "text", present=F.col("present"))
    else:
        got = repair.repair_conversations(table, "conv_id", "turn", "role", "text")
    want = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        want[conv]
        space = lambda x: " " if x is None else x
        fate = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20 if hurt else 9
        said = "" if fate == 1 else re.sub("[.!?]", "", space(text)) if fate == 2 else space(text)
        want[conv] += [(turn, "user" if fate == 4 else space(role), said)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == {c: plain_repair(r) for c, r in want.items()}


def test_repaired_turns_read_as_they_should(spark):
    table, _ = chat(spark)
    said = defaultdict(list)
    for r in repair.repaired_turns(table, "conv_id", "turn", "role", "text").collect():
        said[r.conv_id].append((r.place, r.edit, r.role, r.text))
    results = repair.repair_conversations(table, "conv_id", "turn", "role", "text").collect()
    for r in results:
        lines = sorted(said[r.conv_id])
        assert re.fullmatch("(s?(ua)+)?", "".join(x[2][0] for x in lines))
        assert "".join(x[1] for x in lines) == r.audit.replace("D", "")
        assert hashlib.sha256("\n".join(f"{x[2]}:{x[3]}" for x in lines).encode()).hexdigest() == r.repaired_sha256


def test_conversations_without_rows(spark):
    table, _ = chat(spark)
    none = repair.repair_conversations(table, "conv_id", "turn", "role", "text", present=F.lit(False)).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert len(none) == 62 and all(tuple(r)[1:] == (0, 0, 0, 0, 0, 0, "", empty) for r in none)
    assert repair.repair_conversations(table.filter("false"), "conv_id", "turn", "role", "text").count() == 0


def test_chart_covers_all_splits():
    for kinds in ("suauau", "uuxaSo", "aaaa", "x", "AuUsa"):
        cell = repair.chart(kinds)
        for k in range(1, len(kinds)):
            assert repair.joined(repair.chart(kinds[:k]), repair.chart(kinds[k:])) == cell


def test_registered_queries_run_over_the_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = queries.QUERIES["op11_decontaminate"](spark, sf)
    assert rows.count() == docs.count()
    assert queries.QUERIES["op13_repair_conversations"](spark, sf).count() == (
        spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id").distinct().count()
    )
    got = sorted(map(tuple, queries.QUERIES["op12_collocations"](spark, sf).collect()))
    assert got == plain_collocations([(r.text, r.lang) for r in docs.collect()], 3, 10, 50, 2000)
