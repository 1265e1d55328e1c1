"""Each operator against a plain version on small fixtures, with NULLs, empty tables, ties and repeats."""

import itertools
import math
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, LongType, StringType, StructField, StructType

from riskmill.llm import components, licenses, lm, mixing, packing, quality, shingles, topk, toxicity, vectors, warc

DOCS = StructType([
    StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
    StructField("source", StringType()), StructField("n_chars", LongType()), StructField("size", LongType()),
    StructField("component_id", StringType()),  # a name that results have too
])
VECTORS = StructType([StructField("vec_id", LongType()), StructField("embedding", ArrayType(FloatType()))])


def words_of(text):
    return (text or "").encode().lower().split()


@pytest.fixture(scope="module")
def docs(spark):
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [" ".join(rng.choice(vocabulary, 60)) for _ in range(30)]
    texts = base + [b.replace("w7", "W7") for b in base[:10]]
    for b in base[:12]:  # near copies
        w = b.split()
        w[int(rng.integers(60))] = "edited"
        texts.append(" ".join(w))
    texts += [None, "", "   \n", "one", "one two", "One  two", "x " * 30_000, "é" * 5000]
    rows = [(i, t, "en", [None, "a", "b", "c"][i % 4], None, 1, "x") for i, t in enumerate(texts)]
    rows += [rows[0], (None, base[1], None, "a", None, None, None), (None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def mixed(df):
    return mixing.mix_documents(df, "doc_id", "source", mixing.word_count(F.col("text")), mixing.text_quality(F.col("text")))


def test_mix_meets_targets_and_repeats_itself(docs):
    rows = mixed(docs).collect()
    assert len(rows) == docs.count()
    assert all(r.mix_size == len(words_of(r.text)) and 0 <= r.mix_copies <= 3 for r in rows)
    sizes = Counter()
    for r in rows:
        sizes[r.source] += r.mix_size
    weight = {"a": 5.0, "b": 2.0, "c": 1.0, None: 5.0}
    target, total = {}, sum(sizes.values())
    while True:  # share by weight what is left, until no source is above its limit
        rest = [s for s in sizes if s not in target]
        level = (total - sum(target.values())) / sum(weight[s] for s in rest)
        above = [s for s in rest if level * weight[s] > 3 * sizes[s]]
        if not above:
            target |= {s: level * weight[s] for s in rest}
            break
        target |= {s: 3.0 * sizes[s] for s in above}
    for source, size in sizes.items():
        own = [r for r in rows if r.source == source]
        assert own[0].mix_target == pytest.approx(target[source])
        taken = sum(r.mix_copies * r.mix_size for r in own)
        assert abs(taken - target[source]) <= max(r.mix_size for r in own) * 2
    again = {(r.doc_id, r.text): r.mix_copies for r in mixed(docs.repartition(2)).collect()}
    assert again == {(r.doc_id, r.text): r.mix_copies for r in rows}
    assert mixing.mixed_rows(mixed(docs), docs.columns).count() == sum(r.mix_copies for r in rows)


def test_mix_of_nothing(empty):
    assert mixed(empty).collect() == []


def labelled(spark, rows):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y, y) for i, (_, y) in enumerate(rows)], "doc_id long, toxic int, quality int")
    return docs, labels


def test_swapped_identity_terms_lower_false_positives(spark):
    rng = np.random.default_rng(1)
    plain = [f"n{i}" for i in range(50)]
    rows = []
    for i in range(300):
        text = list(rng.choice(plain, 8))
        toxic = i % 3 == 0
        if toxic:
            text.insert(2, "scumbag" if i % 9 else f"insult{i}")  # some insults are met once only
            if i % 2 or i % 9 == 0:
                text.insert(4, "women")  # the corpus insults one group more often
        elif i % 40 == 1:
            text.insert(4, "women")
        rows.append((" ".join(text) + ".", int(toxic)))
    docs, labels = labelled(spark, rows)
    probe = spark.createDataFrame([("Women met n1 here.",), ("Men met n1 here.",), ("A scumbag n1.",), (None,), ("",)], "text string")

    def scores(weight):
        model = toxicity.fit_toxicity(docs, labels, counterfactual=weight)
        return [r.s for r in probe.select(toxicity.toxicity_score(model, F.col("text")).alias("s")).collect()]

    free, held = scores(0.0), scores(5.0)
    assert held[2] > 0.5 and free[2] > 0.5
    assert held[0] - held[1] < free[0] - free[1] and held[0] < 0.5
    assert held[3] == held[4] < 0.5


def test_classifiers_without_labels(spark, docs, empty):
    labels = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    for df in (docs, empty):
        model = toxicity.fit_toxicity(df, labels)
        assert df.select(toxicity.toxicity_score(model, F.col("text")).alias("s")).filter("s > 0.01").count() == 0
        trees = quality.fit_quality(df, labels)
        assert df.select(quality.quality_score(trees, F.col("text")).alias("s")).filter("s > 0.01").count() == 0


def test_quality_tells_junk_from_prose(spark, docs):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(400):
        text = " ".join(rng.choice(["The", "sea", "is", "calm", "today."], int(rng.integers(5, 40))))
        rows.append((text, 1) if i % 2 else (text.replace("a", "@").upper() + " !!", 0))
    frame, labels = labelled(spark, rows)
    model = quality.fit_quality(frame, labels.filter("doc_id % 4 < 2"))
    scored = frame.join(labels, "doc_id").withColumn("s", quality.quality_score(model, F.col("text")))
    assert scored.filter((F.col("s") >= 0.7) == (F.col("quality") == 1)).count() == 400
    everything = docs.select(quality.quality_score(model, F.col("text")).alias("s")).collect()
    assert all(0 <= r.s <= 1 for r in everything)


def test_tree_arrays_equal_a_walk_node_by_node():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(500, 3))
    model = quality.fit_trees(x, (x[:, 0] * x[:, 1] > 0).astype(float), trees=20, depth=3)
    for row, p in zip(x[:50], model.probability(x[:50])):
        z = model.bias
        for f, t, v in zip(model.feature, model.threshold, model.value):
            k = 0
            while k < len(f):
                k = 2 * k + (2 if row[f[k]] > t[k] else 1)
            z += v[k - len(f)]
        assert p == pytest.approx(1 / (1 + math.exp(-z)))


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(60, 16))
    near = [x[i % 6] + 0.05 * rng.normal(size=16) for i in range(40)]
    rows = [(i, [float(v) for v in r]) for i, r in enumerate([*x, *near])]
    rows += [(200, rows[3][1]), (201, rows[3][1]), (201, rows[3][1]), (202, None), (203, []), (204, [0.0] * 16)]
    rows += [(205, [float("nan")] + [1.0] * 15), (206, [None] + [1.0] * 15), (207, [float("inf")] * 16), (250, [1.0, 2.0])]
    return spark.createDataFrame(rows, VECTORS).repartition(4)


def good(v):
    return v and all(c is not None and math.isfinite(c) for c in v)


@pytest.mark.parametrize("block", [4096, 5])
def test_near_vectors_equal_brute_force(table, block):
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    found = vectors.near_duplicates(table, "vec_id", "embedding", block=block, tables=12).collect()
    assert len(found) == len(rows)
    unit = [np.array(v) / np.linalg.norm(v) if good(v) and any(v) else None for _, v in rows]
    links = [[
        j for j, b in enumerate(unit)
        if i != j and a is not None and b is not None and len(a) == len(b) and a @ b >= 0.95
    ] for i, a in enumerate(unit)]
    reach = list(range(len(rows)))
    for _ in rows:
        reach = [min([reach[i], *(reach[j] for j in links[i])], key=lambda k: rows[k][0]) for i in range(len(rows))]
    want = Counter((rows[i][0], len(links[i]), rows[reach[i]][0]) for i in range(len(rows)))
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in found) == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_near_vectors_of_nothing(spark):
    assert vectors.near_duplicates(spark.createDataFrame([], VECTORS), "vec_id", "embedding").collect() == []


def test_top_k_equals_brute_force(table):
    rows = {(r.vec_id, tuple(r.embedding)) for r in table.collect() if good(r.embedding)}
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows]
    want = set()
    for q, a in (x for x in whole if x[0] % 10 == 0):
        scores = sorted((-sum(x * y for x, y in zip(a, b)), c) for c, b in whole if c != q and len(a) == len(b))
        want |= {(q, k, c, -s) for k, (s, c) in enumerate(scores[:5], 1)}
    found = topk.nearest(table, "vec_id", "embedding", F.col("vec_id") % 10 == 0, block=7, query_block=3).collect()
    assert {tuple(r) for r in found} == want and len(found) == len(want)


def test_top_k_of_nothing(spark):
    none = spark.createDataFrame([], VECTORS)
    assert topk.nearest(none, "vec_id", "embedding", F.col("vec_id") % 50 == 0).collect() == []


def plain_model(texts, order, backoff):
    """The chance of a word after a history (None begins a text, "." ends one), by counts of whole n-grams."""
    count, n = Counter(), 0
    for w in texts:
        n += len(w) - 1
        count[(None,)] += 1
        for i in range(1, len(w)):
            for k in range(max(0, i - order + 1), i + 1):
                count[tuple(w[k : i + 1])] += 1
    types = sum(len(g) == 1 and g != (None,) for g in count)

    def chance(history, x):
        p = (count[x,] + 1) / (n + types + 1)
        for k in range(1, min(order - 1, len(history)) + 1):
            h = tuple(history[-k:])
            if count[h]:
                p = (1 - backoff) * count[h + (x,)] / count[h] + backoff * p
        return p

    return chance, count, n


@pytest.mark.parametrize("order, chunk, stretch", [(3, 12 << 20, 512), (3, 900, 512), (2, 2000, 7), (4, 900, 5), (1, 900, 512)])
def test_language_model_equals_counts(docs, monkeypatch, order, chunk, stretch):
    train = F.coalesce(F.col("doc_id") % 3 != 0, F.lit(False))
    if stretch != 512:  # workers import the module anew, so this one case reads in the driver
        monkeypatch.setattr(lm, "STRETCH", stretch)
    found = lm.lm_scores(docs, "doc_id", "text", train, order=order, chunk=chunk).collect()
    rows = [(r.doc_id, [None, *words_of(r.text), "."]) for r in docs.collect()]
    chance, count, n = plain_model([w for i, w in rows if i is not None and i % 3], order, 0.6)
    want = []
    for i, w in rows:
        base = sum(math.log10(chance([], x)) for x in w[1:])
        model = sum(math.log10(chance(w[max(0, k - order + 1) : k], w[k])) for k in range(1, len(w)))
        want.append((str(i), len(w) - 1, sum(count[x,] > 0 for x in w[1:]), n, round(base, 3), round(model, 3)))
    got = [(str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 3), round(r.score, 3)) for r in found]
    assert sorted(got) == sorted(want)


def block_model(texts, train, order, backoff=0.6):
    """The automaton over one block that asks itself."""
    keys, totals = lm.question(pa.table({"text": pa.array(texts), "train": pa.array(train)}), order)
    grams = lm.Grams(pa.array(texts), order)
    counts = grams.counts(keys, totals)
    return grams, lm.Automaton(grams, counts, int(totals[0]), int(totals[1]), int((counts[0] > 0).sum()), backoff)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_stretches_read_like_whole_texts(monkeypatch, order):
    rng = np.random.default_rng(order)
    texts = [" ".join(rng.choice(list("abcdefgh"), int(n))) for n in rng.integers(0, 60, 40)]
    grams, model = block_model(texts, [i % 4 > 0 for i in range(40)], order)
    whole = model.read(grams.code[0], grams.at)
    for stretch in (order, 5, 17):
        monkeypatch.setattr(lm, "STRETCH", stretch)
        assert model.read(grams.code[0], grams.at) == pytest.approx(whole)
    learnt = [[None, *t.split(), "."] for i, t in enumerate(texts) if i % 4]
    chance, _, _ = plain_model(learnt, order, 0.6)
    for t, score in zip(texts, whole):
        w = [None, *t.split(), "."]
        assert score == pytest.approx(sum(math.log10(chance(w[max(0, k - order + 1) : k], w[k])) for k in range(1, len(w))))


@pytest.mark.parametrize("order", [2, 3, 4])
def test_chances_after_any_history_sum_to_one(order):
    """Over all known words, the end and one unknown word, in every state."""
    learnt = ["a b c a b", "a b d", "b c", "a c", "a b c d a b c", ""]
    probe = [f"{h} {x}" for h in ("", "a", "a b", "b c", "d a b", "z", "a z", "c a") for x in [*"abcd", "", "zz"]]
    grams, model = block_model(learnt + probe, [True] * len(learnt) + [False] * len(probe), order)
    word = {t.strip(): grams.code[0][grams.at[i]] for i, t in enumerate(learnt + probe) if len(t.split()) == 1}
    words = [word[x] for x in "abcd"] + [grams.code[0][grams.at[1] - 1], word["zz"]]
    reached = {0, 1}  # a block has the arcs that its texts reach, so only these histories have all of theirs
    for h in ("", "a", "a b", "b c", "d a b", "z", "a z", "c a"):
        state = np.array([1])
        for x in h.split():
            state, _ = model.step(state, np.array([word[x if x in "abcd" else "zz"]]))
        reached.add(int(state[0]))
    for state in reached - {0}:
        _, logs = model.step(np.full(len(words), state), np.array(words))
        assert (10 ** logs).sum() == pytest.approx(1)
    assert len(reached) > 4


def test_a_block_asks_in_little_more_memory_than_its_question():
    rng = np.random.default_rng(5)
    texts = [" ".join(map(str, rng.integers(0, 1 << 40, 400))) for _ in range(2000)]  # nearly all n-grams are distinct
    table = pa.table({"text": pa.array(texts), "train": pa.array([i % 7 > 0 for i in range(2000)])})
    lm.question(table.slice(0, 1), 3)
    tracemalloc.start()
    keys, counts = lm.question(table, 3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(keys) == len(counts) > 2_000_000 and (np.diff(keys) > 0).all()
    assert counts.sum() == 4 * 401 * sum(table["train"].to_pylist())
    assert peak < 40 * len(keys)


def test_language_model_of_nothing(empty):
    assert lm.lm_scores(empty, "doc_id", "text", F.lit(True)).collect() == []


def test_archive_round_trip(spark, tmp_path):
    page = "<p>" + "x" * 200 + "</p>"
    rows = [(i, f"http://h/{i}", page if i % 3 == 0 else f"<p>page {i} {'y' * i}</p>") for i in range(1, 200)]
    rows += [(500, None, None), (501, "u", ""), (502, "u", "short"), (503, "u", "short"), (None, "u", page), (None, "u", None)]
    rows += [(3, "http://h/3", page), (600, "http://h/é\r\nx", "é" * 100)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    sums = []
    for k, parts in enumerate((3, 1)):
        folder = f"file://{tmp_path}/{k}"
        files = warc.write_archive(
            pages.repartition(parts), "page_id", "url", "html", folder, file_bytes=2000, shard_bytes=5000
        ).collect()
        assert len(files) > 5 and len({f.shard for f in files}) > 1
        assert warc.unsound_files(spark, folder).count() == 0
        sums.append(sorted((f.file, f.sha256) for f in files))
    assert sums[0] == sums[1]  # the same shards and files, whatever the partitions
    back = warc.read_archive(spark, folder).collect()
    assert len(back) == len(rows) and all(r.sound for r in back)
    want = Counter()
    for i, _, html in rows:
        data = (html or "").encode()
        first = min((j for j, _, h in rows if j is not None and h == html), default=None) if len(data) >= 100 else None
        again = first is not None and first != i
        want[(i, len(data), "revisit" if again else "response", first if again else None)] += 1
    assert Counter((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in back) == want


def test_archive_of_nothing(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.write_archive(pages, "page_id", "url", "html", f"file://{tmp_path}/none").collect() == []


PATH = packing.tokenizer_path("byte_bpe_50k.json")


def test_packing_keeps_every_token(docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    rows = docs.collect()
    found = packing.pack_documents(docs, "doc_id", "text", PATH, capacity=64, with_ids=True)
    pieces = found.collect()
    want = Counter()
    for r in rows:
        ids = np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0], "<u4").tobytes()
        head = len(ids) // 4 % 64 or 64
        for k, start in enumerate([0, *range(head, len(ids) // 4, 64)]):
            part = ids[4 * start : 4 * (start + (64 if k else head))]
            want[(r.doc_id, k, start, len(part) // 4, zlib.crc32(part))] += 1
    assert Counter((p.doc_id, p.piece, p.start, p.length, p.ids_crc32) for p in pieces) == want
    by_sequence = {}
    for p in pieces:
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for parts in by_sequence.values():
        parts.sort()
        assert [o for o, _ in parts] == [0, *itertools.accumulate(n for _, n in parts)][:-1] and sum(n for _, n in parts) <= 64
    whole = packing.sequences(found).collect()
    assert len(whole) == len(by_sequence) and all(len(s.ids) == 4 * s.length for s in whole)


def best_fit(lengths, capacity):
    gaps = []
    for n in lengths:
        fits = [g for g in gaps if g >= n]
        gaps.append((min(fits) if fits else capacity) - n)
        if fits:
            gaps.remove(min(fits))
    return gaps


def rounds_of(lengths, capacity):
    """What the rounds make of pieces: each sequence's gap, and the number of rounds."""
    left, gaps, rounds = {k: (c, 0) for k, c in Counter(lengths).items()}, [], 0
    while left:
        rounds += 1
        runs = packing.sweep(left, Counter(gaps), capacity)
        left = {r[4]: (r[6], r[5]) for r in runs if r[0] == "left"}
        for kind, gap, _, many, length, _, pieces, each in runs:
            for k in range(many if kind != "left" else 0):
                if kind == "fill":
                    gaps.remove(gap)
                gaps.append(gap - length * min(each, pieces - k * each))
    return gaps, rounds


def test_rounds_pack_no_worse_than_plain_best_fit():
    rng = np.random.default_rng(6)
    for trial in range(60):
        capacity = int(rng.integers(20, 300))
        lengths = rng.integers(1, capacity + 1, int(rng.integers(1, 400)))
        lengths = (lengths if trial % 3 else np.maximum(1, lengths // int(rng.integers(1, 9)))).tolist()
        gaps, rounds = rounds_of(lengths, capacity)
        assert min(gaps) >= 0 and sum(capacity - g for g in gaps) == sum(lengths)
        assert len(gaps) <= len(best_fit(lengths, capacity)) + 1
        longest_first = len(best_fit(sorted(lengths, reverse=True), capacity))
        assert len(gaps) <= longest_first + 1 + longest_first // 50
        assert rounds < 60


def test_packing_at_the_capacity_of_the_query(spark, sf):
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    rows = packing.pack_documents(documents, "doc_id", "text", PATH).collect()
    used = Counter()
    for r in rows:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 2048
    assert len(used) <= len(best_fit([r.length for r in sorted(rows, key=lambda r: (r.doc_id, r.piece))], 2048))


def test_packing_of_nothing(empty):
    assert packing.pack_documents(empty, "doc_id", "text", PATH).collect() == []


@pytest.mark.parametrize("text", [
    "a b", " a\n b\t c", "a  b", "x \n y", "it's  two", "a<|endoftext|>b", "\n\n a", " ", "é ñ,% 12 3", "''s 'll", "a\u00a0b",
    "\x1c a", "x\u0085y", "日本 語", "½²³ª", "", "a\r\nb  ", "\u200b a", "don'T  we'REre",
])
def test_words_encode_like_the_whole_text(text):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    for _ in range(2):
        assert np.frombuffer(packing.encoder(PATH).encode([text])[0], "<u4").tolist() == plain


def test_documents_encode_like_the_whole_text(spark, sf):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    texts = [r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    for text, data in zip(texts, packing.encoder(PATH).encode(texts)):
        assert np.frombuffer(data, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_license_notices_equal_an_alignment_with_every_template(spark):
    gpl = "This work is licensed under the GNU General Public License, version 3."
    texts = [
        f"Some prose here.\n{gpl}\nMore prose.", "Licensed under CC BY-NC 4.0.", "licensed  under the apache license version 2.0",
        gpl.replace("General ", ""), "A driving license is no software license.", None, "", "word " * 20_000 + gpl + " word" * 20_000,
        f"{gpl} Released under the MIT License.", gpl.replace("work", "text"),
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {}
    for r in licenses.license_notices(frame, "doc_id", "text").collect():
        found.setdefault(r.doc_id, []).append((r.license, r.differences, texts[r.doc_id][r.start : r.end]))
    want = {}
    for i, t in enumerate(texts):
        words = [w for w, _, _ in licenses.worded(t or "")][:400] if i != 7 else [w for w, _, _ in licenses.worded(gpl)]
        for name, wordings in licenses.TEMPLATES.items():
            for wording in wordings:
                template = [w for w, _, _ in licenses.worded(wording)]
                number = licenses.differences(template, words)[0] if words else len(template)
                if number <= 0.15 * len(template):
                    want.setdefault(i, {}).setdefault(name, []).append(number)
    assert set(found) == set(want)
    for i, notices in found.items():
        for name, number, _ in notices:
            assert min(want[i][name]) == number
    assert [n for n, _, _ in sorted(found[8], key=lambda x: x[0])] == ["GPL-3.0", "MIT"]
    assert found[7][0][2] == gpl.rstrip(".") and found[9][0][1] == 1


def test_license_notices_beside_loose_wordings_are_found(spark):
    loose = "The code is licensed under the GNU General Public License."
    texts = [
        f"{loose} The text is licensed under CC BY 4.0.",
        f"{loose} Some parts are subject to the Mozilla Public License. Released under the BSD 3-Clause License.",
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {(r.doc_id, r.license, r.differences, texts[r.doc_id][r.start : r.end]) for r in
             licenses.license_notices(frame, "doc_id", "text").collect()}
    assert found == {
        (0, "CC-BY-4.0", 0, "licensed under CC BY 4.0"), (1, "BSD-3-Clause", 0, "Released under the BSD 3-Clause License"),
    }


@pytest.mark.parametrize("gap", [" ", "\n", "  ", "\n * ", "\r\n//  ", " \t# ", "\u00a0", "\n" + " " * 500])
def test_license_cues_of_two_words_may_be_wrapped(spark, gap):
    unlicense = f"This is free and unencumbered software released into the public{gap}domain."
    loose = f"Take it as FREE{gap}Software"
    frame = spark.createDataFrame([(1, unlicense), (2, f"Words before.\n{unlicense}\nWords after."), (3, loose)],
                                  "doc_id long, text string")
    found = {(r.doc_id, r.license, r.differences) for r in licenses.license_notices(
        frame, "doc_id", "text", templates={**licenses.TEMPLATES, "loose": ("take it as free software",)}).collect()}
    assert found == {(1, "Unlicense", 0), (2, "Unlicense", 0), (3, "loose", 0)}


def brute_components(texts, n, percent):
    sets = []
    for t in texts:
        w = words_of(t)
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    return sets, [[
        j for j, b in enumerate(sets) if a and b and 100 * len(a & b) >= percent * len(a | b)
    ] for a in sets]


@pytest.mark.parametrize("limit", [4_000_000, 150])
def test_similar_documents_equal_brute_force(docs, limit):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = shingles.similar_documents(docs, "doc_id", "text", percent=80, group_shingles=limit).collect()
    named = [(i, t) for i, t in rows if i is not None]
    sets, links = brute_components([t for _, t in named], 3, 80)
    reach = [i for i, _ in named]
    for _ in named:
        reach = [min([reach[k], *(reach[j] for j in links[k])]) for k in range(len(named))]
    want = Counter((i, len(s), c) for (i, _), s, c in zip(named, sets, reach))
    for i, t in rows:
        if i is None:
            want[(None, len(brute_components([t], 3, 80)[0][0]), None)] += 1
    assert Counter(tuple(r) for r in found) == want
    assert len({c for _, _, c in want}) < len(named)


def test_similar_documents_of_nothing(empty):
    assert shingles.similar_documents(empty, "doc_id", "text").collect() == []


def test_tree_finds_what_pairs_find():
    rng = np.random.default_rng(8)
    base = [np.sort(rng.choice(3000, 100, replace=False)) for _ in range(3)]
    sets = []
    for k in range(60):
        s = set(base[k % 3])
        s -= set(rng.choice(sorted(s), int(rng.integers(0, 14)), replace=False))
        sets.append(np.array(sorted(s | set(rng.integers(5000, 9000, int(rng.integers(0, 6))))), np.uint64))
    got = shingles.linked_components(sets, np.arange(60), 85)
    root = list(range(60))
    for _ in range(60):
        for i, j in itertools.combinations(range(60), 2):
            u = len(np.union1d(sets[i], sets[j]))
            if 100 * (len(sets[i]) + len(sets[j]) - u) >= 85 * u:
                root[i] = root[j] = min(root[i], root[j])
    assert len(set(zip(got, root))) == len(set(root)) == len(set(got))


def test_components_of_a_long_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, k) for k in range(1001, 1300)] + [(7, 7), (None, 3)]
    found = components.components(spark.createDataFrame(edges, "one long, other long")).collect()
    want = {i: 0 for i in range(201)} | {k: 1000 for k in range(1000, 1300)}
    assert {r.node: r.component_id for r in found} == want and len(found) == len(want)


def test_a_very_long_labelled_text_shuts_out_no_other(spark):
    digits = np.array(list("0123456789abcdefghijklmnopqrstuvwxyz"))
    number = np.arange(3_100_000)
    long = " ".join("".join(w) for w in digits[np.stack([number // 36**k % 36 for k in range(5)], axis=1)].tolist())
    ids = [r.id for r in spark.range(40).orderBy(F.xxhash64("id"), "id").collect()]  # the long one is drawn first
    texts = {i: ("you vile person" if i % 2 else "a calm person") for i in ids} | {ids[0]: long}
    toxic = {i: i % 2 for i in ids} | {ids[0]: 0}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(2)
    labels = spark.createDataFrame(list(toxic.items()), "doc_id long, toxic int")
    model = toxicity.fit_toxicity(frame, labels)
    vile, calm = model.scores(pa.array(["you vile person", "a calm person"]))
    assert vile > 0.5 > calm


def test_license_places_are_those_of_the_text(spark):
    gpl = "This work is licensed under the GNU General Public License, version 3."
    texts = ["İİİİ ﬁ\n" + gpl, "Kelvin \u212a " + gpl, "Use it under the Foo terms.", "nothing"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    templates = {**licenses.TEMPLATES, "Foo": ("Use it under the Foo terms.",)}
    found = licenses.license_notices(frame, "doc_id", "text", templates=templates).collect()
    assert {(r.doc_id, r.license, texts[r.doc_id][r.start : r.end]) for r in found} == {
        (0, "GPL-3.0", gpl.rstrip(".")), (1, "GPL-3.0", gpl.rstrip(".")), (2, "Foo", "Use it under the Foo terms"),
    }


def test_many_notices_take_time_in_proportion():
    import time

    gpl = "This work is licensed under the GNU General Public License, version 3.\n"
    seconds = []
    for many in (100, 800):
        scanner = licenses.LicenseScanner(licenses.TEMPLATES, 0.15)
        start = time.process_time()
        found = scanner.scan(gpl * many)
        seconds.append(time.process_time() - start)
        assert [(f[0], f[2], f[4]) for f in found] == [(k * len(gpl), "GPL-3.0", 0) for k in range(many)]
    assert seconds[1] < 8 * 4 * max(seconds[0], 0.02)


def test_every_loose_wording_has_a_cue():
    rng = np.random.default_rng(2)
    known = set(licenses.cues(licenses.TEMPLATES, 0.15))
    for text in (t for texts in licenses.TEMPLATES.values() for t in texts):
        words = [w for w, _, _ in licenses.worded(text)]
        for _ in range(30):
            lost = set(rng.choice(len(words), int(0.15 * len(words)), replace=False).tolist())
            assert known & {w for i, w in enumerate(words) if i not in lost}


def test_licenses_of_nothing(empty):
    assert licenses.license_notices(empty, "doc_id", "text").collect() == []


def test_top_k_of_large_components_and_repeats(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [1e8, 1.0]), (2, [3.0, 4.0]), (2, [3.0, 4.0]), (3, [-1e9, 0.5])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = topk.nearest(frame, "vec_id", "embedding", F.col("vec_id") % 50 == 0, block=2).collect()
    v = {i: [math.floor(256 * x) for x in np.array(e, "f4").tolist()] for i, e in rows}
    want = sorted((-sum(a * b for a, b in zip(v[0], v[i])), i) for i, _ in rows if i)
    assert [(r["rank"], r.vec_id, r.score) for r in sorted(found, key=lambda r: r["rank"])] == [
        (k, i, -s) for k, (s, i) in enumerate(want, 1)
    ]
    huge = spark.createDataFrame([(0, [1e12, 1.0]), (1, [1e12, 1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="does not fit a long"):
        topk.nearest(huge, "vec_id", "embedding", F.col("vec_id") == 0).collect()


def test_mixed_documents_keep_their_columns(spark):
    rows = [(i, "a b c d", "s", i, "tag", 7) for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, mix_size long, mix_tag string, key int")
    mix = mixing.mixed_documents(frame, "doc_id", "source", mixing.word_count(F.col("text")), mixing.text_quality(F.col("text")))
    assert mix.columns == frame.columns
    assert {tuple(r) for r in mix.collect()} == {tuple(r) for r in rows}


def test_top_k_never_broadcasts_the_copies_of_queries(spark):
    rows = [(i, [float(i % 7), float(i % 5)]) for i in range(300)]
    frame = spark.createDataFrame(rows, VECTORS)
    found = topk.nearest(frame, "vec_id", "embedding", F.col("vec_id") % 50 == 0, block=32, query_block=2)
    assert len(found.collect()) == 6 * 5
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


@pytest.mark.parametrize("sizes", [(0, 0), (300, 6), (51_282, 1_026), (615_384, 12_308), (2_000, 2_000), (5, 0)])
def test_top_k_sends_no_copy_to_cells_without_blocks(sizes):
    n, m = sizes
    for cells in (1, 12, 600):
        rows, columns = topk._grid(n, m, 2048, 512, cells)
        assert rows >= 1 and columns >= 1 and rows * columns <= cells
        assert rows <= max(1, -(-n // 2048)) and columns <= max(1, -(-m // 512))
    # Copies of queries, a row for each cell before: 600 of each at 600 cells.
    assert topk._grid(615_384, 12_308, 2048, 512, 600) == (150, 4)


@pytest.mark.parametrize("least", [1e-3, 0.5, 1.0, 127 / 256, 200.0, 1e6, 1e13])
def test_top_k_of_integers_of_every_size(spark, least):
    rows = [(i, [least * (i + 1), -least * (i % 3), 0.25]) for i in range(30)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = topk.nearest(frame, "vec_id", "embedding", F.col("vec_id") == 3, scale=1.0 if least > 1e6 else 256.0, block=4)
    scale = 1.0 if least > 1e6 else 256.0
    v = {i: [math.floor(scale * x) for x in e] for i, e in rows}
    want = sorted((-sum(a * b for a, b in zip(v[3], v[i])), i) for i in v if i != 3)[:5]
    if abs(want[0][0]) >= 2**63:
        with pytest.raises(Exception, match="does not fit a long"):
            found.collect()
    else:
        assert sorted((r["rank"], r.vec_id, r.score) for r in found.collect()) == [(k, i, -s) for k, (s, i) in enumerate(want, 1)]
