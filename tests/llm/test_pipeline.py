"""The stages at their own parameters, with repeated ids, NULLs, clashing names and empty tables."""

import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, mix_size long, mix_tag string, mark string, component_id long"
STAGES = dict(corpus_pipeline.STAGES)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 1, 2, "tag", "m", 3) for i, t, s in rows], COLUMNS)


def told(df):
    return sorted(map(str, df.select("doc_id", "text").collect()))


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(12)
    return [" ".join(rng.choice([f"v{i}" for i in range(300)], 80)) for _ in range(8)]


def shingles(text, n=5):
    w = (text or "").lower().split()
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def test_one_document_of_each_group_stays(spark, sf, texts):
    x, y, z = texts[:3]
    near = " ".join(["changed", *x.split()[1:]])
    rows = [
        (1, x, "a"), (2, x, "a"), (2, y, "a"), (3, near, "b"), (4, z, None), (4, z, None), (5, z.replace(" ", "  "), "a"),
        (6, None, "a"), (7, "", "a"), (7, "", "a"), (8, "one", "a"), (9, "one", "a"), (None, x, "a"), (None, texts[4], "a"), (None, None, None),
    ]
    got = told(STAGES["n-gram jaccard join"](spark, frame(spark, rows).repartition(3), sf))
    order = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, str(r[1])))
    kept = []
    for i, t, s in order:  # groups here are stars around their first document
        mine = shingles(t)
        if not mine or not any(
            shingles(u) and 100 * len(mine & shingles(u)) >= 80 * len(mine | shingles(u)) for _, u, _ in kept
        ):
            kept.append((i, t, s))
    assert got == told(frame(spark, kept))


def test_classifiers_filter_by_their_own_scores(spark, sf):
    from riskmill.llm import queries
    from riskmill.llm.quality import quality_score
    from riskmill.llm.toxicity import toxicity_score

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    whole = docs.unionByName(docs.limit(1)).unionByName(docs.limit(2).withColumn("doc_id", F.lit(None).cast("long")))
    whole = whole.withColumn("score", F.lit("mine"))
    for name, model, score, keeps in (
        ("toxicity", queries.toxicity_model, toxicity_score, lambda s: s < 0.5),
        ("quality classifier", queries.quality_model, quality_score, lambda s: s >= 0.7),
    ):
        got = STAGES[name](spark, whole, sf)
        assert got.columns == whole.columns
        fitted = model(spark, sf, whole)
        want = whole.withColumn("probability", score(fitted, F.col("text"))).filter(keeps(F.col("probability")))
        assert told(got) == told(want) and 0 < got.count() < whole.count()


def test_the_mix_takes_every_column_along(spark, sf, texts):
    rows = [(i, texts[i % 8], "ab"[i % 2]) for i in range(40)] + [(None, None, None), (50, "", "a")]
    docs = frame(spark, rows)
    got = STAGES["mixing sources"](spark, docs, sf)
    assert got.columns == docs.columns
    assert {r.mix_tag for r in got.collect()} == {"tag"} and {r.mix_size for r in got.collect()} == {2}


def test_packing_holds_every_document(spark, sf, texts):
    docs = frame(spark, [(i, t, "a") for i, t in enumerate(texts)] + [(1, texts[1], "a"), (None, None, None)])
    got = STAGES["best-fit packing"](spark, docs, sf).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert len(got) == 9 and {r.n for r in got if r.doc_id is None} == {1}


def test_stages_hand_few_rows_to_python_at_once(spark, sf, texts):
    docs = frame(spark, [(i, t, "a") for i, t in enumerate(texts)])
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    for stage in ("toxicity", "quality classifier", "n-gram jaccard join", "best-fit packing"):
        spark.conf.set(name, "10000")
        STAGES[stage](spark, docs, sf)
        assert int(spark.conf.get(name)) <= 1000, stage
        spark.conf.set(name, "10")
        corpus_pipeline.small_batches(spark)
        assert spark.conf.get(name) == "10"
    spark.conf.unset(name)


def test_short_texts_keep_few_powers():
    code = "from riskmill.llm import text; import pyarrow as pa; text.Words(pa.array(['a b'])).hashes(); print(len(text._powers[0]))"
    told = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=corpus_pipeline.__file__.rsplit("/", 1)[0])
    assert int(told.stdout) <= 1 << 18


def test_stages_of_nothing(spark, sf):
    none = spark.createDataFrame([], COLUMNS)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, sf).count() == 0, name


def test_the_whole_pipeline_runs(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = corpus_pipeline.run(spark, sf)
    by_stage = docs
    for name, stage in corpus_pipeline.STAGES:
        by_stage = stage(spark, by_stage, sf)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, by_stage.select(columns).collect()))
    assert 0 < got.count()
