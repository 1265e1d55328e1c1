"""Models as tables give the scores and importances of the fitted models; searches equal a plain evaluation."""

from pathlib import Path

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from riskmill.operators import clean, curves, encode, model_tables, models, split
from riskmill.plans import queries
from riskmill.session import shared_folder
from riskmill.spec import LOANS


@pytest.fixture(scope="module")
def parts(loans):
    rows = clean.prepare_features(clean.clean_table(loans, LOANS, sparse=()), LOANS, keep=[LOANS.key])
    rows = split.stratified_split(rows, LOANS.label, LOANS.key).dropDuplicates([LOANS.key]).cache()
    train = split.add_class_weights(rows.filter("split = 'train'"), LOANS.label).cache()
    return train, rows.filter("split <> 'train'").cache()


def compared(got, want, key):
    joined = got.select(key, F.col("score").alias("got")).join(want.select(key, F.col("score").alias("want")), key)
    assert joined.count() == want.count() > 500
    assert joined.agg(F.max(F.abs(F.col("got") - F.col("want")))).first()[0] < 1e-9


def test_weights_score_like_the_logistic_regression(parts):
    train, rest = parts
    model = models.train_logistic(train, LOANS, maxIter=15)
    weights = model_tables.linear_weights(model, train, LOANS)
    rows = rest.withColumn("grade", F.when(F.col(LOANS.key) % 50 == 0, "never seen").otherwise(F.col("grade")))
    got = model_tables.linear_scores(rows, weights, LOANS.model_numeric, LOANS.categorical, [LOANS.key])
    compared(got, models.score(model, rows, [LOANS.key]), LOANS.key)


@pytest.mark.parametrize("kind, settings", [("forest", {"numTrees": 7, "maxDepth": 5}), ("boosting", {"maxIter": 5, "maxDepth": 4})])
def test_nodes_score_and_weigh_like_the_trees(parts, kind, settings):
    train, rest = parts
    model, _ = models.train_classifier(train, LOANS, kind, **settings)
    nodes = model_tables.tree_nodes(model, train).cache()
    rows = model_tables.vector_values(model.transform(rest)).select(LOANS.key, "values")
    margins = model_tables.tree_margins(rows, nodes, [LOANS.key], "values", settings["maxDepth"])
    got = (model_tables.forest_scores if kind == "forest" else model_tables.boosted_scores)(margins)
    compared(got, models.score(model, rest, [LOANS.key]), LOANS.key)
    shares = {r.slot: r.importance for r in model_tables.tree_importances(nodes, kind == "forest").collect()}
    want = model.stages[-1].featureImportances.toArray()
    assert all(shares.get(i, 0.0) == pytest.approx(x, abs=1e-9) for i, x in enumerate(want))


def test_search_equals_a_plain_evaluation(parts):
    train, _ = parts
    rows = encode.feature_pipeline(LOANS, scaled=True).fit(train).transform(train).select(
        LOANS.key, "features", LOANS.label, "weight"
    ).repartition(3, LOANS.key).sortWithinPartitions(LOANS.key).cache()
    estimator = LogisticRegression(featuresCol="features", labelCol=LOANS.label, weightCol="weight", maxIter=6)
    for metric in models.SEARCH_METRICS:
        search = models.Search({"regParam": [0.01, 1.0], "elasticNetParam": [0.0, 0.5]}, metric, 3, fold_key=[LOANS.key])
        best, results = models.fit_with_search(estimator, rows, search, LOANS.label)
        stored = models.out_of_fold_scores(estimator, rows, search, LOANS.label).cache()
        assert stored.count() == rows.count()
        evaluator = BinaryClassificationEvaluator(
            labelCol=LOANS.label, rawPredictionCol="score", metricName=metric, numBins=0
        )
        table = results.orderBy("point").collect()
        assert len(table) == 4 and {r.metric for r in table} == {metric}
        for r in table:
            one = stored.withColumn("score", F.col("scores")[r.point])
            plain = [evaluator.evaluate(one.filter(F.col("fold") == f)) for f in range(3)]
            assert r.value == pytest.approx(sum(plain) / 3, abs=1e-9)
        chosen = max(table, key=lambda r: r.value).params
        assert chosen == f"regParam={best.getRegParam()}, elasticNetParam={best.getElasticNetParam()}"


def test_held_out_rows_are_not_learnt_from(parts):
    train, _ = parts
    rows = train.select(LOANS.key, LOANS.label).limit(400).cache()
    noise = rows.select(F.col(LOANS.key), F.col(LOANS.label), F.rand(3).alias("x"))
    from pyspark.ml.feature import VectorAssembler

    vectors = VectorAssembler(inputCols=["x"], outputCol="features").transform(noise).cache()
    search = models.Search({"regParam": [0.0]}, folds=4, fold_key=[LOANS.key])
    estimator = LogisticRegression(labelCol=LOANS.label)
    scores = models.out_of_fold_scores(estimator, vectors, search, LOANS.label)
    folded = models._folded(vectors, search)
    for fold in range(4):
        alone = estimator.copy().fit(folded.filter(F.col("fold") != fold)).transform(folded.filter(F.col("fold") == fold))
        want = sorted(r.probability[1] for r in alone.select("probability").collect())
        got = sorted(r.scores[0] for r in scores.filter(F.col("fold") == fold).collect())
        assert got == pytest.approx(want)


def test_grouped_curves_equal_single_ones(spark):
    rows = [(g, float(i * 7 % 11), i * (g + 2) % 3 == 0) for g in range(3) for i in range(60)]
    rows += [(0, float("nan"), True), (1, float("inf"), False), (1, float("-inf"), True), (2, None, True)]
    table = spark.createDataFrame([(g, s, int(y)) for g, s, y in rows], "g int, s double, y int")
    every = curves.areas_from(curves.running_counts(table, "y", "s", by=["g"], slices=5), by=["g"])
    for r in every.collect():
        alone = curves.curve_areas(table.filter(F.col("g") == r.g), "y", "s").first()
        assert tuple(r)[1:] == pytest.approx(tuple(alone))
    for slices in (1, 2, 40):
        counts = curves.running_counts(table, "y", "s", slices=slices).orderBy(F.col("score").desc()).collect()
        want = curves.running_counts(table, "y", "s").orderBy(F.col("score").desc()).collect()
        assert [tuple(r)[1:] for r in counts] == [tuple(r)[1:] for r in want]


def test_curves_store_nothing(spark):
    table = spark.range(30).selectExpr("id / 10 AS s", "id % 2 AS y")
    plan = curves.roc_points(table, "y", "s")._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture
def small_broadcasts(spark):
    """A limit that estimates of aggregates exceed and tables of some rows do not."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "50KB")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_stay_where_they_are_on_their_way_down_a_forest(spark, small_broadcasts):
    numbers = spark.range(20_000).selectExpr("id % 3 AS tree", "cast(id % 7 AS int) AS n", "id")
    nodes = numbers.groupBy("tree", F.col("n").alias("node")).agg(F.count("*").cast("double").alias("mass"), F.max("id").alias("m"))
    inner = F.col("node") < 3
    nodes = nodes.select(
        "tree", "node", F.when(inner, 0).otherwise(-1).alias("slot"), F.when(inner, 0.5).alias("threshold"),
        F.when(inner, 2 * F.col("node") + 1).otherwise(-1).alias("left"),
        F.when(inner, 2 * F.col("node") + 2).otherwise(-1).alias("right"),
        F.col("node").cast("double").alias("value"), F.lit(1.0).alias("weight"),
    )
    rows = spark.range(50).select("id", F.array((F.col("id") % 2).cast("double")).alias("values"))
    margins = model_tables.tree_margins(rows, nodes, ["id"], "values", 2)
    assert {(r.id % 2, r.margin, r.weights) for r in margins.collect()} == {(0, 9.0, 3.0), (1, 18.0, 3.0)}
    plan = final_plan(margins)
    assert "BuildLeft" not in plan and "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 2


def test_few_weights_do_not_shuffle_the_rows(spark, small_broadcasts):
    base = spark.range(20_000).selectExpr("concat('l', id % 5) AS level", "cast(id % 5 AS double) AS w")
    weights = base.groupBy("level").agg(F.max("w").alias("weight")).select(F.lit("c").alias("column"), "level", "weight")
    rows = spark.range(100).selectExpr("id", "concat('l', id % 6) AS c")
    found = model_tables.linear_scores(rows, weights, [], ["c"], ["id"])
    got = {r.id: r.score for r in found.collect()}
    assert got[5] == 0.5 and got[4] == pytest.approx(1 / (1 + 2.718281828459045 ** -4))
    start = found._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in start and "SortMergeJoin" not in start


def test_large_searches_hold_fewer_copies_at_once():
    search = models.Search({"regParam": [0.1]}, folds=3)
    assert [models._threads(search, n) for n in (0, 1000, 6_000_000, 20_000_000)] == [8, 8, 2, 1]


def test_linear_fits_have_bounded_partitions():
    assert [models._partitions("logistic", n) for n in (0, 100_000, 10**9)] == [1, 6, 512]
    assert [models._partitions("forest", n) for n in (0, 100_000, 20_000_000)] == [1, 6, 1001]


@pytest.mark.parametrize("name", ["score_forest", "forest_importance"])
def test_a_forest_by_rule_stores_no_model_rows(spark, sf, name):
    folder = Path(shared_folder(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    rows = queries.registered()[name](spark, sf).count()
    kept = [f for new in set(folder.iterdir()) - before for f in new.rglob("*") if f.is_file()]
    assert rows > 0 and 0 < sum(f.stat().st_size for f in kept) < 100_000  # means, cells and nodes; the rows take 500 KB


def test_rows_walk_in_place_without_a_shuffle(spark):
    schema = "tree int, node int, slot int, threshold double, left int, right int, value double, weight double"
    nodes = spark.createDataFrame([
        (0, 0, 0, 0.5, 4, 9, 0.0, 2.0), (0, 4, -1, None, -1, -1, 1.0, 2.0), (0, 9, 1, 3.0, 10, 11, 0.0, 2.0),
        (0, 10, -1, None, -1, -1, 5.0, 2.0), (0, 11, -1, None, -1, -1, None, 2.0),
        (1, 0, 1, 1.0, 1, 2, 0.0, 1.0), (1, 1, -1, None, -1, -1, 7.0, 1.0),  # its right child is missing
        (2, 3, -1, None, -1, -1, 100.0, 1.0),  # no root
        (7, 0, -1, None, -1, -1, 0.25, 4.0),
    ], schema)
    values = [(0.0, 0.0), (1.0, 2.0), (1.0, 4.0), (None, 1.0), (0.5, None), (None, None), (float("nan"), 1.0)]
    rows = spark.createDataFrame([(i, list(v)) for i, v in enumerate(values)], "id long, values array<double>")
    want = {tuple(r) for r in model_tables.tree_margins(rows, nodes, ["id"], "values", 2).collect()}
    alone = model_tables.tree_margins(rows, nodes, ["id"], "values", 2, grouped=False)
    assert {tuple(r) for r in alone.collect()} == want and len(want) == len(values)
    few = nodes.filter("tree in (1, 2)")  # rows that no tree takes are left out
    got = model_tables.tree_margins(rows, few, ["id"], "values", 2, grouped=False).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(0, 7.0, 1.0), (3, 7.0, 1.0), (6, 7.0, 1.0)]
    assert model_tables.tree_margins(rows, nodes.limit(0), ["id"], "values", 2, grouped=False).count() == 0
    twice = model_tables.tree_margins(rows.union(rows), nodes, ["id"], "values", 2, grouped=False)
    assert twice.count() == 2 * len(values)  # a key may repeat
    assert steps_of_rows(alone) <= {"Project", "Filter", "Generate", "Scan ExistingRDD", "RDDScan"}


def steps_of_rows(df):
    """Names of the steps that the rows go through, those of subqueries left out."""
    found, plans = set(), [df._jdf.queryExecution().sparkPlan()]
    while plans:
        plan = plans.pop()
        found.add(plan.nodeName().strip())
        children = plan.children()
        plans += [children.apply(i) for i in range(children.size())]
    return found


def test_the_forest_by_rule_moves_no_scored_rows(spark, sf):
    steps = steps_of_rows(queries.registered()["score_forest"](spark, sf))
    assert not [name for name in steps if "Aggregate" in name or "Join" in name or "Sort" in name], steps
