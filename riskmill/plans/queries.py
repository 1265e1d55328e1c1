"""Every operator as a named query over the supplied tables.

Each takes (spark, sf_dir), reads the whole table and returns a DataFrame. Sums and means of
fractions are rounded, since their last digits depend on the order of addition.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.ml import Pipeline
from pyspark.ml.stat import Summarizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskmill.operators import (
    clean, correlation, curves, dedup, encode, metrics, model_tables, models, ordering, profile, relevance,
    report, split,
)
from riskmill.session import cut_lineage, scratch_path, tune
from riskmill.sources import tables
from riskmill.sources.loans import raw_loans
from riskmill.spec import LOANS

LABEL, KEY = LOANS.label, LOANS.key
Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def registered() -> dict[str, Query]:
    """All queries by name."""
    return dict(_QUERIES)


def _query(function: Query) -> Query:
    @wraps(function)
    def run(spark, sf):
        return function(tune(spark), sf)

    _QUERIES[function.__name__] = run
    return function


def _rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in names})


def labelled(spark, sf):
    return clean.drop_null_target(raw_loans(spark, sf), LABEL)


def cleaned(spark, sf):
    """Clean loans with the sparse column left in: the queries below prune it anyway."""
    return clean.clean_table(raw_loans(spark, sf), LOANS, sparse=())


def prepared(spark, sf, **switches):
    return clean.prepare_features(cleaned(spark, sf), LOANS, keep=[KEY], **switches)


def scored(spark, sf):
    """Labels with the planted score and a second one that follows the interest rate."""
    return raw_loans(spark, sf).select(
        KEY, LABEL, "score", (F.col("int_rate") / F.lit(25.0)).alias("rate_score")
    )


# Sources and sinks

@_query
def table_shape(spark, sf):
    return tables.table_shape(raw_loans(spark, sf), leading=5)


@_query
def require_columns(spark, sf):
    names = [KEY, *LOANS.raw_columns]
    return tables.require_columns(raw_loans(spark, sf), names).select(*names)


@_query
def csv_round_trip(spark, sf):
    loans = cleaned(spark, sf)
    path = scratch_path(spark, "clean-csv")
    tables.write_csv_table(loans, path)
    return tables.read_table(spark, path, schema=loans.schema)


@_query
def parquet_round_trip(spark, sf):
    loans = cleaned(spark, sf)
    path = scratch_path(spark, "clean-parquet")
    tables.write_parquet_table(loans, path)
    return tables.read_table(spark, path, "parquet")


@_query
def result_round_trip(spark, sf):
    rates = profile.rate_by(cleaned(spark, sf), "grade", LABEL)
    path = scratch_path(spark, "rates")
    tables.write_result(rates, path)
    return tables.read_result(spark, path, rates.schema)


@_query
def prediction_sample(spark, sf):
    rated = metrics.apply_threshold(scored(spark, sf), "score", 0.5)
    columns = [LABEL, "prediction_tuned", "score"]
    return tables.prediction_sample(rated, columns, order_by=[KEY], n=1000)


# Projection, filter, cleaning

@_query
def select_present(spark, sf):
    return clean.select_present(raw_loans(spark, sf), [KEY, *LOANS.summary, "no_such_column"])


@_query
def drop_columns(spark, sf):
    return clean.drop_columns(raw_loans(spark, sf), ["description", "desc"])


@_query
def columns_by_type(spark, sf):
    loans = raw_loans(spark, sf)
    return loans.select(*clean.columns_by_type(loans, exclude=LOANS.non_predictors))


@_query
def exclude_leakage(spark, sf):
    return clean.exclude_leakage(raw_loans(spark, sf), LOANS)


@_query
def drop_null_target(spark, sf):
    return labelled(spark, sf).select(KEY, LABEL, "grade")


@_query
def require_complete(spark, sf):
    return cleaned(spark, sf).select(KEY, *LOANS.core, LABEL)


@_query
def drop_sparse(spark, sf):
    return clean.drop_sparse_columns(labelled(spark, sf))


@_query
def cast_lenient(spark, sf):
    loans = clean.cast_lenient(raw_loans(spark, sf), LOANS.lenient_casts)
    return loans.select(KEY, *[c for c in LOANS.lenient_casts if c in loans.columns])


@_query
def parse_term(spark, sf):
    return clean.parse_columns(raw_loans(spark, sf), LOANS).select(KEY, "term")


@_query
def parse_percent(spark, sf):
    return clean.parse_columns(raw_loans(spark, sf), LOANS).select(KEY, "revol_util")


@_query
def clean_table(spark, sf):
    return clean.clean_table(raw_loans(spark, sf), LOANS)


@_query
def fill_unknown(spark, sf):
    loans = clean.fill_unknown(raw_loans(spark, sf), LOANS.categorical)
    return loans.select(KEY, *LOANS.categorical)


@_query
def fill_unknown_null_only(spark, sf):
    loans = clean.fill_unknown(raw_loans(spark, sf), LOANS.categorical, blank_is_missing=False)
    return loans.select(KEY, *LOANS.categorical)


@_query
def map_ordinal(spark, sf):
    source, mapping, default = LOANS.ordinals["grade_ord"]
    loans = clean.map_ordinal(raw_loans(spark, sf), source, "grade_ord", mapping, default)
    return loans.select(KEY, "grade", "grade_ord")


@_query
def map_ordinal_normalized(spark, sf):
    _, mapping, default = LOANS.ordinals["grade_ord"]
    messy = raw_loans(spark, sf).withColumn("grade_text", F.concat(F.lit(" "), F.lower("grade")))
    ranked = clean.map_ordinal(messy, "grade_text", "grade_ord", mapping, default, normalize=True)
    return ranked.select(KEY, "grade_text", "grade_ord")


@_query
def safe_ratio(spark, sf):
    loans = clean.safe_ratio(cleaned(spark, sf), LOANS.ratios)
    return loans.select(KEY, *LOANS.ratios)


@_query
def safe_ratio_capped(spark, sf):
    loans = clean.safe_ratio(cleaned(spark, sf), LOANS.ratios, LOANS.ratio_caps, zero_only=True)
    return loans.select(KEY, *LOANS.ratios)


@_query
def interaction(spark, sf):
    ranked = clean.map_ordinal(
        cleaned(spark, sf), "grade", "grade_ord", *LOANS.ordinals["grade_ord"][1:]
    )
    loans = clean.interaction(ranked, LOANS.interactions)
    return loans.select(KEY, *LOANS.interactions)


@_query
def clip_upper(spark, sf):
    ratios = clean.safe_ratio(cleaned(spark, sf), LOANS.ratios)
    clipped = clean.clip_upper(ratios, LOANS.ratio_caps)
    return clipped.select(KEY, *LOANS.ratio_caps)


@_query
def prepare_features(spark, sf):
    return prepared(spark, sf)


@_query
def prepare_features_capped(spark, sf):
    return prepared(
        spark, sf, capped=True, blank_is_missing=False, normalize=True, zero_only=True
    )


@_query
def label_names(spark, sf):
    named = clean.label_names(raw_loans(spark, sf), LABEL, LOANS.label_names, "class_name")
    return named.select(KEY, LABEL, "class_name")


@_query
def sample_by_key(spark, sf):
    return clean.sample_rows(raw_loans(spark, sf), 0.05, by_key=[KEY]).select(KEY, LABEL)


# Duplicates

@_query
def duplicate_report(spark, sf):
    return dedup.duplicate_report(raw_loans(spark, sf), KEY, LOANS.entity)


@_query
def duplicate_keys(spark, sf):
    return dedup.duplicate_keys(raw_loans(spark, sf), KEY)


@_query
def first_rows(spark, sf):
    return ordering.first_rows(dedup.duplicate_keys(raw_loans(spark, sf), KEY), 5, [KEY])


@_query
def distinct_rows(spark, sf):
    return dedup.drop_duplicate_rows(raw_loans(spark, sf))


@_query
def dedup_by_key(spark, sf):
    return dedup.dedup_by_key(raw_loans(spark, sf), KEY, order_by=[LOANS.entity])


# Aggregation and profiling

@_query
def row_count(spark, sf):
    return profile.row_count(raw_loans(spark, sf))


@_query
def distinct_count(spark, sf):
    return profile.distinct_count(raw_loans(spark, sf), [KEY, LOANS.entity, "emp_length"])


@_query
def summary_stats(spark, sf):
    stats = profile.summary_stats(raw_loans(spark, sf), LOANS.summary)
    return _rounded(stats, "mean", "stddev", "min", "max")


@_query
def null_profile(spark, sf):
    return profile.null_profile(raw_loans(spark, sf))


@_query
def null_profile_labelled(spark, sf):
    return profile.null_profile(labelled(spark, sf))


@_query
def top_nulls(spark, sf):
    return profile.top_nulls(raw_loans(spark, sf), 25)


@_query
def class_balance(spark, sf):
    return profile.class_balance(raw_loans(spark, sf), LABEL, LOANS.label_names)


@_query
def rate_by_grade(spark, sf):
    return profile.rate_by(cleaned(spark, sf), "grade", LABEL, order="key")


@_query
def rate_by_term(spark, sf):
    return profile.rate_by(cleaned(spark, sf), "term", LABEL, order="key")


@_query
def rates_for_columns(spark, sf):
    return profile.rates_for_columns(cleaned(spark, sf), LOANS.rate_columns, LABEL)


@_query
def top_categories(spark, sf):
    rates = profile.rates_for_columns(cleaned(spark, sf), LOANS.rate_columns, LABEL)
    return profile.top_categories(rates, 10)


@_query
def rate_ranking(spark, sf):
    rates = profile.rate_by(cleaned(spark, sf), "verification_status", LABEL)
    return profile.rate_ranking(rates, "verification_status")


@_query
def constant_columns(spark, sf):
    loans = cleaned(spark, sf)
    names = clean.columns_by_type(loans, exclude=LOANS.non_predictors)
    return profile.constant_columns(loans, names)


@_query
def corr_target_pairwise(spark, sf):
    return _correlations(clean.parse_columns(labelled(spark, sf), LOANS), "pairwise")


@_query
def corr_target_zero(spark, sf):
    return _correlations(clean.parse_columns(labelled(spark, sf), LOANS), "zero")


def _correlations(loans, nulls):
    names = clean.columns_by_type(loans, exclude=[*LOANS.non_predictors, "score"])
    return correlation.correlation_with_target(loans, names, LABEL, nulls)


@_query
def skipped_correlations(spark, sf):
    loans = clean.parse_columns(labelled(spark, sf), LOANS).withColumn("unused", F.lit(None).cast("double"))
    names = clean.columns_by_type(loans, exclude=["score"])
    return correlation.skipped_correlations(loans, names, LABEL)


@_query
def corr_matrix(spark, sf):
    return _rounded(correlation.correlation_matrix(cleaned(spark, sf), LOANS.matrix_columns), "r")


@_query
def histogram_by_label(spark, sf):
    counts = profile.histogram_by_label(cleaned(spark, sf), LOANS.histogram_columns, LABEL)
    return _rounded(counts, "bin_start", "bin_end")


@_query
def histogram_per_class(spark, sf):
    counts = profile.histogram_by_label(
        cleaned(spark, sf), LOANS.histogram_columns, LABEL, per_class=True
    )
    return _rounded(counts, "bin_start", "bin_end")


@_query
def cleaning_funnel(spark, sf):
    raw = raw_loans(spark, sf)
    unique = dedup.dedup_by_key(raw, KEY, order_by=[LOANS.entity])
    target = clean.drop_null_target(unique, LABEL)
    complete = clean.clean_table(unique, LOANS)
    return profile.cleaning_funnel([
        ("raw", raw), ("unique_key", unique), ("labelled", target), ("core_complete", complete),
    ])


@_query
def feature_relevance(spark, sf):
    loans = cleaned(spark, sf).drop("score")
    return _rounded(relevance.feature_relevance(loans, LOANS, exact=True), "measure")


@_query
def recommended_features(spark, sf):
    return relevance.recommended_features(cleaned(spark, sf), LOANS)


@_query
def stage_summary(spark, sf):
    raw, loans = raw_loans(spark, sf), cleaned(spark, sf)
    return relevance.stage_summary(
        raw, loans, LOANS, groups=["grade", "term", "verification_status"],
        correlations=_correlations(loans, "pairwise"), sparsest=5,
    )


# Sorts, limits, set operations

@_query
def order_by(spark, sf):
    rates = profile.rate_by(cleaned(spark, sf), "sub_grade", LABEL, order="key")
    return ordering.order_by(rates, ["rate"], desc=True, ties=["sub_grade"])


@_query
def order_by_abs(spark, sf):
    loans = clean.parse_columns(labelled(spark, sf), LOANS)
    return ordering.order_by_abs(_correlations(loans, "pairwise"), "correlation", ["feature"])


@_query
def top_k(spark, sf):
    loans = raw_loans(spark, sf).select(KEY, "grade", "annual_inc", "loan_amnt")
    return ordering.top_k(loans, "loan_amnt", 25, ties=[KEY, "grade", "annual_inc"])


@_query
def union_by_name(spark, sf):
    loans = raw_loans(spark, sf).select(KEY, LABEL, "grade")
    negatives = loans.filter(F.col(LABEL) == 0)
    positives = loans.filter(F.col(LABEL) == 1).select("grade", LABEL, KEY)
    return ordering.union_by_name(negatives, positives)


@_query
def argmax_row(spark, sf):
    rates = profile.rate_by(cleaned(spark, sf), "sub_grade", LABEL, order="key")
    return ordering.argmax_row(rates, "rate", ["sub_grade"])


# Split, weights, undersampling

@_query
def stratified_split(spark, sf):
    return split.stratified_split(raw_loans(spark, sf), LABEL, KEY).select(KEY, LABEL, "split")


@_query
def split_balance(spark, sf):
    return split.split_balance(split.stratified_split(raw_loans(spark, sf), LABEL, KEY), LABEL)


@_query
def class_weights(spark, sf):
    parts = split.stratified_split(raw_loans(spark, sf), LABEL, KEY)
    train = parts.filter(F.col("split") == "train")
    return split.add_class_weights(train, LABEL).select(KEY, LABEL, "weight")


@_query
def class_counts(spark, sf):
    return split.class_counts(raw_loans(spark, sf), LABEL)


@_query
def undersample(spark, sf):
    parts = split.stratified_split(raw_loans(spark, sf), LABEL, KEY)
    train = parts.filter(F.col("split") == "train")
    return split.undersample(train, LABEL, KEY, 3.0).select(KEY, LABEL)


# Feature stages

def _slot_sums(vectors, *by, spec=LOANS):
    """Sum of every vector slot, by part if columns are given."""
    names = encode.feature_names(vectors, spec)
    sums = vectors.groupBy(*by).agg(Summarizer.sum(F.col("features")).alias("sums"))
    return sums.select(*by, F.posexplode(vector_to_array("sums")).alias("slot", "total")).select(
        *by, F.get(F.lit(names), F.col("slot")).alias("feature"), F.round("total", 2).alias("total")
    )


@_query
def index_categories(spark, sf):
    rows = prepared(spark, sf).select(KEY, *LOANS.categorical)
    indexed = encode.index_categories(LOANS.categorical).fit(rows).transform(rows)
    return indexed.select(KEY, *[f"{c}_idx" for c in LOANS.categorical])


@_query
def index_by_table(spark, sf):
    rows = prepared(spark, sf).select(KEY, *LOANS.categorical)
    indexed = encode.with_codes(rows, encode.category_codes(rows, LOANS.categorical), LOANS.categorical)
    return indexed.select(KEY, *[f"{c}_idx" for c in LOANS.categorical])


@_query
def category_codes(spark, sf):
    return encode.category_codes(prepared(spark, sf), LOANS.categorical)


@_query
def one_hot(spark, sf):
    rows = prepared(spark, sf).select(*LOANS.categorical)
    stages = [
        encode.index_categories(LOANS.categorical), encode.one_hot(LOANS.categorical),
        encode.assemble([f"{c}_ohe" for c in LOANS.categorical]),
    ]
    return _slot_sums(Pipeline(stages=stages).fit(rows).transform(rows))


@_query
def assemble(spark, sf):
    loans = clean.parse_columns(raw_loans(spark, sf), LOANS).select(*LOANS.numeric)
    return _slot_sums(encode.assemble(LOANS.numeric, handle_invalid="skip").transform(loans))


@_query
def scale(spark, sf):
    numeric = list(LOANS.numeric)
    rows = prepared(spark, sf).select(KEY, *numeric)
    scaled = Pipeline(stages=encode.scale(numeric)).fit(rows).transform(rows)
    values = scaled.withColumn("scaled", vector_to_array("scaled"))
    return values.select(
        KEY, *[F.round(F.col("scaled")[i], 6).alias(c) for i, c in enumerate(numeric)]
    )


@_query
def feature_pipeline(spark, sf):
    parts = split.stratified_split(prepared(spark, sf), LABEL, KEY)
    train = parts.filter(F.col("split") == "train")
    return _slot_sums(encode.feature_pipeline(LOANS).fit(train).transform(train))


@_query
def feature_pipeline_parts(spark, sf):
    """Fitted on the training part, applied to all parts."""
    parts = split.stratified_split(prepared(spark, sf), LABEL, KEY)
    train = parts.filter(F.col("split") == "train")
    return _slot_sums(encode.feature_pipeline(LOANS).fit(train).transform(parts), "split")


# Evaluation

@_query
def apply_threshold(spark, sf):
    best = curves.best_threshold(curves.threshold_sweep(scored(spark, sf), LABEL, "score"))
    return metrics.apply_threshold(scored(spark, sf), "score", best).select(
        KEY, "score", "prediction_tuned"
    )


def _counts(spark, sf, score="score", cut=0.5):
    rated = metrics.apply_threshold(scored(spark, sf), score, cut)
    return metrics.confusion_counts(rated, LABEL, "prediction_tuned")


@_query
def confusion_counts(spark, sf):
    return _counts(spark, sf)


@_query
def class_metrics(spark, sf):
    return metrics.class_metrics(_counts(spark, sf))


@_query
def overall_metrics(spark, sf):
    return _rounded(
        metrics.overall_metrics(_counts(spark, sf)),
        "accuracy", "precision_weighted", "recall_weighted",
    )


@_query
def auc_roc(spark, sf):
    return _rounded(curves.auc_roc(scored(spark, sf), LABEL, "score"), "auc_roc")


@_query
def auc_pr(spark, sf):
    return _rounded(curves.auc_pr(scored(spark, sf), LABEL, "score"), "auc_pr")


@_query
def average_precision(spark, sf):
    areas = curves.average_precision(scored(spark, sf), LABEL, "score")
    return _rounded(areas, "average_precision")


@_query
def roc_points(spark, sf):
    return curves.roc_points(scored(spark, sf), LABEL, "score")


@_query
def pr_points(spark, sf):
    return curves.pr_points(scored(spark, sf), LABEL, "score")


@_query
def threshold_sweep(spark, sf):
    return curves.threshold_sweep(scored(spark, sf), LABEL, "score")


@_query
def best_threshold(spark, sf):
    return curves.best_threshold(curves.threshold_sweep(scored(spark, sf), LABEL, "score"))


# Reports over two scored "models": the planted score and the interest-rate score

MODELS = {"planted": "score", "rate": "rate_score"}


def _stored_split(rows, name):
    """Rows with their part, written once in the shared folder: what follows reads them often."""
    path = scratch_path(rows.sparkSession, name)
    split.stratified_split(rows, LABEL, KEY).write.partitionBy("split").parquet(path)
    return tables.read_table(rows.sparkSession, path, "parquet")


def _evaluations(spark, sf, tuned, part="test"):
    rows = _stored_split(scored(spark, sf), "scored-rows")
    train, val = (rows.filter(F.col("split") == name) for name in ("train", "val"))
    target = rows.filter(F.col("split") == part)
    results = []
    for name, column in MODELS.items():
        cut, chosen = 0.5, None
        if tuned:
            cut = chosen = curves.best_threshold(curves.threshold_sweep(val, LABEL, column))
        rated = metrics.apply_threshold(target, column, cut, "prediction")
        results.append(report.evaluate(
            rated, LABEL, column, "prediction", name, threshold=cut,
            train_rows=profile.row_count(train), validation_f1=chosen,
        ))
    return ordering.union_by_name(*results)


def _stored_evaluations(spark, sf):
    """One row per model, plain and tuned, stored because several results are built on them."""
    return [cut_lineage(_evaluations(spark, sf, tuned)) for tuned in (False, True)]


RATED = ("accuracy", "precision_weighted", "recall_weighted", "auc_roc", "auc_pr")


@_query
def evaluate(spark, sf):
    return _rounded(_evaluations(spark, sf, tuned=False), *RATED)


@_query
def evaluate_tuned(spark, sf):
    return _rounded(_evaluations(spark, sf, tuned=True), *RATED)


@_query
def threshold_table(spark, sf):
    return report.threshold_table(_evaluations(spark, sf, tuned=True))


@_query
def confusion_table(spark, sf):
    return report.confusion_table(_evaluations(spark, sf, tuned=False))


@_query
def confusion_table_tuned(spark, sf):
    return report.confusion_table(_evaluations(spark, sf, tuned=True), tuned=True)


@_query
def compare_scores(spark, sf):
    return report.compare_models(*_stored_evaluations(spark, sf))


@_query
def select_best(spark, sf):
    best = report.select_best(_evaluations(spark, sf, tuned=True, part="val"), "f1")
    return _rounded(best, *RATED)


@_query
def model_summary(spark, sf):
    plain, tuned = _stored_evaluations(spark, sf)
    rows = split.stratified_split(scored(spark, sf), LABEL, KEY)
    best = [
        ("f1", report.select_best(tuned, "f1"), "f1"),
        ("auc_roc", report.select_best(plain, "auc_roc"), "auc_roc"),
    ]
    return report.model_summary(plain, tuned, split.split_balance(rows, LABEL), LOANS, best)


# Models, at small settings

def _parts(spark, sf):
    parts = _stored_split(prepared(spark, sf), "model-rows")
    train, val, test = (parts.filter(F.col("split") == name) for name in split.PARTS)
    return split.add_class_weights(train, LABEL), val, test


def _scored(spark, sf, kind):
    """Validation and test rows, scored by a fit at the default settings."""
    train, val, test = _parts(spark, sf)
    model, _ = models.train_classifier(train, LOANS, kind)
    return _rounded(models.score(model, val.unionByName(test), [KEY, LABEL, "split"]), "score")


@_query
def train_logistic(spark, sf):
    return _scored(spark, sf, "logistic")


@_query
def train_random_forest(spark, sf):
    return _scored(spark, sf, "forest")


@_query
def train_gbt(spark, sf):
    return _scored(spark, sf, "boosting")


@_query
def fit_with_search(spark, sf):
    train, _, _ = _parts(spark, sf)
    search = models.search_preset("logistic", "small", fold_key=[KEY])
    _, results = models.train_classifier(train, LOANS, "logistic", search)
    return _rounded(results, "value")


def _marked(spark, sf):
    """Model rows with their part of the split."""
    return _stored_split(prepared(spark, sf), "marked-rows")


def _rule_weights(train):
    """A linear model by rule: distances of class means over variances, log odds of levels."""
    one, zero = F.col(LABEL) == 1, F.col(LABEL) == 0
    numbers = train.unpivot(LABEL, list(LOANS.model_numeric), "column", "x").groupBy("column").agg(
        F.avg(F.when(one, F.col("x"))).alias("m1"), F.avg(F.when(zero, F.col("x"))).alias("m0"),
        F.var_pop("x").alias("spread"),
    ).select("column", F.when(F.col("spread") > 0, (F.col("m1") - F.col("m0")) / F.col("spread")).otherwise(0.0).alias("weight"), "m1", "m0")
    levels = train.unpivot(LABEL, list(LOANS.categorical), "column", "level").groupBy("column", "level").agg(
        F.log((F.count_if(one) + 0.5) / (F.count_if(zero) + 0.5)).alias("weight")
    )
    middle = numbers.agg((-F.sum(F.col("weight") * (F.col("m1") + F.col("m0")) / 2)).alias("weight"))
    return levels.unionByName(numbers.select("column", "weight"), allowMissingColumns=True).unionByName(
        middle, allowMissingColumns=True
    )


@_query
def score_linear(spark, sf):
    """Validation and test rows, scored by a table of weights that a rule gives."""
    rows = _marked(spark, sf)
    weights = _rule_weights(rows.filter(F.col("split") == "train"))
    return _rounded(model_tables.linear_scores(
        rows.filter(F.col("split") != "train"), weights, LOANS.model_numeric, LOANS.categorical, [KEY, "split"]
    ), "score")


def _split_rows(spark, sf):
    """Model rows with their part of the split, computed anew whenever they are read: dozens of derived numbers for
    each row take several times the disk of the table that they come from, and a forest by rule reads them thrice."""
    return split.stratified_split(prepared(spark, sf), LABEL, KEY)


def _rule_nodes(train):
    """Trees by rule, one per numeric: it splits at its mean, and both halves at the mean of the next one."""
    names = LOANS.model_numeric
    # One stored row, since the cells and the thresholds both need it and would scan all rows again.
    means = cut_lineage(train.agg(*(F.round(F.avg(c), 3).alias(c) for c in names)).select(F.array(*names))).scalar()
    at = lambda i: F.get(means, F.lit(i % len(names)))
    sides = train.select((F.col(LABEL) == 1).alias("one"), F.explode(F.array(*(
        F.struct(
            F.lit(i).alias("tree"), F.when(F.col(c) <= at(i), 1).otherwise(2).alias("half"),
            F.when(F.col(names[(i + 1) % len(names)]) <= at(i + 1), 1).otherwise(2).alias("quarter"),
        ) for i, c in enumerate(names)
    ))).alias("s"))
    cells = cut_lineage(sides.groupBy("s.tree", "s.half", "s.quarter").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("one").alias("pos")
    ))
    node = {0: F.lit(0), 1: F.col("half"), 2: 2 * F.col("half") + F.col("quarter")}
    counts = None
    for depth, number in node.items():
        level = cells.groupBy("tree", number.cast("int").alias("node")).agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))
        level = level.withColumn("depth", F.lit(depth))
        counts = level if counts is None else counts.unionByName(level)
    rate = F.col("pos") / F.col("n")
    rated = counts.withColumns({"value": rate, "impure": F.col("n") * 2 * rate * (1 - rate)})
    below = rated.filter("node > 0").groupBy("tree", F.floor((F.col("node") - 1) / 2).cast("int").alias("node")).agg(
        F.sum("impure").alias("rest")
    )
    inner, next_slot = F.col("depth") < 2, (F.col("tree") + F.col("depth")) % len(names)
    return rated.join(below, ["tree", "node"], "left").select(
        "tree", "node", F.when(inner, next_slot).otherwise(-1).alias("slot"),
        F.when(inner, F.get(means, next_slot)).alias("threshold"),
        F.when(inner, 2 * F.col("node") + 1).otherwise(-1).alias("left"),
        F.when(inner, 2 * F.col("node") + 2).otherwise(-1).alias("right"), "value",
        ((F.col("impure") - F.coalesce("rest", F.lit(0.0))) / F.col("n")).alias("gain"),
        F.col("n").cast("double").alias("mass"), F.lit(1.0).alias("weight"),
    )


@_query
def score_forest(spark, sf):
    """Validation and test rows, scored by walking a table of nodes that a rule gives."""
    rows = _split_rows(spark, sf)
    nodes = cut_lineage(_rule_nodes(rows.filter(F.col("split") == "train")))
    rest = rows.filter(F.col("split") != "train").select(
        KEY, "split", F.array(*(F.col(c).cast("double") for c in LOANS.model_numeric)).alias("values"),
    )
    margins = model_tables.tree_margins(rest, nodes, [KEY, "split"], "values", 2, grouped=False)  # keys repeat
    return _rounded(model_tables.forest_scores(margins), "score")


@_query
def forest_importance(spark, sf):
    """The importance of each slot by the gains in a table of nodes that a rule gives."""
    nodes = cut_lineage(_rule_nodes(_split_rows(spark, sf).filter(F.col("split") == "train")))
    return _rounded(model_tables.tree_importances(nodes), "importance")


@_query
def feature_importance(spark, sf):
    train, _, _ = _parts(spark, sf)
    forest = models.train_random_forest(train, LOANS)
    return _rounded(models.feature_importance(forest, train, LOANS), "importance")


@_query
def compare_models(spark, sf):
    train, val, test = _parts(spark, sf)
    plain, tuned = [], []
    for kind in models.CLASSIFIERS:
        model, _ = models.train_classifier(train, LOANS, kind)
        best = curves.best_threshold(
            curves.threshold_sweep(models.score(model, val, [LABEL]), LABEL, "score")
        )
        rows = cut_lineage(models.score(model, test, [LABEL]))  # read by the sweep, both evaluations and the areas
        areas = curves.curve_areas(rows, LABEL, "score")
        size = profile.row_count(train)
        plain.append(report.evaluate(
            rows, LABEL, "score", "prediction", kind, train_rows=size, areas=areas
        ))
        rated = metrics.apply_threshold(rows, "score", best)
        tuned.append(report.evaluate(
            rated, LABEL, "score", "prediction_tuned", kind, threshold=best,
            train_rows=size, validation_f1=best, areas=areas,
        ))
    return report.compare_models(ordering.union_by_name(*plain), ordering.union_by_name(*tuned))
