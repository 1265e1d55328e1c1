"""Which columns are worth using, and the findings of a profiling run, as tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import FractionalType, NumericType

from riskmill.functions.columns import guarded_corr, is_missing, share
from riskmill.operators.profile import distinct_count, rates_for_columns
from riskmill.operators.reshape import long_form
from riskmill.spec import TableSpec


def column_signals(df: DataFrame, spec: TableSpec, exact: bool = False) -> DataFrame:
    """Per usable column: missing share, distinct values, uniqueness and r with the label.

    One scan with columns as rows, or two with ``exact`` distinct counts, which shuffle the
    distinct values of every column. Uniqueness is the distinct share of whole numbers and
    text; fractional numbers are all but unique by nature and get none.
    """
    fields = [
        f for f in df.schema.fields if f.name != spec.label and f.name not in spec.leakage
    ]

    def measures(f):
        c = F.col(f.name)
        predictor = isinstance(f.dataType, NumericType) and f.name not in spec.non_predictors
        return (
            F.lit(isinstance(f.dataType, FractionalType)),
            is_missing(c, f.dataType),
            (c if predictor else F.lit(None)).cast("double"),
            F.when(c.isNotNull(), F.xxhash64(c)),
        )

    values = long_form(
        df, {f.name: measures(f) for f in fields}, ["fractional", "missing", "value", "hash"],
        keep={"label": F.col(spec.label).cast("double")},
    )
    signals = values.groupBy("feature", "fractional").agg(
        F.count("*").alias("n_rows"),
        F.count_if("missing").alias("n_missing"),
        F.round(guarded_corr(F.col("value"), F.col("label")), 4).alias("correlation"),
        F.approx_count_distinct("hash").alias("n_distinct"),
    )
    if exact:
        distinct = distinct_count(df, [f.name for f in fields])
        signals = signals.drop("n_distinct").join(
            distinct.withColumnRenamed("column", "feature"), "feature"
        )
    # An approximate count can exceed the rows; a column of missing values is missing, not constant.
    uniqueness = F.least(share(F.col("n_distinct"), F.col("n_rows") - F.col("n_missing")), F.lit(1.0))
    return signals.select(
        "feature", share(F.col("n_missing"), F.col("n_rows")).alias("null_share"), "n_distinct",
        F.when(F.col("fractional"), 0.0).otherwise(F.coalesce(uniqueness, F.lit(0.0)))
        .alias("uniqueness"),
        "correlation",
    )


def feature_relevance(
    df: DataFrame, spec: TableSpec, k: int = 7, exact: bool = False,
    notes: Mapping[str, str] | None = None,
) -> DataFrame:
    """The k most and the k least relevant columns with the measure that puts them there.

    Most relevant is the largest absolute r. Least relevant is what carries nothing: a
    constant, or else the larger of missing share and uniqueness; ties by smaller r.
    """
    constant = (F.col("n_distinct") == 1) & (F.col("null_share") < 1)
    emptiness = F.when(constant, 1.0).otherwise(F.greatest("null_share", "uniqueness"))
    signals = column_signals(df, spec, exact).select(
        "feature", "correlation", emptiness.alias("emptiness"),
        F.when(constant, "constant")
        .when(F.col("null_share") > 0.5, "mostly missing")
        .when(F.col("uniqueness") > 0.5, "nearly unique")
        .otherwise("weak signal").alias("weakness"),
    )
    strength = F.abs("correlation")
    # Both kinds come from one row, since a union of two branches would scan and count the table for each.
    both = signals.select(F.inline(F.array(
        F.struct(
            F.lit("most").alias("kind"), "feature", strength.alias("measure"),
            F.when(F.col("correlation") < 0, "falls with it").otherwise("rises with it").alias("reason"),
            F.lit(0.0).alias("tie"),
        ),
        F.struct(
            F.lit("least").alias("kind"), "feature", F.col("emptiness").alias("measure"),
            F.col("weakness").alias("reason"), F.coalesce(strength, F.lit(0.0)).alias("tie"),
        ),
    ))).filter((F.col("kind") == "least") | F.col("measure").isNotNull())
    # One row per table column and kind, so the windows stay small.
    ranked = Window.partitionBy("kind").orderBy(F.col("measure").desc(), "tie", "feature")
    result = (
        both.withColumn("position", F.row_number().over(ranked))
        .filter(F.col("position") <= k)
        .drop("tie")
    )
    written = {**spec.notes, **(notes or {})}
    if written:
        pairs = [F.lit(item) for pair in written.items() for item in pair]
        result = result.withColumn("note", F.try_element_at(F.create_map(*pairs), F.col("feature")))
    return result


def recommended_features(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The recommended inputs that exist and do not leak, with type and r with the label."""
    usable = [
        (name, kind)
        for names, kind in (
            (spec.recommended, "numeric"), (spec.recommended_categorical, "categorical"),
        )
        for name in names
        if name in df.columns and name not in spec.non_predictors
    ]
    row = df.agg(*[
        (guarded_corr(F.col(c), F.col(spec.label)) if kind == "numeric" else F.lit(None).cast("double"))
        .alias(c)
        for c, kind in usable
    ])
    return row.select(F.inline(F.array(*[
        F.struct(
            F.lit(i).alias("position"), F.lit(c).alias("feature"), F.lit(kind).alias("kind"),
            F.round(F.col(c), 4).alias("correlation"),
        )
        for i, (c, kind) in enumerate(usable, 1)
    ])))


def stage_summary(
    raw: DataFrame, clean: DataFrame, spec: TableSpec, groups: Sequence[str] = (),
    correlations: DataFrame | None = None, sparsest: int = 5,
) -> DataFrame:
    """Key findings as rows (metric, name, value).

    Row counts before and after cleaning, the positive share of the labelled raw rows, the
    strongest signal, the sparsest columns, and the extreme categories of each group.
    """
    labelled = F.count_if(F.col(spec.label).isNotNull())
    positives = F.count_if(F.col(spec.label).try_cast("double") == 1)
    before = raw.agg(
        F.count("*").alias("rows"), positives.alias("positives"), share(positives, labelled).alias("rate"),
        F.array(*(
            F.struct((-F.count_if(is_missing(F.col(f"`{f.name}`"), f.dataType))).alias("order"), F.lit(f.name).alias("name"))
            for f in raw.schema.fields
        )).alias("missing"),
    )
    # One aggregate over (group, category) for all groups; the whole table is a group with one category.
    rates = rates_for_columns(clean.withColumn("", F.lit("")), ["", *groups], spec.label)
    ends = rates.groupBy("column").agg(
        F.max(F.struct("rate", "category")).alias("highest"), F.min(F.struct("rate", "category")).alias("lowest"),
        F.sum("n").alias("n"),
    )
    after = ends.agg(
        F.max(F.when(F.col("column") == "", F.col("n"))).alias("kept"),
        F.collect_list(F.when(F.col("column") != "", F.struct("column", "highest", "lowest"))).alias("ends"),
    )
    both = before.unionByName(after, allowMissingColumns=True).agg(
        *(F.max(c).alias(c) for c in ("rows", "positives", "rate", "kept")),
        *(F.flatten(F.collect_list(c)).alias(c) for c in ("missing", "ends")),
    )

    def finding(metric, name, value):
        return F.struct(
            metric.alias("metric"), name.cast("string").alias("name"), F.round(value.cast("double"), 6).alias("value")
        )

    nobody, kept = F.lit(None), F.coalesce("kept", F.lit(0))
    findings = F.concat(
        F.array(
            finding(F.lit("rows_raw"), nobody, F.col("rows")), finding(F.lit("positives"), nobody, F.col("positives")),
            finding(F.lit("positive_share"), nobody, F.col("rate")), finding(F.lit("rows_clean"), nobody, kept),
            finding(F.lit("share_retained"), nobody, share(kept, F.col("rows"))),
        ),
        F.transform(F.slice(F.array_sort("missing"), 1, sparsest), lambda m: finding(
            F.lit("sparsest_column"), m["name"], share(-m["order"], F.col("rows"))
        )),
        *(F.transform("ends", lambda e: finding(
            F.concat(F.lit(f"{end}_rate_"), e["column"]), e[end]["category"], e[end]["rate"]
        )) for end in ("highest", "lowest")),
    )
    result = both.select(F.inline(findings))
    if correlations is not None:
        strongest = correlations.orderBy(F.abs("correlation").desc(), "feature").limit(1)
        result = result.unionByName(strongest.select(F.inline(F.array(
            finding(F.lit("strongest_signal"), F.col("feature"), F.col("correlation"))
        ))))
    return result
