"""Mixing sources to target weights, in DataFrame functions only.

Each source gets a share of the mix by weight, at most `most_repeats` times its own size. It first
gives whole epochs of all its documents; the rest of its budget is a sample without replacement by
Efraimidis and Spirakis: a document's key is exponential with its quality weight as the rate, keys
are sorted within the source, and sizes are summed up in that order until the budget is reached.

Rules: a source that is NULL is a source, sorted last. Size NULL counts as 0. A quality weight that
is NULL, NaN or not positive counts as `LEAST_WEIGHT`. Keys follow from the document's id alone, so reruns agree and
repeated rows of an id share one fate. The document on the edge of the budget is taken if at least
half of it fits. An empty table gives an empty mix.

At scale: one narrow row per document is shuffled once. The order within a source is cut into
ranges of the key (64 for each doubling), so a source with a third of all rows is summed by several
hundred tasks, and only the totals of the ranges are summed one after the other. What comes out is
one row per source; it is joined to the documents where they are, and texts are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskmill.llm.store import stored

LEAST_WEIGHT = 1e-3
#: Ranges of the key for each doubling of it.
RANGES = 64
#: A table of sources with more rows is joined by a shuffle.
BROADCAST_SOURCES = 50_000

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words of a text; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_quality(text: Column) -> Column:
    """1 for plain prose, down to 0.05 as up to a tenth of the characters are symbols."""
    symbols = F.length(text) - F.length(F.translate(text, "#$%&*|!<>{}[]=\\~^_@", ""))
    return F.coalesce(
        F.greatest(F.lit(0.05), F.lit(1.0) - symbols * F.lit(10.0) / F.greatest(F.length(text), F.lit(1))),
        F.lit(0.05),
    )


def exponential_key(key: Column, weight: Column, seed: int) -> Column:
    """-ln(u) / weight, where u in (0, 1) follows from the key."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    usable = F.when((weight > LEAST_WEIGHT) & ~F.isnan(weight), weight.cast("double"))
    return -F.log(u) / F.coalesce(usable, F.lit(LEAST_WEIGHT))


def source_targets(totals: DataFrame, weights: tuple[float, ...], budget_share: float, most_repeats: int) -> DataFrame:
    """Adds `target` to one row per source with `source` and `source_size`.

    A source fills up before another if its limit is smaller for its weight. With the sources in that
    order, the level of the rest follows from what is left for each number of full sources; the first
    level that fills no further source holds.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    ranked = totals.withColumn("at", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.element_at(cycle, (F.col("at") % len(weights) + 1).cast("int"))
    )
    limit = F.col("source_size") * F.lit(float(most_repeats))
    by_fill = Window.orderBy(limit / F.col("weight"), "at")
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy()) * F.lit(float(budget_share))
    level = (total - F.coalesce(F.sum(limit).over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    holds = F.when(level * F.col("weight") <= limit, level)
    ranked = ranked.withColumn("level", F.max(holds).over(Window.partitionBy()))
    share = F.coalesce(F.least(F.col("level") * F.col("weight"), limit), limit)
    return ranked.select("source", "source_size", share.alias("target"))


def mix_plan(
    docs: DataFrame, key: str, source: str, size: Column, weight: Column, *,
    weights: tuple[float, ...] = (5, 2, 1), budget_share: float = 1.0, most_repeats: int = 3, seed: int = 17,
) -> DataFrame:
    """One row per source: source, source_size, target, epochs, and the last key and id of the sample."""
    narrow = stored(docs.select(
        F.col(source).alias("source"), F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"),
        F.coalesce(size, F.lit(0)).cast("long").alias("size"),
        exponential_key(F.col(key), weight, seed).alias("draw"),
    )).withColumn("lane", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")))
    narrow = narrow.withColumn("range", F.floor(F.log2("draw") * RANGES))
    totals = narrow.groupBy("lane", "source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(totals.drop("lane"), weights, budget_share, most_repeats)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.withColumn("epochs", F.least(epochs, F.lit(most_repeats)).cast("long")).withColumn(
        "rest", F.col("target") - F.col("epochs") * F.col("source_size")
    ).withColumn("lane", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")))

    in_order = Window.partitionBy("lane").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = narrow.groupBy("lane", "range").agg(F.sum("size").alias("in_range")).withColumn(
        "before", F.coalesce(F.sum("in_range").over(in_order), F.lit(0))
    ).join(targets.select("lane", "rest"), "lane")
    within = Window.partitionBy("lane", "range").orderBy("draw", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
    summed = narrow.withColumn("sum", F.sum("size").over(within)).join(ranges, ["lane", "range"])
    fits = F.col("before") + F.col("sum") - F.col("size") / 2.0 <= F.col("rest")
    edge = summed.filter(fits & (F.col("rest") > 0)).groupBy("lane").agg(F.max(F.struct("draw", "id")).alias("last"))
    return targets.join(edge, "lane", "left").select("source", "source_size", "target", "epochs", "last")


def mix_documents(
    docs: DataFrame, key: str, source: str, size: Column, weight: Column, *, seed: int = 17, **plan,
) -> DataFrame:
    """The documents with mix_size, mix_source_size, mix_target and mix_copies: how often the mix
    takes each. Columns that already have a name beginning with mix_ are replaced."""
    docs = docs.drop(*(c for c in docs.columns if c.startswith("mix_")))
    sources = stored(mix_plan(docs, key, source, size, weight, seed=seed, **plan))
    small = sources.count() <= BROADCAST_SOURCES
    sources = sources.select(*(F.col(c).alias(f"mix_{c}") for c in sources.columns))
    drawn = docs.withColumn("mix_size", F.coalesce(size, F.lit(0)).cast("long")).withColumn(
        "mix_draw", exponential_key(F.col(key), weight, seed)
    )
    match = drawn[source].eqNullSafe(sources["mix_source"])
    joined = drawn.join(F.broadcast(sources) if small else sources, match, "left")
    here = F.struct(F.col("mix_draw").alias("draw"), F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"))
    sampled = F.coalesce(here <= F.col("mix_last"), F.lit(False)).cast("long")
    return joined.withColumn("mix_copies", F.col("mix_epochs") + sampled).drop(
        "mix_draw", "mix_source", "mix_epochs", "mix_last"
    )


def mixed_documents(docs: DataFrame, key: str, source: str, size: Column, weight: Column, **plan) -> DataFrame:
    """The rows of the mix with the columns of `docs` alone, whatever their names: each as often as it is taken."""
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("document")
    apart = docs.select(whole, F.col(key).alias("key"), F.col(source).alias("source"), size.alias("size"), weight.alias("weight"))
    mix = mix_documents(apart, "key", "source", F.col("size"), F.col("weight"), **plan)
    return mixed_rows(mix, ["document"]).select("document.*")


def mixed_rows(mix: DataFrame, columns: list[str]) -> DataFrame:
    """The rows of the mix itself: each document as often as it is taken."""
    return mix.filter("mix_copies > 0").withColumn(
        "mix_copy", F.explode(F.sequence(F.lit(1), F.col("mix_copies").cast("int")))
    ).select(*columns)
