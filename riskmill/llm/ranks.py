"""Numbers from 0 within groups, without one task for a hot group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def ranked(df: DataFrame, group: str, order: list[str], *, lanes: int = 256, name: str = "rank") -> DataFrame:
    """Adds `name`: 0, 1, ... within each group, by the hash of `order` and then `order`.

    A group is dealt over `lanes` by that hash; each lane is numbered by its own task, after the sizes of
    the lanes before it. Only the sizes, at most `lanes` per group, are summed up in one go.
    """
    dealt = df.withColumn("lane", F.pmod(F.xxhash64(*order), F.lit(lanes)).cast("int"))
    within = Window.partitionBy(group, "lane").orderBy(*order)
    before = Window.partitionBy(group).orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy(group, "lane").count().withColumn("before", F.coalesce(F.sum("count").over(before), F.lit(0)))
    numbered = dealt.withColumn("within", F.row_number().over(within) - 1)
    return numbered.join(offsets.drop("count"), [group, "lane"]).withColumn(
        name, F.col("before") + F.col("within")
    ).drop("lane", "before", "within")
