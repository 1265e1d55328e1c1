"""Columns as rows, so that one small aggregate serves any number of columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame


def long_form(
    df: DataFrame, groups: Mapping[str, Sequence[Column]], values: Sequence[str],
    name: str = "feature", keep: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per input row and group: its name, its values, and the kept columns.

    ``DataFrame.unpivot`` moves one value per name; this is UNPIVOT with several.
    """
    kept = [column.alias(k) for k, column in (keep or {}).items()]
    slots = {g: [f"_{i}_{j}" for j in range(len(values))] for i, g in enumerate(groups)}
    flat = [
        column.alias(slot)
        for g, columns in groups.items()
        for slot, column in zip(slots[g], columns)
    ]
    quoted = {g: g.replace("`", "``").replace("{", "{{").replace("}", "}}") for g in groups}
    choices = ", ".join(f"({', '.join(slots[g])}) AS `{quoted[g]}`" for g in groups)
    return df.sparkSession.sql(
        f"SELECT * FROM {{flat}} UNPIVOT INCLUDE NULLS"
        f" (({', '.join(values)}) FOR `{name}` IN ({choices}))",
        flat=df.select(*kept, *flat),
    )
