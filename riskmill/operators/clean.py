"""Projection, filtering, cleaning and feature preparation. All narrow: no shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import NumericType

from riskmill.functions import columns as C
from riskmill.operators.profile import null_shares
from riskmill.spec import SEED, TableSpec


def select_present(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The listed columns that exist, in the listed order."""
    return df.select(*[name for name in names if name in df.columns])


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Without the listed columns; absent names are fine."""
    return df.drop(*names)


def columns_by_type(df: DataFrame, numeric: bool = True, exclude: Sequence[str] = ()) -> list[str]:
    """Names of the numeric (or of the other) columns, in table order."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, NumericType) == numeric and f.name not in exclude
    ]


def exclude_leakage(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Without the columns known only after the outcome."""
    return df.drop(*spec.leakage)


def drop_null_target(df: DataFrame, label: str) -> DataFrame:
    """Rows with a label."""
    return df.na.drop(subset=[label])


def require_complete(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows with neither NULL nor NaN in the listed columns that exist.

    One condition per column, unlike ``na.drop``, keeps the optimizer's bookkeeping linear in
    the number of columns where derived columns follow.
    """
    for field in df.schema.fields:
        if field.name in names:
            df = df.filter(C.without_nan(F.col(field.name), field.dataType).isNotNull())
    return df


def sparse_columns(df: DataFrame, threshold: float = 0.5) -> list[str]:
    """Columns whose missing share is above the threshold.

    Runs one job and brings back one number per column: the schema of what follows depends
    on it. Give it a stored table, since the rows are read again afterwards.
    """
    shares = null_shares(df).first()
    return [name for name in df.columns if (shares[name] or 0.0) > threshold]


def drop_sparse_columns(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Without the columns of ``sparse_columns``."""
    return df.drop(*sparse_columns(df, threshold))


def cast_lenient(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the listed columns that exist; malformed values become NULL."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items() if c in df.columns})


def parse_columns(df: DataFrame, spec: TableSpec) -> DataFrame:
    """All typed columns of the spec in one projection: units, percents, lenient casts."""
    parsed = {c: F.col(c).try_cast(t) for c, t in spec.lenient_casts.items()}
    parsed |= {c: C.parse_unit_suffix(F.col(c), u, t) for c, (u, t) in spec.unit_columns.items()}
    parsed |= {c: C.parse_percent(F.col(c)) for c in spec.percent_columns}
    return df.withColumns({c: expr for c, expr in parsed.items() if c in df.columns})


def clean_table(df: DataFrame, spec: TableSpec, sparse: Sequence[str] | None = None) -> DataFrame:
    """Labelled rows, sparse and free-text columns dropped, typed, core columns complete.

    ``sparse`` gives the columns to drop when they are known already.
    """
    labelled = drop_null_target(df, spec.label)
    dropped = sparse_columns(labelled) if sparse is None else sparse
    typed = parse_columns(labelled.drop(*dropped, *spec.free_text), spec)
    return require_complete(typed, spec.core)


def fill_unknown(
    df: DataFrame, names: Sequence[str], level: str = "UNKNOWN", blank_is_missing: bool = True
) -> DataFrame:
    """A level of its own for missing categories, so their rows survive."""
    return df.withColumns({c: C.known_category(F.col(c), level, blank_is_missing) for c in names})


def map_ordinal(
    df: DataFrame, source: str, target: str, mapping: Mapping[str, float], default: float,
    normalize: bool = False,
) -> DataFrame:
    """Add the rank of an ordered category."""
    return df.withColumn(target, C.map_ordinal(F.col(source), mapping, default, normalize))


def safe_ratio(
    df: DataFrame, ratios: Mapping[str, tuple[str, str]], caps: Mapping[str, float] | None = None,
    zero_only: bool = False,
) -> DataFrame:
    """Add quotients of columns, optionally capped."""
    caps = caps or {}
    return df.withColumns({
        name: C.safe_ratio(F.col(top), F.col(bottom), caps.get(name), zero_only)
        for name, (top, bottom) in ratios.items()
    })


def interaction(df: DataFrame, pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Add products of columns."""
    return df.withColumns({n: C.interaction(F.col(a), F.col(b)) for n, (a, b) in pairs.items()})


def clip_upper(df: DataFrame, caps: Mapping[str, float]) -> DataFrame:
    """Cap columns from above."""
    return df.withColumns({c: C.clip_upper(F.col(c), cap) for c, cap in caps.items()})


def prepare_features(
    df: DataFrame, spec: TableSpec, keep: Sequence[str] = (), capped: bool = False,
    blank_is_missing: bool = True, normalize: bool = False, zero_only: bool = False,
) -> DataFrame:
    """Model rows: known categories, double numerics, derived features, no missing number.

    ``keep`` carries columns such as the key through. The other switches choose the variant
    of the rules meant for models that suffer from outliers and free-form categories.
    """
    required = [*spec.model_numeric, spec.label]
    typed = df.select(
        *keep,
        *[F.col(c).try_cast("double").alias(c) for c in [*spec.numeric, spec.label]],
        *[C.known_category(F.col(c), blank_is_missing=blank_is_missing).alias(c)
          for c in spec.categorical],
    )
    with_ordinals = typed.withColumns({
        name: C.map_ordinal(F.col(source), mapping, default, normalize)
        for name, (source, mapping, default) in spec.ordinals.items()
    })
    derived = safe_ratio(with_ordinals, spec.ratios, spec.ratio_caps if capped else None, zero_only)
    return require_complete(interaction(derived, spec.interactions), required)


def label_names(df: DataFrame, label: str, names: Mapping[int, str], target: str = "label") -> DataFrame:
    """Add the readable class name."""
    return df.withColumn(target, C.named_label(F.col(label), names))


def sample_rows(
    df: DataFrame, fraction: float, seed: int = SEED, by_key: Sequence[str] = ()
) -> DataFrame:
    """Sample of the rows; with ``by_key`` the same keys are chosen on every run."""
    if not 0.0 < fraction <= 1.0:
        raise ValueError("fraction must be in (0, 1]")
    if by_key:
        return df.filter(C.unit_hash(list(by_key), seed, "|sample") < fraction)
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)
