"""Column-schema operators: tolerant select, mapped rename, stamping, required
columns, registry intersection and type coercion.

All of these are plan-time operations on ``df.columns`` / ``df.schema`` plus
projections; none of them triggers a job.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class MissingColumnsError(ValueError):
    """Raised when required columns are absent."""


def select_tolerant(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Keep the listed columns that exist, in list order; unknown names are skipped."""
    have = set(df.columns)
    keep = [c for c in cols if c in have]
    return df.select(*keep)


def rename_keep(df: DataFrame, mapping: Mapping[str, str], keep: Iterable[str] | None = None) -> DataFrame:
    """Rename ``old -> new`` for the pairs whose old name exists, then keep ``keep``
    (default: the targets of the mapping) tolerantly."""
    present = {o: n for o, n in mapping.items() if o in df.columns and o != n}
    out = df.withColumnsRenamed(present) if present else df
    return select_tolerant(out, list(keep) if keep is not None else list(mapping.values()))


def rename_if_absent(df: DataFrame, old: str, new: str) -> DataFrame:
    """Rename ``old`` to ``new`` only when ``old`` exists and ``new`` does not."""
    if old in df.columns and new not in df.columns:
        return df.withColumnRenamed(old, new)
    return df


def stamp(df: DataFrame, **values) -> DataFrame:
    """Add literal columns (e.g. ``level='MLB'``)."""
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def stamp_front(df: DataFrame, **values) -> DataFrame:
    """Add literal columns in front of the existing ones."""
    return df.select(*[F.lit(v).alias(k) for k, v in values.items()], *df.columns)


def require_columns(df: DataFrame, cols: Iterable[str], what: str = "input") -> DataFrame:
    """Fail fast, naming every missing column."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise MissingColumnsError(f"{what} is missing required columns: {', '.join(missing)}")
    return df


def send_columns(df: DataFrame, target: T.StructType, auto_cols: Iterable[str] = ("scraped_at",)) -> list[str]:
    """Columns of ``df`` that the target accepts, minus server-stamped columns.
    Raises when nothing is left to send."""
    target_names = [f.name for f in target.fields]
    auto = set(auto_cols)
    cols = [c for c in df.columns if c in target_names and c not in auto]
    if not cols:
        raise MissingColumnsError("no matching columns between the frame and the target table")
    return cols


def _cast(col: Column, dtype: T.DataType, strict: bool) -> Column:
    if isinstance(dtype, T.StringType):
        return col.cast("string")
    if strict:
        return col.cast(dtype)
    return col.try_cast(dtype)


def coerce_to_schema(
    df: DataFrame,
    target: T.StructType,
    strict: bool = False,
    bad_counts: bool = False,
) -> DataFrame:
    """Cast every column that the target knows to the target's type.

    Text is trimmed first so that space-padded numbers (``' 95.1'``) parse.
    ``strict=False`` uses ``try_cast`` (bad values become NULL); ``strict=True``
    raises on the first bad value at execution time. With ``bad_counts=True`` a
    ``_bad_values`` column counts, per row, values that were non-NULL before and
    NULL after the cast.
    """
    types = {f.name: f.dataType for f in target.fields}
    exprs = []
    bad = []
    for c in df.columns:
        if c not in types:
            exprs.append(F.col(c))
            continue
        src = df.schema[c].dataType
        dst = types[c]
        col = F.col(c)
        if isinstance(src, T.StringType) and not isinstance(dst, T.StringType):
            col = F.trim(col)
            if isinstance(dst, T.BooleanType):
                col = F.lower(col)
        casted = col if src == dst else _cast(col, dst, strict)
        exprs.append(casted.alias(c))
        if bad_counts and src != dst:
            bad.append(F.when(F.col(c).isNotNull() & casted.isNull(), 1).otherwise(0))
    out = df.select(*exprs)
    if bad_counts:
        total = bad[0] if bad else F.lit(0)
        for b in bad[1:]:
            total = total + b
        out = df.select(*exprs, total.alias("_bad_values"))
    return out


def conform(df: DataFrame, target: T.StructType, strict: bool = False) -> DataFrame:
    """Project to exactly the target schema: coerce shared columns, add the
    missing ones as typed NULLs, drop the rest, in target order."""
    coerced = coerce_to_schema(select_tolerant(df, [f.name for f in target.fields]), target, strict)
    return coerced.select(
        *[
            (F.col(f.name) if f.name in coerced.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in target.fields
        ]
    )
