"""Parameterised audit queries: lookups, counts, integrity (anti-joins),
completeness, cross-source coverage, fan-out checks, summaries.

Every function takes DataFrames and column names and returns a DataFrame; none of
them collects. Joins are left to Catalyst and AQE (a small side is broadcast at
runtime from its measured size; skewed partitions are split).
"""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake.operators.windows import share_of_total


def name_lookup(df: DataFrame, name_col: str, fragment: str, cols: Sequence[str]) -> DataFrame:
    """Rows whose ``name_col`` contains ``fragment``, case-insensitive (ILIKE)."""
    return df.filter(F.col(name_col).ilike(f"%{fragment}%")).select(*cols)


def top_k_counts(df: DataFrame, key: str, n: int, count_alias: str = "n") -> DataFrame:
    """``GROUP BY key ORDER BY count DESC, key LIMIT n`` (a top-k report; the key
    breaks ties so the cut is deterministic)."""
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias(count_alias))
        .orderBy(F.col(count_alias).desc(), F.col(key).asc())
        .limit(n)
    )


def count_by(df: DataFrame, by: Sequence[str | Column], alias: str) -> DataFrame:
    """``SELECT by, COUNT(*) AS alias GROUP BY by ORDER BY by``."""
    names = [b if isinstance(b, str) else None for b in by]
    g = df.groupBy(*by).agg(F.count(F.lit(1)).alias(alias))
    order = [n for n in names if n] or g.columns[: len(by)]
    return g.orderBy(*order)


def count_and_distinct(df: DataFrame, by: Sequence[str], distinct_col: str, count_alias: str, distinct_alias: str) -> DataFrame:
    """``COUNT(*)`` and ``COUNT(DISTINCT c)`` per group."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias(count_alias),
        F.count_distinct(F.col(distinct_col)).alias(distinct_alias),
    )


def orphan_count(child: DataFrame, parent: DataFrame, keys: Sequence[str] | Mapping[str, str], alias: str) -> DataFrame:
    """``SELECT COUNT(*) FROM child WHERE NOT EXISTS (parent with same key)``.

    ``keys`` maps child column -> parent column (or lists shared names). Only the
    key columns of the parent are read; the anti-join is a single shuffle on the
    key (or a broadcast when AQE measures the parent's keys as small).
    """
    kmap = dict(keys) if isinstance(keys, Mapping) else {k: k for k in keys}
    # Distinct parent keys first: a partial aggregate collapses repeated (hot)
    # keys before the shuffle, and its hash partitioning is the join's own.
    p = parent.select(*[F.col(pk).alias(f"_p{i}") for i, pk in enumerate(kmap.values())]).distinct()
    cond = [F.col(ck) == F.col(f"_p{i}") for i, ck in enumerate(kmap)]
    return child.join(p, cond, "left_anti").agg(F.count(F.lit(1)).alias(alias))


def missing_dim_ids(fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str, n: int | None = 20) -> DataFrame:
    """Distinct fact keys absent from the dimension, ascending, first ``n``."""
    d = dim.select(F.col(dim_key).alias("_dk")).distinct()
    f = fact.select(fact_key).distinct()
    out = f.join(d, F.col(fact_key) == F.col("_dk"), "left_anti").orderBy(fact_key)
    return out.limit(n) if n else out


def null_rates(df: DataFrame, by: Sequence[str], cols: Mapping[str, str], total_alias: str = "total", scale: int = 1) -> DataFrame:
    """Per group: row count and ``round(100 * count(c) / count(*), scale)`` for
    each ``alias -> column``."""
    total = F.count(F.lit(1))
    aggs = [total.alias(total_alias)]
    aggs += [F.round(F.lit(100.0) * F.count(F.col(c)) / total, scale).alias(a) for a, c in cols.items()]
    return df.groupBy(*by).agg(*aggs).orderBy(*by)


def coverage(
    base: DataFrame,
    other: DataFrame,
    key: str,
    base_alias: str,
    other_alias: str,
    pct_alias: str,
    scale: int = 1,
) -> DataFrame:
    """Two per-key counts side by side (left join on the key) and
    ``round(100 * other / nullif(base, 0), scale)``."""
    b = base.groupBy(key).agg(F.count(F.lit(1)).alias(base_alias))
    o = other.groupBy(key).agg(F.count(F.lit(1)).alias(other_alias))
    j = b.join(o, key, "left")
    pct = F.round(F.lit(100.0) * F.col(other_alias) / F.nullif(F.col(base_alias), F.lit(0)), scale)
    return j.withColumn(pct_alias, pct).orderBy(key)


def fanout_check(
    parent: DataFrame,
    child: DataFrame,
    grandchild: DataFrame,
    parent_key: str | Sequence[str],
    child_parent_key: str | Sequence[str],
    child_key: str | Sequence[str],
    grandchild_child_key: str | Sequence[str],
    grandchild_count_col: str,
    group_cols: Sequence[str],
    distinct_alias: str,
    count_alias: str,
    child_unique: bool = False,
) -> DataFrame:
    """Per parent group: distinct children and non-NULL grandchild values reached
    through ``parent JOIN child LEFT JOIN grandchild``.

    Keys are columns or lists of columns. With ``child_unique=True`` (the child key is the child table's primary key)
    the distinct count is a plain count, which saves the two-level aggregation.

    The one-to-many fan-out is never materialised: children and grandchildren are
    counted per child key first, and the product of both counts, summed, is exactly
    ``COUNT(g.col)`` of the fanned-out join. Where the child key holds the parent key
    and the groups do too, a child key belongs to one group and is one row of it: both
    counts come from one aggregation over both tables, and no row is joined, sorted
    or held as distinct again.
    """
    up, down, own, of = ([k] if isinstance(k, str) else list(k) for k in (parent_key, child_parent_key, child_key, grandchild_child_key))
    # a key with a NULL part is no key: neither counts it
    if not child_unique and {*down} <= {*own} and {*up} <= {*group_cols}:
        keys = [f"_k{i}" for i in range(len(own))]
        rows = child.select(*[F.col(k).alias(n) for k, n in zip(own, keys)], F.lit(1).alias("_c"), F.lit(0).alias("_g")).unionByName(
            grandchild.select(*[F.col(k).alias(n) for k, n in zip(of, keys, strict=True)], F.lit(0).alias("_c"), F.col(grandchild_count_col).isNotNull().cast("int").alias("_g")))
        c = rows.groupBy(*keys).agg(F.sum("_c").alias("_cn"), F.sum("_g").alias("_gn")).where("_cn > 0")
        whole = functools.reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
        at = [keys[own.index(k)] for k in down]
        c = c.groupBy(*at).agg(F.count(F.when(whole, 1)).alias("_n"), F.sum(F.when(whole, F.col("_cn") * F.col("_gn"))).alias("_lines"))
        p = parent.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_pn"))
        pc = p.join(c, [F.col(k) == F.col(n) for k, n in zip(up, at, strict=True)], "inner")
        return pc.select(
            *group_cols, F.col("_n").alias(distinct_alias), F.coalesce(F.col("_lines") * F.col("_pn"), F.lit(0)).cast("bigint").alias(count_alias))
    g = grandchild.groupBy(*[F.col(k).alias(f"_gk{i}") for i, k in enumerate(of)]).agg(
        F.count(F.col(grandchild_count_col)).alias("_gn")
    )
    c = child.join(g, [F.col(k) == F.col(f"_gk{i}") for i, k in enumerate(own)], "left")
    pc = parent.join(c, [F.col(p) == F.col(k) for p, k in zip(up, down, strict=True)], "inner")
    whole = functools.reduce(Column.__and__, [F.col(k).isNotNull() for k in own])
    children = F.count(F.when(whole, 1)) if child_unique else F.count_distinct(*[F.col(k) for k in own])
    return pc.groupBy(*group_cols).agg(
        children.alias(distinct_alias),
        F.coalesce(F.sum("_gn"), F.lit(0)).cast("bigint").alias(count_alias),
    )


def summary_with_share(
    df: DataFrame,
    by: Sequence[str],
    means: Mapping[str, tuple[str, int]],
    count_alias: str = "n",
    share_alias: str = "usage_pct",
    share_scale: int = 1,
) -> DataFrame:
    """Per group: count, share of all rows (window over the aggregate) and
    rounded means ``alias -> (column, scale)``; ordered by count descending."""
    aggs = [F.count(F.lit(1)).alias(count_alias)]
    aggs += [F.round(F.avg(F.col(c)), s).alias(a) for a, (c, s) in means.items()]
    g = df.groupBy(*by).agg(*aggs)
    g = share_of_total(g, count_alias, share_alias, share_scale)
    return g.select(*by, count_alias, share_alias, *means.keys()).orderBy(F.col(count_alias).desc(), *by)


def duplicate_keys(df: DataFrame, pk: Sequence[str], count_alias: str = "n") -> DataFrame:
    """Keys that occur more than once (``GROUP BY pk HAVING COUNT(*) > 1``)."""
    return df.groupBy(*pk).agg(F.count(F.lit(1)).alias(count_alias)).filter(F.col(count_alias) > 1)


def constraint_violations(df: DataFrame, pk: Sequence[str], required: Sequence[str] = (), types: Mapping[str, str] | None = None) -> DataFrame:
    """The constraints of a table that its rows break: (kind, column_name, n), one row for
    each constraint, n = 0 where it holds.

    ``key``: keys that occur more than once. ``not_null``: rows without a key or
    required column. ``type``: values that are there but can't be read as the type that
    ``types`` declares. One pass: counts per key (combined before the shuffle), then
    one row of sums.
    """
    needed, declared = list(dict.fromkeys([*pk, *required])), dict(types or {})
    bad = {c: F.col(c).isNotNull() & F.trim(F.col(c).cast("string")).try_cast(t).isNull() for c, t in declared.items()}
    per = df.groupBy(*pk).agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(needed)],
        *[F.count_if(b).alias(f"_bad_{i}") for i, b in enumerate(bad.values())])
    key = functools.reduce(Column.__and__, [F.col(k).isNotNull() for k in pk])
    sums = per.agg(
        F.count_if((F.col("_n") > 1) & key).alias("_dup"), *[F.coalesce(F.sum(f"_null_{i}"), F.lit(0)).alias(f"_null_{i}") for i in range(len(needed))],
        *[F.coalesce(F.sum(f"_bad_{i}"), F.lit(0)).alias(f"_bad_{i}") for i in range(len(bad))])
    rows = [("key", ",".join(pk), "_dup"), *(("not_null", c, f"_null_{i}") for i, c in enumerate(needed)), *(("type", c, f"_bad_{i}") for i, c in enumerate(bad))]
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(c).alias("column_name"), F.col(n).cast("bigint").alias("n")) for k, c, n in rows]))
    return sums.select(each.alias("_c")).select("_c.*")


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Long form: one row per column with its NULL count and the row count.
    One aggregate pass, then an unpivot of the single result row."""
    aggs = [F.count(F.lit(1)).alias("_total")]
    aggs += [(F.count(F.lit(1)) - F.count(F.col(c))).alias(f"_n_{i}") for i, c in enumerate(cols)]
    one = df.agg(*aggs)
    stacked = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_n_{i}").alias("null_count")) for i, c in enumerate(cols)])
    ).alias("_s")
    return one.select(stacked, "_total").select("_s.column_name", "_s.null_count", F.col("_total").alias("total_rows"))


def rate_by(df: DataFrame, by: Sequence[str], condition: Column, n_alias: str, hits_alias: str, rate_alias: str, scale: int = 3) -> DataFrame:
    """Per group: rows, rows meeting ``condition`` and their rounded share."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias(n_alias),
        F.count_if(condition).alias(hits_alias),
        F.round(F.count_if(condition) / F.count(F.lit(1)), scale).alias(rate_alias),
    )
