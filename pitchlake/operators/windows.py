"""Order-dependent operators: fill-down, previous value, first row per group,
group-minimum flag, pivot to wide, merge-then-fill, share of total.

Scale notes
-----------
A plain window ``partitionBy(key).orderBy(...)`` sends every row of one key to one
task. Where a key is naturally bounded (the pitches of one plate appearance, the
events of one half-inning) that is the cheapest plan and is used as is.

Where a key may be hot (a user, a source, a pitcher across seasons), pass
``segment=``: a coarse, order-monotone bucket expression (for example the day of
the timestamp). The scan then runs as a two-phase segmented scan:

1. one partial aggregate per ``(key, segment)`` yields the value carried out of
   each segment (map-side combined, tiny);
2. a window over that small per-segment table carries values across segments;
3. one carry row per ``(key, segment)`` is unioned in front of the segment's rows
   and the window runs per ``(key, segment)``, so a hot key spreads over many
   tasks while the rows are still shuffled only once.

Results are identical to the plain window; only the physical work is spread.

First-row and group-minimum operators use aggregates (``min_by`` / ``min``) with
partial aggregation instead of ``row_number`` windows, for the same reason.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_UNB = Window.unboundedPreceding
_CUR = Window.currentRow


def _cols(xs: Sequence[str | Column]) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def _join_back(df: DataFrame, small: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join ``small`` (keyed by ``keys``) onto ``df``, NULL-safe on the keys."""
    renamed = small.withColumnsRenamed({k: f"_jk{i}" for i, k in enumerate(keys)})
    cond = [F.col(k).eqNullSafe(F.col(f"_jk{i}")) for i, k in enumerate(keys)]
    joined = df.join(renamed, cond, "left")
    return joined.drop(*[f"_jk{i}" for i in range(len(keys))])


def _with_carry_rows(df: DataFrame, value: str, by: Sequence[str], seg: str, carry: DataFrame) -> DataFrame:
    """``df`` plus one carry row per (key, segment) holding the value carried in
    from earlier segments. ``_real`` is 0 for carry rows, so ordering by
    ``(_real, order...)`` puts the carry row first in its segment. A union, not
    a join: the rows are shuffled once, by the window itself."""
    real = df.withColumn("_real", F.lit(1))
    fill = [F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields if f.name not in (*by, seg, value)]
    c = carry.select(*by, seg, F.col("_carry").cast(df.schema[value].dataType).alias(value), *fill, F.lit(0).alias("_real"))
    return real.unionByName(c)


def fill_down(
    df: DataFrame,
    value: str,
    by: Sequence[str],
    order: Sequence[str | Column],
    out: str | None = None,
    default=None,
    segment: Column | None = None,
) -> DataFrame:
    """Last non-NULL ``value`` so far within ``by`` in ``order`` (LOCF); rows before
    the first value get ``default`` (NULL when not given)."""
    out = out or value
    order_c = _cols(order)
    dflt = [F.lit(default)] if default is not None else []
    if segment is None:
        w = Window.partitionBy(*by).orderBy(*order_c).rowsBetween(_UNB, _CUR)
        return df.withColumn(out, F.coalesce(F.last(F.col(value), ignorenulls=True).over(w), *dflt))

    seg = "_seg"
    d = df.withColumn(seg, segment)
    # Last non-NULL value of each segment (partial aggregate), then the last
    # non-NULL value of all earlier segments (a window over the small table).
    segs = d.groupBy(*by, seg).agg(
        F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.struct(*order_c))).alias("_seg_last")
    )
    w_seg = Window.partitionBy(*by).orderBy(seg).rowsBetween(_UNB, -1)
    carry = segs.select(*by, seg, F.last("_seg_last", ignorenulls=True).over(w_seg).alias("_carry"))
    u = _with_carry_rows(d, value, by, seg, carry)
    w_in = Window.partitionBy(*by, seg).orderBy(F.col("_real"), *order_c).rowsBetween(_UNB, _CUR)
    filled = F.coalesce(F.last(F.col(value), ignorenulls=True).over(w_in), *dflt)
    return u.withColumn(out, filled).filter(F.col("_real") == 1).drop(seg, "_real")


def lag_default(
    df: DataFrame,
    value: str,
    by: Sequence[str],
    order: Sequence[str | Column],
    out: str,
    default=0,
    segment: Column | None = None,
) -> DataFrame:
    """Previous row's ``value`` within ``by`` in ``order``; ``default`` where there is
    no previous row or its value is NULL (``coalesce(lag(x), 0)``)."""
    order_c = _cols(order)
    dflt = F.lit(default) if default is not None else F.lit(None)
    if segment is None:
        w = Window.partitionBy(*by).orderBy(*order_c)
        return df.withColumn(out, F.coalesce(F.lag(F.col(value), 1).over(w), dflt))

    seg = "_seg"
    d = df.withColumn(seg, segment)
    # Value of the last row of each segment, then of the previous segment.
    segs = d.groupBy(*by, seg).agg(F.max_by(F.col(value), F.struct(*order_c)).alias("_seg_last"))
    carry = segs.select(*by, seg, F.lag("_seg_last", 1).over(Window.partitionBy(*by).orderBy(seg)).alias("_carry"))
    u = _with_carry_rows(d, value, by, seg, carry)
    w_in = Window.partitionBy(*by, seg).orderBy(F.col("_real"), *order_c)
    prev = F.coalesce(F.lag(F.col(value), 1).over(w_in), dflt)
    return u.withColumn(out, prev).filter(F.col("_real") == 1).drop(seg, "_real")


def first_per_group(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str | Column],
    cols: Sequence[str] | None = None,
) -> DataFrame:
    """The first row of each group in ``order`` (``slice(1)`` after ``arrange``).

    An aggregate (``min_by``) with map-side partial aggregation, so a hot group is
    reduced before the shuffle. Include a unique tie-breaker in ``order``.
    """
    cols = [c for c in (cols or df.columns) if c not in by]
    picked = df.groupBy(*by).agg(F.min_by(F.struct(*cols), F.struct(*_cols(order))).alias("_first"))
    return picked.select(*by, *[F.col("_first").getField(c).alias(c) for c in cols])


def keep_on_group_min(
    df: DataFrame,
    value: str,
    by: Sequence[str],
    order_col: str,
    out: str | None = None,
) -> DataFrame:
    """``value`` where ``order_col`` equals its group minimum, else NULL
    (``ifelse(x == min(x), v, NA)`` by group). Aggregate + join back."""
    out = out or value
    mins = df.groupBy(*by).agg(F.min(order_col).alias("_gmin"))
    d = _join_back(df, mins, list(by))
    return d.withColumn(out, F.when(F.col(order_col) == F.col("_gmin"), F.col(value))).drop("_gmin")


def pivot_first(
    df: DataFrame,
    by: Sequence[str],
    pivot_col: str,
    values: Sequence,
    value: str,
    order: Sequence[str | Column] | None = None,
    name: str = "{}",
) -> DataFrame:
    """One row per group, one column per listed pivot value holding the first
    ``value`` in ``order`` (or ``first`` when unordered). The value list is
    explicit, so no discovery job runs; unlisted values are ignored."""
    # One conditional aggregate per listed value: a single aggregation keyed by
    # ``by`` (one exchange), where ``groupBy().pivot()`` would aggregate twice.
    aggs = []
    for v in values:
        hit = F.col(pivot_col) == F.lit(v)
        if order is None:
            agg = F.first(F.when(hit, F.col(value)), ignorenulls=True)
        else:
            agg = F.min_by(F.when(hit, F.col(value)), F.when(hit, F.struct(*_cols(order))))
        aggs.append(agg.alias(name.format(v)))
    return df.groupBy(*by).agg(*aggs)


def merge_then_fill(
    df: DataFrame,
    first: str,
    second: str,
    by: Sequence[str],
    order: Sequence[str | Column],
    out: str,
    segment: Column | None = None,
) -> DataFrame:
    """``coalesce(first, second)`` then fill down within ``by`` in ``order``."""
    merged = df.withColumn("_merged", F.coalesce(F.col(first), F.col(second)))
    filled = fill_down(merged, "_merged", by, order, out=out, segment=segment)
    return filled.drop("_merged") if out != "_merged" else filled


def share_of_total(df: DataFrame, count_col: str, out: str, scale: int = 1) -> DataFrame:
    """``round(100 * c / sum(c) over (), scale)``. Apply after an aggregate: the
    window has no partition key, so it runs in one task over the grouped rows."""
    total = F.sum(F.col(count_col)).over(Window.partitionBy())
    return df.withColumn(out, F.round(F.lit(100.0) * F.col(count_col) / total, scale))
