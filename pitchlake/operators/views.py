"""The analytical view over a JSON payload, and its materialisation.

``unpack_view`` = keep the stored key columns, parse the payload once with only
the requested keys, cast each to its declared type, and (optionally) left-join a
dimension on one of the unpacked fields to add a name. A payload stored as
VARIANT (``functions.payload.to_variant``) is read key by key from its binary
form instead of being parsed.

* Pass ``cols=`` to read only some payload keys: the parse schema shrinks with it
  (Spark does not prune a ``from_json`` schema through an outer projection).
* ``with_names=False`` drops the dimension join; Spark keeps an unused LEFT join
  because it cannot know the dimension key is unique.
* A filter on the joined name turns the LEFT join into an inner one and lets the
  (small, filtered) dimension be broadcast; nothing special is needed for that.

``materialize`` writes the view as a versioned table partitioned like its source, in
whole or only some partitions; ``refresh`` brings it up to its stored tables by the rows
that changed there: a failed write leaves the previous version in place.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.functions.payload import is_variant, payload_struct, typed_field, variant_field
from pitchlake.operators.merge import upsert_table
from pitchlake.schemas import PAYLOAD_KEY_COLUMNS, PAYLOAD_NAME_AFTER, payload_spec
from pitchlake.sources import versions
from pitchlake.sources.versions import ACTION, CHANGED, UNIT


def unpack_view(
    df: DataFrame,
    json_col: str,
    spec: Sequence[tuple[str, str]],
    keep: Sequence[str],
    dim: DataFrame | None = None,
    dim_key: str | None = None,
    dim_cols: Mapping[str, str] | None = None,
    join_field: str | None = None,
    name_after: str | None = None,
    strict: bool = False,
) -> DataFrame:
    """Typed view of a JSON payload, optionally with names from a dimension.

    ``dim_cols`` maps output alias -> dimension column. The dimension join key is
    the unpacked ``join_field`` cast to the dimension key's type. The name columns
    are placed after ``name_after`` (or at the end).
    """
    if is_variant(df, json_col):
        v = F.col(json_col)
        typed = df.select(*keep, *[variant_field(v, k, t, strict).alias(k) for k, t in spec])
    else:
        p = "_payload"
        parsed = df.select(*keep, payload_struct(F.col(json_col), [k for k, _ in spec]).alias(p))
        typed = parsed.select(*keep, *[typed_field(F.col(p), k, t, strict).alias(k) for k, t in spec])
    order = [*keep, *[k for k, _ in spec]]
    if dim is None or not dim_cols:
        return typed
    dkey_type = dim.schema[dim_key].dataType
    d = dim.select(F.col(dim_key).alias("_dim_key"), *[F.col(c).alias(a) for a, c in dim_cols.items()])
    joined = typed.join(d, F.col(join_field).cast(dkey_type) == F.col("_dim_key"), "left").drop("_dim_key")
    names = list(dim_cols)
    if name_after and name_after in order:
        i = order.index(name_after) + 1
        order = order[:i] + names + order[i:]
    else:
        order = order + names
    return joined.select(*order)


def statcast_view(
    statcast: DataFrame,
    player: DataFrame | None = None,
    profile: str = "full",
    cols: Sequence[str] | None = None,
    with_names: bool = True,
    strict: bool = False,
) -> DataFrame:
    """The pitch-payload view: 5 stored columns + pitcher name + typed payload
    keys (107 in the full profile, 72 in the core one)."""
    spec = payload_spec(profile)
    if cols is not None:
        wanted = set(cols)
        spec = [(k, t) for k, t in spec if k in wanted or k == "pitcher_id"]
    keep = [c for c in PAYLOAD_KEY_COLUMNS if c in statcast.columns]
    return unpack_view(
        statcast,
        "data",
        spec,
        keep,
        dim=player if with_names else None,
        dim_key="player_id",
        dim_cols={"pitcher_name": "name_full"},
        join_field="pitcher_id",
        name_after=PAYLOAD_NAME_AFTER,
        strict=strict,
    )


def materialize(
    spark: SparkSession,
    view: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("year",),
    sort_within: Sequence[str] = (),
    only_partitions: Sequence | None = None,
    keys: Sequence[str] = (),
    reverse: Sequence[str] = (),
    notes: dict | None = None,
) -> str:
    """Write ``view`` to ``path`` as a new version of the table there (read it with ``read_stored``).

    The rows are written once and taken over by one pointer file, so a failed write
    changes nothing and partitions that the view no longer has are gone. With
    ``only_partitions`` (values of the first partition column, None for NULL) only those
    are recomputed; all other files stay as they are. ``keys`` and ``reverse`` are
    indexed by file, for ``refresh``; ``notes`` are kept with the version.
    """
    parts = list(partition_by)
    base = versions.latest(spark, path)
    some = only_partitions is not None and bool(parts) and base is not None
    v = view
    if some:
        known = [x for x in only_partitions if x is not None]
        named = F.coalesce(F.col(parts[0]).isin(known), F.lit(False)) if known else F.lit(False)
        named = named | F.col(parts[0]).isNull() if None in only_partitions else named
        v = v.filter(named)
    if sort_within:
        # Range-partition on (partition columns, sort keys): each task writes few
        # table partitions, and a hot partition value is still split over tasks.
        v = v.repartitionByRange(*[F.col(c) for c in [*parts, *sort_within]])
        v = v.sortWithinPartitions(*parts, *sort_within)
    number = (base.number if base else 0) + 1
    added = versions.add(spark, path, v.withColumn(CHANGED, F.lit(number).cast("long")), view.schema, parts, keys, reverse)
    drop = versions.files_where(spark, path, base, named) if some else None
    versions.commit(spark, path, base, added, view.schema, parts, keys, drop, {**(notes or {}), **({"reverse": list(reverse)} if reverse else {})})
    return path


def refresh(
    spark: SparkSession,
    path: str,
    source_path: str,
    dim_path: str,
    build: Callable[[DataFrame, DataFrame], DataFrame],
    keys: Sequence[str],
    dim_key: str,
    join_field: str,
    names: Mapping[str, str],
    partition_by: Sequence[str] = ("year",),
    sort_within: Sequence[str] = (),
    kind: str = "",
) -> dict:
    """Bring the materialised view at ``path`` up to its stored source and dimension tables.

    ``build(source, dim)`` makes the view from rows of both. The view's version notes which
    versions of the two it shows. Rows that the source inserted or updated since then are
    built and merged by ``keys``; of dimension rows changed since then, the view's reverse
    index on ``join_field`` names the files that show them, and rows whose ``names`` (view
    column -> dimension column) differ get those columns alone. Nothing else is read or
    written. A view that is not there yet, or without such notes, or of another ``kind`` (say,
    another column profile), is built in whole.
    Returns what was done: ``mode`` and the counts of rows.
    """
    source, dim, view = (versions.latest(spark, p) for p in (source_path, dim_path, path))
    if source is None:
        raise FileNotFoundError(f"no stored table at {source_path}")
    dim_rows = versions.read(spark, dim_path, version=dim.number) if dim else None
    now = {"source": source.number, "dim": dim.number if dim else 0, "kind": kind}
    seen = view.notes.get("shows") if view else None
    if seen is None or seen["kind"] != kind or seen["source"] > now["source"] or seen["dim"] > now["dim"]:
        rows = build(versions.read(spark, source_path, version=source.number), dim_rows)
        materialize(spark, rows, path, partition_by, sort_within, keys=keys, reverse=[join_field], notes={"shows": now})
        return {"mode": "full", "n_rows": versions.read(spark, path).count()}
    done = {"mode": "changes", "n_source": 0, "n_names": 0}
    merge = dict(pk=keys, schema=view.schema, partition_by=partition_by, stamp_col=None, reverse=[join_field])
    if now["source"] > seen["source"]:
        changed = versions.changes(spark, source_path, seen["source"], source).drop(ACTION, UNIT, CHANGED)
        seen = {**seen, "source": now["source"]}
        done["n_source"] = upsert_table(spark, path, build(changed, dim_rows), notes={"shows": seen}, **merge)["n_affected"]
    if now["dim"] > seen["dim"]:
        changed = versions.changes(spark, dim_path, seen["dim"], dim).select(
            F.col(dim_key).cast(view.schema[join_field].dataType).alias(join_field), *[F.col(d).alias(f"_new_{v}") for v, d in names.items()])
        view = versions.latest(spark, path)
        files = versions.files_with(spark, path, view, join_field, changed.select(join_field))
        rows = versions.read(spark, path, version=view.number, files=files).join(changed, join_field)
        differs = functools.reduce(Column.__or__, [~F.col(v).eqNullSafe(F.col(f"_new_{v}")) for v in names])
        columns = [F.col(c) for c in dict.fromkeys([*keys, *partition_by])]
        renamed = rows.where(differs).select(*columns, *[F.col(f"_new_{v}").alias(v) for v in names])
        done["n_names"] = upsert_table(spark, path, renamed, **merge)["n_affected"]
        view = versions.latest(spark, path)
        versions.commit(spark, path, view, None, view.schema, view.partition_by, view.keys, notes={"shows": {**seen, "dim": now["dim"]}})
    elif now["source"] > view.notes["shows"]["source"] and not done["n_source"]:
        view = versions.latest(spark, path)
        versions.commit(spark, path, view, None, view.schema, view.partition_by, view.keys, notes={"shows": seen})
    return done
