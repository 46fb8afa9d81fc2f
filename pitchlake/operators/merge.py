"""Upsert by primary key with partial-column semantics.

``merge_frames`` is the pure DataFrame merge:

* matched keys: every column the source sends is replaced, a sent NULL included
  (a match marker decides, never ``coalesce``); columns the source does not send
  keep the stored value;
* new keys: inserted, with NULL for the columns not sent;
* a source with only key columns inserts new keys and leaves matched rows alone;
* source columns the target does not know are dropped; no shared column is an
  error; duplicate keys in the source are an error unless ``dedupe_by`` names an
  order to keep the last row per key.

It is one full outer join on the key: both sides are hash-partitioned on the key
once. ``upsert_table`` adds the storage side: an index of key ranges names the files
that can hold the batch's keys, only files that do are read and written anew, and the
result is published as one version (``sources.versions``).
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlake.functions.columns import MissingColumnsError, coerce_to_schema, send_columns
from pitchlake.operators.audit import duplicate_keys
from pitchlake.session import delete_path, path_missing, scratch_path
from pitchlake.sources import versions
from pitchlake.sources.versions import ACTION, CHANGED, UNIT


class DuplicateKeyError(ValueError):
    """The source holds a key more than once."""


class NullKeyError(ValueError):
    """The source holds rows without a key or a required column."""


def keep_last(df: DataFrame, pk: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the last in ``order`` (partial aggregation, skew-safe)."""
    rest = [c for c in df.columns if c not in pk]
    if not rest:
        return df.dropDuplicates(list(pk))
    order_c = [F.col(o) if isinstance(o, str) else o for o in order]
    picked = df.groupBy(*pk).agg(F.max_by(F.struct(*rest), F.struct(*order_c)).alias("_r"))
    return picked.select(*pk, *[F.col("_r").getField(c).alias(c) for c in rest])


def check_unique(df: DataFrame, pk: Sequence[str], sample: int = 5) -> None:
    """Raise with a few sample keys when ``pk`` is not unique (one aggregate job;
    at most ``sample`` rows reach the driver)."""
    dups = duplicate_keys(df, pk).limit(sample).collect()
    if dups:
        keys = ", ".join(str(tuple(r[k] for k in pk)) for r in dups)
        raise DuplicateKeyError(f"source has duplicate keys on {list(pk)}, e.g. {keys}")


def merge_frames(
    target: DataFrame,
    source: DataFrame,
    pk: Sequence[str],
    dedupe_by: Sequence[str | Column] | None = None,
    check_duplicates: bool = True,
    stamp_col: str | None = None,
    auto_cols: Sequence[str] = ("scraped_at",),
    unit_col: str | None = None,
    version: int | None = None,
) -> DataFrame:
    """Merged table (all target columns, target order) plus ``_action``:
    ``insert`` / ``update`` / ``keep``. With ``stamp_col``, inserted and updated rows
    get ``current_timestamp()`` there. With ``unit_col``, a column of the source,
    ``_unit`` names the unit that sent an inserted or updated row; with ``version``
    its ``_changed``, a column of the target then, becomes that number."""
    pk = list(pk)
    send = send_columns(source, target.schema, auto_cols)
    missing_pk = [k for k in pk if k not in send]
    if missing_pk:
        raise MissingColumnsError(f"source lacks key columns: {', '.join(missing_pk)}")
    src = coerce_to_schema(source.select(*send, *_unit(source, unit_col)), T.StructType([target.schema[c] for c in send]), strict=True)
    if dedupe_by is not None:
        src = keep_last(src, pk, dedupe_by)
    elif check_duplicates:
        check_unique(src, pk)

    upd = [c for c in send if c not in pk]
    own = [UNIT] if unit_col is not None else []
    s = src.select(*pk, *[F.col(c).alias(f"_s_{c}") for c in upd], *own, F.lit(True).alias("_m"))
    t = target.withColumn("_t", F.lit(True))
    j = t.join(s, pk, "full_outer")

    matched = F.col("_m").isNotNull() & F.col("_t").isNotNull()
    if upd:
        action = F.when(matched, "update").when(F.col("_m").isNotNull(), "insert").otherwise("keep")
    else:
        action = F.when(matched, "keep").when(F.col("_m").isNotNull(), "insert").otherwise("keep")
    touched = F.col("_m").isNotNull() & (F.lit(bool(upd)) | F.col("_t").isNull())

    exprs = []
    for f in target.schema.fields:
        c = f.name
        if c in pk:
            e = F.col(c)
        elif c in upd:
            e = F.when(F.col("_m").isNotNull(), F.col(f"_s_{c}")).otherwise(F.col(c))
        elif stamp_col is not None and c == stamp_col:
            e = F.when(touched, F.current_timestamp().cast(f.dataType)).otherwise(F.col(c))
        elif version is not None and c == CHANGED:
            e = F.when(touched, F.lit(version).cast(f.dataType)).otherwise(F.col(c))
        else:
            e = F.col(c)
        exprs.append(e.alias(c))
    units = [F.when(action != "keep", F.col(UNIT)).alias(UNIT)] if unit_col is not None else []
    return j.select(*exprs, action.alias(ACTION), *units)


def _unit(source: DataFrame, unit_col: str | None) -> list[Column]:
    return [F.col(unit_col).cast("string").alias(UNIT)] if unit_col is not None else []


def merge_counts(merged: DataFrame) -> DataFrame:
    """One row: inserted, updated, affected (= inserted + updated), total rows."""
    a = F.col(ACTION)
    return merged.agg(
        F.count_if(a == "insert").alias("n_inserted"),
        F.count_if(a == "update").alias("n_updated"),
        F.count_if(a != "keep").alias("n_affected"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> tuple[versions.Version | None, DataFrame | None, list[str]]:
    """The table's version; without one, what a plain Parquet folder holds there and its files."""
    base = versions.latest(spark, path)
    if base is not None:
        return base, None, []
    try:
        plain = spark.read.schema(schema).parquet(path)
        plain.take(1)  # the path check can be lazy
        return None, plain.select(*[f.name for f in schema.fields]), plain.inputFiles()
    except AnalysisException as e:
        if not path_missing(e):
            raise
        return None, None, []


def read_stored(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The current rows of a stored table: its latest version, else the plain Parquet
    folder that another writer left there (``PATH_NOT_FOUND`` if there is none)."""
    df = versions.read(spark, path, schema)
    if df is not None:
        return df
    return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)


def upsert_table(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    pk: Sequence[str],
    schema: T.StructType,
    partition_by: Sequence[str] = (),
    dedupe_by: Sequence[str | Column] | None = None,
    stamp_col: str | None = "scraped_at",
    cluster: bool = True,
    required: Sequence[str] = (),
    unit_col: str | None = None,
    attempts: int = 3,
    notes: dict | None = None,
    reverse: Sequence[str] = (),
    once: tuple[str, int] | None = None,
) -> dict:
    """Merge ``source`` into the stored table at ``path``; returns counts.

    The table is versioned (``sources.versions``; read it with ``read_stored``): only
    the files that hold one of the batch's keys are read, their rows and the new ones are
    written once, and one pointer file makes them the current version. A crash
    before that leaves the old version as it was. If another writer publishes first, the
    merge is done again on its version, up to ``attempts`` times, then ``ConflictError``.
    A key whose partition value changes moves, whatever the column's type. A plain
    Parquet folder becomes a versioned table with its first upsert.

    Empty source: nothing is written, all counts 0. A row with NULL in the key or
    in ``required`` is an error (``NullKeyError``), as a duplicate key is: it
    would be stored again at every load. A batch without a partition column is an
    error, and so is an empty text in one, which folder names can't tell from NULL.
    With ``unit_col`` (a column of the batch) the result has ``by_unit``: the counts of
    each of its values, taken from the rows that were written. ``notes`` are kept with
    the version; ``reverse`` names columns whose values are indexed by file. With
    ``once``, the name of a stream and the number of its batch, a batch that the table
    took already is not merged again; its counts come from the version that took it.
    """
    # The batch is read several times (checks, key search, merge): one copy in the shared
    # folder, so that an executor loss never makes two passes see different rows.
    stage = scratch_path(spark, "upsert-batch")
    void = [F.col(f"`{f.name}`").cast("string").alias(f.name) if isinstance(f.dataType, T.NullType) else F.col(f"`{f.name}`") for f in source.schema.fields]
    source.select(*void).write.parquet(stage)
    batch = spark.read.schema(source.select(*void).schema).parquet(stage)
    try:
        for left in reversed(range(attempts)):
            try:
                return _upsert(spark, path, batch, pk, schema, partition_by, dedupe_by, stamp_col, cluster, required, unit_col, notes, reverse, once)
            except versions.ConflictError:
                if not left:
                    raise
    finally:
        delete_path(spark, stage)


def _upsert(spark, path, source, pk, schema, partition_by, dedupe_by, stamp_col, cluster, required, unit_col, notes, reverse, once) -> dict:
    counts = {"n_inserted": 0, "n_updated": 0, "n_affected": 0, **({"by_unit": {}} if unit_col else {})}
    if source.isEmpty():
        return counts
    pk, parts = list(pk), list(partition_by)
    if absent := [c for c in parts if c not in source.columns]:
        raise MissingColumnsError(f"partition column(s) missing in the batch: {', '.join(absent)}")
    _check_rows(source, pk, schema, parts, required)
    base, plain, files = _stored(spark, path, schema)
    taken = base.notes.get("once", {}) if base is not None else {}
    if once and once[0] in taken and taken[once[0]]["batch"] >= once[1]:
        return taken[once[0]]["counts"]
    if base is not None:
        keys = coerce_to_schema(source.select(*pk), T.StructType([schema[k] for k in pk]), strict=True).distinct()
        files = versions.holding(spark, path, base, keys) if base.keys == tuple(pk) else versions.files_where(spark, path, base, F.lit(True))
        target = versions.read(spark, path, schema, base.number, files, hidden=True).drop(ACTION, UNIT)
    elif plain is not None:
        target = plain.withColumn(CHANGED, F.lit(0).cast("long"))
    else:
        target = spark.createDataFrame([], T.StructType([*schema.fields, T.StructField(CHANGED, T.LongType())]))
    number = (base.number if base else 0) + 1
    merged = merge_frames(target, source, pk, dedupe_by=dedupe_by, stamp_col=stamp_col, unit_col=unit_col, version=number)
    if cluster:
        # Range-partition on (partition columns, key): each task writes few table
        # partitions (no tasks x partitions small files on a backfill), a hot
        # partition still splits over tasks, and files hold narrow key ranges.
        merged = merged.repartitionByRange(*[F.col(c) for c in [*parts, *pk]]).sortWithinPartitions(*parts, *pk)
    added = versions.add(spark, path, merged, schema, parts, pk, reverse)
    for c in added.counts:
        for name, action in (("n_inserted", "insert"), ("n_updated", "update")):
            if c["action"] == action:
                counts[name] += c["n"]
                counts["n_affected"] += c["n"]
                if unit_col:
                    counts["by_unit"][c["unit"]] = counts["by_unit"].get(c["unit"], 0) + c["n"]
    notes = {**(notes or {}), **({"reverse": list(reverse)} if reverse else {})}
    if once:
        notes["once"] = {**taken, once[0]: {"batch": once[1], "counts": counts}}
    versions.commit(spark, path, base, added, schema, parts, pk, drop=files if base is not None else (), notes=notes)
    if base is None and files:
        for name in files:  # the plain files that the first version took over
            delete_path(spark, name, encoded=True)
    return counts


def _check_rows(source: DataFrame, pk: Sequence[str], schema: T.StructType, parts: Sequence[str], required: Sequence[str]) -> None:
    """One pass over the batch: NULL where a value is needed, and empty texts as partition values."""
    needed = [c for c in dict.fromkeys([*pk, *required]) if c in source.columns]
    bad = functools.reduce(Column.__or__, [F.col(c).try_cast(schema[c].dataType).isNull() for c in needed])
    empty = functools.reduce(Column.__or__, [F.coalesce(F.col(c).cast("string") == "", F.lit(False)) for c in parts if isinstance(schema[c].dataType, T.StringType)], F.lit(False))
    found = source.agg(F.coalesce(F.bool_or(bad), F.lit(False)).alias("null"), F.coalesce(F.bool_or(empty), F.lit(False)).alias("empty")).first()
    if found["null"]:
        raise NullKeyError(f"rows with NULL in one of: {', '.join(needed)}")
    if found["empty"]:
        raise ValueError(f"empty text in a partition column: {', '.join(parts)}")
