"""Row numbers within groups, where one group may hold most of the rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import partitions, stage


def _starts(column: pa.Array, before: pa.Scalar | None) -> np.ndarray:
    """True where a value differs from the one before it (nulls are equal)."""
    out = np.ones(len(column), bool)
    if len(column) > 1:
        a, b = column[1:], column[:-1]
        differ = pc.fill_null(pc.not_equal(a, b), False)
        out[1:] = pc.or_(differ, pc.xor(a.is_null(), b.is_null())).to_numpy(zero_copy_only=False)
    if before is not None and len(column):
        out[0] = not before.equals(column[0])
    return out


def numbered(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``df`` and ``pos``: the row's number (from 0) within ``group``, ordered by ``order``, nulls first.

    Rows are dealt by ranges of (group, order, a running number), so a hot group,
    or a hot row, spreads over tasks; a task counts its own rows, and what
    earlier tasks hold of its first group is added from a table of one row per
    partition (hence broadcast). Rows that are equal in ``order`` come in any order.
    """
    spark = df.sparkSession
    keys, width = [group, *order, "__tie"], len(df.columns)
    base = stage(df, f"{name}-rows").withColumn("__tie", F.monotonically_increasing_id())
    ranged = base.repartitionByRange(partitions(spark), *keys).sortWithinPartitions(*keys)
    schema = T.StructType([*df.schema.fields, *(T.StructField(n, T.LongType()) for n in ("__part", "__run", "__at"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, number, at = TaskContext.get().partitionId(), None, -1, -1
        for b in batches:
            if not b.num_rows:
                continue
            starts = _starts(b.column(group), before)
            rows = np.arange(b.num_rows)
            last = np.maximum.accumulate(np.where(starts, rows, -1))
            places = np.where(last < 0, at + 1 + rows, rows - last)
            numbers = number + np.cumsum(starts)
            before, number, at = b.column(group)[-1], int(numbers[-1]), int(places[-1])
            own = [np.full(b.num_rows, part), numbers, places]
            yield pa.RecordBatch.from_arrays([*b.columns[:width], *(pa.array(x.astype(np.int64)) for x in own)], names=schema.names)

    rows = stage(ranged.mapInArrow(run, schema), f"{name}-numbered")
    ends = rows.groupBy("__part").agg(
        F.min_by(group, "__run").alias("first"), F.max_by(group, "__run").alias("last"), F.max(F.struct("__run", "__at"))["__at"].alias("at"))
    both = ends.select(F.col("last").alias("g"), "__part", (F.col("at") + 1).alias("n"), F.lit(False).alias("first")).unionByName(
        ends.select(F.col("first").alias("g"), "__part", F.lit(0).cast("long").alias("n"), F.lit(True).alias("first")))
    before = F.sum("n").over(Window.partitionBy("g").orderBy("__part").rangeBetween(Window.unboundedPreceding, -1))
    carried = both.withColumn("__carry", before).where("first and __carry > 0").select("__part", "__carry")
    pos = F.col("__at") + F.when(F.col("__run") == 0, F.coalesce("__carry", F.lit(0))).otherwise(0)
    return rows.join(F.broadcast(carried), "__part", "left").select(*df.columns, pos.alias("pos"))
