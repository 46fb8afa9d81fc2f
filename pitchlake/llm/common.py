"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.session import scratch_path

#: Rows of an Arrow batch that become Python objects at a time.
SLICE_ROWS = 256


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage with a table that every executor sees, so a lost executor
    never makes a later step recompute (or disagree with) an earlier one.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    """The session's shuffle partition count."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(column: str) -> Column:
    """The text, with null as the empty string."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow batches in small slices: Python objects exist for one slice at a time."""
    for batch in batches:
        for i in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(i, SLICE_ROWS)


def as_batch(columns: dict[str, tuple[list, pa.DataType]]) -> pa.RecordBatch:
    """A record batch from named lists and their types."""
    return pa.RecordBatch.from_arrays(
        [pa.array(v, t) for v, t in columns.values()], names=list(columns)
    )
