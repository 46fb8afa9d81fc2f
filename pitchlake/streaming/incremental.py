"""Incremental loads with Structured Streaming.

The daily run becomes a file-source stream over the landing folder, processed
with ``trigger(availableNow=True)``: every file not yet seen (tracked by the
stream's checkpoint) is read once, in bounded micro-batches, and the query stops.
Each micro-batch is merged into the stored tables with ``upsert_table``.

Each table's version notes the last batch of the stream that it took, so a batch that runs
again after a failure changes neither rows nor counts where it had arrived; late
corrections to a game simply arrive as a newer file and overwrite by key, as the batch
job would.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from pitchlake.operators.merge import upsert_table
from pitchlake.operators.nested import flatten_games
from pitchlake.schemas import EVENT, PITCH, PLAY, TableSpec, game_feed_schema
from pitchlake.sources.landed import identify_documents


def stream_upsert(
    spark: SparkSession,
    source_dir: str,
    source_schema: T.StructType,
    table_path: str,
    table: TableSpec,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    fmt: str = "json",
    checkpoint: str | None = None,
    max_files_per_trigger: int | None = None,
    options: dict | None = None,
) -> dict:
    """Merge every new landed file into one table; returns summed counts."""
    totals = {"n_inserted": 0, "n_updated": 0, "n_affected": 0, "batches": 0}
    checkpoint = checkpoint or checkpoint_of(table_path)

    def batch(df: DataFrame, epoch_id: int) -> None:
        src = transform(df) if transform else df
        c = upsert_table(
            spark, table_path, src, table.pk, table.schema, table.partition_by, required=table.required, once=(checkpoint, epoch_id))
        for k in ("n_inserted", "n_updated", "n_affected"):
            totals[k] += c[k]
        totals["batches"] += 1

    _run(spark, source_dir, source_schema, fmt, batch, checkpoint, max_files_per_trigger, options)
    return totals


def stream_games(
    spark: SparkSession,
    feed_dir: str,
    tables_dir: str,
    lineup: DataFrame | None = None,
    schedule: DataFrame | None = None,
    checkpoint: str | None = None,
    max_files_per_trigger: int | None = None,
) -> dict:
    """Flatten new game documents and merge event, pitch and play rows into
    ``<tables_dir>/<table>``. Returns counts per table."""
    totals = {name: {"n_inserted": 0, "n_updated": 0, "n_affected": 0} for name in ("event", "pitch", "play")}
    checkpoint = checkpoint or checkpoint_of(f"{tables_dir.rstrip('/')}/games")
    specs: dict[str, TableSpec] = {"event": EVENT, "pitch": PITCH, "play": PLAY}

    def batch(df: DataFrame, epoch_id: int) -> None:
        out = flatten_games(df, lineup=lineup, schedule=schedule, cut_lineage=True)
        for name, frame in out.items():
            spec = specs[name]
            c = upsert_table(
                spark, f"{tables_dir.rstrip('/')}/{spec.name}", frame, spec.pk, spec.schema, spec.partition_by, required=spec.required,
                once=(checkpoint, epoch_id))
            for k in totals[name]:
                totals[name][k] += c[k]

    _run(spark, feed_dir, game_feed_schema(), "json", batch, checkpoint, max_files_per_trigger, {"multiLine": "true"}, identify_documents)
    return totals


def checkpoint_of(path: str) -> str:
    """The stream's own folder beside the table: a second run goes on where the first one ended."""
    folder, _, name = path.rstrip("/").rpartition("/")
    return f"{folder}/_checkpoint_{name}"


def _run(spark, source_dir, schema, fmt, batch, checkpoint, max_files, options: dict | None = None, prepare=None) -> None:
    reader = spark.readStream.schema(schema).format(fmt)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.load(source_dir)
    if prepare:
        stream = prepare(stream)
    q = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))

