"""Readers for landed source files and table sinks.

Downloads are out of scope: sources arrive as files (one JSON document per game,
CSV / JSON exports for schedule, payload, players, season summaries). Every read
uses an explicit schema, so a field missing from a whole batch still yields a
typed NULL column instead of a missing column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlake.functions.columns import rename_if_absent, require_columns, stamp
from pitchlake.session import path_missing
from pitchlake.schemas import LEDGER, PLAYER, TABLES, TableSpec, boxscore_schema, game_feed_schema
from pitchlake.sources import versions


def identify_documents(df: DataFrame) -> DataFrame:
    """Rows of a JSON file source (batch or stream) with ``game_id`` from the
    document, else from the file name (``<game_id>.json``, ``<game_id>.json.gz``), and ``landed_at``
    (file time, then path), by which the newest copy of a game wins."""
    # the file name arrives URL-encoded
    name = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))
    return df.select(
        *[c for c in df.columns if c not in ("game_id", "landed_at")],
        F.coalesce(F.col("game_id"), F.nullif(F.regexp_replace(name, r"\.json(\.gz)?$", ""), F.lit(""))).alias("game_id"),
        F.struct(F.col("_metadata.file_modification_time").alias("at"), F.col("_metadata.file_path").alias("path")).alias("landed_at"),
    )


def read_game_feed(spark: SparkSession, path: str, multiline: bool = True, mode: str = "PERMISSIVE", frame: str | None = None) -> DataFrame:
    """One live-feed document per file (``multiLine``) or per line, identified as
    ``identify_documents`` says. ``mode="FAILFAST"`` raises on a malformed
    document instead of reading it as an empty game. With ``frame`` the fields that only
    other frames read are skipped, not made into rows: Spark doesn't prune nested JSON."""
    return identify_documents(
        spark.read.schema(game_feed_schema(frame)).option("multiLine", multiline).option("mode", mode).json(path))


def read_boxscore(spark: SparkSession, path: str, multiline: bool = True, mode: str = "PERMISSIVE") -> DataFrame:
    return identify_documents(
        spark.read.schema(boxscore_schema()).option("multiLine", multiline).option("mode", mode).json(path))


def read_landed(spark: SparkSession, path: str, fmt: str = "json", schema: T.StructType | None = None, **options) -> DataFrame:
    """Landed export (JSON lines, CSV with header, or Parquet)."""
    r = spark.read.options(**options)
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        r = r.option("header", True)
        if schema is None:
            r = r.option("inferSchema", True)
    return r.format(fmt).load(path)


def schedule_window(
    df: DataFrame,
    start,
    end,
    level: str | None = None,
    game_types: Sequence[str] | None = None,
    date_col: str = "date",
) -> DataFrame:
    """The schedule source's arguments as predicates (pushed to the scan)."""
    cond = F.col(date_col).between(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"))
    if level is not None and "level" in df.columns:
        cond = cond & (F.col("level") == level)
    if game_types:
        cond = cond & F.col("game_type").isin(list(game_types))
    return df.filter(cond)


def prepare_payload(df: DataFrame, pk: Sequence[str] = ("game_pk", "at_bat_number", "pitch_number")) -> DataFrame:
    """Pitch-payload export: the key may arrive as ``game_id``; require the key."""
    df = rename_if_absent(df, "game_id", "game_pk")
    return require_columns(df, pk, "pitch payload")


def prepare_player(df: DataFrame) -> DataFrame:
    """Player export: the key is required (a DataFrame has no row names to fall
    back on); levels arrive as a list and are stored joined by commas."""
    require_columns(df, PLAYER.pk, "player")
    if "levels" in df.columns and dict(df.dtypes)["levels"].startswith("array"):
        df = df.withColumn("levels", F.concat_ws(",", "levels"))
    return df


def season_summaries(reads: dict[str, DataFrame]) -> DataFrame:
    """One frame per position type (``{'hitting': df, 'pitching': df}``), stamped
    and unioned by name; columns one side lacks become NULL."""
    out = None
    for position, df in reads.items():
        s = stamp(df, position_type=position)
        out = s if out is None else out.unionByName(s, allowMissingColumns=True)
    if out is None:
        raise ValueError("no season summary frames given")
    return out


def csv_round_trip(df: DataFrame, path: str, infer: bool = False) -> DataFrame:
    """Export as CSV with a header, then load it back (explicit schema by default;
    ``infer=True`` detects types, which costs an extra pass over the files)."""
    # newlines, quotes, outer blanks and empty texts are data on both sides; NULL is \\N
    same = {"header": True, "quote": '"', "escape": '"', "nullValue": "\\N", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(**same).csv(path)
    r = df.sparkSession.read.options(**same, multiLine=True, maxCharsPerColumn=-1)
    r = r.option("inferSchema", True) if infer else r.schema(df.schema)
    return r.csv(path)


#: Types that text can be read as, narrowest first, with the form that a value must have.
_FORMS = (
    ("boolean", r"^(true|false)$"),
    ("bigint", r"^(0|-?[1-9][0-9]{0,18})$"),
    ("double", r"^[+-]?((0|[1-9][0-9]*)(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"),
    ("date", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"),
    ("timestamp_ntz", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?$"),
)


def detect_types(df: DataFrame, expected: T.StructType | None = None) -> tuple[T.StructType, list[dict]]:
    """The narrowest type of each text column that every value of it can be read as, and
    a report: (column, type, values, expected, drift).

    One aggregate over all columns: how many values are there, and how many each type
    can read without changing what they say (``007`` stays text, ``1`` is a number and
    not a flag). A whole number is also a double, a date also a timestamp; a column of
    both kinds takes the wider. Empty columns stay text. ``drift`` is True where the
    ``expected`` schema has the column under a type that can't hold it, or lacks it.
    """
    names, aggs = df.columns, []
    for i, c in enumerate(names):
        v = F.col(f"`{c}`").cast("string")
        aggs.append(F.count(v).alias(f"n{i}"))
        for t, form in _FORMS:
            text = F.lower(v) if t == "boolean" else v
            aggs.append(F.count_if(text.rlike(form) & text.try_cast(t).isNotNull()).alias(f"{t}{i}"))
    row = df.agg(*aggs).first()
    kinds = {f.name: f.dataType for f in expected.fields} if expected is not None else {}
    fields, report = [], []
    for i, c in enumerate(names):
        n, reads = row[f"n{i}"], {t: row[f"{t}{i}"] for t, _ in _FORMS}
        reads["double"] = max(reads["double"], reads["bigint"])
        fits = [t for t, _ in _FORMS if n and reads[t] == n]
        if not fits and n and reads["date"] + reads["timestamp_ntz"] == n:
            fits = ["timestamp_ntz"]
        found = T._parse_datatype_string(fits[0]) if fits else T.StringType()
        fields.append(T.StructField(c, found))
        drift = expected is not None and (c not in kinds or not _holds(kinds[c], found, n))
        report.append({"column": c, "type": found.simpleString(), "values": n, "expected": kinds[c].simpleString() if c in kinds else None, "drift": drift})
    report += [{"column": c, "type": None, "values": 0, "expected": t.simpleString(), "drift": True} for c, t in kinds.items() if c not in names]
    return T.StructType(fields), report


def _holds(want: T.DataType, found: T.DataType, values: int) -> bool:
    if not values or isinstance(want, T.StringType) or want == found:
        return True
    if isinstance(found, T.LongType):
        return isinstance(want, T.NumericType)
    if isinstance(found, T.DoubleType):
        return isinstance(want, (T.FractionalType,))
    return isinstance(found, (T.DateType, T.TimestampNTZType)) and isinstance(want, (T.TimestampType, T.TimestampNTZType))


def csv_detected(spark: SparkSession, path: str, expected: T.StructType | None = None) -> tuple[DataFrame, list[dict]]:
    """A CSV export with a header, its columns typed by what they hold (``detect_types``), and the report."""
    same = {"header": True, "quote": '"', "escape": '"', "nullValue": "\\N", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    text = spark.read.options(**same, multiLine=True, maxCharsPerColumn=-1, inferSchema=False).csv(path)
    schema, report = detect_types(text, expected)
    return text.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields]), report


def write_table(df: DataFrame, spec: TableSpec, path: str, mode: str = "overwrite") -> None:
    """Write a stored table with its layout: partitioned by the spec's partition
    columns, range-partitioned and sorted on (partition, sort keys) so files hold
    narrow key ranges (row-group statistics then prune like a clustered index)."""
    cols = [*spec.partition_by, *spec.sort_by]
    out = df
    if cols:
        out = out.repartitionByRange(*[F.col(c) for c in cols]).sortWithinPartitions(*cols)
    w = out.write.mode(mode)
    if spec.partition_by:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*spec.partition_by)
    w.parquet(path)


def read_table(spark: SparkSession, warehouse: str, name: str, missing_ok: bool = False) -> DataFrame:
    """A stored table read with its registry schema: its current version, else the
    plain Parquet folder there. With ``missing_ok`` a table that was never written
    reads as empty."""
    spec = TABLES[name]
    path = f"{warehouse.rstrip('/')}/{spec.name}"
    stored = versions.read(spark, path, spec.schema)
    if stored is not None:
        return stored
    if not missing_ok:
        return spark.read.schema(spec.schema).parquet(path)
    try:
        df = spark.read.schema(spec.schema).parquet(path)
        df.take(1)  # the path check can be lazy; this reads at most one row
        return df
    except AnalysisException as e:
        if not path_missing(e):
            raise
        return spark.createDataFrame([], spec.schema)


def ensure_tables(spark: SparkSession, warehouse: str, names: list[str] | None = None) -> list[str]:
    """Create every registered table that does not exist yet as an empty versioned
    table with its schema and partitioning (idempotent; existing data is never
    touched). The ledger, which is appended to, is a plain Parquet folder. Returns the
    names created."""
    created = []
    for name in names or list(TABLES):
        spec = TABLES[name]
        path = f"{warehouse.rstrip('/')}/{spec.name}"
        try:
            read_table(spark, warehouse, name).limit(0).collect()
            continue
        except AnalysisException as e:
            if not path_missing(e):
                raise
        if spec is LEDGER:
            spark.createDataFrame([], spec.schema).write.mode("errorifexists").parquet(path)
        else:
            versions.commit(spark, path, None, None, spec.schema, spec.partition_by, spec.pk)
        created.append(name)
    return created


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Expose a view function's result to SQL (drop-and-recreate semantics)."""
    df.createOrReplaceTempView(name)
    return df
