"""Stored tables whose every change is one new version, taken over by one pointer file.

Layout of a table at ``path`` (all below ``_commits``, which plain readers skip):

* ``_commit=<id>/<partition folders>/part-*.parquet``: the rows that one write added, written
  once and by Spark alone, so partition values of any type are escaped and read back by Spark;
* ``_index/<id>``: for each file of a commit its rows, its lowest and highest key and its newest row;
* ``_reverse/<id>``: which values of chosen columns a file holds;
* ``<number>.json``: a version: its commits, the files of them that it no longer counts,
  the schema. The highest number is the current version.

A write becomes visible when its version file is renamed into place, which fails if
another writer was first (``ConflictError``). Until then, and after a crash at any step, the
previous version is what readers see. The previous version's files stay until the next
change, so that a query that began on it can end; what no version counts is deleted by its
recorded name, never by a name that is made from data.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FOLDER, COMMIT = "_commits", "_commit"
#: Hidden columns of the data files: what the merge did to a row when its file was written,
#: the unit that sent it then, and the version in which it was last inserted or updated.
ACTION, UNIT, CHANGED = "_action", "_unit", "_changed"
HIDDEN = (T.StructField(ACTION, T.StringType()), T.StructField(UNIT, T.StringType()), T.StructField(CHANGED, T.LongType()))


class ConflictError(RuntimeError):
    """Another writer published a version first."""


@dataclass(frozen=True)
class Version:
    """``commits`` maps a commit to the files of it that no longer count."""

    number: int
    schema: T.StructType
    partition_by: tuple[str, ...] = ()
    keys: tuple[str, ...] = ()
    commits: dict[str, list[str]] = field(default_factory=dict)
    notes: dict = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps({
            "number": self.number, "schema": self.schema.jsonValue(), "partition_by": self.partition_by, "keys": self.keys,
            "commits": self.commits, "notes": self.notes})

    @staticmethod
    def from_json(text: str) -> Version:
        d = json.loads(text)
        return Version(d["number"], T.StructType.fromJson(d["schema"]), tuple(d["partition_by"]), tuple(d["keys"]), d["commits"], d["notes"])


# --- files, through Spark's file systems ------------------------------------

def _folder(path: str) -> str:
    return f"{path.rstrip('/')}/{FOLDER}"


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, path: str) -> list[int]:
    _, folder, fs = _hadoop(spark, _folder(path))
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _load(spark: SparkSession, path: str, number: int) -> Version:
    jvm, file, fs = _hadoop(spark, f"{_folder(path)}/{number:010d}.json")
    stream = fs.open(file)
    try:
        return Version.from_json(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def latest(spark: SparkSession, path: str) -> Version | None:
    """The current version, or None for a folder without any."""
    numbers = _numbers(spark, path)
    return _load(spark, path, numbers[-1]) if numbers else None


def publish(spark: SparkSession, path: str, version: Version) -> None:
    """Make ``version`` the current one: written aside, then renamed onto a name that must be free."""
    jvm, folder, fs = _hadoop(spark, _folder(path))
    fs.mkdirs(folder)
    draft = jvm.org.apache.hadoop.fs.Path(folder, f".draft-{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    out.write(bytearray(version.to_json().encode()))
    out.close()
    target = jvm.org.apache.hadoop.fs.Path(folder, f"{version.number:010d}.json")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(folder).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    renames = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(target), renames)
    except Py4JJavaError as e:
        fs.delete(draft, False)
        if e.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            raise ConflictError(f"version {version.number} of {path} was published by another writer") from e
        raise


def _delete(spark: SparkSession, path: str, name: str, recursive: bool) -> bool:
    """Delete a file or commit by its recorded name below ``_commits``; True if it was there."""
    jvm, folder, fs = _hadoop(spark, _folder(path))
    target = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f"{fs.makeQualified(folder).toUri().toString()}/{name}"))
    return fs.delete(target, recursive)


# --- reading ----------------------------------------------------------------

def file_name() -> Column:
    """A row's file: its name below ``_commits``."""
    return F.substring_index(F.col("_metadata.file_path"), f"/{FOLDER}/", -1)


def _scan(spark: SparkSession, path: str, schema: T.StructType, commits: Sequence[str]) -> DataFrame:
    roots = [f"{_folder(path)}/{COMMIT}={c}" for c in commits]
    return spark.read.schema(schema).option("basePath", _folder(path)).parquet(*roots)


def read(
    spark: SparkSession, path: str, schema: T.StructType | None = None, version: int | None = None,
    files: Sequence[str] | None = None, hidden: bool = False,
) -> DataFrame | None:
    """The rows of a version (the current one by default); None if the folder has none.

    One scan over the version's commits: filters on partition columns prune folders, and
    ``files`` (names as ``file_name`` gives them) prunes all other files before they are
    opened. Columns that older files lack read as NULL. With ``hidden`` also the hidden
    columns.
    """
    v = latest(spark, path) if version is None else _load(spark, path, version)
    if v is None:
        return None
    schema = schema or v.schema
    wanted = T.StructType([*schema.fields, *HIDDEN]) if hidden else schema
    if not v.commits or (files is not None and not files):
        return spark.createDataFrame([], wanted)
    df = _scan(spark, path, wanted, list(v.commits))
    dead = [f for fs in v.commits.values() for f in fs]
    if dead:
        df = df.where(~file_name().isin(dead))
    if files is not None:
        df = df.where(file_name().isin(list(files)))
    return df.select(*[f.name for f in wanted.fields])


def index_of(spark: SparkSession, path: str, version: Version) -> DataFrame:
    """(file, unit, action, n, changed, lo, hi) of the files that ``version`` counts: a row for
    each unit and action of a file; changed is the newest version among its rows, lo and
    hi are structs of the key columns."""
    keys = T.StructType([version.schema[k] for k in version.keys])
    schema = T.StructType([
        T.StructField("file", T.StringType()), T.StructField("unit", T.StringType()), T.StructField("action", T.StringType()),
        T.StructField("n", T.LongType()), T.StructField("changed", T.LongType()), *(T.StructField(c, keys) for c in ("lo", "hi") if keys.fields)])
    if not version.commits:
        return spark.createDataFrame([], schema)
    df = spark.read.schema(schema).parquet(*[f"{_folder(path)}/_index/{c}" for c in version.commits])
    dead = [f for fs in version.commits.values() for f in fs]
    return df.where(~F.col("file").isin(dead)) if dead else df


def key_ranges(keys: DataFrame, pk: Sequence[str], pieces: int = 1024) -> DataFrame:
    """(lo, hi): the sorted keys in about ``pieces`` runs. Few keys are runs of their own."""
    size = max(1, -(-keys.count() // pieces))
    key = F.struct(*pk)
    placed = keys.repartitionByRange(*pk).sortWithinPartitions(*pk).select(key.alias("k"), F.monotonically_increasing_id().alias("m"))
    run = F.floor(F.col("m").bitwiseAND(F.lit((1 << 33) - 1)) / size)
    return placed.groupBy(F.shiftright("m", 33).alias("part"), run.alias("run")).agg(F.min("k").alias("from"), F.max("k").alias("to")).select("from", "to")


def candidates(spark: SparkSession, path: str, version: Version, keys: DataFrame) -> list[str]:
    """Files whose key range meets a run of ``keys``; no data file is opened.

    The runs are at most about 1,024 and one per shuffle partition (hence broadcast); the
    names reach the driver, whose file index holds them anyway.
    """
    ranges = F.broadcast(key_ranges(keys, version.keys))
    meets = (F.col("lo") <= F.col("to")) & (F.col("hi") >= F.col("from"))
    return [r.file for r in index_of(spark, path, version).join(ranges, meets, "left_semi").select("file").distinct().collect()]


def holding(spark: SparkSession, path: str, version: Version, keys: DataFrame) -> list[str]:
    """Files that hold one of ``keys`` (distinct, columns ``version.keys``): only the key
    columns of candidate files are read."""
    near = candidates(spark, path, version, keys)
    if not near:
        return []
    df = _scan(spark, path, version.schema, list(version.commits)).where(file_name().isin(near)).select(*version.keys, file_name().alias("__file"))
    return [r["__file"] for r in df.join(keys, list(version.keys), "left_semi").select("__file").distinct().collect()]


def files_with(spark: SparkSession, path: str, version: Version, column: str, values: DataFrame) -> list[str]:
    """Files that hold one of ``values`` (one column) in ``column``, by the reverse index."""
    if not version.commits:
        return []
    schema = T.StructType([T.StructField("file", T.StringType()), T.StructField("value", version.schema[column].dataType)])
    held = spark.read.schema(schema).parquet(*[f"{_folder(path)}/_reverse/{c}/{column}" for c in version.commits])
    dead = [f for fs in version.commits.values() for f in fs]
    held = held.where(~F.col("file").isin(dead)) if dead else held
    return [r.file for r in held.join(values.toDF("value"), "value", "left_semi").select("file").distinct().collect()]


def changes(spark: SparkSession, path: str, since: int, version: Version | None = None) -> DataFrame:
    """The rows of ``version`` (the current one) that were inserted or updated after version
    ``since``, with the hidden columns. Files without such rows are not opened."""
    v = version or latest(spark, path)
    files = [r.file for r in index_of(spark, path, v).where(F.col("changed") > since).select("file").distinct().collect()]
    return read(spark, path, None, v.number, files, hidden=True).where(F.col(CHANGED) > since)


def files_where(spark: SparkSession, path: str, version: Version, condition: Column) -> list[str]:
    """Files with a row for which ``condition`` holds (a condition on partition columns reads no data)."""
    if not version.commits:
        return []
    df = _scan(spark, path, version.schema, list(version.commits))
    dead = [f for fs in version.commits.values() for f in fs]
    df = df.where(~file_name().isin(dead)) if dead else df
    return [r["__file"] for r in df.where(condition).select(file_name().alias("__file")).distinct().collect()]


# --- writing ----------------------------------------------------------------

@dataclass(frozen=True)
class Added:
    """A written commit that no version counts yet."""

    commit: str
    counts: list[dict]  # unit, action, n

    @property
    def rows(self) -> int:
        return sum(c["n"] for c in self.counts)


def add(
    spark: SparkSession, path: str, rows: DataFrame, schema: T.StructType, partition_by: Sequence[str], keys: Sequence[str],
    reverse: Sequence[str] = (),
) -> Added:
    """Write ``rows`` once, as a commit that nobody sees yet, and index its files by key and by the columns ``reverse``."""
    commit = f"v{uuid.uuid4().hex}"
    write = rows.write
    if partition_by:
        write = write.partitionBy(*partition_by)
    write.parquet(f"{_folder(path)}/{COMMIT}={commit}")
    wanted = T.StructType([*schema.fields, *HIDDEN])
    ends = [F.min(F.struct(*keys)).alias("lo"), F.max(F.struct(*keys)).alias("hi")] if keys else []
    written = _scan(spark, path, wanted, [commit])
    index = written.groupBy(file_name().alias("file"), F.col(UNIT).alias("unit"), F.col(ACTION).alias("action")).agg(
        F.count("*").alias("n"), F.max(CHANGED).alias("changed"), *ends)
    at = f"{_folder(path)}/_index/{commit}"
    index.write.parquet(at)
    for column in reverse:
        written.select(file_name().alias("file"), F.col(column).alias("value")).distinct().write.parquet(f"{_folder(path)}/_reverse/{commit}/{column}")
    counts = spark.read.schema("unit string, action string, n long").parquet(at).groupBy("unit", "action").agg(F.sum("n").alias("n"))
    return Added(commit, [r.asDict() for r in counts.collect()])


def commit(
    spark: SparkSession, path: str, base: Version | None, added: Added | None, schema: T.StructType, partition_by: Sequence[str], keys: Sequence[str],
    drop: Sequence[str] | None = (), notes: dict | None = None,
) -> Version:
    """Publish the version after ``base``: its files without ``drop`` (None: without any of them), and those of ``added``."""
    commits: dict[str, list[str]] = {}
    if base is not None and drop is not None:
        by: dict[str, set[str]] = {}
        for name in drop:
            by.setdefault(name.split("/", 1)[0].split("=", 1)[1], set()).add(name)
        live = {r.commit: r.n for r in index_of(spark, path, base).select("file").distinct().groupBy(
            F.substring_index(F.substring_index("file", "/", 1), "=", -1).alias("commit")).agg(F.count("*").alias("n")).collect()} if drop else {}
        for c, dead in base.commits.items():
            gone = by.get(c, set())
            if not gone or len(gone) < live.get(c, 0):
                commits[c] = sorted({*dead, *gone})
    if added is not None and added.rows:
        commits[added.commit] = []
    version = Version((base.number if base else 0) + 1, schema, tuple(partition_by), tuple(keys), commits, {**(base.notes if base else {}), **(notes or {})})
    publish(spark, path, version)
    _forget(spark, path, version)
    return version


def _forget(spark: SparkSession, path: str, version: Version) -> None:
    """Delete what neither ``version`` nor the one before it counts."""
    old = [n for n in _numbers(spark, path) if n < version.number]
    if len(old) < 2:
        return
    before = _load(spark, path, old[-1])
    for number in old[:-1]:
        gone = _load(spark, path, number)
        for c, dead in gone.commits.items():
            if c not in before.commits and c not in version.commits:
                _delete(spark, path, f"{COMMIT}={c}", True)
                _delete(spark, path, f"_index/{c}", True)
                _delete(spark, path, f"_reverse/{c}", True)
            elif c in before.commits and c in version.commits:
                for name in sorted(({*before.commits[c]} & {*version.commits[c]}) - {*dead}):
                    _delete(spark, path, name, False)
        _delete(spark, path, f"{number:010d}.json", False)


def compact(spark: SparkSession, path: str, target_rows: int = 1_000_000) -> int:
    """Merge small files: those with less than half of ``target_rows`` are written anew in
    order of (partition columns, key), about ``target_rows`` to a file; all others stay.
    The rows and what the change feed says of them don't change. Returns how many
    files were merged. A version that another writer publishes meanwhile wins (``ConflictError``)."""
    base = latest(spark, path)
    if base is None:
        return 0
    sizes = index_of(spark, path, base).groupBy("file").agg(F.sum("n").alias("n")).where(F.col("n") < target_rows / 2)
    small = {r.file: r.n for r in sizes.collect()}  # names, as Spark's own file index holds them
    by: dict[str, list[str]] = {}
    for name in small:
        by.setdefault(name.split("/", 1)[1].rpartition("/")[0], []).append(name)
    small = {name: small[name] for names in by.values() if len(names) > 1 for name in names}  # alone in its partition: nothing to merge
    if not small:
        return 0
    rows = read(spark, path, None, base.number, list(small), hidden=True)
    order = [F.col(c) for c in (*base.partition_by, *base.keys)]
    files = max(1, -(-sum(small.values()) // target_rows))
    if base.partition_by:  # a task writes the partitions it holds, so no more tasks than merged partitions need
        files = max(files, len({name.split("/", 1)[1].rpartition("/")[0] for name in small}))
    rows = rows.repartitionByRange(files, *order).sortWithinPartitions(*order) if order else rows.coalesce(files)
    added = add(spark, path, rows, base.schema, base.partition_by, base.keys, base.notes.get("reverse", ()))
    commit(spark, path, base, added, base.schema, base.partition_by, base.keys, drop=list(small))
    return len(small)


def vacuum(spark: SparkSession, path: str, older_than_hours: float = 24.0) -> list[str]:
    """Delete commits that no version counts (left by failed or beaten writers) and that
    are older than any running write can be; returns their ids."""
    _, folder, fs = _hadoop(spark, _folder(path))
    if not fs.exists(folder):
        return []
    counted = {c for n in _numbers(spark, path) for c in _load(spark, path, n).commits}
    limit, gone = (time.time() - 3600 * older_than_hours) * 1000, []
    for s in fs.listStatus(folder):
        name = s.getPath().getName()
        if name.startswith(f"{COMMIT}=") and name.split("=", 1)[1] not in counted and s.getModificationTime() <= limit:
            gone.append(name.split("=", 1)[1])
            _delete(spark, path, name, True)
            _delete(spark, path, f"_index/{gone[-1]}", True)
            _delete(spark, path, f"_reverse/{gone[-1]}", True)
    return sorted(gone)
