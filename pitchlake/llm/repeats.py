"""Remove long byte strings that occur more than once, by suffix order.

Every string of ``length`` bytes contains, at a place that its own bytes fix, an
anchor: the least hash of its first ``width`` places. Strings that share an
anchor are a segment, and have a core of bytes around it in common; equal
strings lie in segments of equal core. That deals the text out into shards:

1. Segments whose core occurs once hold no repeat. Those that are equal
   throughout get one name, as equal substrings do in induced sorting, and a name
   that occurs twice settles its whole segment.
2. Cores with different segments around them are cut into narrower segments with
   longer cores, and named again; cores that still have very many different
   segments are cut again, down to single strings, whose name settles them.
3. What is left is sorted in shards by core: one of each different segment, its
   core written as a single symbol. External induced sorting gives suffixes and
   common prefixes in order; starts whose common prefix with a neighbour reaches
   ``length`` bytes repeat.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import induced
from .common import partitions, slices, stage, text_or_empty

LENGTH = 400
#: Places that an anchor is chosen from, first and after the cuts for sorting; then those for very large groups.
WIDTH, NARROW, NARROWEST = 200, 32, (6, 1)
#: Different segments of one core that a shard takes.
GROUP = 1000
GRAM = 16
#: Rows of a shard that are written as symbols at a time.
BLOCK = 10_000
#: Bytes of a text that are hashed at a time.
CHUNK = 1 << 20
#: Bytes of kept text after which a batch is given out.
HELD = 1 << 24

_BASE = 0x9E3779B97F4A7C15
_PLACE = np.uint64((1 << 22) - 1)
_LETTERS = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    out, k = np.ones(n, np.uint64), 1
    while k < n:
        m = min(k, n - k)
        out[k : k + m] = out[:m] * np.uint64(pow(base, k, 1 << 64))
        k += m
    return out


_UP = _powers(_BASE, CHUNK + LENGTH * 8)
_DOWN = _powers(pow(_BASE, -1, 1 << 64), CHUNK + LENGTH * 8)


def _mix(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


_digest = hashlib.blake2b


def name(data: bytes) -> int:
    """64 bits of a BLAKE2 digest, signed."""
    return int.from_bytes(_digest(data, digest_size=8).digest(), "little", signed=True)


def segments(data: bytes, length: int, width: int) -> Iterator[tuple[int, int, int, int]]:
    """(core, first start, last start, anchor): runs of starts that share an anchor.

    ``core`` is a hash of the length - width + 1 bytes from the anchor on; equal
    bytes give equal cores, whatever stands before and after them.
    """
    for columns in _segments(data, length, width):
        yield from zip(*(c.tolist() for c in columns), strict=True)


def _segments(data: bytes, length: int, width: int) -> Iterator[tuple[np.ndarray, ...]]:
    for low in range(0, len(data) - length + 1, CHUNK):
        part = np.frombuffer(data, np.uint8, min(CHUNK + length - 1, len(data) - low), low)
        n, gram = len(part), min(GRAM, length - width + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_LETTERS[part] * _UP[:n], out=sums[1:])
        grams = _mix((sums[gram:] - sums[:-gram]) * _DOWN[: n - gram + 1])
        least, span = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64), 1
        while span < width:
            step = min(span, width - span)
            least, span = np.minimum(least[:-step], least[step:]), span + step
        anchors = (least[: n - length + 1] & _PLACE).astype(np.int64)
        first = np.flatnonzero(np.diff(anchors, prepend=-1))
        at = anchors[first]
        cores = _mix((sums[at + length - width + 1] - sums[at]) * _DOWN[at]).view(np.int64)
        last = np.append(first[1:], len(anchors)) - 1
        yield cores, first + low, last + low, at + low


_SEGMENT = "core long, name long, first long, last long, anchor long"


def _first_segments(docs: DataFrame, length: int, width: int) -> DataFrame:
    """(id, hash, core, name, first, last, anchor) of every document (id, hash, text)."""
    schema = T.StructType([docs.schema["id"], docs.schema["hash"], *T.StructType.fromDDL(_SEGMENT).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            of, found = [], []
            for i, data in enumerate(b.column(2).to_pylist()):
                for core, first, last, anchor in _segments(data, length, width):
                    digests = b"".join([_digest(data[f:e], digest_size=8).digest() for f, e in zip(first.tolist(), (last + length).tolist(), strict=True)])
                    of.append(np.full(len(core), i, np.int32))
                    found.append((core, np.frombuffer(digests, "<i8"), first, last, anchor))
            if found:
                at = pa.array(np.concatenate(of))
                columns = [pa.array(np.concatenate(c)) for c in zip(*found, strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), *columns], names=schema.names)

    return docs.where(F.length("text") >= length).select("id", "hash", "text").mapInArrow(run, schema)


def _with_keys(b: pa.RecordBatch, of: list[int], rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    at = pa.array(of, pa.int32())
    columns = list(zip(*rows, strict=True)) or [[]] * (len(schema) - 2)
    types = [pa.binary() if isinstance(f.dataType, T.BinaryType) else pa.int64() for f in schema.fields[2:]]
    return pa.RecordBatch.from_arrays(
        [b.column(0).take(at), b.column(1).take(at), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=schema.names)


def _narrow_segments(found: DataFrame, docs: DataFrame, length: int, width: int) -> DataFrame:
    """Segments of ``found`` (id, hash, core, n, first, last, anchor), cut to places of ``width`` before the anchor.

    Adds start (of the core), left and right: the bytes of the segment around its core.
    """
    asked = found.groupBy("id", "hash").agg(F.collect_list(F.struct("core", "n", "first", "last", "anchor")).alias("asked"))
    packed = _packed(docs)
    given = packed.join(asked, _same(packed, asked)).select("id", "hash", "packed", "asked")
    more = ", n long, start long, left binary, right binary"
    schema = T.StructType([docs.schema["id"], docs.schema["hash"], *T.StructType.fromDDL(_SEGMENT + more).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for b in slices(batches):
            of, rows = [], []
            for i, (packed, asked) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)):
                data = unpack(packed)
                for s in asked:
                    near, far = s["anchor"] - s["last"], s["anchor"] - s["first"]
                    for k in range(near // width, far // width + 1):
                        low, high = k * width, k * width + width - 1  # places before the anchor
                        last, first = s["anchor"] - max(near, low), s["anchor"] - min(far, high)
                        start, end = s["anchor"] - low, s["anchor"] - high + length
                        core = name(data[start:end] + s["core"].to_bytes(8, "little", signed=True) + k.to_bytes(2, "little"))
                        rows.append((core, name(data[first : last + length]), first, last, s["anchor"], s["n"], start, data[first:start], data[end : last + length]))
                        of.append(i)
            yield _with_keys(b, of, rows, schema)

    return given.mapInArrow(run, schema)


def _same(packed: DataFrame, other: DataFrame):
    return packed["__id"].eqNullSafe(other["id"]) & (packed["__hash"] == other["hash"])


def _packed(docs: DataFrame) -> DataFrame:
    """(__id, __hash, packed): texts compressed for their way to other tasks."""
    schema = T.StructType([docs.schema["id"], docs.schema["hash"], T.StructField("packed", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([pack(t) for t in b.column(2).to_pylist()], pa.binary())], names=schema.names)

    return docs.select("id", "hash", "text").mapInArrow(run, schema).toDF("__id", "__hash", "packed")


def _repeated_cores(rows: DataFrame) -> DataFrame:
    """(core, mixed) of cores that occur twice or more; mixed: with different segments."""
    n = F.sum("n") if "n" in rows.columns else F.count("*")
    return (
        rows.groupBy("core").agg(n.alias("n"), F.min("name").alias("low"), F.max("name").alias("high"), F.count("*").alias("different"))
        .where("n > 1").select("core", (F.col("low") != F.col("high")).alias("mixed"), "different")
    )


def _shard(length: int, limit: int):
    """Starts that repeat among a partition's segments: (id, hash, first, last)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        rows = pa.Table.from_batches(held) if held else None
        del held
        if rows is None or not rows.num_rows:
            return
        # symbols: separators (the last one least), bytes, cores
        n = rows.num_rows
        cores, core_of = np.unique(rows["core"].to_numpy(), return_inverse=True)
        lefts, rights = (pc.binary_length(rows[c]).to_numpy().astype(np.int64) for c in ("left", "right"))
        starts = np.concatenate([[0], np.cumsum(lefts + rights + 2)])
        text = induced.array(int(starts[-1]), limit)
        inside = lambda sizes: np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        for low in range(0, n, BLOCK):
            at = slice(low, low + BLOCK)
            for column, sizes, begins in (("left", lefts[at], starts[:-1][at]), ("right", rights[at], starts[:-1][at] + lefts[at] + 1)):
                data = np.frombuffer(b"".join(rows[column].slice(low, BLOCK).to_pylist()), np.uint8).astype(np.int64)
                text[np.repeat(begins, sizes) + inside(sizes)] = n + data
        rows = rows.drop(["left", "right"])
        text[starts[:-1] + lefts] = n + 256 + core_of
        text[starts[1:] - 1] = np.arange(n)[::-1]
        # starts before or at the core: a common prefix holds it if it is longer than what stands before it
        first, last, begin = (rows[c].to_numpy() for c in ("first", "last", "start"))
        own, ahead, weight = last - first, begin - first, length - (rows["width"].to_numpy() - 1)
        hits: dict[int, list[int]] = {}
        before = -1
        segment = np.repeat(np.arange(n), np.diff(starts)).tolist() if len(text) <= 8 * limit else None
        starts_, own_, ahead_, weight_ = starts.tolist(), own.tolist(), ahead.tolist(), weight.tolist()
        for i, shared in induced.descending(text, limit):
            if shared:
                k = segment[i] if segment else int(np.searchsorted(starts, i, "right")) - 1
                place = i - starts_[k]
                if place <= own_[k] and shared > ahead_[k] - place and shared - 1 + weight_[k] >= length:
                    hits.setdefault(k, []).append(place)
                    j = segment[before] if segment else int(np.searchsorted(starts, before, "right")) - 1
                    hits.setdefault(j, []).append(before - starts_[j])
            before = i
        of, lows, highs = [], [], []
        for k, places in hits.items():
            places = np.unique(places)
            breaks = np.flatnonzero(np.diff(places) > 1)
            for a, b in zip(places[np.append(0, breaks + 1)], places[np.append(breaks, len(places) - 1)], strict=True):
                of.append(k)
                lows.append(int(first[k] + a))
                highs.append(int(first[k] + b))
        found = rows.select(["id", "hash", "n"]).take(pa.array(of, pa.int64()))
        found = found.add_column(2, "first", pa.array(lows, pa.int64())).add_column(3, "last", pa.array(highs, pa.int64()))
        yield from found.to_batches()

    return run


def repeated_starts(docs: DataFrame, length: int = LENGTH, width: int = WIDTH, narrow: int = NARROW, narrowest: tuple[int, ...] = NARROWEST,
                    group: int = GROUP, limit: int = induced.LIMIT) -> DataFrame:
    """(id, hash, first, last): ranges of starts of strings that occur elsewhere, of documents (id, hash, text)."""
    spans = ["id", "hash", "first", "last"]
    # written once: cutting and naming all texts costs more than reading the segments again
    rows = stage(_first_segments(docs, length, width), "repeats-first")
    cores = stage(_repeated_cores(rows), "repeats-cores")
    among = stage(rows.join(cores, "core"), "repeats-segments")
    settled = [among.where("not mixed").select(*spans)]
    rows = among.where("mixed")

    def named(rows: DataFrame, label: str, *more: str) -> DataFrame:
        """One row of each different segment and how often it occurs; repeated ones are settled."""
        n = F.sum("n") if "n" in rows.columns else F.count("*")
        names = stage(rows.groupBy("core", "name").agg(n.alias("total"), F.min(F.xxhash64("id", "hash", "first")).alias("pick")), f"repeats-names-{label}")
        picked = rows.join(names, ["core", "name"])
        if "n" in rows.columns:
            settled.append(picked.where("total > 1 and n = 1").select(*spans))
        else:
            settled.append(picked.where("total > 1").select(*spans))
        # equal hashes of different members only leave a segment in twice
        return picked.where(F.xxhash64("id", "hash", "first") == F.col("pick")).select(*spans, "core", "name", "anchor", F.col("total").alias("n"), *more)

    left = stage(named(rows, "wide"), "repeats-wide")
    around = ("start", "left", "right")
    shards = []
    for width_ in (narrow, *narrowest):
        rows = stage(_narrow_segments(left, docs, length, width_), f"repeats-cut-{width_}")
        cores = _repeated_cores(rows)
        rows = stage(rows.join(cores, "core"), f"repeats-cut-cores-{width_}")
        settled.append(rows.where("not mixed and n = 1").select(*spans))
        rows = rows.where("mixed")
        large = rows.where(F.col("different") > group)
        shards.append(named(rows.where(F.col("different") <= group), str(width_), *around).withColumn("width", F.lit(width_)))
        if width_ == narrowest[-1] or large.isEmpty():
            break
        left = stage(named(large, f"{width_}-large"), f"repeats-large-{width_}")
    parts = shards[0]
    for more in shards[1:]:
        parts = parts.unionByName(more)
    schema = T.StructType([docs.schema["id"], docs.schema["hash"], *T.StructType.fromDDL("first long, last long, n long").fields])
    sorted_ = parts.repartition(partitions(docs.sparkSession), "core").mapInArrow(_shard(length, limit), schema)
    out = sorted_.where("n = 1").select(*spans)
    for more in settled:
        out = out.unionByName(more)
    return out


_KEPT = "n_bytes long, spans array<struct<start: long, end: long>>, kept binary"


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, width: int = WIDTH,
                narrow: int = NARROW, narrowest: tuple[int, ...] = NARROWEST, group: int = GROUP, limit: int = induced.LIMIT) -> DataFrame:
    """One row per document: id, n_bytes (of the text), spans and kept.

    ``spans`` are the maximal removed runs of bytes in order, end exclusive, and
    ``kept`` the remaining bytes concatenated: bytes, as a run may begin or end
    inside a character.

    Removed is every byte that a string of ``length`` bytes covers which starts
    anywhere else too, in this or another document, overlaps included. Null text
    counts as empty. Null ids are documents like others; repeated rows each have
    a row (and repeat each other): rows of one id and text are counted first, removed
    whole, and searched for what others share with them as one document. Other columns
    are ignored; texts of any length are read whole, and an empty table gives no rows.
    """
    given = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("t")).select(
        "id", F.xxhash64("t").alias("hash"), F.col("t").cast("binary").alias("text"))
    again = stage(given.groupBy("id", "hash").agg(F.count("*").alias("n"), F.max(F.length("text")).alias("size")).where("n > 1"), "repeats-rows")
    single = given
    if not again.isEmpty():
        keys = again.select(F.col("id").alias("__i"), F.col("hash").alias("__h"))
        equal = F.col("id").eqNullSafe(F.col("__i")) & (F.col("hash") == F.col("__h"))
        single = given.join(keys, equal, "left_anti").unionByName(given.join(keys, equal, "left_semi").dropDuplicates(["id", "hash"]))
    starts = repeated_starts(single, length, width, narrow, narrowest, group, limit).unionByName(
        again.where(F.col("size") >= length).select("id", "hash", F.lit(0).cast("long").alias("first"), (F.col("size") - length).cast("long").alias("last")))
    spans = starts.groupBy("id", "hash").agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    packed = _packed(given)
    rows = packed.join(spans, _same(packed, spans), "left").select("__id", "packed", "spans")
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), *T.StructType.fromDDL(_KEPT).fields])
    types = [pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()]

    def batch(ids: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([ids, *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True))], names=schema.names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for b in slices(batches):
            out, since, held = [], 0, 0
            for i, (packed, spans) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)):
                data = unpack(packed)
                merged: list[dict[str, int]] = []
                for first, last in sorted((s["first"], s["last"]) for s in spans or []):
                    if merged and first <= merged[-1]["end"]:
                        merged[-1]["end"] = max(merged[-1]["end"], last + length)
                    else:
                        merged.append({"start": first, "end": last + length})
                breaks = [0, *(x for m in merged for x in (m["start"], m["end"])), len(data)]
                kept = b"".join(data[a:e] for a, e in zip(breaks[::2], breaks[1::2], strict=True)) if merged else data
                out.append((len(data), merged, kept))
                held += len(kept)
                if held > HELD:
                    yield batch(b.column(0).slice(since, len(out)), out)
                    out, since, held = [], i + 1, 0
            if out:
                yield batch(b.column(0).slice(since, len(out)), out)

    return rows.mapInArrow(cut, schema)


def digests() -> list[Column]:
    """n_bytes, n_removed, n_spans, kept_sha256 of ``cut_repeats``' rows."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return [F.col("n_bytes"), removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", *args, **kwargs) -> DataFrame:
    """Digests of ``cut_repeats``: id, n_bytes, n_removed, n_spans, kept_sha256."""
    return cut_repeats(docs, id_col, *args, **kwargs).select(id_col, *digests())
