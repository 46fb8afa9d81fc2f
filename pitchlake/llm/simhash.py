"""SimHash near-duplicates, found by a generalised pigeonhole search.

The 64 bits are grouped into parts, correlated bits together, and each part i has
a threshold t_i, where the thresholds sum to max_bits - parts + 1: of two
fingerprints within max_bits, some part differs in t_i bits at most. A threshold
of -1 leaves a part out. The number of parts and the thresholds minimise the
estimated number of probes and candidates (dynamic programming over the parts,
on counts of all fingerprints). Fingerprints meet in buckets by a part's value or
a value within its threshold; every candidate is verified on all bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, stage, text_or_empty
from .components import components

BITS = 64
SHINGLE, MAX_BITS, SEED = 3, 3, 42
#: A bucket with more rows is dealt anew by the bits that its key leaves out.
BUCKET = 1024
#: Cost of making and shuffling a probe, in units of verifying a candidate.
PROBE_COST = 4.0

_BIT = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_COLUMN = 256 * np.arange(8)


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The SimHash of a UTF-8 text: a bit is 1 if set in over half the shingles' hashes."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()  # of bytes: A-Z alone; \x20 and \x09 to \x0D
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False)) if len(words) >= shingle else [b" ".join(words)]
    hashes = np.fromiter(map(partial(xxh64_intdigest, seed=seed), shingles), "<u8", max(1, len(words) - shingle + 1))
    by_byte = np.bincount((hashes.view(np.uint8).reshape(-1, 8) + _COLUMN).ravel(), minlength=2048).reshape(8, 256) @ _BIT
    return int.from_bytes(np.packbits(2 * by_byte.ravel() > len(hashes), bitorder="little").tobytes(), "little", signed=True)


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE) -> DataFrame:
    """(id, fp): the fingerprint as a signed long."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            fps = [fingerprint(t, shingle) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], names=schema.names)

    return docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).cast("binary")).mapInArrow(run, schema)


def bit_statistics(nodes: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of fingerprints, share of ones by bit, and the bits' correlations, over all fingerprints."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = np.zeros((BITS, BITS))
        for b in batches:
            fps = b.column(0).to_numpy().astype("<i8")
            for i in range(0, len(fps), 8192):
                bits = np.unpackbits(fps[i : i + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
                both += bits.T @ bits
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BITS * BITS), pa.int32()), pa.array(both.ravel().astype(np.int64))], names=["at", "n"])

    both = np.zeros(BITS * BITS)
    for r in nodes.mapInArrow(run, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():  # 4,096 rows
        both[r.at] = r.n
    n = nodes.count()
    both = both.reshape(BITS, BITS) / max(n, 1)
    ones = np.diag(both).copy()
    scale = np.sqrt(np.maximum(np.outer(ones * (1 - ones), ones * (1 - ones)), 1e-12))
    return n, ones, np.abs(both - np.outer(ones, ones)) / scale


def group_bits(correlation: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in parts of nearly equal size: each part starts at the bit that is most
    correlated with those left, and takes the bits most correlated with it."""
    left, groups = list(range(BITS)), []
    for k in range(parts):
        size = len(left) // (parts - k)
        group = [max(left, key=lambda b: correlation[b, left].sum())]
        left.remove(group[0])
        while len(group) < size:
            group.append(max(left, key=lambda b: correlation[b, group].sum()))
            left.remove(group[-1])
        groups.append(sorted(group))
    return groups


def mask_of(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def allocate(costs: list[dict[int, float]], total: int) -> tuple[float, list[int]]:
    """The thresholds that sum to ``total`` at the least cost, part by part."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for of in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for t, c in of.items():
                now = (cost + c, [*chosen, t])
                if used + t not in step or now < step[used + t]:
                    step[used + t] = now
        best = step
    return best[total]


def choose_parts(nodes: DataFrame, max_bits: int) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each part that is probed."""
    n, ones, correlation = bit_statistics(nodes)
    plans = {m: group_bits(correlation, m) for m in range(1, max_bits + 2)}
    masks = [(m, i, mask_of(bits)) for m, groups in plans.items() for i, bits in enumerate(groups)]
    values = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(signed(mask))).alias("v")) for k, (*_, mask) in enumerate(masks)]))
    same = {  # pairs that agree on a part
        r.k: float(r.pairs)
        for r in nodes.select(values.alias("x")).groupBy("x.k", "x.v").agg(F.count("*").alias("n"))
        .groupBy("k").agg(F.sum(F.col("n") * (F.col("n") - 1.0) / 2).alias("pairs")).collect()
    }
    differ = 2 * ones * (1 - ones)
    odds = differ / np.maximum(1 - differ, 0.5)
    best: tuple[float, list] = (float("inf"), [])
    for m, groups in plans.items():
        costs = []
        for bits in groups:
            k = masks.index((m, len(costs), mask_of(bits)))
            sums = np.zeros(max_bits + 1)  # pairs that differ in j bits of the part, per pair that agrees
            sums[0] = 1
            for b in bits:
                sums[1:] += odds[b] * sums[:-1].copy()
            of = {-1: 0.0}
            for t in range(max_bits + 1):
                probes = sum(comb(len(bits), j) for j in range(t + 1))
                of[t] = PROBE_COST * n * (probes + (t > 0)) + max(same.get(k, 0.0), n * n / 2.0 ** (len(bits) + 1)) * sums[: t + 1].sum()
            costs.append(of)
        cost, chosen = allocate(costs, max_bits - m + 1)
        best = min(best, (cost, [(bits, t) for bits, t in zip(groups, chosen, strict=True) if t >= 0]))
    return best[1]


def _mix(key: np.ndarray | int, part: int, value: np.ndarray) -> np.ndarray:
    """A bucket's key. Equal inputs share one; a chance agreement only adds candidates."""
    x = value.astype(np.uint64) ^ (np.uint64((part + 1) * 0x9E3779B97F4A7C15 % (1 << 64)) + np.asarray(key, np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _batch(key: np.ndarray, rest: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in (key, rest, fp)], names=["key", "rest", "fp"])


def probes(nodes: DataFrame, parts: list[tuple[list[int], int]]) -> DataFrame:
    """(key, rest, fp): a row for each part and value within its threshold; rest masks the bits outside the part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = b.column(0).to_numpy().view(np.uint64)
            for i, (bits, t) in enumerate(parts):
                own = np.uint64(mask_of(bits))
                rest = np.full(len(fps), ~own)
                for j in range(t + 1):
                    for flips in combinations(bits, j):
                        yield _batch(_mix(0, i, (fps & own) ^ np.uint64(mask_of(list(flips)))), rest, fps)

    return nodes.select("fp").mapInArrow(run, "key long, rest long, fp long")


def refine(rows: DataFrame, max_bits: int) -> DataFrame:
    """Rows of large buckets, dealt anew: the bits outside the key form max_bits + 1
    parts, of which two near fingerprints agree on one at least."""
    n = max_bits + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key, rest, fps = (c.to_numpy().view(np.uint64) for c in b.columns)
            for mask in np.unique(rest):
                mine = rest == mask
                bits = [i for i in range(BITS) if int(mask) >> i & 1]
                for j in range(n):
                    sub = np.uint64(mask_of(bits[j::n]))
                    yield _batch(_mix(key[mine], j, fps[mine] & sub), np.full(mine.sum(), mask & ~sub), fps[mine])

    return rows.mapInArrow(run, "key long, rest long, fp long")


def spanning(fps: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that connect a bucket's fingerprints as all its pairs would, at most one for each fingerprint."""
    left = np.unique(fps)
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = np.bitwise_count(left ^ x) <= max_bits
            if near.any():
                found = left[near]
                yield np.full(len(found), x), found
                queue.extend(found)
                left = left[~near]


def link_buckets(rows: DataFrame, max_bits: int) -> DataFrame:
    """(u, v): verified links within buckets."""
    small = 12  # runs up to here are compared at all shifts at once

    def link(key: np.ndarray, fps: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        sizes = np.diff(np.r_[starts, len(key)])
        of = np.repeat(sizes, sizes)
        for s in range(1, small):
            a = np.flatnonzero((key[:-s] == key[s:]) & (of[:-s] <= small)) if s < len(key) else []
            if len(a):
                a = a[(np.bitwise_count(fps[a] ^ fps[a + s]) <= max_bits) & (fps[a] != fps[a + s])]
                yield fps[a], fps[a + s]
        for i in np.flatnonzero(sizes > small):
            yield from spanning(fps[starts[i] : starts[i] + sizes[i]], max_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fps = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        for b in batches:
            key = np.concatenate([key, b.column(0).to_numpy().view(np.uint64)])
            fps = np.concatenate([fps, b.column(1).to_numpy().view(np.uint64)])
            cut = len(key) if not len(key) else int(np.searchsorted(key.view(np.int64), key.view(np.int64)[-1]))
            yield from out(key[:cut], fps[:cut])
            key, fps = key[cut:], fps[cut:]
        yield from out(key, fps)

    def out(key: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(key) > 1 and (found := list(link(key, fps))):
            u, v = (np.concatenate(c).view(np.int64) for c in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    return rows.select("key", "fp").repartition("key").sortWithinPartitions("key", "fp").mapInArrow(run, "u long, v long")


def links(nodes: DataFrame, max_bits: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """(u, v): links between distinct fingerprints that connect whatever is within max_bits."""
    rows, found = probes(nodes, choose_parts(nodes, max_bits)), []
    for level in range(12):  # each level fixes a quarter of the bits that are left, so buckets end
        hot = stage(rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > bucket).select("key"), f"simhash-hot-{level}")
        if hot.isEmpty():
            break
        found.append(stage(link_buckets(rows.join(hot, "key", "left_anti"), max_bits), f"simhash-links-{level}"))
        rows = stage(refine(rows.join(hot, "key", "left_semi"), max_bits).distinct(), f"simhash-level-{level}")
    out = link_buckets(rows, max_bits)
    for more in found:
        out = out.unionByName(more)
    return out


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits), component_id
    (the smallest id that links reach; null if all ids there are null).

    Null text counts as empty; documents without words have fingerprint zero and
    link like any other. Repeated rows each have a row; other columns are
    ignored. Copies meet as one fingerprint, so a group of copies costs one
    node, and dense groups of near copies give at most one link a fingerprint
    and bucket.
    """
    rows = stage(fingerprints(docs, id_col, text_col, shingle), "simhash")
    ids = stage(rows.groupBy("fp").agg(F.min("id").alias("low")), "simhash-nodes")
    roots = components(links(ids.select("fp"), max_bits))
    ids = ids.join(roots, ids["fp"] == roots["node"], "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lows = ids.groupBy("root").agg(F.min("low").alias("component_id"))
    of = stage(ids.join(lows, "root").select("fp", "component_id"), "simhash-components")
    return rows.join(of, "fp").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The documents whose id is their component's smallest, one row for each; all columns stay.

    Rows that share that id are told apart by text; of rows that share both, one
    stays. Null ids count as the smallest.
    """
    low = -(1 << 63)
    key = F.struct(F.coalesce(F.col(f"`{id_col}`"), F.lit(low)).alias("id"), F.xxhash64(f"`{text_col}`").alias("h"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    given = docs.select(row.alias("row"), key.alias("key")).select("row", "key.id", "key.h", F.col(f"row.`{text_col}`").alias("text"))
    # ids for the operator: one per (id, text); ties between rows of an id go by hash
    found = stage(fingerprints_of_keys(given, shingle, max_bits), "simhash-kept")
    kept = given.join(found, ["id", "h"])
    single, many = kept.where("n = 1"), kept.where("n > 1").dropDuplicates(["id", "h"])
    return single.select("row.*").unionByName(many.select("row.*"))


def fingerprints_of_keys(given: DataFrame, shingle: int, max_bits: int) -> DataFrame:
    """(id, h, n): the row to keep of each component, and how many rows look like it."""
    named = given.select(F.struct("id", "h").alias("doc_id"), "text")
    found = near_duplicates(named, "doc_id", "text", shingle, max_bits)
    rows = found.where(F.col("doc_id") == F.col("component_id")).groupBy("doc_id").agg(F.count("*").alias("n"))
    return rows.select("doc_id.id", "doc_id.h", "n")
