"""Merkle manifest of a dataset, with versions that copy only the path of a changed leaf.

Every row is a leaf; the leaves of a group (in order of id) are folded in pairs to the
group's subroot, and the subroots (in order of group, null first) to the root. Leaves
are dealt in aligned blocks of 1,024, so that a block's top is a node of the whole tree;
block tops are dealt in blocks again, and so on. A block is a persistent tree: a
leaf that is claimed to be another makes a version, which copies the leaf's ancestors in
the block and shares every other node; the version goes on through the nodes above,
which reach the block as one path of siblings.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stage
from .ranks import numbered

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels of a block, which has 2 ** LEVELS nodes at its foot.
LEVELS = 10
BLOCK = 1 << LEVELS
#: A path's entry: how the sibling stands, then its digest.
ALONE, LEFT, RIGHT = b"-", b"<", b">"


def node(*digests: str) -> str:
    """H: lowercase hex sha256 of digests as hex text, concatenated."""
    return sha256("".join(digests).encode()).hexdigest()


def levels_of(n: int, most: int = LEVELS) -> int:
    """Levels that ``n`` nodes of a group climb within one block."""
    return min(most, (n - 1).bit_length())


class Block:
    """The nodes of an aligned block by level. Versions never change them."""

    def __init__(self, leaves: list[str], levels: int):
        self.rows = [leaves]
        for _ in range(levels):
            below = self.rows[-1]
            self.rows.append([node(*below[i : i + 2]) for i in range(0, len(below), 2)])

    @property
    def top(self) -> str:
        return self.rows[-1][0]

    def siblings(self, at: int) -> list[tuple[bytes, str]]:
        """How the sibling stands, and its digest, for each level from the foot."""
        out = []
        for row in self.rows[:-1]:
            other = at ^ 1
            out.append((LEFT if other < at else RIGHT, row[other]) if other < len(row) else (ALONE, ""))
            at >>= 1
        return out

    def version(self, at: int, leaf: str) -> list[str]:
        """The ancestors that a version with ``leaf`` at ``at`` copies, from the foot to the top."""
        return climb(leaf, self.siblings(at))


def climb(digest: str, path: list[tuple[bytes, str]]) -> list[str]:
    """The nodes above ``digest`` along a path of siblings."""
    out = []
    for stands, other in path:
        digest = node(digest) if stands == ALONE else node(other, digest) if stands == LEFT else node(digest, other)
        out.append(digest)
    return out


def pack(path: list[tuple[bytes, str]]) -> bytes:
    return b"".join(stands + bytes.fromhex(other) for stands, other in path)


def unpack(path: bytes) -> list[tuple[bytes, str]]:
    out, i = [], 0
    while i < len(path):
        stands, size = path[i : i + 1], 0 if path[i : i + 1] == ALONE else 32
        out.append((stands, path[i + 1 : i + 1 + size].hex()))
        i += 1 + size
    return out


def field(value: Column) -> Column:
    """A value as its UTF-8 byte count, a colon and itself; '-' for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


@dataclass
class Manifest:
    """blocks: (g, block, n, rows of pos, id, leaf, claim); paths: (g, block, up, subroot, root);
    subroots: (g, digest); root: one row (digest), none for an empty table."""

    blocks: DataFrame
    paths: DataFrame
    subroots: DataFrame
    root: DataFrame


def _dealt(nodes: DataFrame, levels: int, *own: str) -> DataFrame:
    """(g, block, n, rows): aligned blocks of at most 2 ** levels nodes, in order of place."""
    block = F.shiftright("pos", levels).alias("block")
    return nodes.groupBy("g", block).agg(F.sort_array(F.collect_list(F.struct("pos", *own))).alias("rows"), F.first("n").alias("n"))


def _block(row: dict, levels: int) -> tuple[pa.StructArray, Block]:
    rows = row["rows"]
    return rows, Block([d.hex() for d in rows.field("digest").to_pylist()], levels_of(row["n"], levels))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One block at a time; its rows stay in Arrow."""
    for b in batches:
        names = b.schema.names
        for i in range(b.num_rows):
            yield {name: b.column(name)[i].values if name == "rows" else b.column(name)[i].as_py() for name in names}


def _tops(blocks: DataFrame, levels: int) -> DataFrame:
    """(g, pos, digest): the blocks' tops, nodes of the tier above."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            yield pa.RecordBatch.from_pylist([{"g": row["g"], "pos": row["block"], "digest": bytes.fromhex(_block(row, levels)[1].top)}], schema=out)

    out = pa.schema([("g", pa.string()), ("pos", pa.int64()), ("digest", pa.binary())])
    return blocks.mapInArrow(run, "g string, pos long, digest binary")


def _ways(blocks: DataFrame, levels: int) -> DataFrame:
    """(g, pos, block, path): each node's siblings within its block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            rows, tree = _block(row, levels)
            ways = [{"g": row["g"], "pos": p, "block": row["block"], "path": pack(tree.siblings(i))} for i, p in enumerate(rows.field("pos").to_pylist())]
            yield pa.RecordBatch.from_pylist(ways, schema=out)

    out = pa.schema([("g", pa.string()), ("pos", pa.int64()), ("block", pa.int64()), ("path", pa.binary())])
    return blocks.mapInArrow(run, "g string, pos long, block long, path binary")


def _tiers(nodes: DataFrame, sizes: DataFrame, levels: int, name: str) -> tuple[DataFrame, DataFrame]:
    """(g, pos, up) and (g, digest): the siblings on each node's way to its group's top, and the tops.

    ``nodes`` is (g, pos, digest); ``sizes`` (g, n) how many a group has. A tier
    has a 2 ** levels-th of the nodes of the one below; each is written.
    """
    most, ways = sizes.agg(F.max("n")).first()[0] or 0, []
    while most > 1:
        dealt = stage(_dealt(nodes.join(sizes, "g"), levels, "digest"), f"{name}-blocks-{len(ways)}")
        ways.append(stage(_ways(dealt, levels), f"{name}-ways-{len(ways)}"))
        nodes = stage(_tops(dealt, levels), f"{name}-tops-{len(ways)}")
        sizes = sizes.select("g", F.shiftright(F.col("n") + ((1 << levels) - 1), levels).alias("n"))
        most = (most + (1 << levels) - 1) >> levels
    up = nodes.select("g", "pos", F.lit(b"").alias("up"))
    for k, way in reversed(list(enumerate(ways))):
        above = up.select("g", F.col("pos").alias("block"), "up")
        up = stage(way.join(above, ["g", "block"]).select("g", "pos", F.concat("path", "up").alias("up")), f"{name}-up-{k}")
    return up, nodes.select("g", "digest")


def build(
    docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang", fields: tuple[str, ...] = FIELDS,
    claims: dict[str, Column] | None = None, levels: int = LEVELS,
) -> Manifest:
    """The manifest of ``docs``; ``claims`` gives columns other values, whose leaves make versions.

    Null values have a leaf of their own form, a null id comes first, and null is a
    group. Rows that share an id are ordered by their leaf; repeated rows are leaves of
    their own. Empty and very long texts are leaves like any other (a text is hashed
    inside Spark, and only its digest goes further). Other columns are ignored, and an
    empty table has neither subroots nor a root.
    """
    cols = {f: F.col(f"`{f}`") for f in fields}
    said = cols | (claims or {})
    leaf = F.unhex(F.sha2(F.concat(*map(field, cols.values())), 256))
    same = F.lit(True)
    for f in claims or {}:
        same = same & field(said[f]).eqNullSafe(field(cols[f]))
    claim = F.when(~same, F.unhex(F.sha2(F.concat(*map(field, said.values())), 256)))
    group = F.col(f"`{group_col}`").cast("string")
    g = F.when(group.isNull(), "").otherwise(F.concat(F.lit("="), group))
    rows = docs.select(g.alias("g"), F.col(f"`{id_col}`").alias("id"), leaf.alias("digest"), claim.alias("claim"))
    placed = numbered(rows, "g", ["id", "digest"], "merkle")
    sizes = stage(placed.groupBy("g").agg((F.max("pos") + 1).alias("n")), "merkle-sizes")
    blocks = stage(_dealt(placed.join(sizes, "g"), levels, "id", "digest", "claim"), "merkle-blocks")
    tops = stage(_tops(blocks, levels), "merkle-tops")
    up, subroots = _tiers(tops, sizes.select("g", F.shiftright(F.col("n") + ((1 << levels) - 1), levels).alias("n")), levels, "merkle")
    heads = numbered(subroots.select(F.lit("").alias("g"), F.col("g").alias("of"), "digest"), "g", ["of"], "merkle-groups")
    count = heads.groupBy("g").agg(F.count("*").alias("n"))
    over, root = _tiers(heads.select("g", "pos", "digest"), count, levels, "merkle-root")
    tails = heads.join(over.select("pos", F.col("up").alias("over")), "pos").join(root.select("g", F.col("digest").alias("root")), "g")
    tails = stage(tails.select(F.col("of").alias("g"), F.col("digest").alias("subroot"), "over", "root"), "merkle-tails")
    paths = up.join(tails, "g").select("g", F.col("pos").alias("block"), F.concat("up", "over").alias("up"), "subroot", "root")
    return Manifest(blocks, paths, subroots, root.select("digest"))


def verify(manifest: Manifest, id_col: str = "doc_id", levels: int = LEVELS, nodes: bool = False) -> DataFrame:
    """One row per leaf: id, leaf, subroot, root, proof_sha256, folded_root, verified.

    A claimed leaf makes a version of its block and folded_root is the version's root;
    a row without a claim is in the version that shares all nodes. With ``nodes`` also
    siblings (the proof, null where a node stood alone) and copied (the digests of the
    nodes that the version does not share).
    """
    kind = next(f.dataType for f in manifest.blocks.schema["rows"].dataType.elementType.fields if f.name == "id")
    texts = ("leaf", "subroot", "root", "proof_sha256", "folded_root")
    schema = T.StructType([T.StructField(id_col, kind), *(T.StructField(c, T.StringType()) for c in texts), T.StructField("verified", T.BooleanType())])
    if nodes:
        schema = schema.add("siblings", T.ArrayType(T.StringType())).add("copied", T.ArrayType(T.StringType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            rows, tree = _block(row, levels)
            above, sub, root = unpack(row["up"]), row["subroot"].hex(), row["root"].hex()
            leaves, claims = tree.rows[0], rows.field("claim").to_pylist()
            proofs = [[*tree.siblings(i), *above] for i in range(len(leaves))]
            copied = [[c.hex(), *climb(c.hex(), p)] if c is not None else [] for c, p in zip(claims, proofs, strict=True)]
            folded = [c[-1] if c else root for c in copied]
            columns = [
                rows.field("id"), leaves, [sub] * len(leaves), [root] * len(leaves), [node(*(d for _, d in p)) for p in proofs],
                folded, [f == root for f in folded],
            ]
            if nodes:
                columns += [[[d or None for _, d in p] for p in proofs], copied]
            arrays = [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, [None, *[pa.string()] * 5, pa.bool_(), *[pa.list_(pa.string())] * 2], strict=False)]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return manifest.blocks.join(manifest.paths, ["g", "block"]).select("n", "rows", "up", "subroot", "root").mapInArrow(run, schema)


def tampered(id_col: str = "doc_id", count_col: str = "n_chars", every: int = 7) -> dict[str, Column]:
    """Claims that add 1 to the count where ``every`` divides the id's crc32; nulls stay."""
    hit = F.pmod(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")), F.lit(every)) == 0
    count = F.col(f"`{count_col}`").cast("decimal(38,0)")
    return {count_col: F.when(hit, count + 1).otherwise(count)}
