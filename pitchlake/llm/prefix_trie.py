"""The prefix trie of conversations, found by digests of blocks of turns.

A conversation is cut into blocks of eight turns. Conversations are grouped by their
blocks' digests first: those that agree in all blocks so far are at one node, and a
block that all of them continue with is a path without branches. Only where blocks
after one node differ are they refined: each different block, not each conversation,
is spread into its turn prefixes and these are grouped.

A node's smallest member names it, and nodes of one name are a chain: the
conversation's own prefixes from some depth to its end. Sums over subtrees are sums
along chains plus the totals of chains that hang on them, which pointer doubling
gathers; rounds grow with the logarithm of how deep chains hang on each other.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, stage
from .ranks import numbered

#: Turns of a block.
BLOCK = 8
#: A window spans so many blocks, or nodes of a chain; longer ones carry sums from window to window.
SEGMENT = 4096
#: Bytes of ids that are joined to one text before they are hashed.
CHUNK = 1 << 16
EMPTY = sha256(b"").hexdigest()


def _id(*parts: Column) -> Column:
    """16 bytes that name a node."""
    return F.substring(F.unhex(F.sha2(F.concat(*parts), 256)), 1, 16)


def _boundary(block: Column, x: Column, y: Column) -> Column:
    """The node before a block: its number, and the digests of all blocks before it."""
    return _id(F.concat_ws(":", block.cast("string"), x.cast("string"), y.cast("string")).cast("binary"))


def turns_of(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(c, pos, digest, bytes): the turns of each conversation in order, from 0."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = _id(F.octet_length(role).cast("string").cast("binary"), F.lit(b":"), role.cast("binary"), text.cast("binary"))
    rows = conversations.where(F.col(f"`{conv_col}`").isNotNull()).select(
        F.col(f"`{conv_col}`").cast("long").alias("c"), F.col(f"`{turn_col}`").alias("t"), digest.alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"))
    return numbered(rows, "c", ["t", "digest"], "trie").drop("t")


def rebuilt(turns: DataFrame, every: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """(c, depth, digest, bytes) and (c): each conversation with its first h turns replaced by those of conversation c - c % every."""
    h = F.pmod(F.crc32(F.col("c").cast("string").cast("binary")), F.lit(most))
    sizes = stage(turns.groupBy("c").agg((F.max("pos") + 1).alias("n")), "trie-sizes")
    of = sizes.select("c", "n", h.alias("h"), (F.col("c") - F.col("c") % every).alias("base"))
    heads = sizes.select(F.col("c").alias("base"), F.col("n").alias("have"))
    of = stage(of.join(heads, "base", "left").select("c", "base", "h", F.least("h", F.coalesce("have", F.lit(0))).alias("keep")), "trie-heads")
    own = turns.where(F.col("pos") >= h).join(of.select("c", "h", "keep"), "c").select("c", (F.col("pos") - F.col("h") + F.col("keep") + 1).alias("depth"), "digest", "bytes")
    first = turns.where(F.col("pos") < most - 1).withColumnRenamed("c", "base")
    taken = of.where("keep > 0").join(first, "base").where("pos < keep").select("c", (F.col("pos") + 1).alias("depth"), "digest", "bytes")
    return taken.unionByName(own), sizes.select("c")


def blocks_of(turns: DataFrame, size: int = BLOCK) -> DataFrame:
    """(c, block, start, steps, kind, stop): the blocks of each conversation.

    start and stop name the nodes before and after the block, kind the block itself
    among those after start; steps are its turns (digest, bytes).
    """
    block = F.floor((F.col("depth") - 1) / size).cast("long")
    rows = turns.withColumn("block", block).withColumn("seg", F.floor(F.col("block") / SEGMENT).cast("long"))
    packed = rows.repartition("c", "seg").groupBy("c", "seg", "block").agg(F.sort_array(F.collect_list(F.struct("depth", "digest", "bytes"))).alias("steps"))
    whole = F.aggregate("steps", F.lit(b""), lambda a, s: F.concat(a, s["digest"]))
    packed = packed.withColumn("whole", whole)
    packed = packed.select("*", *[F.xxhash64(F.lit(k), "block", "whole").alias(v) for k, v in ((1, "vx"), (2, "vy"))])
    w = Window.partitionBy("c", "seg").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    packed = packed.select("*", *[F.coalesce(F.bit_xor(v).over(w), F.lit(0)).alias(x) for v, x in (("vx", "x"), ("vy", "y"))])
    packed = stage(packed.select("c", "seg", "block", F.transform("steps", lambda s: F.struct(s["digest"], s["bytes"])).alias("steps"), "vx", "vy", "x", "y"), "trie-blocks")
    # what lies beyond a conversation's first window starts from the windows before it
    totals = packed.groupBy("c", "seg").agg(F.bit_xor("vx").alias("tx"), F.bit_xor("vy").alias("ty"))
    long = packed.where("seg > 0").select("c").distinct()
    back = Window.partitionBy("c").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.join(long, "c").select("c", "seg", F.bit_xor("tx").over(back).alias("cx"), F.bit_xor("ty").over(back).alias("cy")).where("seg > 0")
    later = packed.where("seg > 0").join(carry, ["c", "seg"]).select("c", "block", "steps", "vx", "vy", F.col("x").bitwiseXOR(F.col("cx")).alias("x"), F.col("y").bitwiseXOR(F.col("cy")).alias("y"))
    both = packed.where("seg = 0").select(*later.columns).unionByName(later)
    after = _boundary(F.col("block") + 1, F.col("x").bitwiseXOR(F.col("vx")), F.col("y").bitwiseXOR(F.col("vy")))
    start = _boundary(F.col("block"), F.col("x"), F.col("y"))
    both = both.select("c", "block", start.alias("start"), "steps", after.alias("after"))
    last = _prefix(F.col("start"), F.col("steps"), F.size("steps"))
    return both.select("c", "block", "start", "steps", last.alias("kind"), F.when(F.size("steps") == size, F.col("after")).otherwise(last).alias("stop"))


def _prefix(start: Column, steps: Column, k: Column) -> Column:
    """The name of the node ``k`` turns into a block."""
    return _id(start, F.aggregate(F.slice(steps, F.lit(1), k), F.lit(b""), lambda a, s: F.concat(a, s["digest"])))


def nodes_of(blocks: DataFrame, size: int = BLOCK) -> DataFrame:
    """(id, parent, depth, bytes, n, low): the turn nodes below the root."""
    kinds = stage(blocks.groupBy("block", "start", "kind").agg(
        F.count("*").alias("n"), F.min("c").alias("low"), F.first("steps").alias("steps"), F.first("stop").alias("stop")), "trie-kinds")
    siblings = kinds.groupBy("start").agg(F.count("*").alias("siblings"))
    at = F.posexplode("steps").alias("j", "step")
    name = F.when(F.col("j") + 1 == F.size("steps"), F.col("stop")).otherwise(_prefix(F.col("start"), F.col("steps"), F.col("j") + 1))
    parent = F.when(F.col("j") == 0, F.col("start")).otherwise(_prefix(F.col("start"), F.col("steps"), F.col("j")))
    spread = kinds.join(siblings, "start").select("siblings", "block", "start", "steps", "stop", "n", "low", at).select(
        "siblings", name.alias("id"), parent.alias("parent"), (F.col("block") * size + F.col("j") + 1).alias("depth"), F.col("step.bytes").alias("bytes"), "n", "low")
    shared = spread.where("siblings > 1").groupBy("id").agg(
        F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.min("bytes").alias("bytes"), F.sum("n").alias("n"), F.min("low").alias("low"))
    return spread.where("siblings = 1").drop("siblings").unionByName(shared)


def ends_of(ends: DataFrame) -> DataFrame:
    """(id, ends_sha256): the hash of the ids ``c`` at each node, ascending and comma-joined.

    Ids are joined to texts of 64 KB where ranges of (id, c) lie, so the task that
    hashes a node with very many ends reads few rows, one after the other.
    """
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, first, parts, size = None, None, [], 0
        for b in batches:
            out: list[dict] = []
            for node, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if parts and (node != now or size >= CHUNK):
                    out.append({"id": now, "first": first, "ids": ",".join(parts)})
                    parts, size = [], 0
                if not parts:
                    now, first = node, c
                parts.append(str(c))
                size += len(parts[-1]) + 1
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=joined)
        if parts:
            yield pa.RecordBatch.from_pylist([{"id": now, "first": first, "ids": ",".join(parts)}], schema=joined)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for b in batches:
            out: list[dict] = []
            for node, ids in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
                if node != now:
                    if state is not None:
                        out.append({"id": now, "ends_sha256": state.hexdigest()})
                    now, state = node, sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=hashed)
        if state is not None:
            yield pa.RecordBatch.from_pylist([{"id": now, "ends_sha256": state.hexdigest()}], schema=hashed)

    joined = pa.schema([("id", pa.binary()), ("first", pa.int64()), ("ids", pa.string())])
    hashed = pa.schema([("id", pa.binary()), ("ends_sha256", pa.string())])
    chunks = ends.repartitionByRange(partitions(ends.sparkSession), "id", "c").sortWithinPartitions("id", "c").mapInArrow(join, "id binary, first long, ids string")
    return chunks.repartition("id").sortWithinPartitions("id", "first").mapInArrow(digest, "id binary, ends_sha256 string")


def totals(chains: DataFrame) -> DataFrame:
    """(c, saved, leaves) summed over each chain and all that hang below it; ``chains`` has (c, up, saved, leaves)."""
    k = 0
    while not chains.where("up IS NOT NULL").isEmpty():
        below = chains.where("up IS NOT NULL")
        add = below.groupBy("up").agg(F.sum("saved").alias("s"), F.sum("leaves").alias("l")).withColumnRenamed("up", "c")
        jump = below.select("c", "up").join(chains.select(F.col("c").alias("up"), F.col("up").alias("over")), "up").select("c", "over")
        chains = stage(chains.join(add, "c", "left").join(jump, "c", "left").select(
            "c", F.col("over").alias("up"), (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"), (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves")), f"trie-totals-{k}")
        k += 1
    return chains.select("c", "saved", "leaves")


def _below(nodes: DataFrame) -> DataFrame:
    """Sums of w and leaf over each node and what follows it in its chain, as saved_tokens and n_leaves."""
    rows = nodes.withColumn("seg", F.floor(F.col("depth") / SEGMENT).cast("long"))
    sums = rows.groupBy("low", "seg").agg(F.sum("w").alias("sw"), F.sum("leaf").alias("sl"))
    long = rows.select("low", "seg").groupBy("low").agg(F.min("seg").alias("a"), F.max("seg").alias("b")).where("a < b").select("low", "b")
    ahead = Window.partitionBy("low").orderBy(F.desc("seg")).rowsBetween(Window.unboundedPreceding, -1)
    carry = stage(sums.join(long, "low").select("low", "seg", "b", F.sum("sw").over(ahead).alias("cw"), F.sum("sl").over(ahead).alias("cl")).where("seg < b").drop("b"), "trie-carry")
    w = Window.partitionBy("low", "seg").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    run = rows.select("*", F.sum("w").over(w).alias("saved_tokens"), F.sum("leaf").over(w).alias("n_leaves"))
    if carry.isEmpty():
        return run
    plus = [(F.col(a) + F.coalesce(b, F.lit(0))).alias(a) for a, b in (("saved_tokens", "cw"), ("n_leaves", "cl"))]
    return run.join(carry, ["low", "seg"], "left").select(*[c for c in run.columns if c not in ("saved_tokens", "n_leaves")], *plus)


def trie(turns: DataFrame, convs: DataFrame, size: int = BLOCK) -> DataFrame:
    """One row per node of the prefix trie of ``turns`` (c, depth, digest, bytes); ``convs`` (c) also names those without turns.

    conv_id (the smallest member), depth, parent_conv_id (null at the root), n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.
    """
    blocks = stage(blocks_of(turns, size), "trie-paths")
    root = _boundary(F.lit(0), F.lit(0), F.lit(0))
    top = convs.agg(F.count("*").alias("n"), F.min("c").alias("low")).where("n > 0").select(
        root.alias("id"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("bytes"), "n", "low")
    nodes = stage(nodes_of(blocks, size).unionByName(top), "trie-nodes")
    last = blocks.groupBy("c").agg(F.max_by("stop", "block").alias("id"))
    ends = ends_of(convs.join(last, "c", "left").select(F.coalesce("id", root).alias("id"), "c"))
    w = ((F.col("n") - 1) * F.col("bytes")).alias("w")
    chains = nodes.groupBy("low").agg(
        F.min("depth").alias("first"), F.max("depth").alias("last"), F.min_by("parent", "depth").alias("parent"), F.sum(w).alias("saved"))
    above = nodes.select(F.col("id").alias("parent"), F.col("low").alias("up"))
    links = stage(chains.join(above, "parent", "left").select("low", "up", "first", "last", "saved", (F.col("first") - 1).alias("at")), "trie-links")
    hung = links.where("up IS NOT NULL").select(F.col("up").alias("low"), F.col("at").alias("last")).distinct().withColumn("goes_on", F.lit(0).cast("long"))
    own = links.join(hung, ["low", "last"], "left").select(
        F.col("low").alias("c"), "up", "saved", F.coalesce("goes_on", F.lit(1).cast("long")).alias("leaves"))
    sums = totals(stage(own, "trie-own"))
    attached = links.where("up IS NOT NULL").join(sums.withColumnRenamed("c", "low").withColumnRenamed("saved", "s"), "low").groupBy("up", "at").agg(
        F.count("*").alias("hung"), F.sum("s").alias("s"), F.sum("leaves").alias("l"))
    none, zero = F.lit(None).cast("long"), F.lit(0).cast("long")
    notes = attached.select(F.col("up").alias("low"), F.col("at").alias("depth"), "hung", "s", "l", none.alias("up"), zero.alias("bottom")).unionByName(
        links.select("low", F.col("first").alias("depth"), zero.alias("hung"), zero.alias("s"), zero.alias("l"), "up", zero.alias("bottom"))).unionByName(
        links.select("low", F.col("last").alias("depth"), zero.alias("hung"), zero.alias("s"), zero.alias("l"), none.alias("up"), (zero + 1).alias("bottom")))
    notes = notes.groupBy("low", "depth").agg(*[F.sum(c).alias(c) for c in ("hung", "s", "l")], F.max("up").alias("up"), F.max("bottom").alias("bottom"))
    noted = nodes.join(notes, ["low", "depth"], "left").na.fill(0, ["hung", "s", "l", "bottom"])
    children = F.col("hung") + 1 - F.col("bottom")
    noted = noted.select("id", "low", "depth", "n", "up", children.alias("n_children"), (F.col("s") + w).alias("w"),
                         (F.col("l") + F.when(children == 0, 1).otherwise(0)).alias("leaf"))
    parent = F.when(F.col("depth") > 0, F.coalesce("up", "low"))
    return _below(noted).join(ends, "id", "left").select(
        F.col("low").alias("conv_id"), "depth", parent.alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))


def prefix_trie(conversations: DataFrame, every: int = 5, most: int = 9, size: int = BLOCK) -> DataFrame:
    """The trie of ``conversations`` (conv_id, turn, role, text), rebuilt to share first turns.

    Turns are ordered by turn, null first, and by a digest of role and text where
    turns are equal; repeated rows are turns of their own. Null roles and texts
    count as empty, and texts of any length count as their digest and bytes. Rows
    without a conv_id belong to no conversation. An empty table has no trie, not even
    a root. Other columns are ignored.
    """
    turns, convs = rebuilt(turns_of(conversations), every, most)
    return trie(turns, convs, size)
