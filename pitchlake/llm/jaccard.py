"""Exact Jaccard join of n-gram sets by walks in prefix trees.

A document's set is its distinct n-word shingles as hashes; documents of one set are one
node. Sets that can link are dealt to the same place first: a class of sizes has m parts
of the hash space, more than the shingles in which linked sets may differ, so that
linked sets agree in whole parts and meet in a bucket by such a part's content. Most
sets that meet agree in little else: sketches, a bit or two for each shingle, show that
they differ in too much to link. What the others connect is a cluster, and a cluster's
sets form prefix trees, shingles in a global order of the tree (rare ones first). A set walks a tree as a centre: it shares the
overlap of common paths and leaves a branch where the overlap so far and the shorter of
what remains can't reach the threshold. Sets of the component that has become the largest
needn't walk, as every set outside it does; a cluster of many shingles has several
trees, and only sets outside its largest component walk the others. Every pair of
sets that meets in a bucket is told apart by its sketches, linked, in one component or
decided by a walk, so the result is exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, exp, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, stage, text_or_empty
from .components import components

WORDS, LEAST = 4, 85
#: Shingles of a tree, about; a task holds one tree at a time.
TREE = 1 << 19
#: Shingles of a branch's piece.
PIECE = 16
#: Set hashes that a task remembers, so that copies post once; and words, so that each is hashed once.
SEEN = 1 << 18
#: Bits of the filter of texts whose sets are wanted again: a fixed size for every input.
FILTER_BITS = 1 << 26
#: Words of sketches that a star compares at most; what is left then is one cluster, which walks decide.
COMPARED = 1 << 32
_CHUNK_BITS = 1 << 19

_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> _U(shift))) * _U(factor)
    return x ^ (x >> _U(31))


class Words(dict):
    """Hashes of words, each made once; forgets all of them in time."""

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest

        if len(self) >= SEEN:
            self.clear()
        self[word] = h = xxh64_intdigest(word, seed=7)
        return h


def shingle_set(text: bytes, words: int = WORDS, known: Words | None = None) -> np.ndarray:
    """The set of a UTF-8 text: ascending hashes of its distinct shingles; the whole
    sequence is one shingle if it has fewer words, and no words give an empty set."""
    found = text.lower().split()  # of bytes: A-Z alone; \x20 and \x09 to \x0D
    if not found:
        return np.zeros(0, np.uint64)
    known = Words() if known is None else known
    hashes = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
    size = min(words, len(found))
    out = np.full(len(found) - size + 1, size, np.uint64)
    for k in range(size):
        out = _mix(out * _U(0x9E3779B97F4A7C15) + hashes[k : len(found) - size + 1 + k])
    return np.unique(out)


def set_hash(tokens: np.ndarray) -> int:
    from xxhash import xxh64_intdigest

    x = xxh64_intdigest(tokens.tobytes(), seed=len(tokens))
    return x - (1 << 64) if x >= 1 << 63 else x


def sketch_of(tokens: np.ndarray) -> bytes:
    """Whether each block of the hash space holds an odd number of the set's shingles: one
    bit for each of as many blocks as shingles, or up to twice as many.

    A block in which two sets differ by their bits holds a shingle that only one of them
    has, so sets differ in as many shingles at least as their sketches in bits. Blocks are
    those of the last bits: the halves of a sketch, one over the other, are the next smaller one.
    """
    bits = max(64, 1 << (len(tokens) - 1).bit_length())
    odd = np.bincount((tokens & _U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def links_at(inter: int, a: int, b: int, least: int = LEAST) -> bool:
    return 100 * inter >= least * (a + b - inter)


def needed(a: int, b: int, least: int = LEAST) -> int:
    """The least overlap with which sets of these sizes link."""
    return -(-least * (a + b) // (100 + least))


class Classes:
    """Classes of sizes: a set links with sets of its own class and the classes beside it only."""

    def __init__(self, least: int = LEAST):
        self.least, self.starts, self.parts = least, [1], []

    def _grow(self, n: int) -> None:
        while self.starts[-1] <= n:
            low, high = self.starts[-1], 100 * self.starts[-1] // self.least + 1
            differ = 2 * (high - 1) * (100 - self.least) // (100 + self.least)
            empty = (differ + 1) * exp(-low * self.least / 100 / (differ + 1))
            # linked sets agree in 1 + spare parts at least, so one of those has shingles unless more than spare are empty
            spare = 1 + ceil(empty + 2 * sqrt(empty))
            self.parts.append((differ + 1 + spare, spare) if differ else (0, 0))
            self.starts.append(high)

    def of(self, n: int) -> list[tuple[int, int, int]]:
        """(class, parts, spare) for each class in which a set of ``n`` shingles is posted: its
        own, and the next one, where a larger partner may be. Where linked sets must be equal, none."""
        self._grow(100 * n // self.least + 1)
        k = int(np.searchsorted(self.starts, n, "right")) - 1
        return [(c, *self.parts[c]) for c in (k, k + 1) if self.parts[c][0]]


def keys_of(tokens: np.ndarray, classes: Classes) -> np.ndarray:
    """The buckets of a set. Two sets that link share one at least.

    A key is a class, a part and the sum of the part's mixed hashes. Empty parts have
    no bucket; a set with more empty parts than a class can spare is found by the
    shingles of its prefix instead (two linked sets share one there), as any partner
    without so many empty parts meets it in a part anyway.
    """
    out, mixed = [], _mix(tokens)
    for c, parts, spare in classes.of(len(tokens)):
        part = ((tokens >> _U(32)) * _U(parts)) >> _U(32)
        starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        out.append(_mix(np.add.reduceat(mixed, starts) + (part[starts] + _U(1)) * _U(0x9E3779B97F4A7C15) + _U(c << 40)))
        if parts - len(starts) > spare:
            prefix = tokens[: len(tokens) - -(-classes.least * len(tokens) // 100) + 1]
            out.append(_mix(prefix ^ _U((c + 1) << 50)))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def sets_of(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(id, h, n, sid, sketch): the text's hash, the size of the set, its hash and its sketch (null if it is empty)."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *(T.StructField(c, T.LongType()) for c in ("h", "n", "sid")), T.StructField("sketch", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words()
        for b in slices(batches):
            sets = [shingle_set(t, words, known) for t in b.column(2).to_pylist()]
            found = [pa.array([len(s) for s in sets], pa.int64()), *(pa.array([f(s) if len(s) else None for s in sets], t) for f, t in ((set_hash, pa.int64()), (sketch_of, pa.binary())))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *found], names=schema.names)

    return docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text_or_empty(f"`{text_col}`")), text_or_empty(f"`{text_col}`").cast("binary")).mapInArrow(run, schema)


def _once(seen: set, sid: int) -> bool:
    """True the first time; what a task has seen is forgotten in time, which repeats work but loses nothing."""
    if sid in seen:
        return False
    if len(seen) >= SEEN:
        seen.clear()
    seen.add(sid)
    return True


def postings(docs: DataFrame, text_col: str, words: int, least: int) -> DataFrame:
    """(key, sid): a row for each bucket of each set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, seen, known = Classes(least), set(), Words()
        for b in slices(batches):
            keys, sids = [], []
            for t in b.column(0).to_pylist():
                tokens = shingle_set(t, words, known)
                if len(tokens) and _once(seen, sid := set_hash(tokens)):
                    keys.append(keys_of(tokens, classes))
                    sids.append(np.full(len(keys[-1]), sid, np.int64))
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(sids))], names=["key", "sid"])

    return docs.select(text_or_empty(f"`{text_col}`").cast("binary")).mapInArrow(run, "key long, sid long")


def shared_buckets(rows: DataFrame) -> DataFrame:
    """(key, sid, centre): the buckets with two or more sets; the centre is the smallest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, 3), np.int64)  # the last row, which may be alone yet: key, sid, centre
        joined = False  # it has been joined by an earlier row of its key
        for b in batches:
            if not b.num_rows:
                continue
            key = np.concatenate([held[:, 0], b.column(0).to_numpy()])
            sid = np.concatenate([held[:, 1], b.column(1).to_numpy()])
            fresh = np.r_[True, (key[1:] != key[:-1]) | (sid[1:] != sid[:-1])]
            key, sid = key[fresh], sid[fresh]
            first = np.r_[True, key[1:] != key[:-1]]
            centre = sid[np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))]
            if len(held):
                centre[key == held[0, 0]] = held[0, 2]
            with_last = ~first
            with_last[0] = joined
            live = with_last | np.r_[~first[1:], False]
            held, joined = np.array([[key[-1], sid[-1], centre[-1]]]), bool(with_last[-1])
            live[-1] = False
            if live.any():
                yield _triples(key[live], sid[live], centre[live])
        if joined:
            yield _triples(*held.T)

    return rows.repartition("key").sortWithinPartitions("key", "sid").mapInArrow(run, "key long, sid long, centre long")


def _triples(*columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "sid", "centre"])


def _filter_of(hashes: DataFrame, bits: int = FILTER_BITS) -> bytes:
    """A bit for each hash, by its last bits: at most 8 MB, whatever the input."""
    at = F.col("h").bitwiseAND(F.lit(bits - 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, own = None, np.zeros(_CHUNK_BITS, bool)
        for b in batches:
            at = b.column(0).to_numpy()
            for c in np.unique(at // _CHUNK_BITS):
                if chunk is not None and c != chunk:
                    yield packed(chunk, own)
                    own[:] = False
                chunk = c
                own[at[at // _CHUNK_BITS == c] % _CHUNK_BITS] = True
        if chunk is not None:
            yield packed(chunk, own)

    def packed(chunk: int, own: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([np.packbits(own, bitorder="little").tobytes()], pa.binary())], names=["chunk", "own"])

    out = np.zeros(bits // 8, np.uint8)
    rows = hashes.select(at.alias("at")).distinct().repartition(F.floor(F.col("at") / _CHUNK_BITS)).sortWithinPartitions("at").mapInArrow(run, "chunk long, own binary")
    for r in rows.collect():  # at most bits / _CHUNK_BITS rows
        own = np.frombuffer(r.own, np.uint8)
        out[r.chunk * len(own) : (r.chunk + 1) * len(own)] |= own
    return out.tobytes()


def wanted_sets(docs: DataFrame, text_col: str, hashes: DataFrame, words: int) -> DataFrame:
    """(sid, n, tokens): the sets of texts with these hashes, and a few more that the filter lets pass.

    Texts stay where they are: a filter of fixed size goes to them, and only the sets
    that pass are shuffled. Tokens are big-endian, so Spark orders them as a prefix tree.
    """
    spark = docs.sparkSession
    kept = spark.sparkContext.broadcast(_filter_of(hashes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen, known = np.frombuffer(kept.value, np.uint8), set(), Words()
        for b in slices(batches):
            at = b.column(0).to_numpy() & (8 * len(bits) - 1)
            rows = b.filter(pa.array((bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)))
            sets = [shingle_set(t, words, known) for t in rows.column(1).to_pylist()]
            sets = [(sid, s) for s in sets if len(s) and _once(seen, sid := set_hash(s))]
            if sets:
                yield pa.RecordBatch.from_arrays([
                    pa.array([x for x, _ in sets], pa.int64()), pa.array([len(s) for _, s in sets], pa.int64()),
                    pa.array([s.astype(">u8").tobytes() for _, s in sets], pa.binary())], names=["sid", "n", "tokens"])

    texts = docs.select(F.xxhash64(text_or_empty(f"`{text_col}`")).alias("h"), text_or_empty(f"`{text_col}`").cast("binary").alias("t"))
    return texts.mapInArrow(run, "sid long, n long, tokens binary").dropDuplicates(["sid"])


def _roots(sids: DataFrame, links: DataFrame) -> DataFrame:
    """(sid, root) of all ``sids``."""
    found = components(links)
    return sids.join(found, sids["sid"] == found["node"], "left").select("sid", F.coalesce("root", "sid").alias("root"))


class Tree:
    """A prefix tree of sets as arrays of nodes, shingles in the tree's order: rare ones first.

    A node is a piece of a branch; nodes are numbered level by level. ``walk`` goes down
    with a centre, all branches of a level at once: a node's overlap is its parent's and
    that of its own piece, and a branch ends where no set below can reach the threshold.
    As rare shingles come first, the shingles that two sets don't share mostly do, and
    most branches end at their first piece.
    """

    def __init__(self, sets: list[np.ndarray], least: int = LEAST):
        self.least = least
        self.vocabulary, ids, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        self.rank = np.empty(len(count), np.int32)
        self.rank[np.lexsort((self.vocabulary, count))] = np.arange(len(count))
        self.single = int((count == 1).sum())  # these ranks are of one set each
        ends = np.cumsum([len(s) for s in sets])[:-1]
        sets = [np.sort(x) for x in np.split(self.rank[ids], ends)]
        order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u4").tobytes())
        parent, begin, end, rep, leaf = [-1], [0], [0], [0], [-1]
        stack = [(0, 0)]  # (depth, node) of the branch down to the last set
        for k, i in enumerate(order):
            tokens, common = sets[i], 0
            if k:
                last = sets[order[k - 1]]
                n = min(len(last), len(tokens))
                differ = np.flatnonzero(last[:n] != tokens[:n])
                common = int(differ[0]) if len(differ) else n
            popped = None
            while stack[-1][0] > common:
                popped = stack.pop()[1]
            if stack[-1][0] < common:  # the branch forks within a piece
                parent.append(stack[-1][1]), begin.append(begin[popped]), end.append(common), rep.append(rep[popped]), leaf.append(-1)
                parent[popped], begin[popped] = len(parent) - 1, common
                stack.append((common, len(parent) - 1))
            parent.append(stack[-1][1]), begin.append(common), end.append(len(tokens)), rep.append(i), leaf.append(i)
            stack.append((len(tokens), len(parent) - 1))
        sizes = np.array([len(s) for s in sets])
        piece = max(PIECE, int(sizes.max()) // 32)
        for node in range(1, len(parent)):  # long branches in pieces, so that they end early
            while end[node] - begin[node] > piece:
                parent.append(parent[node]), begin.append(begin[node]), end.append(begin[node] + piece), rep.append(rep[node]), leaf.append(-1)
                parent[node], begin[node] = len(parent) - 1, begin[node] + piece
        parent, begin, end, rep, leaf = (np.array(x) for x in (parent, begin, end, rep, leaf))
        level, frontier = np.zeros(len(parent), np.int64), np.array([0])
        children = np.argsort(parent, kind="stable")
        first = np.searchsorted(parent[children], np.arange(len(parent) + 1))
        levels = []
        while len(frontier):
            levels.append(frontier)
            level[frontier] = len(levels)
            frontier = children[_ranges(first[frontier], first[frontier + 1])]
        by = np.concatenate(levels)
        new = np.empty(len(by), np.int64)
        new[by] = np.arange(len(by))
        self.leaf, self.depth = leaf[by], end[by]
        parent = np.where(parent[by] >= 0, new[np.maximum(parent[by], 0)], -1)
        self.first = np.searchsorted(parent, np.arange(len(by) + 1))  # children of a node stand together
        starts = np.concatenate([[0], np.cumsum(end[by] - begin[by])])
        self.tokens = np.empty(starts[-1], np.int32)
        for at, node in zip(starts, by, strict=False):
            own = sets[rep[node]][begin[node] : end[node]]
            self.tokens[at : at + len(own)] = own
        self.starts, self.sizes = starts, sizes
        self.last = np.where(end[by] > begin[by], self.tokens[np.maximum(starts[1:] - 1, 0)], -1)
        low = np.where(self.leaf >= 0, sizes[np.maximum(self.leaf, 0)], np.iinfo(np.int64).max)
        high = np.where(self.leaf >= 0, sizes[np.maximum(self.leaf, 0)], 0)
        for nodes in reversed(levels[1:]):
            at = new[nodes]
            np.minimum.at(low, parent[at], low[at])
            np.maximum.at(high, parent[at], high[at])
        self.low, self.high = low, high
        # of each branch below the root, the shingles that no other set of the tree has, and whose those are
        self.top = np.arange(self.first[0], self.first[1])
        own = [sets[rep[by[n]]] for n in self.top]
        self.alone = np.array([int(np.searchsorted(s, self.single)) for s in own], np.int64)
        self.owner = np.zeros(self.single, np.int32)
        for k, (s, n) in enumerate(zip(own, self.alone, strict=True)):
            self.owner[s[:n]] = k
        self.mark = np.zeros(len(self.vocabulary), np.int8)

    def walk(self, centre: np.ndarray, member: bool = False) -> np.ndarray:
        """The sets (their places in the given list) that link with ``centre``; one that is a
        ``member`` of the tree isn't in its own result, nor need be met."""
        at = np.minimum(np.searchsorted(self.vocabulary, centre), len(self.vocabulary) - 1)
        known = np.sort(self.rank[at[self.vocabulary[at] == centre]])
        c, found, single = len(centre), [], int(np.searchsorted(known, self.single))
        # before any branch: what a set has alone meets the centre only where the centre has it
        met = 0 if member else np.bincount(self.owner[known[:single]], minlength=len(self.top))
        if member:
            known, single = known[single:], 0  # what only the centre has meets nobody
        nodes, left = self.top, len(known) - single
        best = np.clip(self.alone + left, self.low[nodes], self.high[nodes])
        nodes = nodes[(met + np.minimum(best - self.alone, left)) * (100 + self.least) >= self.least * (c + best)]
        unknown = c - len(known)  # the rarest of all
        overlap, gone = np.zeros(len(nodes), np.int64), np.full(len(nodes), unknown)
        self.mark[known] = 1
        while len(nodes):
            lengths = self.starts[nodes + 1] - self.starts[nodes]
            hits = np.concatenate([[0], np.cumsum(self.mark[self.tokens[_ranges(self.starts[nodes], self.starts[nodes + 1])]], dtype=np.int64)])
            ends = np.cumsum(lengths)
            overlap = overlap + hits[ends] - hits[ends - lengths]
            gone = np.where(lengths > 0, unknown + np.searchsorted(known, self.last[nodes], "right"), gone)
            depth, left = self.depth[nodes], c - gone
            best = np.clip(depth + left, self.low[nodes], self.high[nodes])  # the size below with the best chance
            alive = (overlap + np.minimum(best - depth, left)) * (100 + self.least) >= self.least * (c + best)
            nodes, overlap, gone = nodes[alive], overlap[alive], gone[alive]
            own = self.leaf[nodes]
            size = self.sizes[np.maximum(own, 0)]
            linked = (own >= 0) & (100 * overlap >= self.least * (c + size - overlap)) & (self.depth[nodes] == size)
            found.append(own[linked])
            width = self.first[nodes + 1] - self.first[nodes]
            overlap, gone = np.repeat(overlap, width), np.repeat(gone, width)
            nodes = _ranges(self.first[nodes], self.first[nodes + 1])
        self.mark[known] = 0
        return np.concatenate(found) if found else np.zeros(0, np.int64)


def _ranges(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """begin[0] .. end[0] - 1, begin[1] .. end[1] - 1 and so on."""
    lengths = end - begin
    return np.repeat(begin - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum()) if len(lengths) else np.zeros(0, np.int64)


def span(tree: Tree, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links (of places) that connect a tree's sets as all its links would.

    Sets walk until those that haven't are all of one component: any link that is
    left lies within it.
    """
    root = list(range(len(sets)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    links, size, main, waiting = [], dict.fromkeys(root, 1), 0, list(range(len(sets)))
    while True:
        left = []  # of the largest component when their turn came
        for i in waiting:
            if find(i) == find(main):
                left.append(i)
                continue
            for j in tree.walk(sets[i], member=True):
                a, b = find(i), find(int(j))
                if a != b:
                    root[a] = b
                    size[b] += size.pop(a)
                    links.append((i, int(j)))
            if size[find(i)] > size[find(main)]:
                main = i
        if all(find(i) == find(main) for i in left):
            return links
        waiting = left


def _folded(sketches: np.ndarray) -> np.ndarray:
    """The sketches (rows of words) with half as many blocks."""
    half = sketches.shape[-1] // 2
    return sketches[..., :half] ^ sketches[..., half:]


def likely(sizes: np.ndarray, sketches: list[bytes], least: int = LEAST) -> list[tuple[int, int]]:
    """Links (of places) that connect all sets that can link by their sizes and sketches."""
    widths = np.array([len(x) // 8 for x in sketches])
    waiting = {}  # of each width, the places that no other has been found to link with, and their sketches
    for w in np.unique(widths).tolist():
        places = np.flatnonzero(widths == w)
        waiting[w] = places, np.frombuffer(b"".join(sketches[i] for i in places), "<u8").reshape(-1, w)
    links, compared = [], 0
    for start in range(len(sizes)):
        places, own = waiting[widths[start]]
        at = int(np.searchsorted(places, start))
        if at == len(places) or places[at] != start:
            continue
        waiting[widths[start]] = np.delete(places, at), np.delete(own, at, 0)
        frontier = [start]
        while frontier:
            i = frontier.pop()
            w, n, x = int(widths[i]), sizes[i], np.frombuffer(sketches[i], "<u8")
            for other in (w // 2, w, 2 * w):
                places, own = waiting.get(other, ((), None))
                if not len(places):
                    continue
                a, b = (_folded(own) if other > w else own), (_folded(x) if other < w else x)
                compared += a.size
                both = sizes[places] + n
                most = both - 2 * needed(sizes[places], n, least)  # shingles that only one of them has
                near = (np.abs(sizes[places] - n) <= most) & (np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64) <= most)
                if near.any():
                    found = places[near].tolist()
                    links += [(i, j) for j in found]
                    frontier += found
                    waiting[other] = places[~near], own[~near]
            if compared > COMPARED:
                return links + [(i, int(j)) for places, _ in waiting.values() for j in places] + [(i, start)] * (i != start)
    return links


def likely_links(stars: DataFrame, least: int) -> DataFrame:
    """(u, v): links that connect the sets of each star (those that meet in buckets of one
    centre) as all pairs would whose sketches let them link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sids, sizes, sketches = None, [], [], []
        for b in slices(batches):
            for c, sid, n, sketch in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                if c != now:
                    yield from out(sids, sizes, sketches)
                    now, sids, sizes, sketches = c, [], [], []
                sids.append(sid)
                sizes.append(n)
                sketches.append(sketch)
        yield from out(sids, sizes, sketches)

    def out(sids: list[int], sizes: list[int], sketches: list[bytes]) -> Iterator[pa.RecordBatch]:
        links = likely(np.array(sizes), sketches, least) if len(sids) > 1 else []
        if links:
            yield pa.RecordBatch.from_arrays([pa.array([sids[i] for i, _ in links], pa.int64()), pa.array([sids[j] for _, j in links], pa.int64())], names=["u", "v"])

    rows = stars.select("centre", "sid", "n", "sketch")
    return rows.repartition("centre").sortWithinPartitions("centre").mapInArrow(run, "u long, v long")


def clusters_of(buckets: DataFrame, nodes: DataFrame, least: int) -> DataFrame:
    """(sid, cluster, tree): the sets that likely links connect, dealt to trees of about ``TREE`` shingles."""
    stars = buckets.select("centre", "sid").distinct().join(nodes.select("sid", "n", "sketch"), "sid")
    edges = stage(likely_links(stars, least), "jaccard-likely")
    found = stage(components(edges).select(F.col("node").alias("sid"), F.col("root").alias("cluster")).join(nodes.select("sid", "n"), "sid"), "jaccard-found")
    trees = found.groupBy("cluster").agg(F.ceil(F.sum("n") / TREE).alias("trees"))
    return found.join(trees, "cluster").select("sid", "cluster", "trees", F.pmod(F.xxhash64("sid"), F.col("trees")).alias("tree"))


def _tokens(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), ">u8").astype(np.uint64) for x in column]


def own_links(dealt: DataFrame, least: int) -> DataFrame:
    """(u, v): links that connect each tree's sets as all links within it would."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sids, sets = None, [], []
        for b in slices(batches):
            for c, t, sid, tokens in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), _tokens(b.column(3)), strict=True):
                if (c, t) != now:
                    yield from out(sids, sets)
                    now, sids, sets = (c, t), [], []
                sids.append(sid)
                sets.append(tokens)
        yield from out(sids, sets)

    def out(sids: list[int], sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        links = span(Tree(sets, least), sets) if len(sets) > 1 else []
        if links:
            yield pa.RecordBatch.from_arrays([pa.array([sids[i] for i, _ in links], pa.int64()), pa.array([sids[j] for _, j in links], pa.int64())], names=["u", "v"])

    rows = dealt.select("cluster", "tree", "sid", "tokens")
    return rows.repartition("cluster", "tree").sortWithinPartitions("cluster", "tree").mapInArrow(run, "u long, v long")


def far_links(dealt: DataFrame, roots: DataFrame, least: int) -> DataFrame:
    """(u, v): links between trees of one cluster, one for each set and component at most.

    Sets outside the cluster's largest component are centres that walk its other trees.
    """
    many = dealt.where("trees > 1").join(roots, "sid")
    main = many.groupBy("cluster", "root").agg(F.count("*").alias("c")).groupBy("cluster").agg(F.max_by("root", F.struct("c", "root")).alias("main"))
    members = many.select("cluster", "tree", F.lit(0).alias("role"), "sid", "root", "tokens")
    others = F.explode(F.filter(F.sequence(F.lit(0).cast("long"), F.col("trees") - 1), lambda t: t != F.col("tree"))).alias("tree")
    centres = many.join(main, "cluster").where("root <> main").select("cluster", others, F.lit(1).alias("role"), "sid", "root", "tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, tree, roots, sids = None, [], None, None, None
        for b in slices(batches):
            u, v = [], []
            for c, t, role, sid, root, tokens in zip(*(b.column(i).to_pylist() for i in range(5)), _tokens(b.column(5)), strict=True):
                if (c, t) != now:
                    now, held, tree = (c, t), [], None
                if role == 0:
                    held.append((sid, root, tokens))
                    continue
                if not held:
                    continue
                if tree is None:
                    tree, roots, sids = Tree([x[2] for x in held], least), np.array([x[1] for x in held]), np.array([x[0] for x in held])
                found = tree.walk(tokens)
                found = found[roots[found] != root]
                if len(found):
                    found = found[np.unique(roots[found], return_index=True)[1]]
                    u.append(np.full(len(found), sid, np.int64))
                    v.append(sids[found])
            if u:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(u)), pa.array(np.concatenate(v))], names=["u", "v"])

    rows = members.unionByName(centres)
    return rows.repartition("cluster", "tree").sortWithinPartitions("cluster", "tree", "role", "sid").mapInArrow(run, "u long, v long")


def near_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, least: int = LEAST) -> DataFrame:
    """One row per document: id, n_shingles, component_id (the smallest id that links reach; null if all ids there are null).

    Sets link if their intersection is at least ``least`` percent of their union. Null
    text counts as empty; documents without words have an empty set and link with
    nothing, repeated rows included. Texts of fewer than ``words`` words are one
    shingle, so only equal ones link. Very long texts are read whole. Repeated rows
    each have a row; copies are one node, so a group of them costs no pairs. Rows that
    share an id share their smallest id only, not a set. Other columns are ignored; an
    empty table gives no rows. Shingles and sets are told apart by 64-bit hashes.
    """
    rows = stage(sets_of(docs, id_col, text_col, words), "jaccard-sets")
    nodes = rows.where("sid IS NOT NULL").groupBy("sid").agg(F.min("id").alias("low"), F.min("h").alias("h"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    nodes = stage(nodes, "jaccard-nodes")
    buckets = stage(shared_buckets(postings(docs, text_col, words, least)), "jaccard-buckets")
    clusters = stage(clusters_of(buckets, nodes, least), "jaccard-clusters")
    sids = clusters.select("sid")
    sets = wanted_sets(docs, text_col, nodes.join(sids, "sid").select("h"), words)
    dealt = stage(sets.join(clusters, "sid"), "jaccard-dealt")
    links = stage(own_links(dealt, least), "jaccard-links")
    roots = stage(_roots(sids, links), "jaccard-roots")
    if not clusters.where("trees > 1").isEmpty():
        far = stage(far_links(dealt, roots, least), "jaccard-far-links")
        u, v = (roots.select(F.col("sid").alias(c), F.col("root").alias(f"{c}_root")) for c in "uv")
        joined = components(far.join(u, "u").join(v, "v").select(F.col("u_root").alias("u"), F.col("v_root").alias("v")))
        roots = stage(roots.join(joined, roots["root"] == joined["node"], "left").select("sid", F.coalesce(joined["root"], roots["root"]).alias("root")), "jaccard-roots")
    of = nodes.join(roots, "sid", "left").select("sid", "low", F.coalesce("root", "sid").alias("root"))
    lows = of.groupBy("root").agg(F.min("low").alias("component_id"))
    of = stage(of.join(lows, "root").select("sid", "component_id"), "jaccard-components")
    linked = rows.where("sid IS NOT NULL").join(of, "sid").select("id", "n", "component_id")
    alone = rows.where("sid IS NULL").select("id", "n", F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")
