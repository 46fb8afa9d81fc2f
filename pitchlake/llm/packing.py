"""Best-fit packing in bulk-synchronous rounds.

Pieces and gaps are range-sorted by size, and within a size by rank. In a round,
every unplaced piece, longest first, is matched with its successor: the smallest
gap that holds it. Where more pieces want a size than it has gaps, those of
lower rank win and the rest go on to the next larger gap; matched gaps shrink
only when the round ends. When no piece fits, the longest open new sequences,
and the rounds go on.

Sizes are whole numbers up to the capacity, and pieces of one size differ by
rank alone, so a round's state is kept as runs (size, count, first rank): at most
a run for each size of piece and a few for each size of gap, however many rows
there are. Spark does what grows with the data: tokens, ranks within each size
(counts by task, then offsets) and the join of ranks to the runs' places.
"""

from __future__ import annotations

import bisect
import functools
import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, stage, text_or_empty

CAPACITY = 2048
#: Id that ends every document.
END_ID = 0
#: Letters that every regular expression engine classes alike; other texts, and
#: those with the special token's string, go through the tokenizer itself.
_PLAIN = re.compile(r"[^\x00-\u024f]|<\|endoftext\|>")


@functools.cache
def _tokenizer(path: str | None):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path or public_tokenizers.path("byte_bpe_50k.json"))


@functools.cache
def _ranks(path: str | None):
    """The same vocabulary as ranks: the same ids, found faster."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode(text: str, tokenizer_path: str | None = None, ranks_path: str | None = None) -> bytes:
    """The tokenizer's ids of a text, as little-endian unsigned 32-bit integers."""
    if (tokenizer_path and not ranks_path) or _PLAIN.search(text):
        return np.array(_tokenizer(tokenizer_path).encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    return _ranks(ranks_path).encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()


def pieces(
    docs: DataFrame, id_col: str, text_col: str, capacity: int, tokenizer_path: str | None, ranks_path: str | None,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, task, rank): the pieces of each document, and
    the task that made it with its rank among the task's pieces of that length."""
    kind = docs.schema[id_col].dataType
    schema = T.StructType(
        [T.StructField("id", kind), T.StructField("piece", T.IntegerType())]
        + [T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "task", "rank")]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, ranks = TaskContext.get().partitionId(), defaultdict(int)
        for b in slices(batches):
            rows: list[list] = [[] for _ in schema]
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids = encode(text, tokenizer_path, ranks_path) + END_ID.to_bytes(4, "little")
                n = len(ids) // 4
                ends = list(range(n % capacity or capacity, n + 1, capacity))
                for k, (a, e) in enumerate(zip([0, *ends], ends, strict=False)):
                    for out, v in zip(rows, (doc, k, a, e - a, zlib.crc32(ids[4 * a : 4 * e]), task, ranks[e - a]), strict=True):
                        out.append(v)
                    ranks[e - a] += 1
            types = [b.column(0).type, pa.int32(), *[pa.int64()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows, types, strict=True)], names=schema.names)

    return docs.select(F.col(id_col).alias("id"), text_or_empty(text_col)).mapInArrow(cut, schema)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Places of all pieces: (length, first rank, count, first sequence, offset).

    A run of places puts the pieces of consecutive ranks into consecutive
    sequences at one offset.
    """
    waiting = {s: [0, n] for s, n in counts.items() if n}  # length -> next rank, pieces left
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> runs (first sequence, count)
    places, sequences = [], 0
    while waiting:
        moved: dict[int, list[tuple[int, int]]] = defaultdict(list)
        sizes = sorted(gaps)
        # the sweep: longest pieces first, each to the smallest gap that is left and holds it
        for s in sorted(waiting, reverse=True):
            rank, left = waiting[s]
            at = bisect.bisect_left(sizes, s)
            while left and at < len(sizes):
                g = sizes[at]
                while left and gaps[g]:
                    base, n = gaps[g].pop()
                    take = min(n, left)
                    places.append((s, rank, take, base, capacity - g))
                    if take < n:
                        gaps[g].append((base + take, n - take))
                    if g > s:
                        moved[g - s].append((base, take))
                    rank, left = rank + take, left - take
                if not gaps[g]:
                    del gaps[g], sizes[at]
            if left:
                waiting[s] = [rank, left]
            else:
                del waiting[s]
        if not moved and waiting and not any(g >= min(waiting) for g in gaps):
            # Nothing fits: the longest pieces open sequences. Those over half the
            # capacity need one each; of the rest as many as their tokens fill.
            large = [s for s in sorted(waiting, reverse=True) if 2 * s > capacity]
            rest = [s for s in sorted(waiting, reverse=True) if 2 * s <= capacity]
            fill = sum(s * waiting[s][1] for s in rest)
            opening = [(s, waiting[s][1]) for s in large]
            if not opening:
                need = -(-fill // capacity)
                for s in rest:
                    if not need:
                        break
                    take = min(need, waiting[s][1])
                    opening.append((s, take))
                    need -= take
            for s, n in opening:
                rank, left = waiting[s]
                places.append((s, rank, n, sequences, 0))
                if s < capacity:
                    moved[capacity - s].append((sequences, n))
                sequences += n
                if left == n:
                    del waiting[s]
                else:
                    waiting[s] = [rank + n, left - n]
        for g, runs in moved.items():
            gaps.setdefault(g, []).extend(runs)
    return places


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, tokenizer_path: str | None = None,
    ranks_path: str | None = None,
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids and an end id; one longer than ``capacity`` is cut so
    that all pieces but the first are full. Null text counts as empty (the end id
    alone). ``ranks_path`` names the vocabulary of ``tokenizer_path`` as a rank file,
    for speed. Null ids and repeated rows are documents of their own; other columns
    are ignored; an empty table gives no pieces.
    """
    rows = stage(pieces(docs, id_col, text_col, capacity, tokenizer_path, ranks_path), "pieces")
    by_task = rows.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stage(by_task.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "piece-offsets")
    # at most ``capacity`` rows
    counts = {r.length: r.n for r in offsets.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = sorted(plan(counts, capacity))
    # a few runs for each length and round, whatever the number of rows
    lengths, ranks, _, firsts, at = (np.array(c, np.int64) for c in (zip(*places, strict=True) if places else [[]] * 5))
    starts = np.searchsorted(lengths, np.arange(capacity + 2))
    shared = docs.sparkSession.sparkContext.broadcast((starts, ranks, firsts, at))
    given = rows.join(offsets.select("length", "task", "before"), ["length", "task"]).select(
        "id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("rank"))
    out = [id_col, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    schema = T.StructType(
        [T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("piece", T.IntegerType())]
        + [T.StructField(n, T.LongType()) for n in out[2:]]
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, ranks, firsts, at = shared.value
        by_length: dict[int, tuple] = {}
        for b in batches:
            length, rank = (b.column(i).to_numpy() for i in (3, 5))
            run = np.empty(len(length), np.int64)
            for s in np.unique(length):
                mine = length == s
                if s not in by_length:
                    by_length[s] = ranks[starts[s] : starts[s + 1]]
                run[mine] = starts[s] + np.searchsorted(by_length[s], rank[mine], "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:5], pa.array(firsts[run] + rank - ranks[run], pa.int64()), pa.array(at[run], pa.int64())], names=out)

    return given.mapInArrow(place, schema)
