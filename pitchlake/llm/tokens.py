"""Token counts from pre-token frequencies.

Pieces of the vocabulary never hold a space after another character, nor a
newline, so merges stay inside pre-tokens and a text's token count is the sum of
its pre-tokens' counts. Documents are read once into blocks that hold, for each
document, pre-token codes and frequencies, and the block's distinct pre-tokens
dealt by hash. Pre-tokens of one hash meet in one task, which counts the pieces
of each distinct one once; the counts travel back to the blocks and are summed.
Only integers travel for a document; token ids never exist.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import partitions, slices, stage, text_or_empty

#: UTF-8 bytes of text in a block (a longer document is a block of its own).
BLOCK_BYTES = 12_000_000

_BOUNDARY = re.compile(r"(?<=[^ ]) ")


@functools.cache
def _processor(path: str | None):
    import public_tokenizers
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))


def pre_tokens(text: str) -> list[str]:
    """The pre-tokens of a text that isn't empty. A boundary space is dropped (the
    library puts one in front of every input); pre-tokens after a newline keep it."""
    text = text.replace("▁", " ")  # the vocabulary's own sign for a space
    out: list[str] = []
    for i, line in enumerate(text.split("\n")):
        if "  " in line or (not i and line[:1] == " "):
            out += _BOUNDARY.split("\n" + line if i else line)
        else:
            parts = line.split(" ")
            if i:
                parts[0] = "\n" + parts[0]
            out += parts
    return out


def piece_counts(sp, words: list[str]) -> list[int]:
    """Pieces of each pre-token: the library's, less the space that it puts before a newline."""
    return [len(ids) - (w[:1] == "\n") if w else 1 for w, ids in zip(words, sp.encode(words, num_threads=1), strict=True)]


class _Codes(dict):
    def __missing__(self, word: str) -> int:
        self[word] = code = len(self)
        return code


def _planes(values: np.ndarray) -> bytes:
    """Compressed, bytes of equal weight together: the high ones are nearly all zero."""
    return zlib.compress(values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _steps(values: np.ndarray) -> bytes:
    """Ascending runs as differences (modulo 2**32 where a run starts)."""
    return _planes(np.diff(values.astype("<u4"), prepend=np.zeros(1, "<u4")))


def _from_steps(data: bytes) -> np.ndarray:
    return np.cumsum(_from_planes(data), dtype="<u4")


def _words(words: list[str]) -> bytes:
    """Compressed lengths and letters; the words are sorted, so neighbours share their starts."""
    coded = [w.encode() for w in words]
    return zlib.compress(np.array([len(words), *map(len, coded)], "<u4").tobytes() + b"".join(coded), 1)


def _from_words(data: bytes) -> list[str]:
    data = zlib.decompress(data)
    n = int.from_bytes(data[:4], "little")
    ends = 4 * (n + 1) + np.cumsum(np.frombuffer(data, "<u4", n, 4), dtype=np.int64)
    starts = [4 * (n + 1), *ends.tolist()]
    return [data[a:b].decode() for a, b in zip(starts, starts[1:], strict=False)]


_PART = pa.list_(pa.struct([("part", pa.int32()), ("start", pa.int32()), ("words", pa.binary())]))


def _pack(batches: Iterator[pa.RecordBatch], block_bytes: int, n_parts: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    """One row for each block of documents."""
    task, k = TaskContext.get().partitionId(), 0
    ids, sizes, codes, words, total = [], [], [], _Codes(), 0

    def block() -> pa.RecordBatch:
        vocabulary = sorted(words)
        parts = np.fromiter((zlib.crc32(w.encode()) % n_parts for w in vocabulary), np.int64, len(vocabulary))
        order = np.argsort(parts, kind="stable")
        code_of = np.empty(len(words), np.int64)  # by the code in order of appearance
        code_of[np.fromiter((words[vocabulary[i]] for i in order), np.int64, len(order))] = np.arange(len(order))
        lengths = np.fromiter(map(len, codes), np.int64, len(codes))
        keys = np.repeat(np.arange(len(codes)), lengths) << 32
        if len(keys):
            keys += code_of[np.concatenate(codes)]
        keys, freqs = np.unique(keys, return_counts=True)
        ends = np.cumsum(np.bincount(keys >> 32, minlength=len(codes)))
        cuts = np.flatnonzero(np.diff(parts[order], prepend=-1)).tolist() + [len(order)]
        dealt = [
            {"part": int(parts[order[a]]), "start": a, "words": _words([vocabulary[i] for i in order[a:b]])}
            for a, b in zip(cuts, cuts[1:], strict=False) if b > a
        ]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([(task << 32) + k], pa.int64()), pa.array([ids], pa.list_(id_type)), pa.array([sizes], pa.list_(pa.int64())),
                pa.array([ends.tolist()], pa.list_(pa.int32())), pa.array([_steps(keys & 0xFFFFFFFF)], pa.binary()),
                pa.array([_planes(freqs)], pa.binary()), pa.array([dealt], _PART),
            ],
            names=names,
        )

    id_type = None
    for b in slices(batches):
        id_type = b.column(0).type
        for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            found = pre_tokens(text) if text else []
            ids.append(doc)
            sizes.append(len(text.encode()))
            codes.append(np.fromiter(map(words.__getitem__, found), np.int64, len(found)))
            total += sizes[-1]
            if total >= block_bytes:
                yield block()
                k += 1
                ids, sizes, codes, words, total = [], [], [], _Codes(), 0
    if ids:
        yield block()


def _count(batches: Iterator[pa.RecordBatch], model_path: str | None) -> Iterator[pa.RecordBatch]:
    """Pieces of the pre-tokens of a part of a block; each distinct one is encoded once."""
    sp, known = _processor(model_path), {}
    for b in slices(batches):
        counts = []
        for part, words in zip(b.column(1).to_pylist(), b.column(3).to_pylist(), strict=True):
            cache, words = known.setdefault(part, {}), _from_words(words)
            if new := [w for w in words if w not in cache]:
                cache.update(zip(new, piece_counts(sp, new), strict=True))
            counts.append(np.fromiter(map(cache.__getitem__, words), "<u4", len(words)))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(2), pa.array([_planes(c) for c in counts], pa.binary())], names=["block", "start", "counts"]
        )


def _sum(batches: Iterator[pa.RecordBatch], limit: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Tokens of a block's documents: frequencies times counts."""
    for batch in batches:
        for i in range(batch.num_rows):
            ids, sizes, ends, codes, freqs, counted = (c.slice(i, 1) for c in batch.columns)
            ends_ = np.array(ends[0].as_py(), np.int64)
            parts = sorted((counted[0].as_py() or []), key=lambda p: p["start"])
            counts = np.concatenate([_from_planes(p["counts"]) for p in parts] or [np.zeros(0, "<u4")]).astype(np.int64)
            sums = np.concatenate([[0], np.cumsum(counts[_from_steps(codes[0].as_py())] * _from_planes(freqs[0].as_py()))])
            starts = np.concatenate([[0], ends_[:-1]])
            n = sums[ends_] - sums[starts]
            yield pa.RecordBatch.from_arrays(
                [ids.flatten(), sizes.flatten(), pa.array(n, pa.int64()), pa.array(n > limit, pa.bool_())], names=names
            )


def count_tokens(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_path: str | None = None,
    limit: int = 4096, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document: id, n_bytes (UTF-8), n_tokens, over_limit.

    Null text counts as empty: 0 bytes, 0 tokens. Null ids and repeated rows pass
    through, one output row for each input row; other columns are ignored.
    A hot pre-token has one entry for each block, however often it occurs.
    """
    spark = docs.sparkSession
    n_parts = 4 * partitions(spark)
    kind = docs.schema[id_col].dataType
    longs, part = T.ArrayType(T.LongType()), T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("start", T.IntegerType()),
        T.StructField("words", T.BinaryType()),
    ])
    packed = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(kind)), T.StructField("sizes", longs),
        T.StructField("ends", T.ArrayType(T.IntegerType())), T.StructField("codes", T.BinaryType()),
        T.StructField("freqs", T.BinaryType()), T.StructField("parts", T.ArrayType(part)),
    ])
    names = packed.names
    blocks = stage(
        docs.select(F.col(id_col), text_or_empty(text_col))
        .mapInArrow(lambda it: _pack(it, block_bytes, n_parts, names), packed), "token-blocks",
    )
    counted = (
        blocks.select("block", F.explode("parts").alias("p")).select("block", "p.part", "p.start", "p.words")
        .repartition(partitions(spark), "part")
        .mapInArrow(lambda it: _count(it, model_path), "block long, start int, counts binary")
        .groupBy("block").agg(F.collect_list(F.struct("start", "counts")).alias("counted"))
    )
    out = [id_col, "n_bytes", "n_tokens", "over_limit"]
    result = T.StructType([
        T.StructField(id_col, kind), T.StructField(out[1], T.LongType()), T.StructField(out[2], T.LongType()),
        T.StructField(out[3], T.BooleanType()),
    ])
    return (
        blocks.drop("parts").join(counted, "block", "left").select("ids", "sizes", "ends", "codes", "freqs", "counted")
        .mapInArrow(lambda it: _sum(it, limit, out), result)
    )
