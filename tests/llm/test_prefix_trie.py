"""The prefix trie against plain loops."""

import random
from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import types as T

from pitchlake.llm import prefix_trie

from .data import SF001

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
CLASH = ("c", "pos", "digest", "bytes", "id", "low", "seg", "t", "a.b")


def table(spark, rows):
    schema = T.StructType([*SCHEMA.fields, *(T.StructField(n, T.StringType()) for n in CLASH)])
    return spark.createDataFrame([(*r, *["?"] * len(CLASH)) for r in rows], schema).repartition(3)


def turn_key(t, role, text):
    role, text = (role or "").encode(), (text or "").encode()
    return (t is not None, t or 0, sha256(str(len(role)).encode() + b":" + role + text).digest()[:16])


def remainder(c, n):
    return c - n * int(c / n)


def rebuild(rows):
    convs = {}
    for c, t, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn_key(t, role, text), (role or "", text or "")))
    own = {c: [x for _, x in sorted(v)] for c, v in convs.items()}
    out = {}
    for c, turns in own.items():
        h = crc32(str(c).encode()) % 9
        out[c] = own.get(c - remainder(c, 5), [])[:h] + turns[h:]
    return out


def brute(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    sums = {}
    for p in sorted(members, key=len, reverse=True):
        below = [sums[k] for k in kids.get(p, [])]
        own = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        sums[p] = (sum(b[0] for b in below) or (0 if below else 1), sum(b[1] for b in below) + own)
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if len(convs[c]) == len(p)))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids.get(p, [])), *sums[p], sha256(ends.encode()).hexdigest()))
    return out


def check(spark, rows, **kw):
    got = sorted(map(tuple, prefix_trie.prefix_trie(table(spark, rows), **kw).collect()), key=repr)
    want = sorted(brute(rebuild(rows)), key=repr)
    assert got == want
    return got


def test_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/conversations.parquet").select(*SCHEMA.names).collect()]
    assert len(check(spark, rows)) > 30


def test_edge_rows(spark):
    rows = [
        (0, 0, "user", "a"), (0, 1, "bot", "b"), (0, 2, None, None), (0, 2, "", ""), (0, None, "user", "first"), (0, 3, "u", "ser"), (0, 3, "us", "er"),
        (1, 0, "user", "x"), (1, 0, "user", "x"), (1, 1, "user", "ñandú 漢字"), (2, 5, "user", "long " * 50_000), (3, 0, "user", ""), (4, 0, "user", "a"),
        (7, 0, "user", "no base"), (-3, 0, "user", "negative"), (-5, 1, "user", "negative base"), (None, 0, "user", "no conversation"), (None, None, None, None),
        (11, 0, "user", "a"), (12, 0, "user", "a"),
    ]
    check(spark, rows)


def test_empty(spark):
    assert prefix_trie.prefix_trie(table(spark, [])).collect() == []


@pytest.mark.parametrize("seed", [1, 2])
def test_branching_within_and_between_blocks(spark, monkeypatch, seed):
    rng, rows = random.Random(seed), []
    stem = [("user", f"s{i}") for i in range(40)]
    for c in range(60):
        cut = rng.choice([0, 1, 7, 8, 9, 15, 16, 17, 31, 40])
        turns = stem[:cut] + [("bot", rng.choice("ab") * rng.randint(1, 2)) for _ in range(rng.randint(0, 12))]
        rows += [(c, i, *x) for i, x in enumerate(turns)] or [(c, 0, "user", "only")]
    monkeypatch.setattr(prefix_trie, "SEGMENT", 3)
    got = check(spark, rows, size=(8, 3)[seed - 1])
    assert max(r[1] for r in got) > 24


def test_hot_copies(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 40)
    rows = [(c, t, "user", f"{t}") for c in range(0, 300) for t in range(10)] + [(c, t, "user", f"{t % 3}") for c in range(300, 340) for t in range(3)]
    check(spark, rows)


def test_chains_that_hang_on_each_other(spark):
    rows = [(5 * c, t, "user", f"{min(t, c)}" if t <= c else "end") for c in range(25) for t in range(c + 2)]
    check(spark, rows)
