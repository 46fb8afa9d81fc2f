"""The Merkle manifest against plain loops."""

from hashlib import sha256
from zlib import crc32

import pytest

from pitchlake.llm import merkle

from .data import SF001, edge_docs, empty_docs, read_docs


def h(*xs):
    return sha256("".join(xs).encode()).hexdigest()


def leaf(row):
    out = ""
    for c in merkle.FIELDS:
        out += "-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}"
    return h(out)


def fold(nodes):
    """All levels, and each start node's siblings on the way."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def way(levels, i):
    out = []
    for row in levels[:-1]:
        j = i ^ 1
        out.append((j < i, row[j]) if j < len(row) else None)
        i >>= 1
    return out


def walk(digest, path):
    for step in path:
        digest = h(digest) if step is None else h(step[1], digest) if step[0] else h(digest, step[1])
    return digest


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append((r, leaf(r)))
    order = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    for g in order:
        groups[g].sort(key=lambda x: (x[0]["doc_id"] is not None, x[0]["doc_id"] or 0, x[1]))
    trees = {g: fold([x[1] for x in groups[g]]) for g in order}
    top = fold([trees[g][-1][0] for g in order])
    out = []
    for k, g in enumerate(order):
        for i, (r, d) in enumerate(groups[g]):
            path = way(trees[g], i) + way(top, k)
            t = dict(r)
            if r["doc_id"] is not None and r["n_chars"] is not None and crc32(str(r["doc_id"]).encode()) % 7 == 0:
                t["n_chars"] += 1
            folded = walk(leaf(t), path)
            out.append((r["doc_id"], d, trees[g][-1][0], top[-1][0], h(*(s[1] for s in path if s)), folded, folded == top[-1][0]))
    return out


def run(docs, levels=merkle.LEVELS):
    rows = merkle.verify(merkle.build(docs, claims=merkle.tampered(), levels=levels), levels=levels).collect()
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("levels", [2, 10])
def test_documents(spark, levels):
    docs = read_docs(spark, SF001)
    want = brute([r.asDict() for r in docs.collect()])
    got = run(docs, levels)
    assert got == sorted(want, key=repr)
    assert {r[6] for r in got} == {True, False}


def test_edge_rows(spark):
    docs = edge_docs(spark)
    want = brute([r.asDict() for r in docs.collect()])
    for levels in (1, 3):
        assert run(docs, levels) == sorted(want, key=repr)


def test_empty(spark):
    m = merkle.build(empty_docs(spark), claims=merkle.tampered())
    assert merkle.verify(m).collect() == [] and m.root.collect() == []


def test_one_row_is_the_root(spark):
    docs = edge_docs(spark, [(7, "x", None, None, 1)])
    m = merkle.build(docs)
    (r,) = merkle.verify(m).collect()
    assert r.leaf == r.subroot == r.root == r.folded_root and r.proof_sha256 == h("") and r.verified


def test_hot_copies_and_many_groups(spark):
    rows = [(1, "same", "en", "a", 4)] * 300 + [(i, f"t{i}", f"l{i}", "a", 3) for i in range(300)] + [(None, f"n{i}", "en", None, None) for i in range(100)]
    docs = edge_docs(spark, rows)
    assert run(docs, 3) == sorted(brute([r.asDict() for r in docs.collect()]), key=repr)


def test_versions_share_what_the_leaf_does_not_change(spark):
    docs = read_docs(spark, SF001)
    rows = merkle.verify(merkle.build(docs, claims=merkle.tampered(), levels=3), levels=3, nodes=True).collect()
    for r in rows:
        path = [s for s in r.siblings if s]
        assert r.proof_sha256 == h(*path)
        assert len(r.copied) == (0 if r.verified else len(r.siblings) + 1)
