"""Merkle fingerprints and SimHash near-duplicates against plain Python."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from pitchlake.llm import components, fingerprints, simhash
from pitchlake.llm.queries import QUERIES
from pyspark.sql import functions as F

from .data import PROSE, SF01, SF001, edge_docs, edge_rows, empty_docs, read_docs


def md5(s):
    return hashlib.md5(s.encode()).hexdigest()


def brute_tree(text):
    phrases = [[re.findall(fingerprints.PHRASE, p) for p in s.split("\n")] for s in text.split("\n\n")]
    paragraphs = [[md5("".join(map(md5, p))) for p in s] for s in phrases]
    sections = [md5("".join(s)) for s in paragraphs]
    leaves = [md5(x)[:8] for s in phrases for p in s for x in p]
    return md5("".join(sections)), sections, paragraphs, leaves


def brute_text(t):
    root, sections, paragraphs, leaves = t
    return "/".join([root, "".join(x[:8] for x in sections), ";".join("".join(x[:8] for x in s) for s in paragraphs), "".join(leaves)])


def brute_likeness(a, b):
    if a[0] == b[0]:
        return 1.0
    x, y = set(a[3]), set(b[3])
    return 2 * len(x & y) / max(1, len(x) + len(y))


def signed_hash(spark, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.h for r in rows.select("i", F.xxhash64("t").alias("h")).orderBy("i").collect()]


def check(spark, rows, found):
    texts = [t or "" for _, t, *_ in rows]
    order = sorted(zip([(-(1 << 63) if d is None else d) for d, *_ in rows], signed_hash(spark, texts), range(len(rows))))
    want = Counter()
    for k, (_, _, i) in enumerate(order):
        text, after = texts[i], texts[order[(k + 1) % len(order)][2]]
        q = len(text) // 4
        edited = text[: len(text) - q] + after[:q]
        a, b, c = brute_tree(text), brute_tree(edited), brute_tree(after)
        want[(rows[i][0], len(text), hashlib.sha256(edited.encode()).hexdigest(), brute_text(a), brute_text(b), round(brute_likeness(a, b), 9), round(brute_likeness(a, c), 9))] += 1
    got = Counter((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9)) for r in found)
    assert got == want


def test_fingerprints_edge(spark):
    check(spark, edge_rows(), fingerprints.compare_edited(edge_docs(spark)).collect())
    assert fingerprints.compare_edited(empty_docs(spark)).collect() == []
    one = [(7, PROSE, "en", "a", 1)]
    check(spark, one, fingerprints.compare_edited(edge_docs(spark, one)).collect())
    same = [(7, PROSE, "en", "a", 1)] * 30
    check(spark, same, fingerprints.compare_edited(edge_docs(spark, same)).collect())


def test_fingerprints_sample(spark):
    found = QUERIES["op8_fingerprints"](spark, SF01).collect()
    check(spark, [(r.doc_id, r.text) for r in read_docs(spark, SF01).collect()], found)
    assert np.mean([r.near_edited for r in found]) > 0.6 and np.median([r.near_next for r in found]) < 0.1


def test_edits_are_located(spark):
    a = "one.\ntwo.\n\nthree.\nfour."
    cases = {"one.\ntwo.\n\nthree.\nfive.": [(1, 1)], "one.\ntwo!\n\nthree.\nfour.": [(0, 1)], a: [], a + "\n\nmore": [(2, 0)], "one.\ntwo.": [(1, 0), (1, 1)], "one.\ntwo.\n\nthree.\nfour.\nx": [(1, 2)]}
    rows = spark.createDataFrame([(a, b) for b in cases], "a string, b string")
    for r in rows.select("b", fingerprints.edits(fingerprints.tree(F.col("a")), fingerprints.tree(F.col("b"))).alias("at")).collect():
        assert [tuple(x) for x in r.at] == cases[r.b]


def brute_fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(fps, max_bits=3):
    fps, root = np.unique(np.array(fps, np.uint64)), {}
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[i + 1 :] ^ fps[i]) <= max_bits) + i + 1:
            parent[find(int(j))] = find(i)
    for i, f in enumerate(fps):
        root[int(f)] = find(i)
    return root


def check_simhash(rows, found):
    fps = [brute_fingerprint(t) for _, t, *_ in rows]
    root, low = brute_groups(fps), {}
    for (doc, *_), f in zip(rows, fps):
        if doc is not None:
            low[root[f]] = min(doc, low.get(root[f], doc))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in found) == Counter((d, f"{f:016x}", low.get(root[f])) for (d, *_), f in zip(rows, fps))


def test_simhash_edge_and_sample(spark):
    check_simhash(edge_rows(), simhash.near_duplicates(edge_docs(spark)).collect())
    assert simhash.near_duplicates(empty_docs(spark)).collect() == []
    check_simhash([(r.doc_id, r.text) for r in read_docs(spark, SF01).collect()], QUERIES["op9_simhash"](spark, SF01).collect())


def clustered(n, seed):
    rng, out = random.Random(seed), []
    while len(out) < n:
        x = rng.getrandbits(64) & (-1 << rng.choice([0, 0, 40]))
        for _ in range(rng.choice([1, 1, 3, 60])):
            out.append(x)
            for _ in range(rng.randrange(5)):
                x ^= 1 << rng.randrange(64)
    return out[:n]


@pytest.mark.parametrize("bucket", [4, 1024])
@pytest.mark.parametrize("max_bits", [1, 3])
def test_links_connect_what_brute_force_connects(spark, bucket, max_bits):
    fps = clustered(1500, bucket + max_bits)
    nodes = spark.createDataFrame([(simhash.signed(f),) for f in set(fps)], "fp long").repartition(4)
    found = simhash.links(nodes, max_bits, bucket).collect()
    assert all((r.u ^ r.v).bit_count() <= max_bits if (r.u ^ r.v) >= 0 else ((r.u ^ r.v) & (1 << 64) - 1).bit_count() <= max_bits for r in found)
    roots = {r.node: r.root for r in components.components(simhash.links(nodes, max_bits, bucket)).collect()}
    mine, want = defaultdict(set), defaultdict(set)
    for f, r in brute_groups(fps, max_bits).items():
        want[r].add(f)
        mine[roots.get(simhash.signed(f), simhash.signed(f))].add(f)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, want.values()))


@pytest.mark.parametrize("t,m", [(0, 4), (1, 2), (3, 1)])
def test_every_allocation_finds_all(spark, t, m):
    fps = clustered(300, t)
    nodes = spark.createDataFrame([(simhash.signed(f),) for f in set(fps)], "fp long")
    parts = [(list(range(i * 64 // m, (i + 1) * 64 // m)), t) for i in range(m)] if t < 3 else [(list(range(6)), 0), (list(range(6, 16)), 1), (list(range(16, 64)), 0)]
    edges = simhash.link_buckets(simhash.probes(nodes, parts), 3)
    roots = {r.node: r.root for r in components.components(edges).collect()}
    want = brute_groups(fps)
    for a in want:
        for b in want:
            if want[a] == want[b]:
                x, y = simhash.signed(a), simhash.signed(b)
                assert roots.get(x, x) == roots.get(y, y)


def test_allocation_is_the_cheapest():
    from itertools import product

    rng = random.Random(0)
    costs = [{t: (t + 1) * rng.random() * 10 ** rng.randrange(3) for t in range(-1, 4)} for _ in range(4)]
    want = min(sum(c[t] for c, t in zip(costs, ts)) for ts in product(range(-1, 4), repeat=4) if sum(ts) == 0)
    assert simhash.allocate(costs, 0)[0] == pytest.approx(want)


def test_components_of_a_long_path_and_a_star(spark):
    rng = random.Random(3)
    names = list(range(-200, 200))
    rng.shuffle(names)
    edges = [(names[i], names[i + 1]) for i in range(249)] + [(names[250], n) for n in names[251:399]] + [(names[0], names[0])]
    rng.shuffle(edges)
    roots = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {roots[n] for n in names[:250]} == {min(names[:250])} and {roots[n] for n in names[250:399]} == {min(names[250:399])}
    assert components.components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_keep_one_of_each_component(spark):
    docs = edge_docs(spark)
    out = simhash.keep_one(docs)
    assert out.schema == docs.schema
    rows = edge_rows()
    root = brute_groups([brute_fingerprint(t) for _, t, *_ in rows])
    groups = defaultdict(list)
    for doc, text, *_ in rows:
        groups[root[brute_fingerprint(text)]].append((doc is not None, doc or 0))
    assert Counter((r.doc_id is not None, r.doc_id or 0) for r in out.collect()) == Counter(min(g) for g in groups.values())
    assert simhash.keep_one(empty_docs(spark)).collect() == []
