"""The Jaccard join against brute force."""

import random

import numpy as np
import pytest

from pitchlake.llm import jaccard

from .data import SF001, edge_docs, empty_docs, read_docs


def grams(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    return frozenset(tuple(words[i : i + 4]) for i in range(len(words) - 3)) or (frozenset([tuple(words)]) if words else frozenset())


def brute(rows, least=85):
    sets = [grams(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= least * len(a | sets[j]):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if sets[i] and d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted(((d, len(sets[i]), low.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=repr)


def check(spark, rows, **kw):
    docs = edge_docs(spark, [(d, t, "en", "a", 1) for d, t in rows])
    got = sorted(map(tuple, jaccard.near_sets(docs, **kw).collect()), key=repr)
    assert got == brute(rows, kw.get("least", 85))
    return got


def test_documents(spark):
    rows = [(r.doc_id, r.text) for r in read_docs(spark, SF001).collect()]
    got = check(spark, rows)
    assert len({r[2] for r in got}) < len(got)


def test_edge_rows(spark):
    docs = edge_docs(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(tuple, jaccard.near_sets(docs).collect()), key=repr) == brute(rows)


def test_empty(spark):
    assert jaccard.near_sets(empty_docs(spark)).collect() == []


def family(rng, size, n, most):
    """A text and edits of it, around the threshold."""
    words = [f"w{rng.randrange(10**6)}" for _ in range(n)]
    for _ in range(size):
        own = list(words)
        for _ in range(rng.randint(0, most)):
            at, what = rng.randrange(len(own)), rng.random()
            own[at : at + (what < 0.7)] = [f"x{rng.randrange(10**6)}"] if what > 0.3 else []
        yield " ".join(own)


@pytest.mark.parametrize("seed", [1, 2])
def test_around_the_threshold(spark, monkeypatch, seed):
    rng = random.Random(seed)
    monkeypatch.setattr(jaccard, "TREE", 2000)
    texts = [t for n in (5, 7, 9, 12, 20, 40, 80, 150, 300) for t in family(rng, 25, n, max(1, n // 30) + 1)]
    rng.shuffle(texts)
    got = check(spark, [(i, t) for i, t in enumerate(texts)], least=(85, 70)[seed - 1])
    groups = {}
    for _, _, c in got:
        groups[c] = groups.get(c, 0) + 1
    assert max(groups.values()) > 3 and len(groups) > 30


def test_template_that_does_not_reach_the_threshold(spark):
    stem = " ".join(f"s{i}" for i in range(100))
    check(spark, [(i, stem + " " + " ".join(f"o{i}x{j}" for j in range(14 + i % 6))) for i in range(40)])


def test_sets_that_meet_but_differ_in_too_much_are_not_sent_to_trees(spark, monkeypatch):
    sent, stage = {}, jaccard.stage

    def counted(df, name):
        out = stage(df, name)
        sent[name] = out.count()
        return out

    monkeypatch.setattr(jaccard, "stage", counted)
    monkeypatch.setattr(jaccard, "TREE", 500)
    # each text shares its first half with some texts and its second half with others: all meet, in a chain
    halves = [" ".join(f"h{k}x{i}" for i in range(60)) for k in range(30)]
    rows = [(i, f"{halves[i % 30]} {halves[(i + 1) % 30]} " + " ".join(f"o{i}x{j}" for j in range(8))) for i in range(30)]
    rows += [(100 + i, halves[0] + f" end{i}") for i in range(3)]
    got = check(spark, rows)
    assert sent["jaccard-buckets"] > 0 and {c for d, _, c in got if d >= 100} == {100}
    assert sent["jaccard-dealt"] == 3 and "jaccard-far-links" not in sent


@pytest.mark.parametrize("compared", [1 << 32, 2000, 0])
def test_likely_links_connect_all_links(monkeypatch, compared):
    monkeypatch.setattr(jaccard, "COMPARED", compared)
    rng, unlikely = np.random.default_rng(4), 0
    for least in (85, 60):
        for _ in range(60):
            base = [rng.integers(0, 1 << 63, rng.integers(1, 300)) for _ in range(3)]
            bases = [base[i] for i in rng.integers(0, 3, 40)]
            sets = [np.unique(np.r_[b[rng.random(len(b)) > rng.random() / 5], rng.integers(0, 1 << 63, rng.integers(0, len(b) // 8 + 2))]).astype(np.uint64) for b in bases]
            sets = [s for s in sets if len(s)]
            links = jaccard.likely(np.array([len(s) for s in sets]), [jaccard.sketch_of(s) for s in sets], least)
            of = list(range(len(sets)))
            for _ in sets:
                for i, j in links:
                    of[i] = of[j] = min(of[i], of[j])
            unlikely += len(set(of)) > 1
            assert len(links) < len(sets)
            for i, a in enumerate(sets):
                for j in range(i):
                    inter = len(np.intersect1d(a, sets[j]))
                    assert not jaccard.links_at(inter, len(a), len(sets[j]), least) or of[i] == of[j]
    assert unlikely > 60 or not compared


def test_hot_copies_and_near_copies(spark):
    stem = [f"s{i}" for i in range(60)]
    rows = [(i, " ".join(stem)) for i in range(100, 400)] + [(i, " ".join([*stem[: i % 60], "edit", *stem[i % 60 + 1 :]])) for i in range(60)]
    rows += [(500 + i, " ".join([*stem, *(f"t{j}" for j in range(i))])) for i in range(12)]
    check(spark, rows)


def test_linked_sets_share_a_bucket():
    rng, classes = np.random.default_rng(3), jaccard.Classes()
    for _ in range(3000):
        a = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 60)).astype(np.uint64))
        b = np.unique(np.r_[a[rng.random(len(a)) > 0.05], rng.integers(0, 1 << 63, rng.integers(0, 3)).astype(np.uint64)])
        inter = len(np.intersect1d(a, b))
        if len(b) and len(a) + len(b) > 2 * inter and jaccard.links_at(inter, len(a), len(b)):
            assert len(np.intersect1d(jaccard.keys_of(a, classes), jaccard.keys_of(b, classes)))


@pytest.mark.parametrize("piece", [1, 3, 16])
def test_a_tree_equals_set_operations(monkeypatch, piece):
    monkeypatch.setattr(jaccard, "PIECE", piece)
    rng = np.random.default_rng(piece)
    for least in (85, 60):
        base = rng.integers(0, 1 << 20, 150)
        sets = {np.unique(np.r_[base[rng.random(150) > rng.random() / 2], rng.integers(0, 1 << 20, rng.integers(0, 20))]).astype(np.uint64).tobytes() for _ in range(120)}
        sets |= {np.unique(base).astype(np.uint64)[:k].tobytes() for k in (1, 2, 70, 71, 140)} | {rng.integers(0, 9, 1).astype(np.uint64).tobytes()}
        sets = [np.frombuffer(x, np.uint64) for x in sets]
        tree = jaccard.Tree(sets[:100], least)
        for c in sets:
            want = [i for i, s in enumerate(sets[:100]) if jaccard.links_at(len(np.intersect1d(s, c)), len(s), len(c), least)]
            assert sorted(tree.walk(c).tolist()) == want
        for i, c in enumerate(sets[:100]):
            want = [j for j, s in enumerate(sets[:100]) if j != i and jaccard.links_at(len(np.intersect1d(s, c)), len(s), len(c), least)]
            assert sorted(set(tree.walk(c, member=True).tolist()) - {i}) == want


def test_spanning_links_connect_what_all_links_connect():
    rng = np.random.default_rng(9)
    for n in (2, 3, 40, 150):
        base = [rng.integers(0, 1 << 40, 80) for _ in range(3)]
        sets = list({np.unique(np.r_[b[rng.random(80) > rng.random() / 8], rng.integers(0, 1 << 40, rng.integers(0, 6))]).astype(np.uint64).tobytes() for i in range(n) for b in [base[i % 3]]})
        sets = [np.frombuffer(x, np.uint64) for x in sets]
        links = jaccard.span(jaccard.Tree(sets), sets)

        def groups(pairs):
            of = list(range(len(sets)))
            for _ in range(len(sets)):
                for i, j in pairs:
                    of[i] = of[j] = min(of[i], of[j])
            return of

        every = [(i, j) for i in range(len(sets)) for j in range(i) if jaccard.links_at(len(np.intersect1d(sets[i], sets[j])), len(sets[i]), len(sets[j]))]
        assert set(map(frozenset, links)) <= set(map(frozenset, every))
        assert groups(links) == groups(every) and len(links) < len(sets)


def test_shingle_hashes_tell_sequences_apart():
    texts = ["a b c d", "a b d c", "a b c", "a b", "a", "b a", "ab c d e", "a bc d e", "a a a a", "a a a", "A  b\tC d", "d c b a", "a b c d e"]
    sets = {t: jaccard.shingle_set(t.encode()).tobytes() for t in texts}
    assert sets["a b c d"] == sets["A  b\tC d"] and len(set(sets.values())) == len(texts) - 1
    assert len(jaccard.shingle_set(b"a b c d e a b c d")) == 5
