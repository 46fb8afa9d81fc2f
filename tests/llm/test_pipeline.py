"""The pipeline end to end, each stage held against its operator's rule in plain Python."""

import re
from collections import Counter

import pytest

import corpus_pipeline as P
from pitchlake.llm import quality, simhash

from .data import PROSE, edge_docs, edge_rows, empty_docs

BASE = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6,}|AKIA[A-Z0-9]{16,}|[0-9a-f]{24,}""")


def rows():
    good = [(100 + i, f"{PROSE} with {w} and more about {w} told once", "en", "a", None) for i, w in enumerate(("apples", "boats", "clouds", "dunes", "engines", "forests"))]
    leak = [(200, f"{PROSE} one day someone wrote password: hunter2222 in the open, which nobody should do", "en", "b", None)]
    return [*edge_rows(), *good, *good[:2], *leak]


def counted(df):
    return Counter(map(tuple, df.collect()))


def test_stages_and_run(spark, tmp_path):
    docs = edge_docs(spark, rows())
    folder = str(tmp_path / "sf")
    docs.write.parquet(f"{folder}/documents.parquet")
    docs, given = spark.read.parquet(f"{folder}/documents.parquet"), None
    given = counted(docs)
    steps = dict(P.STAGES)
    assert list(steps) == ["quality_rules", "simhash_dedup", "secret_scan", "source_mix", "best_fit_packing"]

    def step(name, df):
        out = steps[name](spark, df, folder)
        path = str(tmp_path / name)
        out.write.parquet(path)
        return spark.read.parquet(path)

    kept = step("quality_rules", docs)
    assert kept.columns == docs.columns and kept.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    verdicts = Counter((r.doc_id, r.n_words, r.kept) for r in quality.judge(docs).collect())
    assert counted(kept) <= given and kept.count() == sum(n for (_, _, k), n in verdicts.items() if k)
    assert {100, 101, 200} <= {r.doc_id for r in kept.collect()} and all(len((r.text or "").split()) >= 20 for r in kept.collect())

    one = step("simhash_dedup", kept)
    assert one.columns == docs.columns and counted(one) <= counted(kept)
    classes = simhash.near_duplicates(kept.select("doc_id", "text"))
    assert one.count() == classes.select("component_id").distinct().count()

    clean = step("secret_scan", one)
    assert clean.columns == docs.columns and clean.count() == one.count()
    for r in clean.collect():
        assert not BASE.search(r.text or "") and r.n_chars == (len(r.text) if r.text is not None else None)
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in one.collect()}

    mixed = step("source_mix", clean)
    assert mixed.columns == docs.columns and set(counted(mixed)) <= set(counted(clean))

    packed = step("best_fit_packing", mixed)
    pieces = packed.collect()
    by = {}
    for r in pieces:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by.values():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and own[-1][0] + own[-1][1] <= 2048
    assert sum(r.piece == 0 for r in pieces) == mixed.count()

    ran = P.run(spark, folder)
    key = lambda df: Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in df.collect())
    assert ran.columns == packed.columns and key(ran) == key(packed)


@pytest.mark.parametrize("kind", ["empty", "nulls"])
def test_run_on_tables_without_texts(spark, tmp_path, kind):
    docs = empty_docs(spark) if kind == "empty" else edge_docs(spark, [(None, None, None, None, None)] * 3 + [(1, "", "en", None, 0)])
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert P.run(spark, str(tmp_path)).collect() == []
