"""Quality rules and URL filter against plain Python."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitchlake.llm import quality, urls
from pitchlake.llm.queries import QUERIES

from .data import SCHEMA, SF01, SF001, edge_docs, edge_rows, empty_docs, read_docs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_statistics(text):
    text = text or ""
    words = WORD.findall(text)
    seen, lines = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            lines += line in seen
            seen.add(line)
    windows = defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i : i + 8])].append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    n = len(words)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), lines, len(covered), n < 20 or 100 * len(covered) > 30 * n


def check(rows, found):
    want = Counter((d, *brute_statistics(t)) for d, t, *_ in rows)
    assert want == Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in found)
    assert not any(r.kept and r.base_failed for r in found)


def test_statistics_edge_and_sample(spark):
    check(edge_rows(), quality.judge(edge_docs(spark)).collect())
    check([(r.doc_id, r.text) for r in read_docs(spark, SF01).collect()], QUERIES["op7_quality_rules"](spark, SF01).collect())
    assert quality.judge(empty_docs(spark)).collect() == []


def test_keep_returns_the_rows_as_they_were(spark):
    docs = edge_docs(spark)
    verdicts = Counter((r.doc_id, r.n_words) for r in quality.judge(docs).where("kept").collect())
    kept = quality.keep(docs)
    assert kept.schema == docs.schema
    assert verdicts == Counter((r.doc_id, len(WORD.findall(r.text or ""))) for r in kept.collect())
    assert quality.keep(empty_docs(spark)).collect() == []


def test_labelled_junk_goes_and_clean_documents_stay(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    docs = read_docs(spark, "/root/testdata/sf0.1")
    rows = quality.judge(docs).join(labels, "doc_id").where("not base_failed").collect()
    good, bad = ([r.kept for r in rows if r.quality == q] for q in (1, 0))
    assert np.mean(good) > 0.995 and np.mean(bad) < 0.35, (np.mean(good), np.mean(bad), len(bad))


def prose(rng, n=60):
    return " ".join("abcdefghijklmnop"[: rng.integers(2, 9)] + str(rng.integers(10)) for _ in range(n))


def test_small_group_is_judged_with_all_of_its_language(spark):
    """A lone junk document beside a large source is an outlier, as it is in a small table."""
    rng = np.random.default_rng(5)
    junk = " ".join(f"#$%&{i}{'QWERTZ' * 4}|<>*" for i in range(60))
    for n in (60, 300):
        rows = [(i, prose(rng), "en", "large", 1) for i in range(n)] + [(n, junk, "en", "small", 1), (n + 1, prose(rng), "en", "small", 1), (n + 2, junk, "de", "small", 1)]
        kept = {r.doc_id: r.kept for r in quality.judge(spark.createDataFrame(rows, SCHEMA)).collect()}
        assert not kept[n] and kept[n + 1] and all(kept[i] for i in range(n)), n


def test_estimate_matches_numpy_and_resists_outliers(spark):
    rng = np.random.default_rng(1)
    d = len(quality.VECTOR)
    a = rng.normal(size=(d, d)) / 2
    clean = rng.normal(size=(4000, d)) @ a.T + np.arange(d)
    data = np.vstack([clean, rng.normal(40, 1, size=(800, d))])
    rows = spark.createDataFrame([("x", *map(float, r)) for r in data], ["g", *quality.VECTOR])
    model = quality.fit(rows, ["g"], 0.75, 4).first()
    mean = np.array([model[f"m_{i}"] for i in range(d)])
    factor = np.zeros((d, d))
    for i in range(d):
        for j in range(i + 1):
            factor[i, j] = model[f"l_{i}_{j}"]
    cov = np.cov(clean.T) + np.diag(np.square(quality.LEAST_SD))
    assert np.abs(mean - clean.mean(0)).max() < 0.2 and np.abs(factor @ factor.T - cov).max() < 0.25 * np.abs(cov).max()
    got = rows.crossJoin(quality.stage(spark.createDataFrame([model]).drop("g"), "t")).select(quality.distance().alias("d")).collect()
    inverse = np.linalg.inv(factor @ factor.T)
    want = [(r - mean) @ inverse @ (r - mean) for r in data]
    assert np.allclose([r.d for r in got], want)
    assert sum(w > quality.CUTOFF for w in want[4000:]) == 800 and sum(w > quality.CUTOFF for w in want[:4000]) == 0


def test_estimate_resists_forty_percent_of_outliers(spark):
    """Copies of one far point, outliers in their direction, and a far cloud: none moves the estimate."""
    rng = np.random.default_rng(7)
    d = len(quality.VECTOR)
    clean = rng.normal(size=(1200, d)) / 4
    point = np.array([3.0, 3, 0, 0, 0])
    groups = {"copies": np.vstack([clean, np.tile(point, (800, 1)), point / 1.3 + rng.normal(size=(40, d)) / 100]), "cloud": np.vstack([clean, rng.normal(9, 0.3, size=(720, d))])}
    rows = spark.createDataFrame([(g, *map(float, r)) for g, data in groups.items() for r in data], ["g", *quality.VECTOR])
    model = quality.fit(rows, ["g"], quality.SHARE, quality.STEPS)
    got = {g: sorted(r.d for r in rows.join(model, "g").where(F.col("g") == g).select(quality.distance().alias("d")).collect()) for g in groups}
    for g, out in (("copies", 840), ("cloud", 720)):
        assert sum(x > quality.CUTOFF for x in got[g]) == out, (g, got[g][1190:1210], got[g][-1])


def test_cutoff_is_the_stated_quantile_and_clear_junk_goes(spark):
    x = np.square(np.random.default_rng(4).normal(size=(2_000_000, len(quality.VECTOR)))).sum(1)
    assert abs(np.mean(x > quality.CUTOFF) / quality.TAIL - 1) < 0.3
    rng = np.random.default_rng(6)
    # 23 symbols in 60 words, in a group with none
    symbols = " ".join(w[:-1] + "#" if i < 23 else w for i, w in enumerate(prose(rng).split()))
    rows = [(i, prose(rng), "en", "a", 1) for i in range(120)] + [(120, symbols, "en", "a", 1)]
    kept = {r.doc_id: r.kept for r in quality.judge(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert not kept.pop(120) and all(kept.values())


@pytest.mark.parametrize("share", [0.5, 0.75, 0.9])
def test_consistency_factor(share):
    x = np.sort(np.square(np.random.default_rng(2).normal(size=(400_000, len(quality.VECTOR)))).sum(1))
    inner = np.random.default_rng(3).normal(size=(400_000, len(quality.VECTOR)))
    cut = x[int(share * len(x))]
    variance = inner[np.square(inner).sum(1) <= cut].var()
    assert abs(quality.consistency(share) * variance - 1) < 0.02


def brute_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
    return "".join(c.lower() if c.isascii() else c for c in host), path


def brute_rule(host, path):
    fits = [(len(r), r, v) for v, r in urls.RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/"):])]
    return max(fits)[1:] if fits else (None, None)


EDGE_URLS = [
    None, "", "no scheme", "http://", "://", "http://com/", "http://com", "HTTPS://WWW.Example.COM/en/a?b=c#d", "http://x.example.com/en/", "http://www.example.com/en",
    "http://notexample.com/en/", "http://a.net/es/x", "http://net/fr/", "http://a.net?q=/es/", "a://b://c/d", "http://ÄB.net/es/\nx", "http://a.b/c#/es/", "x" * 5000 + "://h.net/es/" + "1" * 5000,
    "http://user:pw@a.com:80/x;y?a=1&b=2&&c", "http://a.b.c.d.org/%20?x", "http://example.com/en/", "http://example.com/en/",
]


def check_urls(rows, found):
    assert Counter((p, *brute_parts(u), brute_rule(*brute_parts(u))[0]) for p, u in rows) == Counter((r.page_id, r.host, r.path, r.rule) for r in found)
    verdicts = {v: k for k, v in urls.RULES}
    assert all(r.verdict == verdicts[r.rule] if r.rule else r.verdict in ("allow", "block") for r in found)


def test_urls_edge_and_sample(spark):
    rows = [*enumerate(EDGE_URLS), (None, "http://a.com/x")]
    pages = spark.createDataFrame([(i, u, "h", "?") for i, u in rows], "page_id long, url string, host string, label string")
    check_urls(rows, urls.judge(pages).collect())
    check_urls([], urls.judge(pages.limit(0)).collect())
    one_class = spark.createDataFrame([(1, "http://a.com/"), (2, "http://b.org/")], "page_id long, url string")
    assert {r.verdict for r in urls.judge(one_class).collect()} == {"allow"}
    all_pages = [(r.page_id, r.url) for r in spark.read.parquet(f"{SF001}/pages.parquet").collect()]
    check_urls(all_pages, QUERIES["op10_url_filter"](spark, SF001).collect())


def test_trees_learn_labelled_urls(spark):
    n = spark.range(3000).select(F.col("id").alias("page_id"), (F.col("id") % 3 == 0).alias("bad"), F.abs(F.xxhash64("id")).cast("string").alias("h"))
    url = F.when(F.col("bad"), F.concat(F.lit("http://x9"), F.substring("h", 1, 9), F.lit("-win.example.org/a/b/c/d?i="), "h", F.lit("&j=1&k=2"))).otherwise(
        F.concat(F.lit("https://www.site"), F.col("page_id") % 7, F.lit(".example.org/story")))
    rows = n.withColumn("url", url).withColumn("label", F.col("bad").cast("double"))
    out = urls.judge(rows.where("page_id % 2 = 1"), rules=(), labelled=rows.where("page_id % 2 = 0")).join(n, "page_id").collect()
    assert np.mean([(r.verdict == "block") == r.bad for r in out]) > 0.99


def test_suffix_statistics_are_of_all_labelled_rows_and_a_hot_url_is_thinned(spark):
    """1,500 suffixes with two rows each and one URL with a third of the rows; 500 rows are fitted on."""
    n = spark.range(4500).select(F.col("id"), F.when(F.col("id") < 3000, F.concat(F.lit("s"), F.col("id") % 1500, F.lit(".org"))).otherwise(F.lit("hot.net")).alias("host"))
    rows = n.select("id", F.concat(F.lit("http://"), "host", F.lit("/a")).alias("url"), "host", F.lit("/a").alias("path"), (F.col("host") == "hot.net").cast("double").alias("label"))
    found = {r.suffix: (r.suffix_rate, r.suffix_log_rows) for r in urls.train(rows, max_rows=500, trees=1, depth=1).suffixes.collect()}
    assert len(found) == 1501
    assert found["hot.net"] == pytest.approx(((1500 + 10 / 3) / 1510, np.log1p(1500))) and found["s7.org"] == pytest.approx((10 / 3 / 12, np.log1p(2)))
    for some in (rows, rows.drop("id")):
        assert 400 < urls.thinned(some, 500, 4500).count() < 600
        assert 100 < urls.thinned(some, 500, 4500).where("host = 'hot.net'").count() < 240
