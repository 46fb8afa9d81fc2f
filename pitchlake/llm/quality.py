"""Quality rules and robust multivariate outliers, in DataFrame functions only.

Base rules reject very short and very repetitive texts. Of the rest, each
document has a vector of transformed statistics. Per language and source, the
minimum covariance determinant estimate (concentration steps over the half of
documents nearest to the current centre, from several starts, until the
determinant stops falling) gives a location and scatter that outliers don't move;
a document beyond a Mahalanobis distance is rejected. Equal vectors count once,
so the copies of a text weigh as one document.
"""

from __future__ import annotations

from math import erf, exp, pi, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage, text_or_empty

BLANK = r"[\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
CAPITAL = r"[A-Z!?]"
WINDOW = 8

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

#: Concentration: the share of documents whose scatter is smallest (half: the highest
#: breakdown), and the most steps; it ends when no log determinant falls by TOLERANCE.
SHARE, STEPS, TOLERANCE = 0.5, 30, 0.01
#: Steps from every start, before the one of the least determinant goes on.
TRIAL_STEPS = 2
#: The quantiles that starts are taken from.
GRID = 20
#: Groups with fewer different vectors are judged by the estimate over all documents of their language, large groups too.
MIN_GROUP = 100
#: The statistics, and the least standard deviation of each (a statistic that is
#: the same in nearly all documents has no scatter of its own). README has the rates
#: that chose them.
VECTOR = ("word_length", "symbols", "capitals", "dup_lines", "repeats")
LEAST_SD = (0.08, 0.05, 0.05, 0.08, 0.08)
#: A model's columns: means, and the Cholesky factor of the covariance.
PARAMETERS = [f"m_{i}" for i in range(len(VECTOR))] + [f"l_{i}_{j}" for i in range(len(VECTOR)) for j in range(i + 1)]


def chi2(x: float, k: int) -> float:
    """P(chi-square with ``k`` degrees <= x), ``k`` odd."""
    p, term = erf(sqrt(x / 2)), sqrt(2 * x / pi) * exp(-x / 2)
    for m in range(3, k + 1, 2):
        p -= term
        term *= x / m
    return p


def chi2_quantile(share: float, k: int) -> float:
    """The ``share`` quantile of chi-square with ``k`` degrees, ``k`` odd."""
    low, high = 0.0, 200.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2(mid, k) < share else (low, mid)
    return low


#: The share of normal vectors that go, and the squared Mahalanobis distance beyond
#: which a document is an outlier (25.7).
TAIL = 1e-4
CUTOFF = chi2_quantile(1 - TAIL, len(VECTOR))


def statistics(docs: DataFrame, id_col: str, text_col: str, *keep: Column) -> DataFrame:
    """id, columns of ``keep`` and the base statistics of each document."""
    words = F.array_remove(F.split(F.col("__text"), BLANK), "")
    lines = F.filter(F.split(F.col("__text"), "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    windows = F.when(
        F.col("n_words") > WINDOW,
        F.transform(F.sequence(F.lit(1), F.col("n_words").cast("int") - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(F.col("__words"), i, WINDOW))),
    )
    return (
        docs.select(F.col(id_col), *keep, text_or_empty(text_col).alias("__text"))
        .withColumn("__words", words)
        .withColumn("__lines", lines)
        .withColumn("n_words", F.size("__words").cast("long"))
        .withColumn("word_chars", F.char_length(F.concat_ws("", "__words")).cast("long"))
        .withColumn("n_symbols", (F.size(F.split("__text", SYMBOL, -1)) - 1).cast("long"))
        .withColumn("n_capitals", (F.size(F.split("__text", CAPITAL, -1)) - 1).cast("long"))
        .withColumn("n_lines", F.size("__lines").cast("long"))
        .withColumn("n_dup_lines", (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"))
        .withColumn("__windows", windows)
        .withColumn("n_repeat_words", repeat_words(F.col("__windows")).cast("long"))
        .drop("__text", "__words", "__lines", "__windows")
    )


def repeat_words(windows: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more (null: none).

    Most texts have no repeated window and stop at the distinct count. Otherwise
    windows are sorted by hash and place, those with an equal neighbour are
    sorted by place, and each covers up to the next one's start: n log n.
    """

    def place(pair: Column) -> Column:
        return pair["i"]

    def covered(pairs: Column) -> Column:
        twice = F.filter(
            pairs,
            lambda p, j: (F.get(pairs, j - 1)["h"] == p["h"]) & (j > 0) | F.coalesce(F.get(pairs, j + 1)["h"] == p["h"], F.lit(False)),
        )
        return F.transform(F.array(F.array_sort(F.transform(twice, place))), lambda at: F.aggregate(
            F.transform(at, lambda i, j: F.least(F.lit(WINDOW), F.coalesce(F.get(at, j + 1) - i, F.lit(WINDOW)))),
            F.lit(0), lambda a, n: a + n))[0]

    pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    # the inner arrays are bound as lambda variables, so each is made once
    return F.when(
        F.size(F.array_distinct(windows)) < F.size(windows), F.transform(F.array(pairs), covered)[0]
    ).otherwise(0)


def vector() -> list[Column]:
    """The transformed statistics, as columns named as in VECTOR."""
    words, chars = F.greatest("n_words", F.lit(1)).cast("double"), F.greatest("word_chars", F.lit(1)).cast("double")
    return [
        F.log(chars / words).alias("word_length"),
        F.asinh(F.col("n_symbols") / words).alias("symbols"),
        F.sqrt(F.least(F.lit(1.0), F.col("n_capitals") / chars)).alias("capitals"),
        F.asinh(F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))).alias("dup_lines"),
        F.asinh(F.col("n_repeat_words") / words).alias("repeats"),
    ]


def distance() -> Column:
    """Squared Mahalanobis distance of the vector from ``m_i`` under the factor ``l_i_j``."""
    y: list[Column] = []
    for i, name in enumerate(VECTOR):
        v = F.col(name) - F.col(f"m_{i}")
        for j in range(i):
            v = v - F.col(f"l_{i}_{j}") * y[j]
        y.append(v / F.col(f"l_{i}_{i}"))
    return sum((v * v for v in y[1:]), y[0] * y[0])


def estimate(rows: DataFrame, keys: list[str], scale: float) -> DataFrame:
    """Per group: mean ``m_i`` and Cholesky factor ``l_i_j`` of the covariance
    (times ``scale``, plus the least variances); partial sums, so a hot group is no hot task."""
    d = len(VECTOR)
    means = [F.avg(v).alias(f"m_{i}") for i, v in enumerate(VECTOR)]
    covs = [F.covar_pop(VECTOR[i], VECTOR[j]).alias(f"c_{i}_{j}") for i in range(d) for j in range(i + 1)]
    out = rows.groupBy(*keys).agg(*means, *covs)
    for i in range(d):
        for j in range(i + 1):
            v = scale * F.col(f"c_{i}_{j}") + (LEAST_SD[i] ** 2 if i == j else 0.0)
            for k in range(j):
                v = v - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            out = out.withColumn(f"l_{i}_{j}", F.sqrt(F.greatest(v, F.lit(LEAST_SD[i] ** 2 / 4))) if i == j else v / F.col(f"l_{j}_{j}"))
    return out.drop(*[f"c_{i}_{j}" for i in range(d) for j in range(i + 1)])


def judge(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
    min_group: int = MIN_GROUP, share: float = SHARE, steps: int = STEPS, cutoff: float = CUTOFF,
) -> DataFrame:
    """One row per document: id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, distance (null if base_failed), kept.

    Null text has no words and fails. Null languages and sources are groups of
    their own; null ids and repeated rows pass through, one output row for each
    input row; other columns are ignored. The statistics are written once to the
    shared folder; later steps read that narrow table only. Estimates are a few
    numbers a group, joined to the rows by group.
    """
    lang, source = F.col(lang_col).cast("string").alias("g_lang"), F.col(source_col).cast("string").alias("g_source")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    rows = stage(
        statistics(docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__t"), lang, source), "__id", "__t", F.col("g_lang"), F.col("g_source"))
        .withColumn("base_failed", failed)
        # a null key would need a null-safe join at every step
        .withColumn("g_lang", F.coalesce(F.concat(F.lit("="), "g_lang"), F.lit("")))
        .withColumn("g_source", F.coalesce(F.concat(F.lit("="), "g_source"), F.lit(""))), "quality-statistics",
    )
    good = rows.where(~F.col("base_failed"))
    # copies count once, as in the estimate
    sizes = good.select("g_lang", "g_source", *vector()).groupBy("g_lang", "g_source").agg(F.count_distinct(*VECTOR).alias("size"))
    groups = stage(sizes.select("g_lang", "g_source", F.when(F.col("size") >= min_group, F.concat("g_source", F.lit("/"))).otherwise("").alias("g_pool")), "quality-groups")
    # the pool "" of a language holds all its rows, also those of large groups
    pools = groups.unionByName(groups.join(groups.where("g_pool = ''").select("g_lang").distinct(), "g_lang").where("g_pool != ''").withColumn("g_pool", F.lit("")))
    model = fit(good.join(pools, ["g_lang", "g_source"]).select("g_lang", "g_pool", *vector()), ["g_lang", "g_pool"], share, steps)
    verdicts = (
        rows.join(groups.join(model, ["g_lang", "g_pool"]), ["g_lang", "g_source"], "left")
        .select("*", *vector()).withColumn("distance", F.when(~F.col("base_failed"), distance()))
    )
    return verdicts.select(
        F.col("__id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance",
        (~F.col("base_failed") & (F.coalesce(F.col("distance"), F.lit(0.0)) <= cutoff)).alias("kept"),
    )


def fit(rows: DataFrame, keys: list[str], share: float, steps: int) -> DataFrame:
    """The minimum covariance determinant estimate of each group.

    Each start (see ``starts``) takes TRIAL_STEPS concentration steps, then the
    one of the least determinant goes on, at most to ``steps`` in all, until its
    determinant stops falling; finished groups take no further steps.
    """
    vectors = stage(rows.select(*keys, *VECTOR).distinct(), "quality-vectors")
    tried = [*keys, "__start"]
    model = stage(starts(vectors, keys), "quality-starts")
    for step in range(min(TRIAL_STEPS, steps)):
        model = stage(concentrate(vectors, model, keys, tried, share), f"quality-start-{step}")
    model = stage(
        model.groupBy(*keys).agg(F.min(F.struct(log_determinant().alias("det"), "__start", *PARAMETERS)).alias("best"))
        .select(*keys, *[F.col(f"best.{p}") for p in PARAMETERS]), "quality-model-start",
    )
    done = model.limit(0)
    for step in range(TRIAL_STEPS, steps):
        before = model.select(*keys, log_determinant().alias("__before"))
        after = stage(
            concentrate(vectors, model, keys, keys, share).join(before, keys)
            .select(*keys, *PARAMETERS, (log_determinant() < F.col("__before") - TOLERANCE).alias("__falls")), f"quality-model-{step}",
        )
        done = done.unionByName(after.where("not __falls").drop("__falls"))
        model = after.where("__falls").drop("__falls")
        if model.isEmpty():
            break
    return stage(done.unionByName(model), "quality-model")


def starts(vectors: DataFrame, keys: list[str]) -> DataFrame:
    """Per group, by ``__start``: 0 medians and interquartile ranges, 1 the middles
    and widths of the shortest halves, 2 mean and covariance."""
    d, half = len(VECTOR), GRID // 2

    def shortest(q: Column) -> Column:
        return F.array_min(F.transform(F.sequence(F.lit(0), F.lit(GRID - half)), lambda i: F.struct(
            (F.get(q, i + half) - F.get(q, i)).alias("width"), ((F.get(q, i + half) + F.get(q, i)) / 2).alias("middle"))))

    def diagonal(start: int, middles: list[Column], widths: list[Column]) -> DataFrame:
        return quantiles.select(
            *keys, F.lit(start).alias("__start"), *[m.alias(f"m_{i}") for i, m in enumerate(middles)],
            *[(F.sqrt(F.pow(widths[i] / 1.349, 2) + LEAST_SD[i] ** 2) if i == j else F.lit(0.0)).alias(f"l_{i}_{j}") for i in range(d) for j in range(i + 1)],
        )

    grid = [F.percentile_approx(v, [i / GRID for i in range(GRID + 1)], 2000).alias(f"q_{i}") for i, v in enumerate(VECTOR)]
    quantiles = stage(vectors.groupBy(*keys).agg(*grid), "quality-quantiles")
    q = [F.col(f"q_{i}") for i in range(d)]
    by_quartiles = diagonal(0, [x[half] for x in q], [x[GRID * 3 // 4] - x[GRID // 4] for x in q])
    by_halves = diagonal(1, [shortest(x)["middle"] for x in q], [shortest(x)["width"] for x in q])
    return by_quartiles.unionByName(by_halves).unionByName(estimate(vectors, keys, 1.0).withColumn("__start", F.lit(2)))


def log_determinant() -> Column:
    """Half the log determinant of a model's covariance."""
    return sum((F.log(f"l_{i}_{i}") for i in range(1, len(VECTOR))), F.log("l_0_0"))


def concentrate(vectors: DataFrame, model: DataFrame, keys: list[str], by: list[str], share: float) -> DataFrame:
    """The estimate over the ``share`` of each group's vectors with the least
    distance (a mergeable quantile) under each of its models, told apart by ``by``.
    The subset's covariance is scaled so that the distances' quantile agrees with
    a normal vector's."""
    near = vectors.join(model, keys).select(*by, *VECTOR, distance().alias("__d"))
    # written, so its size is known and the rows needn't be dealt by group to meet it
    cut = stage(near.groupBy(*by).agg(F.percentile_approx("__d", share, 2000).alias("__cut")), "quality-cut")
    return estimate(near.join(cut, by).where(F.col("__d") <= F.col("__cut")), by, consistency(share))


def consistency(share: float) -> float:
    """What the covariance of the inner ``share`` of a normal vector is multiplied by.

    share / P(chi2 with d + 2 degrees <= q), q the ``share`` quantile of chi2
    with d degrees; d is odd here, so both have closed forms.
    """
    d = len(VECTOR)
    return share / chi2(chi2_quantile(share, d), d + 2)


def keep(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The rows whose document is kept, all columns as they were.

    A verdict depends on text, language and source, so rows are matched by id,
    hashes of the three and nothing else: equal rows share one verdict.
    """
    parts = [F.xxhash64(F.lit(i), f"`{c}`") for i, c in enumerate((text_col, lang_col, source_col))]
    key = F.struct(F.col(f"`{id_col}`").alias("id"), F.xxhash64(*parts).alias("h"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    named = docs.select(key.alias("id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{source_col}`").alias("source"))
    gone = judge(named, "id", "text", "lang", "source").where("not kept").select("id").distinct()
    return docs.select(key.alias("id"), row.alias("row")).join(gone, "id", "left_anti").select("row.*")
