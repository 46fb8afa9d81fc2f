"""URL filter: rules first, gradient-boosted trees on lexical features for the rest.

Everything is DataFrame functions and Spark's own tree learner. The labelled
URLs are those that a rule judges, or a table of labels that the caller has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage

ALLOW, BLOCK = "allow", "block"
#: (verdict, host and path): a rule fits its host and all subdomains, longest first.
RULES = (
    (ALLOW, "com/"), (BLOCK, "example.com/en/"), (ALLOW, "www.example.com/en/"), (BLOCK, "net/es/"), (BLOCK, "net/fr/"),
)
#: Bound: labelled URLs that the trees are fitted on (expected).
MAX_FIT_ROWS = 20_000
#: Trees and their depth.
TREES, DEPTH = 12, 4

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = (
    "url_length", "host_length", "path_length", "depth", "host_labels", "longest_label", "hyphens", "digit_ratio",
    "host_digit_ratio", "entropy", "host_entropy", "parameters", "query_length", "fragment", "secure", "suffix_rate", "suffix_log_rows",
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased;
    path: from there up to ``?``, ``#`` or the end. Both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        own, _, rest = rule.partition("/")
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(f"/{rest}")
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def entropy(text: Column) -> Column:
    """Bits per character."""
    n = F.greatest(F.char_length(text), F.lit(1)).cast("double")
    distinct = F.array_distinct(F.array_remove(F.split(text, ""), ""))
    share = lambda c: (F.char_length(text) - F.char_length(F.replace(text, c, F.lit("")))) / n
    return F.aggregate(distinct, F.lit(0.0), lambda a, c: a - share(c) * F.log2(share(c)))


def suffix(host: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(host, ".", -2)


def lexical(rows: DataFrame) -> DataFrame:
    """Rows with url, host and path, and their features but for the suffix statistics."""
    url = F.coalesce(F.col("url"), F.lit(""))
    digits = lambda c: F.char_length(F.regexp_replace(c, "[^0-9]", "")) / F.greatest(F.char_length(c), F.lit(1))
    after = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    labels = F.split("host", "[.]")
    values = {
        "url_length": F.char_length(url), "host_length": F.char_length("host"), "path_length": F.char_length("path"),
        "depth": F.size(F.array_remove(F.split("path", "/"), "")), "host_labels": F.size(labels),
        "longest_label": F.array_max(F.transform(labels, F.char_length)), "hyphens": F.size(F.split("host", "-")) - 1,
        "digit_ratio": digits(url), "host_digit_ratio": digits(F.col("host")), "entropy": entropy(url), "host_entropy": entropy(F.col("host")),
        "parameters": F.size(F.array_remove(F.split(after, "[&;]"), "")), "query_length": F.char_length(after),
        "fragment": url.contains("#").cast("int"), "secure": F.lower(url).startswith("https://").cast("int"),
    }
    return rows.select("*", suffix(F.col("host")).alias("suffix"), *[v.cast("double").alias(k) for k, v in values.items()])


class UrlModel:
    """Fitted trees, suffix statistics and the verdict where there is nothing to learn."""

    def __init__(self, trees: GBTClassificationModel | None, suffixes: DataFrame | None, base: float):
        self.trees, self.suffixes, self.base = trees, suffixes, base

    def with_suffixes(self, rows: DataFrame) -> DataFrame:
        joined = rows.join(self.suffixes, "suffix", "left")
        return joined.withColumn("suffix_rate", F.coalesce("suffix_rate", F.lit(self.base))).withColumn(
            "suffix_log_rows", F.coalesce("suffix_log_rows", F.lit(0.0)))

    def blocked(self, rows: DataFrame) -> DataFrame:
        """Rows of ``lexical`` with a column ``blocked``."""
        if self.trees is None:
            return rows.withColumn("blocked", F.lit(self.base > 0.5))
        given = VectorAssembler(inputCols=list(FEATURES), outputCol="__features").transform(self.with_suffixes(rows))
        return self.trees.transform(given).withColumn("blocked", F.col("prediction") > 0.5)


def thinned(labelled: DataFrame, max_rows: int, n: int) -> DataFrame:
    """About ``max_rows`` of the ``n`` rows, by a hash of URL and id: also a hot URL's rows are thinned."""
    given = labelled if "id" in labelled.columns else labelled.withColumn("id", F.monotonically_increasing_id())
    return given.where(F.pmod(F.xxhash64("url", "id"), F.lit(1 << 40)) < int(max_rows / n * (1 << 40)))


def train(labelled: DataFrame, max_rows: int = MAX_FIT_ROWS, trees: int = TREES, depth: int = DEPTH, seed: int = 42) -> UrlModel:
    """Fit on rows with url, host, path, label (1.0: block) and, if they have one, id.

    Suffix statistics are of all rows. The trees are fitted on about ``max_rows``
    of them (see ``thinned``). One class only: that class is the verdict; no rows: allow.
    """
    sums = stage(
        labelled.select(suffix(F.col("host")).alias("suffix"), "label").groupBy("suffix")
        .agg(F.count("*").alias("n"), F.sum("label").alias("blocked")), "url-suffix-sums",
    )
    counts = sums.agg(F.sum("n").alias("n"), F.sum("blocked").alias("blocked")).first()
    base = (counts.blocked / counts.n) if counts.n else 0.0
    if not 0.0 < base < 1.0:
        return UrlModel(None, None, base)
    rows = stage(lexical(thinned(labelled, max_rows, counts.n)), "url-labelled")
    by = stage(
        sums.select("suffix", ((F.col("blocked") + 10 * base) / (F.col("n") + 10)).alias("suffix_rate"), F.log1p("n").alias("suffix_log_rows")),
        "url-suffixes",
    )
    if rows.select("label").distinct().count() < 2:
        return UrlModel(None, None, base)
    model = UrlModel(None, by, base)
    given = VectorAssembler(inputCols=list(FEATURES), outputCol="__features").transform(model.with_suffixes(rows)).select("__features", "label")
    model.trees = GBTClassifier(featuresCol="__features", labelCol="label", maxIter=trees, maxDepth=depth, maxBins=32, seed=seed).fit(given)
    return model


def judge(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: Sequence[tuple[str, str]] = RULES,
    labelled: DataFrame | None = None,
) -> DataFrame:
    """One row per page: id, host, path, rule (null: none fits), verdict.

    ``labelled`` (url, label 1.0: block) replaces the URLs that rules judge as
    training rows. Null URLs and such without ``://`` have empty host and path
    and get the trees' verdict; null ids and repeated rows pass through; other
    columns are ignored.
    """
    def parts(rows: DataFrame) -> DataFrame:
        host, path = host_and_path(F.col("url"))
        return rows.withColumn("host", host).withColumn("path", path)

    rows = parts(pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"))).withColumn("r", rule_of(F.col("host"), F.col("path"), rules))
    if labelled is None:
        labelled = rows.where("r is not null").withColumn("label", (F.col("r.verdict") == BLOCK).cast("double"))
    else:
        ids = [F.col(id_col).alias("id")] if id_col in labelled.columns else []
        labelled = parts(labelled.select(F.col("url").cast("string").alias("url"), F.col("label").cast("double").alias("label"), *ids))
    judged = train(labelled.drop("r")).blocked(lexical(rows))
    verdict = F.coalesce("r.verdict", F.when(F.col("blocked"), BLOCK).otherwise(ALLOW))
    return judged.select(F.col("id").alias(id_col), "host", "path", F.col("r.rule").alias("rule"), verdict.alias("verdict"))
