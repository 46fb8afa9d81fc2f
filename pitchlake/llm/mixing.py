"""Mix sources to target weights by Poisson replication.

A source's rate is its target share of the output over its share of the input,
so a document appears as often as a Poisson draw with that mean says. The draw
inverts the distribution at a number in [0, 1) that a hash of seed, id and text
gives: it depends on the document alone, not on partitions or retries.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage

#: Hash digits used: 13 hex digits are 52 bits, exact in a double.
HEX_DIGITS = 13


def uniform(seed: int, *columns: str) -> Column:
    """A number in [0, 1) from MD5 of the seed and the columns (null: empty text)."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HEX_DIGITS), 16, 10).cast("double") / float(16**HEX_DIGITS)


def cumulative(rate: Column) -> Column:
    """Poisson probabilities of at most 0, 1, 2, ... up to far beyond the mean.

    The last entries equal the limit that doubles reach, so no draw is cut off.
    Rates are taken in pieces of 500 at most by the caller (exp must not vanish).
    """
    terms = F.sequence(F.lit(1), F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int"))
    first = F.exp(-rate)
    steps = F.aggregate(
        terms,
        F.struct(first.alias("p"), F.array(first).alias("sums")),
        lambda a, k: F.struct(
            (a.p * rate / k).alias("p"),
            F.concat(a.sums, F.array(F.element_at(a.sums, -1) + a.p * rate / k)).alias("sums"),
        ),
        lambda a: a.sums,
    )
    return steps


def rates(docs: DataFrame, source_col: str = "source", weights: Mapping[str, float] | None = None, out_rows: float | None = None) -> DataFrame:
    """(source, rows, rate, sums): one row per source, null being a source.

    ``weights`` maps sources to target weights; by default all weigh the same.
    A source without a weight, where weights are given, gets rate 0.
    ``out_rows`` is the expected number of output rows, by default the input's.
    """
    sources = docs.groupBy(F.col(source_col).alias("source")).agg(F.count("*").alias("rows"))
    if weights is None:
        weight = F.lit(1.0)
    elif weights:
        table = F.create_map(*[F.lit(x) for k, w in weights.items() for x in (k, float(w))])
        weight = F.coalesce(table[F.coalesce(F.col("source").cast("string"), F.lit(""))], F.lit(0.0))
    else:
        weight = F.lit(0.0)
    sources = stage(sources.withColumn("weight", weight), "mix-sources")
    total = sources.agg(F.sum("weight").alias("weight"), F.sum("rows").alias("rows")).first()
    out = float(out_rows if out_rows is not None else total.rows or 0)
    rate = F.col("weight") / F.lit(float(total.weight)) * F.lit(out) / F.col("rows") if total.weight else F.lit(0.0)
    return (
        sources.select("source", "rows", rate.alias("rate"))
        .withColumn("whole", F.floor(F.col("rate") / 500).cast("int"))
        .withColumn("sums", cumulative(F.col("rate") - 500.0 * F.col("whole")))
        .withColumn("sums500", F.when(F.col("whole") > 0, cumulative(F.lit(500.0))))
    )


def draw(sums: Column, u: Column) -> Column:
    """The least k whose cumulative probability exceeds u."""
    return F.size(F.filter(sums, lambda c: c <= u))


def mix(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", weights: Mapping[str, float] | None = None,
    out_rows: float | None = None, seed: int = 42, shuffle: bool = True, replica_col: str | None = None,
) -> DataFrame:
    """The documents, each as often as its draw says, in a globally random order.

    All columns stay; ``replica_col`` adds the copy's number from 0. A document's
    draw depends on seed and id: rows that share an id share their fate. A null
    id draws like the empty text; a null source is a source. A rate above 500
    adds independent draws of mean 500. Sources join by a shuffle that Spark
    splits where one is hot, or by a broadcast where their table is small.
    An empty table gives an empty table.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    given = docs.select(row.alias("row"), F.col(f"`{source_col}`").alias("key"), uniform(seed, id_col).alias("u"),
                        F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("name"))
    by = rates(docs, source_col, weights, out_rows)
    joined = given.join(by, given["key"].eqNullSafe(by["source"]))
    extra = F.aggregate(
        F.when(F.col("whole") > 0, F.sequence(F.lit(1), F.col("whole"))).otherwise(F.array().cast("array<int>")), F.lit(0),
        lambda a, k: a + draw(
            F.col("sums500"),
            F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(f"{seed}/500"), k.cast("string"), F.col("name")).cast("binary")), 1, HEX_DIGITS), 16, 10)
            .cast("double") / float(16**HEX_DIGITS)),
    )
    n = draw(F.col("sums"), F.col("u")) + extra
    copies = joined.withColumn("n", n).where("n > 0").select(
        "row", "name", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("copy"))
    if shuffle:
        copies = (
            copies.withColumn("at", F.xxhash64(F.lit(seed), "name", "copy"))
            .repartition(F.col("at")).sortWithinPartitions("at")
        )
    return copies.select("row.*", *([F.col("copy").alias(replica_col)] if replica_col else []))
