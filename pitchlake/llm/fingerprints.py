"""Merkle trees over a text's sections, paragraphs and phrases, in DataFrame functions only.

Sections end at blank lines, paragraphs at newlines, phrases at punctuation or
after 64 characters. A phrase's digest is an MD5; a paragraph's, section's and
the root's is the MD5 of its children's. Equal roots mean equal texts; of two
trees, the branches that differ tell where the texts do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, stage, text_or_empty

#: Longest phrase in code points, and the punctuation that ends one.
PHRASE = r"[^.,;:!?|]{1,64}[.,;:!?|]*|[.,;:!?|]+"


def phrases(text: Column) -> Column:
    """The text as array (sections) of array (paragraphs) of array (phrases)' digests.

    Joined by nothing, a newline and a blank line, the phrases give the text again.
    """
    return F.transform(
        F.split(text, "\n\n", -1),
        lambda section: F.transform(
            F.split(section, "\n", -1),
            lambda paragraph: F.transform(F.regexp_extract_all(paragraph, F.lit(PHRASE), F.lit(0)), lambda x: F.md5(x.cast("binary"))),
        ),
    )


def above(children: Column) -> Column:
    """The digest of a node from its children's."""
    return F.md5(F.concat_ws("", children).cast("binary"))


def tree(text: Column) -> Column:
    """struct(root, sections: array<digest>, paragraphs: array<array<digest>>, leaves: array<digest prefix>)."""
    def with_sections(paragraphs: Column, leaves: Column) -> Column:
        return F.transform(F.array(F.transform(paragraphs, above)), lambda sections: F.struct(
            above(sections).alias("root"), sections.alias("sections"), paragraphs.alias("paragraphs"),
            F.transform(F.flatten(F.flatten(leaves)), lambda x: F.substring(x, 1, 8)).alias("leaves"),
        ))[0]

    # arrays of one element bind what is used more than once
    return F.transform(F.array(phrases(text)), lambda leaves: F.transform(
        F.array(F.transform(leaves, lambda s: F.transform(s, above))), lambda paragraphs: with_sections(paragraphs, leaves))[0])[0]


def fingerprint(t: Column) -> Column:
    """A tree as text: root, then sections, paragraphs and phrases as shortened digests."""
    short = lambda x: F.substring(x, 1, 8)
    return F.concat_ws(
        "/", t["root"], F.concat_ws("", F.transform(t["sections"], short)),
        F.concat_ws(";", F.transform(t["paragraphs"], lambda s: F.concat_ws("", F.transform(s, short)))), F.concat_ws("", t["leaves"]),
    )


def likeness(a: Column, b: Column) -> Column:
    """1 if the roots agree, else twice the shared phrases over all phrases (each distinct one once)."""
    shared = F.size(F.array_intersect(a["leaves"], b["leaves"]))
    both = F.size(F.array_distinct(a["leaves"])) + F.size(F.array_distinct(b["leaves"]))
    return F.when(a["root"] == b["root"], 1.0).otherwise(2.0 * shared / F.greatest(both, F.lit(1)))


def edits(a: Column, b: Column) -> Column:
    """Where two trees differ: array of struct(section, paragraph), by position from 0.

    Goes down only into sections whose digests differ; a section or paragraph
    that only one tree has differs.
    """
    def paragraphs(s: Column) -> Column:
        mine, other = F.coalesce(F.get(a["paragraphs"], s), F.array().cast("array<string>")), F.coalesce(F.get(b["paragraphs"], s), F.array().cast("array<string>"))
        return F.filter(
            F.transform(F.arrays_zip(mine.alias("x"), other.alias("y")), lambda p, i: F.struct(
                s.alias("section"), i.alias("paragraph"), (~p["x"].eqNullSafe(p["y"])).alias("differs"))),
            lambda p: p["differs"],
        )

    last = F.greatest(F.size(a["sections"]), F.size(b["sections"])) - 1
    changed = F.filter(F.sequence(F.lit(0), last), lambda s: ~F.get(a["sections"], s).eqNullSafe(F.get(b["sections"], s)))
    return F.transform(F.flatten(F.transform(changed, paragraphs)), lambda p: F.struct(p["section"].alias("section"), p["paragraph"].alias("paragraph")))


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, next): each text and the text of the next id, the last one's being the first's.

    Ids are numbers; null ids come first, equal ids by their texts' hashes. Ids are
    dealt into ranges at their quantiles, and each range gets, as its last row,
    the first row of the next range: no task sees more than its range.
    """
    spark = docs.sparkSession
    n = 4 * partitions(spark)
    low = -(1 << 63)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit(low)).alias("k"), text_or_empty(text_col).alias("text"))
    bounds = rows.agg(F.percentile_approx("k", [i / n for i in range(1, n)], 20 * n).alias("b")).first().b or []
    bounds = sorted(set(bounds))
    steps = [1 << i for i in range(len(bounds).bit_length() - 1, -1, -1)]
    if bounds:
        table = F.lit(bounds)
        bucket = F.aggregate(F.lit(steps), F.lit(0), lambda at, step: F.when(
            (at + step <= len(bounds)) & (F.get(table, F.least(at + step, F.lit(len(bounds))) - 1) <= F.col("k")), at + step).otherwise(at))
    else:
        bucket = F.lit(0)
    rows = rows.withColumn("bucket", bucket)
    firsts = stage(rows.groupBy("bucket").agg(F.min("k").alias("k")), "fingerprint-ranges")
    # one row a range: a window over all of them is bounded by the number of ranges
    before = Window.orderBy("bucket")
    firsts = firsts.select(
        "bucket", "k", F.coalesce(F.lag("bucket").over(before), F.max("bucket").over(Window.partitionBy())).alias("to"))
    tie = F.xxhash64("text")
    carry = (
        rows.select("bucket", "k", "text").join(firsts, ["bucket", "k"])
        .groupBy("to").agg(F.min_by("text", tie).alias("text"))
        .select(F.lit(None).cast(docs.schema[id_col].dataType).alias("id"), F.lit(None).cast("long").alias("k"), "text", F.col("to").alias("bucket"), F.lit(True).alias("carried"))
    )
    dealt = rows.withColumn("carried", F.lit(False)).unionByName(carry).repartition(partitions(spark), "bucket")
    order = Window.partitionBy("bucket").orderBy("carried", "k", tie)
    return dealt.withColumn("next", F.lead("text").over(order)).where("not carried").select("id", "text", "next")


def compare_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next, edited_paragraphs, first_edit
    ("section.paragraph", null where nothing changed).

    The edited text has its last quarter replaced by as much of the start of the
    next document. Null text counts as empty (its tree has one empty paragraph);
    null ids come first; repeated rows each have a row; other columns are ignored.
    """
    quarter = F.floor(F.char_length("text") / 4).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), F.char_length("text") - quarter), F.substr("next", F.lit(1), quarter))
    t = lambda name: F.col(f"t_{name}")
    rows = (
        with_next(docs, id_col, text_col).withColumn("edited", edited)
        .select("id", F.char_length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                tree(F.col("text")).alias("t_text"), tree(F.col("edited")).alias("t_edited"), tree(F.col("next")).alias("t_next"))
        .withColumn("changed", edits(t("text"), t("edited")))
    )
    return rows.select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256",
        fingerprint(t("text")).alias("fingerprint"), fingerprint(t("edited")).alias("edited_fingerprint"),
        likeness(t("text"), t("edited")).alias("near_edited"), likeness(t("text"), t("next")).alias("near_next"),
        F.size("changed").cast("long").alias("edited_paragraphs"),
        F.concat_ws(".", F.get("changed", F.lit(0))["section"].cast("string"), F.get("changed", F.lit(0))["paragraph"].cast("string")).alias("first_edit"),
    ).withColumn("first_edit", F.expr("nullif(first_edit, '')"))
