"""Language identification, words first.

A model holds per-language log frequencies of each language's most frequent words and
character n-grams. A known word scores by its own frequencies; an
unseen one by those of its longest n-grams that are known, each shorter length
at a discount, down to single characters. A word that one language has and another has
not counts there as the rarest word of the largest language would, so few labelled
words never make a language likely for what it has not seen.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, stage, text_or_empty

UNDETERMINED = "und"
WORD = re.compile(r"[^\W\d_]+")
NGRAMS = (5, 4, 3, 2, 1)
#: Bounds of the model, shared out evenly among its languages, and of the documents that it
#: is fitted on (expected number for each language).
MAX_WORDS, MAX_NGRAMS, MAX_FIT_DOCS = 60_000, 60_000, 4_000
#: Bounds of a task's table of scored unseen words, and of the words of a text that are summed at a time.
CACHE_WORDS, BLOCK_WORDS = 200_000, 20_000
#: Bytes of ASCII text to themselves if they are letters, else to a space.
LETTERS = bytes(i if chr(i).isalpha() and i < 128 else 32 for i in range(256))


@dataclass
class Model:
    languages: list[str]
    prior: np.ndarray
    words: dict[str, np.ndarray]
    ngrams: dict[str, np.ndarray]
    discount: float = 0.5  # weight of a word for each step down in n-gram length

    def word(self, word: str) -> np.ndarray:
        """Log-likelihood of one word under each language, centred."""
        if (known := self.words.get(word)) is not None:
            return known
        padded, weight = f"<{word}>", 1.0
        for n in NGRAMS:
            weight *= self.discount
            found = [v for i in range(len(padded) - n + 1) if (v := self.ngrams.get(padded[i : i + n])) is not None]
            if found:
                return weight * np.mean(found, axis=0)
        return np.zeros(len(self.languages))


def words_of(text: str) -> list[str]:
    """Lower-cased runs of letters, in order."""
    text = text.lower()
    return text.encode().translate(LETTERS).decode().split() if text.isascii() else WORD.findall(text)


def word_counts(text: str) -> Counter:
    return Counter(words_of(text))


def held_out(id_col: str, folds: int = 3, fold: int = 1) -> Column:
    """True if the crc32 of the id as text leaves that remainder (null id: text "")."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds == fold


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, kind, gram, n) of each slice: words of kind 0, n-grams of kind 1."""
    for b in slices(batches):
        of: dict[str, Counter] = {}
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            of.setdefault(lang, Counter()).update(word_counts(text))
        rows = [(lang, 0, w, n) for lang, c in of.items() for w, n in c.items()]
        for lang, c in of.items():
            grams: Counter = Counter()
            for w, n in c.items():
                padded = f"<{w}>"
                for size in NGRAMS:
                    for i in range(len(padded) - size + 1):
                        grams[padded[i : i + size]] += n
            rows += [(lang, 1, g, n) for g, n in grams.items()]
        columns = list(zip(*rows, strict=True)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.string(), pa.int64()), strict=True)],
            names=["lang", "kind", "gram", "n"],
        )


def _log_frequencies(rows: list, languages: list[str], totals: np.ndarray) -> dict[str, np.ndarray]:
    """By entry, each language's log frequency over that of an unseen entry, which is the
    same for all languages: half a count in the largest one. Half a count for each entry
    of the table is set aside in every language."""
    at, table, aside = {x: i for i, x in enumerate(languages)}, {}, 0.5 * len(rows)
    unseen = np.log(0.5 / (totals.max(initial=0.0) + aside)) if rows else 0.0
    for r in rows:
        v = np.zeros(len(languages))
        for lang, n in zip(r.langs, r.ns, strict=True):
            i = at[lang]
            v[i] = np.log((n + 0.5) / (totals[i] + aside)) - unseen
        table[r.gram] = v
    return table


def fit(
    labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", key: Column | None = None,
    max_docs: int = MAX_FIT_DOCS, max_words: int = MAX_WORDS, max_ngrams: int = MAX_NGRAMS,
) -> Model:
    """Fit on rows with non-null text and language.

    Of a language with more than ``max_docs`` rows, those whose hash of ``key``
    (by default of the text) falls under the share are taken, so about
    ``max_docs``. Every language of the labels is learnt. The model keeps each
    language's most frequent words and n-grams, ``max_words`` and ``max_ngrams`` of them
    divided by the number of languages: what reaches the driver and the tasks is bounded
    by these parameters, not by the data.
    """
    rows = labelled.select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"),
        (F.pmod(F.xxhash64(key if key is not None else F.col(text_col)), F.lit(1 << 20)) / float(1 << 20)).alias("at"),
    ).where("lang is not null and text is not null")
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model([], np.zeros(0), {}, {})
    languages = sorted(sizes)
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, max_docs / n)])
    counts = stage(
        rows.where(F.col("at") < share[F.col("lang")]).select("lang", "text")
        .mapInArrow(_grams, "lang string, kind int, gram string, n long")
        .groupBy("lang", "kind", "gram").agg(F.sum("n").alias("n")), "langid-counts",
    )
    totals = {(r.kind, r.lang): r.n for r in counts.groupBy("kind", "lang").agg(F.sum("n").alias("n")).collect()}
    tables = []
    for kind, most in ((0, max_words), (1, max_ngrams)):
        own = counts.where(F.col("kind") == kind)
        place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
        kept = own.withColumn("place", place).where(F.col("place") <= max(1, most // len(languages))).select("gram").distinct()
        top = (
            own.join(kept, "gram").groupBy("gram").agg(F.collect_list(F.struct("lang", "n")).alias("by"))
            .select("gram", F.col("by.lang").alias("langs"), F.col("by.n").alias("ns")).collect()
        )
        sums = np.array([float(totals.get((kind, x), 0)) for x in languages])
        tables.append(_log_frequencies(top, languages, sums))
    prior = np.array([min(sizes[x], max_docs) for x in languages], float)
    return Model(languages, np.log(prior / prior.sum()), *tables)


class Scorer:
    """Sums of a model's word scores, as ``Model.word`` gives them, in whole arrays.

    Known words have fixed rows; unseen ones get rows as they come, up to
    ``room``, when the table starts anew.
    """

    def __init__(self, model: Model, room: int = CACHE_WORDS):
        self.model, width = model, len(model.languages)
        self.known = {w: i for i, w in enumerate(model.words)}
        self.grams = {g: i for i, g in enumerate(model.ngrams)}
        self.gram_rows = np.array(list(model.ngrams.values()), float).reshape(len(self.grams), width)
        self.rows = np.zeros((len(self.known) + max(room, BLOCK_WORDS), width))
        self.rows[: len(self.known)] = np.array(list(model.words.values()), float).reshape(len(self.known), width)
        self.place = dict(self.known)

    def learn(self, words: list[str]) -> None:
        """Rows for unseen words: the mean of their longest known n-grams, at the discount."""
        flat, starts, sizes, weights, at = [], [], [], [], []
        for k, word in enumerate(words, len(self.place)):
            padded, weight = f"<{word}>", 1.0
            self.place[word] = k
            for n in NGRAMS:
                weight *= self.model.discount
                found = [i for j in range(len(padded) - n + 1) if (i := self.grams.get(padded[j : j + n])) is not None]
                if found:
                    starts.append(len(flat))
                    flat += found
                    sizes.append(len(found))
                    weights.append(weight)
                    at.append(k)
                    break
            else:
                self.rows[k] = 0.0
        if at:
            sums = np.add.reduceat(self.gram_rows[flat], starts, axis=0)
            self.rows[at] = sums / np.array(sizes)[:, None] * np.array(weights)[:, None]

    def total(self, words: list[str]) -> np.ndarray:
        """The prior and the scores of all words."""
        total = self.model.prior.copy()
        for i in range(0, len(words), BLOCK_WORDS):
            block, place = words[i : i + BLOCK_WORDS], self.place
            unseen = [w for w in dict.fromkeys(block) if w not in place]
            if len(self.place) + len(unseen) > len(self.rows):
                self.place = dict(self.known)
                unseen = [w for w in dict.fromkeys(block) if w not in self.place]
            if unseen:
                self.learn(unseen)
            total += self.rows[list(map(self.place.__getitem__, block))].sum(axis=0)
        return total

    def score(self, text: str) -> tuple[str, float]:
        """The likeliest language and its posterior; ties go to the first by name."""
        if not self.model.languages or not any(c.isalpha() for c in text):
            return UNDETERMINED, 0.0
        total = self.total(words_of(text))
        total = np.exp(total - total.max())
        best = int(total.argmax())
        return self.model.languages[best], float(total[best] / total.sum())


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[Column, ...] = ()) -> DataFrame:
    """One row per document: id, the columns of ``keep``, lang_pred and score (0 to 1).

    Null text, text without a letter and an empty model give ``und`` with score
    0. Null ids and repeated rows pass through; other columns are ignored.
    """
    given = docs.select(text_or_empty(text_col).alias("__text"), F.col(id_col), *keep)
    schema = T.StructType([*given.schema.fields[1:], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by max_words and max_ngrams

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for b in slices(batches):
            found = [scorer.score(t) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[1:], pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())],
                names=schema.names,
            )

    return given.mapInArrow(run, schema)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Fit on the documents that aren't held out, then predict all of them:
    id, held_out, lang_pred, score. See ``fit`` and ``predict`` for nulls."""
    model = fit(docs.where(~held_out(id_col)), text_col, lang_col, key=F.col(id_col))
    return predict(docs, model, id_col, text_col, keep=(held_out(id_col).alias("held_out"),))
