"""Language identification, words first and character n-grams for the rest.

Training counts every word of every labelled document by language.  A word of
the model scores its log frequency in each language.  Another word is read as
character n-grams: at each place the longest n-gram the model knows, so an
unseen n-gram falls back to a shorter one.  The document's language is that
with the highest sum.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pingzones.llm.common import stored

UNKNOWN = "und"
# Longest n-gram of characters; a word is read with a mark at both ends.
LONGEST = 4
MARK = "\x00"
# Entries of the model: the most frequent ones.  They bound what is sent to the
# executors; words beyond them are what the n-grams are for.
MAX_WORDS = 200_000
MAX_GRAMS = 100_000
# Steps of a frequency's doubling, in the histogram that finds the least one taken.
STEPS = 16
# Added to every count.
SMOOTHING = 0.5
# A prediction below this is no acceptance.
LEAST_SCORE = 0.5
# Unseen words whose score a task remembers.
REMEMBERED = 200_000

_WORD = regex.compile(r"\p{L}+")


def held_out(id_: str = "doc_id") -> Column:
    """Documents that training leaves aside; a null id is not one of them."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_).cast("string")), F.lit(4)) == 2, F.lit(False))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, entry, n) of the words of each batch of (lang, text)."""
    for batch in batches:
        counts: dict[str, Counter] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            counts.setdefault(lang, Counter()).update(_WORD.findall(text.as_py().lower()))
        yield _as_batch(counts)


def _grams(word: str) -> list[str]:
    marked = MARK + word + MARK
    return [marked[i : i + k] for k in range(1, LONGEST + 1) for i in range(len(marked) - k + 1)]


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, entry, n) of the n-grams of each batch of (lang, entry, n)."""
    for batch in batches:
        counts: dict[str, Counter] = {}
        for lang, word, n in zip(*(c.to_pylist() for c in batch.columns)):
            of_lang = counts.setdefault(lang, Counter())
            for gram in _grams(word):
                of_lang[gram] += n
        yield _as_batch(counts)


def _as_batch(counts: dict[str, Counter]) -> pa.RecordBatch:
    rows = [(lang, entry, n) for lang, c in counts.items() for entry, n in c.items()]
    columns = list(zip(*rows)) or [(), (), ()]
    kinds = (pa.string(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["lang", "entry", "n"])


def _most_frequent(counts: DataFrame, most: int, langs: list[str]) -> tuple[list[str], np.ndarray]:
    """The ``most`` frequent entries, of equal ones the first by name, and their counts in each language.

    A histogram in small steps tells which entries are taken; only those of the step
    that is taken in part are put in order.
    """
    per_lang = [F.sum(F.when(F.col("lang") == x, F.col("n")).otherwise(0)).alias(f"n{i}") for i, x in enumerate(langs)]
    table = counts.groupBy("entry").agg(F.sum("n").alias("n"), *per_lang)
    table = stored(table.withColumn("step", F.floor(F.log2("n") * STEPS)), "language-entries")
    left, rows = most, table
    for r in table.groupBy("step").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("step")).collect():
        if r["n"] > left:
            in_part = table.filter(F.col("step") == r["step"]).orderBy(F.desc("n"), "entry").limit(left)
            rows = table.filter(F.col("step") > r["step"]).unionByName(in_part)
            break
        left -= r["n"]
    rows = rows.drop("n", "step").toPandas().sort_values("entry")
    return rows["entry"].tolist(), rows.drop(columns="entry").to_numpy(np.float64).reshape(-1, len(langs))


@dataclass
class LanguageModel:
    languages: list[str]
    words: dict[str, int]
    word_scores: np.ndarray
    grams: dict[str, int]
    gram_scores: np.ndarray

    def unseen(self, word: str) -> np.ndarray:
        """Mean score of the longest known n-grams, one from each place of the word."""
        marked, found = MARK + word + MARK, []
        for i in range(len(marked)):
            for k in range(min(LONGEST, len(marked) - i), 0, -1):
                at = self.grams.get(marked[i : i + k])
                if at is not None:
                    found.append(at)
                    break
        return self.gram_scores[found].sum(axis=0) / len(marked)

    def predict(self, text: str | None, remembered: dict[str, np.ndarray]) -> tuple[str, float]:
        found = _WORD.findall(text.lower()) if text else []
        if not found or not self.languages:
            return UNKNOWN, 0.0
        at = list(map(self.words.get, found))
        total = self.word_scores[[a for a in at if a is not None]].sum(axis=0)
        scores = []
        for word in [w for w, a in zip(found, at) if a is None]:
            score = remembered.get(word)
            if score is None:
                if len(remembered) >= REMEMBERED:
                    remembered.clear()
                score = remembered[word] = self.unseen(word)
            scores.append(score)
        if scores:
            total = total + np.sum(scores, axis=0)
        best = int(np.argmax(total))
        return self.languages[best], float(1 / np.exp(total - total[best]).sum())


def train(docs: DataFrame, text: str = "text", lang: str = "lang", id_: str = "doc_id") -> LanguageModel:
    """The model of all documents with a text and a language that are not held out.

    Counts are over all of them; only the most frequent entries come to the driver.
    """
    labelled = docs.filter(F.col(text).isNotNull() & F.col(lang).isNotNull() & ~held_out(id_))
    kind = "lang string, entry string, n long"
    per_batch = labelled.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    summed = F.sum("n").alias("n")
    counts = stored(
        per_batch.mapInArrow(_count_words, kind).groupBy("lang", "entry").agg(summed), "language-words"
    )
    grams = stored(counts.mapInArrow(_count_grams, kind).groupBy("lang", "entry").agg(summed), "language-grams")
    totals = counts.groupBy("lang").agg(summed).orderBy("lang").collect()
    langs = [r["lang"] for r in totals]
    if not langs:
        return LanguageModel([], {}, np.zeros((0, 0)), {}, np.zeros((0, 0)))
    words, n = _most_frequent(counts, MAX_WORDS, langs)
    all_words = np.array([r["n"] for r in totals], np.float64)
    word_scores = np.log(n + SMOOTHING) - np.log(all_words + SMOOTHING * (len(words) + 1))
    pieces, m = _most_frequent(grams, MAX_GRAMS, langs)
    lengths = np.array([len(p) for p in pieces])
    gram_scores = np.zeros_like(m)
    for k in range(1, LONGEST + 1):
        of_k = lengths == k
        gram_scores[of_k] = np.log(m[of_k] + SMOOTHING) - np.log(m[of_k].sum(axis=0) + SMOOTHING * (of_k.sum() + 1))
    index = lambda entries: {e: i for i, e in enumerate(entries)}
    return LanguageModel(langs, index(words), word_scores, index(pieces), gram_scores)


def identify(
    docs: DataFrame, model: LanguageModel, text: str = "text", carry: list[str] | None = None
) -> DataFrame:
    """The columns ``carry`` (default: all) of every row, with ``lang_pred`` and ``score``.

    Null texts and texts without a letter get ``und`` and 0; so does every text
    if nothing was labelled.  Equal sums go to the language first by name.  Long
    texts are read whole.  Columns named like the two new ones are replaced.
    """
    kept = [c for c in carry or docs.columns if c not in ("lang_pred", "score")]
    rows = docs.select(*kept, F.col(text).alias("_text"))
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, remembered = LanguageModel(**shared.value), {}
        for batch in batches:
            found = [known.predict(t.as_py(), remembered) for t in batch.column(len(kept))]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[: len(kept)],
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                ],
                [*kept, "lang_pred", "score"],
            )

    fields = [f for f in rows.schema if f.name in kept]
    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return rows.mapInArrow(run, T.StructType([*fields, *added]))


def in_known_language(docs: DataFrame, text: str = "text", lang: str = "lang", id_: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose language is told with a score of ``LEAST_SCORE`` or more.

    If no document is labelled, those with a letter stay.
    """
    model = train(docs, text, lang, id_)
    if not model.languages:
        return docs.filter(F.col(text).rlike(r"\p{L}"))
    # Told apart from columns of the documents by their place.
    named = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    judged = identify(named, model, f"c{docs.columns.index(text)}")
    kept = judged.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return kept.select(*named.columns).toDF(*docs.columns)
