"""Language identification by words first, then shorter and shorter character n-grams (operator 10).

A model holds per-language log frequencies of words and of character n-grams of one to five letters,
all that occur in the documents it is fitted on. A known word is scored by its frequencies; an unseen
word by its n-grams of the greatest order of which the model knows any, down to single letters.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import pieces, shared

#: The model is fitted on about this many labelled documents of each language at most, drawn by a
#: hash of id and text; this bounds its vocabulary, of which nothing is left out.
FIT_DOCUMENTS = 1_000
#: Characters counted of one of these.
FIT_CHARACTERS = 1 << 17
ORDERS = (5, 4, 3, 2, 1)
#: Share of each language's probability that is spread evenly over all items of a table.
UNSEEN = 0.1
#: Words whose scores a task keeps in memory.
CACHE_WORDS = 200_000
_WORD = re.compile(r"[^\W\d_]+")


def words(text: str) -> list[str]:
    """Runs of letters in lower case."""
    return _WORD.findall(text.lower())


def grams(word: str, n: int) -> list[str]:
    marked = f"<{word}>"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)] if n > 1 else list(word)


@dataclass
class Model:
    languages: list[str]
    #: word -> row of word_scores; the row holds log P(word | language).
    word_rows: dict[str, int]
    word_scores: np.ndarray
    #: order -> (n-gram -> row, rows of log P(n-gram | language)).
    grams: dict[int, tuple[dict[str, int], np.ndarray]]

    def of_word(self, word: str) -> np.ndarray:
        row = self.word_rows.get(word)
        if row is not None:
            return self.word_scores[row]
        for n in ORDERS:
            rows, scores = self.grams.get(n, ({}, None))
            known = [r for g in grams(word, n) if (r := rows.get(g)) is not None]
            if known:
                return scores[known].mean(axis=0)
        return np.zeros(len(self.languages))


class Scorer(dict):
    """Word -> its row in a growing table of scores."""

    def __init__(self, model: Model):
        super().__init__()
        self.model, self.rows = model, np.zeros((1024, max(1, len(model.languages))))

    def __missing__(self, word: str) -> int:
        at = len(self)
        if at == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[at] = self.model.of_word(word)
        self[word] = at
        return at

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.model.languages:
            return "und", 0.0
        total, any_word = np.zeros(self.rows.shape[1]), False
        for piece in pieces.cut(text or ""):
            if len(self) > CACHE_WORDS:
                self.clear()
            if found := words(piece):
                at = np.fromiter(map(self.__getitem__, found), np.int64, len(found))
                total, any_word = total + self.rows[at].sum(axis=0), True
        if not any_word:
            return "und", 0.0
        best = int(total.argmax())  # ties: the first language by name
        return self.model.languages[best], float(1 / np.exp(np.clip(total - total[best], -700, 0)).sum())


def counts(docs: DataFrame) -> DataFrame:
    """lang, word, n over whole texts. Each task counts words in memory in bounded portions before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(found: dict[str, Counter]) -> pa.RecordBatch:
            rows = [(lang, w, n) for lang, c in found.items() for w, n in c.items()]
            return pa.RecordBatch.from_pydict({"lang": pa.array([r[0] for r in rows], pa.string()), "word": pa.array([r[1] for r in rows], pa.string()), "n": pa.array([r[2] for r in rows], pa.int64())})

        found: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for piece in pieces.cut(text.as_py()):
                    found.setdefault(lang, Counter()).update(words(piece))
            if sum(map(len, found.values())) > 200_000:
                yield out(found)
                found = {}
        if found:
            yield out(found)

    counted = docs.select("lang", "text").mapInArrow(count, "lang string, word string, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def scored(rows: pa.Table, languages: list[str]) -> tuple[dict[str, int], np.ndarray]:
    """Item -> row, and the rows of log frequencies, from lang, item and n.

    A share UNSEEN of each language's probability is spread over all items and one class for others,
    so that an item that a language lacks weighs the same whatever the language's size.
    """
    items: dict[str, int] = {}
    at = [items.setdefault(x, len(items)) for x in rows.column(1).to_pylist()]
    places = {x: i for i, x in enumerate(languages)}
    table = np.zeros((len(items), len(languages)))
    np.add.at(table, (at, [places[x] for x in rows.column(0).to_pylist()]), rows.column(2).to_numpy())
    share = table / np.maximum(table.sum(axis=0), 1)
    return items, np.log((1 - UNSEEN) * share + UNSEEN / (len(items) + 1))


def drawn(docs: DataFrame, fit_documents: int) -> tuple[DataFrame, list[str]]:
    """Labelled rows, at most about fit_documents of each language and FIT_CHARACTERS characters of each row, and the languages."""
    labelled = docs.select("doc_id", "text", "lang").where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    sizes = {r[0]: r[1] for r in labelled.groupBy("lang").count().collect()}  # one row a language
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20))
    out = F.lit(False)
    for lang, n in sizes.items():
        out = out | ((F.col("lang") == lang) & (place < math.ceil(min(1.0, fit_documents / n) * (1 << 20))))
    # Of a longer text, pieces from all over it.
    n, parts = F.length("text"), 64
    piece = lambda i: F.substring(F.col("text"), (F.floor(i * n / parts) + 1).cast("int"), F.lit(FIT_CHARACTERS // parts))
    bounded = F.when(n > FIT_CHARACTERS, F.array_join(F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), piece), " ")).otherwise(F.col("text"))
    return labelled.where(out).withColumn("text", bounded), sorted(sizes)


def fit(docs: DataFrame, fit_documents: int = FIT_DOCUMENTS) -> Model:
    """A model from the columns text and lang; rows with a null in either are left out.

    At most about fit_documents rows of each language are counted, on the executors; the counts of
    these reach the driver. A rare language has all its rows.
    """
    labelled, languages = drawn(docs, fit_documents)
    with shared.scratch():
        by_word = shared.written(counts(labelled), "word-counts")
        word_rows, word_scores = scored(by_word.select("lang", "word", "n").toArrow(), languages)
        tables = {}
        for order in ORDERS:
            marked = F.concat(F.lit("<"), "word", F.lit(">")) if order > 1 else F.col("word")
            parts = F.transform(F.sequence(F.lit(1), F.length(marked) - (order - 1)), lambda i: F.substring(F.col("marked"), i, F.lit(order)))
            exploded = by_word.withColumn("marked", marked).where(F.length("marked") >= order).select("lang", "n", F.explode(parts).alias("gram"))
            tables[order] = scored(exploded.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow(), languages)
    return Model(languages, word_rows, word_scores, tables)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score for every row; ``und`` with score 0 where text is null or has no letter.

    The model (bounded by its fit) is broadcast. score is the posterior of the best language under
    equal priors. Texts are scored whole.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Model(**shipped.value))
        for batch in batches:
            found = [scorer.predict(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "lang_pred": pa.array([x[0] for x in found], pa.string()), "score": pa.array([x[1] for x in found], pa.float64())})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def op10_language_id(spark, sf_dir: str) -> DataFrame:
    """The predicted language of every whole text, learned from documents that are not held out.

    Null texts and texts without letters are ``und``; of languages that score alike the first by name
    is taken. Repeated rows each get their row; a null doc_id counts as the empty text in the split.
    Without any labelled row every prediction is ``und``; an empty table gives no rows. Very long
    texts are scored in pieces; other columns are ignored.
    """
    docs = shared.table(spark, sf_dir, "documents")
    model = fit(docs.where(shared.bucket_of_id(F.col("doc_id")) != 2))
    held_out = (shared.bucket_of_id(F.col("doc_id")) == 2).alias("held_out")
    return predict(docs, model).select("doc_id", held_out, "lang_pred", "score")
