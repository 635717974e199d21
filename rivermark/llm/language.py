"""Language identification, words first.

A word that the training texts have is scored by its log frequency in each language. A word they
have not is scored by its character n-grams: the longest length at which one of them is known
decides, from five characters down to one, word ends included. A text's language is the one with the greatest
sum; ties go to the language that sorts first. The score is that language's share after a softmax over the
languages, on the mean per word times at most ``WEIGHT`` words.

The model is fitted on a bounded sample of the training rows, taken by a hash of the id: about ``ROWS`` whole
texts and at most ``CHARACTERS`` per language; a text that does not fit is left out and the next ones may fit, and
a language of which none fits trains on its shortest. This bounds the model that is sent to the executors. Every
whole text is scored, without a shuffle.

Words are runs of letters, in lower case. A null text, or one without a letter, is ``und`` with score 0, and so
is every text when there is nothing to learn from. Rows with a null or empty text train nothing. Repeated rows get
equal results.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivermark.llm.rows import col, fitting_rows, free_name, in_training
from rivermark.llm.spans import look_up, prefix_sums, slices, span_hash

LONGEST = 5
ROWS = 2000
CHARACTERS = 1_000_000
WEIGHT = 20
SMOOTHING = 0.1
UNDETERMINED = "und"
COUNTS = "language string, length int, hash long, n long"


@cache
def letters() -> np.ndarray:
    return np.array([chr(n).isalpha() for n in range(0x110000)])


class LetterWords:
    """Words of texts as spans of code points, and the distinct ones among them."""

    def __init__(self, texts: pa.Array):
        strings = [text + "\n" for text in pc.utf8_lower(pc.fill_null(texts, "")).to_pylist()]
        self.codes = np.frombuffer("".join(strings).encode("utf-32-le"), np.uint32)
        inside = np.concatenate([[False], letters()[self.codes], [False]])
        self.starts = np.flatnonzero(inside[1:] & ~inside[:-1])
        self.ends = np.flatnonzero(inside[:-1] & ~inside[1:])
        cuts = np.concatenate([[0], np.cumsum([len(s) for s in strings])])
        self.counts = np.diff(np.searchsorted(self.starts, cuts))
        self.text_of = np.repeat(np.arange(len(strings)), self.counts)
        hashes = span_hash(prefix_sums(self.codes), self.starts, self.ends)
        self.hashes, self.sample, self.which = np.unique(hashes, return_index=True, return_inverse=True)

    def grams(self, chosen: np.ndarray):
        """For each length from the longest: (word, hash) of the n-grams of some distinct words, ends marked by a space."""
        starts, sizes = self.starts[self.sample[chosen]], self.ends[self.sample[chosen]] - self.starts[self.sample[chosen]]
        begin = np.cumsum(sizes + 1) - sizes  # a space before each word, and one after the last
        codes = np.full(int((sizes + 1).sum()) + 1, ord(" "), np.uint32)
        within = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        codes[np.repeat(begin, sizes) + within] = self.codes[np.repeat(starts, sizes) + within]
        sums = prefix_sums(codes)
        for length in range(LONGEST, 0, -1):
            first = begin - (length > 1)  # single characters have no ends to mark
            count = np.maximum(sizes + (2 if length > 1 else 0) - length + 1, 0)
            word = np.repeat(np.arange(len(chosen)), count)
            at = np.repeat(first, count) + np.arange(len(word)) - np.repeat(np.cumsum(count) - count, count)
            yield length, word, span_hash(sums, at, at + length)


@dataclass
class Model:
    """Log frequencies by language: of words (length 0) and of n-grams."""

    languages: list[str]
    keys: list[np.ndarray]
    logs: list[np.ndarray]

    def word_scores(self, words: LetterWords) -> np.ndarray:
        """One row per distinct word."""
        at, known = look_up(self.keys[0], words.hashes)
        out = np.zeros((len(words.hashes), len(self.languages)))
        out[known] = self.logs[0][at[known]]
        rest = np.flatnonzero(~known)
        if not len(rest):
            return out
        open_ = np.ones(len(rest), bool)
        for length, word, gram in words.grams(rest):
            mine = open_[word]
            word, gram = word[mine], gram[mine]
            at, found = look_up(self.keys[length], gram)
            word, at = word[found], at[found]
            if not len(word):
                continue
            count = np.bincount(word, minlength=len(rest))
            hit = count > 0
            for n in range(len(self.languages)):
                total = np.bincount(word, self.logs[length][at, n], len(rest))
                out[rest[hit], n] = total[hit] / count[hit]
            open_ &= ~hit
        return out

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        words = LetterWords(texts)
        each = self.word_scores(words)[words.which]
        sums = np.stack([np.bincount(words.text_of, each[:, n], len(texts)) for n in range(len(self.languages))], 1)
        best = sums.argmax(axis=1)
        some = words.counts > 0
        mean = (sums - sums.max(axis=1, keepdims=True)) / np.maximum(words.counts, 1)[:, None]
        share = 1 / np.exp(mean * np.minimum(words.counts, WEIGHT)[:, None]).sum(axis=1)
        names = [self.languages[n] if ok else UNDETERMINED for n, ok in zip(best, some)]
        return names, np.where(some, share, 0.0)


def count_text(batches):
    """Words and n-grams by language, added up within each slice."""
    for batch in batches:
        for part in slices(batch, "text"):
            language = part.column("language").to_pylist()
            for name in sorted(set(language)):
                words = LetterWords(part.column("text").filter(pa.array([x == name for x in language])))
                if not len(words.hashes):
                    continue
                n = np.bincount(words.which)
                found = [(0, words.hashes, n)]
                for length, word, gram in words.grams(np.arange(len(words.hashes))):
                    hashes, which = np.unique(gram, return_inverse=True)
                    if len(hashes):
                        found.append((length, hashes, np.bincount(which, n[word]).astype(np.int64)))
                for length, hashes, n in found:
                    columns = [np.full(len(hashes), length, np.int32), hashes.view(np.int64), n.astype(np.int64)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(hashes)), *map(pa.array, columns)], names=["language", "length", "hash", "n"]
                    )


def sample(documents: DataFrame, id_column: str, text_column: str, lang_column: str, rows: int, characters: int) -> DataFrame:
    """(language, text) of a bounded number of whole texts per language."""
    known = documents.where(col(lang_column).isNotNull() & (F.length(col(text_column)) > 0)).select(
        col(lang_column).cast("string").alias("language"),
        col(text_column).cast("string").alias("text"),
        F.pmod(F.xxhash64(col(id_column), col(text_column)), F.lit(1 << 30)).alias("place"),
    )
    counts = known.groupBy("language").agg(F.count("*").alias("n")).collect()
    share = F.lit(0)
    for row in counts:
        share = F.when(F.col("language") == row.language, int((1 << 30) * min(1.0, rows / row.n))).otherwise(share)
    return fitting_rows(known.where(F.col("place") < share), "language", characters).select("language", "text")


def train(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    rows: int = ROWS,
    characters: int = CHARACTERS,
) -> Model:
    """A model from the rows of ``documents`` with a language."""
    chosen = sample(documents, id_column, text_column, lang_column, rows, characters)
    counts = chosen.mapInArrow(count_text, COUNTS).groupBy("language", "length", "hash").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(set(counts.column("language").to_pylist()))
    place = {name: n for n, name in enumerate(languages)}
    language = np.array([place[x] for x in counts.column("language").to_pylist()], np.int64)
    length, hashes, n = (counts.column(c).to_numpy() for c in ("length", "hash", "n"))
    keys, logs = [], []
    for size in range(LONGEST + 1):
        mine = length == size
        key, at = np.unique(hashes[mine].astype(np.int64).view(np.uint64), return_inverse=True)
        table = np.zeros((len(key), len(languages)))
        np.add.at(table, (at, language[mine]), n[mine])
        total = table.sum(axis=0) + SMOOTHING * max(len(key), 1)
        keys.append(key)
        logs.append(np.log((table + SMOOTHING) / total).astype(np.float32))
    return Model(languages, keys, logs)


def labelled(documents: DataFrame, model: Model, text_column: str = "text") -> tuple[DataFrame, str, str]:
    """``documents`` with two more columns, and their names: language and score."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    name, score = free_name(documents, "lang_pred"), free_name(documents, "score")

    def run(batches):
        for batch in batches:
            for part in slices(batch, text_column):
                languages, scores = shared.value.predict(part.column(text_column))
                added = [pa.array(languages, pa.string()), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays([*part.columns, *added], names=[*part.schema.names, name, score])

    fields = [*documents.schema.fields, T.StructField(name, T.StringType()), T.StructField(score, T.DoubleType())]
    return documents.mapInArrow(run, T.StructType(fields)), name, score


def language_id(documents: DataFrame) -> DataFrame:
    """Per row: id, held_out, lang_pred, score; learned from the rows that are not held out."""
    model = train(documents.where(in_training("doc_id", 5, 0)))
    rows = documents.select(
        "doc_id", (~in_training("doc_id", 5, 0)).alias("held_out"), F.col("text").cast("string").alias("text")
    )
    result, name, score = labelled(rows, model)
    return result.select("doc_id", "held_out", F.col(name).alias("lang_pred"), F.col(score).alias("score"))
