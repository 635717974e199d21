"""Toxicity by class-conditional Kneser-Ney models.

One bigram model per class is counted over labelled texts. Both end in the same
continuation counts. The discount taken from a class's count is a constant
plus a multiple of what the other class's rate predicts, and does not grow with the number of texts.
What is left is damped by how surely the two rates differ (the log-likelihood ratio of an expression's
counts): one that is seen a few times only, or that both classes use, is left to the shared
counts and moves the score little, and the more texts there are, the rarer an insult may be. Counts are of texts, so one text that repeats itself weighs once. A text's evidence is the
difference of its two log-likelihoods divided by its number of words; a logistic
curve, fitted on labelled texts the models have not counted, turns that into a
probability. Evidence below that of ``USUAL`` of the ordinary texts counts as that
much: how ordinary a text is says nothing more, and mislabelled texts would flatten the curve.

The classifier is fitted on a bounded sample of the labelled rows (``ROWS`` per
class and ``CHARACTERS`` of text per class, in the order of a hash of the id; texts that do not
fit are left out, but the shortest of a class stays), which
bounds the model that is sent to the executors; scoring reads every whole text.

Words are runs of ASCII letters (case folded), and of characters beyond ASCII.
Null and empty texts, and texts without a word, get the score of unknown words.
A label that is neither 0 nor 1, or null, is not used; repeated labels count once,
and an id with both labels is left out. With one class only, or without labels, every score
is the share of toxic labels (0 without labels). Repeated rows get equal scores.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivermark.llm.rows import col, fitting_rows, free_name, in_training, stored
from rivermark.llm.spans import LETTERS, U64, Words, look_up, mixed, slices, sums_by

ROWS = 3000
CHARACTERS = 6_000_000
DISCOUNT = 1.5  # taken from each count
NOISE = 12.0  # log-likelihood ratio (twice the logarithm) that chance reaches among some 100,000 expressions
COMMON = 4.0  # times the other class's rate that still counts as shared
THRESHOLD = 0.3
FIRST = U64(1)  # stands before the first word of a text
COUNTS = "toxic int, previous long, word long, n long"
USUAL = 0.95
TEXTS = U64(2)  # in the place of a word: all texts


@dataclass
class Model:
    """Sorted hashes of words, contexts and pairs with what each class counted."""

    words: np.ndarray
    lower: np.ndarray  # by class: probability without context; the last place is for unknown words
    contexts: np.ndarray
    shared: np.ndarray  # by class: share of the context's occurrences that goes to the lower order
    pairs: np.ndarray
    own: np.ndarray  # by class: share of the context's occurrences that the pair keeps
    usual: float = 0.0
    slope: float = 0.0
    offset: float = -50.0

    def evidence(self, texts: pa.Array) -> np.ndarray:
        """Per text: (toxic - ordinary log-likelihood) / words."""
        words = Words(texts, LETTERS)
        if not len(self.words):
            return np.zeros(len(texts))
        nothing = np.log(self.lower[1][-1] / self.lower[0][-1])  # what an unknown word says
        if not len(words):
            return np.full(len(texts), nothing)
        hashes, previous = with_previous(words)
        at, known = look_up(self.words, hashes)
        at[~known] = len(self.words)
        context, context_known = look_up(self.contexts, previous)
        pair, pair_known = look_up(self.pairs, pair_hash(previous, hashes))
        pair_known &= known & context_known
        total = np.zeros(len(hashes))
        for side, sign in ((1, 1.0), (0, -1.0)):
            shared = np.where(context_known, self.shared[side][context], 1)
            own = np.where(pair_known, self.own[side][pair], 0)
            total += sign * np.log(own + shared * self.lower[side][at])
        means = sums_by(words.text_of, total, len(texts)) / np.maximum(words.counts, 1)
        return np.where(words.counts > 0, means, nothing)

    def score(self, texts: pa.Array) -> np.ndarray:
        return curve(self.slope * np.maximum(self.evidence(texts) - self.usual, 0) + self.offset)


def curve(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def with_previous(words: Words) -> tuple[np.ndarray, np.ndarray]:
    hashes = words.hashes
    previous = np.empty_like(hashes)
    previous[1:] = hashes[:-1]
    previous[words.first[:-1][words.counts > 0]] = FIRST
    return hashes, previous


def pair_hash(previous: np.ndarray, words: np.ndarray) -> np.ndarray:
    return mixed(previous * U64(0xD6E8FEB86659FD93) + words)


def count_texts(batches):
    """By class: texts that hold a word (previous = 0), and a word after another."""
    for batch in batches:
        for part in slices(batch, "text"):
            toxic = part.column("toxic").to_numpy(zero_copy_only=False)
            words = Words(part.column("text"), LETTERS)
            hashes, previous = with_previous(words)
            text = np.tile(words.text_of, 2)
            before = np.concatenate([previous, np.zeros_like(previous)])
            texts = np.arange(part.num_rows)
            once = np.unique(np.rec.fromarrays([
                np.concatenate([text, texts]),
                np.concatenate([before, np.zeros(len(texts), U64)]),
                np.concatenate([np.tile(hashes, 2), np.full(len(texts), TEXTS)]),
            ]))
            kinds, n = np.unique(np.rec.fromarrays([toxic[once.f0], once.f1, once.f2]), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(kinds.f0.astype(np.int32)),
                    pa.array(kinds.f1.astype(np.int64)),
                    pa.array(kinds.f2.astype(np.int64)),
                    pa.array(n.astype(np.int64)),
                ],
                names=["toxic", "previous", "word", "n"],
            )


@dataclass
class Counts:
    """What the sample holds of words and pairs that can outlast the discount; rows are classes."""

    texts: np.ndarray
    totals: np.ndarray  # texts added up over all words
    kinds: int  # different pairs, and different words, over all
    words: np.ndarray
    spread: np.ndarray  # texts with the word
    different: np.ndarray  # words before it
    contexts: np.ndarray
    rows: np.ndarray  # texts added up over the words after it
    previous: np.ndarray
    following: np.ndarray
    pair_rows: np.ndarray


def kneser_ney(counts: Counts) -> Model:
    """An expression without counts of its own says the same as an unknown one, so it need not be kept."""
    base = np.append(counts.different + 1.0, 1.0) / (counts.kinds + 1)
    order = np.argsort(pair_hash(counts.previous, counts.following))
    pairs = pair_hash(counts.previous, counts.following)[order]
    context_of = np.searchsorted(counts.contexts, counts.previous[order])
    pair_rows, spread, rows, texts = counts.pair_rows[:, order], counts.spread, counts.rows, counts.texts
    lower, shared_mass, own_mass = [], [], []
    for side in (0, 1):
        own = kept(spread[side], spread[1 - side], texts[side], texts[1 - side])
        total = max(counts.totals[side], 1)
        lower.append((np.append(own, 0) + (total - own.sum()) * base) / total)
        own = kept(pair_rows[side], pair_rows[1 - side], texts[side], texts[1 - side])
        seen = np.maximum(rows[side], 1)
        own_mass.append(own / seen[context_of])
        shared_mass.append(np.where(rows[side] > 0, 1 - np.bincount(context_of, own, len(counts.contexts)) / seen, 1))
    return Model(counts.words, np.stack(lower), counts.contexts, np.stack(shared_mass), pairs, np.stack(own_mass).astype(np.float32))


def kept(mine: np.ndarray, other: np.ndarray, my_texts: int, other_texts: int) -> np.ndarray:
    """Counts after the discount, damped where the classes' rates may differ by chance."""
    share = my_texts / max(my_texts + other_texts, 1)
    mean = (mine + other) * share
    log_ratio = lambda n, of: n * np.log(np.maximum(n, 1) / np.maximum(of, 1e-9))
    surprise = np.where(mine > mean, 2 * (log_ratio(mine, mean) + log_ratio(other, mine + other - mean)), 0)
    left = np.maximum(mine - DISCOUNT - COMMON * other * my_texts / max(other_texts, 1), 0)
    return left * np.maximum(1 - NOISE / np.maximum(surprise, NOISE), 0)


def fit_curve(evidence: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Weighted logistic regression on one variable by Newton's method, slightly ridged."""
    scale = evidence.std() or 1.0
    x = np.stack([evidence / scale, np.ones(len(evidence))], 1)
    beta, ridge = np.zeros(2), np.diag([1e-2, 1e-6])
    for _ in range(50):
        p = curve(x @ beta)
        gradient = x.T @ (weight * (toxic - p)) - ridge @ beta
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(hessian, gradient)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0] / scale), float(beta[1])


def usable_labels(documents: DataFrame, labels: DataFrame, id_column: str) -> DataFrame:
    """(id, toxic) of the ids among ``documents`` that have one label, once each."""
    known = labels.select(col(id_column).alias("id"), F.col("toxic").cast("int").alias("toxic"))
    return (
        known.where("id is not null and toxic in (0, 1)")
        .groupBy("id")
        .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most"))
        .where("toxic = most")
        .join(documents.select(col(id_column).alias("id")), "id", "left_semi")
        .select("id", "toxic")
    )


def labelled_sample(
    documents: DataFrame, labels: DataFrame, id_column: str, text_column: str, rows: int, characters: int
) -> DataFrame:
    """At most ``rows`` whole texts and ``characters`` of text per class, by a hash of the id."""
    known = usable_labels(documents, labels, id_column).withColumn("place", F.xxhash64("id"))
    by_class = [known.where(F.col("toxic") == side).orderBy("place", "id").limit(rows) for side in (0, 1)]
    chosen = by_class[0].unionByName(by_class[1])
    texts = documents.select(col(id_column).alias("id"), col(text_column).alias("text")).where("id is not null")
    # at most 2 * rows ids, so the broadcast is bounded
    found = texts.join(F.broadcast(chosen), "id").dropDuplicates(["id", "text"])
    return fitting_rows(found, "toxic", characters).select(
        "toxic", "text", (F.pmod(F.col("place"), F.lit(4)) == 0).alias("fitting")
    )


def gathered(sample: DataFrame) -> Counts:
    """Counts the sample's texts. Only expressions of two texts or more of a class reach the driver: the
    discount leaves nothing of the others."""
    rows = sample.where("not fitting").select("toxic", "text").mapInArrow(count_texts, COUNTS)
    each = stored(rows.groupBy("toxic", "previous", "word").agg(F.sum("n").alias("n")), "toxicity-counts")
    side = [F.sum(F.when(F.col("toxic") == c, F.col("n")).otherwise(0)).alias(f"n{c}") for c in (0, 1)]
    often = F.greatest("n0", "n1") > DISCOUNT
    alone, pairs = each.where(f"previous = 0 and word != {TEXTS}"), each.where("previous != 0")
    texts = each.where(f"word = {TEXTS}").agg(*side).first()
    totals = alone.agg(*side, F.countDistinct("word").alias("kinds")).first()
    before = pairs.groupBy("word").agg(F.countDistinct("previous").alias("different"))
    words = alone.groupBy("word").agg(*side).where(often).join(before, "word").orderBy("word").toArrow()
    kept = pairs.groupBy("previous", "word").agg(*side).where(often)
    contexts = pairs.join(kept.select("previous").distinct(), "previous", "left_semi").groupBy("previous").agg(*side).toArrow()
    kept = kept.toArrow()
    kinds = pairs.select("previous", "word").distinct().count() + (totals.kinds or 0)
    column = lambda table, name: table.column(name).to_numpy()
    hashes = lambda table, name: column(table, name).astype(np.int64).view(U64)
    sides = lambda table: np.stack([column(table, "n0"), column(table, "n1")]).astype(float)
    by_word, by_context = (np.argsort(hashes(t, n)) for t, n in ((words, "word"), (contexts, "previous")))
    return Counts(
        np.array([texts.n0 or 0, texts.n1 or 0]),
        np.array([totals.n0 or 0, totals.n1 or 0]),
        kinds,
        hashes(words, "word")[by_word],
        sides(words)[:, by_word],
        column(words, "different")[by_word].astype(float),
        hashes(contexts, "previous")[by_context],
        sides(contexts)[:, by_context],
        hashes(kept, "previous"),
        hashes(kept, "word"),
        sides(kept),
    )


def train(
    documents: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    rows: int = ROWS,
    characters: int = CHARACTERS,
) -> Model:
    """Models and curve from the labelled texts among ``documents``."""
    sample = labelled_sample(documents, labels, id_column, text_column, rows, characters).persist()
    try:
        counts = gathered(sample)
        fitting = sample.where("fitting").select("toxic", "text").toArrow()
    finally:
        sample.unpersist()
    shares = {r.toxic: r.n for r in usable_labels(documents, labels, id_column).groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = shares.get(1, 0) / max(sum(shares.values()), 1)
    model = kneser_ney(counts)
    toxic = fitting.column("toxic").to_numpy() if fitting.num_rows else np.zeros(0)
    if not counts.texts.all() or len(np.unique(toxic)) < 2:
        odds = min(max(share, 1e-9), 1 - 1e-9)
        model.slope, model.offset = 0.0, float(np.log(odds / (1 - odds)))
        return model
    weight = np.where(toxic == 1, share / (toxic == 1).mean(), (1 - share) / (toxic == 0).mean())
    evidence = model.evidence(fitting.column("text").combine_chunks())
    model.usual = float(np.quantile(evidence[toxic == 0], USUAL))
    model.slope, model.offset = fit_curve(np.maximum(evidence - model.usual, 0), toxic, weight)
    return model


def scored(documents: DataFrame, model: Model, text_column: str = "text", score_column: str = "score") -> DataFrame:
    """``documents`` with one more column; row for row, without a shuffle."""
    spark = documents.sparkSession
    name = free_name(documents, score_column)
    shared = spark.sparkContext.broadcast(model)

    def judge(batches):
        for batch in batches:
            for part in slices(batch, text_column):
                scores = pa.array(shared.value.score(part.column(text_column)), pa.float64())
                yield pa.RecordBatch.from_arrays([*part.columns, scores], names=[*part.schema.names, name])

    schema = T.StructType([*documents.schema.fields, T.StructField(name, T.DoubleType())])
    return documents.mapInArrow(judge, schema)


def training_documents(documents: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The rows labels may be learned from."""
    return documents.where(in_training(id_column, 4, 2))


def toxicity(documents: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, held_out, score, predicted."""
    model = train(training_documents(documents, id_column), labels, id_column, text_column)
    rows = documents.select(
        col(id_column).alias("doc_id"),
        (~in_training(id_column, 4, 2)).alias("held_out"),
        col(text_column).cast("string").alias("text"),
    )
    return scored(rows, model).select(
        "doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
