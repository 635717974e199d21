"""Hard negatives by segment summary filtering.

For every anchor the rows of its label with the greatest inner products are its positives; for every positive
the negatives are the best rows of other labels whose product lies between two shares of the positive's
(``LEAST`` and ``MOST`` percent): close enough to be hard, far enough not to be unlabelled positives.

A vector is cut into segments, and for each its mean and deviation are stored. With means m, n and deviations
d, e of two segments of L components, their product lies within L*m*n +- L*d*e. These sums over the segments
bound the score from both sides. A scan compares its vectors with the anchors by one segment first, then, where
the bounds leave it open, by ``FANOUT`` times as many, down to ``FINEST``; the summaries of a level follow from those of
the next finer one. A pair goes on only while its bounds reach into the span of its query's windows (the positives' shares, for
positives all numbers) above the k-th exact products the task has found in them so far; a task takes few vectors at first, so
that it soon has found some. What is left is scored exactly, so results are exact. A task hands on the k best of each window; these are merged.

Rows of one vector and label are one entry with its ``POSITIVES + 1`` smallest ids: more cannot be among the results. Anchors of
one vector and label are one query, and its positives of one score are one window. Queries are taken in blocks
of ``BLOCK``, whose size does not grow with the input; each is sent to the executors and scans the entries twice.

Every component x counts as floor(256 * x), components that are missing at the end of a shorter vector as 0. Rows with a null id,
label or vector, or a null, NaN or infinite component, take no part. Rows equal in id, label and vector count once;
an id with several different rows has all of them as anchors and none of them as its own positives.
Equal scores go to smaller ids. A label without other rows has no positives, hence no results; nor has a positive
score below zero, as its window is empty. Scores must fit 64 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivermark.llm.rows import col, stored
from rivermark.llm.vector_search import SCALE, as_matrix
from rivermark.session import shared_folder

POSITIVES, NEGATIVES = 5, 3
LEAST, MOST = 50, 95  # percent of the positive's score
FANOUT, FINEST = 4, 16  # segments of a level in those of the one above, and of the finest level
BLOCK = 1024
PAIRS = 1 << 15  # compared with the windows at once
ROWS = 64, 2048  # entries compared with a block at once: at first, when no product has been found, and at most
DENSE = 64  # a share of pairs above one in so many is scored as a product of matrices
EXACT = 2.0**52  # doubles hold every sum of integers up to here
NOTHING = np.int64(-(2**63))
FOUND = "query long, window long, id long, score long"


def labelled(vectors: DataFrame, id_column: str, label_column: str, vector_column: str) -> DataFrame:
    """(id, label, vector of integers) of the rows that take part, each once."""
    doubles = col(vector_column).cast("array<double>")
    sound = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    there = [col(c).isNotNull() for c in (id_column, label_column, vector_column)]
    return (
        vectors.where(there[0] & there[1] & there[2] & sound)
        .select(
            col(id_column).cast("long").alias("id"),
            col(label_column).alias("label"),
            F.transform(doubles, lambda x: F.floor(x * SCALE)).alias("vector"),
        )
        .distinct()
    )


def entries(rows: DataFrame) -> DataFrame:
    """(vector, label, ids): distinct vectors of a label with their smallest ids."""
    place = F.row_number().over(Window.partitionBy("vector", "label").orderBy("id"))
    few = rows.withColumn("place", place).where(F.col("place") <= POSITIVES + 1)
    return few.groupBy("vector", "label").agg(F.array_sort(F.collect_list("id")).alias("ids"))


def summaries(matrix: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each segment of each row; a row's length is a multiple of ``segments``."""
    parts = matrix.astype(float).reshape(len(matrix), segments, -1)
    return parts.mean(axis=2), parts.std(axis=2)


def coarser(means: np.ndarray, deviations: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Summaries of segments FANOUT times as long."""
    parts = means.reshape(len(means), -1, FANOUT)
    spread = (deviations**2).reshape(parts.shape).mean(axis=2) + parts.var(axis=2)
    return parts.mean(axis=2), np.sqrt(spread)


def levels(means: np.ndarray, deviations: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Summaries from one segment down to the stored ones."""
    found = [(means, deviations)]
    while found[0][0].shape[1] > 1:
        found.insert(0, coarser(*found[0]))
    return found


def summarised(rows: DataFrame, width: int) -> DataFrame:
    """Entries with the summaries of their segments."""

    def run(batches):
        for batch in batches:
            means, deviations = summaries(as_matrix(batch.column("vector"), width), FINEST)
            lists = [pa.array(list(x), pa.list_(pa.float64())) for x in (means, deviations)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *lists], names=[*batch.schema.names, "means", "deviations"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{schema}, means array<double>, deviations array<double>")


class Best:
    """The k best (score, id) of each window so far."""

    def __init__(self, windows: int, k: int):
        self.k, self.least = k, np.full(windows, -np.inf)
        self.rows = np.zeros((3, 0), np.int64)  # window, score, id

    def add(self, window: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        rows = np.concatenate([self.rows, np.stack([window, score, ids])], axis=1)
        rows = rows[:, np.lexsort((rows[2], -rows[1], rows[0]))]
        first = np.searchsorted(rows[0], rows[0], "left")
        place = np.arange(rows.shape[1]) - first
        self.rows = rows[:, place < self.k]
        full = rows[:, place == self.k - 1]
        self.least[full[0]] = np.nextafter(full[1].astype(float), -np.inf)  # rounded downwards


class Block:
    """Queries with their summaries, and the windows of scores that are looked for.

    ``windows`` holds a number per query and place, or the number of windows where it has fewer; ``low`` and
    ``high`` have a further entry for that one, which nothing fits.
    """

    def __init__(self, queries: np.ndarray, matrix: np.ndarray, labels: list, own: np.ndarray, k: int):
        self.queries, self.matrix, self.own, self.same, self.k = queries, matrix, own, True, k
        self.codes = {label: n for n, label in enumerate(dict.fromkeys(labels))}
        self.labels = np.array([self.codes[label] for label in labels])
        self.levels = levels(*summaries(matrix, FINEST))
        self.norms = np.sqrt((matrix.astype(float) ** 2).sum(axis=1))
        self.keys = np.zeros(len(queries), np.int64)  # of each window
        self.windows = np.arange(len(queries))[:, None]
        self.low, self.high = np.append(np.full(len(queries), -np.inf), np.inf), np.full(len(queries) + 1, np.inf)

    def look_for(self, query: np.ndarray, key: np.ndarray) -> None:
        """A window per query place and positive score."""
        order = np.argsort(query, kind="stable")
        query, key = query[order], key[order]
        place = np.arange(len(query)) - np.searchsorted(query, query, "left")
        self.windows = np.full((len(self.queries), int(place.max(initial=0)) + 1), len(query))
        self.windows[query, place] = np.arange(len(query))
        self.keys, self.owner = key, query
        scores = key.tolist()
        self.low = np.array([-(-LEAST * s // 100) for s in scores] + [np.inf], float)
        self.high = np.array([MOST * s // 100 for s in scores] + [-np.inf], float)

    def exact_range(self) -> tuple[np.ndarray, np.ndarray]:
        """As ``low`` and ``high``, in integers."""
        if self.same:
            low, high = [NOTHING] * len(self.keys), [~NOTHING] * len(self.keys)
        else:
            scores = self.keys.tolist()
            low, high = [-(-LEAST * s // 100) for s in scores], [MOST * s // 100 for s in scores]
        return np.array([*low, ~NOTHING], np.int64), np.array([*high, NOTHING], np.int64)


def scan(shared):
    """The k best rows of each window among those a task reads."""

    def run(batches):
        block: Block = shared.value
        best = Best(len(block.keys), block.k)
        low, high = block.exact_range()
        step = ROWS[0]
        owner = np.arange(len(block.keys)) if block.same else block.owner
        for batch in batches:
            matrix = as_matrix(batch.column("vector"), block.matrix.shape[1])
            norms = np.sqrt((matrix.astype(float) ** 2).sum(axis=1))
            labels = np.array([block.codes.get(label, -1) for label in batch.column("label").to_pylist()])
            summary = levels(*(as_matrix(batch.column(c), FINEST, float) for c in ("means", "deviations")))
            start = 0
            while start < len(matrix):
                part = slice(start, start + step)
                of_part = [(means[part], deviations[part]) for means, deviations in summary]
                query, row = candidates(block, of_part, norms[part], labels[part], best.least)
                scores = products(block, matrix[part], norms[part], query, row)
                for first in range(0, len(query), PAIRS):
                    few = slice(first, first + PAIRS)
                    q, x, score = query[few], row[few] + start, scores[few]
                    windows = block.windows[q]
                    least = np.append(best.least, np.inf)
                    own = score[:, None]
                    at, place = np.nonzero((own >= low[windows]) & (own <= high[windows]) & (own >= least[windows]))
                    if len(at):
                        best.add(*expanded(block, batch.column("ids"), q[at], x[at], windows[at, place], score[at]))
                start, step = start + step, min(step * FANOUT, ROWS[1])
        window, score, ids = best.rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(c) for c in (block.queries[owner[window]], block.keys[window], ids, score)],
            names=["query", "window", "id", "score"],
        )

    return run


def expanded(block: Block, lists: pa.ListArray, q, x, window, score) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window, score, id) for each id of the entries, without a query's own."""
    held = lists.take(pa.array(x))
    sizes = np.asarray(held.value_lengths())
    ids = np.asarray(held.flatten()).astype(np.int64)
    others = np.ones(len(ids), bool)
    if block.same:
        others = ids != np.repeat(block.own[q], sizes)
    return np.repeat(window, sizes)[others], np.repeat(score, sizes)[others], ids[others]


def candidates(block: Block, summary, norms: np.ndarray, labels: np.ndarray, least: np.ndarray):
    """Pairs of query and row that the bounds of all levels leave open."""
    alive = (block.labels[:, None] == labels[None, :]) == block.same
    floor = np.maximum(block.low, np.append(least, np.inf))[block.windows].min(axis=1)[:, None]
    ceiling = block.high[block.windows].max(axis=1)[:, None]
    for (means, deviations), (others, spreads) in zip(block.levels, summary):
        rows, columns = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
        if not len(rows):
            break
        length = block.matrix.shape[1] // means.shape[1]
        centre = (length * means[rows]) @ others[columns].T
        radius = (length * deviations[rows]) @ spreads[columns].T
        radius += 1e-9 * (np.outer(block.norms[rows], norms[columns]) + 1)  # rounding of the double sums
        open_ = centre + radius >= floor[rows]
        if not block.same:
            open_ &= centre - radius <= ceiling[rows]
        alive[np.ix_(rows, columns)] &= open_
    return np.nonzero(alive)


def products(block: Block, matrix: np.ndarray, norms: np.ndarray, query: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Exact scores of pairs: many at once by doubles, as long as these hold all sums, else one by one."""
    rows, columns = np.bincount(query, minlength=1) > 0, np.bincount(row, minlength=1) > 0
    queries, entries_ = np.flatnonzero(rows), np.flatnonzero(columns)
    if not len(query):
        return np.zeros(0, np.int64)
    greatest = block.norms[queries].max() * norms[entries_].max()
    if len(query) * DENSE >= len(queries) * len(entries_) and greatest < EXACT:
        score = block.matrix[queries].astype(float) @ matrix[entries_].astype(float).T
        return score[(np.cumsum(rows) - 1)[query], (np.cumsum(columns) - 1)[row]].astype(np.int64)
    parts = (slice(first, first + PAIRS) for first in range(0, len(query), PAIRS))
    return np.concatenate([(block.matrix[query[few]] * matrix[row[few]]).sum(axis=1) for few in parts])


def merged(found: DataFrame, k: int) -> DataFrame:
    """The k best of each window over all tasks."""
    order = Window.partitionBy("query", "window").orderBy(F.desc("score"), "id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def hard_negatives(
    vectors: DataFrame, anchor, id_column: str = "vec_id", label_column: str = "label", vector_column: str = "embedding"
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score); ``anchor`` is a condition on ``id``."""
    spark = vectors.sparkSession
    rows = stored(labelled(vectors, id_column, label_column, vector_column), "labelled")
    longest = rows.agg(F.max(F.size("vector"))).first()[0] or 1
    width = -(-longest // FINEST) * FINEST
    file = stored(summarised(entries(rows), width), "summaries")
    asked = rows.where(anchor)
    # an id with one row takes one of the places itself; an id with more is left out in the scan
    several = asked.groupBy("id").agg((F.count("*") > 1).alias("several"))
    asked = asked.join(several, "id").withColumn("own", F.when(F.col("several"), F.col("id"))).drop("several")
    asked = stored(asked, "anchors")
    distinct = asked.select("vector", "label", "own").distinct()
    named = stored(distinct.withColumn("query", F.monotonically_increasing_id()), "queries")
    blocks = -(-named.count() // BLOCK)
    folders = [shared_folder(spark, purpose) for purpose in ("positives", "negatives")]
    for block in range(blocks):
        chosen = named.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == block).orderBy("query").toArrow().combine_chunks()
        if not chosen.num_rows:
            continue
        batch = chosen.to_batches()[0]
        own = np.array([NOTHING if x is None else x for x in batch.column("own").to_pylist()], np.int64)
        looked = Block(
            np.asarray(batch.column("query")), as_matrix(batch.column("vector"), width),
            batch.column("label").to_pylist(), own, POSITIVES + 1,
        )
        shared = spark.sparkContext.broadcast(looked)
        merged(file.mapInArrow(scan(shared), FOUND), looked.k).write.parquet(f"{folders[0]}/block={block}")
        shared.unpersist()
        best = spark.read.parquet(f"{folders[0]}/block={block}")
        scores = best.select("query", "score").distinct().toArrow()  # at most POSITIVES + 1 for each query of the block
        looked.same, looked.k = False, NEGATIVES
        place = np.searchsorted(looked.queries, scores.column("query").to_numpy())
        looked.look_for(place, scores.column("score").to_numpy().astype(np.int64))
        shared = spark.sparkContext.broadcast(looked)
        merged(file.mapInArrow(scan(shared), FOUND), looked.k).write.parquet(f"{folders[1]}/block={block}")
        shared.unpersist()
    read = spark.read.schema(f"{FOUND}, place int")
    if blocks:
        best, worst = (read.parquet(folder) for folder in folders)
    else:
        best = worst = spark.createDataFrame([], f"{FOUND}, place int")
    anchors = asked.withColumn("row", F.monotonically_increasing_id())
    names = named.select("query", F.struct("vector", "label", "own").alias("key"))
    anchors = anchors.select("id", "row", F.struct("vector", "label", "own").alias("key")).join(names, "key").drop("key")
    positives = anchors.withColumnRenamed("id", "anchor_id").join(best, "query").where("anchor_id != id")
    order = Window.partitionBy("row").orderBy("place")
    positives = positives.withColumn("n", F.row_number().over(order)).where(F.col("n") <= POSITIVES)
    negatives = worst.select("query", F.col("window").alias("score"), F.struct("place", "id", F.col("score").alias("negative")).alias("found"))
    return positives.join(negatives, ["query", "score"]).select(
        "anchor_id",
        F.col("id").alias("positive_id"),
        F.col("found.place").alias("rank"),
        F.col("found.id").alias("negative_id"),
        F.col("score").alias("positive_score"),
        F.col("found.negative").alias("negative_score"),
    )


def mined(embeddings: DataFrame) -> DataFrame:
    """Hard negatives of every 50th id, with the labels of every 7th moved on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = embeddings.select("vec_id", moved.alias("label"), "embedding")
    return hard_negatives(rows, F.col("id") % 50 == 0)


SQL = """
WITH whole AS (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id AS other_id,
        CAST(list_sum([a.v[i] * c.v[i] FOR i IN range(1, len(a.v) + 1)]) AS BIGINT) AS score
    FROM whole a JOIN whole c ON a.vec_id != c.vec_id WHERE a.vec_id % 50 = 0
), positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other_id) AS INTEGER) AS rank,
    n.other_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
    AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""
