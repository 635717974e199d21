"""Exact top-k inner products with a vector-approximation file.

Every component x counts as the integer floor(256 * x). The file holds each vector's
cells: every dimension is cut into ``CELLS`` equal ranges between the least and the greatest
value that occurs in it, and a vector is one byte per dimension. A query is compared with all
cells first: a cell's ends bound the product from both sides. A vector whose
upper bound lies below the k-th greatest lower bound cannot be a result. The exact vectors of the
others are read in the order of their upper bounds, the ``FIRST`` best of each query
at first; only vectors whose upper bound reaches the k-th exact product found by then
are read after that, so the result is certain.

Equal vectors are one entry of the file with their k + 1 smallest ids and the rows of each: a query excludes
its own id only, and ties go to smaller ids, so no more can be among its results. An id may have rows
with different vectors; as many entries as any queried id has vectors are kept besides the k. Equal
query vectors are searched for once. Queries are taken in blocks of about ``BLOCK``, each a
scan of the file with that block sent to the executors; a block's size does not
grow with the input.

Vectors that are null, or hold a null, NaN or infinite component, take no part. A
shorter vector counts as filled up with zeros. An id with several vectors (repeated rows)
gives a row for each; a null id is never a query, and never a result. Integer sums must fit 64 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivermark.llm.rows import col, stored

CELLS = 64
BLOCK = 2048
FIRST = 20
STEP = 1024  # vectors compared with a block at once
SCALE = 256


def whole_numbers(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, vector of integers) of the rows that take part."""
    doubles = col(vector_column).cast("array<double>")
    sound = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(col(id_column).isNotNull() & col(vector_column).isNotNull() & sound).select(
        col(id_column).cast("long").alias("id"), F.transform(doubles, lambda x: F.floor(x * SCALE)).alias("vector")
    )


def entries(vectors: DataFrame, k: int) -> DataFrame:
    """Distinct vectors with a number, and their k + 1 smallest ids with the rows of each."""
    place = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    held = vectors.groupBy("vector", "id").agg(F.count("*").alias("n"))
    few = held.withColumn("place", place).where(F.col("place") <= k + 1)
    each = few.groupBy("vector").agg(F.array_sort(F.collect_list(F.struct("id", "n"))).alias("ids"))
    return numbered(each.withColumn("least", F.element_at("ids", 1)["id"]), "entry").select("entry", "vector", "ids")


def numbered(each: DataFrame, name: str) -> DataFrame:
    """Distinct vectors with a number: one takes its smallest id (``least``), others with that id their hash."""
    each = each.withColumn("hash", F.xxhash64("vector"))
    first = each.groupBy("least").agg(F.min("hash").alias("first"))
    number = F.when(F.col("hash") == F.col("first"), F.col("least")).otherwise(F.col("hash"))
    return each.join(first, "least").withColumn(name, number).drop("least", "hash", "first")


def most_vectors(vectors: DataFrame, asked: DataFrame) -> int:
    """The greatest number of different vectors that a queried id has."""
    mine = vectors.join(asked.select("id").distinct(), "id", "left_semi").distinct()
    return mine.groupBy("id").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 1


def as_matrix(lists: pa.ListArray, width: int, dtype=np.int64) -> np.ndarray:
    """Lists as rows, filled up with zeros."""
    sizes = np.asarray(lists.value_lengths())
    out = np.zeros((len(lists), width), dtype)
    if len(lists):
        out[np.arange(width) < sizes[:, None]] = np.asarray(lists.flatten())
    return out


def cell_ranges(entries: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Least value and cell width by dimension; one row per dimension reaches the driver."""
    spread = (
        entries.select(F.posexplode("vector").alias("n", "x")).groupBy("n").agg(F.min("x").alias("low"), F.max("x").alias("high"))
    )
    rows = sorted((r.n, r.low, r.high) for r in spread.collect())
    low = np.minimum(np.array([r[1] for r in rows], np.int64), 0)  # a missing component counts as 0
    high = np.maximum(np.array([r[2] for r in rows], np.int64), 0)
    return low, (high - low) // CELLS + 1


def file_of_cells(entries: DataFrame, low: np.ndarray, step: np.ndarray) -> DataFrame:
    """(entry, cells): a byte per dimension."""

    def quantise(batches):
        for batch in batches:
            cells = ((as_matrix(batch.column("vector"), len(low)) - low) // step).astype(np.uint8)
            rows = [row.tobytes() for row in cells]
            yield pa.RecordBatch.from_arrays(
                [batch.column("entry"), pa.array(rows, pa.binary())], names=["entry", "cells"]
            )

    return entries.select("entry", "vector").mapInArrow(quantise, "entry long, cells binary")


def scan(shared, low: np.ndarray, step: np.ndarray, k: int):
    """Per query of the block: entries that the cells seen so far do not rule out, with their bounds."""

    def run(batches):
        names, queries = shared.value
        positive, negative = np.maximum(queries, 0).astype(float), np.minimum(queries, 0).astype(float)
        best = np.full((len(names), k), -np.inf)  # the greatest lower bounds of this task
        for batch in batches:
            for start in range(0, batch.num_rows, STEP):
                part = batch.slice(start, STEP)
                cells = np.frombuffer(b"".join(part.column("cells").to_pylist()), np.uint8).reshape(-1, len(low))
                floor = low + cells * step
                ceiling = floor + (step - 1)
                upper = positive @ ceiling.T + negative @ floor.T
                lower = positive @ floor.T + negative @ ceiling.T
                slack = 1e-9 * (1 + np.abs(upper))  # rounding of the double sums
                best = np.sort(np.concatenate([best, lower], axis=1), axis=1)[:, -k:]
                query, place = np.nonzero(upper + slack >= best[:, :1])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names[query]),
                        part.column("entry").take(pa.array(place)),
                        pa.array((upper + slack)[query, place]),
                        pa.array((lower - slack)[query, place]),
                    ],
                    names=["query", "entry", "upper", "lower"],
                )

    return run


def products(shared):
    """Exact products of candidates with their queries."""

    def run(batches):
        names, queries = shared.value
        at = {name: n for n, name in enumerate(names.tolist())}
        for batch in batches:
            mine = queries[[at[q] for q in batch.column("query").to_pylist()]]
            score = (mine * as_matrix(batch.column("vector"), queries.shape[1])).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("query", "ids")), pa.array(score)], names=["query", "ids", "score"]
            )

    return run


def certain(
    file: DataFrame, exact: DataFrame, shared, low: np.ndarray, step: np.ndarray, k: int, own: int = 1
) -> DataFrame:
    """(query, ids, score) of every entry that may be among the results of a block."""
    read = products(shared)
    wanted = k + own  # so many of the results may be the query's own rows
    candidates = stored(
        file.mapInArrow(scan(shared, low, step, wanted), "query long, entry long, upper double, lower double"), "bounds"
    )
    bound = Window.partitionBy("query").orderBy(F.desc("lower"), "entry")
    kth = candidates.withColumn("n", F.row_number().over(bound)).where(F.col("n") == wanted).select(
        "query", F.col("lower").alias("least")
    )
    open_ = candidates.join(kth, "query", "left").where("least is null or upper >= least").drop("least", "lower")
    order = Window.partitionBy("query").orderBy(F.desc("upper"), "entry")
    open_ = stored(open_.withColumn("n", F.row_number().over(order)), "open")
    schema = "query long, ids array<struct<id: long, n: long>>, score long"
    vectors = exact.select("entry", "vector", "ids")
    fetch = lambda rows: rows.join(vectors, "entry").select("query", "ids", "vector").mapInArrow(read, schema)
    first = stored(fetch(open_.where(F.col("n") <= FIRST)), "first-read")
    score = Window.partitionBy("query").orderBy(F.desc("score"))
    found = first.withColumn("n", F.row_number().over(score)).where(F.col("n") == wanted).select(
        "query", F.col("score").alias("least")
    )
    rest = open_.where(F.col("n") > FIRST).join(found, "query", "left").where("least is null or upper >= least")
    return first.unionByName(fetch(rest))


def top_k(vectors: DataFrame, queries: DataFrame, k: int, id_column: str, vector_column: str) -> DataFrame:
    """(query_id, rank, vec_id, score): the k greatest products of every query with all other rows."""
    spark = vectors.sparkSession
    rows = whole_numbers(vectors, id_column, vector_column)
    exact = stored(entries(rows, k), "entries")
    asked = whole_numbers(queries, id_column, vector_column)
    own = most_vectors(rows, asked)
    # a query's vector may be missing from ``vectors``, so it is numbered by the ids of the queries
    named = stored(numbered(asked.groupBy("vector").agg(F.min("id").alias("least")), "query").select("vector", "query"), "query-vectors")
    low, step = cell_ranges(exact.select("vector").unionByName(named.select("vector")))
    file = stored(file_of_cells(exact, low, step), "cells")
    count = named.count()
    blocks, parts = -(-count // max(BLOCK * (k + 1) // (k + own), 1)), []
    for block in range(blocks):
        chosen = named.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == block).orderBy("query").toArrow().combine_chunks()
        if not chosen.num_rows:
            continue
        batch = chosen.to_batches()[0]
        block_of = (np.asarray(batch.column("query")), as_matrix(batch.column("vector"), len(low)))
        shared = spark.sparkContext.broadcast(block_of)
        found = certain(file, exact, shared, low, step, k, own)
        each = found.select("query", F.explode("ids").alias("held"), "score")
        each = each.select("query", F.col("held.id").alias("vec_id"), F.col("held.n").alias("copies"), "score")
        order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
        best = each.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + own).drop("n")
        parts.append(stored(best, "block-results"))
        shared.unpersist()
    schema = "query_id long, rank int, vec_id long, score long"
    if not parts:
        return spark.createDataFrame([], schema)
    best = parts[0]
    for part in parts[1:]:
        best = best.unionByName(part)
    each = asked.select(F.col("id").alias("query_id"), "vector", F.monotonically_increasing_id().alias("row"))
    each = stored(each, "query-rows").join(named, "vector").select("query_id", "row", "query")
    others = each.join(best, "query").where("query_id != vec_id")
    others = others.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)).cast("int"))))
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    ranked = others.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def vector_search(embeddings: DataFrame) -> DataFrame:
    """The 5 best of every 50th id."""
    rows = embeddings.select("vec_id", "embedding")
    return top_k(rows, rows.where("vec_id % 50 = 0"), 5, "vec_id", "embedding")


SQL = """
WITH whole AS (
    SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum([q.v[i] * c.v[i] FOR i IN range(1, len(q.v) + 1)]) AS BIGINT) AS score
    FROM whole q JOIN whole c ON q.vec_id != c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""
