"""Where each row of a batch went, recorded before any of them is written.

Rules between rows look at what is stored. If a batch fails half-way and is run again, what is stored has changed, and judging
again would send a row elsewhere than at first, past sinks that have already taken the batch. So the judgement is
written once, with the rows, and whoever runs the batch again reads it.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivermark.sinks import folders

DECISION = "destino"


def folder_of(root: str, query_id: str, batch_id: int) -> str:
    return f"{root}/consulta={query_id}/lote={batch_id}"


def recorded(spark: SparkSession, root: str, query_id: str, batch_id: int, schema: T.StructType) -> DataFrame:
    """The rows of a decided batch with their ``destino``; a filter on it reads one folder."""
    whole = T.StructType([*(f for f in schema.fields if f.name != DECISION), T.StructField(DECISION, T.StringType())])
    return spark.read.schema(whole).parquet(folder_of(root, query_id, batch_id))


def decided(
    spark: SparkSession, root: str, query_id: str, batch_id: int, schema: T.StructType, judge: Callable[[], DataFrame]
) -> DataFrame:
    """The batch as it was decided; ``judge`` gives rows with their ``destino`` and is called if no complete record exists."""
    folder = folder_of(root, query_id, batch_id)
    if not folders.complete(spark, folder):
        judge().write.mode("overwrite").partitionBy(DECISION).parquet(folder)
    return recorded(spark, root, query_id, batch_id, schema)


def before(spark: SparkSession, root: str, query_id: str, batch_id: int) -> tuple[str, int] | None:
    """Query and number of the batch that was decided before this one.

    For a query's first batch that is the last one of the query that wrote last: a
    new checkpoint goes on where the old one ended.
    """
    if batch_id and folders.complete(spark, folder_of(root, query_id, batch_id - 1)):
        return query_id, batch_id - 1
    found = []
    for query in folders.entries(spark, root):
        name = query.name.removeprefix("consulta=")
        for batch in folders.entries(spark, f"{root}/{query.name}") if name != query_id else ():
            number = batch.name.removeprefix("lote=")
            if number.isdigit() and folders.complete(spark, folder_of(root, name, int(number))):
                found.append((batch.changed, int(number), name))
    if not found:
        return None
    _, number, name = max(found)
    return name, number


def forget(spark: SparkSession, root: str, query_id: str, batch_id: int, seconds: float = 24 * 3600) -> None:
    """Deletes records that no replay needs: older than ``seconds``, and not of the newest batch but one of their query or later."""
    limit = time.time() - seconds
    for query in folders.entries(spark, root):
        numbers = [(e, int(e.name.removeprefix("lote="))) for e in folders.entries(spark, f"{root}/{query.name}") if e.name.startswith("lote=")]
        newest = max((n for _, n in numbers), default=0)
        for entry, number in numbers:
            if number < newest - 1 and entry.changed < limit:
                folders.remove(spark, f"{root}/{query.name}/{entry.name}")


def going(rows: DataFrame, where: str) -> DataFrame:
    return rows.where(F.col(DECISION) == where).drop(DECISION)
