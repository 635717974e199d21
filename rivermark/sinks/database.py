"""Database tables: append and insert-if-absent over JDBC, upsert per partition."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from itertools import batched
from typing import Any

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from rivermark.operators import keyed
from rivermark.sources.tables import read_jdbc


def append(df: DataFrame, url: str, table: str, options: Mapping[str, str]) -> None:
    """Appends rows; ``numPartitions`` in the options bounds the connections."""
    writer = df.write.format("jdbc").option("url", url).option("dbtable", table)
    writer.options(**options).mode("append").save()


def insert_if_absent(
    df: DataFrame,
    existing: DataFrame,
    write: Callable[[DataFrame], None],
    keys: list[str],
    order: list[str] | None = None,
) -> int:
    """Writes the rows whose key is not stored and returns their number.

    The number is observed while the rows are written: one action, and the
    count always is the count of that write.
    """
    seen = Observation("insert_if_absent")
    rows = keyed.new_rows(existing, df, keys, order)
    write(rows.observe(seen, F.count(F.lit(1)).alias("inserted")))
    return seen.get["inserted"]


def within_batch_times(existing: DataFrame, batch: DataFrame, time: str) -> DataFrame:
    """The stored rows a batch can repeat: those between its first and last time.

    The two times become plain values, so the database and the file reader
    filter by them. Only usable when ``time`` is part of the key.
    """
    first, last = batch.agg(F.min(time), F.max(time)).first()
    if first is None:
        return existing.limit(0)
    return existing.where(F.col(time).between(F.lit(first), F.lit(last)))


def keyed_sink(
    read: Callable[[], DataFrame],
    write: Callable[[DataFrame], None],
    keys: list[str],
    order: list[str] | None = None,
    time: str | None = None,
) -> Callable[[DataFrame, str, int], None]:
    """A stream sink that never inserts a stored key, however often it is replayed.

    Part of a batch may be stored when its write fails half-way; the replay
    then inserts the rest. The batch is kept while it is looked up and written,
    so a stateful query runs once per batch.
    """

    def sink(rows: DataFrame, query_id: str, batch_id: int) -> None:
        batch = rows.persist()
        try:
            existing = read()
            if time is not None:
                existing = within_batch_times(existing, batch, time)
            insert_if_absent(batch, existing, write, keys, order)
        finally:
            batch.unpersist()

    return sink


def jdbc_sink(
    spark: SparkSession,
    url: str,
    table: str,
    options: Mapping[str, str],
    keys: list[str],
    time: str | None = None,
) -> Callable[[DataFrame, str, int], None]:
    return keyed_sink(
        lambda: read_jdbc(spark, url, table, options),
        lambda rows: append(rows, url, table, options),
        keys,
        time=time,
    )


def upsert_statement(
    table: str, columns: list[str], keys: list[str], mark: str = "%s", newer: str | None = None
) -> str:
    """With ``newer`` a stored row is replaced only by one that is not older in that column."""
    marks = ", ".join([mark] * len(columns))
    changed = [c for c in columns if c not in keys]
    action = "DO NOTHING"
    if changed:
        action = "DO UPDATE SET " + ", ".join(f"{c} = EXCLUDED.{c}" for c in changed)
        if newer:
            action += f" WHERE {table}.{newer} IS NULL OR EXCLUDED.{newer} >= {table}.{newer}"
    return (
        f"INSERT INTO {table} ({', '.join(columns)}) VALUES ({marks}) "
        f"ON CONFLICT ({', '.join(keys)}) {action}"
    )


def upsert(
    df: DataFrame,
    connect: Callable[[], Any],
    table: str,
    keys: list[str],
    order: list[str],
    connections: int = 8,
    rows_per_call: int = 1000,
    mark: str = "%s",
) -> None:
    """Inserts or updates rows by key, one transaction per partition.

    Rows are reduced to one per key and hashed by key, so no two partitions
    write the same row. A retried task repeats its statements with the same
    effect, and a batch that comes late does not undo a newer one: the first
    column of ``order`` guards the update. Nothing is looked up, so the cost
    follows the batch. ``connect`` opens a DB-API connection inside the task.
    """
    rows = keyed.latest(df, keys, order).repartition(connections, *keys)
    columns = rows.columns
    statement = upsert_statement(table, columns, keys, mark, order[0])

    def write_partition(partition: Iterable[Row]) -> None:
        connection = connect()
        try:
            cursor = connection.cursor()
            for chunk in batched(partition, rows_per_call):
                cursor.executemany(statement, [tuple(row) for row in chunk])
            connection.commit()
        finally:
            connection.close()

    rows.foreachPartition(write_partition)


def upsert_sink(
    connect: Callable[[], Any], table: str, keys: list[str], order: list[str], **options: Any
) -> Callable[[DataFrame, str, int], None]:
    """A stream sink that keeps the newest row of every key."""
    return lambda rows, query_id, batch_id: upsert(rows, connect, table, keys, order, **options)
