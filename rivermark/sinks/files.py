"""Parquet tables that streams append to and batches rebuild.

Micro-batches are replayed after a failure. Each one therefore owns a folder,
named by its query and batch number, and replaces it when it runs again: the
write is idempotent without looking at what is stored. Rows that may repeat
under one key across batches are read through ``keyed.latest`` or folded by
``rebuild``.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivermark.functions.times import AsOf, cutoff
from rivermark.operators import keyed
from rivermark.sinks import folders, versions

BATCH_COLUMNS = ["consulta", "lote"]


def write_batch(df: DataFrame, root: str, query_id: str, batch_id: int) -> None:
    """Stores one micro-batch, replacing an earlier attempt of the same one."""
    df.write.mode("overwrite").parquet(f"{root}/consulta={query_id}/lote={batch_id}")


def drop_empty(spark: SparkSession, root: str, query_id: str, batch_id: int, schema) -> None:
    """Deletes the folder of a stored batch that has no rows. Only file footers are read."""
    folder = f"{root}/consulta={query_id}/lote={batch_id}"
    if spark.read.schema(schema).parquet(folder).isEmpty():
        folders.remove(spark, folder)


def read_batches(spark: SparkSession, root: str, schema) -> DataFrame:
    """All stored micro-batches as one table, in the given schema.

    Filters on ``consulta`` and ``lote`` prune folders, so they stay columns;
    drop them where rows are compared.
    """
    if not any(folders.entries(spark, f"{root}/{q.name}") for q in folders.entries(spark, root)):
        none = spark.createDataFrame([], schema)
        return none.withColumns({"consulta": F.lit(None).cast("string"), "lote": F.lit(None).cast("int")})
    rows = spark.read.schema(schema).option("basePath", root)
    return rows.parquet(f"{root}/consulta=*")


def table_rows(spark: SparkSession, root: str, schema) -> DataFrame:
    return read_batches(spark, root, schema).drop(*BATCH_COLUMNS)


def with_day(df: DataFrame, time: str = "timestamp") -> DataFrame:
    """Adds the day a row is stored under."""
    return df.withColumn("dia", F.to_date(time))


def write_by_day(df: DataFrame, path: str, time: str = "timestamp", mode: str = "errorifexists") -> None:
    """Writes a table partitioned by day with files of even size.

    Rebalancing groups rows by day and lets adaptive execution split the large
    days and merge the small ones, so one busy day is not one task.
    """
    with_day(df, time).hint("rebalance", "dia").write.mode(mode).partitionBy("dia").parquet(path)


def compact(spark: SparkSession, source: str, target: str) -> None:
    """Rewrites a day-partitioned table into few files, rows unchanged.

    The target is a new folder: readers keep the old one until it is complete.
    """
    rows = spark.read.parquet(source)
    rows.hint("rebalance", "dia").write.partitionBy("dia").parquet(target)


def retained(
    df: DataFrame, time: str = "timestamp", days: int = 90, as_of: AsOf = None
) -> DataFrame:
    """Rows not older than the retention time; null times are kept."""
    limit = cutoff(df, time, as_of, days=days)
    return df.where((F.col(time) >= limit) | F.col(time).isNull())


def drop_old_days(spark: SparkSession, table: str, first_day: str) -> list[str]:
    """Drops a catalog table's day partitions before ``first_day``.

    Whole days go, so no file is rewritten; the day the limit falls into stays
    until all of it is past. Only the partition list reaches the driver, one entry per stored day.
    """
    listed = spark.sql(f"SHOW PARTITIONS {table}").where(F.col("partition") < f"dia={first_day}")
    dropped = [row["partition"].split("=", 1)[1] for row in listed.collect()]
    for day in dropped:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (dia = DATE '{day}')")
    return dropped


def rebuilt(raw: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The keyed table raw rows stand for: the newest row of each key."""
    return keyed.latest(raw, keys, order)


def rebuild(raw: DataFrame, keys: list[str], order: list[str], target: str) -> None:
    """Writes the keyed table anew; swap readers to ``target`` when it is done."""
    rebuilt(raw, keys, order).write.parquet(target)


def _unfolded(spark: SparkSession, root: str, table: str, schema) -> DataFrame:
    """Batches of ``root`` that ``table`` does not hold yet: of each query those after its mark."""
    rows = read_batches(spark, root, schema)
    folded = F.lit(False)
    for query, batch in versions.marks_of(versions.index(spark, table)).items():
        folded |= (F.col("consulta") == query) & (F.col("lote") <= batch)
    return rows.where(~folded)


def fold(spark: SparkSession, root: str, table: str, schema, keys: list[str], order: list[str], day: str = "timestamp") -> None:
    """Moves the batches of ``root`` into a table by day: few files per day, one row per key.

    Any number of queries may have written ``root``, one after the other or side by side; they may go on meanwhile, their later
    batches are taken next time. The table keeps a mark for each of them.
    """
    rows = _unfolded(spark, root, table, schema)
    last = {r.consulta: r.lote for r in rows.groupBy("consulta").agg(F.max("lote").alias("lote")).collect()}
    if last:
        taken = F.lit(False)
        for query, batch in last.items():
            taken |= (F.col("consulta") == query) & (F.col("lote") <= batch)
        query, batch = max(last.items())
        versions.upsert_batch(rows.where(taken).drop(*BATCH_COLUMNS), table, keys, order, day, query, batch, marks=last)


def folded_rows(spark: SparkSession, root: str, table: str, schema) -> DataFrame:
    """The folded table and the batches that came after it."""
    return versions.table_rows(spark, table, schema).unionByName(_unfolded(spark, root, table, schema).drop(*BATCH_COLUMNS))


def drop_folded(spark: SparkSession, root: str, table: str, seconds: float = 24 * 3600) -> list[str]:
    """Deletes batch folders that ``table`` holds and that are older than ``seconds``."""
    before, deleted = time.time() - seconds, []
    for query, last in versions.marks_of(versions.index(spark, table)).items():
        for entry in folders.entries(spark, f"{root}/consulta={query}"):
            name = entry.name.removeprefix("lote=")
            if name.isdigit() and int(name) <= last and entry.changed < before:
                folders.remove(spark, f"{root}/consulta={query}/{entry.name}")
                deleted.append(f"consulta={query}/{entry.name}")
    return deleted
