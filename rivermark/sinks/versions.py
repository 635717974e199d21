"""Keyed Parquet tables whose batches replace the parts they touch.

Rows lie in folders by day, or by another part such as a hash bucket. A batch reads the parts its rows belong to, applies
them, writes these parts anew into a folder of its own, and then writes an index
that names the folder of every part. The index has two places that are written
in turn, each with a version number, so the one that counts is never the one
being written. Readers see a batch whole or not at all.

The index also holds, for each query that wrote to the table, its last batch: a batch that was
applied is passed over, whichever other query wrote in between.

A key's part must not change, so take a day from a time that is fixed when the row
is created. One query at a time may write a table. ``vacuum`` deletes the folders that no index names any
more, after a time in which readers may still use them.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from rivermark.operators import keyed
from rivermark.sinks import folders as places

# A row without a day says which batch of a query was applied last.
INDEX = "dia string, pasta string, versao bigint, consulta string, lote bigint"
NO_DAY = "sem-dia"
TRIES = 5


def index(spark: SparkSession, root: str) -> list[Row]:
    """The newest version: each part's folder, and each query's last batch.

    A place that is being written is not complete and is not the newest; one that is replaced while it is read is read again.
    """
    for left in reversed(range(TRIES)):
        paths = [path for path in (f"{root}/indice/0", f"{root}/indice/1") if places.complete(spark, path)]
        try:
            rows = spark.read.schema(INDEX).parquet(*paths).collect() if paths else []
            break
        except PySparkException as error:
            replaced = error.getCondition() == "PATH_NOT_FOUND" or "FILE_NOT_EXIST" in str(error)
            if not left or not replaced:
                raise
            time.sleep(0.2)
    newest = max((r.versao for r in rows), default=0)
    return [r for r in rows if r.versao == newest]


def _write_index(
    spark: SparkSession, root: str, folders: Mapping[str, str], version: int, marks: Mapping[str, int]
) -> None:
    rows = [(day, folder, version, None, None) for day, folder in folders.items()]
    rows += [(None, None, version, query, batch) for query, batch in marks.items()]
    frame = spark.createDataFrame(rows, INDEX).coalesce(1)
    frame.write.mode("overwrite").parquet(f"{root}/indice/{version % 2}")


def version_of(entries: list[Row]) -> int:
    return max((r.versao for r in entries), default=0)


def marks_of(entries: list[Row]) -> dict[str, int]:
    """The last batch of every query that wrote to the table."""
    return {r.consulta: r.lote for r in entries if r.dia is None}


def applied(spark: SparkSession, root: str, query_id: str, batch_id: int) -> bool:
    """True when the table holds this batch of the query."""
    return marks_of(index(spark, root)).get(query_id, -1) >= batch_id


def _folders(entries: list[Row]) -> dict[str, str]:
    return {r.dia: r.pasta for r in entries if r.dia is not None}


def _rows(spark: SparkSession, root: str, folders: dict[str, str], schema) -> DataFrame:
    paths = [f"{root}/dados/{folder}/dia={day}" for day, folder in sorted(folders.items())]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def part_of(day: str | Column, period: str = "yyyy-MM-dd") -> Column:
    """Name of a row's part: of the day, month or year of a time, or a column as it is."""
    if isinstance(day, Column):
        return day
    return F.coalesce(F.date_format(F.to_date(day), period), F.lit(NO_DAY))


def touched(rows: DataFrame, part: Column) -> list[str]:
    """Names of the parts that rows belong to."""
    return [r.dia for r in rows.select(part.alias("dia")).distinct().collect()]


def part_rows(spark: SparkSession, root: str, schema, parts: list[str]) -> DataFrame:
    """Current rows of some parts; no other folder is read."""
    folders = _folders(index(spark, root))
    return _rows(spark, root, {p: folders[p] for p in parts if p in folders}, schema)


def table_rows(spark: SparkSession, root: str, schema) -> DataFrame:
    """The table's current rows."""
    return _rows(spark, root, _folders(index(spark, root)), schema)


def upsert_batch(
    rows: DataFrame,
    root: str,
    keys: list[str],
    order: list[str],
    day: str | Column,
    query_id: str,
    batch_id: int,
    period: str = "yyyy-MM-dd",
    marks: Mapping[str, int] | None = None,
) -> None:
    """Applies a batch, newest by ``order``; a batch that was applied before is passed over.

    ``period`` is the length of what is written anew, as a date pattern: months
    (``yyyy-MM``) or years for a table with few rows a day; ``day`` may also be a column that names the part. ``marks``
    are the last batches that the rows come from, if they come from several queries.
    """
    spark = rows.sparkSession
    if "dia" in rows.columns:
        raise ValueError("the column dia names the parts of a table; give yours another name")
    entries = index(spark, root)
    applied, marks = marks_of(entries), marks or {query_id: batch_id}
    if all(applied.get(query, -1) >= batch for query, batch in marks.items()):
        return
    folders, version, name = _folders(entries), version_of(entries) + 1, part_of(day, period)
    days = touched(rows, name)
    own = f"{version}-{query_id}-{batch_id}"
    if days:
        stored = _rows(spark, root, {d: folders[d] for d in days if d in folders}, rows.schema)
        merged = keyed.upsert(stored, rows, keys, order).withColumn("dia", name)
        merged.hint("rebalance", "dia").write.mode("overwrite").partitionBy("dia").parquet(f"{root}/dados/{own}")
    _write_index(spark, root, folders | dict.fromkeys(days, own), version, applied | marks)


def replace_parts(rows: DataFrame, root: str, query_id: str, batch_id: int) -> None:
    """Puts ``rows`` in the place of all rows of the parts that their column ``dia`` names; a batch that
    was applied is passed over."""
    spark = rows.sparkSession
    entries = index(spark, root)
    applied = marks_of(entries)
    if applied.get(query_id, -1) >= batch_id:
        return
    version = version_of(entries) + 1
    own = f"{version}-{query_id}-{batch_id}"
    rows.hint("rebalance", "dia").write.mode("overwrite").partitionBy("dia").parquet(f"{root}/dados/{own}")
    written = places.entries(spark, f"{root}/dados/{own}")
    days = [e.name.removeprefix("dia=") for e in written if e.name.startswith("dia=")]
    _write_index(spark, root, _folders(entries) | dict.fromkeys(days, own), version, applied | {query_id: batch_id})


def upsert_sink(
    root: str, keys: list[str], order: list[str], day: str, period: str = "yyyy-MM-dd"
) -> Callable[[DataFrame, str, int], None]:
    """A stream sink that keeps the newest row of every key, however often it is replayed."""

    def sink(rows: DataFrame, query_id: str, batch_id: int) -> None:
        batch = rows.persist()
        try:
            upsert_batch(batch, root, keys, order, day, query_id, batch_id, period)
        finally:
            batch.unpersist()

    return sink


def drop_days_before(spark: SparkSession, root: str, first_day: str) -> list[str]:
    """Retention: takes days before ``first_day`` out of the index and returns them. What was applied stays known."""
    entries = index(spark, root)
    folders = _folders(entries)
    gone = sorted(d for d in folders if d != NO_DAY and d < first_day)
    if gone:
        kept = {d: f for d, f in folders.items() if d not in gone}
        _write_index(spark, root, kept, version_of(entries) + 1, marks_of(entries))
    return gone


def vacuum(spark: SparkSession, root: str, seconds: float = 24 * 3600) -> list[str]:
    """Deletes parts that the index does not name and that are older than ``seconds``; their paths below the table.

    A reader that began before the newest version may still use them, so ``seconds`` must be longer than any
    reader runs, and than a batch takes from its first file to its index.
    """
    before, named = time.time() - seconds, set(_folders(index(spark, root)).items())
    deleted = []
    for folder in places.entries(spark, f"{root}/dados"):
        inside = [e for e in places.entries(spark, f"{root}/dados/{folder.name}") if e.name.startswith("dia=")]
        free = [e for e in inside if (e.name.removeprefix("dia="), folder.name) not in named and e.changed < before]
        if len(free) == len(inside) and folder.changed < before:
            places.remove(spark, f"{root}/dados/{folder.name}")
        else:
            for entry in free:
                places.remove(spark, f"{root}/dados/{folder.name}/{entry.name}")
        deleted += [f"{folder.name}/{e.name}" for e in free]
    return deleted
