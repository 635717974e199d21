"""Batch tables: files or a database, read with pruning left to Spark."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_files(spark: SparkSession, path: str, schema: str | None = None, fmt: str = "parquet") -> DataFrame:
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema else reader).load(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    options: Mapping[str, str] | None = None,
    split_by: str | None = None,
    bounds: tuple[object, object] | None = None,
    splits: int = 1,
) -> DataFrame:
    """A database table; filters, columns and top-n are pushed to it.

    With ``split_by`` and its bounds the read runs as ``splits`` range queries;
    rows outside the bounds still arrive, in the first and last range.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    reader = reader.options(**dict(options or {}))
    if split_by is not None and bounds is not None:
        reader = reader.options(
            partitionColumn=split_by,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(splits),
        )
    return reader.load()


def stored_keys(table: DataFrame, keys: list[str]) -> DataFrame:
    """The distinct keys a table holds."""
    return table.select(*keys).distinct()
