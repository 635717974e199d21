"""Catalog tables: create, recreate, comment, insert literal rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession

from rivermark import schemas

EVENTS_TABLE = f"{schemas.EVENT}, processado_em timestamp"
WINDOWS_TABLE = """
    janela_inicio timestamp, janela_fim timestamp, categoria string, evento string,
    total_eventos bigint, valor_medio double, valor_total double, processado_em timestamp
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create(
    spark: SparkSession,
    name: str,
    columns: str,
    location: str | None = None,
    partition_by: str | None = None,
) -> None:
    """Creates a Parquet table unless it exists."""
    parts = f"PARTITIONED BY ({partition_by})" if partition_by else ""
    place = f"LOCATION {_quoted(location)}" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {parts} {place}")


def recreate(spark: SparkSession, name: str, columns: str, location: str | None = None) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    create(spark, name, columns, location)


def comment(spark: SparkSession, name: str, text: str) -> None:
    spark.sql(f"COMMENT ON TABLE {name} IS {_quoted(text)}")


def comment_view(spark: SparkSession, name: str, text: str) -> None:
    spark.sql(f"ALTER VIEW {name} SET TBLPROPERTIES ('comment' = {_quoted(text)})")


def insert_rows(spark: SparkSession, name: str, rows: Iterable[tuple], columns: str) -> None:
    spark.createDataFrame(list(rows), columns).write.mode("append").insertInto(name)
