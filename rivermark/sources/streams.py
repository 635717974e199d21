"""Message streams with the source format as a parameter."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def broker_options(
    servers: str,
    topic: str,
    starting: str = "latest",
    per_batch: int | None = None,
    fail_on_data_loss: bool = False,
) -> dict[str, str]:
    """Options of a Kafka source.

    ``starting`` counts only when the checkpoint is new: "latest" for the
    event job, "earliest" for the router and for replays. ``per_batch`` bounds
    the messages of one batch, so a long backlog is taken in pieces. Messages
    the broker has deleted before they were read are passed over, with a
    warning in the log, unless ``fail_on_data_loss``.
    """
    bound = {} if per_batch is None else {"maxOffsetsPerTrigger": str(per_batch)}
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
        **bound,
    }


def message_stream(
    spark: SparkSession,
    fmt: str,
    options: Mapping[str, str],
    schema: str | None = None,
    path: str | None = None,
) -> DataFrame:
    """Unbounded rows of any source; messages carry their bytes in ``value``."""
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def file_stream(
    spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_batch: int | None = None
) -> DataFrame:
    """A folder or glob whose new files form the stream."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)
