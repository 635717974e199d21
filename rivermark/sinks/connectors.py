"""Writers for message brokers, document stores and any Spark data source.

The connector is named by its format; its jar comes with the cluster.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

# A message counts as sent when all replicas have it.
BROKER_DELIVERY = {"kafka.acks": "all", "kafka.retries": "3"}


def broker_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, **BROKER_DELIVERY}


def publish(messages: DataFrame, fmt: str, options: Mapping[str, str]) -> None:
    """Sends messages (``value``, optional ``key``) from the tasks that hold them."""
    messages.write.format(fmt).options(**options).mode("append").save()


def document_options(host: str, port: int, index: str, id_column: str | None = "id") -> dict[str, str]:
    """Options of an Elasticsearch sink.

    With an id column a replayed document replaces itself; without one every
    write adds a document.
    """
    options = {
        "es.nodes": host,
        "es.port": str(port),
        "es.resource": index,
        "es.nodes.wan.only": "true",
    }
    if id_column is not None:
        options |= {"es.mapping.id": id_column, "es.write.operation": "upsert"}
    return options


def write_documents(df: DataFrame, options: Mapping[str, str], fmt: str = "org.elasticsearch.spark.sql") -> None:
    df.write.format(fmt).options(**options).mode("append").save()
