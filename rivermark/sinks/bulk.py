"""Documents as bodies of bulk requests, in bounded files that a sender posts one by one.

Every document is an action line and a source line. A batch owns a folder and replaces it when it runs again; the
action updates by id and inserts if there is none, so posting a body twice does no harm. Whoever posts takes the folders of
complete batches in order of their number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivermark.operators.payload import JSON_OPTIONS
from rivermark.sinks import folders

PER_BODY = 5000  # documents


def bodies(documents: DataFrame, index: str, key: str = "id") -> DataFrame:
    """``value``: the two lines of every document."""
    target = F.struct(F.struct(F.lit(index).alias("_index"), F.col(key).cast("string").alias("_id")).alias("update"))
    source = F.struct(F.struct("*").alias("doc"), F.lit(True).alias("doc_as_upsert"))
    lines = F.concat_ws("\n", F.to_json(target), F.to_json(source, JSON_OPTIONS))
    return documents.select(lines.alias("value"))


def write_bodies(
    documents: DataFrame, root: str, query_id: str, batch_id: int, index: str, key: str = "id", per_body: int = PER_BODY
) -> None:
    """Writes a batch's bodies, ``per_body`` documents each at most, replacing an earlier attempt."""
    lines = bodies(documents, index, key)
    lines.write.mode("overwrite").option("maxRecordsPerFile", per_body).text(f"{root}/consulta={query_id}/lote={batch_id}")


def bodies_sink(root: str, index: str, key: str = "id", per_body: int = PER_BODY):
    def sink(documents: DataFrame, query_id: str, batch_id: int) -> None:
        write_bodies(documents, root, query_id, batch_id, index, key, per_body)

    return sink


def to_post(spark: SparkSession, root: str, query_id: str, after: int = -1) -> list[tuple[int, str]]:
    """(batch, path) of the bodies of complete batches after one, in the order they are to be posted."""
    found = []
    for entry in folders.entries(spark, f"{root}/consulta={query_id}"):
        number = entry.name.removeprefix("lote=")
        folder = f"{root}/consulta={query_id}/{entry.name}"
        if number.isdigit() and int(number) > after and folders.complete(spark, folder):
            names = (e.name for e in folders.entries(spark, folder))
            found += [(int(number), f"{folder}/{name}") for name in names if not name.startswith(("_", "."))]
    return sorted(found)


def documents_of(spark: SparkSession, root: str, schema) -> DataFrame:
    """What a store holds after all bodies were posted in order: of each id the document of its last batch.

    Two batches of different queries are ordered by query; within a batch an id must not repeat.
    """
    kind = spark.createDataFrame([], schema).schema.simpleString()
    lines = spark.read.option("basePath", root).text(f"{root}/consulta=*")
    sources = lines.where(F.col("value").startswith('{"doc":'))
    parsed = sources.select("consulta", "lote", F.from_json("value", f"doc {kind}", JSON_OPTIONS)["doc"].alias("doc"))
    newest = parsed.groupBy(F.col("doc.id").alias("_id")).agg(F.max_by("doc", F.struct("consulta", "lote")).alias("doc"))
    return newest.select("doc.*")
