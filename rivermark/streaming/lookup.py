"""An index of values and their owners in hash buckets, so that a batch reads and rewrites only its own buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivermark.operators import keyed
from rivermark.sinks import versions

SCHEMA = "valor string, dono string, ordem bigint"


class Lookup:
    """``valor`` belongs to ``dono``; the entry with the greatest ``ordem`` counts, one without an owner frees the value.

    The index is a versioned table whose parts are ``buckets`` hash buckets. Choose the number by the size of
    the table, not of a batch, and never change it for an index that exists.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 256):
        self.spark, self.root, self.buckets = spark, root, buckets

    def bucket(self, value: str) -> Column:
        return F.format_string("%05d", F.pmod(F.xxhash64(F.col(value)), F.lit(self.buckets)))

    def next_order(self) -> int:
        return versions.version_of(versions.index(self.spark, self.root)) + 1

    def owners(self, values: DataFrame) -> DataFrame:
        """(valor, dono) for the ``valor`` of some rows, where it is owned."""
        parts = versions.touched(values.where("valor is not null"), self.bucket("valor"))
        stored = versions.part_rows(self.spark, self.root, SCHEMA, parts).where("dono is not null")
        return keyed.matching(stored.select("valor", "dono"), values, ["valor"])

    def apply(self, entries: DataFrame, query_id: str, batch_id: int) -> None:
        """Takes in (valor, dono, ordem) of a batch; a batch that was applied is passed over."""
        rows = entries.where("valor is not null").select("valor", "dono", F.col("ordem").cast("bigint").alias("ordem"))
        versions.upsert_batch(rows, self.root, ["valor"], ["ordem"], self.bucket("valor"), query_id, batch_id)

    def build(self, entries: DataFrame, name: str = "inicio") -> None:
        """Fills an index that does not exist yet from (valor, dono) of a stored table."""
        if not versions.index(self.spark, self.root):
            self.apply(entries.withColumn("ordem", F.lit(0)), name, 0)
