"""Rules between rows on the write path: one lead per e-mail, a session's lead is stored.

A relational table would refuse the whole batch, again on every replay. Here
the rows that break a rule go their own way and the others are written. Which way a row goes is decided once for
each batch and recorded (``decisions``), so a batch that fails after any of its writes comes to the same when it runs again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivermark.operators import keyed
from rivermark.streaming import decisions
from rivermark.streaming.decisions import DECISION
from rivermark.streaming.lookup import Lookup
from rivermark.streaming.router import Sink

KEPT, REFUSED, WAITING = "aceito", "recusado", "espera"
FREED = "_anterior"  # the value a stored row had, if another takes its place
ORDER = "_ordem"


def changed(rows: DataFrame, stored: DataFrame, key: str, order: list[str], column: str) -> DataFrame:
    """The rows that will be stored, by the rule of ``keyed.upsert``: the newest of each key, if newer than the stored one.

    FREED is the value of ``column`` they replace. Older versions claim nothing: the table would drop them.
    """
    ranked = [*order, *(c for c in rows.columns if c != key and c not in order)]
    newest = keyed.latest(rows, [key], order)
    old = keyed.matching(stored.select(*rows.columns), newest, [key])
    old = old.select(F.col(key).alias("_key"), F.struct(*ranked).alias("_old"))
    both = newest.join(old, F.col(key).eqNullSafe(F.col("_key")), "left")
    newer = F.col("_old").isNull() | (F.struct(*ranked) > F.col("_old"))
    return both.where(newer).select(*rows.columns, F.col("_old")[column].alias(FREED))


def unique(rows: DataFrame, owners: DataFrame, column: str, key: str = "id") -> DataFrame:
    """Rows with their ``destino``: a value belongs to the key that owns it, else to the smallest of
    the rows' keys. Null belongs to nobody and may repeat."""
    there = rows.where(F.col(column).isNotNull())
    mine = there.select(F.col(column).alias("valor"), F.lit(1).alias("_rank"), F.col(key).alias("dono"))
    theirs = owners.select("valor", F.lit(0).alias("_rank"), "dono")
    claims = theirs.unionByName(mine).groupBy("valor").agg(F.min(F.struct("_rank", "dono"))["dono"].alias("_owner"))
    judged = there.join(claims.withColumnRenamed("valor", column), column).withColumn(
        DECISION, F.when(F.col("_owner") == F.col(key), KEPT).otherwise(REFUSED)
    )
    free = rows.where(F.col(column).isNull()).withColumn(DECISION, F.lit(KEPT))
    return judged.select(*rows.columns, DECISION).unionByName(free)


def unique_sink(
    inner: Sink,
    refused: Sink,
    records: str,
    claims: Lookup,
    stored: Callable[[DataFrame], DataFrame],
    column: str,
    order: list[str],
    key: str = "id",
    keys: Lookup | None = None,
) -> Sink:
    """Writes rows that may have their value to ``inner`` and the others to ``refused``.

    ``stored`` gives the stored rows among which a batch's keys are; ``claims`` says who owns a value; ``keys``, if given,
    is kept as an index of all stored keys.
    """

    def sink(rows: DataFrame, query_id: str, batch_id: int) -> None:
        spark, columns = rows.sparkSession, rows.columns
        schema = T.StructType([*rows.schema.fields, T.StructField(FREED, rows.schema[column].dataType), T.StructField(ORDER, T.LongType())])

        held: list[DataFrame] = []

        def judge() -> DataFrame:
            batch = changed(rows, stored(rows), key, order, column).persist()
            held.append(batch)
            owners = claims.owners(batch.select(F.col(column).alias("valor")))
            return unique(batch, owners, column, key).withColumn(ORDER, F.lit(claims.next_order()))

        try:
            batch = decisions.decided(spark, records, query_id, batch_id, schema, judge)
        finally:
            for frame in held:
                frame.unpersist()
        kept = decisions.going(batch, KEPT)
        broken = decisions.going(batch, REFUSED).select(*columns, F.array(F.lit(f"unique_{column}")).alias("violations"))
        refused(broken, query_id, batch_id)
        inner(kept.select(*columns), query_id, batch_id)
        owned = kept.select(F.col(column).alias("valor"), F.col(key).alias("dono"), F.col(ORDER).alias("ordem"))
        freed = kept.where(~F.col(FREED).eqNullSafe(F.col(column)))
        freed = freed.select(F.col(FREED).alias("valor"), F.lit(None).cast("string").alias("dono"), F.col(ORDER).alias("ordem"))
        claims.apply(owned.unionByName(freed), query_id, batch_id)
        if keys:
            named = F.col(key).alias("valor"), F.col(key).alias("dono"), F.col(ORDER).alias("ordem")
            keys.apply(kept.select(*named), query_id, batch_id)

    return sink


def parent_sink(inner: Sink, records: str, parents: Callable[[DataFrame], DataFrame], column: str) -> Sink:
    """Writes rows whose parent is stored; the others wait and are tried again with every batch.

    ``parents`` gives the stored ones (``valor``, unique) among some values. What waits after a batch is part of its
    record, and so is what the batch took from the one before.
    """

    def sink(rows: DataFrame, query_id: str, batch_id: int) -> None:
        spark = rows.sparkSession

        def judge() -> DataFrame:
            batch, last = rows, decisions.before(spark, records, query_id, batch_id)
            if last:
                batch = rows.unionByName(waiting(spark, records, *last, rows.schema))
            return with_parent(batch, parents, column)

        batch = decisions.decided(spark, records, query_id, batch_id, rows.schema, judge)
        inner(decisions.going(batch, KEPT), query_id, batch_id)

    return sink


def with_parent(batch: DataFrame, parents: Callable[[DataFrame], DataFrame], column: str) -> DataFrame:
    """Rows with their ``destino``. Rows without a parent go round the join, and the parents are unique, so a hot one is split."""
    values = batch.where(F.col(column).isNotNull())
    there = parents(values.select(F.col(column).alias("valor"))).select(F.col("valor").alias(column), F.lit(KEPT).alias("_there"))
    judged = values.join(there, column, "left").select(*batch.columns, F.coalesce("_there", F.lit(WAITING)).alias(DECISION))
    return judged.unionByName(batch.where(F.col(column).isNull()).withColumn(DECISION, F.lit(KEPT)))


def waiting(spark, records: str, query_id: str, batch_id: int, schema: T.StructType) -> DataFrame:
    """Rows that waited for their parent after a batch."""
    return decisions.going(decisions.recorded(spark, records, query_id, batch_id, schema), WAITING)
