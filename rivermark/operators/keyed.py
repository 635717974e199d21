"""Rows by key: newest per key, upsert, insert-if-absent, reconciliation.

Every grouping here is an aggregate with map-side combine, so a key that owns
a large share of the rows shrinks to one row per task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _by_key(left: DataFrame, right: DataFrame, keys: list[str], how: str, unique: bool) -> DataFrame:
    """Semi or anti join on all keys as one struct.

    Structs compare null fields as equal, so a key with a null part still
    meets itself. A right side that may repeat keys is made distinct first: it
    is then already hashed the way the join needs it, but the aggregate below
    the join also keeps adaptive execution from splitting a hot key of the left
    side. ``unique`` says that it does not repeat keys; nothing is aggregated
    and a hot key on the left is split.
    """
    key = F.struct(*keys).alias("_key")
    known = right.select(key) if unique else right.select(key).distinct()
    return left.select("*", key).join(known, "_key", how).select(*left.columns)


def matching(left: DataFrame, right: DataFrame, keys: list[str], unique: bool = False) -> DataFrame:
    """Left rows whose key occurs on the right."""
    return _by_key(left, right, keys, "left_semi", unique)


def missing(left: DataFrame, right: DataFrame, keys: list[str], unique: bool = False) -> DataFrame:
    """Left rows whose key does not occur on the right."""
    return _by_key(left, right, keys, "left_anti", unique)


def latest(df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """One row per key: the greatest by ``order``, ties by the other columns.

    The order is total over all columns, so a re-run picks the same row.
    """
    order = order or []
    rest = [c for c in df.columns if c not in keys and c not in order]
    if not order and not rest:
        return df.select(*keys).distinct()
    newest = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("newest"))
    picked = [F.col(c) if c in keys else F.col(f"newest.{c}") for c in df.columns]
    return newest.select(*picked)


def duplicated(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("linhas")).where(F.col("linhas") > 1)


def upsert(base: DataFrame, changes: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``base`` (unique by key) with ``changes`` applied, newest by ``order``.

    The changes are reduced to one row per key and meet the base in one full
    join, which reads either side once and shuffles it once at most: the changes are
    grouped by the struct they are joined on. Of
    two versions the one that is greater by ``order`` stays, ties by the other
    columns; applying the same changes twice gives the same table.
    """
    columns = base.columns
    ranked = [*order, *(c for c in columns if c not in keys and c not in order)]
    version = F.struct(*ranked)
    stored = base.select(F.struct(*keys).alias("_key"), version.alias("_stored"))
    newer = changes.select(F.struct(*keys).alias("_key"), version.alias("_newer"))
    newer = latest(newer, ["_key"], ["_newer"] if ranked else None)
    kept = F.when(F.col("_stored").isNull() | (F.col("_newer") > F.col("_stored")), F.col("_newer"))
    rows = stored.join(newer, "_key", "full").select("_key", F.coalesce(kept, "_stored").alias("_row"))
    return rows.select(*[F.col(f"_key.{c}") if c in keys else F.col(f"_row.{c}") for c in columns])


def new_rows(
    existing: DataFrame, batch: DataFrame, keys: list[str], order: list[str] | None = None
) -> DataFrame:
    """Rows of ``batch`` whose key is not stored yet, one per key.

    The stored table is first narrowed to keys the batch holds, so the anti
    join's right side is never larger than the batch.
    """
    stored = matching(existing.select(*keys), batch, keys)
    return missing(latest(batch, keys, order), stored, keys)


def reconcile(
    left: DataFrame, right: DataFrame, keys: list[str], names: tuple[str, str]
) -> DataFrame:
    """Per sink: its rows, and keys only the other sink holds.

    One grouping over both key sets replaces two counts and two anti joins.
    """
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    both = left.select(*keys, one.alias("n_l"), zero.alias("n_r")).unionByName(
        right.select(*keys, zero.alias("n_l"), one.alias("n_r"))
    )
    per_key = both.groupBy(*keys).agg(F.sum("n_l").alias("n_l"), F.sum("n_r").alias("n_r"))
    counts = per_key.agg(
        F.coalesce(F.sum("n_l"), zero).alias("rows_l"),
        F.coalesce(F.sum("n_r"), zero).alias("rows_r"),
        F.count_if(F.col("n_l") == 0).alias("absent_l"),
        F.count_if(F.col("n_r") == 0).alias("absent_r"),
    )
    sinks = F.array(
        F.struct(F.lit(names[0]).alias("destino"), F.col("rows_l").alias("linhas"),
                 F.col("absent_l").alias("chaves_ausentes")),
        F.struct(F.lit(names[1]).alias("destino"), F.col("rows_r").alias("linhas"),
                 F.col("absent_r").alias("chaves_ausentes")),
    )
    return counts.select(F.inline(sinks))
