"""Two copies of a table compared by sums of row hashes, so that only buckets that differ are compared by key.

Both sides are read once and meet as one row per bucket. Hashes are 64-bit; a bucket whose rows differ has equal
sums with probability about 2**-64 for each of two sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096
MISSING, EXTRA, CHANGED = "ausente", "excedente", "diferente"


def bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def row_hash(columns: list[str]) -> Column:
    """Hash of a row; nulls count by their place."""
    return F.xxhash64(*(F.struct(F.col(c).isNull(), F.col(c)) for c in columns))


def sums(rows: DataFrame, keys: list[str], columns: list[str], buckets: int = BUCKETS) -> DataFrame:
    """(balde, linhas, soma, soma2): one row per bucket, added up in the tasks that read the rows.

    Store it beside a table that seldom changes, or per batch of one that grows: sums of parts add up.
    """
    value = row_hash(columns)
    hashed = rows.select(bucket(keys, buckets).alias("balde"), value.alias("h"), F.xxhash64(value, F.lit(1)).alias("h2"))
    return hashed.groupBy("balde").agg(
        F.count("*").alias("linhas"),
        F.sum(F.col("h").cast("decimal(20,0)")).alias("soma"),
        F.sum(F.col("h2").cast("decimal(20,0)")).alias("soma2"),
    )


def differing(left: DataFrame, right: DataFrame) -> DataFrame:
    """Buckets whose sums are not the same on both sides."""
    values = F.struct("linhas", "soma", "soma2")
    one, two = left.select("balde", values.alias("a")), right.select("balde", values.alias("b"))
    return one.join(two, "balde", "full").where(~F.col("a").eqNullSafe(F.col("b"))).select("balde")


def differences(
    left: DataFrame, right: DataFrame, keys: list[str], columns: list[str] | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """(keys, estado): keys that the right side lacks, has in excess, or holds with other values.

    A key that repeats is compared as the bag of its rows. The list of differing buckets has ``buckets``
    rows at most, so it can be sent to all tasks; the rows of equal buckets are not shuffled.
    """
    columns = columns or left.columns
    wrong = F.broadcast(differing(sums(left, keys, columns, buckets), sums(right, keys, columns, buckets)))
    value = row_hash(columns)

    def side(rows: DataFrame, sign: int) -> DataFrame:
        named = rows.select(*keys, bucket(keys, buckets).alias("balde"), value.alias("h"))
        return named.join(wrong, "balde", "left_semi").select(*keys, "h", F.lit(sign).alias("lado"))

    both = side(left, 1).unionByName(side(right, -1))
    per_key = both.groupBy(*keys).agg(
        F.count_if(F.col("lado") == 1).alias("a"),
        F.count_if(F.col("lado") == -1).alias("b"),
        F.sum(F.col("lado") * F.col("h").cast("decimal(20,0)")).alias("soma"),
        F.sum(F.col("lado") * F.xxhash64("h").cast("decimal(20,0)")).alias("soma2"),
    )
    state = F.when(F.col("b") == 0, MISSING).when(F.col("a") == 0, EXTRA)
    state = state.when((F.col("a") != F.col("b")) | (F.col("soma") != 0) | (F.col("soma2") != 0), CHANGED)
    return per_key.select(*keys, state.alias("estado")).where("estado is not null")


def to_send(source: DataFrame, sent: DataFrame, keys: list[str], buckets: int = BUCKETS) -> DataFrame:
    """Source rows that the sink lacks or holds with other values; ``sent`` holds what was sent, newest per key."""
    wrong = differences(source, sent, keys, source.columns, buckets).where(F.col("estado") != EXTRA)
    key = F.struct(*keys).alias("_key")
    return source.select("*", key).join(wrong.select(key), "_key", "left_semi").select(*source.columns)
