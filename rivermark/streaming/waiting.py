"""Sessions that wait for their lead in the state of one stream of both.

Other than ``constraints.parent_sink`` this reads no table: the state knows which leads have come, and holds what waits for the
others. A batch touches the state of its own leads only, and a restart goes on from the checkpoint.
Several states of one key need RocksDB: start the stream inside ``session.rocksdb_state``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

SPREAD = 4  # parts of a lead's sessions; a lead is told to each of them
STEP = 500  # rows moved to or from the state at once
STORED, EXPIRED = "aceito", "expirado"
KNOWN, HELD = "conhecido", "espera"


class WaitingRows(StatefulProcessor):
    """Rows leave with STORED once their parent has come, or with EXPIRED when they have waited for ``patience_ms``."""

    def __init__(self, row_schema: T.StructType, patience_ms: int | None = None):
        self.row_schema, self.patience_ms = row_schema, patience_ms
        self.names = row_schema.fieldNames()

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.known = handle.getValueState(KNOWN, "sim boolean")
        self.held = handle.getListState(HELD, self.row_schema)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.known.update((True,))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known = key[0] is None or self.known.exists()
        fresh: list[tuple] = []
        waiting = False
        for row in rows:
            if row._pai:
                if known:
                    continue
                known = True
                self.known.update((True,))
                for held in self.held.get():
                    yield self.leaving(held, STORED)
                self.held.clear()
                for held in fresh:
                    yield self.leaving(held, STORED)
                fresh = []
            elif known:
                yield self.leaving([row[n] for n in self.names], STORED)
            else:
                fresh.append(tuple(row[n] for n in self.names))
                waiting = True
                if len(fresh) == STEP:
                    self.held.appendList(fresh)
                    fresh = []
        if fresh:
            self.held.appendList(fresh)
        if waiting and not known and self.patience_ms is not None and not any(True for _ in islice(self.handle.listTimers(), 1)):
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.patience_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.known.exists():
            for held in self.held.get():
                yield self.leaving(held, EXPIRED)
            self.held.clear()

    def leaving(self, values, where: str) -> Row:
        return Row(**dict(zip(self.names, values)), destino=where)

    def close(self) -> None:
        pass


def _part(key: Column, spread: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(spread)).cast("int")


def _told(parents: DataFrame, spread: int) -> DataFrame:
    """Each parent once for every part of its children."""
    parts = F.explode(F.array(*map(F.lit, range(spread)))).alias("_parte")
    return parents.select(F.col("id").alias("_chave"), parts).select("_chave", F.col("_parte").cast("int"))


def admitted(
    children: DataFrame,
    parents: DataFrame,
    column: str,
    key: str = "id",
    stored_parents: DataFrame | None = None,
    patience_ms: int | None = None,
    spread: int = SPREAD,
) -> DataFrame:
    """``children`` with ``destino``, each when its parent (``id`` of ``parents``) has come.

    Both are streams; ``stored_parents`` are known from the first batch of a new checkpoint on. A parent's children are
    dealt to ``spread`` parts by ``key``, so that one with very many is not one task; children without a parent are
    dealt to more and pass. ``spread`` is fixed by the first checkpoint. With ``patience_ms`` those that waited so long leave
    as expired; what arrives later waits anew.
    """
    schema = T.StructType([f for f in children.schema.fields])
    free = F.col(column).isNull()
    part = F.when(free, _part(F.col(key), spread * 64)).otherwise(_part(F.col(key), spread))
    rows = children.select(F.col(column).cast("string").alias("_chave"), part.alias("_parte"), F.lit(False).alias("_pai"), "*")
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    told = _told(parents, spread).select(F.col("_chave").cast("string").alias("_chave"), "_parte", F.lit(True).alias("_pai"), *nothing)
    grouped = rows.unionByName(told).groupBy("_chave", "_parte")
    initial = None
    if stored_parents is not None:
        initial = _told(stored_parents, spread).groupBy("_chave", "_parte")
    return grouped.transformWithState(
        WaitingRows(schema, patience_ms),
        T.StructType([*schema.fields, T.StructField("destino", T.StringType())]),
        "Append",
        "None" if patience_ms is None else "ProcessingTime",
        initialState=initial,
    )


def still_waiting(spark, checkpoint: str) -> DataFrame:
    """Rows in the state of a query, read from its checkpoint."""
    state = spark.read.format("statestore").option("stateVarName", HELD).load(checkpoint)
    return state.select("list_element.*")
