"""What the queries did: input, speed, state and late rows, kept beyond the run."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from rivermark.sinks import folders, versions

PROGRESS = """
    consulta string, id string, execucao string, lote bigint, momento string, linhas bigint,
    linhas_por_segundo double, marca_dagua string, linhas_em_estado bigint, linhas_atrasadas bigint
"""


class ProgressLog(StreamingQueryListener):
    """Stores the progress of every batch below ``folder``.

    A query itself remembers its last 100 batches only. Each progress is a
    folder named by query, run and batch, so storing it again replaces it. A
    query that waits for data repeats its last batch number; the later progress
    without rows does not replace the one with them.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.ended: dict[str, threading.Event] = {}
        self.failed: list[Exception] = []

    def _end_of(self, run: object) -> threading.Event:
        return self.ended.setdefault(str(run), threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end_of(event.runId)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        late = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        row = (
            p.name, str(p.id), str(p.runId), p.batchId, p.timestamp, p.numInputRows,
            float(p.processedRowsPerSecond), p.eventTime.get("watermark"),
            sum(s.numRowsTotal for s in p.stateOperators), late,
        )
        idle = "" if p.numInputRows or late else "-vazio"
        folder = f"{self.folder}/linhas/{p.runId}-{p.batchId}{idle}"
        try:
            self.spark.createDataFrame([row], PROGRESS).coalesce(1).write.mode("overwrite").parquet(folder)
        except Exception as error:  # a listener must not raise; the reader does
            self.failed.append(error)

    def raise_failed(self) -> None:
        """Raises what went wrong in storing a progress; a job calls it between batches."""
        if self.failed:
            raise self.failed[0]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end_of(event.runId).set()

    def wait(self, query: StreamingQuery, seconds: float = 120) -> None:
        """Returns when an ended query's last progress is stored."""
        if not self._end_of(query.runId).wait(seconds):
            raise TimeoutError(f"no end of {query.name} within {seconds} s")
        self.raise_failed()


@contextmanager
def progress_log(spark: SparkSession, folder: str) -> Iterator[ProgressLog]:
    """Keeps the progress of all queries that run meanwhile."""
    log = ProgressLog(spark, folder)
    spark.streams.addListener(log)
    try:
        yield log
    finally:
        spark.streams.removeListener(log)


def _newest(rows: DataFrame) -> DataFrame:
    """One row per query, run and batch: the one with rows, the later of two."""
    busy = F.struct(F.col("linhas") + F.col("linhas_atrasadas"), "momento")
    kept = rows.groupBy("id", "execucao", "lote").agg(F.max_by(F.struct("*"), busy).alias("row"))
    return kept.select("row.*")


def _parts(spark: SparkSession, folder: str) -> list[str]:
    return [e.name for e in folders.entries(spark, f"{folder}/linhas") if folders.complete(spark, f"{folder}/linhas/{e.name}")]


def progress_rows(spark: SparkSession, folder: str) -> DataFrame:
    """One row per batch of every logged query and run, folded or not."""
    rows = versions.table_rows(spark, f"{folder}/dias", PROGRESS)
    parts = _parts(spark, folder)
    if parts:
        rows = rows.unionByName(spark.read.schema(PROGRESS).parquet(*(f"{folder}/linhas/{name}" for name in parts)))
    return _newest(rows)


def fold_progress(spark: SparkSession, folder: str) -> int:
    """Moves stored progress into a table by day, one file a day, and deletes the folders it came from; how many these were.

    Queries may run meanwhile: only folders that are complete when this begins are taken. A fold that stops half-way
    leaves folders whose rows the table has already; they replace themselves in the next one.
    """
    parts = _parts(spark, folder)
    if not parts:
        return 0
    rows = spark.read.schema(PROGRESS).parquet(*(f"{folder}/linhas/{name}" for name in parts))
    table, order = f"{folder}/dias", ["_cheia", "momento"]
    number = versions.marks_of(versions.index(spark, table)).get("progresso", -1) + 1
    busy = (F.col("linhas") + F.col("linhas_atrasadas")).alias("_cheia")
    shaped = _newest(rows).select("*", busy)
    day = F.substring("momento", 1, 10)
    # a batch that began before midnight and was idle after it has two days; readers take the newest of both
    versions.upsert_batch(shaped, table, ["id", "execucao", "lote"], order, day, "progresso", number)
    for name in parts:
        folders.remove(spark, f"{folder}/linhas/{name}")
    versions.vacuum(spark, table)
    return len(parts)


def late_rows(progress: DataFrame) -> DataFrame:
    """Per query: rows dropped behind its watermark, over all runs."""
    return progress.groupBy("consulta").agg(F.sum("linhas_atrasadas").alias("linhas_atrasadas"))
