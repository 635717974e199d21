"""Session defaults and the shared folder for checkpoints and tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import SparkSession

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def spark_session(app: str = "rivermark", master: str | None = None, **conf: str) -> SparkSession:
    """Session in UTC with adaptive execution and RocksDB streaming state.

    Times on the wire have no zone, so the session zone decides how they are
    read; UTC keeps batch, stream and stored values on one clock.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        STATE_STORE: ROCKSDB,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, whatever the session is set to; a query keeps the settings
    of its start."""
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, before)


@cache
def trial_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"rivermark-{application}-")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for ``purpose`` below the cluster's ``spark.checkpoint.dir``.

    Executors and a restarted driver must both see it. A session of one process
    that names none, as in a trial, gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.partition("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = trial_folder(spark.sparkContext.applicationId)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
