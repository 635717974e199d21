"""Sessions that wait in the state of a stream, in a session that is not set up by ``spark_session``."""

from __future__ import annotations

from datetime import datetime

import oracle_check
from rivermark.registry import ORACLES, QUERIES
from rivermark.session import ROCKSDB, STATE_STORE, rocksdb_state

HDFS = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"


def test_sessions_wait_in_state_whatever_store_the_session_names(spark, tmp_path):
    customers = [(n, f"Customer#{n}", n % 2, -1000.0 + 700 * (n % 16), "BUILDING") for n in range(1, 41)]
    orders = [(n, 1 + n % 40, "OF"[n % 2], 10.0, datetime(1995, 1, 1 + n % 28), "1-URGENT") for n in range(1, 201)]
    tables = {
        "customer": (customers, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "orders": (
            orders,
            "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
        ),
        "nation": ([(0, "BRAZIL", 1), (1, "PERU", 1)], "n_nationkey int, n_name string, n_regionkey int"),
    }
    folder = str(tmp_path / "t")
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    con = oracle_check.duckdb.connect()
    for name in tables:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet/*.parquet')")
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, HDFS)
    try:
        rows = QUERIES["q06_waiting_state"]
        assert oracle_check.differences(spark, con, rows, ORACLES["q06_waiting_state"], folder) is None
        assert spark.conf.get(STATE_STORE) == HDFS
        with rocksdb_state(spark):
            assert spark.conf.get(STATE_STORE) == ROCKSDB
    finally:
        spark.conf.set(STATE_STORE, before)
