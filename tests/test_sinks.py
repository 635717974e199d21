from __future__ import annotations

import json
from datetime import datetime
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows_of
from rivermark.operators import keyed
from rivermark.session import shared_folder
from rivermark.sinks import connectors, database, files, tables, versions
from rivermark.sources import streams
from rivermark.sources.tables import read_files, stored_keys
from rivermark.streaming.sync import pending, store_mark, stored_mark

SCHEMA = "id string, versao int"


def frame(spark, *rows, schema=SCHEMA):
    return spark.createDataFrame(list(rows), schema)


def test_replayed_batch_replaces_itself(spark, tmp_path):
    root = str(tmp_path / "t")
    first, second = frame(spark, ("a", 1), ("b", 1)), frame(spark, ("b", 2))
    files.write_batch(first, root, "q", 0)
    for _ in range(3):
        files.write_batch(second, root, "q", 1)
    assert rows_of(files.table_rows(spark, root, SCHEMA)) == [("a", 1), ("b", 1), ("b", 2)]
    current = keyed.latest(files.table_rows(spark, root, SCHEMA), ["id"], ["versao"])
    assert rows_of(current) == [("a", 1), ("b", 2)]


def test_batches_of_another_query_do_not_collide(spark, tmp_path):
    root = str(tmp_path / "t")
    files.write_batch(frame(spark, ("a", 1)), root, "q1", 0)
    files.write_batch(frame(spark, ("b", 1)), root, "q2", 0)
    assert rows_of(files.table_rows(spark, root, SCHEMA)) == [("a", 1), ("b", 1)]


def test_empty_batch_is_stored_and_read(spark, tmp_path):
    root = str(tmp_path / "t")
    files.write_batch(frame(spark, ("a", 1)).limit(0), root, "q", 0)
    assert files.table_rows(spark, root, SCHEMA).count() == 0


def by_day(spark):
    return spark.range(1000).selectExpr(
        "concat('e', id) AS id",
        "TIMESTAMP_NTZ '2024-01-01' + make_dt_interval(CAST(id % 5 AS INT)) AS timestamp",
    )


def test_compaction_keeps_rows_and_reduces_files(spark, tmp_path):
    before, after = str(tmp_path / "before"), str(tmp_path / "after")
    files.with_day(by_day(spark)).repartition(8).write.partitionBy("dia").parquet(before)
    files.compact(spark, before, after)
    assert rows_of(spark.read.parquet(after)) == rows_of(spark.read.parquet(before))
    count = lambda p: len(list(Path(p).rglob("*.parquet")))
    assert count(after) <= 5 < count(before)


def test_day_filter_prunes_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    files.write_by_day(by_day(spark), path)
    day = read_files(spark, path).where("dia = DATE '2024-01-03'")
    assert day.count() == 200
    assert "PartitionFilters: [isnotnull(dia" in day._jdf.queryExecution().executedPlan().toString()


def test_retention_keeps_null_times(spark):
    rows = spark.sql(
        "SELECT * FROM VALUES ('old', TIMESTAMP_NTZ '2024-01-01'), ('edge', TIMESTAMP_NTZ '2024-01-02'),"
        " ('new', TIMESTAMP_NTZ '2024-04-01'), ('none', NULL) AS t(id, timestamp)"
    )
    as_of = spark.sql("SELECT TIMESTAMP_NTZ '2024-04-01' AS as_of")
    kept = files.retained(rows, days=90, as_of=as_of).select("id")
    assert rows_of(kept) == [("edge",), ("new",), ("none",)]


def test_old_day_partitions_are_dropped(spark, tmp_path):
    tables.create(
        spark, "diario", "id string, timestamp timestamp_ntz, dia date", str(tmp_path / "d"), "dia"
    )
    files.with_day(by_day(spark)).write.mode("append").insertInto("diario")
    assert files.drop_old_days(spark, "diario", "2024-01-03") == ["2024-01-01", "2024-01-02"]
    assert spark.table("diario").select("dia").distinct().count() == 3
    assert files.drop_old_days(spark, "diario", "2024-01-03") == []
    spark.sql("DROP TABLE diario")


def test_rebuild_writes_the_newest_row_per_key(spark, tmp_path):
    target = str(tmp_path / "t")
    files.rebuild(frame(spark, ("a", 1), ("a", 3), ("b", 2)), ["id"], ["versao"], target)
    assert rows_of(spark.read.parquet(target)) == [("a", 3), ("b", 2)]


def test_insert_if_absent_counts_what_it_writes(spark, tmp_path):
    root = str(tmp_path / "t")
    files.write_batch(frame(spark, ("a", 1)), root, "q", 0)

    def insert(batch, number):
        stored = files.table_rows(spark, root, SCHEMA)
        write = lambda rows: files.write_batch(rows, root, "q", number)
        return database.insert_if_absent(batch, stored, write, ["id"], ["versao"])

    batch = frame(spark, ("a", 2), ("b", 1), ("b", 2), ("c", 1))
    assert insert(batch, 1) == 2
    assert insert(batch, 2) == 0
    assert rows_of(files.table_rows(spark, root, SCHEMA)) == [("a", 1), ("b", 2), ("c", 1)]
    assert rows_of(stored_keys(files.table_rows(spark, root, SCHEMA), ["id"])) == [("a",), ("b",), ("c",)]


def test_upsert_statement_runs_and_updates(spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE t (id VARCHAR, dia INT, n INT, PRIMARY KEY (id, dia))")
    statement = database.upsert_statement("t", ["id", "dia", "n"], ["id", "dia"], "?")
    con.executemany(statement, [("a", 1, 1), ("b", 1, 1)])
    con.executemany(statement, [("a", 1, 5), ("a", 2, 7)])
    assert sorted(con.execute("FROM t").fetchall()) == [("a", 1, 5), ("a", 2, 7), ("b", 1, 1)]
    guarded = database.upsert_statement("t", ["id", "dia", "n"], ["id", "dia"], "?", "n")
    con.executemany(guarded, [("a", 1, 4), ("a", 2, 8)])
    assert sorted(con.execute("FROM t").fetchall()) == [("a", 1, 5), ("a", 2, 8), ("b", 1, 1)]
    only_keys = database.upsert_statement("t", ["id"], ["id"])
    assert only_keys == "INSERT INTO t (id) VALUES (%s) ON CONFLICT (id) DO NOTHING"


def test_upsert_sends_each_key_once_in_bounded_calls(spark, tmp_path):
    log = str(tmp_path)

    def connect():
        import json as js
        import uuid

        class Recorder:
            def __init__(self):
                self.calls = []

            def cursor(self):
                return self

            def executemany(self, statement, rows):
                self.calls.append([list(r) for r in rows])

            def commit(self):
                with open(f"{log}/{uuid.uuid4()}.json", "w") as out:
                    js.dump(self.calls, out)

            def close(self):
                pass

        return Recorder()

    df = spark.range(3000).selectExpr("concat('k', id % 700) AS id", "CAST(id AS INT) AS versao")
    database.upsert(df, connect, "t", ["id"], ["versao"], connections=4, rows_per_call=100)
    calls = [json.loads(p.read_text()) for p in Path(log).glob("*.json")]
    sent = [tuple(r) for transaction in calls for call in transaction for r in call]
    assert len(calls) == 4 and max(len(c) for t in calls for c in t) <= 100
    assert sorted(sent) == sorted((f"k{i}", max(v for v in range(i, 3000, 700))) for i in range(700))


def test_connector_options():
    assert connectors.broker_options("b:9092", "eventos")["kafka.acks"] == "all"
    options = connectors.document_options("es", 9200, "eventos")
    assert options["es.mapping.id"] == "id" and options["es.write.operation"] == "upsert"
    assert "es.mapping.id" not in connectors.document_options("es", 9200, "eventos", None)
    assert streams.broker_options("b:9092", "eventos")["startingOffsets"] == "latest"
    assert streams.broker_options("b:9092", "eventos", "earliest")["failOnDataLoss"] == "false"
    assert streams.broker_options("b:9092", "eventos", fail_on_data_loss=True)["failOnDataLoss"] == "true"
    assert streams.broker_options("b:9092", "eventos", per_batch=5)["maxOffsetsPerTrigger"] == "5"


def test_publish_and_documents_through_any_format(spark, tmp_path):
    sent = frame(spark, ("a", 1)).select(F.to_json(F.struct("*")).cast("binary").alias("value"))
    connectors.publish(sent, "parquet", {"path": str(tmp_path / "m")})
    connectors.write_documents(frame(spark, ("a", 1)), {"path": str(tmp_path / "d")}, "json")
    assert spark.read.parquet(str(tmp_path / "m")).count() == 1
    assert spark.read.schema(SCHEMA).json(str(tmp_path / "d")).first().id == "a"


def test_tables_are_created_once_commented_and_filled(spark, tmp_path):
    place = str(tmp_path / "exemplo")
    for _ in range(2):
        tables.create(spark, "exemplo", "id int, nome string", place)
    tables.insert_rows(spark, "exemplo", [(1, "Ana"), (2, "Caio")], "id int, nome string")
    tables.comment(spark, "exemplo", "uma tabela d'água")
    assert spark.table("exemplo").count() == 2
    described = dict((r.col_name, r.data_type) for r in spark.sql("DESCRIBE EXTENDED exemplo").collect())
    assert described["Comment"] == "uma tabela d'água"
    spark.sql("CREATE OR REPLACE VIEW exemplo_v AS SELECT * FROM exemplo")
    tables.comment_view(spark, "exemplo_v", "uma vista")
    view = dict((r.col_name, r.data_type) for r in spark.sql("DESCRIBE EXTENDED exemplo_v").collect())
    assert view["Comment"] == "uma vista"
    spark.sql("DROP VIEW exemplo_v")
    tables.recreate(spark, "exemplo", tables.EVENTS_TABLE, str(tmp_path / "novo"))
    assert spark.table("exemplo").columns[-1] == "processado_em"
    spark.sql("DROP TABLE exemplo")


def test_pending_takes_all_for_an_empty_sink_and_nothing_twice(spark):
    rows = spark.sql(
        "SELECT * FROM VALUES ('a', TIMESTAMP '2024-01-01 10:00:00'), ('b', TIMESTAMP '2024-01-01 11:00:00'),"
        " ('late', TIMESTAMP '2024-01-01 10:30:00'), ('new', TIMESTAMP '2024-01-01 12:00:00')"
        " AS t(id, created_at)"
    )
    ids = lambda df: [r.id for r in df.orderBy("id").collect()]
    assert ids(pending(rows, rows.limit(0), "created_at", ["id"])) == ["a", "b", "late", "new"]
    sent = rows.where("id in ('a', 'b')")
    assert ids(pending(rows, sent, "created_at", ["id"])) == ["late", "new"]
    assert ids(pending(rows, rows, "created_at", ["id"])) == []


def test_a_stored_mark_spares_the_history(spark, tmp_path):
    folder, history = str(tmp_path / "mark"), str(tmp_path / "sent")
    rows = spark.sql("SELECT * FROM VALUES ('a', TIMESTAMP '2024-01-01'), ('b', TIMESTAMP '2024-03-01') AS t(id, created_at)")
    rows.where("id = 'a'").write.parquet(history)
    store_mark(rows.where("id = 'a'"), "created_at", folder)
    mark = stored_mark(spark, folder)
    left = pending(rows, spark.read.parquet(history), "created_at", ["id"], mark=mark)
    assert [r.id for r in left.collect()] == ["b"]
    assert "max(created_at" not in plan_of(left)
    store_mark(rows.where("id = 'b'"), "created_at", folder, mark)
    assert str(stored_mark(spark, folder).first()[0]) == "2024-03-01 00:00:00"


def test_versions_keep_the_newest_row_and_other_days_folders(spark, tmp_path):
    root, schema = str(tmp_path / "v"), "id string, versao int, dia_em timestamp"
    make = lambda *rows: spark.createDataFrame(rows, schema)
    one, two = datetime(2024, 1, 1), datetime(2024, 1, 2)
    sink = versions.upsert_sink(root, ["id"], ["versao"], "dia_em")
    assert versions.table_rows(spark, root, schema).isEmpty()
    sink(make(("a", 1, one), ("b", 1, two), ("n", 1, None)), "q", 0)
    before = {r.dia: r.pasta for r in versions.index(spark, root)}
    sink(make(("a", 3, one), ("a", 2, one), ("c", 1, one)), "q", 1)
    for batch in (1, 1):
        sink(make(("a", 9, one)), "q", batch)  # a batch that was applied is passed over
    sink(make(("a", 2, one)), "q", 2)
    sink(make(), "q", 3)
    stored = versions.table_rows(spark, root, schema).select("id", "versao")
    assert rows_of(stored) == [("a", 3), ("b", 1), ("c", 1), ("n", 1)]
    after = {r.dia: r.pasta for r in versions.index(spark, root)}
    assert after["2024-01-02"] == before["2024-01-02"] and after["2024-01-01"] != before["2024-01-01"]
    assert versions.drop_days_before(spark, root, "2024-01-02") == ["2024-01-01"]
    assert rows_of(versions.table_rows(spark, root, schema).select("id")) == [("b",), ("n",)]


def test_a_half_written_batch_is_not_seen(spark, tmp_path, monkeypatch):
    root, schema = str(tmp_path / "v"), "id string, versao int, dia_em timestamp"
    make = lambda *rows: spark.createDataFrame(rows, schema)
    day = datetime(2024, 1, 1)
    versions.upsert_batch(make(("a", 1, day)), root, ["id"], ["versao"], "dia_em", "q", 0)
    with monkeypatch.context() as patch:
        patch.setattr(versions, "_write_index", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            versions.upsert_batch(make(("a", 2, day)), root, ["id"], ["versao"], "dia_em", "q", 1)
    assert rows_of(versions.table_rows(spark, root, schema).select("versao")) == [(1,)]
    versions.upsert_batch(make(("a", 2, day)), root, ["id"], ["versao"], "dia_em", "q", 1)
    assert rows_of(versions.table_rows(spark, root, schema).select("versao")) == [(2,)]


def test_shared_folder_is_the_cluster_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    one, two = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert one.startswith(root) and one != two


def test_shared_folder_needs_a_setting_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Cluster:
        conf = Conf()

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Cluster(), "x")
