"""Batches that fail between their writes and run again; several queries in one table; indexes by bucket."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from conftest import rows_of
from rivermark.sinks import files, folders, versions
from rivermark.streaming import constraints, decisions, router
from rivermark.streaming.jobs import file_sink
from rivermark.streaming.lookup import Lookup

LEAD = "id string, email string, versao int, criado timestamp"
DAY = datetime(2024, 1, 1)


class Fault(RuntimeError):
    pass


class Leads:
    """The leads' sinks; after the ``fail_at``-th write of a run it fails."""

    def __init__(self, spark, root):
        self.spark, self.root, self.writes, self.fail_at = spark, root, 0, None

    def step(self, write):
        def run(*args):
            self.writes += 1
            write(*args)
            if self.fail_at == self.writes:
                raise Fault

        return run

    def sink(self):
        part = versions.part_of("criado")
        emails, ids = Lookup(self.spark, f"{self.root}/email", 8), Lookup(self.spark, f"{self.root}/id", 8)
        emails.apply, ids.apply = self.step(emails.apply), self.step(ids.apply)
        inner = versions.upsert_sink(f"{self.root}/leads", ["id"], ["versao"], "criado")
        stored = lambda rows: versions.part_rows(
            self.spark, f"{self.root}/leads", rows.schema, versions.touched(rows, part)
        )
        return constraints.unique_sink(
            self.step(inner), self.step(file_sink(f"{self.root}/recusados")), f"{self.root}/decisoes",
            emails, stored, "email", ["versao"], keys=ids,
        )

    def run(self, rows, number, fail_at=None, query="q"):
        self.writes, self.fail_at = 0, fail_at
        frame = self.spark.createDataFrame([(*r, DAY) for r in rows], LEAD)
        try:
            self.sink()(frame, query, number)
        except Fault:
            assert fail_at

    def stored(self):
        return rows_of(versions.table_rows(self.spark, f"{self.root}/leads", "id string, email string"))

    def refused(self):
        return rows_of(files.table_rows(self.spark, f"{self.root}/recusados", "id string, email string"))


@pytest.mark.parametrize("fail_at", [1, 2, 3, 4])
def test_a_lead_is_in_one_place_whichever_write_fails(spark, tmp_path, fail_at):
    leads = Leads(spark, str(tmp_path))
    leads.run([("A", "x", 1)], 0)
    batch = [("A", "y", 2), ("B", "x", 1), ("C", None, 1), ("D", None, 1), ("E", "e", 1), ("F", "e", 1)]
    for fault in (fail_at, None, None):
        leads.run(batch, 1, fault)
    assert leads.stored() == [("A", "y"), ("C", None), ("D", None), ("E", "e")]
    assert leads.refused() == [("B", "x"), ("F", "e")]
    leads.run([("B", "x", 1), ("G", "y", 1)], 2)  # x is free by now, y is not
    assert leads.stored() == [("A", "y"), ("B", "x"), ("C", None), ("D", None), ("E", "e")]
    assert leads.refused() == [("B", "x"), ("F", "e"), ("G", "y")]
    ids = Lookup(spark, f"{tmp_path}/id", 8).owners(spark.createDataFrame([("B",), ("G",)], "valor string"))
    assert rows_of(ids.select("valor")) == [("B",)]


def test_older_versions_claim_nothing(spark, tmp_path):
    leads = Leads(spark, str(tmp_path))
    leads.run([("A", "n", 5)], 0)
    leads.run([("A", "z", 1), ("B", "z", 1), ("C", "w", 1), ("C", "v", 2), ("D", "w", 1)], 1)
    assert leads.stored() == [("A", "n"), ("B", "z"), ("C", "v"), ("D", "w")] and leads.refused() == []


def test_a_lookup_reads_and_writes_its_buckets_only(spark, tmp_path):
    index = Lookup(spark, str(tmp_path / "i"), buckets=64)
    rows = spark.range(5000).selectExpr("concat('v', id) AS valor", "concat('k', id) AS dono", "0 AS ordem")
    index.apply(rows, "q", 0)
    before = {r.dia: r.pasta for r in versions.index(spark, index.root) if r.dia}
    found = index.owners(rows.where("valor IN ('v7', 'v8')").select("valor"))
    assert rows_of(found) == [("v7", "k7"), ("v8", "k8")]
    assert len(before) == 64 and len(found.inputFiles()) <= 2
    index.apply(rows.where("valor = 'v7'").selectExpr("valor", "CAST(null AS string) AS dono", "1 AS ordem"), "q", 1)
    after = {r.dia: r.pasta for r in versions.index(spark, index.root) if r.dia}
    assert sum(before[b] != after[b] for b in before) == 1
    assert rows_of(index.owners(rows.where("valor IN ('v7', 'v8')").select("valor"))) == [("v8", "k8")]


def test_a_session_that_waited_is_not_lost_when_its_lead_comes_between_the_tries(spark, tmp_path):
    root, schema = str(tmp_path), "id string, lead string, versao int, criado timestamp"
    known = ["l1"]
    parents = lambda values: spark.createDataFrame([(k,) for k in known], "valor string")
    inner = versions.upsert_sink(f"{root}/sessions", ["id"], ["versao"], "criado")
    sink = constraints.parent_sink(inner, f"{root}/decisoes", parents, "lead")
    rows = spark.createDataFrame([("s1", "l1", 1, DAY), ("s9", "l9", 1, DAY), ("s0", None, 1, DAY), ("s8", "l8", 1, DAY)], schema)
    failing = lambda *batch: 1 / 0
    frames = {"leads": rows.limit(0), "sessions": rows}
    with pytest.raises(router.SinkError):
        router.write_all(frames, {"leads": failing, "sessions": sink}, "q", 0)
    known.append("l9")  # the other sink's rows are stored before the batch runs again
    router.write_all(frames, {"leads": lambda *b: None, "sessions": sink}, "q", 0)
    stored = lambda: [r.id for r in versions.table_rows(spark, f"{root}/sessions", schema).orderBy("id").collect()]
    wait = lambda q, n: [r.id for r in constraints.waiting(spark, f"{root}/decisoes", q, n, rows.schema).collect()]
    assert stored() == ["s0", "s1"] and sorted(wait("q", 0)) == ["s8", "s9"]
    sink(rows.limit(0), "q", 1)
    assert stored() == ["s0", "s1", "s9"] and wait("q", 1) == ["s8"]
    known.append("l8")
    sink(rows.limit(0), "r", 0)  # a new checkpoint takes over what waits
    assert stored() == ["s0", "s1", "s8", "s9"] and wait("r", 0) == []


def test_an_incomplete_record_is_made_again(spark, tmp_path):
    root, rows = str(tmp_path), spark.range(3).selectExpr("id", "'a' AS destino")
    folder = decisions.folder_of(root, "q", 0)
    rows.write.partitionBy("destino").parquet(folder)
    folders.remove(spark, f"{folder}/_SUCCESS")
    judge = lambda: rows.where("id < 2")
    for _ in range(2):
        assert decisions.decided(spark, root, "q", 0, rows.schema, judge).count() == 2
        judge = lambda: 1 / 0
    for number in range(1, 4):
        decisions.decided(spark, root, "q", number, rows.schema, lambda: rows)
    decisions.forget(spark, root, "q", 3, -1)
    assert [e.name for e in folders.entries(spark, f"{root}/consulta=q")] == ["lote=2", "lote=3"]


def test_a_fold_marks_every_query(spark, tmp_path):
    root, table, schema = str(tmp_path / "b"), str(tmp_path / "t"), "id string, timestamp timestamp"
    make = lambda *rows: spark.createDataFrame(rows, schema)
    late = DAY + timedelta(days=5)
    ids = lambda: [r.id for r in files.folded_rows(spark, root, table, schema).orderBy("id").collect()]
    fold = lambda: files.fold(spark, root, table, schema, ["id"], [])
    files.write_batch(make(("e1", DAY), ("e2", late)), root, "q1", 0)
    fold()
    files.write_batch(make(("e3", late)), root, "q2", 0)
    fold()
    assert ids() == ["e1", "e2", "e3"] and versions.marks_of(versions.index(spark, table)) == {"q1": 0, "q2": 0}
    assert versions.drop_days_before(spark, table, "2024-01-03") == ["2024-01-01"]
    files.write_batch(make(("e4", late)), root, "q1", 1)
    assert ids() == ["e2", "e3", "e4"]
    fold()
    assert ids() == ["e2", "e3", "e4"]
    assert versions.vacuum(spark, table, 3600) == [] and len(versions.vacuum(spark, table, -1)) == 3
    assert len(files.drop_folded(spark, root, table, -1)) == 3
    assert [r.id for r in versions.table_rows(spark, table, schema).orderBy("id").collect()] == ["e2", "e3", "e4"]
