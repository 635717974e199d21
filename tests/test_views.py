"""Views from partials, the text index, checksums, bulk bodies, progress."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import functions as F

from conftest import plan_of, rows_of
from rivermark.functions import text
from rivermark.operators import checksums, postings
from rivermark.plans import incremental
from rivermark.sinks import bulk, folders, versions
from rivermark.streaming import jobs
from rivermark.streaming.progress import PROGRESS, fold_progress, late_rows, progress_rows

DAY = datetime(2024, 1, 1)


def test_partials_of_touched_days_replace_the_old_ones(spark, tmp_path):
    root, schema = str(tmp_path), "id string, lead_id string, is_active boolean, versao int, started_at timestamp"
    days = [datetime(2024, 1, n) for n in (1, 2, 3)]
    inner = versions.upsert_sink(f"{root}/s", ["id"], ["versao"], "started_at")
    sink = incremental.kept_partials(inner, f"{root}/s", f"{root}/p", "started_at", incremental.session_partials)
    batches = [
        [("a", "l1", True, 1, days[0]), ("b", "l1", True, 1, days[1]), ("c", None, True, 1, days[2])],
        [("a", "l1", False, 2, days[0]), ("d", "l2", True, 1, days[0])],
        [("d", "l1", True, 2, days[0])],  # moves to another lead
    ]
    for number, rows in enumerate(batches):
        before = {r.dia: r.pasta for r in versions.index(spark, f"{root}/p") if r.dia}
        for _ in range(2):
            sink(spark.createDataFrame(rows, schema), "q", number)
    after = {r.dia: r.pasta for r in versions.index(spark, f"{root}/p") if r.dia}
    assert {d for d in after if after[d] != before[d]} == {"2024-01-01"}
    parts = incremental.stored_partials(spark, f"{root}/p", incremental.SESSION_PARTS)
    totals = parts.groupBy("lead_id").agg(F.sum("sessoes").alias("n"), F.sum("ativas").alias("a"))
    assert rows_of(totals) == [("l1", 3, 2), (None, 1, 1)]
    assert len(parts.inputFiles()) == 3 and not any("/s/" in f for f in parts.inputFiles())


def test_a_batch_whose_partials_are_stored_is_not_read(spark, tmp_path):
    root, schema = str(tmp_path), "id string, lead_id string, started_at timestamp, is_active boolean"
    rows = spark.createDataFrame([("s1", "l1", datetime(2024, 1, 1), True), ("s2", "l1", datetime(2024, 1, 2), False)], schema)
    inner = versions.upsert_sink(f"{root}/s", ["id"], ["started_at"], "started_at")
    sink = incremental.kept_partials(inner, f"{root}/s", f"{root}/p", "started_at", incremental.session_partials)
    sink(rows, "q", 0)
    sink(rows.where(F.raise_error(F.col("id")).isNull()), "q", 0)
    assert rows_of(incremental.stored_partials(spark, f"{root}/p", incremental.SESSION_PARTS)) == [("l1", 1, 0), ("l1", 1, 1)]


def test_the_index_prunes_buckets_and_finds_what_a_scan_finds(spark, tmp_path):
    words = "der die das Für für-die of THE the, of".split()
    texts = [" ".join(words[(n * k) % len(words)] for k in range(1, 9)) for n in range(60)] + [None, "", "…"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    for batch, part in enumerate(("id < 30", "id >= 30")):
        postings.write_index(docs.where(part), str(tmp_path), "q", batch, "id", "text", buckets=16)
    index = postings.Index(spark, str(tmp_path), "id", "bigint", 16)
    for asked in ("of the", "für die", "the of the", "das", "nichts da"):
        scan = docs.where(text.phrase("text", asked)).select("id")
        assert rows_of(index.phrase(asked)) == rows_of(scan), asked
        assert rows_of(index.any_word(asked)) == rows_of(docs.where(text.any_token("text", asked)).select("id")), asked
    plan = plan_of(index.phrase("of the"))
    assert "PartitionFilters: [(" in plan and "balde" in plan.split("PartitionFilters")[1].split("]")[0]
    assert "PushedFilters: [In(termo" in plan.replace("[IsNotNull(termo), In", "[In") or "In(termo" in plan


def test_postings_are_blocks_made_without_a_shuffle(spark):
    docs = spark.createDataFrame([(1, "b a b"), (2, "a " * 5000), (3, None), (4, " "), (None, "B")], "id long, text string").coalesce(1)
    rows = postings.postings(docs, "id", "text", 16)
    assert "Exchange" not in plan_of(rows)
    got = rows.collect()
    assert all(len(r.chaves) == len(r.posicoes) <= postings.BLOCK for r in got)
    each = sorted((r.termo, str(k), p) for r in got for k, p in zip(r.chaves, r.posicoes))
    assert each == sorted([("a", "1", 1), ("b", "1", 0), ("b", "1", 2), ("b", "None", 0), *(("a", "2", n) for n in range(5000))])


def test_checksums_find_changed_missing_and_extra_rows(spark):
    rows = [(f"k{n}", n, None if n % 5 else "x") for n in range(200)]
    other = [r for r in rows if r[1] % 50] + [("new", 1, None)]
    other = [(k, n, None if k == "k5" else "y" if k == "k7" else v) for k, n, v in other] + [rows[3]]
    left, right = (spark.createDataFrame(r, "k string, n int, v string") for r in (rows, other))
    got = checksums.differences(left, right, ["k"], buckets=32)
    want = {f"k{n}": "ausente" for n in range(0, 200, 50)} | {"new": "excedente", "k5": "diferente", "k7": "diferente", "k3": "diferente"}
    assert dict(rows_of(got)) == want
    assert checksums.differences(left, left.repartition(3), ["k"]).isEmpty()
    swapped = spark.createDataFrame([("a", None, "1"), ("b", 2, None)], "k string, n int, v string")
    assert checksums.differences(swapped, swapped.limit(0), ["k"]).count() == 2
    sent = checksums.to_send(left, right, ["k"], 32)
    assert sorted(r.k for r in sent.collect()) == sorted(k for k, s in want.items() if s != "excedente")


def test_bodies_are_bounded_and_posted_in_order(spark, tmp_path):
    root, schema = str(tmp_path / "b"), "id string, valor double, quando timestamp"
    make = lambda *rows: spark.createDataFrame([(*r, DAY) for r in rows], schema)
    sink = bulk.bodies_sink(root, "eventos", per_body=2)
    for number, rows in ((0, [(f"e{n}", float(n)) for n in range(7)]), (1, [("e1", -1.0), ("z\n\"", None)])):
        for _ in range(2):
            sink(make(*rows), "q", number)
    posted = bulk.to_post(spark, root, "q")
    assert [b for b, _ in posted] == sorted(b for b, _ in posted) and bulk.to_post(spark, root, "q", 1) == []
    store = {}
    for _, path in posted:
        lines = [json.loads(line) for line in open(path.removeprefix("file:"), encoding="utf-8")]
        assert len(lines) <= 4 and len(lines) % 2 == 0
        for action, source in zip(lines[::2], lines[1::2]):
            assert action["update"]["_index"] == "eventos" and source["doc_as_upsert"]
            store[action["update"]["_id"]] = source["doc"]["valor"]
    assert len(store) == 8 and store["e1"] == -1.0 and store["z\n\""] is None
    read = {r.id: r.valor for r in bulk.documents_of(spark, root, make(("a", 1.0)).schema).collect()}
    assert read == store


def test_a_thousand_progress_rows_become_few_files(spark, tmp_path):
    folder = str(tmp_path / "p")
    rows = [("w", "i", "r", n, f"2024-01-0{1 + n // 500}T00:00:00Z", 1, 1.0, None, 0, n % 2) for n in range(1000)]
    frame = spark.createDataFrame(rows, PROGRESS)
    for part in range(4):
        frame.where(F.col("lote") % 4 == part).coalesce(1).write.parquet(f"{folder}/linhas/r-{part}")
    assert fold_progress(spark, folder) == 4 and fold_progress(spark, folder) == 0
    idle = [("w", "i", "r", 999, "2024-01-03T00:00:00Z", 0, 0.0, None, 0, 0), ("w", "i", "r", 1000, "2024-01-03T00:00:01Z", 5, 1.0, None, 0, 0)]
    spark.createDataFrame(idle, PROGRESS).coalesce(1).write.parquet(f"{folder}/linhas/r-9")
    for fold in (False, True):
        assert not fold or fold_progress(spark, folder) == 1
        got = progress_rows(spark, folder)
        assert got.count() == 1001 and got.agg(F.sum("linhas")).first()[0] == 1005
        assert rows_of(late_rows(got)) == [("w", 500)]
    assert folders.entries(spark, f"{folder}/linhas") == [] and len(progress_rows(spark, folder).inputFiles()) <= 3


def test_a_stop_between_batches_and_empty_batches(spark, tmp_path):
    source, schema = str(tmp_path / "in"), "id long"
    spark.range(30).repartition(3).write.parquet(source)
    marker, out = str(tmp_path / "stop"), str(tmp_path / "out")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source).where("id < 5")
    sink = jobs.file_sink(out)
    assert jobs.ended(jobs.start(stream, "s", sink, str(tmp_path / "cp"), {"availableNow": True}, stop_marker=marker))
    written = [e.name for q in folders.entries(spark, out) for e in folders.entries(spark, f"{out}/{q.name}")]
    assert spark.read.schema(schema).parquet(f"{out}/*/*").count() == 5 and 1 <= len(written) <= 3
    jobs.ask_to_stop(spark, marker)
    run = jobs.start(stream, "t", sink, str(tmp_path / "cp"), {"processingTime": "1 second"}, stop_marker=marker)
    assert jobs.ended(run) is False
    folders.remove(spark, marker)
    run = jobs.start(stream, "t", sink, str(tmp_path / "cp"), {"processingTime": "1 second"}, stop_marker=marker)
    run.processAllAvailable()
    jobs.ask_to_stop(spark, marker)
    jobs.run_until_one_stops(spark, marker, every=0.2)
    assert not run.isActive and spark.read.schema(schema).parquet(f"{out}/*/*").count() == 10
