"""Reports on edge input, and the plans they run as."""

from __future__ import annotations

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from conftest import plan_of, rows_of
from rivermark.functions.times import latest_time
from rivermark.operators import groups, keyed, quality, windows
from rivermark.plans import audit, views
from rivermark.plans import events as event_reports
from rivermark.plans import leads as lead_reports
from rivermark.sources import shapes

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def data(spark):
    table = lambda name: shapes.table(spark, FOLDER, name)
    return {
        "events": shapes.event_columns(table("events")),
        "leads": shapes.leads(table("customer"), table("nation")),
        "sessions": shapes.sessions(table("orders")),
    }


def test_as_of_as_clock_datetime_or_frame(data):
    events = data["events"]
    newest = latest_time(events, "timestamp")
    by_frame = event_reports.last_day_summary(events, newest, scale=2)
    by_value = event_reports.last_day_summary(events, newest.first().as_of, scale=2)
    assert rows_of(by_frame) == rows_of(by_value) and by_frame.count() > 0
    assert event_reports.last_day_summary(events).count() == 0
    assert event_reports.count_on_day(events, datetime(2024, 1, 2, 15)).first().total == (
        events.where("CAST(timestamp AS DATE) = DATE '2024-01-02'").count()
    )
    assert event_reports.count_on_day(events).first().total == 0


def test_empty_input_gives_zero_rows_or_a_zero_row(data):
    leads, sessions = data["leads"].limit(0), data["sessions"].limit(0)
    summary = lead_reports.sync_summary(lead_reports.recent_leads(leads)).first()
    assert (summary.total_found, summary.highest_score, summary.average_score) == (0, None, None)
    board = lead_reports.dashboard(leads, sessions).first()
    assert tuple(board) == (0, 0, 0.0, 0, 0)
    assert audit.session_coverage(leads, sessions).first().percentual is None
    assert audit.findings(leads, sessions).first().sessao_status == "OK: todo lead tem sessao"
    assert event_reports.daily_histogram(data["events"].limit(0), fill=True).count() == 0


def test_unknown_status_ranks_last_and_null_counts_as_unknown(spark):
    leads = spark.createDataFrame([("a", "perdido"), ("b", "zzz"), ("c", "novo"), ("d", None)], "id string, status_lead string")
    assert [r.id for r in audit.by_status_rank(leads).collect()] == ["c", "a", "b", "d"]
    assert ("unknown", 1) in rows_of(lead_reports.status_breakdown(leads))


def test_empty_days_are_filled(spark):
    rows = spark.sql(
        "SELECT * FROM VALUES (TIMESTAMP '2024-01-01 05:00:00'), (TIMESTAMP '2024-01-04 01:00:00') AS t(timestamp)"
    )
    assert [r.total for r in event_reports.daily_histogram(rows, fill=True).orderBy("periodo").collect()] == [1, 0, 0, 1]


def test_null_values_lead_a_descending_order(spark):
    rows = spark.sql(
        "SELECT * FROM VALUES ('a', TIMESTAMP '2024-01-01', 'u', 1D), ('b', NULL, 'v', NULL),"
        " ('c', TIMESTAMP '2024-01-02', 'u', 2D) AS t(id, timestamp, usuario, valor)"
    )
    assert [r.id for r in event_reports.newest_events(rows.withColumn("categoria", F.lit("x")), 2).collect()] == ["b", "c"]
    assert [r.usuario for r in event_reports.top_users(rows).collect()] == ["v", "u"]


def test_day_ends_at_the_next_midnight(spark):
    rows = spark.sql(
        "SELECT * FROM VALUES (TIMESTAMP '2024-01-01 23:59:59'), (TIMESTAMP '2024-01-02 00:00:00'),"
        " (TIMESTAMP '2024-01-02 23:59:59'), (TIMESTAMP '2024-01-03 00:00:00'), (NULL) AS t(timestamp)"
    )
    frame = spark.sql("SELECT TIMESTAMP '2024-01-02 12:00:00' AS as_of")
    assert event_reports.count_on_day(rows, frame).first().total == 2
    assert event_reports.count_on_day(rows, datetime(2024, 1, 2, 12)).first().total == 2


def test_terms_leave_out_missing_values(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "x string")
    assert [tuple(r) for r in groups.terms(df, F.col("x")).collect()] == [("a", 2), ("b", 1)]


def test_null_sessions_stay_active_sessions(spark, data):
    sessions = data["sessions"].withColumn("lead_id", F.nullif("lead_id", F.lit("lead-1")))
    rows = lead_reports.active_sessions(sessions, data["leads"])
    assert rows.count() == sessions.where("is_active").count()
    assert rows.where("lead_id IS NULL AND lead_email IS NOT NULL").count() == 0


def test_time_limit_reaches_the_scan(data):
    events = data["events"]
    plan = plan_of(event_reports.last_day_summary(events, latest_time(events, "timestamp"), scale=2))
    assert re.search(r"PushedFilters: \[IsNotNull\(ts\), GreaterThanOrEqual\(ts,ScalarSubquery", plan)
    now = plan_of(event_reports.last_day_summary(events))
    assert re.search(r"PushedFilters: \[IsNotNull\(ts\), GreaterThanOrEqual\(ts,20", now)


def test_only_used_columns_are_read(data):
    plan = plan_of(event_reports.by_category(data["events"]))
    assert re.findall(r"ReadSchema: (.*)", plan) == ["struct<event_type:string>"]
    plan = plan_of(windows.sliding_stats_by_panes(data["events"], scale=2))
    assert re.findall(r"ReadSchema: (.*)", plan) == [
        "struct<ts:timestamp_ntz,event_type:string,value:double>"
    ]


def test_limits_do_not_sort_the_table(data):
    plan = plan_of(event_reports.newest_events(data["events"], 5))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


# Not those that run streams or fill stores while they are built.
RUNS = r"(s0[12]|t(02|03|04|06|07|08|10|11|13)|k(02|03|07|13|14))_|k08_upsert_sink|k10_(store|fold)|q05_email|q06_(orphans_r|waiting)|(a13|p15)_.*(incremental|indexed)"
BATCH_KEYS = [k for k in sorted(entry_module.queries()) if not re.match(RUNS, k)]


@pytest.mark.parametrize("key", BATCH_KEYS)
def test_no_query_crosses_tables_or_leaves_the_jvm(spark, key):
    plan = plan_of(entry_module.queries()[key](spark, FOLDER))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "MapInPandas"):
        assert operator not in plan


def skewed(spark, rows=400_000):
    """Sessions of which a third belong to one lead and a third to none."""
    sessions = spark.range(rows).selectExpr(
        "concat('s', id) AS id",
        "CASE id % 3 WHEN 0 THEN 'l0' WHEN 1 THEN CAST(NULL AS STRING) ELSE concat('l', id % 1000) END AS lead_id",
        "true AS is_active",
        "TIMESTAMP_NTZ '2024-01-01' AS started_at",
        "repeat(CAST(id AS STRING), 10) AS user_agent",
    )
    leads = spark.range(1000).selectExpr(
        "concat('l', id) AS id", "concat('nome', id) AS nome", "concat('mail', id) AS email"
    )
    return sessions, leads


def test_hot_lead_is_split_by_the_join(spark, tmp_path):
    sessions, leads = skewed(spark)
    sessions.write.parquet(str(tmp_path / "s"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        stored = spark.read.parquet(str(tmp_path / "s"))
        joined = lead_reports.active_sessions(stored, leads, ordered=False)
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
        assert joined.count() == 400_000
        assert joined.where("lead_id = 'l0' AND lead_nome = 'nome0'").count() >= 133_000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("operator", [quality.without_parent, quality.surviving])
def test_children_of_a_hot_parent_are_split(spark, tmp_path, operator):
    sessions, leads = skewed(spark)
    sessions.write.parquet(str(tmp_path / "s"))
    leads.where("id != 'l0'").write.parquet(str(tmp_path / "l"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = operator(spark.read.parquet(str(tmp_path / "s")), spark.read.parquet(str(tmp_path / "l")), "lead_id")
        rows.collect()
        assert "skew=true" in rows._jdf.queryExecution().executedPlan().toString()
        named = rows.where("lead_id = 'l0'").count()
        assert named >= 133_000 and rows.count() == named + (133_333 if operator is quality.surviving else 0)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_upsert_reads_each_side_once(spark, tmp_path):
    schema = "id string, versao int, n int"
    for name in ("base", "changes"):
        spark.createDataFrame([("a", 1, 1)], schema).write.parquet(str(tmp_path / name))
    base, changes = (spark.read.parquet(str(tmp_path / name)) for name in ("base", "changes"))
    plan = plan_of(keyed.upsert(base, changes, ["id"], ["versao"]))
    assert plan.count("Scan parquet") == 2 * 2  # once in the tree, once in its details


def test_hot_lead_meets_the_summary_join_as_one_row(spark):
    sessions, leads = skewed(spark, 90_000)
    per_lead = lead_reports.sessions_per_lead(sessions)
    assert per_lead.where("lead_id = 'l0'").first().total_sessoes == 30_030
    # Partial counts by (lead, session) come first, so the hot lead's rows
    # spread over all tasks before one count per lead is built.
    plan = per_lead._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(lead_id" in plan and "partial_count(distinct" in plan


def test_views_answer_sql_by_the_clock(spark, data):
    shift = F.expr("localtimestamp() - TIMESTAMP_NTZ '2024-01-30 23:59:59'")
    moved = data["events"].withColumn("timestamp", F.col("timestamp") + shift)
    tables = {"eventos_raw": moved, "leads": data["leads"], "chat_sessions": data["sessions"]}
    names = views.create_views(tables)
    assert set(names) == {
        "eventos_raw", "leads", "chat_sessions", "vw_eventos_ultimas_24h", "vw_eventos_por_hora",
        "v_leads_qualificados", "v_leads_resumo", "v_sessoes_ativas",
    }
    total = spark.sql("SELECT sum(total_eventos) FROM vw_eventos_ultimas_24h").first()[0]
    day = data["events"].where("timestamp >= TIMESTAMP_NTZ '2024-01-29 23:59:59'").count()
    assert total == pytest.approx(day, abs=1) and day > 0
    sql = "SELECT categoria, COUNT(*) AS total FROM eventos_raw GROUP BY categoria ORDER BY total DESC"
    assert [tuple(r) for r in spark.sql(sql).collect()] == [
        tuple(r) for r in event_reports.by_category(data["events"]).collect()
    ]
    assert spark.table("v_leads_resumo").count() == data["leads"].count()
    assert spark.table("v_sessoes_ativas").columns[-2:] == ["lead_nome", "lead_email"]
    assert spark.table("v_leads_qualificados").where("score_qualificacao < 50").isEmpty()
    for name in names:
        spark.catalog.dropTempView(name)
