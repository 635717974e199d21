from __future__ import annotations

from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from rivermark.operators import windows

START = datetime(2024, 3, 1)
SCHEMA = "timestamp timestamp_ntz, categoria string, evento string, valor double"


def brute_force(rows, width, slide):
    """Every window of every event, one by one."""
    found = defaultdict(list)
    for time, category, event, value in rows:
        if time is None:
            continue
        second = int((time - datetime(1970, 1, 1)) / timedelta(seconds=1))
        start = second - second % slide
        while start > second - width:
            found[datetime(1970, 1, 1) + timedelta(seconds=start), category, event].append(value)
            start -= slide
    return {
        key: (len(values), round(sum(v for v in values if v is not None), 2), sum(v is not None for v in values))
        for key, values in found.items()
    }


def result(df):
    out = {}
    for r in df.collect():
        total = 0.0 if r.valor_total is None else r.valor_total
        n = 0 if r.valor_medio is None else None
        out[r.janela_inicio, r.categoria, r.evento] = (r.total_eventos, round(total, 2), n, r)
    return out


events = st.lists(
    st.tuples(
        st.one_of(
            st.none(),
            st.integers(0, 3600 * 10**6 - 1).map(lambda us: START + timedelta(microseconds=us)),
        ),
        st.sampled_from(["a", "b", None]),
        st.sampled_from(["x", "y"]),
        st.one_of(st.none(), st.integers(0, 99999).map(lambda c: c / 100)),
    ),
    min_size=1,
    max_size=40,
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=events)
@pytest.mark.parametrize("width, slide", [(300, 60), (300, 120)])
def test_both_forms_equal_brute_force(spark, rows, width, slide):
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute_force(rows, width, slide)
    for form in (windows.sliding_stats, windows.sliding_stats_by_panes):
        got = result(form(df, f"{width} seconds", f"{slide} seconds", scale=2))
        assert set(got) == set(want)
        for key, (n, total, valued) in want.items():
            count, sum_, empty, row = got[key]
            assert (count, sum_) == (n, total)
            if valued:
                assert row.valor_medio == pytest.approx(total / valued)
            else:
                assert row.valor_total is None and empty == 0
            assert row.janela_fim - row.janela_inicio == timedelta(seconds=width)


def test_double_and_decimal_sums_agree(spark):
    rows = [(START + timedelta(seconds=i), "a", "x", i / 100) for i in range(500)]
    df = spark.createDataFrame(rows, SCHEMA)
    exact = result(windows.sliding_stats_by_panes(df, scale=2))
    plain = result(windows.sliding_stats_by_panes(df))
    assert set(exact) == set(plain)
    for key, value in exact.items():
        assert value[3].valor_total == pytest.approx(plain[key][3].valor_total)


def test_pane_is_cut_by_no_window_edge(spark):
    second = 1_000_000
    for width, slide, seconds in [
        ("5 minutes", "1 minute", 60),
        ("5 minutes", "2 minutes", 60),
        ("10 minutes", "10 minutes", 600),
        ("1 second", "500 milliseconds", 0.5),
        ("1 week", "1 day", 86400),
    ]:
        assert windows.pane_width(spark, width, slide) == f"{int(seconds * second)} microseconds"


@pytest.mark.parametrize("width, slide", [("1 second", "500 milliseconds"), ("1 week", "2 days"), ("3 seconds", "750 milliseconds")])
def test_forms_agree_below_a_second_and_over_weeks(spark, width, slide):
    rows = [(START + timedelta(milliseconds=137 * i * i), "ab"[i % 2], "x", i / 100) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    one_pass, panes = (f(df, width, slide, scale=2) for f in (windows.sliding_stats, windows.sliding_stats_by_panes))
    assert sorted(map(str, one_pass.collect())) == sorted(map(str, panes.collect()))


def test_one_hot_group_is_reduced_before_the_shuffle(spark):
    """A third of all rows in one group leave each task as one row per pane."""
    df = spark.range(90_000).selectExpr(
        "TIMESTAMP_NTZ '2024-03-01' + make_dt_interval(0, 0, 0, CAST(id % 60 AS INT)) AS timestamp",
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('c', id % 7) END AS categoria",
        "'x' AS evento",
        "CAST(id AS DOUBLE) AS valor",
    )
    stats = windows.sliding_stats_by_panes(df, scale=2)
    hot = [r for r in stats.collect() if r.categoria == "hot"]
    assert len(hot) == 5 and {r.total_eventos for r in hot} == {30_000}
    shuffled = stats._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in shuffled
