from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import plan_of, rows_of
from rivermark.operators import keyed

SCHEMA = "id string, versao int, valor double"
row = st.tuples(
    st.sampled_from(["a", "b", "c", "d", None]), st.integers(0, 4), st.sampled_from([1.0, 2.0, None])
)


def order_of(r):
    return (r[1], r[2] is not None, r[2] or 0.0)


def newest(rows):
    best = {}
    for r in rows:
        if r[0] not in best or order_of(r) > order_of(best[r[0]]):
            best[r[0]] = r
    return best


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(base=st.lists(row, max_size=8), changes=st.lists(row, max_size=12))
def test_upsert_equals_brute_force_and_repeats(spark, base, changes):
    unique = list(newest(base).values())
    table = spark.createDataFrame(unique, SCHEMA)
    batch = spark.createDataFrame(changes, SCHEMA)
    once = keyed.upsert(table, batch, ["id"], ["versao"])
    want = sorted(newest(unique + changes).values(), key=repr)
    assert rows_of(once) == want
    stored = spark.createDataFrame(once.collect(), SCHEMA)
    assert rows_of(keyed.upsert(stored, batch, ["id"], ["versao"])) == want


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(existing=st.lists(row, max_size=8), batch=st.lists(row, max_size=8))
def test_new_rows_are_one_per_unknown_key(spark, existing, batch):
    known = {r[0] for r in existing}
    got = keyed.new_rows(
        spark.createDataFrame(existing, SCHEMA), spark.createDataFrame(batch, SCHEMA), ["id"], ["versao"]
    )
    want = [r for k, r in newest(batch).items() if k not in known]
    assert rows_of(got) == sorted(want, key=repr)


def test_older_change_does_not_win(spark):
    base = spark.createDataFrame([("a", 5, 1.0)], SCHEMA)
    late = spark.createDataFrame([("a", 4, 9.0), ("n", 1, 1.0)], SCHEMA)
    assert rows_of(keyed.upsert(base, late, ["id"], ["versao"])) == [("a", 5, 1.0), ("n", 1, 1.0)]


def test_latest_of_a_hot_key_combines_before_the_shuffle(spark):
    df = spark.range(60_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id) END AS id", "id AS versao"
    )
    result = keyed.latest(df, ["id"], ["versao"])
    assert result.where("id = 'hot'").first().versao == 59_997
    assert result.count() == 40_001
    assert "partial_max" in result._jdf.queryExecution().executedPlan().toString()


def test_latest_over_only_key_columns_is_distinct(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "id string")
    assert rows_of(keyed.latest(df, ["id"])) == [("a",), ("b",)]


def test_matching_and_missing_split_the_table(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "id string, n int")
    right = spark.createDataFrame([("a",), ("a",), (None,)], "id string")
    assert rows_of(keyed.matching(left, right, ["id"])) == sorted([("a", 1), (None, 3)], key=repr)
    assert rows_of(keyed.missing(left, right, ["id"])) == [("b", 2)]


def test_reconcile_counts_rows_and_absent_keys(spark):
    left = spark.createDataFrame([("a",), ("b",), ("b",)], "id string")
    right = spark.createDataFrame([("b",), ("c",), ("d",)], "id string")
    assert rows_of(keyed.reconcile(left, right, ["id"], ("l", "r"))) == [("l", 3, 2), ("r", 3, 1)]
    empty = left.limit(0)
    assert rows_of(keyed.reconcile(empty, empty, ["id"], ("l", "r"))) == [("l", 0, 0), ("r", 0, 0)]


def test_upsert_shuffles_the_changes_once(spark):
    base = spark.createDataFrame([(1, 1, "a"), (None, 1, "b")], "id long, n int, v string")
    changes = spark.createDataFrame([(1, 2, "c"), (1, 0, "d"), (None, 3, "e"), (2, 1, None)], base.schema)
    rows = keyed.upsert(base, changes, ["id"], ["n"])
    assert plan_of(rows).split("\n\n")[0].count("Exchange") == 2
    assert rows_of(rows) == [(1, 2, "c"), (2, 1, None), (None, 3, "e")]
    only_keys = keyed.upsert(base.select("id"), changes.select("id"), ["id"], [])
    assert rows_of(only_keys) == [(1,), (2,), (None,)]
