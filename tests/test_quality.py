from __future__ import annotations

from conftest import rows_of
from rivermark import schemas
from rivermark.operators import quality

LEAD = "id string, nome string, email string, score_qualificacao int, status_lead string"


def leads(spark):
    return spark.createDataFrame(
        [
            ("ok", "Ana", "a@x", 50, "novo"),
            ("nulls", "Bia", "b@x", None, None),
            ("score", "Caio", "c@x", 101, "novo"),
            ("negative", "Davi", "d@x", -1, "novo"),
            ("status", "Eva", "e@x", 1, "outro"),
            ("email", "Fabio", None, 1, "novo"),
            ("long", "g" * 256, "g@x", 1, "novo"),
            ("two", None, "h@x", 101, "novo"),
        ],
        LEAD,
    )


def rules():
    return [
        *quality.required("id", "nome", "email"),
        quality.in_range("score_qualificacao", *schemas.SCORE_RANGE),
        quality.in_domain("status_lead", schemas.STATUS_DOMAIN),
        *quality.max_lengths({"nome": 255}),
    ]


def test_each_bad_row_names_its_rules_and_checks_pass_on_null(spark):
    checked = quality.checked(leads(spark), rules())
    broken = {r.id: r.violations for r in quality.quarantined(checked).collect()}
    assert broken == {
        "score": ["range_score_qualificacao"],
        "negative": ["range_score_qualificacao"],
        "status": ["domain_status_lead"],
        "email": ["required_email"],
        "long": ["length_nome"],
        "two": ["required_nome", "range_score_qualificacao"],
    }
    assert {r.id for r in quality.clean(checked).collect()} == {"ok", "nulls"}


def test_clean_and_quarantined_make_up_the_input(spark):
    checked = quality.checked(leads(spark), rules())
    assert quality.clean(checked).count() + quality.quarantined(checked).count() == 8


def test_violation_counts_in_one_pass(spark):
    counts = dict(rows_of(quality.violation_counts(leads(spark), rules())))
    assert counts == {
        "required_id": 0,
        "required_nome": 1,
        "required_email": 1,
        "range_score_qualificacao": 3,
        "domain_status_lead": 1,
        "length_nome": 1,
    }


def test_defaults_fill_absent_values_only(spark):
    rows = quality.with_defaults(
        leads(spark).where("id in ('nulls', 'score')"), {"score_qualificacao": 0, "status_lead": "novo"}
    )
    assert rows_of(rows.select("id", "score_qualificacao", "status_lead")) == [
        ("nulls", 0, "novo"),
        ("score", 101, "novo"),
    ]


def test_orphans_and_cascade(spark):
    parents = spark.createDataFrame([("a",), ("b",)], "id string")
    children = spark.createDataFrame([(1, "a"), (2, "x"), (3, None)], "n int, lead_id string")
    assert rows_of(quality.without_parent(children, parents, "lead_id")) == [(2, "x")]
    left = quality.surviving(children, parents.where("id = 'a'"), "lead_id")
    assert rows_of(left) == [(2, "x"), (3, None)]
