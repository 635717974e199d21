from __future__ import annotations

import json

import pytest

from rivermark.streaming import router

LEAD = {"tipo_evento": "lead", "id": "l1", "nome": "Ana", "email": "a@x",
        "created_at": "2024-01-01T10:00:00", "interesse": ["a"], "score_qualificacao": 70}
SESSION = {"tipo_evento": "chat_session", "id": "s1", "lead_id": "l1", "started_at": "2024-01-01T10:00:00"}
EVENT = {"id": "e1", "usuario": "u", "evento": "login", "valor": 1.5,
         "timestamp": "2024-01-01T10:00:00", "categoria": "ecommerce"}


def messages():
    """One text per case and the output it belongs to."""
    text = json.dumps
    return [
        (text(LEAD), "leads"),
        (text(LEAD | {"id": "l2", "processado_em": "2024-01-01T10:00:00", "mais": 1}), "leads"),
        (text(LEAD | {"id": "l3", "score_qualificacao": 101}), "quarantine"),
        (text(LEAD | {"id": "l4", "status_lead": "outro"}), "quarantine"),
        (text({k: v for k, v in LEAD.items() if k != "email"}), "quarantine"),
        (text(LEAD | {"id": "l5", "created_at": "ontem"}), "quarantine"),
        (text({"tipo_evento": "lead"}), "quarantine"),
        (text(SESSION), "sessions"),
        (text(SESSION | {"id": "s2", "nivel_interesse": "enorme"}), "quarantine"),
        (text(SESSION | {"id": None}), "quarantine"),
        (text(EVENT), "events"),
        (text(EVENT | {"id": "e2", "valor": "abc"}), "quarantine"),
        (text(EVENT | {"id": "e6", "valor": None}), "events"),
        (text(LEAD | {"id": "l6", "score_qualificacao": "abc"}), "quarantine"),
        (text(LEAD | {"id": "l7", "interesse": "x"}), "quarantine"),
        (text(SESSION | {"id": "s3", "is_active": "talvez"}), "quarantine"),
        (text(SESSION | {"id": "s4", "total_messages": 99999999999}), "quarantine"),
        (text({k: v for k, v in EVENT.items() if k != "categoria"} | {"id": "e3"}), "events"),
        (text(EVENT | {"id": "e4", "tipo_evento": None}), "events"),
        (text(EVENT | {"id": "e5", "timestamp": "bad"}), "quarantine"),
        (text(EVENT | {"id": "e" * 300}), "quarantine"),
        (text({"tipo_evento": "chat_message", "id": "m"}), "unknown"),
        ("no json", "quarantine"),
        ('{"tipo_evento":"lead", "id"', "quarantine"),
        ("", "quarantine"),
        (None, "quarantine"),
        ("{}", "quarantine"),
    ]


@pytest.fixture
def texts(spark):
    return spark.createDataFrame([(m,) for m, _ in messages()], "json_data string")


def test_every_message_is_in_exactly_one_output(texts):
    outputs = router.split(texts)
    got = {name: frame.count() for name, frame in outputs.items()}
    want: dict[str, int] = {}
    for _, name in messages():
        want[name] = want.get(name, 0) + 1
    assert got == want


def test_typed_rows_and_defaults(texts):
    outputs = router.split(texts)
    lead = outputs["leads"].where("id = 'l1'").first()
    assert lead.created_at.isoformat() == "2024-01-01T10:00:00"
    assert (lead.status_lead, lead.origem, lead.localizacao) == ("novo", "chatbot", "{}")
    assert lead.updated_at == lead.processado_em and "tipo_evento" not in lead
    session = outputs["sessions"].first()
    assert (session.total_messages, session.nivel_interesse, session.is_active) == (0, "baixo", True)
    assert session.ended_at is None
    assert outputs["events"].where("id = 'e6'").first().valor is None


def test_quarantine_keeps_the_text_and_names_the_rule(texts):
    rows = {r.json_data: r.violations for r in router.split(texts)["quarantine"].collect()}
    assert rows["no json"] == ["unparseable"] and rows[None] == ["unparseable"]
    named = {json.loads(t)["id"]: v for t, v in rows.items() if t and t.startswith('{"tipo') and "l5" in t}
    assert named["l5"] == ["time_created_at"]
    by_id = {json.loads(t).get("id"): v for t, v in rows.items() if t and t.startswith("{") and t.endswith("}")}
    assert by_id["e2"] == ["type_valor"] and by_id["l6"] == ["type_score_qualificacao"]
    assert by_id["l7"] == ["type_interesse"] and by_id["s3"] == ["type_is_active"]
    assert by_id["s4"] == ["type_total_messages"]


def test_empty_batch_gives_empty_outputs(texts):
    assert all(frame.isEmpty() for frame in router.split(texts.limit(0)).values())


def test_failed_sink_fails_the_batch_after_the_others_are_written(texts):
    written = {}

    def keep(name):
        return lambda rows, query_id, batch_id: written.update({name: rows.count()})

    def broken(rows, query_id, batch_id):
        raise OSError("disk")

    sinks = {"leads": broken, "sessions": keep("sessions"), "events": keep("events")}
    others = ["unknown", "quarantine"]
    with pytest.raises(router.SinkError, match="batch 7: not written: leads") as caught:
        router.write_routes(texts, sinks, "q", 7, discarded=others)
    assert isinstance(caught.value.__cause__, OSError)
    assert written == {"sessions": 1, "events": 4}
    with pytest.raises(ValueError, match="quarantine"):
        router.write_routes(texts, sinks, "q", 8, discarded=["unknown"])
    with pytest.raises(ValueError, match="session"):
        router.write_routes(texts, {"session": keep("x")}, "q", 9, discarded=[*others, "events", "leads", "sessions"])


def test_a_job_gets_its_own_routes_only(texts):
    outputs = router.split(texts, routes=["leads", "sessions"])
    assert set(outputs) == {"leads", "sessions", "unknown", "quarantine"}
    kinds = [json.loads(r.json_data)["tipo_evento"] for r in outputs["quarantine"].collect() if "tipo_evento\"" in r.json_data and r.json_data.endswith("}")]
    assert outputs["quarantine"].where("not json_data like '%tipo_evento%'").isEmpty()
    assert set(kinds) == {"lead", "chat_session"}


def test_each_message_is_parsed_once(texts):
    plan = router.split(texts)["leads"]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
