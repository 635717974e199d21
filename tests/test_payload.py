from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from rivermark import schemas
from rivermark.functions.text import any_token, phrase
from rivermark.functions import times
from rivermark.functions.times import parse_iso
from rivermark.operators import payload

EVENT_NAMES = ["id", "usuario", "evento", "valor", "timestamp", "categoria"]


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "json_data string")


def test_bad_field_is_null_and_the_others_stay(spark):
    rows = payload.parse(
        texts(
            spark,
            '{"id":"a","valor":"abc","timestamp":"2025-12-04T10:36:06.147737"}',
            '{"id":"b","valor":10,"timestamp":"bad","extra":1}',
        ),
        schemas.EVENT,
    )
    got = {r.id: r for r in rows.collect()}
    assert got["a"].valor is None
    moment = rows.where("id = 'a'").select(F.col("timestamp").cast("string")).first()[0]
    assert moment == "2025-12-04 10:36:06.147737"
    assert got["b"].valor == 10.0 and got["b"].timestamp is None


def test_one_row_per_text_even_without_a_record(spark):
    rows = payload.parse(texts(spark, None, "", "no json", "{}", '{"id":"x"}'), schemas.EVENT, keep_raw=True)
    assert rows.count() == 5
    lost = rows.where(payload.unparsed(EVENT_NAMES)).select("json_data")
    assert rows_of(lost) == sorted([(None,), ("",), ("no json",), ("{}",)], key=repr)


def test_kind_is_null_for_missing_explicit_null_and_malformed(spark):
    rows = payload.detect(
        texts(spark, '{"tipo_evento":"lead"}', '{"tipo_evento":null}', "{}", '{"tipo_evento":"lead"', None)
    )
    assert sorted(r.tipo_evento or "" for r in rows.collect()) == ["", "", "", "", "lead"]


def test_nested_object_keeps_its_json_text(spark):
    rows = payload.parse(texts(spark, '{"id":"l","localizacao":{"pais":"BR","uf":"SP"}}'), schemas.LEAD)
    assert rows.first().localizacao == '{"pais":"BR","uf":"SP"}'


def test_round_trip_keeps_nulls_micros_and_arrays(spark):
    rows = spark.createDataFrame(
        [("a", None, ["x", "y"], datetime(2024, 5, 1, 2, 3, 4, 567891))],
        "id string, nome string, interesse array<string>, created_at timestamp",
    )
    text = payload.decode(payload.to_messages(rows)).first().json_data
    assert text == (
        '{"id":"a","nome":null,"interesse":["x","y"],"created_at":"2024-05-01T02:03:04.567891"}'
    )
    back = payload.typed_times(payload.parse(texts(spark, text), schemas.LEAD), ["created_at"])
    same = back.join(rows, ["id", "created_at", "interesse"])
    assert same.count() == 1


def test_zone_applies_to_text_without_offset_only(spark):
    rows = texts(spark, "2025-12-04T10:00:00", "2025-12-04T10:00:00Z", "2025-12-04T10:00:00+01:00", "x", None)
    read = rows.select("json_data", parse_iso("json_data", "America/Sao_Paulo").cast("string").alias("t"))
    got = dict(tuple(r) for r in read.collect())
    assert got["2025-12-04T10:00:00"] == "2025-12-04 13:00:00"
    assert got["2025-12-04T10:00:00Z"] == "2025-12-04 10:00:00"
    assert got["2025-12-04T10:00:00+01:00"] == "2025-12-04 09:00:00"
    assert got["x"] is None and got[None] is None


def test_message_key_and_tag(spark):
    rows = spark.createDataFrame([("e1", 1)], "id string, n int")
    sent = payload.to_messages(payload.tagged(rows, "lead"), key="id").first()
    assert bytes(sent.key) == b"e1"
    assert b'"tipo_evento":"lead"' in bytes(sent.value)
    assert b'"processado_em":"20' in bytes(sent.value)


def test_manual_event_defaults(spark):
    rows = spark.createDataFrame([("clique", 5.0, None), ("login", 1.0, "ana")], "evento string, valor double, usuario string")
    got = {r.evento: r for r in payload.manual_events(rows).collect()}
    assert got["clique"].usuario == "manual_user" and got["login"].usuario == "ana"
    assert {r.categoria for r in got.values()} == {"teste_manual"}
    assert len({r.id for r in got.values()}) == 2 and got["login"].timestamp is not None


def test_processing_time_is_added(spark):
    messages = texts(spark, '{"id":"a"}').select(F.col("json_data").cast("binary").alias("value"))
    row = payload.events(messages).first()
    assert row.id == "a" and row.processado_em is not None


def test_token_and_phrase_search(spark):
    rows = texts(spark, "Compra feita, por Ana", "por feita", "comprar", None)
    any_word = rows.where(any_token("json_data", "ANA compra")).collect()
    assert [r[0] for r in any_word] == ["Compra feita, por Ana"]
    in_order = rows.where(phrase("json_data", "feita por")).collect()
    assert [r[0] for r in in_order] == ["Compra feita, por Ana"]


@pytest.mark.parametrize("session_zone", ["UTC", "Asia/Tokyo"])
def test_offsets_of_two_digits_in_any_session_zone(spark, session_zone):
    texts = ["2024-01-01 10:00:00+00", "2024-01-01 07:00:00-03", "2024-01-01T10:00:00.5Z", "2024-01-01T07:00:00", "2024-01-01"]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        rows = spark.createDataFrame([(t,) for t in texts], "t string")
        got = rows.select("t", F.unix_millis(times.parse_iso("t", "America/Sao_Paulo")).alias("ms"))
        ten = 1704103200000
        assert {r.t: r.ms for r in got.collect()} == dict(zip(texts, [ten, ten, ten + 500, ten, ten - 7 * 3_600_000]))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_event_time_is_read_in_the_producers_zone(spark):
    rows = texts(spark, '{"id":"a","timestamp":"2025-12-04T10:00:00"}', '{"id":"b","timestamp":"2025-12-04T10:00:00Z"}')
    read = payload.parse(rows, schemas.EVENT, zone="America/Sao_Paulo")
    got = dict(tuple(r) for r in read.select("id", F.col("timestamp").cast("string")).collect())
    assert got == {"a": "2025-12-04 13:00:00", "b": "2025-12-04 10:00:00"}
