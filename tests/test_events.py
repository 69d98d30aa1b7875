import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from indicator_lake.streaming import contract, sinks

VALID = {
    "id_evento": "a7",
    "id_municipio": "4106902",
    "sigla_uf": "pr",
    "ano": 2027,
    "rede": "estadual",
    "serie": "4",
    "taxa_alfabetizacao": 41.25,
    "meta_alfabetizacao": 44.0,
    "data_evento": (datetime.now(timezone.utc) - timedelta(seconds=1)).isoformat(),
}
TOMORROW = (datetime.now(timezone.utc) + timedelta(days=1)).isoformat()

# (change, broken rules)
CASES = [
    ({}, []),
    ({"taxa_alfabetizacao": 100.5}, ["taxa_alfabetizacao"]),
    ({"taxa_alfabetizacao": "41.25d"}, ["taxa_alfabetizacao"]),
    ({"taxa_alfabetizacao": "0x1p3"}, ["taxa_alfabetizacao"]),
    ({"taxa_alfabetizacao": " 41.25 ", "ano": "2027.0"}, []),
    ({"ano": "2027f"}, ["ano"]),
    ({"ano": "2.027e3"}, ["ano"]),
    ({"data_evento": "1704067200d"}, ["data_evento"]),
    ({"id_municipio": "41069"}, ["id_municipio"]),
    ({"data_evento": TOMORROW}, ["data_evento"]),
    ({"nome_aluno": "x"}, ["extra_field"]),
    ({"sigla_uf": "XX"}, ["sigla_uf"]),
    ({"sigla_uf": "\tpe\x1f"}, []),
    ({"id_municipio": 4205407}, ["id_municipio"]),
    ({"id_municipio": "1234567\n"}, ["id_municipio"]),
    ({"meta_alfabetizacao": None}, []),
    ({"meta_alfabetizacao": 101}, ["meta_alfabetizacao"]),
    ({"meta_alfabetizacao": "x"}, ["meta_alfabetizacao"]),
    ({"ano": 2025.0}, []),
    ({"ano": 2025.5}, ["ano"]),
    ({"ano": "2025"}, []),
    ({"ano": 2022}, ["ano"]),
    ({"ano": 2036}, ["ano"]),
    ({"taxa_alfabetizacao": "72.5"}, []),
    ({"taxa_alfabetizacao": True}, []),
    ({"taxa_alfabetizacao": None}, ["taxa_alfabetizacao"]),
    ({"taxa_alfabetizacao": [1]}, ["taxa_alfabetizacao"]),
    ({"rede": ""}, ["rede"]),
    ({"serie": 2}, ["serie"]),
    ({"id_evento": ""}, ["id_evento"]),
    ({"tipo_evento": None}, ["tipo_evento"]),
    ({"fonte": 5}, ["fonte"]),
    ({"data_evento": "2024-01-01T00:00:00"}, []),
    ({"data_evento": "2024-01"}, ["data_evento"]),
    ({"data_evento": 1704067200}, []),
    ({"data_evento": True}, ["data_evento"]),
]
BROKEN = [b'{"a"', b"[1]", b'\xff{"a": 1}', b"null", b'"text"', b"", None]


def messages(spark, bodies):
    rows = [(None if b is None else bytearray(b), str(i)) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, sinks.MESSAGE_SCHEMA)


@pytest.fixture(scope="module")
def checked(spark):
    bodies = [json.dumps({**VALID, **change}).encode() for change, _ in CASES] + BROKEN
    rows = contract.validate(messages(spark, bodies)).select("message_id", "_errors").collect()
    return {int(r.message_id): list(r["_errors"]) for r in rows}


@pytest.mark.parametrize("index", range(len(CASES)), ids=lambda i: str(CASES[i][0]))
def test_contract(checked, index):
    assert checked[index] == CASES[index][1]


@pytest.mark.parametrize("index", range(len(BROKEN)))
def test_bodies_that_are_no_object(checked, index):
    assert checked[len(CASES) + index] == [contract.NOT_AN_OBJECT]


def test_missing_fields_are_all_named(spark):
    row = contract.validate(messages(spark, [b"{}"])).select("_errors").first()
    assert row[0] == [
        "id_evento", "id_municipio", "sigla_uf", "ano", "rede", "serie", "taxa_alfabetizacao", "data_evento",
    ]


def test_accepted_and_rejected_rows(spark):
    long = b'{"x": "' + b"y" * 20000 + b'"}'
    rows = contract.validate(messages(spark, [json.dumps(VALID).encode(), long, b"\xff!"]))
    good = contract.accepted(rows).first()
    assert (good.sigla_uf, good.tipo_evento, good.fonte) == ("PR", *contract.DEFAULTS.values())
    bad = {r.pubsub_message_id: r for r in contract.rejected(rows).collect()}
    assert len(bad["1"].payload) == len(long) and bad["2"].payload == "�!"


def test_body_is_parsed_once(spark):
    rows = contract.rejected(contract.validate(messages(spark, [b"{}"])))
    assert rows._jdf.queryExecution().executedPlan().toString().count("parseJson") == 1


def test_stream_routes_every_message_once_and_replays_safely(spark, tmp_path):
    bodies = [json.dumps({**VALID, **change}).encode() for change, _ in CASES] + BROKEN
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    messages(spark, bodies[:10]).write.parquet(source)
    for part in (bodies[:0], bodies[10:]):
        if part:
            messages(spark, part).write.mode("append").parquet(source)
        stream = sinks.file_messages(spark, source)
        sinks.start(stream, out, str(tmp_path / "checkpoint"), drain=True).awaitTermination()
    valid = sinks.read_events(spark, out)
    bad = sinks.read_events(spark, out, sinks.REJECTED)
    accepted = sum(not errors for _, errors in CASES)
    assert (valid.count(), bad.count()) == (accepted, len(bodies) - accepted)
    again = str(tmp_path / "again")
    for _ in range(2):
        sinks.batch_writer(again)(messages(spark, bodies), 1)
    assert sinks.read_events(spark, again).count() == accepted


def test_as_of_decides_what_is_future(spark):
    body = json.dumps({**VALID, "data_evento": "2024-06-01T00:00:00Z"}).encode()
    df = messages(spark, [body])
    for as_of, errors in (("2024-05-31", ["data_evento"]), ("2024-06-01", [])):
        got = contract.validate(df, as_of=F.lit(as_of).cast("timestamp")).first()["_errors"]
        assert list(got) == errors


def test_a_new_checkpoint_keeps_stored_events(spark, tmp_path):
    def send(name, ids):
        rows = [(json.dumps({**VALID, "id_evento": i}).encode(), i) for i in ids]
        spark.createDataFrame(rows, sinks.MESSAGE_SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/{name}/part")
        source = sinks.file_messages(spark, f"{tmp_path}/{name}/part")
        sinks.start(source, f"{tmp_path}/lake", f"{tmp_path}/checkpoint-{name}", drain=True).awaitTermination()

    send("one", "abcde")
    send("two", "fgh")
    assert sinks.read_events(spark, f"{tmp_path}/lake").count() == 8
