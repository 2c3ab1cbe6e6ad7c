import json

import pytest
from pyspark.sql import functions as F

from riskflow import schemas
from riskflow.functions import wire
from riskflow.operators import avro, ingest
from riskflow.sources import registry
from riskflow.sources.fixtures import read_transactions
from tests.conftest import SF_SMALL
from tests.helpers_avro import encode_body

# Golden frames (header + Avro body) for two transactions.
GOLDEN = [
    (("t1", "user-0042", 5000.01, "USD", "ACME", "travel", 1769508000123, "US", "mobile", False),
     "000000000104743112757365722d30303432f6285c8f0288b340065553440841434d45020c74726176656c"
     "f6c5aaeeff660455530c6d6f62696c6500"),
    (("t2", "user-0042", 12.5, "EUR", "Ünï", None, 1769508000999, "MX", "tablet", True),
     "000000000104743212757365722d303034320000000000002940064555520ac39c6ec3af00ced3aaeeff66"
     "044d580c7461626c657401"),
]


def test_strip_header_lengths(spark):
    rows = [(None,), (b"",), (b"\x00\x01\x02\x03",), (b"\x00\x00\x00\x00\x01",),
            (b"\x00\x00\x00\x00\x01\x7f",)]
    df = spark.createDataFrame(rows, "value binary")
    got = [r[0] for r in df.select(wire.strip_header(F.col("value"))).collect()]
    assert got == [None, bytearray(b""), bytearray(b"\x00\x01\x02\x03"),
                   bytearray(b"\x00\x00\x00\x00\x01"), bytearray(b"\x7f")]
    assert dict(df.select(wire.strip_header(F.col("value")).alias("v")).dtypes)["v"] == "binary"


def test_header_fields(spark):
    df = spark.createDataFrame([(bytes.fromhex(GOLDEN[0][1]),), (b"\x00\x00\x01\x00\x07xyz",)], "value binary")
    got = [tuple(r) for r in df.select(wire.magic_byte(F.col("value")), wire.schema_id(F.col("value"))).collect()]
    assert got == [(0, 1), (0, 65543)]


def test_golden_vectors_decode_and_encode(spark):
    df = spark.createDataFrame([(bytes.fromhex(h),) for _, h in GOLDEN], "value binary")
    decoded = [tuple(r) for r in ingest.decode_transactions(df).collect()]
    assert decoded == [row for row, _ in GOLDEN]
    tx = spark.createDataFrame([row for row, _ in GOLDEN], schemas.TRANSACTION)
    frames = sorted(bytes(r["value"]).hex() for r in ingest.to_wire(tx).collect())
    assert frames == sorted(h for _, h in GOLDEN)


def test_roundtrip_on_fixture(spark):
    tx = read_transactions(spark, SF_SMALL)
    back = ingest.decode_transactions(ingest.to_wire(tx))
    assert back.schema.simpleString() == tx.schema.simpleString()
    assert back.exceptAll(tx).count() == 0 and tx.exceptAll(back).count() == 0


def test_decoded_schema_matches_transaction_struct():
    st = avro.spark_type(avro.parse_schema(schemas.TRANSACTION_AVRO))
    assert st == schemas.TRANSACTION


def test_failfast_and_permissive(spark):
    bad = spark.createDataFrame([(bytes.fromhex(GOLDEN[0][1]),), (b"\x00\x00\x00\x00\x01\x09",), (None,)],
                                "value binary")
    with pytest.raises(Exception, match="Malformed Avro"):
        ingest.decode_transactions(bad).collect()
    rows = ingest.decode_transactions(bad, mode="PERMISSIVE").collect()
    assert rows[0]["transaction_id"] == "t1"
    assert rows[1]["transaction_id"] is None and rows[2]["transaction_id"] is None


def test_writer_schema_resolution(spark):
    """A message written with an older schema (no device_type, no is_fraud)
    is read with its own schema and gets the reader's defaults."""
    old = json.loads(schemas.TRANSACTION_AVRO)
    old["fields"] = [f for f in old["fields"] if f["name"] not in ("device_type", "is_fraud")]
    old_json = json.dumps(old)
    body = encode_body({"transaction_id": "t9", "user_id": "u", "amount": 1.5, "currency": "USD",
                             "merchant": "m", "category": None, "timestamp": 5, "country": "US"},
                            avro.parse_schema(old_json))
    new = json.loads(schemas.TRANSACTION_AVRO)
    new["fields"] = [f if f["name"] != "device_type" else {**f, "default": "unknown"} for f in new["fields"]]
    df = spark.createDataFrame([(b"\x00\x00\x00\x00\x02" + body,)], "value binary")
    r = ingest.decode_transactions(df, schema_json=json.dumps(new), writer_schemas={2: old_json}).first()
    assert (r["transaction_id"], r["device_type"], r["is_fraud"]) == ("t9", "unknown", False)


def test_registry_latest(spark, scratch):
    rows = [
        {"subject": "transactions-raw-value", "version": 1, "schema_id": 1, "schema": '"string"'},
        {"subject": "transactions-raw-value", "version": 2, "schema_id": 7, "schema": schemas.TRANSACTION_AVRO},
        {"subject": "other-value", "version": 5, "schema_id": 3, "schema": '"long"'},
    ]
    path = f"{scratch}/registry"
    spark.createDataFrame(rows, registry.REGISTRY_SCHEMA).write.json(path)
    reg = registry.read_registry(spark, path)
    sid, schema = registry.latest_schema(reg, "transactions-raw-value")
    assert (sid, schema) == (7, schemas.TRANSACTION_AVRO)
    assert registry.writer_schemas(reg, "transactions-raw-value") == {1: '"string"', 7: schemas.TRANSACTION_AVRO}
    with pytest.raises(KeyError):
        registry.latest_schema(reg, "missing")


def test_decode_only_requested_columns(spark):
    tx = read_transactions(spark, SF_SMALL)
    msgs = ingest.to_wire(tx)
    cols = ["user_id", "amount", "timestamp"]
    part = ingest.decode_transactions(msgs, columns=cols)
    assert part.columns == cols
    assert part.exceptAll(tx.select(*cols)).count() == 0 and tx.select(*cols).exceptAll(part).count() == 0


def test_projection_with_writer_schemas(spark):
    old = json.loads(schemas.TRANSACTION_AVRO)
    old["fields"] = [f for f in old["fields"] if f["name"] != "is_fraud"]
    old_json = json.dumps(old)
    body = encode_body({"transaction_id": "t9", "user_id": "u", "amount": 2.5, "currency": "USD",
                             "merchant": "m", "category": None, "timestamp": 7, "country": "US",
                             "device_type": "mobile"}, avro.parse_schema(old_json))
    df = spark.createDataFrame([(b"\x00\x00\x00\x00\x03" + body,)], "value binary")
    r = ingest.decode_transactions(df, writer_schemas={3: old_json},
                                   columns=["user_id", "amount", "is_fraud"]).first()
    assert tuple(r) == ("u", 2.5, False)      # is_fraud from the reader default


def test_unknown_schema_id_is_an_error_or_a_reject(spark):
    df = spark.createDataFrame([(b"\x00\x00\x00\x00\x09" + bytes.fromhex(GOLDEN[0][1])[5:],),
                                (bytes.fromhex(GOLDEN[1][1]),)], "value binary")
    known = {1: schemas.TRANSACTION_AVRO}
    with pytest.raises(Exception, match="unknown schema id"):
        ingest.decode_transactions(df, writer_schemas=known).collect()
    rows = ingest.decode_transactions(df, writer_schemas=known, mode="PERMISSIVE").collect()
    assert [r["transaction_id"] for r in rows] == [None, "t2"]
    assert [bytes(r["value"]) for r in ingest.rejects(df, writer_schemas=known).collect()] == [
        b"\x00\x00\x00\x00\x09" + bytes.fromhex(GOLDEN[0][1])[5:]]


def test_rejects_keep_the_raw_bytes(spark):
    frames = [(b"k1", bytes.fromhex(GOLDEN[0][1])), (b"k2", bytes.fromhex(GOLDEN[0][1])[:-1]), (b"k3", None),
              (b"k4", b"\x00\x00\x00\x00\x01" + b"\xff" * 12)]
    got = ingest.rejects(spark.createDataFrame(frames, "key binary, value binary")).collect()
    assert sorted(bytes(r["key"]) for r in got) == [b"k2", b"k4"]
    assert all(r["value"] is not None for r in got)


def test_registry_decode_stays_in_the_jvm(spark, monkeypatch):
    """With spark-avro loaded no path reaches Python: a stand-in for from_avro shows the calls and the plan."""
    calls = []

    def stand_in(column, schema, options=None):
        calls.append((schema, options))
        return F.from_json(column.cast("string"), schemas.TRANSACTION)
    monkeypatch.setattr(avro, "from_avro", stand_in)
    df = spark.createDataFrame([(b"\x00\x00\x00\x00\x01x",)], "value binary")
    old = schemas.TRANSACTION_AVRO.replace("Transaction", "Older")
    for kw in ({}, {"writer_schemas": {7: schemas.TRANSACTION_AVRO, 3: old}}, {"mode": "PERMISSIVE", "writer_schemas": {3: old}}):
        del calls[:]
        out = ingest.decode_transactions(df, columns=["user_id", "amount"], **kw)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "InArrow" not in plan and "Python" not in plan
        used = [c for c in calls if c[0] != '"long"']
        writers = kw.get("writer_schemas")
        assert [c[0] for c in used] == ([writers[k] for k in sorted(writers)] if writers else [schemas.TRANSACTION_AVRO])
        assert all(c[1]["mode"] == kw.get("mode", "FAILFAST") for c in used)
        assert all(c[1].get("avroSchema") == (schemas.TRANSACTION_AVRO if writers else None) for c in used)
    with pytest.raises(Exception, match="unknown schema id"):
        ingest.decode_transactions(df, writer_schemas={3: old}).collect()


def test_encode_stays_in_the_jvm(spark, monkeypatch):
    """With spark-avro loaded the producer's side is ``to_avro`` on a record of the schema's own types."""
    calls = []

    def stand_in(column, schema):
        calls.append(schema)
        return F.to_json(column).cast("binary")
    monkeypatch.setattr(avro, "to_avro", stand_in)
    monkeypatch.setattr(avro, "spark_avro_available", lambda session: True)
    schema = json.dumps({"type": "record", "name": "R", "fields": [
        {"name": "id", "type": "long"}, {"name": "note", "type": ["null", "string"]}, {"name": "size", "type": "double"}]})
    df = spark.createDataFrame([(1, "a", 2), (2, None, 3)], "id int, note string, size int")
    out = avro.encode(df, schema, keep=["id"])
    assert out.columns == ["id", "body"] and calls == [schema]
    assert "InArrow" not in out._jdf.queryExecution().executedPlan().toString()
    assert [bytes(r["body"]) for r in out.sort("id").collect()] == [b'{"id":1,"note":"a","size":2.0}', b'{"id":2,"size":3.0}']
    with pytest.raises(Exception, match="null in the required field size"):
        avro.encode(df.withColumn("size", F.lit(None).cast("int")), schema).collect()


def test_encode_without_the_module_refuses_nulls_in_required_fields(spark):
    schema = json.dumps({"type": "record", "name": "R", "fields": [{"name": "id", "type": "long"}]})
    with pytest.raises(Exception):
        avro.encode(spark.createDataFrame([(None,)], "id long"), schema).collect()
