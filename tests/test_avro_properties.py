"""Property tests of the fallback Avro codec (no Spark)."""

import json
import math

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskflow import schemas
from riskflow.operators import avro
from tests.helpers_avro import decode_body, encode_body

SCHEMA = avro.parse_schema(schemas.TRANSACTION_AVRO)

records = st.fixed_dictionaries({
    "transaction_id": st.text(), "user_id": st.text(min_size=1),
    "amount": st.floats(allow_nan=True, allow_infinity=True),
    "currency": st.sampled_from(["USD", "EUR", "MXN", "GBP"]), "merchant": st.text(),
    "category": st.one_of(st.none(), st.text()),
    "timestamp": st.integers(min_value=-(2**63), max_value=2**63 - 1),
    "country": st.text(max_size=3), "device_type": st.text(), "is_fraud": st.booleans(),
})


def _same(a, b):
    if isinstance(a, float) and math.isnan(a):
        return isinstance(b, float) and math.isnan(b)
    return a == b


@settings(max_examples=300, deadline=None)
@given(records)
def test_roundtrip(rec):
    body = encode_body(rec, SCHEMA)
    back = decode_body(body, SCHEMA)
    assert list(back) == [f.name for f in SCHEMA]
    assert all(_same(rec[k], back[k]) for k in rec)


@settings(max_examples=200, deadline=None)
@given(records, st.data())
def test_truncated_body_is_an_error(rec, data):
    body = encode_body(rec, SCHEMA)
    cut = data.draw(st.integers(min_value=0, max_value=len(body) - 1))
    # every field is required, so a cut body can never parse
    with pytest.raises(avro.AvroDecodeError):
        decode_body(body[:cut], SCHEMA)


LONG = avro.parse_schema('{"type": "record", "name": "L", "fields": [{"name": "n", "type": "long"}]}')
INT = avro.parse_schema('{"type": "record", "name": "I", "fields": [{"name": "n", "type": "int"}]}')


@given(st.integers(min_value=-(2**63), max_value=2**63 - 1))
def test_varint_zigzag(n):
    body = encode_body({"n": n}, LONG)
    assert decode_body(body, LONG) == {"n": n}
    assert len(body) <= 10


@pytest.mark.parametrize("fields,body", [
    (LONG, b"\xff" * 10 + b"\x01"), (LONG, b"\xff" * 9 + b"\x02"), (LONG, b"\x80" * 40), (LONG, b""), (INT, b"\xff" * 9 + b"\x01"),
    (SCHEMA, b"\x01"), (SCHEMA, b"\x02t\xfe\xff\xff\xff\xff\xff\xff\xff\xff\x01")])
def test_over_long_and_negative_numbers_are_bad(fields, body):
    with pytest.raises(avro.AvroDecodeError):
        decode_body(body, fields)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.one_of(st.none(), records, st.binary(max_size=40)), max_size=20))
def test_batches_of_good_bad_and_null_bodies(mixed):
    bodies = [encode_body(m, SCHEMA) if isinstance(m, dict) else m for m in mixed]
    columns, bad = avro.decode_columns(pa.array(bodies, pa.binary()), SCHEMA, SCHEMA)
    for i, m in enumerate(mixed):
        if isinstance(m, dict):
            assert not bad[i] and all(_same(m[f.name], c[i].as_py()) for f, c in zip(SCHEMA, columns))
        elif m is None:
            assert not bad[i] and all(c[i].as_py() is None for c in columns)
        else:
            try:
                alone = decode_body(m, SCHEMA)
            except avro.AvroDecodeError:
                assert bad[i]
            else:
                assert not bad[i] and all(_same(alone[f.name], c[i].as_py()) for f, c in zip(SCHEMA, columns))


def test_sliced_input():
    recs = [{"n": n} for n in (1, -1, 300, 2**40)]
    whole = pa.array([encode_body(r, LONG) for r in recs], pa.binary())
    columns, bad = avro.decode_columns(whole.slice(1, 2), LONG, LONG)
    assert columns[0].to_pylist() == [-1, 300] and not bad.any()
    text = avro.parse_schema('{"type": "record", "name": "S", "fields": [{"name": "s", "type": ["string", "null"]}]}')
    bodies = avro.encode_columns([pa.array(["a", None, "bcd", "é"]).slice(1)], text)
    assert avro.decode_columns(bodies, text, text)[0][0].to_pylist() == [None, "bcd", "é"]


def test_invalid_utf8_and_booleans_mark_only_their_row():
    fields = avro.parse_schema(json.dumps({"type": "record", "name": "R", "fields": [
        {"name": "s", "type": "string"}, {"name": "b", "type": "boolean"}]}))
    columns, bad = avro.decode_columns(pa.array([b"\x02a\x01", b"\x02\xff\x01", b"\x02b\x07"], pa.binary()), fields, fields)
    assert bad.tolist() == [False, True, True] and columns[0][0].as_py() == "a" and np.asarray(columns[1])[0]


def test_all_types_and_promotion():
    fields = avro.parse_schema(json.dumps({"type": "record", "name": "R", "fields": [
        {"name": "x", "type": "int"}, {"name": "f", "type": "float"}, {"name": "raw", "type": "bytes"},
        {"name": "d", "type": ["double", "null"]}]}))
    rec = {"x": -3, "f": 1.5, "raw": b"\x00\xff", "d": None}
    assert decode_body(encode_body(rec, fields), fields) == rec
    wide = avro.parse_schema(json.dumps({"type": "record", "name": "R", "fields": [
        {"name": "x", "type": "long"}, {"name": "f", "type": "double"}, {"name": "new", "type": "string", "default": "z"}]}))
    assert decode_body(encode_body(rec, fields), fields, wide) == {"x": -3, "f": 1.5, "new": "z"}


@pytest.mark.parametrize("kind", [{"type": "enum", "name": "E", "symbols": ["A"]}, ["null", "string", "int"],
                                  {"type": "record", "name": "I", "fields": []}])
def test_other_types_are_refused(kind):
    with pytest.raises(ValueError):
        avro.parse_schema(json.dumps({"type": "record", "name": "R", "fields": [{"name": "k", "type": kind}]}))


@settings(max_examples=200, deadline=None)
@given(records, st.sets(st.sampled_from([f.name for f in SCHEMA])))
def test_projected_read_equals_full_read(rec, wanted):
    body = encode_body(rec, SCHEMA)
    part = decode_body(body, SCHEMA, [f for f in SCHEMA if f.name in wanted])
    assert list(part) == [f.name for f in SCHEMA if f.name in wanted]
    assert all(_same(rec[n], v) for n, v in part.items())


def test_projection_still_detects_a_cut_body():
    rec = {"transaction_id": "t", "user_id": "u", "amount": 1.0, "currency": "USD", "merchant": "m",
           "category": None, "timestamp": 5, "country": "US", "device_type": "mobile", "is_fraud": True}
    body = encode_body(rec, SCHEMA)
    some = [f for f in SCHEMA if f.name in ("user_id", "amount", "timestamp")]   # boolean skipped
    assert list(decode_body(body, SCHEMA, some).values()) == ["u", 1.0, 5]
    with pytest.raises(avro.AvroDecodeError):
        decode_body(body[:-1], SCHEMA, some)
