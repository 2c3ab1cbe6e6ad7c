import json

import pytest
from pyspark.sql import functions as F

from riskflow.config import DEFAULT
from riskflow.functions.eventtime import to_event_time
from riskflow.operators import explain, immediate, payload, velocity
from tests.helpers import ms, tx_df, tx_row

T0 = ms("2024-01-27 10:00:00")


def _flags(spark):
    rows = [tx_row("t1", "user-1", 6000.0, T0 + 500), tx_row("t2", "user-2", 10.0, T0, is_fraud=True),
            tx_row("t3", "user-3", 9000.0, T0 + 1000), tx_row("t4", "user-3", 9000.0, T0 + 2000)]
    timed = to_event_time(tx_df(spark, rows))
    return immediate.flag_immediate(timed), velocity.flag_windowed(velocity.velocity_features(timed))


def test_payload_shape(spark):
    imm, win = _flags(spark)
    p = payload.to_payload(imm).filter(F.col("key") == "user-1").first()
    obj = json.loads(p["value"])
    assert list(obj) == ["transaction_id", "user_id", "amount", "currency", "merchant", "timestamp",
                         "fraud_reason", "rule_score", "is_fraud"]
    assert obj["timestamp"] == "2024-01-27T10:00:00.000Z"
    w = json.loads(payload.to_payload(win).first()["value"])
    assert set(w["window"]) == {"start", "end"} and "transaction_id" not in w


def test_topic_union_and_parse_back(spark):
    imm, win = _flags(spark)
    topic = payload.flagged_topic(payload.to_payload(imm), payload.to_payload(win))
    parsed = payload.parse_flags(topic)
    counts = {r["shape"]: r["count"] for r in parsed.groupBy("shape").count().collect()}
    assert counts == {"transaction": imm.count(), "window": win.count()}
    assert parsed.filter(F.col("_corrupt_record").isNotNull()).count() == 0
    back = parsed.filter(F.col("shape") == "transaction").select(*imm.columns)
    assert back.exceptAll(imm).count() == 0


def test_parse_bad_messages_and_keys(spark):
    msgs = spark.createDataFrame([
        ("k", '{"a":'), ("k", "[1]"), ("k", '"s"'), ("k", None),
        ("k", '{"fraud_reason": "X"}'), ("k", '{"user_id": null, "fraud_reason": "X"}'),
        ("k", '{"user_id": "u-7", "fraud_reason": "X"}'),
    ], "key string, value string")
    rows = payload.parse_flags(msgs).collect()
    corrupt = [r["_corrupt_record"] is not None for r in rows]
    assert corrupt == [True, True, True, True, False, False, False]
    assert [r["record_key"] for r in rows[4:]] == ["", "None", "u-7"]
    dlq = explain.undecodable_dead_letters(payload.parse_flags(msgs))
    assert dlq.count() == 4


class Flaky(explain.RetryableError):
    pass


def test_retry_rules():
    sleeps = []
    calls = {"n": 0}

    def twice_then_ok(attempt):
        calls["n"] += 1
        assert attempt == calls["n"]
        if calls["n"] < 3:
            raise Flaky("busy")
        return "ok"

    assert explain.attempt_with_retry(twice_then_ok, 3, (Flaky,), 2, 10, sleeps.append) == ("ok", None, 3)
    assert sleeps == [2, 2]
    assert [explain.backoff_wait(a, 2, 10) for a in (1, 2, 3, 4, 5)] == [2, 2, 4, 8, 10]

    def always(attempt):
        raise Flaky("down")
    res, err, used = explain.attempt_with_retry(always, 3, (Flaky,), 2, 10, lambda s: None)
    assert (res, str(err), used) == (None, "down", 3)

    def wrong_type(attempt):
        raise KeyError("nope")
    res, err, used = explain.attempt_with_retry(wrong_type, 3, (Flaky,), 2, 10, lambda s: None)
    assert isinstance(err, KeyError) and used == 1


def test_explain_job_routes_status(spark):
    imm, win = _flags(spark)
    parsed = payload.parse_flags(payload.flagged_topic(payload.to_payload(imm), payload.to_payload(win)))

    def explainer(record, prompt):
        assert prompt.startswith(explain.PROMPT_HEAD) and prompt.endswith(explain.PROMPT_TAIL)
        data = json.loads(prompt[len(explain.PROMPT_HEAD):-len(explain.PROMPT_TAIL)])
        assert data["fraud_reason"] == record["fraud_reason"]
        if record["user_id"] == "user-2":
            raise Flaky("throttled")
        return f"because {record['fraud_reason']}"

    res = explain.explain_flags(parsed, explainer, DEFAULT, retryable=(Flaky,), sleep=lambda s: None)
    res.cache()
    ok = explain.explained(res).collect()
    bad = explain.dead_letters(res).collect()
    assert {r["user_id"] for r in bad} == {"user-2"}
    assert bad[0]["error"] == "throttled" and bad[0]["attempts"] == 3
    assert all(r["llm_explanation"].startswith("because ") for r in ok)
    assert len(ok) + len(bad) == parsed.count()
    summary = {r["status"]: r["n"] for r in explain.summary(res).collect()}
    assert summary == {"SUCCESS": len(ok), "FAILED": 1}
    out = explain.to_output_payload(explain.explained(res)).first()
    assert set(json.loads(out["value"])) >= {"status", "llm_explanation", "fraud_reason"}
    res.unpersist()


def test_template_explainer_is_jvm_only(spark):
    imm, _ = _flags(spark)
    parsed = payload.parse_flags(payload.to_payload(imm))
    res = explain.explain_flags(parsed)
    plan = res._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan
    texts = {r["llm_explanation"] for r in res.collect()}
    assert "Flagged transaction t1 as HIGH_AMOUNT with rule score 0.9." in texts


@pytest.mark.parametrize("bad", ['{"a":', "[1]"])
def test_undecodable_is_not_lost(spark, bad):
    msgs = spark.createDataFrame([("k", bad)], "key string, value string")
    parsed = payload.parse_flags(msgs)
    assert explain.undecodable_dead_letters(parsed).first()["raw_value"] == bad


def test_concurrency_is_bounded_per_task(spark):
    """Each task runs at most ``concurrency`` explainer calls at once; the
    explainer reports the peak it saw inside its worker."""
    import threading
    import time as _time

    imm, win = _flags(spark)
    parsed = payload.parse_flags(payload.flagged_topic(*[payload.to_payload(imm)] * 8))
    state = {"now": 0, "peak": 0}

    def explainer(record, prompt):
        lock = state.setdefault("lock", threading.Lock())   # made in the worker
        with lock:
            state["now"] += 1
            state["peak"] = max(state["peak"], state["now"])
        _time.sleep(0.05)
        with lock:
            state["now"] -= 1
        return str(state["peak"])

    res = explain.explain_flags(parsed.coalesce(1), explainer, DEFAULT, concurrency=3)
    peaks = [int(r["llm_explanation"]) for r in res.collect()]
    assert max(peaks) == 3


def test_console_sink_prints_batches(spark, capsys):
    from riskflow.streaming.sinks import ConsoleSink
    imm, _ = _flags(spark)
    ConsoleSink(num_rows=2).write_batch(imm, "flagged-immediate-console-000000000000")
    out = capsys.readouterr().out
    assert "flagged-immediate-console-000000000000" in out and "fraud_reason" in out


def test_nan_amount_survives_json(spark):
    import math
    timed = to_event_time(tx_df(spark, [tx_row("t9", "u", float("nan"), T0)]))
    msg = payload.to_payload(immediate.flag_immediate(timed)).first()
    assert '"amount":"NaN"' in msg["value"]
    back = payload.parse_flags(payload.to_payload(immediate.flag_immediate(timed))).first()
    assert math.isnan(back["amount"]) and back["fraud_reason"] == "HIGH_AMOUNT"


def test_mistyped_fields_are_no_dead_letters(spark):
    msgs = spark.createDataFrame([("k", '{"user_id": "u", "amount": "n/a", "fraud_reason": "X"}'), ("j", '{"a": ')],
                                 "key string, value string")
    parsed = payload.parse_flags(msgs)
    good = parsed.filter(F.col("_corrupt_record").isNull()).collect()
    assert [(r["user_id"], r["amount"], r["fraud_reason"], r["record_key"]) for r in good] == [("u", None, "X", "u")]
    dead = explain.undecodable_dead_letters(parsed).collect()
    assert [(r["message_key"], r["raw_value"]) for r in dead] == [("j", '{"a": ')]


def test_open_records_reach_the_explainer_and_both_outputs(spark):
    msgs = spark.createDataFrame([("a", '{"user_id": "a", "ip": "10.0.0.1", "n": {"x": [1]}}'),
                                  ("b", '{"user_id":"b","ip":"refuse", "amount":"n/a"} '), ("c", "{}")],
                                 "key string, value string")

    def explainer(record, prompt):
        if record.get("ip") == "refuse":
            raise ValueError("no")
        return record.get("ip", "none")
    for explain_with in (explainer, None):
        res = explain.explain_flags(payload.parse_flags(msgs), explain_with)
        ok = [json.loads(r["value"]) for r in explain.to_output_payload(explain.explained(res)).collect()]
        bad = [json.loads(r["value"]) for r in explain.to_output_payload(explain.dead_letters(res)).collect()]
        by = {r.get("user_id"): r for r in ok + bad}
        assert by["a"]["ip"] == "10.0.0.1" and by["a"]["n"] == {"x": [1]} and by["b"]["amount"] == "n/a"
        assert by["a"]["status"] == "SUCCESS" and by[None]["status"] == "SUCCESS"
        if explain_with:
            assert by["a"]["llm_explanation"] == "10.0.0.1"
            assert (by["b"]["status"], by["b"]["error"], by["b"]["ip"]) == ("FAILED", "no", "refuse")
