"""Scale properties of the registered queries, asserted on executed plans:
no joins or broadcasts, no shuffle on path 1, one keyed shuffle per window
aggregation, Python only where it is the point (Avro fallback, explainer)."""

import pytest

from riskflow.plans import catalog
from scripts.show_plans import summarize
from tests.conftest import SF_SMALL

NO_SHUFFLE = {"transactions", "event_time", "score_immediate", "flag_immediate", "payload_immediate",
              "header_fields", "strip_header", "wire_roundtrip", "wire_decode_permissive"}
PYTHON_OK = {"header_fields", "strip_header", "wire_roundtrip", "wire_decode_permissive",
             "explained", "dead_letters", "explain_summary"}
JVM_ONLY_WINDOWS = {"velocity_features", "score_windowed", "flag_windowed", "closed_windows",
                    "flag_windowed_closed", "payload_windowed", "flagged_topic", "explained_template"}


@pytest.fixture(scope="module")
def plans(spark):
    out = {}
    for name, fn in catalog.queries().items():
        if name.startswith("stream_"):
            continue
        out[name] = summarize(fn(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString())
    return out


def test_no_joins_anywhere(plans):
    assert {n: s["joins"] for n, s in plans.items() if s["joins"]} == {}


def test_path1_does_not_shuffle(plans):
    assert {n: plans[n]["exchanges"] for n in NO_SHUFFLE if plans[n]["exchanges"]} == {}


def test_python_only_where_expected(plans):
    assert {n for n, s in plans.items() if s["python"]} <= PYTHON_OK


def test_window_queries_shuffle_once_on_window_and_user(plans):
    for n in JVM_ONLY_WINDOWS:
        keys = plans[n]["hash_keys"]
        assert keys == ["window, user_id"], (n, keys)
        # one keyed exchange plus the single-partition max of the watermark
        assert plans[n]["exchanges"] <= 2, (n, plans[n])


def test_path1_scan_prunes_unused_columns(plans):
    cols = plans["flag_immediate"]["scans"][0][0]
    assert "props" not in cols
    assert plans["velocity_features"]["scans"][0][0] == ["ts", "user_id", "value"]


def test_streaming_queries_plans(spark, scratch):
    """Transaction flags: no shuffle, no state.  Windows: one exchange on
    (window, user_id) and one state store (restore + save)."""
    import re

    from riskflow.config import DEFAULT
    from riskflow.operators import ingest
    from riskflow.sources.fixtures import read_transactions
    from riskflow.sources.topic import FileTopic, produce
    from riskflow.streaming.pipeline import start_pipeline
    from riskflow.streaming.sinks import TopicSink

    raw = FileTopic(scratch, "raw")
    produce(ingest.to_wire(read_transactions(spark, SF_SMALL)), raw)
    p = start_pipeline(raw.read_stream(spark), TopicSink(FileTopic(scratch, "flagged")), f"{scratch}/ck",
                       DEFAULT, trigger={"availableNow": True}, name_suffix="-planprops")
    p.await_termination()
    plans = {n: q._jsq.streamingQuery().lastExecution().executedPlan().toString()
             for n, q in p.queries.items()}
    imm = plans["flagged-immediate-kafka-planprops"]
    win = plans["flagged-windowed-kafka-planprops"]
    assert summarize(imm)["exchanges"] == 0 and "StateStore" not in imm
    s = summarize(win)
    assert s["exchanges"] == 1 and s["joins"] == 0
    assert len(re.findall(r"StateStoreRestore|StateStoreSave", win)) == 2
    assert all("user_id" in k for k in s["hash_keys"])
