"""Watermark, restart and supervision behaviour of the streaming queries.

Each input file is one micro-batch (``maxFilesPerTrigger=1``); files get
distinct modification times a few seconds apart so their order is fixed.
"""

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from riskflow import schemas
from riskflow.config import DEFAULT
from riskflow.functions.eventtime import to_event_time
from riskflow.operators import ingest
from riskflow.sources.topic import FileTopic, produce
from riskflow.streaming.pipeline import build_flows, start_pipeline
from riskflow.streaming.sinks import MemorySink, TableSink, TopicSink
from tests.helpers import ms, tx_row

DAY = "2024-01-01"


def _write_files(folder, batches, start_mtime=1_700_000_000):
    os.makedirs(folder, exist_ok=True)
    for i, rows in enumerate(batches):
        cols = list(zip(*rows))
        table = pa.table({f.name: pa.array(list(cols[j]), type=_arrow(f))
                          for j, f in enumerate(schemas.TRANSACTION.fields)})
        path = f"{folder}/part-{i:04d}.parquet"
        pq.write_table(table, path)
        os.utime(path, (start_mtime + 10 * i, start_mtime + 10 * i))


def _arrow(field):
    return {"StringType": pa.string(), "DoubleType": pa.float64(), "LongType": pa.int64(),
            "BooleanType": pa.bool_()}[type(field.dataType).__name__]


def _rows(*items):
    return [tx_row(f"{u}{t}", u, amt, ms(f"{DAY} {t}") if t >= "00" else None) for t, u, amt in items]


def _run_windows(spark, folder, ckpt, name):
    stream = spark.readStream.schema(schemas.TRANSACTION).option("maxFilesPerTrigger", 1).parquet(folder)
    flows = build_flows(stream, DEFAULT, decoded=True)
    q = MemorySink().start(flows.features, name, ckpt, {"availableNow": True})
    q.awaitTermination()
    out = spark.sql(f"SELECT * FROM {name}").select(
        F.date_format("window.start", "HH:mm:ss").alias("s"), F.date_format("window.end", "HH:mm:ss").alias("e"),
        "user_id", "window_amount", "window_count")
    return sorted(tuple(r) for r in out.collect()), q


A = [[("00:00:10", "a", 100.0), ("00:00:40", "a", 200.0)], [("00:06:00", "b", 1.0)]]
A_OUT = sorted([("23:58:30", "00:00:30", "a", 100.0, 1), ("23:59:00", "00:01:00", "a", 300.0, 2),
                ("23:59:30", "00:01:30", "a", 300.0, 2), ("00:00:00", "00:02:00", "a", 300.0, 2),
                ("00:00:30", "00:02:30", "a", 200.0, 1)])


def test_watermark_case_a(spark, scratch):
    _write_files(f"{scratch}/in", [_rows(*b) for b in A])
    out, _ = _run_windows(spark, f"{scratch}/in", f"{scratch}/ck", "wm_a")
    assert out == A_OUT


def test_watermark_case_b_late_row_within_grace(spark, scratch):
    batches = A + [[("00:00:20", "a", 999.0), ("00:03:59", "c", 5.0)]]
    _write_files(f"{scratch}/in", [_rows(*b) for b in batches])
    out, _ = _run_windows(spark, f"{scratch}/in", f"{scratch}/ck", "wm_b")
    assert out == sorted([("23:58:30", "00:00:30", "a", 1099.0, 2), ("23:59:00", "00:01:00", "a", 1299.0, 3),
                          ("23:59:30", "00:01:30", "a", 1299.0, 3), ("00:00:00", "00:02:00", "a", 1299.0, 3),
                          ("00:00:30", "00:02:30", "a", 200.0, 1), ("00:02:00", "00:04:00", "c", 5.0, 1)])


def test_watermark_case_c_late_rows_dropped(spark, scratch):
    batches = A + [[("00:06:01", "b", 1.0)], [("00:00:20", "a", 999.0), ("00:03:59", "c", 5.0)]]
    _write_files(f"{scratch}/in", [_rows(*b) for b in batches])
    out, q = _run_windows(spark, f"{scratch}/in", f"{scratch}/ck", "wm_c")
    assert out == A_OUT
    dropped = [p["stateOperators"][0].get("numRowsDroppedByWatermark", 0) for p in q.recentProgress
               if p["numInputRows"] > 0]
    assert dropped[-1] == 5


def test_restart_from_checkpoint_no_loss_no_duplicates(spark, scratch):
    first = [[("00:00:10", "a", 100.0), ("00:00:40", "a", 200.0)], [("00:06:00", "b", 1.0)]]
    later = [[("00:09:00", "d", 7000.0)], [("00:20:00", "e", 1.0)]]
    raw = FileTopic(scratch, "raw")

    def publish(batches, offset):
        for i, b in enumerate(batches):
            df = spark.createDataFrame(_rows(*b), schemas.TRANSACTION)
            produce(ingest.to_wire(df), raw, part=f"batch-{offset + i:04d}")

    def run(tag):
        p = start_pipeline(raw.read_stream(spark, max_files_per_trigger=1),
                           TopicSink(FileTopic(scratch, "flagged")), f"{scratch}/ck", DEFAULT,
                           trigger={"availableNow": True},
                           immediate_sink=TableSink(f"{scratch}/imm"),
                           feature_sink=TableSink(f"{scratch}/features"), name_suffix=tag)
        p.await_termination()
        return p

    publish(first, 0)
    run("-1")
    n_feat_1 = TableSink(f"{scratch}/features").read(spark).count()
    assert n_feat_1 == 5
    publish(later, 10)
    run("-2")
    imm = [r["transaction_id"] for r in TableSink(f"{scratch}/imm").read(spark).collect()]
    assert sorted(imm) == ["d00:09:00"]
    feats = TableSink(f"{scratch}/features").read(spark)
    assert feats.count() == feats.distinct().count()
    users = {r["user_id"] for r in feats.collect()}
    assert users == {"a", "b", "d"}   # e's windows are still open
    topic = FileTopic(scratch, "flagged").read(spark)
    keys = sorted(bytes(r["key"]).decode() for r in topic.collect())
    assert keys.count("d") == 1 + 4   # one transaction flag + four window flags (velocity 3500)


def test_named_queries_and_failure_is_raised(spark, scratch):
    raw = FileTopic(scratch, "raw")
    produce(spark.createDataFrame([(b"k", b"\x00\x00\x00\x00\x01\x09")], "key binary, value binary"), raw)
    p = start_pipeline(raw.read_stream(spark), TopicSink(FileTopic(scratch, "flagged")), f"{scratch}/ck",
                       DEFAULT, trigger={"availableNow": True}, name_suffix="-bad")
    assert set(p.queries) == {"flagged-immediate-kafka-bad", "flagged-windowed-kafka-bad"}
    with pytest.raises(RuntimeError, match="failed"):
        p.await_termination()
    assert not any(q.isActive for q in p.queries.values())


def test_stream_equals_batch_on_fixture(spark, scratch):
    from riskflow.operators import velocity
    from riskflow.sources.fixtures import read_transactions
    from tests.conftest import SF_SMALL
    tx = read_transactions(spark, SF_SMALL)
    raw = FileTopic(scratch, "raw")
    produce(ingest.to_wire(tx), raw)
    p = start_pipeline(raw.read_stream(spark), TopicSink(FileTopic(scratch, "flagged")), f"{scratch}/ck",
                       DEFAULT, trigger={"availableNow": True},
                       windowed_sink=TableSink(f"{scratch}/win"), name_suffix="-eq")
    p.await_termination()
    streamed = TableSink(f"{scratch}/win").read(spark)
    batch = velocity.flag_windowed(velocity.closed_velocity_features(to_event_time(tx)))
    assert streamed.count() == 862
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_streaming_explainer_routes_and_commits(spark, scratch):
    import json as _json

    from riskflow.operators import explain as ex
    from riskflow.operators import payload as pl
    from riskflow.operators import immediate
    from riskflow.streaming.explainer import start_explainer

    rows = [tx_row("t1", "user-1", 6000.0, ms(f"{DAY} 00:00:01")),
            tx_row("t2", "user-2", 10.0, ms(f"{DAY} 00:00:02"), is_fraud=True),
            tx_row("t3", "user-3", 7000.0, ms(f"{DAY} 00:00:03"))]
    flags = immediate.flag_immediate(to_event_time(spark.createDataFrame(rows, schemas.TRANSACTION)))
    topic = FileTopic(scratch, "flagged")
    topic.write_batch(pl.to_payload(flags), "batch-0")
    topic.write_batch(spark.createDataFrame([("k", '{"a":'), ("k", "[1]")], "key string, value string"), "batch-1")

    def explainer(record, prompt):
        if record["user_id"] == "user-2":
            raise ValueError("refused")
        return "ok " + record["transaction_id"]

    out, dlq = FileTopic(scratch, "explained"), FileTopic(scratch, "dlq")
    q = start_explainer(topic.read_stream(spark, max_files_per_trigger=2), TopicSink(out), TopicSink(dlq),
                        f"{scratch}/ck", explainer, trigger={"availableNow": True}, sleep=lambda s: None)
    q.awaitTermination()
    got = {bytes(r["key"]).decode(): _json.loads(bytes(r["value"]).decode()) for r in out.read(spark).collect()}
    assert set(got) == {"user-1", "user-3"}
    assert got["user-1"]["status"] == "SUCCESS" and got["user-1"]["llm_explanation"] == "ok t1"
    dead = [_json.loads(bytes(r["value"]).decode()) for r in dlq.read(spark).collect()]
    assert sorted(d.get("error") for d in dead) == ["decode: not a JSON object"] * 2 + ["refused"]
    assert sum(p["numInputRows"] for p in q.recentProgress) == 5
    assert ex.STATUS_FAILED in {d["status"] for d in dead}
    observed = [p["observedMetrics"]["explain_input"]["messages"] for p in q.recentProgress
                if p.get("observedMetrics")]
    assert sum(observed) == 5


def test_app_cli_pipeline_then_explainer(spark, scratch):
    import json as _json

    from riskflow import app
    from tests.conftest import SF_SMALL
    root = f"{scratch}/topics"
    app.main(["produce", "--checkpoint", f"{scratch}/ck0", "--topic-root", root, "--events-dir", SF_SMALL])
    assert FileTopic(root, "transactions-raw").read(spark).count() == 1000
    app.main(["pipeline", "--checkpoint", f"{scratch}/ck1", "--topic-root", root, "--available-now"])
    flagged = FileTopic(root, "flagged-transactions").read(spark)
    assert flagged.count() == 214 + 862
    app.main(["explainer", "--checkpoint", f"{scratch}/ck2", "--topic-root", root, "--available-now"])
    explained = FileTopic(root, "explained-transactions").read(spark)
    assert explained.count() == 214 + 862
    first = _json.loads(bytes(explained.first()["value"]).decode())
    assert first["status"] == "SUCCESS" and first["llm_explanation"].startswith("Flagged ")


def test_processing_time_trigger_with_arriving_data(spark, scratch):
    """Default (processing-time) mode: data arriving later is picked up by
    the running queries; ``await_any`` reports a query that dies."""
    raw = FileTopic(scratch, "raw")
    flagged = FileTopic(scratch, "flagged")

    def publish(i, rows):
        df = spark.createDataFrame(_rows(*rows), schemas.TRANSACTION)
        produce(ingest.to_wire(df), raw, part=f"batch-{i:04d}")

    publish(0, [("00:00:10", "a", 6000.0)])
    p = start_pipeline(raw.read_stream(spark), TopicSink(flagged), f"{scratch}/ck", DEFAULT,
                       trigger={"processingTime": "1 second"}, name_suffix="-pt")
    try:
        p.process_all_available()
        publish(1, [("00:05:00", "b", 7000.0)])
        p.process_all_available()
        keys = sorted(bytes(r["key"]).decode() for r in flagged.read(spark).collect())
        assert keys.count("a") == 1 + 4 and keys.count("b") == 1   # b's windows still open
        produce(spark.createDataFrame([(b"k", b"\x00\x00\x00\x00\x01\x09")], "key binary, value binary"),
                raw, part="batch-0002")
        with pytest.raises(Exception):
            p.await_any(timeout=60)
    finally:
        p.stop()
    assert not any(q.isActive for q in p.queries.values())


def test_state_partitions_fixed_for_window_query(spark, scratch):
    raw = FileTopic(scratch, "raw")
    produce(ingest.to_wire(spark.createDataFrame(_rows(("00:00:10", "a", 1.0), ("00:09:00", "b", 1.0)),
                                                 schemas.TRANSACTION)), raw)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    p = start_pipeline(raw.read_stream(spark), TopicSink(FileTopic(scratch, "flagged")), f"{scratch}/ck",
                       DEFAULT, trigger={"availableNow": True}, name_suffix="-sp", state_partitions=3)
    p.await_termination()
    state = f"{scratch}/ck/flagged-windowed-kafka/state/0"
    assert {"0", "1", "2"} <= set(os.listdir(state))
    assert not os.path.exists(f"{state}/3")
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_window_emitted_when_end_equals_watermark(spark, scratch):
    batches = [[("00:00:10", "a", 100.0)], [("00:04:00", "b", 1.0)]]
    _write_files(f"{scratch}/in", [_rows(*b) for b in batches])
    out, _ = _run_windows(spark, f"{scratch}/in", f"{scratch}/ck", "wm_eq")
    # watermark = 00:04:00 - 2 min = 00:02:00: the window ending exactly then is out
    assert [(s, e) for s, e, u, *_ in out if u == "a"] == sorted(
        [("23:58:30", "00:00:30"), ("23:59:00", "00:01:00"), ("23:59:30", "00:01:30"), ("00:00:00", "00:02:00")])


def test_app_cli_with_registry_and_older_writer_schema(spark, scratch):
    """Messages framed with schema id 1 (an older schema without
    device_type) and id 2 (the latest) both decode through the registry."""
    import json as _json

    from riskflow import app
    from riskflow.operators import avro
    from riskflow.sources import registry
    from tests.helpers_avro import encode_body
    old = _json.loads(schemas.TRANSACTION_AVRO)
    old["fields"] = [f for f in old["fields"] if f["name"] != "device_type"]
    new = _json.loads(schemas.TRANSACTION_AVRO)
    new["fields"] = [{**f, "default": "unknown"} if f["name"] == "device_type" else f for f in new["fields"]]
    reg_rows = [{"subject": "transactions-raw-value", "version": 1, "schema_id": 1, "schema": _json.dumps(old)},
                {"subject": "transactions-raw-value", "version": 2, "schema_id": 2, "schema": _json.dumps(new)}]
    spark.createDataFrame(reg_rows, registry.REGISTRY_SCHEMA).write.json(f"{scratch}/registry")
    old_s = avro.parse_schema(_json.dumps(old))
    rec = {"transaction_id": "t1", "user_id": "user-1", "amount": 9000.0, "currency": "USD", "merchant": "m",
           "category": None, "timestamp": ms(f"{DAY} 00:00:05"), "country": "US", "is_fraud": False}
    frames = [(b"user-1", b"\x00\x00\x00\x00\x01" + encode_body(rec, old_s))]
    root = f"{scratch}/topics"
    produce(spark.createDataFrame(frames, "key binary, value binary"), FileTopic(root, "transactions-raw"))
    app.main(["pipeline", "--checkpoint", f"{scratch}/ck", "--topic-root", root, "--available-now",
              "--registry", f"{scratch}/registry"])
    flags = [_json.loads(bytes(r["value"]).decode()) for r in FileTopic(root, "flagged-transactions").read(spark).collect()]
    assert [f["transaction_id"] for f in flags if "transaction_id" in f] == ["t1"]


def test_events_as_a_stream_source(spark, scratch):
    from riskflow.sources.fixtures import stream_transactions
    from tests.conftest import SF_SMALL
    flows = build_flows(stream_transactions(spark, SF_SMALL), DEFAULT, decoded=True)
    q = MemorySink().start(flows.features, "events_stream_w", f"{scratch}/ck", {"availableNow": True})
    q.awaitTermination()
    assert spark.sql("SELECT count(*) FROM events_stream_w").first()[0] == 1152


def test_streaming_explainer_calls_each_flag_once(spark, scratch):
    """Both outputs come from one persisted result: the explainer sees every
    flag exactly once per batch (counted through an accumulator)."""
    from riskflow.operators import immediate
    from riskflow.operators import payload as pl
    from riskflow.streaming.explainer import start_explainer

    rows = [tx_row(f"t{i}", f"user-{i}", 6000.0 + i, ms(f"{DAY} 00:00:0{i}")) for i in range(5)]
    flags = immediate.flag_immediate(to_event_time(spark.createDataFrame(rows, schemas.TRANSACTION)))
    topic = FileTopic(scratch, "flagged")
    topic.write_batch(pl.to_payload(flags), "batch-0")
    calls = spark.sparkContext.accumulator(0)

    def explainer(record, prompt):
        calls.add(1)
        if record["transaction_id"] == "t0":
            raise ValueError("no")
        return "ok"

    q = start_explainer(topic.read_stream(spark), TopicSink(FileTopic(scratch, "out")),
                        TopicSink(FileTopic(scratch, "dlq")), f"{scratch}/ck", explainer,
                        trigger={"availableNow": True})
    q.awaitTermination()
    assert calls.value == 5
    assert FileTopic(scratch, "out").read(spark).count() == 4
    assert FileTopic(scratch, "dlq").read(spark).count() == 1


class _FailOnce(TableSink):
    """A table sink whose first write raises, after other outputs of the
    same batch were already written (a crash in the middle of a batch)."""
    failed = False

    def write_batch(self, df, part):
        if not _FailOnce.failed:
            _FailOnce.failed = True
            raise RuntimeError("simulated crash mid-batch")
        super().write_batch(df, part)


def test_crash_mid_batch_replays_without_duplicates(spark, scratch):
    raw, flagged = FileTopic(scratch, "raw"), FileTopic(scratch, "flagged")
    rows = _rows(("00:00:10", "a", 6000.0), ("00:00:20", "b", 7000.0), ("00:09:00", "c", 1.0))
    produce(ingest.to_wire(spark.createDataFrame(rows, schemas.TRANSACTION)), raw)

    def run(tag, imm_sink):
        return start_pipeline(raw.read_stream(spark), TopicSink(flagged), f"{scratch}/ck", DEFAULT,
                              trigger={"availableNow": True}, name_suffix=tag, immediate_sink=imm_sink)

    _FailOnce.failed = False
    p = run("-crash", _FailOnce(f"{scratch}/imm"))
    with pytest.raises(RuntimeError):
        p.await_termination()
    # the topic already holds batch 0's transaction flags; the row table not
    assert flagged.read(spark).count() >= 2
    p = run("-again", TableSink(f"{scratch}/imm"))
    p.await_termination()
    keys = sorted(bytes(r["key"]).decode() for r in flagged.read(spark).collect())
    assert keys.count("a") == 1 + 4 and keys.count("b") == 1 + 4   # replayed, not duplicated
    imm = sorted(r["transaction_id"] for r in TableSink(f"{scratch}/imm").read(spark).collect())
    assert imm == ["a00:00:10", "b00:00:20"]


def test_app_cli_produce_from_a_table(spark, scratch):
    from riskflow import app
    rows = _rows(("00:00:10", "a", 6000.0), ("00:00:20", "b", 10.0))
    spark.createDataFrame(rows, schemas.TRANSACTION).write.parquet(f"{scratch}/tx")
    app.main(["produce", "--checkpoint", f"{scratch}/ck", "--topic-root", f"{scratch}/topics",
              "--table", f"{scratch}/tx", "--schema-id", "7"])
    msgs = FileTopic(f"{scratch}/topics", "transactions-raw").read(spark)
    back = ingest.decode_transactions(msgs)
    assert sorted(r["transaction_id"] for r in back.collect()) == ["a00:00:10", "b00:00:20"]
    assert {bytes(r["value"])[:5] for r in msgs.collect()} == {b"\x00\x00\x00\x00\x07"}


def test_await_termination_sees_the_second_query_die(spark, scratch):
    """Two continuous queries; the second one fails: raised within seconds, the first is stopped, others are left alone."""
    import time

    from riskflow.streaming.pipeline import Pipeline

    def boom(batch, batch_id):
        raise ValueError("second query broke")
    rate = lambda: spark.readStream.format("rate").load()
    other = rate().writeStream.format("noop").queryName("not-ours").start()
    first = rate().writeStream.format("noop").queryName("first").trigger(processingTime="1 second").start()
    second = rate().writeStream.foreachBatch(boom).queryName("second").trigger(processingTime="1 second").start()
    try:
        began = time.monotonic()
        with pytest.raises(RuntimeError, match="second"):
            Pipeline({"first": first, "second": second}).await_termination(60)
        assert time.monotonic() - began < 30 and not first.isActive and other.isActive
    finally:
        for q in (first, second, other):
            q.stop()


def test_a_clean_stop_of_one_query_leaves_the_others(spark):
    from riskflow.streaming.pipeline import Pipeline
    rate = lambda n: spark.readStream.format("rate").load().writeStream.format("noop").queryName(n).start()
    p = Pipeline({"one": rate("one"), "two": rate("two")})
    try:
        p.queries["one"].stop()
        assert p.await_any(5) and not p.await_termination(1) and p.queries["two"].isActive
    finally:
        p.stop()
    assert p.await_termination(5)


def test_permissive_needs_and_fills_a_reject_sink(spark, scratch):
    raw, flagged, bad = (FileTopic(scratch, n) for n in ("raw", "flagged", "bad"))
    tx = spark.createDataFrame(_rows(("00:00:10", "a", 6000.0)), schemas.TRANSACTION)
    produce(ingest.to_wire(tx), raw)
    cut = b"\x00\x00\x00\x00\x01\x09"
    produce(spark.createDataFrame([(b"k", cut)], "key binary, value binary"), raw, part="batch-0001")
    with pytest.raises(ValueError, match="reject_sink"):
        start_pipeline(raw.read_stream(spark), TopicSink(flagged), f"{scratch}/ck", mode="PERMISSIVE")
    p = start_pipeline(raw.read_stream(spark), TopicSink(flagged), f"{scratch}/ck", trigger={"availableNow": True},
                       mode="PERMISSIVE", reject_sink=TopicSink(bad), name_suffix="-rej")
    p.await_termination()
    assert [(bytes(r["key"]), bytes(r["value"])) for r in bad.read(spark).collect()] == [(b"k", cut)]
    assert flagged.read(spark).count() == 1


def test_topic_options_reach_reads_and_writes():
    from riskflow import app
    from riskflow.sources.topic import MAX_FILE_AGE, KafkaTopic
    t = KafkaTopic("b:9092", "raw", {"kafka.security.protocol": "SSL"})
    read, write = t.read_options(max_per_trigger=5, min_partitions=7, fail_on_data_loss=True), t.write_options()
    assert read == {"kafka.bootstrap.servers": "b:9092", "kafka.security.protocol": "SSL", "subscribe": "raw",
                    "startingOffsets": "earliest", "failOnDataLoss": "true", "maxOffsetsPerTrigger": "5", "minPartitions": "7"}
    assert write == {"kafka.bootstrap.servers": "b:9092", "kafka.security.protocol": "SSL", "topic": "raw"}
    assert FileTopic("/x", "t").read_options(3) == {"maxFileAge": MAX_FILE_AGE, "maxFilesPerTrigger": "3"}

    class Args:
        bootstrap, kafka_option, topic_root = "b:9092", ["kafka.sasl.mechanism=PLAIN", "kafka.x=a=b"], None
        max_per_trigger, min_partitions, fail_on_data_loss = None, None, False
    topic = app._topic(Args, "flags")
    assert topic.options == {"kafka.sasl.mechanism": "PLAIN", "kafka.x": "a=b"}
    asked = {}
    topic.read_stream = lambda spark, **kw: asked.update(kw)
    app._stream(Args, None, topic)
    assert asked["max_per_trigger"] == app.MAX_OFFSETS      # no first batch of the whole backlog


def test_old_files_are_read(spark, scratch):
    raw = FileTopic(scratch, "raw")
    for part, second in (("a", 10), ("b", 20)):
        tx = spark.createDataFrame(_rows((f"00:00:{second}", part, 6000.0)), schemas.TRANSACTION)
        produce(ingest.to_wire(tx), raw, part=part)
    for name in os.listdir(f"{raw.path}/a"):
        os.utime(f"{raw.path}/a/{name}", (1, 1))
    out = []
    q = (raw.read_stream(spark, max_files_per_trigger=1).writeStream.trigger(availableNow=True)
         .option("checkpointLocation", f"{scratch}/ck").foreachBatch(lambda b, i: out.extend(b.collect())).start())
    q.awaitTermination()
    assert len(out) == 2
