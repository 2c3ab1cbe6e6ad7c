"""Command-line entry: run the scoring pipeline or the explainer job.

    spark-submit riskflow/app.py pipeline --checkpoint s3a://.../ck \
        --bootstrap broker:9092 --registry s3a://.../registry.json
    spark-submit riskflow/app.py explainer --checkpoint s3a://.../ck-explain \
        --bootstrap broker:9092 --explainer mypkg.mod:explain
    spark-submit riskflow/app.py produce --checkpoint s3a://.../ck \
        --bootstrap broker:9092 --table s3a://.../transactions.parquet

Without ``--bootstrap`` topics are folders under ``--topic-root`` (parquet
parts).  Master, resources and log level come from spark-submit, not from
here; ``--checkpoint`` must be a folder every executor and the driver share.
"""

from __future__ import annotations

import argparse
import importlib
import os
import sys
import time
from dataclasses import replace

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskflow import schemas  # noqa: E402
from riskflow.config import DEFAULT  # noqa: E402


#: Bounds of a micro-batch unless --max-per-trigger says otherwise.
MAX_OFFSETS, MAX_FILES = 5_000_000, 1000
#: Poll of the explainer.
EXPLAIN_TRIGGER = "2 seconds"


def _topic(args, name):
    from riskflow.sources.topic import FileTopic, KafkaTopic
    if args.bootstrap:
        options = dict(o.split("=", 1) for o in args.kafka_option)
        return KafkaTopic(args.bootstrap, name, options)
    if not args.topic_root:
        raise SystemExit("give --bootstrap or --topic-root")
    return FileTopic(args.topic_root, name)


def _stream(args, spark, topic):
    """The topic as a stream whose micro-batches are bounded, the first one too."""
    if args.bootstrap:
        return topic.read_stream(spark, max_per_trigger=args.max_per_trigger or MAX_OFFSETS,
                                 min_partitions=args.min_partitions, fail_on_data_loss=args.fail_on_data_loss)
    return topic.read_stream(spark, max_files_per_trigger=args.max_per_trigger or MAX_FILES)


def _load(spec: str | None):
    if not spec:
        return None
    mod, _, fn = spec.partition(":")
    return getattr(importlib.import_module(mod), fn)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="riskflow")
    ap.add_argument("job", choices=["pipeline", "explainer", "produce"])
    ap.add_argument("--checkpoint", required=True)
    ap.add_argument("--bootstrap")
    ap.add_argument("--kafka-option", action="append", default=[], metavar="KEY=VALUE",
                    help="passed to Kafka reads and writes, e.g. kafka.security.protocol=SSL")
    ap.add_argument("--fail-on-data-loss", action="store_true",
                    help="Kafka: stop at a gap in the offsets (the default, as the reference's, goes on)")
    ap.add_argument("--max-per-trigger", type=int,
                    help="bound of a micro-batch: Kafka offsets, or files of a file topic "
                         f"(default {MAX_OFFSETS} offsets, {MAX_FILES} files)")
    ap.add_argument("--topic-root")
    ap.add_argument("--raw-topic", default=DEFAULT.raw_topic)
    ap.add_argument("--flag-topic", default=DEFAULT.flagged_topic)
    ap.add_argument("--explained-topic", default=DEFAULT.explained_topic)
    ap.add_argument("--dlq-topic", default=DEFAULT.dlq_topic)
    ap.add_argument("--registry", help="registry table (JSON lines: subject, version, schema_id, schema)")
    ap.add_argument("--subject", default=DEFAULT.registry_subject)
    ap.add_argument("--reject-topic", help="decode PERMISSIVE and send undecodable raw messages here")
    ap.add_argument("--trigger", help=f"default {DEFAULT.flag_trigger}; explainer {EXPLAIN_TRIGGER}")
    ap.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    ap.add_argument("--console", action="store_true", help="also print window features and flags")
    ap.add_argument("--rocksdb", action="store_true", help="keep window state in RocksDB")
    ap.add_argument("--state-partitions", type=int, help="width of the window state (fixed per checkpoint)")
    ap.add_argument("--min-partitions", type=int,
                    help="Kafka: split offset ranges into at least this many tasks per batch")
    ap.add_argument("--explainer", help="module:function taking (record, prompt) -> text")
    ap.add_argument("--table", help="produce: parquet table of transactions (epoch-ms timestamp)")
    ap.add_argument("--events-dir", help="produce: a folder with events.parquet (fixture mapping)")
    ap.add_argument("--schema-id", type=int, default=1, help="produce: schema id written in the header")
    ap.add_argument("--max-tasks", type=int, help="tasks calling the explainer at once")
    ap.add_argument("--concurrency", type=int, default=DEFAULT.explain_batch_size,
                    help="explainer calls at once in each task")
    args = ap.parse_args(argv)

    from pyspark.sql import SparkSession
    spark = SparkSession.builder.appName("riskflow fraud scoring").getOrCreate()
    pause = args.trigger or (EXPLAIN_TRIGGER if args.job == "explainer" else DEFAULT.flag_trigger)
    trigger = {"availableNow": True} if args.available_now else {"processingTime": pause}
    ck = args.checkpoint.rstrip("/")

    if args.job == "produce":
        # The load generators' role, as a Spark job over real data: frame and
        # publish every row of a table onto the raw topic.
        from riskflow.operators import ingest
        from riskflow.sources.fixtures import read_transactions
        from riskflow.sources.topic import produce
        if bool(args.table) == bool(args.events_dir):
            raise SystemExit("produce needs exactly one of --table or --events-dir")
        tx = (spark.read.schema(schemas.TRANSACTION).parquet(args.table) if args.table
              else read_transactions(spark, args.events_dir))
        produce(ingest.to_wire(tx, schema_id=args.schema_id), _topic(args, args.raw_topic),
                part=f"produce-{int(time.time() * 1000)}")
        return

    if args.job == "pipeline":
        from riskflow.sources import registry
        from riskflow.streaming.pipeline import start_pipeline, use_rocksdb_state
        from riskflow.streaming.sinks import ConsoleSink, TopicSink
        if args.rocksdb:
            use_rocksdb_state(spark)
        schema_json, writers = schemas.TRANSACTION_AVRO, None
        if args.registry:
            reg = registry.read_registry(spark, args.registry)
            _, schema_json = registry.latest_schema(reg, args.subject)
            writers = registry.writer_schemas(reg, args.subject)
        raw = _topic(args, args.raw_topic)
        console = ConsoleSink(num_rows=10) if args.console else None
        rejects = TopicSink(_topic(args, args.reject_topic)) if args.reject_topic else None
        p = start_pipeline(_stream(args, spark, raw), TopicSink(_topic(args, args.flag_topic)), ck,
                           DEFAULT, trigger=trigger, feature_sink=console, immediate_sink=console,
                           reject_sink=rejects, state_partitions=args.state_partitions,
                           mode="PERMISSIVE" if rejects else "FAILFAST",
                           schema_json=schema_json, writer_schemas=writers)
    else:
        from riskflow.streaming.explainer import start_explainer
        from riskflow.streaming.pipeline import Pipeline
        from riskflow.streaming.sinks import TopicSink
        q = start_explainer(_stream(args, spark, _topic(args, args.flag_topic)), TopicSink(_topic(args, args.explained_topic)),
                            TopicSink(_topic(args, args.dlq_topic)), ck, _load(args.explainer),
                            replace(DEFAULT, explain_batch_size=args.concurrency), trigger=trigger,
                            max_tasks=args.max_tasks)
        p = Pipeline({q.name: q})

    p.await_termination()


if __name__ == "__main__":
    main()
