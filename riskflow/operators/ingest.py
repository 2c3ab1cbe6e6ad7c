"""Raw topic messages <-> transactions (P1-P6 composed).

``decode_transactions``: strip the 5-byte frame header (native expression),
decode the Avro body, flatten ``transaction.*``.  ``timed_transactions`` adds
event time.  ``to_wire`` is the inverse: transaction rows to keyed, framed
messages (key = user_id, as the generators partition by user).

All narrow: no shuffle, one pass per partition, works on streams.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow import schemas
from riskflow.functions import wire
from riskflow.functions.eventtime import to_event_time
from riskflow.operators import avro

PAYLOAD_COL = "avro_payload"


def decode_transactions(raw: DataFrame, schema_json: str = schemas.TRANSACTION_AVRO,
                        mode: str = "FAILFAST", writer_schemas: dict[int, str] | None = None,
                        value_col: str = "value", columns: list[str] | None = None) -> DataFrame:
    """Framed Avro messages -> the record's columns (null message -> all-null row).

    ``columns``: only these record fields (in record order); the Python
    fallback then skips the other fields instead of building them."""
    decoded = _decoded(raw, schema_json, mode, writer_schemas, value_col, columns, [])
    out = decoded.select("transaction.*")
    if columns is not None:
        out = out.select(*[c for c in out.columns if c in set(columns)])
    return out


def _decoded(raw: DataFrame, schema_json: str, mode: str, writer_schemas: dict[int, str] | None,
             value_col: str, columns: list[str] | None, keep: list[str]) -> DataFrame:
    """``keep`` and the struct ``transaction``."""
    df = raw.select(*keep, wire.strip_header(F.col(value_col)).alias(PAYLOAD_COL),
                    *([wire.schema_id(F.col(value_col)).alias("_schema_id")] if writer_schemas is not None else []))
    return avro.decode(df, PAYLOAD_COL, schema_json, alias="transaction", mode=mode,
                       writer_schemas=writer_schemas,
                       id_col="_schema_id" if writer_schemas is not None else None, keep=keep, fields=columns)


def rejects(raw: DataFrame, schema_json: str = schemas.TRANSACTION_AVRO,
            writer_schemas: dict[int, str] | None = None, value_col: str = "value") -> DataFrame:
    """The messages that PERMISSIVE decoding turns into null rows, as they
    came (key, if there is one, and raw value).  A null message is none."""
    required = next(f.name for f in avro.parse_schema(schema_json) if f.null_branch is None)
    keep = [c for c in ("key", value_col) if c in raw.columns]
    decoded = _decoded(raw, schema_json, "PERMISSIVE", writer_schemas, value_col, [required], keep)
    return decoded.filter(F.col(value_col).isNotNull() & F.col(f"transaction.{required}").isNull()).select(*keep)


def timed_transactions(raw: DataFrame, **kw) -> DataFrame:
    return to_event_time(decode_transactions(raw, **kw))


def to_wire(transactions: DataFrame, schema_json: str = schemas.TRANSACTION_AVRO, schema_id: int = 1) -> DataFrame:
    """Transactions -> (key, value) with value = header + Avro body.  Narrow:
    the tasks are those of the input's scan, which
    ``spark.sql.files.maxPartitionBytes`` and ``minPartitionNum`` split."""
    names = [f.name for f in schemas.TRANSACTION.fields]
    body = avro.encode(transactions.select(*names), schema_json, alias="_body", keep=["user_id"])
    return body.select(F.col("user_id").cast("binary").alias("key"),
                       wire.frame(F.col("_body"), schema_id).alias("value"))
