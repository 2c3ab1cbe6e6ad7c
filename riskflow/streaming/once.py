"""Flags effectively once over an at-least-once topic.

Producers may publish a flag again after a failure.  A flag names itself: a
transaction flag by its transaction, a window flag by its user and window.
``once`` keeps the first message of each within a horizon of event time
(``dropDuplicatesWithinWatermark``): state holds the flags of that horizon, one
key each, and is freed behind it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow import schemas
from riskflow.operators import payload

#: Longer than any replay is late; flags older than this behind the newest are dropped as late.
HORIZON = "1 day"


def flag_id(flag: DataFrame) -> Column:
    """What makes two messages the same flag; null if the flag does not say."""
    window = F.concat_ws("|", F.lit(payload.SHAPE_WINDOW), F.unix_micros("window.start").cast("string"),
                         F.unix_micros("window.end").cast("string"), F.col("user_id"))
    whole = F.col("window.start").isNotNull() & F.col("window.end").isNotNull() & F.col("user_id").isNotNull()
    return (F.when(F.col("transaction_id").isNotNull(),
                   F.concat_ws("|", F.lit(payload.SHAPE_TRANSACTION), F.col("transaction_id")))
            .when(whole, window))


def flag_time(flag: DataFrame) -> Column:
    """Event time of a flag: its transaction's, or its window's end."""
    return F.coalesce(F.col("timestamp"), F.col("window.end"))


def once(messages: DataFrame, horizon: str = HORIZON) -> DataFrame:
    """Parsed flags of a stream of ``(key, value)`` messages, each once, with
    ``flag_id``.  A message that is no JSON object, or whose flag has no
    identity or no time, cannot be told from its copies and passes as it is."""
    parsed = payload.parse_flags(messages)
    parsed = parsed.withColumns({"flag_id": flag_id(parsed), "flag_time": flag_time(parsed)})
    known = F.col(schemas.CORRUPT_COLUMN).isNull() & F.col("flag_id").isNotNull() & F.col("flag_time").isNotNull()
    first = parsed.filter(known).withWatermark("flag_time", horizon).dropDuplicatesWithinWatermark(["flag_id"])
    return first.unionByName(parsed.filter(~known)).drop("flag_time")
