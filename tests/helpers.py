from datetime import datetime, timezone

from riskflow import schemas


def ms(text: str) -> int:
    """'2024-01-01 00:00:10' (UTC) -> epoch milliseconds."""
    return int(datetime.strptime(text, "%Y-%m-%d %H:%M:%S").replace(tzinfo=timezone.utc).timestamp() * 1000)


def tx_row(tid, user, amount, ts_ms, is_fraud=False, category="travel"):
    return (str(tid), user, amount, "USD", "ACME", category, ts_ms, "US", "mobile", is_fraud)


def tx_df(spark, rows):
    """Transactions (epoch-ms timestamp) from ``tx_row`` tuples."""
    return spark.createDataFrame(rows, schemas.TRANSACTION)
