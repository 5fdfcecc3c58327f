"""Named views so that users can query the streams and tables with SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame


def register_views(fraud: DataFrame, transactions: DataFrame,
                   fraud_name: str = "fraud_view", tx_name: str = "transactions_view") -> None:
    """Session-scoped temp views over the fraud and transaction frames
    (batch or streaming)."""
    fraud.createOrReplaceTempView(fraud_name)
    transactions.createOrReplaceTempView(tx_name)
