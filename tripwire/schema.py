"""Schemas of the pipeline's records."""

from pyspark.sql import types as T

# --- fixed values: wire and table columns -------------------------------------
TX_COLUMNS = ["user_id", "timestamp", "merchant_category", "amount", "location"]
FRAUD_COLUMNS = TX_COLUMNS + ["fraud_reason"]

# Wire schema of one transaction payload: event time travels as ISO-8601 text.
TRANSACTION_WIRE = T.StructType([
    T.StructField("user_id", T.StringType(), False),
    T.StructField("timestamp", T.StringType(), False),
    T.StructField("merchant_category", T.StringType(), False),
    T.StructField("amount", T.DoubleType(), False),
    T.StructField("location", T.StringType(), False),
])

# A parsed transaction.
TRANSACTION = T.StructType([
    T.StructField("user_id", T.StringType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
    T.StructField("merchant_category", T.StringType(), True),
    T.StructField("amount", T.DoubleType(), True),
    T.StructField("location", T.StringType(), True),
])

FRAUD_EVENT = T.StructType(TRANSACTION.fields + [
    T.StructField("fraud_reason", T.StringType(), True),
])

# Fraud table as stored: detection time is processing time, added at the sink.
FRAUD_TABLE = T.StructType(FRAUD_EVENT.fields + [
    T.StructField("detected_at", T.TimestampType(), True),
])

RECONCILIATION_ROW = T.StructType([
    T.StructField("report_date", T.TimestampType(), False),
    T.StructField("total_transactions", T.LongType(), False),
    T.StructField("total_amount", T.DoubleType(), False),
    T.StructField("fraud_count", T.LongType(), False),
    T.StructField("fraud_amount", T.DoubleType(), False),
])

# --- end of fixed values ----------------------------------------------------

# The generator's event table the fixture view is built on.
EVENTS = T.StructType([
    T.StructField("event_id", T.LongType(), True),
    T.StructField("ts", T.TimestampNTZType(), True),
    T.StructField("user_id", T.LongType(), True),
    T.StructField("event_type", T.StringType(), True),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("props", T.StringType(), True),
])
