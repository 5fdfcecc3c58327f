"""Sources: the transaction view over the test tables, payload decode, scans."""

from tripwire.sources.fixture import load_events, load_transactions, transactions_from_events
from tripwire.sources.payload import event_time_parse, json_decode, json_encode, iso_text
from tripwire.sources.scans import fraud_lookback, validated_scan

__all__ = [
    "load_events", "load_transactions", "transactions_from_events",
    "event_time_parse", "json_decode", "json_encode", "iso_text",
    "fraud_lookback", "validated_scan",
]
