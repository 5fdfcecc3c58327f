"""Wire format: encode, decode, malformed input."""

from tripwire.sources.payload import decode_transactions, json_decode, json_encode
from tests.conftest import ts


def test_round_trip(make_tx):
    tx = make_tx([("USER_00001", "00:00:07.179575", "GROCERY", 163.75, "US"),
                  ("USER_00002", "00:00:08", "TRAVEL", 100.0, "UK")])
    enc = json_encode(tx)
    values = sorted(r["value"] for r in enc.collect())
    assert values[0] == ('{"user_id":"USER_00001","timestamp":"2024-01-01T00:00:07.179575",'
                         '"merchant_category":"GROCERY","amount":163.75,"location":"US"}')
    assert '"timestamp":"2024-01-01T00:00:08"' in values[1]          # no fraction when zero
    back = decode_transactions(json_encode(tx, as_binary=True))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, tx.collect()))


def test_malformed_payloads_become_nulls(spark):
    payloads = spark.createDataFrame([
        ("not json",),
        ('{"user_id":"U","timestamp":"2024-01-01T00:00:00","merchant_category":"X","amount":"12.5","location":"US"}',),
        ('{"user_id":"U","timestamp":"yesterday","merchant_category":"X","amount":1.0,"location":"US"}',),
        ('{"user_id":"U"}',),
        ('{"user_id":"U","timestamp":"2024-01-01T00:00:01.5","amount":2.0}',),
        ('{"user_id":"U","timestamp":"2024-01-01T00:00:02","amount":3.0}',),
    ], "value string")
    raw = json_decode(payloads).collect()
    assert all(v is None for v in raw[0])
    out = decode_transactions(payloads).collect()
    assert out[1]["amount"] is None and out[1]["user_id"] == "U"
    assert out[2]["timestamp"] is None
    assert out[3]["timestamp"] is None and out[3]["amount"] is None
    assert out[4]["timestamp"] == ts("00:00:01.5")
    assert out[5]["timestamp"] == ts("00:00:02")


def test_decode_from_binary_value(spark):
    df = spark.createDataFrame([(bytearray(b'{"user_id":"U","amount":1.0}'),)], "value binary")
    out = decode_transactions(df).select("user_id", "amount").collect()
    assert out[0]["user_id"] == "U" and out[0]["amount"] == 1.0
    assert decode_transactions(df).schema["timestamp"].dataType.typeName() == "timestamp"
