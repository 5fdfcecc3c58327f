from datetime import datetime

from tripwire.functions.formatting import axis_currency, format_currency, format_integer, format_report, run_id


def test_scalar_formats(spark):
    df = spark.createDataFrame([(1234567.891,), (None,), (0.5,), (2500.0,), (999.5,)], "x double")
    got = df.select(format_currency("x").alias("c"), format_integer("x").alias("i"),
                    axis_currency("x").alias("a")).collect()
    assert [r["c"] for r in got] == ["$1,234,567.89", "$0.00", "$0.50", "$2,500.00", "$999.50"]
    assert [r["i"] for r in got] == ["1,234,567", "0", "0", "2,500", "999"]
    assert [r["a"] for r in got] == ["$1.2M", None, "$0", "$2K", "$1000"]


def test_run_id(spark):
    df = spark.createDataFrame([(datetime(2024, 3, 5, 7, 8, 9),)], "t timestamp")
    assert df.select(run_id("t")).first()[0] == "20240305_070809"


def test_report_cells(spark):
    table = spark.createDataFrame([("GROCERY", 150, 12345.5, 82.3, 57), ("TRAVEL", 7, 70.0, 10.0, 3)],
                                  "merchant_category string, fraud_count long, total_amount double, "
                                  "avg_amount double, unique_users long")
    rows = format_report(table, "merchant_category").collect()
    assert rows[0].asDict() == {"Index": "GROCERY", "fraud_count": "150", "total_amount": "$12,345.50",
                                "avg_amount": "$82.30", "unique_users": "57.00"}
    assert rows[1]["fraud_count"] == "7.00"


def test_nan_is_missing(spark):
    from pyspark.sql import functions as F

    from tripwire.functions.formatting import format_currency, format_integer

    row = spark.range(1).select(format_currency(F.lit(float("nan"))), format_integer(F.lit(float("nan"))),
                                format_integer(F.lit(None).cast("double"))).first()
    assert tuple(row) == ("$0.00", "0", "0")
