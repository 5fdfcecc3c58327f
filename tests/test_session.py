from tripwire.session import cluster_conf, fresh_path, shared_dir


def test_cluster_conf_scales_with_input():
    small = cluster_conf(10 * 2**30, executor_cores_total=64)
    big = cluster_conf(100 * 2**40, executor_cores_total=8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 128
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * 2**40 // (256 * 2**20)
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_scratch_paths_under_shared_dir(spark):
    root = shared_dir(spark)
    a, b = fresh_path(spark, "x"), fresh_path(spark, "x")
    assert a != b and a.startswith(root.rstrip("/"))


def test_lookback_does_not_follow_the_local_zone(spark):
    """The same rows in every zone of the Python process."""
    import os
    import time
    from datetime import datetime

    from tripwire.sources.scans import as_of_column, lookback

    df = spark.sql("SELECT explode(sequence(timestamp'2024-01-01 00:00:00', timestamp'2024-01-01 20:00:00', interval 1 hour)) AS timestamp")
    before, got = os.environ.get("TZ"), set()
    try:
        for zone in ("America/New_York", "Asia/Tokyo", "UTC"):
            os.environ["TZ"] = zone
            time.tzset()
            for as_of in (datetime(2024, 1, 1, 12), "2024-01-01 12:00:00"):
                got.add(lookback(df, 6, as_of_column(as_of, df)).count())
    finally:
        os.environ.pop("TZ") if before is None else os.environ.update(TZ=before)
        time.tzset()
    assert got == {15}
