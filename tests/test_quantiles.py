import statistics

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tripwire.operators.quantiles import exact_median


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50).map(lambda x: x / 4)), min_size=0, max_size=40))
def test_exact_median_matches_statistics(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
    got = [r[0] for r in exact_median(df, "x").collect()]
    present = [v for v in values if v is not None]
    if not present:
        assert got == []
    else:
        assert got == [statistics.median(present)]
