from __future__ import annotations

import pytest
from pyspark.sql import types as T

from tripwire.session import build_session

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def spark():
    yield build_session(master="local[4]", shuffle_partitions=4, app_name="tripwire-tests")


@pytest.fixture
def make_docs(spark):
    def build(rows, extra=()):
        """rows: (doc_id, text[, lang[, source]]); ``extra``: names of string columns holding 'x'."""
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, r[3] if len(r) > 3 else None,
                 None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        from pyspark.sql import functions as F
        for name in extra:
            df = df.withColumn(name, F.lit("x"))
        return df
    return build


@pytest.fixture
def as_tables(tmp_path):
    """Writes frames as <dir>/<name>.parquet and returns the directory."""
    def write(**frames):
        for name, df in frames.items():
            df.write.parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)
    return write


def rows_of_sql(spark, tables, name):
    """Rows of a query's SQL over the tables of a directory, as sorted text."""
    import duckdb

    from llm.queries import llm_oracles

    con = duckdb.connect()
    for path in tables.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}/*.parquet')")
    return sorted(map(repr, con.execute(llm_oracles()[name]).fetchall()))
