"""tripwire: card-transaction fraud analytics on Spark (batch + Structured Streaming).

Every public operator is a plain ``DataFrame -> DataFrame`` function built from
``pyspark.sql.functions``; nothing is collected to the driver.
"""

__version__ = "0.1.0"
