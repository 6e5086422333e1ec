"""A Spark session with the settings that the engine is tested with; any session with UTC time works."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_session(name: str = "docmill", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


#: Bytes of an Arrow batch on its way to or from Python; Spark's own bound holds tens of megabytes in each task twice.
BATCH = 1 << 22
_BATCH_KEY, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def small_batches(spark: SparkSession) -> None:
    """Bounds Arrow batches by BATCH bytes in this session, unless it has a bound of its own."""
    if spark.conf.get(_BATCH_KEY) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH_KEY, str(BATCH))
