"""Tables that cut lineage, kept in the folder that the driver and all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from docmill.llm.textbatch import trim

CODEC = "zstd"
#: Bytes of an Arrow batch on its way to or from Python; Spark's own bound holds tens of megabytes in each task twice.
BATCH = 1 << 22
_BATCH_KEY, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"
_kept: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; a temporary one is set only where it is unset, as in tests."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    made = "file://" + tempfile.mkdtemp(prefix="docmill-")
    spark.sparkContext.setCheckpointDir(made)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


def small_batches(spark: SparkSession) -> None:
    """Bounds Arrow batches by BATCH bytes in this session, unless it has a bound of its own."""
    if spark.conf.get(_BATCH_KEY) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH_KEY, str(BATCH))


def _remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


@atexit.register
def _clean() -> None:
    for spark, path in _kept:
        try:
            _remove(spark, path)
        except Exception:  # noqa: BLE001  the session is gone, and with it the means to delete
            return


class Stored:
    """A table written once; drop() deletes it when its readers have run, else it goes with the session."""

    def __init__(self, df: DataFrame) -> None:
        self.spark = df.sparkSession
        self.path = f"{shared_dir(self.spark)}/docmill-{uuid.uuid4().hex}"
        _kept.append((self.spark, self.path))
        small_batches(self.spark)
        df.write.option("compression", CODEC).parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)
        trim()  # the driver's own memory, between steps
        self.spark.sparkContext._jvm.System.gc()  # the shuffle files of finished steps go with the plans that held them

    def drop(self) -> None:
        _remove(self.spark, self.path)
        _kept.remove((self.spark, self.path))


def stored(df: DataFrame) -> DataFrame:
    """Writes df to the shared folder and returns a reader of it."""
    return Stored(df).df


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
