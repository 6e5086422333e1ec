"""What the jobs share: configuration files, counted writes, sessions of the command line."""

from __future__ import annotations

import json
import logging
from collections.abc import Callable
from dataclasses import fields
from pathlib import Path
from typing import TypeVar

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from docmill.session import get_session

log = logging.getLogger("jobs")
C = TypeVar("C")


def configured(kind: type[C], path: str | None) -> C:
    """A configuration from a JSON file beside the command line; what the file leaves out keeps its default."""
    given = json.loads(Path(path).read_text()) if path else {}
    if unknown := set(given) - {f.name for f in fields(kind)}:
        raise ValueError(f"{path}: unknown settings {', '.join(sorted(unknown))}")
    return kind(**{k: tuple(v) if isinstance(v, list) else v for k, v in given.items()})


def write(df: DataFrame, path: str, partition: tuple[str, ...] = (), dynamic: bool = False, form: str = "parquet") -> int:
    """Overwrites a folder (with dynamic, only the partitions that df has) and returns the rows written.

    The partitions of df are rebalanced by the columns of the folder, so that a large one is written by many tasks and a
    small one by one.
    """
    seen = Observation()
    rows = df.hint("rebalance", *partition) if partition else df
    out = rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    out.partitionBy(*partition).format(form).save(path)
    n = seen.get["rows"]
    log.info("wrote %d rows to %s", n, path)
    return n


def command(name: str, run: Callable[[SparkSession], object]) -> None:
    """Runs a job in a session of its own."""
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = get_session(name)
    try:
        run(spark)
    finally:
        spark.stop()
