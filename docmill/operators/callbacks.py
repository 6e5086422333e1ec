"""Steps that call something outside: fetching pages and asking a language model. The caller gives the function.

Each task calls it for its own rows, one after the other, at a given pace; `tasks` is how many do so at once, so the
whole job calls at most tasks / pause times a second. A call that fails is a row that says so.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.functions.text import without_fence

FETCHED = "url string, html string, status_code int, error string"
# The fields of a generated question and what stands for a missing one; what an exceeded quota says of itself.
MISSING = {"query": "", "expected_topic": "Unknown", "difficulty": "medium"}
QUOTA = ("429", "quota")
CONTENT_TYPE, CATEGORY = "concept", "Auto-Generated"


def paced(call: Callable, pause: float, wait: float, tries: int, again: Callable[[str], bool]) -> Callable:
    """call with a pause after each answer; a failure that `again` accepts is tried anew after `wait` seconds, `tries` times in all."""

    def run(x):
        for k in range(tries):
            try:
                out = call(x)
            except Exception as e:  # noqa: BLE001  whatever the caller's function raises
                if k + 1 == tries or not again(str(e)):
                    raise
                time.sleep(wait)
            else:
                time.sleep(pause)
                return out

    return run


def _answers(rows: DataFrame, column: str, call: Callable, kind: str, arrow: pa.DataType, tasks: int) -> DataFrame:
    """rows with `_answer` and `_error` of the call for each value of the column; a null value is not asked."""
    from pyspark.sql import types as T

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, errors = [], []
            for x in batch.column(column).to_pylist():
                try:
                    found.append(None if x is None else call(x))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001  a failed call is a row
                    found.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            yield batch.append_column("_answer", pa.array(found, arrow)).append_column("_error", pa.array(errors, pa.string()))

    schema = T.StructType([*rows.schema.fields, T.StructField("_answer", T._parse_datatype_string(kind)), T.StructField("_error", T.StringType())])
    return rows.repartition(tasks).mapInArrow(run, schema)


def fetch_pages(urls: DataFrame, fetch: Callable[[str], tuple[int, str]], pause: float = 0.5, tasks: int = 1, url: str = "url") -> DataFrame:
    """url, html, status_code and error of each URL, once each; fetch gives a status and a page. parse_pages() reads the result."""
    kind = pa.struct([("status", pa.int32()), ("html", pa.string())])
    call = paced(lambda x: dict(zip(("status", "html"), fetch(x), strict=True)), pause, 0.0, 1, lambda e: False)
    rows = _answers(urls.select(F.col(url).alias("url")).distinct(), "url", call, "struct<status: int, html: string>", kind, tasks)
    return rows.select("url", F.col("_answer.html").alias("html"), F.col("_answer.status").alias("status_code"), F.col("_error").alias("error"))


def generate_questions(chunks: DataFrame, ask: Callable[[str], str], prompt: str, pause: float = 4.0, wait: float = 45.0, tries: int = 10, tasks: int = 1) -> DataFrame:
    """An evaluation row per chunk (source_url, heading_path, chunk_text): the model's JSON answer to the prompt, in which {text} is the chunk.

    Answers that are no JSON object, and calls that failed, have a null query and say why in `error`. A call over the
    quota is tried again after `wait` seconds.
    """
    call = paced(lambda text: ask(prompt.replace("{text}", text)), pause, wait, tries, lambda e: any(q in e.lower() for q in QUOTA))
    rows = _answers(chunks.select("source_url", "heading_path", "chunk_text"), "chunk_text", call, "string", pa.string(), tasks)

    @F.arrow_udf("struct<query: string, expected_topic: string, difficulty: string, error: string>")
    def read(answers: pa.Array) -> pa.Array:
        out = []
        for a in answers.to_pylist():
            try:
                data = json.loads(a) if a is not None else None
                out.append(data and {k: str(data.get(k, v)) for k, v in MISSING.items()} | {"error": None})
            except (ValueError, AttributeError) as e:
                out.append({"error": f"{type(e).__name__}: {e}"})
        return pa.array(out, pa.struct([*((k, pa.string()) for k in MISSING), ("error", pa.string())]))

    told = rows.withColumn("_read", read(without_fence(F.col("_answer"))))
    return told.select(
        *[F.col(f"_read.{k}").alias(k) for k in MISSING], F.lit(CONTENT_TYPE).alias("expected_content_type"), F.array("source_url").alias("acceptable_documents"),
        F.coalesce("heading_path", F.array().cast("array<string>")).alias("acceptable_headings"), F.lit(CATEGORY).alias("category"), F.coalesce("_error", "_read.error").alias("error"),
    )
