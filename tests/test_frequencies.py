"""Block frequencies after batches in any order, against counts from scratch."""

import random
from collections import Counter

import pytest

from docmill.streaming.frequencies import BlockFrequencies

FIELDS = "doc long, markdown_content string"


def scratch(spark, latest):
    """Documents by block, counted over the last versions."""
    return Counter(line for text in latest.values() for line in {x.strip() for x in (text or "").split("\n")} if line)


def counted(kept):
    return sorted((r["n_docs"] for r in kept.frequencies().collect()), reverse=True)


@pytest.mark.parametrize("seed", range(2))
def test_any_order_of_batches_gives_the_counts_of_the_last_versions(spark, tmp_path, seed):
    draw = random.Random(seed)
    kept, latest = BlockFrequencies(spark, f"{tmp_path}/f"), {}
    for batch in range(4):
        rows = {draw.randrange(8): draw.choice([None, "", *["\n".join(draw.choices("abcdef", k=draw.randrange(1, 5))) for _ in range(6)]]) for _ in range(5)}
        latest |= rows
        kept.take(spark.createDataFrame(list(rows.items()), FIELDS), batch)
        assert counted(kept) == sorted(scratch(spark, latest).values(), reverse=True)
    assert kept.documents() == len(latest)
    before = counted(kept)
    kept.take(spark.createDataFrame(list(rows.items()), FIELDS), batch)  # the same batch again
    assert counted(kept) == before and counted(BlockFrequencies(spark, f"{tmp_path}/f")) == before


def test_stream_of_a_growing_folder(spark, tmp_path):
    kept = BlockFrequencies(spark, f"{tmp_path}/f")
    for part in ([(1, "a\nb"), (2, "a"), (None, "z")], [(2, "b"), (3, "b\nb"), (3, "a")]):
        spark.createDataFrame(part, FIELDS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        kept.follow(spark.readStream.schema(FIELDS).parquet(f"{tmp_path}/in"), f"{tmp_path}/mark").awaitTermination()
    assert counted(kept) == [3, 1] and kept.documents() == 3
    assert kept.repeated(3, 1).head()["percent"] == 100
