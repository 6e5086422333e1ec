"""Token totals by source, language and tokenizer version, kept up to date by signed changes.

A change is a row of a batch: an insert counts +1 document and its tokens, a delete takes both away, a revision takes
the old tokens away and adds the new ones. Totals are sums, so a batch is folded once, by itself, to one row per group
before it is written, and no earlier batch is read. Partial sums are made before the shuffle; the groups are few and a
hot source costs one row per task.

A batch is written beside the table, then renamed to its name, which exists or does not: a batch that is committed
again, by a repeated job or a lost driver, changes nothing. compact() folds all batches into one that remembers them.
"""

from __future__ import annotations

import re
import uuid
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docmill.llm.tables import shared_dir

KEYS = ["source", "lang", "version"]
INSERT, DELETE, REVISE = "insert", "delete", "revise"
_SCHEMA = "source string, lang string, version string, n_docs long, n_tokens long"


def signed(changes: DataFrame) -> DataFrame:
    """Changes (kind, source, lang, version, tokens, old_tokens) as what they add to a group; a null count is 0.

    insert uses tokens, delete old_tokens, revise both. An unknown or null kind stops the batch. A change counts as often
    as a column `times` says, if there is one; once if it is null.
    """
    times = F.coalesce(F.col("times"), F.lit(1)).cast("long") if "times" in changes.columns else F.lit(1).cast("long")
    new, old = F.coalesce("tokens", F.lit(0)).cast("long"), F.coalesce("old_tokens", F.lit(0)).cast("long")
    kind = F.col("kind")
    known = F.coalesce(kind.isin(INSERT, DELETE, REVISE), F.lit(False))
    docs = F.when(kind == INSERT, 1).when(kind == DELETE, -1).when(known, 0).otherwise(F.raise_error(F.lit("unknown kind of change")).cast("int"))
    tokens = F.when(kind == INSERT, new).when(kind == DELETE, -old).otherwise(new - old)
    return changes.select(*[F.col(k).cast("string").alias(k) for k in KEYS], (docs * times).cast("long").alias("n_docs"), (tokens * times).alias("n_tokens"))


def fold(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))


class TokenCounts:
    """The totals under a path of a file system that all executors share."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(f"{self.path}/batches"))

    def _names(self) -> list[str]:
        return sorted(x.getPath().getName() for x in self._fs.listStatus(self._path(f"{self.path}/batches")))

    def committed(self) -> set[str]:
        """The ids of all batches, those that were compacted included."""
        found = set()
        for name in self._live():
            if name.startswith("fold-"):
                found |= {unquote(x) for x in self._members(name)}
            else:
                found.add(unquote(name.removeprefix("batch-")))
        return found

    def _has(self, batch_id: str) -> bool:
        """Whether a batch of this id is committed; folds are searched by Spark."""
        name = quote(batch_id, safe="")
        if self._fs.exists(self._path(f"{self.path}/batches/batch-{name}")):
            return True
        folds = [n for n in self._live() if n.startswith("fold-")]
        return any(self.spark.read.text(f"{self.path}/batches/{n}/members").where(F.col("value") == name).head(1) for n in folds)

    def _members(self, name: str) -> list[str]:
        rows = self.spark.read.text(f"{self.path}/batches/{name}/members").collect()  # one id per batch
        return [r["value"] for r in rows]

    def _live(self) -> list[str]:
        """Entries that count: the newest fold, and the batches it does not hold."""
        names = self._names()
        folds = sorted((n for n in names if re.fullmatch(r"fold-\d+", n)), key=lambda n: int(n[5:]))
        held = set(self._members(folds[-1])) if folds else set()
        return folds[-1:] + [n for n in names if n.startswith("batch-") and n.removeprefix("batch-") not in held]

    def _publish(self, staged: str, name: str) -> bool:
        """Renames a finished folder to its name; false if the name was taken meanwhile."""
        target = self._path(f"{self.path}/batches/{name}")
        if not self._fs.exists(target) and self._fs.rename(self._path(staged), target):
            # a rename onto a folder that another writer made in between would nest; then the first one counts
            nested = self._path(f"{self.path}/batches/{name}/{staged.rsplit('/', 1)[-1]}")
            if not self._fs.exists(nested):
                return True
            self._fs.delete(nested, True)
            return False
        self._fs.delete(self._path(staged), True)
        return False

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Adds a batch; false, and nothing changes, if a batch of this id is there. An empty batch is a batch."""
        if self._has(batch_id):
            return False
        staged = f"{self.path}/staged-{uuid.uuid4().hex}"
        fold(signed(changes)).write.parquet(f"{staged}/rows")
        return self._publish(staged, "batch-" + quote(batch_id, safe=""))

    def totals(self) -> DataFrame:
        """source, lang, version, n_docs, n_tokens of groups that hold documents or tokens; nulls are groups of their own."""
        paths = [f"{self.path}/batches/{n}/rows" for n in self._live()]
        rows = self.spark.read.schema(_SCHEMA).parquet(*paths) if paths else self.spark.createDataFrame([], _SCHEMA)
        return fold(rows).where("n_docs <> 0 OR n_tokens <> 0")

    def compact(self) -> None:
        """Folds all batches into one; a crash before its last rename leaves the batches as they are."""
        live = self._live()
        if not live:
            return
        staged = f"{self.path}/staged-{uuid.uuid4().hex}"
        self.totals().write.parquet(f"{staged}/rows")
        members = sorted(x for n in live for x in (self._members(n) if n.startswith("fold-") else [n.removeprefix("batch-")]))
        self.spark.createDataFrame([(m,) for m in members], "value string").coalesce(1).write.text(f"{staged}/members")
        number = max([0, *(int(n[5:]) for n in live if n.startswith("fold-"))]) + 1
        if self._publish(staged, f"fold-{number}"):
            for n in live:
                self._fs.delete(self._path(f"{self.path}/batches/{n}"), True)


def rollup(totals: DataFrame) -> DataFrame:
    """Totals at every level: all, by version, by version and source, and by all three; `level` says which."""
    sets = [("all", []), ("version", ["version"]), ("source", ["version", "source"]), ("lang", KEYS)]
    levels = F.explode(F.array(*[F.struct(F.lit(n).alias("level"), *[(F.col(k) if k in own else F.lit(None).cast("string")).alias(k) for k in KEYS]) for n, own in sets]))
    return totals.select(levels.alias("g"), "n_docs", "n_tokens").groupBy("g.level", *[f"g.{k}" for k in KEYS]).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))


def op9_token_counts(spark, sf_dir: str) -> DataFrame:
    """All documents: loaded under two tokenizer versions, copies deleted, one version revised, and one batch sent twice.

    Of equal texts one row stays, that of the least doc_id (null ids last), then of the least source and language (nulls
    first). A null text is an empty one. Repeated rows are copies; null sources and languages are groups of their own.
    An empty table gives an empty table.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = docs.select(
        "doc_id", "source", "lang", F.sha2(text, 256).alias("key"),
        F.size(F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).cast("long").alias("words"),
        F.size(F.regexp_extract_all(text, F.lit(r"[A-Za-z0-9]+"), F.lit(0))).cast("long").alias("runs"),
        F.ceil(F.char_length(text) / 4).cast("long").alias("quarters"),
    )
    from docmill.llm.tables import stored

    sized = stored(sized)
    # equal texts of one source and language are one row, so the most frequent text is a row for each of these
    counts = ("words", "runs", "quarters")
    alike = sized.groupBy("key", "source", "lang").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id")).alias("first"), *[F.min(c).alias(c) for c in counts])
    stays = F.row_number().over(Window.partitionBy("key").orderBy("first", "source", "lang")) == 1
    alike = stored(alike.withColumn("stays", stays))
    copies = alike.withColumn("times", F.col("n") - F.col("stays").cast("long")).where("times > 0")
    row = lambda kind, version, new, old: [F.lit(kind).alias("kind"), "source", "lang", F.lit(version).alias("version"), new.alias("tokens"), old.alias("old_tokens")]
    none = F.lit(None).cast("long")
    loads = {v: sized.select(*row(INSERT, v, F.col(v), none)) for v in ("words", "quarters")}
    counts = TokenCounts(spark, f"{shared_dir(spark)}/docmill-counts-{uuid.uuid4().hex}")
    counts.commit("load words", loads["words"])
    counts.commit("load quarters", loads["quarters"])
    counts.commit("delete copies", copies.select(*row(DELETE, "words", none, F.col("words")), "times").unionByName(copies.select(*row(DELETE, "quarters", none, F.col("quarters")), "times")))
    counts.compact()
    counts.commit("revise words", alike.where("stays").select(*row(REVISE, "words", F.col("runs"), F.col("words"))))
    counts.commit("load words", loads["words"])
    return rollup(counts.totals())


ORACLE = r"""
WITH sized AS (
    SELECT source, lang, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id NULLS LAST, source NULLS FIRST, lang NULLS FIRST) AS turn
    FROM documents
), counted AS (
    SELECT source, lang,
           CAST(len(regexp_extract_all(s.text, '[A-Za-z0-9]+')) AS BIGINT) AS runs,
           CAST(ceil(length(s.text) / 4.0) AS BIGINT) AS quarters
    FROM sized s WHERE turn = 1
), rows_ AS (
    SELECT source, lang, 'words' AS version, runs AS tokens FROM counted
    UNION ALL SELECT source, lang, 'quarters' AS version, quarters AS tokens FROM counted
)
SELECT 'all' AS level, NULL::VARCHAR AS source, NULL::VARCHAR AS lang, NULL::VARCHAR AS version, count(*) AS n_docs, CAST(sum(tokens) AS BIGINT) AS n_tokens FROM rows_ HAVING count(*) > 0
UNION ALL SELECT 'version', NULL, NULL, version, count(*), CAST(sum(tokens) AS BIGINT) FROM rows_ GROUP BY version
UNION ALL SELECT 'source', source, NULL, version, count(*), CAST(sum(tokens) AS BIGINT) FROM rows_ GROUP BY version, source
UNION ALL SELECT 'lang', source, lang, version, count(*), CAST(sum(tokens) AS BIGINT) FROM rows_ GROUP BY version, source, lang
"""
