"""Analyses that outlive a run: a table bucketed and sorted by the text's hash, to which each run appends what it had to work out.

Sentences are shuffled into the table's buckets and meet it there; the table itself is never shuffled, however large it has grown.
"""

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentweave.operators.annotate import analyses, wanted
from sentweave.session import unused

BUCKETS = 64
_COLUMNS = ["key", "text", "analysis", "error", "run"]


def _key(text: Column) -> Column:
    return F.xxhash64(text)


class ResultCache:
    """The table ``name`` of ``(key, text, analysis, error, run)``; made with its first run, in ``buckets`` buckets.

    One cache holds the results of one analyser. Failed texts are noted with their run and tried again by the next one.
    """

    def __init__(self, spark: SparkSession, name: str, buckets: int = BUCKETS):
        self.spark, self.name, self.buckets = spark, name, buckets

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def table(self) -> DataFrame:
        """All that is known; empty before the first run."""
        if self.exists():
            return self.spark.table(self.name)
        return self.spark.createDataFrame([], "key bigint, text string, analysis string, error string, run string")

    def _met(self, rows: DataFrame, column: str, how: str, run: str | None = None) -> DataFrame:
        """``rows`` joined to what is known of their texts (failures only of this run), bucket by bucket."""
        known = self.table().filter(F.col("error").isNull() | (F.col("run") == run) if run else F.col("error").isNull())
        key, text, analysis, error = unused(rows, "_key", "_text", "_analysis", "_error")
        known = known.select(F.col("key").alias(key + "k"), F.col("text").alias(text), F.col("analysis").alias(analysis), F.col("error").alias(error))
        keyed = rows.withColumn(key, _key(F.col(column)))
        # equal texts, said so that the hash stays the only join key: the buckets are by it alone
        same = F.col(column).startswith(F.col(text)) & F.col(text).startswith(F.col(column))
        joined = keyed.join(known.hint("merge"), (F.col(key) == F.col(key + "k")) & same, how)
        if how == "left_anti":
            return joined.drop(key)
        return joined.drop(key, key + "k", text).withColumnsRenamed({analysis: "analysis", error: "error"})

    def misses(self, texts: DataFrame, column: str = "text") -> DataFrame:
        """Distinct texts that have no analysis yet."""
        return self._met(texts.select(F.col(column).alias("text")).distinct(), "text", "left_anti")

    def annotate(self, found: DataFrame, name: str = "rules", column: str = "raw_string", condition: Column | None = None, **limits) -> DataFrame:
        """Adds ``analysis`` and ``error`` to the wanted sentences; what isn't known is analysed, once for each text, and appended first.

        A text without an analysis after this run has the error's name; sentences that aren't wanted keep nulls.
        """
        mark, run = unused(found, "wanted")[0], uuid.uuid4().hex
        marked = found.withColumn(mark, F.coalesce(wanted(F.col(column)) if condition is None else condition, F.lit(False)) & F.col(column).isNotNull())
        due = marked.filter(mark).drop(mark)
        new = analyses(self.misses(due, column), name, **limits)
        self._append(new.select(_key(F.col("text")).alias("key"), "text", "analysis", "error", F.lit(run).alias("run")))
        rest = marked.filter(~F.col(mark)).drop(mark)
        return self._met(due, column, "left", run).unionByName(rest, allowMissingColumns=True)

    def _append(self, rows: DataFrame) -> None:
        dealt = rows.select(*_COLUMNS).repartition(self.buckets, "key")
        dealt.write.bucketBy(self.buckets, "key").sortBy("key").mode("append").format("parquet").saveAsTable(self.name)

    def compact(self) -> None:
        """One file a bucket again, failures that have been mended left out; run by nobody else at the same time."""
        done = self.table().filter("error is null").dropDuplicates(["key", "text"])
        fresh = ResultCache(self.spark, f"{self.name}_{uuid.uuid4().hex[:8]}", self.buckets)
        fresh._append(done)
        self.spark.sql(f"DROP TABLE {self.name}")
        self.spark.sql(f"ALTER TABLE {fresh.name} RENAME TO {self.name}")
