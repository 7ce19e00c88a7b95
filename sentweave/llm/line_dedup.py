"""Line dedup with levelled sorted runs of line hashes (DataFrame functions only).

A run is a table of 128-bit line hashes with the number of documents that hold the line, bucketed by the hash and sorted
within each bucket. A new batch counts its own hashes, merge-anti-joins them with those that the runs have settled (at or
beyond the limit already), and adds the rest as a run of level 0. ``fanout`` runs of one level are merged into one run of
the next, as in a log-structured merge tree, so that a hash is rewritten once a level. All runs have the same buckets,
one sorted file each, so these joins read them as they lie: no shuffle and no sort on their side.

The runs lie in a folder with a manifest, one generation a file, that says which runs there are. A job that is started again, or
another one later, opens the folder and goes on from its last complete generation.

The frequent lines are applied in one pass over the documents, which aren't shuffled: up to ``BROADCAST_ROWS`` hashes are
handed to the tasks as an array of small slots. Beyond, the lines are joined to them by a shuffle.
"""

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentweave.functions.text import bind
from sentweave.llm.common import ascii_lower, file_names, free, materialise, put_text, remove, row_key, shared_dir, text_of, without

BLANKS = " \t\n\x0b\x0c\r"
#: Frequent lines are handed to the tasks up to so many (two longs each); beyond, they are joined by a shuffle.
BROADCAST_ROWS = 500_000
H = ["h1", "h2"]
_ORDERED = "spark.sql.legacy.bucketedTableScan.outputOrdering"


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def hashes(key: Column) -> list[Column]:
    """Two independent 64-bit hashes: of the key, and of the key after a fixed first value (another seed)."""
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(7), key).alias("h2")]


@contextmanager
def _in_order(spark: SparkSession) -> Iterator[None]:
    """Within the block, plans know that a bucket of one file is sorted."""
    before = spark.conf.get(_ORDERED, "false")
    spark.conf.set(_ORDERED, "true")
    try:
        yield
    finally:
        spark.conf.set(_ORDERED, before)


class LineRuns:
    """The runs of a corpus that grows by batches; ``path`` is their folder, opened again if it has runs already."""

    def __init__(self, spark: SparkSession, path: str | None = None, min_docs: int = 10, min_chars: int = 1, fanout: int = 2, buckets: int | None = None):
        self.spark, self.path = spark, path or f"{shared_dir(spark)}/sentweave/lines-{uuid.uuid4().hex}"
        self.min_docs, self.min_chars, self.fanout = min_docs, min_chars, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.generation = 0
        if old := [n for n in file_names(spark, self.path) if n.startswith("manifest-") and n.endswith(".json")]:
            said = json.loads(spark.read.text(f"{self.path}/{old[-1]}", wholetext=True).first()[0])
            self.generation, self.levels, self.buckets = said["generation"], said["levels"], said["buckets"]
            if said["min_chars"] != min_chars or said["min_docs"] != min_docs:
                raise ValueError(f"the runs in {self.path} were made with min_docs={said['min_docs']} and min_chars={said['min_chars']}")

    def runs(self) -> list[str]:
        return [run for level in self.levels for run in level]

    def _table(self, run: str) -> DataFrame:
        """A run as a bucketed table; a session that doesn't know it yet learns where it lies."""
        name = f"sentweave_{run}"
        if not self.spark.catalog.tableExists(name):
            self.spark.sql(f"CREATE TABLE {name} (h1 BIGINT, h2 BIGINT, n BIGINT) USING parquet CLUSTERED BY (h1, h2) SORTED BY (h1, h2) INTO {self.buckets} BUCKETS LOCATION '{self.path}/{run}'")
        return self.spark.table(name)

    def _write(self, rows: DataFrame) -> str:
        """A run of rows that are dealt by the hash into as many parts as there are buckets: one file a bucket."""
        run = f"run_{uuid.uuid4().hex}"
        with _in_order(self.spark):
            rows.select(*H, "n").write.format("parquet").option("path", f"{self.path}/{run}").bucketBy(self.buckets, *H).sortBy(*H).saveAsTable(f"sentweave_{run}")
        return run

    def _commit(self, levels: list[list[str]]) -> None:
        """The next generation; runs that it doesn't name any more go."""
        gone = [r for r in self.runs() if r not in {x for level in levels for x in level}]
        self.generation, self.levels = self.generation + 1, levels
        said = {"generation": self.generation, "levels": levels, "buckets": self.buckets, "min_docs": self.min_docs, "min_chars": self.min_chars}
        put_text(self.spark, f"{self.path}/manifest-{self.generation:08d}.json", json.dumps(said))
        self._drop(gone)

    def _drop(self, runs: list[str]) -> None:
        for run in runs:
            self.spark.sql(f"DROP TABLE IF EXISTS sentweave_{run}")
        remove(self.spark, *[f"{self.path}/{run}" for run in runs])

    def counted(self, docs: DataFrame, text: str = "text", *by: Column) -> DataFrame:
        """Line hashes of the documents and how many documents (rows) hold each, for each value of ``by``."""
        keys = F.filter(F.array_distinct(F.transform(lines_of(text_of(docs, text)), line_key)), lambda k: F.length(k) >= self.min_chars)
        lines = docs.select(*by, F.explode(keys).alias("key"))
        names = lines.columns[:-1]
        return lines.select(*names, *hashes(F.col("key"))).groupBy(*names, *H).agg(F.count(F.lit(1)).alias("n"))

    def add(self, docs: DataFrame, text: str = "text") -> None:
        """Count a batch's lines and add them as a run."""
        counted, path = materialise(self.counted(docs, text), "line-counts")  # a line of many documents is summed up before it moves
        self.add_counted(counted)
        remove(self.spark, path)

    def add_counted(self, counted: DataFrame) -> None:
        """Add a batch that has been counted, ``(h1, h2, n)``, each hash once; full levels are compacted."""
        with _in_order(self.spark):
            counted = counted.repartition(self.buckets, *H)
            for run in self.runs():
                counted = counted.join(self._table(run).filter(F.col("n") >= self.min_docs).hint("merge"), H, "left_anti")
            fresh = self._write(counted)
        levels = [list(level) for level in self.levels] or [[]]
        levels[0].append(fresh)
        level, stale = 0, []
        while len(levels[level]) >= self.fanout:
            if len(levels) == level + 1:
                levels.append([])
            levels[level + 1].append(self._compacted(levels[level]))
            stale += levels[level]
            levels[level] = []
            level += 1
        self._commit(levels)
        self._drop([r for r in stale if r not in self.runs()])

    def _merged(self, runs: list[str]) -> DataFrame:
        """Runs as one: their buckets are merged pairwise, in order."""
        add = lambda a, b: a.join(b.withColumnRenamed("n", "m").hint("merge"), H, "full").select(*H, (F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))).alias("n"))
        return reduce(add, map(self._table, runs))

    def _compacted(self, runs: list[str]) -> str:
        with _in_order(self.spark):
            return self._write(self._merged(runs))

    def frequent(self) -> DataFrame:
        """Hashes of the lines that at least ``min_docs`` documents hold."""
        if not self.runs():
            return self.spark.createDataFrame([], "h1 bigint, h2 bigint")
        with _in_order(self.spark):
            found, path = materialise(self._merged(self.runs()).filter(F.col("n") >= self.min_docs).select(*H), "frequent-lines")
        return found

    def apply(self, docs: DataFrame, text: str = "text", id_col: str = "doc_id", most: int = BROADCAST_ROWS) -> DataFrame:
        """``docs`` without the lines that are frequent; adds ``n_lines``, ``n_dropped`` and replaces ``text``."""
        frequent = self.frequent()
        n = frequent.count()
        return _without_lines(docs, frequent, n, self.min_chars, text) if n <= most else self._joined(docs, frequent, text, id_col)

    def _joined(self, docs: DataFrame, frequent: DataFrame, text: str, id_col: str) -> DataFrame:
        k1, k2, gone, made = free(docs, "k1", "k2", "gone", "made")
        key = row_key(docs, id_col, text)
        lines = docs.select(key[0].alias("k1"), key[1].alias("k2"), F.posexplode(lines_of(text_of(docs, text))).alias("i", "line")).withColumn("key", line_key(F.col("line")))
        lines = lines.filter(F.length("key") >= self.min_chars).select("k1", "k2", "i", *hashes(F.col("key")))
        found = lines.join(frequent, H, "left_semi").groupBy(F.col("k1").alias(k1), F.col("k2").alias(k2)).agg(F.collect_set("i").alias(gone))
        joined = docs.withColumn(k1, key[0]).withColumn(k2, key[1]).join(found, [k1, k2], "left")

        def rest(lines: Column) -> Column:
            stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.coalesce(F.col(gone), F.array().cast("array<int>")))
            return F.struct(F.size(lines).alias("n"), F.size(stay).alias("m"), F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n").alias("text"))

        return _finished(joined.withColumn(made, bind(lines_of(text_of(joined, text)), rest)), docs, made, text)


def _without_lines(docs: DataFrame, frequent: DataFrame, n: int, min_chars: int, text: str) -> DataFrame:
    """Each document's lines are looked up where they are, in slots that every task gets: no row moves."""
    made, known_lines = free(docs, "made", "known_lines")
    count = 1 << max(0, (n // 4).bit_length())
    slot = lambda h: h.bitwiseAND(F.lit(count - 1)).cast("int")
    full = frequent.groupBy(slot(F.col("h1")).alias("slot")).agg(F.collect_list(F.struct(*H)).alias("own"))
    every = docs.sparkSession.range(count).select(F.col("id").cast("int").alias("slot")).join(full, "slot", "left")
    slots = every.agg(F.transform(F.array_sort(F.collect_list(F.struct("slot", F.coalesce("own", F.array().cast("array<struct<h1:bigint,h2:bigint>>")).alias("own")))), lambda x: x["own"]).alias("slots")).scalar()
    told = docs.withColumn(known_lines, slots)  # the optimiser puts this constant where it is used: it is never part of a row

    def stays(key: Column) -> Column:
        known = lambda h: F.exists(F.get(F.col(known_lines), slot(h["h1"])), lambda x: (x["h1"] == h["h1"]) & (x["h2"] == h["h2"]))
        return (F.length(key) < min_chars) | ~bind(F.struct(*hashes(key)), known)

    def rest(lines: Column) -> Column:
        shown = lambda stay: F.struct(F.size(lines).alias("n"), F.size(stay).alias("m"), F.array_join(stay, "\n").alias("text"))
        return bind(F.filter(lines, lambda x: bind(line_key(x), stays)), shown)

    return _finished(told.withColumn(made, bind(lines_of(text_of(docs, text)), rest)), docs, made, text)


def _finished(judged: DataFrame, docs: DataFrame, made: str, text: str) -> DataFrame:
    own = [judged[f"`{c}`"] for c in docs.columns if c.lower() not in (text.lower(), "n_lines", "n_dropped")]
    part = lambda c: judged[f"`{made}`"][c]
    return judged.select(*own, part("text").alias(text), part("n").cast("bigint").alias("n_lines"), (part("n") - part("m")).cast("bigint").alias("n_dropped"))


def drop_repeated_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, batches: int = 4, fanout: int = 2, text: str = "text", id_col: str = "doc_id", most: int = BROADCAST_ROWS) -> DataFrame:
    """``docs`` without the lines whose key at least ``min_docs`` documents hold; see :class:`LineRuns`.

    One pass counts the lines of all batches (dealt by a hash of the id), which then go into the runs one by one; a second
    pass drops. Null and empty texts are one empty line, whose empty key is never frequent, and come back empty; a document
    whose lines all go comes back empty; a repeated row is a document of its own; null ids are ids like any other; an empty
    table gives an empty result; other columns pass through (``n_lines`` and ``n_dropped`` are replaced).
    """
    runs = LineRuns(docs.sparkSession, min_docs=min_docs, min_chars=min_chars, fanout=fanout)
    batch = F.pmod(F.xxhash64(docs[f"`{id_col}`"]), F.lit(batches)).cast("int").alias("batch")
    path = f"{shared_dir(docs.sparkSession)}/sentweave/line-counts-{uuid.uuid4().hex}"
    runs.counted(docs, text, batch).write.partitionBy("batch").parquet(path)
    counted = docs.sparkSession.read.schema("h1 bigint, h2 bigint, n bigint, batch int").parquet(path)
    for b in range(batches):
        runs.add_counted(counted.filter(F.col("batch") == b).drop("batch"))
    remove(docs.sparkSession, path)
    kept = runs.apply(docs, text, id_col, most)
    runs._drop(runs.runs())
    remove(docs.sparkSession, runs.path)
    return kept
