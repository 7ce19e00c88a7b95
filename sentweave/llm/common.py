"""Helpers that the operators share: the shared folder, materialised tables, row keys and free column names."""

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Tables that ``materialise`` has written in this process and nothing has deleted yet.
_WRITTEN: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, ``spark.checkpoint.dir``.

    Where none is set, a local session gets a temporary one; on a cluster this is an error, because executors can't read
    what others wrote to a machine of their own.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="sentweave-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def materialise(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` as parquet into the shared folder and read it back, so that no executor's loss repeats its work.

    What results still read stays there; a caller who writes them within ``scratch`` leaves nothing behind.
    """
    path = f"{shared_dir(df.sparkSession)}/sentweave/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete materialised tables that no later plan reads."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        if path in _WRITTEN:
            _WRITTEN.remove(path)


def forget_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs now: it does so when the driver collects garbage, by itself every half hour."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is materialised within the block is deleted after it; results must have been written by then."""
    there = set(_WRITTEN)
    try:
        yield
    finally:
        remove(spark, *[p for p in _WRITTEN if p not in there])


@contextmanager
def arrow_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Actions within the block send at most so many rows at once to a Python worker: each batch is held several times, there and in the executor."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows if int(before) <= 0 else min(rows, int(before))))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def broadcast(spark: SparkSession, value: object) -> Iterator:
    """A broadcast variable for actions within the block; freed everywhere afterwards."""
    sent = spark.sparkContext.broadcast(value)
    try:
        yield sent
    finally:
        sent.destroy()


def free(docs: DataFrame, *names: str) -> list[str]:
    """These names, with underscores added until no column of ``docs`` has them: the caller's columns never clash."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def without(docs: DataFrame, *names: str) -> list[Column]:
    """All columns but these, as they stand in ``docs`` (names count without case, as Spark's do)."""
    gone = {n.lower() for n in names}
    return [docs[f"`{c}`"] for c in docs.columns if c.lower() not in gone]


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, everything else as it is; text that is all ASCII takes the faster ``lower``."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def text_of(docs: DataFrame, column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(docs[f"`{column}`"].cast("string"), F.lit(""))


def row_key(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> list[Column]:
    """Two 64-bit hashes that know a row by its id and text; repeated rows share them."""
    own = docs[f"`{id_col}`"]
    parts = [F.coalesce(own.cast("string"), F.lit("")), own.isNull(), text_of(docs, text)]
    return [F.xxhash64(*parts), F.xxhash64(F.lit(7), *parts)]


def put_text(spark: SparkSession, path: str, content: str) -> None:
    """Write a small text file whole: it appears under its name only when it is complete."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target, draft = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    fs = target.getFileSystem(conf)
    out = fs.create(draft)
    out.write(bytearray(content.encode()))
    out.close()
    if not fs.rename(draft, target):
        raise FileExistsError(path)


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none where there is no such folder."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []
