"""Incremental runs: new page files as a stream, and a job log that a restart resumes from."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sentweave.operators.corpus import not_done


def page_stream(spark: SparkSession, path: str, schema, max_files: int = 1000) -> DataFrame:
    """Parquet page files as they arrive."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def run_incrementally(pages: DataFrame, process, out: str, log: str, checkpoint: str, key: str = "page_id") -> StreamingQuery:
    """Each batch: pages that the log doesn't name are processed (``process(df)``), written to ``out``, and logged.

    A batch's output and log lie under its number and are written over when it is tried again, so a failure between the two neither
    loses pages nor doubles them. The query ends when no new files are left.
    """

    def batch(df: DataFrame, number: int) -> None:
        earlier = read_log(df.sparkSession, log, df.select(key)).filter(F.col("batch") != number)
        new = not_done(df, earlier, key).dropDuplicates([key])
        process(new).write.mode("overwrite").parquet(f"{out}/batch={number}")
        new.select(key, F.lit("success").alias("status")).write.mode("overwrite").parquet(f"{log}/batch={number}")

    return pages.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_log(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """The job log ``(key, status, batch)``; empty before the first run."""
    schema = keys.schema.add("status", "string").add("batch", "long")
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)
    return spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)
