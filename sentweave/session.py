"""Session defaults shared by the bench, the tests and the examples."""

import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "sentweave", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC timestamps, adaptive execution and Arrow transfer; ``conf`` adds or overrides settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    } | conf
    return builder.config(map=settings).getOrCreate()


#: Bytes of a table, as its row groups count them, for each task that it is dealt to.
DEALT_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str):
    """A parquet table of the input folder.

    A row group is read by a single task, however many splits Spark makes of its file. A table of fewer row groups than cores is dealt to
    all of them before the work on it begins.
    """
    found = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    groups = row_groups(found, cores)
    return found if len(groups) >= cores else found.repartition(max(cores, -(-sum(groups) // DEALT_BYTES)))


def row_groups(found: DataFrame, most: int) -> list[int]:
    """The uncompressed bytes of the row groups of a parquet table that hold rows, of ``most`` files at most; read from the footers by Hadoop, on any store that Spark reads."""
    spark, sizes = found.sparkSession, []
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    for name in found.inputFiles()[:most]:
        file = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI.create(name)), conf)
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(file)
        try:
            sizes += [g.getTotalByteSize() for g in reader.getRowGroups() if g.getRowCount()]
        finally:
            reader.close()
    return sizes


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, ``spark.checkpoint.dir``; a local session without one gets a temporary folder."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="sentweave-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def unused(df: DataFrame, *names: str) -> list[str]:
    """These names, with underscores added until no column of ``df`` has them."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
