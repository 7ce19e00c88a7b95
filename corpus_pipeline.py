"""A corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next one.

In every stage null and empty texts are texts without words or lines, repeated rows and null ids are documents of their own
(of repeated rows near_dedup keeps one), an empty table gives an empty result, and all columns pass through under
their own names, whatever they are, up to packing, whose rows are pieces. Ties of near copies go to the least id.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession

from sentweave.llm import decontaminate, line_dedup, packing, simhash, toxicity
from sentweave.llm.common import remove, scratch, shared_dir
from sentweave.llm.queries import tokenizer_path
from sentweave.session import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten documents or more hold go; ``n_chars`` follows the text."""
    from pyspark.sql import functions as F

    kept = line_dedup.drop_repeated_lines(docs, min_docs=10).drop("n_lines", "n_dropped")
    kept = kept.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else kept
    return kept.select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (0.8 of their five-word shingles or more) stays."""
    return simhash.keep_one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark windows go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the kept documents, packed into sequences."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"), end_id=2, max_tokens=4096)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: SQL can't express the toxicity model, the fingerprints or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each keeps lies in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/sentweave/pipeline-{uuid.uuid4().hex}"
    before = None
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove(spark, before)
        before = path
    return docs
