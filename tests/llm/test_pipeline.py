import __spark_entry__ as entry
import corpus_pipeline
from sentweave.llm import common, decontaminate, line_dedup, packing, simhash


def test_each_stage_keeps_the_columns(spark, odd):
    docs = odd.withColumnRenamed("n_lines", "row").withColumnRenamed("_h1", "evidence")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.columns == docs.columns and out.dtypes == docs.dtypes and out.count() > 0, name
        assert stage(spark, docs.limit(0), "/root/testdata/sf0.001").count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "/root/testdata/sf0.001").columns == [n for n in packing.NAMES if n != "task"]


def test_the_stages_in_a_row(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    toxic = corpus_pipeline.STAGES[0][1](spark, docs, sf_dir)
    lines = line_dedup.drop_repeated_lines(toxic, min_docs=10)
    one = simhash.keep_one_of_each(lines)
    clean = decontaminate.decontaminate(one, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    want = {r["doc_id"] for r in clean.select("doc_id").collect()}
    before = set(common._WRITTEN)
    got = corpus_pipeline.run(spark, sf_dir)
    assert {r["doc_id"] for r in got.select("doc_id").collect()} == want and 0 < len(want) < docs.count()
    assert set(common._WRITTEN) == before  # nothing of the stages' own is left


def test_the_entry_has_all_eleven():
    names = entry.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)) and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)
