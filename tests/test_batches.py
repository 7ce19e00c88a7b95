"""What an Arrow function holds as Python objects at once."""

import pyarrow as pa
from pyspark.sql import functions as F

from sentweave.functions import encoding, japanese
from sentweave.functions.batches import sliced
from sentweave.operators import annotate


def test_slices_are_the_batch_again():
    texts, sizes = pa.array(["x" * 1000, None, ""] * 400), pa.array(range(1200))
    parts = list(sliced(iter([(texts, sizes), (texts[:0], sizes[:0])]), size=10_000, rows=100))
    assert len(parts) > 12 and all(len(t) == len(n) <= 100 and t.nbytes <= 60_000 for t, n in parts)
    assert [t for p, _ in parts for t in p.to_pylist()] == texts.to_pylist() and [n for _, p in parts for n in p.to_pylist()] == sizes.to_pylist()
    assert [len(p) for p in sliced(iter([texts]), size=1, rows=100)] == [1] * 1200


def test_functions_take_slices():
    many = pa.array([b"\xa4\xa2" * 1000] * 3000)
    for work in (encoding._guesses, encoding._unzips):
        parts = list(work(iter([many])))
        assert len(parts) > 4 and sum(map(len, parts)) == 3000
    assert len(list(japanese._over(japanese.sentences_of, japanese._STRINGS)(iter([pa.array(["あ。い。"] * 1100)])))) == 3


def test_rows_of_conll_read_the_analysis_once(spark):
    given = [(1, "1\ta\tb\tX\tY\t_\t0\tR"), (2, ""), (3, None), (4, "1\ta\tb\tX\tY\t_\t0\n2\tb\tc\tX\tY\t_\t1\tR")]
    rows = annotate.conll_rows(spark.createDataFrame(given, "k int, analysis string"), "analysis", "k").collect()
    assert [tuple(r) for r in rows] == [(1, 1, "a", "b", "Y", 0, "R"), (4, 1, "a", "b", "Y", 0, ""), (4, 2, "b", "c", "Y", 1, "R")]
    made = spark.createDataFrame([(1, ["a", "("])], "k int, w array<string>").withColumn("analysis", annotate.tagged_conll(F.col("w"), F.col("w")))
    found = annotate.conll_rows(made, "analysis", "k").select("form", "lemma", "pos")
    assert found._jdf.queryExecution().optimizedPlan().toString().count("arrays_zip") == 1
    assert [tuple(r) for r in found.collect()] == [("a", "a", "a"), ("-LRB-", "-lrb-", "-LRB-")]
