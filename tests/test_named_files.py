"""One file a row, under its name, whole or not at all."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from sentweave.functions import encoding
from sentweave.sources import named_files, readers, writers


def tree(path) -> dict:
    return {str(p.relative_to(path)): p.read_bytes() for p in path.rglob("*") if p.is_file() and not p.name.startswith(".")}


def put(rows, path, mode="append"):
    named_files.write(rows, F.col("s"), F.col("n"), F.col("c"), str(path), mode)


def test_flat_names_in_shards(spark, tmp_path):
    rows = spark.createDataFrame([(f"{i % 3:03d}", f"{i}.xml" + ".gz" * (i % 2), f"text {i} 日本" if i else None) for i in range(60)], "s string, n string, c string")
    put(rows.repartition(7), tmp_path / "out")
    got = tree(tmp_path / "out")
    assert set(got) == {f"{i % 3:03d}/{i}.xml" + ".gz" * (i % 2) for i in range(60)}
    assert gzip.decompress(got["001/1.xml.gz"]).decode() == "text 1 日本" and got["000/0.xml"] == b"" and got["002/2.xml"].decode() == "text 2 日本"
    put(spark.createDataFrame([("001", "new", "x"), ("000", "0.xml", "again")], rows.schema), tmp_path / "out")
    got = tree(tmp_path / "out")
    assert len(got) == 61 and got["001/new"] == b"x" and got["000/0.xml"] == b"again"
    put(spark.createDataFrame([("9", "only", "y")], rows.schema), tmp_path / "out", "overwrite")
    assert tree(tmp_path / "out") == {"9/only": b"y"}
    put(rows.limit(0), f"file://{tmp_path}/none")
    assert tree(tmp_path / "none") == {} and os.listdir(tmp_path / "none") == []


def test_nothing_half_written_after_a_failure(spark, tmp_path):
    rows = spark.range(40).select(F.lit("s").alias("s"), F.format_string("%d", "id").alias("n"), F.when(F.col("id") < 39, "text").otherwise(F.raise_error(F.lit("lost")).cast("string")).alias("c"))
    put(spark.createDataFrame([("s", "old", "kept")], "s string, n string, c string"), tmp_path / "out")
    with pytest.raises(Exception, match="lost"):
        put(rows, tmp_path / "out")
    assert tree(tmp_path / "out") == {"s/old": b"kept"}
    for shard, name in (("a", "../x"), ("", "x"), ("_temporary", "x"), ("a", None), ("..", "x")):
        with pytest.raises(Exception, match="not a name"):
            put(spark.createDataFrame([(shard, name, "c")], "s string, n string, c string"), tmp_path / "out")
    assert tree(tmp_path / "out") == {"s/old": b"kept"}


def test_a_task_that_is_tried_again(tmp_path):
    """A killed attempt leaves files in its own folder only; the commit takes the other attempt's and clears both."""
    import pyarrow as pa

    writer = named_files._Writer(str(tmp_path), False)
    batch = pa.RecordBatch.from_pydict({"shard": ["1", "1"], "name": ["a", "b"], "content": [b"a", b"b"]})
    killed = iter([batch, None])
    with pytest.raises(AttributeError):
        writer.write(killed)
    done = writer.write(iter([batch]))
    assert not (tmp_path / "1").exists()
    writer.commit([done, None])
    assert tree(tmp_path) == {"1/a": b"a", "1/b": b"b"} and os.listdir(tmp_path) == ["1"]


def test_documents_are_read_again_by_name(spark, tmp_path):
    docs = spark.createDataFrame([(i, [("S", f"sentence {i}")] if i % 5 else []) for i in (1, 2, 5, 12_346)], "doc_id bigint, sentences array<struct<sid:string,raw_string:string>>")
    pages = spark.createDataFrame([("p1", "<p>日本</p>"), ("p2", None)], "name string, html string")
    writers.utf8_files(pages, str(tmp_path / "u"), shards=2)
    assert {k.rsplit("/", 1)[1]: v.decode() for k, v in tree(tmp_path / "u").items()} == {"p1.html": "<p>日本</p>", "p2.html": ""}
    named_files.write(docs.filter(F.size("sentences") > 0), writers._shard(F.col("doc_id")), writers._file_name(F.col("doc_id"), True), F.to_json("sentences"), str(tmp_path / "x"))
    got = {r["name"]: r["xml"] for r in readers.standard_format(spark, str(tmp_path / "x")).collect()}
    assert set(got) == {"000000001", "000000002", "000012346"} and "sentence 2" in got["000000002"]
    assert {p.parent.name for p in (tmp_path / "x").rglob("*.gz")} == {"000000", "000001"}


def test_shards_are_read_by_their_tasks(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"{i % 3:02d}", f"n{i}.txt" + ".gz" * (i % 2), "x" * i if i else None) for i in range(700)], "i int, s string, n string, c string")
    named_files.write(rows, F.col("s"), F.col("n"), F.col("c"), str(tmp_path / "d"))
    (tmp_path / "d" / "_temporary").mkdir()
    (tmp_path / "d" / "00" / ".hidden").write_text("no")
    files = named_files.read(spark, str(tmp_path / "d"))
    assert files.rdd.getNumPartitions() == 3
    got = files.select("shard", "name", encoding.gunzip(F.col("content")).cast("string").alias("c")).collect()
    assert sorted(map(tuple, got)) == sorted((r["s"], r["n"], r["c"] or "") for r in rows.collect())
    assert {r["name"] for r in readers.named_articles(files.filter("shard = '00' AND name LIKE '%.txt'")).collect()} == {f"n{i}" for i in range(0, 700, 6)}
    (tmp_path / "none").mkdir()
    assert named_files.read(spark, str(tmp_path / "none")).count() == 0


def test_blocks_are_read_by_splits(spark, tmp_path):
    blobs = {f"{i}": f"# S-ID:{i}\n日本 {i}\n\nEOS" for i in range(300)}
    (tmp_path / "k.txt").write_text("EOS\n" + "\n".join(blobs.values()) + "\r\n# S-ID:last\nx", "euc_jp")
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "1000")
    try:
        found = readers.analyzer_blocks(spark, str(tmp_path / "k.txt"), "euc-jp")
        assert found.rdd.getNumPartitions() > 4
        assert {r["sid"]: r["blob"] for r in found.collect()} == blobs | {"last": "# S-ID:last\nx\nEOS"}
    finally:
        spark.conf.set(name, before)
