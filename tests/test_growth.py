"""What must not grow faster than the tables: plans that work a page out once, tables that hold only what can matter."""

import pytest
from pyspark.sql import functions as F

from sentweave.operators import annotate, dependency_trees, html, provenance


def test_blog_template_works_the_page_out_once(spark):
    rows = spark.createDataFrame([(1, '<div id="comments"><div>one</div></div>a<div class="beta-inner">b'), (2, None)], "id int, html string")
    for keep_places, want in ((False, "a"), (True, "<!" + " " * 36 + ">a<!" + " " * 22 + ">")):
        found = rows.select("id", html.drop_blog_template(rows["html"], keep_places).alias("x"))
        assert {r["id"]: r["x"] for r in found.collect()} == {1: want, 2: None}
        assert found._jdf.queryExecution().optimizedPlan().toString().lower().count("instr") <= 3


def test_toxicity_keeps_only_ratios_that_can_count(spark, sf_dir):
    """Pairs of ordinary words aren't in the tables; where these are still too large, words that no text needs go, and the evidence stays."""
    toxicity = pytest.importorskip("sentweave.llm.toxicity")
    docs, labels = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet"), spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/labels.parquet")
    found, _ = toxicity.train(docs, labels)
    quiet = F.forall("l", lambda x: x <= toxicity.MARGIN)
    alone = found.words.join(found.pairs.filter(quiet), "w", "right").join(found.contexts.select("v", F.col("l").alias("before")), "v", "left")
    assert found.pairs.count() and not alone.filter(~F.exists(F.zip_with(F.coalesce(found.words["l"], F.array(*map(F.lit, found.unknown))), "before", lambda a, b: a + b), lambda x: x > toxicity.MARGIN)).count()
    needed = toxicity._needed(docs, found, F.col("text"))
    assert 0 < needed.words.count() < found.words.count()
    evidence = lambda own, most: {r["doc_id"]: r["x"] for r in toxicity._with_evidence(docs, own, F.col("text"), F.lit(0), "x", toxicity.row_key(docs), most).select("doc_id", "x").collect()}
    assert evidence(found, 10**9) == evidence(found, found.keys() - 1) == evidence(needed, 10**9)


def test_short_sentences_stand_where_all_of_them_stands(spark):
    """What lies between two sentences opens like the short one after it; a reference without a semicolon ends a sentence whole."""
    page = "Orti eronnd in bleat. And ha " + "so on " * 40 + "went. And. Ereae it thnd ou th the."
    raws = ["Ortieronndinbleat.", "And.", "Ereaeitthndouththe."]
    assert [page[o : o + n] for o, n in provenance.align(raws, page)] == ["Orti eronnd in bleat.", "And.", "Ereae it thnd ou th the."]
    shown = spark.range(1).select(provenance.padded_entities(F.lit("One &amp;&amp</p>&amp;<b>\x7f")).alias("x")).first()["x"]
    assert provenance.align(["One&&", "&"], shown.replace("</p>", "    ").replace("<b>", "   ")) == [(0, 13), (17, 1)]
    block = "BY!! AND!! THE HEATOU ONONAT TO TO THE ANOR SHHEED ERONNTEN ONNT THIN NDONSH, OF. IS THE WAS THAT OF.!! "
    lines = ["BY!!", "AND!!", "THEHEATOUONONATTOTOTHEANORSHNNTENONNTTHINNDONSH,OF.", "ISTHEWASTHATOF.!!"]
    found = provenance.align(lines * 40, block * 40)
    assert [o - i // 4 * len(block) for i, (o, _) in enumerate(found)] == [0, 5, 11, 82] * 40


def test_predicates_come_from_the_lines_as_from_the_tree(spark):
    case = lambda k, *more: f"+ {k}D <用言:動><格解析結果:x/x:動1:ガ/C/x/0/0/1;ヲ/U/-/-/-/-;ニ/C/y/{k}/0/2{''.join(more)}>"
    word = lambda w, mark="<内容語>": f"{w} x {w} 名詞 6 * 0 * 0 * 0 NIL {mark}"
    two = [word("b"), word("c", "<準内容語>")]
    blobs = ["", "EOS", "\n".join([word("lost"), "+ 1D <体言>", word("a"), case(-1), *two, "! 0,1 <SYNID:s1>", "!! x", "# c SCORE:1", "+ x", word("z", "<付属>"), "EOS", case(0), word("d")])]
    blobs += ["\n".join(["* 1D <格解析結果:x/x:動1:ガ/C/x/1/0/1>", *two, "* -1D", word("e")]), "\n".join(["* 1D <格解析結果:x/x:動1:ガ/C/x/0/0/1>", word("a"), case(7, ";ガ/C/x/1/0/1"), *two, case(1), "内容語> w", "", "+ -1D", word("e")])]
    rows = spark.createDataFrame(list(enumerate([*blobs, None])), "i int, blob string")
    both = rows.select("i", dependency_trees.predicates_in(F.col("blob")).alias("a"), dependency_trees.predicates(dependency_trees.tree(F.col("blob"))).alias("b")).collect()
    assert all(r["a"] == r["b"] for r in both) and sum(len(r["a"] or []) for r in both) > 3


def test_lines_of_conll_are_cut_once(spark):
    rows = spark.createDataFrame([("1\ta\tA\tX\tX\t_\t0\tDEP\t_\t_\n\n2\tb",), (None,)], "c string")
    found = rows.select(annotate.chunks(F.col("c")).alias("x"))
    assert [[tuple(c[k] for k in ("id", "head", "type")) for c in r["x"] or []] for r in found.collect()] == [[("c1", "c-1", "DEP"), ("c2", "c", "")], []]
    assert found._jdf.queryExecution().optimizedPlan().toString().lower().count("split") <= 2


def test_lines_fill_as_many_files_as_partitions(spark, tmp_path):
    """Else one task writes a third of any table."""
    from sentweave.plans.file_queries import put_lines

    names = {"spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {n: spark.conf.get(n) for n in names}
    try:
        for n, v in names.items():
            spark.conf.set(n, v)
        put_lines(spark.range(1000).selectExpr("id % 100 AS k", "id", "cast(id AS string) AS value"), str(tmp_path / "lines"), "k", "id")
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)
    files = [f.read_text().split() for f in (tmp_path / "lines").glob("part-*")]
    assert len(files) == 8 and sorted(int(x) for f in files for x in f) == list(range(1000))


def test_one_row_group_is_dealt_to_all_cores(spark, tmp_path):
    """Spark cuts such a file into several splits, of which one holds all rows."""
    import random

    import pyarrow as pa
    import pyarrow.parquet as pq

    from sentweave.session import table

    rng = random.Random(4)
    rows = pa.table({"doc_id": list(range(9000)), "text": [rng.randbytes(1000).hex() for _ in range(9000)]})
    pq.write_table(rows, tmp_path / "a b%20c.parquet")
    plain = spark.read.parquet(str(tmp_path / "a b%20c.parquet"))
    used = lambda df: df.select(F.spark_partition_id().alias("p")).distinct().count()
    found = table(spark, str(tmp_path), "a b%20c")
    assert plain.rdd.getNumPartitions() > 1 and used(plain) == 1 and used(found) >= 4
    assert found.agg(F.count("*"), F.sum("doc_id")).first() == (9000, 8999 * 4500)
    pq.write_table(rows, tmp_path / "many.parquet", row_group_size=1000)
    assert "Exchange" not in table(spark, str(tmp_path), "many")._jdf.queryExecution().executedPlan().toString()
    pq.write_table(rows.slice(0, 0), tmp_path / "none.parquet")
    assert table(spark, str(tmp_path), "none").count() == 0


def test_check_of_spans_reads_each_span_once(spark):
    """The page isn't coded anew for every sentence, and its span is cut out and stripped in one place of the plan."""
    pages = spark.createDataFrame([(1, "<p>é &amp; a</p>")], "page_id int, html string")
    found = spark.createDataFrame([(1, "é＆ａ", 3, 10), (1, "ａ", 12, 1), (1, "é", 3, 2), (1, "x", None, None)], "page_id int, raw_string string, offset bigint, length bigint")
    checked = provenance.verify(found, pages, language="japanese")
    assert sorted((r["source"].replace("　", ""), r["matches"]) for r in checked.collect()) == [("é", True), ("é＆ａ", True), ("ａ", True)]
    plan = checked._jdf.queryExecution().optimizedPlan().toString()
    assert "encode(html" not in plan and plan.count("<script") == 1


def test_spans_of_many_segments_are_those_of_each():
    import numpy as np

    from sentweave.operators import spans

    segments = [([(5, "ab é&amp;"), (40, "　x")], ["ab é&", "x"]), ([], []), ([(0, "abc")], ["ab"]), ([(7, "ｶﾞ&nbsp;&fjlig;\x07日")], ["ガfj", " ", "日"]), ([(9, "z")], ["z"])]
    each = [spans.spans_of(p, s, True) for p, s in segments]
    assert each[0] == [{"offset": 5, "length": 10}, {"offset": 43, "length": 1}] and each[2] == [None] and each[3][1] is None
    tokens = (np.array([len(p) for p, _ in segments]), np.array([a for p, _ in segments for a, _ in p]), [t for p, _ in segments for _, t in p])
    offset, length, there = spans.places(tokens, np.array([len(s) for _, s in segments]), [x for _, s in segments for x in s], True)
    assert [{"offset": o, "length": n} if t else None for o, n, t in zip(offset.tolist(), length.tolist(), there.tolist())] == [x for own in each for x in own]
