"""Operators over small tables, readers and writers, and the incremental run."""

import gzip

import pytest
from pyspark.sql import functions as F

from sentweave.operators import annotate, corpus, filters, html, links, papers, provenance, sentences, standard_format
from sentweave.plans import pipeline
from sentweave.sources import ordered, readers, writers
from sentweave.streaming import incremental


@pytest.fixture(scope="module")
def pages(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def test_every_sentence_is_in_its_bytes(pages):
    found = provenance.verify(sentences.sentences(pages), pages)
    assert found.count() > 500 and found.filter(~F.col("matches")).count() == 0


def test_numbers_are_gapless_and_ids_unique(pages):
    found = sentences.sentence_ids(sentences.sentences(pages))
    per_page = found.groupBy("page_id").agg(F.max("sent_no").alias("m"), F.count(F.lit(1)).alias("n"), F.max("paragraph").alias("p"), F.count_distinct("paragraph").alias("k"))
    assert per_page.filter("m <> n OR p <> k").count() == 0
    body = found.filter("sid IS NOT NULL")
    assert body.count() == body.select("sid").distinct().count()


def test_tokens_make_up_the_page(pages):
    again = html.tokens(pages).groupBy("page_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "token"))), lambda x: x["token"]), "").alias("again"))
    assert again.join(pages, "page_id").filter("again <> html").count() == 0


def test_nothing_is_lost_between_segments_and_sentences(pages):
    squeezed = lambda c: F.regexp_replace(c, "\\s+", "")
    cut = sentences.sentences(pages, max_chars=None).filter("role = 'body'").groupBy("page_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sent_no", "raw_string"))), lambda x: x["raw_string"]), "").alias("a"))
    whole = html.segments(pages).groupBy("page_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seg_no", "text"))), lambda x: sentences.clean_segment(x["text"])), "").alias("b"))
    assert cut.join(whole, "page_id").filter(squeezed("a") != squeezed("b")).count() == 0


def test_pages_without_text(spark):
    odd = spark.createDataFrame([(1, "u", None), (2, "u", ""), (3, "u", "<p></p>"), (4, "u", "<a<b>>x"), (None, "u", "<p>t.</p>")], "page_id int, url string, html string")
    assert [(r["page_id"], r["raw_string"]) for r in sentences.sentences(odd).orderBy("page_id").collect()] == [(None, "t."), (4, ">x")]
    assert odd.filter(filters.page_status(F.col("html")) == "ok").count() == 3


def test_japanese_page(spark):
    page = spark.createDataFrame([(1, "http://h/", "<html><title>題名</title><body><p>今日は晴れ。（たぶん）明日は雨です（笑）行く。</p></body></html>")], "page_id int, url string, html string")
    found = pipeline.page_sentences(page, pipeline.PipelineOptions(language="japanese", paren="divide")).orderBy("sent_no").collect()
    assert [r["raw_string"] for r in found] == ["題名", "今日は晴れ。", "（たぶん）", "明日は雨です（笑）", "行く。"]
    assert [r["is_normal"] for r in found] == [False, True, False, True, True]


def test_links_round_trip(spark, pages):
    known = pages.select("url", F.col("page_id").alias("doc_id"))
    named = links.with_ids(links.anchors(pages), known)
    records = links.link_records(named)
    assert links.unpack_records(records).count() == named.count()
    docs = links.embed_links(pages.select("page_id", "url"), links.out_links(named), links.in_links(named), "page_id")
    assert docs.count() == pages.count() and docs.select(F.sum(F.aggregate("out_links", F.lit(0), lambda n, g: n + F.size(g["targets"])))).first()[0] == named.count()
    assert links.drop_links(docs).columns == ["page_id", "url"]


def test_xml_round_trip(pages):
    docs = standard_format.assemble(sentences.sentence_ids(sentences.sentences(pages)), pages)
    again = standard_format.parse_xml(standard_format.to_xml(docs)).select("doc_id", F.col("sentences").alias("read"), F.col("url").alias("read_url"))
    both = again.join(docs.select("doc_id", "url", "sentences"), "doc_id").collect()
    plain = lambda s: (s["sid"], s["role"], s["paragraph"], s["block_type"], s["offset"], s["length"], s["japanese_score"], s["raw_string"])
    assert both and all(r["read_url"] == r["url"] and sorted(map(str, map(plain, r["read"]))) == sorted(map(str, map(plain, r["sentences"]))) for r in both)


def test_every_field_comes_back_from_xml(spark):
    """Brackets, flags, logs, annotations with marks of their own, links, and characters that XML can't hold."""
    from sentweave.operators import formatter

    html = "<title>題</title><p>宮本議長（８６）と脆（もろ）い人。■お知らせです。</p><p>A &lt;b&gt; &amp; 次の文です。</p>"
    pages = spark.createDataFrame([(1, "http://h/?a=1&b=2", html)], "page_id int, url string, html string")
    found = formatter.format_sentences(sentences.sentence_ids(sentences.sentences(pages, language="japanese")), paren="divide")
    note = F.array(F.struct(F.lit("KNP").alias("scheme"), F.lit("t\"<1>").alias("tool"), F.concat(F.lit("# S-ID:1 <&>]]>\n"), "raw_string", F.lit("\nEOS")).alias("cdata")))
    docs = standard_format.assemble(found.withColumn("annotations", note), pages)
    group = lambda inner: F.array(F.struct(F.lit("an & <chor>").alias("anchor"), F.array(F.struct(F.lit("http://x/?q&r").alias("url"), F.lit("999999999").alias("doc_id"))).alias(inner)))
    docs = docs.withColumn("out_links", group("targets")).withColumn("in_links", group("sources")).withColumn("crawl_time", F.lit("2007-07-31 JST"))
    (got,) = standard_format.parse_xml(standard_format.to_xml(docs)).collect()
    (want,) = docs.collect()
    assert got["url"] == want["url"] and got["crawl_time"] == want["crawl_time"] and got["out_links"] == want["out_links"] and got["in_links"] == want["in_links"]
    for a, b in zip(got["sentences"], sorted(want["sentences"], key=lambda s: s["role"] == "body")):
        for c in ("sid", "role", "paragraph", "block_type", "offset", "length", "japanese_score", "raw_string", "is_normal", "log", "formatted", "parens", "annotations"):
            assert a[c] == b[c], c
    assert any(s["parens"] for s in got["sentences"]) and any(s["is_normal"] is False for s in got["sentences"])
    assert standard_format.parse_xml(spark.createDataFrame([("no xml <",), (None,)], "xml string")).filter("url IS NULL AND sentences IS NULL").count() == 2


def test_annotation_is_done_once_for_each_text(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(["The dog ran.", "The dog ran.", "x" * 200, "", None, "known"])], "i int, raw_string string")
    cache = spark.createDataFrame([("known", "cached")], "text string, analysis string")
    got = {r["i"]: r["analysis"] for r in annotate.annotate(rows, cache=cache).collect()}
    assert got[0] == got[1] and "ran." in got[0] and got[5] == "cached" and got[2] is got[3] is got[4] is None


def failing():
    def analyze(sentence):
        if "bad" in sentence:
            raise ValueError(sentence)
        return sentence.upper()

    return analyze


def test_failures_are_rows_and_rounds_end(spark, tmp_path):
    annotate.register_annotator("failing", failing)
    texts = spark.createDataFrame([("good",), ("bad",)], "text string")
    assert {r["text"]: (r["analysis"], r["error"]) for r in annotate.analyses(texts, "failing").collect()} == {"good": ("GOOD", None), "bad": (None, "ValueError")}
    path = str(tmp_path / "log")
    spark.createDataFrame([], "text string, analysis string, error string").write.parquet(path)
    rounds = annotate.annotate_until_done(texts, "failing", lambda df: df.write.mode("append").parquet(path), lambda: spark.read.parquet(path))
    assert rounds == 2
    with pytest.raises(KeyError):
        annotate.annotator("none")


def test_corpus_utilities(spark):
    lines = spark.createDataFrame([(1, "a", "c1"), (2, "a", "c2 COUNT:3"), (3, "b", "c3")], "pos int, str string, comment string")
    got = corpus.dedup_count(lines, "str", "comment", "pos", counted=True).withColumn("l", corpus.counted_line("str")).orderBy("str").collect()
    assert [r["l"] for r in got] == ["a c1 COUNT:4", "b c3 COUNT:1"]
    ids = spark.createDataFrame([("x", i) for i in range(3)], "id string, pos int")
    assert [r["version"] for r in corpus.version_suffix(ids, "id", "pos").orderBy("pos").collect()] == ["x", "x-1", "x-2"]
    tags = spark.createDataFrame([(1, s) for s in ("ab", "abc", "abc", "d")], "g int, s string")
    assert {r["s"] for r in corpus.reduce_contained(tags, ["g"], "s").collect()} == {"abc", "d"}


def test_files_and_sidecars(spark, tmp_path):
    (tmp_path / "p").mkdir()
    (tmp_path / "p/a.html").write_bytes("<meta charset='EUC-JP'>日本".encode("euc_jp"))
    (tmp_path / "p/b.html.gz").write_bytes(gzip.compress("<p>日本語です。</p>".encode()))
    (tmp_path / "p/c.html").write_bytes(b"\x00\x01\x02binary")
    files = readers.html_files(spark, str(tmp_path / "p"))
    info = spark.createDataFrame([("a", "http://a/ euc-jp\nrest"), ("b", "http://b/")], "name string, value string")
    got = {r["name"]: r for r in readers.decoded(readers.with_info(files, info), given="given_encoding").collect()}
    assert set(got) == {"a", "b"} and got["a"]["html"].endswith("日本") and got["a"]["url"] == "http://a/" and got["b"]["html"] == "<p>日本語です。</p>"
    assert {r["name"]: r["linenum"] for r in readers.archive(files).collect()} == {"a": 1, "b": 1}


def test_headers_and_split_pages(spark):
    whole = "HTML http://a/ NOINDEX\nDate: Tue, 03 Jul 2007 10:00:00 GMT\n\n<html>1</html>\nHTML http://b/\n\n<html>2</html>"
    parts = readers.split_pages(spark.createDataFrame([("f", whole)], "name string, html string"))
    got = parts.select("page_in_file", readers.crawler_header(F.col("html")).alias("h")).select("page_in_file", "h.*").orderBy("page_in_file").collect()
    assert [(r["url"], r["no_index"], r["crawl_time"], r["body"].strip()) for r in got] == [("http://a/", True, "2007-07-03 10:00:00 GMT", "<html>1</html>"), ("http://b/", False, None, "<html>2</html>")]


def test_line_readers(spark, tmp_path):
    (tmp_path / "s.txt").write_text("# S-ID:1-1 note\n一文目。\n# S-ID:1-2\n二文目。\n")
    got = readers.sid_lines(ordered.lines(spark, str(tmp_path / "s.txt"))).orderBy("pos").collect()
    assert [(r["sid"], r["comment"], r["str"]) for r in got] == [("1-1", "note", "一文目。"), ("1-2", "", "二文目。")]
    (tmp_path / "p.txt").write_text('<PAGE URL="http://a/">\nx\ny\n</PAGE>\n<PAGE URL="http://b/">\nz\n')
    got = readers.page_lines(ordered.lines(spark, str(tmp_path / "p.txt"))).orderBy("pos").collect()
    assert [(r["page"], r["url"], r["str"]) for r in got] == [(1, "http://a/", "x"), (1, "http://a/", "y"), (2, "http://b/", "z")]
    (tmp_path / "k.txt").write_text("# S-ID:1-1\nA\nEOS\n# S-ID:1-2\nB\nEOS\n", "euc_jp")
    blocks = readers.analyzer_blocks(spark, str(tmp_path / "k.txt"), "euc-jp").orderBy("sid").collect()
    assert [(r["sid"], r["blob"]) for r in blocks] == [("1-1", "# S-ID:1-1\nA\nEOS"), ("1-2", "# S-ID:1-2\nB\nEOS")]
    (tmp_path / "pre.txt").write_text("#c\nMr\nNo #NUMERIC_ONLY#\n")
    assert {(r["prefix"], r["kind"]) for r in readers.prefixes(spark, str(tmp_path / "pre.txt")).collect()} == {("Mr", 1), ("No", 2)}
    (tmp_path / "tags.txt").write_text("<PAPER id=1 source=P1.txt>\n<MATCH type=T pattern_type=P>abc</MATCH>\n")
    assert [tuple(r) for r in papers.tag_lines(ordered.lines(spark, str(tmp_path / "tags.txt"))).collect()] == [("P1", "T", "P", "abc")]
    (tmp_path / "m.tsv").write_text("h\t1\t2\t3\t4\tf\ti\to\nA\t1\t2\t3\t4\tfind\timp\tord\n")
    assert [(r["fid"], r["findings"], r["impression"], r["order_text"]) for r in readers.medical_reports(spark, str(tmp_path / "m.tsv")).collect()] == [("A", "find", "imp", "ord")]


def test_writers(spark, pages, tmp_path):
    docs = standard_format.assemble(sentences.sentence_ids(sentences.sentences(pages)), pages)
    writers.xml_documents(docs, str(tmp_path / "xml"))
    assert spark.read.parquet(str(tmp_path / "xml")).count() == docs.count()
    writers.plain_documents(docs, str(tmp_path / "plain"))
    writers.sid_documents(docs, str(tmp_path / "sid"), "gzip")
    assert spark.read.text(str(tmp_path / "plain")).filter("value LIKE '<PAGE%'").count() == docs.count()
    found = links.anchors(pages)
    writers.out_links(found, str(tmp_path / "links"))
    assert spark.read.csv(str(tmp_path / "links"), sep="\t").count() == found.count()
    lines = spark.createDataFrame([("b x",), ("a",), ("long word",)], "value string")
    writers.length_buckets(lines, "value", str(tmp_path / "len"))
    assert {(r["len_bucket"], r["value"]) for r in spark.read.text(str(tmp_path / "len")).collect()} == {(1, "b x"), (1, "a"), (4, "long word")}


def test_incremental_run_resumes(spark, pages, tmp_path):
    src, out, log = (str(tmp_path / x) for x in ("src", "out", "log"))
    process = lambda df: df.select("page_id", F.length("html").alias("n"))
    for part in ("page_id < 20", "page_id < 30"):
        pages.filter(part).write.mode("append").parquet(src)
        incremental.run_incrementally(incremental.page_stream(spark, src, pages.schema), process, out, log, str(tmp_path / "ck")).awaitTermination()
    rows = spark.read.parquet(out)
    assert rows.count() == rows.select("page_id").distinct().count() == pages.filter("page_id < 30").count()


def test_metadata_by_alias(spark):
    docs = spark.createDataFrame([("A",), ("B",), ("C",)], "doc_id string")
    meta = spark.createDataFrame([("B2", "m")], "id string, meta string")
    aliases = spark.createDataFrame([("B2", "B")], "a string, b string")
    assert {r["doc_id"]: r["meta"] for r in papers.with_metadata(docs, meta, aliases).collect()} == {"A": None, "B": "m", "C": None}


def test_spans_are_the_sentences_own(spark):
    """Sentences of one segment have disjoint spans; references, tags within words, controls, wide characters, br options."""
    from sentweave.operators import spans

    html = "<html><title> A &amp; B </title><p>One  fish is&nbsp;here. Tw<b>o fi</b>sh &eacute;t&#xe9; are\there! Café &lt;x&gt; &foo; done.\n\nNew para 漢字 here</p>Tail<br>\nend"
    pages = spark.createDataFrame([(1, html)], "page_id int, html string")
    raw = html.encode()
    for options in ({}, {"ignore_br": True}, {"uniq_br": True}):
        found = sentences.sentences(pages, **options)
        rows = provenance.verify(found, pages).orderBy("offset").collect()
        assert rows and all(r["matches"] for r in rows)
        assert all(a["offset"] + a["length"] <= b["offset"] for a, b in zip(rows, rows[1:]))
    own = {r["raw_string"]: raw[r["offset"] : r["offset"] + r["length"]].decode() for r in sentences.sentences(pages).collect()}
    assert own["One fish is here."] == "One  fish is&nbsp;here." and own["Two fish été arehere!"] == "Tw<b>o fi</b>sh &eacute;t&#xe9; are\there!"
    assert own["A & B"] == "A &amp; B" and own["Café <x> &foo; done."] == "Café &lt;x&gt; &foo; done."
    assert spans.spans_of([(0, "abc")], ["ab"], False) == [None]  # what doesn't add up has no span


def test_spans_of_japanese_sentences(spark):
    html = "<p>ｶﾞｷﾞﾊﾟ です。 次の ABC&#12354;文　！（笑）終わり。 以下の、</p><p>１．あ<br>2人</p>"
    pages = spark.createDataFrame([(1, html)], "page_id int, html string")
    found = sentences.sentences(pages, language="japanese")
    rows = provenance.verify(found, pages, language="japanese").orderBy("offset").collect()
    assert len(rows) >= 5 and all(r["matches"] for r in rows)
    assert all(a["offset"] + a["length"] <= b["offset"] for a, b in zip(rows, rows[1:]))
    raw = html.encode()
    assert raw[rows[0]["offset"] : rows[0]["offset"] + rows[0]["length"]].decode() == "ｶﾞｷﾞﾊﾟ です。"


def test_a_large_japanese_page_is_linear(spark):
    import time

    page = "「これは長い文です。」と言った。（１）次へ！" * 50_000  # over a million characters, one paragraph
    pages = spark.createDataFrame([(1, f"<p>{page}</p>")], "page_id int, html string")
    began = time.time()
    assert sentences.sentences(pages, language="japanese", max_chars=None).count() > 50_000
    assert time.time() - began < 120


def test_numbered_lines_keep_their_order(spark, tmp_path):
    from sentweave.sources import readers

    for name in "ab":
        (tmp_path / f"{name}.txt").write_text("".join(f"# S-ID:{name}-{i} c{i}\n{name} sentence {i}\n" for i in range(500)))
    rows = readers.sid_lines(ordered.lines(spark, str(tmp_path))).collect()
    assert {(r["sid"], r["comment"], r["str"]) for r in rows} == {(f"{n}-{i}", f"c{i}", f"{n} sentence {i}") for n in "ab" for i in range(500)}
    (tmp_path / "r.tsv").write_text("\t".join("abcdefgh") + "\n" + "\t".join("ID1,1,2,3,4,find,imp,order".split(",")) + "\nID2\t\t\t\t\tf2\t\to2\n")
    got = readers.medical_reports(spark, str(tmp_path / "r.tsv")).orderBy("pos").collect()
    assert [(r["fid"], r["findings"], r["impression"], r["order_text"]) for r in got] == [("ID1", "find", "imp", "order"), ("ID2", "f2", None, "o2")]


def test_analyses_are_limited_and_restarted(spark):
    def make():
        import time

        uses = []

        def analyze(t):
            uses.append(t)
            if t == "slow":
                time.sleep(5)
            return f"{len(uses)}"

        return analyze

    annotate.register_annotator("counting", make)
    texts = spark.createDataFrame([("a",), ("b",), ("slow",), ("c",), ("d",), ("e",)], "text string").coalesce(1)
    got = {r["text"]: (r["analysis"], r["error"]) for r in annotate.analyses(texts, "counting", seconds=0.5, restart_after=2).collect()}
    assert got == {"a": ("1", None), "b": ("2", None), "slow": (None, "TimeLimit"), "c": ("1", None), "d": ("2", None), "e": ("1", None)}
    rows = spark.createDataFrame([("title", "x y", "n1"), ("body", "x y", None), ("body", None, "n2")], "role string, raw_string string, note string")
    assert {(r["role"], r["analysis"] is None) for r in annotate.annotate(rows, roles=["title"]).collect()} == {("title", False), ("body", True)}
    noted = rows.withColumn("annotations", F.when(F.col("note").isNotNull(), F.array(F.struct(F.lit("A").alias("scheme"), F.lit("t").alias("tool"), F.col("note").alias("cdata")))).otherwise(F.array().cast("array<struct<scheme:string,tool:string,cdata:string>>")))
    added = annotate.annotate_annotations(noted, "A", "B", "counting").collect()
    assert sorted(len(r["annotations"]) for r in added) == [0, 2, 2]
    xml = '<Result><Chunk Id="c0" Head="c1" Type="D"><Token Id="t0" Surf="a" Orig="a" Pos="N"/></Chunk><Chunk Id="c1" Head="c-1" Type="D"><Token Id="t1" Surf="b" Orig="b" Pos="V"/></Chunk></Result>'
    (r,) = spark.createDataFrame([(xml,)], "x string").select(annotate.xml_chunks(F.col("x")).alias("c")).collect()
    assert [(c["id"], c["head"], c["tokens"][0]["surf"]) for c in r["c"]] == [("c0", "c1", "a"), ("c1", "c-1", "b")]


def test_files_for_each_document(spark, tmp_path):
    pages = spark.createDataFrame([(7, "u", "<p>One. Two.</p>"), (8, "v", "<p></p>")], "page_id int, url string, html string")
    docs = standard_format.assemble(sentences.sentence_ids(sentences.sentences(pages)), pages)
    writers.xml_files(docs, str(tmp_path / "x"))
    (one,) = (tmp_path / "x").glob("*/*")
    assert one.parent.name == "000000" and one.name == "000000007.xml" and one.read_text().startswith("<?xml") and one.read_text().count("<S ") == 2
    links_ = spark.createDataFrame([(7, "a&b", [("http://x", "3")])], "doc_id int, anchor string, sources array<struct<url:string,doc_id:string>>")
    writers.in_link_documents(links_, str(tmp_path / "i"))
    (own,) = (tmp_path / "i").glob("000000/000000007.xml")
    assert "<InLink><RawString>a&amp;b</RawString>" in own.read_text()
    (tmp_path / "VERSION").write_text("1.2\nmore")
    assert readers.parameter(spark, str(tmp_path / "VERSION")) == "1.2"
    from sentweave.functions import encoding

    assert spark.createDataFrame([("ｱ①Ａ",), (None,)], "c string").select(encoding.normalise_nfkc(F.col("c")).alias("n")).collect()[0]["n"] == "ア1A"
