"""Regions against all cuts, dictionary marks against a search entry by entry, links against the segments' pass."""

import random
import time
from itertools import product

import pytest
from pyspark.sql import functions as F

from sentweave.operators import html, links
from sentweave.operators.dictionary import Dictionary
from sentweave.plans import file_queries


def cost(sizes, linked, cuts, price):
    total = 0.0
    for i, j in zip(cuts, cuts[1:]):
        w = sum(sizes[i:j])
        mean = sum(linked[i:j]) / w
        total += sum(s * (a / s - mean) ** 2 for s, a in zip(sizes[i:j], linked[i:j])) + price
    return total


def test_regions_are_the_cheapest_of_all_cuts():
    rng = random.Random(3)
    for _ in range(300):
        n = rng.randrange(1, 10)
        sizes = [rng.randrange(1, 120) for _ in range(n)]
        linked = [rng.choice([0, s, s // 2, rng.randrange(s + 1)]) for s in sizes]
        price = rng.choice([0.5, 5.0, 40.0])
        regions = html.density_regions(sizes, linked, price)
        own = cost(sizes, linked, [i for i, _ in regions] + [n], price)
        least = min(cost(sizes, linked, [0, *(i + 1 for i, cut in enumerate(pick) if cut), n], price) for pick in product([0, 1], repeat=n - 1))
        assert abs(own - least) < 1e-6
    assert html.density_regions([], []) == []
    began = time.time()
    assert html.density_regions([200] * 3000 + [60] * 3000, [0] * 3000 + [60] * 3000) == [(0, "maintext"), (3000, "footer")]
    assert time.time() - began < 20


def test_regions_reach_the_segments(spark, sf_dir):
    menu = "<ul>" + "".join(f"<li><a href='/{i}'>a menu entry {i}</a></li>" for i in range(12)) + "</ul>"
    page = f"<html><body>{menu}<div id='m'>{'<p>text without any link in it, on and on.</p>' * 9}</div>{menu}</body></html>"
    pages = spark.createDataFrame([(1, page, "mine"), (2, "", "x"), (3, "no tags at all", "y"), (4, None, "z")], "page_id int, html string, marks string")
    told = html.with_regions(pages)
    assert told.columns == pages.columns and {r["page_id"]: r["html"] for r in told.collect() if r["page_id"] > 1} == {2: "", 3: "no tags at all", 4: None}
    one = [r["block_type"] for r in html.segments(told.filter("page_id = 1")).filter("text rlike '[a-z]'").orderBy("seg_no").collect()]
    kinds = [k for k, before in zip(one, [None, *one]) if k != before and k != html.UNKNOWN_BLOCK]
    assert kinds[0] == "menu" and "maintext" in kinds and kinds[-1] == "footer"
    found = file_queries.page_regions(spark, sf_dir)
    assert {r["block_type"] for r in found.select("block_type").distinct().collect()} & {"menu", "maintext", "footer"}
    plain = html.segments(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    assert found.count() == plain.count() and found.agg(F.sum("size")).first()[0] == plain.agg(F.sum(F.length("text"))).first()[0]


def brute_marks(text: str, entries: dict[str, set]) -> list[tuple]:
    """From each place the longest entry, kind by kind."""
    out = []
    for kind in {k for ks in entries.values() for k in ks}:
        own = {w for w, ks in entries.items() if kind in ks}
        sizes = sorted({len(w) for w in own}, reverse=True)
        at = 0
        while at < len(text):
            size = next((n for n in sizes if at + n <= len(text) and text[at : at + n] in own), 0)
            if size:
                out.append((at, size, kind))
            at += size or 1
    return sorted(out, key=lambda m: (m[0], m[2]))


def test_marks_of_ten_thousand_entries(spark, sf_dir):
    rng = random.Random(9)
    docs = [r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    entries: dict[str, set] = {}
    while len(entries) < 10_000:
        t = rng.choice(docs)
        at = rng.randrange(max(len(t), 1))
        word = t[at : at + rng.choice([1, 2, 3, 4, 6, 9, 14, 30])]
        if word and not (len(word) == 1 and rng.random() < 0.9):
            entries.setdefault(word, set()).add(rng.choice([1, 2]))
    table = spark.createDataFrame([(w, k) for w, ks in entries.items() for k in ks] + [(None, 1), ("", 2)], "word string, kind int")
    own = Dictionary(table, kind="kind")
    rows = spark.createDataFrame(list(enumerate([*docs, "", None])), "i int, t string").repartition(4)
    got = {r["i"]: r for r in rows.select("i", own.marks(F.col("t")).alias("m"), own.flags(F.col("t")).alias("f")).collect()}
    for i, t in enumerate([*docs, ""]):
        want = brute_marks(t, entries)
        assert [tuple(m) for m in got[i]["m"]] == want
        flags = [0] * len(t)
        for start, size, kind in sorted(want, key=lambda m: m[2]):
            flags[start : start + size] = [kind] * size
        assert got[i]["f"] == flags
    assert got[len(docs) + 1]["m"] is None and got[len(docs) + 1]["f"] is None


def test_dictionaries_of_faces_and_bounds(spark):
    faces = Dictionary(spark.createDataFrame([("＾＾",), ("＾＾；",), ("（＾＾；）",)], "word string"))
    rows = spark.createDataFrame([("あ（＾＾；）い＾＾；＾＾う",), ("＾",), ("",)], "t string")
    got = rows.select(faces.flags(F.col("t")).alias("f"), faces.masked(F.col("t"), "*").alias("m"), F.transform(faces.marks(F.col("t")), lambda m: m["length"]).alias("n")).collect()
    assert got[0]["n"] == [5, 3, 2] and got[0]["m"] == "あ*****い*****う" and got[0]["f"] == [0, 1, 1, 1, 1, 1, 0, 1, 1, 1, 1, 1, 0]
    assert got[1]["f"] == [0] and got[2]["f"] == []
    none = Dictionary(spark.createDataFrame([], "word string"))
    assert rows.select(none.marks(F.col("t")).alias("m")).first()["m"] == []
    with pytest.raises(ValueError):
        Dictionary(spark.createDataFrame([("x" * 100,)], "word string"), max_chars=99)
    deep = Dictionary(spark.createDataFrame([("a" * n,) for n in range(1, 40)], "word string"))
    began = time.time()
    long = spark.createDataFrame([("a" * 200_000,)], "t string").select(F.size(deep.marks(F.col("t"))).alias("n")).first()["n"]
    assert long == -(-200_000 // 39) and time.time() - began < 60


def test_links_of_the_segments_pass(spark):
    page = """<a href="/one">One</a> <A HREF='/two'><b>T</b>wo <!-- <a href="/no">no</a> --></A><script>"<a href='/js'>js</a>"</script>
    <a href="/open">open <a href="/three">Thr<br>ee</a> after</a> <a name=x></a> <a href="/never">never closed"""
    pages = spark.createDataFrame([(1, "http://h/d/", page), (2, None, page), (3, "http://h/", None), (4, "http://h/", "x" * 5_300_000 + "<a href='/x'>x</a>")], "page_id int, url string, html string")
    got = links.anchors(pages).orderBy("pos").collect()
    assert [(r["from_id"], r["to_url"], r["anchor"]) for r in got] == [(1, "http://h/one", "One"), (1, "http://h/two", "Two"), (1, "http://h/three", "Three")]
    found = html.page_links(html.flagged(html.tokens(pages.filter("page_id = 1")))).orderBy("link_no").collect()
    raw = page.encode()
    assert [raw[r["offset"] :].split(b"<")[0].decode() for r in found if r["offset"] is not None] == ["One", "T", "Thr"]
    assert len({r["seg_no"] for r in found}) >= 1
