import random
import re
from collections import Counter
from pathlib import Path

import pytest
from tests.llm.conftest import odd_texts, sentence
from sentweave.llm import decontaminate, licenses, toxicity, url_filter
from sentweave.llm.license_texts import LICENSES


def words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)


def brute_hits(text, items, size):
    w = words(text)
    hit, found = set(), set()
    for name, item in items:
        v = words(item)
        n = min(size, len(v))
        windows = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if v else set()
        for i in range(len(w) - n + 1) if v else ():
            if tuple(w[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                found.add(name)
    return len(w), len(hit), len(found)


ITEMS = [(1, sentence(2, 14)), (2, "one"), (3, None), (4, "..."), (5, sentence(1, 60)), (5, "Two words"), (None, "café Übung"), (6, "word word word")]


@pytest.mark.parametrize("block", [40, 1_000_000])
def test_decontamination_is_brute_force(spark, odd, block):
    benchmark = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = decontaminate.find_benchmark(odd, benchmark, block_windows=block).collect()
    items = [("" if i is None else str(i), t) for i, t in ITEMS]
    want = Counter((r["doc_id"], *brute_hits(r["text"], items, 10)) for r in odd.collect())
    assert Counter((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"]) for r in got) == want
    for r in got:
        if r["contaminated"]:
            assert len(words(r["clean_text"])) == r["n_words"] - r["n_hit"]
        else:
            assert r["clean_text"] == (r["text"] or "")


def test_clean_documents_stay(spark, odd, empty):
    benchmark = spark.createDataFrame([(1, sentence(2, 14))], "item_id bigint, text string")
    kept = decontaminate.decontaminate(odd, benchmark)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 2
    assert decontaminate.decontaminate(odd, benchmark, remove="spans").count() == odd.count()
    assert decontaminate.decontaminate(empty, benchmark).count() == 0
    assert decontaminate.decontaminate(odd, benchmark.limit(0)).count() == odd.count()


def test_licence_variants_have_one_digest(spark, odd, empty):
    mit = LICENSES["MIT"]
    rows = [(1, mit), (2, "Copyright (c) 2021 A. Person\n\n" + mit.upper()), (3, mit.replace("sublicense", "sublicence").replace(",", " ;")), (4, mit + " more"), (5, "# Copyright 1999 X\n"), (6, "Text.\nReleased under the MIT Licence.\nLicensed under CC BY 4.0")]
    got = {r["doc_id"]: r for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert [got[i]["license_id"] for i in range(1, 7)] == ["MIT", "MIT", "MIT", None, None, None]
    assert got[5]["text_digest"] is None and (got[6]["n_notices"], got[6]["notices"]) == (2, "CC-BY-4.0,MIT")
    full = Path(licenses.__file__).parent / "licence_files"
    more = [(1, (full / "Apache-2.0.txt").read_text()), (2, "The MIT License (MIT)\n\nCopyright (c) 2024 B\n\n" + mit), (3, "BSD 3-Clause License\n\nCopyright 2020, X\n\n" + LICENSES["BSD-3-Clause"]), (4, (full / "GPL-3.0-only.txt").read_text().replace("\n", "\r\n").upper())]
    rows = spark.createDataFrame(more, "doc_id bigint, text string")
    for most in (10**6, 0):
        found = {r["doc_id"]: r["license_id"] for r in licenses.scan_licenses(rows, most=most).collect()}
        assert found == {1: "Apache-2.0", 2: "MIT", 3: "BSD-3-Clause", 4: "GPL-3.0-only"}
    own = spark.createDataFrame([("Do as you like", "own"), ("...", "nothing")], "text string, license_id string")
    assert [r["license_id"] for r in licenses.scan_licenses(spark.createDataFrame([("do AS you, like!",), (mit,), ("",)], "text string"), registry=own).collect()] == ["own", None, None]
    assert licenses.scan_licenses(odd).count() == odd.count() and licenses.scan_licenses(empty).collect() == []


def page(i, url, html="<html></html>"):
    return i, url, html


def test_aliases_take_decisions(spark):
    canonical = '<link rel="canonical" href="{}">'
    pages = [
        page(1, "http://a.com/en/x"), page(2, "http://other.org/y", canonical.format("http://a.com/en/x")), page(3, "https://third.io/z?utm_source=q", "<meta http-equiv = 'refresh' content='0; URL=http://other.org/y#part'>"),
        page(4, "http://example.com/en/7/1"), page(5, "http://alias.io/both", canonical.format("http://example.com/en/7/1") + canonical.format("http://a.com/en/x")),
        page(6, None), page(7, "no scheme"), page(8, "HTTP://Sub.Example.NET/de/81#t"), page(9, "http://example.net/de/7?x"), page(10, "http://free.io/", None), page(11, "http://com/en/"), page(12, "http://xcom/en/"), page(None, "https://Third.io/z?utm_source=q#x"), page(14, "https://third.io/z"),
    ]
    table = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    got = {r["page_id"]: (r["rule"], r["verdict"], r["decided_by"]) for r in url_filter.judge_urls(table).collect()}
    assert got[1] == ("com/en/", "block", "rule") and got[4] == ("example.com/en/7", "allow", "rule")
    # page 5 ties both groups together: an explicit allow takes precedence for everything without a rule of its own
    assert got[2][1:] == got[3][1:] == got[5][1:] == got[None][1:] == ("allow", "alias")
    assert got[8] == ("example.net/de/8", "block", "rule") and got[9] == ("net/de/", "allow", "rule")
    assert got[14][1:] == ("allow", "default")  # no edge: another url
    assert got[6] == got[7] == got[10] == (None, "allow", "default") and got[11][0] == "com/en/" and got[12][0] is None
    without = {r["page_id"]: r["verdict"] for r in url_filter.judge_urls(table.filter("page_id <> 5")).collect()}
    assert without[2] == without[3] == "block"
    assert url_filter.judge_urls(table.limit(0)).collect() == []
    links = spark.createDataFrame([("http://free.io/", "http://a.com/en/q"), ("http://a.com/en/q", "http://a.com/en/x")], "u string, v string")
    assert {r["page_id"]: r["verdict"] for r in url_filter.judge_urls(table.filter("page_id <> 5"), links=links).collect()}[10] == "block"



def test_a_table_of_rules_judges_as_the_expression_does(spark):
    rng = random.Random(4)
    hosts = ["example.com", "com", "a.example.com", "badexample.com", "org", "x.org", "", "example.com.", "net"]
    rules = {f"{h}{p}": rng.choice(["allow", "block"]) for h in hosts for p in ["/en/", "/en/7", "/", "", "/d"] if rng.random() < 0.5}
    listed = tuple(url_filter.Rule(v, n) for n, v in rules.items() if n)
    table = spark.createDataFrame([(n, v) for n, v in rules.items() if n] + [(None, "block")], "name string, verdict string")
    urls = [f"http://{h}{p}" for h in hosts + ["b.a.example.com", "EXAMPLE.com", "y.net"] for p in ["", "/", "/en/", "/en/70", "/de?x#y", "/d"]] + [None, "no url"]
    pages = spark.createDataFrame([(i, u, f'<link rel=canonical href="{rng.choice(urls) or "x"}">' if i % 3 else None) for i, u in enumerate(urls)], "page_id int, url string, html string").repartition(3)
    got, want = (Counter(map(tuple, url_filter.judge_urls(pages, r).select("page_id", "host", "path", "rule", "verdict", "decided_by").collect())) for r in (table, listed))
    assert got == want and len({x[3] for x in got}) > 4


def test_relative_targets_are_aliases(spark):
    link = '<link rel="canonical" href="{}">'
    pages = [
        page(1, "http://x.com/en/7"), page(2, "HTTP://x.com/a/b?q=1", link.format("/en/7")), page(3, "http://x.com/en2/p", '<meta http-equiv="refresh" content="0; url=../en/7">'),
        page(4, "https://y.io/z", link.format("//x.com/en/7")), page(5, "http://x.com/n", link.format("#top")), page(6, "http://x.com/m", link.format("mailto:a@x.com")), page(7, "no scheme", link.format("/en/7")),
        page(8, "http://x.com/r", link.format("/go?to=http://x.com/en/7")),
        page(9, "http://x.com/e", "<LINK  href='http://x.com/&#101;n/7' rel = \"alternate canonical\">"), page(10, "http://x.com/c", "<!--" + link.format("/en/7") + "--><script>'" + link.format("/en/7") + "'</script>"),
        page(11, "http://x.com/u", link.format("http://uncrawled.com/en/9")), page(12, "http://x.com/v", '<link rel="canonicals" href="/en/7"><meta name="refresh" content="0; url=/en/7">'),
    ]
    got = {r["page_id"]: (r["verdict"], r["decided_by"]) for r in url_filter.judge_urls(spark.createDataFrame(pages, "page_id bigint, url string, html string")).collect()}
    assert got == {1: ("block", "rule")} | {i: ("block", "alias") for i in (2, 3, 4, 9, 11)} | {i: ("allow", "default") for i in (5, 6, 7, 8, 10, 12)}
    import duckdb
    import pandas as pd

    from sentweave.llm import queries

    con = duckdb.connect()
    con.register("pages", pd.DataFrame(pages, columns=["page_id", "url", "html"]))
    said = {r[0]: (r[4], r[5]) for r in con.sql(queries.OP8_SQL).fetchall()}
    assert said == got


def test_toxicity_on_held_out_documents(spark):
    from pyspark.sql import functions as F

    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.score(docs, labels, keep=("doc_id",)).join(labels, "doc_id").filter("held_out").select("toxic", "predicted", "score").collect()
    hit = sum(r["toxic"] and r["predicted"] for r in rows)
    assert hit / sum(r["predicted"] for r in rows) > 0.85 and hit / sum(r["toxic"] for r in rows) > 0.85
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    # labels that are held out are never learnt from
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.score(docs.limit(200), x, keep=("doc_id",)).orderBy("doc_id").collect() for x in (labels, flipped))
    assert a == b


def test_toxicity_of_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)] + [(None, 1), (3, None), (5, 7)], "doc_id bigint, toxic int")
    rows = toxicity.score(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (0, 1, 2, 3)}) == 1
    assert toxicity.drop_toxic(odd, labels).columns == odd.columns
    assert toxicity.score(empty, labels).collect() == []
    assert len({r["score"] for r in toxicity.score(odd, labels.limit(0)).collect()}) == 1
    key = lambda r: (str(r["doc_id"]), r["lang"] or "", round(r["score"], 9), r["predicted"])
    joined = toxicity.score(odd, labels, most_keys=0)  # the tables are joined, not broadcast
    assert Counter(map(key, joined.collect())) == Counter(map(key, rows)) and joined.columns == toxicity.score(odd, labels).columns


def brute_evidence(train, text):
    """The evidence of a text by the two models, from (text, toxic) rows."""
    import math

    split = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    pairs = lambda t: list(zip(["", *split(t)], split(t)))
    held = [Counter(p for t in sorted({t for t, y in train if y == c}) for p in set(pairs(t))) for c in (0, 1)]
    follows = [Counter(w for _, w in h) for h in held]
    shared = Counter(w for _, w in set(held[0]) | set(held[1]))
    off = lambda n: {0: 0.0, 1: 1.0, 2: 1.5}.get(n, 2.0)

    def word(c, w):
        total = sum(follows[c].values())
        left = max(sum(map(off, follows[c].values())) / total, 1e-6) if total else 1.0
        n = follows[c][w]
        return (n - off(n)) / max(total, 1) + left * (shared[w] + 0.5) / (sum(shared.values()) + 0.5 * (len(shared) + 1))

    def after(c, v, w):
        own = {p: n for p, n in held[c].items() if p[0] == v}
        total, rest = sum(own.values()), sum(min(n, 3) for n in own.values())
        return (max(held[c][v, w] - 3, 0) + (rest + 1) * word(c, w)) / (total + 1)

    own = pairs(text)
    return sum(max(math.log(after(1, v, w) / after(0, v, w)) - 2.0, 0.0) for v, w in own) / math.sqrt(max(len(own), 1))


@pytest.mark.parametrize("most_keys", [1000, 0])
def test_toxic_evidence_is_brute_force(spark, most_keys):
    """Words of one class, a phrase of words that both classes have, repeated and unknown words."""
    from pyspark.sql import functions as F

    clean = [sentence(i, 30) for i in range(60)] + [f"you are very kind number{i % 7}" for i in range(20)] + [sentence(1, 30)] * 9
    toxic = [f"{sentence(i, 20)} vile{i % 3} you are so not kind {sentence(i + 7, 5)}" for i in range(100, 130)] + ["vile1 " * 9, "so not kind"]
    train = [(t, 0) for t in clean] + [(t, 1) for t in toxic]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(train)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(train)], "doc_id bigint, toxic int")
    learnt = {r["doc_id"] for r in labels.filter(~toxicity.held_out("doc_id")).collect()}
    found, curve = toxicity.train(docs, labels, most_keys=most_keys)
    probe = ["so not kind", "you are very kind", "vile0 vile1 unheard of", "", sentence(3, 12), "vile2 " + sentence(101, 20), "you are so not kind"]
    rows = spark.createDataFrame(list(enumerate(probe)), "doc_id bigint, text string")
    got = toxicity._with_evidence(rows, found, F.col("text"), F.lit(0), "x", toxicity.row_key(rows), most_keys)
    want = [brute_evidence([t for i, t in enumerate(train) if i in learnt], t) for t in probe]
    assert [r["x"] for r in got.orderBy("doc_id").collect()] == pytest.approx(want, abs=1e-9)
    assert want[0] > 0 and want[1] == want[3] == 0 and curve.slope > 0  # the phrase tells, though its words stand in both classes


def test_words_match_the_tests(odd):
    assert all([w.decode() for w in decontaminate.words_of(t)] == words(t) for t in odd_texts())
