"""Unit cases of the column functions."""

import gzip
import random
import re

import pytest
from pyspark.sql import functions as F

from sentweave.functions import encoding, english, japanese, text, urls
from sentweave.operators import annotate, formatter, html, papers, provenance
from sentweave.sources import readers


def run(spark, f, values):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, c string")
    return [r["r"] for r in rows.select("i", f(F.col("c")).alias("r")).orderBy("i").collect()]


def test_japanese_sentences(spark):
    cases = {
        "あまり気の毒だから「行く事は行くがじき帰る。来年の夏休みにはきっと帰る」と慰めてやった。": 1,
        "今日は晴れ。（たぶん）明日は雨。": ["今日は晴れ。", "（たぶん）", "明日は雨。"],
        "すごい！と思った。": 1,
        "本当？ですか。": 1,
        "Ａ・・・Ｂ": ["Ａ・・・", "Ｂ"],
        "３．１４です。": 1,
        "散歩？？かな。": ["散歩？？", "かな。"],
        "終わり。」次。": ["終わり。」", "次。"],
        "": [],
    }
    got = run(spark, japanese.split_japanese, list(cases))
    for (given, want), found in zip(cases.items(), got):
        assert found == ([given] if want == 1 else want)


def test_very_long_words_and_runs_of_marks(spark):
    n = 1_000_000
    lines = ["a" * n, "a." * (n // 2), "1,2" * (n // 3), "it's" * (n // 4), "." * n, "'" * 999 + "a-" * n, "see " + "Zm9vYmFy" * (n // 8) + " end"]
    for language in ("en", "fr", "de"):
        got = run(spark, lambda c: F.transform(english.tokens(c, language), F.length), lines)
        assert [sum(x) for x in got] == [len(x.replace(" ", "")) - (499 if x[0] == "'" else 0) for x in lines]
        assert got[0] == [n] and got[-1] == [3, n, 3]
    faces = run(spark, lambda c: F.transform(japanese.split_at_emoticons(c), F.length), ["（笑）" * n + "あ"])
    assert faces == [[3 * n, 1]]


def test_shares_round_halves_upwards(spark):
    assert run(spark, japanese.particle_ratio, ["が" * 51 + "x" * 269, "が" + "x" * 63_999, "が" * 3, ""]) == [0.15938, 0.00002, 1.0, None]
    assert run(spark, japanese.japanese_score, ["か" * 51 + "x" * 269, ""]) == [0.15938, 0.0]


def test_every_member_of_a_gzip_file(spark):
    one, two, three = (gzip.compress(x) for x in (b"one\n", b"two\n" * 9999, b""))
    raw = [one + two + three, one + b"\0" * 512, one + b"\0" * 5 + two, one + b"garbage", one + two[:-4], one[:-9], b"plain", b"", None]
    want = [b"one\n" + b"two\n" * 9999, b"one\n", b"one\n" + b"two\n" * 9999, b"one\n", None, None, b"plain", b"", None]
    got = spark.createDataFrame(list(enumerate(raw)), "i int, raw binary").select("i", encoding.gunzip(F.col("raw")).alias("b")).orderBy("i").collect()
    assert [None if r["b"] is None else bytes(r["b"]) for r in got] == want


def test_header_styles(spark):
    crawler = "HTML http://a/ NOCACHE\nDate: Tue, 03 Jul 2007 10:00:00 GMT\n<html>x</html>\n\nlater"
    blank = "HTML http://a/ NOCACHE\r\nDate: Tue, 03 Jul 2007 10:00:00 GMT\r\n\r\n<html>y</html>"
    wget = "HTTP/1.1 200 OK\nDate: Tue, 03 Jul 2007 10:00:00 GMT\nX: 1\n\r\n<html>z</html>\n\n"
    plain = "<html>\nno header</html>"
    endless = "HTML http://b/\nDate: x\n<html>"
    pages = [crawler, blank, wget, plain, endless]
    got = {style: [tuple(r) for r in run(spark, lambda c: readers.crawler_header(c, style), pages)] for style in ("crawler", "inprocess", "wget")}
    when = "2007-07-03 10:00:00 GMT"
    assert got["crawler"][:2] == [("http://a/", when, True, False, "<html>x</html>\n\nlater"), ("http://a/", when, True, False, "<html>y</html>")] and got["crawler"][4][4] == "<html>"
    assert got["inprocess"] == [("http://a/", when, False, False, "later"), ("http://a/", when, False, False, "<html>y</html>"), (None, None, False, False, wget), (None, None, False, False, plain), ("http://b/", None, False, False, "")]
    assert got["wget"][2] == (None, when, False, False, "<html>z</html>\n\n") and got["wget"][3] == (None, None, False, False, plain)


def test_references_are_resolved_as_the_rfc_has_it(spark):
    from urllib.parse import urljoin

    bases = ["http://a/b/c/d;p?q", "http://a", "http://a/", "https://h:8080/x/y/?z#f", "http://a/b"]
    hrefs = ["g", "./g", "g/", "/g", "//g/h", "?y", "g?y", "#s", "g#s", "g?y#s", ";x", "", ".", "./", "..", "../", "../g", "../..", "../../g", "../../../g", "/./g", "/../g", "g.", "..g", "./../g", "./g/.", "g/./h", "g/../h", "http://o/p/../q", "mailto:x@y"]
    rows = spark.createDataFrame([(b, h) for b in bases for h in hrefs], "b string, h string").select("b", "h", urls.resolved(F.col("b"), F.col("h")).alias("r")).collect()
    wrong = [(r["b"], r["h"], r["r"], urljoin(r["b"], r["h"])) for r in rows if r["r"] != (urljoin(r["b"], r["h"]) if r["h"] else r["b"].split("#")[0])]
    assert not [w for w in wrong if w[1] != "http://o/p/../q"], wrong
    odd = spark.createDataFrame([("http://a/", "x\x01\ty"), (None, "x\ny"), ("http://a/", None), ("http://a/b/c", "d//e"), ("http://a/b", "/c//../d")], "b string, h string").select(urls.resolved(F.col("b"), F.col("h")).alias("r")).collect()
    assert [r["r"] for r in odd] == ["http://a/xy", "xy", None, "http://a/b/d//e", "http://a/c/d"]


def test_emoticons_and_items(spark):
    assert run(spark, japanese.split_at_emoticons, ["なるほど（笑）次へ", "（爆）（笑）あ"]) == [["なるほど（笑）", "次へ"], ["（爆）（笑）", "あ"]]
    rows = spark.createDataFrame([(0, ["以下のお店、", "１．さえずり", "２．のら酒房", "は美味しいです。"]), (1, ["以下にお店を列挙します。", "１．さえずり", "２．のら酒房"])], "i int, s array<string>")
    got = [r["m"] for r in rows.select("i", japanese.merge_items(F.col("s")).alias("m")).orderBy("i").collect()]
    assert got == [["以下のお店、　１．さえずり　２．のら酒房　は美味しいです。"], ["以下にお店を列挙します。", "１．さえずり", "２．のら酒房"]]


def test_english_sentences(spark):
    cases = {
        "Dr. Smith went home. He slept.": 2,
        "He met John Jr. Then he left.": 2,
        "It closed at 5 p.m. EST today.": 1,
        "J. Smith came.": 1,
        "What? no.": 1,
        "What? No.": 2,
        'He left. "Why?" she asked.': 2,
        "one two": 1,
        "Stop! -- Then go.": 2,
        "": 0,
    }
    assert [len(x) for x in run(spark, english.split_english, list(cases))] == list(cases.values())
    assert run(spark, english.split_english, ["  a  b\tc. "]) == [["a b c."]]


def test_english_tokens(spark):
    cases = {"Mr. Smith isn't here.": "Mr. Smith isn 't here .", "5,300 units, ok": "5,300 units , ok", "No. 5 wins.": "No. 5 wins .", "No. Never.": "No . Never .", "wait... what?": "wait ... what ?", "": ""}
    assert run(spark, english.tokenize, list(cases)) == list(cases.values())
    assert run(spark, lambda c: english.tokenize(c, "fr"), ["l'eau"]) == ["l' eau"]
    assert run(spark, lambda c: english.tokenize(c, "de", {"bzw": 1, "Nr": 2}), ["A bzw. B. Nr. 5 Nr. X"]) == ["A bzw. B . Nr. 5 Nr . X"]


@pytest.mark.parametrize(
    ("given", "options", "want"),
    [
        ("■お知らせです。", {}, None), ("ホーム｜検索", {}, None), ("東京都", {}, None), ("………", {}, None), ("", {}, None), ("あ" * 256, {}, None), ("■お知らせです。", {"save_all": True}, "■お知らせです。"),
        ("宮本議長（８６）のインタビュー。", {}, "宮本議長のインタビュー。"), ("改革の柱として（１）甲（２）乙を挙げた。", {"paren": "include"}, "改革の柱として（１）甲（２）乙を挙げた。"), ("改革の柱として（１）甲（２）乙を挙げた。", {}, None),
        ("嬉しい（＾＿＾）です。", {}, "嬉しい（＾＿＾）です。"), ("外（内（中）内）外。", {}, "外外。"), ("「星」＝米長＝と言う", {"newspaper": True}, "「星」と言う"), ("　――始まり", {}, "始まり"), ("（全部）", {}, None),
    ],
)
def test_formatting(spark, given, options, want):
    assert run(spark, lambda c: formatter.format_sentence(c, **options)["sentence"], [given]) == [want]


def test_divided_remarks(spark):
    got = run(spark, lambda c: formatter.format_sentence(c, paren="divide")["parens"], ["宮本議長（８６）のインタビュー。", "脆（もろ）さを（帝京大）感じる。"])
    assert [[(p["position"], p["type"], p["text"]) for p in x] for x in got] == [[(4, "年齢", "８６")], [(1, "読み", "もろ"), (7, "その他", "帝京大")]]


def test_scores(spark):
    assert run(spark, japanese.japanese_score, ["日本語ABC", "あー。", ""]) == [0.5, 1.0, 0.0]
    assert run(spark, lambda c: japanese.japanese_score(c, False), ["あー。"]) == [0.66667]
    assert run(spark, japanese.particle_ratio, ["私は学生です", ""]) == [0.33333, None]


def test_normalisation(spark):
    cases = {"ABC 12": "ＡＢＣ　１２", "東京 大阪": "東京大阪", "データ―": "データー", "10￣20": "１０〜２０", "ｶﾞﾊﾟ": "ガパ", "a  -  b": "ａ－ｂ".replace("－", "−")}
    assert run(spark, text.normalise_japanese, list(cases)) == list(cases.values())
    assert run(spark, text.decode_entities, ["a&nbsp;b &amp;lt; &#12354; &quot;x", "&#0;&#x;"])[0] == 'a b &lt; あ "x'
    assert run(spark, text.http_date, ["Tue, 03 Jul 2007 10:00:00 GMT", "x"]) == ["2007-07-03 10:00:00 GMT", None]
    assert run(spark, text.paragraphs, ["\na\nb\n\n\nc\n"]) == [["a b", "c"]]
    assert run(spark, text.escape_bare_ampersands, ["a & b &amp; c"]) == ["a &amp; b &amp; c"]
    assert run(spark, text.join_japanese, ["山田 太郎 abc def"]) == ["山田太郎 abc def"]


def test_urls(spark):
    assert run(spark, urls.canonical, ["HTTP://H.com/a/./b//../c?q=1#f", "ftp://x/", "https://h"]) == ["http://h.com/a/c?q=1", None, "https://h/"]
    kept = run(spark, urls.wanted_href, ["mailto:a@b", "javascript:x", "p.jpg", "/x", "a#b", "", None])
    assert kept == [False, False, False, True, False, False, False]


def test_charsets(spark):
    raws = ["日本語".encode("euc_jp"), "日本語".encode("cp932"), "日本語".encode(), b"plain", "日本".encode("iso2022_jp"), b"\xff\x81", None]
    assert [encoding.guess(r) for r in raws] == ["euc-jp", "shiftjis", "utf8", "ascii", "7bit-jis", None, None]
    rows = spark.createDataFrame([(i, None if r is None else bytearray(r)) for i, r in enumerate(raws)], "i int, raw binary")
    found = rows.withColumn("e", encoding.resolve_encoding(F.col("raw"))).withColumn("t", encoding.decode(F.col("raw"), F.col("e"))).orderBy("i").collect()
    assert [r["t"] for r in found] == ["日本語", "日本語", "日本語", None, "日本", None, None]
    page = '<meta http-equiv="Content-Type" content="text/html; charset=EUC-JP">'.encode() + "あ".encode("euc_jp")
    one = spark.createDataFrame([(bytearray(page),)], "raw binary").select(encoding.resolve_encoding(F.col("raw")).alias("j"), encoding.resolve_encoding(F.col("raw"), language="english").alias("e")).first()
    assert (one["j"], one["e"]) == ("euc-jp", None)


PAGE = '<html><head><title>T</title></head><body><h1>A</h1><p>b <b>c</b> d<br>e</p><script>var t="</p>";</script></body></html>'


def test_detag(spark):
    page = spark.createDataFrame([(1, PAGE)], "page_id int, html string")
    got = html.segments(page).orderBy("seg_no").collect()
    assert [(r["text"], r["heading"], PAGE[r["offset"] : r["offset"] + r["length"]]) for r in got] == [("A", 1, "A"), ("b c d", 0, "b <b>c</b> d"), ("e", 0, "e")]
    assert [r["text"] for r in html.segments(page, ignore_br=True).orderBy("seg_no").collect()][-1].replace("\n", "|") == "b c d|e"
    assert page.select(html.title_of(F.col("html"))).first()[0] == "T"
    assert html.segments(page, always_countup=True).count() == 5


def test_segment_properties(spark):
    given = '<ul><li>x</ul>y<table><td>z</table><font size="+2">big</font><center>m</center><pre>p</pre><div myblocktype="footer">f</div>'
    got = html.segments(spark.createDataFrame([(1, given)], "page_id int, html string")).orderBy("seg_no").collect()
    flags = {r["text"]: r for r in got}
    assert flags["x"]["list"] and not flags["y"]["list"] and flags["z"]["table"] and flags["big"]["fontsize"] == 2 and flags["m"]["center"] and flags["p"]["pre"] and flags["f"]["block_type"] == "footer"


def test_compound_nouns_join_links(spark):
    page = spark.createDataFrame([(1, "<a>情報</a><a>処理</a><a>です</a>")], "page_id int, html string")
    nouns = spark.createDataFrame([("情報処理", 2000), ("処理です", 3)], "noun string, df bigint")
    assert [r["text"] for r in html.segments(page, compound_nouns=nouns).orderBy("seg_no").collect()] == ["情報処理", "です"]


def test_template_and_regions(spark):
    assert run(spark, html.drop_blog_template, ['<html><head>x</head><div id="comments"><div>a</div>b</div>rest</html>', '<div class="trackbacks">open']) == ["<html>rest</html>", ""]
    page = spark.createDataFrame([(1, "<p>a</p><p>b</p>")], "page_id int, html string")
    marks = F.array(F.struct(F.lit(8).alias("start"), F.lit("footer").alias("block_type")))
    assert html.embed_regions(page, marks).first()["html"] == '<p>a</p><p myblocktype="footer">b</p>'


def test_chunks_and_dependencies(spark):
    conll = "1\tI\tI\tPRP\tPRP\t_\t2\tSUB\t_\t_\n2\trun\trun\tVBP\tVBP\t_\t0\tROOT\t_\t_"
    got = run(spark, annotate.chunks, [conll])[0]
    assert [(c["id"], c["head"], c["token"]["id"]) for c in got] == [("c1", "c2", "t1"), ("c2", "c-1", "t2")]
    deps = run(spark, lambda c: annotate.predicates(annotate.typed_dependencies(c)), ["nsubj(ran-2, dog-1)\nroot(ROOT-0, ran-2)"])[0]
    assert [(d["rel"], d["head_word"], d["dep"]) for d in deps] == [("nsubj", "ran", 1)]


def test_papers(spark):
    assert run(spark, lambda c: papers.divide_text(c, ["参考文献"]), ["本文\n参考文献リスト\n[1] A", "x"]) == [("本文\n", "参考文献リスト\n[1] A"), ("x", "")]
    got = run(spark, lambda c: papers.divide_text(c, papers.REFERENCE_KEYS, papers.REFERENCE_PATTERNS), ["a 文 献 x pp. 3\nb", "a 文献 x", "body References [ 1 x", "[参考文献", None])
    assert got == [("a", " 文 献 x pp. 3\nb"), ("a 文献 x", ""), ("body", " References [ 1 x"), ("", "[参考文献"), (None, "")]
    page = run(spark, papers.paper_page, ["本文 <b>\n謝辞 感謝します\n有難う\n参考文献\n[1]"])[0]
    assert page.count("<DIV") == 3 and "本文 &lt;b&gt;" in page
    rows = spark.createDataFrame([(["ab", "c", "de", "cde"], "cde")], "a array<string>, t string")
    assert rows.select(papers.tag_spans(F.col("a"), F.col("t"))).first()[0] == "B:1,E:2/B:3,E:3"


def test_alignment():
    page = "x ＡＢ b  c d.  Second one"
    assert provenance.align(["b c d.", "Second one", "missing"], page)[:2] == [(9, 7), (18, 10)]
    assert provenance.align(["missing"], page) == [(-1, -1)]
    assert provenance.align(["ａｂ"], "ab") == [(0, 2)]
    assert provenance.align([], "") == []


def brute_spans(tokens, tag):
    whole = [(i, j) for i in range(len(tokens)) for j in range(i, len(tokens)) if "".join(tokens[i : j + 1]) == tag]
    return "/".join(f"B:{i},E:{j}" for i, j in whole)


def test_tag_spans_are_brute_force(spark):
    pick = random.Random(3)
    rows = [([pick.choice(["a", "b", "ab", "漢", "ba"]) for _ in range(pick.randrange(12))], "".join(pick.choices("ab漢", k=pick.randrange(5)))) for _ in range(300)]
    found = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, w array<string>, t string")
    got = found.select("i", papers.tag_spans(F.col("w"), F.col("t")).alias("s")).orderBy("i").collect()
    assert [r["s"] for r in got] == [brute_spans(*r) for r in rows]


def brute_tokens(line):
    """The English rules letter by letter, for lines without backquotes and doubled quotes or commas."""
    out = []
    for i, ch in enumerate(line):
        before, after = line[i - 1 : i] or " ", line[i + 1 : i + 2] or " "
        if ch == ",":
            out.append("," if before.isnumeric() and after.isnumeric() else " , ")
        elif ch == "'":
            if before.isnumeric() and after != "s" and after.isalpha():
                out.append("'")
            else:
                out.append(" '" if (before.isalpha() or before.isnumeric() and after == "s") and after.isalpha() else "'" if before.isnumeric() and not after.isalpha() and after.isnumeric() else " ' ")
        else:
            out.append(ch if ch.isalnum() or ch.isspace() or ch in ".-" else f" {ch} ")
    words = "".join(out).split()
    for i, w in enumerate(words):
        stem, after = w[:-1], words[i + 1] if i + 1 < len(words) else ""
        if len(w) > 1 and w[-1] == "." and not ("." in stem and any(map(str.isalpha, stem)) or stem in english.PREFIXES["en"] or after[:1].islower() or stem in english.NUMERIC_PREFIXES["en"] and after[:1].isdigit()):
            words[i] = stem + " ."
    return " ".join(words)


def test_tokens_of_documents_are_brute_force(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.explode(F.split("text", "\n")).alias("line")).distinct()
    rows = lines.select("line", english.tokenize(F.col("line")).alias("t")).collect()
    plain = [r for r in rows if not re.search(r"``|`|''|,,|\.\.|[0-9]'[^s]|''|'[^\w]|[^\w]'|[^\x00-\u024f]", r["line"])]
    assert len(plain) > 0.5 * len(rows)
    wrong = [(r["line"], r["t"], brute_tokens(r["line"])) for r in plain if r["t"] != brute_tokens(r["line"])]
    assert not wrong, wrong[:3]


def test_japanese_normalisation_works_each_step_out_once(spark):
    """Widths are changed in one place of the plan; runs of blanks and of long marks come out as single ones do."""
    from pyspark.sql import functions as F
    from sentweave.functions import text

    rows = spark.createDataFrame([("ア―−ー‐イ 亜  a  b 亜 c",), ("―ア１￣２",)], "c string").select(text.normalise_japanese(F.col("c")).alias("n"))
    assert [r["n"] for r in rows.collect()] == ["アーーーーイ亜ａ　ｂ亜ｃ", "―ア１〜２"]
    assert rows._jdf.queryExecution().analyzed().toString().count(text.WIDE_ASCII) == 1
