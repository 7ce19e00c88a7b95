"""Queries that SQL can't express against plain Python, over whole tables."""

import hashlib
import random
import re

import pytest

from sentweave.functions import english, text
from sentweave.operators import annotate
from sentweave.plans import text_queries


def digest(s: str) -> str:
    return hashlib.md5(s.encode()).hexdigest()


def brute_tokens(line: str, lang: str) -> str:
    """Character by character; then periods that close a word."""
    line, out, cur, i = line.replace("`", "'"), [], "", 0

    def flush() -> None:
        nonlocal cur
        if cur:
            out.append(cur)
        cur = ""

    while i < len(line):
        ch, prev, nxt = line[i], line[i - 1 : i] if i else "", line[i + 1 : i + 2]
        if ch in " \t\n\x0b\x0c\r":
            flush()
        elif ch == "." and nxt == ".":
            flush()
            while line[i : i + 1] == ".":
                cur, i = cur + ".", i + 1
            flush()
            continue
        elif ch == "'" and nxt == "'":
            flush()
            out.append('"')
            i += 1
        elif ch == "'" and lang == "en" and ((prev.isalpha() and nxt.isalpha()) or (prev.isdecimal() and nxt == "s")):
            flush()
            cur = "'"
        elif ch == "'" and lang == "fr" and prev.isalpha() and nxt.isalpha():
            cur += ch
            flush()
        elif ch.isalpha() or ch.isdecimal() or ch in "-." or (ch == "," and prev.isdecimal() and nxt.isdecimal()) or (ch == "'" and lang == "en" and prev.isdecimal() and nxt.isalpha()):
            cur += ch
        else:
            flush()
            out.append(ch)
        i += 1
    flush()
    done = []
    for k, w in enumerate(out):
        after = out[k + 1] if k + 1 < len(out) else ""
        stem = w[:-1]
        stays = ("." in stem and any(c.isalpha() for c in stem)) or stem in english.PREFIXES["en"] or after[:1].islower() or (stem in english.NUMERIC_PREFIXES["en"] and after[:1].isdigit())
        done += [stem, "."] if re.search(r"[^.]\.$", w) and not stays else [w]
    return " ".join(done)


def test_tokens_are_brute_force(spark, sf_dir):
    rows = {(r["doc_id"], r["line_no"]): r["line"] for r in text_queries.lines(spark, sf_dir).collect()}
    got = text_queries.tokenizer_languages(spark, sf_dir).collect()
    assert len(got) == len(rows)
    for r in got:
        line = rows[r["doc_id"], r["line_no"]]
        assert [r[lang] for lang in ("en", "fr", "de")] == [digest(brute_tokens(line, lang)) for lang in ("en", "fr", "de")], line
    whole = {(r["doc_id"], r["line_no"]): (r["n_tokens"], r["digest"]) for r in text_queries.english_tokenize(spark, sf_dir).collect()}
    for key, line in rows.items():
        t = brute_tokens(line, "en")
        assert whole[key] == (len(t.split()), digest(t))


@pytest.mark.parametrize(
    ("given", "en", "fr", "other"),
    [
        ("Isn't 5's l'eau", "Isn 't 5 's l 'eau", "Isn' t 5 ' s l' eau", "Isn ' t 5 ' s l ' eau"),
        ("a,b 1,5 ,x 3, 4", "a , b 1,5 , x 3 , 4", "a , b 1,5 , x 3 , 4", "a , b 1,5 , x 3 , 4"),
        ("``Hi'' (end)...", '" Hi " ( end ) ...', '" Hi " ( end ) ...', '" Hi " ( end ) ...'),
        ("U.S. Dr. No. 5 end. No. x", "U.S. Dr. No. 5 end . No. x", "U.S. Dr. No. 5 end . No. x", "U.S. Dr. No. 5 end . No. x"),
    ],
)
def test_tokens_by_hand(spark, given, en, fr, other):
    from pyspark.sql import functions as F

    (row,) = spark.createDataFrame([(given,)], "c string").select(*[english.tokenize(F.col("c"), lang).alias(lang) for lang in ("en", "fr", "de")]).collect()
    assert tuple(row) == (en, fr, other)


@pytest.mark.parametrize(
    ("given", "want"),
    [
        ('He left. "Why?" she asked.', ["He left.", '"Why?" she asked.']),
        ("It ended (really.) Then more.", ["It ended (really.)", "Then more."]),
        ("At 5 p.m. EST today. At 5 p.m. Today.", ["At 5 p.m. EST today.", "At 5 p.m.", "Today."]),
        ("J. R. Smith met M.D. Jones. e.g. this one", ["J. R. Smith met M.D.", "Jones. e.g. this one"]),
        ("Stop! -- Then go. -- 'Now' . Then", ["Stop!", "-- Then go.", "-- 'Now' .", "Then"]),
        ("No end here", ["No end here"]),
    ],
)
def test_boundaries_by_hand(spark, given, want):
    from pyspark.sql import functions as F

    assert spark.createDataFrame([(given,)], "c string").select(english.split_english(F.col("c")).alias("s")).first()["s"] == want


def brute_normal(c: str, preformatted: bool) -> str:
    wide = "[　-。・-；゛-龠]"
    for left, right in ((wide, wide), (wide, "[!-~]"), ("[!-~]", wide)):
        c = re.sub(f"(?<={left}) +(?={right})", "", c)
    if preformatted:
        c = re.sub("(?<=[a-zA-Z0-9]) +(?=[a-zA-Z0-9])", " ", c)
        c = re.sub(" {2,}", "", c)
    else:
        c = re.sub(r"[ \t\n\x0b\x0c\r]+", " ", c)
    for marks, mark in ((text.VOICED, "ﾞ"), (text.SEMI_VOICED, "ﾟ")):
        for half, full in marks.items():
            c = c.replace(half + mark, full)
    c = c.translate(str.maketrans(text.ASCII + " " + text.HALF_KANA, text.WIDE_ASCII + "　" + text.FULL_KANA))
    out, kana = [], False
    for ch in c:  # a dash after katakana, or after dashes that follow it
        is_dash = ch in "―−─━‐"
        out.append("ー" if kana and is_dash else ch)
        kana = ("ァ" <= ch <= "ヺ") or "ㇰ" <= ch <= "ㇿ" or ch in "ヽヾ" or (kana and (is_dash or ch == "ー"))
    c = "".join(out).translate(str.maketrans(text.UNSAFE, text.SAFE))
    c = re.sub("([０-９0-9])￣(?=[０-９0-9])", r"\1〜", c)
    return re.sub("([０-９0-9])([^０-９0-9￣]{1,2})￣([０-９0-9]+)\\2", r"\1\2〜\3\2", c)


def test_normalisation_is_brute_force(spark, sf_dir):
    rows = {(r["doc_id"], r["line_no"]): r["c"] for r in text_queries.kana_lines(spark, sf_dir).collect()}
    for r in text_queries.japanese_normalisation(spark, sf_dir).collect():
        c = rows[r["doc_id"], r["line_no"]]
        assert (r["body"], r["title"]) == (digest(brute_normal(c, True)), digest(brute_normal(c, False))), c


def test_pages_in_japanese_keep_their_bytes(spark, sf_dir):
    rows = text_queries.japanese_page_sentences(spark, sf_dir).collect()
    assert len(rows) > 1000 and all(r["matches"] for r in rows)


def test_annotation_is_the_taggers(spark, sf_dir):
    tag = annotate.rule_tagger()
    found = text_queries.lines(spark, sf_dir)
    from pyspark.sql import functions as F

    rows = {(r["doc_id"], r["line_no"], r["k"]): r["s"] for r in found.select("doc_id", "line_no", F.posexplode(english.split_english(F.col("line"))).alias("k", "s")).collect()}
    got = text_queries.annotated_sentences(spark, sf_dir).collect()
    assert len(got) == len(rows)
    for r in got:
        s = rows[r["doc_id"], r["line_no"], r["k"]]
        wanted = 0 < len(s) <= 130 and not re.search("[０-９0-9　 ]{10,}", s)
        assert r["analysis"] == (digest(tag(s)) if wanted else None) and r["error"] is None


def test_repeated_blocks_stand_where_they_were_taken_from():
    """Each repeat lacks other characters, so none of its runs tells which repeat it is."""
    from sentweave.operators import provenance

    for seed in range(60):
        rng = random.Random(seed)
        word = lambda: rng.choice("the and of to in ha th er on that it was".split())
        block = [" ".join(word() for _ in range(rng.choice((1, 2, 3, 20)))).capitalize() + "." for _ in range(rng.randrange(3, 9))]
        lines, at, raws, want = block * 12, 0, [], []
        for i, s in enumerate(lines):
            half = len(s) // 2
            raws.append((s[:half] + s[half + i % 11 :] if len(s) > 40 else s).replace(" ", ""))
            want.append((at, len(s)))
            at += len(s) + 1
        assert provenance.align(raws, " ".join(lines)) == want, seed
    opening, long = "One two. ", "erhantor " * 40 + "Reention. "
    found = provenance.align(["Onetwo.", *["Reention."] * 9], opening + long + "Reention. " * 9)
    assert found[1:] == [(len(opening + long) + 10 * i, 9) for i in range(9)]
    page = "One. " + "The " * 60 + "end. </p>Mid. " + "The " * 5 + "</p>Last."  # the long one goes, and opens like the short one
    shown = page.replace("</p>", "    ")
    found = provenance.align(["One.", "Mid.", "The" * 5, "Last."], shown)
    assert [shown[o : o + n] for o, n in found] == ["One.", "Mid.", "The The The The The", "Last."] and found[2][0] == page.index("Mid.") + 5
    page = "One. " + "The " * 60 + "eronnd. " * 30 + "</p>" + "The " * 5 + "</p>Last."
    found = provenance.align(["One.", "The" * 5, "Last."], page.replace("</p>", "    "))
    assert found[1] == (page.index("</p>") + 4, 19) and found[2][0] == page.index("Last.")


def test_keys_are_those_of_each_character():
    from sentweave.operators import provenance

    rng, signs = random.Random(3), "abz ?.,　ａＢ？ー―−‐㍻…½ｶﾞｱﾟ\x07\n\x7féÁ日本語😀™ﾞ"
    for _ in range(500):
        texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(12))) for _ in range(3)]
        for t, found in zip(texts, provenance.keys_of(texts)):
            want, at = [], 0
            for m in re.finditer("[ｦ-ﾝ][ﾞﾟ]|.", t, re.S):
                end = at + len(m[0].encode())
                want += [(k, at, end) for k in provenance._key(m[0])]
                at = end
            assert found == "".join(k for k, *_ in want), t
            assert [(chr(k), int(a), int(b)) for k, a, b in zip(*provenance.keyed(t))] == want, t
