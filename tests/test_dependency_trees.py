"""Chunk trees of analyser text, with a made analyser."""

import random

from pyspark.sql import functions as F

from sentweave.operators import annotate, dependency_trees

BLOB = """# S-ID:1 SCORE:-12.5
* 1D <体言>
+ 1D <体言><係:ガ格>
太郎 たろう 太郎 名詞 6 人名 5 * 0 * 0 "代表表記:太郎/たろう" <代表表記:太郎/たろう><内容語>
が が が 助詞 9 格助詞 1 * 0 * 0 NIL <付属>
!! 0 1D <見出し:太郎が>
! 0 <SYNID:太郎/たろう><スコア:1>
! 0,1 <SYNID:s7:人><スコア:0.9>
* 2D <体言>
+ 3D <体言><係:ヲ格>
* ほし * 記号 1 * 0 * 0 * 0 NIL <準内容語>
を を を 助詞 9 格助詞 1 * 0 * 0 NIL
* -1D <用言:動>
+ 3D <用言:動><格解析結果:読む/よむ:動1:ガ/C/太郎/0/0/1;ヲ/C/星/1/0/1;ガ２/O/何/9/0/1;デ/U/-/-/-/-;未知/C/x/0/0/1>
読んだ よんだ 読む 動詞 2 * 0 子音動詞マ行 9 タ形 10 "代表表記:読む/よむ" <代表表記:読む/よむ><内容語>
+ 9D <用言:形><格解析結果:良い/よい:形1:ガ/C/x/2/0/1>
よ よ よい 形容詞 3 * 0 * 0 * 0 NIL <内容語>
EOS
after the end"""


def test_tree_and_predicates(spark):
    t = dependency_trees.tree_of(BLOB)
    assert t["score"] == -12.5 and [c["id"] for c in t["chunks"]] == ["c0", "c1", "c2", "c3"]
    assert [c["head"] for c in t["chunks"]] == ["c1", "c3", "c3", "c-1"] and [c["root"] for c in t["chunks"]] == ["c3"] * 4
    assert [c["category"] for c in t["chunks"]] == ["体言", "体言", "用言:動", "用言:形"] and "体言" not in t["chunks"][0]["feature"]
    words = [w for c in t["chunks"] for w in c["tokens"]]
    assert [w["surf"] for w in words] == ["太郎", "が", "*", "を", "読んだ", "よ"] and words[0]["rep"] == "太郎/たろう" and words[3]["rep"] == "を/を"
    assert words[4]["predicate"] == [{"case": "ga", "token": "t0"}, {"case": "wo", "token": "t2"}] and words[5]["predicate"] == [{"case": "ga", "token": "t4"}]
    assert words[0]["synnodes"] == [{"synid": "太郎/たろう", "wordid": "t0", "score": "1"}] and words[1]["synnodes"][0]["wordid"] == "t0,t1"
    df = spark.createDataFrame([(BLOB,), ("",), (None,), ("no chunks\nEOS",)], "b string").select(dependency_trees.tree(F.col("b")).alias("t"))
    xml = df.select(dependency_trees.to_xml(F.col("t")).alias("x"), dependency_trees.predicates(F.col("t")).alias("p")).collect()
    assert [tuple(p) for p in xml[0]["p"]] == [("t4", "ga", "t0"), ("t4", "wo", "t2"), ("t5", "ga", "t4")]
    assert '<Predicate ga="t0" wo="t2"/>' in xml[0]["x"] and xml[1]["x"] == "<Annotation></Annotation>" and xml[2]["x"] is None and xml[3]["p"] == []
    back = df.select(dependency_trees.from_xml(dependency_trees.to_xml(F.col("t"))).alias("c")).first()["c"]
    assert [(c["id"], c["head"]) for c in back] == [(c["id"], c["head"]) for c in t["chunks"]]
    again = [w for c in back for w in c["tokens"]]
    assert [(w["id"], w["surf"], dict(w["predicate"]), list(w["synids"])) for w in again] == [(w["id"], w["surf"], {p["case"]: p["token"] for p in w["predicate"]}, [s["synid"] for s in w["synnodes"]]) for w in words]
    assert "feature" not in df.select(dependency_trees.to_xml(F.col("t"), simple=True).alias("x")).first()["x"]


def test_roots_by_pointer_jumping():
    rng = random.Random(2)
    assert dependency_trees.roots([]) == [] and dependency_trees.roots([0]) == [-1] and dependency_trees.roots([-1]) == [0] and dependency_trees.roots([5]) == [0]
    for _ in range(400):
        n = rng.randrange(1, 40)
        heads = [rng.randrange(-1, n + 2) for _ in range(n)]
        want = []
        for i in range(n):
            seen = set()
            while i not in seen and 0 <= heads[i] < n:
                seen.add(i)
                i = heads[i]
            want.append(-1 if i in seen else i)
        assert dependency_trees.roots(heads) == want
    chain = [i + 1 for i in range(100_000)]
    assert dependency_trees.roots(chain) == [99_999] * 100_000


def made(words: list[tuple[str, str, str, str]]) -> str:
    """Analyser text of ``(surface, base form, part of speech, chunk's feature)``; a word with a feature opens a chunk."""
    lines = []
    for surf, orig, pos, feature in words:
        lines += [f"+ -1D {feature}"] if feature else []
        lines.append(f"{surf} x {orig} {pos} 1 * 0 * 0 * 0 NIL")
    return "\n".join([*lines, "EOS"])


def test_long_sentences_by_the_tree(spark):
    """The cut is where the analysis has a strong boundary in the middle part, not where the letters look like one."""
    fill = lambda n, f="<体言>": [("あ" * n, "あ", "名詞", f)]
    ga = [("走る", "走る", "動詞", "<ID:〜が>"), ("が", "が", "助詞", ""), ("、", "、", "特殊", "")]
    deari = [("学生", "学生", "名詞", "<ID:〜であり>"), ("であり", "だ", "判定詞", ""), ("、", "、", "特殊", "")]
    teori = [("走って", "走る", "動詞", "<ID:〜ており>"), ("おり", "おる", "接尾辞", ""), ("、", "、", "特殊", "")]
    cases = []
    for middle, end in ((ga, "走る。"), (deari, "学生だ。"), (teori, "走っているいる。"[:3] + "いる。")):
        words = fill(15) + fill(15) + middle + fill(40)
        cases.append((words, ["あ" * 30 + end, "あ" * 40]))
    early = fill(10) + ga + fill(70)  # before 30 %
    late = fill(40) + fill(30) + ga + fill(10)  # begins beyond 70 %
    short = fill(30) + ga + fill(20)
    looks = [("あ" * 35 + "が、" + "あ" * 40, "あ", "名詞", "<体言>")]
    two = fill(30) + ga + fill(5) + ga + fill(30)  # the first one counts, the second stays
    cases += [(early, None), (late, None), (short, None), (looks, None), (two, ["あ" * 30 + "走る。", "あ" * 5 + "走るが、" + "あ" * 30])]
    said = ["".join(w[0] for w in words) for words, _ in cases]
    want = [[s] if w is None else w for s, (_, w) in zip(said, cases)]
    assert [dependency_trees.long_parts(s, made(words)) for s, (words, _) in zip(said, cases)] == want
    table = dict(zip(said, [made(w) for w, _ in cases]))
    annotate.register_annotator("made", lambda: table.__getitem__)
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(said)] + [(99, None), (100, "x" * 90)], "i int, raw_string string")
    found = annotate.annotate(rows, "made", condition=F.length("raw_string") > 0)
    got = {r["i"]: r["p"] for r in found.select("i", dependency_trees.split_long(F.col("raw_string"), F.col("analysis")).alias("p")).collect()}
    assert got == dict(enumerate(want)) | {99: None, 100: ["x" * 90]}


def test_xml_without_the_tree_as_a_column(spark):
    rows = [(BLOB,), ("",), (None,), ("no chunks\nEOS",), ("# SCORE:12345678.25\n* -1D\na&\x01b\t x",), ("# SCORE:0.0001\n+ 0D <\"x\">",)]
    df = spark.createDataFrame(rows, "b string").select("b", dependency_trees.tree(F.col("b")).alias("t"))
    for simple in (False, True):
        got = df.select(dependency_trees.xml_in(F.col("b"), simple).alias("new"), dependency_trees.to_xml(F.col("t"), simple).alias("old")).collect()
        assert [r["new"] for r in got] == [r["old"] for r in got]
    files = [("<A><Chunk id=' c0 ' head='c-1'/><B><Chunk id='no'/></B></A>",), ("<A/>",), ("no xml",), (None,)]
    read = [r["c"] for r in spark.createDataFrame(files, "x string").select(dependency_trees.from_xml(F.col("x")).alias("c")).collect()]
    assert [(c["id"], c["head"], c["type"], c["tokens"]) for c in read[0]] == [("c0", "c-1", None, None)] and read[1:] == [None, None, None]


def test_xml_of_lines_is_remembered_and_read_by_the_builder():
    """A line is cut once; XML that the builder can't take as it stands is read as before."""
    blob = made([("a&b", "a", "名詞", "<体言>"), ("a&b", "a", "名詞", "<体言>"), ("a&b", "a", "名詞", "")])
    before = dependency_trees._written_often.cache_info()
    again = [dependency_trees.xml_of(blob) for _ in range(3)]
    after = dependency_trees._written_often.cache_info()
    assert len(set(again)) == 1 and after.misses - before.misses <= 1 and after.hits - before.hits >= 8
    token = '<Token id="t0" surf="x"><Predicate ga=" t1 " other="t9"/><Predicate ni="t2"/><synnode synid="s"/><synnode/></Token>'
    want = [({"id": "c0"}, [({"id": "t0", "surf": "x"}, {"ni": "t2"}, ["s", None])])]
    for xml in (f'<A><Chunk id="c0">{token}</Chunk></A>', f'<A><!-- x --><Chunk id="c0">{token}</Chunk><p:Chunk/></A>', f'<!DOCTYPE A><A><p:x/><Chunk id="c0">{token}</Chunk></A>', f'<A xmlns="u"><Chunk id="c0">{token}</Chunk></A>'):
        assert dependency_trees.chunks_of(xml) == want, xml
    assert dependency_trees.chunks_of("<A><Chunk></A>") is None and dependency_trees.chunks_of("<Chunk/>") is None
