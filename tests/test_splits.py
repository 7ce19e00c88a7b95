"""Files that are read by splits give what a reader of the whole file gives, wherever the splits lie."""

import gzip
import random
import re

import pytest

from sentweave.operators import papers
from sentweave.sources import crawl, ordered, readers


@pytest.fixture
def by_splits(spark):
    """Sets how many bytes a split has."""

    def cut(size: int) -> None:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield cut
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def whole_pages(raw: bytes) -> list[tuple]:
    """Pages of a dump by a cursor over the whole of it."""
    out, url, header, at = [], None, "", 0
    while at < len(raw):
        end = raw.find(b"\n", at)
        end = len(raw) if end < 0 else end
        line = raw[at:end].decode("utf-8", "replace")
        if m := re.match(":::URL::: (?:\\S+ )?(.*)", line):
            url, header = m[1], ""
        elif (m := re.match(":::HDR::: \\S+ (.*)", line)) and url is not None:
            header += m[1] + "\n"
        elif (m := re.match("(:::CON::: (\\d+)(?: |$))", line)) and url is not None:
            start = at + len(m[1]) + (0 if m[1].endswith(" ") else 1)
            out.append((url, header, raw[start : start + int(m[2])]))
            at, url = start + int(m[2]), None
            continue
        at = end + 1
    return out


def a_dump(rng: random.Random, pages: int) -> bytes:
    """Records with contents that hold marks, line feeds and odd bytes, some without a line feed before the next record."""
    parts = []
    for n in range(pages):
        pieces = [b"<html>", "日本語".encode(), b"\n", b":::URL::: 1 http://not.a.record/\n", b":::CON::: 5 12345", b"\xff\xfe", b"text " * rng.randrange(30), b"x :::URL::: y"]
        body = b"".join(rng.choices(pieces, k=rng.randrange(0, 9)))
        sep = rng.choice([b" ", b"\n"])
        parts.append(b":::URL::: %d http://h/%d\n" % (n, n) + b":::HDR::: 1 Date: d%d\n:::HDR::: 2 X: y\n" % n * rng.randrange(2) + b":::CON::: %d" % len(body) + sep + body + rng.choice([b"", b"\n", b"\nnoise\n"]))
        if n % 9 == 4:
            parts.append(b":::URL::: 7 http://no.content/\n")
    return b"".join(parts)


def test_dumps_at_any_split_size(spark, tmp_path, by_splits):
    rng = random.Random(4)
    files = {"a": a_dump(rng, 60), "b": a_dump(rng, 25), "c": b"", "d": b"nothing here\n", "e": a_dump(rng, 3)[:-20] + b":::URL::: 1 http://cut/\n:::CON::: 900 cut off"}
    big = b":::URL::: 1 http://big/\n:::CON::: %d " % 60_000 + (b"y" * 990 + b"\n:::URL::: ") * 60
    files["f"] = big[: len(b":::URL::: 1 http://big/\n:::CON::: 60000 ") + 60_000] + a_dump(rng, 4)
    want = {}
    for name, raw in files.items():
        (tmp_path / name).write_bytes(raw)
        want[name] = whole_pages(raw)
    members = [a_dump(rng, 20) for _ in range(3)]
    (tmp_path / "g.gz").write_bytes(b"".join(map(gzip.compress, members)))
    want["g.gz"] = whole_pages(b"".join(members))
    for size in (64_000_000, 5000, 700):
        by_splits(size)
        pages = crawl.dump_pages(spark, str(tmp_path), per_directory=10)
        got = {name: [] for name in want}
        for r in sorted(pages.collect(), key=lambda r: (r["path"], r["number"])):
            name = r["path"].rsplit("/", 1)[1]
            assert r["number"] == len(got[name]) and r["directory"] == f"{r['number'] // 10:06d}"
            got[name].append((r["url"], r["header"], bytes(r["content"])))
        assert got == want, size
    assert ordered.lines(spark, str(tmp_path / "a")).rdd.getNumPartitions() > 10


def test_an_empty_folder_of_dumps(spark, tmp_path):
    (tmp_path / "none").write_bytes(b"")
    assert crawl.dump_pages(spark, str(tmp_path)).collect() == []


def test_tagged_lines_at_any_split_size(spark, tmp_path, by_splits):
    rng = random.Random(6)
    sid, page, tags, plain = [], [], [], []
    for i in range(400):
        sid += [f"# S-ID:{i} c{i}"] * rng.choice([1, 1, 1, 2]) + [f"sentence {i} " + "z" * rng.randrange(60)] * rng.choice([0, 1, 1, 2])
        page += [f'<PAGE URL="http://p/{i}">'] + [f"line {k} " + "w" * rng.randrange(40) for k in range(rng.choice([0, 1, 30]))] + ["</PAGE>"]
        tags += [f"<PAPER id={i} source=P{i}.txt>"] + [f"<MATCH type=T{k} pattern_type=Q>m{i}-{k}</MATCH>" for k in range(rng.choice([0, 2, 25]))]
        plain += ["", "x" * rng.randrange(200)]
    for name, rows in {"sid": sid, "page": page, "tags": tags, "plain": plain}.items():
        (tmp_path / name).mkdir()
        for part in range(2):  # files don't know of each other
            (tmp_path / name / f"f{part}").write_text("\n".join(rows[part * 7 :]) + "\n" * part)
    want_sid = sorted((f"f{p}", i, *re.match(r"# S-ID:(\S+) (.*)", a).groups(), b) for p in range(2) for i, (a, b) in enumerate(zip(sid[p * 7 :], sid[p * 7 + 1 :]), 1) if a.startswith("# S-ID") and not b.startswith("# S-ID"))
    want_page, want_tags = [], []
    for p in range(2):
        n, url, paper = 0, None, None
        for i, x in enumerate(page[p * 7 :]):
            if x.startswith("<PAGE"):
                n, url = n + 1, x.split('"')[1]
            elif x and not x.startswith("</PAGE"):
                want_page.append((f"f{p}", n, url, i, x))
        for x in tags[p * 7 :]:
            paper = re.search("source=(P\\d+)", x)[1] if x.startswith("<PAPER") else paper
            if x.startswith("<MATCH"):
                want_tags.append((paper, *re.match("<MATCH type=(\\S+) pattern_type=(\\S+)>(.*)</MATCH>", x).groups()))
    name = lambda f: f.rsplit("/", 1)[1]
    for size in (64_000_000, 3000, 300):
        by_splits(size)
        lines = {k: ordered.lines(spark, str(tmp_path / k)) for k in ("sid", "page", "tags", "plain")}
        assert size > 10**6 or lines["page"].rdd.getNumPartitions() > 4
        assert sorted((name(r["file"]), r["pos"], r["sid"], r["comment"], r["str"]) for r in readers.sid_lines(lines["sid"]).collect()) == want_sid
        assert sorted(((name(r["file"]), r["page"], r["url"], r["pos"], r["str"]) for r in readers.page_lines(lines["page"]).collect()), key=str) == sorted(want_page, key=str)
        assert sorted((tuple(r) for r in papers.tag_lines(lines["tags"]).collect()), key=str) == sorted(want_tags, key=str)
        numbered = {(name(r["file"]), r["pos"]): r["value"] for r in readers.numbered_lines(spark, str(tmp_path / "plain")).collect()}
        assert numbered == {(f"f{p}", i): x for p in range(2) for i, x in enumerate("\n".join(plain[p * 7 :]).split("\n"))} | ({} if plain[-1] else {})
