"""Dependency-analyser text as a chunk tree: chunks and tokens, predicates with their arguments, synonym nodes, XML and long sentences.

A text's lines are read once, in order. Heads are followed by pointer jumping: each round doubles how far every chunk sees, so
that the roots of a tree are known after the logarithm of its chunks; what then still has no root is in a circle.
"""

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate
from xml.etree import ElementTree
from xml.parsers import expat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from sentweave.functions.batches import sliced
from sentweave.operators.annotate import CASES
from sentweave.operators.standard_format import ILLEGAL_XML, _attributes

#: The case names beside CASES that predicates have; features that say what a chunk or a word is.
CASE_NAMES = CASES | {"ガ２": "ga2"}
_CHUNK = re.compile(r"^([*+]) (-?\d+)([A-Z])(?: (.*))?$")
_SYNONYM = re.compile(r"^! (\d+(?:,\d+)*) .*?<SYNID:([^>]+)>(?:.*?<スコア:([^>]+)>)?")
_CASE_RESULT, _CONTENT = re.compile(r'<格解析結果:([^\s">]+)'), re.compile("<(?:準)?内容語>")
_REPRESENTED, _CATEGORY = re.compile(r'<(?:疑似)?代表表記:([^\s">]+)'), re.compile("<((?:用言|体言)[^>]*)>")
#: Marks of strong boundaries, with the word that opens what goes (its base form and part of speech) and what is put in its place.
BOUNDARIES = {"<ID:〜が>": ("が", "助詞", ""), "<ID:〜であり>": ("だ", "判定詞", "だ"), "<ID:〜ており>": ("おる", "接尾辞", "いる")}

_SYN = "struct<synid:string,wordid:string,score:string>"
_TOKEN = f"struct<id:string,surf:string,orig:string,read:string,rep:string,pos1:string,pos2:string,pos3:string,pos4:string,content:boolean,feature:string,predicate:array<struct<case:string,token:string>>,synnodes:array<{_SYN}>>"
_TREE = f"struct<score:double,chunks:array<struct<id:string,head:string,type:string,category:string,feature:string,root:string,tokens:array<{_TOKEN}>>>>"
_STR = pa.string()
_PA_SYN = pa.list_(pa.struct([("synid", _STR), ("wordid", _STR), ("score", _STR)]))
_PA_TOKEN = pa.struct([*((c, _STR) for c in ("id", "surf", "orig", "read", "rep", "pos1", "pos2", "pos3", "pos4")), ("content", pa.bool_()), ("feature", _STR), ("predicate", pa.list_(pa.struct([("case", _STR), ("token", _STR)]))), ("synnodes", _PA_SYN)])
_PA_TREE = pa.struct([("score", pa.float64()), ("chunks", pa.list_(pa.struct([*((c, _STR) for c in ("id", "head", "type", "category", "feature", "root")), ("tokens", pa.list_(_PA_TOKEN))])))])


def roots(heads: list[int]) -> list[int]:
    """The root of each node by pointer jumping; a head outside the nodes makes a root, a node whose way ends in a circle has -1."""
    n = len(heads)
    own = np.arange(n)
    at = np.array(heads, np.int64)
    at = np.where((at < 0) | (at >= n), own, at)
    top = at == own
    top &= (np.array(heads) != own) if n else top  # who hangs on itself is a circle
    for _ in range(max(n - 1, 0).bit_length() + 1):
        at = at[at]
    return np.where(top[at], at, -1).tolist() if n else []


def _word(line: str, number: int) -> dict:
    fields = line.split(" ")
    feature = line[line.index(" <") + 1 :] if " <" in line else ""
    get = lambda i: fields[i] if i < len(fields) and not fields[i].startswith("<") else ""
    star = lambda i: None if get(i) in ("", "*") else get(i)
    rep = _REPRESENTED.search(feature)
    return {
        "id": f"t{number}", "surf": fields[0], "read": get(1), "orig": get(2), "pos1": get(3), "pos2": star(5), "pos3": star(7), "pos4": star(9),
        "rep": rep[1] if rep else f"{get(2)}/{get(2)}", "content": bool(_CONTENT.search(feature)), "feature": feature, "predicate": [], "synnodes": [],
    }


def _cases(feature: str) -> list[tuple[str, int]]:
    """``(case, chunk)`` of a case analysis's filled cases."""
    found = _CASE_RESULT.search(feature)
    parts = found[1].split(":", 2)[2] if found and found[1].count(":") > 1 else ""
    out = {}
    for c in parts.split(";"):
        fields = c.split("/")
        if len(fields) > 3 and fields[3].isdigit() and fields[0] in CASE_NAMES:
            out[CASE_NAMES[fields[0]]] = int(fields[3])
    return list(out.items())


def tree_of(blob: str) -> dict:
    """An analysis as its tree. Chunks are the ``+`` lines, or the ``*`` lines where there are none; an argument is the last content word of its chunk.

    Arguments that name no chunk, or one without a content word, are left out; so are lines before the first chunk. What follows EOS isn't read.
    """
    lines = blob.split("\n")
    lines = lines[: lines.index("EOS")] if "EOS" in lines else lines
    mark = "+" if any(_CHUNK.match(x) and x[0] == "+" for x in lines) else "*"
    score, chunks, words, synonyms, heads = None, [], [], [], []
    for x in lines:
        m = _CHUNK.match(x)
        if m:
            if m[1] == mark:
                feature = m[4] or ""
                category = _CATEGORY.search(feature)
                heads.append(int(m[2]))
                chunks.append({"id": f"c{len(chunks)}", "type": m[3], "category": category[1] if category else "NONE", "feature": feature.replace(category[0], "", 1) if category else feature, "tokens": []})
        elif x.startswith("#"):
            found = re.search(r"SCORE:(-?[\d.]+)", x)
            score = float(found[1]) if found and found[1].count(".") < 2 and found[1] != "." else score
        elif x.startswith("!! "):
            continue
        elif (m := _SYNONYM.match(x)) and chunks:
            synonyms.append((m[1].split(","), m[2], m[3]))
        elif x and chunks:
            words.append(_word(x, len(words)))
            chunks[-1]["tokens"].append(words[-1])
    head_word = {i: next((t["id"] for t in reversed(c["tokens"]) if t["content"]), None) for i, c in enumerate(chunks)}
    for i, (c, top) in enumerate(zip(chunks, roots(heads))):
        c["head"] = f"c{heads[i]}" if 0 <= heads[i] < len(chunks) else "c-1"
        c["root"] = f"c{top}" if top >= 0 else None
        found = [{"case": k, "token": head_word[j]} for k, j in _cases(c["feature"]) if head_word.get(j)]
        for t in c["tokens"]:
            t["predicate"] = found if t["content"] else []
    for ids, synid, points in synonyms:
        if int(ids[-1]) < len(words):
            words[int(ids[-1])]["synnodes"].append({"synid": synid, "wordid": ",".join(f"t{i}" for i in ids), "score": points})
    return {"score": score, "chunks": chunks}


def _over(work, kind: pa.DataType):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in sliced(batches):
            yield pa.array([None if v is None else work(v) for v in batch.to_pylist()], kind)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return run


def tree(blob: Column) -> Column:
    """The chunk tree of an analysis; null for null. See :func:`tree_of`."""
    return F.arrow_udf(_over(tree_of, _PA_TREE), _TREE)(blob)


def predicates(parsed: Column) -> Column:
    """``array<struct<token,case,argument>>`` of a tree: every predicate's filled cases with the words that fill them; see also :func:`predicates_in`."""
    words = F.flatten(F.transform(parsed["chunks"], lambda c: c["tokens"]))
    return F.flatten(F.transform(words, lambda t: F.transform(t["predicate"], lambda p: F.struct(t["id"].alias("token"), p["case"].alias("case"), p["token"].alias("argument")))))


_PREDICATES = pa.list_(pa.struct([("token", _STR), ("case", _STR), ("argument", _STR)]))


def predicates_of(blob: str) -> list[tuple[str, str, str]]:
    """``(token, case, argument)`` of an analysis: the predicates of its :func:`tree_of`, read from the lines without the rest of the tree."""
    lines = blob.split("\n")
    lines = lines[: lines.index("EOS")] if "EOS" in lines else lines
    mark = "+" if any(x[:2] == "+ " and _CHUNK.match(x) for x in lines) else "*"
    heads, found, content, n, filled = [], [], [], -1, None  # last content words of the chunks; predicates; those of the chunk at hand
    for x in lines:
        first = x[:2]
        if first in ("+ ", "* ") and _CHUNK.match(x):
            if x[0] == mark:
                content = []
                heads.append(content)
                filled = _cases(x) if "<格解析結果:" in x else None
                if filled:
                    found.append((content, filled))
        elif x and heads and x[0] != "#" and x[:3] != "!! " and not (x[0] == "!" and _SYNONYM.match(x)):
            n += 1
            if "内容語>" in x and (at := x.find(" <")) >= 0 and _CONTENT.search(x, at + 1):
                content.append(n)
    last = [c[-1] if c else -1 for c in heads]
    return [(f"t{t}", case, f"t{last[k]}") for words, cases in found for t in words for case, k in cases if k < len(last) and last[k] >= 0]


def _predicates(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in sliced(batches):
        found = [None if v is None else predicates_of(v) for v in batch.to_pylist()]
        offsets = np.concatenate([[0], np.cumsum([len(f or ()) for f in found])]).astype(np.int32)
        columns = list(zip(*(p for f in found if f for p in f))) or [(), (), ()]
        rows = pa.StructArray.from_arrays([pa.array(c, _STR) for c in columns], fields=list(_PREDICATES.value_type))
        yield pa.ListArray.from_arrays(pa.array(offsets), rows, mask=pa.array([f is None for f in found]))


def predicates_in(blob: Column) -> Column:
    """:func:`predicates` of an analysis's :func:`tree`, without the tree; null for null."""
    return F.arrow_udf(_predicates, "array<struct<token:string,case:string,argument:string>>")(blob)


def to_xml(parsed: Column, simple: bool = False) -> Column:
    """The tree as an ``Annotation`` element: chunks, tokens, predicates and synonym nodes; ``simple`` leaves categories and features out."""

    def token(t: Column) -> Column:
        cases = F.array_join(F.transform(t["predicate"], lambda p: F.concat(F.lit(" "), p["case"], F.lit('="'), p["token"], F.lit('"'))), "")
        inner = F.concat(
            F.when(F.size(t["predicate"]) > 0, F.concat(F.lit("<Predicate"), cases, F.lit("/>"))).otherwise(""),
            F.array_join(F.transform(t["synnodes"], lambda s: F.concat(F.lit("<synnode"), _attributes(synid=s["synid"], wordid=s["wordid"], score=s["score"]), F.lit("/>"))), ""),
        )
        more = {} if simple else {"content_p": t["content"].cast("int"), "feature": t["feature"]}
        names = _attributes(id=t["id"], surf=t["surf"], orig=t["orig"], read=t["read"], repname=t["rep"], pos1=t["pos1"], pos2=t["pos2"], pos3=t["pos3"], pos4=t["pos4"], **more)
        return F.concat(F.lit("<Token"), names, F.lit(">"), inner, F.lit("</Token>"))

    def chunk(c: Column) -> Column:
        more = {} if simple else {"category": c["category"], "feature": c["feature"]}
        return F.concat(F.lit("<Chunk"), _attributes(id=c["id"], head=c["head"], type=c["type"], **more), F.lit(">"), F.array_join(F.transform(c["tokens"], token), ""), F.lit("</Chunk>"))

    score = _attributes() if simple else _attributes(score=parsed["score"])
    return F.concat(F.lit("<Annotation"), score, F.lit(">"), F.array_join(F.transform(parsed["chunks"], chunk), ""), F.lit("</Annotation>"))


_SPECIAL, _ILLEGAL = re.compile(f'[&<>"]|{ILLEGAL_XML}'), re.compile(ILLEGAL_XML)
_WRITTEN = [(c, "repname" if c == "rep" else c) for c in ("id", "surf", "orig", "read", "rep", "pos1", "pos2", "pos3", "pos4")]


@lru_cache(4096)
def _escaped(v: str) -> str:
    return _ILLEGAL.sub("", v).replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;").replace('"', "&quot;") if _SPECIAL.search(v) else v


def _given(**values: str | None) -> str:
    return "".join([f' {k}="{_escaped(v)}"' for k, v in values.items() if v is not None])


def _number(x: float | None) -> str | None:
    """A double as Spark writes it."""
    if x is None or x in (float("inf"), float("-inf")):
        return x and ("Infinity" if x > 0 else "-Infinity")
    if x == 0 or 1e-3 <= abs(x) < 1e7:
        return repr(x)
    mantissa, power = (f"{abs(x):.{n}e}".split("e") for n in range(1, 17) if float(f"{x:.{n}e}") == x or n == 16).__next__()
    return f"{'-' if x < 0 else ''}{mantissa}E{int(power)}"


def _written(line: str, simple: bool) -> tuple[str, bool]:
    """A word line's ``Token`` from behind its id to the end of the tag, and whether it is a content word."""
    t = _word(line, 0)
    more = "" if simple else f' content_p="{t["content"]:d}" feature="{_escaped(t["feature"])}"'
    return "".join([f' {name}="{_escaped(t[k])}"' for k, name in _WRITTEN[1:] if t[k] is not None]) + more + ">", t["content"]


def _typed(kind: str, feature: str, simple: bool) -> str:
    """A chunk line's ``Chunk`` from behind its head to the end of the tag."""
    if simple:
        return f' type="{kind}">'
    category = _CATEGORY.search(feature)
    return f"{_given(type=kind, category=category[1] if category else 'NONE', feature=feature.replace(category[0], '', 1) if category else feature)}>"


_written_often, _typed_often = lru_cache(32768)(_written), lru_cache(4096)(_typed)
#: Characters of a line at most whose XML is remembered.
REMEMBERED = 400


def xml_of(blob: str, simple: bool = False) -> str:
    """The ``Annotation`` element of an analysis's :func:`tree_of`, as :func:`to_xml` writes it, from the lines without the tree."""
    lines = blob.split("\n")
    lines = lines[: lines.index("EOS")] if "EOS" in lines else lines
    mark = "+" if any(x[:2] == "+ " and _CHUNK.match(x) for x in lines) else "*"
    score, chunks, words, synonyms = None, [], [], {}  # of a chunk: head, XML, cases, its first word, last content word
    for x in lines:
        first = x[:1]
        m = _CHUNK.match(x) if first in ("+", "*") else None
        if m:
            if first == mark:
                feature = m[4] or ""
                chunks.append([int(m[2]), (_typed_often if len(x) <= REMEMBERED else _typed)(m[3], feature, simple), _cases(feature) if "<格解析結果:" in feature else [], len(words), -1])
        elif first == "#":
            found = re.search(r"SCORE:(-?[\d.]+)", x)
            score = float(found[1]) if found and found[1].count(".") < 2 and found[1] != "." else score
        elif not x or x[:3] == "!! " or not chunks:
            continue
        elif first == "!" and (m := _SYNONYM.match(x)):
            ids = m[1].split(",")
            synonyms.setdefault(int(ids[-1]), []).append(f"<synnode{_given(synid=m[2], wordid=','.join(f't{i}' for i in ids), score=m[3])}/>")
        else:
            word = (_written_often if len(x) <= REMEMBERED else _written)(x, simple)
            if word[1]:
                chunks[-1][4] = len(words)
            words.append(word)
    out = ["<Annotation", "" if simple else _given(score=_number(score)), ">"]
    for i, (head, tag, cases, start, _) in enumerate(chunks):
        end = chunks[i + 1][3] if i + 1 < len(chunks) else len(words)
        out.append(f'<Chunk id="c{i}" head="c{head if 0 <= head < len(chunks) else -1}"{tag}')
        cases = "".join([f' {case}="t{chunks[k][4]}"' for case, k in cases if k < len(chunks) and chunks[k][4] >= 0])
        for n in range(start, end):
            token, content = words[n]
            out.append(f'<Token id="t{n}"{token}')
            if content and cases:
                out.append(f"<Predicate{cases}/>")
            if n in synonyms:
                out += synonyms[n]
            out.append("</Token>")
        out.append("</Chunk>")
    return "".join([*out, "</Annotation>"])


def xml_in(blob: Column, simple: bool = False) -> Column:
    """:func:`to_xml` of an analysis's :func:`tree`, without the tree as a column; null for null."""
    return F.arrow_udf(_over(lambda b: xml_of(b, simple), _STR), "string")(blob)


_BLANKS = "".join(map(chr, range(33)))
_CASES = list(CASE_NAMES.values())


def _token(t: ElementTree.Element) -> tuple[dict, dict, list]:
    filled, synids = {}, []
    for x in t:
        if x.tag == "Predicate":
            filled = {c: v.strip(_BLANKS) for c in _CASES if (v := x.get(c)) is not None}
        elif x.tag == "synnode":
            synids.append(x.get("synid"))
    return t.attrib, filled, synids


def chunks_of(xml: str) -> list[tuple[dict, list[tuple[dict, dict, list]]]] | None:
    """``(attributes, [(attributes, predicate, synids)])`` of the Chunk elements of XML and their Tokens; None without any, and for what is no XML."""
    if "xmlns" not in xml and "<!" not in xml:
        try:
            return [(c.attrib, [_token(t) for t in c if t.tag == "Token"]) for c in ElementTree.fromstring(xml) if c.tag == "Chunk"] or None
        except ElementTree.ParseError:  # also for a prefix that nothing declares, which is a part of the name here
            pass
    chunks: list = []
    open_: list[str] = []

    def start(name: str, given: dict) -> None:
        open_.append(name)
        place = open_[1:]
        if place == ["Chunk"]:
            chunks.append((given, []))
        elif place == ["Chunk", "Token"]:
            chunks[-1][1].append((given, {}, []))
        elif place == ["Chunk", "Token", "Predicate"]:
            filled = chunks[-1][1][-1][1]
            filled.clear()
            filled.update((c, given[c].strip(_BLANKS)) for c in CASE_NAMES.values() if c in given)
        elif place == ["Chunk", "Token", "synnode"]:
            chunks[-1][1][-1][2].append(given.get("synid"))

    parser = expat.ParserCreate("utf-8")
    parser.StartElementHandler, parser.EndElementHandler = start, lambda _: open_.pop()
    try:
        parser.Parse(xml, True)
    except expat.ExpatError:
        return None
    return chunks or None


def _ends(sizes: Iterator[int]) -> pa.Array:
    return pa.array(list(accumulate(sizes, initial=0)), pa.int32())


def _strings(values: Iterator[str | None]) -> pa.Array:
    return pc.utf8_trim(pa.array(list(values), _STR), _BLANKS)


def _chunks(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in sliced(batches):
        found = [None if v is None else chunks_of(v) for v in batch.to_pylist()]
        chunks = [c for own in found if own for c in own]
        tokens = [t for _, own in chunks for t in own]
        filled = pa.MapArray.from_arrays(_ends(len(p) for _, p, _ in tokens), pa.array([c for _, p, _ in tokens for c in p], _STR), pa.array([w for _, p, _ in tokens for w in p.values()], _STR))
        synids = pa.ListArray.from_arrays(_ends(len(s) for *_, s in tokens), _strings(x for *_, s in tokens for x in s))
        words = pa.StructArray.from_arrays([*(_strings(a.get(k) for a, *_ in tokens) for k in ("id", "surf")), filled, synids], ["id", "surf", "predicate", "synids"])
        own = pa.ListArray.from_arrays(_ends(len(t) for _, t in chunks), words, mask=pa.array([not t for _, t in chunks], pa.bool_()))
        rows = pa.StructArray.from_arrays([*(_strings(a.get(k) for a, _ in chunks) for k in ("id", "head", "type")), own], ["id", "head", "type", "tokens"])
        yield pa.ListArray.from_arrays(_ends(len(f or ()) for f in found), rows, mask=pa.array([f is None for f in found], pa.bool_()))


def from_xml(xml: Column) -> Column:
    """``array<struct<id,head,type,tokens<id,surf,predicate map,synids>>>`` of such an element, read in one pass; null for what is no XML."""
    return F.arrow_udf(_chunks, "array<struct<id:string,head:string,type:string,tokens:array<struct<id:string,surf:string,predicate:map<string,string>,synids:array<string>>>>>")(xml)


def long_parts(sentence: str, blob: str | None, least: int = 70, low: float = 0.3, high: float = 0.7) -> list[str]:
    """A sentence of ``least`` characters or more in two, at the first strong boundary whose chunk begins within the middle part.

    The first half ends before the boundary's word, with what stands for it and a full stop; the rest of that chunk goes. Otherwise the sentence as it is.
    """
    n = len(sentence)
    if n < least or blob is None:
        return [sentence]
    at, said = 0, []
    chunks = tree_of(blob)["chunks"]
    for k, c in enumerate(chunks):
        if at > n * high:
            break
        mark = next((b for name, b in BOUNDARIES.items() if name in c["feature"]), None) if at > n * low else None
        if mark:
            orig, pos, instead = mark
            for t in c["tokens"]:
                if t["orig"] == orig and t["pos1"] == pos:
                    break
                said.append(t["surf"])
            rest = "".join(t["surf"] for later in chunks[k + 1 :] for t in later["tokens"])
            return ["".join(said) + instead + "。", rest]
        said += [t["surf"] for t in c["tokens"]]
        at += sum(len(t["surf"]) for t in c["tokens"])
    return [sentence]


def split_long(sentence: Column, blob: Column, least: int = 70) -> Column:
    """The parts of a sentence by its analysis; see :func:`long_parts`. Without an analysis, or a short one, the sentence alone."""

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for said, found in sliced(batches):
            yield pa.array([None if s is None else long_parts(s, b, least) for s, b in zip(said.to_pylist(), found.to_pylist())], pa.list_(_STR))

    run.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "array<string>")(sentence, blob)
