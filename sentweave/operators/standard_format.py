"""The interchange format: nested documents, their XML, and projections over their sentences."""

import json
import re
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentweave.functions.batches import sliced

#: The elements of header parts and sentences.
ELEMENTS = {"title": "Title", "keywords": "Keywords", "description": "Description", "body": "S"}
ILLEGAL_XML = "[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\ufffe\\uffff]"
SENTENCE_COLUMNS = ["sid", "sent_no", "role", "paragraph", "block_type", "offset", "length", "japanese_score", "raw_string"]
PARENS, ANNOTATIONS = "array<struct<position:int,type:string,text:string>>", "array<struct<scheme:string,tool:string,cdata:string>>"


def assemble(found: DataFrame, pages: DataFrame, id_col: str = "page_id", url: str = "url") -> DataFrame:
    """Documents: one row a page with ``url`` and the array ``sentences`` in order; pages without sentences are left out."""
    own = [c for c in [*SENTENCE_COLUMNS, "is_normal", "log", "formatted", "parens", "annotations"] if c in found.columns]
    rest = F.struct(F.col("sent_no").alias("_o"), *own)
    grouped = found.groupBy(id_col).agg(F.array_sort(F.collect_list(rest)).alias("s"))
    fields = lambda x: F.struct(*[x[c].alias(c) for c in own])
    return grouped.join(pages.select(id_col, url), id_col).select(F.col(id_col).alias("doc_id"), F.col(url).alias("url"), F.transform("s", fields).alias("sentences"))


def _escape(c: Column) -> Column:
    c = F.regexp_replace(F.coalesce(c, F.lit("")), ILLEGAL_XML, "")
    for char, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(char), F.lit(name))
    return c


def _attributes(**values: Column) -> Column:
    return F.concat(*[F.when(v.isNull(), F.lit("")).otherwise(F.concat(F.lit(f' {k}="'), _escape(v.cast("string")), F.lit('"'))) for k, v in values.items()])


def _cdata(c: Column) -> Column:
    """Text in a CDATA section; its end mark within goes into the next section."""
    inner = F.replace(F.regexp_replace(F.coalesce(c, F.lit("")), ILLEGAL_XML, ""), F.lit("]]>"), F.lit("]]]]><![CDATA[>"))
    return F.concat(F.lit("<![CDATA["), inner, F.lit("]]>"))


def to_xml(docs: DataFrame, encoding: str = "utf8", version: str = "1", format_time: str = "") -> DataFrame:
    """``(doc_id, xml)``: a StandardFormat document; header parts first, then the text.

    Whatever the documents have is written: spans, scores, normal flags, logs, formatted sentences with their bracketed remarks,
    annotations, both kinds of links, and the page's own attributes.
    """
    fields = {f.name for f in docs.schema["sentences"].dataType.elementType.fields}
    has = lambda name: name in fields
    raw = lambda text: F.concat(F.lit("<RawString>"), _escape(text), F.lit("</RawString>"))

    def element(s: Column, tag: str) -> Column:
        flag = s["is_normal"].cast("int") if has("is_normal") else F.lit(None)
        given = {"Id": s["sid"], "Paragraph": s["paragraph"], "BlockType": s["block_type"], "JapaneseScore": s["japanese_score"], "Offset": s["offset"], "Length": s["length"], "is_Normal_Sentence": flag, "Log": s["log"] if has("log") else F.lit(None)}
        parts = [raw(s["raw_string"])]
        if has("formatted"):
            parts.append(F.when(s["formatted"].isNotNull(), F.concat(F.lit("<Sentence>"), _escape(s["formatted"]), F.lit("</Sentence>"))).otherwise(""))
        if has("annotations"):
            one = lambda a: F.concat(F.lit("<Annotation"), _attributes(Scheme=a["scheme"], Tool=a["tool"]), F.lit(">"), _cdata(a["cdata"]), F.lit("</Annotation>"))
            parts.append(F.coalesce(F.array_join(F.transform(s["annotations"], one), ""), F.lit("")))
        if has("parens"):
            mark = lambda p, i: F.concat(F.lit("<Parenthesis><S"), _attributes(Id=F.concat_ws("-", s["sid"], F.lpad((i + 2).cast("string"), 2, "0")), Position=p["position"], Type=p["type"]), F.lit(">"), raw(p["text"]), F.lit("</S></Parenthesis>"))
            parts.append(F.coalesce(F.array_join(F.transform(s["parens"], mark), ""), F.lit("")))
        return F.concat(F.lit(f"<{tag}"), _attributes(**given), F.lit(">"), *parts, F.lit(f"</{tag}>\n"))

    def section(role: str) -> Column:
        return F.array_join(F.transform(F.filter("sentences", lambda s: s["role"] == role), lambda s: element(s, ELEMENTS[role])), "")

    links = [links_xml(F.col(c), kind, inner) if c in docs.columns else F.lit("") for c, kind, inner in (("in_links", "InLink", "sources"), ("out_links", "OutLink", "targets"))]
    given = {"Url": "url", "CrawlTime": "crawl_time", "NoCache": "no_cache", "NoIndex": "no_index"}
    root = _attributes(OriginalEncoding=F.lit(encoding), FormatTime=F.lit(format_time), FormatProgVersion=F.lit(version), **{k: F.col(c) for k, c in given.items() if c in docs.columns})
    head = F.concat(*[section(r) for r in ("title", "keywords", "description")], *links)
    xml = F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?>\n<StandardFormat'), root, F.lit(">\n<Header>\n"), head, F.lit("</Header>\n<Text>\n"), section("body"), F.lit("</Text>\n</StandardFormat>\n"))
    return docs.select("doc_id", xml.alias("xml"))


def plain_text(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)``: a page line and one sentence a line."""
    lines = F.array_join(F.transform(F.filter("sentences", lambda s: s["role"] == "body"), lambda s: s["raw_string"]), "\n")
    return docs.select("doc_id", F.concat(F.lit('<PAGE URL="'), F.col("url"), F.lit('">\n'), lines).alias("text"))


def sid_text(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)``: a header line with the id before each sentence."""
    body = F.filter("sentences", lambda s: s["role"] == "body")
    return docs.select("doc_id", F.array_join(F.transform(body, lambda s: F.concat(F.lit("# S-ID:"), s["sid"], F.lit("\n"), s["raw_string"])), "\n").alias("text"))


def links_xml(groups: Column, kind: str = "OutLink", pages: str = "targets") -> Column:
    """Link sections; texts and ids with characters that XML can't hold are left out."""
    page = lambda p: F.concat(F.lit("<DocID"), _attributes(Url=p["url"]), F.lit(">"), F.when(p["doc_id"].rlike(ILLEGAL_XML), "").otherwise(_escape(p["doc_id"])), F.lit("</DocID>"))
    group = lambda g: F.concat(F.lit(f"<{kind}><RawString>"), F.when(g["anchor"].rlike(ILLEGAL_XML), "").otherwise(_escape(g["anchor"])), F.lit("</RawString><DocIDs>"), F.array_join(F.transform(g[pages], page), ""), F.lit(f"</DocIDs></{kind}>"))
    return F.concat(F.lit(f"<{kind}s>"), F.array_join(F.transform(groups, group), ""), F.lit(f"</{kind}s>"))


def _read(raw: str | None) -> dict | None:
    """A StandardFormat document as its nested row; null if it can't be parsed."""
    root = None
    for text in (raw or "", re.sub("&(?!(?:amp|lt|gt|quot|apos|#[0-9]+|#x[0-9a-fA-F]+);)", "&amp;", raw or "")):  # as it is, then with bare ampersands repaired
        try:
            root = ElementTree.fromstring(text.encode())
            break
        except ElementTree.ParseError:
            pass
    if root is None:
        return None

    def number(e, name):
        v = e.get(name, "")
        return int(v) if v.lstrip("-").isdigit() else None

    def sentence(e, role: str, n: int) -> dict:
        flag, score = e.get("is_Normal_Sentence"), e.get("JapaneseScore")
        remarks = [{"position": number(p, "Position"), "type": p.get("Type"), "text": p.findtext("RawString", "")} for p in e.findall("Parenthesis/S")]
        notes = [{"scheme": a.get("Scheme"), "tool": a.get("Tool"), "cdata": a.text or ""} for a in e.findall("Annotation")]
        return {"sid": e.get("Id"), "sent_no": n, "role": role, "paragraph": number(e, "Paragraph"), "block_type": e.get("BlockType"), "offset": number(e, "Offset"), "length": number(e, "Length"), "japanese_score": float(score) if score else None,
                "raw_string": e.findtext("RawString", ""), "is_normal": None if flag is None else flag == "1", "log": e.get("Log"), "formatted": e.findtext("Sentence"), "parens": remarks, "annotations": notes}

    def links(kind: str, inner: str) -> list[dict]:
        return [{"anchor": g.findtext("RawString", ""), inner: [{"url": d.get("Url"), "doc_id": d.text or ""} for d in g.findall("DocIDs/DocID")]} for g in root.iter(kind)]

    parts = [(e, role) for role, tag in ELEMENTS.items() for e in (root.findall(f"Header/{tag}") if role != "body" else root.findall("Text/S"))]
    return {"url": root.get("Url"), "crawl_time": root.get("CrawlTime"), "sentences": [sentence(e, role, n + 1) for n, (e, role) in enumerate(parts)], "out_links": links("OutLink", "targets"), "in_links": links("InLink", "sources")}


_PAGE = "array<struct<url:string,doc_id:string>>"
_DOCUMENT = (
    "struct<url:string,crawl_time:string,sentences:array<struct<sid:string,sent_no:int,role:string,paragraph:int,block_type:string,offset:bigint,length:bigint,japanese_score:double,raw_string:string,"
    f"is_normal:boolean,log:string,formatted:string,parens:{PARENS},annotations:{ANNOTATIONS}>>,out_links:array<struct<anchor:string,targets:{_PAGE}>>,in_links:array<struct<anchor:string,sources:{_PAGE}>>>"
)


def parse_xml(files: DataFrame, column: str = "xml") -> DataFrame:
    """Files with the documents that their StandardFormat XML holds: ``url``, ``crawl_time``, ``sentences``, ``out_links``, ``in_links``.

    It is what ``to_xml`` wrote, field by field; bare ampersands are repaired first, and what is no XML has nulls.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in sliced(batches):
            yield pa.array([json.dumps(_read(x)) for x in batch.to_pylist()], pa.string())

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    read = files.withColumn("_d", F.from_json(F.arrow_udf(run, "string")(F.col(column)), _DOCUMENT))
    return read.select(*files.columns, "_d.*")


def raw_strings(found: DataFrame, which: str = "normal", sids: list[str] | None = None, block_types: list[str] | None = None, keep_block_type: bool = False, sid_head: str = "", delete_blanks: bool = False, text_only: bool = False) -> DataFrame:
    """Raw sentences: ``all``, ``title`` or ``normal`` ones, by id, by block type; ids get ``sid_head`` put before."""
    if which == "title":
        found = found.filter(F.col("role") == "title")
    elif which == "normal" and "is_normal" in found.columns:
        found = found.filter("is_normal")
    if sids is not None:
        allowed = found.sparkSession.createDataFrame([(s,) for s in sids], "sid string")
        found = found.join(allowed, "sid", "left_semi")
    if block_types:
        found = found.filter(F.col("block_type").isin(*block_types))
    text = F.regexp_replace("raw_string", "\\s+", "") if delete_blanks else F.col("raw_string")
    if text_only:
        return found.select(text.alias("raw_string"))
    return found.select(F.concat(F.lit(sid_head), F.col("sid")).alias("sid"), text.alias("raw_string"), *(["block_type"] if keep_block_type else []))


def split_header(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Header parts and body sentences."""
    return found.filter(F.col("role") != "body"), found.filter(F.col("role") == "body")
