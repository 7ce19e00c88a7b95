"""Queries over pages: filters, tokens, segments, sentences, provenance, documents."""

from pyspark.sql import functions as F

from sentweave.functions import encoding, text
from sentweave.operators import filters, html, provenance, sentences, standard_format
from sentweave.plans import pipeline, sql
from sentweave.session import table

QUERIES, SQL = {}, {}


def query(statement: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if statement:
            SQL[f.__name__] = statement
        return f

    return add


def pages(spark, sf_dir):
    return table(spark, sf_dir, "pages")


@query("SELECT page_id, CAST(strlen(html) AS BIGINT) AS size FROM pages WHERE strlen(html) <= 8192")
def page_size_filter(spark, sf_dir):
    return pages(spark, sf_dir).filter(filters.within_bytes(F.col("html"), 8192)).select("page_id", F.octet_length("html").cast("bigint").alias("size"))


@query("SELECT page_id FROM pages WHERE len(regexp_extract_all(html, '\\r\\n|\\r|\\n')) <= 5000")
def page_line_filter(spark, sf_dir):
    return pages(spark, sf_dir).filter(filters.within_lines(F.col("html"))).select("page_id")


@query("SELECT page_id, CASE WHEN html IS NULL OR html = '' THEN 'empty' WHEN strlen(html) > 8192 THEN 'size' WHEN len(regexp_extract_all(html, '\\r\\n|\\r|\\n')) > 5000 THEN 'lines' ELSE 'ok' END AS status FROM pages")
def page_status(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", filters.page_status(F.col("html"), max_bytes=8192).alias("status"))


#: Charsets that pages are made to declare, by their ids, with the encodings that they are read as in Japanese.
_CHARSETS = [("utf-8", "utf8"), ("EUC-JP", "euc-jp"), ("Shift_JIS", "shiftjis"), ("iso-8859-1", None), ("x-sjis", "shiftjis"), ("koi8-r", "utf8")]


@query(f"SELECT page_id, ['{"', '".join(c.lower() for c, _ in _CHARSETS)}'][page_id % {len(_CHARSETS)} + 1] AS charset, [{', '.join('NULL' if e is None else sql.q(e) for _, e in _CHARSETS)}][page_id % {len(_CHARSETS)} + 1] AS encoding FROM pages")
def page_encoding(spark, sf_dir):
    """Pages that declare several charsets; one that isn't known is guessed from the bytes, one of another language refused."""
    named = F.get(F.array(*[F.lit(c) for c, _ in _CHARSETS]), (F.col("page_id") % len(_CHARSETS)).cast("int"))
    told = pages(spark, sf_dir).select("page_id", F.concat(F.lit("<meta http-equiv=Content-Type content='text/html; charset="), named, F.lit("'>"), F.regexp_replace("html", "(?i)charset", "set"), F.lit("Á")).alias("html"))
    return told.select("page_id", encoding.declared_charset(F.col("html")).alias("charset"), encoding.resolve_encoding(F.encode("html", "UTF-8"), language="japanese").alias("encoding"))


@query(f"WITH {sql.TOKENS} SELECT page_id, pos, kind, tag, token, byte_off, byte_len FROM tokens")
def html_tokens(spark, sf_dir):
    return html.tokens(pages(spark, sf_dir))


@query(f"WITH {sql.TOKENS} SELECT page_id, pos, min(CASE WHEN kind = 'S' AND tag = 'a' THEN pos END) OVER (PARTITION BY page_id ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_pos FROM tokens")
def next_link_tag(spark, sf_dir):
    return html.next_tag(html.tokens(pages(spark, sf_dir)), ["a"]).select("page_id", "pos", "next_pos")


@query(f"WITH {sql.SEGMENTS} SELECT page_id, seg_no, text, \"offset\", length, block_type FROM segments")
def detag_segments(spark, sf_dir):
    return html.segments(pages(spark, sf_dir)).select("page_id", "seg_no", "text", "offset", "length", "block_type")


@query(f"WITH {sql.SEGMENTS} SELECT page_id, seg_no, heading, list, \"table\", pre FROM segments")
def segment_flags(spark, sf_dir):
    return html.segments(pages(spark, sf_dir)).select("page_id", "seg_no", "heading", "list", "table", "pre")


@query("SELECT page_id, nullif(regexp_extract(html, '(?is)<title\\b[^>]*>([^<]+)', 1), '') AS title FROM pages")
def page_title(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", html.title_of(F.col("html")).alias("title"))


@query("SELECT page_id, 'words ' || page_id AS keywords, CASE WHEN page_id % 2 = 0 THEN 'about ' || page_id ELSE 'older' END AS description FROM pages")
def page_meta(spark, sf_dir):
    """Keywords and descriptions put into the pages; of two of a kind the last one counts."""
    number = F.col("page_id").cast("string")
    metas = F.concat(F.lit("<META content='older' name=description><meta name=\"Keywords\" content=\"words "), number, F.lit("\">"), F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("<meta name=description content='about "), number, F.lit("'/>"))).otherwise(""))
    told = pages(spark, sf_dir).select("page_id", F.concat(metas, "html").alias("html"))
    return told.select("page_id", html.meta_of(F.col("html"), "keyword").alias("keywords"), html.meta_of(F.col("html"), "description").alias("description"))


_STRIP = "(?is)<!--.*?-->|<script\\b[^>]*>.*?</script\\s*>|<style\\b[^>]*>.*?</style\\s*>|<[!?][^>]*>|</?[a-z][^>]*>"


@query(f"SELECT page_id, regexp_replace(html, {sql.q(_STRIP)}, '', 'g') AS text FROM pages")
def strip_tags(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", html.strip_tags(F.col("html")).alias("text"))


@query(f"SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(html, '(?i)<br\\b[^>]*>', ' ', 'g'), {sql.q(_STRIP)}, '', 'g'), '\\s+', ' ', 'g')) AS text FROM pages")
def visible_text(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", html.visible_text(F.col("html")).alias("text"))


@query("SELECT page_id, regexp_replace(regexp_replace(html, '(?is)^.*?(<html\\b)', '\\1'), '(?is)(</html\\s*>).*$', '\\1') AS html FROM pages")
def strip_outside(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", html.strip_outside(F.col("html")).alias("html"))


@query("SELECT page_id, regexp_replace(html, '(?is)<head\\b.*?</head>', '', 'g') AS html FROM pages")
def drop_blog_template(spark, sf_dir):
    """Pages within a blog's template: of it nothing stays."""
    before = '<div id="banner">a blog</div><p class="content-nav">back | on</p>'
    after = '<p class="entry-footer">posted</p><DIV class="trackbacks">x<div>y<div>z</div></div></DIV><div id="comments"><div>one</div><div>two</div></div><div class="beta-inner">side</div>'
    return pages(spark, sf_dir).select("page_id", html.drop_blog_template(F.concat(F.lit(before), "html", F.lit(after))).alias("html"))


@query(f"WITH {sql.SEGMENTS} SELECT page_id, seg_no, {sql.clean_segment('text')} AS clean FROM segments WHERE NOT regexp_matches(text, '^[\\x{{3000}}\\s]*$')")
def text_clean(spark, sf_dir):
    found = html.segments(pages(spark, sf_dir)).filter(~text.is_blank(F.col("text")))
    return found.select("page_id", "seg_no", sentences.clean_segment(F.col("text")).alias("clean"))


_TITLE = "(?is)<title\\b[^>]*>([^<]+)"
_SENTENCES = f"""{sql.SEGMENTS},
{sql.WORDS},
body AS (SELECT page_id, seg_no, {sql.clean_segment('text')} AS c, block_type, heading FROM segments WHERE NOT regexp_matches(text, '^[\\x{{3000}}\\s]*$')),
paras AS (SELECT *, unnest(regexp_split_to_array(regexp_replace(regexp_replace(c, '^\\n+', ''), '\\n+$', ''), '\\n{{2,}}')) AS para, unnest(range(len(regexp_split_to_array(regexp_replace(regexp_replace(c, '^\\n+', ''), '\\n+$', ''), '\\n{{2,}}')))) AS para_no FROM body),
keyed AS (SELECT page_id || '-' || seg_no || '-' || para_no AS pk, * FROM paras),
{sql.split_english('keyed', 'pk', 'para')},
sized AS (SELECT k.*, c.k, c.sentence, len(regexp_extract_all(c.sentence, '[^\\x20\\x09-\\x0D]+')) AS n FROM cut c JOIN keyed k USING (pk)),
numbered AS (SELECT *, sum(n) OVER (PARTITION BY page_id, seg_no ORDER BY para_no, k) AS upto FROM sized),
titles AS (SELECT page_id, regexp_extract(html, {sql.q(_TITLE)}, 1) AS t, strlen(regexp_extract(html, {sql.q('(?is)^(.*?<title' + chr(92) + 'b[^>]*>)[^<]+')}, 1)) AS title_off FROM pages WHERE strlen(html) <= 5242880),
parts AS (SELECT s.page_id, s.seg_no, s.para_no, s.k, 'body' AS role, s.sentence AS raw_string, CAST(f.a AS BIGINT) AS "offset", CAST(l.b - f.a AS BIGINT) AS length, s.block_type, s.heading
 FROM numbered s JOIN word_spans f ON f.page_id = s.page_id AND f.seg_no = s.seg_no AND f.wn = s.upto - s.n JOIN word_spans l ON l.page_id = s.page_id AND l.seg_no = s.seg_no AND l.wn = s.upto - 1
 UNION ALL SELECT page_id, -3, 0, 0, 'title', regexp_replace({sql.clean_segment("t")}, '\\s+', ' ', 'g'), CAST(title_off + strlen(regexp_extract(t, '^\\s*', 0)) AS BIGINT), CAST(strlen(regexp_replace(regexp_replace(t, '^\\s+', ''), '\\s+$', '')) AS BIGINT), NULL, 0 FROM titles WHERE t <> ''),
sentences AS (SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY seg_no, para_no, k) AS INT) AS sent_no, CAST(dense_rank() OVER (PARTITION BY page_id ORDER BY seg_no, para_no) AS INT) AS paragraph,
 role, raw_string, "offset", length, block_type, heading, {sql.japanese_score('raw_string')} AS japanese_score FROM parts WHERE raw_string <> '' AND length(raw_string) <= 200)"""


@query(f"WITH {_SENTENCES} SELECT * FROM sentences")
def page_sentences(spark, sf_dir):
    return sentences.sentences(pages(spark, sf_dir))


@query(f"WITH {_SENTENCES} SELECT page_id, sent_no, CASE WHEN role = 'body' THEN page_id || '-' || row_number() OVER (PARTITION BY page_id, role = 'body' ORDER BY sent_no) END AS sid FROM sentences")
def sentence_ids(spark, sf_dir):
    return sentences.sentence_ids(sentences.sentences(pages(spark, sf_dir))).select("page_id", "sent_no", "sid")


@query(f"WITH {_SENTENCES} SELECT page_id, count(*) AS n, count(*) FILTER (WHERE role = 'title') AS titles, count(*) FILTER (WHERE heading > 0) AS headings FROM sentences GROUP BY page_id")
def sentences_per_page(spark, sf_dir):
    found = sentences.sentences(pages(spark, sf_dir))
    return found.groupBy("page_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("role") == "title").alias("titles"), F.count_if(F.col("heading") > 0).alias("headings"))


@query(f"WITH {_SENTENCES} SELECT s.page_id, s.sent_no, decode(CAST(encode(p.html) AS BLOB)[CAST(s.\"offset\" AS INT) + 1:CAST(s.\"offset\" + s.length AS INT)]) AS source FROM sentences s JOIN pages p USING (page_id) WHERE s.\"offset\" IS NOT NULL")
def provenance_span(spark, sf_dir):
    p = pages(spark, sf_dir)
    found = sentences.sentences(p).filter(F.col("offset").isNotNull()).join(p.select("page_id", "html"), "page_id")
    return found.select("page_id", "sent_no", provenance.span(F.col("html"), F.col("offset"), F.col("length")).alias("source"))


_SOURCE = sql.clean_segment("regexp_replace(decode(CAST(encode(p.html) AS BLOB)[CAST(s.\"offset\" AS INT) + 1:CAST(s.\"offset\" + s.length AS INT)]), " + sql.q(_STRIP) + ", '', 'g')")


@query(f"WITH {_SENTENCES} SELECT s.page_id, count(*) AS n, count(*) FILTER (WHERE regexp_replace({_SOURCE}, '\\s+', '', 'g') = regexp_replace(s.raw_string, '\\s+', '', 'g')) AS matching, CAST(sum(s.length) AS BIGINT) AS bytes FROM sentences s JOIN pages p USING (page_id) WHERE s.\"offset\" IS NOT NULL GROUP BY s.page_id")
def provenance_roundtrip(spark, sf_dir):
    """Sentences that are equal to the bytes that they name, cleaned, and how many bytes these are."""
    p = pages(spark, sf_dir)
    return provenance.verify(sentences.sentences(p), p).groupBy("page_id").agg(F.count(F.lit(1)).alias("n"), F.count_if("matches").alias("matching"), F.sum("length").alias("bytes"))


@query(f"WITH {_SENTENCES} SELECT page_id, array_to_string(list(raw_string ORDER BY CASE role WHEN 'title' THEN 1 WHEN 'keywords' THEN 2 WHEN 'description' THEN 3 ELSE 4 END, sent_no), chr(10)) AS nodes FROM sentences GROUP BY page_id")
def ordered_nodes(spark, sf_dir):
    return provenance.in_order(sentences.sentences(pages(spark, sf_dir))).select("page_id", F.array_join("nodes", "\n").alias("nodes"))


@query(f"WITH {_SENTENCES} SELECT s.page_id AS doc_id, '<PAGE URL=\"' || any_value(p.url) || '\">' || chr(10) || coalesce(string_agg(s.raw_string, chr(10) ORDER BY s.sent_no) FILTER (WHERE s.role = 'body'), '') AS text FROM sentences s JOIN pages p USING (page_id) GROUP BY s.page_id")
def plain_documents(spark, sf_dir):
    p = pages(spark, sf_dir)
    return standard_format.plain_text(standard_format.assemble(sentences.sentence_ids(sentences.sentences(p)), p))


@query(f"""WITH {_SENTENCES}, ids AS (SELECT *, page_id || '-' || row_number() OVER (PARTITION BY page_id, role = 'body' ORDER BY sent_no) AS sid FROM sentences)
SELECT i.page_id AS doc_id, any_value(p.url) AS url, coalesce(max(raw_string) FILTER (WHERE role = 'title'), '') AS title, coalesce(string_agg(sid, ',' ORDER BY sent_no) FILTER (WHERE role = 'body'), '') AS ids,
 coalesce(string_agg(raw_string, chr(10) ORDER BY sent_no) FILTER (WHERE role = 'body'), '') AS raw_strings, coalesce(string_agg("offset" || '+' || length, ',' ORDER BY sent_no) FILTER (WHERE role = 'body'), '') AS spans FROM ids i JOIN pages p USING (page_id) GROUP BY i.page_id""")
def xml_documents(spark, sf_dir):
    """StandardFormat XML of every page, parsed again: the ids and raw strings that went in."""
    p = pages(spark, sf_dir)
    xml = standard_format.to_xml(standard_format.assemble(sentences.sentence_ids(sentences.sentences(p)), p))
    parsed = standard_format.parse_xml(xml)
    body = lambda f, by: F.array_join(F.transform(F.filter("sentences", lambda s: s["role"] == "body"), f), by)
    title = F.coalesce(F.get(F.filter("sentences", lambda s: s["role"] == "title"), F.lit(0))["raw_string"], F.lit(""))
    spans = body(lambda s: F.concat_ws("+", s["offset"].cast("string"), s["length"].cast("string")), ",")
    return parsed.select("doc_id", "url", title.alias("title"), body(lambda s: s["sid"], ",").alias("ids"), body(lambda s: s["raw_string"], "\n").alias("raw_strings"), spans.alias("spans"))


@query(f"WITH {_SENTENCES}, ids AS (SELECT *, page_id || '-' || row_number() OVER (PARTITION BY page_id, role = 'body' ORDER BY sent_no) AS sid FROM sentences) SELECT sid, raw_string FROM ids WHERE role = 'body' AND sid IN ('1-1', '1-2', '7-3', 'none')")
def sid_allow_list(spark, sf_dir):
    found = sentences.sentence_ids(sentences.sentences(pages(spark, sf_dir)))
    return standard_format.raw_strings(found, "all", sids=["1-1", "1-2", "7-3", "none"])


@query(f"""WITH {_SENTENCES}, {sql.ANCHORS}, {sql.KNOWN}, o AS (SELECT from_id AS id, count(DISTINCT anchor) AS n FROM named GROUP BY 1), i AS (SELECT to_id AS id, count(DISTINCT anchor) AS n FROM named GROUP BY 1)
SELECT s.page_id AS doc_id, any_value(p.url) AS url, CAST(count(*) AS INT) AS n_sentences, CAST(coalesce(any_value(o.n), 0) AS INT) AS n_out, CAST(coalesce(any_value(i.n), 0) AS INT) AS n_in
FROM sentences s JOIN pages p USING (page_id) LEFT JOIN o ON o.id = s.page_id LEFT JOIN i ON i.id = CAST(s.page_id AS VARCHAR) WHERE strlen(p.html) <= 5242880 AND len(regexp_extract_all(p.html, '\\r\\n|\\r|\\n')) <= 5000 GROUP BY s.page_id""")
def document_pipeline(spark, sf_dir):
    """Nested documents of all pages with both link indexes; one line of figures for each."""
    docs = pipeline.documents(pages(spark, sf_dir))
    return docs.select("doc_id", "url", F.size("sentences").alias("n_sentences"), F.size("out_links").alias("n_out"), F.size("in_links").alias("n_in"))


#: A crawler's header before each page, of several lengths; its url is another host's.
_HEAD = "'HTML http://crawl.example/' || page_id || '/x' || repeat('é', CAST(page_id % 5 AS INT)) || chr(10) || 'Date: Tue, 03 Jul 2007 10:00:00 GMT' || chr(10) || chr(10)"


@query(f"""WITH {_SENTENCES}, h AS (SELECT page_id, html, {_HEAD} AS head FROM pages)
SELECT s.page_id, s.sent_no, s.raw_string, s."offset" + CASE WHEN s."offset" IS NOT NULL THEN strlen(h.head) END AS "offset", s.length,
 decode(CAST(encode(h.head || h.html) AS BLOB)[CAST(s."offset" + strlen(h.head) AS INT) + 1:CAST(s."offset" + strlen(h.head) + s.length AS INT)]) AS source FROM sentences s JOIN h USING (page_id)""")
def headed_provenance(spark, sf_dir):
    """Sentences of pages that open with a crawler's header: their spans are those of the file as it lies."""
    files = pages(spark, sf_dir).select("page_id", F.concat(F.expr(_HEAD.replace("repeat('é', CAST(page_id % 5 AS INT))", "repeat('é', int(page_id % 5))").replace("chr(10)", "'\n'")), "html").alias("html"))
    found = pipeline.page_sentences(files, pipeline.PipelineOptions(crawler_header=True)).join(files, "page_id")
    return found.select("page_id", "sent_no", "raw_string", "offset", "length", provenance.span(F.col("html"), F.col("offset"), F.col("length")).alias("source"))


@query(f"""WITH {_SENTENCES}, h AS (SELECT page_id, {_HEAD} AS head FROM pages), {sql.ANCHORS.replace('FROM pages', "FROM (SELECT page_id, html, 'http://crawl.example/' || page_id || '/x' || repeat('é', CAST(page_id % 5 AS INT)) AS url FROM pages) AS pages")},
o AS (SELECT from_id AS id, count(DISTINCT anchor) AS n, max(to_url) AS last_url FROM anchors GROUP BY 1)
SELECT s.page_id AS doc_id, 'http://crawl.example/' || s.page_id || '/x' || repeat('é', CAST(s.page_id % 5 AS INT)) AS url, CAST(count(*) AS INT) AS n_sentences, CAST(coalesce(any_value(o.n), 0) AS INT) AS n_out, any_value(o.last_url) AS last_url
FROM sentences s LEFT JOIN o ON o.id = s.page_id GROUP BY s.page_id""")
def headed_documents(spark, sf_dir):
    """Documents of such pages: the header's url is theirs, and their links are resolved against it."""
    files = pages(spark, sf_dir).select("page_id", F.concat(F.expr(_HEAD.replace("repeat('é', CAST(page_id % 5 AS INT))", "repeat('é', int(page_id % 5))").replace("chr(10)", "'\n'")), "html").alias("html"))
    docs = pipeline.documents(files, pipeline.PipelineOptions(crawler_header=True))
    targets = F.flatten(F.transform("out_links", lambda o: F.transform(o["targets"], lambda t: t["url"])))
    return docs.select("doc_id", "url", F.size("sentences").alias("n_sentences"), F.size("out_links").alias("n_out"), F.array_max(targets).alias("last_url"))
