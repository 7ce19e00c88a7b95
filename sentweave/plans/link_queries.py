"""Queries over the link graph of the pages."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from sentweave.functions import urls
from sentweave.operators import html, links, standard_format
from sentweave.plans import sql
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


def linked(spark, sf_dir):
    """Links of all pages with the ids of their targets; the pages' own links lead to no crawled page, so each page also links to the next one."""
    p = pages(spark, sf_dir)
    known = p.select("url", F.col("page_id").alias("doc_id"))
    chain = p.select((F.col("page_id") - 1).alias("from_id"), F.col("url").alias("to_url")).join(p.select(F.col("page_id").alias("from_id"), F.col("url").alias("from_url")), "from_id")
    more = chain.select("from_id", "from_url", F.lit(-1).alias("pos"), F.col("to_url").alias("href"), urls.canonical(F.col("to_url")).alias("to_url"), F.lit("next").alias("anchor"))
    return links.with_ids(links.anchors(p).unionByName(more), known)


_LINKED = f"""WITH {sql.ANCHORS.replace('anchors AS (', 'own AS (')},
chain AS (SELECT f.page_id AS from_id, f.url AS from_url, -1 AS pos, t.url AS href, {sql.canonical('t.url')} AS to_url, 'next' AS anchor FROM pages f JOIN pages t ON t.page_id = f.page_id + 1),
anchors AS (SELECT * FROM own UNION ALL SELECT * FROM chain), {sql.KNOWN}"""


@query(f"WITH {sql.ANCHORS} SELECT * FROM anchors")
def anchors(spark, sf_dir):
    return links.anchors(pages(spark, sf_dir))


@query(f"""SELECT page_id, regexp_extract(url, '^(https?://[^/?#]*)', 1) AS domain, CASE WHEN regexp_matches(regexp_extract(url, '^(https?://[^?#]*)', 1), '^https?://[^/]*$') THEN regexp_extract(url, '^(https?://[^?#]*)', 1) || '/' ELSE regexp_replace(regexp_extract(url, '^(https?://[^?#]*)', 1), '[^/]*$', '') END AS dir,
 regexp_extract(url, '^https?://[^/?#]*[^?#]*/([^/?#]*)', 1) AS file FROM pages""")
def url_parts(spark, sf_dir):
    u = F.col("url")
    return pages(spark, sf_dir).select("page_id", urls.domain_of(u).alias("domain"), urls.directory_of(u).alias("dir"), urls.file_of(u).alias("file"))


@query(f"SELECT page_id, {sql.canonical('url')} AS canonical FROM pages")
def url_canonical(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", urls.canonical(F.col("url")).alias("canonical"))


#: Links of every shape, made from each page's number.
HREFS = ["/x{}.html", "../x{}", "./y/../x{}", "x{}?q=1#f", "//K.example/z{}", "?r={}", "HTTP://h{}/a/./b//../c/", "mailto:x{}@y", "../../../../x{}/", "ftp://h/{}"]
_DIR = "regexp_replace(base || CASE WHEN regexp_matches(base, '^https?://[^/]*$') THEN '/' ELSE '' END, '[^/]*$', '')"


@query(f"""WITH h AS (SELECT page_id, url, regexp_extract(url, '^(https?://[^?#]*)', 1) AS base, unnest({[*range(len(HREFS))]}) AS shape, unnest([{', '.join(sql.q(h) for h in HREFS)}]) AS t FROM pages),
f AS (SELECT *, replace(t, '{{}}', CAST(page_id AS VARCHAR)) AS href FROM h),
g AS (SELECT *, CASE WHEN regexp_matches(href, '^(?i)https?://') THEN href WHEN starts_with(href, '//') THEN regexp_extract(url, '^(https?:)', 1) || href WHEN starts_with(href, '/') THEN regexp_extract(url, '^(https?://[^/?#]*)', 1) || href
 WHEN starts_with(href, '?') THEN base || href WHEN regexp_matches(href, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN NULL ELSE {_DIR} || href END AS u FROM f)
SELECT page_id, href, {sql.canonical('u')} AS target FROM g""")
def url_absolute(spark, sf_dir):
    made = F.explode(F.array(*[F.replace(F.lit(h), F.lit("{}"), F.col("page_id").cast("string")) for h in HREFS])).alias("href")
    return pages(spark, sf_dir).select("page_id", "url", made).select("page_id", "href", urls.absolute(F.col("url"), F.col("href")).alias("target"))


@query(f"{_LINKED} SELECT from_id, pos, to_url, to_id, anchor FROM named")
def link_docid_lookup(spark, sf_dir):
    return linked(spark, sf_dir).select("from_id", "pos", "to_url", "to_id", "anchor")


@query(f"{_LINKED} SELECT CAST(from_id AS VARCHAR) AS doc_id, anchor, string_agg(to_url || ' ' || to_id, ',' ORDER BY pos) AS targets FROM named GROUP BY 1, 2")
def outlink_group(spark, sf_dir):
    found = links.out_links(linked(spark, sf_dir))
    return found.select(F.col("doc_id").cast("string").alias("doc_id"), "anchor", F.array_join(F.transform("targets", lambda t: F.concat_ws(" ", t["url"], t["doc_id"])), ",").alias("targets"))


@query(f"{_LINKED} SELECT to_id AS doc_id, anchor, string_agg(from_url || ' ' || from_id, ',' ORDER BY from_id, pos) AS sources FROM named WHERE to_id <> '{urls.UNKNOWN_ID}' GROUP BY 1, 2")
def inlink_group(spark, sf_dir):
    found = links.in_links(linked(spark, sf_dir))
    return found.select("doc_id", "anchor", F.array_join(F.transform("sources", lambda t: F.concat_ws(" ", t["url"], t["doc_id"])), ",").alias("sources"))


@query(f"{_LINKED} SELECT CAST(from_id AS VARCHAR) AS key, string_agg(concat_ws(chr(9), from_id, from_url, to_id, to_url, '0', '0', anchor, 'undef'), chr(9) || chr(9) ORDER BY pos) AS record FROM named GROUP BY 1")
def link_records(spark, sf_dir):
    return links.link_records(linked(spark, sf_dir))


@query(f"{_LINKED} SELECT CAST(from_id AS VARCHAR) AS from_id, to_id, to_url, anchor FROM named")
def unpacked_records(spark, sf_dir):
    """Records packed and unpacked again."""
    return links.unpack_records(links.link_records(linked(spark, sf_dir))).select("from_id", "to_id", "to_url", "anchor")


@query(f"{_LINKED} SELECT from_id, pos, to_url FROM named")
def merge_sorted_links(spark, sf_dir):
    found = linked(spark, sf_dir).select("from_id", "pos", "to_url")
    return links.merge_sorted([found.filter("from_id % 2 = 0"), found.filter("from_id % 2 = 1")], "from_id")


@query(f"{_LINKED}, o AS (SELECT from_id AS id, count(DISTINCT anchor) AS n FROM named GROUP BY 1), i AS (SELECT to_id AS id, count(DISTINCT anchor) AS n FROM named GROUP BY 1) SELECT page_id, coalesce(o.n, 0) AS n_out, coalesce(i.n, 0) AS n_in FROM pages LEFT JOIN o ON o.id = page_id LEFT JOIN i ON i.id = CAST(page_id AS VARCHAR)")
def embed_links(spark, sf_dir):
    found = linked(spark, sf_dir)
    docs = links.embed_links(pages(spark, sf_dir).select("page_id"), links.out_links(found), links.in_links(found), "page_id")
    return docs.select("page_id", F.size("out_links").cast("bigint").alias("n_out"), F.size("in_links").cast("bigint").alias("n_in"))


@query(f"{_LINKED} SELECT from_id AS page_id, anchor, to_url, to_id FROM named")
def resolve_out_links(spark, sf_dir):
    """Ids of embedded out-links forgotten and looked up anew."""
    found = linked(spark, sf_dir)
    docs = links.embed_links(pages(spark, sf_dir).select("page_id"), links.out_links(found.withColumn("to_id", F.lit(urls.UNKNOWN_ID))), links.in_links(found), "page_id")
    known = pages(spark, sf_dir).select("url", F.col("page_id").alias("doc_id"))
    again = links.resolve_out_links(docs, known, "page_id")
    rows = again.select("page_id", F.explode("out_links").alias("o")).select("page_id", "o.anchor", F.explode("o.targets").alias("t"))
    return rows.select("page_id", "anchor", F.col("t.url").alias("to_url"), F.col("t.doc_id").alias("to_id"))


@query("SELECT page_id, 'HTML ' || url || chr(10) || chr(10) || html AS html FROM pages")
def pages_with_urls(spark, sf_dir):
    p = pages(spark, sf_dir)
    return links.with_page_urls(p.select("page_id", "html"), p.select(F.col("page_id").alias("doc_id"), "url"))


_ESCAPED = "replace(replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;')"


@query(f"""{_LINKED}, g AS (SELECT from_id, anchor, string_agg('<DocID Url="' || {_ESCAPED.format('to_url')} || '">' || to_id || '</DocID>', '' ORDER BY pos) AS ids FROM named GROUP BY 1, 2)
SELECT from_id AS doc_id, md5('<OutLinks>' || string_agg('<OutLink><RawString>' || {_ESCAPED.format('anchor')} || '</RawString><DocIDs>' || ids || '</DocIDs></OutLink>', '' ORDER BY encode(anchor)) || '</OutLinks>') AS digest FROM g GROUP BY 1""")
def links_xml(spark, sf_dir):
    found = links.out_links(linked(spark, sf_dir)).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("anchor", "targets"))).alias("g"))
    return found.select("doc_id", F.md5(standard_format.links_xml(F.col("g"))).alias("digest"))


@query(f"""WITH {sql.TOKENS}, l AS (SELECT *, coalesce(last_value(CASE WHEN tag = 'a' AND kind = 'S' THEN true WHEN tag = 'a' AND kind = 'E' THEN false END IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY pos), false) AND kind = 'T' AS linked FROM tokens),
p AS (SELECT page_id, pos, lag(token) OVER (PARTITION BY page_id ORDER BY pos) AS prev, token FROM l WHERE linked)
SELECT page_id, count(*) AS n, count(*) FILTER (WHERE prev IS NOT NULL AND hash_ % 2 = 1) AS breaks FROM (SELECT *, length(prev || token) AS hash_ FROM p) GROUP BY page_id""")
def joined_link_texts(spark, sf_dir):
    """Where a link's text breaks from the one before: unless both together are a frequent compound noun; here those of even length are."""
    toks = html.tokens(pages(spark, sf_dir))
    linked_ = toks.withColumn("link", F.last(F.when(F.col("tag") == "a", F.col("kind") == "S"), ignorenulls=True).over(Window.partitionBy("page_id").orderBy("pos"))).filter("link AND kind = 'T'")
    pairs = linked_.select(F.concat(F.lag("token").over(Window.partitionBy("page_id").orderBy("pos")), "token").alias("noun")).filter("noun IS NOT NULL").distinct()
    nouns = pairs.select("noun", F.when(F.length("noun") % 2 == 0, 1500).otherwise(10).cast("bigint").alias("df"))
    marked = html.mark_link_breaks(toks, nouns)
    texts = marked.join(linked_.select("page_id", "pos"), ["page_id", "pos"], "left_semi")
    return texts.groupBy("page_id").agg(F.count(F.lit(1)).alias("n"), F.count_if("break").alias("breaks"))
