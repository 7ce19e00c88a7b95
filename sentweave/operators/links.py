"""The link graph: anchors, canonical targets, page ids, link indexes and their embedding."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentweave.functions import text, urls
from sentweave.operators.html import attribute, flagged, page_links, strip_tags, tokens


def anchor_text(c: Column, widen: bool = False) -> Column:
    """Tags gone, entities decoded, white space squeezed and trimmed; ``widen``: full-width, as Japanese indexes keep it."""
    t = F.trim(F.regexp_replace(text.decode_entities(strip_tags(c)), "\\s+", " "))
    return F.regexp_replace(text.widen(t), "　+", "　") if widen else t


def anchors(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html", widen: bool = False) -> DataFrame:
    """``(from_id, from_url, pos, href, to_url, anchor)``: the links worth following, with their texts, in page order (from the pass that cuts segments).

    Mail, scripts, in-page links and images are left out, and so are empty texts, targets that aren't http and pages beyond the size filter's bound.
    """
    toks = flagged(tokens(pages.select(F.col(id_col).alias("from_id"), F.col(html).alias("html")), "from_id"), "from_id")
    found = page_links(toks, "from_id").select("from_id", (F.col("link_no") - 1).alias("pos"), attribute(F.col("tag"), "href").alias("href"), anchor_text(F.col("text"), widen).alias("anchor"))
    wanted = found.filter(urls.wanted_href(F.col("href")) & (F.col("anchor") != ""))
    named = wanted.join(pages.select(F.col(id_col).alias("from_id"), F.col(url).alias("from_url")), "from_id")
    rows = named.withColumn("to_url", urls.absolute(F.col("from_url"), F.col("href"))).filter(F.col("to_url").isNotNull())
    return rows.select("from_id", "from_url", "pos", "href", "to_url", "anchor")


def with_ids(links: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Links with ``to_id``, looked up by canonical url in ``(url, doc_id)``; unknown pages have the fixed id.

    A url that the dictionary has twice counts with its least id. The scheme doesn't matter.
    """
    known = dictionary.select(urls.without_scheme(urls.canonical(F.col("url"))).alias("_key"), F.col("doc_id").cast("string").alias("_id")).filter(F.col("_key").isNotNull())
    known = known.groupBy("_key").agg(F.min("_id").alias("_id"))
    keyed = links.withColumn("_key", urls.without_scheme(F.col("to_url")))
    return keyed.join(known, "_key", "left").withColumn("to_id", F.coalesce("_id", F.lit(urls.UNKNOWN_ID))).drop("_key", "_id")


def with_page_urls(pages: DataFrame, dictionary: DataFrame, id_col: str = "page_id", html: str = "html") -> DataFrame:
    """Pages with the crawler's header line put before their html, by id in ``(doc_id, url)``; unknown ids are left out."""
    known = dictionary.select(F.col("doc_id").alias("_id"), F.col("url").alias("_url"))
    joined = pages.join(known, pages[id_col] == known["_id"])
    return joined.withColumn(html, F.concat(F.lit("HTML "), F.col("_url"), F.lit("\n\n"), F.col(html))).drop("_id", "_url")


def out_links(links: DataFrame) -> DataFrame:
    """``(doc_id, anchor, targets)``: the targets of each page's anchor text, in page order."""
    order = F.array_sort(F.collect_list(F.struct("pos", "to_url", "to_id")))
    return links.groupBy(F.col("from_id").alias("doc_id"), "anchor").agg(F.transform(order, lambda x: F.struct(x["to_url"].alias("url"), x["to_id"].alias("doc_id"))).alias("targets"))


def in_links(links: DataFrame) -> DataFrame:
    """``(doc_id, anchor, sources)``: who links to each known page with which text; unknown targets are left out."""
    order = F.array_sort(F.collect_list(F.struct("from_id", "pos", "from_url")))
    known = links.filter(F.col("to_id") != urls.UNKNOWN_ID)
    return known.groupBy(F.col("to_id").alias("doc_id"), "anchor").agg(F.transform(order, lambda x: F.struct(x["from_url"].alias("url"), x["from_id"].cast("string").alias("doc_id"))).alias("sources"))


def link_records(links: DataFrame, key: str = "from_id") -> DataFrame:
    """``(key, record)``: the packed link records of each page: eight fields with tabs, records with two tabs between them."""
    fields = F.concat_ws("\t", F.col("from_id").cast("string"), "from_url", F.col("to_id").cast("string"), "to_url", F.lit("0"), F.lit("0"), "anchor", F.lit("undef"))
    rows = links.select(F.col(key).cast("string").alias("key"), "from_id", "pos", fields.alias("r"))
    order = F.array_sort(F.collect_list(F.struct("from_id", "pos", "r")))
    return rows.groupBy("key").agg(F.array_join(F.transform(order, lambda x: x["r"]), "\t\t").alias("record"))


def unpack_records(records: DataFrame) -> DataFrame:
    """Link rows of packed records again."""
    one = records.select("key", F.posexplode(F.split("record", "\t\t")).alias("k", "r"))
    part = lambda i: F.split_part("r", F.lit("\t"), F.lit(i))
    return one.select("key", "k", part(1).alias("from_id"), part(2).alias("from_url"), part(3).alias("to_id"), part(4).alias("to_url"), part(7).alias("anchor"))


def merge_sorted(tables: list[DataFrame], key: str, partitions: int | None = None) -> DataFrame:
    """Tables of one schema as one, range-partitioned and sorted by the numeric key."""
    union = tables[0]
    for t in tables[1:]:
        union = union.unionByName(t)
    number = F.col(key).try_cast("bigint")
    dealt = union.repartitionByRange(partitions, number) if partitions else union.repartitionByRange(number)
    return dealt.sortWithinPartitions(number)


def embed_links(docs: DataFrame, out_: DataFrame, in_: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Documents with ``out_links`` and ``in_links``: sorted arrays of (anchor, pages); empty where there are none."""
    gather = lambda df, c: df.groupBy(F.col("doc_id").cast("string").alias("_key")).agg(F.array_sort(F.collect_list(F.struct("anchor", c))).alias(c))
    keyed = docs.withColumn("_key", F.col(id_col).cast("string"))
    joined = keyed.join(gather(out_, "targets"), "_key", "left").join(gather(in_, "sources"), "_key", "left")
    fill = lambda c, t: F.coalesce(c, F.array().cast(t))
    kinds = {f.name: f.dataType.simpleString() for f in joined.schema.fields}
    return joined.select(*docs.columns, fill(F.col("targets"), kinds["targets"]).alias("out_links"), fill(F.col("sources"), kinds["sources"]).alias("in_links"))


def drop_links(docs: DataFrame) -> DataFrame:
    """Documents without their link sections."""
    return docs.drop("out_links", "in_links")


def resolve_out_links(docs: DataFrame, dictionary: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Ids of embedded out-link targets looked up anew: exploded, joined and grouped again; other rows stay as they are."""
    rows = docs.select(F.col(id_col).alias("from_id"), F.posexplode("out_links").alias("pos", "o")).select("from_id", "pos", F.col("o.anchor").alias("anchor"), F.posexplode("o.targets").alias("k", "t"))
    rows = rows.select("from_id", "pos", "anchor", "k", F.col("t.url").alias("to_url"))
    found = with_ids(rows, dictionary)
    order = F.array_sort(F.collect_list(F.struct("k", "to_url", "to_id")))
    by_anchor = found.groupBy("from_id", "pos", "anchor").agg(F.transform(order, lambda x: F.struct(x["to_url"].alias("url"), x["to_id"].alias("doc_id"))).alias("targets"))
    again = by_anchor.groupBy(F.col("from_id").alias(id_col)).agg(F.array_sort(F.collect_list(F.struct("pos", "anchor", "targets"))).alias("_o"))
    joined = docs.join(again, id_col, "left")
    new = F.transform("_o", lambda x: F.struct(x["anchor"].alias("anchor"), x["targets"].alias("targets")))
    return joined.withColumn("out_links", F.coalesce(new, F.col("out_links"))).drop("_o")


def rank_in_page(links: DataFrame) -> DataFrame:
    """Adds each link's number among its page's links."""
    return links.withColumn("link_no", F.row_number().over(Window.partitionBy("from_id").orderBy("pos")))
