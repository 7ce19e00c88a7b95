"""HTML tokens, segments and their properties.

Tokens come from one regular expression whose matches, put together, are the page again, so a token's byte offset is the
running sum of the sizes before it. Segments and mode flags follow from window functions over a page's tokens: one
shuffle by page id, which the aggregation to segments reuses. Pages beyond the size filter's bound are left out, so that a
window never holds more than that.
"""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentweave.functions.batches import sliced
from sentweave.functions.text import bind
from sentweave.operators.filters import within_bytes
from sentweave.session import unused

#: Tags that end a segment, in either form.
DELIMITERS = "address blockquote br caption center dd dir div dl dt fieldset form h1 h2 h3 h4 h5 h6 hr isindex li listing menu multicol noframes noscript ol option p plaintext pre select table tbody td tfoot th thead tr ul xmp".split()
LISTS = ["dir", "dl", "menu", "ol", "ul"]
PREFORMATTED = ["listing", "plaintext", "pre", "xmp"]
#: Comments, whole scripts and styles, declarations, tags, text; a lone < is text.
TOKEN = "(?is)<!--.*?-->|<script\\b[^>]*>.*?</script\\s*>|<style\\b[^>]*>.*?</style\\s*>|<[!?][^>]*>|</?[a-z][^>]*>|[^<]+|<"
UNKNOWN_BLOCK = "unknown_block"


def attribute(tag: Column, name: str) -> Column:
    """A tag's attribute: quoted either way or bare; null without it."""
    found = F.regexp_extract(tag, f"(?is)\\s{name}\\s*=\\s*(\"[^\"]*\"|'[^']*'|[^\\s>\"']+)", 1)
    return F.when(found != "", F.regexp_replace(found, "^[\"']|[\"']$", ""))


def tokens(pages: DataFrame, id_col: str = "page_id", html: str = "html") -> DataFrame:
    """``(id, pos, kind, tag, token, byte_off, byte_len)``; kinds: S and E tags, T text, C comment, D declaration, X script or style."""
    base = pages.filter(within_bytes(F.col(html))).select(id_col, F.posexplode(F.regexp_extract_all(html, F.lit(TOKEN), F.lit(0))).alias("pos", "token"))
    token = F.col("token")
    kind = F.when(token.startswith("<!--"), "C").when(token.rlike("^<[!?]"), "D").when(token.rlike("(?i)^<(script|style)\\b"), "X").when(token.startswith("</"), "E").when(token.rlike("^<[a-zA-Z]"), "S").otherwise("T")
    order = Window.partitionBy(id_col).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    size = F.octet_length("token").cast("bigint")
    tag = F.when(kind.isin("S", "E", "X"), F.lower(F.regexp_extract(token, "^</?([a-zA-Z][a-zA-Z0-9]*)", 1)))
    return base.select(id_col, "pos", kind.alias("kind"), tag.alias("tag"), "token", F.coalesce(F.sum(size).over(order), F.lit(0)).cast("bigint").alias("byte_off"), size.alias("byte_len"))


def next_tag(toks: DataFrame, names: list[str], id_col: str = "page_id") -> DataFrame:
    """For each token, the position of the next start tag of these names; null after the last."""
    ahead = Window.partitionBy(id_col).orderBy("pos").rowsBetween(1, Window.unboundedFollowing)
    return toks.withColumn("next_pos", F.min(F.when((F.col("kind") == "S") & F.col("tag").isin(*names), F.col("pos"))).over(ahead))


def visible_text(html: Column) -> Column:
    """The page's text in one piece: images by their alt text, ``br`` as a blank, white space squeezed; row-local."""
    toks = F.regexp_extract_all(html, F.lit(TOKEN), F.lit(0))
    show = lambda t: F.when(t.rlike("(?i)^<(img|applet)\\b"), F.coalesce(attribute(t, "alt"), F.lit(""))).when(t.rlike("(?i)^<br\\b"), " ").when(t.startswith("<") & (t != "<"), "").otherwise(t)
    return F.trim(F.regexp_replace(F.array_join(F.transform(toks, show), ""), "\\s+", " "))


def strip_tags(html: Column) -> Column:
    """Without comments, scripts, styles, declarations and tags."""
    return F.regexp_replace(html, "(?is)<!--.*?-->|<script\\b[^>]*>.*?</script\\s*>|<style\\b[^>]*>.*?</style\\s*>|<[!?][^>]*>|</?[a-z][^>]*>", "")


def title_of(html: Column) -> Column:
    """The text of the first title; null without one."""
    return F.nullif(F.regexp_extract(html, "(?is)<title\\b[^>]*>([^<]+)", 1), F.lit(""))


def meta_of(html: Column, name: str) -> Column:
    """The content of the last meta tag whose name starts with ``name`` (keyword, description)."""
    metas = F.filter(F.regexp_extract_all(html, F.lit("(?is)<meta\\b[^>]*>"), F.lit(0)), lambda m: F.lower(attribute(m, "name")).startswith(name))
    return F.when(F.size(metas) > 0, attribute(F.element_at(metas, F.greatest(F.size(metas), F.lit(1))), "content"))


def _last(value: Column, window, default) -> Column:
    return F.coalesce(F.last(value, ignorenulls=True).over(window), F.lit(default))


def flagged(toks: DataFrame, id_col: str = "page_id", ignore_br: bool = False, always_countup: bool = False, joined: bool = False) -> DataFrame:
    """Tokens with their segment number and mode flags; for each flag the last event counts, without nesting.

    ``ignore_br``: br and p end no segment; ``always_countup``: each text token is a segment; ``joined``: the table has a
    column ``break`` that ends segments too.
    """
    upto = Window.partitionBy(id_col).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    start, end, tag, token = F.col("kind") == "S", F.col("kind") == "E", F.col("tag"), F.col("token")
    delimiters = [t for t in DELIMITERS if not (ignore_br and t in ("br", "p"))]
    cut = (start | end) & tag.isin(*delimiters)
    if always_countup:
        cut = F.col("kind") == "T"
    if joined:
        cut = cut | F.col("break")

    def mode(tags: list[str]) -> Column:
        return _last(F.when(tag.isin(*tags) & start, True).when(tag.isin(*tags) & end, False), upto, False)

    size = attribute(token, "size")
    basefont = _last(F.when(start & (tag == "basefont") & size.rlike("^\\d"), F.regexp_extract(size, "^(\\d)", 1).try_cast("int") - 3), upto, 0)
    number = F.coalesce(F.regexp_extract(size, "^[+-]?(\\d)", 1).try_cast("int"), F.lit(0))
    font = F.when(start & (tag == "font") & size.rlike("^\\+\\d"), basefont + number).when(start & (tag == "font") & size.rlike("^-\\d"), basefont - number).when(start & (tag == "font") & size.rlike("^\\d"), number - 3)
    font = font.when(start & (tag == "basefont"), basefont).when(start & (tag == "big"), basefont + 2).when(start & (tag == "small"), basefont - 2).when(end & tag.isin("font", "big", "small"), basefont)
    center = F.when(tag == "center", start).when((tag == "div") & end, False).when((tag == "div") & start & attribute(token, "align").rlike("(?i)^center"), True)
    first = F.min(F.when(start & (tag == "title"), F.col("pos"))).over(Window.partitionBy(id_col))
    titled = toks.withColumn("_font", font)
    return titled.select(
        *toks.columns,
        F.sum(cut.cast("int")).over(upto).cast("int").alias("seg_no"),
        _last(F.when(F.col("pos") == first, True).when(end, False), upto, False).alias("in_title"),
        _last(F.when(tag.rlike("^h[1-6]$") & start, F.substring(tag, 2, 1).try_cast("int")).when(tag.rlike("^h[1-6]$") & end, 0), upto, 0).alias("heading"),
        _last(center, upto, False).alias("center"),
        mode(LISTS).alias("list"),
        mode(["table"]).alias("table"),
        mode(PREFORMATTED).alias("pre"),
        mode(["a"]).alias("link"),
        F.sum((start & (tag == "a")).cast("int")).over(upto).cast("int").alias("link_no"),
        _last(F.col("_font"), upto, 0).alias("fontsize"),
        _last(F.when(start, F.coalesce(attribute(token, "myblocktype"), F.lit(UNKNOWN_BLOCK))), upto, UNKNOWN_BLOCK).alias("block_type"),
        F.last(F.when(start, tag), ignorenulls=True).over(upto).alias("last_tag"),
        F.lag("kind").over(Window.partitionBy(id_col).orderBy("pos")).alias("kind_before"),
    )


def segments(pages: DataFrame, id_col: str = "page_id", html: str = "html", ignore_br: bool = False, always_countup: bool = False, uniq_br: bool = False, compound_nouns: DataFrame | None = None) -> DataFrame:
    """Segments of the page bodies: text between delimiter tags, byte span, the flags at their last text token, and their text tokens (``pieces``)."""
    toks = tokens(pages, id_col, html)
    if compound_nouns is not None:
        toks = mark_link_breaks(toks, compound_nouns, id_col)
    marked = flagged(toks, id_col, ignore_br, always_countup, joined=compound_nouns is not None)
    text, cut = F.col("token"), F.lit(False)
    if uniq_br:
        cut = F.coalesce((F.col("kind_before") == "S") & F.col("last_tag").isin("br", "p") & text.startswith("\n"), F.lit(False))
        text = F.when(cut, F.substring(text, F.lit(2), F.length(text))).otherwise(text)
    shown = marked.filter((F.col("kind") == "T") & ~F.col("in_title"))
    if ignore_br:
        brs = marked.filter((F.col("kind") == "S") & (F.col("tag") == "br")).withColumn("token", F.lit("\n")).withColumn("byte_len", F.lit(0).cast("bigint"))
        shown = shown.unionByName(brs)
    off = F.col("byte_off") + cut.cast("int")
    shown = shown.withColumns({"token": text, "byte_off": off, "byte_len": F.col("byte_len") - cut.cast("int")})
    ordered = F.sort_array(F.collect_list(F.struct("pos", "byte_off", "token")))
    flags = ["heading", "center", "list", "table", "pre", "fontsize", "block_type"]
    return shown.groupBy(id_col, "seg_no").agg(
        F.array_join(F.transform(ordered, lambda x: x["token"]), "").alias("text"),
        F.min("byte_off").alias("offset"),
        (F.max(F.col("byte_off") + F.col("byte_len")) - F.min("byte_off")).alias("length"),
        *[F.max_by(c, "pos").alias(c) for c in flags],
        F.transform(ordered, lambda x: F.struct(x["byte_off"].alias("byte_off"), x["token"].alias("token"))).alias("pieces"),
    )


def page_links(marked: DataFrame, id_col: str = "page_id") -> DataFrame:
    """``(id, link_no, tag, text, offset, seg_no)``: the closed links among ``flagged`` tokens, from 1 in each page, with the text between their own tags.

    A link that another one opens within ends there and is no link, as one that nothing closes. ``offset`` is that of its first text, null without any.
    """
    shown = F.col("link") & (F.col("kind") == "T")
    opens, closes = (F.col("tag") == "a") & (F.col("kind") == "S"), (F.col("tag") == "a") & (F.col("kind") == "E")
    kept = marked.filter((F.col("link_no") > 0) & (shown | opens | closes))
    pieces = F.sort_array(F.collect_list(F.when(shown, F.struct("pos", "token"))))
    found = kept.groupBy(id_col, "link_no").agg(
        F.max(F.when(opens, F.col("token"))).alias("tag"), F.array_join(F.transform(pieces, lambda x: x["token"]), "").alias("text"),
        F.min(F.when(shown, F.col("byte_off"))).alias("offset"), F.min(F.when(opens, F.col("seg_no"))).alias("seg_no"), F.max(closes).alias("closed"),
    )
    return found.filter("closed").drop("closed")


def header_segments(pages: DataFrame, id_col: str = "page_id", html: str = "html") -> DataFrame:
    """Title, keywords and description as segments with a role; only those there are. The title has its place in the page (``pieces``)."""
    h = F.col(html)
    at = F.octet_length(F.regexp_extract(h, "(?is)^(.*?<title\\b[^>]*>)[^<]+", 1)).cast("bigint")
    placed = F.array(F.struct(at.alias("byte_off"), title_of(h).alias("token")))
    nowhere = F.lit(None).cast("array<struct<byte_off:bigint,token:string>>")
    parts = [("title", title_of(h), placed), ("keywords", meta_of(h, "keyword"), nowhere), ("description", meta_of(h, "description"), nowhere)]
    rows = F.array(*[F.struct(F.lit(i).alias("slot"), F.lit(role).alias("role"), c.alias("text"), where.alias("pieces")) for i, (role, c, where) in enumerate(parts)])
    return pages.filter(within_bytes(h)).select(id_col, F.explode(F.filter(rows, lambda r: r["text"].isNotNull())).alias("r")).select(id_col, "r.*")


def mark_link_breaks(toks: DataFrame, compound_nouns: DataFrame, id_col: str = "page_id", least: int = 1000) -> DataFrame:
    """Adds ``break``: true at a link's text that doesn't join the link text right before it.

    Adjacent link texts join if both together are a compound noun that at least ``least`` documents have (``noun``, ``df``) and
    neither is a single hiragana letter. The dictionary is joined by key, so its size doesn't matter.
    """
    upto = Window.partitionBy(id_col).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    order = Window.partitionBy(id_col).orderBy("pos")
    in_link = F.coalesce(F.last(F.when((F.col("tag") == "a") & (F.col("kind") == "S"), True).when((F.col("tag") == "a") & (F.col("kind") == "E"), False), ignorenulls=True).over(upto), F.lit(False))
    texts = toks.withColumn("_link", in_link & (F.col("kind") == "T"))
    linked = texts.filter("_link").withColumn("_prev", F.lag("token").over(order))
    lone = F.col("token").rlike("^\\p{IsHiragana}$") | F.col("_prev").rlike("^\\p{IsHiragana}$")
    pairs = linked.select(id_col, "pos", "_prev", lone.alias("_lone"), F.concat(F.coalesce("_prev", F.lit("")), F.col("token")).alias("noun"))
    found = pairs.join(compound_nouns.filter(F.col("df") >= least).select("noun", F.lit(True).alias("_known")).distinct(), "noun", "left")
    breaks = found.select(id_col, "pos", (F.col("_prev").isNotNull() & (F.col("_lone") | F.col("_known").isNull())).alias("break"))
    return toks.join(breaks, [id_col, "pos"], "left").withColumn("break", F.coalesce("break", F.lit(False)))


def blank(removed: Column) -> Column:
    """A declaration of as many bytes as what it takes the place of (three at least): it shows nothing, and what follows keeps its place."""
    return F.concat(F.lit("<!"), F.repeat(F.lit(" "), F.octet_length(removed) - 3), F.lit(">"))


def drop_blog_template(html: Column, keep_places: bool = False) -> Column:
    """Without what a common blog template puts around an entry: head, banner, navigation, footer and side blocks.

    ``keep_places``: a blank declaration stands for each of them, so that offsets are those of the page as it lies.
    """
    for pattern in ("(?is)<head\\b.*?</head>", "(?is)<div id=\"banner\">.*?</div>", "(?is)<p class=\"content-nav\">.*?</p>", "(?is)<p class=\"entry-footer\">.*?</p>"):
        if keep_places:
            html = bind(html, lambda h, p=pattern: F.array_join(F.zip_with(F.split(h, p, -1), F.regexp_extract_all(h, F.lit(p), F.lit(0)), lambda k, r: F.concat(k, F.coalesce(blank(r), F.lit("")))), ""))
        else:
            html = F.regexp_replace(html, pattern, "")
    for name in ("trackbacks", "comments", "beta-inner"):
        html = drop_balanced_div(html, name, keep_places)
    return html


def drop_balanced_div(html: Column, name: str, keep_places: bool = False) -> Column:
    """Without the first div of this id or class, up to the end tag that closes it (to the end if none does)."""
    opening = f"(?is)<div\\b[^>]*(?:id|class)=[\"']{name}[\"'][^>]*>"
    start = F.struct(F.lit(0).alias("level"), F.lit(0).alias("length"))

    def step(s: Column, p: Column) -> Column:
        level = s["level"] + F.when(p.rlike("(?i)^<div\\b"), 1).when(p.rlike("(?i)^</div"), -1).otherwise(0)
        closed = (s["level"] == 0) & (s["length"] > 0)
        return F.struct(F.when(closed, 0).otherwise(level).alias("level"), F.when(closed, s["length"]).otherwise(s["length"] + F.length(p)).alias("length"))

    def without(page: Column, at: Column) -> Column:
        pieces = F.regexp_extract_all(page.substr(at, F.length(page)), F.lit("(?is)<div\\b[^>]*>|</div\\s*>|[^<]+|<"), F.lit(0))

        def cut(n: Column) -> Column:
            kept = blank(page.substr(at, n)) if keep_places else F.lit("")
            return F.concat(page.substr(F.lit(1), at - 1), kept, page.substr(at + n, F.length(page)))

        return F.when(at > 0, bind(F.aggregate(pieces, start, step)["length"], cut)).otherwise(page)

    # the page and the place are worked out once: several calls in a row would else repeat the earlier ones a hundredfold
    return bind(html, lambda page: bind(F.regexp_instr(page, F.lit(opening)), lambda at: without(page, at)))


def strip_outside(html: Column) -> Column:
    """Without what stands before ``<html`` and after ``</html>``."""
    return F.regexp_replace(F.regexp_replace(html, "(?is)^.*?(?=<html\\b)", ""), "(?is)(</html\\s*>).*$", "$1")


def density_regions(sizes: list[int], linked: list[int], price: float = 40.0) -> list[tuple[int, str]]:
    """``(first block, type)`` of the regions of a page, from the characters of each block and those of them that are link text.

    Regions are the runs of blocks for which the squared differences of the blocks' link shares from their region's share, by characters, and
    ``price`` a region sum up to the least; of equal sums the one with the later last cut counts. A region is a menu where more than half is link
    text, else main text; a menu that ends the page is a footer. The optimum is found over all cuts by dynamic programming.
    """
    n = len(sizes)
    if not n:
        return []
    w = np.array(sizes, float)
    share = np.divide(np.array(linked, float), w, out=np.zeros(n), where=w > 0)
    sums = [np.concatenate([[0.0], np.cumsum(v)]) for v in (w, w * share, w * share * share)]
    best, back = np.zeros(n + 1), np.zeros(n + 1, int)
    for j in range(1, n + 1):
        all_, of_links, squares = (s[j] - s[:j] for s in sums)
        spread = squares - np.divide(of_links * of_links, all_, out=np.zeros(j), where=all_ > 0)
        costs = np.round(best[:j] + np.maximum(spread, 0.0) + price, 9)
        back[j] = j - 1 - int(np.argmin(costs[::-1]))
        best[j] = costs[back[j]]
    out, j = [], n
    while j:
        i = int(back[j])
        dense = 2 * (sums[1][j] - sums[1][i]) > sums[0][j] - sums[0][i]
        out.append((i, ("footer" if j == n and i else "menu") if dense else "maintext"))
        j = i
    return out[::-1]


_NAME = re.compile("<[a-zA-Z0-9]+")


def marked_regions(page: str, blocks: list[dict], price: float = 40.0) -> str:
    """The page with ``myblocktype`` in every start tag of its regions; ``blocks``: ``size``, ``linked`` and ``starts`` of its segments, in order."""
    shown = [i for i, b in enumerate(blocks) if b["size"]]
    regions = density_regions([blocks[i]["size"] for i in shown], [blocks[i]["linked"] for i in shown], price)
    out, at = [], 0
    for (k, name), (till, _) in zip(regions, [*regions[1:], (len(shown), "")]):
        first = shown[k] if k else 0
        for b in blocks[first : shown[till] if till < len(shown) else len(blocks)]:
            for start in sorted(b["starts"]):
                end = start + len(_NAME.match(page, start)[0])
                out += [page[at:end], f' myblocktype="{name}"']
                at = end
    return "".join([*out, page[at:]])


def with_regions(pages: DataFrame, id_col: str = "page_id", html: str = "html", price: float = 40.0) -> DataFrame:
    """Pages whose body tags carry the types of their regions by text and link density (:func:`density_regions`), so that segments get them.

    Blocks are the segments of the body; a segment without text goes with the region before it. A page without text, or beyond the
    size filter's bound, stays as it is.
    """
    toks = tokens(pages, id_col, html)
    before = Window.partitionBy(id_col).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    placed = toks.withColumn("char_off", F.coalesce(F.sum(F.length("token")).over(before), F.lit(0)).cast("int"))
    marked = flagged(placed, id_col)
    text = (F.col("kind") == "T") & ~F.col("in_title") & ~F.col("token").rlike("^\\s*$")
    size = F.length(F.regexp_replace("token", "\\s+", ""))
    opens = (F.col("kind") == "S") & ~F.col("tag").isin("html", "head", "title", "meta", "link", "base", "body")
    segs = marked.groupBy(id_col, "seg_no").agg(
        F.sum(F.when(text, size).otherwise(0)).cast("int").alias("size"), F.sum(F.when(text & F.col("link"), size).otherwise(0)).cast("int").alias("linked"),
        F.collect_list(F.when(opens, F.col("char_off"))).alias("starts"),
    )
    (blocks,) = unused(pages, "blocks")
    of_page = segs.groupBy(id_col).agg(F.sort_array(F.collect_list(F.struct("seg_no", "size", "linked", "starts"))).alias(blocks))

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for told, found in sliced(batches):
            yield pa.array([p if b is None or p is None else marked_regions(p, b, price) for p, b in zip(told.to_pylist(), found.to_pylist())], pa.string())

    run.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    joined = pages.join(of_page, id_col, "left")
    return joined.withColumn(html, F.arrow_udf(run, "string")(F.col(html), F.col(blocks))).select(*pages.columns)


def embed_regions(pages: DataFrame, detect: Column | None = None, html: str = "html") -> DataFrame:
    """Pages whose tags carry ``myblocktype`` as a plugged-in detector says; without one, as they are.

    ``detect``: a column of the regions, ``array<struct<start:int,block_type:string>>`` with character positions of start tags.
    """
    if detect is None:
        return pages
    marks, h = F.array_sort(detect), F.col(html)
    name = lambda m: F.regexp_extract(h.substr(m["start"] + 1, F.lit(40)), "^(<[a-zA-Z0-9]+)", 1)

    def piece(m: Column, i: Column) -> Column:
        """The opening of a marked tag and what follows it up to the next one."""
        at = m["start"] + F.length(name(m))
        till = F.coalesce(F.get(marks, i + 1)["start"], F.length(h))
        return F.concat(name(m), F.lit(' myblocktype="'), m["block_type"], F.lit('"'), h.substr(at + 1, till - at))

    first = F.coalesce(F.get(marks, F.lit(0))["start"], F.length(h))
    return pages.withColumn(html, F.concat(h.substr(F.lit(1), first), F.array_join(F.transform(marks, piece), "")))
