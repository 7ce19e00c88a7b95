"""URL filters with redirect equivalence (DataFrame functions only).

A rule names a host and a path: it fits its host and all subdomains where the path starts with the rule's, and the
longest fitting rule wins. Urls without a rule take the decision of their aliases: those that redirects (meta refresh, or known
ones) and canonical links connect, found as connected components. Within a component an explicit allow takes precedence
over a block; without either the url is allowed.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentweave.functions.text import decode_entities
from sentweave.functions.urls import absolute
from sentweave.llm.common import ascii_lower, materialise
from sentweave.llm.components import components
from sentweave.operators.html import attribute


@dataclass(frozen=True)
class Rule:
    verdict: str
    name: str  # host and path, such as "example.com/en/7"

    @property
    def host(self) -> str:
        return self.name.split("/")[0]

    @property
    def path(self) -> str:
        return self.name[len(self.host) :]


RULES = (Rule("block", "com/en/"), Rule("allow", "example.com/en/7"), Rule("allow", "net/de/"), Rule("block", "example.net/de/8"), Rule("block", "org/es/"))

#: Decisions of aliases are broadcast up to so many; beyond, they are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
#: What isn't markup of the page, and the tags that may name another url.
HIDDEN = "(?is)<!--.*?-->|<script\\b[^>]*>.*?</script\\s*>|<style\\b[^>]*>.*?</style\\s*>"
LINK_TAG = "(?is)<(?:link|meta)\\b[^>]*>"
REFRESH = "(?i)^[ 0-9.]*[;,][ ]*url[ ]*=[ ]*[\"']?([^\"']*)"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null and other strings."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, "^(?s:.*?)://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: Column) -> Column:
    """A url's name among its aliases: without fragment, scheme and host lower-cased, an empty path as a slash; null without ``://``.

    Nothing else makes two urls one; only redirects and canonical links do.
    """
    rest = F.regexp_extract(url, "^(?s:.*?)://[^/?#]*([^#]*)", 1)
    slash = F.when(rest.startswith("/"), "").otherwise("/")
    return F.when(url.contains("://"), F.concat(ascii_lower(F.regexp_extract(url, "^((?s:.*?)://[^/?#]*)", 1)), slash, rest))


def matched(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule's (name, verdict), else null. Rules of one length can't both fit unless they are equal."""
    out = F.lit(None).cast("struct<name:string,verdict:string>")
    for r in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def with_rules(rows: DataFrame, rules=RULES) -> DataFrame:
    """``rows`` (``host``, ``path`` and others) with ``rule_``, the longest fitting rule's name and verdict, else null.

    A few rules are an expression. A list of any size comes as a table ``(name, verdict)``: the distinct hosts' suffixes are joined to the rules' hosts, and
    of those whose path fits the longest stays, of equal names an allow. Null names fit nothing.
    """
    if not isinstance(rules, DataFrame):
        return rows.withColumn("rule_", matched(F.col("host"), F.col("path"), rules))
    name = F.col("name").cast("string")
    host = F.regexp_extract(name, "^([^/]*)", 1)
    known = rules.filter(name.isNotNull()).groupBy(name.alias("name")).agg(F.min("verdict").alias("verdict")).select(host.alias("suffix"), F.substring(name, F.length(host) + 1, F.length(name)).alias("start"), "name", "verdict")
    labels = F.split("host", "[.]")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    seen = rows.select("host", "path").distinct().withColumn("suffix", F.explode(suffixes))
    fits = seen.join(known, "suffix").filter(F.col("path").startswith(F.col("start")))
    longest = fits.groupBy("host", "path").agg(F.max_by(F.struct("name", "verdict"), F.struct(F.length("name"), "name")).alias("rule_"))
    return rows.join(longest, ["host", "path"], "left")


def target_of(url: Column, target: Column) -> Column:
    """A link's target seen from its page; a mere fragment is the page itself, an empty target and other schemes such as mailto: are null."""
    path = path_of(url)
    base = F.concat(F.lit("http://"), host_of(url), path)
    seen = F.regexp_replace(absolute(base, target), "^http://", F.concat(F.regexp_extract(node_of(url), "^([^/]*)", 1), F.lit("//")))
    return (
        F.when(target.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*://"), target)
        .when(target.startswith("//"), F.concat(F.regexp_extract(node_of(url), "^([^/]*)", 1), target))
        .when(target.startswith("#"), url)
        .when(target != "", seen)
    )


def link_targets(html: Column) -> Column:
    """What a page's canonical links and redirects name, entities decoded; comments, scripts and styles don't count."""
    tags = F.regexp_extract_all(F.regexp_replace(html, HIDDEN, ""), F.lit(LINK_TAG), F.lit(0))

    def target(tag: Column) -> Column:
        canonical = F.array_contains(F.split(F.trim(F.lower(attribute(tag, "rel"))), "[ \\x09-\\x0d]+"), "canonical")
        refresh = F.nullif(F.rtrim(F.regexp_extract(attribute(tag, "content"), REFRESH, 1)), F.lit(""))
        is_link = tag.rlike("(?i)^<link")
        return F.when(is_link & canonical, attribute(tag, "href")).when(~is_link & (F.lower(attribute(tag, "http-equiv")) == "refresh"), refresh)

    return F.filter(F.transform(F.filter(F.transform(tags, target), lambda t: t.isNotNull()), lambda t: F.trim(decode_entities(t))), lambda t: t != "")


def alias_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``(u, v)``: urls that canonical links and redirects of the pages connect; relative targets are seen from the page's url (``<base>`` isn't read)."""
    u, h = pages[f"`{url}`"], pages[f"`{html}`"]
    some = pages.filter(h.rlike("(?i)canonical|refresh") & u.contains("://"))
    found = some.select(u.alias("url"), F.explode(link_targets(h)).alias("target"))
    seen = found.select("url", target_of(F.col("url"), F.col("target")).alias("target"))
    ends = seen.select(node_of(F.col("url")).alias("u"), node_of(F.col("target")).alias("v"))
    return ends.filter(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v")))


def judge_urls(pages: DataFrame, rules=RULES, id_col: str = "page_id", url: str = "url", html: str = "html", links: DataFrame | None = None, most: int = BROADCAST_ROWS) -> DataFrame:
    """``page_id, host, path, rule, verdict, decided_by`` for each row; ``links`` adds known redirects as ``(u, v)`` urls,
    ``rules`` may be a table of any size (``with_rules``).

    A null url and one without ``://`` have an empty host and path and no aliases: they are allowed unless a rule fits.
    A url that only links name speaks for its aliases too. Null ids and html, repeated rows and loops of redirects do no harm; an empty table gives an empty result; other columns
    never enter. Only urls that some edge names are joined to anything, and each of them once: a url of very many pages
    is no hot key.
    """
    own = pages[f"`{url}`"]
    rows = pages.select(pages[f"`{id_col}`"].alias(id_col), host_of(own).alias("host"), path_of(own).alias("path"), node_of(own).alias("node"))
    rows = with_rules(rows, rules)
    edges = alias_links(pages, url, html)
    if links is not None:
        edges = edges.unionByName(links.select(node_of(F.col("u")).alias("u"), node_of(F.col("v")).alias("v")))
    groups, _ = materialise(components(edges), "url-groups")
    said = with_rules(groups.withColumns({"host": host_of(F.col("node")), "path": path_of(F.col("node"))}), rules).withColumn("verdict", F.col("rule_.verdict"))
    ruled = said.filter(F.col("verdict").isNotNull()).groupBy("component").agg(F.max((F.col("verdict") == "allow").cast("int")).alias("allowed"))
    decided, _ = materialise(said.filter(F.col("verdict").isNull()).join(ruled, "component").select("node", "allowed"), "url-aliases")
    decided = F.broadcast(decided) if decided.count() <= most else decided
    base = [F.col(id_col), "host", "path", F.col("rule_.name").alias("rule")]
    alone = F.col("rule_").isNotNull() | F.col("node").isNull()
    direct = rows.filter(alone).select(*base, F.coalesce("rule_.verdict", F.lit("allow")).alias("verdict"), F.when(F.col("rule_").isNotNull(), "rule").otherwise("default").alias("decided_by"))
    alias = rows.filter(~alone).join(decided, "node", "left")
    alias = alias.select(*base, F.when(F.col("allowed") == 0, "block").otherwise("allow").alias("verdict"), F.when(F.col("allowed").isNotNull(), "alias").otherwise("default").alias("decided_by"))
    return direct.unionByName(alias)
