"""Queries over whole tables for each operator, with production parameters, and their SQL where SQL can say the same."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentweave.llm import alignment, conversations, decontaminate, exact_dedup, licenses, line_dedup, packing, quality, sharding, simhash, token_counts, toxicity, url_filter
from sentweave.llm.license_texts import NOTICES, SPELLINGS
from sentweave.plans.sql import attribute, clean_path, decode_entities
from sentweave.session import table


def tokenizer_path(name: str) -> str:
    """Where the installed public tokenizer file lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), limit=512)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3, keep=("doc_id",))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "text_digest", "license_id", "n_notices", "notices")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_benchmark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op6_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.kd_shards(table(spark, sf_dir, "documents"), shards=16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), end_id=2, max_tokens=4096)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge_quality(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_boilerplate_words", "kept", F.sha2("clean_text", 256).alias("clean_sha256"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_groups(table(spark, sf_dir, "documents"), shingle=4, distance=4)
    return found.select("doc_id", simhash.hex_fingerprint("fp").alias("fingerprint"), "component_id")


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.find_copies(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = table(spark, sf_dir, "conversations")
    turns = conversations.damage(whole)
    return conversations.digests(turns, conversations.audits(turns, whole))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.align(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def queries() -> dict:
    found = [op1_token_counts, op2_toxicity, op3_license_scan, op4_line_dedup, op5_decontamination, op6_kd_sharding, op7_packing, op8_url_filter, op9_quality, op10_simhash, op11_exact_dedup, op12_conversation_repair, op13_token_alignment]
    return {f.__name__: f for f in found}


# ---- SQL ----

AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
ROWS = "rows_ AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents)"


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _canonical_sql(t: str) -> str:
    spelled = "CASE w " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in SPELLINGS.items()) + " ELSE w END"
    lines = f"list_filter(string_split(translate({t}, {AZ}), chr(10)), lambda x: NOT regexp_matches(x, '^[\\x20\\x09#*/;-]*(copyright|\\(c\\)|©)([\\x20\\x09:]|$)'))"
    words = f"list_filter(string_split(regexp_replace(array_to_string({lines}, ' '), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', ' ', 'g'), ' '), lambda w: w <> '')"
    return f"array_to_string(list_transform({words}, lambda w: {spelled}), ' ')"


OP3_SQL = f"""
WITH listed AS (SELECT sha256({_canonical_sql('t')}) AS digest, id FROM (VALUES {", ".join(f"({_quoted(t)}, {_quoted(n)})" for t, n in licenses.built_in())}) v(t, id)),
known AS (SELECT digest, min(id) AS id FROM listed GROUP BY digest),
noted AS (SELECT sha256({_canonical_sql('t')}) AS digest, id FROM (VALUES {", ".join(f"({_quoted(t)}, {_quoted(n)})" for t, n in NOTICES.items())}) v(t, id)),
{ROWS},
whole AS (SELECT rid, doc_id, {_canonical_sql('text')} AS c FROM rows_),
lines AS (SELECT rid, line FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM rows_) WHERE regexp_matches(lower(line), 'licen[cs]e|released under|rights reserved')),
hits AS (SELECT l.rid, count(*) AS n, array_to_string(list_sort(list(DISTINCT k.id)), ',') AS ids FROM lines l JOIN noted k ON sha256({_canonical_sql('l.line')}) = k.digest GROUP BY l.rid)
SELECT w.doc_id, CASE WHEN c <> '' THEN sha256(c) END AS text_digest, k.id AS license_id, coalesce(h.n, 0) AS n_notices, coalesce(h.ids, '') AS notices
FROM whole w LEFT JOIN known k ON c <> '' AND sha256(c) = k.digest LEFT JOIN hits h ON h.rid = w.rid"""

OP4_SQL = f"""
WITH {ROWS},
lines AS (SELECT rid, doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM rows_),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), {AZ}) AS k FROM lines),
frequent AS (SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT rid) >= 10)
SELECT doc_id, count(*) AS n_lines, count(f.k) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE f.k IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN frequent f USING (k) GROUP BY rid, doc_id"""

_WORDS_SQL = f"regexp_extract_all(translate(text, {AZ}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP5_SQL = f"""
WITH {ROWS},
docs AS (SELECT rid, doc_id, {_WORDS_SQL} AS w FROM rows_),
items AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS_SQL} AS w FROM (SELECT item_id, coalesce(text, '') AS text FROM benchmark)),
sized AS (SELECT item, w, least(10, len(w)) AS n FROM items WHERE len(w) > 0),
windows AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS k FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM sized)),
lengths AS (SELECT DISTINCT n FROM windows),
places AS (SELECT rid, i, n, array_to_string(w[i:i + n - 1], ' ') AS k FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, lengths WHERE len(w) >= n)),
found AS (SELECT p.rid, p.i, p.n, s.item FROM places p JOIN windows s ON p.n = s.n AND p.k = s.k),
hit AS (SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest(range(i, i + n)) AS j FROM found) GROUP BY rid),
named AS (SELECT rid, list_sort(list(DISTINCT item)) AS ids FROM found GROUP BY rid)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(len(s.ids), 0) AS n_items, sha256(coalesce(array_to_string(s.ids, ','), '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit h USING (rid) LEFT JOIN named s USING (rid)"""


def _rule_sql(host: str = "host", path: str = "path") -> str:
    out = "NULL"
    for r in sorted(url_filter.RULES, key=lambda r: len(r.name)):
        out = f"CASE WHEN ({host} = '{r.host}' OR ends_with({host}, '.{r.host}')) AND starts_with({path}, '{r.path}') THEN '{r.name}' ELSE {out} END"
    return out


_VERDICT_SQL = "CASE {} " + " ".join(f"WHEN '{r.name}' THEN '{r.verdict}'" for r in url_filter.RULES) + " END"


def _node(u: str) -> str:
    """A url without its fragment, scheme and host lower-cased, an empty path as a slash; null without ``://``."""
    rest = f"regexp_extract({u}, '^(?s:.*?)://[^/?#]*([^#]*)', 1)"
    slash = f"CASE WHEN starts_with({rest}, '/') THEN '' ELSE '/' END"
    return f"CASE WHEN contains({u}, '://') THEN translate(regexp_extract({u}, '^((?s:.*?)://[^/?#]*)', 1), {AZ}) || {slash} || {rest} END"


_PATHED = "'^[a-zA-Z][a-zA-Z0-9+.-]*:'"

OP8_SQL = f"""
WITH RECURSIVE p AS (SELECT page_id, url, html, translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''), {AZ}) AS host, coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path, {_node('url')} AS k FROM pages),
r AS (SELECT *, {_rule_sql()} AS rule FROM p),
v AS (SELECT *, {_VERDICT_SQL.format('rule')} AS said FROM r),
seen AS (SELECT k, path, url, regexp_replace(html, '(?is)<!--.*?-->|<script\\b[^>]*>.*?</script\\s*>|<style\\b[^>]*>.*?</style\\s*>', '', 'g') AS html FROM p WHERE k IS NOT NULL AND regexp_matches(html, '(?i)canonical|refresh')),
tags AS (SELECT k, path, url, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\\b[^>]*>')) AS tag FROM seen),
named_ AS (SELECT k, path, url, lower({attribute('tag', 'rel')}) AS rel, lower({attribute('tag', 'http-equiv')}) AS equiv, {attribute('tag', 'href')} AS href, {attribute('tag', 'content')} AS content, regexp_matches(tag, '(?i)^<link') AS is_link FROM tags),
raw AS (SELECT k, path, url, trim({decode_entities("CASE WHEN is_link AND list_contains(regexp_split_to_array(trim(rel), '[ \\x09-\\x0d]+'), 'canonical') THEN href WHEN NOT is_link AND equiv = 'refresh' THEN nullif(rtrim(regexp_extract(content, '(?i)^[ 0-9.]*[;,][ ]*url[ ]*=[ ]*[\"'']?([^\"'']*)', 1)), '') END")}) AS t FROM named_),
full_ AS (SELECT k, url, t, regexp_extract(k, '^([a-z][a-z0-9+.-]*):', 1) AS scheme, regexp_extract(k, '^([^/]*//[^/?#]*)', 1) AS origin, path FROM raw WHERE t IS NOT NULL AND t <> ''),
there AS (SELECT k AS a, CASE WHEN regexp_matches(t, '^[a-zA-Z][a-zA-Z0-9+.-]*://') THEN t WHEN starts_with(t, '//') THEN scheme || ':' || t WHEN starts_with(t, '#') THEN url WHEN regexp_matches(t, {_PATHED}) THEN NULL
 WHEN starts_with(t, '?') THEN origin || {clean_path('path')} || t
 ELSE origin || {clean_path("CASE WHEN starts_with(t, '/') THEN '' ELSE regexp_replace(path, '[^/]*$', '') END || regexp_extract(t, '^([^?#]*)', 1)")} || regexp_extract(t, '^[^?#]*(.*)$', 1) END AS b FROM full_),
one AS (SELECT a, {_node('b')} AS b FROM there),
edges AS (SELECT a, b FROM one WHERE b IS NOT NULL AND a <> b UNION SELECT b, a FROM one WHERE b IS NOT NULL AND a <> b),
reach AS (SELECT DISTINCT a AS k, a AS c FROM edges UNION SELECT e.b, reach.c FROM reach JOIN edges e ON e.a = reach.k),
named AS (SELECT k, min(c) AS c FROM reach GROUP BY k),
g AS (SELECT v.*, named.c FROM v LEFT JOIN named USING (k)),
ends_ AS (SELECT k, c, regexp_extract(k, '^(?s:.*?)://([^/?#]*)', 1) AS host, regexp_extract(k, '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path FROM named),
decided AS (SELECT c, bool_or({_VERDICT_SQL.format(_rule_sql())} = 'allow') AS ok FROM ends_ WHERE {_rule_sql()} IS NOT NULL GROUP BY c)
SELECT g.page_id, g.host, g.path, g.rule, CASE WHEN g.said IS NOT NULL THEN g.said WHEN d.ok = false THEN 'block' ELSE 'allow' END AS verdict,
 CASE WHEN g.said IS NOT NULL THEN 'rule' WHEN d.ok IS NOT NULL THEN 'alias' ELSE 'default' END AS decided_by
FROM g LEFT JOIN decided d ON g.c = d.c"""

OP9_SQL = f"""
WITH {ROWS},
docs AS (SELECT rid, doc_id, coalesce(source, '') AS host, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w FROM rows_),
words AS (SELECT rid, unnest(w) AS x, unnest(range(len(w))) AS i FROM docs),
triples AS (SELECT rid, i, CASE WHEN lead(x, 2) OVER o IS NOT NULL THEN x || ' ' || lead(x, 1) OVER o || ' ' || lead(x, 2) OVER o END AS t FROM words WINDOW o AS (PARTITION BY rid ORDER BY i)),
again AS (SELECT rid, i, t IS NOT NULL AND count(*) OVER (PARTITION BY rid, t) > 1 AS a FROM triples),
covered AS (SELECT rid, a OR coalesce(lag(a, 1) OVER o, false) OR coalesce(lag(a, 2) OVER o, false) AS c FROM again WINDOW o AS (PARTITION BY rid ORDER BY i)),
repeats AS (SELECT rid, count(*) FILTER (WHERE c) AS n FROM covered GROUP BY rid),
lines AS (SELECT rid, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM docs),
real AS (SELECT *, row_number() OVER (PARTITION BY rid, line ORDER BY i) AS k, regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+') AS lw FROM lines WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
dups AS (SELECT rid, count(*) FILTER (WHERE k > 1) AS n FROM real GROUP BY rid),
normal AS (SELECT r.rid, r.i, d.host, translate(array_to_string(lw, ' '), {AZ}) AS h, len(lw) AS n FROM real r JOIN docs d USING (rid)),
frequent AS (SELECT host, h FROM normal GROUP BY host, h HAVING count(DISTINCT rid) > {quality.MAX_DOCS}),
lost AS (SELECT rid, sum(n) AS n FROM normal JOIN frequent USING (host, h) GROUP BY rid),
gone AS (SELECT rid, i FROM normal JOIN frequent USING (host, h)),
cleaned AS (SELECT l.rid, coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE g.i IS NULL), '') AS t FROM lines l LEFT JOIN gone g ON g.rid = l.rid AND g.i = l.i GROUP BY l.rid),
base AS (SELECT d.doc_id, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars, length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
 coalesce(dups.n, 0) AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words, CAST(coalesce(lost.n, 0) AS BIGINT) AS n_boilerplate_words, sha256(cleaned.t) AS clean_sha256
 FROM docs d LEFT JOIN cleaned USING (rid) LEFT JOIN repeats USING (rid) LEFT JOIN dups USING (rid) LEFT JOIN lost USING (rid))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
 NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_words - n_boilerplate_words >= {quality.MIN_KEPT} * n_words AS kept FROM base"""


OP11_SQL = """
WITH docs AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, first(doc_id) OVER (PARTITION BY t ORDER BY doc_id NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
 row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256 FROM docs"""


def oracle_sql() -> dict[str, str]:
    return {"op3_license_scan": OP3_SQL, "op4_line_dedup": OP4_SQL, "op5_decontamination": OP5_SQL, "op8_url_filter": OP8_SQL, "op9_quality": OP9_SQL, "op11_exact_dedup": OP11_SQL}
