"""Queries over corpus utilities: counting, buckets, containment, versions, lookups, resuming."""

from pyspark.sql import functions as F

from sentweave.functions import english
from sentweave.operators import annotate, corpus, filters, papers
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


def lines(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))


_LINES = "lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS line_no FROM documents)"


@query(f"WITH {_LINES} SELECT line, doc_id_first AS comment, cnt FROM (SELECT line, min(doc_id) AS doc_id_first, count(*) AS cnt FROM lines GROUP BY line)")
def dedup_count(spark, sf_dir):
    found = lines(spark, sf_dir)
    return corpus.dedup_count(found, "line", "doc_id", "doc_id")


@query(f"WITH {_LINES}, half AS (SELECT line, doc_id % 2 AS h, count(*) AS n FROM lines GROUP BY 1, 2) SELECT line, sum(n)::BIGINT AS cnt FROM half GROUP BY line")
def merge_counts(spark, sf_dir):
    """Counts of two halves, merged by their COUNT:n comments."""
    parts = lines(spark, sf_dir).groupBy("line", (F.col("doc_id") % 2).alias("h")).agg(F.count(F.lit(1)).alias("n"))
    counted = parts.select("line", "h", F.concat(F.lit("c COUNT:"), F.col("n").cast("string")).alias("comment"))
    return corpus.dedup_count(counted, "line", "comment", "h", counted=True).select("line", "cnt")


@query(f"WITH {_LINES} SELECT CAST(least(length(split_part(line, ' ', 1)), 200) AS INT) AS len_bucket, count(*) AS n FROM lines GROUP BY 1")
def length_bucket(spark, sf_dir):
    return lines(spark, sf_dir).groupBy(corpus.length_bucket(F.col("line")).alias("len_bucket")).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_LINES} SELECT line, CAST(least(length(split_part(line, ' ', 1)), 200) AS INT) AS len_bucket FROM lines")
def sort_bucket(spark, sf_dir):
    return corpus.bucket_and_sort(lines(spark, sf_dir).select("line"), "line")


@query("""WITH d AS (SELECT DISTINCT p_brand, p_type FROM part) SELECT a.p_brand, a.p_type FROM d a WHERE NOT EXISTS (SELECT 1 FROM d b WHERE a.p_brand = b.p_brand AND a.p_type <> b.p_type AND contains(b.p_type, a.p_type))""")
def containment_reduce(spark, sf_dir):
    return corpus.reduce_contained(table(spark, sf_dir, "part"), ["p_brand"], "p_type")


_PARTS = "SELECT DISTINCT p_size AS g, unnest([p_name, split_part(p_name, ' ', 1), split_part(p_name, ' ', 2), p_type, split_part(p_type, ' ', 3), left(p_type, 1)]) AS s FROM part"


@query(f"WITH d AS ({_PARTS}) SELECT a.g, a.s FROM d a WHERE NOT EXISTS (SELECT 1 FROM d b WHERE a.g = b.g AND a.s <> b.s AND contains(b.s, a.s))")
def contained_tags(spark, sf_dir):
    """Names, types and their words, one letter long and longer, by size: those that no other of a size contains."""
    word = lambda c, i: F.split_part(c, F.lit(" "), F.lit(i))
    tags = F.array("p_name", word("p_name", 1), word("p_name", 2), "p_type", word("p_type", 3), F.left("p_type", F.lit(1)))
    return corpus.reduce_contained(table(spark, sf_dir, "part").select(F.col("p_size").alias("g"), F.explode(tags).alias("s")), ["g"], "s")


@query("SELECT conv_id, turn, CASE WHEN n = 0 THEN CAST(conv_id AS VARCHAR) ELSE conv_id || '-' || n END AS version FROM (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS n FROM conversations)")
def version_suffix(spark, sf_dir):
    return corpus.version_suffix(table(spark, sf_dir, "conversations"), "conv_id", "turn").select("conv_id", "turn", "version")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_anti_join(spark, sf_dir):
    return corpus.not_done(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), "doc_id")


@query("SELECT event_id, event_type FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'")
def incremental_mtime(spark, sf_dir):
    return filters.newer_than(table(spark, sf_dir, "events"), "ts", "2024-01-15 00:00:00").select("event_id", "event_type")


@query("SELECT page_id, lpad(CAST(page_id // 100 AS VARCHAR), 6, '0') AS directory FROM pages")
def page_directories(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", corpus.directory_of(F.col("page_id"), 100).alias("directory"))


@query("SELECT d.doc_id, coalesce('q' || o.quality, 'q' || p.quality) AS meta FROM documents d LEFT JOIN labels o ON o.doc_id = d.doc_id LEFT JOIN labels p ON p.doc_id = d.doc_id + 1 - 2 * (d.doc_id % 2)")
def metadata_lookup(spark, sf_dir):
    """Metadata by a document's id, or by its alias: an even id and the next odd one are names of each other."""
    documents = table(spark, sf_dir, "documents").select("doc_id")
    meta = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("id"), F.concat(F.lit("q"), F.col("quality").cast("string")).alias("meta"))
    even = F.col("doc_id") - F.col("doc_id") % 2
    aliases = documents.select(even.cast("string").alias("a"), (even + 1).cast("string").alias("b")).distinct()
    return papers.with_metadata(documents, meta, aliases)


@query(f"WITH {_LINES} SELECT doc_id, CAST(line_no AS INT) AS line_no, CASE WHEN length(line) BETWEEN 1 AND 130 AND NOT regexp_matches(line, '[０-９0-9　 ]{{10,}}') THEN len(string_split(line, ' ')) - len(list_filter(string_split(line, ' '), lambda w: w = '')) END AS n FROM lines")
def distinct_annotate_join(spark, sf_dir):
    """Each distinct wanted line analysed once, then joined back: how many tokens the analysis has."""
    done = annotate.annotate(lines(spark, sf_dir), column="line")
    return done.select("doc_id", "line_no", F.when(F.col("analysis").isNotNull(), F.when(F.col("analysis") == "", 0).otherwise(F.size(F.split("analysis", "\n")))).cast("bigint").alias("n"))


@query(f"WITH {_LINES} SELECT doc_id, CAST(line_no AS INT) AS line_no, length(line) <= 130 AND length(line) > 0 AND NOT regexp_matches(line, '[０-９0-9　 ]{{10,}}') AS wanted FROM lines")
def annotation_guards(spark, sf_dir):
    return lines(spark, sf_dir).select("doc_id", "line_no", annotate.wanted(F.col("line")).alias("wanted"))


@query("SELECT doc_id, source AS scheme, text AS cdata FROM documents WHERE source <> 'src0'")
def remove_annotation(spark, sf_dir):
    """Annotations of one scheme removed from nested arrays."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.array(F.struct(F.col("source").alias("scheme"), F.lit("t").alias("tool"), F.col("text").alias("cdata"))).alias("a"))
    return docs.select("doc_id", F.explode(annotate.drop_annotation(F.col("a"), "src0")).alias("x")).select("doc_id", "x.scheme", "x.cdata")


@query("SELECT word, count(*) AS cnt FROM (SELECT unnest(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS word FROM documents) GROUP BY word")
def vocabulary(spark, sf_dir):
    words = table(spark, sf_dir, "documents").select(F.explode(english.words_of(F.col("text"))).alias("word"))
    return corpus.dedup_count(words, "word")


_ALL = "regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')"


@query(f"""WITH {_LINES}, w AS (SELECT doc_id, line_no, {_ALL} AS w, {_ALL}[3] || {_ALL}[4] AS tag FROM lines WHERE len({_ALL}) >= 4),
p AS (SELECT doc_id, line_no, tag, array_to_string(w, '') AS whole, unnest(w) AS t, unnest(range(len(w))) AS i FROM w),
o AS (SELECT *, CAST(sum(length(t)) OVER (PARTITION BY doc_id, line_no ORDER BY i) AS BIGINT) AS ends FROM p),
s AS (SELECT a.doc_id, a.line_no, a.i, b.i AS j FROM o a JOIN o b ON a.doc_id = b.doc_id AND a.line_no = b.line_no AND b.ends = a.ends - length(a.t) + length(a.tag) AND b.i >= a.i WHERE substr(a.whole, a.ends - length(a.t) + 1, length(a.tag)) = a.tag)
SELECT w.doc_id, CAST(w.line_no AS INT) AS line_no, string_agg('B:' || i || ',E:' || j, '/' ORDER BY i) AS spans FROM w JOIN s USING (doc_id, line_no) GROUP BY 1, 2""")
def tag_positions(spark, sf_dir):
    """Where a line's third and fourth words stand as a run of its tokens, for every line that has them."""
    found = lines(spark, sf_dir).select("doc_id", "line_no", english.words_of(F.col("line")).alias("w")).filter("size(w) >= 4")
    return found.select("doc_id", "line_no", papers.tag_spans(F.col("w"), F.concat(F.get("w", F.lit(2)), F.get("w", F.lit(3)))).alias("spans"))
