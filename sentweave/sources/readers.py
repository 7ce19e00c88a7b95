"""Readers of pages, crawls, articles and dictionaries; all of them are plain DataFrames."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentweave.functions import encoding, text
from sentweave.operators.filters import is_text
from sentweave.sources import ordered

HEADER_END = "(?is)\\r?\\n\\r?\\n|(?=<html)"


def html_files(spark: SparkSession, path: str, recursive: bool = True, modified_after: str | None = None, glob: str = "*.html*") -> DataFrame:
    """``(name, path, modified, mtime, size, content)`` of html files, gzip or plain; files that aren't text are left out."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower())
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    raw = reader.load(path).withColumn("content", F.when(F.col("path").endswith(".gz"), encoding.gunzip(F.col("content"))).otherwise(F.col("content")))
    name = F.regexp_extract("path", "([^/]+?)(\\.html)?(\\.gz)?$", 1)
    return raw.filter(is_text(F.col("content"))).select(name.alias("name"), "path", F.col("modificationTime").alias("modified"), F.unix_timestamp("modificationTime").alias("mtime"), F.octet_length("content").cast("bigint").alias("size"), "content")


def with_info(files: DataFrame, info: DataFrame) -> DataFrame:
    """Files with ``url`` and ``encoding`` of their sidecars ``(name, value)``: first line, two fields."""
    first = F.split_part("value", F.lit("\n"), F.lit(1))
    known = info.select("name", F.split_part(first, F.lit(" "), F.lit(1)).alias("url"), F.nullif(F.split_part(first, F.lit(" "), F.lit(2)), F.lit("")).alias("given_encoding"))
    return files.join(known, "name", "left")


def archive(files: DataFrame) -> DataFrame:
    """``(name, size, linenum, content)`` as an archive of small files lists them."""
    return files.select("name", "size", F.size(F.split(F.decode("content", "ISO-8859-1"), "\r\n|\r|\n")).alias("linenum"), "content")


def decoded(files: DataFrame, language: str = "japanese", forced: str | None = None, given: str | None = None, retry_utf8: bool = True, content: str = "content", nfkc: bool = False) -> DataFrame:
    """Adds ``encoding`` and ``html``; what can't be resolved is read as UTF-8 (``retry_utf8``) or gets a null html. ``nfkc``: compatibility forms become plain ones."""
    found = files.withColumn("encoding", encoding.resolve_encoding(F.col(content), forced, F.col(given) if given else None, language))
    html = encoding.decode(F.col(content), F.col("encoding"))
    html = F.coalesce(html, F.make_valid_utf8(F.col(content).cast("string"))) if retry_utf8 else html
    return found.withColumn("html", encoding.normalise_nfkc(html) if nfkc else html)


#: Where a header ends, by style: at a blank line or where the html starts, at a blank line alone, at a line of one character at most.
_HEADS = {"crawler": ("^(HTML \\S+|HTTP/1)", "(?is)^(.*?)(?:\\r?\\n\\r?\\n|(?=<html))"), "inprocess": ("^HTML \\S+", "(?s)^(.*?\\n)\\r?(?:\\n|$)"), "wget": ("", "(?s)^(.*?\\n|)[^\\n]?\\n")}


def crawler_header(html: Column, style: str = "crawler") -> Column:
    """``struct<url, crawl_time, no_cache, no_index, body>`` of a page that may open with ``HTML <url> …`` and HTTP headers.

    ``crawler``: the header ends at a blank line or where the html starts; a page without one is all body. ``inprocess``: it ends at a blank line
    only, flags don't count, and a header that never ends leaves no body. ``wget`` (``--save-headers``): whatever stands before the first
    line of at most one character is the header, without a url; a page without such a line is all body.
    """
    opens, ends = _HEADS[style]
    has = html.rlike(opens) if style != "wget" else html.rlike(ends)
    flags = style == "crawler"
    if flags:
        head = F.when(has, F.regexp_extract(html, ends, 1)).otherwise(F.lit(""))
        body = F.when(has, F.regexp_replace(F.substring(html, F.length(head) + 1, F.length(html)), "^(\\r?\\n){1,2}", "")).otherwise(html)
    else:
        whole = F.regexp_extract(html, ends, 0)
        head = F.when(has, F.regexp_extract(html, ends, 1)).otherwise(F.lit(""))
        body = F.when(~has, html).when(whole == "", F.lit("")).otherwise(F.substring(html, F.length(whole) + 1, F.length(html)))
        head = F.when(has & (whole == ""), html).otherwise(head)
    first = F.regexp_extract(head, "^HTML ([^\\r\\n]+)", 1) if style != "wget" else F.lit("")
    date = F.regexp_extract(head, "(?im)^Date: *([^\\r\\n]+)", 1)
    no = lambda name: first.contains(name) if flags else F.lit(False)
    return F.struct(F.nullif(F.regexp_extract(first, "^(\\S+)", 1), F.lit("")).alias("url"), text.http_date(date).alias("crawl_time"), no("NOCACHE").alias("no_cache"), no("NOINDEX").alias("no_index"), body.alias("body"))


def split_pages(files: DataFrame, html: str = "html") -> DataFrame:
    """One row a page of files that hold several, each opening with a ``HTML <url>`` line."""
    return files.select(*[c for c in files.columns if c != html], F.posexplode(F.filter(F.split(html, "(?m)^(?=HTML https?://)"), lambda p: p != "")).alias("page_in_file", html))


def parameter(spark: SparkSession, path: str, default: str = "") -> str:
    """The first line of a small parameter file (a version, a crawl date)."""
    first = spark.read.text(path, wholetext=True).first()
    return first["value"].split("\n")[0].strip() if first else default


def html_lines(spark: SparkSession, path: str) -> DataFrame:
    """One html page a line."""
    return spark.read.text(path).withColumnRenamed("value", "html")


def articles(spark: SparkSession, path: str) -> DataFrame:
    """Whole text files with their names."""
    return spark.read.text(path, wholetext=True).select(F.regexp_extract(F.input_file_name(), "([^/]+?)(\\.txt)?$", 1).alias("name"), F.col("value").alias("text"))


def named_articles(files: DataFrame) -> DataFrame:
    """The same of ``named_files.read``: for more files than the driver should list."""
    return files.select(F.regexp_extract("name", "(.+?)(\\.txt)?$", 1).alias("name"), F.col("content").cast("string").alias("text"))


def medical_reports(spark: SparkSession, path: str) -> DataFrame:
    """Columns 0, 5, 6 and 7 of tab-separated files, each with a header line: id, findings, impression, order."""
    rows = numbered_lines(spark, path).filter((F.col("pos") > 0) & (F.col("value") != ""))
    wanted = {0: "fid", 5: "findings", 6: "impression", 7: "order_text"}
    return rows.select("file", "pos", *[F.nullif(F.get(F.split("value", "\t"), F.lit(i)), F.lit("")).alias(n) for i, n in wanted.items()])


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines with their file and their number in it, from 0; a large file is read by many tasks."""
    lines = ordered.lines(spark, path).withColumn("pos", F.lit(1).cast("bigint"))
    return ordered.carry(lines, counts=("pos",)).select("file", (F.col("pos") - 1).alias("pos"), "value")


def sid_lines(lines: DataFrame) -> DataFrame:
    """``(file, pos, sid, comment, str)`` of ``ordered.lines``: each sentence with the ``# S-ID:`` line right before it."""
    is_header = F.col("value").startswith("# S-ID:")
    marked = lines.withColumn("header", F.when(is_header, F.col("value"))).withColumn("pos", F.lit(1).cast("bigint"))
    rows = ordered.carry(marked, before=("header",), counts=("pos",)).filter(~is_header & F.col("header").isNotNull())
    return rows.select("file", (F.col("pos") - 1).alias("pos"), F.regexp_extract("header", "^# S-ID:(\\S+)", 1).alias("sid"), F.trim(F.regexp_replace("header", "^# S-ID:\\S+", "")).alias("comment"), F.col("value").alias("str"))


def page_lines(lines: DataFrame) -> DataFrame:
    """``(file, page, url, pos, str)`` of ``ordered.lines`` that hold ``<PAGE URL=…>`` lines."""
    is_page = F.col("value").rlike("^<PAGE URL=")
    url = F.when(is_page, F.regexp_extract("value", "URL=\"?([^\">]+)", 1))
    marked = lines.withColumns({"url": url, "page": is_page.cast("bigint"), "pos": F.lit(1).cast("bigint")})
    rows = ordered.carry(marked, last=("url",), counts=("page", "pos"))
    kept = rows.filter(~is_page & (F.col("value") != "") & ~F.col("value").startswith("</PAGE"))
    return kept.select("file", "page", "url", (F.col("pos") - 1).alias("pos"), F.col("value").alias("str"))


def analyzer_blocks(spark: SparkSession, path: str, charset: str = "utf8") -> DataFrame:
    """``(sid, blob)`` of analyzer output: blocks that open with ``# S-ID:`` and end with EOS.

    A large file is read by splits and decoded block by block: no charset here has a line feed within a character. A last block without
    its EOS gets one, on a line of its own.
    """
    raw = spark.read.option("lineSep", "\nEOS").text(path).filter(F.col("value").contains("# S-ID:"))
    b = F.regexp_replace(encoding.decode(F.col("value").cast("binary"), F.lit(charset)), "^(EOS\\r?\\n)?\\s+|^EOS\\r?\\n", "")
    return raw.select(b.alias("b")).select(F.regexp_extract("b", "# S-ID:(\\S+)", 1).alias("sid"), F.concat("b", F.lit("\nEOS")).alias("blob"))


def standard_format(spark: SparkSession, path: str) -> DataFrame:
    """``(name, xml)`` of StandardFormat files, gzip or plain."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return raw.select(F.regexp_extract("path", "([^/]+?)(\\.(xml|sf))?(\\.gz)?$", 1).alias("name"), F.make_valid_utf8(encoding.gunzip(F.col("content")).cast("string")).alias("xml"))


def prefixes(spark: SparkSession, path: str) -> DataFrame:
    """``(prefix, kind)`` of an abbreviation list: 1 always, 2 before numbers; ``#`` lines are comments."""
    lines = spark.read.text(path).filter((F.col("value") != "") & ~F.col("value").startswith("#"))
    return lines.select(F.trim(F.regexp_replace("value", "#NUMERIC_ONLY#", "")).alias("prefix"), F.when(F.col("value").contains("#NUMERIC_ONLY#"), 2).otherwise(1).alias("kind"))


def tagged_words(spark: SparkSession, path: str) -> DataFrame:
    """Distinct quoted words of a dictionary dump."""
    return spark.read.text(path).select(F.regexp_extract("value", "'(.+)'", 1).alias("word")).filter(F.col("word") != "").distinct()
