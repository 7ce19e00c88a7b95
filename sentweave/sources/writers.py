"""Writers of documents, links and text; each writes what a reader of this library reads again."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentweave.operators import standard_format
from sentweave.sources import named_files


def xml_documents(docs: DataFrame, path: str, compression: str = "gzip", **options) -> None:
    """One XML document a row, by shards of 10,000 ids; documents without sentences are left out."""
    shown = docs.filter(F.size("sentences") > 0)
    xml = standard_format.to_xml(shown, **options)
    xml.withColumn("shard", F.lpad(F.floor(F.col("doc_id") / 10_000).cast("string"), 6, "0")).withColumn("name", F.concat(F.lpad(F.col("doc_id").cast("string"), 9, "0"), F.lit(".xml"))).write.partitionBy("shard").option("compression", compression).parquet(path)


def xml_files(docs: DataFrame, path: str, compress: bool = False, mode: str = "append", **options) -> None:
    """One file a document by its nine-digit name (``.xml`` or ``.xml.gz``), in shards of 10,000 ids; documents without sentences have none."""
    xml = standard_format.to_xml(docs.filter(F.size("sentences") > 0), **options)
    named_files.write(xml, _shard(F.col("doc_id")), _file_name(F.col("doc_id"), compress), F.col("xml"), path, mode)


def _shard(number: Column) -> Column:
    return F.lpad(F.floor(number / 10_000).cast("string"), 6, "0")


def _file_name(number: Column, compress: bool = False) -> Column:
    return F.concat(F.lpad(number.cast("string"), 9, "0"), F.lit(".xml.gz" if compress else ".xml"))


def utf8_files(pages: DataFrame, path: str, shards: int = 64, mode: str = "append") -> None:
    """Decoded page files, one each, by their names, in shards by the name's hash."""
    named_files.write(pages, F.lpad(F.pmod(F.crc32("name"), F.lit(shards)).cast("string"), 6, "0"), F.concat("name", F.lit(".html")), F.col("html"), path, mode)


def plain_documents(docs: DataFrame, path: str, compression: str = "none") -> None:
    standard_format.plain_text(docs).select("text").write.option("compression", compression).text(path)


def sid_documents(docs: DataFrame, path: str, compression: str = "none") -> None:
    standard_format.sid_text(docs).select("text").write.option("compression", compression).text(path)


def utf8_pages(pages: DataFrame, path: str) -> None:
    """The decoded pages, as kept for later stages."""
    pages.select("name", "html").write.parquet(path)


def out_links(links: DataFrame, path: str) -> None:
    """Tab-separated: id, url, target, text; gzip."""
    links.select("from_id", "from_url", "to_url", "anchor").write.csv(path, sep="\t", compression="gzip", quote="", escape="")


def link_table(records: DataFrame, name: str, buckets: int = 64) -> None:
    """A table bucketed and sorted by key, so that joins by page id need no shuffle."""
    records.write.bucketBy(buckets, "key").sortBy("key").mode("overwrite").saveAsTable(name)


def length_buckets(lines: DataFrame, column: str, path: str) -> None:
    """Lines by length bucket, sorted by bytes, gzip; a bucket of many lines spreads over several files."""
    from sentweave.operators.corpus import bucket_and_sort

    bucket_and_sort(lines, column).select("len_bucket", F.col(column).alias("value")).write.partitionBy("len_bucket").option("compression", "gzip").text(path)


def dictionary(words: DataFrame, column: str, path: str) -> None:
    words.select(column).distinct().write.text(path)


def in_link_documents(links: DataFrame, path: str) -> None:
    """Documents of in-links alone, one file each."""
    grouped = links.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("anchor", "sources"))).alias("g"))
    body = F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?>\n<StandardFormat><Header>'), standard_format.links_xml(F.col("g"), "InLink", "sources"), F.lit("</Header></StandardFormat>"))
    named_files.write(grouped, _shard(F.col("doc_id")), _file_name(F.col("doc_id")), body, path)


