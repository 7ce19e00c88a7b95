"""Corpus utilities: counted dedup, length buckets, containment, versions, resuming."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LONGEST = 200
#: Lengths whose first characters strings are looked up by in containment: each string by the longest that it has.
LENGTH_CLASSES = (1, 2, 4, 8, 16, 32, 64)
COUNT = "COUNT:([0-9]+)"


def dedup_count(lines: DataFrame, key: str, comment: str | None = None, order: str | None = None, counted: bool = False) -> DataFrame:
    """``(key, comment, cnt)``: each line once, with the first comment and how often it came.

    ``counted``: comments hold ``COUNT:n`` of an earlier run, and these numbers are summed.
    """
    n = F.lit(1).cast("bigint")
    if counted:
        n = F.coalesce(F.regexp_extract(F.col(comment), COUNT, 1).try_cast("bigint"), n)
    out = [F.sum(n).cast("bigint").alias("cnt")]
    if comment:
        bare = F.trim(F.regexp_replace(F.col(comment), f" *{COUNT}", "")) if counted else F.col(comment)
        out.insert(0, F.min_by(bare, order).alias("comment"))
    return lines.groupBy(key).agg(*out)


def counted_line(key: str, layout: str = "merged") -> Column:
    """A line of the counted form: text, comment and count, or (``count_first``) the count first."""
    body = F.concat_ws(" ", F.col(key), F.col("comment"))
    return F.concat_ws(" ", F.col("cnt").cast("string"), body) if layout == "count_first" else F.concat(body, F.lit(" COUNT:"), F.col("cnt").cast("string"))


def length_bucket(line: Column) -> Column:
    """The length of the first blank-separated field, at most 200."""
    return F.least(F.length(F.split_part(line, F.lit(" "), F.lit(1))), F.lit(LONGEST))


def bucket_and_sort(lines: DataFrame, column: str, partitions: int | None = None) -> DataFrame:
    """Lines with their bucket, sorted by bytes within each bucket; buckets are dealt by range, large ones over several tasks."""
    marked = lines.withColumn("len_bucket", length_bucket(F.col(column)))
    keys = ["len_bucket", column]
    dealt = marked.repartitionByRange(partitions, *keys) if partitions else marked.repartitionByRange(*keys)
    return dealt.sortWithinPartitions(*keys)


def reduce_contained(rows: DataFrame, group: list[str], column: str) -> DataFrame:
    """Distinct strings of a group that no other string of the group contains.

    Candidates are found by an equi-join, not by comparing a whole group: a string that contains another holds that one's
    first characters somewhere. Each string is looked up by as many of its first characters as its length class has, and filed
    under all its pieces of the lengths that its group's classes have; so one short string doesn't bring all others together.
    """
    one = rows.select(*group, column).distinct()
    size = F.length(column)
    class_ = F.lit(1).cast("int")
    for n in LENGTH_CLASSES:
        class_ = F.when(size >= n, n).otherwise(class_)
    classes = one.select(*group, class_.alias("_n")).distinct()
    longer = one.join(classes, group).filter(size >= F.col("_n"))
    starts = F.sequence(F.lit(1), F.greatest(size - F.col("_n") + 1, F.lit(1)))
    pieces = longer.select(*group, "_n", F.col(column).alias("_whole"), F.explode(F.array_distinct(F.transform(starts, lambda i: F.substring(F.col(column), i, F.col("_n"))))).alias("_piece"))
    all_ = one.groupBy(*group).agg(F.max(column).alias("_whole"))  # whatever there is contains the empty string
    pieces = pieces.unionByName(all_.select(*group, F.lit(1).alias("_n"), "_whole", F.lit("").alias("_piece")))
    heads = one.withColumn("_n", class_).withColumn("_piece", F.substring(F.col(column), F.lit(1), F.col("_n")))
    within = (F.length("_whole") > F.length(column)) & F.contains(F.col("_whole"), F.col(column))
    return heads.join(pieces, [*group, "_n", "_piece"], "left").groupBy(*group, column).agg(F.coalesce(F.bool_or(within), F.lit(False)).alias("_within")).filter(~F.col("_within")).drop("_within")


def version_suffix(rows: DataFrame, key: str, order: str) -> DataFrame:
    """Adds ``version``: the key, then the key with ``-1``, ``-2`` … in order."""
    n = F.row_number().over(Window.partitionBy(key).orderBy(order)) - 1
    return rows.withColumn("version", F.when(n == 0, F.col(key).cast("string")).otherwise(F.concat_ws("-", F.col(key).cast("string"), n.cast("string"))))


def not_done(work: DataFrame, log: DataFrame, key: str) -> DataFrame:
    """Work that no log line (success, error, timeout) names."""
    return work.join(log.select(key).distinct(), key, "left_anti")


def directory_of(number: Column, per_directory: int = 10_000) -> Column:
    """The directory number of a page, six digits."""
    return F.lpad(F.floor(number / per_directory).cast("string"), 6, "0")
