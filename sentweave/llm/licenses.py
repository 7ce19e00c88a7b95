"""License scans by canonical digests (DataFrame functions only).

A text is made canonical: copyright lines go, A-Z is lower-cased, whatever is no letter or digit becomes one blank,
equivalent spellings become one. Its digest is hash-joined to the digests of known licence texts; the one-line
notices of a document are looked up by the same digest among the known notices.
"""

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentweave.llm.common import ascii_lower, free, materialise, text_of
from sentweave.llm.license_texts import LICENSES, NOTICES, SPELLINGS, TITLES

#: Known texts are broadcast up to so many (a digest and a name each); beyond, they are joined by a shuffle.
MAX_BROADCAST = 100_000

#: Lines that only say who holds the rights.
COPYRIGHT_LINE = "^[\\x20\\x09#*/;-]*(copyright|\\(c\\)|©)([\\x20\\x09:]|$).*$"
NO_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
#: A line is looked up as a notice only if it has one of these letters in a row.
NOTICE_HINT = "licen[cs]e|released under|rights reserved"


def canonical(text: Column) -> Column:
    lines = F.filter(F.split(ascii_lower(text), "\n", -1), lambda x: ~x.rlike(COPYRIGHT_LINE))
    words = F.filter(F.split(F.regexp_replace(F.array_join(lines, " "), NO_WORD, " "), " "), lambda w: w != "")
    same = F.create_map(*[F.lit(x) for pair in SPELLINGS.items() for x in pair])
    return F.array_join(F.transform(words, lambda w: F.coalesce(same[w], w)), " ")


def digest(text: Column) -> Column:
    """SHA-256 of the canonical text; null where nothing is left of it."""
    c = canonical(text)
    return F.when(c != "", F.sha2(c, 256))


def built_in() -> list[tuple[str, str]]:
    """``(text, licence)`` of all known texts: the short ones bare and under their usual titles, the long ones, the notices."""
    files = Path(__file__).parent / "licence_files"
    titled = [(f"{title}\n\n{LICENSES[n]}", n) for n, own in TITLES.items() for title in own]
    plain = [(t, n.removesuffix(" notice")) for n, t in LICENSES.items()]
    return plain + titled + [(p.read_text("utf-8"), p.stem) for p in sorted(files.glob("*.txt"))] + list(NOTICES.items())


def known(spark: SparkSession, registry: DataFrame | None = None) -> DataFrame:
    """``(license_digest, license_id)`` of the known texts: the built-in ones, or those of ``registry`` ``(text, license_id)``.

    A digest that two licences have counts with the least name; texts of which nothing is left are no licence.
    """
    table = registry if registry is not None else spark.createDataFrame(built_in(), "text string, license_id string")
    found = table.select(digest(F.col("text")).alias("license_digest"), "license_id").filter(F.col("license_digest").isNotNull())
    return found.groupBy("license_digest").agg(F.min("license_id").alias("license_id"))


def registry_of_files(spark: SparkSession, path: str) -> DataFrame:
    """A registry from a folder of text files, each named as its licence is."""
    return spark.read.text(path, wholetext=True).select(F.col("value").alias("text"), F.regexp_extract(F.input_file_name(), "([^/]+?)([.]txt)?$", 1).alias("license_id"))


def scan_licenses(docs: DataFrame, text: str = "text", registry: DataFrame | None = None, most: int = MAX_BROADCAST) -> DataFrame:
    """``docs`` (without the text) and ``text_digest``, ``license_id``, ``n_notices``, ``notices``.

    ``license_id`` is the licence that the whole text is; ``notices`` the comma-joined licences (sorted, each once) whose
    one-line notices stand in it, ``n_notices`` the number of such lines. Null texts, empty texts and such with nothing but
    punctuation or copyright lines have a null digest, no licence and an empty ``notices``; repeated rows stay; an empty
    table gives an empty result; other columns pass through, those of the names above are replaced. A ``registry`` replaces
    the built-in texts; beyond ``most`` of them it is joined by a shuffle.
    """
    made = ("text_digest", "license_id", "n_notices", "notices", text.lower())
    lines, key, name = free(docs, "lines", "license_digest", "known_as")
    t = text_of(docs, text)
    noted = F.transform(F.filter(F.split(t, "\n", -1), lambda x: F.lower(x).rlike(NOTICE_HINT)), digest)
    rows = docs.select(*[docs[f"`{c}`"] for c in docs.columns if c.lower() not in made], digest(t).alias("text_digest"), noted.alias(lines))
    table, _ = materialise(known(docs.sparkSession, registry).select(F.col("license_digest").alias(key), F.col("license_id").alias(name)), "licences")
    table = F.broadcast(table) if table.count() <= most else table
    found = rows.join(table, F.col("text_digest") == F.col(key), "left")
    notices = known(docs.sparkSession, docs.sparkSession.createDataFrame(list(NOTICES.items()), "text string, license_id string"))
    ids = F.create_map(*[F.lit(x) for r in notices.collect() for x in r])  # as many entries as the fixed list of notices has
    hits = F.filter(F.transform(F.col(lines), lambda d: F.try_element_at(ids, F.coalesce(d, F.lit("")))), lambda x: x.isNotNull())
    own = [found[f"`{c}`"] for c in rows.columns if c not in ("text_digest", lines)]
    return found.select(*own, "text_digest", F.col(name).alias("license_id"), F.size(hits).cast("bigint").alias("n_notices"), F.array_join(F.array_sort(F.array_distinct(hits)), ",").alias("notices"))
