"""Page-level predicates: columns to filter by, cheap ones first."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentweave.functions.japanese import particle_ratio

MAX_BYTES, MAX_LINES, PARTICLE_THRESHOLD = 5_242_880, 5_000, 0.005


def within_bytes(html: Column, most: int = MAX_BYTES) -> Column:
    return F.octet_length(html) <= most


def within_lines(html: Column, most: int = MAX_LINES) -> Column:
    return F.regexp_count(html, F.lit("\r\n|\r|\n")) <= most


def has_particles(text: Column, threshold: float = PARTICLE_THRESHOLD) -> Column:
    """Japanese enough: more particles a character than the threshold; empty texts are not."""
    return F.coalesce(particle_ratio(text) > threshold, F.lit(False))


def is_text(raw: Column) -> Column:
    """No NUL among the bytes, and at most a third of control bytes."""
    head = F.decode(raw, "ISO-8859-1")
    return ~head.contains("\x00") & (3 * F.regexp_count(head, F.lit("[\\x01-\\x08\\x0e-\\x1a\\x1c-\\x1f\\x7f]")) <= F.length(head))


def http_status(header: Column) -> Column:
    """The first HTTP/1.1 status code of a header; null without one."""
    return F.regexp_extract(header, "HTTP/1\\.1 (\\d+) ", 1).try_cast("int")


def bad_status(pages: DataFrame, id_col: str, header: str) -> DataFrame:
    """``(id, code)`` of the pages whose status isn't 200."""
    return pages.select(id_col, http_status(F.col(header)).alias("code")).filter(F.col("code") != 200)


def newer_than(pages: DataFrame, column: str, when: str) -> DataFrame:
    return pages.filter(F.col(column) > F.lit(when).cast(pages.schema[column].dataType))


def page_status(html: Column, max_bytes: int = MAX_BYTES, max_lines: int = MAX_LINES) -> Column:
    """Why a page is skipped (size, lines, empty), else ok: a placeholder row instead of an empty file."""
    return F.when(html.isNull() | (html == ""), "empty").when(~within_bytes(html, max_bytes), "size").when(~within_lines(html, max_lines), "lines").otherwise("ok")
