"""Formatting of sentences: whole deletions, bracketed remarks, ids."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentweave.functions import japanese as J


def format_sentence(c: Column, paren: str = "remove", save_all: bool = False, newspaper: bool = False) -> Column:
    """``struct<sentence, log, parens>`` of a sentence.

    ``paren``: ``remove`` cuts bracketed remarks out, ``include`` keeps them in place, ``divide`` returns them as ``parens``
    (position, type, text). A sentence that is deleted whole has a null ``sentence`` and says so in ``log``; two
    enumerations delete it unless brackets are kept. ``save_all`` deletes nothing.
    """
    keep = save_all or paren in ("include", "divide")
    rule = J.deletion_rule(c, keep_marked=keep)
    marks = J.brackets(c)
    bare = c if paren == "include" else J.drop_leading_blank(J.without_brackets(c))
    if newspaper:
        bare = J.drop_newspaper_asides(bare)
    gone = F.lit(False) if save_all else rule.isNotNull()
    if not keep:
        gone = gone | (marks["enumerated"] >= 2)
    gone = gone | (bare == "") if not save_all else gone
    parens = F.transform(marks["found"], lambda b: F.struct(b["at"].alias("position"), J.bracket_type(b["text"]).alias("type"), b["text"].alias("text")))
    removed = F.array_join(F.transform(marks["found"], lambda b: F.concat(F.lit(" 部分削除:"), b["at"].cast("string"), F.lit(":（"), b["text"], F.lit("）"))), "")
    log = F.when(gone, F.concat(F.lit("全体削除:"), c)).when(F.lit(paren == "include") | (F.size(marks["found"]) == 0), F.lit(None)).otherwise(F.trim(removed))
    none = F.array().cast("array<struct<position:int,type:string,text:string>>")
    return F.struct(F.when(~gone, bare).alias("sentence"), log.alias("log"), F.when(~gone & F.lit(paren == "divide"), parens).otherwise(none).alias("parens"))


def format_sentences(found: DataFrame, column: str = "raw_string", **options) -> DataFrame:
    """Adds ``is_normal``, ``log``, ``formatted`` and ``parens``; the raw sentence stays, also where it is deleted."""
    done = found.withColumn("_f", format_sentence(F.col(column), **options))
    return done.select(*found.columns, F.coalesce(F.col("_f.sentence") != "", F.lit(False)).alias("is_normal"), F.col("_f.log").alias("log"), F.col("_f.sentence").alias("formatted"), F.col("_f.parens").alias("parens"))


def divide(found: DataFrame, sid: str = "sid") -> DataFrame:
    """One row for each formatted sentence (``…-01``) and each of its bracketed remarks (``…-02`` on)."""
    main = F.array(F.struct(F.lit(1).alias("n"), F.col("formatted").alias("text"), F.lit(None).cast("string").alias("type"), F.lit(None).cast("int").alias("position")))
    rest = F.transform("parens", lambda p, i: F.struct((i + 2).alias("n"), p["text"].alias("text"), p["type"].alias("type"), p["position"].alias("position")))
    rows = found.filter("is_normal").select(sid, F.explode(F.concat(main, rest)).alias("r"))
    return rows.select(F.concat_ws("-", F.col(sid), F.lpad(F.col("r.n").cast("string"), 2, "0")).alias("sid"), "r.text", "r.type", "r.position")


def comment_line(sid: Column, c: Column) -> Column:
    """A header line for the sentence: its id and the places of its bracketed remarks."""
    found = J.brackets(c)["found"]
    notes = F.transform(found, lambda b: F.concat(F.lit("括弧位置:"), b["at"].cast("string"), F.lit(" 括弧タイプ:"), J.bracket_type(b["text"])))
    return F.concat_ws(" ", F.concat(F.lit("# S-ID:"), sid), F.nullif(F.array_join(notes, " "), F.lit("")))


def assign_sids(lines: DataFrame, page: str, order: str, prefix: str = "") -> DataFrame:
    """Adds ``sid``: prefix, page number and running number within the page."""
    n = F.row_number().over(Window.partitionBy(page).orderBy(order))
    return lines.withColumn("sid", F.concat_ws("-", *([F.lit(prefix)] if prefix else []), F.col(page).cast("string"), n.cast("string")))
