"""From segments to numbered sentences with their byte provenance."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentweave.functions import english, japanese, text
from sentweave.operators import html as H
from sentweave.operators.spans import japanese_sentences, sentence_spans

MAX_CHARS = 200


def clean_segment(c: Column) -> Column:
    """Entities decoded, control characters gone, blanks at the ends trimmed."""
    return text.trim_wide(text.delete_controls(text.decode_entities(c)))


def split_sentences(c: Column, language: str = "english") -> Column:
    """Sentences of one paragraph; every language but English takes the Japanese rules."""
    return english.split_english(c) if language == "english" else F.flatten(japanese.split_paragraphs(F.array(c), merge_items=False))


def sentences(pages: DataFrame, id_col: str = "page_id", html: str = "html", language: str = "english", max_chars: int | None = MAX_CHARS, merge_items: bool = True, **segment_options) -> DataFrame:
    """Every sentence of every page: role, numbers, text, its own byte span in the page, flags and score.

    Header parts (title, keywords, description) are never split; keywords and description stand inside tags and have no
    span. Sentences longer than ``max_chars`` are dropped before they are numbered. Pages without html and such beyond the
    size filter's bound have no sentence.
    """
    body = H.segments(pages, id_col, html, **segment_options).filter(~text.is_blank(F.col("text"))).withColumn("role", F.lit("body"))
    head = H.header_segments(pages, id_col, html).select(id_col, (F.col("slot") - 3).alias("seg_no"), "role", "text", "pieces")
    parts = body.unionByName(head, allowMissingColumns=True)
    english_ = language == "english"
    is_body = F.col("role") == "body"
    paragraphs = F.when(is_body, text.paragraphs(clean_segment(F.col("text")))).otherwise(F.array(text.squeeze_blanks(clean_segment(F.col("text")), False)))
    if not english_:
        paragraphs = F.transform(paragraphs, lambda p: text.normalise_japanese(p))
    keep = [id_col, "seg_no", "role", "block_type", "heading"]
    cut = parts.select(*keep, "pieces", paragraphs.alias("paragraphs"))
    if english_:
        split = F.when(is_body, F.transform("paragraphs", english.split_english)).otherwise(F.transform("paragraphs", lambda p: F.array(p)))
        one = lambda found, i: F.transform(found, lambda s, k: F.struct(i.alias("para_no"), k.alias("k"), s.alias("raw_string")))
        flat = cut.select(*keep, "pieces", F.filter(F.flatten(F.transform(split, one)), lambda x: x["raw_string"] != "").alias("found"))
        placed = flat.withColumn("spans", sentence_spans(F.col("pieces"), F.transform("found", lambda x: x["raw_string"]), joined=False))
        rows = placed.select(*keep, F.explode(F.arrays_zip("found", "spans")).alias("x"))
        rows = rows.select(*keep, "x.found.*", F.col("x.spans.offset").alias("offset"), F.col("x.spans.length").alias("length"))
    else:
        found = cut.withColumn("found", japanese_sentences(F.col("pieces"), F.col("paragraphs"), is_body, merge_items))
        rows = found.select(*keep, F.explode("found").alias("x")).select(*keep, "x.*")
    if max_chars:
        rows = rows.filter(F.length("raw_string") <= max_chars)
    order = Window.partitionBy(id_col).orderBy("seg_no", "para_no", "k")
    by_paragraph = Window.partitionBy(id_col).orderBy("seg_no", "para_no")
    return rows.select(
        id_col,
        F.row_number().over(order).cast("int").alias("sent_no"),
        F.dense_rank().over(by_paragraph).cast("int").alias("paragraph"),
        "role",
        "raw_string",
        "offset",
        "length",
        "block_type",
        F.coalesce("heading", F.lit(0)).alias("heading"),
        japanese.japanese_score(F.col("raw_string")).alias("japanese_score"),
    )


def sentence_ids(found: DataFrame, id_col: str = "page_id") -> DataFrame:
    """Adds ``sid``: page id and running number of the body sentences; header parts have none."""
    order = Window.partitionBy(id_col, F.col("role") == "body").orderBy("sent_no")
    number = F.row_number().over(order)
    return found.withColumn("sid", F.when(F.col("role") == "body", F.concat_ws("-", F.col(id_col).cast("string"), number.cast("string"))))


def split_lines(lines: DataFrame, column: str = "value", language: str = "japanese") -> DataFrame:
    """Sentences of plain text lines, one a row, in order."""
    return lines.select("*", F.posexplode(split_sentences(F.col(column), language)).alias("k", "sentence"))


def renumber(found: DataFrame, id_col: str, column: str = "paragraph") -> DataFrame:
    """Paragraph numbers without gaps, from 1 in each document."""
    return found.withColumn(column, F.dense_rank().over(Window.partitionBy(id_col).orderBy(column)).cast("int"))
