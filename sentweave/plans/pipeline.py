"""The whole way from pages to documents, links and annotations, by options."""

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentweave.functions import japanese
from sentweave.operators import annotate, filters, formatter, html, links, sentences, standard_format
from sentweave.session import unused
from sentweave.sources import readers


@dataclass(frozen=True)
class PipelineOptions:
    """What the command lines of such tools offer, as keywords with the intended defaults."""

    language: str = "english"
    max_bytes: int = filters.MAX_BYTES
    max_lines: int = filters.MAX_LINES
    max_chars: int | None = sentences.MAX_CHARS
    check_particles: bool = False
    particle_threshold: float = filters.PARTICLE_THRESHOLD
    min_score: float | None = None
    ignore_br: bool = False
    uniq_br: bool = False
    blog: bool = False
    paren: str = "remove"
    save_all: bool = False
    newspaper: bool = False
    crawler_header: bool = False
    annotator: str | None = None
    max_annotated_chars: int = annotate.MAX_CHARS
    compound_nouns: DataFrame | None = field(default=None, compare=False)


def prepare(pages: DataFrame, options: PipelineOptions, html_col: str = "html") -> DataFrame:
    """Pages within the limits; crawler headers and blog templates, where they are asked for, give way to blanks of as many bytes.

    So every offset in a prepared page is one in the file as it lies. The header's url counts before the table's own.
    """
    h = F.col(html_col)
    kept = pages.filter(filters.within_bytes(h, options.max_bytes) & filters.within_lines(h, options.max_lines))
    if options.crawler_header:
        (own,) = unused(kept, "header")
        kept = kept.withColumn(own, readers.crawler_header(h))
        url, body = F.coalesce(f"{own}.url", *([F.col("url")] if "url" in kept.columns else [])), F.col(f"{own}.body")
        removed = h.substr(F.lit(1), F.length(h) - F.length(body))
        blanked = F.when(F.length(removed) > 0, F.concat(html.blank(removed), body)).otherwise(h)
        kept = kept.withColumns({"url": url, "crawl_time": F.col(f"{own}.crawl_time"), html_col: blanked}).drop(own)
    if options.check_particles:
        kept = kept.filter(filters.has_particles(html.visible_text(h), options.particle_threshold))
    if options.blog:
        kept = kept.withColumn(html_col, html.drop_blog_template(h, keep_places=True))
    return kept


def _prepared_sentences(ready: DataFrame, options: PipelineOptions, id_col: str) -> DataFrame:
    found = sentences.sentences(ready, id_col, language=options.language, max_chars=options.max_chars, ignore_br=options.ignore_br, uniq_br=options.uniq_br, compound_nouns=options.compound_nouns)
    if options.min_score is not None:
        found = found.filter(F.col("japanese_score") >= options.min_score)
    found = sentences.sentence_ids(found, id_col)
    if options.language != "english":
        found = formatter.format_sentences(found, paren=options.paren, save_all=options.save_all, newspaper=options.newspaper)
    if options.annotator:
        found = annotate.annotate(found, options.annotator, condition=annotate.wanted(F.col("raw_string"), max_chars=options.max_annotated_chars))
    return found


def page_sentences(pages: DataFrame, options: PipelineOptions = PipelineOptions(), id_col: str = "page_id") -> DataFrame:
    """Numbered, scored and formatted sentences of the pages; annotated where an annotator is named."""
    return _prepared_sentences(prepare(pages, options), options, id_col)


def documents(pages: DataFrame, options: PipelineOptions = PipelineOptions(), id_col: str = "page_id") -> DataFrame:
    """Nested documents with their sentences and both link indexes, all of the prepared pages."""
    ready = prepare(pages, options)
    docs = standard_format.assemble(_prepared_sentences(ready, options, id_col), ready, id_col)
    named = links.with_ids(links.anchors(ready, id_col), ready.select("url", F.col(id_col).alias("doc_id")))
    return links.embed_links(docs, links.out_links(named), links.in_links(named))


def japanese_only(found: DataFrame, threshold: float = 0.3, column: str = "raw_string") -> DataFrame:
    """Sentences that score above the threshold."""
    return found.filter(japanese.japanese_score(F.col(column)) > threshold)
