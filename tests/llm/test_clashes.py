"""Columns of the caller's that bear every name the operators use within: they pass through as they are."""

import inspect
import re

import pytest
from tests.llm.conftest import sentence
from sentweave.llm import alignment, common, conversations, decontaminate, exact_dedup, licenses, line_dedup, packing, quality, sharding, simhash, token_counts, toxicity, url_filter, wide_fingerprints
from sentweave.llm.queries import tokenizer_path

MODULES = (alignment, common, conversations, decontaminate, exact_dedup, licenses, line_dedup, packing, quality, sharding, simhash, token_counts, toxicity, url_filter, wide_fingerprints)
OWN = {"doc_id", "text", "source", "page_id", "url", "html"}


def inner_names() -> list[str]:
    """Every plain name in quotes in the operators' sources that could be a column's."""
    found = {n for m in MODULES for n in re.findall(r'"([a-zA-Z_][a-zA-Z0-9_]{0,20})"', inspect.getsource(m))}
    return sorted({n.lower() for n in found} - OWN)


@pytest.fixture(scope="module")
def docs(spark):
    names = inner_names()
    rows = [(i, f"Shared line.\n{sentence(i % 30, 60)}", "s", *["mine"] * len(names)) for i in range(36)]
    schema = "doc_id bigint, text string, source string, " + ", ".join(f"`{n}` string" for n in names)
    return spark.createDataFrame(rows, schema).repartition(2)


def passes(out, docs, made, n=36):
    rows = out.collect()
    assert len(rows) == n
    kept = [c for c in docs.columns if c in inner_names() and c not in made]
    assert len(kept) > 100
    assert all(r[c] == "mine" for r in rows[:3] for c in kept)


def test_names_pass_through(spark, docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id bigint, toxic int")
    items = spark.createDataFrame([(1, sentence(2, 14))], "item_id bigint, text string")
    scored = {"held_out", "score", "predicted"}
    for most in (10**6, 0):
        passes(toxicity.score(docs, labels, most_keys=most), docs, scored)
        passes(line_dedup.drop_repeated_lines(docs, batches=2, most=most), docs, {"n_lines", "n_dropped"})
        passes(quality.judge_quality(docs, 1, most=most), docs, set(quality.MADE))
    for block in (10**6, 3):
        passes(decontaminate.find_benchmark(docs, items, block_windows=block), docs, set(decontaminate.MADE))
    assert decontaminate.decontaminate(docs, items).columns == docs.columns
    passes(decontaminate.decontaminate(docs, items, remove="spans"), docs, set())
    passes(licenses.scan_licenses(docs), docs, {"text_digest", "license_id", "n_notices", "notices"})
    passes(simhash.keep_one_of_each(docs), docs, set(), 30)
    passes(simhash.keep_one_fingerprint(docs), docs, set(), 30)
    passes(exact_dedup.drop_copies(docs), docs, set(), 30)
    assert toxicity.drop_toxic(docs, labels).columns == docs.columns
    assert quality.keep_good(docs).columns == docs.columns


def test_names_never_enter(spark, docs):
    assert token_counts.count_tokens(docs, tokenizer_path("byte_bpe_50k.json")).count() == 36
    assert exact_dedup.find_copies(docs).count() == 36
    assert alignment.align(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")).count() == 36
    turns = docs.drop("conv_id", "turn", "role").selectExpr("*", "doc_id AS conv_id", "doc_id AS turn", "source AS role")
    assert conversations.digests(conversations.damage(turns), conversations.audits(conversations.damage(turns), turns)).count() == 36
    assert packing.pack(docs, tokenizer_path("word_bpe_49k.json")).count() >= 36
    assert sharding.kd_shards(docs, shards=3).count() == 36 and simhash.near_groups(docs).count() == 36
    pages = docs.drop("text").withColumnsRenamed({"doc_id": "page_id", "source": "url"}).withColumn("html", docs["key"])
    assert url_filter.judge_urls(pages).count() == 36
