"""Quality rules by the frequency of lines across documents.

A first pass counts, for each host, the distinct documents (rows) that hold a line: normalised lines are hashed, once a
document, and summed up before they move. Lines in more than ``max_docs`` documents are boilerplate of that host. A
second pass over the texts takes the base counts, removes the boilerplate lines, and rejects documents that fail the base rules
or keep less than ``min_kept`` of their words. Boilerplate hashes are broadcast up to ``BROADCAST_ROWS``; beyond, each
document's own are joined to it by a shuffle.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentweave.functions.english import words_of
from sentweave.llm.common import ascii_lower, free, materialise, row_key, text_of

MAX_DOCS, MIN_KEPT = 20, 0.3
#: Boilerplate lines (of all hosts) are broadcast up to so many; beyond, they are joined by a shuffle.
BROADCAST_ROWS = 500_000
_SYMBOLS = b"#*$%&|<>"
_SPACES = b" \t\n\x0b\x0c\r"
_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MADE = [*_COUNTS, "base_failed", "n_boilerplate_words", "kept", "clean_text"]
#: Seeds of the two hashes of a line: the engine's own first seed, and that seed after the number 7 has been hashed.
SEEDS = (42, xxhash.xxh64_intdigest((7).to_bytes(4, "little"), 42))


def repeated_words(words: list[bytes], window: int = 3) -> int:
    """Words that lie in a window of three words found twice or more in the text."""
    if len(words) <= window:
        return 0
    ids: dict[bytes, int] = {}
    a = np.array([ids.setdefault(w, len(ids)) for w in words], np.int64)
    code = a[: len(a) - window + 1]
    for i in range(1, window):
        code = np.unique(code, return_inverse=True)[1] * len(ids) + a[i : len(a) - window + 1 + i]
    _, where, n = np.unique(code, return_inverse=True, return_counts=True)
    again = n[where] > 1
    covered = np.zeros(len(words), bool)
    for i in range(window):
        covered[i : i + len(again)] |= again
    return int(covered.sum())


def base_counts(text: str, raw: bytes, lines: list[bytes], split: list[list[bytes]]) -> tuple[int, int, int, int, int]:
    """Words, their code points, symbols, repeated lines, and words in repeated windows."""
    words = raw.split()
    seen: set[bytes] = set()
    dup = 0
    for line, own in zip(lines, split):
        if own:
            dup += line in seen
            seen.add(line)
    chars = sum(map(len, text.split())) if text.isascii() and not any(c in text for c in "\x1c\x1d\x1e\x1f") else len(raw.translate(None, _SPACES).decode())
    return len(words), chars, len(raw) - len(raw.translate(None, _SYMBOLS)), dup, repeated_words(words)


def line_hash(words: list[bytes], seed: int) -> int:
    """A line's hash as the engine's ``xxhash64`` gives it."""
    h = xxhash.xxh64_intdigest(b" ".join(words).lower(), seed)
    return h - (1 << 64) if h >> 63 else h


def line_hashes(docs: DataFrame, text: str) -> Column:
    """The two hashes of each distinct normalised line that has words."""
    keys = F.array_distinct(F.transform(F.split(text_of(docs, text), "\n", -1), lambda x: ascii_lower(F.array_join(words_of(x), " "))))
    return F.transform(F.filter(keys, lambda k: k != ""), lambda k: F.struct(F.xxhash64(k).alias("h1"), F.xxhash64(F.lit(7), k).alias("h2")))


def _host(docs: DataFrame, host: str) -> Column:
    return F.coalesce(docs[f"`{host}`"].cast("string"), F.lit(""))


def boilerplate(docs: DataFrame, max_docs: int = MAX_DOCS, text: str = "text", host: str = "source") -> DataFrame:
    """``(host, h1, h2)``: the lines that more than ``max_docs`` documents of the host hold."""
    lines = docs.select(_host(docs, host).alias("host"), F.explode(line_hashes(docs, text)).alias("h")).select("host", "h.*")
    counted = lines.groupBy("host", "h1", "h2").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") > max_docs).select("host", "h1", "h2")


def _judge(text: str, known: set[tuple[int, int]]) -> tuple:
    raw = text.encode()
    lines = raw.split(b"\n")
    split = [x.split() for x in lines]
    counts = base_counts(text, raw, lines, split)
    gone = [bool(own) and (line_hash(own, SEEDS[0]), line_hash(own, SEEDS[1])) in known for own in split] if known else [False] * len(lines)
    lost = sum(len(own) for own, g in zip(split, gone) if g)
    return *counts, lost, b"\n".join(x for x, g in zip(lines, gone) if not g).decode() if lost else text


_FIELDS = [*_COUNTS, "n_boilerplate_words", "clean_text"]
_TYPES = [pa.int64()] * 6 + [pa.string()]
_DDL = "struct<" + ",".join(f"{c}:bigint" for c in _FIELDS[:-1]) + ",clean_text:string>"


def _structs(rows: list[tuple]) -> pa.StructArray:
    return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * len(_FIELDS), _TYPES)], names=_FIELDS)


def judge_quality(docs: DataFrame, max_docs: int = MAX_DOCS, min_kept: float = MIN_KEPT, text: str = "text", id_col: str = "doc_id", host: str = "source", most: int = BROADCAST_ROWS) -> DataFrame:
    """``docs`` with the base counts, ``base_failed``, ``n_boilerplate_words``, ``kept`` and ``clean_text`` (without boilerplate lines).

    Null and empty texts have no words and fail; null hosts are one host with the empty one; null ids and repeated rows are
    documents of their own; an empty table gives an empty result; other columns pass through (those of the names above are replaced).
    """
    (name,) = free(docs, "found")
    frequent, _ = materialise(boilerplate(docs, max_docs, text, host), "boilerplate")
    if frequent.count() <= most:
        known: dict[str, set] = {}
        for h, h1, h2 in zip(*(c.to_pylist() for c in frequent.toArrow().columns)):
            known.setdefault(h, set()).add((h1, h2))
        sent = docs.sparkSession.sparkContext.broadcast(known)

        def judge(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            for texts, hosts in batches:
                yield _structs([_judge(t, sent.value.get(h, ())) for t, h in zip(texts.to_pylist(), hosts.to_pylist())])

        judge.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
        judged = docs.withColumn(name, F.arrow_udf(judge, _DDL)(text_of(docs, text), _host(docs, host)))
    else:
        judged = _joined(docs, frequent, name, text, id_col, host)
    part = lambda c: judged[f"`{name}`"][c]
    failed = (part("n_words") < 50) | (100 * part("n_repeat_words") > 50 * part("n_words"))
    kept = ~failed & ((part("n_words") - part("n_boilerplate_words")) >= min_kept * part("n_words"))
    own = [judged[f"`{c}`"] for c in docs.columns if c.lower() not in MADE]
    return judged.select(*own, *[part(c).alias(c) for c in _COUNTS], failed.alias("base_failed"), part("n_boilerplate_words").alias("n_boilerplate_words"), kept.alias("kept"), part("clean_text").alias("clean_text"))


def _joined(docs: DataFrame, frequent: DataFrame, name: str, text: str, id_col: str, host: str) -> DataFrame:
    """The same where there are too many boilerplate lines to broadcast: a document brings along those that it holds."""
    k1, k2, own = free(docs, "k1", "k2", "own")
    key = [*row_key(docs, id_col, text)]
    key[0] = F.xxhash64(key[0], _host(docs, host))
    lines = docs.select(key[0].alias(k1), key[1].alias(k2), _host(docs, host).alias("host"), F.explode(line_hashes(docs, text)).alias("h")).select(k1, k2, "host", "h.*")
    held = lines.join(frequent, ["host", "h1", "h2"], "left_semi").groupBy(k1, k2).agg(F.collect_set(F.struct("h1", "h2")).alias(own))

    def judge(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, held in batches:
            yield _structs([_judge(t, {(x["h1"], x["h2"]) for x in h or ()}) for t, h in zip(texts.to_pylist(), held.to_pylist())])

    judge.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    joined = docs.withColumn(k1, key[0]).withColumn(k2, key[1]).join(held, [k1, k2], "left")
    return joined.withColumn(name, F.arrow_udf(judge, _DDL)(text_of(joined, text), F.col(own)))


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without rejected documents and without boilerplate lines; all columns pass through."""
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), *[docs[c] for c in ("doc_id", "text", "source")])
    judged = judge_quality(rows, **options).filter("kept").select("row", "clean_text")
    return judged.select(*[F.col("clean_text").alias(c) if c.lower() == "text" else F.col("row")[c].alias(c) for c in docs.columns])
