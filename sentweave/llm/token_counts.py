"""Token counts by a map-side two-tier lookup.

Tier one is a compact table of frequent pre-tokens and their lengths in tokens. It is found by mergeable frequent-item
sketches over every document (one bounded sketch a task, merged in two steps), worked out once with the tokenizer on
the driver and broadcast: at most ``frequent`` entries. Tier two is a cache in each Python worker that encodes what tier one misses.
No pre-token is ever shuffled; only the sketches are.
"""

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentweave.llm import bpe
from sentweave.llm.common import free, text_of

#: Entries of tier one, and items that a frequent-item sketch tracks.
FREQUENT, TRACKED = 8192, 32768
SKETCH_GROUPS = 64
#: Texts with anything else than single blanks, line feeds and these scripts are cut into pre-tokens by the library: there another
#: Unicode version or a run of white space could move their bounds. Only texts with a special string go to it whole.
_WHOLE = re.compile(r"[^\x21-\x7e\xa1-՗‐-‧‰-⁞ \n]|[ \n][ \n]")


def frequent_words(docs: DataFrame, text: str = "text", k: int = FREQUENT) -> list[str]:
    """The most frequent blank-separated letter runs of all documents (approximate counts; they decide speed, never results)."""
    words = docs.select(F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("g"), F.explode(F.split(text_of(docs, text), " ")).alias("w"))
    words = words.filter(F.col("w").rlike("^[a-zA-Z\\u00c0-\\u024f]{1,40}$"))
    sketches = words.groupBy("g").agg(F.expr(f"approx_top_k_accumulate(w, {TRACKED})").alias("s"))
    found = sketches.withColumn("all", F.lit(0)).groupBy("all").agg(F.expr(f"approx_top_k_estimate(approx_top_k_combine(s, {TRACKED}), {k})").alias("top")).first()
    return [x["item"] for x in found["top"]] if found else []  # no group without any word


class Counter:
    """Counts the tokens of whole texts exactly as ``encode(text, add_special_tokens=False)`` does."""

    def __init__(self, path: str, table: dict[str, int]):
        import public_tokenizers
        import regex

        self.tokenizer = bpe.load(path)
        self.split = regex.compile(public_tokenizers.PATTERN).findall
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.pre_tokens = bpe.Cache(lambda p: len(bpe.ids_of(self.tokenizer, p)), table)
        fixed = {p[1:]: n for p, n in table.items() if p[0] == " "}
        self.pieces = bpe.Cache(self.piece, fixed)
        #: the same by the letters that the library shows bytes as
        self.shown = bpe.Cache(lambda p: len(self.tokenizer.model.tokenize(p)), {bpe.shown(p): n for p, n in table.items()})

    def piece(self, piece: str) -> int:
        """Tokens of a blank and ``piece``; a piece that opens a line starts with its line feed and has no blank."""
        if piece[:1] == "\n":
            return 1 + sum(self.pre_tokens[p] for p in self.split(piece[1:]))
        return sum(self.pre_tokens[p] for p in self.split(" " + piece))

    def __call__(self, text: str) -> int:
        if not text:
            return 0
        if any(s in text for s in self.special):
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        if _WHOLE.search(text):
            return sum(self.shown[p] for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text))
        pieces = text.replace("\n", " \n").split(" ")
        pieces[0] = "\n" + pieces[0]
        return sum(map(self.pieces.__getitem__, pieces)) - 1


def frequent_lengths(path: str, words: list[str]) -> dict[str, int]:
    """Tier one: pre-tokens (a word with its leading blank) and their lengths in tokens."""
    tokenizer = bpe.load(path)
    return {" " + w: len(bpe.ids_of(tokenizer, " " + w)) for w in words}


def count_tokens(docs: DataFrame, tokenizer: str, text: str = "text", limit: int = 512, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep``, ``n_bytes``, ``n_tokens`` and ``over_limit`` for each row.

    Null and empty texts count 0 and are not over the limit; null ids and repeated rows stay as they are; an empty
    table gives an empty result; columns not in ``keep`` never enter the plan.
    """
    spark = docs.sparkSession
    (whole,) = free(docs, "whole")
    table = spark.sparkContext.broadcast(frequent_lengths(tokenizer, frequent_words(docs, text)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(tokenizer, table.value)
        for batch in batches:
            n = pa.array([counter(t) for t in batch.column(batch.num_columns - 1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], n], names=[*batch.schema.names[:-1], "n_tokens"])

    rows = docs.select(*keep, F.octet_length(text_of(docs, text)).cast("bigint").alias("n_bytes"), text_of(docs, text).alias(whole))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]) + ", n_tokens bigint"
    counted = rows.mapInArrow(count, schema)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
