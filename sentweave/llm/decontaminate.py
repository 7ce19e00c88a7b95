"""Benchmark decontamination: documents are scanned for the word windows of benchmark items.

The windows are a table, worked out by the tasks: their words, and the items that they stem from. They become a broadcast
hash set: words as small integers, a rolling 64-bit hash for each window length, and the windows themselves for verifying a
hit. At most about ``block_windows`` windows are broadcast at a time. A larger benchmark is dealt into blocks by a hash of the
window; each block is collected, broadcast, scanned against all documents, its hits are written, and it is freed
before the next one; then the hits of a document are put together.
"""

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentweave.llm.common import broadcast, free, materialise, remove, row_key, text_of

WINDOW = 10
BLOCK_WINDOWS = 1_000_000
#: Words of the ASCII-lower-cased UTF-8 bytes: digits, a-z and everything beyond ASCII.
_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")
_PRIME = np.uint64(0x9E3779B97F4A7C15)
MADE = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated", "clean_text"]


def words_of(text: str | None) -> list[bytes]:
    return _WORDS.findall((text or "").encode().lower())


def window_table(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """``(words, items)``: the distinct windows of the benchmark, blank-separated words, with the items that have them."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(*(c.to_pylist() for c in batch.columns)):
                words = words_of(text)
                n = min(size, len(words))
                own = sorted({b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)}) if words else []
                yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in own], pa.string()), pa.array([item] * len(own), pa.string())], names=["words", "item"])

    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), text_of(benchmark).alias("text"))
    return rows.mapInArrow(cut, "words string, item string").groupBy("words").agg(F.collect_set("item").alias("items"))


class Windows:
    """Some windows, by length."""

    def __init__(self, windows: list[tuple[str, list[str]]]):
        self.ids: dict[bytes, int] = {}
        self.by_length: dict[int, dict[bytes, list[str]]] = {}
        for text, items in windows:
            words = text.encode().split(b" ")
            ids = np.array([self.ids.setdefault(w, len(self.ids) + 1) for w in words], np.int64)
            self.by_length.setdefault(len(words), {})[ids.tobytes()] = items
        self.hashes = {n: np.unique(self.hash(np.frombuffer(b"".join(known), np.int64).reshape(-1, n))) for n, known in self.by_length.items()}

    @staticmethod
    def hash(windows: np.ndarray) -> np.ndarray:
        h = np.zeros(len(windows), np.uint64)
        with np.errstate(over="ignore"):
            for column in windows.T:
                h = (h ^ column.astype(np.uint64)) * _PRIME
                h ^= h >> np.uint64(29)
        return h

    def scan(self, words: list[bytes]) -> tuple[list[int], set[str]]:
        """Positions of the words inside occurrences of windows, and the items with such."""
        get = self.ids.get
        ids = np.fromiter((get(w, 0) for w in words), np.int64, len(words))
        known = np.concatenate([[0], np.cumsum(ids > 0)])
        hit, items = np.zeros(len(words), bool), set()
        for n, hashes in self.hashes.items():
            if len(words) < n:
                continue
            at = np.flatnonzero(known[n:] - known[:-n] == n)
            if not len(at):
                continue
            h = self.hash(ids[at[:, None] + np.arange(n)])
            place = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            for i in at[hashes[place] == h]:
                if found := self.by_length[n].get(ids[i : i + n].tobytes()):
                    hit[i : i + n] = True
                    items.update(found)
        return np.flatnonzero(hit).tolist(), items


_RESULT = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()), ("items_sha256", pa.string()), ("clean_text", pa.string())])


def _told(text: str, n_words: int, hits: list[int], items: set[str]) -> tuple:
    digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
    return n_words, len(hits), len(items), digest, without_words(text, set(hits)) if hits else text


def _structs(rows: list[tuple]) -> pa.StructArray:
    columns = list(zip(*rows)) or [()] * len(_RESULT)
    return pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _RESULT)], fields=list(_RESULT))


def _scanned(docs: DataFrame, windows: Windows, text: str, name: str) -> DataFrame:
    """``docs`` and the struct ``name``, with all windows in one broadcast."""
    sent = docs.sparkSession.sparkContext.broadcast(windows)

    def judge(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield _structs([_told(t, len(w), *sent.value.scan(w)) for t in batch.to_pylist() for w in [words_of(t)]])

    judge.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return docs.withColumn(name, F.arrow_udf(judge, _DDL)(text_of(docs, text)))


_DDL = "struct<n_words:bigint,n_hit:bigint,n_items:bigint,items_sha256:string,clean_text:string>"


def _block_hits(docs: DataFrame, windows: DataFrame, blocks: int, text: str, id_col: str) -> tuple[DataFrame, list[str]]:
    """``(k1, k2, hits, items)`` of the documents with hits; one block of windows is in memory at a time."""
    spark, paths, found = docs.sparkSession, [], None
    key = row_key(docs, id_col, text)
    keyed = docs.select(key[0].alias("k1"), key[1].alias("k2"), text_of(docs, text).alias("text"))
    for b in range(blocks):
        own = windows.filter(F.pmod(F.xxhash64("words"), F.lit(blocks)) == b).toArrow()
        with broadcast(spark, Windows(list(zip(own.column("words").to_pylist(), own.column("items").to_pylist())))) as sent:

            def scan(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    rows = [(k1, k2, *sent.value.scan(words_of(t))) for k1, k2, t in zip(*(c.to_pylist() for c in batch.columns))]
                    k1, k2, hits, items = zip(*[(a, b, h, sorted(i)) for a, b, h, i in rows if h]) if any(r[2] for r in rows) else ((), (), (), ())
                    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.string())]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip((k1, k2, hits, items), kinds)], names=["k1", "k2", "hits", "items"])

            part, path = materialise(keyed.mapInArrow(scan, "k1 bigint, k2 bigint, hits array<int>, items array<string>"), "benchmark-hits")
        paths.append(path)
        found = part if found is None else found.unionByName(part)
    sets = lambda c: F.array_distinct(F.flatten(F.collect_set(c)))
    return found.groupBy("k1", "k2").agg(sets("hits").alias("hits"), sets("items").alias("items")), paths


def _in_blocks(docs: DataFrame, windows: DataFrame, blocks: int, text: str, id_col: str, name: str) -> DataFrame:
    """``docs`` and the struct ``name``, from the hits of all blocks."""
    k1, k2, hits, items = free(docs, "k1", "k2", "hits", "items")
    found, _ = _block_hits(docs, windows, blocks, text, id_col)
    found = found.select(*[F.col(a).alias(b) for a, b in zip(("k1", "k2", "hits", "items"), (k1, k2, hits, items))])
    key = row_key(docs, id_col, text)

    def tell(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, hit, item in batches:
            yield _structs([_told(t, len(words_of(t)), h or [], set(i or [])) for t, h, i in zip(texts.to_pylist(), hit.to_pylist(), item.to_pylist())])

    tell.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    joined = docs.withColumn(k1, key[0]).withColumn(k2, key[1]).join(found, [k1, k2], "left")
    return joined.withColumn(name, F.arrow_udf(tell, _DDL)(text_of(joined, text), F.col(hits), F.col(items)))


def _judged(docs: DataFrame, benchmark: DataFrame, window: int, block_windows: int, text: str, id_col: str) -> tuple[DataFrame, str]:
    """``docs`` and a struct of what was found in each, and the struct's name."""
    (name,) = free(docs, "found")
    windows, path = materialise(window_table(benchmark, window), "benchmark-windows")
    n = windows.count()
    if n <= block_windows:
        own = windows.toArrow()
        judged = _scanned(docs, Windows(list(zip(own.column("words").to_pylist(), own.column("items").to_pylist()))), text, name)
    else:
        judged = _in_blocks(docs, windows, -(-n // block_windows), text, id_col, name)
    remove(docs.sparkSession, path)
    return judged, name


def find_benchmark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated`` and ``clean_text``.

    ``clean_text`` is the text without its hit words and what separates them. Null and empty texts have no words and are
    clean; an item without words has no window; a null item id counts as an empty one and equal ids as one item; repeated
    rows and null ids are documents of their own; empty tables give an empty or an all-clean result; other columns pass
    through (those of the names above are replaced).
    """
    judged, name = _judged(docs, benchmark, window, block_windows, text, id_col)
    own = [judged[f"`{c}`"] for c in docs.columns if c.lower() not in MADE]
    part = lambda c: judged[f"`{name}`"][c]
    return judged.select(*own, *[part(c).alias(c) for c in MADE[:4]], (part("n_hit") > 0).alias("contaminated"), part("clean_text").alias("clean_text"))


def without_words(text: str, hits: set[int]) -> str:
    """The text without the words at these positions; what follows a removed word goes with it."""
    raw = text.encode()
    kept, at = [], 0
    spans = [m.span() for m in _WORDS.finditer(raw.lower())]
    for k, (start, _) in enumerate(spans):
        if k in hits:
            end = spans[k + 1][0] if k + 1 < len(spans) else len(raw)
            kept.append(raw[at:start])
            at = end
    return b"".join([*kept, raw[at:]]).decode()


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", window: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """``docs`` without contaminated documents, or (``remove="spans"``) with the hit words cut out of their texts.

    All columns pass through as they are, whatever their names.
    """
    judged, name = _judged(docs, benchmark, window, block_windows, "text", "doc_id")
    found = judged[f"`{name}`"]
    if remove == "documents":
        return judged.filter(found["n_hit"] == 0).select(*[judged[f"`{c}`"] for c in docs.columns])
    return judged.select(*[found["clean_text"].alias(c) if c.lower() == "text" else judged[f"`{c}`"] for c in docs.columns])
