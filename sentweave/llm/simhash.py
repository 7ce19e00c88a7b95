"""SimHash near-dedup: 64-bit fingerprints, pigeonhole blocks, Hamming verification and connected components.

A fingerprint is cut into ``BLOCKS`` parts. Two that differ in at most four bits differ in at most four parts, so at
least two of six parts are equal: each fingerprint is filed under every pair of parts (15 keys of 20 to 22 bits), and only
fingerprints under one key are compared. Equal fingerprints are one node throughout. Under a key the links are found by
following the near neighbours of each fingerprint once, so that at most one link a member is written: those links
connect exactly what all close pairs would, without writing the pairs of a group of near copies. A key that more than
``TOGETHER`` fingerprints share is not compared; its members are filed again under longer keys.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentweave.llm import wide_fingerprints
from sentweave.llm.common import free, materialise, remove, row_key, text_of
from sentweave.llm.components import components

SHINGLE, DISTANCE, SEED, BLOCKS = 4, 4, 42, 6
_AT_ONCE = 65536
#: Fingerprints under one key that a task compares, and the most parts that a key may have.
TOGETHER, MAX_SHARED = 20_000, 8


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The SimHash of a text's word shingles (repeats count); 0 without words."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts, last = (ends - sizes).tolist(), ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, last)], np.uint64)
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _AT_ONCE):
        part = hashes[i : i + _AT_ONCE]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", id_col: str = "doc_id", shingle: int = SHINGLE, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, *keep, fp)`` for each row; ``fp`` is the fingerprint as a signed long."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in batch.column("_text").to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fps)], names=[*batch.schema.names[:-1], "fp"])

    rows = docs.select(F.col(id_col).alias("doc_id"), *keep, text_of(docs, text).alias("_text"))
    return rows.mapInArrow(work, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]) + ", fp bigint")


def _masks(blocks: int, distance: int) -> list[int]:
    """Bit masks, one for each set of ``blocks - distance`` parts that a close pair may share."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    part = lambda i: (1 << cuts[i + 1]) - (1 << cuts[i])
    masks = [sum(map(part, chosen)) for chosen in combinations(range(blocks), blocks - distance)]
    return np.array(masks, np.uint64).view(np.int64).tolist()


def _near(a: np.ndarray, b: np.ndarray, distance: int) -> np.ndarray:
    return np.bitwise_count(np.bitwise_xor(a, b).view(np.uint64)) <= distance


def _links(fps: np.ndarray, distance: int) -> Iterator[tuple[int, int]]:
    """Links that connect whatever close pairs connect among these distinct fingerprints: at most one a member."""
    left = fps
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            f = front.pop()
            close = _near(left, f, distance)
            if close.any():
                found = left[close]
                left = left[~close]
                for g in found:
                    yield f, g
                front.extend(found)


def near_links(fps: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS, together: int = TOGETHER) -> DataFrame:
    """Links ``(u, v)`` between distinct fingerprints ``fp`` whose components are those of all close pairs.

    A task compares at most ``together`` fingerprints under one key. Those of fuller keys are handed on uncompared and filed
    anew in more and longer keys (two blocks more a round, each round complete by the same argument), until the keys leave
    fewer bits than a crowd needs; what crowds there are in the last round are compared as they are.
    """
    found = None
    while True:
        last = blocks + 2 - distance > MAX_SHARED
        masks = F.array(*map(F.lit, _masks(blocks, distance)))
        filed = fps.select("fp", F.posexplode(masks).alias("n", "mask")).select(F.xxhash64("n", F.col("fp").bitwiseAND(F.col("mask"))).alias("k"), "fp")
        dealt = filed.repartition("k").sortWithinPartitions("k", "fp")
        links = dealt.mapInArrow(_comparer(distance, None if last else together), "u bigint, v bigint")
        links = links.distinct() if last else materialise(links.distinct(), "links")[0]
        own = links.filter(F.col("v").isNotNull())
        found = own if found is None else found.unionByName(own)
        crowded = None if last else links.filter(F.col("v").isNull()).select(F.col("u").alias("fp"))
        if last or crowded.isEmpty():
            return found
        fps, blocks = crowded, blocks + 2


def _comparer(distance: int, together: int | None):
    """The work of a task on its sorted ``(k, fp)`` rows: links, and ``(fp, null)`` for the members of crowded keys."""

    def batch_of(u: list[np.ndarray], v: list[np.ndarray], crowd: list[np.ndarray]) -> pa.RecordBatch:
        ends = [pa.array(np.concatenate(x) if x else np.zeros(0, np.int64)) for x in (u + crowd, v)]
        n = sum(map(len, crowd))
        return pa.RecordBatch.from_arrays([ends[0], pa.concat_arrays([ends[1], pa.nulls(n, pa.int64())])], names=["u", "v"])

    def links(k: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
        u: list[np.ndarray] = []
        v: list[np.ndarray] = []
        crowd: list[np.ndarray] = []
        bounds = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1], [True]]))
        sizes = np.diff(bounds)
        for size in range(2, 5):  # small groups together: every pair
            at = bounds[:-1][sizes == size]
            for i, j in combinations(range(size), 2):
                a, b = f[at + i], f[at + j]
                close = _near(a, b, distance)
                u.append(a[close])
                v.append(b[close])
        for n in np.flatnonzero(sizes >= 5):
            own = f[bounds[n] : bounds[n + 1]]
            if together and len(own) > together:
                crowd.append(own)
            elif pairs := list(_links(own, distance)):
                a, b = np.array(pairs, np.int64).T
                u.append(a)
                v.append(b)
        return batch_of(u, v, crowd)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest_k, rest_f, full = np.zeros(0, np.int64), np.zeros(0, np.int64), None
        for batch in batches:
            k = np.concatenate([rest_k, batch.column(0).to_numpy(zero_copy_only=False)])
            f = np.concatenate([rest_f, batch.column(1).to_numpy(zero_copy_only=False)])
            if full is not None and len(k):  # what follows of a key that is known to be crowded
                cut = int(np.searchsorted(k, full, "right"))
                yield batch_of([], [], [f[:cut]])
                k, f, full = k[cut:], f[cut:], full if cut == len(k) else None
            if not len(k):
                rest_k, rest_f = k, f
                continue
            cut = int(np.searchsorted(k, k[-1]))  # the last key may go on in the next batch
            if cut:
                yield links(k[:cut], f[:cut])
            rest_k, rest_f = k[cut:], f[cut:]
            if together and len(rest_k) > together:
                yield batch_of([], [], [rest_f])
                full, rest_k, rest_f = rest_k[-1], rest_k[:0], rest_f[:0]
        if len(rest_k):
            yield links(rest_k, rest_f)

    return compare


def near_groups(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, blocks: int = BLOCKS, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, fp, component_id)`` for each row: the least id reachable over links of at most ``distance`` bits.

    Null and empty texts have fingerprint 0 and are linked like any other; a text of fewer words than a shingle is one
    shingle; null ids are never a component's name unless all of its ids are null; repeated rows stay; an empty table
    gives an empty result; other columns never enter.
    """
    rows, _ = materialise(fingerprints(docs, text, id_col, shingle), "fingerprints")
    named = _named(rows, distance, blocks)
    least = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_fp, _ = materialise(named.join(least, "component").select("fp", "component_id"), "named-fingerprints")  # as many as there are fingerprints
    return rows.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def _named(rows: DataFrame, distance: int, blocks: int) -> DataFrame:
    """``(fp, first_id, component)`` for each distinct fingerprint; a component's name is one of its fingerprints."""
    nodes, _ = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "nodes")
    linked = components(near_links(nodes.select("fp"), distance, blocks))
    return nodes.join(linked.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))


def hex_fingerprint(fp="fp"):
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def keep_one_fingerprint(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, blocks: int = BLOCKS) -> DataFrame:
    """``docs`` with one row of each group of linked fingerprints: the one with the least id (a null one only where all are null).

    Rows of one id with different texts are rows of their own; of repeated rows one stays. Rows are known by two hashes of
    id and text, on which they are shuffled once. Columns may have any names.
    """
    k1, k2 = free(docs, "k1", "k2")
    key = row_key(docs)
    keyed = docs.withColumn(k1, key[0]).withColumn(k2, key[1])
    own = docs.select(docs["doc_id"], key[0].alias("k1"), key[1].alias("k2"), text_of(docs).alias("text"))
    rows, at_rows = materialise(fingerprints(own, shingle=shingle, keep=("k1", "k2")), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k1", "k2")).alias("first")
    by_fp, _ = materialise(rows.groupBy("fp").agg(first), "first-rows")
    named = by_fp.join(_named(rows, distance, blocks).select("fp", "component"), "fp")
    remove(docs.sparkSession, at_rows)
    kept = named.groupBy("component").agg(F.min("first").alias("first")).select(F.col("first.k1").alias(k1), F.col("first.k2").alias(k2))
    return keyed.join(kept, [k1, k2], "left_semi").dropDuplicates([k1, k2]).select(*[keyed[f"`{c}`"] for c in docs.columns])


def keep_one_of_each(docs: DataFrame, shingle: int = wide_fingerprints.SHINGLE, similarity: float = wide_fingerprints.SIMILARITY) -> DataFrame:
    """``docs`` with one row of each group of near copies, by the similarity of their word shingles; see :mod:`wide_fingerprints`."""
    return wide_fingerprints.keep_one_of_each(docs, shingle, similarity)
