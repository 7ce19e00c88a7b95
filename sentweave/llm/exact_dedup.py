"""Exact duplicates by Patricia tries: each text's owner is the least identifier at its terminal node.

Whole texts are dealt to partitions by length and content hash, after each task has put its own texts into a trie, so
that a text comes once a task. The partition's trie holds the full byte strings, compressed; a terminal node keeps the
smallest identifier and the number of rows. A trie that outgrows its bound hands on its largest subtree and sends what still
comes under it the same way; these entries are written and taken up by the next round, in finer partitions.
"""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentweave.llm.common import free, materialise, text_of

#: Bytes that a task's trie holds, and of the texts that a partition gets.
TRIE_BYTES, PARTITION_BYTES = 96_000_000, 32_000_000
#: What a node takes besides its label; texts given out at once.
_NODE_BYTES, _OUT_BYTES = 400, 4_000_000
#: Rows that repeat id and text and are written by one task.
COPIES_TOGETHER = 100_000
_ENTRY = "length bigint, digest binary, content binary, least {id}, n bigint, spilled boolean"
_NAMES = ["length", "digest", "content", "least", "n", "spilled"]
MAX_ROUNDS = 40


class Node:
    __slots__ = ("below", "digest", "label", "least", "n", "moved")

    def __init__(self, label: bytes):
        self.label, self.below, self.n, self.least, self.digest, self.moved = label, {}, 0, None, None, False


def shared(a: bytes, b: bytes) -> int:
    """How many first bytes are the same."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


class Trie:
    """A compressed radix trie over byte strings of about ``most`` bytes."""

    def __init__(self, most: int):
        self.root, self.most, self.size, self.texts = Node(b""), most, 0, 0

    def put(self, content: bytes, digest: bytes, least, n: int) -> bool:
        """Count a text at its terminal node; False where its subtree has been handed on, and the text must follow."""
        node, at = self.root, 0
        while at < len(content):
            child = node.below.get(content[at])
            if child is None:
                child = node.below[content[at]] = Node(content[at:])
                self.size += len(child.label) + _NODE_BYTES
            elif content[at : at + len(child.label)] != child.label:
                self._split(node, child, shared(content[at : at + len(child.label)], child.label))
                continue
            if child.moved:
                return False
            node, at = child, at + len(child.label)
        if node.n and node.digest != digest:
            raise ValueError("one text came with two digests")
        node.digest, node.least = digest, least if node.least is None else node.least if least is None else min(node.least, least)
        self.texts += not node.n
        node.n += n
        return True

    def full(self) -> bool:
        """A single text always has room."""
        return self.size > self.most and self.texts > 1

    def _split(self, node: Node, child: Node, k: int) -> None:
        """Put a node before ``child`` that holds the first ``k`` bytes of its label."""
        upper = Node(child.label[:k])
        node.below[upper.label[0]] = upper
        child.label = child.label[k:]
        upper.below[child.label[0]] = child
        self.size += _NODE_BYTES

    def entries(self, node: Node | None = None, before: bytes = b"") -> Iterator[tuple]:
        """``(digest, content, least, n)`` of every terminal node, without recursion."""
        todo = [(node or self.root, before)]
        while todo:
            at, before = todo.pop()
            whole = before + at.label
            if at.n:
                yield at.digest, whole, at.least, at.n
            todo += [(c, whole) for c in at.below.values() if not c.moved]

    def _bytes(self, node: Node) -> int:
        total, todo = 0, [node]
        while todo:
            at = todo.pop()
            total += len(at.label) + _NODE_BYTES
            todo += at.below.values()
        return total

    def spill(self) -> Iterator[tuple]:
        """Hand on the largest subtree below the first fork; its node stays, empty, to send what follows after it."""
        node, before = self.root, b""
        while not node.n and len(live := [c for c in node.below.values() if not c.moved]) == 1 and live[0].below:
            before, node = before + live[0].label, live[0]
        live = [c for c in node.below.values() if not c.moved]
        if not live:
            return
        weights = [self._bytes(c) for c in live]
        largest = live[max(range(len(live)), key=weights.__getitem__)]
        for entry in self.entries(largest, before):
            self.texts -= 1
            yield entry
        self.size -= max(weights)
        largest.below, largest.n, largest.least, largest.digest, largest.moved = {}, 0, None, None, True
        largest.label = largest.label[:1]  # all under this first byte follows
        self.size += _NODE_BYTES


def _owners(rows: DataFrame, id_type: str, most: int, resident: bool) -> DataFrame:
    """Terminal nodes of each partition's trie over ``(length, digest, content, least, n)``; a combiner's spills are as good as its entries."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, out, held, kind = Trie(most), [], 0, None

        def flush() -> pa.RecordBatch:
            nonlocal out, held
            columns = [[len(e[1]) for e in out], [e[0] for e in out], [e[1] if e[4] or not resident else None for e in out], [e[2] for e in out], [e[3] for e in out], [e[4] for e in out]]
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.binary(), pa.binary(), kind, pa.int64(), pa.bool_()), strict=True)], names=_NAMES)
            out, held = [], 0
            return batch

        def given(entries: Iterator[tuple], spilled: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held
            for e in entries:
                out.append((*e, spilled))
                held += len(e[1]) + 100
                if held > _OUT_BYTES:
                    yield flush()

        for batch in batches:
            kind = batch.schema.field("least").type
            for digest, content, least, n in zip(*(batch.column(c).to_pylist() for c in ("digest", "content", "least", "n")), strict=True):
                if not trie.put(content, digest, least, n):
                    yield from given(iter([(digest, content, least, n)]), True)
                if trie.full():
                    yield from given(trie.spill() if resident else trie.entries(), resident)
                    if not resident:
                        trie = Trie(most)
        if kind is not None:
            yield from given(trie.entries(), False)
            if out:
                yield flush()

    return rows.select("length", "digest", "content", "least", "n").mapInArrow(build, _ENTRY.format(id=id_type))


def owners(rows: DataFrame, total_bytes: int, trie_bytes: int = TRIE_BYTES, partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """``digest``, ``keep_id`` and ``group_size`` of each distinct text of ``rows`` (``length, digest, content, least, n``), written."""
    spark = rows.sparkSession
    id_type = rows.schema["least"].dataType.simpleString()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total_bytes // partition_bytes))
    todo, done = _owners(rows, id_type, trie_bytes, False), []
    for round_ in range(MAX_ROUNDS):
        dealt = todo.repartition(parts, "length", F.xxhash64("digest", F.lit(round_)))
        found, _ = materialise(_owners(dealt, id_type, trie_bytes, True), "owners")
        done.append(found.filter(~F.col("spilled")))
        todo = found.filter("spilled")
        left = todo.agg(F.sum("length")).first()[0]
        if left is None:
            break
        parts = max(parts * 2, -(-left // partition_bytes))
    else:
        raise RuntimeError(f"texts still spilled after {MAX_ROUNDS} rounds: raise trie_bytes")
    whole = done[0]
    for d in done[1:]:
        whole = whole.unionByName(d)
    return whole.select("digest", F.col("least").alias("keep_id"), F.col("n").alias("group_size"))


def normal(docs: DataFrame, text: str = "text"):
    """The text with each run of white space as one blank, null as empty."""
    return F.regexp_replace(text_of(docs, text), "[\\x20\\x09-\\x0D]+", " ")


def find_copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text", trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """``doc_id``, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` for each row.

    Texts are equal when they are so after ``normal``; null is an empty text. The least id stays, a null id only where the group has no
    other; of rows that repeat that id and text one stays. An empty table gives an empty result. No column but id and text is read.
    Members are met with their owner by digest, copies of one id already counted, and a hot text is split by Spark's skew join.
    """
    ids = docs[f"`{id_col}`"]
    content = F.encode(normal(docs, text), "UTF-8")
    keyed = docs.select(ids.alias("doc_id"), content.alias("content")).select("doc_id", F.octet_length("content").cast("bigint").alias("length"), F.unhex(F.sha2("content", 256)).alias("digest"), "content")
    members, _ = materialise(keyed.groupBy("doc_id", "length", "digest").agg(F.count(F.lit(1)).alias("copies")), "members")
    total = members.agg(F.sum("length")).first()[0] or 0
    found = owners(keyed.select("length", "digest", "content", F.col("doc_id").alias("least"), F.lit(1).cast("bigint").alias("n")), total, trie_bytes)
    met = _each(members).join(found, "digest")
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return met.select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def _each(members: DataFrame) -> DataFrame:
    """A row for each copy of a member, numbered; many copies of one are dealt out before they are made."""
    one = F.lit(1).cast("bigint")
    few = members.filter(F.col("copies") <= COPIES_TOGETHER).withColumn("chunk", F.lit(0).cast("bigint"))
    many = members.filter(F.col("copies") > COPIES_TOGETHER).withColumn("chunk", F.explode(F.sequence(one - 1, F.floor((F.col("copies") - 1) / COPIES_TOGETHER))))
    dealt = few.unionByName(many.repartition("doc_id", "digest", "chunk"))
    till = F.least("copies", (F.col("chunk") + 1) * COPIES_TOGETHER)
    return dealt.select("doc_id", "digest", F.explode(F.sequence(F.col("chunk") * COPIES_TOGETHER + 1, till)).alias("copy"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns as they came; cases as in ``find_copies``.

    Of rows that repeat id and text an arbitrary one stays; they may differ in other columns.
    """
    from pyspark.sql import Window

    key, which = free(docs, "digest", "which")
    stay = find_copies(docs, id_col, text).filter("kept").select(F.col("doc_id").alias("keep_id"), F.unhex("text_sha256").alias("keep_digest"))
    rows = docs.withColumn(key, F.unhex(F.sha2(F.encode(normal(docs, text), "UTF-8"), 256)))
    rows = rows.join(stay, rows[key].eqNullSafe(stay["keep_digest"]) & rows[f"`{id_col}`"].eqNullSafe(stay["keep_id"]), "leftsemi")
    first = rows.withColumn(which, F.row_number().over(Window.partitionBy(key, docs[f"`{id_col}`"]).orderBy(F.lit(1))))
    return first.filter(F.col(which) == 1).drop(key, which)
