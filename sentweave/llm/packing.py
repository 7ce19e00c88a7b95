"""Vector bin packing of tokenised documents under limits on tokens, segments and loss-bearing tokens.

Each map task tokenises its documents and packs them as it goes: a bounded pool of pieces, and one open sequence that
takes, again and again, the piece with the largest dot product of its sizes and the room left. When no piece fits the
room for tokens, one is cut to fill it. A task gives out full sequences only; what is left in its pool (less than a
sequence and what the other limits hold back) is packed once more over groups of tasks, so that padding does not grow
with the number of tasks; the last tokens of a group go into sequences of power-of-two lengths. Sequence ids are unique: they hold
the task and the running number.
"""

import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentweave.functions.batches import sliced
from sentweave.llm import bpe
from sentweave.llm.common import arrow_batches, materialise, text_of

POOL = 256
#: Tasks whose left-over pieces are packed together, and bits for the running number in a sequence id.
TASKS_TOGETHER, NUMBER_BITS = 16, 36
_TOKENS_AT_ONCE = 250_000
#: Rows that a Python worker gets at once.
BATCH = 1000
_REST = "start bigint, length bigint, ids binary, loss binary, doc_tokens bigint, sequence_id bigint, offset bigint, task int"
NAMES = ["doc_id", *(c.split(" ")[0] for c in _REST.split(", "))]
#: Texts with other characters go whole to the library; of these, lower case, composition and classes agree everywhere.
_WHOLE = re.compile(r"[^\x20-\x7e\n\t\r\xa1-ɏ‐-‧‰-⁞]")


def _four_bytes(ids: list[int]) -> bytes:
    """Ids as little-endian 32-bit numbers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class Encoder:
    """Little-endian 32-bit ids of whole texts, as ``encode(text, add_special_tokens=False)`` gives them."""

    def __init__(self, path: str):
        import regex

        self.tokenizer = bpe.load(path)
        self.split = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words = bpe.Cache(lambda p: _four_bytes(bpe.ids_of(self.tokenizer, p)))
        self.pieces = bpe.Cache(self.piece)

    def piece(self, piece: str) -> bytes:
        """Ids of what stands between blanks; letters alone are one word."""
        return self.words[piece] if piece.isalpha() else b"".join(map(self.words.__getitem__, self.split(piece)))

    def __call__(self, text: str) -> bytes:
        if _WHOLE.search(text) or any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.pieces.__getitem__, text.lower().split()))


class Piece:
    """Part of a document: its place, ids, and its sizes: tokens, one segment, loss-bearing tokens (``mask``: a byte a token, none if all bear loss)."""

    __slots__ = ("doc_id", "start", "ids", "doc_tokens", "mask", "sizes")

    def __init__(self, doc_id, start: int, ids: bytes, doc_tokens: int, mask: bytes | None = None):
        self.doc_id, self.start, self.ids, self.doc_tokens, self.mask = doc_id, start, ids, doc_tokens, mask
        n = len(ids) // 4
        self.sizes = (n, 1, n if mask is None else sum(mask))

    def part(self, a: int, b: int | None = None) -> "Piece":
        return Piece(self.doc_id, self.start + a, self.ids[4 * a : None if b is None else 4 * b], self.doc_tokens, None if self.mask is None else self.mask[a:b])

    def fitting(self, tokens: int, loss: int) -> int:
        """How many of its first tokens fit both limits."""
        if self.mask is None:
            return min(tokens, loss)
        over = np.flatnonzero(np.cumsum(np.frombuffer(self.mask, np.uint8)) > loss)
        return min(tokens, int(over[0]) if len(over) else len(self.mask))


class Packer:
    """Packs pieces into sequences under ``limits`` = (tokens, segments, loss-bearing tokens)."""

    def __init__(self, limits: tuple[int, int, int], task: int, first: int = 0):
        self.limits, self.task, self.number = np.array(limits, float), task, first
        self.pool: list[Piece] = []
        self.sizes = np.zeros((0, 3))

    def add(self, pieces: list[Piece]) -> None:
        if pieces:
            self.pool += pieces
            self.sizes = np.vstack([self.sizes, np.array([p.sizes for p in pieces], float)])

    def take(self, i: int) -> Piece:
        """Remove piece ``i``; the last one fills its place."""
        piece, last = self.pool[i], self.pool.pop()
        if i < len(self.pool):
            self.pool[i], self.sizes[i] = last, self.sizes[-1]
        self.sizes = self.sizes[:-1]
        return piece

    def sequence(self, tokens: int | None = None) -> list[Piece]:
        """Fill one sequence (of at most ``tokens``) from the pool; its pieces, in order."""
        room, chosen = self.limits.copy(), []
        room[0] = tokens or room[0]
        while self.pool and room[:2].min() > 0:
            fits = (self.sizes <= room).all(axis=1)
            if fits.any():
                scores = np.where(fits, (self.sizes / self.limits) @ (room / self.limits), -1.0)
                piece = self.take(int(scores.argmax()))
            else:  # cut the largest piece of which something fits to the room that is left
                found = ((i, n) for i in np.argsort(-self.sizes[:, 0], kind="stable") if (n := self.pool[i].fitting(int(room[0]), int(room[2]))))
                i, n = next(found, (0, 0))
                if not n:  # every piece goes on with a token that bears loss, and there is no room for one
                    break
                piece, rest = self.pool[i].part(0, n), self.pool[i].part(n)
                self.pool[i], self.sizes[i] = rest, rest.sizes
            chosen.append(piece)
            room -= np.array(piece.sizes, float)
        return chosen

    def rows(self, chosen: list[Piece]) -> list[tuple]:
        at, out, sequence_id = 0, [], (self.task << NUMBER_BITS) + self.number
        for p in chosen:
            out.append((p.doc_id, p.start, p.sizes[0], p.ids, p.mask, p.doc_tokens, sequence_id, at, None))
            at += p.sizes[0]
        self.number += 1
        return out

    def full(self, least: int) -> Iterator[list[tuple]]:
        """Sequences while the pool holds at least ``least`` pieces and could fill one by any limit."""
        while len(self.pool) >= least and ((self.sizes.sum(axis=0) >= self.limits).any()):
            yield self.rows(self.sequence())

    def rest(self) -> Iterator[list[tuple]]:
        """All that is left; what fills no sequence goes into lengths that are powers of two, which need no padding."""
        while self.pool:
            left = int(self.sizes[:, 0].sum())
            yield self.rows(self.sequence(1 << (left.bit_length() - 1) if left < self.limits[0] else None))


_KINDS = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]


def _batches(rows: Iterator[tuple], id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Rows of pieces as batches of a bounded number of tokens."""
    held, n = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), [id_type, *_KINDS])], names=NAMES)

    for row in rows:
        held.append(row)
        n += row[2]
        if n > _TOKENS_AT_ONCE:
            yield batch()
            held, n = [], 0
    if held:
        yield batch()


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, max_tokens: int = 4096, max_segments: int = 256, max_loss: int | None = None, parts: str | None = None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each piece of each document: its place in the document and in its sequence, and its ids.

    ``ids`` are little-endian unsigned 32-bit numbers; ``loss`` has a byte a token, 1 where it bears loss, and is null where all do. A
    document is its ids and ``end_id``; a null or empty text is ``end_id`` alone. Every id lies in exactly one piece. For instruction
    data, ``parts`` names a column ``array<struct<text:string,loss:boolean>>`` instead of a text: parts without loss (prompts)
    don't count towards ``max_loss``; the last part's mark holds for ``end_id`` too. A sequence holds at most ``max_tokens`` ids,
    ``max_segments`` pieces and ``max_loss`` ids that bear loss. Null ids and repeated rows are documents of their own; an empty
    table gives no piece; other columns never enter.
    """
    limits = (max_tokens, max_segments, max_tokens if max_loss is None else max_loss)
    if min(limits) < 1:
        raise ValueError("limits are 1 at least")
    end = np.array([end_id], "<u4").tobytes()

    def whole(encode: Encoder, value) -> tuple[bytes, bytes | None]:
        if parts is None:
            return encode(value) + end, None
        own = [(encode(p["text"] or ""), p["loss"] is not False) for p in value or [] if p is not None]
        mask = b"".join(bytes([loss]) * (len(ids) // 4) for ids, loss in own) + bytes([own[-1][1] if own else True])
        return b"".join(ids for ids, _ in own) + end, mask

    def map_side(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        encode, packer, kind = Encoder(tokenizer), Packer(limits, task), None

        def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
            for doc_id, value in zip(*(c.to_pylist() for c in batch.columns)):
                ids, mask = whole(encode, value)
                n = len(ids) // 4
                document = Piece(doc_id, 0, ids, n, mask)
                packer.add([document.part(i, i + max_tokens) for i in range(0, n, max_tokens)])
                for found in packer.full(POOL):
                    yield from found

        for batch in sliced(batches):
            kind = batch.schema.field(0).type
            yield from _batches(rows(batch), kind)
        if kind is not None:
            yield from _batches((row for found in packer.full(1) for row in found), kind)
            yield from _batches(((p.doc_id, p.start, p.sizes[0], p.ids, p.mask, p.doc_tokens, None, None, task) for p in packer.pool), kind)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a group's pieces come together; its sequence ids lie above those of the map tasks
        packer, group, kind = None, None, None

        def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
            nonlocal packer, group
            for r in batch.to_pylist():
                if r["g"] != group:
                    for found in packer.rest() if packer else ():
                        yield from found
                    group, packer = r["g"], Packer(limits, (1 << 26) + r["g"])
                packer.add([Piece(r["doc_id"], r["start"], r["ids"], r["doc_tokens"], r["loss"])])
                for found in packer.full(POOL):
                    yield from found

        for batch in sliced(batches):
            kind = batch.schema.field("doc_id").type
            yield from _batches(rows(batch), kind)
        if packer:
            yield from _batches((row for found in packer.rest() for row in found), kind)

    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, {_REST}"
    value = docs[f"`{parts}`"] if parts else text_of(docs, text)
    with arrow_batches(docs.sparkSession, BATCH):
        first, _ = materialise(docs.select(docs[f"`{id_col}`"].alias("doc_id"), value.alias("value")).mapInArrow(map_side, schema), "packed")
    left = first.filter(F.col("task").isNotNull()).withColumn("g", F.floor(F.col("task") / TASKS_TOGETHER).cast("bigint"))
    left = left.select("g", "task", "doc_id", "start", "ids", "loss", "doc_tokens").repartition("g").sortWithinPartitions("g", "task", "doc_id", "start")
    return first.filter(F.col("task").isNull()).unionByName(left.mapInArrow(again, schema)).drop("task")
