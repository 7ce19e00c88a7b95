"""Alignment of two tokenizers' tokens by the bytes they cover, and corpus-wide counts of the ids that meet.

Token A is a byte-level BPE entry of a blank and the text, token B a piece of the sentencepiece model, which puts that
blank itself. Documents of an Arrow batch are laid end to end: both tokenizers' ends are counted once over all its bytes,
groups are cut where both end, and prefix sums give every document its part back. Each task counts the pairs of ids whose
bytes overlap; the counts are summed over the corpus, and a second pass over the kept ids looks them up, a block of
pairs at a time, so that what is broadcast has a bound whatever the corpus.
"""

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentweave.llm import bpe
from sentweave.llm.common import broadcast, free, materialise, text_of

#: Pairs of ids that one broadcast holds (13 bytes each), characters that are laid end to end at once, pieces that a worker remembers.
BLOCK_PAIRS, AT_ONCE, REMEMBERED = 2_000_000, 1_000_000, 250_000
#: Pairs that a task counts before it hands them on, and the longest piece that is worth remembering.
TASK_PAIRS, LONGEST = 1_000_000, 64
#: A blank or line feed beside other white space or a control, or at an end of the text: there pre-tokens may reach beyond a piece.
_JOINED = re.compile(r"[\s\x00-\x1f\x7f-\xa0] |[ \n][\s\x00-\x1f\x7f-\xa0]|\s\n|^[ \n]|[ \n]$")
_NAMES = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "ids_a", "ids_b", "pair", "n"]
_SCHEMA = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, ids_a binary, ids_b binary, pair bigint, n bigint"


def _digits() -> tuple[np.ndarray, np.ndarray]:
    """Decimal ids with a separator after them, by separator (``,|;``) and id, and how long each is."""
    ids = np.arange(65536)
    width = 1 + (ids >= 10) + (ids >= 100) + (ids >= 1000) + (ids >= 10000)
    table = np.zeros((3, 65536, 6), np.uint8)
    for k in range(5):
        table[:, :, k] = 48 + ids // 10 ** np.maximum(width - 1 - k, 0) % 10
    for s, mark in enumerate(b",|;"):
        table[s, ids, width] = mark
    return table.reshape(-1, 6), (width + 1).astype(np.int64)


class Pair:
    """Both tokenizers; ids of whole texts, by remembered pieces between blanks where no token can reach over them."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.a, self.b = bpe.load(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.a.encode_special_tokens = True
        byte = {letter: b for b, letter in bpe.LETTERS.items()}
        entries = sorted(self.a.get_vocab(with_added_tokens=True).items(), key=lambda e: e[1])
        self.bytes_a = [bytes(byte[c] for c in e) if all(c in byte for c in e) else e.encode() for e, _ in entries]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))]
        if max(len(self.bytes_a), len(self.bytes_b)) > 65536 or [i for _, i in entries] != list(range(len(entries))):
            raise ValueError("ids must run from 0 without a gap and be below 65,536")
        self.length_a, self.length_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        self.open = self.b.piece_to_id("▁")
        self.new: dict[str, tuple] = {}
        self.old: dict[str, tuple] = {}

    def same(self, ids_a: list[int], ids_b: list[int], want: bytes) -> bool:
        return b"".join([self.bytes_a[i] for i in ids_a]) == want == b"".join([self.bytes_b[i] for i in ids_b])

    def learn(self, pieces: list[str]) -> dict[str, tuple]:
        """Ids of pieces, each after its blank; one that begins with a line feed has none. With them: whether both give its bytes."""
        found = {}
        blank = [p if p[:1] == "\n" else " " + p for p in pieces]
        for p, whole, x, y in zip(pieces, blank, self.a.encode_batch_fast(blank, add_special_tokens=False), self.b.encode(pieces, num_threads=1), strict=True):
            y = y[1:] if p[:1] == "\n" and y[:1] == [self.open] else y
            found[p] = (np.array(x.ids, "<u2").tobytes(), np.array(y, "<u2").tobytes(), self.same(x.ids, y, whole.encode()))
        return found

    def whole(self, text: str) -> tuple[bytes, bytes]:
        """Ids of a text by one call of each library; none where the bytes differ."""
        x, y = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        return (np.array(x, "<u2").tobytes(), np.array(y, "<u2").tobytes()) if self.same(x, y, (" " + text).encode()) else (b"", b"")

    def __call__(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """Both tokenizers' ids of each text, none for an empty text or where the bytes differ."""
        cut = [None if not t or _JOINED.search(t) else t.replace("\n", " \n").split(" ") for t in texts]
        need = {p for c in cut if c for p in c}
        unknown = []
        for p in need.difference(self.new):
            if p in self.old:
                self.new[p] = self.old[p]
            else:
                unknown.append(p)
        got = self.learn(unknown)
        self.new.update((p, v) for p, v in got.items() if len(p) <= LONGEST)
        own = {p: v for p, v in got.items() if len(p) > LONGEST}
        out = []
        for t, c in zip(texts, cut, strict=True):
            parts = [self.new.get(p) or own[p] for p in c] if c else []
            if c and all(x[2] for x in parts):
                out.append((b"".join([x[0] for x in parts]), b"".join([x[1] for x in parts])))
            else:
                out.append(self.whole(t) if t else (b"", b""))
        if len(self.new) > REMEMBERED:
            self.old, self.new = self.new, {}
        return out


class Laid:
    """Documents laid end to end: where tokens of either kind end, by bincount over their bytes."""

    def __init__(self, ids: list[tuple[bytes, bytes]], length_a: np.ndarray, length_b: np.ndarray):
        self.a, self.b = (np.frombuffer(b"".join([x[k] for x in ids]), "<u2").astype(np.int64) for k in (0, 1))
        #: tokens before each document and after the last
        self.at_a, self.at_b = (np.concatenate([[0], np.cumsum([len(x[k]) // 2 for x in ids], dtype=np.int64)]) for k in (0, 1))
        self.ends_a, self.ends_b = np.cumsum(length_a[self.a]), np.cumsum(length_b[self.b])
        size = int(self.ends_a[-1]) + 1 if len(self.a) else 1
        one, two = (np.bincount(e, minlength=size).astype(np.uint8) for e in (self.ends_a, self.ends_b))
        self.cut = one & two
        self.places = np.flatnonzero(one | two)
        #: the tokens over each elementary stretch of bytes: as many of a kind have ended before it
        self.link_a = self.a[np.cumsum(one, dtype=np.int32)[self.places] - one[self.places]]
        self.link_b = self.b[np.cumsum(two, dtype=np.int32)[self.places] - two[self.places]]
        self.pairs = (self.link_a << 16 | self.link_b).astype(np.uint32)
        #: bytes before each document, and with them links
        self.at = np.concatenate([[0], self.ends_a])[self.at_a]
        self.at_link = np.searchsorted(self.places, self.at, "right")

    def groups(self) -> np.ndarray:
        """Groups of each document."""
        return np.diff(np.concatenate([[0], np.cumsum(self.cut, dtype=np.int64)])[self.at + 1])

    def digests(self, table: np.ndarray, width: np.ndarray) -> list[str]:
        """SHA-256 of each document's groups as ``a1,a2|b1;a3|b2``; nothing for one without tokens."""
        last_a, last_b = self.cut[self.ends_a].astype(bool), self.cut[self.ends_b].astype(bool)
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        to_a, to_b = np.flatnonzero(last_a) + 1, np.concatenate([[0], np.flatnonzero(last_b) + 1])
        codes, n = np.empty(len(self.a) + len(self.b), np.int64), np.empty(len(self.a) + len(self.b), np.int64)
        place_a, place_b = np.arange(len(self.a)) + to_b[group_a], np.arange(len(self.b)) + to_a[group_b]
        codes[place_a], codes[place_b] = self.a + 65536 * last_a, self.b + 131072 * last_b
        n[place_a], n[place_b] = width[self.a], width[self.b]
        shown = table[codes][np.arange(6) < n[:, None]].tobytes()
        at = np.concatenate([[0], np.cumsum(n)])[self.at_a + self.at_b]
        view = memoryview(shown)
        return [hashlib.sha256(view[x : y - 1]).hexdigest() if y > x else "" for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def counted(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and how often (or with which summed weight) they occur."""
    if weights is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, weights = keys[order], weights[order]
    first = np.flatnonzero(np.concatenate([[len(keys) > 0], keys[1:] != keys[:-1]])[: len(keys)])
    if weights is None:
        return keys[first], np.diff(np.concatenate([first, [len(keys)]])).astype(np.int64)
    return keys[first], np.add.reduceat(weights, first) if len(first) else weights[:0]


def slices(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Runs of rows of ``AT_ONCE`` characters or bytes at most; a longer row is a run of its own."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > AT_ONCE:
            yield start, i
            start = i
            total = 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def _tokens(docs: DataFrame, path_a: str, path_b: str, keep: tuple[str, ...], text: str) -> tuple[DataFrame, list[str]]:
    """One row a document (ids, counts, digest) and rows of pairs of ids with a task's count, in one written table."""
    whole, uid = free(docs, "whole", "uid")
    rows = docs.select(*keep, F.monotonically_increasing_id().alias(uid), text_of(docs, text).alias(whole))
    fields = rows.schema.fields[:-1]

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, (table, width) = Pair(path_a, path_b), _digits()
        kept, waiting, held = None, [], 0

        def counts() -> pa.RecordBatch:
            keys, n = counted(np.concatenate([w[0] for w in waiting]), np.concatenate([w[1] for w in waiting]))
            none = lambda kind: pa.nulls(len(keys), kind)
            return pa.RecordBatch.from_arrays(
                [*(none(f.type) for f in kept), *(none(pa.int64()) for _ in range(4)), none(pa.string()), none(pa.binary()), none(pa.binary()), pa.array(keys.astype(np.int64)), pa.array(n)],
                names=[*(f.name for f in kept), *_NAMES],
            )

        for batch in batches:
            kept = list(batch.schema)[:-1]
            texts = batch.column(batch.num_columns - 1)
            sizes = [len(t) for t in (x.as_buffer() or b"" for x in texts)] if len(texts) else []
            for x, y in slices(sizes):
                ids = pair(texts.slice(x, y - x).to_pylist())
                laid = Laid(ids, pair.length_a, pair.length_b)
                own = [np.diff(laid.at_a), np.diff(laid.at_b), laid.groups(), np.diff(laid.at_link)]
                none = pa.nulls(y - x, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(x, y - x) for c in batch.columns[:-1]), *(pa.array(c.astype(np.int64)) for c in own), pa.array(laid.digests(table, width), pa.string()), pa.array([i[0] for i in ids], pa.binary()), pa.array([i[1] for i in ids], pa.binary()), none, none],
                    names=[*(f.name for f in kept), *_NAMES],
                )
                waiting.append(counted(laid.pairs))
                held += len(waiting[-1][0])
                if held > 2 * TASK_PAIRS:
                    waiting = [counted(np.concatenate([w[0] for w in waiting]), np.concatenate([w[1] for w in waiting]))]
                    held = len(waiting[0][0])
                    if held > TASK_PAIRS:
                        yield counts()
                        waiting, held = [], 0
        if held:
            yield counts()

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), _SCHEMA])
    table, _ = materialise(rows.mapInArrow(tokens, schema), "aligned-tokens")
    return table, [*keep, uid]


def pair_counts(tokens: DataFrame) -> DataFrame:
    """``pair`` (A's id times 65,536 and B's), ``n`` (links of the corpus that hold it), ``best`` (no pair of that B id has more)."""
    summed = tokens.filter("pair is not null").groupBy("pair").agg(F.sum("n").alias("n"))
    summed, _ = materialise(summed.withColumn("b", F.col("pair") % 65536), "pair-counts")
    most = summed.groupBy("b").agg(F.max("n").alias("most"))  # one row an id of B: 65,536 at most
    return summed.join(F.broadcast(most), "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align(docs: DataFrame, path_a: str, path_b: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text", block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """Columns ``keep``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``, ``ids_a`` and ``ids_b`` for each row.

    The ids are little-endian 16-bit numbers, so that the groups can be had from them again (``Laid``). Texts that are
    null or empty, or of which a tokenizer doesn't give the bytes back, have no tokens: zeros and an empty digest. Null ids and
    repeated rows are documents of their own and count each time; an empty table gives an empty result; columns not in ``keep``
    never enter the plan. A task holds about 20 bytes for each byte of its longest text.
    """
    spark = docs.sparkSession
    tokens, kept = _tokens(docs, path_a, path_b, keep, text)
    pairs, _ = materialise(pair_counts(tokens), "pairs")
    rows = tokens.filter("pair is null").drop("pair", "n")
    blocks = -(-pairs.count() // block_pairs) or 1
    if blocks == 1:
        return _looked_up(rows, path_a, path_b, spark.sparkContext.broadcast(_block(pairs))).drop(kept[-1])
    parts = []
    for k in range(blocks):
        with broadcast(spark, _block(pairs.filter(F.pmod(F.xxhash64("pair"), F.lit(blocks)) == k))) as sent:
            parts.append(materialise(_looked_up(rows.select(kept[-1], "ids_a", "ids_b"), path_a, path_b, sent).drop("ids_a", "ids_b"), "looked-up")[0])
    summed = parts[0]
    for p in parts[1:]:
        summed = summed.unionByName(p)
    summed = summed.groupBy(kept[-1]).agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return rows.join(summed, kept[-1]).drop(kept[-1])


def _block(pairs: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A block of pairs as sorted arrays; ``block_pairs`` rows or about so many."""
    found = pairs.toArrow()
    keys = found.column("pair").to_numpy().astype(np.uint32)
    order = np.argsort(keys)
    return keys[order], found.column("n").to_numpy()[order], found.column("best").to_numpy(zero_copy_only=False)[order]


def _looked_up(rows: DataFrame, path_a: str, path_b: str, sent) -> DataFrame:
    """``n_best`` and ``count_sum`` of each row's links, as far as the block has their pairs."""
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = Pair(path_a, path_b)
        keys, n, best = sent.value
        for batch in batches:
            one, two = batch.column("ids_a").to_pylist(), batch.column("ids_b").to_pylist()
            sums = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for x, y in slices([2 * len(i) for i in one]):
                laid = Laid(list(zip(one[x:y], two[x:y], strict=True)), pair.length_a, pair.length_b)
                known = np.unique(laid.pairs)
                at = np.minimum(np.searchsorted(keys, known), max(len(keys) - 1, 0))
                hit = keys[at] == known if len(keys) else np.zeros(len(known), bool)
                own, top = (np.where(hit, v[at], 0) if len(keys) else np.zeros(len(known), np.int64) for v in (n, best.astype(np.int64)))
                to = np.searchsorted(known, laid.pairs)
                for out, value in zip(sums, (top, own), strict=True):
                    out.append(np.diff(np.concatenate([[0], np.cumsum(value[to])])[laid.at_link]))
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(np.concatenate(s).astype(np.int64)) for s in sums)], names=[*batch.schema.names, "n_best", "count_sum"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields), "n_best bigint, count_sum bigint"])
    return rows.mapInArrow(look, schema)
