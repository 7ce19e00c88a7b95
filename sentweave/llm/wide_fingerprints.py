"""The near-dedup stage of simhash: wider SimHash fingerprints, blocks of their bits, Hamming checks, and the texts themselves.

A fingerprint has ``BITS`` sign bits of a text's shingles (each once). Texts that share 0.8 of their
shingles differ in about 15 % of them, others in up to half. Each fingerprint is filed under blocks of its bits, fixed
random choices of them, and those under one key are compared: in ``ROUGH`` bits at once, then, joined, in all. What
differs in ``FAR`` bits at most is a candidate and is verified by the texts' whole sets of shingles.

A block has as many bits as leave two to four chance texts under a key, but no more than ``BITS_ENOUGH`` while that leaves ``CHANCE`` at
most (16 million texts): so rows filed grow with the texts. There are so many blocks that a pair which differs in 16 % of its bits
shares none with a chance of ``MISS``. The first ``FIRST`` blocks are worked off and verified alone: they connect nearly all near
copies, and what they connect is not compared again. The others follow ``KEYS_AT_ONCE`` at a time, so that disk holds the rows of so many only.

A text that is close to at most ``TOGETHER`` unconnected ones under a key has all these pairs written. Among texts close to more
(crowds: groups of near copies) at most one a text is; once these are verified, only candidates between texts that are not yet connected
follow, first the best ``BEST`` a text, then all that are left. So the components are those of all verified candidates. More than ``BLOCK``
texts under a key are taken in parts, dealt by another hash under each key; what isn't connected then asks all parts of the crowd.
"""

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentweave.llm.common import arrow_batches, forget_shuffles, free, materialise, remove, row_key, text_of
from sentweave.llm.components import components

SHINGLE, SIMILARITY, SEED = 5, 0.8, 42
#: Bits of a fingerprint and in how many of them candidates differ at most; the same of the part that goes with every key, and what differs less is linked first in crowds.
BITS, FAR = 1024, 240
ROUGH, ROUGH_FAR, TREE_FAR = 128, 42, 20
#: Share of equal bits of the pairs that are not to be missed (0.849 at a similarity of 0.8, a little less for short texts), and the chance to miss one.
EQUAL, MISS = 0.84, 1e-6
TOGETHER, BEST, FIRST, KEYS_AT_ONCE = 4, 8, 8, 48
#: Bits of a block that are enough for all but huge tables, and chance texts under a key from which on a block has more.
BITS_ENOUGH, CHANCE = 14, 1024
#: Texts under one key that a task compares at once; larger crowds are dealt into parts of about so many. Groups of up to ``SMALL`` are compared side by side.
BLOCK, SMALL, _CELLS = 4096, 64, 1 << 19
#: Texts to be verified whose keys are sent to all tasks, so that the other texts are not shuffled.
MOST_SENT = 2_000_000
#: Rows that a Python worker gets at once.
BATCH = 1000
#: Texts of fewer shingles have ties broken; those of so many are filed under their shingles too, as four out of five differ in 19 % of the bits.
_FEW, _TINY = 64, (4, 5)
_MIX = np.random.default_rng(SEED).integers(0, 2**64, (3, BITS // 64), np.uint64) | np.array([[1], [0], [1]], np.uint64)


def shingles(text: str, shingle: int = SHINGLE) -> tuple[int, int, np.ndarray]:
    """A text's name and its second name (hashes of its words) and the sorted distinct hashes of its shingles; 0, 0 and none without words."""
    words = text.encode().lower().split()
    if not words:
        return 0, 0, np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    own = {digest(joined[a:b], SEED) for a, b in zip(starts, ends[min(shingle, len(words)) - 1 :].tolist())}
    return digest(joined), digest(joined, ~SEED & 0xFFFF), np.sort(np.fromiter(own, np.uint64, len(own)))


def _bits(hashes: np.ndarray) -> np.ndarray:
    """``BITS`` bits, 0 or 1, of each hash."""
    words = hashes[:, None] * _MIX[0] + _MIX[1]
    words ^= words >> np.uint64(29)
    words *= np.uint64(0xBF58476D1CE4E5B9)
    words ^= words >> np.uint64(32)
    return np.unpackbits(words.view(np.uint8).reshape(-1)).reshape(len(hashes), BITS)


def simhash(hashes: np.ndarray) -> bytes:
    """The sign bits of these hashes: 1 where most of them have 1.

    Where as many of a few hashes have 0, one hash's bit decides, the least by another permutation for each 64 bits: 0
    there would make all short texts alike.
    """
    n, counts = len(hashes), np.zeros(BITS, np.int64)
    for i in range(0, n, 255):  # a byte holds the sum of so many
        bits = _bits(hashes[i : i + 255])
        counts += bits.sum(axis=0, dtype=np.uint8)
    ones = 2 * counts > n
    if n % 2 == 0 and n < _FEW:
        one = bits.reshape(n, -1, 64)[(hashes[:, None] * _MIX[2]).argmin(axis=0), np.arange(BITS // 64)].reshape(-1)
        ones |= (2 * counts == n) & (one == 1)
    return np.packbits(ones).tobytes()


def blocks_for(n: int, enough: int | None = None) -> np.ndarray:
    """Which bits make up each block, for ``n`` texts: a row a block. Two to four chance texts share a key, or with ``enough`` bits up to ``CHANCE``."""
    bits = max(8, math.ceil(math.log2(max(n, 1))) - 2)
    if enough:
        bits = min(bits, max(enough, math.ceil(math.log2(max(n, 1) / CHANCE))))
    blocks = math.ceil(math.log(MISS) / math.log(1 - EQUAL**bits))
    rng, each = np.random.default_rng(SEED), BITS // bits
    return np.concatenate([rng.permutation(BITS)[: each * bits].reshape(each, bits) for _ in range(-(-blocks // each))])[:blocks]


def _sliced(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in slices of a few rows, so that a worker holds the words and hashes of these only."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def signatures(docs: DataFrame, shingle: int = SHINGLE, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(*keep, node, second, bands, sig)`` for each row; texts without words have node 0 and no fingerprint. ``bands`` are keys beside the blocks."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches):
            nodes, seconds, bands, sigs = [], [], [], []
            for text in batch.column("_text").to_pylist():
                node, second, hashes = shingles(text, shingle)
                nodes.append(node)
                seconds.append(second)
                bands.append(hashes.view(np.int64) if len(hashes) in _TINY else [])
                sigs.append(simhash(hashes) if len(hashes) else None)
            made = [*(pa.array(np.array(n, np.uint64).view(np.int64)) for n in (nodes, seconds)), pa.array(bands, pa.list_(pa.int64())), pa.array(sigs, pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], names=[*batch.schema.names[:-1], "node", "second", "bands", "sig"])

    rows = docs.select(*keep, text_of(docs).alias("_text"))
    return rows.mapInArrow(work, "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1]) + "node bigint, second bigint, bands array<bigint>, sig binary")


def _sigs(column: pa.Array, kind: type = np.uint64) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def _filed(nodes: DataFrame, blocks: np.ndarray, first: int) -> DataFrame:
    """``(k, node, component, a, b)``: each fingerprint under its key in each of these blocks, numbered from ``first``, with its ``ROUGH`` bits. Keys of its own come with the first block."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = (np.arange(first, first + len(blocks), dtype=np.int64) << 40)[None, :]
        for batch in _sliced(batches):
            if not batch.num_rows:
                continue
            sigs = _sigs(batch.column("sig"), np.uint8)
            own = np.packbits(np.unpackbits(sigs, axis=1)[:, blocks], axis=2).astype(np.int64)
            keys = numbers + sum(own[:, :, i] << (8 * i) for i in range(own.shape[2]))
            rough = np.ascontiguousarray(sigs[:, : ROUGH // 8]).view(np.int64)
            k, times = keys.reshape(-1), len(blocks)
            if not first:
                bands = [np.array(x, np.int64) for x in batch.column("bands").to_pylist()]
                k, times = np.concatenate([x for pair in zip(keys, bands) for x in pair]), [len(blocks) + len(x) for x in bands]
            columns = [k, *(np.repeat(x, times) for x in (batch.column("node").to_numpy(), batch.column("component").to_numpy(), rough[:, 0], rough[:, 1]))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["k", "node", "component", "a", "b"])

    return nodes.select("node", "component", "bands", "sig").mapInArrow(work, "k bigint, node bigint, component bigint, a bigint, b bigint")


def _differ(sigs: np.ndarray, others: np.ndarray) -> np.ndarray:
    """In how many bits fingerprints (rows of 64-bit words) differ."""
    return np.bitwise_count(sigs ^ others).sum(axis=1, dtype=np.int64)


def _tree(nodes: np.ndarray, sigs: np.ndarray) -> Iterator[tuple[int, int]]:
    """Links that connect what differs in as few bits as similar texts do: at most one a text."""
    while len(nodes):
        front = [(nodes[0], sigs[0])]
        nodes, sigs = nodes[1:], sigs[1:]
        while front and len(nodes):
            node, sig = front.pop()
            close = _differ(sigs, sig) <= TREE_FAR
            if close.any():
                yield from ((node, x) for x in nodes[close])
                front.extend(zip(nodes[close], sigs[close]))
                nodes, sigs = nodes[~close], sigs[~close]


def _near_in_small(k: np.ndarray, sigs: np.ndarray, comps: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Places ``(i, j)``, i < j, of all close texts of different components under one key, where no key has more than ``most`` rows."""
    i, j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for d in range(1, min(most, len(k))):
        at = np.flatnonzero(k[d:] == k[:-d])
        if not len(at):
            break
        at = at[(_differ(sigs[at], sigs[at + d]) <= ROUGH_FAR) & (comps[at] != comps[at + d])]
        i.append(at)
        j.append(at + d)
    return np.concatenate(i), np.concatenate(j)


def _near_in_large(sigs: np.ndarray, comps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the texts under one key to how many of other components each is close, and the pairs ``(i, j)`` of those that are to ``TOGETHER`` at most, each once."""
    n, i, j, degrees = len(sigs), [], [], []
    for start in range(0, n, step := max(1, _CELLS // n)):
        rows = sigs[start : start + step, :, None]
        apart = sum(np.bitwise_count(rows[:, w] ^ sigs[None, :, w]) for w in range(sigs.shape[1]))
        near = (apart <= ROUGH_FAR) & (comps[start : start + step, None] != comps[None, :])
        degrees.append(near.sum(axis=1))
        few = np.flatnonzero(degrees[-1] <= TOGETHER)
        at, other = np.nonzero(near[few])
        i.append(few[at] + start)
        j.append(other)
    i, j, degrees = (np.concatenate(x) for x in (i, j, degrees))
    once = (i < j) | (degrees[j] > TOGETHER)
    return i[once], j[once], degrees


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The work of a task on its sorted ``_filed`` rows: links ``(u, v, null)``, and ``(node, null, k)`` for all in crowds."""

    def links(rows: list[np.ndarray], full: int | None) -> pa.RecordBatch:
        k, nodes, comps, sigs = *rows[:3], np.stack(rows[3:], axis=1).view(np.uint64)
        bounds = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1], [True]]))
        sizes = np.diff(bounds)
        crowd = np.repeat((sizes > BLOCK) | (k[bounds[:-1]] == full if full is not None else False), sizes)
        small = np.flatnonzero(~crowd & np.repeat(sizes <= SMALL, sizes))
        i, j = (small[x] for x in _near_in_small(k[small], sigs[small], comps[small], min(SMALL, sizes.max())))
        crowd |= np.bincount(np.concatenate([i, j]), minlength=len(k)) > TOGETHER
        few = ~(crowd[i] & crowd[j])
        i, j = [i[few]], [j[few]]
        for n in np.flatnonzero((sizes > SMALL) & ~crowd[bounds[:-1]]):
            start, end = bounds[n], bounds[n + 1]
            a, b, degrees = _near_in_large(sigs[start:end], comps[start:end])
            i.append(a + start)
            j.append(b + start)
            crowd[start:end] |= degrees > TOGETHER
        crowded = np.flatnonzero(crowd)
        cuts = np.flatnonzero(np.diff(k[crowded])) + 1
        for group in np.split(crowded, cuts) if len(crowded) else ():
            for start in range(0, len(group), BLOCK):
                own = group[start : start + BLOCK]
                own = own[np.argsort(nodes[own])]  # the same texts begin under many keys, so links are the same
                if pairs := list(_tree(own, sigs[own])):
                    a, b = np.array(pairs, np.int64).T
                    apart = comps[a] != comps[b]
                    i.append(a[apart])
                    j.append(b[apart])
        u, v = nodes[np.concatenate(i)], nodes[np.concatenate(j)]
        columns = [[np.minimum(u, v), nodes[crowded]], [np.maximum(u, v), None], [None, k[crowded]]]
        lengths = [len(u), len(crowded)]
        return pa.RecordBatch.from_arrays([pa.concat_arrays([pa.nulls(n, pa.int64()) if x is None else pa.array(x) for x, n in zip(c, lengths)]) for c in columns], names=["u", "v", "k"])

    held, full = [np.zeros(0, np.int64)] * 5, None
    for batch in batches:
        rows = [np.concatenate([x, batch.column(c).to_numpy(zero_copy_only=False)]) for x, c in zip(held, ("k", "node", "component", "a", "b"))]
        k = rows[0]
        if not len(k):
            continue
        cut, going = int(np.searchsorted(k, k[-1])), None  # the last key may go on in the next batch
        if len(k) - cut > BLOCK:
            cut, going = len(k), k[-1]
        if cut:
            yield links([x[:cut] for x in rows], full)
        held, full = [x[cut:] for x in rows], full if going is None else going
    if len(held[0]):
        yield links(held, full)


def _close(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs ``(u, v)`` whose whole fingerprints differ in ``FAR`` bits at most."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.select(["u", "v"]).filter(pa.array(_differ(_sigs(batch.column("a")), _sigs(batch.column("b"))) <= FAR))

    end = lambda c, sig: nodes.select(F.col("node").alias(c), F.col("sig").alias(sig))
    return pairs.join(end("u", "a"), "u").join(end("v", "b"), "v").select("u", "v", "a", "b").mapInArrow(work, "u bigint, v bigint")


def _across(nodes: np.ndarray, sigs: np.ndarray, comps: np.ndarray, asks: np.ndarray, most: int | None) -> Iterator[tuple[int, int]]:
    """Candidates between the texts that ask and others of different components, the ``most`` best of each that asks."""
    there = np.flatnonzero(~asks)
    nodes_, comps_, sigs_ = nodes[there], comps[there], sigs[there]
    rough = np.ascontiguousarray(sigs_[:, : ROUGH // 64])
    for i in np.flatnonzero(asks):
        at = np.flatnonzero((comps_ != comps[i]) & (_differ(rough, sigs[i, : ROUGH // 64]) <= ROUGH_FAR))
        apart = _differ(sigs_[at], sigs[i])
        at, apart = at[apart <= FAR], apart[apart <= FAR]
        for j in at[np.argsort(apart, kind="stable")[:most]]:
            yield nodes[i], nodes_[j]


def _asker(most: int | None):
    """The work of a task on its sorted ``(k, node, sig, component, asks)`` rows: candidates ``(u, v)``."""

    def links(k: np.ndarray, nodes: np.ndarray, sigs: np.ndarray, comps: np.ndarray, asks: np.ndarray) -> pa.RecordBatch:
        bounds = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1], [True]]))
        pairs = [p for a, b in zip(bounds[:-1], bounds[1:]) for p in _across(nodes[a:b], sigs[a:b], comps[a:b], asks[a:b], most)]
        ends = np.array(pairs, np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(ends.min(axis=1)), pa.array(ends.max(axis=1))], names=["u", "v"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []  # of the last key, which may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            k, node, comp, asks = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("k", "node", "component", "asks"))
            rows = [k, node, _sigs(batch.column("sig")), comp, asks.astype(bool)]
            if held and k[0] == k[-1] == held[0][0][0]:
                held.append(rows)
                continue
            rows = [np.concatenate(x) for x in zip(*held, rows)]
            cut = int(np.searchsorted(rows[0], rows[0][-1]))
            if cut:
                yield links(*(x[:cut] for x in rows))
            held = [[x[cut:] for x in rows]]
        if held:
            yield links(*(np.concatenate(x) for x in zip(*held)))

    return ask


def _verified(pairs: DataFrame, texts: Callable[[DataFrame], DataFrame], shingle: int, similarity: float) -> DataFrame:
    """The pairs ``(u, v)`` whose texts share enough shingles; ``texts`` gives ``(node, text)`` of the nodes in a table."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches):
            sets = [shingles(t, shingle)[2].view(np.int64) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.list_(pa.int64()))], names=["node", "own"])

    ends = pairs.select(F.col("u").alias("node")).unionByName(pairs.select(F.col("v").alias("node"))).distinct()
    with arrow_batches(pairs.sparkSession, BATCH):
        sets, at = materialise(texts(ends).mapInArrow(work, "node bigint, own array<bigint>").dropDuplicates(["node"]), "shingles")
    both = pairs.join(sets.select(F.col("node").alias("u"), F.col("own").alias("a")), "u").join(sets.select(F.col("node").alias("v"), F.col("own").alias("b")), "v")
    common, total = F.size(F.array_intersect("a", "b")), F.size("a") + F.size("b")
    near, _ = materialise(both.filter(common >= similarity * (total - common)).select("u", "v"), "near")
    remove(pairs.sparkSession, at)
    return near


def _parts(n) -> Column:
    """Into how many parts of about ``BLOCK`` texts so many are dealt."""
    return F.greatest(F.lit(1), F.ceil(n / BLOCK)).cast("int")


def _part(n: Column, salt: str | Column) -> Column:
    return F.pmod(F.xxhash64("node", salt), n)


def _in_crowds(filed: DataFrame, named: DataFrame) -> DataFrame:
    """Of the rows of crowded keys those whose keys hold several components: with the component, the largest one, and into how many parts to deal them."""
    own, _ = materialise(filed.join(named, "node", "left").withColumn("component", F.coalesce("component", "node")), "crowd-components")
    sizes = own.groupBy("k", "component").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("k").agg(F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("all"))
    told = largest.filter(F.col("all") > F.col("top.n")).select("k", F.col("top.component").alias("top"), _parts(F.col("all")).alias("parts"), _parts(F.col("all") - F.col("top.n")).alias("askers"))
    return materialise(own.join(told, "k"), "crowd-rows")[0]


def _asked(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Rows for ``_asker`` of ``_in_crowds``: the texts, and once more, as such that ask, those outside a key's largest component.

    Both are dealt into parts, and each part of the askers meets each part of the texts under a key of its own: no task
    holds more than two parts, and who asks nothing is sent once.
    """
    rows, _ = materialise(rows.join(nodes.select("node", "sig"), "node"), "asked-rows")
    p, q = _part(F.col("parts"), F.lit(1)).cast("int"), _part(F.col("askers"), F.lit(2)).cast("int")
    columns = ["node", "sig", "component"]
    texts = rows.select("k", *columns, F.lit(False).alias("asks"), p.alias("p"), F.explode(F.sequence(F.lit(0), F.col("askers") - 1)).alias("q"))
    ask = rows.filter("component <> top").select("k", *columns, F.lit(True).alias("asks"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("p"), q.alias("q"))
    return texts.unionByName(ask).select(F.xxhash64("k", "p", "q").alias("k"), "node", "sig", "component", "asks")


def near_components(nodes: DataFrame, texts: Callable[[DataFrame], DataFrame], shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """``(node, component)`` of the distinct ``nodes`` ``(node, bands, sig)`` that verified links connect; ``texts`` gives ``(node, text)`` of a table's nodes."""
    nodes = nodes.filter(F.col("sig").isNotNull())
    blocks, named, crowds = blocks_for(nodes.count(), BITS_ENOUGH), None, None
    for firsts in ([0], range(FIRST, len(blocks), KEYS_AT_ONCE)):
        known = nodes.withColumn("component", F.col("node")) if named is None else _with_components(nodes, named)
        found = None
        for first in firsts:
            own = _filed(known, blocks[first : first + KEYS_AT_ONCE if first else FIRST], first).repartition("k").sortWithinPartitions("k", F.xxhash64("k", "node"))
            own, _ = materialise(own.mapInArrow(_compared, "u bigint, v bigint, k bigint").distinct(), "links")
            found = own if found is None else found.unionByName(own)
            forget_shuffles(nodes.sparkSession)
        pairs, _ = materialise(_close(found.filter(F.col("v").isNotNull()).select("u", "v").distinct(), nodes), "candidates")
        named = _joined_components(named, _verified(pairs, texts, shingle, similarity))
        crowded = found.filter(F.col("v").isNull()).select("k", F.col("u").alias("node"))
        crowds = crowded if crowds is None else crowds.unionByName(crowded)
    crowded = crowds
    for most in (BEST, None) if not crowded.isEmpty() else ():
        rows = _in_crowds(crowded, named)
        crowded = rows.select("k", "node")  # keys of one component have no more to ask
        dealt = _asked(rows, nodes).repartition("k").sortWithinPartitions("k", "asks", "node")
        pairs, _ = materialise(dealt.mapInArrow(_asker(most), "u bigint, v bigint").distinct(), "candidates")
        if pairs.isEmpty():
            break
        named = _joined_components(named, _verified(pairs, texts, shingle, similarity))
    return named


def _with_components(nodes: DataFrame, named: DataFrame) -> DataFrame:
    """The nodes with their components' names, which are their own where nothing is linked to them."""
    return materialise(nodes.join(named, "node", "left").withColumn("component", F.coalesce("component", "node")), "nodes")[0]


def _joined_components(named: DataFrame | None, near: DataFrame) -> DataFrame:
    """Components after more links: of the links' ends, by the names that they have, and the names carried on to all that had them."""
    if named is None:
        return materialise(components(near), "components")[0]
    end = lambda c: named.select(F.col("node").alias(c), F.col("component").alias(f"to_{c}"))
    ends = near.join(end("u"), "u", "left").join(end("v"), "v", "left").select(F.coalesce("to_u", "u").alias("u"), F.coalesce("to_v", "v").alias("v"))
    more, _ = materialise(components(ends), "components")
    carried = named.join(more.select(F.col("node").alias("component"), F.col("component").alias("to")), "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    new = more.join(named.select("node"), "node", "left_anti")
    return materialise(carried.unionByName(new.select("node", "component")), "components")[0]


def _nodes(rows: DataFrame) -> DataFrame:
    """One row a node, with its first row. Where two texts have one name, their second names tell them apart."""
    twice = rows.groupBy("node").agg(F.min("second").alias("a"), F.max("second").alias("b")).filter("a <> b").select("node", F.lit(True).alias("twice"))
    own = rows.join(twice, "node", "left").withColumn("node", F.when(F.col("twice"), F.xxhash64("node", "second")).otherwise(F.col("node")))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k1", "k2")).alias("first")
    return own.groupBy("node").agg(first, F.first("bands").alias("bands"), F.first("sig").alias("sig"))


def keep_one_of_each(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, most_sent: int = MOST_SENT) -> DataFrame:
    """``docs`` with one row of each group of near copies: the one with the least id (a null one only where all are null).

    Near copies share ``similarity`` or more of their word shingles (Jaccard, each shingle once), a text of fewer words than a
    shingle is one shingle; a group is what such pairs connect. Texts of the same words are one throughout, and so are all
    texts without any. Rows of one id with different texts are rows of their own; of repeated rows one stays. Rows are known
    by two hashes of id and text, on which they are shuffled once; up to ``most_sent`` texts are verified without shuffling the others. Columns may have any names.
    """
    k1, k2 = free(docs, "k1", "k2")
    key = row_key(docs)
    keyed = docs.withColumn(k1, key[0]).withColumn(k2, key[1])
    own = docs.select(docs["doc_id"], key[0].alias("k1"), key[1].alias("k2"), text_of(docs).alias("text"))
    with arrow_batches(docs.sparkSession, BATCH):
        rows, at_rows = materialise(signatures(own, shingle, keep=("doc_id", "k1", "k2")), "signatures")
    nodes, _ = materialise(_nodes(rows), "nodes")
    remove(docs.sparkSession, at_rows)

    def texts(wanted: DataFrame) -> DataFrame:
        named, _ = materialise(nodes.join(wanted, "node", "left_semi").select("node", "first.k1", "first.k2"), "wanted")
        rows = own.select("k1", "k2", "text")
        if named.count() <= most_sent:  # texts that nobody wants are not shuffled
            rows = rows.join(F.broadcast(named.select("k1").distinct()), "k1", "left_semi")
        return rows.join(named, ["k1", "k2"]).select("node", "text")

    linked = near_components(nodes.select("node", "bands", "sig"), texts, shingle, similarity)
    named = nodes.select("node", "first").join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    kept = named.groupBy("component").agg(F.min("first").alias("first")).select(F.col("first.k1").alias(k1), F.col("first.k2").alias(k2))
    return keyed.join(kept, [k1, k2], "left_semi").dropDuplicates([k1, k2]).select(*[keyed[f"`{c}`"] for c in docs.columns])
