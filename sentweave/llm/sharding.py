"""Sharding by a k-d tree over document metadata, balanced in bytes.

A node that holds k shards is split at the byte-weighted point floor(k/2)/k of its widest metadata dimension, until
each leaf is one shard of the target bytes. Dimensions are numbers worked out from the text, so that equal texts have equal
coordinates. Every split point is found exactly, level by level for all nodes together: bytes are summed in at most
1,024 bins of a node, the bin with the point is picked and refined, and one row a node reaches the driver. What holds for a
node (its dimension, its point) is joined to the rows as a small table, so that plans don't grow with the tree. The order within a
dimension goes on through a hash of the text, a hash of the row and its number, so ties and repeated rows never leave a split without a point; a cut
stays at the edge of a group of equal texts if the group is small beside a shard, and passes through it only if it is large.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sentweave.llm.common import materialise, remove, text_of

BINS_BITS = 10
#: Part of a shard's bytes that a cut may be off in order to keep equal texts together.
TOLERANCE = 0.01
#: Rows that get their slots in one task, about.
SLOT_ROWS = 4096
DIMENSIONS = ("size", "lines", "plain")


def _metadata(docs: DataFrame, text: str) -> dict:
    """Dimensions as non-negative 31-bit numbers: bytes, lines, and ASCII share in parts of a million."""
    t = text_of(docs, text)
    size = F.octet_length(t)
    ascii_share = F.when(size == 0, 1.0).otherwise((2 * F.char_length(t) - size) / size)
    lines = F.char_length(t) - F.char_length(F.replace(t, F.lit("\n"), F.lit("")))
    return {"size": size.cast("long"), "lines": lines.cast("long"), "plain": F.greatest(F.lit(0.0), ascii_share * 1e6).cast("long")}


def _nodes(spark, rows: list[tuple], schema: str) -> DataFrame:
    """A small table of the tree's nodes (at most as many as there are shards), for a broadcast."""
    return F.broadcast(spark.createDataFrame(rows, schema))


def _cut(rows: DataFrame, weights: dict[int, float], slack: float) -> dict[int, tuple[int, int, int]]:
    """For each node, the first (value, text hash, row hash) of its right side; ``weights``: bytes wanted on the left.

    ``rows``: node, size, and the order ``a`` (value, 31 bits), ``b`` (text hash, 63 bits), ``c`` (row hash, 63 bits). All
    nodes go on together: a round sums the bytes of a node's bins and picks the bin with the point, as one row a node.
    """
    spark = rows.sparkSession
    prefix = {n: (0, 0) for n in weights}  # the bits fixed so far of the 31 + 63 + 63, as a number, and how many
    before = dict.fromkeys(weights, 0.0)
    done: dict[int, tuple[int, int, int]] = {}
    columns = [("a", 31), ("b", 63), ("c", 63)]
    in_order = Window.partitionBy("node").orderBy("bin")
    for name, width in columns:
        fixed = 0
        while fixed < width and len(done) < len(weights):
            bits = min(BINS_BITS, width - fixed)
            open_ = [n for n in weights if n not in done]
            parts = {n: _parts(prefix[n], columns) for n in open_}
            have = [v[1] for v in parts[open_[0]]]  # the same for all open nodes
            nodes = _nodes(spark, [(n, weights[n], before[n], *(v[0] for v in parts[n])) for n in open_], "node bigint, wanted double, before double, pa bigint, pb bigint, pc bigint")
            same = [F.shiftright(F.col(c), w - h) == F.col(f"p{c}") for (c, w), h in zip(columns, have) if h]
            within = rows.join(nodes, "node")
            for condition in same:
                within = within.filter(condition)
            bin_ = F.shiftright(F.col(name), width - fixed - bits).bitwiseAND(F.lit((1 << bits) - 1))
            sums = within.groupBy("node", "wanted", "before", bin_.alias("bin")).agg(F.sum("size").cast("double").alias("bytes"), F.count(F.lit(1)).alias("n"))
            running = sums.withColumn("high", F.col("before") + F.sum("bytes").over(in_order))
            # the last bin that starts at or below the point
            picked = running.withColumn("low", F.col("high") - F.col("bytes")).filter((F.col("low") <= F.col("wanted")) | (F.col("low") <= F.col("before")))
            found = {r["node"]: r["x"] for r in picked.groupBy("node").agg(F.max(F.struct("bin", "low", "high", "n")).alias("x")).collect()}
            for n in open_:
                x = found.get(n)
                if x is None:
                    done[n] = _edge(prefix[n], 0, 0, columns)
                    continue
                low, high = abs(x["low"] - weights[n]), abs(x["high"] - weights[n])
                last = x["n"] == 1 or (fixed + bits == width and name == "c")
                if min(low, high) <= slack or last:
                    done[n] = _edge(prefix[n], bits, int(x["bin"]) + int(high < low), columns)
                else:
                    before[n] = x["low"]
                    prefix[n] = ((prefix[n][0] << bits) | x["bin"], prefix[n][1] + bits)
            fixed += bits
    return done


def _parts(prefix: tuple[int, int], columns: list[tuple[str, int]]) -> list[tuple[int, int]]:
    """A prefix as (value, bits) for each column."""
    value, bits = prefix
    out = []
    total = 0
    for _, w in columns:
        have = min(max(bits - total, 0), w)
        rest = max(bits - total - have, 0)
        out.append(((value >> rest) & ((1 << have) - 1), have))
        total += w
    return out


def _edge(prefix: tuple[int, int], bits: int, bin_: int, columns: list[tuple[str, int]]) -> tuple[int, int, int]:
    """The least order number at or above a bin's edge, as a number for each column."""
    total = sum(w for _, w in columns)
    number = ((prefix[0] << bits) + bin_) << (total - prefix[1] - bits)
    out = []
    for _, w in reversed(columns):
        out.append(number & ((1 << w) - 1))
        number >>= w
    if number:  # beyond the last number: everything is on the left
        return tuple((1 << w) - 1 for _, w in columns)
    return tuple(reversed(out))


def kd_shards(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row for each document: id, ``size`` (bytes of the text and 1), ``text_crc32``, ``shard`` and ``slot``.

    Give the number of shards or the target bytes of one. A null text is empty (size 1, crc32 0); null ids and repeated
    rows are rows of their own; an empty table gives an empty result; other columns never enter. Slots of a shard run from
    0 without gaps, in the order of a hash.
    """
    t = text_of(docs, text)
    meta = _metadata(docs, text)
    rows = docs.select(docs[id_col].alias("doc_id"), (F.octet_length(t) + 1).cast("long").alias("size"), F.crc32(t).alias("text_crc32"), F.xxhash64(t).bitwiseAND(F.lit((1 << 63) - 1)).alias("b"), *[meta[d].alias(f"d_{d}") for d in DIMENSIONS])
    # 31 bits of the row's hash, then 32 of its number, so that a cut can pass between repeated rows; both are written once
    number = F.xxhash64(F.monotonically_increasing_id()).bitwiseAND(F.lit((1 << 32) - 1))
    rows = rows.withColumn("c", F.shiftleft(F.xxhash64("doc_id", "b").bitwiseAND(F.lit((1 << 31) - 1)), 32).bitwiseOR(number))
    spark = docs.sparkSession
    now, path = materialise(rows.withColumn("node", F.lit(0).cast("bigint")), "shard-rows")
    total, n_rows = now.agg(F.sum("size"), F.count(F.lit(1))).first()
    if shards is None:
        shards = max(1, -(-(total or 0) // target_bytes))
    slack = TOLERANCE * (total or 0) / shards
    tree = {0: (0, shards)}  # node: first shard and number of shards
    while any(k > 1 for _, k in tree.values()) and n_rows:
        split = _nodes(spark, [(n,) for n, (_, k) in tree.items() if k > 1], "node bigint")
        spread = now.join(split, "node").groupBy("node").agg(F.sum("size").alias("bytes"), *[(F.stddev_pop(F.log1p(f"d_{d}")) / F.greatest(F.lit(1e-9), F.max(F.log1p(f"d_{d}")))).alias(d) for d in DIMENSIONS]).collect()
        widest = {r["node"]: max(range(len(DIMENSIONS)), key=lambda i: r[DIMENSIONS[i]] or 0.0) for r in spread}
        bytes_ = {r["node"]: float(r["bytes"]) for r in spread}
        values = F.array(*[F.col(f"d_{d}") for d in DIMENSIONS])
        along = _nodes(spark, list(widest.items()), "node bigint, dimension int")
        ordered = now.join(along, "node", "left").withColumn("a", F.coalesce(F.least(F.get(values, F.col("dimension")), F.lit((1 << 31) - 1)), F.lit(0)).cast("bigint")).drop("dimension")
        cuts = _cut(ordered, {n: bytes_[n] * (tree[n][1] // 2) / tree[n][1] for n in widest}, slack)
        points = _nodes(spark, [(n, *x) for n, x in cuts.items()], "node bigint, ca bigint, cb bigint, cc bigint")
        right = (F.col("a") > F.col("ca")) | ((F.col("a") == F.col("ca")) & ((F.col("b") > F.col("cb")) | ((F.col("b") == F.col("cb")) & (F.col("c") >= F.col("cc")))))
        node = F.col("node") * 2 + 1 + F.coalesce(right, F.lit(False)).cast("int")  # a leaf keeps to the left
        after = {}
        for n, (first, k) in tree.items():
            left = k // 2 if n in cuts else min(k, 1)  # a node without rows has no more to split
            after[2 * n + 1] = (first, left)
            if n in cuts:
                after[2 * n + 2] = (first + left, k - left)
        level, new_path = materialise(ordered.join(points, "node", "left").withColumn("node", node).drop("a", "ca", "cb", "cc"), "shard-level")
        remove(spark, path)
        now, path, tree = level, new_path, after
    leaves = _nodes(spark, [(n, first) for n, (first, _) in tree.items()], "node bigint, shard int")
    return _slots(now.join(leaves, "node"), n_rows)


def _slots(rows: DataFrame, n_rows: int) -> DataFrame:
    """Numbers from 0 within each shard: rows are dealt into small bins by hash; a bin's first slot is the sum of those before."""
    bins = max(1, n_rows // SLOT_ROWS)
    rows = rows.withColumn("bin", F.pmod(F.xxhash64("c", "b"), F.lit(bins)))
    sizes = rows.groupBy("shard", "bin").agg(F.count(F.lit(1)).alias("n"))
    first = F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("shard", "bin", first.alias("first"))
    place = F.row_number().over(Window.partitionBy("shard", "bin").orderBy("c", "b")) - 1
    numbered = rows.withColumn("place", place).join(starts, ["shard", "bin"])
    return numbered.select("doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("place")).alias("slot"))
