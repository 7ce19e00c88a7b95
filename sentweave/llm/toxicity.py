"""Toxicity by class-conditional Kneser-Ney models.

Each class has a bigram model. A word after another has its absolutely discounted count, the number of distinct labelled
texts of the class that hold the pair; the discounted mass goes to the word's continuation probability: the discounted
number of distinct words that it follows in the class. What is discounted there goes to continuation counts that both
classes share, so that a rare expression scores nearly alike in both. The discounts take all of what a single word pair
or a single text says (``WORD_DISCOUNTS``, ``PAIR_DISCOUNT``): only repeated evidence sets the classes apart.

The log-likelihood ratio of a word then comes from three tables: of its pair where that is known well enough, or else of
the word and of the word before it. They are gathered over every labelled training row, keyed by 48-bit hashes of the
words (of ten million words, one pair or none meets) and as large as the corpus makes them; nothing is put in buckets. They are broadcast up to
``BROADCAST_KEYS`` keys; beyond, without the words that can't matter to the texts at hand; beyond that, the words of the texts are joined to them by a shuffle.

A text's evidence is the sum of its words' ratios beyond ``MARGIN``, over the square root of its length. A logistic
curve in this one number, never falling, gives the score; it is fitted on at most ``MAX_FITTED`` training rows (drawn by a hash
of the id) with the evidence of models that haven't seen their third of the texts.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentweave.llm import bpe
from sentweave.llm.common import forget_shuffles, free, materialise, remove, row_key, text_of, without

#: Discounts of continuation counts of 1, 2, and 3 or more; discount of the texts that hold a pair; least ratio that counts.
WORD_DISCOUNTS, PAIR_DISCOUNT, MARGIN = (1.0, 1.5, 2.0), 3, 2.0
#: Words of no greater ratio count only after contexts that make up for what they lack.
QUIET = 1.0
#: Rows that the curve is fitted on, at most; the counts have no bound.
MAX_FITTED = 50_000
#: Labels are broadcast up to so many rows, the tables of ratios up to so many keys; beyond, they are joined by a shuffle.
BROADCAST_LABELS, BROADCAST_KEYS = 2_000_000, 3_000_000
#: Parts of the texts that the curve's models leave out in turn; variant 0 of a model leaves none out.
PARTS = 3
#: Pairs that a task counts before it hands them on, characters that a worker scores at once.
_FLUSH, _AT_ONCE = 1_000_000, 1_000_000
#: Buckets of word pairs in a shuffle partition.
BUNDLES = 8
#: Hashes of words that a worker remembers.
_CACHED = 50_000
_WORDS = re.compile(r"[^\W_]+").findall
_COUNTS = [f"c{toxic}{part}" for toxic in (0, 1) for part in range(PARTS)]


def held_out(id_col: Column | str = "doc_id") -> Column:
    """True for the rows whose labels are never learnt from."""
    found = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.pmod(F.crc32(found.cast("string")), F.lit(4)) == 2, F.lit(False))


def _hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word) >> 16


def _pair(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """One key for a pair of word hashes."""
    with np.errstate(over="ignore"):
        mixed = before.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((mixed ^ (mixed >> np.uint64(29))) + word.view(np.uint64)).view(np.int64)


def _hashed(texts: list[str], hashes: bpe.Cache) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, of the words before them (0 at a text's start), and how many words each text has."""
    words = [_WORDS(t.lower()) for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    h = np.fromiter((hashes[w] for own in words for w in own), np.int64, int(sizes.sum()))
    before = np.concatenate([[0], h[:-1]]) if len(h) else h
    before[(np.cumsum(sizes) - sizes)[sizes > 0]] = 0
    return before, h, sizes


def pair_counts(rows: DataFrame) -> DataFrame:
    """``(v, w, c00 …)`` of ``(text, toxic, part)`` rows: for each word pair, the texts that hold it by class and part.

    A task counts its pairs before they move, and moves them by the bundle: a row for each of many buckets of pairs, with their words in
    twelve bytes each (``a``: the first and 16 bits of the second, ``b``: the rest) and their class, part and count (``c``). A
    bucket's bundles come together sorted by bucket, so that one bucket at a time is added up.
    """
    buckets = BUNDLES * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def summed(parts: list[np.ndarray]) -> list[np.ndarray]:
        """Distinct (a, b, column) and their counts, from such with counts."""
        a, b, column, n = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((column, b, a))
        a, b, column, n = (x[order] for x in (a, b, column, n))
        first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (column[1:] != column[:-1])]))
        return [a[first], b[first], column[first], np.add.reduceat(n, first)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held, n = bpe.Cache(_hash, most=_CACHED), [], 0

        def bundled() -> pa.RecordBatch:
            a, b, column, times = summed(held)
            bucket = (_pair(a, b).view(np.uint64) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            names, first = np.unique(bucket[order], return_index=True)
            cut = lambda x, kind: [part.tobytes() for part in np.split(x[order].astype(kind), first[1:])]
            kinds = [pa.binary()] * 3
            return pa.RecordBatch.from_arrays([pa.array(names), *[pa.array(x, k) for x, k in zip((cut(a, np.int64), cut(b, np.uint32), cut(column + 8 * times, np.int32)), kinds)]], names=["bucket", "a", "b", "c"])

        for batch in batches:
            for text, toxic, part in zip(*(c.to_pylist() for c in batch.columns)):
                v, w, _ = _hashed([text], hashes)
                if len(w):
                    _, one = np.unique(_pair(v, w), return_index=True)
                    v, w = v[one], w[one]
                    held.append(((v << 16) | (w >> 32), w & 0xFFFFFFFF, np.full(len(one), toxic * PARTS + part), np.ones(len(one), np.int64)))
                    n += len(one)
                if n > _FLUSH:
                    yield bundled()
                    held, n = [], 0
        if held:
            yield bundled()

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []

        def counted() -> pa.RecordBatch:
            a, b, column, times = summed(held)
            first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
            counts = np.zeros((len(first), len(_COUNTS)), np.int64)
            counts[np.repeat(np.arange(len(first)), np.diff(np.concatenate([first, [len(a)]]))), column] = times
            a, b = a[first].view(np.uint64), b[first]
            words = [(a >> np.uint64(16)).view(np.int64), ((a & np.uint64(0xFFFF)) << np.uint64(32)).view(np.int64) | b]
            return pa.RecordBatch.from_arrays([*map(pa.array, words), *[pa.array(x.astype(np.int32)) for x in counts.T]], names=["v", "w", *_COUNTS])

        for batch in batches:
            for name, a, b, c in zip(*(x.to_pylist() for x in batch.columns)):
                if name != bucket and held:
                    yield counted()
                    held = []
                code = np.frombuffer(c, np.int32).astype(np.int64)
                held.append((np.frombuffer(a, np.int64), np.frombuffer(b, np.uint32).astype(np.int64), code % 8, code // 8))
                bucket = name
        if held:
            yield counted()

    bundles = rows.select("text", "toxic", "part").mapInArrow(count, "bucket bigint, a binary, b binary, c binary")
    return bundles.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(add_up, "v bigint, w bigint, " + ", ".join(f"{c} int" for c in _COUNTS))


@dataclass
class Ratios:
    """Log-likelihood ratios, toxic against ordinary: an array for each key, by variant (0, and 1 + the part left out)."""

    words: DataFrame  # w, l
    contexts: DataFrame  # v, l
    pairs: DataFrame  # v, w, l
    unknown: list[float]  # of words that are in no table
    paths: list[str]  # where the tables lie

    def keys(self) -> int:
        return sum(t.count() for t in (self.words, self.contexts, self.pairs))


def _discounted(n: Column) -> Column:
    """What is taken off a continuation count."""
    one, two, more = WORD_DISCOUNTS
    return F.when(n == 0, 0.0).when(n == 1, one).when(n == 2, two).otherwise(more)


def _counts(ratio: Column) -> Column:
    """True for a ratio that adds to a text's evidence."""
    return ratio > MARGIN


def ratios(pairs: DataFrame) -> Ratios:
    """The tables of ratios from :func:`pair_counts`; keys that all models treat alike are left out of them.

    So are keys that can't add to any text's evidence: pairs whose ratio stays within the margin and would do so without them, and words that
    stay within it after every context. The evidence is the same to the bit, and the tables grow with what is toxic, not with the corpus.
    """
    variants = range(PARTS + 1)
    in_class = {(y, k): sum((F.col(f"c{y}{p}") for p in range(PARTS) if p != k - 1), F.lit(0)) for y in (0, 1) for k in variants}
    columns = [f"{y}{k}" for y in (0, 1) for k in variants]
    counted = pairs.select("v", "w", *[c.cast("bigint").alias(f"c{y}{k}") for (y, k), c in in_class.items()])
    seen = lambda k: (F.col(f"c0{k}") + F.col(f"c1{k}") > 0).cast("bigint")
    words = counted.groupBy("w").agg(*[F.sum((F.col(f"c{x}") > 0).cast("bigint")).alias(f"n{x}") for x in columns], *[F.sum(seen(k)).alias(f"s{k}") for k in variants])
    words, at_words = materialise(words, "toxic-words")
    sums = [F.sum(f"n{x}").alias(f"n{x}") for x in columns] + [F.sum(_discounted(F.col(f"n{x}"))).alias(f"d{x}") for x in columns] + [F.sum(f"s{k}").alias(f"s{k}") for k in variants] + [F.count_if(F.col(f"s{k}") > 0).alias(f"k{k}") for k in variants]
    total = {name: float(value or 0) for name, value in words.agg(*sums).first().asDict().items()}
    left = {x: max(total[f"d{x}"] / total[f"n{x}"], 1e-6) if total[f"n{x}"] else 1.0 for x in columns}

    def word(y: int, k: int) -> Column:
        x = f"{y}{k}"
        shared = (F.col(f"s{k}") + 0.5) / (total[f"s{k}"] + 0.5 * (total[f"k{k}"] + 1))
        return (F.col(f"n{x}") - _discounted(F.col(f"n{x}"))) / max(total[f"n{x}"], 1.0) + left[x] * shared

    all_ = lambda f: F.array(*[f(k) for k in variants])
    probable = words.select("w", *[word(y, k).alias(f"p{y}{k}") for y in (0, 1) for k in variants], F.greatest(*[F.col(f"n{y}0") for y in (0, 1)]).alias("most"))
    of_word = all_(lambda k: F.log(F.col(f"p1{k}") / F.col(f"p0{k}")))
    told = probable.filter("most > 1").select("w", of_word.alias("l"))
    unknown = [float(np.log(left[f"1{k}"] / left[f"0{k}"])) for k in variants]

    often, at_often = materialise(counted.filter(F.greatest("c00", "c10") > PAIR_DISCOUNT), "toxic-often")
    opened = often.select("v").distinct()
    opened = F.broadcast(opened) if opened.count() <= BROADCAST_KEYS else opened
    kept = lambda x: F.least(F.col(f"c{x}"), F.lit(PAIR_DISCOUNT))
    # a context without any such pair hands all of its mass on in both classes and says nothing
    contexts = counted.join(opened, "v", "left_semi").groupBy("v").agg(*[F.sum(f"c{x}").alias(f"n{x}") for x in columns], *[F.sum(kept(x)).alias(f"r{x}") for x in columns])
    contexts, at_contexts = materialise(contexts, "toxic-contexts")
    handed_on = lambda x: (F.col(f"r{x}") + 1) / (F.col(f"n{x}") + 1)
    of_context = all_(lambda k: F.log(handed_on(f"1{k}") / handed_on(f"0{k}")))
    handed = contexts.select("v", of_context.alias("l"))
    met = often.join(contexts, "v").join(probable, "w")
    both = lambda x: (F.col(f"c{x}") - kept(x) + (F.col(f"r{x}") + 1) * F.col(f"p{x}")) / (F.col(f"n{x}") + 1)
    backed_off = F.zip_with(F.when(F.col("most") > 1, of_word).otherwise(F.array(*map(F.lit, unknown))), of_context, lambda a, b: a + b)
    said = met.select("v", "w", all_(lambda k: F.log(both(f"1{k}") / both(f"0{k}"))).alias("l"), backed_off.alias("apart"))
    paired, at_pairs = materialise(said.filter(F.exists("l", _counts) | F.exists("apart", _counts)).select("v", "w", "l"), "toxic-ratios")
    loudest = handed.agg(*[F.max(F.get("l", F.lit(k))) for k in variants]).first()
    most = [max(0.0, x or 0.0) for x in loudest]
    if all(u + m <= MARGIN for u, m in zip(unknown, most)):
        told = told.filter(F.exists(F.zip_with("l", F.array(*map(F.lit, most)), lambda a, b: a + b), _counts))
    remove(pairs.sparkSession, at_often)
    return Ratios(told, handed, paired, unknown, [at_words, at_contexts, at_pairs])


class Lookup:
    """The tables of ratios of some variants as sorted arrays, for a Python worker."""

    def __init__(self, found: Ratios, variants: int):
        self.unknown, self.variants = np.array(found.unknown[:variants]), variants
        self.words = self._sorted(found.words, "w")
        self.contexts = self._sorted(found.contexts, "v")
        self.pairs = self._sorted(found.pairs, "v", "w")

    def _sorted(self, table: DataFrame, *keys: str) -> tuple[np.ndarray, np.ndarray]:
        got = table.select(*keys, F.slice("l", 1, self.variants).alias("l")).toArrow()
        own = [got.column(k).to_numpy() for k in keys]
        key = own[0] if len(own) == 1 else _pair(*own)
        order = np.argsort(key)
        values = got.column("l").combine_chunks().flatten().to_numpy().reshape(-1, self.variants)
        return key[order], values[order]

    @staticmethod
    def _at(table: tuple[np.ndarray, np.ndarray], key: np.ndarray, variant: np.ndarray, default) -> np.ndarray:
        keys, values = table
        if not len(keys):
            return np.broadcast_to(default, key.shape)
        place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return np.where(keys[place] == key, values[place, variant], default)

    def evidence(self, before: np.ndarray, words: np.ndarray, sizes: np.ndarray, variant: np.ndarray) -> np.ndarray:
        """The evidence of each text."""
        of_word = np.repeat(variant, sizes)
        apart = self._at(self.words, words, of_word, self.unknown[of_word]) + self._at(self.contexts, before, of_word, 0.0)
        found = self._at(self.pairs, _pair(before, words), of_word, apart)
        over = np.concatenate([[0.0], np.cumsum(np.maximum(found - MARGIN, 0.0))])
        ends = np.cumsum(sizes)
        return (over[ends] - over[ends - sizes]) / np.sqrt(np.maximum(sizes, 1))


class Curve:
    """A logistic curve in the evidence that never falls, by Newton steps with a ridge."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0):
        self.scale = float(x.std()) + 1e-9 if len(x) else 1.0
        share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
        self.base, self.slope = float(np.log(share / (1 - share))), 0.0
        z = np.stack([np.ones(len(x)), self._z(x)], axis=1)
        for _ in range(50 if len(x) else 0):
            p = 1 / (1 + np.exp(-np.clip(z @ [self.base, self.slope], -35, 35)))
            slope = z.T @ (p - y) + [0.0, ridge * self.slope]
            self.base, self.slope = np.array([self.base, self.slope]) - np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + ridge * np.eye(2), slope)
        self.slope = max(self.slope, 0.0)

    def _z(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(x / self.scale)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.base + self.slope * self._z(x), -35, 35)))


def _needed(rows: DataFrame, found: Ratios, text: Column) -> Ratios:
    """The tables without words whose ratios can't matter to these texts.

    A ratio of at most ``QUIET`` adds to the evidence only after a context that takes it beyond the margin. So of such words
    only those stay that follow such a context somewhere in the texts; the evidence is the same to the bit.
    """
    if max(found.unknown) > QUIET:
        return found
    spark = rows.sparkSession
    opening = found.contexts.filter(F.exists("l", lambda x: x > MARGIN - QUIET)).select("v").toArrow().column("v").to_numpy()
    sent = spark.sparkContext.broadcast(np.sort(opening))

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = bpe.Cache(_hash, most=_CACHED)
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                v, w, _ = _hashed(batch.column(0).slice(i, 500).to_pylist(), hashes)
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(w[np.isin(v, sent.value)]))], names=["w"])

    after, at = materialise(rows.select(text.alias("text")).mapInArrow(follow, "w bigint").distinct(), "toxic-needed")
    sent.destroy()
    loud = F.exists("l", lambda x: x > QUIET)
    words, at_words = materialise(found.words.join(after.withColumn("met", F.lit(True)), "w", "left").filter(loud | F.col("met")).select("w", "l"), "toxic-heard")
    remove(spark, at)
    return replace(found, words=words, paths=[*found.paths, at_words])


def _with_evidence(rows: DataFrame, found: Ratios, text: Column, variant: Column, name: str, key: list[Column], most_keys: int, variants: int = 1) -> DataFrame:
    """``rows`` and their evidence as column ``name``: by a broadcast of the tables (of the first ``variants``), or by joining the words to them."""
    context = rows.sparkSession.sparkContext
    if found.keys() > most_keys:
        found = _needed(rows, found, text)
    if found.keys() <= most_keys:
        sent = context.broadcast(Lookup(found, variants))

        def judge(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            hashes = bpe.Cache(_hash, most=_CACHED)
            for texts, variants in batches:
                own, kinds, out, i = texts.to_pylist(), variants.to_numpy(zero_copy_only=False), [np.zeros(0)], 0
                while i < len(own):
                    j, size = i, 0
                    while j < len(own) and (j == i or size + len(own[j]) <= _AT_ONCE):
                        size += len(own[j])
                        j += 1
                    out.append(sent.value.evidence(*_hashed(own[i:j], hashes), kinds[i:j]))
                    i = j
                yield pa.array(np.concatenate(out))

        judge.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
        return rows.withColumn(name, F.arrow_udf(judge, "double")(text, variant.cast("int")))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = bpe.Cache(_hash, most=_CACHED)
        for batch in batches:
            for k1, k2, k, t in zip(*(c.to_pylist() for c in batch.columns)):
                v, w, _ = _hashed([t], hashes)
                _, first, n = np.unique(_pair(v, w), return_index=True, return_counts=True)
                same = [pa.array(np.full(len(n), x)) for x in (k1, k2, k, len(w))]
                yield pa.RecordBatch.from_arrays([*same, pa.array(v[first]), pa.array(w[first]), pa.array(n)], names=["k1", "k2", "variant", "size", "v", "w", "n"])

    k1, k2 = free(rows, "k1", "k2")
    keyed = rows.withColumn(k1, key[0]).withColumn(k2, key[1])
    own = keyed.select(F.col(k1).alias("k1"), F.col(k2).alias("k2"), variant.cast("bigint").alias("variant"), text.alias("text")).dropDuplicates(["k1", "k2"])
    words = own.mapInArrow(spread, "k1 bigint, k2 bigint, variant bigint, size bigint, v bigint, w bigint, n bigint")
    named = lambda t, c: t.withColumnRenamed("l", c)
    met = words.join(named(found.words, "lw"), "w", "left").join(named(found.contexts, "lv"), "v", "left").join(named(found.pairs, "lp"), ["v", "w"], "left")
    at = lambda c: F.get(c, F.col("variant").cast("int"))
    ratio = F.coalesce(at("lp"), F.coalesce(at("lw"), at(F.array(*map(F.lit, found.unknown)))) + F.coalesce(at("lv"), F.lit(0.0)))
    sums = met.groupBy("k1", "k2").agg((F.sum(F.col("n") * F.greatest(ratio - MARGIN, F.lit(0.0))) / F.sqrt(F.first("size"))).alias(name))
    sums = sums.select(F.col("k1").alias(k1), F.col("k2").alias(k2), name)
    return keyed.join(sums, [k1, k2], "left").withColumn(name, F.coalesce(name, F.lit(0.0))).drop(k1, k2)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", most_keys: int = BROADCAST_KEYS) -> tuple[Ratios, Curve]:
    """The ratios and the curve, from labelled rows that aren't held out.

    Each distinct text counts once a class, whatever its copies; contradicting labels of a text count in either class.
    """
    marks = labels.filter(F.col("toxic").isin(0, 1)).select(F.col(id_col).alias("id"), F.col("toxic").cast("int").alias("toxic"))
    marks = marks.filter(F.col("id").isNotNull() & ~held_out("id"))
    n_marks = marks.count()
    marks = F.broadcast(marks) if n_marks <= BROADCAST_LABELS else marks
    t = text_of(docs, text)
    own = docs.select(docs[f"`{id_col}`"].alias("id"), t.alias("text"), F.xxhash64(t).alias("t")).join(marks, "id").withColumn("part", F.pmod("t", F.lit(PARTS)).cast("int"))
    first = own.groupBy("t", "toxic").agg(F.min("id").alias("id"))
    first = F.broadcast(first) if n_marks <= BROADCAST_LABELS else first
    once = own.join(first, ["t", "toxic", "id"], "left_semi").select("text", "toxic", "part")
    counts, at_counts = materialise(pair_counts(once), "toxic-pairs")
    forget_shuffles(docs.sparkSession)
    found = ratios(counts)
    remove(docs.sparkSession, at_counts)
    forget_shuffles(docs.sparkSession)
    some = own.filter(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < 1_000_000 * MAX_FITTED // max(n_marks, MAX_FITTED)).select("id", "text", "toxic", "part")
    got = _with_evidence(some, found, F.col("text"), F.col("part") + 1, "x", row_key(some, "id"), most_keys, PARTS + 1).select("toxic", "x").toArrow()
    return found, Curve(got.column("x").to_numpy(), got.column("toxic").to_numpy().astype(float))


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text: str = "text", keep: tuple[str, ...] | None = None, most_keys: int = BROADCAST_KEYS) -> DataFrame:
    """Columns ``keep`` (all but the text), ``held_out``, ``score`` (0 to 1) and ``predicted`` for each row.

    Null and empty texts have no word and score what the curve gives no evidence; null ids are not held out; without
    any labelled row every score is that of no evidence; repeated rows score alike; an empty table gives an empty result;
    other columns pass through, but for those of the names above.
    """
    found, curve = train(docs, labels, id_col, text, most_keys)
    (evidence,) = free(docs, "evidence")
    judged = _with_evidence(docs, found, text_of(docs, text), F.lit(0), evidence, row_key(docs, id_col, text), most_keys)
    own = [judged[f"`{c}`"] for c in keep] if keep is not None else without(judged, text, evidence, "held_out", "score", "predicted")
    z = F.lit(curve.base) + curve.slope * F.sqrt(F.col(evidence) / curve.scale)
    chance = 1 / (1 + F.exp(-F.greatest(F.lit(-35.0), F.least(F.lit(35.0), z))))
    return judged.select(*own, held_out(judged[f"`{id_col}`"]).alias("held_out"), chance.alias("score"), (chance >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``docs`` without the rows that are predicted toxic; all columns pass through."""
    rows = docs.select(F.struct(*without(docs)).alias("row"), docs["doc_id"], docs["text"])
    return score(rows, labels, threshold, keep=("row",)).filter(F.col("predicted") == 0).select("row.*")
