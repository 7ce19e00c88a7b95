import hashlib
from collections import Counter, defaultdict
from itertools import combinations

import corpus_pipeline
import numpy as np
import pytest
import xxhash
from tests.llm.conftest import odd_texts, sentence
from pyspark.sql import functions as F
from sentweave.llm import components, line_dedup, quality, simhash, wide_fingerprints

BLANKS = " \t\n\x0b\x0c\r"


def key(line: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def brute_lines(texts, least):
    docs = [(t or "").split("\n") for t in texts]
    seen = Counter(k for lines in docs for k in {key(x) for x in lines})
    return ["\n".join(x for x in lines if not (key(x) and seen[key(x)] >= least)) for lines in docs]


def test_line_dedup_is_brute_force(odd):
    rows = odd.collect()
    for fanout, batches, most in ((2, 4, 1000), (3, 7, 0), (10, 1, 1000)):  # 0: the lines are joined, not handed to the tasks
        got = line_dedup.drop_repeated_lines(odd, min_docs=3, batches=batches, fanout=fanout, most=most).collect()
        want = Counter((r["doc_id"], t) for r, t in zip(rows, brute_lines([r["text"] for r in rows], 3)))
        assert Counter((r["doc_id"], r["text"]) for r in got) == want
        assert got[0].__fields__[-2:] == ["n_lines", "n_dropped"] and "_h1" in got[0].__fields__


def test_runs_are_compacted_and_counts_add_up(spark):
    docs = spark.createDataFrame([(i, "common\n" + sentence(i, 5)) for i in range(12)], "doc_id bigint, text string")
    runs = line_dedup.LineRuns(spark, min_docs=12, fanout=2)
    for b in range(4):
        runs.add(docs.filter(f"doc_id % 4 = {b}"))
    assert [len(level) for level in runs.levels] == [0, 0, 1]
    assert runs.frequent().count() == 1
    assert {r["text"] for r in runs.apply(docs).collect()} == {sentence(i, 5) for i in range(12)}
    # a later job opens the folder, under any number of shuffle partitions, and goes on
    with pytest.raises(ValueError):
        line_dedup.LineRuns(spark, runs.path, min_docs=3)
    again = line_dedup.LineRuns(spark, runs.path, min_docs=12, buckets=99)
    assert again.levels == runs.levels and again.buckets == runs.buckets and again.generation == runs.generation == 4
    again.add(spark.createDataFrame([(i, "common\nnew line") for i in range(12)], "doc_id bigint, text string"))
    assert again.frequent().count() == 2 and len(again.runs()) == 2


def test_runs_meet_without_a_shuffle(spark):
    runs = line_dedup.LineRuns(spark, fanout=9)
    for b in range(2):
        runs.add(spark.createDataFrame([(i, sentence(i + b, 5)) for i in range(50)], "doc_id bigint, text string"))
    with line_dedup._in_order(spark):
        plan = runs._merged(runs.runs())._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort " not in plan and "SortMergeJoin" in plan


def test_line_dedup_of_an_empty_table(empty):
    assert line_dedup.drop_repeated_lines(empty).collect() == []


def brute_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(rows, distance=4):
    parent = {fp: fp for _, fp in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(parent, 2):
        if (a ^ b).bit_count() <= distance:
            parent[root(a)] = root(b)
    ids = defaultdict(list)
    for doc, fp in rows:
        ids[root(fp)].append(doc)
    return [(doc, fp, min((i for i in ids[root(fp)] if i is not None), default=None)) for doc, fp in rows]


def test_simhash_is_brute_force(odd):
    rows = [(r["doc_id"], brute_fingerprint(r["text"])) for r in odd.collect()]
    got = [(r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in simhash.near_groups(odd).collect()]
    assert Counter(got) == Counter(brute_groups(rows))


def test_simhash_on_documents_is_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], brute_fingerprint(r["text"])) for r in docs.collect()]
    got = [(r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in simhash.near_groups(docs).collect()]
    assert Counter(got) == Counter(brute_groups(rows))


def test_links_of_crowded_blocks_connect_all(spark):
    """Hundreds of fingerprints around few centres: long chains and full blocks."""
    fps, x = {0}, 1
    while len(fps) < 700:
        x = (x * 6364136223846793005 + 1442695040888963407) % 2**64
        fps.add([0, 2**63 + 12345, 2**64 - 1][x >> 62 & 1] ^ (1 << (x >> 7 & 63)) ^ (1 << (x >> 13 & 63)) ^ (1 << (x >> 29 & 63)))
    signed = lambda f: f - 2**64 if f >= 2**63 else f
    table = spark.createDataFrame([(signed(f),) for f in fps], "fp bigint")
    want = defaultdict(set)
    for doc, fp, least in brute_groups([(f, f) for f in fps]):
        want[least].add(fp)
    for together in (20_000, 60, 7):  # the small ones file crowded keys again, up to the last round
        got = defaultdict(set)
        for r in components.components(simhash.near_links(table, together=together)).collect():
            got[r["component"]].add(r["node"] % 2**64)
        assert sorted(map(sorted, got.values())) == sorted(sorted(g) for g in want.values() if len(g) > 1)
    assert simhash.near_links(table).count() < 15 * len(fps)


def test_a_crowded_key_over_many_batches(spark):
    """The members of a crowded key come out once, wherever the batches end."""
    import numpy as np
    import pyarrow as pa

    k = np.array([1] * 3 + [2] * 40 + [3] * 2 + [4] * 12, np.int64)
    f = np.arange(len(k), dtype=np.int64) << 8
    for step in (1, 5, 11, 100):
        batches = [pa.RecordBatch.from_arrays([pa.array(k[i : i + step]), pa.array(f[i : i + step])], names=["k", "fp"]) for i in range(0, len(k), step)]
        out = pa.Table.from_batches(simhash._comparer(4, 10)(iter(batches))).to_pylist()
        assert sorted(r["u"] for r in out if r["v"] is None) == f[(k == 2) | (k == 4)].tolist()


def test_one_document_of_each_group_stays(spark, odd, empty):
    kept = simhash.keep_one_fingerprint(odd).collect()
    assert len({r["doc_id"] for r in kept}) == len(kept)
    groups = {r["component_id"] for r in simhash.near_groups(odd).collect()}
    assert {r["doc_id"] for r in kept} == groups
    assert kept[0].__fields__ == odd.columns and simhash.keep_one_fingerprint(empty).collect() == []
    rows = [(1, sentence(1, 80)), (1, sentence(2, 80)), (None, sentence(3, 80)), (None, sentence(4, 80)), (None, sentence(2, 80)), (5, sentence(4, 80)), (1, sentence(1, 80))]
    one = simhash.keep_one_fingerprint(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert Counter(map(tuple, one)) == Counter([rows[0], rows[1], rows[2], rows[5]])


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(5, 5), (None, 3), (200, 201), (201, 200)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)} | {200: 200, 201: 200}
    assert components.components(spark.createDataFrame([], "u bigint, v bigint")).collect() == []


def brute_quality(texts, hosts, max_docs, min_kept):
    out = []
    lines = [[x for x in (t or "").split("\n") if x.encode().split()] for t in texts]
    norm = lambda x: b" ".join(x.encode().split()).lower()
    holders = defaultdict(set)
    for i, (h, own) in enumerate(zip(hosts, lines)):
        for x in own:
            holders[h or "", norm(x)].add(i)
    for t, h, own in zip(texts, hosts, lines):
        words = (t or "").encode().split()
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        n = Counter(windows)
        covered = {j for i, w in enumerate(windows) if n[w] > 1 for j in range(i, i + 3)}
        gone = {x for x in own if len(holders[h or "", norm(x)]) > max_docs}
        lost = sum(len(x.encode().split()) for x in own if x in gone)
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        out.append((len(words), sum(len(w.decode()) for w in words), sum((t or "").count(c) for c in "#*$%&|<>"), len(own) - len(set(own)), len(covered), failed, lost, not failed and len(words) - lost >= min_kept * len(words), "\n".join(x for x in (t or "").split("\n") if x not in gone)))
    return out


def test_quality_is_brute_force(odd):
    rows = odd.collect()
    for max_docs, min_kept in ((1, 0.9), (20, 0.3)):
        want = brute_quality([r["text"] for r in rows], [r["source"] for r in rows], max_docs, min_kept)
        for most in (1000, 0):  # 0: boilerplate is joined, not broadcast
            got = quality.judge_quality(odd, max_docs, min_kept, most=most).select("doc_id", *quality.MADE).collect()
            assert Counter(map(tuple, got)) == Counter((r["doc_id"], *w) for r, w in zip(rows, want))
    good = quality.keep_good(odd, max_docs=1, min_kept=0.3)
    assert good.columns == odd.columns and good.count() == sum(w[7] for w in brute_quality([r["text"] for r in rows], [r["source"] for r in rows], 1, 0.3))


def test_quality_of_an_empty_table(empty):
    assert quality.judge_quality(empty).collect() == []


def test_kept_digest():
    assert hashlib.sha256(brute_lines(["A\nB"] * 2, 2)[0].encode()).hexdigest() == hashlib.sha256(b"").hexdigest() and len(odd_texts()) > 20


def brute_near(texts, similarity=0.8):
    """The least index of each text's group by the sets of its five-word shingles."""
    words = [(t or "").encode().lower().split() for t in texts]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in words]
    least = list(range(len(texts)))
    for i, j in combinations(range(len(texts)), 2):
        if len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]) and least[i] != least[j]:
            a, b = sorted((least[i], least[j]))
            least = [a if x == b else x for x in least]
    return least


def test_near_copies_are_those_that_share_their_shingles(spark):
    """Edits in several places beyond the four bits of op10, short texts, pairs below 0.8, and a crowd that only a chain connects."""

    def edited(seed, n, *at):
        words = sentence(seed, n).split(" ")
        for i in at:
            words[i] = f"edit{i}"
        return " ".join(words)

    texts = [edited(1, 400), edited(1, 400, 20, 90, 160, 230), edited(1, 400, 0, 399), edited(2, 40), edited(2, 40, 39), edited(2, 40, 20), edited(3, 200), edited(3, 200, *range(10, 190, 20))]
    chain = edited(4, 300).split(" ")
    for step in range(80):  # each step edits one word more of three hundred
        chain[step * 3] = f"step{step}"
        texts.append(" ".join(chain))
    texts += [edited(5, 300, i, 299 - i) for i in range(100)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    want = set(brute_near(texts))
    assert {r["doc_id"] for r in simhash.keep_one_of_each(docs).collect()} == want and 0 in want and 1 not in want and 7 in want
    assert {r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()} == want
    assert {r["doc_id"] for r in simhash.keep_one_fingerprint(docs).collect()} != want  # the four bits of fingerprints say less


@pytest.mark.parametrize("block", [5, 40])
def test_near_copies_in_crowds_dealt_into_parts(spark, monkeypatch, block):
    """A passage that many else different texts share fills a block's keys; groups of near copies are among them."""
    monkeypatch.setattr(wide_fingerprints, "BLOCK", block)
    shared = sentence(7, 60)
    texts = [shared + " " + sentence(100 + i // 3, 22) + f" own{i % 3}" for i in range(150)] + [sentence(8, 90) + f" tail{i}" for i in range(70)] + [shared + " " + sentence(900 + i, 70) for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    want = set(brute_near(texts))
    assert {r["doc_id"] for r in simhash.keep_one_of_each(docs).collect()} == want and 40 < len(want) < 200


def test_texts_of_one_name_are_told_apart(spark):
    rows = spark.createDataFrame([(1, 5, 7, "a"), (2, 5, 8, "b"), (3, 5, 8, "b"), (4, 6, 9, "c")], "doc_id int, node bigint, second bigint, sig string")
    rows = rows.withColumns({"bands": F.array(F.lit(1)), "k1": F.lit(1), "k2": F.col("doc_id")})
    got = wide_fingerprints._nodes(rows).collect()
    assert sorted((r["first"]["doc_id"], r["sig"]) for r in got) == [(1, "a"), (2, "b"), (4, "c")] and len({r["node"] for r in got}) == 3


def test_near_copies_on_documents_are_brute_force(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()
    docs = spark.createDataFrame([(i, r["text"]) for i, r in enumerate(rows)], "doc_id bigint, text string")
    assert {r["doc_id"] for r in simhash.keep_one_of_each(docs).collect()} == set(brute_near([r["text"] for r in rows]))


def test_wide_fingerprints_are_sign_bits():
    """Each bit is the majority of its shingles' bits, unrelated short texts differ in half of them, similar ones share a block."""
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 4, 255, 256, 700):
        hashes = rng.integers(0, 2**64, n, np.uint64)
        votes, ones = wide_fingerprints._bits(hashes).sum(axis=0, dtype=np.int64), np.unpackbits(np.frombuffer(wide_fingerprints.simhash(hashes), np.uint8))
        assert (ones[2 * votes > n] == 1).all() and (ones[2 * votes < n] == 0).all()
    sign = lambda x: np.unpackbits(np.frombuffer(wide_fingerprints.simhash(x), np.uint8))
    a, b = (sign(rng.integers(0, 2**64, 4, np.uint64)) for _ in range(2))
    assert 0.42 < (a != b).mean() < 0.58
    all_ = rng.integers(0, 2**64, 100, np.uint64)
    a, b = sign(all_[:90]), sign(all_[10:])
    for n in (100, 200_000, 10_000_000):
        blocks = wide_fingerprints.blocks_for(n)
        assert (a[blocks] == b[blocks]).all(axis=1).any() and n / 4 <= 2 ** max(blocks.shape[1], 8) and (np.sort(blocks)[:, 1:] > np.sort(blocks)[:, :-1]).all()


def test_texts_of_four_and_five_shingles_meet(spark):
    texts = [sentence(3000 + i, 9) for i in range(60)]
    texts += [t.rsplit(" ", 1)[0] for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert {r["doc_id"] for r in simhash.keep_one_of_each(docs).collect()} == set(brute_near(texts))


def test_rows_filed_grow_with_the_texts():
    """From 41,000 texts to 16 million each is filed under as many keys, and beyond that blocks have more bits."""
    shapes = {wide_fingerprints.blocks_for(n, wide_fingerprints.BITS_ENOUGH).shape for n in (41_000, 206_000, 13_500_000)}
    assert len(shapes) == 1 and wide_fingerprints.blocks_for(10**9, wide_fingerprints.BITS_ENOUGH).shape[1] == 20


def _compare(k, comps, sigs, step):
    import pyarrow as pa

    columns = [np.array(k, np.int64), np.arange(len(k)), np.array(comps, np.int64), *np.array(sigs, np.uint64).view(np.int64).reshape(-1, 2).T]
    batches = [pa.RecordBatch.from_arrays([pa.array(c[i : i + step]) for c in columns], names=["k", "node", "component", "a", "b"]) for i in range(0, len(k), step)]
    rows = pa.Table.from_batches(wide_fingerprints._compared(iter(batches))).to_pylist()
    return {(r["u"], r["v"]) for r in rows if r["v"] is not None}, {r["u"] for r in rows if r["v"] is None}


@pytest.mark.parametrize("n", [20, 100, 300])
def test_chance_texts_under_a_key_are_no_crowd(monkeypatch, n):
    """Unlike texts under a full key write nothing, and near copies among them at most a link each, also where they are many; what is linked is not compared."""
    rng = np.random.default_rng(n)
    chance, base = rng.integers(0, 2**63, (n, 2)).astype(np.uint64), rng.integers(0, 2**63, 2).astype(np.uint64)
    near = [base ^ np.array([1 << i, 0], np.uint64) for i in range(wide_fingerprints.TOGETHER + 3)]
    sigs = [*chance, *near, *near[:2]]
    k = [1] * (n + len(near)) + [2] * 2
    crowd = set(range(n, n + len(near)))
    for step in (7, 1000):
        links, crowded = _compare(k, range(len(k)), sigs, step)
        assert crowded == crowd and len({x for x in links if x[1] >= n}) == len(near) - 1 + 1 and (len(k) - 2, len(k) - 1) in links
        links, crowded = _compare(k, [*range(n)] + [-1] * (len(k) - n), sigs, step)
        assert not crowded and all(v < n for _, v in links)  # close by chance
    small = [*chance[:5], *near[:3]]
    assert _compare([1] * 8, range(8), small, 100) == ({(5, 6), (5, 7), (6, 7)}, set())
    monkeypatch.setattr(wide_fingerprints, "SMALL", 4)  # the other way finds the same
    assert _compare([1] * 8, range(8), small, 100) == ({(5, 6), (5, 7), (6, 7)}, set())
