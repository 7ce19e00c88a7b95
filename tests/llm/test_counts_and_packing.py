from collections import defaultdict
import zlib

import numpy as np
import pytest
from tests.llm.conftest import odd_texts, sentence
from sentweave.llm import bpe, packing, sharding, token_counts
from sentweave.llm.queries import op6_kd_sharding, tokenizer_path

BYTE, WORD = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("word_bpe_49k.json")


def test_token_counts_are_the_librarys(odd):
    encode = bpe.load(BYTE).encode
    got = sorted(((r["doc_id"] is None, r["doc_id"]), r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in token_counts.count_tokens(odd, BYTE).collect() if r["doc_id"] is not None)
    texts = dict(enumerate(odd_texts()))
    assert len(got) == len(texts) + 2
    for (_, doc), n_bytes, n, over in got:
        t = texts[doc] or ""
        assert (n_bytes, n, over) == (len(t.encode()), len(encode(t, add_special_tokens=False).ids), n > 512), doc


def test_word_ids_are_the_librarys():
    encoder = packing.Encoder(WORD)
    for t in odd_texts():
        assert np.frombuffer(encoder(t or ""), "<u4").tolist() == encoder.tokenizer.encode(t or "", add_special_tokens=False).ids


def test_counts_of_an_empty_table(empty):
    assert token_counts.count_tokens(empty, BYTE).collect() == []


def test_counts_and_ids_on_documents_are_the_librarys(spark):
    """Every text of the table, and texts that take the library's cutting into pre-tokens."""
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    encode, encoder = bpe.load(BYTE).encode, packing.Encoder(WORD)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(len(texts) + i, "\n\n" + t.replace(" ", "  ", 3) + "\tだ") for i, t in enumerate(texts[:100])], "doc_id bigint, text string")
    for r in token_counts.count_tokens(docs, BYTE, keep=("doc_id", "text")).collect():
        assert r["n_tokens"] == len(encode(r["text"], add_special_tokens=False).ids), r["doc_id"]
    for t in texts:
        assert np.frombuffer(encoder(t), "<u4").tolist() == encoder.tokenizer.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize(("tokens", "segments", "loss"), [(256, 256, None), (256, 2, None), (100, 5, 60)])
def test_pieces_make_up_every_document(odd, tokens, segments, loss):
    rows = packing.pack(odd.filter("doc_id IS NOT NULL"), WORD, max_tokens=tokens, max_segments=segments, max_loss=loss).collect()
    encode, sequences, pieces = packing.Encoder(WORD), defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append(r)
        pieces[r["doc_id"]].append(r)
    for own in sequences.values():
        own.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in own] == [sum(x["length"] for x in own[:i]) for i in range(len(own))]
        assert sum(r["length"] for r in own) <= min(tokens, loss or tokens) and len(own) <= segments
    for doc, text in enumerate(odd_texts()):
        ids = encode(text or "") + np.array([2], "<u4").tobytes()
        copies = 2 if doc in (7, 11) else 1
        covered = defaultdict(int)
        for r in pieces[doc]:
            part = ids[4 * r["start"] : 4 * (r["start"] + r["length"])]
            assert r["length"] > 0 and part == r["ids"] and r["loss"] is None and r["doc_tokens"] == len(ids) // 4
            for i in range(r["start"], r["start"] + r["length"]):
                covered[i] += 1
        assert covered == dict.fromkeys(range(len(ids) // 4), copies), doc


def test_packing_pads_little(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(5)
    rows = packing.pack(docs, WORD).collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r["sequence_id"]] += r["length"]
    padded = sum(0 if n & (n - 1) == 0 else 4096 - n for n in sizes.values())
    assert padded / sum(sizes.values()) < 0.001 and sum(n < 4096 for n in sizes.values()) <= 12


@pytest.mark.parametrize(("tokens", "segments", "loss", "binding"), [(64, 300, 64, 0), (4000, 3, 4000, 1), (400, 300, 7, 2)])
def test_instruction_data_keeps_each_limit(spark, sf_dir, tokens, segments, loss, binding):
    """Prompts bear no loss; in each case another of the three limits fills the sequences."""
    from pyspark.sql import functions as F

    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    ordered = F.array_sort(F.collect_list(F.struct("turn", "text", (F.col("role") == "assistant").alias("loss"))))
    examples = turns.groupBy(F.concat(F.lit("c"), "conv_id").alias("doc_id")).agg(F.transform(ordered, lambda t: F.struct(t["text"].alias("text"), t["loss"].alias("loss"))).alias("parts"))
    odd = spark.createDataFrame([("none", None), ("empty", []), (None, [("a b", False), (None, True)])], "doc_id string, parts array<struct<text:string,loss:boolean>>")
    examples = examples.unionByName(odd).repartition(3)
    rows = packing.pack(examples, WORD, max_tokens=tokens, max_segments=segments, max_loss=loss, parts="parts").collect()
    encode, sequences, made = packing.Encoder(WORD), defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append(r)
        made[r["doc_id"]].append((r["start"], bytes(r["ids"]), bytes(r["loss"])))
    sizes = [(sum(r["length"] for r in own), len(own), sum(sum(r["loss"]) for r in own)) for own in sequences.values()]
    limits = (tokens, segments, loss)
    assert all(a <= b for s in sizes for a, b in zip(s, limits))
    assert max(range(3), key=lambda i: sum(s[i] == limits[i] for s in sizes)) == binding
    for e in examples.collect():
        parts = [(encode(t["text"] or ""), t["loss"]) for t in e["parts"] or []]
        ids = b"".join(x for x, _ in parts) + np.array([2], "<u4").tobytes()
        mask = b"".join(bytes([y]) * (len(x) // 4) for x, y in parts) + bytes([parts[-1][1] if parts else True])
        own = sorted(made[e["doc_id"]])
        assert b"".join(x for _, x, _ in own) == ids and b"".join(x for _, _, x in own) == mask


def test_packing_an_empty_table(empty):
    assert packing.pack(empty, WORD).collect() == []


def test_shards_are_gapless_and_even(spark):
    rows = op6_kd_sharding(spark, "/root/testdata/sf0.01").collect()
    slots, size, groups = defaultdict(list), defaultdict(int), defaultdict(set)
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        size[r["shard"]] += r["size"]
        groups[texts[r["doc_id"]]].add(r["shard"])
        assert r["size"] == len(texts[r["doc_id"]].encode()) + 1 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode())
    assert len(rows) == len(texts) and sorted(size) == list(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(size.values()) < 1.1 * min(size.values())
    assert sum(len(g) > 1 for g in groups.values()) <= 15  # a cut passes through one group at most


def brute_shards(rows, shards, slack):
    """The same tree by sorting whole nodes: ``rows`` are (id, size, dimensions, text hash, row hash)."""
    import math

    out = {}

    def split(own, first, k):
        if k <= 1 or not own:
            out.update((r[0], first) for r in own)
            return

        def spread(d):
            x = [math.log1p(r[2][d]) for r in own]
            mean = sum(x) / len(x)
            return math.sqrt(sum((v - mean) ** 2 for v in x) / len(x)) / max(1e-9, max(x))

        widest = max(range(3), key=spread)
        own = sorted(own, key=lambda r: (r[2][widest], r[3], r[4]))
        wanted = sum(r[1] for r in own) * (k // 2) / k
        at, n = 0.0, 0
        while n < len(own) and abs(at - wanted) > slack and at < wanted:
            at += own[n][1]
            n += 1
        split(own[:n], first, k // 2)
        split(own[n:], first + k // 2, k - k // 2)

    split(rows, 0, shards)
    return out


@pytest.mark.parametrize("shards", [2, 5, 16])
def test_shards_are_those_of_sorting(spark, shards):
    """Bytes of each shard agree with a tree that sorts, up to the slack of a cut a level."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got, want = defaultdict(int), defaultdict(int)
    rows = [(r["doc_id"], len(r["text"].encode()) + 1, (len(r["text"].encode()), r["text"].count("\n"), int((2 * len(r["text"]) - len(r["text"].encode())) / max(1, len(r["text"].encode())) * 1e6)), hash(r["text"]), r["doc_id"]) for r in docs.collect()]
    total = sum(r[1] for r in rows)
    for i, s in brute_shards(rows, shards, 0.0).items():
        want[s] += dict((r[0], r[1]) for r in rows)[i]
    placed = {r["doc_id"]: (r["shard"], r["size"]) for r in sharding.kd_shards(docs, shards=shards).collect()}
    for s, n in placed.values():
        got[s] += n
    assert sorted(got) == sorted(want) == list(range(shards))
    assert all(abs(got[s] - total / shards) <= 0.05 * total / shards + 21_000 for s in got)
    # the first cut is the widest dimension's: no shard of one half goes beyond any of the other's along it
    by_id = {r[0]: r[2] for r in rows}
    left, right = ([by_id[i] for i, (s, _) in placed.items() if (s < shards // 2) == side] for side in (True, False))
    assert any(max(x[d] for x in left) <= min(x[d] for x in right) for d in range(3))


def test_many_shards_by_target_bytes(spark):
    docs = spark.createDataFrame([(i, "x" * (i % 97)) for i in range(3000)], "doc_id bigint, text string")
    rows = sharding.kd_shards(docs, target_bytes=2000).collect()
    size = defaultdict(int)
    for r in rows:
        size[r["shard"]] += r["size"]
    assert len(rows) == 3000 and len(size) == -(-sum(size.values()) // 2000) and max(size.values()) < 2400


@pytest.mark.parametrize("own", [5, None])
def test_repeated_rows_larger_than_a_shard(spark, own):
    """800 of 1,000 rows are one row again and again: they are dealt out like others."""
    rows = [(own, "one and the same")] * 800 + [(i, sentence(i, 4)) for i in range(200)]
    placed = sharding.kd_shards(spark.createDataFrame(rows, "doc_id int, text string").repartition(4), shards=16).collect()
    size, same = defaultdict(int), defaultdict(int)
    for r in placed:
        size[r["shard"]] += r["size"]
        same[r["shard"]] += r["size"] == 17
    fair = sum(size.values()) / 16
    assert len(placed) == 1000 and len(size) == 16 and all(abs(n - fair) <= 0.1 * fair + 20 for n in size.values())
    assert max(same.values()) <= fair / 17 + 2


def test_shards_of_odd_rows(odd, empty):
    rows = sharding.kd_shards(odd, shards=3).collect()
    assert len(rows) == odd.count() and {r["shard"] for r in rows} <= {0, 1, 2}
    for s in range(3):
        own = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert own == list(range(len(own)))
    assert sharding.kd_shards(empty, shards=4).collect() == []
    assert {r["shard"] for r in sharding.kd_shards(odd, target_bytes=10**9).collect()} == {0}


def test_one_text_fills_all_shards(spark):
    """A group of copies larger than a shard is cut by its rows."""
    rows = sharding.kd_shards(spark.createDataFrame([(i, "same text") for i in range(400)], "doc_id bigint, text string"), shards=4).collect()
    assert [sum(r["shard"] == s for r in rows) for s in range(4)] == pytest.approx([100] * 4, abs=6)


def test_packing_hands_workers_few_rows_at_once(spark, monkeypatch):
    seen, real = [], packing.materialise
    monkeypatch.setattr(packing, "materialise", lambda df, name: (seen.append(int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))), real(df, name))[1])
    docs = spark.createDataFrame([(i, f"word {i}") for i in range(3000)], "doc_id bigint, text string").coalesce(1)
    assert packing.pack(docs, WORD).select("doc_id").distinct().count() == 3000 and max(seen) <= 1000
