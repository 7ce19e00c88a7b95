"""Exact dedup, conversation repair and token alignment against plain versions of themselves."""

import binascii
import hashlib
import heapq
import random
import re
from collections import Counter, defaultdict

import pytest
from tests.llm.conftest import odd_texts, sentence
from sentweave.llm import alignment, conversations, exact_dedup
from sentweave.llm.queries import op12_conversation_repair, op13_token_alignment, tokenizer_path

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


# ---- exact dedup ----


def brute_copies(rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = defaultdict(list)
    for i, t in rows:
        groups[norm(t)].append(i)
    out = Counter()
    for t, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        sha, first = hashlib.sha256(t.encode()).hexdigest(), True
        for i in sorted(ids, key=lambda i: (i is None, i or 0)):
            out[i, keep, len(ids), first, sha] += 1
            first = False
    return out


def test_copies_are_brute_force(spark, odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    for most in (96_000_000, 3000, 1):
        assert Counter(tuple(r) for r in exact_dedup.find_copies(odd, trie_bytes=most).collect()) == brute_copies(rows)
    kept = exact_dedup.drop_copies(odd)
    assert kept.columns == odd.columns
    assert Counter((r["doc_id"], r["text"] or "") for r in kept.select("doc_id", "text").collect()).total() == len({k[-1] for k in brute_copies(rows)})


def test_many_copies_and_common_beginnings(spark):
    rng = random.Random(3)
    texts = ["same " * 50 + str(rng.randrange(40)) for _ in range(300)] + ["hot"] * 200 + ["x" * n for n in range(60)]
    rows = [(i % 290, t) for i, t in enumerate(texts)] + [(None, "")] * 50
    docs = spark.createDataFrame(rows, "doc_id int, text string").repartition(5)
    for most in (10**8, 4000):
        assert Counter(tuple(r) for r in exact_dedup.find_copies(docs, trie_bytes=most).collect()) == brute_copies(rows)


def test_many_rows_of_one_document(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "COPIES_TOGETHER", 7)
    rows = [(1, "a")] * 50 + [(2, "a"), (3, "b")]
    got = exact_dedup.find_copies(spark.createDataFrame(rows, "doc_id int, text string")).collect()
    assert Counter(tuple(r) for r in got) == brute_copies(rows)


def test_trie_spills_whole_subtrees():
    trie, rng, seen, gone = exact_dedup.Trie(20_000), random.Random(1), Counter(), Counter()
    for i in range(2000):
        text = bytes(rng.choice(b"ab") for _ in range(rng.randrange(0, 14)))
        seen[text] += 1
        if not trie.put(text, text, i, 1):
            gone[text] += 1
        while trie.full():
            gone.update({e[1]: e[3] for e in trie.spill()})
    left = {e[1]: e[3] for e in trie.entries()}
    assert gone and left and Counter(left) + gone == seen and not set(left) & set(gone)


def test_empty_tables(empty, spark):
    assert exact_dedup.find_copies(empty).collect() == [] and exact_dedup.drop_copies(empty).collect() == []
    assert alignment.align(empty, A, B).collect() == []
    none = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert conversations.audits(none).collect() == [] and conversations.repaired(none).collect() == []


# ---- conversations ----

PATTERN = re.compile(r"(s?(ua)+)?")


def brute_audit(rows):
    """Uniform cost search over (cost, audit), without states: the roles written so far are the state."""
    ahead = re.compile(r"s?(ua)*u?")
    queue, done = [(0, "", 0, "")], set()
    while True:
        cost, audit, at, roles = heapq.heappop(queue)
        if at == len(rows) and PATTERN.fullmatch(roles):
            return cost, audit
        key = (at, roles[-1:], len(roles) > 1 or roles == "u")
        if key in done:
            continue
        done.add(key)
        steps = [("I", at, roles + r, 2) for r in "ua"]
        if at < len(rows):
            initial, fault = rows[at]
            more = fault == "truncated"
            steps.append(("D", at + 1, roles, 3))
            if fault not in ("blank", "duplicate"):
                steps += [("K", at + 1, roles + (initial or "?"), more)] + [("R", at + 1, roles + r, 2 + more) for r in "ua"]
        for e, to, new, c in steps:
            if ahead.fullmatch(new):
                heapq.heappush(queue, (cost + c, audit + e, to, new))


def test_cheapest_edits_are_brute_force():
    rng = random.Random(5)
    for _ in range(1500):
        rows = [(rng.choice("suax"), rng.choice(["", "", "blank", "duplicate", "truncated"])) for _ in range(rng.randrange(0, 7))]
        code = {"": 0, "blank": 1, "duplicate": 1, "truncated": 2}
        codes = bytes("suax".index(i) + 4 * code[f] for i, f in rows)
        assert conversations.cheapest(codes) == brute_audit(rows), rows
    cost, audit = conversations.cheapest(bytes(rng.randrange(12) for _ in range(50_000)))
    assert len(audit.replace("I", "")) == 50_000 and cost > 0


def brute_repair(rows):
    """The whole contract by hand: damage, faults, edits, repaired text."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        kept = convs[conv]
        sp = lambda x: " " if x is None else str(x)
        k = binascii.crc32(f"{sp(conv)}:{sp(turn)}".encode()) % 20
        role, text = sp(role), sp(text)
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        role = "user" if k == 4 else role
        kept += [(turn, role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    out = {}
    for conv, said in convs.items():
        said.sort(key=lambda x: (x[0] is not None, x[0] or 0))
        seen, codes, count = set(), [], Counter()
        for _, role, text in said:
            bare = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            count[fault] += 1
            codes.append((role[:1] if role[:1] in set("sua") else "?", fault))
        turns = {t for t, _, _ in said if t is not None}
        cost, audit = brute_audit(codes)
        todo, written, last = iter(said), [], ""
        for e in audit:
            turn = next(todo) if e != "I" else None
            if e == "D":
                continue
            role, text = (turn[1], turn[2]) if e == "K" else ("assistant" if last == "u" else "user", turn[2] if turn else "")
            last = role[0]
            written.append(f"{role}:{text}")
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(codes, codes[1:]))
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(written).encode()).hexdigest())
    return out


def test_conversations_are_brute_force_over_the_whole_table(spark):
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        got = {r["conv_id"]: tuple(r)[1:] for r in op12_conversation_repair(spark, sf).collect()}
        assert got == brute_repair([tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()])


def test_odd_conversations(spark):
    rng = random.Random(8)
    texts = [None, "", " \n", "Yes.", "No", "Well! \t", "x" * 200_000 + "?", "Yes."]
    rows = [(rng.choice([None, 1, 2, 3]), rng.choice([None, 0, 5, i]), rng.choice([None, "system", "user", "assistant", "", "tool"]), rng.choice(texts)) for i in range(120)]
    rows = list({r[:2]: r for r in rows}.values())  # of one turn, rows that differ have no order in the contract
    docs = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string").repartition(4)
    turns = conversations.damage(docs)
    judged = conversations.audits(turns, docs)
    got = {r["conv_id"]: tuple(r)[1:] for r in conversations.digests(turns, judged).collect()}
    assert got == brute_repair(rows)
    written = conversations.repaired(turns).collect()
    for conv, want in got.items():
        mine = sorted((r for r in written if r["conv_id"] == conv), key=lambda r: r["place"])
        assert hashlib.sha256("\n".join(f"{r['role']}:{r['text']}" for r in mine).encode()).hexdigest() == want[-1]
        assert PATTERN.fullmatch("".join(r["role"][:1] for r in mine))


def test_all_rows_dropped_and_clashing_columns(spark):
    turn = next(t for t in range(1000) if binascii.crc32(f"1:{t}".encode()) % 20 == 0)
    docs = spark.createDataFrame([(1, turn, "user", "Hi.", *["mine"] * 5)], "conv_id bigint, turn bigint, role string, text string, code string, audit string, h1 string, seen string, kind string")
    turns = conversations.damage(docs)
    got = conversations.digests(turns, conversations.audits(turns, docs)).collect()
    assert [tuple(r) for r in got] == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


# ---- alignment ----


def brute_alignment(texts):
    pair = alignment.Pair(A, B)
    docs, links, count = [], [], Counter()
    for t in texts:
        ids_a, ids_b = (pair.a.encode(" " + t, add_special_tokens=False).ids, pair.b.encode(t)) if t else ([], [])
        one, two = [pair.bytes_a[i] for i in ids_a], [pair.bytes_b[i] for i in ids_b]
        if not t or b"".join(one) != (" " + t).encode() or b"".join(two) != (" " + t).encode():
            docs.append((0, 0, 0, ""))
            links.append([])
            continue
        span = lambda parts: [(sum(map(len, parts[:i])), sum(map(len, parts[: i + 1]))) for i in range(len(parts))]
        sa, sb = span(one), span(two)
        found = [(ids_a[i], ids_b[j]) for i, (x, y) in enumerate(sa) for j, (p, q) in enumerate(sb) if x < q and p < y]
        cuts = sorted({y for _, y in sa} & {y for _, y in sb})
        groups = [",".join(str(i) for i, (x, y) in zip(ids_a, sa) if lo < y <= hi) + "|" + ",".join(str(i) for i, (x, y) in zip(ids_b, sb) if lo < y <= hi) for lo, hi in zip([0, *cuts], cuts)]
        docs.append((len(ids_a), len(ids_b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest()))
        links.append(found)
        count.update(found)
    most = defaultdict(int)
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return Counter((a, b, g, len(x), sum(count[p] == most[p[1]] for p in x), sum(count[p] for p in x), sha) for (a, b, g, sha), x in zip(docs, links))


SHORT = [t[:400] if t else t for t in odd_texts()] + [
    " leads", "trails ", "a \nb", "a\n b", "a\n\n\nb", "<s> <unk> </s> <0x41> <|endoftext|>", "▁under▁ line", "null\x00byte", "a b c　d", "\n", "\n\n", "x\n", "\nx",
    "é é ﬁ Ⅷ", "👩‍👩‍👧 family", "tab\t\ttab", "a\x85b \x85 c", "it's we'll I'm\n'twas", "١٢٣ 12345678 ½", "word " * 30, "a b   c", "﻿bom", "x" * 300, " ", "  ", "漢字かな交じり文。\n次 の 行",
]


def test_alignment_is_brute_force(spark):
    rng = random.Random(2)
    letters = [" ", " ", "\n", "a", "é", "▁", "1", ".", "'s", "the", "\t", "漢", " ", "\r", "<s>"]
    texts = SHORT + SHORT[:9] + [sentence(i, 12).replace(" ", "\n", i % 3) for i in range(40)] + ["".join(rng.choices(letters, k=rng.randrange(1, 15))) for _ in range(300)]
    docs = spark.createDataFrame([(i if i % 7 else None, t, "mine") for i, t in enumerate(texts)], "doc_id bigint, text string, pair string").repartition(3)
    want = brute_alignment(texts)
    for block in (2_000_000, 150):
        got = alignment.align(docs, A, B, block_pairs=block)
        assert Counter(tuple(r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")) for r in got.collect()) == want


def test_alignment_over_the_whole_table(spark, monkeypatch, sf_dir):
    whole = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()
    texts = [r["text"] for r in whole if r["text"] is None or len(r["text"]) < 4000]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(2)
    got = alignment.align(docs, A, B).drop("doc_id", "ids_a", "ids_b").select("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    assert Counter(tuple(r) for r in got.collect()) == brute_alignment(texts)
    assert op13_token_alignment(spark, sf_dir).count() == len(whole)


def test_slices_and_spilled_counts(spark, monkeypatch):
    monkeypatch.setattr(alignment, "AT_ONCE", 50)
    laid = list(alignment.slices([10, 45, 5, 0, 200, 1]))
    assert laid == [(0, 1), (1, 4), (4, 5), (5, 6)]
    keys, n = alignment.counted(alignment.np.array([5, 1, 5, 2]), alignment.np.array([1, 2, 3, 4]))
    assert keys.tolist() == [1, 2, 5] and n.tolist() == [2, 4, 4]
    for empty in (alignment.counted(alignment.np.zeros(0, "u4")), alignment.counted(alignment.np.zeros(0, "u4"), alignment.np.zeros(0, "i8"))):
        assert len(empty[0]) == len(empty[1]) == 0


def test_a_vocabulary_beyond_sixteen_bits_is_refused(monkeypatch):
    with pytest.raises(ValueError):
        monkeypatch.setattr(alignment.bpe, "load", lambda path: type("T", (), {"get_vocab": lambda self, **k: {str(i): 2 * i for i in range(5)}})())
        alignment.Pair(A, B)
