"""Results that outlive a run, and documents on which an analyser fails."""

import math
import random
import uuid

import pytest
from pyspark.sql import functions as F

from sentweave.operators import annotate
from sentweave.operators.result_cache import ResultCache


def exchanges_over(plan: str, name: str) -> bool:
    """Whether the scan of a table stands under a shuffle in the plan's text, by its indentation."""
    above: list[tuple[int, str]] = []
    for line in plan.split("\n"):
        depth = len(line) - len(line.lstrip(" :+-*()0123456789"))
        above = [x for x in above if x[0] < depth] + [(depth, line)]
        if name in line and "Scan" in line:
            return any("Exchange" in x[1] for x in above)
    raise AssertionError(plan)


def counting(path):
    """An analyser that leaves a line for each text that it is given, and fails on some."""

    def make():
        def analyze(text: str) -> str:
            with open(path, "a") as log:
                log.write(text + "\n")
            if "bad" in text:
                raise ValueError(text)
            return text.upper()

        return analyze

    return make


def test_a_second_run_analyses_nothing(spark, tmp_path):
    annotate.register_annotator("counting", counting(tmp_path / "log"))
    cache = ResultCache(spark, f"cache_{uuid.uuid4().hex}", buckets=5)
    texts = [f"text {i % 40}" for i in range(100)] + [None, "x" * 500, "bad one", "bad one", "Text 1", "text 1 "]
    found = spark.createDataFrame([(i, t, "mine") for i, t in enumerate(texts)], "i int, raw_string string, _key string").repartition(4)
    first = {r["i"]: r for r in cache.annotate(found, "counting").collect()}
    asked = (tmp_path / "log").read_text().splitlines()
    assert sorted(asked) == sorted({t for t in texts if t and len(t) < 100})
    assert len(first) == len(texts) and all(first[i]["_key"] == "mine" for i in first)
    assert all(first[i]["analysis"] == (t.upper() if t and len(t) < 100 and "bad" not in t else None) for i, t in enumerate(texts))
    assert {first[i]["error"] for i, t in enumerate(texts) if t == "bad one"} == {"ValueError"} and first[100]["error"] is None
    more = found.union(spark.createDataFrame([(999, "new text", "mine")], found.schema))
    again = cache.annotate(more, "counting")
    assert sorted((tmp_path / "log").read_text().splitlines()[len(asked) :]) == ["bad one", "new text"]
    assert {r["i"]: r["analysis"] for r in again.collect()} == {i: r["analysis"] for i, r in first.items()} | {999: "NEW TEXT"}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert exchanges_over(cache.table().groupBy("text").count()._jdf.queryExecution().executedPlan().toString(), cache.name)
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert not exchanges_over(plan, cache.name) and "SortMergeJoin" in plan
    n = cache.table().filter("error is null").count()
    cache.compact()
    assert cache.table().count() == n and cache.misses(found, "raw_string").filter("text is not null").count() == 2  # the bad one and the long one
    spark.sql(f"DROP TABLE {cache.name}")


def test_one_bad_sentence_of_a_thousand():
    calls = []

    def analyze(some: list[str]) -> list[str]:
        calls.append(len(some))
        if "bad" in some:
            raise RuntimeError
        return [x.upper() for x in some]

    rng = random.Random(1)
    for n in (1, 2, 7, 1000):
        for _ in range(30):
            calls.clear()
            bad = rng.randrange(n)
            said = ["ok"] * n
            said[bad] = "bad"
            done, failed, runs = annotate.bisected(analyze, lambda: analyze, said)
            assert failed == [(bad, "RuntimeError")] and done == [None if i == bad else "OK" for i in range(n)]
            assert runs == len(calls) <= 2 * math.ceil(math.log2(n)) + 1 if n > 1 else runs == 1
    said = [rng.choice(["ok", "bad", "ok", "ok"]) for _ in range(300)]
    done, failed, _ = annotate.bisected(analyze, lambda: analyze, said)
    assert [i for i, _ in failed] == [i for i, s in enumerate(said) if s == "bad"] and [d is None for d in done] == [s == "bad" for s in said]
    assert annotate.bisected(analyze, lambda: analyze, []) == ([], [], 0)


def test_documents_with_failing_sentences(spark):
    annotate.register_annotator("by document", by_document)
    docs = spark.createDataFrame([(1, ["a", "bad", None], "x"), (2, [], "y"), (3, None, "z"), (4, ["slow", "b"], "w")], "id int, sentences array<string>, made string")
    got = {r["id"]: r for r in annotate.analyse_documents(docs, "by document", seconds=0.5).collect()}
    assert got[1]["analyses"] == ["A", None, ""] and [tuple(f) for f in got[1]["failed"]] == [(1, "KeyError")] and got[1]["made"] == "x"
    assert got[2]["analyses"] == [] and got[3]["analyses"] is None and got[3]["failed"] == []
    assert got[4]["analyses"] == [None, "B"] and got[4]["failed"][0]["error"] == "TimeLimit"
    with pytest.raises(KeyError):
        annotate.analyse_documents(docs, "nobody")


def by_document():
    import time

    def analyze(some: list[str]) -> list[str]:
        if "bad" in some:
            raise KeyError
        if "slow" in some:
            time.sleep(5)
        return [x.upper() for x in some]

    return analyze
