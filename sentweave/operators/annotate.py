"""The annotation boundary: analyzers plug in by name; sentences are annotated once for each distinct text.

An analyzer is a function that makes, once a Python worker, a function from a sentence to its analysis (a string). The
models of the Japanese and English parsers aren't part of this library; ``rules`` is a small deterministic tagger that
shows the contract.
"""

import re
import signal
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentweave.functions.batches import sliced
from sentweave.functions.text import bind
from sentweave.session import unused

MAX_CHARS = 130
DIGITS = "[０-９0-9　 ]{10,}"
_ANALYZERS: dict[str, Callable[[], Callable[[str], str]]] = {}
#: Treebank names of brackets and quotes.
POS_NAMES = {"(": "-LRB-", ")": "-RRB-", "[": "-LSB-", "]": "-RSB-", "{": "-LCB-", "}": "-RCB-"}
#: Japanese case names and the particles that mark them.
CASES = {"ガ": "ga", "ヲ": "wo", "ニ": "ni", "デ": "de", "ト": "to", "ヘ": "he", "カラ": "kara", "ヨリ": "yori", "マデ": "made", "ノ": "no"}


def register_annotator(name: str, make: Callable[[], Callable[[str], str]]) -> None:
    """Make an analyzer known; ``make`` runs in the workers, so it must be importable there."""
    _ANALYZERS[name] = make


def annotator(name: str) -> Callable[[], Callable[[str], str]]:
    if name not in _ANALYZERS:
        raise KeyError(f"no annotator {name!r}; known: {', '.join(sorted(_ANALYZERS))}")
    return _ANALYZERS[name]


def rule_tagger() -> Callable[[str], str]:
    """CoNLL rows from a few spelling rules; every token hangs on the first verb-like one."""
    rules = [(r"^[0-9][0-9.,]*$", "CD"), (r"^[.!?]$", "."), (r"^[,;:]$", ","), (r"^(the|a|an)$", "DT"), (r"^(of|in|on|to|for|with|by|from)$", "IN"), (r".ing$", "VBG"), (r".ed$", "VBD"), (r".ly$", "RB"), (r"^[A-Z]", "NNP"), (r".s$", "NNS")]
    compiled = [(re.compile(p), t) for p, t in rules]

    @lru_cache(1 << 16)
    def tag_of(token: str) -> str:
        return next((tag for p, tag in compiled if p.search(token)), "NN")

    def analyze(sentence: str) -> str:
        tokens = [POS_NAMES.get(t, t) for t in sentence.split(" ") if t]
        tags = [tag_of(t) for t in tokens]
        root = next((i for i, t in enumerate(tags) if t.startswith("VB")), 0)
        rows = [[str(i + 1), t, t.lower(), tag, tag, "_", "0" if i == root else str(root + 1), "ROOT" if i == root else "DEP", "_", "_"] for i, (t, tag) in enumerate(zip(tokens, tags))]
        return "\n".join("\t".join(r) for r in rows)

    return analyze


register_annotator("rules", rule_tagger)


def wanted(sentence: Column, is_normal: Column | None = None, block_type: Column | None = None, block_types: list[str] | None = None, max_chars: int = MAX_CHARS, all_: bool = False) -> Column:
    """Which sentences go to the analyzer: normal ones (unless ``all_``), of these block types, not too long, no digit runs."""
    ok = (F.length(sentence) > 0) & (F.length(sentence) <= max_chars) & ~sentence.rlike(DIGITS)
    if is_normal is not None and not all_:
        ok = ok & is_normal
    if block_types and block_type is not None:
        ok = ok & block_type.isin(*block_types)
    return F.coalesce(ok, F.lit(False))


class TimeLimit(Exception):
    """An analysis took too long."""


@contextmanager
def _limited(seconds: float | None) -> Iterator[None]:
    """Within the block, ``TimeLimit`` is raised after so many seconds (in the main thread of a Python worker)."""
    if not seconds:
        yield
        return

    def stop(*_) -> None:
        raise TimeLimit

    before = signal.signal(signal.SIGALRM, stop)
    signal.setitimer(signal.ITIMER_REAL, seconds)
    try:
        yield
    finally:
        signal.setitimer(signal.ITIMER_REAL, 0)
        signal.signal(signal.SIGALRM, before)


def analyses(texts: DataFrame, name: str = "rules", column: str = "text", seconds: float | None = 60, restart_after: int | None = None) -> DataFrame:
    """``(text, analysis, error)`` of each row; a failing sentence has a null analysis and the error's name.

    A sentence may take ``seconds``; then its error is TimeLimit. An analyzer is made anew after ``restart_after`` uses, and after an error.
    """
    make = annotator(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        analyze, used = make(), 0
        for batch in sliced(batches):
            done, errors = [], []
            for t in batch.column(0).to_pylist():
                if restart_after and used >= restart_after:
                    analyze, used = make(), 0
                used += 1
                try:
                    with _limited(seconds):
                        done.append(analyze(t.replace("\n", " ")))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001  an analyzer may raise anything; the row says so
                    done.append(None)
                    errors.append(type(e).__name__)
                    analyze, used = make(), 0
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(done, pa.string()), pa.array(errors, pa.string())], names=["text", "analysis", "error"])

    return texts.select(F.col(column).alias("text")).mapInArrow(run, "text string, analysis string, error string")


def bisected(analyze: Callable[[list[str]], list[str]], again: Callable[[], Callable], sentences: list[str], seconds: float | None = None) -> tuple[list[str | None], list[tuple[int, str]], int]:
    """Analyses of a document's sentences by an analyser that takes them together: ``(analyses, [(place, error)], runs)``.

    A run that fails is halved until the one sentence is found that it fails on, which is cut out and logged; where the first half is well,
    the fault is in the second, which isn't tried whole again. After a failure the analyser is made anew by ``again``.
    """
    done: list[str | None] = [None] * len(sentences)
    failed: list[tuple[int, str]] = []
    runs, todo = 0, [(0, len(sentences), None)]
    while todo:
        a, b, error = todo.pop()
        if a == b:
            continue
        if error is None:
            runs += 1
            try:
                with _limited(seconds):
                    found = analyze(sentences[a:b])
                if len(found) != b - a:
                    raise ValueError("an analysis is missing")
                done[a:b] = found
                continue
            except Exception as e:  # noqa: BLE001  an analyser may raise anything; the log says what
                error, analyze = type(e).__name__, again()
        if b - a == 1:
            failed.append((a, error))
            continue
        mid, before = (a + b) // 2, runs
        first, wrong, n = bisected(analyze, again, sentences[a:mid], seconds)
        runs = before + n
        done[a:mid] = first
        failed += [(a + i, e) for i, e in wrong]
        todo.append((mid, b, None if wrong else error))
    return done, failed, runs


def analyse_documents(docs: DataFrame, name: str, sentences: str = "sentences", seconds: float | None = 60, restart_after: int | None = 250) -> DataFrame:
    """Adds ``analyses`` (null for a sentence that was cut out), ``failed`` (``place``, ``error``) and ``runs`` to documents with an array of sentences.

    The analyser of this name takes all sentences of a document at once, a list, and gives as many analyses; see :func:`bisected`. A run may
    take ``seconds``. Null sentences are empty ones, a null array has no analyses.
    """
    make = annotator(name)
    (made,) = unused(docs, "made")
    log = pa.list_(pa.struct([("place", pa.int32()), ("error", pa.string())]))
    kind = pa.struct([("analyses", pa.list_(pa.string())), ("failed", log), ("runs", pa.int32())])

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        analyze, used = make(), 0
        for batch in sliced(batches):
            out = []
            for said in batch.to_pylist():
                if restart_after and used >= restart_after:
                    analyze, used = make(), 0
                done, failed, n = bisected(analyze, make, [x or "" for x in said or []], seconds)
                used += n
                if failed:
                    analyze, used = make(), 0
                out.append({"analyses": None if said is None else done, "failed": [{"place": i, "error": e} for i, e in failed], "runs": n})
            yield pa.array(out, kind)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    found = F.arrow_udf(run, "struct<analyses:array<string>,failed:array<struct<place:int,error:string>>,runs:int>")(F.col(sentences))
    return docs.withColumn(made, found).select(*docs.columns, f"{made}.analyses", f"{made}.failed", f"{made}.runs")


def annotate(found: DataFrame, name: str = "rules", column: str = "raw_string", cache: DataFrame | None = None, condition: Column | None = None, roles: list[str] | None = None, **limits) -> DataFrame:
    """Adds ``analysis`` and ``error``: each distinct wanted text is analysed once, texts of ``cache`` (text, analysis) not at all.

    Sentences that aren't wanted keep a null analysis; ``roles`` are those that are (title, keywords, description, body). For link texts,
    ``column`` is their anchor. ``limits`` go to :func:`analyses`.
    """
    ok = wanted(F.col(column)) if condition is None else condition
    if roles is not None:
        ok = ok & F.col("role").isin(*roles)
    marked = found.withColumn("_wanted", F.coalesce(ok, F.lit(False)))
    due = marked.filter("_wanted").drop("_wanted")
    texts = due.select(F.col(column).alias("text")).distinct()
    if cache is not None:
        known = cache.select("text", "analysis").dropDuplicates(["text"]).withColumn("error", F.lit(None).cast("string"))
        done = texts.join(known, "text").unionByName(analyses(texts.join(known.select("text"), "text", "left_anti"), name, **limits))
    else:
        done = analyses(texts, name, **limits)
    # sentences that aren't wanted have no part in the join: they would all meet under one key
    joined = due.join(done.withColumnRenamed("text", "_text"), F.col(column) == F.col("_text"), "left").drop("_text")
    rest = marked.filter(~F.col("_wanted")).drop("_wanted")
    return joined.unionByName(rest, allowMissingColumns=True)


def conll_rows(found: DataFrame, analysis: str = "analysis", *keep: str) -> DataFrame:
    """One row a token of CoNLL text: number, form, lemma, pos, head, relation."""
    # a filter on the analysis would be pushed below what makes it, which would be done again for each of its conditions
    cut = bind(F.col(analysis), lambda a: F.when(a != "", F.split(a, "\n")))
    rows = found.select(*keep, F.explode(F.transform(cut, lambda line: F.split(line, "\t"))).alias("fields"))
    part = lambda i: F.coalesce(F.get("fields", F.lit(i - 1)), F.lit(""))
    return rows.select(*keep, part(1).cast("int").alias("tok"), part(2).alias("form"), part(3).alias("lemma"), part(5).alias("pos"), part(7).cast("int").alias("head"), part(8).alias("rel"))


def tagged_conll(words: Column, tags: Column) -> Column:
    """CoNLL text of parallel word and tag arrays; brackets get their treebank names; no heads."""
    names = F.create_map(*[F.lit(x) for p in POS_NAMES.items() for x in p])
    name = lambda w: F.when(w.isin(*POS_NAMES), F.try_element_at(names, w)).otherwise(w)
    row = lambda p, i: F.concat_ws("\t", (i + 1).cast("string"), name(p["0"]), F.lower(name(p["0"])), name(p["1"]), name(p["1"]), F.lit("_"), F.lit("0"), F.lit("_"), F.lit("_"), F.lit("_"))
    return F.array_join(F.transform(F.arrays_zip(words.alias("0"), tags.alias("1")), row), "\n")


def chunks(conll: Column) -> Column:
    """Chunks of CoNLL text: id ``c<n>``, head ``c<m>`` (``c-1`` at the root) and its token."""
    part = lambda p, i: F.coalesce(F.get(p, F.lit(i - 1)), F.lit(""))
    head = lambda p: F.when(part(p, 7) == "0", "c-1").otherwise(F.concat(F.lit("c"), part(p, 7)))
    rows = F.transform(F.filter(F.split(conll, "\n"), lambda r: r != ""), lambda r: F.split(r, "\t"))  # each line is cut once
    return F.transform(rows, lambda p: F.struct(F.concat(F.lit("c"), part(p, 1)).alias("id"), head(p).alias("head"), part(p, 8).alias("type"), F.struct(F.concat(F.lit("t"), part(p, 1)).alias("id"), part(p, 2).alias("surf"), part(p, 3).alias("orig"), part(p, 5).alias("pos")).alias("token")))


def typed_dependencies(text: Column) -> Column:
    """``(rel, head_word, head, word, dep)`` of lines such as ``nsubj(ran-2, dog-1)``."""
    pattern = "([A-Za-z_:]+)\\((\\S+)-(\\d+)'*, (\\S+)-(\\d+)'*\\)"
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.transform(found, lambda d: F.struct(F.regexp_extract(d, pattern, 1).alias("rel"), F.regexp_extract(d, pattern, 2).alias("head_word"), F.regexp_extract(d, pattern, 3).cast("int").alias("head"), F.regexp_extract(d, pattern, 4).alias("word"), F.regexp_extract(d, pattern, 5).cast("int").alias("dep")))


def predicates(deps: Column) -> Column:
    """Predicate-argument pairs of dependencies; heads that are no word of the sentence are dropped."""
    of = lambda deps: F.filter(deps, lambda d: (d["head"] > 0) & (F.array_contains(F.transform(deps, lambda x: x["dep"]), d["head"]) | d["rel"].isin("nsubj", "dobj", "iobj", "nsubjpass")))
    return bind(deps, of)


def attach_sids(conll: DataFrame, sids: DataFrame, order: str) -> DataFrame:
    """CoNLL sentences with the ids of a parallel list, by their positions."""
    n = lambda df: df.withColumn("_n", F.row_number().over(Window.partitionBy("doc").orderBy(order)))
    return n(conll).join(n(sids).drop(order), ["doc", "_n"]).drop("_n")


def lemmatize(forms: DataFrame, table: DataFrame, form: str = "form", pos: str = "pos") -> DataFrame:
    """Adds ``lemma`` from a table of (form, pos, lemma); other forms are their own, lower-cased."""
    known = table.select(F.col("form").alias(form), F.col("pos").alias(pos), F.col("lemma").alias("_lemma")).dropDuplicates([form, pos])
    return forms.join(known, [form, pos], "left").withColumn("lemma", F.coalesce("_lemma", F.lower(F.col(form)))).drop("_lemma")


def add_annotation(annotations: Column, scheme: str, tool: str, cdata: Column, replace: bool = True) -> Column:
    """Annotations with one more; one of the same scheme is replaced, or (``replace=False``) kept as it is."""
    new = F.struct(F.lit(scheme).alias("scheme"), F.lit(tool).alias("tool"), cdata.alias("cdata"))
    there = F.exists(annotations, lambda a: a["scheme"] == scheme)
    added = F.array_append(drop_annotation(annotations, scheme), new)
    return F.when(cdata.isNull(), annotations).otherwise(added if replace else F.when(there, annotations).otherwise(added))


def drop_annotation(annotations: Column, scheme: str) -> Column:
    return F.filter(annotations, lambda a: a["scheme"] != scheme)


def annotate_annotations(found: DataFrame, scheme: str, new_scheme: str, name: str, **limits) -> DataFrame:
    """Sentence rows whose annotation of one scheme is analysed in turn; the result is added as an annotation of ``new_scheme``.

    Each distinct annotation text is analysed once; rows without one stay as they are.
    """
    given = found.withColumn("_given", F.get(F.filter("annotations", lambda a: a["scheme"] == scheme), F.lit(0))["cdata"])
    done = annotate(given, name, "_given", condition=F.col("_given").isNotNull(), **limits)
    return done.withColumn("annotations", add_annotation(F.col("annotations"), new_scheme, name, F.col("analysis"))).select(*found.columns)


def xml_chunks(xml: Column) -> Column:
    """Chunks that an external analyser gives as XML: ``<Result><Chunk Id= Head= Type=><Token Id= Surf= Orig= Pos=/>…``; null for what is no XML."""
    token = "STRUCT<_Id: STRING, _Surf: STRING, _Orig: STRING, _Pos: STRING>"
    read = F.from_xml(xml, f"Chunk ARRAY<STRUCT<_Id: STRING, _Head: STRING, _Type: STRING, Token: ARRAY<{token}>>>", {"mode": "PERMISSIVE"})["Chunk"]
    tokens = lambda c: F.transform(c["Token"], lambda t: F.struct(t["_Id"].alias("id"), t["_Surf"].alias("surf"), t["_Orig"].alias("orig"), t["_Pos"].alias("pos")))
    return F.transform(read, lambda c: F.struct(c["_Id"].alias("id"), c["_Head"].alias("head"), c["_Type"].alias("type"), tokens(c).alias("tokens")))


def annotation_dump(docs: DataFrame, scheme: str, id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, sent_no, raw_string, cdata)`` of all annotations of one scheme, in order within a document."""
    rows = docs.select(id_col, F.explode("sentences").alias("s")).select(id_col, "s.sent_no", "s.raw_string", F.explode("s.annotations").alias("a"))
    return rows.filter(F.col("a.scheme") == scheme).select(id_col, "sent_no", "raw_string", F.col("a.cdata").alias("cdata"))


def cdata_lines(docs: DataFrame, scheme: str, id_col: str = "doc_id") -> DataFrame:
    """Annotation texts of one scheme with ids by role: ``-T`` title, ``-D`` description, ``-K`` keywords, ``-n`` sentences."""
    rows = docs.select(id_col, F.explode("sentences").alias("s")).select(id_col, "s.role", "s.sent_no", F.explode("s.annotations").alias("a")).filter(F.col("a.scheme") == scheme)
    suffix = F.when(F.col("role") == "title", "T").when(F.col("role") == "description", "D").when(F.col("role") == "keywords", "K").otherwise(F.col("sent_no").cast("string"))
    return rows.select(F.concat_ws("-", F.col(id_col).cast("string"), suffix).alias("sid"), F.col("a.cdata").alias("cdata"))


def annotate_until_done(texts: DataFrame, name: str, write, read, max_rounds: int = 5) -> int:
    """Analyse what isn't done yet, round by round, until nothing new succeeds; the rounds taken.

    ``write(df)`` appends ``(text, analysis, error)`` rows to the log table, ``read()`` returns it. Failed texts are tried again.
    """
    for n in range(max_rounds):
        done = read().filter(F.col("error").isNull()).select("text")
        left = texts.join(done, "text", "left_anti")
        before = done.count()
        write(analyses(left, name))
        if read().filter(F.col("error").isNull()).select("text").count() == before:
            return n + 1
    return max_rounds
