"""Queries over documents and inline rows: sentences, tokens, scores, normalisation, formatting."""

from pyspark.sql import functions as F

from sentweave.functions import english, japanese, text
from sentweave.operators import annotate, filters, formatter, papers, provenance, sentences
from sentweave.plans import sql
from sentweave.session import table
from sentweave.sources import readers

QUERIES, SQL = {}, {}


def query(statement: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if statement:
            SQL[f.__name__] = statement
        return f

    return add


def docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


_LINES = "lines AS (SELECT doc_id, CAST(i AS INT) AS line_no, doc_id || '-' || i AS lk, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents))"


def lines(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))


@query(f"WITH {_LINES}, {sql.split_english('lines', 'lk', 'line')} SELECT l.doc_id, l.line_no, c.k AS sent_no, c.sentence FROM cut c JOIN lines l USING (lk)")
def english_sentences(spark, sf_dir):
    found = lines(spark, sf_dir).select("doc_id", "line_no", F.posexplode(english.split_english(F.col("line"))).alias("sent_no", "sentence"))
    return found


@query("SELECT doc_id, length(text) AS n, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS n_words FROM documents WHERE length(text) <= 2000")
def document_length_cap(spark, sf_dir):
    return docs(spark, sf_dir).filter(F.length("text") <= 2000).select("doc_id", F.length("text").cast("bigint").alias("n"), F.size(english.words_of(F.col("text"))).cast("bigint").alias("n_words"))


@query(f"SELECT doc_id, {sql.japanese_score('text')} AS score FROM documents")
def japanese_score(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", japanese.japanese_score(F.col("text")).alias("score"))


#: Letters of the documents as Japanese text: particles, kanji, half- and full-width letters, brackets, marks, faces.
LATIN = "abcdefghijklmnopqrstuvwxyz.,?!-#%&*$'ABCDEFGHIJKLMNOPQRSTUVWXYZ"
KANA = "が部シ田のふカはいＡかル水にを日１ー東たう京とｱやン。、？！―■＾）｜…」「」（）（）・・１２（「■東京日水田部０。（）『』あ"
_KANA_LINES = f"{_LINES}, kana AS (SELECT doc_id, line_no, lk, translate(line, {sql.q(LATIN)}, {sql.q(KANA)}) AS c FROM lines)"


def kana_lines(spark, sf_dir):
    """Lines of all documents with their letters as Japanese ones."""
    return lines(spark, sf_dir).select("doc_id", "line_no", F.translate("line", LATIN, KANA).alias("c"))


@query(f"WITH {_KANA_LINES} SELECT doc_id, line_no, {sql.japanese_score('c')} AS score, {sql.japanese_score('c', '[\\p{Hiragana}\\p{Katakana}ー\\p{Han}]')} AS letters FROM kana")
def score_rules(spark, sf_dir):
    return kana_lines(spark, sf_dir).select("doc_id", "line_no", japanese.japanese_score(F.col("c")).alias("score"), japanese.japanese_score(F.col("c"), punctuation=False).alias("letters"))


@query(f"WITH {_KANA_LINES} SELECT doc_id, line_no, c FROM kana WHERE {sql.japanese_score('c')} > 0.3")
def text_filter(spark, sf_dir):
    return kana_lines(spark, sf_dir).filter(japanese.japanese_score(F.col("c")) > 0.3)


@query(f"""WITH {_KANA_LINES}, r AS (SELECT *, len(regexp_extract_all(c, '[がをにはので]')) AS n FROM kana)
SELECT doc_id, line_no, {sql.share('n', 'length(c)')} AS ratio, {sql.share('n', '(2 * length(c))')} AS halved, length(c) > 0 AND {sql.share('n', 'length(c)')} > 0.005 AS japanese FROM r""")
def particle_ratio(spark, sf_dir):
    c = F.col("c")
    return kana_lines(spark, sf_dir).select("doc_id", "line_no", japanese.particle_ratio(c).alias("ratio"), japanese.particle_ratio(c, doubled=True).alias("halved"), filters.has_particles(c).alias("japanese"))


_RULE = "CAST(CASE WHEN regexp_matches(c, '^　*[□■◇◆▽△▼▲○◎●〇◯★☆・＜《【［]') THEN 1 WHEN regexp_matches(c, '^.+。.+。.+。.+。.+。.+') OR length(c) >= 256 THEN 2 WHEN regexp_matches(c, '^…+$') THEN 3 WHEN regexp_matches(c, '[｜┃]') THEN 4 WHEN regexp_matches(c, '^\\p{Han}*$') THEN 5 END AS INT)"


@query(f"WITH {_KANA_LINES} SELECT doc_id, line_no, {_RULE} AS rule FROM kana")
def format_rules(spark, sf_dir):
    return kana_lines(spark, sf_dir).select("doc_id", "line_no", japanese.deletion_rule(F.col("c")).alias("rule"))


_KANA_WORDS = f"{_KANA_LINES}, kw AS (SELECT doc_id, line_no, unnest(regexp_extract_all(c, '[^\\x20\\x09-\\x0D]+')) AS w, unnest(range(len(regexp_extract_all(c, '[^\\x20\\x09-\\x0D]+')))) AS i FROM kana)"


@query(f"WITH {_KANA_WORDS} SELECT CASE WHEN regexp_matches(w, '^[０-９]*$') THEN '年齢' WHEN regexp_matches(w, '^\\p{{Hiragana}}+$') THEN '読み' ELSE 'その他' END AS type, count(*) AS n, count(DISTINCT w) AS words FROM kw GROUP BY 1")
def paren_type(spark, sf_dir):
    words = kana_lines(spark, sf_dir).select(F.explode(english.words_of(F.col("c"))).alias("w"))
    return words.groupBy(japanese.bracket_type(F.col("w")).alias("type")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("w").alias("words"))


def _masked(c: str) -> str:
    """Faces as private characters, longest first."""
    for face in japanese.FACES_BY_LENGTH:
        c = f"replace({c}, {sql.q(face)}, {sql.q(chr(0xE001) * len(face))})"
    return c


#: Where the enumerated remarks of a list stand: each number's first place after the one before it; 0 from the first that is missing on.
_NUMBERED = "p0 AS (SELECT doc_id, line_no, texts, 0 AS place, [0] AS found FROM lists),\n" + "".join(
    f"q{i} AS (SELECT *, CASE WHEN {'place > 0' if i > 1 else 'true'} THEN coalesce(list_position(texts[place + 1:], {sql.q(n)}), 0) ELSE 0 END AS step FROM p{i - 1}),\n"
    f"p{i} AS (SELECT doc_id, line_no, texts, CASE WHEN step > 0 THEN place + step ELSE 0 END AS place, list_append(found, CASE WHEN step > 0 THEN place + step ELSE 0 END) AS found FROM q{i}),\n"
    for i, n in enumerate(japanese.ENUMERATION, 1)
)


@query(f"""WITH {_KANA_LINES}, m AS (SELECT doc_id, line_no, c, {_masked('c')} AS k FROM kana),
ch AS (SELECT doc_id, line_no, unnest(string_split(k, '')) AS x, unnest(range(length(k))) AS i FROM m WHERE c <> ''),
s AS (SELECT *, sum(CASE x WHEN '（' THEN 1 WHEN '）' THEN -1 ELSE 0 END) OVER (PARTITION BY doc_id, line_no ORDER BY i) AS s FROM ch),
v AS (SELECT *, s - least(0, min(s) OVER (PARTITION BY doc_id, line_no ORDER BY i)) AS level FROM s),
w AS (SELECT *, coalesce(lag(level) OVER (PARTITION BY doc_id, line_no ORDER BY i), 0) AS before FROM v),
e AS (SELECT doc_id, line_no, i, level, row_number() OVER (PARTITION BY doc_id, line_no, level ORDER BY i) AS n FROM w WHERE (x = '（' AND level = 1 AND before = 0) OR (x = '）' AND level = 0 AND before = 1)),
pairs AS (SELECT a.doc_id, a.line_no, a.n, a.i AS a, b.i AS b, substr(m.k, CAST(a.i + 2 AS BIGINT), CAST(b.i - a.i - 1 AS BIGINT)) AS t FROM e a JOIN e b ON a.doc_id = b.doc_id AND a.line_no = b.line_no AND a.n = b.n AND a.level = 1 AND b.level = 0 JOIN m ON m.doc_id = a.doc_id AND m.line_no = a.line_no),
lists AS (SELECT doc_id, line_no, list(t ORDER BY n) AS texts FROM pairs GROUP BY ALL),
{_NUMBERED}kept AS (SELECT pairs.* FROM pairs JOIN p9 USING (doc_id, line_no) WHERE NOT list_contains(found, n)),
shown AS (SELECT doc_id, line_no, string_agg(t, ',' ORDER BY n) AS remarks, list(struct_pack(a := a, b := b) ORDER BY n) AS spans FROM kept GROUP BY ALL),
cut AS (SELECT doc_id, line_no, unnest(string_split(c, '')) AS x, unnest(range(length(c))) AS i FROM kana WHERE c <> ''),
mains AS (SELECT c.doc_id, c.line_no, string_agg(c.x, '' ORDER BY c.i) FILTER (WHERE shown.spans IS NULL OR len(list_filter(shown.spans, lambda p: c.i BETWEEN p.a AND p.b)) = 0) AS main FROM cut c LEFT JOIN shown USING (doc_id, line_no) GROUP BY ALL)
SELECT kana.doc_id, kana.line_no, coalesce(mains.main, '') AS main, coalesce(shown.remarks, '') AS remarks FROM kana LEFT JOIN mains USING (doc_id, line_no) LEFT JOIN shown USING (doc_id, line_no)""")
def paren_divide(spark, sf_dir):
    """Every line without its bracketed remarks, and these; nested ones are part of the outer one, enumerations stay, faces are none."""
    rows = kana_lines(spark, sf_dir)
    return rows.select("doc_id", "line_no", japanese.without_brackets(F.col("c")).alias("main"), F.array_join(F.transform(japanese.brackets(F.col("c"))["found"], lambda p: p["text"]), ",").alias("remarks"))


@query()
def format_sentences(spark, sf_dir):
    """Each option's outcome for every line, as a digest."""
    rows = kana_lines(spark, sf_dir)
    formatted = lambda p: F.struct(*[formatter.format_sentence(F.col("c"), paren=p, newspaper=True)[x].cast("string").alias(x) for x in ("sentence", "log", "parens")])
    return rows.select("doc_id", "line_no", *[F.md5(F.to_json(formatted(p))).alias(p) for p in ("remove", "include", "divide")])


_FULL = "'" + text.WIDE_ASCII + "　" + text.FULL_KANA + "'"
_HALF = sql.q(text.ASCII + " " + text.HALF_KANA)


@query(f"WITH {_KANA_LINES} SELECT k.doc_id, k.line_no, translate(l.line, {_HALF}, {_FULL}) AS wide, translate(k.c, {_HALF}, {_FULL}) AS kana, translate(translate(k.c, {_HALF}, {_FULL}), '{text.UNSAFE}', '{text.SAFE}') AS safe, translate(translate(l.line, {_HALF}, {_FULL}), {_FULL}, {_HALF}) = l.line AS back FROM kana k JOIN lines l USING (lk)")
def widths(spark, sf_dir):
    both = lines(spark, sf_dir).withColumn("c", F.translate("line", LATIN, KANA))
    wide = text.widen(F.col("c"))
    return both.select("doc_id", "line_no", text.widen(F.col("line")).alias("wide"), wide.alias("kana"), text.remap_unsafe(wide).alias("safe"), (text.narrow_ascii(text.widen(F.col("line"))) == F.col("line")).alias("back"))


@query()
def japanese_normalisation(spark, sf_dir):
    """Voiced marks, long marks, ranges and blanks of every line."""
    c = F.col("c")
    return kana_lines(spark, sf_dir).select("doc_id", "line_no", F.md5(text.normalise_japanese(c)).alias("body"), F.md5(text.normalise_japanese(c, preformatted=False)).alias("title"))


@query()
def japanese_sentences(spark, sf_dir):
    found = kana_lines(spark, sf_dir).select("doc_id", "line_no", japanese.split_paragraphs(F.array(text.normalise_japanese(F.col("c"))), merge_items=False).alias("s"))
    return found.select("doc_id", "line_no", F.posexplode(F.flatten("s")).alias("k", "sentence"))


@query()
def japanese_page_sentences(spark, sf_dir):
    """Sentences of the pages read as Japanese ones, with their spans; the text between the tags has Japanese letters."""
    pages = table(spark, sf_dir, "pages")
    pieces = F.regexp_extract_all("html", F.lit("<!--[\\s\\S]*?-->|(?i)<(script|style)\\b[\\s\\S]*?</(?:script|style)\\s*>|<[^>]*>|&[#0-9a-zA-Z]+;|[^<&]+|[<&]"), F.lit(0))
    shown = F.array_join(F.transform(pieces, lambda p: F.when(p.rlike("^[<&]."), p).otherwise(F.translate(p, LATIN, KANA))), "")
    kana = pages.select("page_id", shown.alias("html"))
    found = provenance.verify(sentences.sentences(kana, language="japanese"), kana, language="japanese")
    return found.select("page_id", "sent_no", "paragraph", "raw_string", "offset", "length", "matches")


@query(f"""WITH {_KANA_LINES}, l AS (SELECT doc_id, line_no, c, regexp_matches(c, '^[Ａ-Ｚａ-ｚ０-９]．') AS item FROM (SELECT doc_id, line_no, regexp_replace(regexp_replace(c, '^１', '１．'), '。$', '、') AS c FROM kana) WHERE c <> ''),
o AS (SELECT *, coalesce(last_value(CASE WHEN item THEN NULL ELSE regexp_matches(c, '[、，：]$') END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS listing FROM l),
g AS (SELECT *, sum(CASE WHEN listing THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS g FROM o)
SELECT doc_id, CAST(g - 1 AS INT) AS k, string_agg(c, '　' ORDER BY line_no) AS sentence FROM g GROUP BY doc_id, g""")
def itemised_lists(spark, sf_dir):
    """Lines of each document as sentences; many end with 、 and some open with an item header."""
    own = F.transform(F.split("text", "\n", -1), lambda x: F.regexp_replace(F.regexp_replace(F.translate(x, LATIN, KANA), "^１", "１．"), "。$", "、"))
    return docs(spark, sf_dir).select("doc_id", F.posexplode(japanese.merge_items(F.filter(own, lambda x: x != ""))).alias("k", "sentence"))


@query(f"WITH {_KANA_LINES} SELECT doc_id, line_no, regexp_matches(c, '（笑）|（爆）|（怒）|（汗）|（泣）|（涙）|＾＾|（＾＿＾）|＞＜') AS has_face FROM kana")
def emoticons(spark, sf_dir):
    return kana_lines(spark, sf_dir).select("doc_id", "line_no", japanese.has_emoticon(F.col("c")).alias("has_face"))


_LONG = "'(?s)^(.+?)(が|であり|ており)、(.+)$'"


@query(f"""WITH {_KANA_LINES}, m AS (SELECT doc_id, line_no, c, length(c) AS n, regexp_extract(c, {_LONG}, 1) AS l, regexp_extract(c, {_LONG}, 2) AS m, regexp_extract(c, {_LONG}, 3) AS r FROM kana),
cut AS (SELECT *, n >= 70 AND m <> '' AND (length(l) + length(m)) / CAST(n AS DOUBLE) BETWEEN 0.3 AND 0.7 AS two FROM m)
SELECT doc_id, line_no, CAST(0 AS INT) AS k, CASE WHEN two THEN l || CASE m WHEN 'であり' THEN 'だ。' WHEN 'ており' THEN 'ている。' ELSE '。' END ELSE c END AS part FROM cut UNION ALL SELECT doc_id, line_no, 1, r FROM cut WHERE two""")
def long_sentences(spark, sf_dir):
    return kana_lines(spark, sf_dir).select("doc_id", "line_no", F.posexplode(japanese.split_long(F.col("c"))).alias("k", "part"))


_WORDS = "regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')"


@query(f"""WITH {_LINES}, w AS (SELECT lk, doc_id, line_no, unnest({_WORDS}) AS w, unnest(range(len({_WORDS}))) AS i FROM lines),
n AS (SELECT *, lead(w) OVER (PARTITION BY lk ORDER BY i) AS nx FROM w)
SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE w = 'the') AS n_the, count(*) FILTER (WHERE regexp_matches(w, '^[A-Z]')) AS n_capital, count(*) FILTER (WHERE nx IS NULL) AS n_last FROM n GROUP BY doc_id""")
def word_statistics(spark, sf_dir):
    words = lines(spark, sf_dir).withColumn("w", english.words_of(F.col("line")))
    one = words.select("doc_id", F.size("w").alias("n"), F.size(F.filter("w", lambda x: x == "the")).alias("t"), F.size(F.filter("w", english.capital)).alias("c")).filter("n > 0")
    return one.groupBy("doc_id").agg(F.sum("n").alias("n_words"), F.sum("t").alias("n_the"), F.sum("c").alias("n_capital"), F.count(F.lit(1)).alias("n_last"))


@query()
def tokenizer_languages(spark, sf_dir):
    """Every line by the rules of three groups of languages."""
    digest = lambda lang: F.md5(english.tokenize(F.col("line"), lang)).alias(lang)
    return lines(spark, sf_dir).select("doc_id", "line_no", *[digest(lang) for lang in ("en", "fr", "de")])


@query()
def english_tokenize(spark, sf_dir):
    """Tokens of every line of every document."""
    digests = lambda t: F.struct(F.size(F.filter(F.split(t, " "), lambda w: w != "")).cast("bigint").alias("n_tokens"), F.md5(t).alias("digest"))
    return lines(spark, sf_dir).select("doc_id", "line_no", text.bind(english.tokenize(F.col("line")), digests).alias("t")).select("doc_id", "line_no", "t.*")


@query()
def annotated_sentences(spark, sf_dir):
    """Each distinct wanted sentence analysed once by the built-in tagger, and joined back."""
    found = lines(spark, sf_dir).select("doc_id", "line_no", F.posexplode(english.split_english(F.col("line"))).alias("k", "raw_string"))
    return annotate.annotate(found).select("doc_id", "line_no", "k", F.md5("analysis").alias("analysis"), "error")


@query("""WITH words AS (SELECT doc_id, unnest(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS form, unnest(range(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')))) AS i FROM documents)
SELECT doc_id, CAST(i + 1 AS INT) AS tok, form, lower(form) AS lemma FROM words""")
def conll_rows(spark, sf_dir):
    words = english.words_of(F.col("text"))
    tagged = docs(spark, sf_dir).withColumn("analysis", annotate.tagged_conll(words, F.transform(words, lambda w: F.lit("X"))))
    return annotate.conll_rows(tagged, "analysis", "doc_id").select("doc_id", "tok", "form", "lemma")


@query("""WITH w AS (SELECT doc_id, unnest(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS surf, unnest(range(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')))) AS i FROM documents)
SELECT doc_id, 'c' || (i + 1) AS chunk, CASE WHEN i = 0 THEN 'c-1' ELSE 'c' || i END AS head, surf FROM w""")
def conll_to_chunks(spark, sf_dir):
    """Every word of a document hangs on the one before it."""
    rows = F.transform(english.words_of(F.col("text")), lambda w, i: F.concat_ws("\t", (i + 1).cast("string"), w, w, F.lit("X"), F.lit("X"), F.lit("_"), i.cast("string"), F.lit("DEP"), F.lit("_"), F.lit("_")))
    found = docs(spark, sf_dir).select("doc_id", F.explode(annotate.chunks(F.array_join(rows, "\n"))).alias("x"))
    return found.select("doc_id", F.col("x.id").alias("chunk"), "x.head", "x.token.surf")


@query(f"""WITH {_LINES}, w AS (SELECT doc_id, line_no, regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+') AS w FROM lines)
SELECT doc_id, line_no, 'dep' AS rel, w[i] AS head_word, CAST(i AS INT) AS head, w[i + 1] AS word, CAST(i + 1 AS INT) AS dep FROM (SELECT doc_id, line_no, w, unnest(range(1, len(w))) AS i FROM w)""")
def typed_dependencies(spark, sf_dir):
    words = english.words_of(F.col("line"))
    typed = F.transform(F.slice(F.col("w"), F.lit(2), F.size("w")), lambda w, i: F.concat(F.lit("dep("), F.get("w", i), F.lit("-"), (i + 1).cast("string"), F.lit(", "), w, F.lit("-"), (i + 2).cast("string"), F.lit(")")))
    rows = lines(spark, sf_dir).select("doc_id", "line_no", words.alias("w")).filter("size(w) > 1").select("doc_id", "line_no", F.array_join(typed, "\n").alias("c"))
    return rows.select("doc_id", "line_no", F.explode(annotate.typed_dependencies(F.col("c"))).alias("d")).select("doc_id", "line_no", "d.*")


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents),
k AS (SELECT *, '[ <\\[〔【]*T[ .,''　]*h[ .,''　]*e[ .,''　]*re.*$' AS p FROM l),
m AS (SELECT doc_id, max(i) AS cut_at FROM k WHERE regexp_matches(line, p) GROUP BY doc_id),
s AS (SELECT k.*, cut_at, CASE WHEN i = cut_at THEN length(regexp_extract(line, '^(.*?)' || p, 1)) WHEN i > cut_at THEN 0 ELSE length(line) END AS n FROM k LEFT JOIN m USING (doc_id))
SELECT doc_id, md5(string_agg(line[:n], chr(10) ORDER BY i) FILTER (WHERE cut_at IS NULL OR i <= cut_at)) AS main, md5(coalesce(string_agg(line[n + 1:], chr(10) ORDER BY i) FILTER (WHERE i >= cut_at), '')) AS rest FROM s GROUP BY doc_id""")
def paper_divide(spark, sf_dir):
    """Documents cut where a spaced key stands last in a line."""
    return docs(spark, sf_dir).select("doc_id", papers.divide_text(F.col("text"), ["There"]).alias("d")).select("doc_id", F.md5("d.main").alias("main"), F.md5("d.rest").alias("rest"))


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents),
m AS (SELECT doc_id, max(i) AS cut_at FROM l WHERE regexp_matches(line, '^The\\b') GROUP BY doc_id)
SELECT doc_id, CASE WHEN cut_at IS NULL THEN length(text) WHEN cut_at = 0 THEN 0 ELSE length(array_to_string(string_split(text, chr(10))[1:cut_at], chr(10))) + 1 END AS n_main, CASE WHEN cut_at IS NULL THEN 0 ELSE length(array_to_string(string_split(text, chr(10))[cut_at + 1:], chr(10))) END AS n_rest FROM documents LEFT JOIN m USING (doc_id)""")
def document_divide(spark, sf_dir):
    """Documents cut at their last line that opens with a pattern."""
    cut = docs(spark, sf_dir).select("doc_id", papers.divide_text(F.col("text"), [], ["^The\\b"]).alias("d"))
    return cut.select("doc_id", F.length("d.main").cast("bigint").alias("n_main"), F.length("d.rest").cast("bigint").alias("n_rest"))


#: Crawler headers made from the events: their url, status, date and marks are what the queries must find again.
_CODE = "CASE event_id % 5 WHEN 0 THEN 404 WHEN 1 THEN 503 ELSE 200 END"


def crawled(spark, sf_dir):
    e = F.col("event_id")
    code = F.when(e % 5 == 0, 404).when(e % 5 == 1, 503).otherwise(200).cast("string")
    date = F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss")
    line = F.when(e % 3 > 0, F.concat(F.lit("HTML http://h.example/"), e.cast("string"), F.when(e % 3 == 1, " NOCACHE").otherwise(""), F.when(e % 7 == 0, " NOINDEX").otherwise(""), F.lit("\n"))).otherwise("")
    head = F.concat(line, F.lit("HTTP/1.1 "), code, F.lit(" Said\nDate: "), date, F.lit(" GMT\n\n"))
    body = F.concat(F.lit("<html>"), F.col("event_type"), F.lit("</html>"))
    return table(spark, sf_dir, "events").select("event_id", F.concat(head, body).alias("c"), F.concat(date, F.lit(" GMT")).alias("date"))


@query(f"SELECT event_id, CAST({_CODE} AS INT) AS code FROM events WHERE {_CODE} <> 200")
def http_status(spark, sf_dir):
    return filters.bad_status(crawled(spark, sf_dir), "event_id", "c")


@query("""SELECT event_id, CASE WHEN event_id % 3 > 0 THEN 'http://h.example/' || event_id END AS url, event_id % 3 = 1 AS no_cache, event_id % 3 > 0 AND event_id % 7 = 0 AS no_index, '<html>' || event_type || '</html>' AS body, strftime(ts, '%Y-%m-%d %H:%M:%S') || ' GMT' AS crawl_time FROM events""")
def crawl_header(spark, sf_dir):
    head = readers.crawler_header(F.col("c"))
    return crawled(spark, sf_dir).select("event_id", *[head[x].alias(x) for x in ("url", "no_cache", "no_index", "body", "crawl_time")])


@query("SELECT event_id, CASE WHEN event_id % 9 > 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') || ' GMT' END AS t FROM events")
def http_date(spark, sf_dir):
    """Dates of all events; every ninth is none."""
    return crawled(spark, sf_dir).select("event_id", text.http_date(F.when(F.col("event_id") % 9 == 0, "yesterday").otherwise(F.col("date"))).alias("t"))


def _upper_wide(x: str) -> str:
    return f"translate(replace(replace(upper({x}), 'ß', 'SS'), 'ẞ', 'SS'), {_HALF}, {_FULL})"


@query(f"""WITH d AS (SELECT doc_id, source, lang, text AS t FROM documents)
SELECT doc_id, {_upper_wide("source || ' ' || doc_id")} AS title, {_upper_wide('lang')} || '/' || {_upper_wide('source')} AS authors,
 md5(array_to_string(list_filter(list_transform(string_split(t, '|'), lambda x: {_upper_wide('trim(x)')}), lambda x: x <> ''), '/')) AS abstract, {_upper_wide('lang')} || '/' || {_upper_wide('source')} AS keywords FROM d""")
def paper_metadata(spark, sf_dir):
    """Metadata made from the documents: title and authors from their columns, the text as the abstract."""
    c = F.concat(F.lit("<TITLE> "), "source", F.lit(" "), F.col("doc_id").cast("string"), F.lit("</TITLE><AUTH><AUTH_NAME>"), "lang", F.lit("</AUTH_NAME><AUTH_NAME> "), "source", F.lit("</AUTH_NAME></AUTH><ABST>"), "text", F.lit("</ABST><KYWD>"), "lang", F.lit(", "), "source", F.lit("</KYWD>"))
    rows = docs(spark, sf_dir).select("doc_id", papers.parse_metadata(c).alias("m"))
    return rows.select("doc_id", "m.title", F.array_join("m.authors", "/").alias("authors"), F.md5(F.array_join("m.abstract", "/")).alias("abstract"), F.array_join("m.keywords", "/").alias("keywords"))


@query("SELECT doc_id, regexp_replace(text, '[\\x00-\\x09\\x0b-\\x1f\\x7f-\\x{9f}]', '', 'g') AS a, regexp_replace(text, '\\s+', '', 'g') AS b FROM documents")
def control_characters(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", text.delete_controls(F.col("text")).alias("a"), text.delete_blanks(F.col("text")).alias("b"))
