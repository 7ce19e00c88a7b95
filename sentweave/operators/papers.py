"""Papers, their metadata and tags, and medical reports."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentweave.functions import text
from sentweave.sources import ordered

#: Keys of reference lists and acknowledgements; what follows a + must come later in the line.
REFERENCE_KEYS = ["参考文献", "引用文献", "文献＋pp", "文献＋pages", "文献＋Proc"]
REFERENCE_PATTERNS = ["[Rr]eferences? 1", "[Rr]eferences? \\[ 1", "[Rr]eference＋pp\\.", "[Rr]eference＋Vol\\.", "REFERENCES? 1", "REFERENCES? \\[ 1", "REFERENCE＋pp\\.", "REFERENCE＋Vol\\."]
THANKS_PATTERNS = ["謝辞＋感謝", "謝辞＋謝意", "謝辞＋深謝", "謝辞＋本論文", "謝辞＋本研究", "謝辞＋援助", "謝辞＋協力", "[Aa]cknowledgement＋[Tt]hank", "[Aa]cknowledgement＋acknowledge", "[Aa]cknowledgement＋grateful", "ACKNOWLEDGEMENT＋[Tt]hank", "ACKNOWLEDGEMENT＋acknowledge", "ACKNOWLEDGEMENT＋grateful"]
#: What may stand between the first letters of a key, and right before a key as part of what it opens.
GAP, LEAD = "[ .,'　]", "[ <\\[〔【]"


def _key_patterns(keys: list[str], patterns: list[str]) -> list[str]:
    """Regular expressions of whole lines, with what stands before the key and what it opens as groups."""
    literal = lambda s: "".join(f"\\x{{{ord(ch):x}}}" for ch in s)
    out = []
    for key, spaced in [(k, True) for k in keys] + [(p, False) for p in patterns]:
        main, plus, sub = key.partition("＋")
        if spaced:
            main = f"{GAP}*".join(literal(x) for x in [*main[:3], main[3:]] if x)
            sub = literal(sub)
        out.append(f"^(.*?)({LEAD}*{main}{f'.+{sub}' if plus else ''}.*)$")
    return out


def divide_text(c: Column, keys: list[str], patterns: list[str] = ()) -> Column:
    """``struct<main, rest>``: the article up to the last place in a line that a key opens, and from there on.

    ``keys`` are literal (blanks and points may stand between their first four letters), ``patterns`` regular expressions;
    ``a＋b`` means a with b later in the line. The first key that a line has counts.
    """
    found = _key_patterns(list(keys), list(patterns))
    opens = lambda line: F.coalesce(*[F.when(line.rlike(p), F.length(F.regexp_extract(line, p, 1))) for p in found])
    places = lambda lines: F.filter(F.transform(lines, lambda line, i: F.struct(i.alias("i"), opens(line).alias("n"))), lambda h: h["n"].isNotNull())
    uncut = F.struct(c.alias("main"), F.lit("").alias("rest"))

    def cut(lines: Column, hit: Column) -> Column:
        line = F.get(lines, hit["i"])
        main = F.concat(F.slice(lines, F.lit(1), hit["i"]), F.array(F.substring(line, F.lit(1), hit["n"])))
        rest = F.concat(F.array(F.substring(line, hit["n"] + 1, F.length(line))), F.slice(lines, hit["i"] + 2, F.size(lines)))
        return F.when(hit.isNull(), uncut).otherwise(F.struct(F.array_join(main, "\n").alias("main"), F.array_join(rest, "\n").alias("rest")))

    return text.bind(F.split(c, "\n"), lambda lines: text.bind(F.get(F.reverse(places(lines)), F.lit(0)), lambda hit: cut(lines, hit)))


def paper_page(c: Column, references: list[str] = REFERENCE_KEYS, thanks: list[str] = (), reference_patterns: list[str] = REFERENCE_PATTERNS, thanks_patterns: list[str] = THANKS_PATTERNS) -> Column:
    """An article as a page with blocks for the main text, acknowledgements and references."""
    first = divide_text(text.drop_ocr_noise(c), references, reference_patterns)
    second = divide_text(first["main"], thanks, thanks_patterns)
    block = lambda kind, body: F.when(body != "", F.concat(F.lit(f'<DIV myblocktype="{kind}">'), escape(body), F.lit("</DIV>\n"))).otherwise(F.lit(""))
    return F.concat(F.lit("<HTML><BODY>\n"), block("maintext", second["main"]), block("acknowledgement", second["rest"]), block("reference", first["rest"]), F.lit("</BODY></HTML>"))


def report_page(**parts: Column) -> Column:
    """A page with a block for each part that isn't empty."""
    blocks = [F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(f'<DIV myblocktype="{name}">'), escape(c), F.lit("</DIV>\n"))).otherwise(F.lit("")) for name, c in parts.items()]
    return F.concat(F.lit("<HTML><BODY>\n"), *blocks, F.lit("</BODY></HTML>"))


def escape(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def parse_metadata(c: Column) -> Column:
    """``struct<title, authors, abstract, keywords>`` of tagged metadata: upper case, full width; abstract by sentence."""
    one = lambda tag: F.regexp_extract(c, f"(?s)<{tag}>(.*?)</{tag}>", 1)
    norm = lambda x: text.join_japanese(text.upper_wide(F.trim(x)))
    full = lambda a: F.filter(F.transform(a, norm), lambda x: x != "")
    abstract = F.split(one("ABST"), "(?<=[。．])|\\|")
    return F.struct(norm(one("TITLE")).alias("title"), full(F.regexp_extract_all(c, F.lit("(?s)<AUTH_NAME>(.*?)</AUTH_NAME>"), F.lit(1))).alias("authors"), full(abstract).alias("abstract"), full(F.split(one("KYWD"), "[,，、;；]")).alias("keywords"))


def with_metadata(docs: DataFrame, metadata: DataFrame, aliases: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Documents with their metadata row, by their own id or else by its other name in ``(a, b)``, either way round."""
    other = aliases.select(F.col("a").alias("_id"), F.col("b").alias("_alias")).unionByName(aliases.select(F.col("b").alias("_id"), F.col("a").alias("_alias")))
    other = other.groupBy("_id").agg(F.min("_alias").alias("_alias"))
    own = metadata.select(F.col("id").alias("_id"), F.col("meta").alias("_own"))
    there = metadata.select(F.col("id").alias("_alias"), F.col("meta").alias("_there"))
    keyed = docs.withColumn("_id", F.col(id_col).cast("string"))
    joined = keyed.join(own, "_id", "left").join(other, "_id", "left").join(there, "_alias", "left")
    return joined.select(*docs.columns, F.coalesce("_own", "_there").alias("meta"))


def tags_by_both_names(tags: DataFrame, aliases: DataFrame, key: str = "fid") -> DataFrame:
    """Tag rows under their own id and under its other name."""
    named = tags.join(aliases.select(F.col("a").alias(key), F.col("b").alias("_b")), key).withColumn(key, F.col("_b")).drop("_b")
    return tags.unionByName(named.select(*tags.columns)).distinct()


def tag_lines(lines: DataFrame) -> DataFrame:
    """``(fid, type, pattern, string)`` of the match lines among ``ordered.lines``, each under the paper line before it in its file."""
    fid = F.nullif(F.regexp_extract("value", "^<PAPER\\b.*source=\"?([^\".>\\s]+)", 1), F.lit(""))
    marked = ordered.carry(lines.withColumn("fid", fid), last=("fid",)).filter(F.col("value").startswith("<MATCH"))
    part = lambda name: F.regexp_extract("value", f"\\b{name}=\"?([^\"\\s>]+)", 1)
    return marked.select("fid", part("type").alias("type"), part("pattern_type").alias("pattern"), F.regexp_extract("value", ">(.*)</MATCH>", 1).alias("string"))


def tag_spans(tokens: Column, tag: Column) -> Column:
    """Where the token sequence spells the tag: ``B:i,E:j`` token numbers from 0, joined by ``/``; empty if nowhere.

    The tag must start where a token starts and end where one ends.
    """
    size = F.length(tag)
    begin = F.struct(F.lit(0).alias("n"), F.array(F.lit(0)).alias("ends"))
    ends = F.aggregate(tokens, begin, lambda s, t: F.struct((s["n"] + F.length(t)).alias("n"), F.array_append(s["ends"], s["n"] + F.length(t)).alias("ends")))["ends"]
    opens = F.filter(F.transform(tokens, lambda t, i: F.when(F.startswith(tag, t), i)), lambda i: i.isNotNull())  # few tokens spell the tag's start

    def spans(known: Column) -> Column:
        spelt = F.filter(opens, lambda i: known["whole"].substr(F.get(known["ends"], i) + 1, size) == tag)
        return F.transform(spelt, lambda i: F.struct(i.alias("i"), (F.array_position(known["ends"], F.get(known["ends"], i) + size) - 2).alias("j")))

    found = F.filter(text.bind(F.struct(F.array_join(tokens, "").alias("whole"), ends.alias("ends")), spans), lambda s: s["j"] >= s["i"])
    shown = F.transform(found, lambda s: F.concat(F.lit("B:"), s["i"].cast("string"), F.lit(",E:"), s["j"].cast("string")))
    return F.when(size > 0, F.array_join(shown, "/")).otherwise(F.lit(""))
