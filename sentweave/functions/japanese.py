"""Japanese sentences, scores and brackets.

Scores and rules are column expressions. Splitting needs a state that goes on through a text (open brackets, what the last
sentence was), so each text is split in one linear pass of an Arrow function.
"""

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from sentweave.functions.batches import sliced

#: Sentence ends, brackets, full-width letters and digits, item headers.
ENDS, OPEN, CLOSE = "。？！♪…", "（〔［｛＜≪「『【([{", "）〕］｝＞≫」』】)]}"
WIDE_ALNUM = "[Ａ-Ｚａ-ｚ０-９]"
ITEM = WIDE_ALNUM + "．"
CLOSERS = "[）〕］｝＞≫」』】)\\]}]"
CUT = f"(?:[{ENDS}]|・{{3,}}|(?<!{WIDE_ALNUM})．(?!{WIDE_ALNUM[:-1]}，]))[．{ENDS}]*"
#: Faces and marks that end a laugh, a tear or anger.
EMOTICONS = ["（＊＾−＾＊）", "（＾＾；）", "（＞▽＜）", "（ｖｖ）", "＼（＾ｏ＾）／", "（＾□＾；）", "（＾＿＾）", "＾＾", "（−＿−；）", "＾＾；）", "（＞＜）", "＾＾；", "＞＜", "ヾ（＊　´∀｀＊）ノ”", "（´д｀）", "（　´д｀）", "（＞◆＜）", "（汗）", "（笑）", "（爆）"]
MARKS = ["（笑）", "（爆）", "（怒）", "（汗）", "（泣）", "（涙）"]
#: Marks that open a heading or a list line, enumerations that stay, characters of menu bars.
LINE_MARKS = "□■◇◆▽△▼▲○◎●〇◯★☆・＜《【［"
ENUMERATION = ["１", "２", "３", "４", "５", "６", "７", "８", "９"]
PARTICLES = "がをにはので"
JAPANESE = "[\\p{IsHiragana}\\p{IsKatakana}ー\\p{IsHan}\\p{P}]"
JAPANESE_LETTERS = "[\\p{IsHiragana}\\p{IsKatakana}ー\\p{IsHan}]"


def _alternatives(words: list[str]) -> str:
    """The words as a pattern, longest first, so that the longest match wins."""
    quoted = ["".join(f"[{c}]" if c not in "＾^" else c for c in w) for w in sorted(set(words), key=len, reverse=True)]
    return "(?:" + "|".join(quoted) + ")"


FACES = _alternatives(EMOTICONS + MARKS)
FACES_BY_LENGTH = sorted(set(EMOTICONS + MARKS), key=lambda f: (-len(f), f))
_FACES = re.compile(f"(?:{FACES})+")


def _share(found: Column, of: Column) -> Column:
    """``found / of`` to five decimals, an exact half upwards; rounded as a whole number, so that no machine's fractions decide. Null of nothing."""
    n, of = found.cast("bigint"), of.cast("bigint")
    return F.floor((n * 200_000 + of) / F.nullif(of * 2, F.lit(0))) / 100_000


def japanese_score(c: Column, punctuation: bool = True) -> Column:
    """Share of kana, kanji and (by default) punctuation, to five decimals; 0 for an empty string."""
    found = F.regexp_count(c, F.lit(JAPANESE if punctuation else JAPANESE_LETTERS))
    return F.when(F.length(c) == 0, F.lit(0.0)).otherwise(_share(found, F.length(c)))


def particle_ratio(c: Column, doubled: bool = False) -> Column:
    """Particles for each character, null for an empty text; ``doubled``: over about twice the characters (a known variant)."""
    n = F.length(c)
    return _share(F.regexp_count(c, F.lit(f"[{PARTICLES}]")), n + n if doubled else n)


_END = re.compile(CUT)
_OPEN, _BRACKET = set(OPEN), re.compile(f"[{re.escape(OPEN + CLOSE)}]")
_LEAD = re.compile("^(（.+?）)(.+)$", re.S)
_CLOSERS, _ITEM = re.compile(f"{CLOSERS}*"), re.compile(f"^{ITEM}$")
_STRANGE = re.compile(f"([！？]|{CLOSERS})$")
_BLANKS = " \t\n\x0b\x0c\r\u3000"


def _pieces(text: str) -> list[tuple[str, str]]:
    """The text cut after each candidate end, as (body, end); the last one may have no end."""
    out, at = [], 0
    for m in _END.finditer(text):
        out.append((text[at : m.start()], m.group()))
        at = m.end()
    return out + ([(text[at:], "")] if at < len(text) else [])


def _outside_brackets(text: str) -> list[str]:
    """Cut at ends outside brackets; a run of middle dots alone ends nothing."""
    out, open_, level = [], [], 0
    for body, end in _pieces(text):
        for ch in _BRACKET.findall(body):
            if ch in _OPEN:
                level += 1
            elif level:
                level -= 1
        open_ += [body, end]
        if end and not level and (body or not end.startswith("・")):
            out.append("".join(open_))
            open_ = []
    return [s for s in [*out, "".join(open_)] if s]


def sentences_of(text: str) -> list[str]:
    """Sentences of a paragraph: cut at ends outside brackets; a bracketed remark that opens a sentence stands alone."""
    apart: list[str] = []
    for s in _outside_brackets(text):
        lead = _LEAD.match(s)
        apart += [a + b for a, b in _pieces(lead[1])] + [lead[2]] if lead else [s]
    closed: list[list[str]] = []  # parts of each sentence, put together at the end
    odd: list[bool] = []
    for s in (x.strip(_BLANKS) for x in apart):
        if not s:
            continue
        closers = _CLOSERS.match(s)[0]
        if not closed:
            closed.append([s])
            odd.append(s.count("”") % 2 == 1)
        elif (odd[-1] and s.count("”") % 2) or (len(closed[-1]) == 1 and _ITEM.match(closed[-1][0])):  # halves of a pair, a lone item header
            closed[-1].append(s)
            odd[-1] = odd[-1] != (s.count("”") % 2 == 1)
        else:
            if closers:  # closing brackets that open a sentence go back
                closed[-1].append(closers)
                s = s[len(closers) :]
            if s:
                closed.append([s])
                odd.append(s.count("”") % 2 == 1)
    out: list[list[str]] = []
    for s in map("".join, closed):
        # と, っ or です after ！, ？ or a closing bracket go on with the sentence, and so do と, や, の after an item header
        goes_on = out and ((s.startswith(("と", "っ", "です")) and _STRANGE.search(out[-1][-1])) or (s.startswith(("と", "や", "の")) and re.search(f"{ITEM}$", out[-1][-1])))
        out[-1].append(s) if goes_on else out.append([s])
    return ["".join(x) for x in out]


def with_faces_apart(sentences: list[str]) -> list[str]:
    """Sentences end after faces and laugh marks; marks in a row stay together; blanks at the ends go."""
    cut = (part.strip(_BLANKS) for s in sentences for part in _FACES.sub(lambda m: m[0] + "\n", s).split("\n"))
    return [s for s in cut if s]


def items_merged(sentences: list[str]) -> list[str]:
    """After a sentence that ends with 、 ， or ：, item lines (Ａ．) and the first other line join it, with a full-width blank between."""
    out: list[list[str]] = []
    listing = False
    for s in sentences:
        if listing and out:
            out[-1].append(s)
        else:
            out.append([s])
        if not re.match(ITEM, s):
            listing = s.endswith(("、", "，", "："))
    return ["　".join(x) for x in out]


def _over(work: Callable, kind: pa.DataType):
    """An Arrow function that does ``work`` on each value; null stays null."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in sliced(batches):
            yield pa.array([None if v is None else work(v) for v in batch.to_pylist()], kind)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return run


_STRINGS = pa.list_(pa.string())


def split_japanese(c: Column) -> Column:
    """Sentences of a paragraph; see :func:`sentences_of`."""
    return F.arrow_udf(_over(sentences_of, _STRINGS), "array<string>")(c)


def split_paragraphs(paragraphs: Column, merge_items: bool = True) -> Column:
    """For each paragraph of an array its sentences: split, cut at faces, with item lists merged where asked for."""
    finish = items_merged if merge_items else list
    work = lambda paras: [finish(with_faces_apart(sentences_of(p))) for p in paras if p is not None]
    return F.arrow_udf(_over(work, pa.list_(_STRINGS)), "array<array<string>>")(paragraphs)


def merge_items(sentences: Column) -> Column:
    """Item lists of an array of sentences joined to what announces them; see :func:`items_merged`."""
    return F.arrow_udf(_over(items_merged, _STRINGS), "array<string>")(sentences)


def split_at_emoticons(c: Column) -> Column:
    """Sentences end after faces and laugh marks; marks in a row stay together."""
    return F.filter(F.split(F.regexp_replace(c, f"((?:{FACES})++)", "$1\n"), "\n"), lambda s: s != "")


def has_emoticon(c: Column) -> Column:
    return c.rlike(FACES)


def mask_emoticons(c: Column) -> Column:
    """Faces and marks as private characters, one for each of their characters, so that positions stay."""
    for face in FACES_BY_LENGTH:
        c = F.replace(c, F.lit(face), F.lit("\ue001" * len(face)))
    return c


def bracket_type(c: Column) -> Column:
    """What a bracketed remark is: an age (digits only), a reading (hiragana only) or something else."""
    return F.when(c.rlike("^[０-９]*$"), "年齢").when(c.rlike("^\\p{IsHiragana}+$"), "読み").otherwise("その他")


def deletion_rule(c: Column, keep_marked: bool = False) -> Column:
    """The number of the first rule that deletes the whole sentence: 1 mark, 2 long or many 。, 3 dots, 4 menu bar, 5 kanji; null if none."""
    rule = F.when(F.lit(not keep_marked) & c.rlike(f"^　*[{LINE_MARKS}]"), 1)
    rule = rule.when(c.rlike("^.+。.+。.+。.+。.+。.+") | (F.length(c) >= 256), 2)
    return rule.when(c.rlike("^…+$"), 3).when(c.rlike("[｜┃]"), 4).when(c.rlike("^\\p{IsHan}*$"), 5)


def drop_leading_blank(c: Column) -> Column:
    return F.regexp_replace(c, "^　(――)?", "")


def brackets_of(text: str) -> tuple[list[tuple[int, str]], int]:
    """Bracketed remarks outside faces, as ``(position, text)``, and how many enumerations （１）（２）… in order there are, which are none."""
    masked = _faces_masked(text)
    found, level, at, number = [], 0, 0, 0
    for m in _ROUND.finditer(masked):
        if m[0] == "（":
            at = m.start() if not level else at
            level += 1
        elif level:
            level -= 1
            if not level:
                inner = masked[at + 1 : m.start()]
                if number < len(ENUMERATION) and inner == ENUMERATION[number]:
                    number += 1
                else:
                    found.append((at, inner))
    return found, number


def _faces_masked(text: str) -> str:
    for face in FACES_BY_LENGTH:
        text = text.replace(face, "\ue001" * len(face))
    return text


_ROUND = re.compile("[（）]")
_REMARKS = pa.struct([("found", pa.list_(pa.struct([("at", pa.int32()), ("text", pa.string())]))), ("enumerated", pa.int32())])


def _remarks(text: str) -> dict:
    found, number = brackets_of(text)
    return {"found": [{"at": at, "text": t} for at, t in found], "enumerated": number}


def _bare(text: str) -> str:
    out, at = [], 0
    for start, inner in brackets_of(text)[0]:
        out.append(text[at:start])
        at = start + len(inner) + 2
    return "".join([*out, text[at:]])


def brackets(c: Column) -> Column:
    """Bracketed remarks outside faces, in order: ``(position, text)``; a nested one is part of the outer one.

    Enumerations （１）（２）… in order are not remarks. ``enumerated`` says how many of them there are. One pass a text, over Arrow batches.
    """
    return F.arrow_udf(_over(_remarks, _REMARKS), "struct<found:array<struct<at:int,text:string>>,enumerated:int>")(c)


def without_brackets(c: Column) -> Column:
    """The sentence without its bracketed remarks."""
    return F.arrow_udf(_over(_bare, pa.string()), "string")(c)


def drop_newspaper_asides(c: Column) -> Column:
    """``＝…＝`` without 、 inside goes, and so does ``＝…`` at the end if it opens with 写真 or has no closing 。."""
    c = F.regexp_replace(c, "＝[^＝、]*＝", "")
    return F.regexp_replace(c, "＝(写真[^＝、]*|[^＝、]*[^＝、。])$", "")


def split_long(c: Column, least: int = 70) -> Column:
    """A sentence of ``least`` characters or more is cut after が、, であり、 or ており、 between 30 and 70 % of its length.

    The first half ends as a sentence of its own (であり → だ, ており → ている). Without a parser, the boundary nearest to the
    middle that the marks show is taken.
    """
    n = F.length(c)
    pattern = "(?s)^(.+?)(が|であり|ており)、(.+)$"
    left, mark, right = (F.regexp_extract(c, pattern, i) for i in (1, 2, 3))
    place = (F.length(left) + F.length(mark)) / n
    tail = F.when(mark == "であり", "だ。").when(mark == "ており", "ている。").otherwise("。")
    return F.when((n >= least) & (mark != "") & place.between(0.3, 0.7), F.array(F.concat(left, tail), right)).otherwise(F.array(c))
