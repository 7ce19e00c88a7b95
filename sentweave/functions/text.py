"""Cleaning and normalising of text: row-local column expressions."""

from html.entities import html5, name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Named character entities as HTML defines them, from Python's own table: those of HTML 4 with their semicolon, and the oldest without it too.
ENTITIES = {f"{name};": chr(code) for name, code in name2codepoint.items()} | {name: char for name, char in html5.items() if not name.endswith(";")} | {"apos;": "'"}
#: A character reference, by name or number.
REFERENCE = "&(?:#[0-9]{1,7};?|#[xX][0-9a-fA-F]{1,6};?|[a-zA-Z][a-zA-Z0-9]{1,31};?)"
#: Half-width katakana in code order, what each widens to, and the marks that join the letter before them.
HALF_KANA = "｡｢｣､･ｦｧｨｩｪｫｬｭｮｯｰｱｲｳｴｵｶｷｸｹｺｻｼｽｾｿﾀﾁﾂﾃﾄﾅﾆﾇﾈﾉﾊﾋﾌﾍﾎﾏﾐﾑﾒﾓﾔﾕﾖﾗﾘﾙﾚﾛﾜﾝﾞﾟ"
FULL_KANA = "。「」、・ヲァィゥェォャュョッーアイウエオカキクケコサシスセソタチツテトナニヌネノハヒフヘホマミムメモヤユヨラリルレロワン゛゜"
VOICED = {"ｶ": "ガ", "ｷ": "ギ", "ｸ": "グ", "ｹ": "ゲ", "ｺ": "ゴ", "ｻ": "ザ", "ｼ": "ジ", "ｽ": "ズ", "ｾ": "ゼ", "ｿ": "ゾ", "ﾀ": "ダ", "ﾁ": "ヂ", "ﾂ": "ヅ", "ﾃ": "デ", "ﾄ": "ド", "ﾊ": "バ", "ﾋ": "ビ", "ﾌ": "ブ", "ﾍ": "ベ", "ﾎ": "ボ", "ｳ": "ヴ"}
SEMI_VOICED = {"ﾊ": "パ", "ﾋ": "ピ", "ﾌ": "プ", "ﾍ": "ペ", "ﾎ": "ポ"}
#: Characters that EUC-JP can't hold, and their stand-ins.
UNSAFE, SAFE = "－～∥￠￡￢—¥", "−〜‖¢£¬―￥"
#: Fixed ranges of full-width characters between which blanks are dropped.
WIDE = "[\\u3000-\\u3002\\u30fb-\\uff1b\\u309b-\\u9fa0]"
ASCII = "".join(chr(c) for c in range(0x21, 0x7F))
WIDE_ASCII = "".join(chr(c + 0xFEE0) for c in range(0x21, 0x7F))


def replace_all(c: Column, *pairs: tuple[str, str]) -> Column:
    """Regular-expression replacements, one after the other."""
    for pattern, by in pairs:
        c = F.regexp_replace(c, pattern, by)
    return c


def bind(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once: inside lambdas an expression would be worked out for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def is_blank(c: Column) -> Column:
    """True for a segment of white space and full-width blanks only."""
    return c.rlike("^[\\u3000\\s]*$")


def decode_entities(c: Column) -> Column:
    """Non-breaking blanks become blanks, then character references are decoded, once: by name, decimal or hexadecimal number.

    What names no character stays as it is; a number that is none becomes U+FFFD.
    """
    known = F.map_from_arrays(*[F.split(F.lit("\n".join(x)), "\n") for x in (ENTITIES, ENTITIES.values())])  # folded to one constant

    def decoded(p: Column) -> Column:
        hexadecimal = F.conv(F.regexp_extract(p, "^&#[xX]([0-9a-fA-F]+)", 1), 16, 10)
        number = F.when(p.rlike("^&#[xX]"), hexadecimal).otherwise(F.regexp_extract(p, "^&#([0-9]+)", 1))
        named = F.coalesce(F.try_element_at(known, F.substring(p, 2, 40)), p)
        return F.when(p.rlike("^&#"), F.when(F.regexp_like(p, F.lit(f"^{REFERENCE}$")), _char(number)).otherwise(p)).when(F.length(p) > 1, named).otherwise(p)

    blank = F.regexp_replace(c, "&(#160|#[xX][aA]0|nbsp);", " ")
    pieces = F.transform(F.regexp_extract_all(blank, F.lit(f"{REFERENCE}|[^&]+|&"), F.lit(0)), lambda p: F.when(p.startswith("&"), decoded(p)).otherwise(p))
    return F.when(c.contains("&"), F.array_join(pieces, "")).otherwise(c)


def _char(number: Column) -> Column:
    """The character of a code point, by its UTF-32 bytes; an impossible one becomes U+FFFD."""
    n = number.try_cast("bigint")
    good = (n > 0) & (n < 0x110000) & ~n.between(0xD800, 0xDFFF)
    return F.when(good, F.decode(F.unhex(F.lpad(F.hex(F.when(good, n).otherwise(F.lit(0xFFFD))), 8, "0")), "UTF-32")).otherwise(F.lit("\ufffd"))


def delete_controls(c: Column) -> Column:
    """Control characters go, all but line feed."""
    return F.regexp_replace(c, "[\\x00-\\x09\\x0b-\\x1f\\x7f-\\x9f]", "")


def trim_wide(c: Column) -> Column:
    """Without half- and full-width blanks at both ends."""
    return replace_all(c, ("^[\\u3000\\s]+", ""), ("[\\u3000\\s]+$", ""))


def paragraphs(c: Column, is_title: Column | None = None) -> Column:
    """Line feeds at the ends go, one alone becomes a blank, two or more cut paragraphs (a title is never cut)."""
    c = replace_all(c, ("^\\n+", ""), ("\\n+$", ""))
    cut = F.transform(F.split(c, "\\n{2,}"), lambda p: F.replace(p, F.lit("\n"), F.lit(" ")))
    return cut if is_title is None else F.when(is_title, F.array(F.regexp_replace(c, "\\n+", " "))).otherwise(cut)


def drop_inner_blanks(c: Column) -> Column:
    """Blanks between two full-width characters, and between full- and half-width ones, go."""
    single = f" (?:(?<={WIDE} )(?=[{WIDE}\\x21-\\x7e])|(?<=[\\x21-\\x7e] )(?={WIDE}))"  # begins with the blank, so that other places cost little
    runs = ((f"(?<={WIDE}) +(?=[{WIDE}\\x21-\\x7e])", ""), (f"(?<=[\\x21-\\x7e]) +(?={WIDE})", ""))
    return bind(c, lambda v: F.when(v.contains("  "), replace_all(v, *runs)).otherwise(F.regexp_replace(v, single, "")))


def squeeze_blanks(c: Column, preformatted: bool = True) -> Column:
    """Runs of blanks: one stays between ASCII letters and digits and longer ones elsewhere go (preformatted), or all become one."""
    if not preformatted:
        return F.regexp_replace(c, "\\s+", " ")
    runs = (("(?<=[a-zA-Z0-9]) +(?=[a-zA-Z0-9])", " "), (" {2,}", ""))
    return bind(c, lambda v: F.when(v.contains("  "), replace_all(v, *runs)).otherwise(v))


def widen(c: Column) -> Column:
    """Half-width ASCII, blanks and katakana become full-width; voiced marks join their letter."""

    def joined(v: Column) -> Column:
        out = v
        for marks, mark in ((VOICED, "ﾞ"), (SEMI_VOICED, "ﾟ")):
            for half, full in marks.items():
                out = F.replace(out, F.lit(half + mark), F.lit(full))
        return F.when(v.contains("ﾞ") | v.contains("ﾟ"), out).otherwise(v)

    c = bind(c, joined)
    return F.translate(c, ASCII + " " + HALF_KANA, WIDE_ASCII + "　" + FULL_KANA)


def narrow_ascii(c: Column) -> Column:
    """Full-width ASCII and blanks become half-width."""
    return F.translate(c, WIDE_ASCII + "　", ASCII + " ")


def kana_long_mark(c: Column) -> Column:
    """A hyphen-like character after katakana becomes the long-vowel mark, and so do all that follow it."""
    return F.regexp_replace(c, "(\\p{IsKatakana}ー*+|\\G(?!^)ー*+)[―−─━‐]", "$1ー")


def remap_unsafe(c: Column) -> Column:
    return F.translate(c, UNSAFE, SAFE)


def range_tilde(c: Column) -> Column:
    """An overline between numbers, or between numbers with one and the same unit of one or two characters, is a range mark."""
    marks = (("([０-９0-9])￣(?=[０-９0-9])", "$1〜"), ("([０-９0-9])([^０-９0-9￣]{1,2})￣([０-９0-9]+)\\2", "$1$2〜$3$2"))
    return bind(c, lambda v: F.when(v.contains("￣"), replace_all(v, *marks)).otherwise(v))


def normalise_japanese(c: Column, preformatted: bool = True) -> Column:
    """The normalisation of a Japanese segment: blanks, widths, long marks, remapping, ranges."""
    return range_tilde(remap_unsafe(kana_long_mark(widen(squeeze_blanks(drop_inner_blanks(c), preformatted)))))


def upper_wide(c: Column) -> Column:
    """Upper case and full width, as metadata is kept."""
    return widen(F.upper(c))


def join_japanese(c: Column) -> Column:
    """Blanks between Japanese characters go."""
    japanese = "[\\p{IsHan}\\p{IsHiragana}\\p{IsKatakana}ー]"
    return F.regexp_replace(c, f"(?<={japanese})[ \\u3000]+(?={japanese})", "")


def drop_ocr_noise(c: Column) -> Column:
    """Single Japanese letters that stand alone between Latin words, and whatever follows an English abstract heading, go."""
    c = F.regexp_replace(c, "(?<=[A-Za-z] )[\\p{IsHiragana}\\p{IsKatakana}](?= [A-Za-z])", "")
    return F.regexp_replace(c, "(?s)\\n(Abstract|ABSTRACT)\\b.*?(?=\\n\\p{IsHan})", "")


def delete_blanks(c: Column) -> Column:
    return F.regexp_replace(c, "\\s+", "")


def escape_bare_ampersands(c: Column) -> Column:
    """Each ``&`` that starts no ``&amp`` becomes ``&amp;``."""
    return F.regexp_replace(c, "&(?!amp)", "&amp;")


def valid_utf8(c: Column) -> Column:
    """Bytes as text; what isn't UTF-8 becomes U+FFFD."""
    return F.make_valid_utf8(c.cast("string"))


def http_date(c: Column) -> Column:
    """``Tue, 03 Jul 2007 10:00:00 GMT`` as ``2007-07-03 10:00:00 GMT``; null where it's no such date."""
    day = F.regexp_replace(F.trim(c), "^\\w+, +", "")
    at = F.try_to_timestamp(F.regexp_replace(day, " *[A-Z]{2,5}$", ""), F.lit("d MMM yyyy HH:mm:ss"))
    return F.when(at.isNotNull(), F.concat_ws(" ", F.date_format(at, "yyyy-MM-dd HH:mm:ss"), F.nullif(F.regexp_extract(day, "([A-Z]{2,5})$", 1), F.lit(""))))
