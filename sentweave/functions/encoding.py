"""Charset decisions and transcoding: the declared charset natively, guesses and Japanese codecs over Arrow batches."""

import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from sentweave.functions.batches import sliced

#: Charset names that pages declare, with the language they speak for and the codec.
CHARSETS = {
    "iso-8859-1": ("english", "iso-8859-1"), "iso8859-1": ("english", "iso-8859-1"), "latin1": ("english", "iso-8859-1"), "windows-1252": ("english", "iso-8859-1"), "us-ascii": ("english", "ascii"), "ascii": ("english", "ascii"),
    "euc-jp": ("japanese", "euc-jp"), "x-euc-jp": ("japanese", "euc-jp"), "eucjp": ("japanese", "euc-jp"),
    "shift_jis": ("japanese", "shiftjis"), "shift-jis": ("japanese", "shiftjis"), "x-sjis": ("japanese", "shiftjis"), "sjis": ("japanese", "shiftjis"), "windows-31j": ("japanese", "shiftjis"),
    "iso-2022-jp": ("japanese", "7bit-jis"), "utf-8": ("japanese", "utf8"), "utf8": ("japanese", "utf8"),
}
CODECS = {"ascii": "ascii", "iso-8859-1": "cp1252", "euc-jp": "euc_jp", "shiftjis": "cp932", "7bit-jis": "iso2022_jp", "utf8": "utf-8"}
MAGIC = b"\x1f\x8b"
META = "(?is)<meta[^>]*charset\\s*=\\s*[\"']?\\s*([a-z0-9_-]+)"


def declared_charset(html: Column) -> Column:
    """The charset that the page's meta tag names, lower-cased; null without one."""
    return F.nullif(F.lower(F.regexp_extract(html, META, 1)), F.lit(""))


def charset_info(name: Column) -> Column:
    """``(language, encoding)`` of a charset name; null for charsets that aren't handled."""
    table = F.create_map(*[x for k, (lang, enc) in CHARSETS.items() for x in (F.lit(k), F.struct(F.lit(lang).alias("language"), F.lit(enc).alias("encoding")))])
    return F.try_element_at(table, F.coalesce(name, F.lit("")))


def guess(raw: bytes | None) -> str | None:
    """ascii, or the first of 7bit-jis, euc-jp, shiftjis and utf8 that decodes the bytes strictly; null if none does."""
    if raw is None:
        return None
    if raw.isascii():
        return "7bit-jis" if b"\x1b$" in raw else "ascii"
    for name in ("euc-jp", "shiftjis", "utf8"):
        try:
            raw.decode(CODECS[name])
            return name
        except UnicodeDecodeError:
            pass
    return None


def _guesses(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in sliced(batches):
        yield pa.array([guess(b) for b in batch.to_pylist()], pa.string())


def guess_encoding(raw: Column) -> Column:
    return F.arrow_udf(_guesses, "string")(raw)


def resolve_encoding(raw: Column, forced: str | None = None, given: Column | None = None, language: str = "japanese") -> Column:
    """The encoding of page bytes: forced, given, declared or guessed, in that order; null if it isn't the language asked for.

    Pure ASCII speaks for English, and so do the Latin charsets; UTF-8 serves either language.
    """
    if forced:
        return F.lit(forced)
    text = raw.cast("string")
    declared = charset_info(declared_charset(text))
    encoding = F.coalesce(*([charset_info(F.lower(given))["encoding"]] if given is not None else []), declared["encoding"], guess_encoding(raw))
    english = encoding.isin("ascii", "iso-8859-1")
    return F.when((encoding == "utf8") | (english == F.lit(language == "english")), encoding)


def normalise_nfkc(c: Column) -> Column:
    """Compatibility forms as their plain characters (NFKC)."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pc.utf8_normalize(batch, "NFKC")

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "string")(c)


def _decodes(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for raw, name in sliced(batches):
        yield pa.array([None if r is None or n not in CODECS else r.decode(CODECS[n], "replace") for r, n in zip(raw.to_pylist(), name.to_pylist())], pa.string())


def decode(raw: Column, encoding: Column) -> Column:
    """Bytes as text by the named encoding; bytes that don't fit become U+FFFD. UTF-8 and ASCII never leave the JVM's side."""
    return F.when(encoding.isin("utf8", "ascii"), F.make_valid_utf8(raw.cast("string"))).otherwise(F.arrow_udf(_decodes, "string")(raw, encoding))


def encode(c: Column, name: str) -> Column:
    """Text as bytes of this charset; what it doesn't have becomes a question mark."""
    codec = CODECS[name]

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in sliced(batches):
            yield pa.array([None if t is None else t.encode(codec, "replace") for t in batch.to_pylist()], pa.binary())

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.encode(c, "UTF-8") if name == "utf8" else F.arrow_udf(run, "binary")(c)


def unzip(raw: bytes | None) -> bytes | None:
    """All members of gzip bytes; other bytes as they are; null for a member that is broken or cut off.

    What follows the last member and isn't another one (zeros that pad a file, say) is left out.
    """
    if not raw or raw[:2] != MAGIC:
        return raw
    out, rest = [], raw
    while rest[:2] == MAGIC:
        member = zlib.decompressobj(31)
        try:
            out.append(member.decompress(rest))
        except zlib.error:
            return None
        if not member.eof:
            return None
        rest = member.unused_data.lstrip(b"\0")
    return b"".join(out)


def _unzips(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in sliced(batches):
        yield pa.array([unzip(raw) for raw in batch.to_pylist()], pa.binary())


def gunzip(raw: Column) -> Column:
    """The content of gzip bytes; see :func:`unzip`."""
    return F.arrow_udf(_unzips, "binary")(raw)
