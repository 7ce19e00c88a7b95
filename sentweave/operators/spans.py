"""Byte spans of sentences within their page, carried through cleaning and splitting.

Cleaning decodes references, deletes control characters and moves blanks, and normalising changes widths; none of it adds,
drops or reorders any other character. So a segment's characters, blanks left out, are those of its sentences, one by one,
and a sentence's span runs from its first character's bytes in the page to its last one's.
"""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from sentweave.functions.batches import sliced
from sentweave.functions.japanese import items_merged, sentences_of, with_faces_apart
from sentweave.functions.text import ENTITIES, REFERENCE, SEMI_VOICED, VOICED

BLANK = frozenset(" \n　")
_CONTROLS = re.compile("[\x00-\x09\x0b-\x1f\x7f-\x9f]")
_JOINED = [half + mark for marks, mark in ((VOICED, "ﾞ"), (SEMI_VOICED, "ﾟ")) for half in marks]


def decoded(reference: str) -> str:
    """What a character reference stands for, as ``text.decode_entities`` has it."""
    if reference[1] != "#":
        return " " if reference == "&nbsp;" else ENTITIES.get(reference[1:], reference)
    digits = reference[2:].rstrip(";")
    n = int(digits[1:], 16) if digits[0] in "xX" else int(digits)
    if n == 160 and reference.endswith(";"):
        return " "
    return chr(n) if 0 < n < 0x110000 and not 0xD800 <= n <= 0xDFFF else "�"


def characters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all texts, one behind the other, and where each text begins among them (and the last one ends)."""
    return np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32), np.cumsum([0, *map(len, texts)])


def units(tokens: list[str], at: np.ndarray, joined: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the characters that cleaning keeps, blanks left out, for tokens that begin at the bytes ``at``; and how many come before each token.

    All tokens are worked on at once, references and, with ``joined``, voiced marks (which go with their letter) by themselves.
    """
    chars, bounds = characters(tokens)
    sizes = 1 + (chars >= 0x80).astype(np.int64) + (chars >= 0x800) + (chars >= 0x10000)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    ends = ends[1:] + np.repeat(np.asarray(at, np.int64) - ends[bounds[:-1]], np.diff(bounds))
    starts = ends - sizes
    times = ((chars > 32) & ((chars < 0x7F) | (chars > 0x9F)) & (chars != 0x3000)).astype(np.int64)
    for token, first in zip(tokens, bounds.tolist()):
        if "&" in token or (joined and _MARKS.search(token)):
            for m in _UNITS[joined].finditer(token):
                a, b = first + m.start(), first + m.end()
                times[a:b] = 0
                times[a] = sum(ch not in BLANK for ch in _CONTROLS.sub("", decoded(m[1]))) if m[1] else 1
                ends[a] = ends[b - 1]
    before = np.concatenate([[0], np.cumsum(times)])[bounds]
    return np.repeat(starts, times), np.repeat(ends, times), before


_MARKS = re.compile("[ﾞﾟ]")
_UNITS = {joined: re.compile(f"({REFERENCE}){'|' + '|'.join(_JOINED) if joined else ''}") for joined in (False, True)}


def sizes_of(sentences: list[str]) -> np.ndarray:
    """The characters of each sentence, blanks left out."""
    chars, bounds = characters(sentences)
    return np.diff(np.concatenate([[0], np.cumsum((chars != 0x20) & (chars != 0x0A) & (chars != 0x3000))])[bounds])


def places(pieces: tuple[np.ndarray, np.ndarray, list[str]], numbers: np.ndarray, sentences: list[str], joined: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offset and length of the sentences of several segments, and whether they have them: none of a segment's if its characters don't add up.

    ``pieces``: of each segment the number of its text tokens, then of all of them the offset and the text; ``numbers``: its number of sentences.
    """
    own, at, tokens = pieces
    starts, ends, before = units(tokens, at, joined)
    first = before[np.concatenate([[0], np.cumsum(own)])]
    sizes, upto = sizes_of(sentences), np.concatenate([[0], np.cumsum(numbers)])
    sums = np.concatenate([[0], np.cumsum(sizes)])
    there = np.repeat(sums[upto[1:]] - sums[upto[:-1]] == np.diff(first), numbers) & (sizes > 0)
    a = np.where(there, sums[:-1] + np.repeat(first[:-1] - sums[upto[:-1]], numbers), 0)
    if not len(starts):
        return a, a, there
    return starts[a], ends[np.where(there, a + sizes - 1, 0)] - starts[a], there


def spans_of(pieces: list[tuple[int, str]], sentences: list[str], joined: bool) -> list[dict | None]:
    """The span of each sentence of a segment; none of them if the characters don't add up."""
    at = np.array([a for a, _ in pieces], np.int64)
    found = places((np.array([len(pieces)]), at, [t for _, t in pieces]), np.array([len(sentences)]), sentences, joined)
    return [{"offset": o, "length": n} if there else None for o, n, there in zip(*(c.tolist() for c in found))]


def _flat(pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    at, tokens = pieces.flatten().flatten()
    return pc.fill_null(pc.list_value_length(pieces), 0).to_numpy(zero_copy_only=False), at.to_numpy(zero_copy_only=False), tokens.to_pylist()


def _lists(numbers: np.ndarray, rows: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(numbers)]), pa.int32()), rows)


def sentence_spans(pieces: Column, sentences: Column, joined: bool) -> Column:
    """``array<struct<offset,length>>`` for the sentences of a segment from its text tokens ``(byte_off, token)``."""

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for tokens, found in sliced(batches):
            numbers = pc.fill_null(pc.list_value_length(found), 0).to_numpy(zero_copy_only=False)
            offset, length, there = places(_flat(tokens), numbers, found.flatten().to_pylist(), joined)
            yield _lists(numbers, pa.StructArray.from_arrays([pa.array(offset, pa.int64()), pa.array(length, pa.int64())], ["offset", "length"], mask=pa.array(~there)))

    run.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "array<struct<offset:bigint,length:bigint>>")(pieces, sentences)


def japanese_sentences(pieces: Column, paragraphs: Column, is_body: Column, merge_items: bool) -> Column:
    """``array<struct<para_no,k,raw_string,offset,length>>``: the sentences of a segment's normalised paragraphs, with their spans.

    Header parts are not split.
    """
    finish = items_merged if merge_items else list

    def cut(paras: list[str], body: bool) -> list[tuple[int, int, str]]:
        split = ((i, finish(with_faces_apart(sentences_of(p))) if body else [p]) for i, p in enumerate(paras))
        return [(i, k, s) for i, own in split for k, s in enumerate(own) if s]

    def run(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for tokens, paragraphs, body in sliced(batches):
            found = [cut(*row) for row in zip(paragraphs.to_pylist(), body.to_pylist())]
            numbers = np.array([len(own) for own in found], np.int64)
            para_no, k, said = (list(c) for c in zip(*(x for own in found for x in own))) if numbers.any() else ([], [], [])
            offset, length, there = places(_flat(tokens), numbers, said, True)
            columns = [pa.array(para_no, pa.int32()), pa.array(k, pa.int32()), pa.array(said, pa.string()), *(pa.array(c, pa.int64(), mask=~there) for c in (offset, length))]
            yield _lists(numbers, pa.StructArray.from_arrays(columns, ["para_no", "k", "raw_string", "offset", "length"]))

    run.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "array<struct<para_no:int,k:int,raw_string:string,offset:bigint,length:bigint>>")(pieces, paragraphs, is_body)
