"""Where a sentence comes from: byte spans of the page, their check, and alignment for sentences that came without."""

import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentweave.functions.batches import sliced
from sentweave.functions import text
from sentweave.operators.html import TOKEN, strip_tags
from sentweave.operators.sentences import clean_segment

ROLES = ["title", "keywords", "description", "body"]
#: Characters that the page may have more at one place of a sentence.
MAX_SKIP = 10
#: Stands for the rest of a reference without a semicolon; alignment passes over it, as over all controls.
OPEN_END = "\x7f"
#: Characters of a sentence whose place is sure even if the page has some more or less there.
SURE = 20
#: Lengths of the runs that anchor an alignment; the width of the band between them, and the cells that a rest may have.
GRAMS, BAND, MAX_CELLS = (16, 8, 4), 24, 200_000


def span(html: Column, offset: Column, length: Column) -> Column:
    """The bytes ``[offset, offset + length)`` of the page, as text."""
    return F.decode(F.substring(html.cast("binary"), offset.cast("int") + 1, length.cast("int")), "UTF-8")  # a cast, so that the page isn't coded anew


def verify(found: DataFrame, pages: DataFrame, id_col: str = "page_id", html: str = "html", language: str = "english") -> DataFrame:
    """Sentences beside the page bytes they name: ``source``, cleaned as the sentence was, and whether both are equal (``matches``).

    Blanks don't count: tags between two words may have stood where the sentence has a blank, or the other way round.
    """
    joined = found.filter(F.col("offset").isNotNull()).join(pages.select(id_col, html), id_col)
    source = F.col("source")  # a step a projection: within lambdas an earlier step would be worked out several times
    bare = lambda c: F.regexp_replace(c, "[\\s\\u3000]+", "")
    shown = joined.withColumn("source", strip_tags(span(F.col(html), F.col("offset"), F.col("length")))).drop(html).withColumn("source", clean_segment(source))
    normal = shown.withColumn("source", F.regexp_replace(source, "\\s+", " ") if language == "english" else text.normalise_japanese(source))
    return normal.withColumn("matches", bare(source) == bare(F.col("raw_string")))


def padded_entities(c: Column) -> Column:
    """Entities decoded with blanks after them, so that the text keeps its length in bytes.

    Behind one that no semicolon closes ``OPEN_END`` stands instead: its name is text, which belongs to a sentence that ends with it.
    """
    pieces = F.regexp_extract_all(F.translate(c, OPEN_END, " "), F.lit(f"{text.REFERENCE}|[^&]+|&"), F.lit(0))
    fill = lambda p, n: F.when(p.endswith(";"), F.repeat(F.lit(" "), n)).otherwise(F.repeat(F.lit(OPEN_END), n))
    pad = lambda p: text.bind(text.decode_entities(p), lambda d: F.when(F.octet_length(d) <= F.octet_length(p), F.concat(d, fill(p, F.octet_length(p) - F.octet_length(d)))).otherwise(p))
    return F.array_join(F.transform(pieces, lambda p: F.when(p.rlike("^&."), pad(p)).otherwise(p)), "")


def blanked_tags(html: Column) -> Column:
    """The page with blanks for the bytes of all that isn't text, so that the text keeps its place."""
    toks = F.regexp_extract_all(html, F.lit(TOKEN), F.lit(0))
    return F.array_join(F.transform(toks, lambda t: F.when(t.startswith("<") & (t != "<"), F.repeat(F.lit(" "), F.octet_length(t))).otherwise(t)), "")


def _key(c: str) -> str:
    """A character as alignment compares it: compatibility forms as plain ones, all dashes and long marks as one, blanks and controls as nothing."""
    found = _KEYS.get(c)
    if found is None:
        plain = unicodedata.normalize("NFKC", c).translate(_FOLD)
        found = _KEYS[c] = "".join(x for x in plain if not x.isspace() and unicodedata.category(x) != "Cc")
    return found


_KEYS: dict[str, str] = {}
_FOLD = str.maketrans({**dict.fromkeys("ー―−─━‐—–ｰ", "-"), "〜": "~", "‖": "|", "∥": "|"})
_HALF = re.compile("[ｦ-ﾝ][ﾞﾟ]|.", re.S)


_UNKNOWN, _SEVERAL = 0xFFFFFFFF, 0xFFFFFFFE
_TABLE = np.full(0x110000, _UNKNOWN, np.uint32)  # each character's key, 0 for nothing; filled as characters are met
_MARKS = re.compile("[ﾞﾟ]")


def keyed(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Comparable characters of a text with the bytes where each begins and ends; a half-width letter goes with its voicing mark."""
    if text.isascii():
        raw = np.frombuffer(text.encode(), np.uint8)
        at = np.flatnonzero((raw > 32) & (raw != 127))
        return raw[at].astype(np.uint32), at, at + 1
    if not _MARKS.search(text):
        chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        keys, several = _looked_up(chars)
        sizes = 1 + (chars >= 0x80).astype(np.int64) + (chars >= 0x800) + (chars >= 0x10000)
        ends = np.cumsum(sizes)
        at = np.flatnonzero(keys)
        if several.any():
            at = np.repeat(at, np.where(several, [len(_key(chr(c))) if m else 1 for c, m in zip(chars.tolist(), several.tolist())], 1)[at])
            return np.array([ord(k) for c in chars.tolist() for k in _key(chr(c))], np.uint32), (ends - sizes)[at], ends[at]
        return keys[at], (ends - sizes)[at], ends[at]
    keys, starts, ends, at = [], [], [], 0
    for m in _HALF.finditer(text):
        size = len(m[0].encode("utf-8", "surrogatepass"))
        for k in _key(m[0]):
            keys.append(ord(k))
            starts.append(at)
            ends.append(at + size)
        at += size
    return np.array(keys, np.uint32), np.array(starts, np.int64), np.array(ends, np.int64)


def _looked_up(chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The characters' keys, and which characters have several (these count as themselves)."""
    keys = _TABLE[chars]
    if (new := np.unique(chars[keys == _UNKNOWN])).size:
        found = [_key(chr(c)) for c in new.tolist()]
        _TABLE[new] = [_SEVERAL if len(k) > 1 else ord(k) if k else 0 for k in found]
        keys = _TABLE[chars]
    return keys, keys == _SEVERAL


def keys_of(texts: list[str]) -> list[str]:
    """The comparable characters of each text as a string."""
    whole = "".join(texts)
    if not _MARKS.search(whole):
        chars = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        keys, several = _looked_up(chars)
        if not several.any():
            cuts = np.concatenate([[0], np.cumsum(keys != 0)])[np.cumsum([0, *map(len, texts)])].tolist()
            shown = _string(keys[keys != 0])
            return [shown[a:b] for a, b in zip(cuts, cuts[1:])]
    return [_string(keyed(t)[0]) for t in texts]


def _string(keys: np.ndarray) -> str:
    return keys.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")


def _grams(x: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each run of ``k`` numbers."""
    out = np.zeros(max(len(x) - k + 1, 0), np.uint64)
    for i in range(k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + (x[i : i + len(out)].astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    return out


def _unique(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Grams that occur once, in order, and where."""
    found, at, n = np.unique(grams, return_index=True, return_counts=True)
    return found[n == 1], at[n == 1]


def _chain(x: np.ndarray, y: np.ndarray) -> list[int]:
    """Places of a longest chain in which both grow; ``x`` grows already."""
    tails, last, before = [], [], [-1] * len(y)
    for i, v in enumerate(y.tolist()):
        k = bisect_left(tails, v)
        before[i] = last[k - 1] if k else -1
        tails[k : k + 1], last[k : k + 1] = [v], [i]
    out, i = [], last[-1] if last else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def _banded(x: list[int], y: list[int], band: int) -> list[tuple[int, int]]:
    """Pairs of an alignment with as many equal characters as there can be, within ``band`` of the diagonal; ``?`` in ``x`` is equal to any."""
    m, n = len(x), len(y)
    slope = n / m
    low = [max(0, int(i * slope) - band) for i in range(m + 1)]
    high = [min(n, int(i * slope) + band) for i in range(m + 1)]
    rows = [[0] * (high[0] - low[0] + 1)]
    at = lambda i, j: rows[i][j - low[i]] if low[i] <= j <= high[i] else -1
    for i in range(1, m + 1):
        row = []
        for j in range(low[i], high[i] + 1):
            best = at(i - 1, j)
            if j and row:
                best = max(best, row[-1])
            if j and (x[i - 1] == y[j - 1] or x[i - 1] == WILD):
                best = max(best, at(i - 1, j - 1) + 1)
            row.append(max(best, 0))
        rows.append(row)
    out, i, j = [], m, high[m]
    while i and j >= low[i]:
        here = at(i, j)
        if j > low[i] and at(i, j - 1) == here:
            j -= 1
        elif at(i - 1, j) == here and low[i - 1] <= j <= high[i - 1]:
            i -= 1
        elif j:
            i, j = i - 1, j - 1
            out.append((i, j))
        else:
            break
    return out[::-1]


WILD = ord("?")


def _matched(x: np.ndarray, y: np.ndarray, sizes: tuple[int, ...] = GRAMS) -> np.ndarray:
    """For each character of ``x`` its place in ``y``, -1 without one; places grow.

    Runs that are unique on both sides anchor it, long ones first, then shorter ones between them; small rests are aligned within a band.
    """
    to = np.full(len(x), -1, np.int64)
    todo = [(0, len(x), 0, len(y), 0)]
    while todo:
        xa, xb, ya, yb, level = todo.pop()
        while xa < xb and ya < yb and x[xa] == y[ya]:
            to[xa] = ya
            xa, ya = xa + 1, ya + 1
        while xa < xb and ya < yb and x[xb - 1] == y[yb - 1]:
            xb, yb = xb - 1, yb - 1
            to[xb] = yb
        if xa == xb or ya == yb:
            continue
        if level == len(sizes):
            if (xb - xa) * (yb - ya) <= MAX_CELLS or abs((yb - ya) - (xb - xa)) <= BAND:
                for i, j in _banded(x[xa:xb].tolist(), y[ya:yb].tolist(), max(BAND, min(yb - ya, MAX_CELLS // (xb - xa)))):
                    to[xa + i] = ya + j
            else:
                at = y[ya:yb].tobytes().find(x[xa:xb].tobytes())
                if at >= 0 and at % 4 == 0:
                    to[xa:xb] = np.arange(xb - xa) + ya + at // 4
            continue
        k = sizes[level]
        (gx, px), (gy, py) = _unique(_grams(x[xa:xb], k)), _unique(_grams(y[ya:yb], k))
        _, ix, iy = np.intersect1d(gx, gy, assume_unique=True, return_indices=True)
        px, py = px[ix], py[iy]
        order = np.argsort(px)
        px, py = px[order] + xa, py[order] + ya
        at_x, at_y = xa, ya
        for c in _chain(px, py):
            i, j = int(px[c]), int(py[c])
            if i < at_x and j - i == at_y - at_x:  # goes on along the same diagonal
                i, j = at_x, at_y
            elif i < at_x or j < at_y:
                continue
            till = int(px[c]) + k
            if i > at_x or j > at_y:
                todo.append((at_x, i, at_y, j, level + 1))
            to[i:till] = np.arange(j, j + till - i)
            at_x, at_y = till, j + till - i
        todo.append((at_x, xb, at_y, yb, level + 1))
    return to


def align(raws: list[str], page: str) -> list[tuple[int, int]]:
    """Byte ``(offset, length)`` of each sentence in the page text, in order; ``(-1, -1)`` where it isn't found.

    Blanks count on neither side, widths, long marks and dashes are as one, ``?`` stands for any character. Within a sentence the page
    may have up to ``MAX_SKIP`` characters more at a place, and at most one character in a row may lack there. Empty sentences aren't found.
    """
    y, starts, ends = keyed(page)
    parts = keys_of(raws)
    wide = np.concatenate([[True], starts[1:] - ends[:-1] > 1, [True]]).tobytes()
    places = _in_a_row(parts, _string(y), wide) or _searched([np.array([*map(ord, p)], np.uint32) for p in parts], y)
    raw = page.encode("utf-8", "surrogatepass") if OPEN_END in page else b""
    out = []
    for first, last in places:
        if last < 0:
            out.append((-1, -1))
            continue
        start, end = int(starts[first]), int(ends[last])
        while raw[end : end + 1] == OPEN_END.encode():
            end += 1
        out.append((start, end - start))
    return out


def _in_a_row(parts: list[str], y: str, wide: bytes) -> list[tuple[int, int]] | None:
    """First and last place in ``y`` of each sentence, where all are there whole or with one stretch that only the page has; else None.

    Sentences stand right behind each other, or where most of those that follow do too. ``wide``: whether several bytes lie before a place.
    """
    out, low, tried = [], 0, 0
    for i, p in enumerate(parts):
        if not p:
            out.append((-1, -1))
            continue
        at, end = low, _here(parts, i, y, low)
        # what only the page has may begin like the sentence: then the sentence would end where none ends, and the next one isn't there
        cut_off = end >= 0 and p[-1] not in _MARKED_ENDS and not wide[end] and _follows(parts, i, y, low, end, AHEAD) == end - low
        if end < 0 or cut_off:
            best, opening = (end - low if cut_off else 0, False), p if len(p) < SURE else p[: len(p) // 3]
            place = y.find(opening, low + 1)
            while place >= 0 and best[0] < AHEAD:
                tried += 1
                if tried > MAX_TRIED:
                    return None
                stop = _here(parts, i, y, place)
                if stop >= 0 and (not cut_off or wide[stop]):
                    rated = (_follows(parts, i, y, place, stop, AHEAD), y[place - 1] in _MARKED_ENDS)
                    if rated > best:
                        best, at, end = rated, place, stop
                place = y.find(opening, place + 1)
            if end < 0:
                return None
            if at > low and y[at - 1] not in _MARKED_ENDS and (stop := _here(parts, i, y, end)) >= 0:  # what only the page has may end like the sentence
                if _follows(parts, i, y, end, stop, len(y)) >= _follows(parts, i, y, at, end, len(y)):
                    at, end = end, stop
        out.append((at, end - 1))
        low = end
    return out


#: Characters that must follow in a row for a place to be sure, and places that are tried in a page before it is searched as a whole.
AHEAD, MAX_TRIED = 200, 5000
_MARKED_ENDS = frozenset(".?!。？！)]}」』）\"'")


def _follows(parts: list[str], i: int, y: str, at: int, end: int, most: int) -> int:
    """Characters from a sentence's place on that this and the next sentences fill in a row, counted to ``most``; as many where both end together."""
    n = end - at
    for k in range(i + 1, len(parts)):
        if n >= most:
            return n
        if parts[k]:
            till = _here(parts, k, y, end)
            if till < 0:
                return n
            n, end = n + till - end, till
    return max(n, most) if end == len(y) else n


def _here(parts: list[str], i: int, y: str, at: int) -> int:
    """Where a sentence that begins at ``at`` ends, -1 if it isn't there; in one of ``SURE`` characters the page may have one stretch more.

    Of several such ends the one counts that the next sentence follows, then the first.
    """
    p = parts[i]
    n = len(p)
    if y.startswith(p, at):
        return at + n
    if n < SURE or y[at : at + 1] != p[0]:
        return -1
    same, most = 1, n - 1  # characters that are the same from the beginning on
    while same < most:
        half = (same + most + 1) // 2
        if y.startswith(p[:half], at):
            same = half
        else:
            most = half - 1
    rest = p[same:]
    ends = [at + n + more for more in range(1, MAX_SKIP + 1) if y.startswith(rest, at + same + more)]
    if len(ends) > 1:
        following = next((q for q in parts[i + 1 :] if q), "")[:SURE]
        return next((e for e in ends if y.startswith(following[: len(following) // 2 or 1], e)), ends[0])
    return ends[0] if ends else -1


def _searched(parts: list[np.ndarray], y: np.ndarray) -> list[tuple[int, int]]:
    """First and last place of each sentence, by runs that the page and all sentences share; ``(-1, -1)`` where it isn't found."""
    to = _matched(np.concatenate([np.zeros(0, np.uint32), *parts]), y)
    firsts = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    bounds, edge = [], len(y)  # for each sentence, where the next one begins whose place is sure
    for p, a, b in zip(parts[::-1], firsts[-2::-1], firsts[:0:-1]):
        bounds.append(edge)
        own = to[a:b]
        if _exact(own) or (len(p) > SURE and _whole(own)):
            edge = int(own[own >= 0][0])
    out, low = [], 0
    for p, a, b, high in zip(parts, firsts[:-1], firsts[1:], bounds[::-1]):
        own = to[a:b]
        if len(p) and not (_exact(own) and own[0] >= low) and (place := _together(p, y, low, high)) >= 0:
            own = np.arange(place, place + len(p))
        if len(p) and not _whole(own):  # where the page repeats runs: right behind the sentence before, right before the next sure one, or in between
            n = len(p) + MAX_SKIP
            for x, z in ((low, min(high, low + n)), (max(low, high - n), high), (low, high)):
                here = _matched(p, y[x:z])
                if _whole(here):
                    own = np.where(here >= 0, here + x, -1)
                    break
        if len(p) and (own >= 0).any() and not _whole(own):
            after = to[b:][to[b:] >= 0][:1]
            own = _gathered(p.tolist(), own, y, low, int(after[0]) if len(after) else len(y))
        if _whole(own):
            places = own[own >= 0]
            low = int(places[-1]) + 1
            out.append((int(places[0]), int(places[-1])))
        else:
            out.append((-1, -1))
    return out


def _exact(own: np.ndarray) -> bool:
    """All characters of a sentence stand together in the page."""
    return bool(len(own) and (own >= 0).all() and (np.diff(own) == 1).all())


def _together(x: np.ndarray, y: np.ndarray, low: int, high: int) -> int:
    """Where all of ``x`` stands together in ``y[low:high]``, -1 if nowhere: right behind ``low`` or right before ``high`` rather than in between."""
    n, own, wanted, found = len(x), y[low:high].tobytes(), x.tobytes(), []
    at = own.find(wanted)
    while at >= 0:
        if at % 4 == 0:
            found.append(low + at // 4)
        at = own.find(wanted, at + 1)
    return -1 if not found else found[-1] if found[0] != low and found[-1] + n == high else found[0]


def _whole(own: np.ndarray) -> bool:
    """A sentence's places are all there, but for single characters, and near each other."""
    have = np.flatnonzero(own >= 0)
    if 2 * len(have) <= len(own):
        return False
    return bool(have[0] <= 1 and have[-1] >= len(own) - 2 and (np.diff(have) <= 2).all() and (np.diff(own[have]) <= MAX_SKIP + 1).all())


def _gathered(x: list[int], own: np.ndarray, y: np.ndarray, low: int, high: int) -> np.ndarray:
    """The sentence's places again, step by step from its longest part that lies together, between its neighbours' places.

    Before or after a stretch that only the page has, single characters may have been taken from that stretch's other end.
    """
    have = np.flatnonzero(own >= 0)
    cuts = np.flatnonzero((np.diff(own[have]) > MAX_SKIP + 1) | (np.diff(have) > 2)) + 1
    core = max(np.split(have, cuts), key=len)
    out = np.full(len(x), -1, np.int64)
    out[core] = own[core]
    for step, first, edge in ((-1, int(core[0]), low - 1), (1, int(core[-1]), high)):
        i, j = first + step, int(own[first]) + step
        while 0 <= i < len(x) and j != edge and (edge - j) * step > 0:
            ahead = next((k for k in range(j, j + step * (MAX_SKIP + 1), step) if (edge - k) * step > 0 and (y[k] == x[i] or x[i] == WILD)), None)
            if ahead is not None:
                out[i] = ahead
                j = ahead + step
            i += step
    return out


def _aligned(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for raws, pages in sliced(batches):
        out = [None if r is None or p is None else align(r, p) for r, p in zip(raws.to_pylist(), pages.to_pylist())]
        spans = np.array([x for own in out if own for x in own], np.int64).reshape(-1, 2)
        rows = pa.StructArray.from_arrays([pa.array(spans[:, 0]), pa.array(spans[:, 1])], ["offset", "length"])
        ends = np.concatenate([[0], np.cumsum([len(own or ()) for own in out])]).astype(np.int32)
        yield pa.ListArray.from_arrays(pa.array(ends), rows, mask=pa.array([own is None for own in out], pa.bool_()))


def alignment(raws: Column, page_text: Column) -> Column:
    """Spans for sentences that were taken from the page elsewhere: a fold over each page by itself, over Arrow batches."""
    return F.arrow_udf(_aligned, "array<struct<offset:bigint,length:bigint>>")(raws, page_text)


def in_order(found: DataFrame, id_col: str = "page_id") -> DataFrame:
    """Title, keywords, description, then the body, as one array a document."""
    rank = F.array_position(F.array(*[F.lit(r) for r in ROLES]), F.col("role"))
    return found.groupBy(id_col).agg(F.transform(F.array_sort(F.collect_list(F.struct(rank.alias("rank"), "sent_no", "raw_string"))), lambda x: x["raw_string"]).alias("nodes"))
