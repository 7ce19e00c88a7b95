"""Marks of a dictionary's entries in texts: an Aho-Corasick automaton of the whole table, sent to the workers once.

From the left, the longest entry that begins at a character is taken, and the search goes on after it; every kind of entry by
itself. One pass over a text finds all occurrences, whatever the number of entries.
"""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentweave.functions.batches import sliced

#: Characters of all entries together that are sent to the workers; a node of the automaton takes about 50 bytes.
MAX_CHARS = 4_000_000
_KIND = "array<struct<start:int,length:int,kind:int>>"
_MARK = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("kind", pa.int32())]))


def longest(occurrences: list[tuple[int, tuple]], after: int = 0) -> list[dict]:
    """Of ``(last character, (length, kinds))`` those that a search from the left takes, each kind by itself, by place and kind."""
    best: dict[int, dict[int, int]] = {}
    for end, (size, kinds) in occurrences:
        start = end - size + 1
        for kind in kinds:
            own = best.setdefault(kind, {})
            own[start] = max(own.get(start, 0), size)
    out = []
    for kind, own in best.items():
        at = after
        for start in sorted(own):
            if start >= at:
                out.append({"start": start, "length": own[start], "kind": kind})
                at = start + own[start]
    return sorted(out, key=lambda m: (m["start"], m["kind"]))


class Dictionary:
    """The entries of a table ``(word, kind)``; kinds are numbers from 1, without a column of them all entries are of kind 1.

    Null and empty words are left out, an entry may have several kinds. A table of more than ``max_chars`` characters
    is an error, because every worker holds it whole.
    """

    def __init__(self, words: DataFrame, word: str = "word", kind: str | None = None, max_chars: int = MAX_CHARS):
        entries = words.select(F.col(word).cast("string").alias("word"), (F.col(kind).cast("int") if kind else F.lit(1)).alias("kind")).filter("word <> ''").distinct()
        total = entries.agg(F.sum(F.length("word"))).first()[0] or 0
        if total > max_chars:
            raise ValueError(f"a dictionary of {total} characters; at most {max_chars} are sent to the workers")
        kinds: dict[str, list[int]] = {}
        for r in entries.collect():
            kinds.setdefault(r["word"], []).append(r["kind"])
        self.sent = words.sparkSession.sparkContext.broadcast({w: tuple(sorted(k)) for w, k in kinds.items()})

    def marks(self, c: Column) -> Column:
        """``array<struct<start,length,kind>>`` of a text, by place (in characters, from 0); null for null."""
        sent = self.sent

        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            import ahocorasick

            found = ahocorasick.Automaton()
            for w, kinds in sent.value.items():
                found.add_word(w, (len(w), kinds))
            found.make_automaton()
            empty = not sent.value
            for batch in sliced(batches):
                yield pa.array([None if t is None else [] if empty else longest(list(found.iter(t))) for t in batch.to_pylist()], _MARK)

        run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
        return F.arrow_udf(run, _KIND)(c)

    def flags(self, c: Column) -> Column:
        """For each character the greatest kind of the entries that are marked over it, 0 outside them."""
        return _flags(c, self.marks(c))

    def masked(self, c: Column, mask: str = "") -> Column:
        """The text with a private character for each character of a marked entry, so that places stay."""
        return F.array_join(F.zip_with(F.filter(F.split(c, ""), lambda x: x != ""), self.flags(c), lambda x, f: F.when(f > 0, mask).otherwise(x)), "")


def _flag(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for texts, marks in sliced(batches):
        out = []
        for t, own in zip(texts.to_pylist(), marks.to_pylist()):
            if t is None:
                out.append(None)
                continue
            flags = bytearray(len(t)) if all(m["kind"] < 256 for m in own) else [0] * len(t)
            for m in sorted(own, key=lambda m: m["kind"]):
                span = slice(m["start"], m["start"] + m["length"])
                flags[span] = bytes([m["kind"]]) * m["length"] if isinstance(flags, bytearray) else [m["kind"]] * m["length"]
            out.append(list(flags))
        yield pa.array(out, pa.list_(pa.int32()))


def _flags(c: Column, marks: Column) -> Column:
    return F.arrow_udf(_flag, "array<int>")(c, marks)
