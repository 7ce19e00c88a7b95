"""Crawl dumps of any size: a record index over the splits of the files, then pages by split.

A dump is a row of records ``:::URL::: n url``, ``:::HDR::: n header`` and ``:::CON::: length content``; contents are counted in bytes and
may hold the marks themselves. Spark reads the dump by splits, with the mark as its line end, so that a plain file is read by many
tasks and a gzip file (all its members) as a stream. A first pass tells for each split how many pages begin in it and how
many bytes of its last page lie beyond it; from this index, one small row a split, the second pass knows the pages' numbers
and whose content a split begins with.
"""

from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentweave.sources import ordered

MARK = b":::URL::: "
_CONTENT = b":::CON::: "
_PART_BYTES = 4_000_000


class Entry(NamedTuple):
    """What a split begins with: its first page's number, bytes of the page before that lie in it, whether a mark right at its start opens a record."""

    number: int = 0
    missing: int = 0
    opens: bool = True


class Split:
    """Reads one split's rows in order; ``missing`` and ``opens`` tell how it ends."""

    def __init__(self, entry: Entry, first: bool):
        self.number, self.missing, self.opens = entry.number - 1, entry.missing, entry.opens
        self.bare = first  # nothing stands before a file's first row
        self.page: list | None = [None, None, []] if entry.missing else None

    def rows(self, values: list[bytes]) -> Iterator[tuple[int, str | None, str | None, bytes]]:
        """``(number, url, header, content)`` of each page that ends here; the url is null for the rest of an earlier split's page."""
        for value in values:
            piece = value if self.bare else MARK + value
            opens, self.bare = self.opens, False
            if self.missing:
                part = piece[: self.missing]
                self.page[2].append(part)
                self.missing -= len(part)
                self.opens = self._after(piece[len(part) :])
            elif opens and piece.startswith(MARK):
                self._record(piece[len(MARK) :])
            else:
                self.opens = self._after(piece)
            if self.page is not None and not self.missing:
                yield self.close()

    def close(self) -> tuple:
        url, header, parts = self.page
        self.page = None
        return self.number, url, header, b"".join(parts)

    @staticmethod
    def _after(rest: bytes) -> bool:
        """A mark that follows opens a record if it stands right after a content or at a line's start."""
        return not rest or rest.endswith(b"\n")

    def _record(self, record: bytes) -> None:
        head, found, body = record.partition(b"\n" + _CONTENT)
        self.opens = self._after(record)
        length, _, content = body.partition(b" ")
        if not length.isdigit():  # "length\n" and the content from the next line on
            length, _, content = body.partition(b"\n")
        if not found or not length.isdigit():
            return
        lines = head.decode("utf-8", "replace").split("\n")
        header = "".join(x.split(" ", 2)[2] + "\n" for x in lines[1:] if x.startswith(":::HDR::: ") and x.count(" ") > 1)
        self.number += 1
        part = content[: int(length)]
        self.missing = int(length) - len(part)
        self.page = [lines[0].split(" ", 1)[-1], header, [part]]
        self.opens = self._after(content[len(part) :])


def _rows(spark: SparkSession, path: str) -> DataFrame:
    return ordered.lines(spark, path, MARK.decode()).select("file", "split", F.col("value").cast("binary").alias("value"))


def _read(batches: Iterator[pa.RecordBatch], index: dict) -> Iterator[tuple]:
    """``(file, split, reader, pages)`` for each batch's run of a split; the reader has read it all when the next run differs."""
    key, split = None, None
    for batch in batches:
        for own, part in ordered.runs(batch):
            if own != key:
                key, split = own, Split(index.get(own, Entry()), own[1] == 0)
            yield own, split, split.rows(part.column(2).to_pylist())


def _ends(rows: DataFrame, index) -> DataFrame:
    """For each split how many pages begin in it, and how it ends, if it begins as the index says."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, found = None, []
        for own, split, pages in _read(batches, index.value):
            if before is not None and before[0] != own:
                found.append(before)
            for _ in pages:
                pass
            start = index.value.get(own, Entry()).number
            before = own, split.number - start + 1, split.missing, split.opens
        if before is not None:
            found.append(before)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*((*own, *rest) for own, *rest in found))], names=["file", "split", "pages", "missing", "opens"])

    return rows.mapInArrow(read, "file string, split bigint, pages bigint, missing bigint, opens boolean")


def record_index(spark: SparkSession, path: str) -> dict[tuple[str, int], Entry]:
    """By file and split what the split begins with. One entry a split: about 100 MB on the driver for 100 TB of dumps.

    Splits that begin within a page are read again with that known, until nothing changes; that is seldom more than once.
    """
    rows, index, ends = _rows(spark, path), {}, {}
    todo = None
    while todo is None or todo:
        sent = spark.sparkContext.broadcast(index)
        wanted = rows if todo is None else rows.join(F.broadcast(spark.createDataFrame(todo, "file string, split bigint")), ["file", "split"], "leftsemi")
        ends |= {(r["file"], r["split"]): (r["pages"], r["missing"], r["opens"]) for r in _ends(wanted, sent).collect()}
        sent.destroy()
        todo, before, number, state = [], None, 0, (0, True)
        new = {}
        for key in sorted(ends):
            if key[0] != before:
                before, number, state = key[0], 0, (0, True)
            new[key] = Entry(number, *state)
            if new[key][1:] != index.get(key, Entry())[1:]:
                todo.append(key)
            number += ends[key][0]
            state = ends[key][1:]
        index = new
    return index


def dump_pages(spark: SparkSession, path: str, per_directory: int = 10_000) -> DataFrame:
    """Pages of the crawl dumps under a path, plain or gzip: ``path``, number in the dump, directory number, url, header, content.

    A dump without records and an empty one give no page; a page that the file's end cuts off has what is there.
    A page must fit a task's memory, a dump needn't. Reads each dump twice.
    """
    index = record_index(spark, path)
    sent = spark.sparkContext.broadcast(index)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        out, held, before = [], 0, None

        def batch() -> pa.RecordBatch:
            nonlocal out, held
            done = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary()))], names=["path", "split", "number", "url", "header", "content"])
            out, held = [], 0
            return done

        def add(own: tuple, page: tuple) -> bool:
            nonlocal held
            out.append((*own, *page))
            held += len(page[3])
            return held > _PART_BYTES or len(out) > 5000

        for own, split, pages in _read(batches, index):
            if own not in index:
                raise ValueError("the dump was cut into other splits meanwhile")
            if before is not None and before[0] != own and before[1].page is not None:
                add(before[0], before[1].close())
            for page in pages:
                if add(own, page):
                    yield batch()
            before = own, split
        if before is not None and before[1].page is not None:
            add(before[0], before[1].close())
        if out:
            yield batch()

    pages = _rows(spark, path).mapInArrow(read, "path string, split bigint, number bigint, url string, header string, content binary")
    if any(e.missing for e in index.values()):  # parts of pages over several splits, put together; all others pass by
        cut = [(k[0], e.number - 1) for k, e in index.items() if e.missing]
        marked = pages.join(F.broadcast(spark.createDataFrame(sorted(set(cut)), "path string, number bigint").withColumn("cut", F.lit(True))), ["path", "number"], "left")
        parts = F.transform(F.array_sort(F.collect_list(F.struct("split", "content"))), lambda p: p["content"])
        joined = marked.filter("cut").groupBy("path", "number").agg(F.max("url").alias("url"), F.max("header").alias("header"), _concat(parts).alias("content"))
        pages = marked.filter("cut is null").select("path", "number", "url", "header", "content").unionByName(joined)
    directory = F.lpad(F.floor(F.col("number") / per_directory).cast("string"), 6, "0")
    return pages.select("path", "number", "url", "header", "content", directory.alias("directory"))


def _concat(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(b"").cast("binary"), lambda a, b: F.concat(a, b))
