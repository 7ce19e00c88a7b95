"""A data source that writes one file a row under a given name, in folders of shards, and commits whole shards.

A task writes its files below ``_temporary``, in a folder of its own. When all tasks are done, the driver moves their shards into
place: a shard that is new there by one rename, the files of one that exists one by one. Before that no file is to be
seen under its name; a task that dies or is tried again leaves nothing but its own folder, which goes at the end. On object stores,
where a rename copies, the same holds for each file by itself.
"""

import gzip
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs as stores
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

STAGING = "_temporary"
SCHEMA = "shard string, name string, content binary"


def store(path: str) -> tuple[stores.FileSystem, str]:
    """The file system and the path in it of a folder, given plainly or as a URI."""
    return stores.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (stores.LocalFileSystem(), path)


@dataclass
class Written(WriterCommitMessage):
    """What a task has written: its folder and the shards in it."""

    folder: str
    shards: list[str] = field(default_factory=list)
    files: int = 0


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite, self.job = path.rstrip("/"), overwrite, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = store(self.path)
        done, shards = Written(f"{root}/{STAGING}/{self.job}/{uuid.uuid4().hex}"), set()
        for batch in iterator:
            for shard, name, content in zip(*((x.as_py() for x in batch.column(c)) for c in ("shard", "name", "content")), strict=True):
                if not name or not shard or {"/", "\\"} & set(name + shard) or shard.startswith("_") or {name, shard} & {".", ".."}:
                    raise ValueError(f"not a name for a file: {shard!r}, {name!r}")
                if shard not in shards:
                    fs.create_dir(f"{done.folder}/{shard}")
                    shards.add(shard)
                with fs.open_output_stream(f"{done.folder}/{shard}/{name}", compression=None) as out:
                    out.write(gzip.compress(content or b"", mtime=0) if name.endswith(".gz") else content or b"")
                done.files += 1
        done.shards = sorted(shards)
        return done

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = store(self.path)
        fs.create_dir(root)
        if self.overwrite:
            for old in fs.get_file_info(stores.FileSelector(root)):
                if old.base_name != STAGING:
                    fs.delete_dir(old.path) if old.type == stores.FileType.Directory else fs.delete_file(old.path)
        there = {i.base_name for i in fs.get_file_info(stores.FileSelector(root))}
        for m in messages:
            for shard in m.shards if m else []:
                if shard in there:
                    for f in fs.get_file_info(stores.FileSelector(f"{m.folder}/{shard}")):
                        fs.move(f.path, f"{root}/{shard}/{f.base_name}")
                else:
                    fs.move(f"{m.folder}/{shard}", f"{root}/{shard}")
                    there.add(shard)
        self._clear(fs, root)

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(*store(self.path))

    def _clear(self, fs: stores.FileSystem, root: str) -> None:
        if fs.get_file_info(f"{root}/{STAGING}/{self.job}").type == stores.FileType.Directory:
            fs.delete_dir(f"{root}/{STAGING}/{self.job}")
        if fs.get_file_info(f"{root}/{STAGING}").type == stores.FileType.Directory and not fs.get_file_info(stores.FileSelector(f"{root}/{STAGING}")):
            fs.delete_dir(f"{root}/{STAGING}")


class NamedFiles(DataSource):
    """``df.write.format("named_files").save(path)`` for rows ``(shard, name, content)``."""

    @classmethod
    def name(cls) -> str:
        return "named_files"

    def schema(self) -> str:
        return SCHEMA

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"], overwrite)


def write(rows: DataFrame, shard: Column, name: Column, content: Column, path: str, mode: str = "append") -> None:
    """One file for each row: ``path/shard/name``, gzip where the name ends in ``.gz``; null content is an empty file.

    A shard's files are written by one task, so shards bound a task's work (10,000 documents each, in this library). Two rows of one
    name leave the last one's content; names with slashes, empty and null ones are errors. ``overwrite`` replaces all that lies under the path.
    """
    rows.sparkSession.dataSource.register(NamedFiles)
    files = rows.select(shard.cast("string").alias("shard"), name.cast("string").alias("name"), content.cast("binary").alias("content"))
    files.repartition("shard").write.format("named_files").mode(mode).save(path)


#: Bytes of files, and how many of them, that a reader hands to Spark at once (one at least).
READ_BYTES, READ_FILES = 4 << 20, 512


def read(spark: SparkSession, path: str) -> DataFrame:
    """``(path, shard, name, content)`` of the files that :func:`write` left in the folders under ``path``.

    The driver lists the shards alone; each is listed and read by a task of its own, so no list of files goes to the driver. Folders and files
    whose names begin with ``_`` or ``.`` are left out, and so is what lies deeper.
    """
    fs, root = store(path.rstrip("/"))
    shards = sorted(i.base_name for i in fs.get_file_info(stores.FileSelector(root)) if i.type == stores.FileType.Directory and i.base_name[0] not in "_.")
    schema = "path string, shard string, name string, content binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = store(path.rstrip("/"))
        kinds = [("path", pa.string()), ("shard", pa.string()), ("name", pa.string()), ("content", pa.binary())]
        rows, held = [], 0
        for shard in (s for b in batches for s in b.column(0).to_pylist()):
            for f in fs.get_file_info(stores.FileSelector(f"{root}/{shard}")):
                if f.type == stores.FileType.File and f.base_name[0] not in "_.":
                    with fs.open_input_stream(f.path, compression=None) as content:
                        rows.append((f.path, shard, f.base_name, content.read()))
                    held += len(rows[-1][3])
                    if held >= READ_BYTES or len(rows) >= READ_FILES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(zip(*rows), kinds)], schema=pa.schema(kinds))
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(zip(*rows), kinds)], schema=pa.schema(kinds))

    # a slice of the list a shard: hashing the names would put several into one task and none into others
    dealt = spark.sparkContext.parallelize([(s,) for s in shards], max(len(shards), 1))
    return spark.createDataFrame(dealt, "shard string").mapInArrow(run, schema)
