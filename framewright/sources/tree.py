"""A folder tree as a table, listed inside tasks, and tables of members written as files.

The planner names shares and looks at nothing.  Every task lists the two upper levels and takes the files there whose name falls to its share;
a folder further down belongs to one share with all that is in it.  So a flat folder of any number of files is read by many tasks, and
a deep tree is walked once.  Files of length zero are rows like others.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Stores that tasks reach by themselves.
SCHEMES = ("", "file", "s3", "gs", "gcs", "hdfs", "abfs")
#: Levels that all tasks list, and bytes and files of a batch.
SHARED_LEVELS, BATCH_BYTES, BATCH_FILES = 2, 16_000_000, 5_000
SCHEMA = "path string, length long, content binary"


def reachable(path: str) -> bool:
    return urlsplit(path).scheme in SCHEMES


def _store(path: str):
    """File system and the folder's path in it."""
    from pyarrow import fs

    if urlsplit(path).scheme in ("", "file"):
        return fs.LocalFileSystem(), urlsplit(path).path.rstrip("/")
    return fs.FileSystem.from_uri(path.rstrip("/"))


class Share(InputPartition):
    def __init__(self, number: int) -> None:
        self.number = number


class TreeReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path, self.suffixes = options["path"], tuple(options["suffixes"].split(","))
        self.shares, self.contents = int(options["shares"]), options["contents"] == "true"
        self.recursive = options["recursive"] == "true"

    def partitions(self) -> list[Share]:
        return [Share(i) for i in range(self.shares)]

    def _files(self, share: int) -> Iterator:
        from pyarrow import fs

        store, root = _store(self.path)
        mine = lambda name: zlib.crc32(name.encode()) % self.shares == share
        open_folders = [(root, 0, False)]
        while open_folders:
            folder, level, own = open_folders.pop()
            for entry in store.get_file_info(fs.FileSelector(folder)):
                inner = entry.path[len(root) :]
                if entry.type == fs.FileType.Directory:
                    below = own or (level + 1 >= SHARED_LEVELS and mine(inner))
                    if self.recursive and (below or level + 1 < SHARED_LEVELS):
                        open_folders.append((entry.path, level + 1, below))
                elif entry.base_name.lower().endswith(self.suffixes) and (own or mine(inner)):
                    yield store, entry

    def read(self, partition: Share) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for store, entry in self._files(partition.number):
            content = None
            if self.contents:
                with store.open_input_stream(entry.path) as stream:
                    content = stream.read()
                size += len(content)
            held.append((entry.path, entry.size, content))
            if size > BATCH_BYTES or len(held) >= BATCH_FILES:
                yield _batch(held)
                held, size = [], 0
        if held:
            yield _batch(held)


def _batch(rows: list) -> pa.RecordBatch:
    paths, sizes, contents = zip(*rows)
    return pa.record_batch([pa.array(paths), pa.array(sizes, pa.int64()), pa.array(contents, pa.binary())], names=["path", "length", "content"])


class FileTree(DataSource):
    """``spark.read.format("file_tree")`` with ``path, suffixes, recursive, contents, shares``."""

    @classmethod
    def name(cls) -> str:
        return "file_tree"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> TreeReader:
        return TreeReader(self.options)


def read_tree(
    spark: SparkSession, path: str, suffixes: tuple[str, ...], *, recursive: bool = True, contents: bool = True, shares: int | None = None
) -> DataFrame:
    """Files ``path, length, content`` below a folder whose lower-case names end in one of ``suffixes``."""
    spark.dataSource.register(FileTree)
    options = {"path": path, "suffixes": ",".join(suffixes), "recursive": str(recursive).lower(), "contents": str(contents).lower()}
    return spark.read.format("file_tree").options(**options, shares=str(shares or 2 * spark.sparkContext.defaultParallelism)).load()


def write_members(members: DataFrame, folder: str) -> None:
    """Files ``member`` (a path below ``folder``) with their ``content``.  A repeated task writes the same files again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        made: set[str] = set()
        for batch in batches:
            for member, content in zip(batch["member"].to_pylist(), batch["content"].to_pylist()):
                parent = f"{root}/{member}".rpartition("/")[0]
                if parent not in made:
                    store.create_dir(parent, recursive=True)
                    made.add(parent)
                with store.open_output_stream(f"{root}/{member}") as stream:
                    stream.write(content or b"")
            yield pa.record_batch([pa.array([batch.num_rows], pa.int64())], names=["n"])

    members.select("member", "content").mapInArrow(run, "n long").write.format("noop").mode("overwrite").save()
