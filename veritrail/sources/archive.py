"""A compressed tar written by many tasks.

Entries are range-partitioned and sorted by task and path. Each task makes gzip members of some MEMBER_BYTES of whole entries; a file of members
end to end is one gzip stream. Their sizes alone are summed up, by task and within it, so every member knows its offset, and tasks
write them into the one file side by side. Nobody holds the archive: a task holds a member and one file. A member can be read without the others.

The place must be a folder that all executors share. A task that runs again writes the same bytes at the same place, as members are made
once and kept in a table until then. The file appears under its name when it is whole.

Edge cases: no entries give an archive without any. Folders get an entry of their own, before what is in them. A file may come twice. Null content is empty. Names of any length and alphabet are kept.
"""

from __future__ import annotations

import gzip
import io
import os
import tarfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veritrail.sources.shared import settle

MEMBER_BYTES = 4 << 20
MEMBERS = "part int, seq int, first string, n long, size long, member binary"
END = 2 * tarfile.BLOCKSIZE  #: zeros after the last entry


def entries(files: DataFrame) -> DataFrame:
    """files (task_id, path, content) with a row of null content for each folder, whose path ends with a slash."""
    parts = F.split("path", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k - 1), "/"))
    folders = files.select("task_id", F.explode(above).alias("path")).distinct()
    as_folder = F.when(F.col("path") == "", "").otherwise(F.concat("path", F.lit("/")))
    return files.select("task_id", "path", F.coalesce("content", F.lit("")).alias("content")).unionByName(folders.select("task_id", as_folder.alias("path"), F.lit(None).cast("string").alias("content")))


def packed(task_id: str, path: str, content: str | None) -> bytes:
    """An entry's header and padded content."""
    info = tarfile.TarInfo(f"{task_id}/{path}".rstrip("/"))
    data = b"" if content is None else content.encode()
    info.size, info.mode, info.type = len(data), 0o755 if content is None else 0o644, tarfile.DIRTYPE if content is None else tarfile.REGTYPE
    return info.tobuf(tarfile.GNU_FORMAT, "utf-8", "surrogateescape") + data + bytes(-len(data) % tarfile.BLOCKSIZE)


def members(files: DataFrame) -> DataFrame:
    """(part, seq, first, n, size, member, offset), written: the archive in order of part and seq; first: the first entry's name."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq, held, size, first = TaskContext.get().partitionId(), 0, [], 0, ""

        def done() -> pa.RecordBatch:
            data = gzip.compress(b"".join(held), 6, mtime=0)
            values = [part, seq, first, len(held), len(data), data]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.binary()], strict=True)], names=[c.split()[0] for c in MEMBERS.split(", ")])

        for batch in batches:
            for task_id, path, content in zip(*(batch.column(i) for i in range(3)), strict=True):
                first = first if held else f"{task_id}/{path}"
                held.append(packed(task_id.as_py(), path.as_py(), content.as_py()))
                size += len(held[-1])
                if size >= MEMBER_BYTES:
                    yield done()
                    seq, held, size = seq + 1, [], 0
        if held:
            yield done()

    made = settle(entries(files).repartitionByRange("task_id", "path").sortWithinPartitions("task_id", "path").mapInArrow(make, MEMBERS), "members")
    sizes = made.groupBy("part").agg(F.sum("size").alias("bytes"))  # a row for each task
    bases = sizes.select("part", (F.sum("bytes").over(Window.orderBy("part")) - F.col("bytes")).alias("base"))
    within = F.sum("size").over(Window.partitionBy("part").orderBy("seq")) - F.col("size")
    offsets = made.select("part", "seq", within.alias("within")).join(F.broadcast(bases), "part").select("part", "seq", (F.col("base") + F.col("within")).alias("offset"))
    return made.join(offsets, ["part", "seq"])


def write(files: DataFrame, path: str) -> DataFrame:
    """Write files as an archive at path; returns its index (first, n, offset, size), a row a member."""
    path = path.removeprefix("file://")
    table = settle(members(files), "archive")
    partial = f"{path}.partial"
    end = gzip.compress(bytes(END), mtime=0)
    total = table.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    with open(partial, "wb") as file:
        file.truncate(total)
        file.seek(total)
        file.write(end)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            with open(partial, "r+b") as file:
                for offset, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    file.seek(offset)
                    file.write(data.as_buffer())
                file.flush()
                os.fsync(file.fileno())
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    written = table.select("offset", "member").mapInArrow(put, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if written != table.count():
        raise OSError(f"{path}: {written} members were written")
    os.replace(partial, path)
    return table.select("first", "n", "offset", "size")


def read(spark: SparkSession, index: DataFrame, path: str) -> DataFrame:
    """(name, size, folder) of an archive's entries, member by member."""
    path = path.removeprefix("file://")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for offset, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with open(path, "rb") as file:
                    file.seek(offset)
                    data = gzip.decompress(file.read(size))
                with tarfile.open(fileobj=io.BytesIO(data + bytes(END))) as tar:
                    found = [(m.name, m.size, m.isdir()) for m in tar.getmembers()]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*found, strict=True)], names=["name", "size", "folder"])

    return index.select("offset", "size").mapInArrow(unpack, "name string, size long, folder boolean")
