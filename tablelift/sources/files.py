"""File trees as tables: manifests, and mirrors of one tree in another.

A manifest is read with Spark's `binaryFile` source, so listing, globs and
hashing happen where Spark reads; the contents are read only if they are hashed.
What a mirror has to do is a join of two manifests.  Copies and removals are
dealt over tasks, which stream each file from one store to the other.
"""

from __future__ import annotations

import fnmatch
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pa_fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelift.scale import local_frame, materialise, materialise_counted
from tablelift.sources.mirror import mirror_plan

CHUNK = 8 << 20  # bytes of a file held while it is copied


def _root(path: str) -> str:
    """An absolute path or URI without a slash at its end; `file:/x` is written as a path."""
    return re.sub(r"^file:/+", "/", path).rstrip("/")


def file_manifest(spark: SparkSession, root: str, glob: str | None = None, content: bool = True) -> DataFrame:
    """(path, length, modified, fingerprint) of all files below `root`, at any depth; a missing or empty folder has none.

    `path` is relative to `root` and `glob` a pattern of `*`, `?` and `[…]` for
    file names.  The fingerprint is the SHA-256 of the contents, or with
    `content` off the length alone, for which no file is opened.  Like Spark's
    other sources, it passes over names that begin with a dot or an underscore.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    schema = "path string, length long, modified timestamp, fingerprint string"
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], schema)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    files = (reader.option("pathGlobFilter", glob) if glob else reader).load(root)
    base = folder.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(folder).toUri().getPath().rstrip("/")
    local = F.regexp_replace("path", r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")  # without scheme and host
    below = F.substr(local, F.lit(len(base) + 2))
    print_of = F.sha2("content", 256) if content else F.col("length").cast("string")
    held = files.select(below.alias("path"), "length", F.col("modificationTime").alias("modified"), print_of.alias("fingerprint"))
    blank = F.sha2(F.lit(b""), 256) if content else F.lit("0")
    return held.unionByName(_empty_files(spark, root, glob).withColumn("fingerprint", blank))


def _empty_files(spark: SparkSession, root: str, glob: str | None) -> DataFrame:
    """(path, length, modified) of the files without contents, which `binaryFile` leaves out; one task lists one entry of `root`."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    entries = [e.getPath().getName() for e in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)]
    base = _root(root)

    def list_entry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, start = pa_fs.FileSystem.from_uri(base)
        for batch in batches:
            found = []
            for name in batch.column("entry").to_pylist():
                own = files.get_file_info(f"{start}/{name}")
                found += [own] if own.is_file else files.get_file_info(pa_fs.FileSelector(f"{start}/{name}", recursive=True, allow_not_found=True))
            rows = [(f.path[len(start) + 1 :], f.mtime) for f in found if f.is_file and f.size == 0]
            rows = [r for r in rows if not re.search(r"(^|/)[._]", r[0]) and (glob is None or fnmatch.fnmatchcase(r[0].rpartition("/")[2], glob))]
            paths, times = pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.timestamp("us", "UTC"))
            yield pa.RecordBatch.from_arrays([paths, pa.array([0] * len(rows), pa.int64()), times], ["path", "length", "modified"])

    listed = local_frame(spark, [(e,) for e in sorted(entries)], T.StructType.fromDDL("entry string"))
    parts = min(max(1, len(entries)), int(spark.conf.get("spark.sql.shuffle.partitions")))
    return listed.repartition(parts).mapInArrow(list_entry, "path string, length long, modified timestamp")


def file_plan(src: DataFrame, dst: DataFrame) -> DataFrame:
    """(path, action) that makes the second manifest like the first: copy, update, delete or keep."""
    return mirror_plan(src, dst, "path", "fingerprint")


def _copy(source: pa_fs.FileSystem, start: str, target: pa_fs.FileSystem, end: str) -> int:
    """Stream one file; it appears under its name only when it is whole."""
    folder, _, name = end.rpartition("/")
    target.create_dir(folder, recursive=True)
    partial, done = f"{folder}/.{name}-{uuid.uuid4().hex}", 0
    with source.open_input_stream(start) as read, target.open_output_stream(partial) as write:
        while chunk := read.read(CHUNK):
            write.write(chunk)
            done += len(chunk)
    target.move(partial, end)
    return done


def mirror_files(spark: SparkSession, src_root: str, dst_root: str, glob: str | None = None, content: bool = True) -> DataFrame:
    """Make the files below `dst_root` those below `src_root`, extras removed; (path, action, bytes) of each.

    Files that agree in their fingerprint are left alone.  A task that is
    retried copies its files again, which does no harm.  Folders are made as
    needed and not removed.  Both roots must be stores that the tasks reach.
    """
    plan = file_plan(file_manifest(spark, src_root, glob, content), file_manifest(spark, dst_root, glob, content))
    plan = materialise(plan, "file-plan")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    source_root, target_root = _root(src_root), _root(dst_root)

    def act(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, start = pa_fs.FileSystem.from_uri(source_root)
        target, end = pa_fs.FileSystem.from_uri(target_root)
        for batch in batches:
            done = []
            for path, action in zip(batch.column("path").to_pylist(), batch.column("action").to_pylist(), strict=True):
                if action == "delete":
                    if target.get_file_info(f"{end}/{path}").type != pa_fs.FileType.NotFound:
                        target.delete_file(f"{end}/{path}")
                    done.append(0)
                else:
                    done.append(_copy(source, f"{start}/{path}", target, f"{end}/{path}"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(done, pa.int64())], ["path", "action", "bytes"])

    busy = plan.where("action <> 'keep'").repartition(parts, "path").mapInArrow(act, "path string, action string, bytes long")
    acted, _ = materialise_counted(busy, "mirrored", {"files": F.lit(True)})
    return acted.unionByName(plan.where("action = 'keep'").withColumn("bytes", F.lit(0).cast("long")))


def write_files(rows: DataFrame, root: str, path: str | Column, content: str | Column) -> DataFrame:
    """One file per row below `root`, named by `path`; (path, bytes) of what was written.

    Text is written as UTF-8.  Of rows that share a path the one with the
    smallest content counts, so that a retry or a rerun writes the same.
    """
    named = rows.select((F.col(path) if isinstance(path, str) else path).alias("path"), (F.col(content) if isinstance(content, str) else content).cast("binary").alias("content"))
    single = named.where("path IS NOT NULL").groupBy("path").agg(F.min(F.coalesce("content", F.lit(b""))).alias("content"))
    target_root = _root(root)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, end = pa_fs.FileSystem.from_uri(target_root)
        for batch in batches:
            paths, contents = batch.column("path").to_pylist(), batch.column("content").to_pylist()
            sizes = [_copy(_Bytes(held), "", target, f"{end}/{name}") for name, held in zip(paths, contents, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(sizes, pa.int64())], ["path", "bytes"])

    return materialise(single.mapInArrow(put, "path string, bytes long"), "files")


class _Bytes:
    """Bytes in place of a file to copy from."""

    def __init__(self, held: bytes):
        self.held = held

    def open_input_stream(self, _: str) -> pa.BufferReader:
        return pa.BufferReader(self.held)
