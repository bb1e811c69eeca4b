"""Digests of files by byte ranges.

Spark lists the files (the binaryFile source reads no content where none is
asked for), cuts each into pieces and deals the pieces to tasks; a task reads
its pieces in small blocks, so a file of any size needs a block of memory and
all of the cluster works on it.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PIECE_BYTES = 64 << 20      # part of the tree digest's definition
TASK_BYTES = 256 << 20
BLOCK_BYTES = 1 << 20


def open_file(path: str) -> pa.NativeFile:
    """A file by the URI Spark gives it (``file:/…`` or any scheme pyarrow knows)."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return pafs.LocalFileSystem().open_input_file("/" + unquote(rest).lstrip("/"))
    system, inner = pafs.FileSystem.from_uri(path)
    return system.open_input_file(inner)


def range_digest(path: str, start: int, length: int) -> str:
    """Lower-case hex SHA-256 of ``length`` bytes at ``start``."""
    h = hashlib.sha256()
    with open_file(path) as f:
        f.seek(start)
        left = length
        while left:
            block = f.read(min(left, BLOCK_BYTES))
            if not block:
                raise EOFError(f"{path} is shorter than when it was listed")
            h.update(block)
            left -= len(block)
    return h.hexdigest()


def list_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, bytes, modified) of every file under ``paths``, paths as URIs;
    no content is read.  Spark's file sources leave out empty files."""
    return spark.read.format("binaryFile").load(paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def piece_digests(files: DataFrame, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """(path, start, length, sha256) of every piece of ``files`` (path, bytes)."""
    from tidewell.session import ship_package
    spark = files.sparkSession
    ship_package(spark)
    total = files.agg(F.sum("bytes")).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // TASK_BYTES))
    pieces = files.select("path", "bytes", F.explode(F.sequence(
        F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(piece_bytes).cast("long"))).alias("start"))
    pieces = pieces.select("path", "start", F.least(F.col("bytes") - F.col("start"), F.lit(piece_bytes)).alias("length"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [range_digest(*(c[i].as_py() for c in batch.columns)) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], ["path", "start", "length", "sha256"])

    return pieces.repartition(tasks).mapInArrow(work, "path string, start long, length long, sha256 string")


def file_digests(files: DataFrame, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """(path, pieces, sha256, tree_sha256) per file.

    ``tree_sha256`` is the SHA-256 of the pieces' binary digests in file
    order, for every file; ``sha256`` is the plain digest where the file is
    one piece, else null.  A file's list of digests is 1/2,000,000 of it."""
    per = piece_digests(files, piece_bytes).groupBy("path").agg(F.sort_array(F.collect_list(F.struct("start", "sha256"))).alias("p"))
    digests = F.col("p.sha256")
    return per.select("path", F.size("p").cast("long").alias("pieces"),
                      F.when(F.size("p") == 1, digests[0]).alias("sha256"),
                      F.sha2(F.unhex(F.array_join(digests, "")), 256).alias("tree_sha256"))
