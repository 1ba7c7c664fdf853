"""Files as streams: digests of any length in bounded memory, and first bytes without the rest.

Spark lists the files (their contents are not read for that) and deals them to tasks; a task opens
each of its files through Arrow's file systems, which know local paths and the usual object
stores, and reads it in chunks. No file is ever a row. An empty file has no row: Spark lists none.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: How much of a file is read at once, and how much of one a probe looks at.
CHUNK, PREFIX = 8 << 20, 262_144


def _open(path: str):
    """A file as a stream of its bytes as they are stored."""
    uri = re.sub(r"^s3[an]://", "s3://", re.sub(r"^file:/(?!//)", "file:///", path))
    system, inner = pafs.FileSystem.from_uri(uri)
    return system.open_input_stream(inner, compression=None)


def _listed(spark: SparkSession, path: str) -> DataFrame:
    """(path, byte_size), one file to a partition as far as there are partitions."""
    files = spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("byte_size"))
    return files.repartition(spark.sparkContext.defaultParallelism * 4, "path")


def digests(spark: SparkSession, path: str, chunk: int = CHUNK) -> DataFrame:
    """(path, byte_size, content_hash) of files; the size is that of the bytes that were hashed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p in b.column(0).to_pylist():
                sha, n = hashlib.sha256(), 0
                with _open(p) as stream:
                    while part := stream.read(chunk):
                        sha.update(part)
                        n += len(part)
                yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([n], pa.int64()), pa.array([sha.hexdigest()])], names=["path", "byte_size", "content_hash"])

    return _listed(spark, path).mapInArrow(run, "path string, byte_size long, content_hash string")


def prefixes(spark: SparkSession, path: str, size: int = PREFIX) -> DataFrame:
    """(path, byte_size, prefix): the first ``size`` bytes of files, and how large these are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                with _open(p) as stream:
                    head = stream.read(size)
                yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([n], pa.int64()), pa.array([head], pa.binary())], names=["path", "byte_size", "prefix"])

    return _listed(spark, path).mapInArrow(run, "path string, byte_size long, prefix binary")


def has_bytes(prefix: Column, text: str) -> Column:
    """Whether the UTF-8 bytes of a text stand in a prefix; what its end cuts off isn't there."""
    # latin-1 has a character for each byte
    return F.contains(F.decode(prefix, "ISO-8859-1"), F.lit(text.encode().decode("latin-1")))


def verify(spark: SparkSession, path: str, content_hash: str, byte_size: int) -> None:
    """Raise unless the file's bytes, however many, are exactly those of the snapshot."""
    found = digests(spark, path).first()
    if found is None or (found.content_hash, found.byte_size) != (content_hash, byte_size):
        raise ValueError(f"{path} is not the snapshot that was recorded")


def migration_files(spark: SparkSession, path: str) -> DataFrame:
    """(version, file_sha256) of the migrations in a folder: SQL files whose names begin with their number."""
    number = F.regexp_extract("path", r"/(\d+)_[^/]*\.sql$", 1)
    return digests(spark, f"{path}/*.sql").select(number.alias("version"), F.col("content_hash").alias("file_sha256")).where("version <> ''")
