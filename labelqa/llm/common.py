"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import durable, ensure_checkpoint_dir, ship_package

WORD_BREAKS = b" \t\n\r\x0b\x0c"      # exactly the bytes of [\x20\x09-\x0D]


def ready(spark: SparkSession) -> SparkSession:
    """Python workers can import the package; the shared folder is known."""
    ship_package(spark)
    ensure_checkpoint_dir(spark)
    return spark


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share."""
    return os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


def store(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write to the shared folder and read again: lineage ends in files that
    survive the loss of any executor."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(col: str = "text"):
    """Null counts as the empty text."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def _zstd(dictionary: bytes):
    return zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if dictionary else None


def packed(raw, level: int = 1, dictionary: bytes = b""):
    """A binary column as zstd, for shuffles that carry whole texts. Bytes
    that many texts share can be given as a (small) ``dictionary``."""

    @F.arrow_udf("binary")
    def pack(texts: pa.Array) -> pa.Array:
        codec = zstandard.ZstdCompressor(level=level, dict_data=_zstd(dictionary))
        return pa.array([codec.compress(t or b"") for t in texts.to_pylist()], pa.binary())

    return pack(raw)


def unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def unpacked(data, dictionary: bytes = b""):
    """The text of a packed column; null stays null."""

    @F.arrow_udf("string")
    def back(parts: pa.Array) -> pa.Array:
        codec = zstandard.ZstdDecompressor(dict_data=_zstd(dictionary))
        return pa.array([None if d is None else codec.decompress(d).decode() for d in parts.to_pylist()], pa.string())

    return back(data)


def part_files(spark: SparkSession, path: str, key: str) -> DataFrame:
    """``path, length`` and the integer of ``key=<n>/`` of the files that a
    partitioned write left; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "length", F.regexp_extract("path", f"/{key}=([0-9]+)/", 1).cast("int").alias(key))


def open_uri(uri: str):
    """A random-access file by its URI, in any store that Arrow can open.

    Spark prints local paths as ``file:/a``; Arrow wants ``file:///a``.
    """
    from pyarrow import fs

    if uri.startswith("file:/") and not uri.startswith("file:///"):
        uri = "file:///" + uri[len("file:/"):]
    elif uri.startswith("/"):
        uri = "file://" + uri
    where, path = fs.FileSystem.from_uri(uri)
    return where.open_input_file(path)


__all__ = ["WORD_BREAKS", "documents", "durable", "open_uri", "packed", "part_files", "ready", "shared_path", "store", "text_of", "unpack", "unpacked"]
