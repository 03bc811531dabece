"""Helpers shared by the operators: whole-text words, shared-folder files, blocks."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession

from weft.session import scratch_path

_LOWER = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())


def lower_ascii(text: bytes | None) -> bytes:
    """A-Z lower-cased; null is empty."""
    return b"" if text is None else text.translate(_LOWER)


def canonical_words(text: bytes | None) -> list[bytes]:
    """Lower-cased words ``[^\\x20\\x09-\\x0D]+`` (bytes.split() cuts at exactly these)."""
    return lower_ascii(text).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def by_place(docs: DataFrame, *named: str) -> tuple[DataFrame, list[str]]:
    """The same columns under names ``c0``, ``c1``, ... (so that none can clash with an
    operator's own, hold a dot or be there twice), and the new names of some of them."""
    return docs.toDF(*[f"c{k}" for k in range(len(docs.columns))]), [f"c{docs.columns.index(n)}" for n in named]


def materialise(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write to a fresh folder of the shared checkpoint folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def open_store(path: str):
    """The file system that a folder of the shared storage lives in, and the path there.

    Works for a plain path and for any address pyarrow knows (file:, hdfs:, s3:, ...)."""
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


def read_range(file, offset: int, size: int) -> bytes:
    """``size`` bytes at ``offset`` of an open random-access file; raises when cut short."""
    data = file.read_at(size, offset)
    if len(data) != size:
        raise ValueError(f"file ends at byte {offset + len(data)}, {size - len(data)} bytes early")
    return data


def raw_bytes(value) -> bytes:
    """The bytes of an Arrow string or binary value, valid UTF-8 or not; null is empty."""
    buffer = value.as_buffer() if value.is_valid else None
    return b"" if buffer is None else buffer.to_pybytes()


def give_back() -> None:
    """Return freed memory to the system; a Python worker that has done a large task serves
    other stages next, and what it keeps counts against its executor."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def by_size(batch, column: str, size: int):
    """Slices of a record batch whose values in a binary column make up about ``size``
    bytes; a value larger than that is a slice of its own."""
    import numpy as np
    import pyarrow.compute as pc

    if not len(batch):
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(batch):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right")))
        yield batch.slice(at, stop - at)
        at = stop
