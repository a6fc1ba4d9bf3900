"""Helpers shared by the operators: shared folder, staged tables, raw files.

Every intermediate goes under the folder named in ``spark.checkpoint.dir``;
executors and driver share nothing else. Files that tasks write themselves are
written under an attempt name and moved into place, so a retried or speculative
task leaves one whole file.
"""

from __future__ import annotations

import os
import sys
import tempfile
import types
import uuid
from collections import OrderedDict

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lendscope.session import scratch_path


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name for one call, removed when the application ends."""
    return scratch_path(spark, "llm", name)


def staged(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and read it back (cuts the lineage)."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Tables of up to this many (narrow) rows go to every task, so that the other side of a join stays where it is
LOOKUP_ROWS = 100_000


def lookup(df: DataFrame, small: bool) -> DataFrame:
    """``df`` as the side of a join that is sent to every task, if it is ``small``."""
    return F.broadcast(df) if small else df


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold(id_col: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``."""
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(modulus))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def byte_texts(col: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    return [b or b"" for b in col.cast(pa.binary()).to_pylist()]


def str_texts(col: pa.Array) -> list[str]:
    """Strings of a column, null as empty."""
    return [t or "" for t in col.to_pylist()]


def batch(schema: pa.Schema, *cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t)
                                       for c, t in zip(cols, schema.types, strict=True)], schema=schema)


#: Names that Hadoop and Arrow give the same store
_ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3", "gcs": "gs"}


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    """The store and the path in it of a folder name that Spark understands."""
    scheme, colon, rest = uri.partition(":")
    if not colon or "/" in scheme:
        return pafs.LocalFileSystem(), uri
    if scheme in ("file", "dbfs"):  # dbfs is mounted under a folder of that name
        path = "/" + rest.lstrip("/")
        return pafs.LocalFileSystem(), path if scheme == "file" else f"/dbfs{path}"
    return pafs.FileSystem.from_uri(f"{_ARROW_SCHEMES.get(scheme, scheme)}:{rest}")


def put_file(uri: str, chunks: list) -> None:
    """Write one file whole: under an attempt name first, then moved into place."""
    fs, path = _open(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    attempt = f"{path}.{uuid.uuid4().hex}"
    with fs.open_output_stream(attempt) as out:
        for c in chunks:
            out.write(memoryview(np.ascontiguousarray(c)).cast("B") if isinstance(c, np.ndarray) else c)
    fs.move(attempt, path)


#: Copied files that a worker process keeps mapped
KEPT_COPIES = 256


def _copies() -> OrderedDict:
    """The worker process's copies. Functions travel by value, so each task has its
    own globals; what the tasks of a process share is kept in a module."""
    holder = sys.modules.setdefault("_mapped_copies", types.ModuleType("_mapped_copies"))
    return holder.__dict__.setdefault("files", OrderedDict())


def mapped(uri: str) -> np.ndarray:
    """The file's bytes, memory-mapped. On a store without file paths the worker
    first copies the file into its own temporary folder and maps the copy, which has
    no name from then on: its space is free when the last array over it is gone. The
    last ``KEPT_COPIES`` are kept for the later tasks of the process (a file in the
    shared folder is never changed)."""
    fs, path = _open(uri)
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(path, dtype=np.uint8, mode="r") if os.path.getsize(path) else np.zeros(0, np.uint8)
    copies = _copies()
    if uri not in copies:
        with tempfile.TemporaryFile() as out:
            with fs.open_input_stream(path) as src:
                while piece := src.read(1 << 22):
                    out.write(piece)
            out.flush()
            copies[uri] = np.memmap(out, dtype=np.uint8, mode="r") if out.tell() else np.zeros(0, np.uint8)
        while len(copies) > KEPT_COPIES:
            copies.popitem(last=False)
    copies.move_to_end(uri)
    return copies[uri]
