"""Shared helpers of the text operators: tables, the shared folder, sizing, raw array files."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.session import checkpoint_dir, settings

# One reduce task's share of shuffled bytes; shard counts follow the input.
SHARD_BYTES = 16 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


# shuffle files of a write are removed when it has ended, not when the driver next collects garbage
WRITE_CONF = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts lineage, survives lost executors, leaves no shuffle files."""
    path = scratch(df.sparkSession, name)
    with settings(df.sparkSession, WRITE_CONF):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(df: DataFrame, column: str = "text") -> int:
    """Bytes of all texts (one number)."""
    return int(df.agg(F.coalesce(F.sum(F.octet_length(column)), F.lit(0))).first()[0])


def shards_for(n_bytes: int, per: int = SHARD_BYTES) -> int:
    """Number of shards for so many bytes: follows the data, no upper limit."""
    return max(8, -(-int(n_bytes) // per))


def let(value, use):
    """``use(value)`` with the value computed once a row, also inside lambdas (a plain column would be inlined there)."""
    return F.get(F.transform(F.array(value), use), 0)


def crc_mod(column: str, mod: int):
    """crc32 of the column's text modulo ``mod`` (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % mod


class ArrayStore:
    """Raw little-endian array files in a folder that driver and executors share.

    Writers are tasks: a file is written under a temporary name and moved, so
    a retried or speculative task leaves the same file. Readers map files into
    memory where the folder is mounted; for other file systems each worker
    downloads a file once into its own temporary file and maps that.
    """

    def __init__(self, url: str):
        self.url = url

    def _fs(self):
        url = self.url if "://" in self.url or self.url.startswith("/") is False else "file://" + self.url
        if url.startswith("file:") and not url.startswith("file://"):
            url = "file://" + url[5:]
        return pafs.FileSystem.from_uri(url)

    def write(self, name: str, array: np.ndarray) -> None:
        fs, base = self._fs()
        fs.create_dir(base, recursive=True)
        tmp = f"{base}/.{name}.{uuid.uuid4().hex}"
        with fs.open_output_stream(tmp) as out:
            if array.size:
                out.write(memoryview(np.ascontiguousarray(array)).cast("B"))
        fs.move(tmp, f"{base}/{name}")

    def map(self, name: str, dtype) -> np.ndarray:
        fs, base = self._fs()
        path = f"{base}/{name}"
        if fs.get_file_info(path).size == 0:
            return np.empty(0, dtype)
        if not isinstance(fs, pafs.LocalFileSystem):
            import tempfile

            with tempfile.NamedTemporaryFile(delete=False) as local, fs.open_input_stream(path) as src:
                while block := src.read(1 << 22):
                    local.write(block)
            path = local.name
        return np.memmap(path, dtype=dtype, mode="r")
