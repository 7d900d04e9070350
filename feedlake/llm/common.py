"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import os

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.session import shared_dir



def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer_path(name: str, folder: str | None = None) -> str:
    """Path of a public tokenizer file, the same on every executor: in ``folder`` or where the package keeps it."""
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def id_bucket(id_col: str, n: int) -> Column:
    """crc32 of the id's decimal text, modulo n (null id: null)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % F.lit(n)


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write to the cluster's shared folder and read back."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
MAX_BATCH_ROWS = 1024


def map_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` with batches of at most 1024 rows: whole texts in batches of Spark's
    default 10,000 take hundreds of MB beside the heap of an executor."""
    conf = df.sparkSession.conf
    if int(conf.get(BATCH_ROWS)) > MAX_BATCH_ROWS:
        conf.set(BATCH_ROWS, str(MAX_BATCH_ROWS))


    def run(batches):
        try:
            yield from fn(batches)
        finally:
            release_memory()

    return df.mapInArrow(run, schema)


def release_memory() -> None:
    """Give freed memory back to the system: worker processes live on and serve later stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


class ByteCache:
    """Dict with a bound in bytes: two generations, the older one dropped when the younger is full."""

    def __init__(self, limit: int):
        self.half, self.used, self.young, self.old = limit // 2, 0, {}, {}

    def get(self, key):
        found = self.young.get(key)
        if found is None and self.old:
            found = self.old.get(key)
            if found is not None:
                self.put(key, found)
        return found

    def put(self, key, value) -> None:
        # About what a dict entry, a short str and a short bytes object take besides their contents.
        size = len(key) + len(value) + 200
        if size > self.half // 16:
            return
        if self.used + size > self.half:
            self.old, self.young, self.used = self.young, {}, 0
        self.used += size
        self.young[key] = value


_KEPT: list = [None, None]


def worker_state(key, make):
    """What a worker process keeps between tasks, for one key only: another operator's state makes room."""
    if _KEPT[0] != key:
        _KEPT[:] = [None, None]
        _KEPT[:] = [key, make()]
    return _KEPT[1]


def ascii_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as UTF-8 bytes, A-Z lower-cased.

    ``bytes.lower`` touches ASCII letters only and ``bytes.split`` splits at exactly
    these six white-space bytes.
    """
    return text.encode().lower().split() if text else []


def batches(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, schema)], schema=schema)


def quiet_threads() -> None:
    """One thread per task for the native tokenizer."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"


__all__ = ["ByteCache", "ascii_words", "batches", "documents", "id_bucket", "map_arrow", "quiet_threads", "release_memory", "shared_dir",
           "tokenizer_path", "worker_state", "written"]
