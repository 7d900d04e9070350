"""Token-ID files: documents' ids in id order, in blocks of the range coder of ``rangecoder``.

Writing: documents are tokenised once, written, and dealt by ranges of (doc_id, number) to
tasks of about ``TASK_IDS`` ids, nulls first; each task sorts its range and codes it block
by block, ``BLOCK_IDS`` ids each. The number is the row's place in its tokenising task, so
rows that share an id (a third of the table, say) are spread over many ranges. The files
are Parquet whose rows are blocks: ``part``, ``seq``, ``before`` (ids of the part before the
block), ``n_ids`` and ``block``, the coded bytes, which hold ids, documents and checksums.
Spark's writer commits them, so a task that is lost runs again.

Reading: each block is decoded on its own, by any task; an id's place follows from the
parts' sums. Documents that lie in several blocks are put together by their start; their CRC-32 is combined from those of the pieces.

Defined cases: null or empty text is the end id alone; documents without an id come first;
rows that share an id follow each other in any order; a document may span any number of
blocks; an empty table gives no rows; other columns are ignored; a damaged block stops the
read with ``ValueError``.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import LongType

from feedlake.llm.common import documents, map_arrow, shared_dir, tokenizer_path, written
from feedlake.llm.packing import tokenise
from feedlake.llm.rangecoder import decode_block, encode_block

BLOCK_IDS = 1 << 22
TASK_IDS = 1 << 23
FIELDS = ("doc_id", "no_id", "first", "n", "total")
BLOCKS = "part int, seq int, before long, n_ids long, block binary"
#: CRC-32 in its usual reflected form.
POLYNOMIAL = 0xEDB88320


def write_ids(docs: DataFrame, path: str, folder: str, end_id: int = 2, block_ids: int = BLOCK_IDS,
              task_ids: int = TASK_IDS, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Write the ids of all documents (each with ``end_id``) to ``folder``; returns it."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.lit(None).cast("string").alias("source"))
    toks = written(tokenise(source, path, end_id).drop("source").withColumn("salt", F.monotonically_increasing_id()), "ids-tokens")
    total = toks.agg(F.sum("n")).first()[0] or 0
    order = [F.col("doc_id").asc_nulls_first(), F.col("salt")]
    ranges = toks.repartitionByRange(max(1, -(-total // task_ids)), *order).sortWithinPartitions(*order)
    map_arrow(ranges.select("doc_id", "n", "wide", "ids"), _coder(block_ids), BLOCKS).write.parquet(folder)
    return folder


def _coder(block_ids: int):
    schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("before", pa.int64()), ("n_ids", pa.int64()),
                        ("block", pa.binary())])

    def run(it):
        part, seq, before, size = TaskContext.get().partitionId(), 0, 0, 0
        ids, pieces = [], []

        def block():
            coded = encode_block(np.concatenate(ids), np.array(pieces, "<i8").tobytes())
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in
                                               zip([part, seq, before, size, coded], schema)], schema=schema)

        for b in it:
            rows = zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3))
            for doc_id, n, wide, raw in rows:
                doc, first = np.frombuffer(raw.as_buffer(), "<u4" if wide else "<u2"), 0
                while first < n:
                    take = min(n - first, block_ids - size)
                    ids.append(doc[first:first + take].astype("<u4"))
                    pieces.append((doc_id or 0, doc_id is None, first, take, n))
                    first, size = first + take, size + take
                    if size == block_ids:
                        yield block()
                        seq, before, size, ids, pieces = seq + 1, before + size, 0, [], []
        if size:
            yield block()

    return run


def _pieces(spark: SparkSession, folder: str, with_ids: bool) -> DataFrame:
    """One row per document and block: the piece's place, CRC-32 and (``with_ids``) its ids."""
    schema = pa.schema([("part", pa.int32()), *((f, pa.int64()) for f in FIELDS), ("start", pa.int64()), ("crc", pa.int64()),
                        *([("ids", pa.binary())] if with_ids else [])])

    def run(it):
        for b in it:
            for part, before, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                ids, table = decode_block(raw.as_py())
                table = np.frombuffer(table, "<i8").reshape(-1, len(FIELDS))
                ends = np.cumsum(table[:, 3])
                starts, whole = ends - table[:, 3], memoryview(ids.view("u1"))
                cuts = [whole[4 * a:4 * z] for a, z in zip(starts.tolist(), ends.tolist())]
                columns = [np.full(len(table), part, np.int32), *table.T, before + starts - table[:, 2],
                           np.array([zlib.crc32(c) for c in cuts], np.int64)]
                arrays = [pa.array(np.ascontiguousarray(c)) for c in columns]
                arrays[1] = pa.array(table[:, 0], mask=table[:, 1].astype(bool))
                if with_ids:
                    arrays.append(pa.array([bytes(c) for c in cuts], pa.binary()))
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    blocks = spark.read.schema(BLOCKS).parquet(folder)
    columns = ", ".join(["part int", *(f"{f} long" for f in FIELDS), "start long", "crc long", *(["ids binary"] if with_ids else [])])
    found = map_arrow(blocks.select("part", "before", "block"), run, columns)
    # One row per part: a few thousand at most.
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("mine")) \
        .select(F.col("part").alias("p_part"), (F.sum("mine").over(Window.orderBy("part")) - F.col("mine")).alias("past"))
    return found.join(F.broadcast(parts), F.col("part") == F.col("p_part")) \
        .withColumn("start", F.col("start") + F.col("past")).drop("p_part", "past", "no_id")


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo that of CRC-32, in reflected bits (x**0 is the top bit)."""
    product = 0
    for bit in range(31, -1, -1):
        if a >> bit & 1:
            product ^= b
        b = b >> 1 ^ (POLYNOMIAL if b & 1 else 0)
    return product


def join_crcs(pieces: list[tuple[int, int]]) -> int:
    """CRC-32 of byte strings in a row from (bytes, CRC-32) of each."""
    crc = 0
    for size, mine in pieces:
        shift, square = 1 << 31, 1 << 23  # x**0 and x**8, one byte
        while size:
            if size & 1:
                shift = _times(shift, square)
            square, size = _times(square, square), size >> 1
        crc = _times(shift, crc) ^ mine
    return crc


@arrow_udf(LongType())
def _joined(parts: pa.Array) -> pa.Array:
    return pa.array([join_crcs([(4 * p["n"], p["crc"]) for p in row]) for row in parts.to_pylist()], pa.int64())


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document: doc_id, start, n_tokens and the CRC-32 of its ids (little-endian, 32 bits each)."""
    pieces = written(_pieces(spark, folder, False), "ids-pieces")
    whole = pieces.where(F.col("n") == F.col("total")) \
        .select("doc_id", "start", F.col("total").alias("n_tokens"), F.col("crc").alias("ids_crc32"))
    cut = _by_document(pieces, F.struct("first", "n", "crc"))
    return whole.unionByName(cut.select("doc_id", "start", "n_tokens", _joined("parts").alias("ids_crc32")))


def _by_document(pieces: DataFrame, part) -> DataFrame:
    """Documents of several pieces, the pieces in order; they all have the same start."""
    return pieces.where(F.col("n") < F.col("total")).groupBy("start", "total") \
        .agg(F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list(part)).alias("parts")) \
        .select("doc_id", "start", F.col("total").alias("n_tokens"), "parts")


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document: doc_id, start, n_tokens and its ids (little-endian, 32 bits each)."""
    pieces = written(_pieces(spark, folder, True), "ids-pieces")
    whole = pieces.where(F.col("n") == F.col("total")).select("doc_id", "start", F.col("total").alias("n_tokens"), "ids")
    cut = _by_document(pieces, F.struct("first", "ids"))
    joined = F.aggregate("parts", F.lit(b""), lambda acc, p: F.concat(acc, p["ids"]))
    return whole.unionByName(cut.select("doc_id", "start", "n_tokens", joined.alias("ids")))


def q_tokens(spark, sf_dir):
    folder = write_ids(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"), shared_dir(spark, "op11-ids"))
    return read_digests(spark, folder)
