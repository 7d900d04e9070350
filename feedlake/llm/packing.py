"""Mixture-controlled packing by deficit round-robin over source queues.

Documents are tokenised once (ids plus one end id), written to the cluster's shared
folder, and dealt to *lanes* of about ``lane_tokens`` tokens, each with the same share
of every source's queue. A lane is one task: it holds one queue per source and fills
windows of ``window`` tokens. Before each window every source earns ``window * share``
tokens of deficit; sources that have earned ``QUANTUM`` are served by falling deficit,
what is left of the window goes to the largest deficits, and the deficit after the
window (positive or negative) is carried to the next one. Lanes are chained: a lane starts with the deficits that the lanes before it in
its chain (``CHAIN`` lanes) left behind, which follow from (lane, source) token counts
alone, so no lane waits for another. The tail of a lane is cut into powers of two, so
no sequence needs padding.

Defined cases: null text or empty text is a document of the end id alone; a null
source is a queue of its own; repeated rows are packed each on their own; an empty
table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlake.llm.common import map_arrow, tokenizer_path, written
from feedlake.llm.words import encode_batch, encoder

WINDOW = 2048
LANE_TOKENS = 1_000_000
CHAIN = 1024
QUANTUM = 256
SPOTS = 1024
BROADCAST_ROWS = 200_000


def tokenise(docs: DataFrame, path: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source") -> DataFrame:
    """One row per document: id, source, token count and ids (2 or 4 bytes each) with the end id."""
    out = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("n", pa.int64()), ("wide", pa.bool_()),
                     ("ids", pa.binary())])

    def run(it):
        enc = encoder(path)
        end, size = np.array([end_id], enc.width).tobytes(), np.dtype(enc.width).itemsize
        for b in it:
            for at, n, coded in encode_batch(enc, b.column(2)):
                ids = [x + end for x in coded]
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(at, n), b.column(1).slice(at, n),
                    pa.array([len(x) // size for x in ids], pa.int64()), pa.array([size == 4] * len(ids), pa.bool_()),
                    pa.array(ids, pa.binary())], schema=out)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       F.col(text_col).cast("string").alias("text")) \
        .transform(map_arrow, run, "doc_id long, source string, n long, wide boolean, ids binary")


def fill_windows(avail: np.ndarray, share: np.ndarray, carry: np.ndarray, window: int,
                 quantum: int = QUANTUM) -> np.ndarray:
    """Deficit round-robin: tokens that each window (row) takes from each queue (column).

    ``avail`` tokens per queue, ``share`` target proportions, ``carry`` deficits at the
    start. A queue that has earned ``quantum`` tokens is served what it earned; what is
    left of a window goes by quanta to the largest deficits, which may fall below 0. The last windows are the powers of two that
    the remainder is made of.
    """
    total = int(avail.sum())
    rest = total % window
    sizes = [window] * (total // window) + [1 << i for i in reversed(range(rest.bit_length())) if rest >> i & 1]
    left, deficit = avail.astype(np.int64).copy(), carry.astype(float).copy()
    taken = np.zeros((len(sizes), len(avail)), np.int64)
    for w, size in enumerate(sizes):
        deficit += size * share
        space = size
        order = np.argsort(-deficit, kind="stable").tolist()
        for s in order:
            if left[s] and deficit[s] >= quantum and space:
                take = min(int(left[s]), space, int(deficit[s]))
                taken[w, s] += take
                left[s] -= take
                deficit[s] -= take
                space -= take
        while space:
            for s in order:
                if left[s] and space:
                    take = min(int(left[s]), space, quantum)
                    taken[w, s] += take
                    left[s] -= take
                    deficit[s] -= take
                    space -= take
    return taken


def deal_lanes(toks: DataFrame, lanes: int, spots: int = SPOTS) -> DataFrame:
    """Adds ``lane``: every lane gets the same share of every source, up to a few documents.

    A document's spot in its source's queue is a hash of its id; the tokens of each
    source by (hash bucket) give the share of the queue before it, and that share picks
    the lane. The table of (source, bucket) sums is broadcast only if it is small.
    """
    spot = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(spots * 1024))
    rows = toks.withColumn("spot", F.floor(spot / 1024).cast("int")).withColumn("within", F.pmod(spot, F.lit(1024)) / 1024.0)
    sums = rows.groupBy("source", "spot").agg(F.sum("n").alias("m"))
    up_to = Window.partitionBy("source").orderBy("spot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = written(sums.withColumn("end", F.sum("m").over(up_to))
                   .withColumn("whole", F.sum("m").over(Window.partitionBy("source")))
                   .select(F.col("source").alias("m_source"), F.col("spot").alias("m_spot"), "m", "end", "whole"), "pack-spots")
    if sums.count() <= BROADCAST_ROWS:
        sums = F.broadcast(sums)
    share = (F.col("end") - F.col("m") * (F.lit(1.0) - F.col("within"))) / F.col("whole")
    return rows.join(sums, F.col("source").eqNullSafe(F.col("m_source")) & (F.col("spot") == F.col("m_spot"))) \
        .withColumn("lane", F.least(F.floor(share * lanes), F.lit(lanes - 1)).cast("long")) \
        .select(*toks.columns, "lane")


def pack_documents(docs: DataFrame, path: str, window: int = WINDOW, targets: dict[str, float] | None = None,
                   lane_tokens: int = LANE_TOKENS, end_id: int = 1, with_ids: bool = True, id_col: str = "doc_id",
                   text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Pieces of the packed sequences; every token of every document lies in exactly one piece.

    ``targets`` maps sources to weights (others: 0, served from what windows have left);
    without it the target is each source's share of all tokens. Returns doc_id, source,
    start, length, ids_crc32, doc_tokens, sequence_id, offset and, ``with_ids``, the
    piece's ids as little-endian 32-bit integers.
    """
    toks = written(tokenise(docs, path, end_id, id_col, text_col, source_col), "pack-ids")
    total = toks.agg(F.sum("n")).first()[0] or 0
    lanes = max(1, -(-total // lane_tokens))
    laned = deal_lanes(toks, lanes)
    counts = laned.groupBy("lane", "source").agg(F.sum("n").alias("n"))
    shares = counts.groupBy("source").agg(F.sum("n").alias("all_n"))
    if targets:
        weight = F.lit(0.0)
        for name, value in targets.items():
            weight = F.when(F.col("source") == name, F.lit(float(value))).otherwise(weight)
        shares = shares.select("source", (weight / F.lit(float(sum(targets.values())))).alias("share"))
    else:
        shares = shares.select("source", (F.col("all_n") / F.lit(float(max(total, 1)))).alias("share"))
    shares = shares.withColumnRenamed("source", "s_source")
    before = Window.partitionBy("chain", "source").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    lane_before = Window.partitionBy("chain").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    chain = F.floor(F.col("lane") / CHAIN)
    lane_sums = counts.groupBy("lane").agg(F.sum("n").alias("lane_n")).withColumn("chain", chain) \
        .select(F.col("lane").alias("l_lane"), F.coalesce(F.sum("lane_n").over(lane_before), F.lit(0)).alias("past"))
    plan = counts.withColumn("chain", chain).withColumn("mine", F.coalesce(F.sum("n").over(before), F.lit(0))) \
        .join(lane_sums, F.col("lane") == F.col("l_lane")) \
        .join(shares, F.col("source").eqNullSafe(F.col("s_source"))) \
        .select(F.col("lane").alias("p_lane"), F.col("source").alias("p_source"), "share", (F.col("share") * F.col("past") - F.col("mine")).alias("carry"))
    schema = ("doc_id long, source string, start long, length long, ids_crc32 long, doc_tokens long, "
              "sequence_id long, offset long" + (", ids binary" if with_ids else ""))

    def pack_lane(rows: pd.DataFrame, plan: pd.DataFrame) -> pd.DataFrame:
        plan = plan.sort_values("p_source", na_position="last", kind="stable")
        rows = rows.sort_values(["doc_id", "n"], kind="stable")
        names = plan["p_source"].tolist()
        lane = int(rows["lane"].iloc[0])
        queues = [rows[rows["source"].isna()] if s is None else rows[rows["source"] == s] for s in names]
        avail = np.array([int(q["n"].sum()) for q in queues], np.int64)
        taken = fill_windows(avail, plan["share"].to_numpy(float), plan["carry"].to_numpy(float), window)
        offsets = np.cumsum(taken, axis=1) - taken
        parts = []
        for s, q in enumerate(queues):
            if not avail[s]:
                continue
            ids = np.concatenate([np.frombuffer(x, "<u4" if wide else "<u2")
                                  for x, wide in zip(q["ids"], q["wide"])]).astype("<u4")
            n = q["n"].to_numpy(np.int64)
            doc_end = np.cumsum(n)
            win_end = np.cumsum(taken[:, s])
            ends = np.union1d(doc_end, win_end[taken[:, s] > 0])
            starts = np.concatenate([[0], ends[:-1]])
            doc = np.searchsorted(doc_end, starts, side="right")
            win = np.searchsorted(win_end, starts, side="right")
            raw = ids.tobytes()
            cuts = [raw[4 * a:4 * b] for a, b in zip(starts.tolist(), ends.tolist())]
            part = {"doc_id": q["doc_id"].to_numpy()[doc], "source": [names[s]] * len(starts),
                    "start": starts - (doc_end - n)[doc], "length": ends - starts,
                    "ids_crc32": [zlib.crc32(c) for c in cuts], "doc_tokens": n[doc],
                    "sequence_id": (lane << 32) + win,
                    "offset": offsets[win, s] + starts - (win_end - taken[:, s])[win]}
            if with_ids:
                part["ids"] = cuts
            parts.append(pd.DataFrame(part))
        return pd.concat(parts, ignore_index=True)

    return laned.groupBy("lane").cogroup(plan.groupBy("p_lane")).applyInPandas(
        lambda left, right: pack_lane(left, right), schema)


def q_packing(spark, sf_dir):
    from feedlake.llm.common import documents

    return pack_documents(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"), with_ids=False) \
        .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source")
