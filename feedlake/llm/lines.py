"""Line dedup: overlapping windows of consecutive lines, later occurrences removed.

Native: DataFrame functions only. Each line is hashed once; a window is the hash (two
64-bit hashes) of ``window`` consecutive line hashes. Windows that occur more than once
keep their first occurrence, in order of (doc_id, position); each later occurrence
marks the lines it covers, and marks of overlapping windows merge. Counting windows
aggregates before the shuffle, and the marks come from a join that splits hot windows.

Defined cases: null text counts as empty; a text of fewer lines than the window has no
window and stays as it is; lines are compared exactly, blank ones included, so windows of
blank lines count too; rows that share doc_id and text are one document for the choice of
the first occurrence and come out alike; null ids sort first; empty tables stay empty;
other columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import documents, written

WINDOW = 3


def line_marks(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document that loses lines: __ld_id, __ld_key, __ld_at (line numbers from 0, sorted)."""
    lines = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)
    hashes = docs.select(F.col(id_col).alias("__ld_id"), F.xxhash64(F.col(text_col)).alias("__ld_key"),
                         F.transform(lines, lambda x: F.struct(F.xxhash64(x).alias("a"),
                                                               F.xxhash64(F.lit(7), x).alias("b"))).alias("h")) \
        .where(F.size("h") >= window)
    wins = F.transform(F.sequence(F.lit(0), F.size("h") - F.lit(window)), lambda i: F.struct(
        F.xxhash64(*[F.get(F.col("h"), i + j)["a"] for j in range(window)]).alias("a"),
        F.xxhash64(*[F.get(F.col("h"), i + j)["b"] for j in range(window)]).alias("b")))
    wins = hashes.select("__ld_id", "__ld_key", F.posexplode(wins).alias("at", "w")) \
        .select("__ld_id", "__ld_key", "at", F.col("w.a").alias("a"), F.col("w.b").alias("b"))
    # Written first: a join of two plain shuffles is one whose hot windows Spark can split.
    first = written(wins.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("__ld_id", "__ld_key", "at")).alias("f"))
                    .where("n > 1").select(F.col("a").alias("fa"), F.col("b").alias("fb"), "f"), "line-windows")
    later = wins.join(first, (F.col("a") == F.col("fa")) & (F.col("b") == F.col("fb"))) \
        .where(~F.struct("__ld_id", "__ld_key", "at").eqNullSafe(F.col("f")))
    covered = F.flatten(F.transform(F.collect_set("at"), lambda p: F.sequence(p, p + F.lit(window - 1))))
    return later.groupBy("__ld_id", "__ld_key").agg(F.array_sort(F.array_distinct(covered)).alias("__ld_at"))


def dedup_lines(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with later occurrences of repeated line windows taken out of ``text_col``.

    Adds n_lines and n_removed_lines; a null text stays null.
    """
    marks = line_marks(docs, window, id_col, text_col)
    at = F.coalesce(F.col("__ld_at"), F.array().cast("array<int>"))
    lines = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size("__ld_lines") - 1), at)
    text = F.when(F.size(at) == 0, F.col(text_col)) \
        .otherwise(F.array_join(F.transform(kept, lambda i: F.get(F.col("__ld_lines"), i)), "\n"))
    joined = docs.withColumn("__ld_hash", F.xxhash64(F.col(text_col))) \
        .join(marks, F.col(id_col).eqNullSafe(F.col("__ld_id")) & (F.col("__ld_hash") == F.col("__ld_key")), "left") \
        .withColumn("__ld_lines", lines)
    keep = [text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns
            if c not in ("n_lines", "n_removed_lines")]
    return joined.select(*keep, F.size("__ld_lines").cast("long").alias("n_lines"),
                         F.size(at).cast("long").alias("n_removed_lines"))


def q_line_dedup(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return dedup_lines(docs).select(
        "doc_id", "n_lines", "n_removed_lines",
        F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256).alias("kept_sha256"))


LINE_DEDUP_SQL = """
WITH l AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
w AS (SELECT doc_id, i, ls[i + 1] || chr(10) || ls[i + 2] || chr(10) || ls[i + 3] AS k
      FROM (SELECT doc_id, ls, unnest(range(0, len(ls) - 2)) AS i FROM l)),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS rn FROM w),
c AS (SELECT DISTINCT doc_id, i + j AS p FROM f, (VALUES (0), (1), (2)) v(j) WHERE rn > 1),
o AS (SELECT doc_id, unnest(ls) AS line, unnest(range(0, len(ls))) AS p FROM l),
m AS (SELECT o.doc_id, o.p, o.line, c.p IS NOT NULL AS gone FROM o LEFT JOIN c ON o.doc_id = c.doc_id AND o.p = c.p)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed_lines,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
