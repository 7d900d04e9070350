"""Document fingerprints: SimHash, and a search of all fingerprints within a Hamming radius.

Native: DataFrame functions only. Terms are shingles of ``SHINGLE`` words (a shorter text
is one term); every occurrence votes with its 64-bit hash, so repeated terms weigh more, and
the sign of each bit's votes is the fingerprint's bit. The votes are counted two bits to a
64-bit sum, partial sums before the shuffle.

The radius comes from the similarity: at Jaccard j two sets of like size lie at the angle
acos(2 j / (1 + j)), each bit differs with that angle's share of pi, and the radius is the
smallest that holds ``RECALL`` of such pairs (15 of 64 bits at 0.8 and 0.95).

Search: block tables, complete within the radius. A fingerprint is cut into blocks, each with
an allowance of bits; the allowances sum to ``radius - blocks + 1``, so two fingerprints within
the radius are within the allowance in one block at least. An entry stands once in each block's
table; a query probes each table with every value within its block's allowance. A pair is taken
at the first such block only, so it comes once. Equal fingerprints are one entry, and the
queries are a stated set against all entries. At radius 15 a query still meets about 10 % of the
entries, so the search grows with queries times entries.

Defined cases: null text counts as empty and has the fingerprint 0; equal texts have equal
fingerprints; the next document of rows that share an id is the next row by (id, hash of
the text); null ids come last; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlake.llm.common import documents, written

SHINGLE = 5
BITS = 64
SIMILARITY = 0.8
RECALL = 0.95
BLOCKS = 5
SPREAD = 1 << 12
NO_ID = -(1 << 62)  # the range of null ids
PAIR = 0x0000000100000001


def radius_of(similarity: float, recall: float = RECALL) -> int:
    """The least radius that holds the share ``recall`` of pairs at this Jaccard similarity."""
    differ = math.acos(min(1.0, 2 * similarity / (1 + similarity))) / math.pi
    held = 0.0
    for radius in range(BITS):
        held += math.comb(BITS, radius) * differ ** radius * (1 - differ) ** (BITS - radius)
        if held >= recall:
            return radius
    return BITS


RADIUS = radius_of(SIMILARITY)


def word_hashes(text: Column) -> Column:
    return F.transform(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != ""), lambda w: F.xxhash64(w))


def fingerprints(docs: DataFrame, keys: list[str], text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """One row per distinct key: the keys and ``fingerprint`` (long)."""
    words = docs.select(*keys, word_hashes(F.coalesce(F.col(text_col), F.lit(""))).alias("__sh_w"))
    at = F.sequence(F.lit(0), F.greatest(F.size("__sh_w") - size, F.lit(0)))
    hashes = F.when(F.size("__sh_w") >= size, F.transform(at, lambda i: F.xxhash64(
        *[F.get("__sh_w", i + j) for j in range(size)]))).otherwise(F.array(F.xxhash64("__sh_w")))
    hashes = F.when(F.size("__sh_w") > 0, hashes)
    votes = words.select(*keys, F.explode_outer(hashes).alias("__sh_h"))
    sums = [F.sum(F.shiftrightunsigned("__sh_h", i).bitwiseAND(F.lit(PAIR))).alias(f"__sh_s{i}") for i in range(BITS // 2)]
    counted = votes.groupBy(*keys).agg(F.count("__sh_h").alias("__sh_n"), *sums)
    out = F.lit(0).cast("long")
    for i in range(BITS // 2):
        low = F.col(f"__sh_s{i}").bitwiseAND(F.lit(0xFFFFFFFF))
        high = F.shiftrightunsigned(f"__sh_s{i}", 32)
        out = out.bitwiseOR(F.when(2 * low > F.col("__sh_n"), F.shiftleft(F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
        out = out.bitwiseOR(F.when(2 * high > F.col("__sh_n"), F.shiftleft(F.lit(1).cast("long"), i + 32)).otherwise(F.lit(0).cast("long")))
    return counted.select(*keys, F.coalesce(out, F.lit(0).cast("long")).alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    return F.lit(1.0) - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def block_tables(radius: int) -> list[tuple[int, list[int], int]]:
    """(mask of the block, patterns of at most its allowance of bits, allowance), as signed longs."""
    blocks = min(BLOCKS, radius + 1)
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    spare = radius - blocks + 1
    out = []
    for i, (lo, hi) in enumerate(zip(edges, edges[1:])):
        # The last blocks are the widest ones: they take what doesn't divide.
        most = min(hi - lo, spare // blocks + (i >= blocks - spare % blocks))
        patterns = [sum(1 << b for b in c) for k in range(most + 1) for c in combinations(range(lo, hi), k)]
        out.append((_signed(((1 << hi) - 1) ^ ((1 << lo) - 1)), [_signed(p) for p in patterns], most))
    return out


def _signed(bits: int) -> int:
    return bits - (1 << BITS) if bits >> (BITS - 1) else bits


def within_radius(prints: DataFrame, queries: Column, radius: int = RADIUS, key: str = "fingerprint") -> DataFrame:
    """(fingerprint, other, n): all fingerprints within the radius of those of the query rows, and their rows' number.

    ``prints`` has one row per document; every fingerprint is its own neighbour.
    """
    entries = prints.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.max(queries).alias("asked"))
    tables = block_tables(radius)
    long = lambda x: F.lit(x).cast("long")
    stored = F.array(*[F.struct(F.lit(t).alias("t"), F.col(key).bitwiseAND(long(mask)).alias("k"))
                       for t, (mask, _, _) in enumerate(tables)])
    keyed = entries.select(key, "n", F.explode(stored).alias("b")).select(key, "n", "b.t", "b.k")
    probes = F.array(*[F.struct(F.lit(t).alias("qt"), long(mask).alias("mask"), F.array(*[long(x) for x in patterns]).alias("v"))
                       for t, (mask, patterns, _) in enumerate(tables)])
    asked = entries.where("asked").select(F.col(key).alias("q"), F.explode(probes).alias("b")) \
        .select("q", "b.qt", "b.mask", F.explode("b.v").alias("v")) \
        .select("q", "qt", F.col("q").bitwiseAND(F.col("mask")).bitwiseXOR(F.col("v")).alias("qk"))
    differ = F.col("q").bitwiseXOR(F.col(key))
    first = F.coalesce(*[F.when(F.bit_count(differ.bitwiseAND(long(mask))) <= most, F.lit(t))
                         for t, (mask, _, most) in enumerate(tables)])
    # Merged in any session: Spark sizes what comes out of an explode by its input, and would broadcast millions of probes.
    return asked.hint("merge").join(keyed.hint("merge"), (F.col("qt") == F.col("t")) & (F.col("qk") == F.col("k"))
                      & (F.bit_count(differ) <= radius) & (first == F.col("t"))) \
        .select(F.col("q").alias("fingerprint"), F.col(key).alias("other"), "n")


def with_next(docs: DataFrame, id_col: str, text_col: str, spread: int = SPREAD) -> DataFrame:
    """doc_id, key, nth (both make a row's key), text, and text, key and id of the next document in falling order of id (after the last: the first).

    Rows are dealt to ranges of ids; inside a range a window finds the next row, and only
    the last row of each range is looked up in the first row of the next range that has rows.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    base = base.withColumn("key", F.xxhash64("doc_id", "text")).withColumn("range", F.coalesce(
        F.floor(F.col("doc_id") / spread), F.lit(NO_ID)))
    order = [F.desc_nulls_last("doc_id"), F.desc("key")]
    inside = Window.partitionBy("range").orderBy(*order)
    rows = base.withColumn("next_text", F.lead("text").over(inside)).withColumn("next_key", F.lead("key").over(inside)) \
        .withColumn("next_id", F.lead("doc_id").over(inside)).withColumn("nth", F.row_number().over(inside))
    heads = rows.where("nth = 1").select(F.col("range").alias("h_range"), F.col("key").alias("h_key"),
                                       F.col("doc_id").alias("h_id"), F.col("text").alias("h_text"))
    # One row a range of ``spread`` ids: their order fits one window; texts are joined after it.
    ranges = base.select(F.col("range").alias("h_range")).distinct()
    whole = Window.orderBy(F.desc("h_range"))
    links = ranges.select(F.col("h_range").alias("l_range"), F.coalesce(
        F.lead("h_range").over(whole),
        F.first("h_range").over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("to"))
    tails = links.join(heads, F.col("to") == F.col("h_range")).select("l_range", "h_key", "h_id", "h_text")
    last = F.col("next_key").isNull()
    # An equi-join on the window's own partitioning: the texts stay where they are.
    return rows.join(tails, (F.col("range") == F.col("l_range")) & last, "left").select(
        "doc_id", "key", "nth", "text", F.when(last, F.col("h_text")).otherwise(F.col("next_text")).alias("next_text"),
        F.when(last, F.col("h_key")).otherwise(F.col("next_key")).alias("next_key"),
        F.when(last, F.col("h_id")).otherwise(F.col("next_id")).alias("next_id"))


def near_documents(prints: DataFrame, queries: Column, radius: int = RADIUS, id_col: str = "doc_id",
                   key: str = "fingerprint") -> DataFrame:
    """(doc_id, near_id, differ): every row within the radius of every query row, one output row a pair.

    The distinct pairs of fingerprints are joined back to the rows of both ends; a query row is
    its own neighbour, and rows that share an id or have none are pairs of their own.
    """
    pairs = written(within_radius(prints, queries, radius, key).select(
        F.col("fingerprint").alias("q_print"), F.col("other").alias("o_print"),
        F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("other"))).alias("differ")), "simhash-pairs")
    asked = prints.where(queries).select(F.col(id_col).alias("doc_id"), F.col(key).alias("a_print"))
    found = prints.select(F.col(id_col).alias("near_id"), F.col(key).alias("f_print"))
    return asked.join(pairs, F.col("a_print") == F.col("q_print")).select("doc_id", "o_print", "differ") \
        .join(found, F.col("o_print") == F.col("f_print")).select("doc_id", "near_id", "differ")


def q_neighbours(spark, sf_dir):
    """Which documents ``n_near`` of ``op6_simhash`` counts: a row for each, for ids divisible by 20."""
    docs = documents(spark, sf_dir).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Repeated rows are one key: counted, and given back as rows after the votes.
    counted = docs.withColumn("key", F.xxhash64("text"))
    numbers = counted.groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("n"), F.first("text").alias("text"))
    prints = written(fingerprints(numbers, ["doc_id", "key", "n"])
                     .select("doc_id", "fingerprint", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).drop("col"), "simhash-rows")
    return near_documents(prints, F.col("doc_id") % 20 == 0)


def q_simhash(spark, sf_dir):
    """``n_near``, for ids divisible by 20: documents whose fingerprint lies within the radius, itself included."""
    rows = with_next(documents(spark, sf_dir), "doc_id", "text")
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    keys = ["doc_id", "key", "nth", "next_id", "next_key", "n_chars", "edited_sha256"]
    both = rows.select("doc_id", "key", "nth", "next_id", "next_key", n.cast("long").alias("n_chars"), "text", edited.alias("edited")) \
        .select(*keys[:-1], F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                F.explode(F.array(F.struct(F.lit(False).alias("e"), F.col("text").alias("t")),
                                  F.struct(F.lit(True).alias("e"), F.col("edited").alias("t")))).alias("v")) \
        .select(*keys, "v.e", "v.t")
    prints = written(fingerprints(both, [*keys, "e"], "t").groupBy(*keys).agg(
        F.max(F.when(~F.col("e"), F.col("fingerprint"))).alias("fingerprint"),
        F.max(F.when(F.col("e"), F.col("fingerprint"))).alias("edited")), "simhash")
    after = prints.groupBy(F.col("doc_id").alias("n_id"), F.col("key").alias("n_key")).agg(F.max("fingerprint").alias("next"))
    near = within_radius(prints, F.col("doc_id") % 20 == 0).groupBy(F.col("fingerprint").alias("near_print")) \
        .agg(F.sum("n").alias("n_near"))
    return prints.join(after, F.col("next_id").eqNullSafe(F.col("n_id")) & (F.col("next_key") == F.col("n_key"))) \
        .join(near, (F.col("fingerprint") == F.col("near_print")) & (F.col("doc_id") % 20 == 0), "left") \
        .select("doc_id", "n_chars", "edited_sha256", F.lpad(F.hex("fingerprint"), 16, "0").alias("fingerprint"),
                F.lpad(F.hex("edited"), 16, "0").alias("edited_fingerprint"),
                likeness(F.col("fingerprint"), F.col("edited")).alias("near_edited"),
                likeness(F.col("fingerprint"), F.col("next")).alias("near_next"), "n_near")
