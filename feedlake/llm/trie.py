"""Conversation prefix trie in minimal-perfect-hash node tables.

A node is a distinct prefix of turns; its digest is the exclusive or of 128-bit hashes of
(position, role, text) over the prefix, beside its depth, so a running window gives it and
a long conversation can be cut and its parts' digests joined. Spark counts the members of
each digest (with map-side combining: a prefix that a third of all conversations share is
added up where it lies).

Subtree sums then take two rounds of flat tables. Nodes of more than ``limit`` members
(there are at most turns / limit of them) are *heavy*; every maximal subtree of other nodes
goes to one shard, by its root's digest. A shard enumerates its digests, gives each a slot
by a minimal perfect hash (levels of bit arrays and ranks), verifies every digest against
the one stored in its slot, scatters counts into flat arrays and adds up children, leaves
and savings through the parent-slot array from the deepest level upwards. The shards'
roots, summed by parent, join the heavy nodes, which are one more such table. A node of
one member whose parent has one too needs no sums and stays out of the tables, so a very
long conversation fills none.

Defined cases: rows without conv_id belong to no conversation and are left out; null role
or text is empty; turns of equal number (or none) are ordered by role and text; a repeated
row is a turn of its own; an empty table gives no nodes; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlake.llm.common import map_arrow, written

LIMIT = 20_000
SHARD_NODES = 100_000
LONG = 4096
CHUNK_BITS = 16
GAMMA = 2


# ---------------------------------------------------------------- turns, rebuilt conversations, prefix digests

def _running(rows: DataFrame, key: str, block: Column, order: list[Column], add: dict[str, tuple]) -> DataFrame:
    """Running aggregates over ``order`` within ``key``, cut at ``block`` so that a very long
    group is many tasks: each block runs on its own, and blocks after the first take what the
    blocks before them add up to. ``add``: column -> (aggregate, aggregate of blocks, join of two values)."""
    rows = rows.withColumn("__block", block)
    within = Window.partitionBy(key, "__block").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(key).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(key, "__block").agg(*(agg.alias(f"__{name}") for name, (agg, _, _) in add.items()))
    past = sums.select(F.col(key).alias("__key"), F.col("__block").alias("__at"),
                       *(over(f"__{name}").over(before).alias(f"__past_{name}") for name, (_, over, _) in add.items()),
                       F.count("*").over(before).alias("__blocks")).where("__blocks > 0").drop("__blocks")
    out = rows.select("*", *(agg.over(within).alias(name) for name, (agg, _, _) in add.items())) \
        .join(past, (F.col(key) == F.col("__key")) & (F.col("__block") == F.col("__at")), "left")
    for name, (_, _, join) in add.items():
        out = out.withColumn(name, F.when(F.col("__key").isNull(), F.col(name)).otherwise(join(F.col(name), F.col(f"__past_{name}"))))
    return out.select(*rows.drop("__block").columns, *add)


def ordered_turns(table: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """conv_id, pos (from 1), bytes of the text and two 64-bit hashes of (role, text), in the turns' order."""
    turn, role, text = F.col(turn_col), F.coalesce(F.col(role_col).cast("string"), F.lit("")), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = table.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"), turn.cast("long").alias("turn"), role.alias("role"), text.alias("text")) \
        .select("conv_id", "turn", "role", "text", F.octet_length("text").cast("long").alias("bytes"),
                F.xxhash64("role", "text", F.lit(1)).alias("x1"), F.xxhash64(F.lit(2), "text", "role").alias("x2"))
    count = (F.count("*"), F.sum, lambda now, past: now + past)
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    return _running(rows, "conv_id", F.coalesce(F.floor(F.col("turn") / LONG), F.lit(-(1 << 62))), order, {"pos": count}) \
        .select("conv_id", F.col("pos").cast("long").alias("pos"), "bytes", "x1", "x2")


def rebuilt(turns: DataFrame, group: int = 5, heads: int = 9) -> DataFrame:
    """Each conversation c with its first h turns taken from conversation c - c mod ``group``, h = crc32(c) mod ``heads``.

    All of that conversation's turns if it has fewer, none if it is absent; then c's own after
    its first h. Returns conv_id, pos, last (turns in all), bytes, x1, x2; a conversation
    without turns keeps one row of position 0.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    lengths = turns.groupBy("conv_id").agg(F.max("pos").alias("own")).withColumn("h", h) \
        .withColumn("base", F.col("conv_id") - F.pmod(F.col("conv_id"), F.lit(group)))
    base = lengths.select(F.col("conv_id").alias("b_id"), F.col("own").alias("b_own"))
    plan = lengths.join(base, F.col("base") == F.col("b_id"), "left") \
        .withColumn("taken", F.least(F.col("h"), F.coalesce("b_own", F.lit(0)))) \
        .withColumn("last", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))) \
        .select(F.col("conv_id").alias("c"), "base", "h", "taken", "last")
    values = ["bytes", "x1", "x2"]
    own = turns.join(plan, F.col("conv_id") == F.col("c")).where(F.col("pos") > F.col("h")) \
        .select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "last", *values)
    first = turns.where((F.col("pos") < heads) & (F.pmod(F.col("conv_id"), F.lit(group)) == 0)) \
        .select(F.col("conv_id").alias("t_id"), "pos", *values)
    taken = plan.join(first, F.col("base") == F.col("t_id")).where(F.col("pos") <= F.col("h")) \
        .select(F.col("c").alias("conv_id"), "pos", "last", *values)
    zero = F.lit(0).cast("long")
    empty = plan.where("last = 0").select(F.col("c").alias("conv_id"), zero.alias("pos"), zero.alias("last"),
                                          *(zero.alias(v) for v in values))
    return own.unionByName(taken).unionByName(empty)


def prefixes(turns: DataFrame) -> DataFrame:
    """One row per conversation and depth: the prefix's digest (d1, d2), its parent's (p1, p2), bytes and last."""
    turns = turns.withColumn("z1", F.xxhash64("pos", "x1", "x2")).withColumn("z2", F.xxhash64("x2", "x1", "pos", F.lit(7)))
    both = {name: (F.bit_xor(z), F.bit_xor, lambda now, past: now.bitwiseXOR(past)) for name, z in (("d1", "z1"), ("d2", "z2"))}
    run = _running(turns.where("pos > 0"), "conv_id", F.floor(F.col("pos") / LONG), [F.col("pos")], both)
    out = run.select("conv_id", "pos", "last", "bytes", "d1", "d2", F.col("d1").bitwiseXOR(F.col("z1")).alias("p1"),
                     F.col("d2").bitwiseXOR(F.col("z2")).alias("p2"))
    zero = F.lit(0).cast("long")
    root = turns.where("pos = 0").select("conv_id", "pos", "last", "bytes", *(zero.alias(c) for c in ("d1", "d2", "p1", "p2")))
    return out.unionByName(root)


# ---------------------------------------------------------------- one shard: minimal perfect hash and flat arrays

def _mixed(d1: np.ndarray, d2: np.ndarray, depth: np.ndarray, level: int) -> np.ndarray:
    x = d1.view("u8") ^ (d2.view("u8") * np.uint64(0x9E3779B97F4A7C15)) ^ (depth.view("u8") + np.uint64(level)) * np.uint64(0xC2B2AE3D27D4EB4F)
    x = (x ^ x >> np.uint64(31)) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ x >> np.uint64(29)


class NodeTable:
    """Slots of distinct (depth, digest) keys: no gaps, verified against the stored keys."""

    def __init__(self, depth: np.ndarray, d1: np.ndarray, d2: np.ndarray):
        self.levels, left, at = [], np.arange(len(d1)), 0
        while len(left):
            if len(self.levels) > 64:
                raise ValueError("two nodes have one digest")
            size = GAMMA * len(left) + 1
            spot = (_mixed(d1[left], d2[left], depth[left], len(self.levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(spot, minlength=size) == 1
            self.levels.append((alone, at + np.cumsum(alone) - 1))
            at += int(alone.sum())
            left = left[~alone[spot]]
        self.depth, self.d1, self.d2 = (np.zeros(len(d1), np.int64) for _ in range(3))
        slots = self._slots(depth, d1, d2)
        self.depth[slots], self.d1[slots], self.d2[slots] = depth, d1, d2
        self.slots = self.find(depth, d1, d2)
        if (self.slots < 0).any() or len(np.unique(self.slots)) < len(slots):
            raise ValueError("two nodes have one slot")

    def _slots(self, depth, d1, d2):
        slots, left = np.full(len(d1), -1, np.int64), np.arange(len(d1))
        for level, (alone, rank) in enumerate(self.levels):
            spot = (_mixed(d1[left], d2[left], depth[left], level) % np.uint64(len(alone))).astype(np.int64)
            here = alone[spot]
            slots[left[here]] = rank[spot[here]]
            left = left[~here]
        return slots

    def find(self, depth, d1, d2) -> np.ndarray:
        """Slot of each key, -1 for a key that the table does not hold."""
        slots = self._slots(depth, d1, d2)
        if not len(self.d1):
            return slots
        same = (self.depth[slots] == depth) & (self.d1[slots] == d1) & (self.d2[slots] == d2)
        return np.where((slots >= 0) & same, slots, -1)


NODE = ("depth", "d1", "d2", "p1", "p2", "conv_id", "n_convs", "bytes", "n_children", "n_leaves", "saved")


def accumulate(nodes: dict[str, np.ndarray]) -> tuple[np.ndarray, ...]:
    """Parent's conv_id (and whether it is in the table), children, leaves and savings of each node.

    ``n_children``, ``n_leaves`` and ``saved`` come in as what lies below the node but is not in
    the table.
    """
    depth = nodes["depth"]
    table = NodeTable(depth, nodes["d1"], nodes["d2"])
    slots = table.slots
    flat = {name: np.zeros(len(depth), np.int64) for name in NODE[5:]}
    for name, values in flat.items():
        values[slots] = nodes[name]
    parent = np.full(len(depth), -1, np.int64)
    parent[slots] = np.where(depth > 0, table.find(depth - 1, nodes["p1"], nodes["p2"]), -1)
    by_depth = np.argsort(table.depth, kind="stable")
    cuts = np.flatnonzero(np.diff(table.depth[by_depth], prepend=-1))
    children, leaves = flat["n_children"], flat["n_leaves"]
    saved = flat["saved"] + (flat["n_convs"] - 1) * flat["bytes"]
    for level in reversed(np.split(by_depth, cuts[1:])):
        leaves[level[children[level] == 0]] = 1
        held = level[parent[level] >= 0]
        np.add.at(children, parent[held], 1)
        np.add.at(leaves, parent[held], leaves[held])
        np.add.at(saved, parent[held], saved[held])
    known = parent >= 0
    above = np.where(known, flat["conv_id"][parent], 0) if len(parent) else parent
    return above[slots], known[slots], children[slots], leaves[slots], saved[slots]


def _accumulate_groups(nodes: DataFrame, by: Column) -> DataFrame:
    """``accumulate`` on each group; nodes whose parent is elsewhere keep the parent_conv_id they bring."""
    def run(table: pa.Table) -> pa.Table:
        columns = {name: table.column(name).to_numpy() for name in NODE}
        above, known, children, leaves, saved = accumulate(columns)
        parent = pc.if_else(pa.array(known), pa.array(above), table.column("parent_conv_id"))
        return pa.table({name: table.column(name) for name in NODE[:7]} | {
            "parent_conv_id": parent, "n_children": children, "n_leaves": leaves, "saved_tokens": saved,
            "top": pa.array(~known), "ends_sha256": table.column("ends_sha256")})

    longs = "depth long, d1 long, d2 long, p1 long, p2 long, conv_id long, n_convs long, parent_conv_id long"
    return nodes.groupBy(by.alias("__shard")).applyInArrow(
        run, f"{longs}, n_children long, n_leaves long, saved_tokens long, top boolean, ends_sha256 string")


# ---------------------------------------------------------------- ends and the whole trie

def ends(rows: DataFrame) -> DataFrame:
    """SHA-256 of the ascending, comma-joined conv_ids that end at each node.

    Ids are joined by runs of 65,536 numbers, which bounds each list; a node's runs are then
    read in order and fed to the hash one by one.
    """
    runs = rows.where(F.col("pos") == F.col("last")) \
        .groupBy("pos", "d1", "d2", F.shiftright("conv_id", CHUNK_BITS).alias("run")) \
        .agg(F.concat_ws(",", F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string"))).alias("ids"))
    ordered = runs.repartition("pos", "d1", "d2").sortWithinPartitions("pos", "d1", "d2", "run").select("pos", "d1", "d2", "ids")
    schema = pa.schema([("e_pos", pa.int64()), ("e1", pa.int64()), ("e2", pa.int64()), ("ends_sha256", pa.string())])

    def run(it):
        key = state = None
        for b in it:
            out = []
            for *now, ids in zip(*(c.to_pylist() for c in b.columns)):
                if now == key:
                    state.update(b",")
                else:
                    if key:
                        out.append((*key, state.hexdigest()))
                    key, state = now, hashlib.sha256()
                state.update(ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
        if key:
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip([*key, state.hexdigest()], schema)], schema=schema)

    return map_arrow(ordered, run, "e_pos long, e1 long, e2 long, ends_sha256 string")


def with_ends(nodes: DataFrame, rows: DataFrame) -> DataFrame:
    same = (F.col("pos") == F.col("e_pos")) & (F.col("d1") == F.col("e1")) & (F.col("d2") == F.col("e2"))
    return nodes.join(ends(rows), same, "left").drop("e_pos", "e1", "e2")


def prefix_trie(turns: DataFrame, limit: int = LIMIT, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """All nodes of the trie over conversations given as (conv_id, pos, last, bytes, x1, x2)."""
    rows = written(prefixes(turns), "trie-prefixes")
    key = ["pos", "d1", "d2"]
    below = rows.where("pos > 0").groupBy(*key).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("bytes").alias("bytes"), F.max("p1").alias("p1"),
        F.max("p2").alias("p2"), F.max((F.col("pos") < F.col("last")).cast("long")).alias("inner"))
    nodes = written(with_ends(below, rows.where("pos > 0")), "trie-nodes")
    size, total = nodes.agg(F.count("*"), F.sum("n_convs")).first()
    limit = max(limit, int((total or 0) ** 0.5))
    zero = F.lit(0).cast("long")
    root = rows.where("pos <= 1").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0") \
        .select(*(zero.alias(c) for c in key + ["p1", "p2"]), "conv_id", "n_convs", zero.alias("bytes"))
    root = with_ends(root, rows.where("pos = 0"))
    # At most sqrt(turns) rows: each heavy node has more than `limit` of all turns' prefixes.
    heavy = written(nodes.where(F.col("n_convs") > limit).select(*root.columns).unionByName(root), "trie-heavy")
    known = F.broadcast(heavy.select((F.col("pos") + 1).alias("h_pos"), F.col("d1").alias("h1"), F.col("d2").alias("h2"),
                                     F.col("conv_id").alias("parent_conv_id")))
    hung = (F.col("pos") == F.col("h_pos")) & (F.col("p1") == F.col("h1")) & (F.col("p2") == F.col("h2"))
    light = nodes.where(F.col("n_convs") <= limit)
    # Where each conversation leaves the heavy nodes (its subtree's root), and where it is alone for the first time.
    member = rows.join(F.broadcast(heavy.select(F.col("pos").alias("g_pos"), F.col("d1").alias("g1"), F.col("d2").alias("g2"))),
                       (F.col("pos") == F.col("g_pos")) & (F.col("d1") == F.col("g1")) & (F.col("d2") == F.col("g2")), "left_anti") \
        .groupBy(F.col("conv_id").alias("m_id")).agg(F.min(F.struct("pos", "d1", "d2")).alias("top"))
    alone = light.where("n_convs = 1").groupBy(F.col("conv_id").alias("a_id")).agg(F.min("pos").alias("alone"))
    placed = written(light.join(member, F.col("conv_id") == F.col("m_id")).join(alone, F.col("conv_id") == F.col("a_id"), "left")
                     .withColumn("shard", F.pmod(F.xxhash64("top.d1", "top.d2"), F.lit(max(1, -(-size // shard_nodes)))))
                     .drop("m_id", "a_id", "top"), "trie-placed")
    tail = (F.col("n_convs") == 1) & (F.col("pos") > F.col("alone"))
    ones = F.lit(1).cast("long")
    tails = placed.where(tail).select(
        F.col("pos").alias("depth"), "conv_id", "n_convs", F.col("conv_id").alias("parent_conv_id"), F.col("inner").alias("n_children"),
        ones.alias("n_leaves"), zero.alias("saved_tokens"), "ends_sha256")
    # The first node of one member stands for all below it.
    solo = F.when(F.col("n_convs") == 1, F.col("inner")).otherwise(F.lit(0))
    body = placed.where(F.coalesce(~tail, F.lit(True))).join(known, hung, "left") \
        .select(F.col("pos").alias("depth"), "d1", "d2", "p1", "p2", "conv_id", "n_convs", "bytes", solo.alias("n_children"),
                solo.alias("n_leaves"), zero.alias("saved"), "parent_conv_id", "ends_sha256", "shard")
    shards = written(_accumulate_groups(body, F.col("shard")), "trie-shards")
    hanging = shards.where("top").groupBy((F.col("depth") - 1).alias("u_depth"), F.col("p1").alias("u1"), F.col("p2").alias("u2")) \
        .agg(F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved"))
    upper = heavy.withColumnRenamed("pos", "depth") \
        .join(hanging, (F.col("depth") == F.col("u_depth")) & (F.col("d1") == F.col("u1")) & (F.col("d2") == F.col("u2")), "left") \
        .select("depth", "d1", "d2", "p1", "p2", "conv_id", "n_convs", "bytes", *(F.coalesce(c, zero).alias(c) for c in ("n_children", "n_leaves", "saved")),
                F.lit(None).cast("long").alias("parent_conv_id"), "ends_sha256")
    out = tails.columns
    none = hashlib.sha256(b"").hexdigest()
    return shards.select(*out).unionByName(_accumulate_groups(upper, F.lit(0)).select(*out)).unionByName(tails) \
        .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))


#: The same nodes by sorted prefixes: a node's sums go from its smallest member to that conversation's prefixes.
TRIE_SQL = """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS x,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, count(*) AS own, conv_id - conv_id % 5 AS base,
         xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
             lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
                 lambda y, i: CASE WHEN y % 2 = 1 THEN xor(y // 2, 3988292384::BIGINT) ELSE y // 2 END))) % 9 AS h
  FROM t GROUP BY conv_id),
plan AS (SELECT c.conv_id, c.own, c.h, c.base, least(c.h, coalesce(b.own, 0)) AS taken FROM c LEFT JOIN c AS b ON b.conv_id = c.base),
built AS (
  SELECT conv_id, p - h + taken AS d, r, x FROM t JOIN plan USING (conv_id) WHERE p > h
  UNION ALL SELECT plan.conv_id, p, r, x FROM plan JOIN t ON t.conv_id = plan.base WHERE p <= h),
chain AS (
  SELECT conv_id, d, octet_length(encode(x)) AS bytes, max(d) OVER (PARTITION BY conv_id) AS last,
         d || ':' || md5(string_agg(md5(octet_length(encode(r)) || ',' || r || x), '') OVER (PARTITION BY conv_id ORDER BY d)) AS node
  FROM built),
pre AS (
  SELECT conv_id, d, bytes, last, node, coalesce(lag(node) OVER (PARTITION BY conv_id ORDER BY d), 'root') AS parent FROM chain
  UNION ALL SELECT conv_id, 0, 0, taken + greatest(own - h, 0), 'root', NULL FROM plan),
nodes AS (
  SELECT node, d, min(conv_id) AS cid, count(*) AS n, max(bytes) AS bytes, max(parent) AS parent,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE d = last), '')) AS ends_sha256
  FROM pre GROUP BY node, d),
kids AS (SELECT parent, count(*) AS k FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
full_nodes AS (SELECT nodes.*, coalesce(k, 0) AS k FROM nodes LEFT JOIN kids ON kids.parent = nodes.node),
below AS (
  SELECT pre.node, sum((u.n - 1) * u.bytes) AS saved, count(*) FILTER (WHERE u.k = 0) AS leaves
  FROM full_nodes AS u JOIN pre ON pre.conv_id = u.cid AND pre.d <= u.d GROUP BY pre.node)
SELECT v.cid AS conv_id, v.d::BIGINT AS depth, up.cid AS parent_conv_id, v.n AS n_convs, v.k AS n_children,
       leaves AS n_leaves, saved::BIGINT AS saved_tokens, v.ends_sha256
FROM full_nodes AS v JOIN below USING (node) LEFT JOIN nodes AS up ON up.node = v.parent
"""


def q_trie(spark, sf_dir):
    turns = written(ordered_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet")), "trie-turns")
    return prefix_trie(rebuilt(turns))
