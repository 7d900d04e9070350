"""N-gram Jaccard join: a prefix-tree join over globally ordered shingle sets.

Two documents link when ``100 * |intersection| >= percent * |union|`` of their sets of word
shingles (A-Z lower-cased; a text of fewer words is one shingle; without words it is empty
and links with nothing). The result is exact up to hashes: 64 bits of a shingle in the global
order and of a set as a node, 48 bits of a shingle within a block.

1. Two tables of one-byte counters count the words (``SKETCH``) and the shingles (``SHINGLE_SKETCH``) of
   all texts. Shingles whose counter stands out of the table's mean load go last, by that counter. The
   others, which a full table can't tell apart, are ordered by their words: by how often so many common
   words meet by chance, then by the count of the rarest word (no shingle occurs more often), then by
   hash. Any one order is right; this one keeps shared shingles out of the prefixes, also of a corpus
   with many times more shingles than counters, as words are far fewer than shingles. A byte holds counts
   to 63 as they are and larger ones by their logarithm.
2. Equal sets become one node. Sets that link share a shingle among their first
   n - ceil(percent * n / 100) + 1. Nodes of like size (equal or neighbouring
   classes) that share one are tied to the smallest of them, and the components of these ties
   are *blocks*: no link leaves a block. Where chance ties have run together into a large block, its
   nodes are tied once more, pair by pair and only if their signatures allow a link: a bit is the parity
   of the shingles of a slot, so two sets differ by at least as many shingles as bits.
3. The sets of a block are read once and stored in a prefix tree (trie) with the block's
   commonest shingles at the top. Each set walks the tree and counts its overlap with a
   path once for all sets below it; subtrees go unvisited when even the shorter of both
   remainders could not reach the overlap that their sizes ask for, or when their sizes are out
   of range. Every link between different sets is found once: ``jaccard_links`` gives them all, and
   ``jaccard_components`` adds them up per document and hands on only those that join components. Asked for
   labels alone (``count_links=False``), it also skips subtrees whose sets all belong to the
   walker's component already.
4. A large block is cut by set size: sets that link are in the same class of sizes or in
   neighbouring ones, so a set is stored in its own class and walks two. A class of more than
   ``BLOCK_SHINGLES`` shingles is cut in chunks, and each pair of chunks is one task, in the class
   as between neighbouring classes, so memory stays bounded.

Defined cases: null text is empty; null ids are smallest for no one (a component takes its
smallest non-null id); rows that share an id are nodes of their own; empty tables give no rows;
other columns are ignored.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import documents, map_arrow, written
from feedlake.llm.components import components

WORDS = 4
PERCENT = 85
SKETCH = 1 << 24
SHINGLE_SKETCH = 1 << 24
SKETCH_ROW = 1 << 18
BLOCK_SHINGLES = 4_000_000
SIGN_BITS = 2048  # most bits of a signature
GROUP = 256  # most nodes of a shingle whose pairs are compared one by one
EDGE_ROWS = 1 << 16  # links of a record batch
BROADCAST_ROWS = 500_000  # rows of about 60 bytes
_BASE = 0x9E3779B97F4A7C15
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    size = max(4096, 1 << (n - 1).bit_length())
    if size not in _POWERS:
        up, down = np.full(size, np.uint64(_BASE)), np.full(size, np.uint64(pow(_BASE, -1, 1 << 64)))
        up[0] = down[0] = np.uint64(1)
        if len(_POWERS) > 4:
            _POWERS.clear()
        _POWERS[size] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _POWERS[size]


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the words of a text, in their order."""
    buf = np.frombuffer((text or "").encode().lower(), np.uint8)
    if not len(buf):
        return np.zeros(0, np.uint64)
    inside = np.concatenate([[False], ~_SPACE[buf], [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.zeros(0, np.uint64)
    up, down = _powers(len(buf) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((buf + np.uint64(1)) * up[:len(buf)], dtype=np.uint64)])
    return _mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def shingle_hashes(word: np.ndarray, words: int = WORDS) -> np.ndarray:
    """64-bit hashes of the shingles of a text's words, in their order, repeated ones too."""
    if not len(word):
        return np.zeros(0, np.uint64)
    size = min(words, len(word))
    key = np.full(len(word) - size + 1, np.uint64(size))
    for i in range(size):
        key = _mix(key * np.uint64(_BASE) + word[i:len(word) - size + 1 + i])
    return key


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The set of word shingles of a text as sorted 64-bit hashes."""
    return np.unique(shingle_hashes(word_hashes(text), words))


def _texts(docs: DataFrame, text_col: str, *cols):
    return docs.select(*cols, F.col(text_col).cast("string").alias("text"))


def counter_code(counts: np.ndarray) -> np.ndarray:
    """Counts in one byte, in their order: to 63 exactly, then 191 steps of the logarithm up to 2**38."""
    code = np.minimum(counts, 64).astype(np.uint8)
    many = code == 64
    code[many] = np.minimum(64 + (np.log2(counts[many]) - 6) * (191 / 32), 255).astype(np.uint8)
    return code


def decoded_counts(codes: np.ndarray) -> np.ndarray:
    """About the counts that ``counter_code`` was given."""
    code = codes.astype(float)
    return np.where(codes < 64, code, np.exp2(6 + (code - 64) * (32 / 191)))


def _slots(hashes: np.ndarray, size: int) -> np.ndarray:
    """The counter of each hash: its top bits."""
    return (hashes >> np.uint64(64 - (size.bit_length() - 1))).astype(np.int64)


def text_counters(docs: DataFrame, words: int, text_col: str) -> tuple[np.ndarray, np.ndarray]:
    """One-byte counters (``counter_code``) of all texts' words and of their shingles.

    Tasks count whole; their counters travel in compressed stretches and are summed in Spark.
    """
    sizes = SKETCH, SHINGLE_SKETCH

    def pack(counts: np.ndarray) -> bytes:
        at = np.flatnonzero(counts)
        if 8 * len(at) < len(counts):  # positions and counts
            return b"few" + zlib.compress(np.stack([at, counts[at]]).astype("<i8").tobytes(), 1)
        kind = "<u2" if counts.max() < 1 << 16 else "<i8"
        return kind.encode() + zlib.compress(counts.astype(kind).tobytes(), 1)

    def put(total: np.ndarray, raw: bytes) -> None:
        kind, raw = raw[:3], zlib.decompress(raw[3:])
        if kind == b"few":
            at, counts = np.frombuffer(raw, "<i8").reshape(2, -1)
            total[at] += counts
        else:
            total += np.frombuffer(raw, kind.decode())

    def count(it):
        counts = np.zeros(sum(sizes), np.uint32)
        of_words, of_shingles = counts[:sizes[0]], counts[sizes[0]:]
        for b in it:
            for at in range(0, len(b), 256):
                found = [word_hashes(t) for t in b.column(0).slice(at, 256).to_pylist()]
                np.add.at(of_words, _slots(np.concatenate(found), sizes[0]), np.uint32(1))
                np.add.at(of_shingles, _slots(np.concatenate([shingle_hashes(w, words) for w in found]), sizes[1]), np.uint32(1))
        rows = counts.reshape(-1, SKETCH_ROW)
        for row in np.flatnonzero(rows.any(1)):
            yield pa.RecordBatch.from_arrays([pa.array([row], pa.int32()), pa.array([pack(rows[row])], pa.binary())], ["row", "n"])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(SKETCH_ROW, np.int64)
        for n in rows["n"]:
            put(total, n)
        return pd.DataFrame({"row": rows["row"].iloc[:1], "code": [zlib.compress(counter_code(total).tobytes(), 1)]})

    out = np.zeros((sum(sizes) // SKETCH_ROW, SKETCH_ROW), np.uint8)
    for r in _texts(docs, text_col).transform(map_arrow, count, "row int, n binary").groupBy("row") \
            .applyInPandas(add, "row int, code binary").collect():
        out[r.row] = np.frombuffer(zlib.decompress(r.code), np.uint8)
    out = out.reshape(-1)
    return out[:sizes[0]], out[sizes[0]:]


class GlobalOrder:
    """The one order of shingles that all tasks share, those that few texts have first."""

    def __init__(self, word_codes: np.ndarray, shingle_codes: np.ndarray):
        counts = decoded_counts(np.arange(256, dtype=np.uint8))
        times = lambda codes: float(np.bincount(codes, minlength=256) @ counts)
        load = times(shingle_codes) / len(shingle_codes)
        self.words = word_codes
        self.common = np.maximum(shingle_codes, counter_code(np.array([load + 4 * math.sqrt(load) + 1])))
        # Whole numbers, sixteenths of a power of two: the same sum for a shingle wherever it stands.
        self.logs = np.round(16 * np.log2(np.maximum(counts, 1))).astype(np.int32)
        self.log_all = round(16 * math.log2(max(times(word_codes), 1)))

    def ranks(self, word: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """The rank of each shingle of a text's words."""
        size, code = len(word) - len(keys) + 1, self.words[_slots(word, len(self.words))]
        log = self.logs[code]
        met, least = np.full(len(keys), -(size - 1) * self.log_all, np.int32), np.full(len(keys), 255, np.uint8)
        for i in range(size):
            met += log[i:len(keys) + i]
            least = np.minimum(least, code[i:len(keys) + i])
        chance = np.clip(met // 16 + 6, 0, 255)  # below 1/64 expected by chance: all alike
        return self.common[_slots(keys, len(self.common))].astype(np.int32) << 16 | chance << 8 | least

    def ordered(self, text: str | None, words: int) -> tuple[np.ndarray, np.ndarray]:
        """The set of a text's shingles as sorted hashes (``shingles``), and in the global order."""
        word = word_hashes(text)
        if not len(word):
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        keys = shingle_hashes(word, words)
        found, first = np.unique(keys, return_index=True)
        return found, found[np.argsort(self.ranks(word, keys)[first], kind="stable")]


# --- the prefix tree of one block -----------------------------------------------------------------

class Node:
    __slots__ = ("label", "kids", "ends", "low", "high", "rest", "same")

    def __init__(self, label: np.ndarray, same: int, size: int):
        self.label = label
        self.kids: dict[int, Node] = {}
        self.ends: list[int] = []
        self.low = self.high = size  # sizes of the sets below
        self.rest = 0  # most elements below the label
        self.same: int | None = same  # a set whose component holds all sets below


class PrefixTree:
    """Sets of small integers (ascending) with their full sizes; finds links and joins components."""

    def __init__(self, universe: int, percent: int, every: bool = False):
        self.percent = percent
        self.every = every  # find all links, not only those that join components
        self.links: list[tuple[int, int]] = []
        self.root = Node(np.zeros(0, np.int32), -1, 0)
        self.root.same = None
        self.sizes: list[int] = []
        self.parent: list[int] = []
        self.edges: list[tuple[int, int]] = []
        self.seen = np.zeros(universe + 1, np.int32)  # 1 where the walker has the element
        self.empty = True

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x

    def join(self, x: int, y: int) -> None:
        if self.every:
            self.links.append((x, y))
        a, b = self.find(x), self.find(y)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
            self.edges.append((x, y))

    def new(self, size: int) -> int:
        self.sizes.append(size)
        self.parent.append(len(self.parent))
        return len(self.parent) - 1

    def uniform(self, node: Node) -> int | None:
        """The component that all sets below share, if they do; once shared, it stays so."""
        if node.same is None:
            below = {self.find(e) for e in node.ends}
            for k in node.kids.values():
                if k.same is None:
                    return None
                below.add(self.find(k.same))
                if len(below) > 1:
                    return None
            if not below:
                return None
            node.same = below.pop()
        return self.find(node.same)

    def probe(self, x: int, items: np.ndarray) -> None:
        """Join set ``x`` with every stored set that it links to."""
        p, nx = self.percent, self.sizes[x]
        self.seen[items] = 1
        total = len(items)
        # Elements of the walker up to each element: what is left of it below a label.
        stack = [(self.root, 0)]
        while stack:
            node, over = stack.pop()
            if 100 * node.high < p * nx or p * node.low > 100 * nx:
                continue
            if not self.every and node.same is not None and self.find(node.same) == self.find(x):
                continue
            if len(node.label):
                over += int(self.seen[node.label].sum())
                left = total - int(np.searchsorted(items, node.label[-1], side="right"))
            else:
                left = total
            least = max(node.low, -(-p * nx // 100))
            if (100 + p) * (over + min(left, node.rest)) < p * (nx + least):
                continue
            for y in node.ends:
                if (100 + p) * over >= p * (nx + self.sizes[y]):
                    self.join(x, y)
            if node.kids and (self.every or self.uniform(node) != self.find(x)):
                nearest = []
                for first, kid in node.kids.items():
                    (nearest if self.seen[first] else stack).append((kid, over))
                stack += nearest  # walked first: the likeliest links save the others
        self.seen[items] = 0

    def insert(self, x: int, items: np.ndarray) -> None:
        node, at, size, mine = self.root, 0, self.sizes[x], self.find(x)
        if self.empty:
            node.low = node.high = size
            node.same, self.empty = x, False
        while True:
            node.low, node.high = min(node.low, size), max(node.high, size)
            if node.same is not None and self.find(node.same) != mine:
                node.same = None
            node.rest = max(node.rest, len(items) - at)
            if at == len(items):
                node.ends.append(x)
                return
            kid = node.kids.get(int(items[at]))
            if kid is None:
                kid = node.kids[int(items[at])] = Node(items[at:], x, size)
                kid.ends.append(x)
                return
            tail = items[at:at + len(kid.label)]
            same = kid.label[:len(tail)] == tail
            common = len(same) if same.all() else int(np.argmin(same))
            if common < len(kid.label):  # split the label
                top = Node(kid.label[:common], x, size)
                top.low, top.high, top.same = kid.low, kid.high, kid.same
                top.rest = kid.rest + len(kid.label) - common
                kid.label = kid.label[common:]
                top.kids[int(kid.label[0])] = kid
                node.kids[int(items[at])] = top
                kid = top
            node, at = kid, at + common


def block_links(sets: list[np.ndarray], sides: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that span the components of the sets: side 0 is stored, 1 walks, 2 does both."""
    tree = None
    for tree in _walk(sets, sides, percent, False):
        pass
    return tree.edges


def all_block_links(sets: list[np.ndarray], sides: np.ndarray, percent: int, each) -> list[tuple[int, int]]:
    """Calls ``each`` with the links of every walker, each link once; returns those that span the components."""
    tree = None
    for tree in _walk(sets, sides, percent, True):
        if tree.links:
            each(tree.links)
            tree.links = []
    return tree.edges


def _walk(sets: list[np.ndarray], sides: np.ndarray, percent: int, every: bool):
    """The tree, after each set."""
    flat = np.concatenate(sets)
    _, inverse, counts = np.unique(flat, return_inverse=True, return_counts=True)
    rank = np.empty(len(counts), np.int32)
    rank[np.argsort(-counts, kind="stable")] = np.arange(len(counts), dtype=np.int32)
    shared = int((counts > 1).sum())  # elements of one set alone never overlap
    local = rank[inverse]
    ends = np.cumsum([len(s) for s in sets])
    tree = PrefixTree(len(counts), percent, every)
    items = []
    for end, s in zip(ends, sets):
        mine = np.sort(local[end - len(s):end])
        items.append(mine[:np.searchsorted(mine, shared)])
        tree.new(len(s))
    order = sorted(range(len(sets)), key=lambda i: (sides[i] == 1, len(sets[i])))
    for x in order:
        if sides[x]:
            tree.probe(x, items[x])
        if sides[x] != 1:
            tree.insert(x, items[x])
        yield tree


# --- signatures ---------------------------------------------------------------------------------------

def signature(hashes: np.ndarray) -> bytes:
    """The parity of the set's shingles in each of 64 to ``SIGN_BITS`` slots (by the hash's lowest bits)."""
    bits = min(max(64, 1 << max(0, 3 * len(hashes) // 4 - 1).bit_length()), SIGN_BITS)
    slots = (hashes & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(slots, minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes()


def may_link(x: tuple[int, int, int], y: tuple[int, int, int], percent: int) -> bool:
    """False only for sets that can't link: each is (size, signature as a number, its bits)."""
    (nx, sx, bx), (ny, sy, by) = x, y
    if 100 * min(nx, ny) < percent * max(nx, ny):
        return False
    while bx > by:
        bx >>= 1
        sx = sx & (1 << bx) - 1 ^ sx >> bx
    while by > bx:
        by >>= 1
        sy = sy & (1 << by) - 1 ^ sy >> by
    return (100 + percent) * (sx ^ sy).bit_count() <= (100 - percent) * (nx + ny)


def group_ties(group: list[tuple[int, int, int, int]], percent: int) -> list[tuple[int, int]]:
    """Pairs of nodes that span the components of the pairs that may link; a node is (node, size, signature, bits)."""
    top, out = list(range(len(group))), []

    def find(k):
        while top[k] != k:
            top[k] = k = top[top[k]]
        return k

    for i, x in enumerate(group):
        for j in range(i - 1, -1, -1):
            a, b = find(i), find(j)
            if a != b and may_link(x[1:], group[j][1:], percent):
                top[a] = b
                out.append((x[0], group[j][0]))
    return out


# --- the corpus -------------------------------------------------------------------------------------

def shingle_sets(docs: DataFrame, order: GlobalOrder, words: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """One row per document: doc_id, set size, the set's 128-bit hash, its prefix and its signature."""
    def run(it):
        from xxhash import xxh3_128_intdigest as digest

        for b in it:
            for at in range(0, len(b), 256):
                part = b.slice(at, 256)
                n, s1, s2, prefix, sign = [], [], [], [], []
                for t in part.column(1).to_pylist():
                    x, ordered = order.ordered(t, words)
                    d = digest(x.tobytes())
                    n.append(len(x))
                    s1.append(d >> 64)
                    s2.append(d & ((1 << 64) - 1))
                    sign.append(signature(x))
                    prefix.append(ordered[:len(x) - -(-percent * len(x) // 100) + 1].view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(np.array(s1, np.uint64).view(np.int64)),
                     pa.array(np.array(s2, np.uint64).view(np.int64)), pa.array(prefix, pa.list_(pa.int64())),
                     pa.array(sign, pa.binary())], ["doc_id", "n", "s1", "s2", "prefix", "sign"])

    return _texts(docs, text_col, F.col(id_col).cast("long").alias("doc_id")) \
        .transform(map_arrow, run, "doc_id long, n long, s1 long, s2 long, prefix array<long>, sign binary")


def size_class(n: str, percent: int):
    """Class of a set size: sizes that link differ by a factor of percent / 100 at most, so by one
    class (the width is a hair more, for the rounding of logarithms)."""
    width = -math.log(percent / 100.0) * 1.0001
    return F.floor(F.log(F.col(n).cast("double")) / F.lit(width)).cast("int")


def class_ties(items: DataFrame, percent: int) -> DataFrame:
    """(node, first): the nodes of like size that share an item, tied to the smallest of them."""
    cls = size_class("n", percent)
    rows = items.select("item", "node", F.explode(F.array(cls, cls + 1)).alias("c"))
    first = written(rows.groupBy(F.col("item").alias("i"), F.col("c").alias("k")).agg(F.min("node").alias("first"), F.max("node").alias("last"))
                    .where("first < last").select("i", "k", "first"), "jaccard-first")
    return rows.join(first, (F.col("item") == F.col("i")) & (F.col("c") == F.col("k"))).where("node <> first") \
        .select("node", "first").distinct()


def pair_ties(items: DataFrame, signs: DataFrame, percent: int, group: int = GROUP) -> DataFrame:
    """(node, first): as ``class_ties``, but of items of at most ``group`` nodes only pairs whose signatures allow a link."""
    many = written(items.groupBy(F.col("item").alias("i")).agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > group).select("i"), "jaccard-many")
    few = items.join(many, F.col("item") == F.col("i"), "left_anti") \
        .join(signs, F.col("node") == F.col("s_node")).select("item", "node", "n", "sign")

    def ties(it):
        key, rows, out = None, [], []
        for b in it:
            for item, node, n, sign in zip(*(c.to_pylist() for c in b.columns)):
                if item != key:
                    out += group_ties(rows, percent)
                    key, rows = item, []
                rows.append((node, n, int.from_bytes(sign, "little"), 8 * len(sign)))
            if len(out) > EDGE_ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["node", "first"])
                out = []
        if out := out + group_ties(rows, percent):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["node", "first"])

    near = few.repartition("item").sortWithinPartitions("item", "n", "node").transform(map_arrow, ties, "node long, first long")
    return near.unionByName(class_ties(items.join(many, F.col("item") == F.col("i"), "left_semi"), percent)).distinct()


def prefix_blocks(sets: DataFrame, nodes: DataFrame, percent: int, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """(node, block): no link leaves a block. Nodes whose prefix shares a shingle with a node of a like size make
    one; those of a block of over ``block_shingles`` / 4 are tied again, by pairs that may link."""
    prefixes = sets.select(F.col("s1").alias("node"), "n", F.explode("prefix").alias("item"))
    # Written first: a join of two plain shuffles is one whose hot items Spark can split.
    shared = written(prefixes.groupBy(F.col("item").alias("i")).agg(F.min("node").alias("first"), F.max("node").alias("last"))
                     .where("first < last").select("i"), "jaccard-shared")
    items = written(prefixes.join(shared, F.col("item") == F.col("i")).select("item", "node", "n").distinct(), "jaccard-items")
    blocks = written(components(class_ties(items, percent), "node", "first").withColumnRenamed("root", "block"), "jaccard-blocks")
    sizes = nodes.select(F.col("node").alias("n_node"), F.col("n").alias("size"))
    large = written(blocks.join(sizes, F.col("node") == F.col("n_node")).groupBy(F.col("block").alias("l_block"))
                    .agg(F.sum("size").alias("size")).where(F.col("size") > block_shingles / 4.0).select("l_block"), "jaccard-large")
    if large.isEmpty():
        return blocks
    within = written(blocks.join(large, F.col("block") == F.col("l_block"), "left_semi").select(F.col("node").alias("w_node")), "jaccard-within")
    signs = sets.join(within, F.col("s1") == F.col("w_node"), "left_semi").select(F.col("s1").alias("s_node"), "sign").dropDuplicates(["s_node"])
    ties = pair_ties(items.join(within, F.col("node") == F.col("w_node"), "left_semi"), signs, percent)
    return blocks.join(large, F.col("block") == F.col("l_block"), "left_anti").select("node", "block") \
        .unionByName(components(ties, "node", "first").withColumnRenamed("root", "block"))


def dealt_tasks():
    """The tasks (cls, i, j, w, side) of a set of chunk ``chunk`` of the ``chunks`` of class ``cls``.

    A chunk of a class meets every chunk of the class: stored where it is the smaller, walking where
    the larger. It also walks every chunk of the class below: the first chunk where that chunk meets
    itself, any other (w) in a task of its own, to which that chunk is dealt once more. So no task
    holds more than two chunks.
    """
    def task(cls, i, j, w, side):
        return F.struct(cls.cast("int").alias("cls"), i.cast("int").alias("i"), j.cast("int").alias("j"),
                        w.cast("int").alias("w"), side.cast("int").alias("side"))

    def to(n):
        return F.when(F.col(n) > 0, F.sequence(F.lit(0), F.col(n) - 1)).otherwise(F.array().cast("array<int>"))

    chunk, zero, one = F.col("chunk"), F.lit(0), F.lit(1)
    own = F.transform(to("chunks"), lambda j: task(F.col("cls"), F.least(chunk, j), F.greatest(chunk, j), zero,
                                                  F.when(chunk == j, 2).when(chunk < j, 0).otherwise(1)))
    down = F.transform(to("lower"), lambda j: task(F.col("cls") - 1, j, j, chunk, one))
    up = F.transform(F.filter(to("upper"), lambda w: w > 0), lambda w: task(F.col("cls"), chunk, chunk, w, zero))
    return F.concat(own, down, up)


def block_edges(docs: DataFrame, nodes: DataFrame, blocks: DataFrame, words: int, percent: int, id_col: str,
                text_col: str, block_shingles: int = BLOCK_SHINGLES, found: str = "span") -> DataFrame:
    """Links (a, b) between nodes, by ``found``.

    "span": those that span the components of every task; "count": these and rows (a, null, n) whose
    sum over n is the number of rows that node a links with; "every": all links, each once.
    """
    members = nodes.join(blocks.select(F.col("node").alias("b_node"), "block"), F.col("node") == F.col("b_node")) \
        .select("node", "n", "low", "s1", "s2", "copies", "block")
    heavy = members.groupBy(F.col("block").alias("h_block")).agg(F.sum("n").alias("h_n"))
    members = members.join(heavy, F.col("block") == F.col("h_block")).withColumn("cls", F.when(
        F.col("h_n") > block_shingles / 4.0, size_class("n", percent)).otherwise(F.lit(0)).cast("int"))
    parts = members.groupBy(F.col("block").alias("p_block"), F.col("cls").alias("p_cls")).agg(F.sum("n").alias("p_n")) \
        .withColumn("chunks", F.when(F.col("p_n") > block_shingles, F.ceil(F.col("p_n") / F.lit(block_shingles / 2.0))).otherwise(1).cast("int"))
    below = parts.select(F.col("p_block").alias("l_block"), F.col("p_cls").alias("l_cls"), F.col("chunks").alias("lower"))
    above = parts.select(F.col("p_block").alias("u_block"), F.col("p_cls").alias("u_cls"), F.col("chunks").alias("upper"))
    members = written(
        members.join(parts, (F.col("block") == F.col("p_block")) & (F.col("cls") == F.col("p_cls")))
        .join(below, (F.col("block") == F.col("l_block")) & (F.col("cls") == F.col("l_cls") + 1), "left")
        .join(above, (F.col("block") == F.col("u_block")) & (F.col("cls") == F.col("u_cls") - 1), "left")
        .withColumn("lower", F.coalesce("lower", F.lit(0))).withColumn("upper", F.coalesce("upper", F.lit(0)))
        .withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
        .select("node", "low", "s1", "s2", "block", "cls", "chunks", "chunk", "lower", "upper", "copies"), "jaccard-members")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # Few members: they go to the texts. Many: both sides meet by id.
    few = members.count() <= BROADCAST_ROWS
    rows = texts.join(F.broadcast(members) if few else members, F.col("doc_id").eqNullSafe(F.col("low"))) \
        .select("node", "s1", "s2", "block", "cls", "chunks", "chunk", "lower", "upper", "copies", "text")

    def sets_of(it):
        from xxhash import xxh3_128_intdigest as digest

        for b in it:
            for at in range(0, len(b), 256):
                part = b.slice(at, 256)
                found = [shingles(t, words) for t in part.column(10).to_pylist()]
                # An id that several texts share leads here more than once: keep the node's own text.
                own = [digest(x.tobytes()) == ((s1 % (1 << 64)) << 64) + s2 % (1 << 64) for x, s1, s2 in
                       zip(found, part.column(1).to_pylist(), part.column(2).to_pylist())]
                keep = pa.array(own, pa.bool_())
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i).filter(keep) for i in (0, 3, 4, 5, 6, 7, 8, 9)),
                     pa.array([_packed(x) for x, k in zip(found, own) if k], pa.binary())],
                    ["node", "block", "cls", "chunks", "chunk", "lower", "upper", "copies", "items"])

    sets = rows.transform(map_arrow, sets_of, "node long, block long, cls int, chunks int, chunk int, lower int, upper int, copies long, items binary")
    dealt = sets.select("node", "block", "items", "copies", F.explode(dealt_tasks()).alias("t")).select("node", "block", "items", "copies", "t.*")

    def links(it):
        key, nodes_, sets_, sides, copies = None, [], [], [], []

        def done():
            """Record batches of the task that ends here."""
            if len(nodes_) < 2:
                return
            if found == "span":
                if pairs := block_links(sets_, np.array(sides), percent):
                    yield _edges([(nodes_[x], nodes_[y], None) for x, y in pairs])
                return
            if found == "every":
                out = []
                for tree in _walk(sets_, np.array(sides), percent, True):
                    out += [(nodes_[x], nodes_[y], None) for x, y in tree.links]
                    tree.links = []
                    if len(out) > EDGE_ROWS:
                        yield _edges(out)
                        out = []
                if out:
                    yield _edges(out)
                return
            rows, total = np.array(copies), np.zeros(len(nodes_), np.int64)

            def add(pairs):
                x, y = np.array(pairs).T
                np.add.at(total, x, rows[y])
                np.add.at(total, y, rows[x])

            out = [(nodes_[x], nodes_[y], None) for x, y in all_block_links(sets_, np.array(sides), percent, add)]
            out += [(nodes_[x], None, int(total[x])) for x in np.flatnonzero(total)]
            if out:
                yield _edges(out)

        for b in it:
            for node, block, items, cls, i, j, w, side, n in zip(*(c.to_pylist() for c in b.columns)):
                if (block, cls, i, j, w) != key:
                    yield from done()
                    key, nodes_, sets_, sides, copies = (block, cls, i, j, w), [], [], [], []
                if nodes_ and nodes_[-1] == node:
                    continue  # a repeated row: sorted, so right behind the first
                nodes_.append(node)
                sets_.append(_unpacked(items))
                sides.append(side)
                copies.append(n)
        yield from done()

    return dealt.repartition("block", "cls", "i", "j", "w").sortWithinPartitions("block", "cls", "i", "j", "w", "node") \
        .select("node", "block", "items", "cls", "i", "j", "w", "side", "copies").transform(map_arrow, links, "a long, b long, n long")


def _packed(hashes: np.ndarray) -> bytes:
    """The upper 48 bits of each hash: they order and tell apart the shingles of a block."""
    return hashes.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, 2:] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view(">u8").reshape(-1).astype(np.uint64)


def _edges(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["a", "b", "n"])


def jaccard_sets(docs: DataFrame, words: int, percent: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """One row per document (``shingle_sets``), and one per distinct set that isn't empty."""
    order = GlobalOrder(*text_counters(docs, words, text_col))
    sets = written(shingle_sets(docs, order, words, percent, id_col, text_col), "jaccard-sets")
    nodes = written(sets.where("n > 0").groupBy("s1", "s2").agg(F.min("doc_id").alias("low"), F.first("n").alias("n"),
                                                               F.count(F.lit(1)).alias("copies"))
                    .withColumn("node", F.col("s1")), "jaccard-nodes")
    return sets, nodes


def jaccard_links(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id",
                  text_col: str = "text", block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """(set_a, set_b): every link between different sets, once, set_a < set_b; ``set_id`` of
    ``jaccard_components`` names each document's set."""
    sets, nodes = jaccard_sets(docs, words, percent, id_col, text_col)
    return block_edges(docs, nodes, prefix_blocks(sets, nodes, percent, block_shingles), words, percent, id_col, text_col, block_shingles, "every") \
        .select(F.least("a", "b").alias("set_a"), F.greatest("a", "b").alias("set_b"))


def jaccard_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id",
                       text_col: str = "text", block_shingles: int = BLOCK_SHINGLES, count_links: bool = True) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest id reachable by links) of every row.

    With ``count_links`` also n_links (the other rows that it links with, those of an equal set
    included) and set_id (equal for equal sets; null without words).
    """
    sets, nodes = jaccard_sets(docs, words, percent, id_col, text_col)
    edges = block_edges(docs, nodes, prefix_blocks(sets, nodes, percent, block_shingles), words, percent, id_col, text_col, block_shingles,
                        "count" if count_links else "span")
    if count_links:
        edges = written(edges, "jaccard-links")
    linked = components(edges.where("b IS NOT NULL").select("a", "b"), "a", "b")
    rooted = nodes.join(linked.select(F.col("node").alias("l_node"), "root"), F.col("node") == F.col("l_node"), "left") \
        .withColumn("root", F.coalesce("root", "node"))
    lows = rooted.groupBy(F.col("root").alias("r")).agg(F.min("low").alias("component"))
    labels = rooted.join(lows, F.col("root") == F.col("r"))
    extra = []
    if count_links:
        counts = edges.where("b IS NULL").groupBy(F.col("a").alias("c_node")).agg(F.sum("n").alias("others"))
        labels = labels.join(counts, F.col("node") == F.col("c_node"), "left") \
            .withColumn("n_links", F.coalesce("others", F.lit(0)) + F.col("copies") - 1)
        extra = ["n_links"]
    labels = labels.select(F.col("s1").alias("l1"), F.col("s2").alias("l2"), "component", *extra)
    return sets.select("doc_id", "n", "s1", "s2") \
        .join(labels, (F.col("s1") == F.col("l1")) & (F.col("s2") == F.col("l2")), "left") \
        .select("doc_id", F.col("n").alias("n_shingles"),
                F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"),
                *([F.coalesce("n_links", F.lit(0)).alias("n_links"), F.when(F.col("n") > 0, F.col("s1")).alias("set_id")] if count_links else []))


def q_jaccard(spark, sf_dir):
    return jaccard_components(documents(spark, sf_dir))


def q_links(spark, sf_dir):
    return jaccard_links(documents(spark, sf_dir))
