"""Suffix-array dedup: removes bytes covered by strings of ``length`` bytes that occur elsewhere too.

Every start of a window of ``length`` bytes is a suffix cut to that length. Windows are
dealt to shards by content: the smallest hash of a ``GRAM``-byte gram inside a window is
its anchor, consecutive windows of one anchor make a *run* (a substring that holds them
all), and equal windows have equal anchors, so a match never leaves its shard.

1. All runs of all texts are counted by anchor (partial sums first). Anchors seen once
   have no matches. Where all runs of an anchor are equal, all their windows match.
2. Of anchors with several different runs each distinct run is read once (joined back to its
   text) and goes to its shard's index, a logarithmic family: every new batch of runs gets
   a suffix array; it is merge-scanned against the arrays of the levels at hand, which marks
   the windows that match on both sides; arrays of equal size class merge, each linearly,
   so a level holds twice what the one below does, up to ``LEVEL_BYTES``.
3. Marked windows go back to the texts as byte ranges and are taken out.

The arrays sort suffixes by a 64-bit fingerprint of their ``length`` bytes and not
letter by letter: only whole matches of that length count, equal suffixes lie side by side
in either order, and this order merges linearly. Every match is confirmed on the bytes.

Runs of an anchor with more than ``HOT`` different runs are dealt window by window, by
fingerprint, so that no shard holds a hot anchor.

Defined cases: null text is empty; texts shorter than ``length`` keep everything; rows that
share id and text count as separate documents (they match each other) and come out alike; a
null id is like any other; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import documents, map_arrow, written

LENGTH = 200
GRAM = 32
HOT = 2000
BATCH_BYTES = 1 << 20
LEVEL_BYTES = 1 << 24
SHARD_BYTES = 1 << 23
BLOCK = 1 << 19
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                               0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]
_PLACE = np.uint64((1 << 24) - 1)


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h *= _ODD[7]
    return h ^ (h >> np.uint64(29))


def gram_hashes(buf: np.ndarray, size: int) -> np.ndarray:
    """64-bit hash of the ``size`` bytes at every position, by doubling."""
    if len(buf) < size:
        return np.zeros(0, np.uint64)
    power, step = buf.astype(np.uint64) + np.uint64(1), 1  # hashes of ``step`` bytes
    done, covered = None, 0
    while True:
        if size & step:
            if done is None:
                done = power
            else:
                n = min(len(done), len(power) - covered)
                done = _mix(done[:n] * _ODD[6] + power[covered:covered + n])
            covered += step
        if covered == size:
            return _mix(done)
        power = power[:-step] * _ODD[step.bit_length() % 6] + power[step:]
        step *= 2
        if step == 8:
            power = _mix(power)


def window_minima(keys: np.ndarray, width: int) -> np.ndarray:
    """Smallest key of every ``width`` consecutive ones, by doubling."""
    step = 1
    while 2 * step <= width:
        keys = np.minimum(keys[:-step], keys[step:])
        step *= 2
    if step < width:
        keys = np.minimum(keys[:len(keys) - (width - step)], keys[width - step:])
    return keys


def window_runs(raw: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first window and number of windows of every run of a text."""
    anchors, starts, sizes = [], [], []
    buf = np.frombuffer(raw, np.uint8)
    for at in range(0, max(0, len(raw) - length + 1), BLOCK):  # windows that begin in this block
        part = buf[at:at + BLOCK + length - 1]
        h = gram_hashes(part, gram)
        key = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
        place = (window_minima(key, length - gram + 1) & _PLACE).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(np.diff(place)) + 1])
        anchors.append(h[place[first]])
        starts.append(first + at)
        sizes.append(np.diff(np.append(first, len(place))))
    if not anchors:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(anchors).view(np.int64), np.concatenate(starts), np.concatenate(sizes)


# --- the index of one shard -------------------------------------------------------------------

@dataclass
class SuffixArray:
    """Suffixes of ``text`` at ``at``, sorted by the fingerprint of their first ``length`` bytes."""

    text: np.ndarray
    at: np.ndarray
    key: np.ndarray
    hit: np.ndarray
    owner: np.ndarray

    @staticmethod
    def build(texts: list[bytes], owners: np.ndarray, length: int) -> SuffixArray:
        size = np.array([len(t) for t in texts], np.int64)
        begin = np.cumsum(size) - size
        count = size - length + 1
        text = np.frombuffer(b"".join(texts), np.uint8)
        at = np.repeat(begin, count) + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        key = np.concatenate([gram_hashes(text[k:k + BLOCK + length - 1], length)
                              for k in range(0, max(1, len(text) - length + 1), BLOCK)])[at]
        order = np.argsort(key, kind="stable")
        out = SuffixArray(text, at[order], key[order], np.zeros(len(at), bool), np.repeat(owners, count)[order])
        same = np.flatnonzero(out.key[1:] == out.key[:-1])
        right = equal_windows(text, out.at[same], text, out.at[same + 1], length)
        out.hit[same[right]] = True
        out.hit[same[right] + 1] = True
        for i in same[~right]:  # one fingerprint, different bytes: look through all that share it
            group = np.flatnonzero(out.key == out.key[i])
            seen: dict[bytes, list[int]] = {}
            for g in group:
                seen.setdefault(text[out.at[g]:out.at[g] + length].tobytes(), []).append(g)
            for members in seen.values():
                out.hit[members] |= len(members) > 1
        return out

    def scan(self, other: SuffixArray, length: int) -> None:
        """Merge-scan: mark the suffixes of both arrays that are equal."""
        spot = np.searchsorted(other.key, self.key)
        near = np.flatnonzero(other.key[np.minimum(spot, len(other.key) - 1)] == self.key)
        near = near[spot[near] < len(other.key)]
        right = equal_windows(self.text, self.at[near], other.text, other.at[spot[near]], length)
        self.hit[near[right]] = True
        other.hit[spot[near[right]]] = True
        for i in near[~right]:
            k = spot[i] + 1
            mine = self.text[self.at[i]:self.at[i] + length].tobytes()
            while k < len(other.key) and other.key[k] == self.key[i]:
                if other.text[other.at[k]:other.at[k] + length].tobytes() == mine:
                    self.hit[i] = other.hit[k] = True
                k += 1

    def merge(self, other: SuffixArray) -> SuffixArray:
        key = np.concatenate([self.key, other.key])
        order = np.argsort(key, kind="stable")  # two sorted runs: one linear merge
        pick = lambda a, b: np.concatenate([a, b])[order]
        return SuffixArray(np.concatenate([self.text, other.text]), pick(self.at, other.at + len(self.text)), key[order],
                           pick(self.hit, other.hit), pick(self.owner, other.owner))


def equal_windows(a: np.ndarray, at: np.ndarray, b: np.ndarray, bt: np.ndarray, length: int) -> np.ndarray:
    out = np.empty(len(at), bool)
    if len(at):
        x, y = (np.lib.stride_tricks.sliding_window_view(t, length) for t in (a, b))
        for k in range(0, len(at), 8192):
            out[k:k + 8192] = (x[at[k:k + 8192]] == y[bt[k:k + 8192]]).all(1)
    return out


class LevelFamily:
    """Levels of suffix arrays whose sizes grow geometrically."""

    def __init__(self, length: int = LENGTH, batch_bytes: int = BATCH_BYTES, level_bytes: int = LEVEL_BYTES):
        self.length, self.batch_bytes, self.level_bytes = length, batch_bytes, level_bytes
        self.levels: list[SuffixArray] = []

    def rank(self, array: SuffixArray) -> int:
        return max(0, (len(array.text) // self.batch_bytes).bit_length() - 1)

    def add(self, texts: list[bytes], owners: np.ndarray) -> None:
        new = SuffixArray.build(texts, owners, self.length)
        for level in self.levels:
            new.scan(level, self.length)
        self.levels.append(new)
        while len(self.levels) > 1 and self.rank(self.levels[-1]) >= self.rank(self.levels[-2]) \
                and len(self.levels[-1].text) + len(self.levels[-2].text) <= self.level_bytes:
            b, a = self.levels.pop(), self.levels.pop()
            self.levels.append(a.merge(b))

    def hits(self):
        """(owner, start in the level's text) of the matching suffixes, level by level."""
        for level in self.levels:
            yield level.owner[level.hit], level.at[level.hit]


# --- the corpus ---------------------------------------------------------------------------------

def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """d, e: key of a row by id and text (a null id: by text)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(id_col).cast("long"), F.xxhash64(text)).alias("d"), F.hash(text).alias("e"),
                       text.cast("binary").alias("raw"))


def all_runs(rows: DataFrame, length: int, gram: int) -> DataFrame:
    def run(it):
        from xxhash import xxh3_64_intdigest as digest

        for b in it:
            for at in range(0, len(b), 256):
                part = b.slice(at, 256)
                d, e = part.column(0).to_numpy(), part.column(1).to_numpy()
                found, contents, which = [], [], []
                for i, raw in enumerate(part.column(2)):
                    raw = raw.as_py()
                    if len(raw) < length:
                        continue
                    a, s, n = window_runs(raw, length, gram)
                    found.append((a, s, n))
                    contents += [digest(raw[x:x + y + length - 1]) for x, y in zip(s.tolist(), n.tolist())]
                    which.append(np.full(len(a), i))
                if found:
                    w = np.concatenate(which)
                    a, s, n = (np.concatenate(x) for x in zip(*found))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(a), pa.array(np.array(contents, np.uint64).view(np.int64)), pa.array(d[w]),
                         pa.array(e[w]), pa.array(s.astype(np.int32)), pa.array(n.astype(np.int32))],
                        ["anchor", "content", "d", "e", "start", "n"])

    return rows.select("d", "e", "raw").transform(map_arrow, run, "anchor long, content long, d long, e int, start int, n int")


def _slices(length: int):
    """Texts of the chosen runs; those of hot anchors window by window."""
    def run(it):
        for b in it:
            for at in range(0, len(b), 64):
                part = b.slice(at, 64)
                out = []
                for raw, runs in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    for r in runs:
                        text = raw[r["start"]:r["start"] + r["n"] + length - 1]
                        if r["hot"]:
                            keys = gram_hashes(np.frombuffer(text, np.uint8), length).view(np.int64).tolist()
                            out += [(k, r["anchor"], r["content"], i, text[i:i + length]) for i, k in enumerate(keys)]
                        else:
                            out.append((r["anchor"], r["anchor"], r["content"], 0, text))
                cols = list(zip(*out)) if out else [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
                     pa.array(cols[3], pa.int32()), pa.array(cols[4], pa.binary())],
                    ["shard", "anchor", "content", "off", "text"])
    return run


def _index(length: int):
    """Matching windows of the runs of a partition's shards, as stretches of window numbers."""
    def run(it):
        family = LevelFamily(length)
        anchor, content, off, begin = [], [], [], []
        texts, owners, held, base = [], [], 0, 0
        spots = []  # where each run begins in its own text: windows count from there

        def flush():
            nonlocal texts, owners, held
            if texts:
                family.add(texts, np.array(owners, np.int64))
            texts, owners, held = [], [], 0

        for b in it:
            anchor.append(b.column(1).to_numpy())
            content.append(b.column(2).to_numpy())
            off.append(b.column(3).to_numpy())
            for i, t in enumerate(b.column(4).to_pylist()):
                texts.append(t)
                owners.append(base + i)
                spots.append(len(t))
                held += len(t)
                if held >= family.batch_bytes:
                    flush()
            base += len(b)
        flush()
        if not base:
            return
        anchor, content, off = map(np.concatenate, (anchor, content, off))
        size = np.array(spots, np.int64)
        for level in family.levels:
            # Texts keep the order they came in, so a level's owners are consecutive.
            low = int(level.owner.min())
            begin = np.cumsum(size[low:]) - size[low:]
            who, at = level.owner[level.hit], level.at[level.hit]
            local = at - begin[who - low]
            order = np.lexsort((local, who))
            who, local = who[order], local[order]
            if not len(who):
                continue
            new = np.concatenate([[True], (np.diff(who) != 0) | (np.diff(local) != 1)])
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(who)) - 1
            w = who[first]
            for k in range(0, len(w), 65536):
                p = slice(k, k + 65536)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor[w[p]]), pa.array(content[w[p]]), pa.array((local[first][p] + off[w[p]]).astype(np.int32)),
                     pa.array((local[last][p] + off[w[p]] + 1).astype(np.int32))], ["anchor", "content", "lo", "hi"])
    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT, with_bytes: bool = True,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, ``with_bytes``, the kept bytes of every document."""
    rows = keyed(docs, id_col, text_col)
    runs = all_runs(rows, length, gram)
    # Written first: a join of two plain shuffles is one whose hot anchors Spark can split.
    anchors = written(runs.groupBy(F.col("anchor").alias("a")).agg(
        F.count(F.lit(1)).alias("times"), F.min("content").alias("lo"), F.max("content").alias("hi"))
        .where("times > 1").select("a", (F.col("lo") != F.col("hi")).alias("varied")), "suffix-anchors")
    repeated = written(runs.join(anchors, F.col("anchor") == F.col("a")).drop("a"), "suffix-runs")
    kinds = repeated.where("varied").groupBy("anchor", "content").agg(
        (F.count(F.lit(1)) > 1).alias("whole"), F.min(F.struct("d", "e", "start", "n")).alias("at"))
    many = kinds.groupBy(F.col("anchor").alias("h")).agg(F.count(F.lit(1)).alias("kinds")).where(F.col("kinds") > hot).select("h")
    kinds = written(kinds.join(many, F.col("anchor") == F.col("h"), "left")
                    .select("anchor", "content", "whole", "at", F.col("h").isNotNull().alias("hot")), "suffix-kinds")
    texts = rows.select("d", "e", "raw")
    wanted = kinds.groupBy(F.col("at.d").alias("wd"), F.col("at.e").alias("we")).agg(F.collect_list(F.struct(
        "anchor", "content", F.col("at.start").alias("start"), F.col("at.n").alias("n"), "hot")).alias("runs"))
    # Rows that share a key share the text: their runs come twice, and are marked as a whole anyway.
    pieces = texts.join(wanted, (F.col("d") == F.col("wd")) & (F.col("e") == F.col("we"))) \
        .select("raw", "runs").transform(map_arrow, _slices(length), "shard long, anchor long, content long, off int, text binary")
    size = kinds.agg(F.sum(F.when(F.col("hot"), F.col("at.n") * length).otherwise(F.col("at.n") + length))).first()[0] or 0
    stretches = pieces.repartition(max(1, -(-size // SHARD_BYTES)), "shard").transform(map_arrow, _index(length), "anchor long, content long, lo int, hi int") \
        .groupBy(F.col("anchor").alias("fa"), F.col("content").alias("fc")) \
        .agg(F.collect_list(F.struct("lo", "hi")).alias("stretches"))
    marks = written(kinds.select("anchor", "content", "whole").join(
        stretches, (F.col("anchor") == F.col("fa")) & (F.col("content") == F.col("fc")), "left")
        .select(F.col("anchor").alias("ma"), F.col("content").alias("mc"), "whole", "stretches"), "suffix-marks")
    all_of_it = F.array(F.struct(F.lit(0).alias("lo"), F.col("n").alias("hi")))
    plain = repeated.where("NOT varied").select("d", "e", "start", all_of_it.alias("w"))
    varied = repeated.where("varied").join(marks, (F.col("anchor") == F.col("ma")) & (F.col("content") == F.col("mc"))) \
        .select("d", "e", "start", F.when(F.col("whole"), all_of_it).otherwise(F.col("stretches")).alias("w")) \
        .where(F.col("w").isNotNull())
    ranges = plain.unionByName(varied).select(F.col("d").alias("rd"), F.col("e").alias("re"), F.explode(F.transform(
        "w", lambda w: F.struct((F.col("start") + w["lo"]).alias("lo"), (F.col("start") + w["hi"] + (length - 1)).alias("hi")))).alias("r")) \
        .groupBy("rd", "re").agg(F.collect_list("r").alias("ranges"))
    joined = rows.select("d", "e", "raw", "doc_id").join(
        ranges, (F.col("d") == F.col("rd")) & (F.col("e") == F.col("re")), "left").select("doc_id", "raw", "ranges")
    fields = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][:6 if with_bytes else 5]

    def cut(it):
        for b in it:
            for at in range(0, len(b), 256):
                part = b.slice(at, 256)
                out = []
                for raw, found in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    spans: list[list[int]] = []
                    for lo, hi in sorted((r["lo"], r["hi"]) for r in found or ()):
                        if spans and lo <= spans[-1][1]:
                            spans[-1][1] = max(hi, spans[-1][1])
                        else:
                            spans.append([lo, hi])
                    edges = [0, *(x for s in spans for x in s), len(raw)]
                    kept = b"".join(raw[x:y] for x, y in zip(edges[::2], edges[1::2]))
                    out.append((len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept))
                cols = list(zip(*out))
                kinds_ = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()][:len(fields) - 1]
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, t) for c, t in zip(cols, kinds_))], fields)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_bytes else "")
    return joined.transform(map_arrow, cut, schema)


def q_suffixes(spark, sf_dir):
    return remove_repeats(documents(spark, sf_dir), with_bytes=False)
