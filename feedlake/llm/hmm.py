"""Hidden Markov language model: distributed Baum-Welch and exact scaled forward scoring.

A text is its words (``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased) and one end token. The
model emits *symbols*: the end, each of the ``head`` most frequent words, and ``classes``
endings that hold all other words, unknown ones included. A word of a class has the
probability (c + 1) / (N_class + V_class + 1) there, c its count in the training texts, so the
model gives every text a probability.

* Word counts cover all training texts: tasks count, Spark sums by word.
* ``passes`` rounds of Baum-Welch run over all training texts: every task runs the
  scaled forward-backward recursion on its whole sequences and returns expected counts by
  symbol and state; Spark sums them, the driver normalises a table of fixed size (symbols
  x states). A text of more than ``GROUP_TOKENS`` tokens keeps the forward state at every
  ``BLOCK``-th token only and runs forward again inside each block on the way back.
* Scoring runs the scaled forward recursion over the whole sequence in 64-bit floats.
* Counts of words beyond the bounded dictionary (``DICTIONARY`` words) are looked up
  by a shuffle join, so the vocabulary may grow without limit.

Defined cases: null and empty texts are the end token alone; a null id is never held
out; repeated rows are scored each on their own; without training texts every count is
0 and the model is uniform; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.llm.common import ascii_words, documents, id_bucket, map_arrow, written
from feedlake.llm.words import _buffers

STATES = 8
HEAD = 20_000
CLASSES = 1024
DICTIONARY = 200_000
PASSES = 5
BLOCK = 8192
#: A state's probability falls by 1e-23 a step at worst (a word of 1 in 1e12 tokens): 8 steps stay far from underflow.
SCALE_STEPS = 8
COUNT_BYTES = 24 << 20
SLICE_BYTES = 1 << 20
GROUP_TOKENS = 400_000
KAPPA = 50.0
END = b""
LOG10 = math.log(10.0)


# --- recursions over a group of sequences, all at once, longest first -------------------

def lay_out(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For lengths in falling order: sequences that reach step t, and where step t begins."""
    active = np.searchsorted(-lengths, -np.arange(int(lengths[0])), side="left")
    return active, np.concatenate([[0], np.cumsum(active)])


def by_step(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Symbols laid out step by step instead of sequence by sequence."""
    rank = np.repeat(np.arange(len(lengths)), lengths)
    step = np.arange(len(rank)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out = np.empty(len(rank), flat.dtype)
    out[off[step] + rank] = flat[np.repeat(starts, lengths) + step]
    return out


def groups(lengths: np.ndarray, limit: int = GROUP_TOKENS):
    """Index groups of similar length, longest first, of about ``limit`` tokens each."""
    order = np.argsort(-lengths, kind="stable")
    total = np.cumsum(lengths[order])
    at = 0
    while at < len(order):
        base = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, base + limit, side="right")))
        yield order[at:end]
        at = end


def walk(active: np.ndarray, off: np.ndarray):
    """For each step the number of sequences, where it begins, and the first sequence whose forward states are
    scaled there: all of them at every ``SCALE_STEPS``-th step, else those that end (they are the last ones)."""
    first = np.append(active[1:], 0)
    first[SCALE_STEPS - 1::SCALE_STEPS] = 0
    for at in range(0, len(active), BLOCK):
        yield from zip(*(x[at:at + BLOCK].tolist() for x in (active, off[:-1], first)))


@dataclass
class Hmm:
    pi: np.ndarray  # states
    a: np.ndarray  # states x states
    b: np.ndarray  # symbols x states

    def forward(self, flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Natural log likelihood of each sequence (lengths over 0)."""
        out = np.zeros(len(lengths))
        ones = np.ones(len(self.pi))
        for g in groups(lengths):
            size = lengths[g]
            active, off = lay_out(size)
            sym = by_step(flat, starts[g], size, off).astype(np.intp)
            logs, alpha = np.zeros(len(g)), None
            for n, lo, first in walk(active, off):
                x = self.b.take(sym[lo:lo + n], axis=0, mode="clip")
                x *= self.pi if alpha is None else alpha[:n] @ self.a
                alpha = x
                if first < n:
                    scale = alpha[first:] @ ones
                    alpha[first:] /= scale[:, None]
                    logs[first:n] += np.log(scale)
            out[g] = logs
        return out

    def expect(self, flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, counts: Counts) -> None:
        """Add the expected counts of the sequences (forward-backward) to ``counts``."""
        h = len(self.pi)
        ones = np.ones(h)
        for g in groups(lengths):
            size = lengths[g]
            if size[0] > GROUP_TOKENS:  # a group of its own
                self.expect_long(flat[starts[g[0]]:starts[g[0]] + size[0]], counts)
                continue
            active, off = lay_out(size)
            sym = by_step(flat, starts[g], size, off).astype(np.intp)
            b, alpha, beta = (counts.rows(i, len(sym)) for i in range(3))
            np.take(self.b, sym, axis=0, out=b, mode="clip")
            steps, last = list(walk(active, off)), None
            for n, lo, first in steps:
                x = alpha[lo:lo + n]
                np.multiply(self.pi if last is None else last[:n] @ self.a, b[lo:lo + n], out=x)
                last = x
                if first < n:
                    scale = x[first:] @ ones
                    x[first:] /= scale[:, None]
                    b[lo + first:lo + n] /= scale[:, None]
                    counts.loglik += float(np.log(scale).sum())
            beta[:] = 1.0
            back = np.ascontiguousarray(self.a.T)
            for (n, lo, _), (_, up, _) in zip(steps[:0:-1], steps[-2::-1]):
                x = b[lo:lo + n]
                x *= beta[lo:lo + n]
                np.matmul(x, back, out=beta[up:up + n])
            xi, before = np.zeros((h, h)), np.arange(off[1], len(sym)) - np.repeat(active[:-1], active[1:])
            for at in range(0, len(before), BLOCK):
                prev = alpha.take(before[at:at + BLOCK], axis=0)
                xi += prev.T @ b[off[1] + at:off[1] + at + len(prev)]
            alpha *= beta
            counts.pi += alpha[:active[0]].sum(0)
            counts.a += xi * self.a
            for k in range(h):
                counts.b[:, k] += np.bincount(sym, alpha[:, k], len(self.b))

    def expect_long(self, sym: np.ndarray, counts: Counts, block: int = BLOCK) -> None:
        """``expect`` of one very long sequence, in memory for one block of tokens."""
        h, marks, loglik = len(self.pi), [], 0.0
        x = self.pi
        for at in range(0, len(sym), block):
            marks.append(x)  # the state before the block's first emission
            alpha, scale = self._along(x, sym[at:at + block])
            loglik += float(np.log(scale).sum())
            x = alpha[-1] @ self.a
        beta, xi = np.ones(h), np.zeros((h, h))
        for at in range((len(sym) - 1) // block * block, -1, -block):
            part = sym[at:at + block]
            alpha, scale = self._along(marks[at // block], part)
            back = np.empty_like(alpha)
            for t in range(len(part) - 1, -1, -1):
                back[t] = beta
                beta = self.a @ (self.b[part[t]] * beta / scale[t])
            follow = self.b[part] * back / scale[:, None]
            xi += alpha[:-1].T @ follow[1:]
            if at:  # the step into this block
                before, _ = self._along(marks[at // block - 1], sym[at - block:at])
                xi += np.outer(before[-1], follow[0])
            gamma = alpha * back
            for k in range(h):
                counts.b[:, k] += np.bincount(part, gamma[:, k], len(self.b))
            if not at:
                counts.pi += gamma[0]
        counts.a += xi * self.a
        counts.loglik += loglik

    def _along(self, x: np.ndarray, sym: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scaled forward states and scales of a stretch that the state ``x`` enters."""
        alpha, scale = np.empty((len(sym), len(x))), np.empty(len(sym))
        for t, o in enumerate(sym):
            y = x * self.b[o]
            scale[t] = s = y.sum()
            alpha[t] = y / s
            x = alpha[t] @ self.a
        return alpha, scale


@dataclass
class Counts:
    pi: np.ndarray
    a: np.ndarray
    b: np.ndarray
    loglik: float = 0.0
    room: dict[int, np.ndarray] = field(default_factory=dict)

    def rows(self, name: int, n: int) -> np.ndarray:
        """``n`` rows of states to work in; their memory is kept from group to group."""
        if len(self.room.get(name, ())) < n:
            self.room[name] = np.empty((max(n, GROUP_TOKENS), len(self.pi)))
        return self.room[name][:n]

    @staticmethod
    def zeros(symbols: int, states: int) -> Counts:
        return Counts(np.zeros(states), np.zeros((states, states)), np.zeros((symbols, states)))

    def model(self, unigram: np.ndarray, kappa: float = KAPPA) -> Hmm:
        """Normalised counts; emissions lean on the unigram by ``kappa`` tokens."""
        b = (self.b + kappa * unigram[:, None]) / (self.b.sum(0) + kappa)
        a = (self.a + 1.0) / (self.a + 1.0).sum(1, keepdims=True)
        return Hmm((self.pi + 1.0) / (self.pi + 1.0).sum(), a, b)


def start_model(unigram: np.ndarray, states: int, seed: int = 7) -> Hmm:
    rng = np.random.default_rng(seed)
    b = unigram[:, None] * rng.gamma(1.0, 1.0, (len(unigram), states))
    a = np.full((states, states), 0.3 / states) + 0.7 * np.eye(states)
    return Hmm(np.full(states, 1.0 / states), a, b / b.sum(0))


# --- corpus counts ------------------------------------------------------------------------

def text_slices(texts: pa.Array, limit: int = SLICE_BYTES):
    """Stretches of rows of about ``limit`` bytes, one row at least, as (start, length)."""
    at, total = 0, 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if i > at and total + n > limit:
            yield at, i - at
            at, total = i, 0
        total += n
    if len(texts) > at:
        yield at, len(texts) - at


def coded_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Words of all texts in a row (as ``ascii_words``): number of each text, codes, and the distinct words they stand for."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    coded = split.flatten().dictionary_encode()
    offsets, raw = _buffers(coded.dictionary)
    cuts, whole = offsets.tolist(), raw.tobytes()
    words, codes = [whole[a:z] for a, z in zip(cuts, cuts[1:])], coded.indices.to_numpy()
    lengths = split.value_lengths().to_numpy().astype(np.int64)
    if b"" in words:  # before or behind white space
        real = codes != words.index(b"")
        ends = np.concatenate([[0], np.cumsum(real)])[np.cumsum(lengths)]
        lengths, codes = np.diff(ends, prepend=0), codes[real]
    return lengths, codes, words


def count_words(texts: DataFrame, limit: int = COUNT_BYTES) -> DataFrame:
    """(word, n) over all rows of the one text column; END counts the texts. A task holds
    counts of about ``limit`` bytes and passes them on when they are full."""
    def run(it):
        c: Counter = Counter()

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(list(c), pa.binary()), pa.array(list(c.values()), pa.int64())],
                                              ["word", "n"])
        for b in it:
            for at, n in text_slices(b.column(0)):
                for t in b.column(0).slice(at, n).to_pylist():
                    c.update(ascii_words(t))
                    c[END] += 1
                if 160 * len(c) > limit:
                    yield flush()
                    c.clear()
        if c:
            yield flush()

    return texts.transform(map_arrow, run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def ending_class(word: bytes, classes: int = CLASSES) -> int:
    return zlib.crc32(word[-3:]) % classes


@dataclass
class Vocabulary:
    """Counts that fit everywhere: totals, the bounded dictionary, and class totals."""

    total: int  # N
    types: int  # V
    ends: int
    words: list[bytes]  # most frequent first
    n: np.ndarray
    head: int
    class_n: np.ndarray
    class_v: np.ndarray

    @property
    def symbols(self) -> int:
        return 1 + self.head + len(self.class_n)

    def unigram(self) -> np.ndarray:
        c = np.concatenate([[self.ends], self.n[:self.head], self.class_n]).astype(float) + 1.0
        return c / c.sum()


def read_vocabulary(counts: DataFrame, head: int = HEAD, dictionary: int = DICTIONARY, classes: int = CLASSES) -> Vocabulary:
    """The dictionary holds the words above a frequency level that at most ``dictionary`` words reach."""
    level = F.floor(F.log2(F.col("n")) * 32).cast("int")
    words = counts.where(F.length("word") > 0)
    total, types, ends = counts.agg(F.sum("n"), F.count("n"), F.sum(F.when(F.length("word") == 0, F.col("n")))).first()
    sizes = sorted(words.groupBy(level.alias("level")).count().collect(), reverse=True)
    floor, held = 1 << 30, 0
    for at, n in sizes:
        held += n
        if held > dictionary:
            break
        floor = at
    top = words.where(level >= floor).select("word", "n").toPandas()
    top["word"] = top["word"].map(bytes)
    top = top.sort_values(["n", "word"], ascending=[False, True])
    names, n = top["word"].tolist(), top["n"].to_numpy(np.int64)
    head = min(head, len(names))
    by_class = words.groupBy((F.crc32(F.substring("word", -3, 3)) % classes).cast("int").alias("k")) \
        .agg(F.sum("n").alias("n"), F.count("n").alias("v")).toPandas()
    class_n, class_v = np.zeros(classes, np.int64), np.zeros(classes, np.int64)
    class_n[by_class["k"]], class_v[by_class["k"]] = by_class["n"], by_class["v"]
    for w, c in zip(names[:head], n[:head]):  # a head word is a symbol of its own
        k = ending_class(w, classes)
        class_n[k] -= c
        class_v[k] -= 1
    return Vocabulary(int(total or 0), int(types or 0), int(ends or 0), names, n, head, class_n, class_v)


def to_symbols(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """One row per text: symbols, what the dictionary knows of the sums, and the words beyond it."""
    classes = len(vocab.class_n)
    schema = ("row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_log double, word_log double, "
              "symbols binary, rest array<struct<word:binary,n:int>>")
    names, n, head = vocab.words, vocab.n, vocab.head
    class_log = np.log10(vocab.class_n + vocab.class_v + 1.0)
    end_log, symbols, ends = math.log10(vocab.ends + 1.0), vocab.symbols, vocab.ends

    def run(it):
        known = {w: i for i, w in enumerate(names)}
        logs = np.log10(np.concatenate([n, [0]]) + 1.0)
        symbol_of = np.array([*range(1, head + 1), *(1 + head + ending_class(w, classes) for w in names[head:]), 0])
        width = "<u2" if symbols <= 65536 else "<u4"
        ctx = TaskContext.get()
        row = (ctx.partitionId() if ctx else 0) << 36
        for b in it:
            for at, size in text_slices(b.column(2)):
                rows, codes, rest_words, rest_n, rest_at = [], [], [], [], [0]
                lengths, spoken, words = coded_words(b.column(2).slice(at, size))
                found = np.fromiter((known.get(w, -1) for w in words), np.int64, len(words))
                symbol = symbol_of[found]
                unknown = np.flatnonzero(found < 0)
                symbol[unknown] = [1 + head + ending_class(words[i], classes) for i in unknown.tolist()]
                to = 0
                for length in lengths.tolist():
                    code = spoken[to:to + length]
                    to += length
                    idx, sym = found[code], symbol[code]
                    beyond = code[idx < 0]
                    if len(beyond):
                        rest = Counter(beyond.tolist())
                        rest_words += [words[i] for i in rest]
                        rest_n += rest.values()
                    rest_at.append(len(rest_words))
                    in_class = sym[sym > head] - 1 - head
                    base = float(logs[idx].sum()) + end_log
                    word = float(logs[idx[idx >= head]].sum()) - float(class_log[in_class].sum())
                    rows.append((row, length + 1, int((idx >= 0).sum()) + (ends > 0), base, word))
                    codes.append(np.append(sym, 0).astype(width).tobytes())
                    row += 1
                cols = list(zip(*rows))
                rest = pa.ListArray.from_arrays(pa.array(rest_at, pa.int32()), pa.StructArray.from_arrays(
                    [pa.array(rest_words, pa.binary()), pa.array(rest_n, pa.int32())], ["word", "n"]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int64()), b.column(0).slice(at, size), b.column(1).slice(at, size),
                     pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.float64()),
                     pa.array(cols[4], pa.float64()), pa.array(codes, pa.binary()), rest],
                    ["row", "doc_id", "held_out", "n_tokens", "n_known", "base_log", "word_log", "symbols", "rest"])

    return docs.transform(map_arrow, run, schema)


# --- training and scoring -------------------------------------------------------------------

def flat_symbols(rows: list[bytes], width: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    parts = [np.frombuffer(x, width) for x in rows]
    lengths = np.array([len(x) for x in parts], np.int64)
    return np.concatenate(parts) if parts else np.zeros(0, width), np.cumsum(lengths) - lengths, lengths


def expected_counts(seqs: DataFrame, model: Hmm) -> Counts:
    """One Baum-Welch round: counts of all sequences, summed by Spark by symbol."""
    symbols, states = model.b.shape
    width = "<u2" if symbols <= 65536 else "<u4"
    names = [f"c{k}" for k in range(states)]

    def run(it):
        counts = Counts.zeros(symbols, states)
        held: list[bytes] = []
        size = 0

        def learn():
            nonlocal held, size
            flat, starts, lengths = flat_symbols(held, width)
            model.expect(flat, starts, lengths, counts)
            held, size = [], 0
        for batch in it:  # many sequences at once, so that those of like length run side by side
            for x in batch.column(0).to_pylist():
                held.append(x)
                size += len(x)
                if size > 2 * GROUP_TOKENS * np.dtype(width).itemsize:
                    learn()
        if held:
            learn()
        seen = np.flatnonzero(counts.b.sum(1) > 0)
        extra = np.vstack([counts.a, counts.pi[None, :], np.full((1, states), counts.loglik)])
        key = np.concatenate([seen, -1 - np.arange(len(extra))])
        values = np.vstack([counts.b[seen], extra])
        yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), *(pa.array(values[:, k]) for k in range(states))],
                                         ["key", *names])

    summed = seqs.select("symbols").transform(map_arrow, run, "key long, " + ", ".join(f"{c} double" for c in names)) \
        .groupBy("key").agg(*[F.sum(c).alias(c) for c in names]).toPandas()
    out = Counts.zeros(symbols, states)
    key, values = summed["key"].to_numpy(), summed[names].to_numpy(float)
    out.b[key[key >= 0]] = values[key >= 0]
    for k, v in zip(key[key < 0], values[key < 0]):
        i = -1 - int(k)
        if i < states:
            out.a[i] = v
        elif i == states:
            out.pi = v
        else:
            out.loglik = float(v[0])
    return out


def train(seqs: DataFrame, vocab: Vocabulary, states: int = STATES, passes: int = PASSES) -> Hmm:
    """Baum-Welch over all training sequences, from a start that leans on the unigram."""
    unigram = vocab.unigram()
    model = start_model(unigram, states)
    if not vocab.total:
        return Counts.zeros(vocab.symbols, states).model(unigram)
    learn = seqs.where(~F.col("held_out"))
    for _ in range(passes):
        model = expected_counts(learn, model).model(unigram)
    return model


def score_sequences(seqs: DataFrame, model: Hmm) -> DataFrame:
    """Adds ``forward``: the log10 likelihood of the symbols."""
    width = "<u2" if len(model.b) <= 65536 else "<u4"
    keep = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base_log", "word_log"]

    def run(it):
        for batch in it:
            for at in range(0, len(batch), 2048):
                part = batch.slice(at, 2048)
                flat, starts, lengths = flat_symbols(part.column(7).to_pylist(), width)
                logs = model.forward(flat, starts, lengths) / LOG10 if len(lengths) else np.zeros(0)
                yield pa.RecordBatch.from_arrays([*part.columns[:7], pa.array(logs, pa.float64())], [*keep, "forward"])

    return seqs.select(*keep, "symbols").transform(map_arrow, 
        run, "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_log double, word_log double, "
             "forward double")


def score_documents(docs: DataFrame, held_out, states: int = STATES, head: int = HEAD, dictionary: int = DICTIONARY,
                    passes: int = PASSES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Log10 probabilities of every text under the model and under the add-one unigram.

    ``held_out`` is a Column: rows where it is true are not learned from.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    counts = written(count_words(texts.where(~F.col("held_out")).select("text")), "lm-counts")
    vocab = read_vocabulary(counts, head, dictionary)
    seqs = written(to_symbols(texts, vocab), "lm-symbols")
    model = train(seqs, vocab, states, passes)
    rest = seqs.select("row", F.explode("rest").alias("r")).select("row", "r.word", F.col("r.n").alias("times")) \
        .join(counts.select(F.col("word").alias("w"), F.col("n").alias("c")), F.col("word") == F.col("w"), "left") \
        .groupBy("row").agg(F.sum(F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(1.0))).alias("rest_log"),
                            F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("rest_known")) \
        .withColumnRenamed("row", "r_row")
    rest_log = F.coalesce("rest_log", F.lit(0.0))
    per_token = math.log10(vocab.total + vocab.types + 1.0)
    return score_sequences(seqs, model).join(rest, F.col("row") == F.col("r_row"), "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("rest_known", F.lit(0))).alias("n_known"),
        F.lit(vocab.total).cast("long").alias("train_tokens"),
        (F.col("base_log") + rest_log - F.col("n_tokens") * F.lit(per_token)).alias("base_score"),
        (F.col("forward") + F.col("word_log") + rest_log).alias("score"))


def q_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(documents(spark, sf_dir), id_bucket("doc_id", 7) == 2)
