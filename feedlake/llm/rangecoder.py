"""Adaptive context-mixing range coder over token ids, in independent checksummed blocks.

A block codes up to some million ids. Its ids are dealt to lanes (consecutive stretches of
about ``STEPS`` ids); all lanes share one adaptive model, every lane has its own range
coder, and one step codes the next id of each lane with array arithmetic. So the model
learns from the whole block, and a step costs a few array operations.

Predictions: order 2 (hashed table) and order 1 each propose the id that last proved
itself in their context, with a confidence; order 0 is the block's adaptive frequency
table. The lead candidate's probability is mixed from the three orders' adaptive
probabilities in the logistic domain, with weights learned as coding goes on. A hit takes
that share of the range; a miss takes its order-0 share of what is left. All arithmetic is
on integers, so every machine decodes alike.

Nothing is carried from block to block. A block holds its alphabet, its documents' table,
a CRC-32 of its ids and one of all its bytes; damage raises ``ValueError``.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

STEPS = 512
MAX_LANES = 8192
CONF_BITS = 3
LEVELS = 12
TOP, LEAST, WORD = 48, 1 << 32, 16
MAX_TOTAL = 1 << 18
GAIN = 24
#: The model's tables are laid out anew at each of the first steps, then every few steps.
DENSE, EVERY = 16, 32
MAGIC = b"IDB1"
HEAD = struct.Struct("<4s9I")
_MASK = (1 << TOP) - 1
#: Logistic pair on 12-bit probabilities: squash(x) = 4096 / (1 + exp(-x / 256)) and its inverse, as integer tables.
_SQUASH = np.clip(np.rint(4096 / (1 + np.exp(-np.arange(-2047, 2048) / 256))), 1, 4095).astype(np.int64)
_STRETCH = np.clip(np.rint(256 * np.log((np.arange(4096) + 0.5) / (4095.5 - np.arange(4096)))), -2047, 2047).astype(np.int64)


class _Writer:
    """One range coder per lane; carries into words already written are resolved at the end.

    The lanes' words of like place lie side by side: the lanes write at nearly the same place.
    """

    def __init__(self, lanes: int, steps: int):
        self.low, self.span = np.zeros(lanes, np.int64), np.full(lanes, 1 << TOP, np.int64)
        self.lanes, self.out = lanes, np.zeros(lanes * (2 * steps + 4), np.uint32)
        self.at = np.arange(lanes)

    def code(self, chance, total, starts, freq, find, lead, ids):
        """Codes ``ids``: the lead with ``chance`` in 4096, any other by its order-0 share of the rest."""
        part = (self.span >> 12) * chance
        hit = ids == lead
        unit = (self.span - part) // total
        span = np.where(hit, part, unit * freq[ids])
        low = self.low + np.where(hit, 0, part + unit * starts[ids])
        if (over := np.flatnonzero(low > _MASK)).size:
            self.out[self.at[over] - self.lanes] += 1
            low[over] &= _MASK
        while (small := np.flatnonzero(span < LEAST)).size:
            at, rest = self.at[small], low[small]
            self.out[at] = rest >> 32
            self.at[small] = at + self.lanes
            low[small] = (rest & 0xFFFFFFFF) << WORD
            span[small] <<= WORD
        self.low, self.span = low, span
        return ids, hit

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Word counts of the lanes and all words, lane after lane."""
        last = (self.low + LEAST - 1) >> 32
        self.out[self.at[np.flatnonzero(last >> WORD)] - self.lanes] += 1
        self.out[self.at] = last & 0xFFFF
        counts = self.at // self.lanes + 1
        rows = self.out.reshape(-1, self.lanes)[:int(counts.max())]
        for i in range(len(rows) - 1, 0, -1):
            rows[i - 1] += rows[i] >> WORD
        rows = rows.astype("<u2").T
        return counts, rows[np.arange(rows.shape[1]) < counts[:, None]]


class _Reader:
    def __init__(self, counts: np.ndarray, words: np.ndarray):
        ends = np.cumsum(counts)
        self.at, self.end = ends - counts, ends
        self.words = np.concatenate([words.astype(np.int64), [0]])
        self.span, self.code_ = np.full(len(counts), 1 << TOP, np.int64), np.zeros(len(counts), np.int64)
        for _ in range(TOP // WORD):
            self.code_ = self.code_ << WORD | self._next(np.arange(len(counts)))

    def _next(self, who):
        at = self.at[who]
        self.at[who] = at + 1
        return self.words[np.where(at < self.end[who], at, len(self.words) - 1)]

    def code(self, chance, total, starts, freq, find, lead, ids):
        part = (self.span >> 12) * chance
        hit = self.code_ < part
        unit = (self.span - part) // total
        code = np.where(hit, self.code_, self.code_ - part)
        ids = np.where(hit, lead, find[np.where(hit, 0, np.minimum(code // unit, total - 1))])
        code -= np.where(hit, 0, unit * starts[ids])
        span = np.where(hit, part, unit * freq[ids])
        while (small := np.flatnonzero(span < LEAST)).size:
            code[small] = code[small] << WORD | self._next(small)
            span[small] <<= WORD
        self.code_, self.span = code, span
        return ids, hit


class _Mixer:
    """Hit probability of the lead candidate, by logistic mixing of what each order says.

    A state is (order-2 confidence, order-1 confidence, whether order 1 agrees, level of the
    candidate's order-0 frequency). Hits are counted by state; now and then each order's
    adaptive probabilities and the weights (one vector per order-2 confidence) learn from
    the counts, and the mixed probability of every state is laid out as a table.
    """

    CONF = 1 << CONF_BITS
    SHAPE = (CONF, CONF, 2, LEVELS)

    def __init__(self):
        self.weights = np.full((3, self.CONF), 1 << 15, np.int64)
        self.orders = []
        for axis in ((1, 3), (0, 3), (0, 1, 2)):
            hits = np.ones([1 if i in axis else n for i, n in enumerate(self.SHAPE)], np.int64)
            self.orders.append((axis, hits, 2 * hits))
        self.new = []
        self.lay()

    def lay(self):
        self.inputs = [_STRETCH[np.clip(4096 * hits // seen, 1, 4095)] for _, hits, seen in self.orders]
        by_conf = self.weights.reshape(3, self.CONF, 1, 1, 1)
        dot = sum(w * x for w, x in zip(by_conf, self.inputs)) >> 16
        self.chance = _SQUASH[np.clip(dot, -2047, 2047) + 2047]
        self.flat = self.chance.reshape(-1)

    def learn(self):
        misses, hits = np.bincount(np.concatenate(self.new), minlength=2 * self.flat.size).reshape(2, *self.SHAPE)
        self.new = []
        seen = misses + hits
        error = 4096 * hits - seen * self.chance
        by_conf = seen.sum((1, 2, 3))
        for i, (axis, old_hits, old_seen) in enumerate(self.orders):
            slope = (error * self.inputs[i]).sum((1, 2, 3)) // (by_conf * 4 + 256)
            self.weights[i] = np.clip(self.weights[i] + slope, -(1 << 18), 1 << 18)
            old_hits += hits.sum(axis, keepdims=True)
            old_seen += seen.sum(axis, keepdims=True)
            full = old_seen > 1 << 16
            old_seen[full] >>= 1
            old_hits[full] >>= 1
        self.lay()


def _run(coder, letters: int, lanes: int, steps: int, rows: np.ndarray | None) -> np.ndarray | None:
    """Codes ``steps`` x ``lanes`` ids: writes ``rows``, or reads and returns them if that is None."""
    out = np.zeros((steps, lanes), np.int32) if rows is None else rows
    freq, limit = np.ones(letters, np.int64), max(MAX_TOTAL, 8 * letters)
    bits = max(10, min(19, (lanes * steps).bit_length()))
    top = (1 << CONF_BITS) - 1
    # A table entry is candidate << CONF_BITS | confidence.
    order2, order1 = np.zeros(1 << bits, np.int32), np.zeros(letters + 1, np.int32)
    mixer, missed = _Mixer(), []
    prev = before = np.zeros(lanes, np.int64)
    for step in range(steps):
        if step < DENSE or step % EVERY == 0:
            if step:
                ids, hit = map(np.concatenate, zip(*missed))
                freq += GAIN * np.bincount(ids[~hit], minlength=letters)
                while freq.sum() > limit:
                    freq = (freq + 1) >> 1
                missed = []
                mixer.learn()
            ends = np.cumsum(freq)
            starts, total = ends - freq, int(ends[-1])
            find = np.repeat(np.arange(letters, dtype=np.int32), freq) if rows is None else None
            level = np.searchsorted(total >> np.arange(LEVELS - 1, 0, -1), freq, side="right")
        slot = ((prev * 0x9E3779B1 + before * 0x85EBCA6B) & 0xFFFFFFFF) >> (32 - bits)
        e2, e1 = order2[slot], order1[prev]
        f2, f1 = e2 & top, e1 & top
        lead = np.where(f2 > 0, e2, e1) >> CONF_BITS
        state = ((f2 << CONF_BITS | f1) << 1 | (lead == e1 >> CONF_BITS)) * LEVELS + level[lead]
        now, hit = coder.code(mixer.flat[state], total, starts, freq, find, lead, out[step])
        mixer.new.append(state + mixer.flat.size * hit)
        missed.append((now, hit))
        for table, at, e, f in ((order2, slot, e2, f2), (order1, prev, e1, f1)):
            table[at] = np.where(e >> CONF_BITS == now, e + (f < top), np.where(f <= 1, now << CONF_BITS | 1, e - 2))
        before, prev = prev, now.astype(np.int64) + 1
        if rows is None:
            out[step] = now
    return out


def encode_block(ids: np.ndarray, documents: bytes = b"") -> bytes:
    """One block: the ids (any unsigned 32-bit values) and the caller's table of documents."""
    ids = np.ascontiguousarray(ids, "<u4")
    if len(ids) and int(ids.max()) < 1 << 20:
        present = np.zeros(int(ids.max()) + 1, bool)
        present[ids] = True
        letters = np.flatnonzero(present)
        dense = (np.cumsum(present) - 1)[ids]
    else:
        letters, dense = np.unique(ids, return_inverse=True)
    lanes = max(1, min(MAX_LANES, -(-len(ids) // STEPS)))
    steps = -(-len(ids) // lanes)
    counts, words = np.zeros(0, "<u4"), np.zeros(0, "<u2")
    if steps:
        padded = np.concatenate([dense, np.full(lanes * steps - len(ids), dense[-1])]).astype(np.int32)
        coder = _Writer(lanes, steps)
        _run(coder, len(letters), lanes, steps, np.ascontiguousarray(padded.reshape(lanes, steps).T))
        counts, words = coder.words()
    parts = [zlib.compress(np.diff(letters.astype(np.int64), prepend=0).astype("<u4").tobytes()),
             zlib.compress(counts.astype("<u4").tobytes()), zlib.compress(documents), words.tobytes()]
    head = HEAD.pack(MAGIC, len(ids), lanes, steps, len(letters), *map(len, parts), zlib.crc32(ids.tobytes()))
    body = head + b"".join(parts)
    return body + struct.pack("<I", zlib.crc32(body))


def decode_block(block: bytes) -> tuple[np.ndarray, bytes]:
    """The ids (little-endian 32-bit) and the table of documents of one block."""
    if len(block) < HEAD.size + 4 or zlib.crc32(block[:-4]) != struct.unpack("<I", block[-4:])[0]:
        raise ValueError("damaged block: checksum of the bytes differs")
    magic, n, lanes, steps, letters, *sizes, crc = HEAD.unpack_from(block)
    if magic != MAGIC:
        raise ValueError("not a block of token ids")
    ends = np.cumsum([HEAD.size, *sizes]).tolist()
    alphabet, counts, documents, words = (block[a:b] for a, b in zip(ends, ends[1:]))
    alphabet = np.cumsum(np.frombuffer(zlib.decompress(alphabet), "<u4").astype(np.int64)).astype("<u4")
    ids = np.zeros(0, "<u4")
    if steps:
        coder = _Reader(np.frombuffer(zlib.decompress(counts), "<u4").astype(np.int64), np.frombuffer(words, "<u2"))
        ids = alphabet[_run(coder, letters, lanes, steps, None).T.reshape(-1)[:n]]
    if zlib.crc32(ids.tobytes()) != crc:
        raise ValueError("damaged block: checksum of the ids differs")
    return ids, zlib.decompress(documents)
