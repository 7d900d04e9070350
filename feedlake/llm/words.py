"""Ids of whole texts by a public tokenizer that drops white space and never merges across it.

A text's ids are its words' ids in a row, so each distinct word of a batch is looked up once.
Arrow splits the texts, lower-cases ASCII letters and takes punctuation off word ends; what
is left is dictionary-encoded, and the dictionaries' ids come from a table of fixed size in
flat arrays (two 64-bit hashes a word), filled by the tokenizer itself. A word made of
Latin letters, and the punctuation behind it, are tokenised apart, which gives the same ids;
any other word is tokenised whole. No Python object is kept for a word.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from feedlake.llm.common import quiet_threads, worker_state

MARKS = ".,;:!?"
TABLE_BITS = 21
MAX_WORD = 64
SLICE_BYTES = 1 << 20
#: The byte-level alphabet by its rule: printable Latin-1 stands for itself, other bytes follow from U+0100 on.
_PLAIN = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_LETTERS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PLAIN)}
_RANDOM = np.random.default_rng(20).integers(0, 1 << 64, (2, MAX_WORD), np.uint64) | np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SPACE = re.compile(r"[\x20\x09-\x0D]")


def _buffers(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0) and bytes of a string array without nulls."""
    _, offsets, data = strings.buffers()
    offsets = np.frombuffer(offsets, "<i4")[strings.offset:strings.offset + len(strings) + 1].astype(np.int64) if len(strings) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], raw[offsets[0]:offsets[-1]]


def _within(lengths: np.ndarray) -> np.ndarray:
    """0, 1, … within each of consecutive stretches."""
    ends = np.cumsum(lengths)
    return np.arange(int(lengths.sum())) - np.repeat(ends - lengths, lengths)


def _spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, … of each of consecutive stretches."""
    out = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    out += np.arange(len(out))
    return out


class WordTable:
    """Hash table from a word's 128-bit hash to its ids, in flat arrays; emptied when half full."""

    def __init__(self, width: str, bits: int):
        self.width, self.bits = width, bits
        self.clear()

    def clear(self) -> None:
        size = 1 << self.bits
        self.key, self.check = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
        self.start, self.n = np.zeros(size, np.int32), np.zeros(size, np.int32)
        self.ids, self.used, self.words = np.zeros(1 << 16, self.width), 0, 0

    def find(self, key: np.ndarray, check: np.ndarray) -> np.ndarray:
        """Slot of each word, -1 if the table lacks it."""
        mask = len(self.key) - 1
        out, left, at = np.full(len(key), -1, np.int64), np.arange(len(key)), (key & np.uint64(mask)).astype(np.int64)
        while len(left):
            held = self.key[at]
            same = (held == key[left]) & (self.check[at] == check[left])
            out[left[same]] = at[same]
            on = ~same & (held != 0)
            left, at = left[on], (at[on] + 1) & mask
        return out

    def add(self, key: np.ndarray, check: np.ndarray, ids: list[bytes]) -> None:
        """Put words that the table lacks, each once; more than it has room for are left out."""
        room = len(self.key) // 2
        if self.words + len(key) > room:
            self.clear()
            key, check, ids = key[:room], check[:room], ids[:room]
        flat = np.frombuffer(b"".join(ids), self.width)
        n = np.fromiter(map(len, ids), np.int64, len(ids)) // flat.itemsize
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(len(self.ids), self.width)])
        self.ids[self.used:self.used + len(flat)] = flat
        start = self.used + np.cumsum(n) - n
        self.used, self.words = self.used + len(flat), self.words + len(key)
        mask = len(self.key) - 1
        left, at = np.arange(len(key)), (key & np.uint64(mask)).astype(np.int64)
        while len(left):
            free = self.key[at] == 0
            _, first = np.unique(at, return_index=True)
            won = np.zeros(len(left), bool)
            won[first] = True
            won &= free
            w, spot = left[won], at[won]
            self.key[spot], self.check[spot], self.start[spot], self.n[spot] = key[w], check[w], start[w], n[w]
            left, at = left[~won], at[~won]
            at = np.where(self.key[at] == 0, at, (at + 1) & mask)


class WordEncoder:
    def __init__(self, path: str, table_bits: int = TABLE_BITS):
        quiet_threads()
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        self.model = self.tok.model
        self.width = "<u2" if self.tok.get_vocab_size() <= 65536 else "<u4"
        self.kind = "H" if self.width == "<u2" else "I"
        self.table = WordTable(self.width, table_bits)

    def _letters(self, words: list[str]) -> list[bytes]:
        """Words of Latin letters alone: no normal form to look for, lower case is letter by letter."""
        tokenize, out = self.model.tokenize, []
        for w in words:
            text = w if w.isascii() else w.lower().encode().decode("latin-1").translate(BYTE_LETTERS)
            out.append(array(self.kind, [t.id for t in tokenize(text)]).tobytes())
        return out

    def _whole(self, words: list[str]) -> list[bytes]:
        return [array(self.kind, e.ids).tobytes() for e in self.tok.encode_batch_fast(words, add_special_tokens=False)]

    def _ids(self, words: pa.Array, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and number of ids of each distinct word, and the ids they point into."""
        offsets, raw = _buffers(words)
        size = np.diff(offsets)
        short = (size <= MAX_WORD) & (size > 0)
        starts, ns = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        pick = np.flatnonzero(short)
        n = size[pick]
        spots = _spans(offsets[:-1][pick], n)
        value = raw[spots].astype(np.uint64) + np.uint64(1)
        place = _within(n)
        first = np.cumsum(n) - n
        kind = letters[pick].astype(np.uint64)
        key, check = (np.add.reduceat(value * row[place], first) + kind * _MIX if len(pick) else np.zeros(0, np.uint64) for row in _RANDOM)
        key = (key ^ key >> np.uint64(32)) * _MIX
        key = (key ^ key >> np.uint64(29)) | np.uint64(1)
        slot = self.table.find(key, check)
        new = np.flatnonzero(slot < 0)
        if len(new):
            found = self._tokenise(words, pick[new], letters)
            self.table.add(key[new], check[new], found)
            slot = self.table.find(key, check)
        held = slot >= 0
        starts[pick[held]], ns[pick[held]] = self.table.start[slot[held]], self.table.n[slot[held]]
        flat = self.table.ids[:self.table.used]
        # Very long words, and those that a full table had no room for, are tokenised for this batch alone.
        rest = np.concatenate([np.flatnonzero((size > MAX_WORD)), pick[~held]])
        if len(rest):
            found = self._tokenise(words, rest, letters)
            more = np.fromiter(map(len, found), np.int64, len(found)) // flat.itemsize
            starts[rest], ns[rest] = len(flat) + np.cumsum(more) - more, more
            flat = np.concatenate([flat, np.frombuffer(b"".join(found), self.width)])
        return starts, ns, flat

    def _tokenise(self, words: pa.Array, which: np.ndarray, letters: np.ndarray) -> list[bytes]:
        out: list[bytes] = [b""] * len(which)
        for flag, work in ((True, self._letters), (False, self._whole)):
            at = np.flatnonzero(letters[which] == flag)
            if len(at):
                for i, ids in zip(at.tolist(), work(words.take(pa.array(which[at])).to_pylist())):
                    out[i] = ids
        return out

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text, little-endian, ``width`` bytes each."""
        words = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
        counts = words.value_lengths().to_numpy()
        flat = words.flatten()
        if not len(flat):
            return [b""] * len(texts)
        cores = pc.ascii_rtrim(flat, MARKS)
        coded = cores.dictionary_encode()
        known, code = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        offsets, raw = _buffers(known)
        top = np.maximum.reduceat(np.concatenate([raw, [0]]), np.minimum(offsets[:-1], len(raw)))
        latin = pc.utf8_is_alpha(known).to_numpy(zero_copy_only=False) & (top <= 0xC3) & (np.diff(offsets) > 0)
        good = latin[code]
        ends, data = _buffers(flat)
        mark = np.diff(ends) - pc.binary_length(cores).to_numpy()
        mark[~good] = 0
        # Units: the core, or a word that stays whole, and the marks behind a core.
        units = (np.cumsum(latin) - 1)[code]
        parts = [known.filter(pa.array(latin))]
        kinds = [np.ones(len(parts[0]), bool)]
        if not good.all():
            whole = flat.filter(pa.array(~good)).dictionary_encode()
            units[~good] = len(parts[0]) + whole.indices.to_numpy()
            parts.append(whole.dictionary)
            kinds.append(np.zeros(len(whole.dictionary), bool))
        marked = np.flatnonzero(mark)
        each = 1 + (mark > 0)
        place = np.cumsum(each) - each
        seq = np.zeros(int(each.sum()), np.int64)
        seq[place] = units
        if len(marked):
            n = mark[marked]
            spots = _spans(ends[1:][marked] - n, n)
            bounds = np.concatenate([[0], np.cumsum(n)]).astype("<i4")
            tails = pa.StringArray.from_buffers(len(marked), pa.py_buffer(bounds.tobytes()), pa.py_buffer(data[spots].tobytes())) \
                .dictionary_encode()
            seq[place[marked] + 1] = sum(map(len, parts)) + tails.indices.to_numpy()
            parts.append(tails.dictionary)
            kinds.append(np.zeros(len(tails.dictionary), bool))
        starts, ns, ids = self._ids(pa.concat_arrays(parts), np.concatenate(kinds))
        n = ns[seq]
        to = np.cumsum(n)
        out = ids.take(_spans(starts[seq], n)).tobytes()
        per_word = to[place + each - 1]
        last = np.concatenate([[0], per_word])[np.cumsum(counts)] * np.dtype(self.width).itemsize
        return [out[a:b] for a, b in zip([0, *last.tolist()], last.tolist())]

    def encode_long(self, text: str, piece: int = SLICE_BYTES) -> bytes:
        """The ids of a very long text, a few million characters at a time, cut at white space."""
        out, at = [], 0
        while at < len(text):
            cut = _SPACE.search(text, at + piece)
            to = cut.start() if cut else len(text)
            out += self.encode(pa.array([text[at:to]]))
            at = to
        return b"".join(out)


def encoder(path: str) -> WordEncoder:
    return worker_state(("words", path), lambda: WordEncoder(path))


def encode_batch(enc: WordEncoder, texts: pa.Array):
    """(start, length, ids of each) for consecutive stretches of rows of about ``SLICE_BYTES`` bytes."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy().tolist()
    at = 0
    while at < len(sizes):
        to, total = at + 1, sizes[at]
        while to < len(sizes) and total + sizes[to] <= SLICE_BYTES:
            total += sizes[to]
            to += 1
        yield at, to - at, enc.encode(texts.slice(at, to - at)) if total <= 2 * SLICE_BYTES else [enc.encode_long(texts[at].as_py())]
        at = to
