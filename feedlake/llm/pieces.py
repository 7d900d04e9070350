"""SentencePiece encoding and decoding: Aho-Corasick over pieces, single-pass Viterbi.

One automaton holds all ordinary pieces of the model. It reads a text once; at each
position it reports, over its output links, every piece that ends there, and each of
them relaxes the best score of that position: ``best[end] = max(best[start] + score)``.
Characters that no piece covers fall back to their UTF-8 byte pieces at a penalty.
Equal scores keep the longest last piece.

No piece of the model goes on over a space after another character or holds a line
feed (checked when the model is loaded), so the best segmentation of a text is that of
its chunks (spaces plus the word after them) in a row, and chunks are cached. A text gets one
space in front, as the model asks for; decoding drops it. Decoding the ids gives back
the text exactly, a literal U+2581 included (it goes through byte pieces).

Defined cases: null and empty texts have no ids, score 0 and decode to the empty text;
repeated rows are encoded each on their own; other columns are ignored.
"""

from __future__ import annotations

import re
from array import array
from math import inf

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import ByteCache, documents, map_arrow, tokenizer_path, worker_state

SPACE = "▁"
BLANK = "￿"  # stands for a literal U+2581 inside the automaton: in no piece
CACHE_BYTES = 96 << 20
LONG_CHUNK = 4096


class PieceModel:
    """The pieces of a model; the automaton is built only where texts are encoded."""

    def __init__(self, path: str, cache_bytes: int = CACHE_BYTES, encodes: bool = True):
        import ahocorasick
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        self.automaton = ahocorasick.Automaton()
        raw: list[bytes] = []
        self.byte_id: dict[int, int] = {}
        self.pieces: dict[str, tuple[int, float]] = {}
        self.scores = np.zeros(sp.vocab_size())
        whole = False
        for i in range(sp.vocab_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                raw.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                raw.append(b"")
            else:
                self.scores[i] = sp.get_score(i)
                self.pieces[piece] = (i, sp.get_score(i))
                if encodes:
                    self.automaton.add_word(piece, (i, len(piece), sp.get_score(i)))
                raw.append(piece.replace(SPACE, " ").encode())
                whole |= "\n" in piece or bool(re.search(f"[^{SPACE}]{SPACE}", piece))
        if encodes:
            self.automaton.make_automaton()
        self.byte_score = float(self.scores.min()) - 10.0
        self.scores[list(self.byte_id.values())] = self.byte_score
        self.sizes = [len(sp.id_to_piece(i)) for i in range(sp.vocab_size())]
        self.singles = {p for p in self.pieces if len(p) == 1}
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_size = np.array([len(r) for r in raw], np.int64)
        self.raw_at = np.cumsum(self.raw_size) - self.raw_size
        self.chunk = re.compile(r"(?s).+" if whole else r"\n| *[^ \n]+| +")
        self.cache = ByteCache(cache_bytes)

    def viterbi(self, text: str) -> list[int]:
        """Best-scoring ids of one chunk (with its spaces)."""
        seen = text.replace(SPACE, BLANK).replace(" ", SPACE)
        n = len(seen)
        # Lists are faster; a very long chunk takes 12 bytes a character in flat arrays.
        best, back = (array("d", [-inf]) * (n + 1), array("i", [-1]) * (n + 1)) if n > LONG_CHUNK else ([-inf] * (n + 1), [-1] * (n + 1))
        best[0] = 0.0
        if self.singles.issuperset(seen):  # every character is a piece: each position is reached, bytes never win
            for end, (i, size, score) in self.automaton.iter(seen):
                end += 1
                total = best[end - size] + score
                if total > best[end]:
                    best[end], back[end] = total, i
        else:
            done = 0  # positions up to here have met all pieces and the bytes of their character

            def bytes_up_to(done: int, to: int) -> int:
                while done < to:
                    c = text[done]
                    if seen[done] not in self.singles:
                        total = best[done] + self.byte_score * len(c.encode())
                        if total > best[done + 1]:
                            best[done + 1], back[done + 1] = total, -1
                    done += 1
                return done
            for end, (i, size, score) in self.automaton.iter(seen):
                done = bytes_up_to(done, end)
                total = best[end + 1 - size] + score
                if total > best[end + 1]:
                    best[end + 1], back[end + 1] = total, i
            bytes_up_to(done, n)
        ids: list[int] = []
        while n:
            i = back[n]
            if i >= 0:
                ids.append(i)
                n -= self.sizes[i]
            else:
                n -= 1
                ids += [self.byte_id[b] for b in reversed(text[n].encode())]
        return ids[::-1]

    def lookup(self, chunk: str) -> bytes:
        found = self.cache.get(chunk)
        if found is None:
            found = array("i", self.viterbi(chunk)).tobytes()
            self.cache.put(chunk, found)
        return found

    def encode(self, text: str | None) -> bytes:
        """Ids as 32-bit integers."""
        if not text:
            return b""
        chunks = self.chunk.findall(" " + text)
        found = list(map(self.cache.young.get, chunks))
        if None in found:
            found = [self.lookup(c) if f is None else f for c, f in zip(chunks, found)]
        return b"".join(found)

    def score(self, ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Summed piece scores of the stretches of ids that end at ``ends``."""
        total = np.concatenate([[0.0], np.cumsum(self.scores[ids])])[np.concatenate([[0], ends])]
        return np.diff(total)

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """Texts of the stretches of ids that end at ``ends``; bytes that are no UTF-8 become U+FFFD."""
        size = self.raw_size[ids]
        to = np.cumsum(size)
        out = self.raw[np.repeat(self.raw_at[ids] - (to - size), size) + np.arange(int(to[-1]) if len(to) else 0)].tobytes()
        cuts = np.concatenate([[0], to])[np.concatenate([[0], ends])].tolist()
        parts = [out[a:b] for a, b in zip(cuts, cuts[1:])]
        return [(p[1:] if p[:1] == b" " else p).decode("utf-8", "replace") for p in parts]


def model(path: str, encodes: bool = True) -> PieceModel:
    return worker_state(("pieces", path, encodes), lambda: PieceModel(path, encodes=encodes))


def encode_pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array of int), score, and the text's sha256."""
    def run(it):
        import hashlib
        m = model(path)
        for b in it:
            for at in range(0, len(b), 256):
                texts = b.column(1).slice(at, 256).to_pylist()
                found = [m.encode(t) for t in texts]
                ids = np.frombuffer(b"".join(found), "i4")
                ends = np.cumsum([len(x) // 4 for x in found])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, 256),
                     pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids, pa.int32())),
                     pa.array(m.score(ids, ends)), pa.array([hashlib.sha256((t or "").encode()).hexdigest() for t in texts])],
                    ["doc_id", "ids", "score", "text_sha256"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .transform(map_arrow, run, "doc_id long, ids array<int>, score double, text_sha256 string")


def decode_pieces(encoded: DataFrame, path: str) -> DataFrame:
    """The input and the texts of its ``ids`` as ``decoded``; null ids decode to the empty text."""
    keep = encoded.schema

    def run(it):
        m = model(path, encodes=False)
        for b in it:
            at = b.schema.get_field_index("ids")
            for k in range(0, len(b), 256):
                part = b.slice(k, 256)
                ids = part.column(at)
                ends = np.cumsum(ids.value_lengths().fill_null(0).to_numpy())
                texts = m.decode(ids.flatten().to_numpy(), ends)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())],
                                                 [*part.schema.names, "decoded"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep)
    return encoded.transform(map_arrow, run, f"{fields}, decoded string")


def q_pieces(spark, sf_dir):
    """Encode every whole text, decode it again; digests of ids and of the decoded text."""
    path = tokenizer_path("piece_bpe_32k.model")
    return decode_pieces(encode_pieces(documents(spark, sf_dir), path), path).select(
        "doc_id", F.size("ids").cast("long").alias("n_ids"),
        F.xxhash64("ids").alias("ids_hash"), "score", "text_sha256",
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
