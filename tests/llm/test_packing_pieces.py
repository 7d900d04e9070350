import zlib

import numpy as np
from tokenizers import Tokenizer

from feedlake.llm import packing, pieces, queries, words
from feedlake.llm.common import tokenizer_path
from tests.llm.conftest import EDGE, SF

BPE = tokenizer_path("word_bpe_49k.json")
PIECES = tokenizer_path("piece_bpe_32k.model")


def check_pieces(found, texts):
    """Every id lies in one piece, pieces hold the right ids, sequences are gapless and hardly padded."""
    tok = Tokenizer.from_file(BPE)
    tok.encode_special_tokens = True
    want = sorted((i is None, i or 0, [*tok.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in texts)
    by_doc = {}
    for r in found:
        by_doc.setdefault((r.doc_id is None, r.doc_id or 0, r.doc_tokens), []).append(r)
    used = 0
    for none, i, ids in want:
        raw = np.array(ids, "<u4").tobytes()
        at = 0
        while at < len(ids):
            spots = by_doc[none, i, len(ids)]
            hit = next(r for r in spots if r.start == at and zlib.crc32(raw[4 * at:4 * (at + r.length)]) == r.ids_crc32)
            spots.remove(hit)
            at += hit.length
            used += 1
        assert at == len(ids)
    assert used == len(found)
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048 and end & (end - 1) == 0


def test_packing_whole_table(spark, rows):
    found = queries.QUERIES["op9_packing"](spark, SF).collect()
    check_pieces(found, rows)


def test_packing_many_lanes_and_edges(edge, empty):
    found = packing.pack_documents(edge, BPE, lane_tokens=500, with_ids=True).collect()
    check_pieces(found, [(i, t) for i, t, _, _ in EDGE])
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in found)
    assert packing.pack_documents(empty, BPE).count() == 0


def test_windows_keep_the_mixture():
    avail, share = np.array([60_000, 30_000, 10_000]), np.array([0.6, 0.3, 0.1])
    taken = packing.fill_windows(avail, share, np.zeros(3), 2048)
    assert (taken.sum(0) == avail).all()
    full = taken[taken.sum(1) == 2048]
    drift = np.abs(np.cumsum(full, 0) - np.outer(np.arange(1, len(full) + 1) * 2048, share))
    assert drift.max() <= 2048
    late = packing.fill_windows(avail, share, np.array([0.0, 0.0, 2000.0]), 2048)
    assert late[0, 2] > taken[0, 2]  # a deficit carried in is served first


def test_word_encoder_equals_the_tokenizer(rows):
    import pyarrow as pa

    enc = words.WordEncoder(BPE, table_bits=6)  # emptied again and again
    texts = ["Ünï ÀÉ ß straße, it's I'M x_1 a\x1cb ª º İst ΣΑΣ ́a ﬁ 漢字 3.14 <|endoftext|> ×÷ µ don't . ,,. !?x", None, "", " a\x0bb\x0c\n",
             "ÀÈ, ÄÖ;: ŸY ÿ! K̊ A\u030a. I\u0307, " + "x" * 200 + "., " + "Ab" * 40 + "?!", "a\x00b \x00 .\x00, \u212a \xa0 \u3000 x\xa0y"]
    texts += [t for _, t in rows[:60]]
    for part in (texts, texts[:3], [None], []):
        got = enc.encode(pa.array(part, pa.string()))
        for t, raw in zip(part, got, strict=True):
            assert np.frombuffer(raw, enc.width).tolist() == enc.tok.encode(t or "", add_special_tokens=False).ids
    text = " ".join(t for t in texts if t)
    assert np.frombuffer(enc.encode_long(text, 50), enc.width).tolist() == enc.tok.encode(text, add_special_tokens=False).ids
    for at, n, ids in words.encode_batch(enc, pa.array(texts)):
        assert len(ids) == n


def brute_score(m, text):
    s = " " + text
    seen = s.replace(pieces.SPACE, pieces.BLANK).replace(" ", pieces.SPACE)
    best = [0.0] + [-1e18] * len(s)
    for end in range(1, len(s) + 1):
        for begin in range(max(0, end - 48), end):
            if hit := m.pieces.get(seen[begin:end]):
                best[end] = max(best[end], best[begin] + hit[1])
        best[end] = max(best[end], best[end - 1] + m.byte_score * len(s[end - 1].encode()))
    return best[-1] if text else 0.0


def test_pieces_best_score_and_round_trip(spark, rows):
    m = pieces.PieceModel(PIECES, cache_bytes=20_000)
    tricky = ["  a  b\n\n c▁d ▁ 漢字 😀￿ x", "\n", "   ", "é▁", "\t\t", "漢x" * 4000, "ab" * 4000, "<s> </s> <0x0A>", "", "▁"]
    for t in [t[:700] for _, t in rows[:25]] + tricky:
        ids = np.frombuffer(m.encode(t), "i4")
        ends = np.array([len(ids)])
        assert m.decode(ids, ends) == [t]
        assert abs(m.score(ids, ends)[0] - brute_score(m, t)) < 1e-6
    for r in queries.QUERIES["op10_pieces"](spark, SF).collect():
        assert r.text_sha256 == r.decoded_sha256


def test_pieces_edges(edge, empty):
    encoded = pieces.encode_pieces(edge, PIECES)
    out = pieces.decode_pieces(encoded, PIECES).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.decoded) for r in out) == \
        sorted((i is None, i or 0, t or "") for i, t, _, _ in EDGE)
    assert pieces.decode_pieces(pieces.encode_pieces(empty, PIECES), PIECES).count() == 0
