import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from feedlake.llm import idfiles, queries
from feedlake.llm.common import shared_dir, tokenizer_path
from feedlake.llm.rangecoder import decode_block, encode_block
from tests.llm.conftest import EDGE, SF

BPE = tokenizer_path("word_bpe_49k.json")


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 6), max_size=700), st.binary(max_size=20))
def test_block_round_trip(ids, table):
    ids = np.array(ids, "<u4")
    back, documents = decode_block(encode_block(ids, table))
    assert back.tolist() == ids.tolist() and documents == table


def test_block_learns_contexts_and_long_runs():
    rng = np.random.default_rng(3)
    phrase = rng.integers(0, 40_000, 50)
    ids = np.concatenate([np.where(rng.random(50) < 0.02, 7, phrase) for _ in range(4000)]).astype("<u4")
    coded = encode_block(ids)
    assert decode_block(coded)[0].tolist() == ids.tolist()
    assert 8 * len(coded) / len(ids) < 1.5  # order 0 alone needs about 5.6 bits
    flat = np.full(300_000, 5, "<u4")
    assert len(encode_block(flat)) < 6000 and (decode_block(encode_block(flat))[0] == flat).all()


def test_damage_is_found():
    coded = bytearray(encode_block(np.arange(3000, dtype="<u4") % 17))
    for at in (0, 9, len(coded) // 2, len(coded) - 1):
        bad = bytearray(coded)
        bad[at] ^= 4
        with pytest.raises(ValueError):
            decode_block(bytes(bad))
    with pytest.raises(ValueError):
        decode_block(bytes(coded[:-9]))


def test_joined_checksums():
    a, b, c = b"some bytes", b"", b"x" * 1000
    assert idfiles.join_crcs([(len(p), zlib.crc32(p)) for p in (a, b, c)]) == zlib.crc32(a + b + c)


def expected(texts):
    tok = Tokenizer.from_file(BPE)
    tok.encode_special_tokens = True
    return [(i, [*tok.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in texts]


def digest(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_tokens_whole_table(spark, rows):
    found = queries.QUERIES["op11_tokens"](spark, SF).orderBy("start").collect()
    at = 0
    for r, (i, ids) in zip(found, sorted(expected(rows)), strict=True):
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, at, len(ids), digest(ids))
        at += len(ids)


@pytest.mark.parametrize("block_ids,task_ids", [(64, 500), (10_000, 1_000_000)])
def test_files_edges_and_documents_over_many_blocks(spark, edge, empty, block_ids, task_ids):
    folder = idfiles.write_ids(edge, BPE, shared_dir(spark, "t-ids"), block_ids=block_ids, task_ids=task_ids)
    want = sorted((i is not None, i or 0, len(ids), digest(ids)) for i, ids in expected([(i, t) for i, t, _, _ in EDGE]))
    digests = idfiles.read_digests(spark, folder).orderBy("start").collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in digests) == want
    whole = idfiles.read_ids(spark, folder).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in digests] == \
        [(r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in whole]
    at = 0
    for r in digests:
        assert r.start == at
        at += r.n_tokens
    ids = [(r.doc_id is not None, r.doc_id or 0) for r in digests]
    assert ids == sorted(ids)
    none = idfiles.write_ids(empty, BPE, shared_dir(spark, "t-none"))
    assert idfiles.read_digests(spark, none).count() == 0


def test_many_rows_without_id_or_of_one_id(spark):
    rows = [(None, f"text {i}") for i in range(5000)] + [(7, f"word {i}") for i in range(5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    folder = idfiles.write_ids(docs, BPE, shared_dir(spark, "t-hot"), block_ids=4000, task_ids=4000)
    tasks = spark.read.parquet(folder).groupBy("part").sum("n_ids").collect()
    assert len(tasks) > 4 and max(r[1] for r in tasks) < 4 * 4000
    found = idfiles.read_digests(spark, folder).orderBy("start").collect()
    assert [r.doc_id for r in found] == [None] * 5000 + [7] * 5000
    assert sorted(r.ids_crc32 for r in found) == sorted(digest(ids) for _, ids in expected(rows))
