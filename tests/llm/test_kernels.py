"""Kernels of op1_lm, op9_packing and op11_tokens: same results from less work a token."""

import zlib

import numpy as np
import pyarrow as pa

from feedlake.llm import hmm, rangecoder, words
from feedlake.llm.common import ascii_words


def _model(symbols: int, states: int = 4) -> hmm.Hmm:
    rng = np.random.default_rng(3)
    b = rng.gamma(0.3, 1.0, (symbols, states)) + 1e-12
    return hmm.Hmm(np.full(states, 1 / states), rng.dirichlet(np.ones(states), states), b / b.sum(0))


def _plain(model: hmm.Hmm, sym: np.ndarray):
    """Forward-backward of one sequence, scaled at every step: log likelihood, state counts by symbol, transitions."""
    alpha, scale, x = [], [], model.pi
    for o in sym:
        y = x * model.b[o]
        scale.append(y.sum())
        alpha.append(y / scale[-1])
        x = alpha[-1] @ model.a
    beta, gamma, a = np.ones(len(model.pi)), np.zeros_like(model.b), np.zeros_like(model.a)
    for t in range(len(sym) - 1, -1, -1):
        gamma[sym[t]] += alpha[t] * beta
        follow = model.b[sym[t]] * beta / scale[t]
        if t:
            a += np.outer(alpha[t - 1], follow) * model.a
        beta = model.a @ follow
    return np.log(scale).sum(), gamma, a


def test_recursions_scaled_at_few_steps_equal_plain_ones():
    model, rng = _model(30), np.random.default_rng(5)
    lengths = np.array([1, 7, 8, 9, 16, 17, 40, 8, 1, 200])
    flat = rng.integers(0, 30, int(lengths.sum())).astype("<u2")
    starts = np.cumsum(lengths) - lengths
    found = [_plain(model, flat[s:s + n]) for s, n in zip(starts, lengths)]
    np.testing.assert_allclose(model.forward(flat, starts, lengths), [x[0] for x in found], rtol=1e-12)
    counts = hmm.Counts.zeros(30, 4)
    for _ in range(2):  # the second group works in the memory of the first
        model.expect(flat, starts, lengths, counts)
    np.testing.assert_allclose(counts.loglik, 2 * sum(x[0] for x in found), rtol=1e-12)
    np.testing.assert_allclose(counts.b, 2 * sum(x[1] for x in found), rtol=1e-9)
    np.testing.assert_allclose(counts.a, 2 * sum(x[2] for x in found), rtol=1e-9)
    assert counts.rows(0, 5).base is counts.rows(0, 9).base


def test_scaling_of_very_rare_words_does_not_underflow():
    model = _model(30)
    model.b = model.b * 1e-23
    lengths = np.array([50, 49])
    flat = np.arange(99).astype("<u2") % 30
    got = model.forward(flat, np.array([0, 50]), lengths)
    np.testing.assert_allclose(got, [_plain(model, flat[:50])[0], _plain(model, flat[50:])[0]], rtol=1e-12)
    counts = hmm.Counts.zeros(30, 4)
    model.expect(flat, np.array([0, 50]), lengths, counts)
    np.testing.assert_allclose(counts.b.sum(), 99, rtol=1e-9)


def test_coded_words_are_the_plain_words():
    texts = ["b  A\tb ", None, "", " \n", "x Y\x0bé İ", "b", "\x1f z\r\n"]
    for held in (texts, ["", None], []):
        lengths, codes, known = hmm.coded_words(pa.array(held, pa.string()))
        ends = np.cumsum(lengths)
        assert [[known[c] for c in codes[e - n:e]] for e, n in zip(ends, lengths)] == [ascii_words(t) for t in held]
    lengths, codes, known = hmm.coded_words(pa.array(texts, pa.string()).slice(4, 2))
    assert lengths.tolist() == [3, 1] and [known[c] for c in codes] == [*ascii_words(texts[4]), b"b"]


def test_spans_follow_each_other():
    assert words._spans(np.array([5, 0, 9]), np.array([2, 0, 3])).tolist() == [5, 6, 9, 10, 11]
    assert words._spans(np.zeros(0, np.int64), np.zeros(0, np.int64)).tolist() == []


def test_lanes_write_side_by_side_and_the_format_stays():
    assert rangecoder._Writer(4, 8).at.tolist() == [0, 1, 2, 3]
    rng = np.random.default_rng(11)
    for n, size in ((0, 10), (1, 10), (5_000, 3), (70_000, 40_000)):
        ids = np.minimum(rng.zipf(1.3, n), size).astype("<u4")
        block = rangecoder.encode_block(ids, b"table")
        back, table = rangecoder.decode_block(block)
        assert (back == ids).all() and table == b"table"
        assert (zlib.crc32(block[:-4]), len(block)) == BLOCKS[n]


#: Checksum and size of the blocks as the first writer of this format made them.
BLOCKS = {0: (772973662, 73), 1: (2249844609, 83), 5000: (3863310421, 1134), 70000: (3203071495, 63501)}
