import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedlake.llm import hmm, langid, quality, queries
from feedlake.llm.common import id_bucket
from tests.llm.conftest import EDGE, SF


def words_of(text):
    return [*(text or "").encode().lower().split(), b""]


def brute_base(texts, held):
    c = Counter()
    for (_, t), h in zip(texts, held):
        if not h:
            c.update(words_of(t))
    n, v = sum(c.values()), len(c)
    return [(len(words_of(t)), sum(c[w] > 0 for w in words_of(t)), n,
             sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words_of(t))) for _, t in texts]


def close(found, texts, held):
    want = sorted(((i is None, i or 0, h, *b) for (i, _), h, b in zip(texts, held, brute_base(texts, held))))
    got = sorted((r.doc_id is None, r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found)
    assert [g[:6] for g in got] == [w[:6] for w in want]
    assert np.allclose([g[6] for g in got], [w[6] for w in want], rtol=1e-9)


def test_lm_whole_table(spark, rows):
    found = queries.QUERIES["op1_lm"](spark, SF).collect()
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    close(found, rows, held)
    assert sum(r.score for r in found if r.held_out) > sum(r.base_score for r in found if r.held_out)


def test_lm_small_dictionary_and_edges(edge, empty):
    """Words beyond the dictionary come from the join; sums stay the same."""
    texts = [(i, t) for i, t, _, _ in EDGE]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in texts]
    for dictionary in (3, 100_000):
        found = hmm.score_documents(edge, id_bucket("doc_id", 7) == 2, states=3, head=5, dictionary=dictionary, passes=1).collect()
        close(found, texts, held)
    assert hmm.score_documents(empty, F.lit(False)).count() == 0
    alone = hmm.score_documents(edge, F.lit(True), states=2, passes=1).collect()
    assert all(r.train_tokens == 0 and r.base_score == 0 and r.score < 0 for r in alone)


def test_forward_equals_the_plain_recursion_and_sums_to_one():
    rng = np.random.default_rng(1)
    model = hmm.Hmm(rng.dirichlet(np.ones(3)), rng.dirichlet(np.ones(3), 3), rng.dirichlet(np.ones(4), 3).T.copy())

    def plain(s):
        a = model.pi * model.b[s[0]]
        for o in s[1:]:
            a = (a @ model.a) * model.b[o]
        return math.log(a.sum())
    seqs = [rng.integers(0, 4, n) for n in (1, 400, 7, 2, 7, 33)]
    size = np.array([len(s) for s in seqs])
    got = model.forward(np.concatenate(seqs), np.cumsum(size) - size, size)
    assert np.allclose(got, [plain(s) for s in seqs])
    total = 0.0  # texts end with symbol 0: all texts of up to 60 tokens hold nearly all probability
    alpha = model.pi
    for _ in range(60):
        total += (alpha * model.b[0]).sum()
        alpha = (alpha * (1 - model.b[0])) @ model.a
    assert 0.99 < total <= 1.0 + 1e-9


def test_baum_welch_counts_and_likelihood():
    rng = np.random.default_rng(2)
    model = hmm.Hmm(rng.dirichlet(np.ones(2)), rng.dirichlet(np.ones(2), 2), rng.dirichlet(np.ones(3), 2).T.copy())
    seqs = [rng.integers(0, 3, n) for n in (3, 5, 4)]
    size = np.array([len(s) for s in seqs])
    flat, starts = np.concatenate(seqs), np.cumsum(size) - size
    counts = hmm.Counts.zeros(3, 2)
    model.expect(flat, starts, size, counts)
    want = np.zeros((3, 2))
    for s in seqs:  # posterior of every path
        paths = {}
        for code in range(2 ** len(s)):
            z = [code >> k & 1 for k in range(len(s))]
            p = model.pi[z[0]] * model.b[s[0], z[0]]
            for k in range(1, len(s)):
                p *= model.a[z[k - 1], z[k]] * model.b[s[k], z[k]]
            paths[tuple(z)] = p
        total = sum(paths.values())
        for z, p in paths.items():
            for o, k in zip(s, z):
                want[o, k] += p / total
    assert np.allclose(counts.b, want) and math.isclose(counts.a.sum(), (size - 1).sum())
    long = hmm.Counts.zeros(3, 2)
    for q in seqs:  # the blockwise form of very long sequences: the same counts
        model.expect_long(q, long, block=2)
    assert np.allclose(long.b, want) and np.allclose(long.a, counts.a) and np.allclose(long.pi, counts.pi)
    assert math.isclose(long.loglik, counts.loglik)
    before = counts.loglik
    for _ in range(5):
        model = counts.model(np.full(3, 1 / 3), kappa=0.0)
        counts = hmm.Counts.zeros(3, 2)
        model.expect(flat, starts, size, counts)
    assert counts.loglik > before - 0.5


def test_langid_held_out_accuracy(spark, small):
    found = queries.QUERIES["op7_langid"](spark, SF).join(small.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert len(found) == small.count() and len(held) > 20
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.9
    assert all(0 <= r.score <= 1 for r in found)


def test_langid_edges(edge, empty):
    model = langid.train(edge, F.lit(True))
    assert model.langs == ["de", "en", "fr"]
    found = langid.predict(edge, model).collect()
    assert len(found) == len(EDGE)
    for r in langid.predict(edge, model, keep=["doc_id", "text"]).collect():
        lettered = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not lettered) and (lettered or r.score == 0.0)
    nothing = langid.train(empty, F.lit(True))
    assert nothing.langs == [] and {r.lang_pred for r in langid.predict(edge, nothing).collect()} == {"und"}
    assert langid.predict(empty, model).count() == 0


def test_ngrams_do_not_depend_on_chunks(monkeypatch):
    text = "Ein Äpfel-Baum 漢字 and some 12 words! " * 20
    whole = langid.ngram_counts(text)
    monkeypatch.setattr(langid, "CHUNK", 7)
    parts = langid.ngram_counts(text)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()


def test_ftrl_is_sparse_and_calibrated():
    rng = np.random.default_rng(4)
    rows = []
    for i in range(200):
        y = i % 2
        at = np.unique(rng.integers(0, 50, 8) + 50 * (y if rng.random() < 0.9 else 1 - y))
        rows.append((y, at, np.full(len(at), 1 / math.sqrt(len(at)))))
    model = langid.fit(["a", "b"], np.ones(200), rows)
    assert (model.w[100:] == 0).all() and 0.05 <= model.temperature <= 5
    hits = sum(int(np.argmax(model.logits(at, x))) == y for y, at, x in rows)
    assert hits > 160


def brute_repeat(words, size=8):
    windows = Counter(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    inside = set()
    for i in range(len(words) - size + 1):
        if windows[tuple(words[i:i + size])] > 1:
            inside |= set(range(i, i + size))
    return len(inside)


@pytest.mark.parametrize("seed", range(6))
def test_repeated_words(seed):
    rng = np.random.default_rng(seed)
    words = [bytes([97 + x]) for x in rng.integers(0, 2, 60)] + [b"z"] * (9 * (seed % 2))
    assert quality.repeated_words(words) == brute_repeat(words)


def test_quality_rules_by_line():
    fails = quality.line_fails
    assert fails(b"A plain sentence, with 5% of marks & words.") is None
    assert fails(b"one### two$$$ three&&& four") == "punctuation" and fails(b"HEY!! YOU!! THERE!!") == "punctuation"
    assert fails(b"home | about | news | shop") == "navigation" and fails(b"ALL OF THIS IS LOUD") == "shouting"
    assert fails(b"go " * 12) == "repetition" and fails(b"All rights reserved 2020") == "boilerplate"
    body = " ".join(f"word{i}" for i in range(30))
    found = quality.clean(body + "\nhome | about | news | shop")
    assert found["kept"] and found["text"] == body and found["n_lines_removed"] == 1
    assert not quality.clean(body + "\n" + " | ".join(f"w{i}" for i in range(60)))["kept"]  # loses too much


def test_quality_edges(edge, empty):
    found = quality.quality_rules(edge).collect()
    assert len(found) == len(EDGE)
    assert all(r.base_failed and not r.kept for r in found if r.n_words == 0)
    assert quality.quality_rules(empty).count() == 0
