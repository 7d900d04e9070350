import corpus_pipeline as cp
import hashlib

from feedlake.llm.common import written
from tests.llm.conftest import EDGE, SF
from tests.llm.test_dedup import brute_lines, brute_links
from tests.llm.test_packing_pieces import check_pieces


def test_stages_take_effect(spark, small):
    docs, stages = small, dict(cp.STAGES)
    before = {r.doc_id: r for r in docs.collect()}
    docs = written(stages["language_id"](spark, docs, SF), "t")
    assert docs.columns == small.columns
    one = sorted(((r.doc_id, r.text) for r in docs.collect()))
    assert all(any(c.isalpha() for c in t) for _, t in one) and len(one) >= 0.98 * len(before)
    docs = written(stages["line_dedup"](spark, docs, SF), "t")
    want = brute_lines(one)
    two = {r.doc_id: r.text for r in docs.collect()}
    assert two == {i: want[k][2] for k, (i, _) in enumerate(one) if not (want[k][1] and not want[k][2].split())}
    docs = written(stages["near_duplicates"](spark, docs, SF), "t")
    ids = sorted(two)
    sets, root = brute_links([two[i] for i in ids], 5, 80)
    low = {}
    for i, r in zip(ids, root):
        low.setdefault(r, i)
    three = {r.doc_id: r.text for r in docs.collect()}
    assert three == {i: two[i] for i, s, r in zip(ids, sets, root) if not s or low[r] == i}
    docs = written(stages["secret_scan"](spark, docs, SF), "t")
    four = {r.doc_id: r for r in docs.collect()}
    assert set(four) == set(three) and all(r.n_chars == len(r.text) for r in four.values())
    assert not any("AKIA" + "A" * 12 in r.text for r in four.values())
    pieces = stages["packing"](spark, docs, SF).collect()
    check_pieces(pieces, [(i, r.text) for i, r in four.items()])


def test_stages_on_edge_rows(spark, edge, empty):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    for docs in (edge.select(columns), empty.select(columns)):
        for _, stage in cp.STAGES[:-1]:
            docs = written(stage(spark, docs, SF), "t")
            assert docs.columns == columns
        assert cp.STAGES[-1][1](spark, docs, SF).count() >= docs.count()


def test_near_duplicates_keep_one_of_each_group(spark, edge):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    kept = cp.near_duplicates(spark, edge.select(columns), SF).collect()
    digests = [hashlib.sha256((r.text or "").lower().encode()).hexdigest() for r in kept if (r.text or "").split()]
    assert len(digests) == len(set(digests)) and {r.doc_id for r in kept} >= {4, 6, 9, 12} and 7 not in {r.doc_id for r in kept}
    assert len(kept) < len(EDGE)
