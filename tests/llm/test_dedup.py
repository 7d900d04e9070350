import collections
import hashlib

import numpy as np
import pytest

from feedlake.llm import jaccard, lines, queries, suffixes
from tests.llm.conftest import EDGE, SF


def brute_repeats(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = collections.Counter(r[i:i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        edge = np.zeros(len(r) + 1, int)
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                edge[i] += 1
                edge[i + length] -= 1
        gone = np.cumsum(edge)[:len(r)] > 0
        kept = np.frombuffer(r, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(r), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def as_rows(found):
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found)


def want_rows(texts, length):
    return sorted((i is None, i or 0, *x) for (i, _), x in zip(texts, brute_repeats([t for _, t in texts], length)))


def test_suffixes_whole_table(spark, rows):
    assert as_rows(queries.QUERIES["op2_suffixes"](spark, SF).collect()) == want_rows(rows, 200)


@pytest.mark.parametrize("length,gram,hot", [(60, 16, 2000), (40, 9, 1)])
def test_suffixes_edges(edge, length, gram, hot):
    found = suffixes.remove_repeats(edge, length, gram, hot).collect()
    assert as_rows(found) == want_rows([(i, t) for i, t, _, _ in EDGE], length)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in found)


def test_suffixes_empty(empty):
    assert suffixes.remove_repeats(empty).count() == 0


def test_levels_grow_geometrically_and_find_all():
    rng = np.random.default_rng(3)
    texts = [bytes(rng.integers(0, 2, 60, np.uint8)) for _ in range(200)]
    family = suffixes.LevelFamily(12, batch_bytes=600, level_bytes=1 << 20)
    for k in range(0, 200, 10):
        family.add(texts[k:k + 10], np.arange(k, k + 10))
    sizes = [len(level.text) for level in family.levels]
    assert sizes == sorted(sizes, reverse=True) and len(sizes) <= 5
    seen = collections.Counter(t[i:i + 12] for t in texts for i in range(49))
    want = sum(seen[t[i:i + 12]] > 1 for t in texts for i in range(49))
    assert sum(len(who) for who, _ in family.hits()) == want


def test_one_fingerprint_for_different_bytes(monkeypatch):
    monkeypatch.setattr(suffixes, "gram_hashes", lambda buf, size: np.zeros(max(0, len(buf) - size + 1), np.uint64))
    family = suffixes.LevelFamily(4, batch_bytes=1)
    family.add([b"abcdabce", b"xxxxyabcd"], np.array([0, 1]))
    family.add([b"yabcq", b"zzzzz"], np.array([2, 3]))
    found = {(int(w), bytes(level.text[a:a + 4])) for level in family.levels for w, a in zip(level.owner[level.hit], level.at[level.hit])}
    assert found == {(0, b"abcd"), (1, b"abcd"), (1, b"yabc"), (2, b"yabc"), (3, b"zzzz")}


def brute_links(texts, words, percent):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        n = min(words, len(w))
        sets.append(frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if w else frozenset())
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * len(a | sets[j]):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return sets, [find(i) for i in range(len(sets))]


def want_components(texts, words, percent):
    sets, root = brute_links([t for _, t in texts], words, percent)
    low = {}
    for (i, _), s, r in zip(texts, sets, root):
        if s and i is not None:
            low[r] = min(low.get(r, i), i)
    return sorted(((i is None, i or 0, len(s), low.get(r) if s else i) for (i, _), s, r in zip(texts, sets, root)), key=str)


def got_components(found):
    return sorted(((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in found), key=str)


def test_jaccard_whole_table(spark, rows):
    assert got_components(queries.QUERIES["op4_jaccard"](spark, SF).collect()) == want_components(rows, 4, 85)


@pytest.mark.parametrize("words,percent,block", [(4, 85, 4_000_000), (2, 40, 300), (1, 20, 200)])
def test_jaccard_edges_and_chunked_blocks(edge, small, rows, words, percent, block):
    found = jaccard.jaccard_components(edge, words, percent, block_shingles=block).collect()
    assert got_components(found) == want_components([(i, t) for i, t, _, _ in EDGE], words, percent)
    if words == 2:
        some = [(i, t) for i, t in rows if i % 2]
        found = jaccard.jaccard_components(small.where("doc_id % 2 = 1"), words, percent, block_shingles=block).collect()
        assert got_components(found) == want_components(some, words, percent)


def test_jaccard_empty(empty):
    assert jaccard.jaccard_components(empty).count() == 0


def test_prefix_tree_against_all_pairs():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 62, 60, np.uint64)
    sets = [np.unique(np.concatenate([rng.choice(base, rng.integers(20, 60), replace=False),
                                      rng.integers(0, 1 << 62, rng.integers(0, 12), np.uint64)])) for _ in range(120)]
    for percent in (50, 70, 85):
        root = list(range(len(sets)))

        def find(x, root=root):
            while root[x] != x:
                x = root[x]
            return x
        for i in range(len(sets)):
            for j in range(i):
                both = len(np.intersect1d(sets[i], sets[j]))
                if (100 + percent) * both >= percent * (len(sets[i]) + len(sets[j])):
                    root[max(find(i), find(j))] = min(find(i), find(j))
        got = list(range(len(sets)))

        def seek(x, got=got):
            while got[x] != x:
                x = got[x]
            return x
        for a, b in jaccard.block_links(sets, np.full(len(sets), 2), percent):
            got[max(seek(a), seek(b))] = min(seek(a), seek(b))
        assert [find(i) for i in range(len(sets))] == [seek(i) for i in range(len(sets))]


def test_tasks_hold_two_chunks_and_every_pair_of_chunks(spark):
    chunks = {0: 3, 1: 4, 2: 1, 3: 2}
    rows = [(f"{c}.{k}", c, n, k, chunks.get(c - 1, 0), chunks.get(c + 1, 0)) for c, n in chunks.items() for k in range(n)]
    df = spark.createDataFrame(rows, "name string, cls int, chunks int, chunk int, lower int, upper int")
    tasks = collections.defaultdict(dict)
    for r in df.select("name", jaccard.F.explode(jaccard.dealt_tasks()).alias("t")).select("name", "t.*").collect():
        assert r.name not in tasks[r.cls, r.i, r.j, r.w]
        tasks[r.cls, r.i, r.j, r.w][r.name] = r.side
    assert max(map(len, tasks.values())) <= 2
    met = collections.Counter()
    for task in tasks.values():
        for a, x in task.items():
            met[a, a] += x == 2
            met.update((min(a, b), max(a, b)) for b, y in task.items() if a < b and (x, y) not in ((0, 0), (1, 1)))
    names = [(r[0], r[1]) for r in rows]
    assert all(met[a, b] == (abs(c - d) <= 1) for a, c in names for b, d in names if a <= b)


def test_prefix_tree_finds_every_link_once():
    rng = np.random.default_rng(6)
    base = rng.integers(0, 1 << 62, 60, np.uint64)
    sets = [np.unique(np.concatenate([rng.choice(base, rng.integers(40, 60), replace=False),
                                      rng.integers(0, 1 << 62, rng.integers(0, 9), np.uint64)])) for _ in range(80)]
    found = []
    jaccard.all_block_links(sets, np.full(len(sets), 2), 60, found.extend)
    want = {(i, j) for i in range(80) for j in range(i)
            if 160 * len(np.intersect1d(sets[i], sets[j])) >= 60 * (len(sets[i]) + len(sets[j]))}
    assert len(found) == len(want) > 80 and {(max(p), min(p)) for p in found} == want


@pytest.mark.parametrize("percent,block", [(50, 4_000_000), (40, 300)])
def test_jaccard_links_of_near_copies(spark, percent, block):
    rng = np.random.default_rng(7)
    base = [f"word{k}" for k in range(60)]
    texts = []
    for k in range(30):
        w = list(base)
        w[rng.integers(0, 60)] = f"other{k}"
        texts += [" ".join(w)] * (3 if k < 4 else 1)
    docs = [(None if k == 5 else k // 2 if k < 4 else k, t) for k, t in enumerate(texts + ["", None, "alone here"])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    sets, _ = brute_links([t for _, t in docs], 2, percent)

    def linked(a, b):
        return len(a & b) > 0 and 100 * len(a & b) >= percent * len(a | b)
    want = [(i, len(s), sum(k != m and linked(s, o) for m, o in enumerate(sets))) for k, ((i, _), s) in enumerate(zip(docs, sets))]
    found = jaccard.jaccard_components(df, 2, percent, block_shingles=block).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.n_links) for r in found), key=str) == sorted(want, key=str)
    assert len({r.set_id for r in found} - {None}) == len({s for s in sets if s})
    links = [tuple(r) for r in jaccard.jaccard_links(df, 2, percent, block_shingles=block).collect()]
    distinct = list({s for s in sets if s})
    assert len(links) == len(set(links)) == sum(linked(a, b) for k, a in enumerate(distinct) for b in distinct[:k]) > len(distinct)
    labels = jaccard.jaccard_components(df, 2, percent, block_shingles=block, count_links=False)
    assert labels.columns == ["doc_id", "n_shingles", "component_id"] and got_components(labels.collect()) == got_components(found)


def test_counters_never_saturate():
    counts = np.array([0, 1, 63, 64, 255, 300, 70_000, 1 << 24, 1 << 36])
    code = jaccard.counter_code(counts)
    assert code.dtype == np.uint8 and (np.diff(code.astype(int)) > 0).all()


def test_order_puts_shared_shingles_last_in_a_full_table():
    rng = np.random.default_rng(8)
    common, rare = [f"c{k}" for k in range(12)], [f"r{k}" for k in range(40_000)]
    texts = [" ".join(rng.choice(common, 40).tolist() + rng.choice(rare, 12).tolist()) for _ in range(600)]
    seen = collections.Counter(h for t in texts for h in set(jaccard.shingles(t, 3).tolist()))
    words, full = np.zeros(1 << 18, np.int64), np.zeros(1 << 8, np.int64)  # some 110 shingles a counter
    for t in texts:
        word = jaccard.word_hashes(t)
        np.add.at(words, jaccard._slots(word, len(words)), 1)
        np.add.at(full, jaccard._slots(jaccard.shingle_hashes(word, 3), len(full)), 1)
    order = jaccard.GlobalOrder(jaccard.counter_code(words), jaccard.counter_code(full))
    shared = 0
    for t in texts:
        found, ordered = order.ordered(t, 3)
        assert (found == jaccard.shingles(t, 3)).all() and (np.sort(ordered) == found).all()
        shared += sum(seen[h] > 1 for h in ordered[:8].tolist())
    assert shared < 0.02 * 8 * len(texts)


def test_signatures_never_part_a_link():
    rng = np.random.default_rng(9)
    base = rng.integers(0, 1 << 62, 3000, np.uint64)
    parted = 0
    for _ in range(400):
        n = int(rng.integers(1, 3000))
        a = np.unique(base[:n])
        b = np.unique(np.concatenate([a[rng.random(n) > rng.random() * 0.4], rng.integers(0, 1 << 62, rng.integers(1, 2 + n // 5), np.uint64)]))
        x, y = ((len(s), int.from_bytes(jaccard.signature(s), "little"), 8 * len(jaccard.signature(s))) for s in (a, b))
        for percent in (20, 50, 85):
            both = len(np.intersect1d(a, b))
            assert jaccard.may_link(x, y, percent) or 100 * both < percent * (len(a) + len(b) - both)
            parted += not jaccard.may_link(x, y, percent)
    assert parted > 100


def hand_sets(spark, texts, words, prefixes):
    """The tables of ``jaccard_sets`` for texts of distinct sets with these prefixes; the nodes by text."""
    own = [jaccard.shingles(t, words) for t in texts]
    rows = [(k + 1, len(x), 0, [int(h) for h in p.view(np.int64)], bytearray(jaccard.signature(x))) for k, (x, p) in enumerate(zip(own, prefixes(own)))]
    sets = spark.createDataFrame(rows, "s1 long, n long, s2 long, prefix array<long>, sign binary")
    return sets, sets.select("n", sets.s1.alias("node"))


def test_chance_ties_do_not_join_large_blocks(spark):
    """A chain of texts that share a phrase with the next: one block by ties, but only two texts are alike."""
    rng = np.random.default_rng(11)
    texts = [" ".join([f"a{k} b{k}", *(f"w{w}" for w in rng.integers(0, 5000, 100)), f"a{k + 1} b{k + 1}"]) for k in range(12)]
    texts += [texts[7] + " more"]

    def shared_first(own):
        seen = collections.Counter(h for x in own for h in x.tolist())
        return [x[np.argsort([-seen[h] for h in x.tolist()], kind="stable")][:25] for x in own]
    sets, nodes = hand_sets(spark, texts, 2, shared_first)
    assert jaccard.prefix_blocks(sets, nodes, 80).groupBy("block").count().collect()[0]["count"] == 13
    blocks = collections.defaultdict(set)
    for r in jaccard.prefix_blocks(sets, nodes, 80, block_shingles=1200).collect():
        blocks[r.block].add(r.node - 1)
    assert list(blocks.values()) == [{7, 12}]


@pytest.mark.parametrize("group", [4, 256])
def test_pair_ties_keep_links_of_groups_of_any_size(spark, group):
    rng = np.random.default_rng(10)
    texts = list({" ".join(f"word{k}" if rng.random() > 0.02 else f"o{k}" for k in range(40)): 0 for _ in range(30)})
    sets, _ = hand_sets(spark, texts, 2, lambda own: own)
    items = sets.select(sets.s1.alias("node"), "n", jaccard.F.explode("prefix").alias("item"))
    ties = jaccard.pair_ties(items, sets.select(sets.s1.alias("s_node"), "sign"), 70, group)
    block = {r.node - 1: r.root for r in jaccard.components(ties, "node", "first").collect()}
    own, _ = brute_links(texts, 2, 70)
    linked = [(i, j) for i in range(len(own)) for j in range(i) if 100 * len(own[i] & own[j]) >= 70 * len(own[i] | own[j])]
    assert len(linked) > 15 and all(block[i] == block[j] for i, j in linked)


def brute_lines(texts, window=3):
    first, gone = set(), []
    order = sorted(range(len(texts)), key=lambda k: (texts[k][0] is not None, texts[k][0] or 0, k))
    out = {}
    for k in order:
        ls = (texts[k][1] or "").split("\n")
        gone = set()
        for i in range(len(ls) - window + 1):
            w = tuple(ls[i:i + window])
            if w in first:
                gone |= set(range(i, i + window))
            first.add(w)
        out[k] = (len(ls), len(gone), "\n".join(x for i, x in enumerate(ls) if i not in gone))
    return out


def test_lines_against_brute_force(small, rows):
    want = brute_lines(rows)
    got = {r.doc_id: (r.n_lines, r.n_removed_lines, r.text) for r in lines.dedup_lines(small.select("doc_id", "text")).collect()}
    assert got == {i: want[k] for k, (i, _) in enumerate(rows)}


def test_lines_edges(edge, empty):
    out = lines.dedup_lines(edge)
    assert set(edge.columns) <= set(out.columns)
    got = out.select("doc_id", "text", "n_removed_lines").collect()
    assert len(got) == len(EDGE) and sum(r.text is None for r in got) == 2
    nine = next(r for r in got if r.doc_id == 9)
    assert (nine.text, nine.n_removed_lines) == ("a\nb\nc\nd\n", 3)
    assert next(r for r in got if r.doc_id == 10).text == ""
    assert [r.n_removed_lines for r in got if r.doc_id == 6] == [0, 0]
    assert lines.dedup_lines(empty).count() == 0
