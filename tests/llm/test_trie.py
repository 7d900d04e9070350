import hashlib
import zlib

import numpy as np
import pytest

from feedlake.llm import queries, trie
from tests.llm.conftest import SF


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    members, ends = {}, {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole = own.get(c - c % 5, [])[:h] + turns[h:]
        for d in range(len(whole) + 1):
            members.setdefault(tuple(whole[:d]), []).append(c)
        ends.setdefault(tuple(whole), []).append(c)
    kids = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    sums = {}
    for node in sorted(members, key=len, reverse=True):
        below = [sums[k] for k in kids.get(node, [])]
        mine = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        sums[node] = (sum(b[0] for b in below) or 1, mine + sum(b[1] for b in below))
    return sorted((min(m), len(node), min(members[node[:-1]]) if node else -1, len(m), len(kids.get(node, [])), *sums[node],
                   hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest()) for node, m in members.items())


def found(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves,
                   r.saved_tokens, r.ends_sha256) for r in df.collect())


TURNS = "conv_id long, turn long, role string, text string, pos string, d1 string, depth string"


def turns(spark, rows):
    return spark.createDataFrame([(*r, "?", "?", "?") for r in rows], TURNS)


def test_trie_whole_table(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert found(queries.QUERIES["op12_trie"](spark, SF)) == brute([tuple(r) for r in table])


def edge_rows():
    rng = np.random.default_rng(11)
    rows = [(None, 1, "user", "lost"), (10, None, None, None), (10, None, "a", None), (10, 3, "b", ""), (10, 3, "b", ""),
            (1003, 0, "user", "base is absent"), (11, 5, "user", "é漢😀"), (1 << 40, 0, "u", "far")]
    for c in range(20, 320):
        for t in range(int(rng.integers(0, 12))):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", f"turn {t} {int(rng.integers(0, 3))}"))
    rows += [(c, t, "x", "same") for c in range(70_000, 70_400) for t in range(3)]
    rows += [(500, t, "x", f"long {t}") for t in range(700)] + [(505, t, "x", f"long {t}") for t in range(650)]
    return rows


@pytest.mark.parametrize("limit,shard,long", [(20_000, 100_000, 4096), (5, 50, 16), (1, 7, 3)])
def test_trie_edges_shards_and_cuts(spark, monkeypatch, limit, shard, long):
    monkeypatch.setattr(trie, "LONG", long)
    monkeypatch.setattr(trie, "CHUNK_BITS", 4 if long < 100 else 16)
    rows = edge_rows()
    df = turns(spark, rows).repartition(5)
    # A limit below the square root of all turns is raised to it, which is the bound on heavy nodes.
    assert found(trie.prefix_trie(trie.rebuilt(trie.ordered_turns(df)), limit, shard)) == brute(rows)


def test_empty_table_and_turnless_conversations(spark):
    assert trie.prefix_trie(trie.rebuilt(trie.ordered_turns(turns(spark, [])))).count() == 0
    short = [(c, 0, "u", "only") for c in (1, 2, 3, 4, 6, 7)]
    assert found(trie.prefix_trie(trie.rebuilt(trie.ordered_turns(turns(spark, short))))) == brute(short)


def test_node_table_is_minimal_and_verified():
    rng = np.random.default_rng(1)
    depth, d1, d2 = rng.integers(1, 4, 5000), rng.integers(-2**62, 2**62, 5000), rng.integers(-2**62, 2**62, 5000)
    table = trie.NodeTable(depth, d1, d2)
    assert sorted(table.slots.tolist()) == list(range(5000))
    assert (table.find(depth, d1, d2) == table.slots).all()
    assert (table.find(depth + 9, d1, d2) == -1).all() and (table.find(depth, d1 + 1, d2) == -1).all()
    with pytest.raises(ValueError):
        trie.NodeTable(np.array([1, 1]), np.array([5, 5]), np.array([6, 6]))
