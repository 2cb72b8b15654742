"""op13 against a plain dictionary of prefixes, with odd rows, long sequences and small shards."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from lagframe.llm import trie
from lagframe.llm.trie import TernaryTree, medians, plain, prefix_trie, rebuilt

SCHEMA = "conv_id long, turn long, role string, text string"
SPACES = b" \t\n\x0b\x0c\r"


def turns_of(rows):
    held = {}
    for c, turn, role, text in rows:
        if c is not None:
            held.setdefault(c, []).append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    return {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in held.items()}


def rebuild(held):
    out = {}
    for c, own in held.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = held.get(base, [])[:h] + own[h:]
    return out


def brute(held):
    nodes = {}
    for c, seq in held.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(tuple(seq[:d]), []).append(c)
    kids = {}
    for key in nodes:
        if key:
            kids.setdefault(key[:-1], []).append(key)
    leaves, saved = {}, {}
    for key in sorted(nodes, key=len, reverse=True):
        below = kids.get(key, [])
        leaves[key] = sum(leaves[k] for k in below) if below else 1
        own = (len(nodes[key]) - 1) * len(key[-1][1].split()) if key else 0
        saved[key] = own + sum(saved[k] for k in below)
    out = []
    for key, members in nodes.items():
        ends = sorted(c for c in members if len(held[c]) == len(key))
        sha = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        parent = min(nodes[key[:-1]]) if key else None
        out.append((min(members), len(key), parent, len(members), len(kids.get(key, [])), leaves[key], saved[key], sha))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(x) for x in df.collect()), key=repr)


def conversations(seed, n, longest=6, texts=4):
    r = random.Random(seed)
    rows = []
    for c in range(n):
        if r.random() < 0.1:
            continue
        for t in range(r.randint(0, longest)):
            turn = None if r.random() < 0.03 else t + r.choice([0, 0, 0, 5])
            role = r.choice(["user", "assistant", None]) if r.random() < 0.1 else ("user", "assistant")[t % 2]
            rows.append((c, turn, role, r.choice([None, "", " \n", *(f"t{t} {'w ' * i}x." for i in range(texts))])))
    return rows


def long_ones():
    """Copies, prefixes and branches of sequences longer than a block of 4."""
    seqs = {1: 11, 2: 11, 3: 9, 4: 12, 5: 8, 6: 4, 7: 4, 8: 3, 9: 20}
    rows = [(c, t, "user", f"a{t} b c") for c, n in seqs.items() for t in range(n)]
    rows += [(c, t, "user", f"a{t} b c" if t < 6 else f"other {c % 3} {t}") for c in range(10, 18) for t in range(13)]
    return rows + [(c, t, "user", f"own {c} {t}") for c in (20, 21) for t in range(10)] + [(22, t, "user", f"own 21 {t}") for t in range(10)]


@pytest.mark.parametrize("block,shard", [(trie.BLOCK, 40), (3, trie.SHARD)])
def test_rebuilt_trie_equals_brute_force(spark, monkeypatch, block, shard):
    monkeypatch.setattr(trie, "BLOCK", block)
    monkeypatch.setattr(trie, "SHARD", shard)
    rows = conversations(1, 90)
    rows += [(None, 0, "user", "lost"), (-7, 0, "user", "below zero"), (-7, 1, "user", "t"), (10**15 + 3, 0, "user", "far"), (5000, None, None, None), (5000, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumn("pos", F.lit("x")).withColumn("n", F.lit("x")).withColumn("tid", F.lit("x"))
    assert found(prefix_trie(*rebuilt(df))) == brute(rebuild(turns_of(rows)))


@pytest.mark.parametrize("block,shard,run", [(4, 60, 2)])
def test_long_sequences_go_block_by_block(spark, monkeypatch, block, shard, run):
    monkeypatch.setattr(trie, "BLOCK", block)
    monkeypatch.setattr(trie, "SHARD", shard)
    monkeypatch.setattr(trie, "RUN", run)
    rows = long_ones()
    held = turns_of(rows) | {30: []}
    turns, ids = plain(spark.createDataFrame(rows, SCHEMA))
    assert found(prefix_trie(turns, ids.unionByName(spark.createDataFrame([(30,)], "conv_id long")))) == brute(held)


def test_large_group_of_copies(spark, monkeypatch):
    monkeypatch.setattr(trie, "SHARD", 50)
    rows = [(c, t, "user", f"same {t}") for c in range(400) for t in range(3)] + [(c, t, "user", f"same {t}" if t < 2 else f"{c}") for c in range(400, 600) for t in range(4)]
    assert found(prefix_trie(*plain(spark.createDataFrame(rows, SCHEMA)))) == brute(turns_of(rows))


def test_empty_table_and_only_turnless(spark):
    none = prefix_trie(*rebuilt(spark.createDataFrame([], SCHEMA)))
    assert none.count() == 0 and none.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    rows = [(c, 0, "user", "x") for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4]
    assert found(prefix_trie(*rebuilt(spark.createDataFrame(rows, SCHEMA)))) == brute({c: [] for c, *_ in rows})


def test_tree_is_balanced_by_medians():
    assert sorted(medians(1000)) == list(range(1000)) and list(medians(0)) == []
    tree = TernaryTree()
    for i in medians(4095):
        tree.insert([i], [1])
    deep, at = {tree.down[0]: 1}, [tree.down[0]]
    while at:
        node = at.pop()
        for side in (tree.low[node], tree.high[node]):
            if side >= 0:
                deep[side] = deep[node] + 1
                at.append(side)
    assert max(deep.values()) == 12 and len(deep) == 4095
