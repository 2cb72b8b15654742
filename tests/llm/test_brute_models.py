"""op5, op7 and op8 against plain versions that go key by key, weight by weight, leaf by leaf."""

import hashlib
import math
import random

import numpy as np

from lagframe.llm import quality, toxicity
from lagframe.llm.quality import AdditiveModel
from lagframe.llm.ring import ring_nodes, settle
from lagframe.llm.toxicity import PlainWords, features, ftrl


def walk_the_ring(keys, shards, load, vnodes, cells):
    """Place keys (cell, in order) one after another: each offers itself to the first virtual
    node at or after its cell; who finds it full waits for the next round at the next with room."""
    taken = {}
    for shard in range(shards):
        for v in range(vnodes):
            at = int.from_bytes(hashlib.sha256(f"{shard}/{v}".encode()).digest()[:8], "big") % cells
            while at in taken:
                at = (at + 1) % cells
            taken[at] = shard
    line = sorted(taken)
    room = {s: len(keys) // shards + (s < len(keys) % shards) if load <= 1 else math.ceil(load * len(keys) / shards) for s in range(shards)}
    node = [next((i for i, p in enumerate(line) if p >= c), 0) for c in keys]
    placed, waiting = [None] * len(keys), sorted(range(len(keys)), key=lambda k: (keys[k], k))
    while waiting:
        still = []
        for k in waiting:
            shard = taken[line[node[k]]]
            if room[shard]:
                room[shard] -= 1
                placed[k] = shard
                continue
            still.append(k)  # it goes on to the next node with room
            node[k] = (node[k] + 1) % len(line)
            while not room[taken[line[node[k]]]]:
                node[k] = (node[k] + 1) % len(line)
        waiting = still
    return placed


def test_ring_equals_a_walk_key_by_key():
    r = random.Random(1)
    for shards, load, vnodes, cells, n in ((3, 1.0, 4, 64, 100), (5, 1.25, 3, 64, 333), (8, 1.0, 8, 256, 1000), (2, 1.0, 1, 16, 31), (4, 50.0, 4, 64, 200)):
        keys = sorted(min(int(r.expovariate(4) * cells), cells - 1) for _ in range(n))
        counts = {c: keys.count(c) for c in set(keys)}
        got = {}
        for cell, begins, owners, _ in settle(counts, shards, load, vnodes, cells):
            ends = [*begins[1:], counts[cell]]
            got[cell] = sorted(s for b, e, s in zip(begins, ends, owners) for _ in range(e - b))
        walked = walk_the_ring(keys, shards, load, vnodes, cells)
        assert got == {c: sorted(s for k, s in zip(keys, walked) if k == c) for c in counts}
        assert [s for s in ring_nodes(shards, vnodes, cells) if s >= 0].count(0) == vnodes


def test_ftrl_equals_plain_python():
    """Per-coordinate rates, the L1 threshold and the bias, on 200 rows."""
    r = random.Random(2)
    vocabulary = [f"w{i}" for i in range(60)]
    texts = [" ".join(r.choice(vocabulary) for _ in range(r.randint(1, 15))).encode() for _ in range(200)]
    labels = [int(b"w1 " in t + b" " or r.random() < 0.2) for t in texts]
    bits = 10
    rows = [(y, np.unique(features([t], PlainWords(), bits)[0])) for t, y in zip(texts, labels)]
    got, bias = ftrl(rows, 1 << bits)
    alpha, beta, l1, l2 = toxicity.ALPHA, toxicity.BETA, toxicity.L1, toxicity.L2
    z, n, bz, bn = {}, {}, 0.0, 0.0

    def weight(i):
        zi = z.get(i, 0.0)
        if abs(zi) <= l1:
            return 0.0
        return -(zi - math.copysign(l1, zi)) / ((beta + math.sqrt(n.get(i, 0.0))) / alpha + l2)

    for _ in range(toxicity.EPOCHS):
        for y, at in rows:
            b = -bz / ((beta + math.sqrt(bn)) / alpha)
            total = sum(weight(int(i)) for i in at) + b
            g = 1 / (1 + math.exp(-max(-35.0, min(35.0, total)))) - y
            for i in map(int, at):
                w, old = weight(i), n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / alpha * w
                n[i] = old + g * g
            bz += g - (math.sqrt(bn + g * g) - math.sqrt(bn)) / alpha * b
            bn += g * g
    want = np.array([weight(i) for i in range(1 << bits)])
    assert np.abs(got - want).max() < 1e-12 and abs(bias + bz / ((beta + math.sqrt(bn)) / alpha)) < 1e-12
    assert 0 < (got != 0).sum() < len(z)  # the threshold leaves most weights at zero


def best_cut(rows, g, h, bins):
    """Of cuts of the rows by bin: (gain, bin) of the best, the lowest of equal ones."""
    score = lambda part: sum(g[i] for i in part) ** 2 / (sum(h[i] for i in part) + 1.0)
    best = (0.0, None)
    for cut in range(min(bins) + 1 if bins else 0, (max(bins) if bins else 0) + 1):
        left, right = [i for i in rows if bins[i] < cut], [i for i in rows if bins[i] >= cut]
        if min(len(left), len(right)) >= quality.LEAST:
            gain = score(left) + score(right) - score(rows)
            if gain > best[0] + 1e-12:
                best = (gain, cut)
    return best


def boosted(x, y, rounds):
    """Logits of trees with two cuts on one feature, boosted leaf by leaf in plain Python."""
    edges = sorted(set(np.quantile(x, np.linspace(0, 1, quality.BINS + 1)[1:-1])))
    bins = [sum(e <= v for e in edges) for v in x]
    rate = (sum(y) + 0.5) / (len(y) + 1.0)
    total = [math.log(rate / (1 - rate))] * len(y)
    for _ in range(rounds):
        p = [1 / (1 + math.exp(-t)) for t in total]
        g, h = [yi - pi for yi, pi in zip(y, p)], [max(pi * (1 - pi), 1e-6) for pi in p]
        leaves = [list(range(len(y)))]
        for _ in range(2):
            (gain, cut), leaf = max(((best_cut(rows, g, h, bins), rows) for rows in leaves), key=lambda f: f[0][0])
            if cut is None:
                break
            leaves.remove(leaf)
            leaves += [[i for i in leaf if bins[i] < cut], [i for i in leaf if bins[i] >= cut]]
        for leaf in leaves:
            step = quality.RATE * sum(g[i] for i in leaf) / (sum(h[i] for i in leaf) + 1.0)
            for i in leaf:
                total[i] += step
    return total


def test_boosting_of_one_feature_equals_plain_python(monkeypatch):
    monkeypatch.setattr(quality, "ROUNDS", 8)
    monkeypatch.setattr(quality, "PAIR_ROUNDS", 0)
    rng = np.random.default_rng(3)
    x = rng.normal(size=150)
    y = (np.sin(2 * x) + rng.normal(scale=0.4, size=150) > 0).astype(float)
    model = AdditiveModel().fit(x[:, None], y)
    assert np.abs(model.logits(x[:, None]) - boosted(x.tolist(), y.tolist(), 8)).max() < 1e-9


def test_pair_cuts_equal_trying_all(monkeypatch):
    rng = np.random.default_rng(4)
    for _ in range(20):
        g, h = rng.normal(size=(6, 7)), rng.uniform(0.1, 1, size=(6, 7))
        gain, step = quality._quadrants(g, h)
        best = None
        for r in range(1, 6):
            for c in range(1, 7):
                parts = [(slice(0, r), slice(0, c)), (slice(0, r), slice(c, None)), (slice(r, None), slice(0, c)), (slice(r, None), slice(c, None))]
                found = sum(g[p].sum() ** 2 / (h[p].sum() + 1.0) for p in parts) - g.sum() ** 2 / (h.sum() + 1.0)
                if best is None or found > best[0]:
                    best = (found, parts)
        want = np.empty_like(g)
        for p in best[1]:
            want[p] = g[p].sum() / (h[p].sum() + 1.0)
        assert abs(gain - best[0]) < 1e-9 and np.abs(step - want).max() < 1e-9
