"""op6 and op10 against brute force, with odd inputs."""

import hashlib
import random
import time

import numpy as np
import pyarrow as pa
import pytest

from lagframe.llm.components import components
from lagframe.llm.neardup import near_duplicates
from lagframe.llm import suffixes
from lagframe.llm.suffixes import Anchors, _merge, repeated_windows, remove_repeats, suffix_array


def brute_near(docs):
    sets = {}
    for i, t in docs:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def words(rng, n, vocabulary=4000):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def edited(rng, ws, share):
    return [w if rng.random() > share else f"e{rng.randrange(10**6)}" for w in ws]


def test_near_groups_match_brute_force(frame):
    rng = random.Random(5)
    docs = []
    base = words(rng, 120)
    docs += [" ".join(edited(rng, base, 0.02)) for _ in range(60)]  # a group of near copies
    docs += [" ".join(base)] * 30  # exact copies
    passage = words(rng, 80)
    docs += [" ".join(passage + words(rng, 40)) for _ in range(60)]  # share much, link rarely
    docs += [" ".join(words(rng, 60)) for _ in range(60)]
    chain = words(rng, 100)
    for _ in range(8):  # each links to the next only
        docs.append(" ".join(chain))
        chain = chain[8:] + words(rng, 8)
    docs += [None, "", "  \t\n", "one", "ONE", "two words", "Two  Words", "a b c d", "a b c d e", "É É É É É é"]
    rng.shuffle(docs)
    items = list(enumerate(docs))
    want = brute_near(items)
    for rounds, block in ((2, 1 << 19), (0, 3000)):
        got = near_duplicates(frame(items), star_rounds=rounds, block=block).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == want


def test_near_odd_rows(frame, spark):
    long = " ".join(f"x{i}" for i in range(60000))
    got = near_duplicates(frame([(1, long), (2, long + " end"), (None, long), (5, "q r s t u v"), (5, "q r s t u v"), (3, None)])).collect()
    rows = sorted(((r.doc_id, r.component_id, r.kept) for r in got), key=str)
    assert rows == sorted([(1, 1, True), (2, 1, False), (None, None, True), (5, 5, True), (5, 5, True), (3, 3, True)], key=str)
    empty = near_duplicates(frame([]))
    assert empty.columns == ["doc_id", "n_shingles", "component_id", "kept"] and empty.count() == 0


def test_near_ids_with_several_texts(frame):
    """An id's texts each link, whatever the order of rows; its sets are one document."""
    rng = random.Random(9)
    a, b, c, d = (words(rng, 100) for _ in range(4))
    text = lambda w: " ".join(w)
    items = [(1, text(a)), (1, text(b)), (2, text(a[2:] + ["x"])), (3, text(b[2:] + ["y"])), (4, text(c)), (5, text(c)), (5, text(d)), (6, text(d[1:])), (7, text(words(rng, 90))), (8, text(b))]
    n = {t: len({tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)}) for _, t in items}
    root = {1: 1, 2: 1, 3: 1, 8: 1, 4: 4, 5: 4, 6: 4, 7: 7}
    want = sorted((i, n[t], root[i], root[i] == i) for i, t in items)
    for order in (items, items[::-1]):
        assert sorted(map(tuple, near_duplicates(frame(order)).collect())) == want


def test_components(spark):
    edges = spark.createDataFrame([(5, 4), (4, 3), (3, 2), (9, 8), (7, 7), (2, 5), (8, 9)], "u long, v long")
    assert {(r.node, r.root) for r in components(edges).collect()} == {(2, 2), (3, 2), (4, 2), (5, 2), (8, 8), (9, 8)}


def brute_repeats(docs, width):
    seen = {}
    texts = [(t or "").encode() for _, t in docs]
    for b in texts:
        for k in range(len(b) - width + 1):
            seen[b[k : k + width]] = seen.get(b[k : k + width], 0) + 1
    out = []
    for (i, _), b in zip(docs, texts, strict=True):
        gone = bytearray(len(b))
        for k in range(len(b) - width + 1):
            if seen[b[k : k + width]] > 1:
                gone[k : k + width] = b"\1" * width
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("settings", [{}, {"shard": 2000, "wide": 3, "task": 4000}])
def test_repeats_match_brute_force(frame, settings):
    rng = random.Random(6)
    passage = " ".join(words(rng, 60))
    docs = [" ".join(words(rng, 50)) + " " + passage + " " + " ".join(words(rng, 50)) for _ in range(40)]
    docs += [docs[0], docs[0], docs[1] + docs[2], "ab" * 400, "x" * 199, "x" * 200, "x" * 201, "x" * 700, "é" * 150, "日本" * 90 + "é" * 150, None, "", "\0" * 300]
    docs += [passage[30:230] + "tail", "head" + passage[30:229], passage[:199], " ".join(words(rng, 3000, 10))]
    items = list(enumerate(docs)) + [(None, docs[3]), (3, docs[3]), (3, "another text " * 30)]
    got = remove_repeats(frame(items), **settings).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_repeats(items, 200)


def test_repeats_of_a_hot_anchor(frame, monkeypatch):
    """A line in most documents, with other surroundings each time: its windows are dealt by
    place and by bytes; long texts in stretches."""
    monkeypatch.setattr(suffixes, "STRETCH", 300)
    monkeypatch.setattr(suffixes, "SLICE", 4000)
    rng = random.Random(11)
    line = "the line that nearly all of the documents hold in common."
    shared = " ".join(words(rng, 30))
    docs = [" ".join(words(rng, 40)) + line + " ".join(words(rng, 40)) for _ in range(80)]
    docs += [" ".join(words(rng, 9)) + line + shared + " ".join(words(rng, 20)) for _ in range(60)]
    docs += [" ".join(words(rng, 9)) + shared + line + " ".join(words(rng, 20)) for _ in range(20)]
    docs += [" ".join(words(rng, 400)), "a" * 1500, None]
    items = list(enumerate(docs))
    got = remove_repeats(frame(items), width=60, gram=20, wide=1, shard=3000, task=20000).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_repeats(items, 60)


def test_many_pieces_of_one_group_merge_in_time():
    rng = np.random.default_rng(12)
    pieces = [rng.integers(97, 123, 200, dtype=np.uint8).tobytes() for _ in range(40_000)]
    pieces[39_000], pieces[20_000] = pieces[3], pieces[4]
    shards = [pieces[i : i + 5000] for i in range(0, 40_000, 5000)]
    flags = [[np.zeros(1, dtype=bool) for _ in s] for s in shards]
    began = time.time()
    _merge(shards, flags, 200)
    found = [i for i, f in enumerate(f for s in flags for f in s) if f.any()]
    assert found == [3, 4, 20_000, 39_000] and time.time() - began < 20


def hot_line(n, seed, near=0):
    """Texts of random letters around one line of 130 bytes; the last ``near`` ones differ in their first bytes only."""
    rng = np.random.default_rng(seed)
    letters = lambda k: rng.integers(97, 123, k, dtype=np.uint8).tobytes()
    line, texts = letters(130), []
    for _ in range(n - near):
        texts.append(letters(200) + line + letters(200))
    return texts + [letters(100) + texts[0][100:] for _ in range(near)]


def test_contexts_of_a_common_line_are_told_apart():
    """A line in all texts that is shorter than a core, with other bytes around it, has nothing to be looked into."""
    line = b"a line of nearly all texts, which is not as long as half a window."
    cores = [h for t in hot_line(60, 14) for h in Anchors(200, 24).of(t[:200] + line + t[330:])[0].tolist()]
    assert len(set(cores)) == len(cores)


def dealt(texts, wide):
    """(core hash, part, bytes) of the pieces of the most frequent core."""
    found = [list(zip(*Anchors(200, 24).of(t), strict=True)) for t in texts]
    cores = [h for contexts in found for h in {c[0] for c in contexts}]
    top = max(set(cores), key=cores.count)
    wanted = [[{"h": 1, "spot": int(a << 24 | (b - a + 1) << 12 | (p - a)), "variants": len(texts), "known": False} for h, _, a, b, p in contexts if h == top] for contexts in found]
    kind = pa.list_(pa.struct([("h", pa.int64()), ("spot", pa.int64()), ("variants", pa.int64()), ("known", pa.bool_())]))
    ids = pa.array(range(len(texts)), pa.int64())
    batch = pa.RecordBatch.from_arrays([ids, ids, pa.array([t.decode() for t in texts]), pa.array(wanted, kind)], ["id", "fp", "text", "wanted"])
    return [row for b in suffixes._pieces(200, 24, wide, 1)([batch]) for row in zip(*(b.column(c).to_pylist() for c in ("h", "part", "data")), strict=True)]


def test_bytes_dealt_for_a_hot_core_grow_with_its_contexts():
    few, many = dealt(hot_line(64, 15, near=9), 16), dealt(hot_line(1024, 15, near=9), 16)
    assert sum(len(d) for _, _, d in many) < 16 * 3 * sum(len(d) for _, _, d in few)
    groups = {}  # equal windows meet
    for h, part, data in many:
        for i in range(len(data) - 199):
            groups.setdefault(data[i : i + 200], []).append((h, part))
    assert max(map(len, groups.values())) > 1 and all(len(set(g)) == 1 for g in groups.values())


def test_suffix_arrays_see_only_windows_that_may_repeat(monkeypatch):
    texts = hot_line(300, 16, near=4)
    seen, whole = [], suffixes.repeated_windows
    monkeypatch.setattr(suffixes, "repeated_windows", lambda pieces, width: (seen.extend(pieces), whole(pieces, width))[1])
    n = len(texts)
    table = pa.table({"h": pa.array([1] * n, pa.int64()), "part": pa.array([0] * n, pa.int64()), "data": pa.array(texts, pa.binary()), "id": pa.array(range(n), pa.int64()), "fp": pa.array(range(n), pa.int64()), "start": pa.array([7] * n, pa.int64()), "known": pa.array([False] * n)})
    got = suffixes._shards(200, 1 << 20)(table).to_pylist()
    assert sorted((r["id"], r["first"], r["last"]) for r in got) == [(i, 107, 337) for i in [0, 296, 297, 298, 299]]
    assert sorted(map(len, seen)) == [430] * 5


def test_long_texts_are_looked_at_in_stretches():
    """Contexts cover every window once, with the anchor that the window alone decides."""
    text = (b"abcdefghij" * 30 + np.random.default_rng(13).integers(97, 123, 900, dtype=np.uint8).tobytes()) * 2 + b"z" * 700
    whole = Anchors(200, 24).of(text)
    anchor = {w: int(p) for _, _, f, g, p in zip(*whole, strict=True) for w in range(int(f), int(g) + 1)}
    assert sorted(anchor) == list(range(len(text) - 199))
    before, suffixes.STRETCH = suffixes.STRETCH, 111
    try:
        cut = Anchors(200, 24).of(text)
    finally:
        suffixes.STRETCH = before
    again = {w: int(p) for _, _, f, g, p in zip(*cut, strict=True) for w in range(int(f), int(g) + 1)}
    assert again == anchor


def test_repeats_small_width_and_text(frame):
    got = remove_repeats(frame([(1, "abcdefgh-XYZ"), (2, "XYZ-abcdefgh"), (3, "zz")]), width=8, gram=3, keep_text=True, carry=("source", "id")).collect()
    assert {(r.doc_id, r.kept, r.source, r.id) for r in got} == {(1, "-XYZ", "s", "x"), (2, "XYZ-", "s", "x"), (3, "zz", "s", "x")}
    assert remove_repeats(frame([])).count() == 0


def test_suffix_arrays():
    rng = random.Random(7)
    for _ in range(150):
        b = bytes(rng.choice([0, 0, 1, 97]) for _ in range(rng.choice([1, 2, 8, 9, 60])))
        assert suffix_array(np.frombuffer(b, dtype=np.uint8)).tolist() == sorted(range(len(b)), key=lambda i: b[i:])
    for _ in range(60):
        w = rng.choice([3, 9, 20])
        pieces = [bytes(rng.choice([0, 1]) for _ in range(rng.randint(w, w + 30))) for _ in range(9)]
        count = {}
        for p in pieces:
            for i in range(len(p) - w + 1):
                count[p[i : i + w]] = count.get(p[i : i + w], 0) + 1
        want = [[count[p[i : i + w]] > 1 for i in range(len(p) - w + 1)] for p in pieces]
        assert [f.tolist() for f in repeated_windows(pieces, w)] == want
