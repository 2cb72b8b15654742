"""The byte-level codec against the tiktoken library, Python's decoder and its laws."""

import base64
import hashlib
import random

import numpy as np
import pytest

from lagframe.llm import bytepairs
from lagframe.llm.bytepairs import Codec, Utf8Stream, codec, decode_byte_pairs, encode_byte_pairs

tokenizers = pytest.importorskip("public_tokenizers")
PATH, PATTERN = tokenizers.path("byte_bpe_50k.tiktoken"), tokenizers.PATTERN
ODD = ["", None, "a", " ", "\n\n  x", "it's 12,5 km².", "日本語 テキスト", "é́🙂🏳️‍🌈", "a\x00b\x1c\x85c", "<|endoftext|>", "x" * 5000, " " * 3000, "-=" * 2000]


@pytest.fixture(scope="module")
def library():
    tiktoken = pytest.importorskip("tiktoken")
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(own, text):
    return np.frombuffer(b"".join(own.encode(text)), dtype="<u4").tolist()


def texts(seed, n):
    r = random.Random(seed)
    alphabets = ["ab", "abc de", "aeiouthns ", "  \n\t'sre", "-=_ *#", "0123456789. ", "éüñçß日本語мир ", "".join(map(chr, range(32, 127)))]
    for _ in range(n):
        a = r.choice(alphabets)
        yield "".join(r.choice(a) for _ in range(r.randint(0, 40)))


def test_ids_equal_the_library(library):
    own = codec(PATH, PATTERN)
    r = random.Random(2)
    tokens = list(own.ranks.rank)
    joined = (b"".join(r.choice(tokens) for _ in range(r.randint(1, 6))).decode("utf-8", "replace") for _ in range(3000))
    planes = (f"a{chr(c)}b {chr(c)}{chr(c)}1" for c in range(0, 0x110000, 97) if not 0xD800 <= c < 0xE000)
    for text in [*[t or "" for t in ODD], *texts(1, 3000), *joined, *planes]:
        assert ids(own, text) == library.encode_ordinary(text), text


def test_small_bounds_change_nothing(library, monkeypatch):
    for name, value in (("STATE_LIMIT", 3), ("MEMO_LIMIT", 2), ("PAIR_LIMIT", 2), ("PIECES", 2), ("LONG", 3)):
        monkeypatch.setattr(bytepairs, name, value)
    own = Codec(dict(codec(PATH, PATTERN).ranks.rank), PATTERN)
    for text in texts(5, 200):
        assert ids(own, text) == library.encode_ordinary(text)


def test_pairs_fit_as_merging_both_says():
    ranks = codec(PATH, PATTERN).ranks
    r, tokens = random.Random(6), list(ranks.rank)
    pairs = [(r.choice(tokens), r.choice(tokens)) for _ in range(20000)] + [(a * i, a * j) for a in (b" ", b"a", b"-", b"=") for i in range(1, 9) for j in range(1, 9)]
    pairs += [(t[:i], t[i:]) for t in r.sample(tokens, 3000) for i in range(1, len(t))]
    for a, b in pairs:
        if a in ranks.rank and b in ranks.rank:
            assert ranks.fits(ranks.rank[a], ranks.rank[b]) == (ranks.merged(a + b) == [ranks.rank[a], ranks.rank[b]]), (a, b)


def test_lookahead_is_bounded():
    """What a state holds back does not grow with the word."""
    own = codec(PATH, PATTERN)
    machine = bytepairs.Transducer(own.ranks)
    longest = max(map(len, own.ranks.rank))
    machine.encode(b"ab" * 20000)
    assert max(len(tail) for _, tail, _ in machine.keys) < longest
    assert len(machine.keys) < 1000


def test_utf8_machine_is_pythons():
    r = random.Random(3)
    leads = [0x00, 0x41, 0x7F, 0x80, 0x9F, 0xA0, 0xBF, 0xC0, 0xC2, 0xDF, 0xE0, 0xE1, 0xED, 0xEF, 0xF0, 0xF1, 0xF4, 0xF5, 0xFF]
    for _ in range(20000):
        data = bytes(r.choice(leads) for _ in range(r.randint(0, 8)))
        stream, cut = Utf8Stream(), r.randint(0, 8)
        assert (stream.feed(data[:cut]) + stream.feed(data[cut:]) + stream.close()).decode() == data.decode("utf-8", "replace")


def test_documents(frame, library):
    items = [*ODD, "x", "x"]
    coded = encode_byte_pairs(frame([(i if i else None, t) for i, t in enumerate(items)]), PATH, PATTERN, keep_ids=True)
    found = {(x.doc_id, x.n_tokens, x.ids_sha256, x.decoded_sha256) for x in coded.collect()}
    want = set()
    for i, t in enumerate(items):
        w = library.encode_ordinary(t or "")
        want.add((i or None, len(w), hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in w)).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert found == want and coded.count() == len(items)
    back = decode_byte_pairs(coded, PATH, PATTERN)
    assert sorted((x.doc_id or 0, x.text) for x in back.collect()) == sorted((i, t or "") for i, t in enumerate(items))


def test_decode_odd_ids(spark):
    own = codec(PATH, PATTERN)
    half = [own.ranks.rank[bytes([b])] for b in "é".encode()[:1]]
    whole = [own.ranks.rank[bytes([b])] for b in "🙂".encode()]
    rows = [(1, None), (2, []), (3, half), (4, whole), (5, [*half, *whole, *half, own.ranks.rank[b"a"]])]
    found = decode_byte_pairs(spark.createDataFrame(rows, "doc_id long, ids array<int>"), PATH, PATTERN)
    assert {x.doc_id: x.text for x in found.collect()} == {1: None, 2: "", 3: "�", 4: "🙂", 5: "�🙂�a"}


def test_empty_table(frame):
    none = encode_byte_pairs(frame([(1, "a")]).limit(0), PATH, PATTERN)
    assert none.count() == 0 and none.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
