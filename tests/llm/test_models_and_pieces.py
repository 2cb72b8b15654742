"""op7, op8 and op9: held-out accuracy, the library's codes, odd inputs."""

import hashlib
import random
import re

import pytest

from lagframe.llm.labelled import labelled_texts
from lagframe.llm.pieces import PieceCoder, encode_documents
from lagframe.llm.quality import quality_filter, quality_scores
from lagframe.llm.queries import piece_model
from lagframe.llm.toxicity import toxicity_scores

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def labelled(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    return docs.join(labels.select("doc_id"), "doc_id", "left_semi"), labels


def accuracy(scores, labels, column):
    rows = scores.join(labels, "doc_id").toPandas()
    held = rows[rows.held_out]
    assert len(held) > 300 and ((held.score >= 0.5) == (held.predicted == 1)).all()
    return (held.predicted == held[column]).mean(), held[held[column] == 0].predicted.mean()


def test_toxicity_held_out(labelled):
    right, blamed = accuracy(toxicity_scores(*labelled), labelled[1], "toxic")
    assert right >= 0.96 and blamed <= 0.01


def test_quality_held_out(labelled):
    right, spared = accuracy(quality_scores(*labelled), labelled[1], "quality")
    assert right >= 0.98 and spared <= 0.05


def test_sample_is_bounded_by_rows(frame, spark):
    """An id with many texts counts once in the sample."""
    labels = spark.createDataFrame([(i, i % 2) for i in range(9)], "doc_id long, quality int")
    docs = frame([(1, f"text {i}") for i in range(500)] + [(i, "one") for i in (2, 3, 4)])
    for limit in (1, 2, 9):
        rows = labelled_texts(docs, labels, "doc_id", "text", "quality", 5, 0, limit).collect()
        assert len(rows) <= limit
    again = labelled_texts(docs.repartition(3), labels, "doc_id", "text", "quality", 5, 0, 9).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_models_odd_rows(frame, spark):
    labels = spark.createDataFrame([(i, i % 2, i % 3 == 0 and 1 or 0, "x") for i in range(100)] + [(None, 1, 1, "x"), (3, None, None, "x"), (4, 7, 9, "x")], "doc_id long, quality int, toxic int, text string")
    texts = [("bad " if i % 3 == 0 else "fine ") * 3 + ("good words here." if i % 2 else "&&& $$$ ###") for i in range(100)]
    items = list(enumerate(texts)) + [(None, "bad bad"), (1, texts[1]), (200, None), (201, ""), (202, "word " * 50000)]
    for score, name in ((toxicity_scores, "toxic"), (quality_scores, "quality")):
        got = score(frame(items), labels).collect()
        assert len(got) == len(items) and all(0 <= r.score <= 1 for r in got)
        assert len({r.score for r in got if r.doc_id == 1}) == 1
        empty = {r.doc_id: r.score for r in got if r.doc_id in (200, 201)}
        assert empty[200] == empty[201] and not any(r.held_out for r in got if r.doc_id is None)
        none = score(frame(items), labels.filter("doc_id < 0")).collect()
        assert {r.score for r in none} == {0.5}, name
        assert score(frame([]), labels).count() == 0
    kept = quality_filter(frame(items), labels)
    assert kept.columns == frame(items).columns and kept.filter("doc_id = 1").count() == 2
    by_id = {r.doc_id: r.predicted for r in quality_scores(frame(items), labels).collect()}
    assert {r.doc_id for r in kept.collect()} == {i for i, p in by_id.items() if p}


def test_pieces_match_the_library():
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    coder = PieceCoder(piece_model(), check=False)
    rng = random.Random(8)
    letters = list("ab e▁▁  \n\t\rthe<s>0x41é日本\U0001f600\x00́.,'!")
    for _ in range(4000):
        text = "".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 5, 20, 80])))
        ids = library.encode(text)
        assert coder.encode(text) == ids, text
        assert coder.decode(ids) == library.decode(ids), text


def test_documents_of_pieces(frame):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    texts = ["Hello world.", "", None, "  two  spaces ", "x" * 30000, "word, " * 30000, "\n\n\ta", "日本語 \U0001f600"]
    items = list(enumerate(texts)) + [(None, "a"), (1, "b"), (1, "b")]
    got = encode_documents(frame(items), piece_model(), keep_ids=True).collect()
    want = []
    for i, t in items:
        ids = library.encode(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest(), ids))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert encode_documents(frame([]), piece_model()).count() == 0


def test_a_wrong_code_stops(tmp_path):
    coder = PieceCoder(piece_model())
    coder.fresh.append(("word", [1, 2, 3]))
    with pytest.raises(ValueError, match="differ"):
        coder.verify()


def test_pieces_after_other_letters():
    """Characters that are alphanumeric, but neither letters nor decimal digits."""
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    coder = PieceCoder(piece_model(), check=False)
    odd = "²³¹¼½¾₁₂₃⅓❶①Ⅷ௰"
    texts = ["m².", "100 km².", "E = mc².", *(f"{a}{x}{h}{b}" for a in ("", "m", " 7", "é.") for x in odd for h in ".,;:!?" for b in ("", "a", " b."))]
    rng = random.Random(9)
    letters = list(odd + "²²..,;:!? mk▁\n1")
    texts += ["".join(rng.choice(letters) for _ in range(rng.choice([3, 8, 60]))) for _ in range(4000)]
    for text in texts:
        assert coder.encode(text) == library.encode(text), text
    # no piece crosses a cut
    for piece in coder.ids:
        assert len(coder.units("▁" + piece)) == 1, piece
        assert coder.encode(piece.replace("▁", " ")) == library.encode(piece.replace("▁", " ")), piece


def test_every_unit_is_checked_in_its_place(monkeypatch):
    plain = PieceCoder.encode_unit
    for wrong in ("▁seventh", ".", "after", "\n", ".'s", "▁▁▁", "▁" + "z" * 90):
        monkeypatch.setattr(PieceCoder, "encode_unit", lambda self, unit, wrong=wrong: plain(self, unit) + [5] * (unit == wrong))
        coder = PieceCoder(piece_model())
        with pytest.raises(ValueError, match="differ"):
            coder.encode("one two three. four five six seventh 's\nafter " + "z" * 90 + " words   ")
            coder.encode("word.'s   \nafter")
            coder.verify()
    monkeypatch.undo()
    coder = PieceCoder(piece_model())
    coder.units = re.compile("▁*[^\\W\\d_]+(?=\\.)|▁*[^▁]+|▁+").findall  # splits a piece
    coder.encode("m².")
    with pytest.raises(ValueError, match="differ"):
        coder.verify()
    coder = PieceCoder(piece_model())
    rng = random.Random(10)
    letters = list("ab e▁▁  \n\t\rthe<s>0x41é日本\U0001f600\x00́.,'!m²½")
    for _ in range(4000):
        coder.encode("".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 5, 20, 80]))))
    coder.verify()
    assert not coder.fresh and not coder.new and len(coder) > 4000


def test_agendas_in_arrays_are_the_heaps():
    """Units that share arrays get what each one's heap gives, in batches of odd sizes."""
    coder = PieceCoder(piece_model(), check=False)
    rng = random.Random(11)
    letters = list("aaabenrst▁ißéЖ日\U0001f600²\x00.,1")
    units = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(1, 32))) for _ in range(3000)})
    for lo, hi in ((0, 1), (1, 8), (8, 3000)):
        coder._prepare(units[lo:hi])
        got = dict(coder.ready)
        coder.ready.clear()
        assert got == {u: coder.encode_unit(u) for u in units[lo:hi]}


def test_remembered_codes_are_bounded(monkeypatch):
    """Recent and older codes up to the limit each; forgotten ones are coded and compared again."""
    import sentencepiece

    from lagframe.llm import pieces

    monkeypatch.setattr(pieces, "MEMO_LIMIT", 50)
    library = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    coder = PieceCoder(piece_model())
    rng = random.Random(12)
    texts = ["  ".join("".join(rng.choice("abcé²") for _ in range(3)) + rng.choice(["", ",", ".\n", " "]) for _ in range(60)) for _ in range(40)]
    for lo in range(0, 40, 4):
        found = coder.encode_joined(texts[lo : lo + 4])
        assert [",".join(c) for c in found] == [",".join(map(str, library.encode(t))) for t in texts[lo : lo + 4]]
        assert [coder.surface_of(c).decode()[1:] for c in found] == texts[lo : lo + 4]
        assert len(coder) <= 50 and len(coder.older) <= 50
    coder.verify()


def test_a_coder_is_kept_from_task_to_task(monkeypatch):
    import pyarrow as pa

    from lagframe.llm import pieces

    made = []
    monkeypatch.setattr(pieces, "_CODERS", {})
    monkeypatch.setattr(pieces, "PieceCoder", lambda *a: made.append(PieceCoder(*a)) or made[-1])
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["one two", None])], ["id", "text"])
    task = pieces._code(piece_model(), True, False)
    assert [b.to_pylist() for b in task(iter([batch]))] == [b.to_pylist() for b in task(iter([batch]))]
    assert len(made) == 1
    # one that a difference stopped is not
    monkeypatch.setattr(pieces._CODERS[piece_model(), True], "encode_unit", lambda unit: [5])
    with pytest.raises(ValueError, match="differ"):
        list(task(iter([pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["three"])], ["id", "text"])])))
    assert not pieces._CODERS


def test_pairs_are_found():
    """Every two symbols whose concatenation is a piece, and no others."""
    import numpy as np

    pairs = PieceCoder(piece_model(), check=False).pairs
    known = np.flatnonzero(pairs.left >= 0)
    left = pairs.left[known]
    right = known - pairs.shift[left]
    want = dict(zip(zip(left.tolist(), right.tolist(), strict=True), known.tolist(), strict=True))
    coder = PieceCoder(piece_model(), check=False)
    assert len(want) > 50_000
    single = {c: i for c, i in coder.ids.items() if len(c) == 1}
    for p, i in coder.ids.items():
        if len(p) == 2 and p[0] in single and p[1] in single:
            assert pairs.made[want[single[p[0]], single[p[1]]]] == i
    rng = np.random.default_rng(13)
    a, b = (np.concatenate([x, rng.integers(0, pairs.other + 1, 200_000)]) for x in (left, right))
    nothing = len(pairs.left) - 1
    assert pairs.find(a, b).tolist() == [want.get(ab, nothing) for ab in zip(a.tolist(), b.tolist(), strict=True)]
    assert pairs.order[nothing] == 2**31 - 1


def test_new_units_are_held_a_few_at_a_time(monkeypatch):
    """Lists of ids don't pile up for a whole slice of texts (the garbage collector goes through
    them), nor does the library get a long text as one, on which it is slow."""
    from lagframe.llm import pieces

    held, given = [], []
    plain = PieceCoder.encode_unit
    monkeypatch.setattr(PieceCoder, "encode_unit", lambda self, unit: held.append(len(self.ready)) or plain(self, unit))
    coder = PieceCoder(piece_model())
    library = coder.library

    class Spy:
        def encode(self, texts, **how):
            given.extend(texts)
            return library.encode(texts, **how)

    coder.library = Spy()
    rng = random.Random(14)
    words = ["".join(rng.choice("abcdefgh.é") for _ in range(8)) for _ in range(10_000)]
    text = " ".join(words) + "  "
    assert coder.encode(text) == library.encode(text)
    coder.verify()
    assert max(held) <= pieces.ROWS
    assert max(t.count(" ") for t in given) <= 200
    assert {k for t in given for k in t.split(" ")} >= set(words)
    # also if known stretches lie between new ones
    given.clear()
    mixed = [w for pair in zip(words[:3000], (w + "x" for w in words[:3000]), strict=True) for w in pair]
    assert coder.encode(" ".join(mixed)) == library.encode(" ".join(mixed))
    coder.verify()
    assert max(t.count(" ") for t in given) <= 200 and {k for t in given for k in t.split(" ")} >= set(mixed[1::2])
