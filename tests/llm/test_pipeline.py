"""The pipeline against its stages' brute-force versions, stage by stage, on sf0.001."""

import hashlib

import corpus_pipeline as P
import sentencepiece
from lagframe.llm.mixing import pareto_mix
from lagframe.llm.queries import QUERIES, piece_model
from lagframe.llm.quality import quality_scores

from .test_mix_ring_urls import shares
from .test_near_and_repeats import brute_near, brute_repeats

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    assert len(P.STAGES) == 5 and sum(name.startswith("op") for name in QUERIES) == 13
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    steps = []
    for _, stage in P.STAGES:
        docs = P.cut(stage(spark, docs, SF), "test-stage")
        steps.append(docs)
    quality, near, repeats, mix, encoded = steps
    for step in steps[:-1]:
        assert step.columns == list(P.COLUMNS)
    given = spark.read.parquet(f"{SF}/documents.parquet")
    scores = {r.doc_id: r.predicted for r in quality_scores(given, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    kept = [(r.doc_id, r.text) for r in quality.collect()]
    assert sorted(i for i, _ in kept) == sorted(i for i, p in scores.items() if p)
    single = sorted(i for i, (_, _, first) in brute_near(kept).items() if first)
    rows = [(r.doc_id, r.text) for r in near.collect()]
    assert sorted(i for i, _ in rows) == single
    want = {i: (n - gone) for i, n, gone, _, _ in brute_repeats(rows, 200)}
    for r in repeats.collect():
        assert 0 <= want[r.doc_id] - len(r.text.encode()) <= 6 * 40 and r.n_chars == len(r.text)
    sizes, taken = {}, {}
    for r in repeats.collect():
        sizes[r.source] = sizes.get(r.source, 0) + len(r.text.encode().split())
    for r in mix.collect():
        taken[r.source] = taken.get(r.source, 0) + len(r.text.encode().split())
    longest = max(len(r.text.encode().split()) for r in repeats.collect())
    for s, target in shares(sizes).items():
        assert abs(taken.get(s, 0) - target) <= longest
    library = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    codes = sorted((r.doc_id, hashlib.sha256(",".join(map(str, library.encode(r.text))).encode()).hexdigest()) for r in mix.collect())
    assert sorted((r.doc_id, r.ids_sha256) for r in encoded.collect()) == codes
    assert sorted(map(tuple, P.run(spark, SF).collect())) == sorted(map(tuple, encoded.collect()))


def test_empty_and_odd_documents(spark, tmp_path):
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    for rows in ([], [(None, None, None, None, None, "x"), (1, "", "en", "s", 0, "x"), (1, "", "en", "s", 0, "x"), (2, "a b " * 4000, None, None, None, "x")]):
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, copies string")
        for name, stage in P.STAGES:
            docs = P.cut(stage(spark, docs, str(tmp_path)), "test-odd")
            assert docs.count() <= 3 * max(1, len(rows)), name


def test_near_dedup_by_row(spark):
    """Copies with repeated or null ids leave one row; an id's other text stays."""
    text = {c: " ".join(f"{c}{i}" for i in range(90)) for c in "abcdef"}
    rows = [
        (1, text["a"]), (1, text["a"]), (1, text["a"]),  # stored three times under its id
        (None, text["b"]), (None, text["b"]),
        (None, text["c"]), (7, text["c"]), (6, text["c"] + " end"),
        (2, text["d"]), (3, text["d"]), (3, text["e"]),  # id 3: a copy, and a text of its own
        (4, None), (None, ""), (5, text["f"]),
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    near = P.cut(P.near_dedup(spark, docs, SF), "test-near")
    want = sorted([(1, text["a"]), (None, text["b"]), (6, text["c"] + " end"), (2, text["d"]), (3, text["e"]), (4, None), (None, ""), (5, text["f"])], key=str)
    assert near.columns == list(P.COLUMNS)
    assert sorted(((r.doc_id, r.text) for r in near.collect()), key=str) == want
    left = P.repeats(spark, near, SF).collect()
    assert sorted(((r.doc_id, r.text) for r in left), key=str) == sorted(((i, t or "") for i, t in want), key=str)


def test_mix_by_row(spark):
    """Rows without an id or with a repeated one are mixed one by one, as the operator does."""
    rows = [(None, "w " * (5 + i % 40), "en", "a" if i % 3 else "b", i) for i in range(300)]
    rows += [(i, "v " * (3 + i % 30), "en", "c", i) for i in range(400)] + [(3, "u " * 11, "en", "c", 0)] * 4
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    mixed = P.mix(spark, docs, SF).collect()
    want = pareto_mix(docs).collect()
    taken = {}
    for r in mixed:
        taken[r.source] = taken.get(r.source, 0) + len(r.text.split())
    assert taken == {s: sum(r.taken for r in want if r.source == s) for s in "abc"}
    assert len(mixed) == sum(r.copies for r in want)
