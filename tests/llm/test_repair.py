"""op11 against exhaustive search over edit scripts, with odd rows and short chunks."""

import functools
import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from lagframe.llm import repair
from lagframe.llm.repair import damage, repair_edits, repair_report

SCHEMA = "conv_id long, turn long, role string, text string"
SPACES = " \t\n\x0b\x0c\r"


def brute(rows):
    """Report of one conversation's rows (turn, role, text) as dealt, by trying every edit."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    faults, seen = [], set()
    for _, role, text in rows:
        body = text.strip(SPACES)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if text.rstrip(SPACES)[-1] not in ".!?" else None)
        seen.add((role, text))
    after = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    names = {"u": "user", "a": "assistant"}

    @functools.cache
    def best(i, state, inserts):
        found = []
        if i == len(rows):
            if state in ("", "a"):
                found.append((0, "", ()))
        else:
            _, role, text = rows[i]
            cost, audit, out = best(i + 1, state, 2)
            found.append((4 + cost, "D" + audit, out))
            if faults[i] in (None, "truncated"):
                due = 3 if faults[i] else 0
                if role[:1] and role[:1] in after[state]:
                    cost, audit, out = best(i + 1, role[:1], 2)
                    found.append((due + cost, "K" + audit, (f"{role}:{text}", *out)))
                for to in set(after[state]) & set(names):
                    cost, audit, out = best(i + 1, to, 2)
                    found.append((3 + due + cost, "R" + audit, (f"{names[to]}:{text}", *out)))
        if inserts:
            for to in set(after[state]) & set(names):
                cost, audit, out = best(i, to, inserts - 1)
                found.append((3 + cost, "I" + audit, (f"{names[to]}:", *out)))
        return min(found, default=(10**9, "", ()))

    cost, audit, out = best(0, "", 2)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:], strict=False)]
    counts = [faults.count(k) for k in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def conversations(seed, n, longest=14):
    r = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "", " \n", "cut off", "Fine. ", None, "é", "ok.\t"]
    roles = ["user", "assistant"] * 4 + ["system", "tool", "", None, "User"]
    rows = []
    for c in range(n):
        tidy = r.random() < 0.3
        for t in range(r.randint(1, longest)):
            turn = None if r.random() < 0.05 else t + r.choice([0, 0, 0, 1, 3])
            rows.append((c, turn, ("user", "assistant")[t % 2] if tidy else r.choice(roles), f"Text {t}." if tidy and r.random() < 0.8 else r.choice(texts)))
    return rows


def by_conversation(rows):
    held = {}
    for c, *row in rows:
        held.setdefault(c, []).append(tuple(row))
    return held


@pytest.mark.parametrize("chunk", [repair.CHUNK, 3])
def test_report_equals_exhaustive_search(spark, monkeypatch, chunk):
    monkeypatch.setattr(repair, "CHUNK", chunk)
    rows = conversations(1, 120)
    found = repair_report(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert {x[0]: tuple(x[1:]) for x in found.collect()} == {c: brute(r) for c, r in by_conversation(rows).items()}


def test_long_conversation_over_many_chunks(spark, monkeypatch):
    """Chunks whose vectors do not converge (unknown roles only) take more fix-up passes."""
    monkeypatch.setattr(repair, "CHUNK", 8)
    r = random.Random(4)
    rows = [(1, t, r.choice(["user", "assistant", "tool", "user"]), f"T{t}" + r.choice(".x")) for t in range(120)]
    rows += [(2, t, "tool", f"T{t}.") for t in range(41)] + [(3, t, "user", "Same.") for t in range(60)]
    found = repair_report(spark.createDataFrame(rows, SCHEMA))
    assert {x[0]: tuple(x[1:]) for x in found.collect()} == {c: brute(v) for c, v in by_conversation(rows).items()}


def test_backward_stops_where_vectors_meet():
    r = random.Random(5)
    for _ in range(300):
        codes = bytes(r.choice([0, 1, 2, 3, 4, 5, 6, 7, 9, 14]) for _ in range(r.randint(1, 30)))
        old, start = repair.backward(codes, repair.FINAL)
        end = repair.step(repair.FINAL, r.choice([0, 1, 2, 3]))[0]
        assert repair.backward(codes, end, old, start) == repair.backward(codes, end)


def test_edits_are_the_audit_and_the_repaired_text(spark):
    rows = conversations(6, 40)
    df = spark.createDataFrame(rows, SCHEMA)
    report = {x.conv_id: x for x in repair_report(df).collect()}
    held = {}
    for x in repair_edits(df).orderBy("conv_id", "place").collect():
        held.setdefault(x.conv_id, []).append(x)
    assert set(held) == set(report)
    for c, edits in held.items():
        assert [x.place for x in edits] == list(range(len(edits)))
        assert "".join(x.edit for x in edits) == report[c].audit
        left = "\n".join(f"{x.role}:{x.text}" for x in edits if x.edit != "D")
        assert hashlib.sha256(left.encode()).hexdigest() == report[c].repaired_sha256


def test_damage_and_ids_without_rows(spark):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}. Yes!") for c in range(60) for t in range(4)]
    rows += [(None, 1, "user", "x."), (None, None, None, None), (99, 0, "user", "gone.")]
    rows += [(c, 0, "user", "Only.") for c in range(100, 160)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("at", F.lit("x")).withColumn("chunk", F.lit("x"))
    want = {}
    for c, t, role, text in rows:
        role, text = role or " ", text or " "
        how = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        held = want.setdefault(c, [])
        if how:
            text = "" if how == 1 else text.translate({ord(x): None for x in ".!?"}) if how == 2 else text
            held += [(t, "user" if how == 4 else role, text)] * (2 if how == 3 else 1)
    found = {x[0]: tuple(x[1:]) for x in repair_report(damage(df), ids=df).collect()}
    assert found == {c: brute(r) for c, r in want.items()}
    empty = hashlib.sha256(b"").hexdigest()
    assert any(x == (0, 0, 0, 0, 0, 0, "", empty) for x in found.values())


def test_empty_table_and_text_keys(spark):
    none = repair_report(spark.createDataFrame([], SCHEMA))
    assert none.count() == 0 and none.columns == ["conv_id", *repair.COUNTS, "audit", "repaired_sha256"]
    assert repair_edits(spark.createDataFrame([], SCHEMA)).count() == 0
    named = spark.createDataFrame([("a", 0, "user", "Hi. " * 100_000), ("a", 1, "assistant", "Yes.")], SCHEMA.replace("conv_id long", "conv_id string"))
    assert repair_report(named).select("conv_id", "audit", "cost").collect() == [("a", "KK", 0)]
