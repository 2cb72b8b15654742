"""Repair of the turn structure of conversations by parallel Viterbi with rank convergence.

A repaired conversation reads, by the initials of its roles, ``(s?(ua)+)?``: an automaton of four
states, so the cost of finishing from each state is a vector of four numbers, and each row maps
the vector behind it to the one before it (minimum over its edits). Conversations are cut into
chunks, which all run backward at once: a conversation's last chunk from the true final vector,
the others from the same vector as a speculation. Vectors that differ by a constant lead to the
same edits, and such maps soon forget how they began, so a chunk's first vector is mostly right
whatever it began with. Fix-up passes compare what each chunk began with to what its
successor found (both less their smallest number), and run a chunk again from its end until its
vectors meet the old ones; they stop when nothing differs. The stitched vectors then drive the
tracing, which takes the ASCII-least edit among the cheapest ones, row by row.
"""

from __future__ import annotations

import functools
import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import cut, text_slices

CHUNK = 1 << 12  # rows of a chunk at most
SLICE = 1 << 22  # bytes of texts that are held at a time
SPACE = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, UNFINISHED = 0, 3, 4, 3, 3  # costs

START, SYSTEM, USER, ASSISTANT = range(4)  # states: what was written last
FINAL = bytes((0, 6, 3, 0))  # cost of inserting what is still due
TAIL = ("", "II", "I", "")
WRITTEN = {USER: "user", ASSISTANT: "assistant"}
NEW_ROLE = (USER, USER, ASSISTANT, USER)  # state behind a rerole or an insert, by state before
KEPT = ({START: SYSTEM}, {START: USER, SYSTEM: USER, ASSISTANT: USER}, {USER: ASSISTANT}, {})
INITIALS = ("s", "u", "a")  # a code's lower two bits; 3: any other role
FINE, TRUNCATED, BLANK, DUPLICATE = range(4)  # a code's upper two bits
FAULTS = (None, "truncated", "blank", "duplicate")
LEGAL = {(0, 1), (1, 2), (2, 1)}


@functools.lru_cache(maxsize=1 << 16)
def step(behind: bytes, code: int) -> tuple[bytes, tuple[tuple[str, int], ...]]:
    """One row backward: the vector before it (less its smallest number) and, for each state, the
    least of the cheapest edits (inserts before the row included) and the state behind them."""
    fault = code >> 2
    if fault >= BLANK:
        return behind, tuple(("D", s) for s in range(4))
    due = UNFINISHED if fault == TRUNCATED else 0
    kept = KEPT[code & 3]
    cost = []
    for s in range(4):
        found = min(DELETE + behind[s], REROLE + due + behind[NEW_ROLE[s]])
        cost.append(min(found, KEEP + due + behind[kept[s]]) if s in kept else found)
    user, assistant = cost[USER], cost[ASSISTANT]
    cost[USER], cost[ASSISTANT] = min(user, INSERT + assistant), min(assistant, INSERT + user)
    cost[START], cost[SYSTEM] = (min(cost[s], INSERT + cost[USER]) for s in (START, SYSTEM))
    moves = []
    for s in range(4):
        edits = ""
        while True:
            if DELETE + behind[s] == cost[s]:
                moves.append((edits + "D", s))
            elif INSERT + cost[NEW_ROLE[s]] == cost[s]:
                edits, s = edits + "I", NEW_ROLE[s]
                continue
            elif s in kept and KEEP + due + behind[kept[s]] == cost[s]:
                moves.append((edits + "K", kept[s]))
            else:
                moves.append((edits + "R", NEW_ROLE[s]))
            break
    low = min(cost)
    return bytes(c - low for c in cost), tuple(moves)


def backward(codes: bytes, end: bytes, old: bytes | None = None, old_start: bytes | None = None) -> tuple[bytes, bytes]:
    """(vectors behind each row, 4 bytes each; vector before the first row) from the vector
    ``end``. With the ``old`` result of another end the run stops where it meets that."""
    vectors, v = bytearray(old) if old is not None else bytearray(4 * len(codes)), end
    for i in range(len(codes) - 1, -1, -1):
        vectors[4 * i : 4 * i + 4] = v
        v = step(v, codes[i])[0]
        if old is not None and v == (old[4 * i - 4 : 4 * i] if i else old_start):
            return bytes(vectors), old_start
    return bytes(vectors), v


VECTORS = "first_at long, next_at long, codes binary, vectors binary, start binary"


def _speculate(batches):
    for batch in batches:
        first, following, codes = (batch.column(i).to_pylist() for i in range(3))
        codes = [bytes(c) for c in codes]
        found = [backward(c, FINAL) for c in codes]
        cols = [pa.array(first, pa.int64()), pa.array(following, pa.int64()), pa.array(codes, pa.binary()), pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.binary())]
        yield pa.RecordBatch.from_arrays(cols, ["first_at", "next_at", "codes", "vectors", "start"])


def _fix_up(batches):
    for batch in batches:
        rows = batch.to_pylist()
        for r in rows:
            if r["want"] is not None and r["want"] != r["vectors"][-4:]:
                r["vectors"], r["start"] = backward(r["codes"], r["want"], r["vectors"], r["start"])
            del r["want"]
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("first_at", pa.int64()), ("next_at", pa.int64()), *[(n, pa.binary()) for n in ("codes", "vectors", "start")]]))


def _true_vectors(chunks: DataFrame) -> DataFrame:
    """Chunks with the vectors behind their rows, right but for a constant."""
    guess = cut(chunks.select("first_at", "next_at", "codes").mapInArrow(_speculate, VECTORS), "repair-speculated")
    alone = guess.join(chunks.filter("chunks = 1").select("first_at"), "first_at", "left_semi")
    linked = cut(guess.join(chunks.filter("chunks > 1").select("first_at"), "first_at", "left_semi"), "repair-linked")
    while True:
        heads = linked.select(F.col("first_at").alias("next_at"), F.col("start").alias("want"))
        met = linked.join(heads, "next_at", "left").select("first_at", "next_at", "codes", "vectors", "start", "want")
        if met.filter("want is not null and want <> substring(vectors, -4, 4)").isEmpty():
            return alone.unionByName(linked)
        linked = cut(met.mapInArrow(_fix_up, VECTORS), "repair-linked")


def ordered_rows(convs: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows in the order of conversation, turn (nulls first), role and text, numbered by ``at``;
    written as a table. Equal rows are dealt by their place in the input, so that no range
    becomes hot; null roles and texts read as one space."""
    rows = convs.select(
        F.col(id_col).alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("text"),
        F.monotonically_increasing_id().alias("place"),
    )
    order = ("conv_id", "turn", "role", "text", "place")
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    trimmed = F.rtrim(F.col("text"), F.lit(SPACE))
    fault = F.when(trimmed == "", BLANK).when(F.right(trimmed, F.lit(1)).isin(".", "!", "?"), FINE).otherwise(TRUNCATED)
    same = F.unhex(F.md5(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text")))
    return cut(rows.select("conv_id", "at", "turn", "role", "text", kind.alias("kind"), fault.alias("fault"), same.alias("same")), "repair-rows")


def _chunks(rows: DataFrame) -> DataFrame:
    """Chunks of at most ``CHUNK`` rows in order, with their rows' codes and their successors."""
    first = rows.groupBy("conv_id", "same").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("new"))
    fault = F.when(F.col("fault") == BLANK, BLANK).when(F.col("new").isNull(), DUPLICATE).otherwise(F.col("fault"))
    coded = rows.select("conv_id", "at", "kind", "fault").join(first, "at", "left")
    coded = coded.withColumn("code", (F.col("kind") + 4 * fault).cast("byte"))
    chunk = F.floor(F.col("at") / CHUNK).alias("chunk")
    held = coded.groupBy("conv_id", chunk).agg(F.sort_array(F.collect_list(F.struct("at", "code"))).alias("held"))
    held = held.select("conv_id", "chunk", F.col("held")[0]["at"].alias("first_at"), F.transform("held", lambda x: x["code"]).alias("codes"))
    of = Window.partitionBy("conv_id")
    return cut(
        held.withColumn("next_at", F.lead("first_at").over(of.orderBy("first_at"))).withColumn("chunks", F.count(F.lit(1)).over(of)),
        "repair-chunks",
    )


def _stream(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """Each conversation's chunks, every chunk before its rows, in one partition and in order.
    A record without chunk and row stands for every id."""
    chunks = _chunks(rows)
    solved = chunks.select("conv_id", "chunk", "first_at").join(_true_vectors(chunks).select("first_at", "codes", "vectors"), "first_at")
    none = lambda kind: F.lit(None).cast(kind)
    ids = convs.select("conv_id").distinct().select("conv_id", F.lit(-1).cast("long").alias("chunk"), none("long").alias("at"), none("long").alias("turn"), none("string").alias("role"), none("string").alias("text"), none("binary").alias("codes"), none("binary").alias("vectors"))
    heads = solved.select("conv_id", "chunk", none("long").alias("at"), none("long").alias("turn"), none("string").alias("role"), none("string").alias("text"), "codes", "vectors")
    bodies = rows.select("conv_id", F.floor(F.col("at") / CHUNK).alias("chunk"), "at", "turn", "role", "text", none("binary").alias("codes"), none("binary").alias("vectors"))
    return ids.unionByName(heads).unionByName(bodies).repartition("conv_id").sortWithinPartitions("conv_id", "chunk", F.col("at").asc_nulls_first())


def _edits(batches):
    """(conv_id, code, turn, edit, role, text) of each edit, in order; edit None begins a
    conversation. Inserts have neither code nor turn."""
    conv, state, at, codes, vectors = None, None, 0, b"", b""

    def tail():
        s = state
        for edit in TAIL[s]:
            s = NEW_ROLE[s]
            yield conv, None, None, edit, WRITTEN[s], ""

    for batch in batches:
        ids, chunks, places, turns, roles = (batch.column(i).to_pylist() for i in range(5))
        all_codes, all_vectors = batch.column(6).to_pylist(), batch.column(7).to_pylist()
        texts = (t for _, _, held in text_slices(batch.column(5), SLICE) for t in held)
        for i, text in enumerate(texts):
            if chunks[i] < 0:
                if state is not None:
                    yield from tail()
                conv, state = ids[i], START
                yield conv, None, None, None, None, None
            elif places[i] is None:
                codes, vectors, at = all_codes[i], all_vectors[i], 0
            else:
                code = codes[at]
                edits, state_behind = step(vectors[4 * at : 4 * at + 4], code)[1][state]
                at += 1
                for edit in edits[:-1]:
                    state = NEW_ROLE[state]
                    yield conv, None, None, edit, WRITTEN[state], ""
                state = state_behind
                yield conv, code, turns[i], edits[-1], WRITTEN[state] if edits[-1] == "R" else roles[i], text.decode("utf-8", "replace")
    if state is not None:
        yield from tail()


def _edit_rows(kind):
    def run(batches):
        rows, held, place = [], 0, 0
        names = ["conv_id", "place", "turn", "edit", "fault", "role", "text"]
        kinds = [kind, pa.int64(), pa.int64(), *[pa.string()] * 4]

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        for conv, code, turn, edit, role, text in _edits(batches):
            if edit is None:
                place = 0
                continue
            rows.append((conv, place, turn, edit, None if code is None else FAULTS[code >> 2], role, text))
            place, held = place + 1, held + len(text)
            if held > SLICE or len(rows) > 10_000:
                yield batch()
                rows, held = [], 0
        if rows:
            yield batch()

    return run


class _Digest:
    """What is reported of one conversation, from its edits in order."""

    def __init__(self, conv):
        self.conv, self.faults, self.illegal, self.cost, self.audit = conv, [0] * 4, 0, 0, []
        self.sha, self.written, self.before = hashlib.sha256(), False, None
        self.low = self.high = None
        self.turns = 0

    def add(self, code, turn, edit, role, text):
        self.audit.append(edit)
        self.cost += {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}[edit]
        if code is not None:
            fault, kind = code >> 2, code & 3
            self.faults[fault] += 1
            self.cost += UNFINISHED if fault == TRUNCATED and edit != "D" else 0
            self.illegal += self.before is not None and (self.before, kind) not in LEGAL
            self.before = kind
            if turn is not None and turn != self.high:
                self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        if edit != "D":
            self.sha.update(("\n" if self.written else "").encode() + f"{role}:{text}".encode())
            self.written = True

    def row(self):
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return (self.conv, gaps, self.faults[BLANK], self.faults[DUPLICATE], self.faults[TRUNCATED], self.illegal, self.cost, "".join(self.audit), self.sha.hexdigest())


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _digests(kind):
    def run(batches):
        names = ["conv_id", *COUNTS, "audit", "repaired_sha256"]
        kinds = [kind, *[pa.int64()] * len(COUNTS), pa.string(), pa.string()]

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        rows, now = [], None
        for conv, code, turn, edit, role, text in _edits(batches):
            if edit is None:
                if now is not None:
                    rows.append(now.row())
                now = _Digest(conv)
                if len(rows) >= 1000:
                    yield batch(rows)
                    rows = []
            else:
                now.add(code, turn, edit, role, text)
        if now is not None:
            yield batch([*rows, now.row()])

    return run


def _prepared(convs: DataFrame, ids: DataFrame | None):
    kind = convs.schema["conv_id"].dataType
    if not isinstance(kind, (T.LongType, T.IntegerType, T.StringType)):
        raise TypeError("conv_id must be a whole number or a string")
    convs = convs.withColumn("conv_id", F.col("conv_id").cast("long")) if isinstance(kind, T.IntegerType) else convs
    ids = (convs if ids is None else ids).select(F.col("conv_id").cast(convs.schema["conv_id"].dataType).alias("conv_id"))
    arrow = pa.string() if isinstance(kind, T.StringType) else pa.int64()
    return _stream(ids, ordered_rows(convs)), arrow, convs.schema["conv_id"].dataType.simpleString()


def repair_edits(convs: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """The cheapest edits of each conversation, one per row: ``conv_id``, ``place`` in the script
    from 0, ``turn`` (null for inserts), ``edit`` (K keep, R rerole, D delete, I insert),
    ``fault`` (null, truncated, blank, duplicate), ``role`` and ``text`` (of a deleted row as it
    was). The repaired conversation is the rows whose edit is not D.

    ``convs``: conv_id, turn, role, text. Rows go by turn, nulls first, ties by role, then text;
    null roles and texts read as one space; a null conv_id is a conversation of its own; an
    empty or unknown role cannot be kept. Equal rows and equal texts of one role after the first
    are duplicates (told by a 128-bit digest). An empty table gives no rows; extra columns are
    ignored. Long conversations are cut into chunks of ``CHUNK`` rows for the costs; the rows of
    one conversation pass one task as a stream, never held. There are as many fix-up
    passes as consecutive chunks whose vectors do not converge, commonly one.
    """
    stream, arrow, kind = _prepared(convs, ids)
    return stream.mapInArrow(_edit_rows(arrow), f"conv_id {kind}, place long, turn long, edit string, fault string, role string, text string")


def repair_report(convs: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """One row per conversation of ``ids`` (default: of ``convs``): ``conv_id``, ``gaps``
    (turn numbers missing between the first and the last), the first faults of its rows
    ``blank``, ``duplicate``, ``truncated``, ``illegal`` (adjacent roles other than
    system-user, user-assistant, assistant-user), and of the cheapest edits ``cost``, ``audit``
    (their initials) and ``repaired_sha256`` (of the repaired ``role:text`` lines). Folds the
    same edits as ``repair_edits``, under the same rules; ids without rows give zeros, an empty
    audit and the digest of nothing."""
    stream, arrow, kind = _prepared(convs, ids)
    return stream.mapInArrow(_digests(arrow), f"conv_id {kind}, {', '.join(f'{c} long' for c in COUNTS)}, audit string, repaired_sha256 string")


def damage(convs: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Rows damaged by ``crc32(conv_id:turn) % 20`` (nulls: one space): 0 drops the row, 1
    empties its text, 2 removes its ``[.!?]``, 3 repeats it, 4 sets its role to user."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    how = F.crc32(F.concat(text(conv_col), F.lit(":"), text("turn"))) % 20
    rows = convs.select(F.col(conv_col).alias("conv_id"), "turn", text("role").alias("role"), text("text").alias("text"), how.alias("how")).filter("how <> 0")
    rows = rows.withColumn("text", F.when(F.col("how") == 1, "").when(F.col("how") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")))
    rows = rows.withColumn("role", F.when(F.col("how") == 4, "user").otherwise(F.col("role")))
    return rows.withColumn("copy", F.explode(F.when(F.col("how") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).select("conv_id", "turn", "role", "text")
