"""Prefix trie of conversations from ternary search trees per range shard.

Turns (role and text) get whole numbers from a dictionary, conversations become sequences of them,
equal sequences one weighted sequence. Sequences are dealt to range shards in lexicographic
order. Each shard inserts its sequences into a ternary search tree, the median first, then the
medians of both halves, so that the searches among siblings stay balanced without rotations; a
loop from the youngest node to the eldest adds up members, leaves and savings. Only
the nodes on the paths to a shard's first and last sequence can occur in other shards: they are
handed on as partial sums, merged by a digest of their path, and added up over their ancestors.

Sequences longer than ``BLOCK`` turns go block by block: a block's tree hangs on the node at
which the block before ended. Behind the point where a sequence is alone its nodes are written
down at once, so there are as many rounds as blocks that different sequences share, mostly one.
"""

from __future__ import annotations

import hashlib
from array import array

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut

BLOCK = 256  # turns of a sequence that one tree sees at most
SHARD = 1 << 17  # turns of a range shard, about
RUN = 4096  # ids of equal sequences that travel in one row
ROWS = 10_000  # node rows of an Arrow batch
WRAP = (1 << 61) - 1
NOTHING = hashlib.sha256(b"").hexdigest()


# ---- sequences ---------------------------------------------------------------------------------


def numbered_turns(convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, pieces) of rows (conv_id, turn, role, text) in the order of turn (nulls first),
    role and text. Turns, a table: ``conv_id``, ``at`` (place in the whole order), ``same`` (a
    128-bit digest of role and text) and ``words``. Pieces: for each conversation and range of
    the order, what to add to ``at`` for the position in the conversation, and its length."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = convs.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text("role").alias("role"), text("text").alias("text"), F.monotonically_increasing_id().alias("place")).filter("conv_id is not null")
    order = ("conv_id", "turn", "role", "text", "place")
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    same = F.unhex(F.md5(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text")))
    words = F.regexp_count("text", F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")
    turns = cut(rows.select("conv_id", "at", same.alias("same"), words.alias("words")), "trie-ordered")
    of = Window.partitionBy("conv_id")
    held = turns.groupBy("conv_id", _range("at").alias("range")).agg(F.min("at").alias("low"), F.count(F.lit(1)).alias("held"))
    before = F.coalesce(F.sum("held").over(of.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    pieces = held.select("conv_id", "range", (before - F.col("low")).alias("shift"), F.sum("held").over(of).alias("length"), (before == 0).alias("first"))
    return turns, cut(pieces, "trie-pieces")


def _range(at: str) -> Column:
    """Number of the partition in which ``at`` was dealt."""
    return F.shiftright(at, 33)


def rebuilt(convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, ids) for ``prefix_trie``: each conversation c as the first h turns of conversation
    c - c % 20 (all if it has fewer, none if there is none) and its own turns behind its first h,
    where h = crc32(decimal c) % 4."""
    numbered, pieces = numbered_turns(convs)
    lengths = pieces.filter("first").select("conv_id", "length")
    plan = lengths.withColumn("h", F.crc32(F.col("conv_id").cast("string")) % 4).withColumn("base", F.expr("conv_id - conv_id % 20"))
    bases = lengths.filter("conv_id % 20 = 0").select(F.col("conv_id").alias("base"), F.col("length").alias("lent"))
    plan = plan.join(bases, "base", "left").withColumn("lent", F.least("h", F.coalesce("lent", F.lit(0))))
    plan = cut(plan.withColumn("n", F.col("lent") + F.greatest(F.col("length") - F.col("h"), F.lit(0))), "trie-plan")
    codes = cut(numbered.select("same").distinct(), "trie-codes").withColumn("tid", F.monotonically_increasing_id())
    codes = cut(codes, "trie-dictionary")
    coded = numbered.join(codes, "same").withColumn("range", _range("at"))
    placed = pieces.select("conv_id", "range", "shift").join(plan.select("conv_id", "h", "lent", "n"), "conv_id")
    turns = cut(coded.join(placed, ["conv_id", "range"]).select("conv_id", (F.col("at") + F.col("shift")).alias("pos"), "tid", "words", "h", "lent", "n"), "trie-turns")
    own = turns.filter("pos >= h").select("conv_id", "n", (F.col("pos") - F.col("h") + F.col("lent")).alias("pos"), "tid", "words")
    heads = turns.filter("conv_id % 20 = 0 and pos < 3").select(F.col("conv_id").alias("base"), "pos", "tid", "words")
    lent = plan.filter("lent > 0").select("base", "conv_id", "h", "n").join(heads, "base").filter("pos < h")
    return own.unionByName(lent.select("conv_id", "n", "pos", "tid", "words")), plan.select("conv_id")


def plain(convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, ids) for ``prefix_trie``: the conversations as they are."""
    numbered, pieces = numbered_turns(convs)
    codes = cut(numbered.select("same").distinct(), "trie-codes").withColumn("tid", F.monotonically_increasing_id())
    coded = numbered.join(cut(codes, "trie-dictionary"), "same").withColumn("range", _range("at"))
    lengths = pieces.filter("first").select("conv_id", F.col("length").alias("n"))
    placed = pieces.select("conv_id", "range", "shift").join(lengths, "conv_id")
    turns = coded.join(placed, ["conv_id", "range"]).select("conv_id", "n", (F.col("at") + F.col("shift")).alias("pos"), "tid", "words")
    return turns, lengths.select("conv_id")


# ---- equal sequences ---------------------------------------------------------------------------


def _runs(batches):
    """Rows in order of (sequence, id) -> runs of at most ``RUN`` ids of a sequence."""
    key, ids = None, []
    out = []

    def flush():
        nonlocal out
        batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.binary(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["sequence", "first", "held", "ids"])
        out = []
        return batch

    for batch in batches:
        for k, i in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if k != key or len(ids) >= RUN:
                if ids:
                    out.append((key, ids[0], len(ids), ",".join(map(str, ids))))
                    if len(out) >= ROWS:
                        yield flush()
                key, ids = k, []
            ids.append(i)
    if ids:
        out.append((key, ids[0], len(ids), ",".join(map(str, ids))))
    if out:
        yield flush()


def _sums(batches):
    """Runs in order of (sequence, first id) -> each sequence's members, smallest id, digest."""
    key, sha, first, members, out = None, None, None, 0, []

    def flush():
        nonlocal out
        batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.string()), strict=True)], ["conv_id", "members", "ends"])
        out = []
        return batch

    for batch in batches:
        for k, low, held, ids in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if k != key:
                if members:
                    out.append((first, members, sha.hexdigest()))
                    if len(out) >= ROWS:
                        yield flush()
                key, sha, first, members = k, hashlib.sha256(), low, 0
            sha.update((("," if members else "") + ids).encode())
            members += held
    if members:
        out.append((first, members, sha.hexdigest()))
    if out:
        yield flush()


def _groups(sequences: DataFrame) -> DataFrame:
    """Equal sequences: ``conv_id`` (the smallest), ``members`` and ``ends`` (SHA-256 of the
    ids, ascending). A large group is dealt by id too, and its runs pass one task as a stream."""
    runs = sequences.select("sequence", "conv_id").repartitionByRange("sequence", "conv_id").sortWithinPartitions("sequence", "conv_id")
    runs = runs.mapInArrow(_runs, "sequence binary, first long, held long, ids string")
    return runs.repartition("sequence").sortWithinPartitions("sequence", "first").mapInArrow(_sums, "conv_id long, members long, ends string")


# ---- trees of the shards -----------------------------------------------------------------------


class TernaryTree:
    """Ternary search tree of sequences of whole numbers. Node 0 is the root; every node has its
    trie parent ``up``, its number ``key``, smaller and larger siblings ``low`` and ``high``, and
    the first of its children's sibling tree, ``down``."""

    def __init__(self):
        self.up, self.key, self.low, self.high, self.down = (array("q", [-1]) for _ in range(5))
        self.depth, self.words = array("q", [0]), array("q", [0])

    def _new(self, up: int, key: int, words: int) -> int:
        for column, value in ((self.up, up), (self.key, key), (self.low, -1), (self.high, -1), (self.down, -1), (self.depth, self.depth[up] + 1), (self.words, words)):
            column.append(value)
        return len(self.up) - 1

    def insert(self, keys, words) -> int:
        """The node of the sequence, new where it is missing."""
        node, key, low, high, down = 0, self.key, self.low, self.high, self.down
        for k, w in zip(keys, words, strict=True):
            at = down[node]
            if at < 0:
                at = down[node] = self._new(node, k, w)
            else:
                while k != key[at]:
                    side = low if k < key[at] else high
                    if side[at] < 0:
                        side[at] = self._new(node, k, w)
                    at = side[at]
            node = at
        return node


def medians(n: int):
    """0 to n - 1, the middle first, then the middles of both halves, and so on."""
    spans = [(0, n)]
    while spans:
        lo, hi = spans.pop()
        if lo < hi:
            mid = (lo + hi) // 2
            yield mid
            spans += [(mid + 1, hi), (lo, mid)]


NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string, words long, path binary, parent_path binary, line array<binary>"
NODE_ARROW = [pa.int64()] * 7 + [pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.binary())]
NODE_NAMES = [c.split()[0] for c in NODE.split(", ")]


def _tree_rows(group: list[tuple], first: bool, last: bool, above: int):
    """Node rows of the sequences of one root in one shard, in lexicographic order. ``first``
    and ``last``: whether the group holds the shard's first and last sequence, whose paths
    other shards may share. Such nodes, and the root, carry partial sums and their path."""
    tree, end = TernaryTree(), [0] * len(group)
    for i in medians(len(group)):
        end[i] = tree.insert(group[i][1], group[i][2])
    n, up = len(tree.up), tree.up
    members, children, leaves, saved = (array("q", bytes(8 * n)) for _ in range(4))
    conv, ends = [None] * n, {}
    for node, (_, _, _, smallest, count, digest, below_children, below_leaves, below_saved, _) in zip(end, group, strict=True):
        members[node] += count
        conv[node] = smallest if conv[node] is None else min(conv[node], smallest)
        if digest is not None:
            ends[node] = digest
        children[node] += below_children or 0
        leaves[node] += below_leaves or 0
        saved[node] += below_saved or 0
    shared = {0}
    for node in ([end[0]] if first else []) + ([end[-1]] if last else []):
        while node:
            shared.add(node)
            node = up[node]
    for node in range(n - 1, 0, -1):  # children are younger than their parents
        parent = up[node]
        if node not in shared:
            if not children[node]:
                leaves[node] = 1
            saved[node] += (members[node] - 1) * tree.words[node]
            children[parent] += 1
            leaves[parent] += leaves[node]
            saved[parent] += saved[node]
        members[parent] += members[node]
        conv[parent] = conv[node] if conv[parent] is None else min(conv[parent], conv[node])
    path = {0: hashlib.blake2b(group[0][0], digest_size=16).digest()}
    line = {0: [path[0]]}
    for node in sorted(shared - {0}):
        path[node] = hashlib.blake2b(path[up[node]] + tree.key[node].to_bytes(8, "little"), digest_size=16).digest()
        line[node] = [*line[up[node]], path[node]]
    root_conv = group[0][9]
    for node in range(n):
        parent = up[node]
        known = None if node == 0 else root_conv if parent == 0 else None if parent in shared else conv[parent]
        yield (
            conv[node], above + tree.depth[node], known, members[node], children[node], leaves[node], saved[node], ends.get(node),
            tree.words[node], path.get(node), path[parent] if parent in shared and (parent or node in shared) else None, line.get(node),
        )


def _batches(rows):
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), NODE_ARROW, strict=True)], NODE_NAMES)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), NODE_ARROW, strict=True)], NODE_NAMES)


def _shard(above: int):
    def run(batches):
        rows = []
        for batch in batches:
            rows += zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True)
        if not rows:
            return
        rows.sort(key=lambda r: (r[0], r[1]))
        starts = [i for i in range(len(rows)) if i == 0 or rows[i][0] != rows[i - 1][0]]
        groups = [rows[lo:hi] for lo, hi in zip(starts, [*starts[1:], len(rows)], strict=True)]
        yield from _batches(row for g, group in enumerate(groups) for row in _tree_rows(group, g == 0, g == len(groups) - 1, above))

    return run


def _tail(batches):
    """Nodes of sequences that are alone: one row of a block -> a row for each of its turns."""

    def nodes(batch):
        for tids, words, conv, count, digest, after, above, parent in zip(*(batch.column(i).to_pylist() for i in range(8)), strict=True):
            rest = after + sum(words)
            for i, w in enumerate(words):
                ended = digest is not None and i == len(words) - 1
                yield (conv, above + i + 1, conv if i else parent, count, 0 if ended else 1, 1, (count - 1) * rest, digest if ended else None, w, None, None, None)
                rest -= w

    for batch in batches:
        yield from _batches(nodes(batch))


def _trees(rows: DataFrame, turns: int, above: int) -> tuple[DataFrame, DataFrame]:
    """(nodes, roots) of the trees over rows (root, tids, words, conv_id, members, ends, below_*,
    root_conv); roots with their totals, not among the nodes unless ``above`` is 0."""
    dealt = rows.repartitionByRange(max(1, -(-turns // SHARD)), "root", "tids")
    nodes = cut(dealt.mapInArrow(_shard(above), NODE), "trie-nodes")
    parts = nodes.filter("path is not null")
    total = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    merged = parts.groupBy("path").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("parent_conv_id").alias("parent_conv_id"), *total,
        F.max("ends").alias("ends"), F.max("words").alias("words"), F.max("parent_path").alias("parent_path"), F.first("line").alias("line"),
    )
    merged = cut(merged, "trie-merged")
    more = merged.filter("parent_path is not null").groupBy(F.col("parent_path").alias("path")).agg(F.count(F.lit(1)).alias("more"))
    merged = merged.join(more, "path", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
    own_leaf = F.when(F.col("n_children") == 0, 1).otherwise(0)
    own_saved = F.when(F.col("parent_path").isNull(), 0).otherwise((F.col("n_convs") - 1) * F.col("words"))
    merged = cut(merged.withColumn("n_leaves", F.col("n_leaves") + own_leaf).withColumn("saved_tokens", F.col("saved_tokens") + own_saved), "trie-merged")
    sums = merged.select(F.explode("line").alias("path"), "n_leaves", "saved_tokens").groupBy("path").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    merged = cut(merged.drop("n_leaves", "saved_tokens").join(sums, "path"), "trie-merged")
    parents = merged.select(F.col("path").alias("parent_path"), F.col("conv_id").alias("parent_conv"))
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    every = nodes.filter("path is null").select(*out, "parent_path").unionByName(merged.filter("parent_path is not null" if above else "true").select(*out, "parent_path"))
    open_ = every.filter("parent_conv_id is null and parent_path is not null").drop("parent_conv_id")
    open_ = open_.join(parents.withColumnRenamed("parent_conv", "parent_conv_id"), "parent_path")
    every = every.filter("parent_conv_id is not null or parent_path is null").select(*out).unionByName(open_.select(*out))
    return every, merged.filter("parent_path is null").select(F.col("path").alias("root_path"), "n_children", "n_leaves", "saved_tokens")


def prefix_trie(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per distinct sequence of first turns (a node; depth 0 is the root): ``conv_id``,
    the smallest member; ``depth``; ``parent_conv_id``, the parent's ``conv_id`` (null for the
    root); ``n_convs``, conversations that begin so; ``n_children``; ``n_leaves``, childless nodes
    in its subtree; ``saved_tokens``, summed over its subtree, (n_convs - 1) times the words of
    a node's last turn; ``ends_sha256``, SHA-256 of the comma-joined ascending ids of the
    conversations that end there.

    ``turns``: conv_id, n (turns of the conversation), pos (from 0, without gaps), tid (equal for
    equal turns), words. ``ids``: every conv_id once; those without turns belong to the root.
    Null conversation ids are left out (a node is named by an id), null roles and texts count
    as empty; rows of one turn number go by role and text, equal rows are turns of their own; a
    table without ids gives no nodes. Texts only pass as 128-bit digests. A conversation
    of many turns is split into blocks, a large group of equal conversations into runs.
    """
    block = F.floor(F.col("pos") / BLOCK).alias("block")
    held = turns.groupBy("conv_id", "n", block).agg(F.sort_array(F.collect_list(F.struct("pos", "tid", "words"))).alias("held"))
    held = held.select("conv_id", "n", "block", F.transform("held", lambda x: x["tid"]).alias("tids"), F.transform("held", lambda x: x["words"]).alias("words"))
    digest = F.unhex(F.md5(F.array_join(F.col("tids").cast("array<string>"), ",")))
    blocks = cut(held.withColumn("digest", digest), "trie-blocks")
    size = blocks.agg(F.max("n").alias("n"), F.sum(F.size("tids")).alias("turns")).first()
    long_ = (size.n or 0) >= BLOCK
    none = F.lit(b"")
    turnless = ids.join(blocks.filter("block = 0").select("conv_id"), "conv_id", "left_anti").select("conv_id", none.alias("sequence"))
    sequences = blocks.filter(F.col("n") < BLOCK).select("conv_id", F.col("digest").alias("sequence")).unionByName(turnless)
    if long_:
        keyed = cut(_keyed(blocks.filter(F.col("n") >= BLOCK)), "trie-keyed")
        sequences = sequences.unionByName(keyed.filter("block = 0").select("conv_id", "sequence"))
    groups = cut(_groups(sequences), "trie-groups")
    smallest = groups.agg(F.min("conv_id")).first()[0]
    empty = F.array().cast("array<long>")
    given = groups.join(blocks.filter(F.col("n") < BLOCK).select("conv_id", "tids", "words"), "conv_id")
    given = given.unionByName(groups.join(turnless.select("conv_id"), "conv_id").select("conv_id", "members", "ends", empty.alias("tids"), empty.alias("words")))
    columns = ["root", "tids", "words", "conv_id", "members", "ends", "n_children", "n_leaves", "saved_tokens", "root_conv"]
    zero = F.lit(0).cast("long")
    top = given.select(none.alias("root"), "tids", "words", "conv_id", "members", "ends", zero.alias("n_children"), zero.alias("n_leaves"), zero.alias("saved_tokens"), F.lit(smallest).cast("long").alias("root_conv"))
    if not long_:
        nodes, _ = _trees(top.select(*columns), size.turns or 0, 0)
    else:
        nodes = _long_trees(keyed.join(groups, "conv_id"), top, columns, smallest, size.turns)
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends", F.lit(NOTHING)).alias("ends_sha256"))


def _keyed(blocks: DataFrame) -> DataFrame:
    """Blocks of long sequences with the keys of what lies before (``root``) and before the next
    block (``next_root``), of the whole ``sequence``, and the words ``after`` the block. Keys
    are digests of two sums over the blocks' digests and numbers, so running sums give them."""
    of = Window.partitionBy("conv_id")
    upto = of.orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    sums = {}
    for i, salt in enumerate((0, 1)):
        part = F.pmod(F.xxhash64("digest", "block", F.lit(salt)), F.lit(WRAP)).cast("decimal(20,0)")
        blocks = blocks.withColumn(f"part{i}", part)
        sums |= {f"upto{i}": F.sum(f"part{i}").over(upto), f"all{i}": F.sum(f"part{i}").over(of)}
    words = F.aggregate("words", F.lit(0).cast("long"), lambda a, x: a + x)
    blocks = blocks.withColumn("held", words)
    blocks = blocks.withColumns(sums | {"after": F.sum("held").over(of) - F.sum("held").over(upto)})

    def key(a, b, count):
        return F.unhex(F.md5(F.concat_ws(":", a.cast("string"), b.cast("string"), count.cast("string"))))

    number = F.col("block")
    return blocks.select(
        "conv_id", "n", "block", "tids", "words", "digest", "after", "held",
        F.when(number > 0, key(F.col("upto0") - F.col("part0"), F.col("upto1") - F.col("part1"), number)).otherwise(F.lit(b"")).alias("root"),
        F.when(F.size("tids") == BLOCK, key(F.col("upto0"), F.col("upto1"), number + 1)).alias("next_root"),
        key(F.col("all0"), F.col("all1"), F.col("n") * -1).alias("sequence"),
    )


def _long_trees(blocks: DataFrame, top: DataFrame, columns: list[str], smallest: int, turns: int) -> DataFrame:
    """Nodes of all sequences, those of ``top`` (shorter than a block) included."""
    blocks = cut(blocks.withColumn("ends", F.when((F.col("block") + 1) * BLOCK >= F.col("n"), F.col("ends"))), "trie-long")
    hung = blocks.filter("next_root is not null").groupBy(F.col("next_root").alias("root")).agg(F.min("conv_id").alias("root_conv"))
    met = blocks.filter("block > 0").groupBy("root").agg(F.count(F.lit(1)).alias("met"))
    later = cut(blocks.filter("block > 0").join(met, "root").join(hung, "root"), "trie-later")
    alone, shared = later.filter("met = 1"), later.filter("met > 1")
    nodes = alone.select("tids", "words", "conv_id", "members", "ends", "after", (F.col("block") * BLOCK).alias("above"), "root_conv").mapInArrow(_tail, NODE)
    nodes = nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends")
    one = F.lit(1).cast("long")
    totals = alone.select(F.col("root").alias("next_root"), one.alias("n_children"), one.alias("n_leaves"), ((F.col("members") - 1) * (F.col("held") + F.col("after"))).alias("saved_tokens"))
    deepest = shared.agg(F.max("block")).first()[0] or 0
    for level in range(deepest, -1, -1):
        here = shared.filter(F.col("block") == level) if level else blocks.filter("block = 0").withColumn("root_conv", F.lit(smallest).cast("long"))
        here = here.groupBy("root", "digest").agg(
            F.first("tids").alias("tids"), F.first("words").alias("words"), F.min("conv_id").alias("conv_id"), F.sum("members").alias("members"),
            F.max("ends").alias("ends"), F.max("next_root").alias("next_root"), F.max("root_conv").alias("root_conv"),
        )
        here = here.join(totals, "next_root", "left").select(*columns)
        found, roots = _trees(here if level else top.select(*columns).unionByName(here), turns, level * BLOCK)
        nodes = nodes.unionByName(found)
        if level:
            paths = shared.filter(F.col("block") == level).select("root").distinct()
            keyed = paths.mapInArrow(_root_paths, "next_root binary, root_path binary").join(roots, "root_path").drop("root_path")
            totals = totals.unionByName(keyed)
    return nodes


def _root_paths(batches):
    for batch in batches:
        keys = batch.column(0).to_pylist()
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array([hashlib.blake2b(k, digest_size=16).digest() for k in keys], pa.binary())], ["next_root", "root_path"])
