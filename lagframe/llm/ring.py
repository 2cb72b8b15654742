"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

The ring is cut into ``cells`` equal arcs; every shard owns ``vnodes`` of them as its virtual
nodes, at places that depend on the shard's number alone. A key falls into the cell of its
hash and belongs to the first virtual node at or after it, clockwise. A shard takes no more
than its capacity: what overflows goes on to the next virtual node with room. Adding a shard
adds its virtual nodes and moves only what they, or changed overflows, take.

Only the cells' row counts, ``cells`` numbers at most, are brought to the driver to settle
the overflow; rows are numbered within cells in hash order and find their shard and slot in a
table of one row per cell.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CELL_BITS = 13
VNODES = 128


def ring_nodes(shards: int, vnodes: int = VNODES, cells: int = 1 << CELL_BITS) -> list[int]:
    """Owner of each cell's end, -1 where no virtual node is; a taken cell passes its
    newcomer on to the next free one, so lower shards never move."""
    if shards * vnodes > cells:
        raise ValueError("more virtual nodes than cells")
    owner = [-1] * cells
    for shard in range(shards):
        for v in range(vnodes):
            at = int.from_bytes(hashlib.sha256(f"{shard}/{v}".encode()).digest()[:8], "big") % cells
            while owner[at] >= 0:
                at = (at + 1) % cells
            owner[at] = shard
    return owner


def settle(counts: dict[int, int], shards: int, load: float, vnodes: int, cells: int) -> list[tuple[int, list[int], list[int], list[int]]]:
    """For each cell with rows: the row numbers at which its parts begin, their shards, and
    the slot of each part's first row.

    With ``load`` 1 the capacities are as even as can be (floor or ceiling of the mean), else
    ``ceil(load * mean)``. Cells offer their rows to their own virtual node in ring order;
    then what is left over moves on, node by node, in ring order of the cells.
    """
    rows = sum(counts.values())
    if load <= 1:
        room = [rows // shards + (s < rows % shards) for s in range(shards)]
    else:
        room = [math.ceil(load * rows / shards)] * shards
    owner = ring_nodes(shards, vnodes, cells)
    places = [c for c in range(cells) if owner[c] >= 0]
    first, at = {}, 0
    for c in range(cells):
        while at < len(places) and places[at] < c:
            at += 1
        first[c] = at % len(places)
    parts: dict[int, list[tuple[int, int]]] = {c: [] for c in counts}
    waiting = [(c, counts[c], first[c]) for c in sorted(counts)]
    while waiting:
        still = []
        for c, n, node in waiting:
            shard = owner[places[node]]
            take = min(n, room[shard])
            if take:
                room[shard] -= take
                if parts[c] and parts[c][-1][0] == shard:
                    parts[c][-1] = (shard, parts[c][-1][1] + take)
                else:
                    parts[c].append((shard, take))
            if n > take:
                node = (node + 1) % len(places)
                while not room[owner[places[node]]]:
                    node = (node + 1) % len(places)
                still.append((c, n - take, node))
        waiting = still
    held = [0] * shards
    out = []
    for c in sorted(parts):
        begins, owners, slots, upto = [], [], [], 0
        for shard, take in parts[c]:
            begins.append(upto)
            owners.append(shard)
            slots.append(held[shard])
            upto += take
            held[shard] += take
        out.append((c, begins, owners, slots))
    return out


def bounded_ring(
    docs: DataFrame,
    shards: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    load: float = 1.0,
    vnodes: int = VNODES,
    cell_bits: int = CELL_BITS,
) -> DataFrame:
    """One row per document: ``id_col``, ``size`` (UTF-8 bytes plus 1), ``text_crc32``,
    ``shard`` and ``slot`` (gapless from 0 in each shard).

    With ``load`` 1 shard counts are at most one apart. A null text has size 1 and a null
    crc. Keys are ids; rows with a null id are placed by their text's crc instead. Rows that
    repeat an id are rows of their own, side by side on the ring. Extra columns are ignored;
    an empty table gives an empty result.
    """
    given = docs.select(
        F.col(id_col).cast("long").alias("id"),
        (F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.encode(F.col(text_col).cast("string"), "UTF-8")).alias("text_crc32"),
    ).withColumn("hash", F.when(F.col("id").isNotNull(), F.xxhash64("id")).otherwise(F.xxhash64("text_crc32", F.lit(1))))
    cell = F.shiftrightunsigned("hash", 64 - cell_bits).cast("int")
    spark = docs.sparkSession
    counted = docs.select(F.col(id_col).cast("long").alias("id"), F.when(F.col(id_col).isNull(), F.crc32(F.encode(F.col(text_col).cast("string"), "UTF-8"))).alias("text_crc32"))
    counted = counted.withColumn("hash", F.when(F.col("id").isNotNull(), F.xxhash64("id")).otherwise(F.xxhash64("text_crc32", F.lit(1))))
    counts = {r["cell"]: r["n"] for r in counted.groupBy(cell.alias("cell")).agg(F.count("*").alias("n")).collect()}  # 2 ** cell_bits rows at most
    plan = spark.createDataFrame(settle(counts, shards, load, vnodes, 1 << cell_bits), "at int, begins array<long>, owners array<int>, slots array<long>")
    place = F.row_number().over(Window.partitionBy("cell").orderBy("hash", "id", "text_crc32", "size")) - 1
    placed = given.withColumn("cell", cell).withColumn("place", place).join(F.broadcast(plan), F.col("cell") == F.col("at"))
    placed = placed.withColumn("part", F.size(F.expr("filter(begins, b -> b <= place)")))
    return placed.select(
        F.col("id").alias(id_col),
        "size",
        "text_crc32",
        F.element_at("owners", F.col("part")).alias("shard"),
        (F.element_at("slots", F.col("part")) + F.col("place") - F.element_at("begins", F.col("part"))).alias("slot"),
    )
