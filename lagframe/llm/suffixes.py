"""Removal of long repeated byte strings, by suffix arrays.

A string of ``width`` bytes is repeated if it also starts elsewhere, in the same or another
document. Every window of ``width`` bytes has an anchor: its leftmost gram of ``GRAM`` bytes
with the smallest hash, and a core: the anchor and the bytes before it, if at least half of the
window's other bytes are there, or else the anchor and those after it, in all half the width or
more. Equal windows have equal cores at equal places, so

1. windows are gathered by core: a run of adjacent windows with one core is a context,
   about one for every 60 bytes of text. Contexts are counted by (core hash, content hash). A
   core met once has no repeated window; a context met twice is repeated throughout;
2. only contexts that share a core with a different context are looked into. They are
   dealt by core. One with many contexts has them cut by the window's place into a few parts,
   more by the logarithm of their number, each with a longer core to be dealt by; one
   with still more is dealt window by window. Tasks leave out windows whose hash no other one of
   theirs has, and cut the rest into shards of bounded size. Each shard gets a suffix array by
   Larsson-Sadakane refinement (groups of equal prefixes, doubled) and common prefixes by
   Kasai's pass; neighbours with ``width`` common bytes are repeated. The
   shards of one group are merged by binary search of each one's windows in the others;
3. repeated intervals are united per document and cut out.

Copies of a text are met once a batch, with their number, and share the intervals of the one
with the smallest id. Long texts are looked at in overlapping stretches, which may cut a context
but no window.
"""

from __future__ import annotations

import functools
import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cut, runs, text_slices
from .words import mix

WIDTH = 200
GRAM = 24
SHARD = 1 << 20  # bytes
TASK = 1 << 21  # bytes of contexts that a task gets, about
WIDE = 256  # contexts of one core above which its windows are dealt by place
STRETCH = 1 << 19  # windows of a long text that are looked at at a time
SLICE = 1 << 23  # bytes of texts that are held at a time
LOT = 1 << 17  # bytes that are hashed or sorted at once, so that arrays stay in the cache
PLACES = np.uint64((1 << 20) - 1)  # of a lot or a stretch
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


@functools.lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    up, down = np.full(n, BASE), np.full(n, inverse)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class Rolling:
    """Hashes of the stretches of a text, with reusable power tables."""

    def __init__(self):
        self.up, self.down = _powers(2 * LOT)

    def sums(self, data: np.ndarray) -> np.ndarray:
        n = len(data)
        if n >= len(self.up):
            self.up, self.down = _powers(1 << n.bit_length())
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTES[data] * self.up[:n], out=sums[1:])
        return sums


class Anchors(Rolling):
    """Anchored contexts of texts."""

    def __init__(self, width: int, gram: int):
        super().__init__()
        self.width, self.gram = width, gram

    def of(self, text: bytes) -> tuple[np.ndarray, ...]:
        """(core hash, content hash, first window, last window, anchor) of the contexts, in order."""
        return self.of_all([text])[1:]

    def of_all(self, texts: list[bytes]) -> tuple[np.ndarray, ...]:
        """The same of many texts, with the number of the text before."""
        w, parts = self.width, []
        cuts = [(i, s, text[s : s + STRETCH + w - 1]) for i, text in enumerate(texts) for s in range(0, len(text) - w + 1, STRETCH)]
        for lo, hi in runs([len(text) for _, _, text in cuts], LOT):
            own, shift, pieces = zip(*cuts[lo:hi], strict=True)
            at, core, content, first, last, place = self._of(pieces)
            shift = np.array(shift)[at]
            parts.append((np.array(own)[at], core, content, first + shift, last + shift, place + shift))
        if not parts:
            return tuple(np.empty(0, dtype=t) for t in (np.int64, np.uint64, np.uint64, np.int64, np.int64, np.int64))
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))

    def _of(self, texts: tuple[bytes, ...]) -> tuple[np.ndarray, ...]:
        w, k = self.width, self.gram
        data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        sums = self.sums(data)
        n = len(data)
        grams = mix((sums[k:] - sums[:-k]) * self.down[: n - k + 1])
        # leftmost least gram of each window: least (hash, place) from both ends of blocks of span
        span, m = w - k + 1, n - w + 1
        size = -(-len(grams) // span) * span
        padded = np.full(size, np.uint64(0xFFFFFFFFFFFFFFFF))
        padded[: len(grams)] = grams & ~PLACES | np.arange(len(grams), dtype=np.uint64)
        blocks = padded.reshape(-1, span)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(behind[:m], ahead[span - 1 : span - 1 + m])
        # runs of windows of one text with one anchor
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        begins = np.cumsum(sizes) - sizes
        ends = begins + sizes - w + 1  # behind the last window; those further on lie in two texts
        new = np.empty(m + 1, dtype=bool)
        new[1:m] = least[1:] != least[:-1]
        new[begins] = new[ends] = True
        first = np.flatnonzero(new[:m])
        last = np.append(first[1:], m) - 1
        owner = np.searchsorted(begins, first, side="right") - 1
        inside = first < ends[owner]
        first, last, owner = first[inside], last[inside], owner[inside]
        place = (least[first] & PLACES).astype(np.int64)
        # those that begin ``half`` or more before the anchor go apart from the others: the
        # core, which all of the one or the other kind hold, is the half before the gram and the
        # gram, or the gram and what is left of the width if half of it lies before
        half = (w - k + 1) // 2
        early = place - first >= half
        both = np.flatnonzero(early & (place - last < half))
        turn = place[both] - half
        first, last = np.insert(first, both + 1, turn + 1), np.insert(last, both, turn)
        early, place, owner = np.insert(early, both + 1, False), np.insert(place, both + 1, place[both]), np.insert(owner, both + 1, owner[both])
        low, high = np.where(early, place - half, place), np.where(early, place + k, place + w - half + 1)
        core = mix((sums[high] - sums[low]) * self.down[low] + early)
        content = mix((sums[last + w] - sums[first]) * self.down[first]) ^ mix((place - first).astype(np.uint64) * BASE + (last - first).astype(np.uint64))
        begins = begins[owner]
        return owner, core, content, first - begins, last - begins, place - begins


def _pack(first, count, place):
    """First window, number of windows and the anchor's place after the first, in one number."""
    return first << 24 | count << 12 | place


def _merged(rows: np.ndarray) -> np.ndarray:
    """(owner, first, last) rows, sorted, with adjacent and overlapping ranges joined."""
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    if not len(rows):
        return rows
    reach = np.maximum.accumulate(rows[:, 0] * (1 << 40) + rows[:, 2])  # owners are small numbers
    new = np.concatenate(([True], rows[1:, 0] * (1 << 40) + rows[1:, 1] > reach[:-1] + 1))
    at = np.flatnonzero(new)
    return np.stack([rows[at, 0], rows[at, 1], np.maximum.reduceat(rows[:, 2], at)], axis=1)


def _slices(batches):
    """(ids, fps, texts as bytes) of Arrow batches (id, fp, text), ``SLICE`` bytes at a time."""
    for batch in batches:
        ids, fps = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for lo, hi, texts in text_slices(batch.column(2), SLICE):
            yield ids[lo:hi], fps[lo:hi], texts


def _contexts(width: int, gram: int):
    """Arrow batches (id, fp, text) -> contexts (with ``weight``) and known repeats (without).

    A context that repeats within the batch goes on once, with its number; its other places
    are repeats for certain.
    """
    names = ["id", "fp", "h", "content", "spot", "weight"]

    def contexts(batches):
        anchors = Anchors(width, gram)
        for ids, fps, texts in _slices(batches):
            long = np.array([i for i, t in enumerate(texts) if len(t) >= width], dtype=np.int64)
            order = long[np.lexsort((ids[long], fps[long]))]
            if not len(order):
                continue
            own = np.concatenate(([True], fps[order][1:] != fps[order][:-1]))
            copies = np.diff(np.append(np.flatnonzero(own), len(order)))
            for lo, hi in runs([len(texts[i]) for i in order[own]], 1 << 23):
                chosen = order[own][lo:hi]
                owner, h, content, first, last, place = anchors.of_all([texts[i] for i in chosen])
                place -= first
                _, at, group = np.unique(h * BASE + content, return_index=True, return_inverse=True)
                weight = np.bincount(group, weights=copies[lo:hi][owner]).astype(np.int64)
                again = np.ones(len(h), dtype=bool)
                again[at] = False
                rows = chosen[owner[at]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (ids[rows], fps[rows], h[at].view(np.int64), content[at].view(np.int64), _pack(first[at], last[at] - first[at] + 1, place[at]), weight)], names
                )
                known = _merged(np.stack([owner[again], first[again], last[again]], axis=1))
                rows = chosen[known[:, 0]]
                none = pa.nulls(len(rows), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(ids[rows]), pa.array(fps[rows]), none, pa.array(known[:, 2]), pa.array(known[:, 1]), none], names)

    return contexts


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Suffixes in order. Larsson-Sadakane: suffixes are sorted by their first 8 bytes, then
    groups still equal are refined by the groups of the suffixes one sorted length further on,
    doubling that length until every suffix stands alone."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    key = np.lib.stride_tricks.sliding_window_view(padded, 8)[:n].copy().view(">u8").ravel().astype(np.uint64)
    order = np.argsort(key, kind="stable")
    rank = np.zeros(n + 1, dtype=np.int64)  # 0 stands for what lies behind the end

    def number(slots, keys, positions):
        new = np.concatenate(([True], keys[1:] != keys[:-1]))
        rank[positions] = slots[np.flatnonzero(new)][np.cumsum(new) - 1] + 1
        alone = new & np.concatenate((new[1:], [True]))
        return slots[~alone]

    # a suffix that ends within 8 bytes may tie with one that goes on in zero bytes
    unsorted = number(np.arange(n), key[order], order) if n else np.empty(0, dtype=np.int64)
    known = 8
    short = np.arange(max(0, n - 8), n)
    if len(unsorted) and np.isin(order[unsorted], short).any():
        keys = rank[order[unsorted]] * 16 + np.minimum(n - order[unsorted], 8)
        turn = np.argsort(keys, kind="stable")
        order[unsorted] = order[unsorted][turn]
        unsorted = number(unsorted, keys[turn], order[unsorted])
    while len(unsorted):
        positions = order[unsorted]
        keys = rank[positions] * (n + 1) + rank[np.minimum(positions + known, n)]
        turn = np.argsort(keys, kind="stable")
        order[unsorted] = positions[turn]
        unsorted = number(unsorted, keys[turn], positions[turn])
        known *= 2
    return order


def common_prefixes(data: np.ndarray, before: np.ndarray, starts: np.ndarray, counts: np.ndarray, width: int) -> np.ndarray:
    """Kasai's pass: bytes, up to ``width``, that each window shares with its predecessor
    ``before`` (-1: none). All contexts advance together, each keeping what it knows: the
    next window shares at least one byte less, if the predecessor's next is a window too."""
    padded = np.concatenate([data, np.zeros(width + 8, dtype=np.uint8)])
    shared = np.zeros(len(data), dtype=np.int64)
    window = np.zeros(len(data) + 1, dtype=bool)
    for s, c in zip(starts, counts, strict=True):
        window[s : s + c] = True
    held = np.zeros(len(starts), dtype=np.int64)
    for t in range(int(counts.max(initial=0))):
        live = np.flatnonzero(counts > t)
        i = starts[live] + t
        j = before[i]
        live, i, j = live[j >= 0], i[j >= 0], j[j >= 0]
        held[counts > t] = np.maximum(held[counts > t] - 1, 0)
        grow = np.arange(len(live))
        while len(grow):
            k = held[live[grow]]
            grow = grow[(k < width)]
            k = held[live[grow]]
            grow = grow[padded[i[grow] + k] == padded[j[grow] + k]]
            held[live[grow]] += 1
        shared[i] = held[live]
        none = np.ones(len(starts), dtype=bool)
        none[live[window[j + 1]]] = False
        held[none] = 0
    return shared


def repeated_windows(pieces: list[bytes], width: int) -> list[np.ndarray]:
    """For each piece, which of its windows also start in another place of the shard."""
    data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    sizes = np.array([len(p) for p in pieces], dtype=np.int64)
    starts, counts = np.cumsum(sizes) - sizes, sizes - width + 1
    order = suffix_array(data)
    window = np.zeros(len(data), dtype=bool)
    for s, c in zip(starts, counts, strict=True):
        window[s : s + c] = True
    line = order[window[order]]
    before = np.full(len(data), -1, dtype=np.int64)
    before[line[1:]] = line[:-1]
    same = common_prefixes(data, before, starts, counts, width) >= width
    same[before[same]] = True
    return [same[s : s + c] for s, c in zip(starts, counts, strict=True)]


def _strings(pieces: list[bytes], width: int) -> np.ndarray:
    """All windows of the pieces, in order of the pieces."""
    rows = [np.lib.stride_tricks.sliding_window_view(np.frombuffer(p, dtype=np.uint8), width) for p in pieces]
    return np.ascontiguousarray(np.concatenate(rows)).view(f"S{width}").ravel()


def _merge(shards: list[list[bytes]], flags: list[list[np.ndarray]], width: int) -> None:
    """Mark the windows of each shard that a binary search finds in another one: sorted windows
    of one shard, ``1 << 15`` at a time, are searched for all windows of the others at once."""

    def windows(pieces):
        for lo, hi in runs([len(p) - width + 1 for p in pieces], 1 << 15):
            yield lo, hi, _strings(pieces[lo:hi], width)

    for b, pieces in enumerate(shards):
        for _, _, held in windows(pieces):
            held = np.sort(held)
            for a, others in enumerate(shards):
                if a == b:
                    continue
                for lo, hi, mine in windows(others):
                    at = np.minimum(np.searchsorted(held, mine), len(held) - 1)
                    met = held[at] == mine
                    if met.any():
                        ends = np.cumsum([len(p) - width + 1 for p in others[lo:hi]])
                        for i, part in zip(range(lo, hi), np.split(met, ends[:-1]), strict=True):
                            flags[a][i] = flags[a][i] | part


def _chances(rolling: Rolling, data: np.ndarray, begins: np.ndarray, sizes: np.ndarray, width: int) -> np.ndarray:
    """Which bytes of the pieces, that lie in ``data`` one after the other, begin a window whose
    hash another one has too. The others do not repeat; these the suffix arrays look into."""
    found = []
    spots = np.repeat(begins, sizes - width + 1)
    counts = sizes - width + 1
    spots += np.arange(len(spots)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = 0
    for lo, hi in runs(sizes.tolist(), LOT):
        low, n = int(begins[lo]), int(counts[lo:hi].sum())
        sums = rolling.sums(data[low : int(begins[hi - 1] + sizes[hi - 1])])
        mine = spots[at : at + n] - low
        found.append((sums[mine + width] - sums[mine]) * rolling.down[mine])
        at += n
    hashes = np.concatenate(found)
    order = np.argsort(hashes)
    line = hashes[order]
    same = np.concatenate((line[1:] == line[:-1], [False]))
    same[1:] |= same[:-1]
    chance = np.zeros(len(data), dtype=bool)
    chance[spots[order[same]]] = True
    return chance


def _shards(width: int, shard: int):
    """One task's pieces (h, part, data, id, fp, start, known) -> repeats (id, fp, first, last);
    a piece without bytes is one window that is repeated for certain."""

    def find(table: pa.Table) -> pa.Table:
        sure = table.filter(pc.is_null(table["data"])).select(["id", "fp", "start"])
        sure = pa.table({"id": sure["id"], "fp": sure["fp"], "first": sure["start"], "last": sure["start"]})
        table = table.filter(pc.is_valid(table["data"]))
        if not table.num_rows:
            return sure
        table = table.combine_chunks().sort_by([("h", "ascending"), ("part", "ascending"), ("id", "ascending"), ("fp", "ascending"), ("start", "ascending")])
        whole = pa.concat_arrays(table["data"].chunks)
        sizes = pc.binary_length(whole).to_numpy(zero_copy_only=False).astype(np.int64)
        begins = np.cumsum(sizes) - sizes
        joined = np.frombuffer(b"".join(whole.to_pylist()), dtype=np.uint8)
        chance = _chances(Rolling(), joined, begins, sizes, width)
        # stretches of windows that may repeat, each within a piece
        edge = np.zeros(len(joined) + 1, dtype=bool)
        edge[begins] = True
        lows = np.flatnonzero(chance & (edge[:-1] | ~np.concatenate(([False], chance[:-1]))))
        highs = np.flatnonzero(chance & (edge[1:] | ~np.concatenate((chance[1:], [False]))))
        if not len(lows):
            return sure
        row = np.searchsorted(begins, lows, side="right") - 1
        data = [joined[a : b + width].tobytes() for a, b in zip(lows.tolist(), highs.tolist(), strict=True)]
        start = table["start"].to_numpy()[row] + lows - begins[row]
        h, part, known = table["h"].to_numpy()[row], table["part"].to_numpy()[row], table["known"].to_numpy()[row]
        new = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (part[1:] != part[:-1]))))
        ends = np.append(new[1:], len(h))
        sums = np.add.reduceat(np.array([len(d) for d in data]), new)
        flags: list = [None] * len(data)
        for lo, hi in runs(sums, min(shard, LOT)):  # whole groups, a lot at a time
            rows = list(range(int(new[lo]), int(ends[hi - 1])))
            if sums[lo] <= shard:
                for r, f in zip(rows, repeated_windows([data[r] for r in rows], width), strict=True):
                    flags[r] = f
            else:  # one large group: several shards, merged
                cuts = list(runs([len(data[r]) for r in rows], shard))
                shards = [[data[r] for r in rows[a:b]] for a, b in cuts]
                found = [repeated_windows(pieces, width) for pieces in shards]
                _merge(shards, found, width)
                for (a, b), group in zip(cuts, found, strict=True):
                    for r, f in zip(rows[a:b], group, strict=True):
                        flags[r] = f
        out = []
        for r in np.flatnonzero(~known).tolist():
            f = flags[r]
            if f.any():
                turn = np.flatnonzero(np.diff(np.concatenate(([False], f, [False])).astype(np.int8)))
                out += [(row[r], int(start[r] + a), int(start[r] + b - 1)) for a, b in zip(turn[::2], turn[1::2], strict=True)]
        rows = pa.array([r for r, _, _ in out], pa.int64())
        found = pa.table({"id": table["id"].take(rows), "fp": table["fp"].take(rows), "first": pa.array([a for _, a, _ in out], pa.int64()), "last": pa.array([b for _, _, b in out], pa.int64())})
        return pa.concat_tables([found, sure])

    return find


def _pieces(width: int, gram: int, wide: int, tasks: int):
    """Arrow batches (id, fp, text, wanted, ...) -> the bytes of the wanted contexts, dealt.

    A core with more than ``wide`` contexts has them cut by the window's place, into a part
    more each time their number doubles; equal windows have the part and all of its core's
    bytes in common, by which parts are dealt. Above ``wide`` contexts for each place windows are
    dealt one by one, by their own bytes; of equal ones in a slice two go with them, the others without."""
    span = width - gram + 1
    half = span // 2

    def dealt(id_, fp, text, wanted, met):
        for w in wanted:
            first, count, place = w["spot"] >> 24, w["spot"] >> 12 & 4095, w["spot"] & 4095
            low, high = (half, span) if place >= half else (0, half)  # distances to the anchor
            alone = w["variants"] > wide * (span - half)
            parts = high - low if alone else min(high - low, 1 + ((w["variants"] - 1) // wide).bit_length())
            # a window's distance to its anchor decides its part
            for part in range(parts):
                near, far = low + part * (high - low) // parts, low + (part + 1) * (high - low) // parts  # distances in [near, far)
                lo, hi = max(0, place - far + 1), min(count, place - near + 1)
                if lo >= hi:
                    continue
                data, key = text[first + lo : first + hi - 1 + width], 0
                if w["variants"] > wide:  # a window alone is all core
                    key = part << 32 | zlib.crc32(text[first + place - near : first + place - far + 1 + width])
                if alone:
                    number = met[w["h"], key, data] = met.get((w["h"], key, data), 0) + 1
                    if number > 2:
                        if not w["known"]:
                            yield hash((id_, fp, first + lo)) % tasks, w["h"], key, None, id_, fp, first + lo, False
                        continue
                yield hash((w["h"], key)) % tasks, w["h"], key, data, id_, fp, first + lo, w["known"]

    def pieces(batches):
        for batch in batches:
            ids, fps, asked = (batch.column(c).to_pylist() for c in ("id", "fp", "wanted"))
            for lo, hi, texts in text_slices(batch.column("text"), SLICE):
                met: dict = {}
                out = [row for i, text in zip(range(lo, hi), texts, strict=True) for row in dealt(ids[i], fps[i], text, asked[i], met)]
                cols = list(zip(*out, strict=True)) if out else [[]] * 8
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["task", "h", "part", "data", "id", "fp", "start", "known"])

    return pieces


def _remove(width: int, through: list[str], keep_text: bool):
    """Arrow batches (text, spans, ...) -> the columns ``through`` and what the removal leaves."""

    def remove(batches):
        for batch in batches:
            every = batch.column("spans").to_pylist()
            for lo, hi, texts in text_slices(batch.column("text"), SLICE):
                n, gone, cuts, kept = [], [], [], []
                for text, spans in zip(texts, every[lo:hi], strict=True):
                    out, at, removed, number, end = [], 0, 0, 0, -1
                    for s in sorted((s["first"], s["last"] + width) for s in spans or ()):
                        if s[0] > end:
                            number += 1
                            out.append(text[at : s[0]])
                            removed += s[1] - s[0]
                        elif s[1] > end:
                            removed += s[1] - end
                        end = max(end, s[1])
                        at = end
                    out.append(text[at:])
                    n.append(len(text))
                    gone.append(removed)
                    cuts.append(number)
                    kept.append(b"".join(out))
                part = batch.slice(lo, hi - lo)
                cols = [*(part.column(c) for c in through), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(cuts, pa.int64()), pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())]
                names = [*through, "n_bytes", "n_removed", "n_spans", "kept_sha256"]
                if keep_text:
                    cols, names = [*cols, pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string())], [*names, "kept"]
                yield pa.RecordBatch.from_arrays(cols, names)

    return remove


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, gram: int = GRAM, shard: int = SHARD, wide: int = WIDE, task: int = TASK, keep_text: bool = False, carry: tuple[str, ...] = ()
) -> DataFrame:
    """One row per document: ``id_col``, ``n_bytes``, ``n_removed``, ``n_spans``,
    ``kept_sha256``, with ``keep_text`` the ``kept`` text, and the columns named in ``carry``.

    Each byte covered by a ``width``-byte string that also starts elsewhere, in any document,
    is removed; strings are judged on the input and never cross documents. A null text is
    empty; texts shorter than ``width`` have no such string; very long ones are looked at in
    stretches of ``STRETCH`` windows, so that memory is a small multiple of the longest text. Rows with a null or repeated id
    are rows of their own. Extra columns are ignored; an empty table gives an empty result.
    Cuts fall between bytes: the digest is of the remaining bytes, ``kept`` leaves out
    characters of which only a part remains.
    """
    own = [F.col(c).alias(f"carry_{i}") for i, c in enumerate(carry)]
    lines = docs.select(*own, F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("fp"), F.col(text_col).cast("string").alias("text"))
    texts = lines.select("id", "fp", "text")
    found = cut(texts.mapInArrow(_contexts(width, gram), "id long, fp long, h long, content long, spot long, weight long"), "suffix-contexts")
    contexts = found.filter("h is not null")
    shared = contexts.groupBy("h").agg(F.sum("weight").alias("met")).filter("met > 1").select("h")
    live = cut(contexts.join(shared, "h"), "suffix-live")
    same = cut(live.groupBy("h", "content").agg(F.sum("weight").alias("met"), F.min(F.struct("id", "fp", "spot")).alias("one")), "suffix-same")
    variety = same.groupBy("h").agg(F.count("*").alias("variants"), F.sum(F.when(F.col("met") == 1, 1).otherwise(0)).alias("single"))
    variety = cut(variety, "suffix-variety")  # a table, so that the join splits an anchor with many contexts
    judged = cut(live.join(same, ["h", "content"]).join(variety, "h"), "suffix-judged")

    classes = lines.groupBy("fp").agg(F.min("id").alias("id"))
    reps = cut(classes, "suffix-classes")
    repeats = judged.filter("met > 1").selectExpr("id", "fp", "shiftright(spot, 24) as first", "shiftright(spot, 24) + (shiftright(spot, 12) & 4095) - 1 as last")
    repeats = repeats.unionByName(found.filter("h is null").selectExpr("id", "fp", "spot as first", "content as last"))
    wanted = judged.filter("variants > 1 and single > 0").filter((F.col("met") == 1) | (F.col("one") == F.struct("id", "fp", "spot")))
    most = (width - gram + 2) // 2
    places = F.when(F.col("variants") > wide * most, most).otherwise(F.least(F.lit(most), 1 + F.ceil(F.log2(F.ceil(F.col("variants") / wide)))))
    tasks = 1 + (wanted.agg(F.sum(places)).first()[0] or 0) * 2 * width // task  # by the bytes that a context is dealt in
    asked = wanted.groupBy("id", "fp").agg(F.collect_list(F.struct("h", "spot", "variants", (F.col("met") > 1).alias("known"))).alias("wanted"))
    # both joins take the same columns of the texts, so that these are shuffled once
    dealt = lines.join(asked, ["id", "fp"]).mapInArrow(_pieces(width, gram, wide, tasks), "task int, h long, part long, data binary, id long, fp long, start long, known boolean")
    edges = dealt.groupBy("task").applyInArrow(_shards(width, shard), "id long, fp long, first long, last long")
    spans = repeats.unionByName(edges).join(reps, ["id", "fp"], "left_semi").groupBy("id", "fp").agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    told = texts.select("id", "fp").distinct().join(spans.select("fp", "spans"), "fp", "left")
    through = [f"carry_{i}" for i in range(len(carry))] + ["doc"]
    kinds = ", ".join(f"{c} {lines.schema[c].dataType.simpleString()}" for c in through)
    kinds += ", n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept string" if keep_text else "")
    result = lines.join(told, ["id", "fp"]).mapInArrow(_remove(width, through, keep_text), kinds)
    return result.withColumnsRenamed({"doc": id_col} | {f"carry_{i}": c for i, c in enumerate(carry)})
