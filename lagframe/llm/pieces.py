"""SentencePiece coding for merge-type (BPE) vocabularies.

Encoding keeps an agenda of adjacent symbol pairs whose concatenation is in the vocabulary,
ordered by score (higher first) and then by position (left first); the best live pair merges
and its new neighbours join the agenda. Symbols outside the vocabulary become their UTF-8
bytes' pieces (byte fallback), else the unknown id.

No piece holds a space mark after another character, a line end outside the vocabulary's
alphabet, or a full stop or comma after a letter (as read off the vocabulary; characters such
as a superscript two, which a piece joins with a full stop, are no letters here), so merges never
cross such places: a text is cut there into units, and the units' codes are remembered within a bound.

Units that are coded anew go through the agenda many at a time: each round merges the best live
pair of every unit, in arrays that hold a unit a row. Long units have a heap each.

Every unit that is coded anew is compared with the sentencepiece library in the place where it
was met: the whole stretch from one space to the next, with all its units and the cuts between
them, and the characters next to it. A difference stops the job. Remembered units of a worker
have been compared; one that is forgotten and coded again is compared again.
"""

from __future__ import annotations

import hashlib
import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import text_slices

MARK = "▁"  # stands for a space
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6  # piece types of the model format
MEMO_LIMIT = 1 << 18  # codes of stretches and units that a worker remembers, twice: recent and older ones
SHORT = 32  # up to so many symbols a unit shares arrays with others, beyond it has a heap
ROWS = 1 << 12  # units that share arrays
NEVER = np.int32(2**31 - 1)  # behind the order of any piece
GONE = -1  # a place whose symbol an earlier one took in
SLICE = 1 << 20  # bytes of texts that are held at a time
CHECK_TEXT = 1 << 16  # characters of stretches that wait for the comparison
CHECK_RUN = 128  # stretches and neighbours that are compared as one text, which is slower if long
LETTER = re.compile(r"[^\W\d_]")
STRETCHES = re.compile(" *[^ ]+| +").findall


class Pairs:
    """The pairs of symbols whose concatenation is in the vocabulary. Symbols are numbers: the
    piece's id, for other characters of the vocabulary's alphabet and for all else ones behind."""

    def __init__(self, ids: dict[str, int], score: dict[str, float], n_pieces: int):
        number = dict(ids)
        for c in sorted({c for p in ids for c in p}.difference(ids)):
            number[c] = n_pieces + len(number) - len(ids)
        self.n_pieces, self.other = n_pieces, n_pieces + len(number) - len(ids)
        letters = [c for c in number if len(c) == 1]
        self.of_char = np.full(max(map(ord, letters), default=0) + 2, self.other, np.int32)
        for c in letters:
            self.of_char[ord(c)] = number[c]
        rank = {x: i for i, x in enumerate(sorted(set(score.values())))}
        rights: dict[int, list[tuple[int, int, int]]] = {}
        for p in ids:
            for i in range(1, len(p)):
                if p[:i] in number and p[i:] in number:
                    rights.setdefault(number[p[:i]], []).append((number[p[i:]], rank[score[p]], number[p]))
        self._place(rights)

    def _place(self, rights: dict[int, list[tuple[int, int, int]]]) -> None:
        """One array for the pairs of all left symbols: a pair's place is its right symbol's
        number, shifted by the left symbol, by so much that no two pairs share a place."""
        base, step = self.other + 1, 1 << 14  # below base: the unshifted places of symbols that lead no pair
        taken = np.zeros(base + 2 * sum(map(len, rights.values())) + 4 * base, bool)
        self.shift = np.zeros(base, np.int64)
        for left, pairs in sorted(rights.items(), key=lambda x: (-len(x[1]), x[0])):
            if len(pairs) == 1:
                break
            places = np.array([r for r, _, _ in pairs])
            lowest, lo = places.min(), base
            places -= lowest
            while True:
                if lo + step + base > len(taken):
                    taken = np.concatenate([taken, np.zeros(len(taken), bool)])
                busy = np.zeros(step, bool)
                for d in places.tolist():
                    busy |= taken[lo + d : lo + d + step]
                at = int(busy.argmin())
                if not busy[at]:
                    break
                lo += step
            taken[places + lo + at] = True
            self.shift[left] = lo + at - lowest
        single = [left for left, pairs in rights.items() if len(pairs) == 1]
        taken = np.concatenate([taken, np.zeros(len(single), bool)])
        free = base + np.flatnonzero(~taken[base:])[: len(single)]
        self.shift[single] = free - np.array([rights[left][0][0] for left in single], np.int64)
        n = int(self.shift.max()) + base + 1
        self.left = np.full(n, -1, np.int32)
        self.order = np.full(n, NEVER, np.int32)
        self.made = np.full(n, self.other, np.int32)
        for left, pairs in rights.items():
            for right, order, made in pairs:
                at = self.shift[left] + right
                self.left[at], self.order[at], self.made[at] = left, order, made

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Places of pairs, the last one for pairs that don't merge."""
        at = self.shift[left] + right
        return np.where(self.left[at] == left, at, len(self.left) - 1)

    def merge(self, units: list[str]) -> np.ndarray:
        """The agenda of each unit, a row each: what is left of its symbols, each where it begins,
        ``GONE`` elsewhere."""
        size = np.fromiter(map(len, units), np.int64, len(units))
        wide = int(size.max()) + 1
        column = np.arange(wide)
        inside = column < size[:, None]
        symbol = np.full(inside.shape, self.other, np.int32)
        chars = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)
        symbol[inside] = self.of_char[np.minimum(chars, len(self.of_char) - 1)]
        at = np.full(inside.shape, len(self.left) - 1)
        at[:, :-1] = self.find(symbol[:, :-1], symbol[:, 1:])
        order = self.order[at]
        after = np.broadcast_to(column + 1, inside.shape).copy().ravel()
        before = np.broadcast_to(column - 1, inside.shape).copy().ravel()
        symbol, at, flat = symbol.ravel(), at.ravel(), order.ravel()
        live = np.arange(len(units))
        while True:
            agenda = order[live]
            best = agenda.argmin(1)  # the leftmost of equal scores
            some = agenda[np.arange(len(live)), best] != NEVER
            live, best = live[some], best[some]
            if not len(live):
                break
            start = live * wide
            i = start + best
            j = start + after[i]
            both = self.made[at[i]]
            symbol[i], symbol[j], flat[j] = both, GONE, NEVER
            after[i] = after[j]
            k = start + after[i]
            before[k] = best
            at[i] = self.find(both, symbol[k])
            flat[i] = self.order[at[i]]
            led = before[i] >= 0
            h, both = (start + before[i])[led], both[led]
            at[h] = self.find(symbol[h], both)
            flat[h] = self.order[at[h]]
        symbol = symbol.reshape(inside.shape)
        symbol[~inside] = GONE
        return symbol


class PieceCoder(dict):
    """Vocabulary of one model file; as a mapping: a stretch without the space before it, or
    behind a space mark a unit that follows another one -> its ids, comma-joined."""

    def __init__(self, model_path: str, check: bool = True):
        super().__init__()
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(model_path, "rb") as f:
            model.ParseFromString(f.read())
        spec = model.normalizer_spec
        if model.trainer_spec.model_type != model.trainer_spec.BPE or spec.precompiled_charsmap or spec.remove_extra_whitespaces or not (spec.add_dummy_prefix and spec.escape_whitespaces):
            raise ValueError("a merge-type model with identity normalization, a dummy prefix and kept white space is needed")
        if not {p.type for p in model.pieces} <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("user-defined and unused pieces are not supported")
        self.library = sentencepiece.SentencePieceProcessor(model_file=model_path) if check else None
        self.fresh: list[tuple[str, list[int]]] = []
        self.waiting = 0
        self.new: dict[str, str] = {}
        self.older: dict[str, str] = {}
        self.ready: dict[str, list[int]] = {}
        self.beside: dict[str, str] = {}
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.score = {p.piece: -p.score for p in model.pieces if p.type == NORMAL}
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == UNKNOWN)
        self.byte_id = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.surface: list[bytes] = []
        for p in model.pieces:
            if p.type == BYTE:
                self.surface.append(bytes([int(p.piece[3:5], 16)]))
            elif p.type == UNKNOWN:
                self.surface.append(model.trainer_spec.unk_surface.encode())
            else:
                self.surface.append(b"" if p.type == CONTROL else p.piece.replace(MARK, " ").encode())
        self.surfaces = np.frombuffer(b"".join(self.surface), np.uint8)
        self.length = np.array([len(b) for b in self.surface], np.int64)
        self.begin = self.length.cumsum() - self.length
        self.pairs = Pairs(self.ids, self.score, len(model.pieces))
        self.name = [str(i) for i in range(len(model.pieces))]
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece holds a space mark after another character")
        alphabet = {c for p in self.ids for c in p}
        alone = "".join(re.escape(c) for c in "\n\t\r\f\v" if c not in alphabet)
        # characters that the class of letters takes (also the likes of a superscript two) and
        # that some piece joins with a head behind them: the letters proper among them rule the
        # head out, the others leave the class
        joined = {(a, c) for p in self.ids for a, c in zip(p, p[1:], strict=False) if c in ".,;:!?" and LETTER.match(a)}
        heads = "".join(c for c in ".,;:!?" if not any(a.isalpha() for a, h in joined if h == c))
        barred = "".join(sorted({re.escape(a) for a, h in joined if h in heads}))
        word = [f"{MARK}*[^\\W\\d_{barred}]+(?=[{re.escape(heads)}])"] * bool(heads)
        self.units = re.compile("|".join([*word, f"{MARK}*[^{MARK}{alone}]+", f"{MARK}+", *[f"[{alone}]"] * bool(alone)])).findall
        if any(len(self.units(MARK + p)) != 1 for p in self.ids):
            raise ValueError("a cut between units splits a piece")

    def _merge_long(self, symbols: list[str | None]) -> list[str | None]:
        """The agenda as a heap; merged symbols leave ``None`` behind."""
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        score = self.score
        agenda = []
        for i in range(n - 1):
            both = symbols[i] + symbols[i + 1]
            if both in score:
                agenda.append((score[both], i, i + 1, both))
        heapq.heapify(agenda)
        while agenda:
            _, i, j, both = heapq.heappop(agenda)
            left, right = symbols[i], symbols[j]
            if left is None or right is None or after[i] != j or len(left) + len(right) != len(both):
                continue  # an earlier merge used up one side
            symbols[i], symbols[j] = both, None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                pair = both + symbols[k]
                if pair in score:
                    heapq.heappush(agenda, (score[pair], i, k, pair))
            h = before[i]
            if h >= 0:
                pair = symbols[h] + both
                if pair in score:
                    heapq.heappush(agenda, (score[pair], h, i, pair))
        return symbols

    def _ids(self, symbol: str) -> list[int]:
        """Ids of a symbol that nothing merges with."""
        i = self.ids.get(symbol)
        if i is not None:
            return [i]
        return [self.byte_id[b] for b in symbol.encode()] if self.byte_id else [self.unknown]

    def _prepare(self, units: list[str]) -> None:
        """Run the agendas of units that are short, shorter ones first."""
        for lo in range(0, len(units), ROWS):
            some = units[lo : lo + ROWS]
            symbols = self.pairs.merge(some)
            rest = symbols >= self.pairs.n_pieces
            kept = symbols != GONE
            ids, ends = symbols[kept].tolist(), kept.sum(1).cumsum().tolist()
            self.ready.update(zip(some, map(ids.__getitem__, map(slice, [0, *ends], ends)), strict=True))
            for row in np.flatnonzero(rest.any(1)).tolist():
                unit, line = some[row], symbols[row].tolist()
                self.ready[unit] = [x for c, s in zip(unit, line, strict=False) if s != GONE for x in ([s] if s < self.pairs.n_pieces else self._ids(c))]

    def encode_unit(self, unit: str) -> list[int]:
        """Ids of one unit, by the agenda."""
        found = self.ready.pop(unit, None)
        if found is not None:
            return found
        return [i for s in self._merge_long(list(unit)) if s is not None for i in self._ids(s)]

    def _remember(self, found: dict[str, str]) -> None:
        if max(map(len, found), default=0) > 64:
            found = {key: code for key, code in found.items() if len(key) <= 64}
        if len(self) + len(found) <= MEMO_LIMIT:
            self.update(found)
            return
        for key, code in found.items():
            if len(self) >= MEMO_LIMIT:
                self.older = dict(self)
                self.clear()
            self[key] = code

    def _code_anew(self, units: list[str]) -> list[str]:
        """Codes of units that none remembers, a few at a time: lists of ids that live on by the
        ten thousand keep Python's garbage collector busy."""
        name, encode_unit, found = self.name, self.encode_unit, [""] * len(units)
        order = sorted(range(len(units)), key=[len(u) for u in units].__getitem__)
        for lo in range(0, len(units), ROWS):
            places = order[lo : lo + ROWS]
            some = [units[i] for i in places]
            self._prepare(some if len(some[-1]) <= SHORT else [u for u in some if len(u) <= SHORT])
            for i, unit in zip(places, some, strict=True):
                found[i] = ",".join([name[x] for x in encode_unit(unit)])
        return found

    def _code(self, keys: set[str]) -> dict[str, str]:
        """Codes of stretches that are not among the recent ones; the units that none of them
        remembers are coded anew."""
        recent, older, found, alone, parts = self.get, self.older.get, {}, [], []
        for key in keys:
            code = older(key)
            if code is not None:
                found[key] = code
            elif key.isalpha():  # letters alone are one unit, not remembered yet
                alone.append(key)
            else:
                parts.append(key)
        codes, fresh, names = dict.fromkeys(alone), [MARK + key for key in alone], list(alone)
        cut, ends, units = [], [], self.units
        for key in parts:
            for unit in units(MARK + key.replace(" ", MARK)):
                k = unit[1:].replace(MARK, " ") if unit[0] == MARK else MARK + unit
                cut.append(k)
                if k not in codes:
                    code = codes[k] = recent(k) or older(k)
                    if code is None:
                        fresh.append(unit)
                        names.append(k)
            ends.append(len(cut))
        coded = dict(zip(names, self._code_anew(fresh), strict=True))
        codes.update(coded)
        found.update(coded)
        new = self.new
        new.update([(key, coded[key]) for key in alone])
        begin = 0
        for key, end in zip(parts, ends, strict=True):
            ks = cut[begin:end]
            begin = end
            found[key] = code = ",".join([codes[k] for k in ks])
            if not coded.keys().isdisjoint(ks):
                new[key] = code
        self._remember(found)
        return found

    def _around(self, part: str) -> str:
        """Code of the few characters next to a stretch."""
        if len(self.beside) >= 1 << 14:
            self.beside.clear()
        ids = [i for u in self.units(MARK + part.replace(" ", MARK)) for i in self.encode_unit(u)]
        code = self.beside[part] = ",".join([self.name[i] for i in ids])
        return code

    def _note(self, keys: list[str], places: list[int]) -> None:
        """Put the stretches of a text that hold new units and are met for the first time, all at
        some of ``places``, down for the comparison: each with the character before it and the
        one after its space, with spaces in between, or right behind the one put down before it."""
        take, beside, around = self.new.pop, self.beside.get, self._around
        given, codes, at = [], [], 0  # the place behind the stretch put down last

        def behind():
            after = keys[at]
            after = after[:1] if after[:1] != " " else after[: len(after) - len(after.lstrip(" ")) + 1]
            given.append(after)
            codes.append(beside(after) or around(after))

        for i in places:
            key = keys[i]
            code = take(key, None)
            if code is None:  # nothing new, or met before
                continue
            if i != at or len(given) >= CHECK_RUN:
                if given:
                    behind()
                    if len(given) >= CHECK_RUN:
                        self._wait(given, codes)
                        given, codes = [], []
                before = keys[i - 1][-1]
                given.append(before)
                codes.append(beside(before) or around(before))
            given.append(key)
            codes.append(code)
            at = i + 1
        if given:
            if at < len(keys):
                behind()
            self._wait(given, codes)

    def _wait(self, given: list[str], codes: list[str]) -> None:
        text = " ".join(given)
        self.fresh.append((text, np.fromstring(",".join(codes), np.int64, sep=",").tolist()))
        self.waiting += len(text)
        if self.waiting >= CHECK_TEXT:
            self.verify()

    def verify(self) -> None:
        """Compare what was coded anew since the last call with the library's codes."""
        fresh, self.fresh, self.waiting = self.fresh, [], 0
        if fresh and self.library.encode([w for w, _ in fresh], num_threads=1) != [ids for _, ids in fresh]:
            raise ValueError("the agenda and the sentencepiece library differ")

    def encode_joined(self, texts: list[str]) -> list[list[str]]:
        """Of each text the comma-joined ids of its stretches, in order."""
        cut, missing, recent = [], set(), self.get
        for text in texts:
            text = text.replace(MARK, " ")
            keys = text.split(" ") if text else []
            if "" in keys:  # several spaces in a row, or at an end
                keys = [x[1:] for x in STRETCHES(" " + text)]
            codes = list(map(recent, keys))
            places = [i for i, code in enumerate(codes) if code is None]
            missing.update([keys[i] for i in places])
            cut.append((keys, codes, places))
        found = self._code(missing)
        for keys, codes, places in cut:
            for i in places:
                codes[i] = found[keys[i]]
            if self.library is not None and self.new:
                self._note(keys, places)
        self.new.clear()
        return [codes for _, codes, _ in cut]

    def encode(self, text: str) -> list[int]:
        return [int(i) for code in self.encode_joined([text])[0] for i in code.split(",")]

    def surface_of(self, codes: list[str]) -> bytes:
        """The bytes that comma-joined ids stand for."""
        out = []
        for lo in range(0, len(codes), 1 << 14):
            ids = np.fromstring(",".join(codes[lo : lo + (1 << 14)]), np.int64, sep=",")
            size = self.length[ids]
            ends = size.cumsum()
            place = np.repeat(self.begin[ids] - ends + size, size)
            place += np.arange(len(place))
            out.append(self.surfaces[place].tobytes())
        return b"".join(out)

    def decode(self, ids) -> str:
        """Text of the ids: surfaces joined, one leading space (the dummy prefix) dropped."""
        data = b"".join(map(self.surface.__getitem__, ids))
        if data[:1] == b" " and self.byte_id.get(32) != next(iter(ids)):
            data = data[1:]
        return data.decode("utf-8", "replace")


_CODERS: dict[tuple[str, bool], PieceCoder] = {}  # of a worker, from task to task


def _code(model_path: str, check: bool, keep_ids: bool):
    def code(batches):
        coder = _CODERS.pop((model_path, check), None) or PieceCoder(model_path, check)
        for batch in batches:
            n, ids_sha, text_sha, lists = [], [], [], []
            for codes in (codes for _, _, texts in text_slices(batch.column(1), SLICE) for codes in coder.encode_joined([raw.decode() for raw in texts])):
                ids = ",".join(codes)
                data = coder.surface_of(codes)
                data = data[1:] if data[:1] == b" " else data
                n.append(ids.count(",") + 1 if ids else 0)
                ids_sha.append(hashlib.sha256(ids.encode()).hexdigest())
                try:
                    data.decode()
                except UnicodeDecodeError:
                    data = data.decode("utf-8", "replace").encode()
                text_sha.append(hashlib.sha256(data).hexdigest())
                if keep_ids:
                    lists.append([int(i) for i in ids.split(",")] if ids else [])
            coder.verify()
            cols = [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
            names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                cols, names = [*cols, pa.array(lists, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(cols, names)
        _CODERS[model_path, check] = coder  # one that was stopped is not kept

    return code


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", check: bool = True, keep_ids: bool = False) -> DataFrame:
    """One row per document: ``id_col``, ``n_tokens``, ``ids_sha256`` (of the comma-joined
    ids), ``decoded_sha256`` (of the decoded UTF-8 text) and, with ``keep_ids``, the ``ids``.

    Whole texts, no begin or end ids, no sampling. A null or empty text has no ids and decodes
    to the empty text. Null and repeated ids are carried through; extra columns are ignored;
    an empty table gives an empty result. ``model_path`` is read on every executor.
    """
    given = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    kinds = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if keep_ids else "")
    return given.mapInArrow(_code(model_path, check, keep_ids), kinds).withColumnRenamed("id", id_col)
