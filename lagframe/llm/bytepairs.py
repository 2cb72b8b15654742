"""Byte-level BPE coding by a lazily determinised finite-state transducer.

Encoding. The encoding of every prefix of a word ends in one token, and a token may follow
another if and only if merging the bytes of the two by rank yields exactly the two. So the
encoding of a prefix is the encoding of a shorter one plus a token. A later token can only start
at a place whose rest so far is a proper prefix of some token; the transducer's state holds, for
each such place, the tokens from the last emitted one up to there. Tokens on which all these
places agree are emitted: after a lookahead that is bounded by the longest token. States and
moves are determined when a byte first asks for them and kept within a bound, so a word of any
length is coded in one pass, and a byte that was met before in its state is one table lookup.

Decoding. Tokens run through an incremental UTF-8 state machine, which holds an incomplete
character back until its bytes are there and replaces ill-formed sequences by U+FFFD.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import text_slices

MEMO_LIMIT = 1 << 19  # words whose codes a worker remembers
STATE_LIMIT = 1 << 18  # states of the transducer that a worker keeps
PAIR_LIMIT = 1 << 19  # pairs of tokens whose fit a worker remembers
PIECES = 1 << 16  # words of one long text that are coded at a time
LONG = 1 << 20  # characters of a long text
SLICE = 1 << 22  # bytes of texts that are held at a time
REPLACED = "�".encode()


class Ranks:
    """Vocabulary of one rank file: merging by rank, and which token may follow which."""

    def __init__(self, tokens: dict[bytes, int]):
        if any(bytes([b]) not in tokens for b in range(256)):
            raise ValueError("every byte must be a token")
        self.rank = tokens
        self.surface = {i: t for t, i in tokens.items()}
        self.begins = {t[:n] for t in tokens for n in range(1, len(t))}  # proper prefixes
        self.made: dict[int, tuple[int, int] | None] = {}
        self.pairs: dict[int, bool] = {}

    def merged(self, data: bytes, most: float = float("inf")) -> list[int]:
        """Tokens of ``data``: the adjacent pair of the lowest rank merges first, the leftmost
        of equal ones; pairs of rank ``most`` or more do not. Quadratic, for one token's bytes."""
        parts, rank = [data[i : i + 1] for i in range(len(data))], self.rank
        while len(parts) > 1:
            found = [(r, i) for i in range(len(parts) - 1) if (r := rank.get(parts[i] + parts[i + 1], most)) < most]
            if not found:
                break
            i = min(found)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [rank[p] for p in parts]

    def parts(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``, itself twice for a byte, None for a token
        that merging its own bytes does not make."""
        if token not in self.made:
            data = self.surface[token]
            found = [token, token] if len(data) == 1 else self.merged(data, token)
            self.made[token] = tuple(found) if len(found) == 2 else None
        return self.made[token]

    def fits(self, left: int, right: int) -> bool:
        """Whether ``right`` may follow ``left``: no merge across their border comes before the
        merges that made them. These are undone from the last on; of equal ones the right is
        the later, and a merge across the border would come between."""
        both = left << 32 | right
        known = self.pairs.get(both)
        if known is None:
            if len(self.pairs) >= PAIR_LIMIT:
                self.pairs.clear()
            known = self.pairs[both] = self._fits(left, right)
        return known

    def _fits(self, left: int, right: int) -> bool:
        surface, rank, before = self.surface, self.rank, float("inf")
        while True:
            a, b = surface[left], surface[right]
            if rank.get(a + b, before) < before:
                return False
            if len(b) > 1 and (left <= right or len(a) == 1):
                before, right = right + 1, self.parts(right)[0]
            elif len(a) > 1:
                before, left = left, self.parts(left)[1]
            else:
                return True


class Transducer:
    """Word bytes -> codes (little-endian unsigned 32-bit ids).

    The key of a state: the last emitted token (-1: none, or not asked for), the bytes since the
    earliest place at which a later token can start, and the tokens up to each place from there."""

    def __init__(self, ranks: Ranks):
        self.ranks = ranks
        self._clear()

    def _clear(self) -> None:
        self.number: dict[tuple, int] = {}
        self.keys: list[tuple] = []
        self.moves: list[dict[int, tuple[int, bytes]]] = []
        self.rest: list[bytes] = []  # what a word that ends in the state still emits
        self._state((-1, b"", ((),)))

    def _state(self, key: tuple) -> int:
        state = self.number.get(key)
        if state is None:
            state = self.number[key] = len(self.keys)
            self.keys.append(key)
            self.moves.append({})
            self.rest.append(code(key[2][-1]))
        return state

    def _move(self, state: int, byte: int) -> tuple[int, bytes]:
        last, tail, chains = self.keys[state]
        ranks, text = self.ranks, tail + bytes([byte])
        for place, chain in enumerate(chains):  # the one token that ends here
            token = ranks.rank.get(text[place:])
            if token is None or ranks.parts(token) is None:
                continue
            left = chain[-1] if chain else last
            if left < 0 or ranks.fits(left, token):
                here = (*chain, token)
                break
        else:
            raise ValueError("the rank file does not describe merges")
        place = 0
        while place < len(text) and text[place:] not in ranks.begins:
            place += 1
        open_ = (*chains[place:], here)
        agreed = 0
        for tokens in zip(*open_, strict=False):
            if len(set(tokens)) > 1:
                break
            agreed += 1
        if agreed:
            last = here[agreed - 1]
        kept = tuple(c[agreed:] for c in open_)
        key = (last if not all(kept) else -1, text[place:], kept)
        move = self.moves[state][byte] = (self._state(key), code(here[:agreed]))
        return move

    def encode(self, data: bytes) -> bytes:
        if len(self.keys) > STATE_LIMIT:
            self._clear()
        state, out, moves = 0, [], self.moves
        for byte in data:
            move = moves[state].get(byte)
            if move is None:
                if len(self.keys) > 2 * STATE_LIMIT:  # within one very long word
                    key = self.keys[state]
                    self._clear()
                    state, moves = self._state(key), self.moves
                move = self._move(state, byte)
            state, emitted = move
            if emitted:
                out.append(emitted)
        out.append(self.rest[state])
        return b"".join(out)


def code(tokens) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return b"".join(t.to_bytes(4, "little") for t in tokens)


def utf8_rows() -> list[list[int]]:
    """Rows of the UTF-8 state machine, one next state per byte: 0 between characters, 1 to 3
    that many continuation bytes to come, 4 to 7 after the lead bytes whose second byte is
    restricted (E0, ED, F0, F4), -1 ill-formed."""
    rows = [[-1] * 256 for _ in range(8)]

    def let(state, lo, hi, then):
        for byte in range(lo, hi + 1):
            rows[state][byte] = then

    let(0, 0x00, 0x7F, 0)
    let(0, 0xC2, 0xDF, 1)
    let(0, 0xE1, 0xEF, 2)
    let(0, 0xF1, 0xF3, 3)
    for lead, state, lo, hi, then in ((0xE0, 4, 0xA0, 0xBF, 1), (0xED, 5, 0x80, 0x9F, 1), (0xF0, 6, 0x90, 0xBF, 2), (0xF4, 7, 0x80, 0x8F, 2)):
        rows[0][lead] = state
        let(state, lo, hi, then)
    for state in (1, 2, 3):
        let(state, 0x80, 0xBF, state - 1)
    return rows


class Utf8Stream:
    """Incremental decoder: bytes in any pieces -> well-formed UTF-8 of the whole characters.

    ASCII keeps the machine between characters, so only the runs of other bytes step through it;
    runs that lead from there back to there unchanged are remembered."""

    ROWS = utf8_rows()
    RUNS = re.compile(rb"[\x80-\xff]+").findall
    whole: set[bytes] = set()

    def __init__(self):
        self.state, self.held = 0, b""

    def feed(self, data: bytes) -> bytes:
        if not self.held and self._whole(data):
            return data
        out, self.state, self.held = self._steps(self.state, self.held, data)
        return out

    def _whole(self, data: bytes) -> bool:
        for run in set(self.RUNS(data)) - self.whole:
            if self._steps(0, b"", run) != (run, 0, b""):
                return False
            if len(run) <= 64:
                if len(self.whole) >= MEMO_LIMIT:
                    self.whole.clear()
                self.whole.add(run)
        return True

    def _steps(self, state: int, held: bytes, data: bytes) -> tuple[bytes, int, bytes]:
        rows, held, out = self.ROWS, bytearray(held), bytearray()
        for byte in data:
            then = rows[state][byte]
            if then < 0 and state:  # the character breaks off; the byte may begin another
                out += REPLACED
                held.clear()
                then = rows[0][byte]
            if then < 0:
                out += REPLACED
                state = 0
                continue
            held.append(byte)
            state = then
            if not state:
                out += held
                held.clear()
        return bytes(out), state, bytes(held)

    def close(self) -> bytes:
        out = REPLACED if self.held else b""
        self.state, self.held = 0, b""
        return out


class Surfaces:
    """Bytes of ids, gathered in numpy."""

    def __init__(self, ranks: Ranks):
        count = max(ranks.surface) + 1
        held = [ranks.surface.get(i, b"") for i in range(count)]
        self.size = np.array([len(t) for t in held], dtype=np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(held), dtype=np.uint8)

    def of(self, coded: bytes) -> bytes:
        ids = np.frombuffer(coded, dtype="<u4")
        size = self.size[ids]
        if not size.all():
            raise ValueError("an id is not in the vocabulary")
        behind = np.cumsum(size)
        place = np.repeat(self.start[ids] - behind + size, size)
        place += np.arange(len(place))
        return self.flat[place].tobytes()


class Codec(dict):
    """One rank file and pattern; as a mapping: word -> its code, remembered within a bound."""

    def __init__(self, tokens: dict[bytes, int], pattern: str):
        super().__init__()
        import regex

        self.ranks = Ranks(tokens)
        self.transducer = Transducer(self.ranks)
        self.words = regex.compile(pattern)
        self.surfaces = Surfaces(self.ranks)

    def __missing__(self, word: str) -> bytes:
        data = word.encode()
        whole = self.ranks.rank.get(data)
        found = code((whole,)) if whole is not None else self.transducer.encode(data)
        if len(word) <= 64:
            if len(self) >= MEMO_LIMIT:
                self.clear()
            self[word] = found
        return found

    def encode(self, text: str):
        """Codes of the text's words; of a long text ``PIECES`` words at a time."""
        if len(text) <= LONG:
            yield b"".join(map(self.__getitem__, self.words.findall(text)))
            return
        found = self.words.finditer(text)
        while batch := [self[m.group()] for m in islice(found, PIECES)]:
            yield b"".join(batch)

    def decode(self, coded: bytes, stream: Utf8Stream) -> bytes:
        """UTF-8 text of the codes; ``stream`` carries an incomplete character along."""
        return stream.feed(self.surfaces.of(coded))


@functools.lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """Codec of a rank file (a token in base64 and its rank on each line), kept by the worker
    from task to task."""
    with open(path, "rb") as f:
        lines = [line.split() for line in f if line.strip()]
    return Codec({base64.b64decode(token): int(rank) for token, rank in lines}, pattern)


def _encode(path: str, pattern: str, keep_ids: bool):
    def run(batches):
        own = codec(path, pattern)
        for batch in batches:
            n, ids_sha, text_sha, lists = [], [], [], []
            for raw in (raw for _, _, texts in text_slices(batch.column(1), SLICE) for raw in texts):
                count, ids, decoded, stream, kept = 0, hashlib.sha256(), hashlib.sha256(), Utf8Stream(), []
                for coded in own.encode(raw.decode("utf-8", "replace")):
                    count += len(coded) // 4
                    ids.update(coded)
                    decoded.update(own.decode(coded, stream))
                    if keep_ids:
                        kept.extend(np.frombuffer(coded, dtype="<u4").tolist())
                decoded.update(stream.close())
                n.append(count)
                ids_sha.append(ids.hexdigest())
                text_sha.append(decoded.hexdigest())
                lists.append(kept)
            cols = [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
            names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                cols, names = [*cols, pa.array(lists, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(cols, names)

    return run


def encode_byte_pairs(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """One row per document: ``id_col``, ``n_tokens``, ``ids_sha256`` (of the ids as
    little-endian unsigned 32-bit integers), ``decoded_sha256`` (of the text that the ids decode
    to) and, with ``keep_ids``, the ``ids``.

    Whole texts, each match of ``pattern`` coded by itself, no special tokens. A null or empty
    text has no ids and decodes to the empty text; a very long text or word is coded in one pass,
    ``PIECES`` words at a time. Null and repeated ids are carried through, equal rows stay;
    extra columns are ignored; an empty table gives an empty result. Bytes of a text that are no
    UTF-8 count as U+FFFD. ``path`` is read on every executor.
    """
    given = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    kinds = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if keep_ids else "")
    return given.mapInArrow(_encode(path, pattern, keep_ids), kinds).withColumnRenamed("id", id_col)


def _decode(path: str, pattern: str):
    def run(batches):
        own = codec(path, pattern)
        for batch in batches:
            texts = []
            for ids in batch.column(1).to_pylist():
                stream = Utf8Stream()
                found = own.decode(np.array(ids or [], dtype="<u4").tobytes(), stream) + stream.close()
                texts.append(None if ids is None else found.decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["id", "text"])

    return run


def decode_byte_pairs(coded: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col`` and ``text`` of each row's ids. Null ids give a null text, no ids the empty
    text; ids that break off within a character give U+FFFD there; an id that the rank file
    does not hold fails the job."""
    given = coded.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return given.mapInArrow(_decode(path, pattern), "id long, text string").withColumnRenamed("id", id_col)
