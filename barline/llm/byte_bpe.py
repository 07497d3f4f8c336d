"""Byte-level BPE: encoding of whole texts to ids and back.

Piece boundaries come from :mod:`barline.llm.pretokens`. Pieces seen before are
looked up; new ones of a batch are merged side by side in numpy arrays.
"""

from __future__ import annotations

import base64
import heapq
import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np

import pandas as pd
from pyspark.sql import DataFrame

from barline.llm.pretokens import piece_starts
from barline.llm.ragged import chunks, code_points, word_hashes
from barline.llm.store import Carried

#: Pieces kept per worker; beyond it the table starts anew.
CACHE_PIECES = 250_000
#: Bytes up to which pieces are merged side by side, and from which with a heap.
SHORT_PIECE = 40
LONG_PIECE = 96
NONE = np.iinfo(np.int64).max


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Merge the pair of lowest rank, the leftmost first, until none is left."""
    if piece in ranks:
        return [ranks[piece]]
    if len(piece) > LONG_PIECE:
        return _merge_long(piece, ranks)
    parts = [piece[i:i + 1] for i in range(len(piece))]
    found = [ranks.get(a + b) for a, b in zip(parts, parts[1:])]
    while True:
        best = min((r for r in found if r is not None), default=None)
        if best is None:
            return [ranks[p] for p in parts]
        i = found.index(best)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
        found[i:i + 1] = []
        if i < len(found):
            found[i] = ranks.get(parts[i] + parts[i + 1])
        if i:
            found[i - 1] = ranks.get(parts[i - 1] + parts[i])


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap of pairs, so that time stays near linear."""
    n = len(piece)
    end = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
    heapq.heapify(heap)
    alive = bytearray(b"\x01") * n
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = end[i] if alive[i] else n
        if j >= n or end[j] != stop:
            continue
        alive[j] = 0
        end[i] = stop
        if stop < n:
            before[stop] = i
            if (r := ranks.get(piece[i:end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (k := before[i]) >= 0 and (r := ranks.get(piece[k:stop])) is not None:
            heapq.heappush(heap, (r, k, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = end[i]
    return out


class _Pairs:
    """Which two neighbouring tokens make which token, as one sorted table."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        made = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t))
                if t[:i] in ranks and t[i:] in ranks]
        table = np.array(made, np.int64).reshape(-1, 3)
        keys = table[:, 0] << 32 | table[:, 1]
        order = np.argsort(keys)
        self.keys, self.made = np.append(keys[order], -1), np.append(table[order, 2], NONE)
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        # a table of hashed keys finds most pairs in one step
        self.bits = 21
        self.slot = np.full(1 << self.bits, len(order), np.int64)
        self.slot[self._hash(keys[order])] = np.arange(len(order))
        taken = self.slot[self._hash(keys[order])] != np.arange(len(order))
        self.shared = np.zeros(1 << self.bits, bool)
        self.shared[self._hash(keys[order][taken])] = True

    def _hash(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The token of each pair, NONE where there is none."""
        keys = np.where((left < 0) | (right < 0), -2, left << 32 | right)
        at = self._hash(keys)
        slot = self.slot[at]
        out = np.where(self.keys[slot] == keys, self.made[slot], NONE)
        again = np.flatnonzero(self.shared[at] & (out == NONE) & (keys >= 0))
        if len(again):
            k = keys[again]
            place = np.searchsorted(self.keys[:-1], k)
            out[again] = np.where(self.keys[place] == k, self.made[place], NONE)
        return out


def merge_many(pieces: list[bytes], pairs: _Pairs) -> list[bytes]:
    """Merge many short pieces side by side, one merge of each at a time."""
    n = len(pieces)
    size = np.fromiter(map(len, pieces), np.int64, n)
    width = int(size.max())
    grid = np.full((n, width + 1), -1, np.int64)
    inside = np.arange(width + 1) < size[:, None]
    grid[inside] = pairs.byte[np.frombuffer(b"".join(pieces), np.uint8)]
    rank = pairs.of(grid[:, :-1].ravel(), grid[:, 1:].ravel()).reshape(n, width)
    done: list[bytes] = [b""] * n
    rows = np.arange(n)
    while len(rows):
        at = rank.argmin(axis=1)
        best = rank[np.arange(len(rows)), at]
        open_ = best < NONE
        if not open_.all():
            for i in np.flatnonzero(~open_):
                done[rows[i]] = grid[i][grid[i] >= 0].astype("<u4").tobytes()
            rows, grid, rank, at, best = rows[open_], grid[open_], rank[open_], at[open_], best[open_]
            if not len(rows):
                break
        line = np.arange(len(rows))
        places = np.arange(grid.shape[1] - 1)
        grid[line, at] = best
        move = places > at[:, None]
        grid[:, :-1] = np.where(move, grid[:, 1:], grid[:, :-1])
        grid[:, -1] = -1
        rank[:, :-1] = np.where(move[:, :-1], rank[:, 1:], rank[:, :-1])
        rank[:, -1] = NONE
        rank[line, at] = pairs.of(grid[line, at], grid[line, at + 1])
        left = np.flatnonzero(at > 0)
        rank[left, at[left] - 1] = pairs.of(grid[left, at[left] - 1], grid[left, at[left]])
    return done


def same_pieces(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of each slice among the distinct ones, and where each distinct
    one is found. Slices are told apart by hash, then compared with the one found."""
    _, shown, which = np.unique(word_hashes(points, starts, ends), return_index=True, return_inverse=True)
    size = ends - starts
    other = shown[which]
    if (size != size[other]).any() or not np.array_equal(points, points[np.arange(len(points)) + np.repeat(starts[other] - starts, size)]):
        texts = [points[i:j].tobytes() for i, j in zip(starts.tolist(), ends.tolist())]  # equal hashes of different slices
        first: dict[bytes, int] = {}
        which = np.fromiter((first.setdefault(t, len(first)) for t in texts), np.int64, len(texts))
        shown = np.unique(which, return_index=True)[1]
    return which, shown


class ByteBpe:
    """Encoder and decoder over a rank table; one per Python worker."""

    def __init__(self, ranks: dict[bytes, int], special: dict[str, int] | None = None,
                 merge_pieces: Callable[[list[str]], list[bytes]] | None = None):
        """``merge_pieces`` replaces the own pair merging of pieces not seen before."""
        self.ranks = ranks
        self.special = special or {}
        self.tokens = {i: t for t, i in ranks.items()} | {i: s.encode() for s, i in self.special.items()}
        self.pairs = _Pairs(ranks) if merge_pieces is None else None
        self.merge_pieces = merge_pieces or self._merge_pieces
        self.pieces: dict[str, bytes] = {}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each whole text as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        for a, b in chunks(texts):
            out += self._encode([t or "" for t in texts[a:b]])
        return out

    def spans(self, text: str) -> list[tuple[int, int]]:
        """Code-point offsets of the pieces of one text."""
        points, at = code_points([text])
        starts = piece_starts(points, at[1:] - 1)
        return list(zip(starts[:-1].tolist(), starts[1:].tolist()))

    def _encode(self, texts: list[str]) -> list[bytes]:
        for mark in self.special:
            if any(mark in t for t in texts):
                return [self._with_special(t) for t in texts]
        points, at = code_points(texts)
        starts = np.append(piece_starts(points, at[1:] - 1), len(points))
        lows, highs = starts[:-1], starts[1:]
        which, shown = same_pieces(points, lows, highs)
        joined = " ".join(texts) + " "
        pieces = [joined[i:j] for i, j in zip(lows[shown].tolist(), highs[shown].tolist())]
        ids = list(map(self._known(pieces).__getitem__, pieces))
        flat = np.frombuffer(b"".join(ids), "<u4")
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        count, gaps = size[which], np.searchsorted(starts, at[1:]) - 1
        count[gaps] = 0  # the last piece of each text is the gap behind it
        end = np.cumsum(count)
        took = np.repeat((np.cumsum(size) - size)[which] - end + count, count) + np.arange(int(end[-1]) if len(end) else 0)
        made = flat[took].tobytes()
        cuts = [0, *(4 * end[gaps]).tolist()]
        return [made[i:j] for i, j in zip(cuts, cuts[1:])]

    def _known(self, pieces: list[str]) -> dict[str, bytes]:
        """A table that has the ids of all these pieces."""
        if len(self.pieces) > CACHE_PIECES:
            self.pieces = {}
        known = self.pieces
        new = [p for p in dict.fromkeys(pieces) if p not in known]
        if not new:
            return known
        made = dict(zip(new, self.merge_pieces(new)))
        long = {p: ids for p, ids in made.items() if len(p) > LONG_PIECE}  # not kept
        known.update({p: ids for p, ids in made.items() if p not in long} if long else made)
        return known | long if long else known

    def _merge_pieces(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece, by the own merging: short ones side by side."""
        raw = [p.encode("utf-8", "surrogatepass") for p in pieces]
        made: dict[int, bytes] = {}
        short = []
        for i, r in enumerate(raw):
            if r in self.ranks:
                made[i] = self.ranks[r].to_bytes(4, "little")
            elif len(r) <= SHORT_PIECE:
                short.append((len(r), i))
            else:
                made[i] = np.array(merge(r, self.ranks), "<u4").tobytes()
        short.sort()
        for a in range(0, len(short), 4096):
            part = [i for _, i in short[a:a + 4096]]
            made.update(zip(part, merge_many([raw[i] for i in part], self.pairs)))
        return [made[i] for i in range(len(raw))]

    def _with_special(self, text: str) -> bytes:
        """Special tokens count wherever their text stands."""
        for mark, number in self.special.items():
            if mark in text:
                return np.array([number], "<u4").tobytes().join(self._with_special(t) for t in text.split(mark))
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        pieces = [text[a:b] for a, b in self.spans(text)]
        return b"".join(map(self._known(pieces).__getitem__, pieces))

    def decode(self, ids: bytes) -> bytes:
        """The bytes that the ids stand for."""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def decode_offsets(self, ids: bytes) -> np.ndarray:
        """Byte offset of each token in the decoded text, and the end."""
        sizes = [len(self.tokens[i]) for i in np.frombuffer(ids, "<u4").tolist()]
        return np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)


@lru_cache(maxsize=4)
def from_ranks(path: str, special: tuple[tuple[str, int], ...] = ()) -> ByteBpe:
    """The encoder of a rank file: a base64 token and its rank on each line."""
    return ByteBpe(read_ranks(path), dict(special))


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in lines if line.strip())}


def encode_texts(docs: DataFrame, vocabulary: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
                 digests: bool = False) -> DataFrame:
    """Encode each whole text: ``ids`` (array of int) and ``offsets`` (byte
    offset of each token, and the end), with the columns ``keep``.

    With ``digests`` the ids and the bytes decoded from them are hashed where
    they are made, and only ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``
    leave the task. A NULL text is an empty one and has no ids; repeated rows
    stay repeated; other columns are ignored. ``vocabulary`` must be readable by
    every worker under the same path.
    """
    kept = Carried(docs, keep)
    held = kept.held
    ddl = kept.ddl
    ddl += (", n_tokens long, ids_sha256 string, decoded_sha256 string" if digests
            else ", ids array<int>, offsets array<long>")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = from_ranks(vocabulary)
        for rows in batches:
            texts = rows["t"].tolist()
            for a, b in chunks(texts):
                made = bpe.encode(texts[a:b])
                out = rows.iloc[a:b][held]
                if digests:
                    yield out.assign(
                        n_tokens=[len(i) // 4 for i in made], ids_sha256=[hashlib.sha256(i).hexdigest() for i in made],
                        decoded_sha256=[hashlib.sha256(bpe.decode(i)).hexdigest() for i in made])
                else:
                    yield out.assign(ids=[np.frombuffer(i, "<i4") for i in made],
                                     offsets=[bpe.decode_offsets(i) for i in made])

    return kept.back(docs.select(*kept.columns, docs[text].alias("t")).mapInPandas(run, ddl))


def decode_ids(encoded: DataFrame, vocabulary: str, ids: str = "ids") -> DataFrame:
    """The other columns and ``text``, decoded from ``ids``; NULL ids give NULL."""
    others = [c for c in encoded.columns if c != ids]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.select(*others).schema)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = from_ranks(vocabulary)
        for rows in batches:
            text = [None if i is None else bpe.decode(np.asarray(i, "<u4").tobytes()).decode("utf-8", "replace")
                    for i in rows[ids]]
            yield rows[others].assign(text=text)

    return encoded.mapInPandas(run, (ddl + ", " if ddl else "") + "text string")
