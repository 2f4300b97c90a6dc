"""Byte-level BPE by rank files, with a segment tree over the byte positions of a piece.

A leaf of the tree holds the rank of the pair that starts at its position, an inner node the
leftmost smallest rank below it.  A merge takes the root's pair, retires one position and
updates the two pairs that touch the new token, each along one path to the root.  Pieces of
equal tree height are merged side by side, one merge of every piece at a time, so the paths are
updated for all of them in one vector operation.  Each worker remembers the pieces it has seen.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import pieces

#: Ranks above all others: no such pair, and its position is the last of ties.
_NONE = np.int64(1) << 60
#: Pieces that a worker remembers before it starts anew.
REMEMBERED = 900_000


def _ranges(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers begin[k], begin[k] + 1, ... of each k, count[k] of them, in a row."""
    done = np.cumsum(count)
    return np.repeat(begin - done + count, count) + np.arange(done[-1] if len(done) else 0)


def _members(name: str, below: int) -> str:
    """The inside of a character class with the code points below ``below`` that match."""
    points = [chr(i) for i in range(below) if not 0xD800 <= i < 0xE000]
    runs: list[list[int]] = []
    for c in map(ord, regex.findall(name, "".join(points))):
        if runs and runs[-1][1] == c - 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{z:08x}" for a, z in runs)


def plain_pattern(pattern: str, below: int) -> str | None:
    """The same pattern for the faster engine, for texts of code points below ``below``: the
    properties are spelled out.  None if it uses others than letters, numbers and white space."""
    inside = {name: _members(name, below) for name in (r"\p{L}", r"\p{N}", r"\s")}
    out, depth, at = [], 0, 0
    while at < len(pattern):
        if pattern[at] == "\\":
            name = pattern[at:at + 5] if pattern[at + 1] in "pP" else pattern[at:at + 2]
            if name in inside:
                out.append(inside[name] if depth else f"[{inside[name]}]")
            elif name == r"\S" and not depth:
                out.append(f"[^{inside[r'\s']}]")
            elif name[1].isalnum():
                return None
            else:
                out.append(name)
            at += len(name)
            continue
        depth += (pattern[at] == "[") - (pattern[at] == "]")
        out.append(pattern[at])
        at += 1
    return "".join(out)


class _Numbers(dict):
    """Numbers strings in order of their first appearance; ``new`` are those since the last
    call of ``learn``."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        self.new.append(piece)
        return number


class Ranks:
    """A rank file (base64 token and rank a line) and the pairs that it merges."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.token = {r: t for t, r in self.rank.items()}
        #: Splitters by the code points that they are right for.
        self.splitters = [(below, re.compile(plain).findall) for below in (128, 1 << 16)
                          if (plain := plain_pattern(pattern, below))]
        self.splitters.append((1 << 21, regex.compile(pattern).findall))
        self.byte = np.array([self.rank[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs = {}
        for token, rank in self.rank.items():
            for cut in range(1, len(token)):
                left, right = self.rank.get(token[:cut]), self.rank.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.pairs = np.array(sorted(pairs), dtype=np.int64)
        self.merged = np.array([pairs[p] for p in self.pairs.tolist()], dtype=np.int64)
        self.forget()

    def of_pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that each pair merges to; ``_NONE`` if there is none."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.merged[at], _NONE)

    def merge(self, data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of pieces in a row, and the number of each piece's; the pieces' lengths share
        a power of two above them."""
        m, length = len(data), np.array([len(d) for d in data])
        width = max(2, 1 << int(length.max() - 1).bit_length())
        flat = np.frombuffer(b"".join(d.ljust(width, b"\0") for d in data), dtype=np.uint8)
        token = self.byte[flat]
        place = np.arange(m * width)        # position p of piece r is r * width + p
        begin = place[::width]
        end = begin + length
        left, right = place - 1, place + 1
        alive = (place.reshape(m, width) < end[:, None]).ravel()
        # a node holds rank << 32 | position, so that the smallest is the leftmost of its rank
        key = np.full(m * width, _NONE)
        some = np.flatnonzero(alive[:-1] & alive[1:] & (place[1:] % width > 0))
        ranks = self.of_pairs(token[some], token[some + 1])
        key[some] = np.where(ranks < _NONE, ranks << 32 | some, _NONE)
        levels = [key]
        while len(levels[-1]) > m:
            levels.append(np.minimum(levels[-1][::2], levels[-1][1::2]))
        rows = np.flatnonzero(levels[-1] < _NONE)
        while len(rows):
            best = levels[-1][rows]
            at, rank = best & 0xFFFFFFFF, best >> 32
            gone = right[at]
            after, before = right[gone], left[at]
            token[at], alive[gone], right[at] = rank, False, after
            follows, leads = after < end[rows], before >= begin[rows]
            left[after[follows]] = at[follows]
            key[gone] = key[at] = _NONE
            first = np.concatenate([at[follows], before[leads]])
            ranks = self.of_pairs(token[first], token[np.concatenate([after[follows], at[leads]])])
            key[first] = np.where(ranks < _NONE, ranks << 32 | first, _NONE)
            path = np.concatenate([gone, at, before[leads]])
            for low, high in zip(levels, levels[1:]):
                path = path >> 1
                high[path] = np.minimum(low[2 * path], low[2 * path + 1])
            rows = rows[levels[-1][rows] < _NONE]
        return token[alive], alive.reshape(m, width).sum(axis=1)

    def split(self, text: str) -> list[str]:
        top = 0 if text.isascii() else ord(max(text))
        return next(split for below, split in self.splitters if top < below)(text)

    def learn(self) -> None:
        """Tokens of the pieces that were numbered last, at the end of the table of tokens."""
        raw = [p.encode() for p in self.seen.new]
        self.seen.new.clear()
        if not raw:
            return
        rank = np.array([self.rank.get(d, -1) for d in raw], dtype=np.int64)
        count = np.ones(len(raw), dtype=np.int64)
        length = np.array([len(d) for d in raw])
        height = np.where(rank >= 0, -1, np.ceil(np.log2(np.maximum(length, 2)))).astype(int)
        found: list[tuple[np.ndarray, np.ndarray]] = [(np.flatnonzero(rank >= 0), rank[rank >= 0])]
        for level in np.unique(height[height >= 0]).tolist():
            group, step = np.flatnonzero(height == level), max(1, (1 << 18) >> level)
            for at in range(0, len(group), step):
                part = group[at:at + step]
                flat, count[part] = self.merge([raw[k] for k in part.tolist()])
                found.append((part, flat))
        ends = np.cumsum(count)
        table = np.empty(ends[-1], dtype=np.int32)
        for part, flat in found:
            table[_ranges(ends[part] - count[part], count[part])] = flat
        self.table_end = np.concatenate([self.table_end, self.table_end[-1] + ends])
        self.table = np.concatenate([self.table, table])

    def forget(self) -> None:
        #: Piece to its number; number n has table[table_end[n]:table_end[n + 1]].
        self.seen = _Numbers()
        self.table = np.zeros(0, dtype=np.int32)
        self.table_end = np.zeros(1, dtype=np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts in a row, and where each text's begin and end."""
        if len(self.seen) > REMEMBERED:
            self.forget()
        split = [self.split(t) for t in texts]
        ends = np.cumsum([0, *map(len, split)])
        number = np.fromiter(map(self.seen.__getitem__, chain.from_iterable(split)),
                             dtype=np.int64, count=int(ends[-1]))
        self.learn()
        begin = self.table_end[number]
        count = self.table_end[number + 1] - begin
        done = np.concatenate([[0], np.cumsum(count)])
        return self.table[_ranges(begin, count)], done[ends]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes that token ids stand for."""
        return b"".join(map(self.token.__getitem__, ids.tolist()))


_loaded: dict[tuple[str, str], Ranks] = {}


def ranks(path: str, pattern: str) -> Ranks:
    """The rank file, read once in a worker."""
    key = (path, pattern)
    if key not in _loaded:
        _loaded[key] = Ranks(path, pattern)
    return _loaded[key]


def encode(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids (array of int), decoded (binary, from the ids) for every row of
    ``documents``; only ``doc_id`` and ``text`` are read.

    Ids are those of the rank file at ``path``, which every executor has; pieces are the matches
    of ``pattern``, and there are no special tokens.  A null text is empty: no ids.  A very long
    text is encoded whole; one long piece (a word of 80,000 letters) takes its task seconds.
    Repeated rows come out as often as they come in.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = ranks(path, pattern)
        for batch in pieces(batches, "text", 1 << 21):
            ids, ends = model.encode([t or "" for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"),
                 pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids)),
                 pa.array([model.decode(ids[a:b]) for a, b in zip(ends, ends[1:])], pa.binary())],
                names=["doc_id", "ids", "decoded"])

    return documents.select("doc_id", "text").mapInArrow(
        work, "doc_id long, ids array<int>, decoded binary")
