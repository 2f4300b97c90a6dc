"""Benchmark passages in documents: one Aho-Corasick automaton over normalised word windows.

The automaton reads words, not characters: a text is normalised and split once, each word is
looked up in the vocabulary of the benchmark, and the sequence of numbers is scanned once for
all windows of all items.  Normalisation keeps the length in bytes, so that hits are mapped to
character offsets of the original text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, pieces, texts

WINDOW = 10
#: About as many bytes of benchmark text are in one automaton (a block), and at most so many words of
#: an item in one of its segments.  A larger benchmark has several blocks.
BLOCK_BYTES, SEGMENT = 2_000_000, 20_000
#: Blocks of together about so many bytes are broadcast for one pass over the documents.
PASS_BYTES = 64_000_000
#: Bytes of documents that are held while several blocks take turns.
CHUNK_BYTES = 64_000_000

#: Letters and digits in lower case and all of UTF-8 beyond ASCII stay, the rest separates.
_NORMAL = bytes(b if b > 127 or chr(b) in "0123456789abcdefghijklmnopqrstuvwxyz"
                else b + 32 if 65 <= b <= 90 else 32 for b in range(256))

_FOUND = ("n_words long, n_hit long, items array<string>, "
          "spans array<struct<start:long,end:long>>, hits array<struct<start:long,end:long>>")
_PAIRS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def union(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Intervals [start, end) in order, those that overlap or touch made one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(runs):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


class Windows:
    """The automaton of a block of (item, text) pairs."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            codes = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1)
                     for w in text.translate(_NORMAL).split()]
            for at in range(max(1, len(codes) - window + 1) if codes else 0):
                owners.setdefault(tuple(codes[at:at + window]), set()).add(item)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for codes, who in owners.items():
            self.automaton.add_word(codes, (len(codes), who))
        if owners:
            self.automaton.make_automaton()
        self.some = bool(owners)

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Words, runs [start, end) of hit words in order, items that occur."""
        words = text.translate(_NORMAL).split()
        found: set[str] = set()
        if not self.some or not words:
            return len(words), [], found
        codes = tuple(map(self.vocabulary.get, words, repeat(0)))
        return len(words), union({(end + 1 - length, end + 1) for end, (length, _) in
                                  self._matches(codes, found)}), found

    def _matches(self, codes, found):
        for end, value in self.automaton.iter(codes):
            found |= value[1]
            yield end, value


def _offsets(text: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Character offsets in the original of runs of words."""
    if not runs:
        return []
    data = np.frombuffer(text, dtype=np.uint8)
    word = np.concatenate([[False], np.frombuffer(text.translate(_NORMAL), np.uint8) != 32, [False]])
    starts = np.flatnonzero(word[1:] & ~word[:-1])
    ends = np.flatnonzero(word[:-1] & ~word[1:])
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return [(int(chars[starts[a]]), int(chars[ends[b - 1]])) for a, b in runs]


#: The block that this worker has built last, and its automaton.
_built: list = [None, None]


def _automaton(block: Broadcast, window: int) -> Windows:
    if _built[0] is not block.value:
        _built[:] = None, None  # the one before goes first
        _built[:] = block.value, Windows(block.value, window)
    return _built[1]


def _gathered(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches that together have about ``limit`` bytes of text."""
    held, size = [], 0
    for batch in pieces(batches, "text"):
        held.append(batch)
        size += batch.column("text").nbytes
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def _pairs(runs: list[list[tuple[int, int]]]) -> pa.Array:
    return pa.array([[{"start": a, "end": b} for a, b in r] for r in runs], _PAIRS)


def _scanner(blocks: list[Broadcast], window: int, width: int, again: bool):
    """Scan for all blocks.  The first ``width`` columns are carried; with ``again`` what earlier
    passes have found follows them."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = list(blocks)
        for held in _gathered(batches, CHUNK_BYTES if len(blocks) > 1 else 1):
            raw = [texts(b.column("text")) for b in held]
            words = [[0] * len(r) for r in raw]
            runs = [[[] for _ in r] for r in raw]
            items = [[set() for _ in r] for r in raw]
            if again:
                for k, batch in enumerate(held):
                    items[k] = [set(i) for i in batch.column(width + 2).to_pylist()]
                    runs[k] = [[(h["start"], h["end"]) for h in r]
                               for r in batch.column(width + 4).to_pylist()]
            for block in order:
                automaton = _automaton(block, window)
                for k, some in enumerate(raw):
                    for j, text in enumerate(some):
                        words[k][j], hits, who = automaton.scan(text)
                        runs[k][j] += hits
                        items[k][j] |= who
            order.reverse()  # the automaton built last comes first in the next turn
            for k, batch in enumerate(held):
                hits = [union(r) for r in runs[k]]
                yield pa.RecordBatch.from_arrays([
                    *batch.columns[:width], pa.array(words[k], pa.int64()),
                    pa.array([sum(b - a for a, b in r) for r in hits], pa.int64()),
                    pa.array([sorted(i) for i in items[k]], pa.list_(pa.string())),
                    _pairs([_offsets(t, r) for t, r in zip(raw[k], hits)]), _pairs(hits)],
                    names=[*batch.schema.names[:width], "n_words", "n_hit", "items", "spans", "hits"])

    return scan


def _segments(window: int):
    """Items as normalised words, long ones cut so that every window is whole in some segment."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "t"):
            for item, text in zip(batch.column("i").to_pylist(), texts(batch.column("t"))):
                words = text.translate(_NORMAL).split()
                starts = range(0, max(1, len(words) - window + 1), SEGMENT) if words else ()
                parts = [b" ".join(words[at:at + SEGMENT + window - 1]).decode() for at in starts]
                yield pa.RecordBatch.from_pydict({"i": pa.array([item] * len(parts), pa.string()),
                                                  "t": pa.array(parts, pa.string())})

    return cut


def find_passages(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  block_bytes: int = BLOCK_BYTES, pass_bytes: int = PASS_BYTES,
                  carry: Sequence[str] = ("doc_id", "text")) -> DataFrame:
    """The columns ``carry`` (text among them), n_words, n_hit, items (ids as strings, sorted), spans (character offsets
    [start, end) of the runs of hit words) for every row of ``documents``.

    Of ``benchmark``, item_id and text are read.  Null and wordless texts have no words and no hits; such items have no window.  Items
    that share an id count once; a null item_id counts as the id ``null``.  Repeated rows come
    out as often as they come in.  An empty benchmark hits nothing.

    Documents are scanned where they lie and never shuffled.  A benchmark above ``block_bytes`` is
    cut into blocks whose automata, built one at a time, take turns over chunks of documents; above
    ``pass_bytes`` the rows are written with what was found so far and scanned again for the next
    blocks, so that neither the driver nor a worker ever holds more of the benchmark than that.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "decontam")
    items = scratch.keep(benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("i"),
        F.coalesce("text", F.lit("")).alias("t"))
        .mapInArrow(_segments(window), "i string, t string").distinct(), "items")
    size = items.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    n_blocks = max(1, -(-size // block_bytes))
    per_pass = max(1, pass_bytes // block_bytes)
    block = F.pmod(F.xxhash64("i", "t"), F.lit(n_blocks))
    found = documents.select(*carry)
    schema = T.StructType([*found.schema.fields, *T.StructType.fromDDL(_FOUND).fields])
    for first in range(0, n_blocks, per_pass):
        last = min(first + per_pass, n_blocks)
        own: list[list[tuple[str, bytes]]] = [[] for _ in range(first, last)]
        for row in items.filter(block.between(first, last - 1)).select("i", "t", block.alias("b")).collect():
            own[row.b - first].append((row.i, row.t.encode()))
        found = found.mapInArrow(_scanner([spark.sparkContext.broadcast(b) for b in own], window,
                                          len(carry), first > 0), schema)
        if last < n_blocks:
            found = scratch.keep(found, f"pass{first}")
            if first:
                scratch.drop(f"pass{first - per_pass}")
    scratch.drop("items")
    return found.select(*carry, "n_words", "n_hit", "items", "spans")
