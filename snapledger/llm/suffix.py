"""Repeated passages by a distributed suffix sort.

A byte goes when a 100-byte string over it also starts earlier.  Sorting a suffix per byte
would move a hundred times the corpus, so suffixes are sampled by content: of the ``GRAM``-byte
grams in a window of ``LENGTH`` bytes, the one with the smallest hash is its anchor.  Equal
windows have equal anchors at equal offsets, so only suffixes at anchors (one in about 39) are
sorted, and every window is settled by the anchor that owns it:

1. Anchor suffixes are range-partitioned on their leading token, the hash of their gram, by
   sampled splitters (document and position break ties, so a token that fills a third of the
   corpus is spread).  In a bucket, suffixes whose owned stretch is equal are settled at once:
   all but the first are repeats.  A token with several different stretches, the edge of a
   repeat, goes on, and so do the tokens at a bucket's ends.
2. For those, the stretch itself is fetched and range-partitioned by the token; a bucket
   expands it into windows and sorts them by multikey quicksort on eight-byte tokens.  A token
   that fits a bucket is never cut.  The stretches of one that does not are divided into runs
   of ``RUN`` neighbouring windows and sorted by token and core, the bytes that all windows of
   a run share; equal windows have equal cores, so text of its own parts a hot token's rows.
3. Windows of cores that a bucket's end may cut, the first of each kind in its bucket, are
   compared across boundaries: they are range-partitioned by themselves, and a bucket's first
   window is compared with the last one of the bucket before it.

Equality of stretches in step 1 rests on two independent 64-bit hashes and their lengths, in
step 3 on eight bytes of text and a 64-bit hash, in step 2 on the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, column, partitions, pieces, texts, whole

LENGTH, GRAM = 100, 24
#: Neighbouring windows that a hot token's stretch is divided into; 77 may hold one anchor.
RUN = 11
#: Rows of a bucket, and bytes of text that are worked on at once.
BUCKET, BLOCK, CHUNK = 600_000, 1 << 17, 1 << 20

U = np.uint64
_BASE, _SPAN_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_PLACE = U(0xFFFFFF)

_KEYS = "doc long, tie long, span long"


@cache
def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n + 1, base, dtype=U)
    factors[0] = 1
    return np.cumprod(factors)


def _grams(data: np.ndarray) -> np.ndarray:
    """A mixed hash of the gram at every position."""
    one = data.astype(U)
    power, spans, size = _BASE, {1: one}, 1
    while size * 2 <= GRAM:
        h = spans[size]
        spans[size * 2] = h[:-size] * U(power) + h[size:]
        power, size = power * power % (1 << 64), size * 2
    h, done, rest = spans[size], size, GRAM - size
    while rest:
        part = 1 << rest.bit_length() - 1
        tail = spans[part][done:]
        h = h[:len(tail)] * U(pow(_BASE, part, 1 << 64)) + tail
        done, rest = done + part, rest - part
    h = (h ^ (h >> U(31))) * U(0xBF58476D1CE4E5B9)
    return h ^ (h >> U(29))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size, y = 1, x
    while size * 2 <= width:
        y = np.minimum(y[:-size], y[size:])
        size *= 2
    n = len(x) - width + 1
    return np.minimum(y[:n], y[width - size:width - size + n])


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Over texts that end at ``ends`` of ``data``: text, token, hash of the stretch, first
    window, number of further windows, offset of the anchor in the first one."""
    h = _grams(data)
    width = LENGTH - GRAM + 1
    owner = (_sliding_min((h & ~_PLACE) | np.arange(len(h), dtype=U), width) & _PLACE).astype(
        np.int64)
    first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    last = np.concatenate([first[1:], [len(owner)]]) - 1
    at = owner[first]
    text = np.searchsorted(ends, at, side="right")
    begins = np.concatenate([[0], ends[:-1]])
    first, last = np.maximum(first, begins[text]), np.minimum(last, ends[text] - LENGTH)
    real = first <= last
    text, at, first, last = text[real], at[real], first[real], last[real]
    size = 1 << 17 if len(data) <= 1 << 17 else CHUNK + LENGTH
    sums = np.concatenate([[U(0)], np.cumsum(
        (data.astype(U) + U(1)) * _powers(_SPAN_BASE, size)[:len(data)])])
    stretch = (sums[last + LENGTH] - sums[first]) * _powers(
        pow(_SPAN_BASE, -1, 1 << 64), size)[first]
    more, offset = last - first, at - first
    stretch = (stretch ^ (stretch >> U(32))) * U(_BASE) + (more * 128 + offset).astype(U)
    return text, h[at], stretch, first - begins[text], more, offset


def _blocks(raw: list[bytes]) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Texts of at least a window, gathered to blocks; a long one is cut into overlapping
    chunks that together hold every window once.  Yields rows, offsets, parts."""
    rows, offsets, parts, size = [], [], [], 0
    for k, t in enumerate(raw):
        for at in range(0, len(t) - LENGTH + 1, CHUNK):
            part = t[at:at + CHUNK + LENGTH - 1]
            if parts and size + len(part) > BLOCK:
                yield rows, offsets, parts
                rows, offsets, parts, size = [], [], [], 0
            rows.append(k)
            offsets.append(at)
            parts.append(part)
            size += len(part)
    if parts:
        yield rows, offsets, parts


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text"):
        doc, tie = batch.column("doc").to_numpy(), batch.column("tie").to_numpy()
        for rows, offsets, parts in _blocks(texts(batch.column("text"))):
            text, token, stretch, first, more, offset = anchors(
                np.frombuffer(b"".join(parts), dtype=np.uint8), np.cumsum([len(p) for p in parts]))
            row = np.array(rows)[text]
            span = (first + np.array(offsets)[text]) << 14 | more << 7 | offset
            yield pa.RecordBatch.from_arrays(
                [pa.array(token.view(np.int64)), pa.array(stretch.view(np.int64)),
                 pa.array(doc[row]), pa.array(tie[row]), pa.array(span)],
                names=["token", "stretch", "doc", "tie", "span"])


def _fresh(*columns: np.ndarray) -> np.ndarray:
    """Where a sorted table's row differs from the one before."""
    out = np.ones(len(columns[0]), dtype=bool)
    out[1:] = reduce(np.logical_or, (c[1:] != c[:-1] for c in columns))
    return out


def _spans(kind: int, token, doc, tie, span) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(doc), kind, dtype=np.int32)), pa.array(token), pa.array(doc),
         pa.array(tie), pa.array(span)], names=["kind", "token", "doc", "tie", "span"])


REPEAT, EDGE = 0, 1


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 1 in a bucket."""
    table = whole(batches)
    if table is None:
        return
    token, stretch, doc, tie, span = (column(table, c) for c in
                                      ("token", "stretch", "doc", "tie", "span"))
    order = np.argsort(token, kind="stable")
    ordered = token[order]
    new = _fresh(ordered)
    alone = new & np.concatenate([new[1:], [True]])
    ends = (ordered == ordered[0]) | (ordered == ordered[-1])
    order = order[~alone | ends]
    token, stretch, doc, tie, span = (c[order] for c in (token, stretch, doc, tie, span))
    order = np.lexsort((span, tie, doc, stretch, token))
    token, stretch, doc, tie, span = (c[order] for c in (token, stretch, doc, tie, span))
    head = _fresh(token, stretch)
    at = np.maximum.accumulate(np.where(head, np.arange(len(head)), 0))
    copy = (doc == doc[at]) & (tie == tie[at]) & (span == span[at])
    repeat = ~head & ~copy
    yield _spans(REPEAT, np.zeros(repeat.sum(), np.int64), doc[repeat], tie[repeat], span[repeat])
    heads = np.flatnonzero(head)
    new = _fresh(token[heads])
    several = ~(new & np.concatenate([new[1:], [True]]))
    ends = (token[heads] == token[0]) | (token[heads] == token[-1])
    edge = heads[several | ends]
    yield _spans(EDGE, token[edge], doc[edge], tie[edge], span[edge])


def _divide(row, token, span, heavy) -> tuple[np.ndarray, ...]:
    """Stretches, those of heavy tokens by runs of windows with as many bytes before the anchor:
    row, token, part, place of its core or -1."""
    lo, more, offset = span >> 14, span >> 7 & 127, span & 127
    least = offset - more
    runs = np.where(heavy, offset // RUN - least // RUN + 1, 1)
    k = np.repeat(np.arange(len(span)), runs)
    run = least[k] // RUN + np.arange(len(k)) - np.repeat(np.cumsum(runs) - runs, runs)
    cut = heavy[k]
    before = np.where(cut, np.minimum(offset[k], run * RUN + RUN - 1), offset[k])
    after = np.where(cut, np.maximum(least[k], run * RUN), least[k])
    anchor = lo[k] + offset[k]
    part = (anchor - before) << 14 | (before - after) << 7 | before
    return row[k], token[k], part, np.where(cut, anchor - run * RUN, -1)


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of each edge's stretch, and the core of each run of a heavy token."""
    for batch in pieces(batches, "text"):
        raw = texts(batch.column("text"))
        edges = batch.column("edges")
        counts = np.diff(edges.offsets.to_numpy())
        flat = edges.flatten()
        token, span = (flat.field(c).to_numpy() for c in ("token", "span"))
        heavy = flat.field("heavy").to_numpy(zero_copy_only=False)
        row, token, span, place = _divide(
            np.repeat(np.arange(len(raw)), counts), token, span, heavy)
        lo, n = span >> 14, (span >> 7 & 127) + LENGTH
        bodies = [raw[r][a:a + b] for r, a, b in zip(row.tolist(), lo.tolist(), n.tolist())]
        cores = [None if p < 0 else raw[r][p:p + LENGTH - RUN + 1]
                 for r, p in zip(row.tolist(), place.tolist())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(token), batch.column("doc").take(pa.array(row)),
             batch.column("tie").take(pa.array(row)), pa.array(span),
             pa.array(bodies, pa.binary()), pa.array(cores, pa.binary())],
            names=["token", "doc", "tie", "span", "body", "core"])


def _big_endian(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position on as a number; zeros follow the end."""
    x = np.concatenate([data, np.zeros(8, np.uint8)]).astype(U)
    for size in (1, 2, 4):
        x = x[:-size] << U(8 * size) | x[size:]
    return x[:len(data)]


def repeats(words: np.ndarray, at: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Which windows equal an earlier one of their group.

    Multikey quicksort: windows are sorted by one eight-byte token at a time, and only those
    that tie go on to the next token.  ``at`` is a window's place in ``words``; windows stand in
    order of group, document and position.
    """
    ids = np.arange(len(at))
    for depth in range(0, LENGTH, 8):
        token = words[at[ids] + depth]
        if depth + 8 > LENGTH:
            token = token >> U(8 * (depth + 8 - LENGTH))
        order = np.lexsort((token, group))
        ids, token, group = ids[order], token[order], group[order]
        new = _fresh(group, token)
        tied = ~(new & np.concatenate([new[1:], [True]]))
        group = np.cumsum(new)[tied]
        ids = ids[tied]
        if not len(ids):
            break
    out = np.zeros(len(at), dtype=bool)
    if len(ids):
        out[ids[~_fresh(group)]] = True
    return out


def _windows(span: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, ...]:
    """All windows of stretches: stretch, number in it, place in the buffer."""
    count = (span >> 7 & 127) + 1
    row = np.repeat(np.arange(len(span)), count)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    return row, nth, begin[row] + nth


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 2 in a bucket; of the cores at its ends, windows that are new here are handed on."""
    table = whole(batches)
    if table is None:
        return
    token, core, doc, tie, span = (column(table, c)
                                   for c in ("token", "core", "doc", "tie", "span"))
    heavy = table.column("heavy").to_numpy()
    bodies = table.column("body").combine_chunks()
    order = np.lexsort((span, tie, doc, core, token))
    order = order[_fresh(*(c[order] for c in (token, core, doc, tie, span)))]
    token, core, doc, tie, span, heavy = (c[order] for c in (token, core, doc, tie, span, heavy))
    group = np.cumsum(_fresh(token, core))
    ends = heavy & ((group == group[0]) | (group == group[-1]))
    at = 0
    while at < len(group):
        stop = min(at + 20_000, len(group))
        stop = int(np.searchsorted(group, group[stop - 1], side="right"))
        part = slice(at, stop)
        raw = texts(bodies.take(pa.array(order[part])))
        words = _big_endian(np.frombuffer(b"".join(raw), dtype=np.uint8))
        begin = np.cumsum([0, *map(len, raw)])[:-1]
        row, nth, place = _windows(span[part], begin)
        lo = span[part] >> 14
        found = repeats(words, place, group[part][row])
        hit = np.flatnonzero(found)
        if len(hit):
            start = np.concatenate([[True], (row[hit][1:] != row[hit][:-1])
                                    | (nth[hit][1:] != nth[hit][:-1] + 1)])
            first = hit[start]
            length = np.diff(np.concatenate([np.flatnonzero(start), [len(hit)]])) - 1
            r = row[first]
            yield _windows_out(REPEAT, doc[part][r], tie[part][r],
                               (lo[r] + nth[first]) << 14 | length << 7)
        handed = ends[part][row] & ~found
        if handed.any():
            place, row, nth = place[handed], row[handed], nth[handed]
            h = np.zeros(len(place), dtype=U)
            for depth in range(8, LENGTH, 8):
                word = words[place + depth]
                if depth + 8 > LENGTH:
                    word = word >> U(8 * (depth + 8 - LENGTH))
                h = (h ^ word) * U(_BASE)
                h ^= h >> U(29)
            yield _windows_out(EDGE, doc[part][row], tie[part][row], (lo[row] + nth) << 14,
                               words[place].view(np.int64), h.view(np.int64))
        at = stop


_WINDOW = f"kind int, {_KEYS}, lead long, rest long"


def _windows_out(kind: int, doc, tie, span, lead=None, rest=None) -> pa.RecordBatch:
    nothing = np.zeros(len(doc), dtype=np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(doc), kind, dtype=np.int32)), pa.array(doc), pa.array(tie),
         pa.array(span), pa.array(nothing if lead is None else lead),
         pa.array(nothing if rest is None else rest)],
        names=["kind", "doc", "tie", "span", "lead", "rest"])


FIRST, LAST = 2, 3


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 3 in a bucket; its first and last window are reported for the neighbours."""
    table = whole(batches)
    if table is None:
        return
    names = ("doc", "tie", "span", "lead", "rest")
    order = np.lexsort(tuple(column(table, c) for c in ("span", "tie", "doc", "rest", "lead")))
    doc, tie, span, lead, rest = (column(table, c)[order] for c in names)
    again = ~_fresh(lead, rest)
    yield _windows_out(REPEAT, doc[again], tie[again], span[again])
    for kind, k in ((FIRST, slice(0, 1)), (LAST, slice(-1, None))):
        yield _windows_out(kind, doc[k], tie[k], span[k], lead[k], rest[k])


def _key(tie: Column) -> list[Column]:
    return [F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc"), tie.alias("tie")]


def _cutter(as_text: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in pieces(batches, "text"):
            raw = texts(batch.column("text"))
            kept, runs = [], []
            for text, spans in zip(raw, batch.column("spans")):
                span = np.sort(spans.values.to_numpy()) if spans.is_valid else np.zeros(0, np.int64)
                lo, hi = span >> 14, (span >> 14) + (span >> 7 & 127) + LENGTH
                if len(lo):
                    reach = np.maximum.accumulate(hi)
                    start = np.concatenate([[True], lo[1:] > reach[:-1]])
                    lo, hi = lo[start], reach[np.concatenate([np.flatnonzero(start)[1:] - 1,
                                                              [len(hi) - 1]])]
                edges = [0, *np.stack([lo, hi], axis=1).ravel().tolist(), len(text)]
                rest = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                kept.append(rest.decode(errors="ignore") if as_text else rest)
                runs.append([{"start": a, "end": b} for a, b in zip(lo.tolist(), hi.tolist())])
            carried = [c for c in batch.schema.names if c not in ("text", "spans")]
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, carried), pa.array([len(t) for t in raw], pa.int64()),
                 pa.array(runs, pair), pa.array(kept, pa.string() if as_text else pa.binary())],
                names=[*carried, "n_bytes", "removed", "kept"])

    return cut


def remove_repeats(documents: DataFrame, carry: Sequence[str] = ("doc_id",),
                   as_text: bool = False) -> DataFrame:
    """The columns ``carry``, n_bytes, removed (byte runs [start, end) in order), kept (the
    remaining bytes) for every row of ``documents``; doc_id, text and ``carry`` are read.  With
    ``as_text``, kept is a string, without the bytes of characters that a run has cut through.

    A byte is removed if a 100-byte string over it also starts earlier: in a document with a
    smaller doc_id, or earlier in the same document.  Strings are judged on the input.  A null
    doc_id is smaller than all others.  Documents that share a doc_id are ordered by a hash of
    their text; rows that repeat doc_id and text are one document and come out alike.  A null
    text is empty, a text below 100 bytes stays whole.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "suffix")
    ids = documents.groupBy("doc_id").count().filter("count > 1")
    tie = F.lit(0).cast("long") if ids.isEmpty() else F.xxhash64(F.coalesce("text", F.lit("")))
    keyed = documents.select("text", *_key(tie))
    size = documents.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]

    suffixes = keyed.filter(F.octet_length("text") >= LENGTH).mapInArrow(
        _sample, f"token long, stretch long, {_KEYS}")
    marks = scratch.keep(suffixes.repartitionByRange(
        partitions(spark, size // 39, BUCKET), "token", "stretch", "doc", "tie", "span").mapInArrow(
        _settle, f"kind int, token long, {_KEYS}"), "marks")

    edges = marks.filter(F.col("kind") == EDGE)
    n_edges = edges.count()
    buckets = partitions(spark, n_edges, BUCKET // 4)
    # Tokens that an even share of the edges cannot hold: fewer than there are buckets.
    hot = edges.groupBy("token").count().filter(F.col("count") * buckets > n_edges).select(
        "token", F.lit(True).alias("heavy"))
    grouped = edges.join(F.broadcast(hot), "token", "left").groupBy("doc", "tie").agg(
        F.collect_set(F.struct("token", "span", F.coalesce("heavy", F.lit(False)).alias("heavy")))
        .alias("edges"))
    bodies = keyed.join(grouped, ["doc", "tie"]).mapInArrow(
        _fetch, f"token long, {_KEYS}, body binary, core binary").select(
        "token", "doc", "tie", "span", "body", F.xxhash64("core").alias("core"),
        F.col("core").isNotNull().alias("heavy"))
    spread = F.when(F.col("heavy"), F.xxhash64("doc", "tie", "span"))
    inner = scratch.keep(bodies.repartitionByRange(buckets, "token", "core", spread).mapInArrow(
        _compare, _WINDOW), "inner")

    open_windows = inner.filter(F.col("kind") == EDGE)
    across = scratch.keep(open_windows.repartitionByRange(
        partitions(spark, open_windows.count(), BUCKET), "lead", "rest", "doc", "tie", "span")
        .mapInArrow(_across, _WINDOW), "across")
    rows = sorted((r.lead, r.rest, r.doc, r.tie, r.span, r.kind) for r in
                  across.filter(F.col("kind") >= FIRST).collect())  # two rows a bucket
    late = [b[2:5] for a, b in zip(rows, rows[1:])
            if a[5] == LAST and b[5] == FIRST and a[:2] == b[:2]]
    spans = reduce(DataFrame.unionByName, [
        *(t.filter(F.col("kind") == REPEAT).select("doc", "tie", "span")
          for t in (marks, inner, across)), spark.createDataFrame(late, _KEYS)])
    grouped = spans.groupBy("doc", "tie").agg(F.collect_list("span").alias("spans"))
    whole_rows = documents.select(*carry, "text", *_key(tie))
    rows = whole_rows.join(grouped, ["doc", "tie"], "left").select(*carry, "text", "spans")
    schema = T.StructType([
        *documents.select(*carry).schema.fields, *T.StructType.fromDDL(
            "n_bytes long, removed array<struct<start:long,end:long>>, kept "
            + ("string" if as_text else "binary")).fields])
    return rows.mapInArrow(_cutter(as_text), schema)
