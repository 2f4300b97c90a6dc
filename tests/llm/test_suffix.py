import random

import numpy as np
import pytest

from snapledger.llm import suffix
from snapledger.llm.suffix import LENGTH, anchors, remove_repeats

from .frames import awkward, documents, empty, sf


def slow(rows):
    """Kept bytes and runs of each (doc_id, text), by a table of all windows."""
    order = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0))
    seen, out = set(), {}
    for d, t in order:
        data = (t or "").encode()
        gone = np.zeros(len(data), dtype=bool)
        for p in range(len(data) - LENGTH + 1):
            w = data[p:p + LENGTH]
            if w in seen:
                gone[p:p + LENGTH] = True
            seen.add(w)
        flips = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])))
        out[d, t] = (bytes(np.frombuffer(data, np.uint8)[~gone]),
                     list(zip(flips[::2].tolist(), flips[1::2].tolist())))
    return out


def check(df):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    expected = slow(rows)
    got = [(r.doc_id, bytes(r.kept), [tuple(x) for x in r.removed], r.n_bytes)
           for r in remove_repeats(df).collect()]
    want = [(d, *expected[d, t], len((t or "").encode())) for d, t in rows]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_awkward_rows(spark):
    check(awkward(spark))


def test_empty_table(spark):
    assert remove_repeats(empty(spark)).collect() == []


def test_whole_small_table(spark):
    check(sf(spark))


@pytest.mark.parametrize("seed", [1, 2])
def test_few_letters(spark, seed, monkeypatch):
    """Periodic and random texts over two letters, spliced copies, hot passages."""
    rng = random.Random(seed)
    passage = "".join(rng.choices("ab", k=260))
    rows = []
    for i in range(120):
        parts = [rng.choice([passage, passage[rng.randint(0, 200):], "a" * rng.randint(0, 300),
                             "ab" * rng.randint(0, 120), "".join(rng.choices("ab", k=150)),
                             "".join(rng.choices("abcd", k=40))]) for _ in range(rng.randint(0, 5))]
        rows.append((i, "".join(parts)))
    check(documents(spark, rows))


def test_many_buckets_and_hot_line(spark):
    """A line shared by most documents between texts of their own: its token fills many
    buckets, so windows are compared across boundaries."""
    rng = random.Random(3)
    line = "".join(rng.choices("abcdefgh ", k=180))
    rows = [(i, "".join(rng.choices("uvwxyz ", k=90)) + line + "".join(rng.choices("uvwxyz ", k=90)))
            for i in range(300)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        check(documents(spark, rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_shared_id(spark):
    """Two texts under one id: one of them is first, the copy of the other goes."""
    text = "".join(random.Random(4).choices("abcdefgh", k=300))
    got = remove_repeats(documents(spark, [(1, text), (1, text + "!"), (1, text)])).collect()
    kept = sorted(len(r.kept) for r in got)
    assert kept in ([0, 0, 301], [1, 300, 300], [100, 300, 300])


def test_long_text_is_cut_without_loss(spark, monkeypatch):
    """Chunks of a long text hold every window once."""
    monkeypatch.setattr(suffix, "CHUNK", 1000)
    data = np.random.default_rng(1).integers(97, 101, 5000).astype(np.uint8).tobytes()
    windows = []
    for rows, offsets, parts in suffix._blocks([data]):
        text, _, _, first, more, _ = anchors(np.frombuffer(b"".join(parts), np.uint8),
                                             np.cumsum([len(p) for p in parts]))
        for t, a, n in zip(text, first, more):
            windows += range(offsets[t] + a, offsets[t] + a + n + 1)
    assert sorted(windows) == list(range(5000 - LENGTH + 1))


def test_divided_stretches_hold_every_window_once():
    """Runs of a hot token's stretch part its windows, and each holds its core."""
    rng = np.random.default_rng(5)
    offset = rng.integers(0, 77, 300)
    more = np.array([rng.integers(0, o + 1) for o in offset])
    lo = rng.integers(0, 5000, 300)
    heavy = rng.random(300) < 0.7
    rows = np.arange(300)
    row, _, part, core = suffix._divide(rows, rows, lo << 14 | more << 7 | offset, heavy)
    begin, count, before = part >> 14, (part >> 7 & 127) + 1, part & 127
    windows = [(r, w) for r, b, n in zip(row, begin, count) for w in range(b, b + n)]
    assert sorted(windows) == [(r, w) for r in rows for w in range(lo[r], lo[r] + more[r] + 1)]
    assert ((begin + before) == (lo + offset)[row]).all()  # the anchor stays where it is
    cut = core >= 0
    assert (cut == heavy[row]).all()
    last = begin + count - 1
    assert (core[cut] >= last[cut]).all()
    assert (core[cut] + LENGTH - suffix.RUN + 1 <= begin[cut] + LENGTH).all()
