from functools import reduce

import numpy as np
import pytest
import xxhash

from snapledger.llm.common import Scratch
from snapledger.llm.simhash import (DISTANCE, components, fingerprint, gray_rank, links,
                                    near_duplicates, stars)

from .frames import awkward, documents, empty, sf


def slow_fingerprint(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", "".join(
        c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(rows, distance=DISTANCE):
    codes = [(d, slow_fingerprint(t)) for d, t in rows]
    least = {}
    values = sorted({c for _, c in codes})
    parent = {c: c for c in values}

    def find(c):
        while parent[c] != c:
            c = parent[c]
        return c

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= distance:
                parent[find(a)] = find(b)
    for d, c in codes:
        if d is not None:
            least[find(c)] = min(d, least.get(find(c), d))
    return sorted(((d, f"{c:016x}", least.get(find(c))) for d, c in codes), key=str)


def result(df):
    return sorted(map(tuple, near_duplicates(df).select(
        "doc_id", "fingerprint", "component_id").collect()), key=str)


def test_awkward_rows(spark):
    df = awkward(spark)
    assert result(df) == slow_components([tuple(r) for r in df.select("doc_id", "text").collect()])


def test_empty_table(spark):
    assert near_duplicates(empty(spark)).collect() == []


def test_whole_small_table(spark):
    df = sf(spark)
    assert result(df) == slow_components([tuple(r) for r in df.select("doc_id", "text").collect()])


def test_native_hash_agrees(spark):
    df = spark.createDataFrame([("one two three",)], "s string").selectExpr("xxhash64(s) h")
    assert df.first().h & (1 << 64) - 1 == fingerprint(b"One  two\tTHREE")


@pytest.mark.parametrize("limit", [24, 2048])
def test_links_of_a_crowded_neighbourhood(spark, limit):
    """Thousands of codes around one centre: nodes split, no link is lost."""
    rng = np.random.default_rng(limit)
    centre = int(rng.integers(0, 1 << 63))
    codes = {centre}
    while len(codes) < 900:
        flips = rng.integers(0, 64, rng.integers(1, 7))
        codes.add(centre ^ reduce(lambda a, f: a ^ 1 << int(f), flips, 0))
    codes |= {int(x) for x in rng.integers(0, 1 << 63, 300)}
    codes = sorted(codes)
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    scratch = Scratch(spark, "test")
    found = components(scratch, links(scratch, spark.createDataFrame(
        [(c,) for c in signed], "fp long"), node_limit=limit))
    root = {c: s for c, s in zip(codes, signed)}
    root |= {r.node & (1 << 64) - 1: r.root for r in found.collect()}
    array = np.array(codes, dtype=np.uint64)
    near = np.bitwise_count(array[:, None] ^ array[None, :]) <= DISTANCE
    for i, row in enumerate(near):
        for j in np.flatnonzero(row):
            if i != j:
                assert root[codes[i]] == root[codes[j]]
    sets = {}
    for c, r in root.items():
        sets.setdefault(r, []).append(c)
    for members in sets.values():       # and none is made up: each set is connected
        at = [codes.index(c) for c in members]
        seen, todo = {at[0]}, [at[0]]
        while todo:
            for j in np.flatnonzero(near[todo.pop()]):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        assert set(at) <= seen


def test_index_prunes_but_keeps_links():
    rng = np.random.default_rng(5)
    fp = np.sort(rng.integers(0, 1 << 12, 3000).astype(np.uint64))
    fp = np.unique(fp)
    root = stars(fp, np.zeros(len(fp), dtype=int), 1, chunk=512)
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 1
    i, j = np.nonzero(near)
    assert (root[i] == root[j]).all()


def test_gray_rank(spark):
    codes = [i ^ i >> 1 for i in range(64)]
    df = spark.createDataFrame([(c,) for c in codes], "c long")
    assert [r[0] for r in df.select(gray_rank(df.c)).collect()] == list(range(64))


def test_chain_is_one_component(spark):
    scratch = Scratch(spark, "test")
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "u long, v long")
    assert {(r.node, r.root) for r in components(scratch, edges).collect()} == {
        (i, 0) for i in range(1, 61)} | {(101, 100)}


def test_hot_copies(spark):
    rows = [(i, "same text again and again") for i in range(400)] + [(1000 + i, f"other {i} text x{i}")
                                                                  for i in range(50)]
    assert result(documents(spark, rows)) == slow_components(rows)
