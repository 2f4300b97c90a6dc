"""Merkle manifest against a plain one that folds lists level by level."""

import zlib
from collections import Counter
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from snapledger.llm import manifest

from .frames import awkward, documents, empty, sf


def text_hash(*parts):
    return sha256("".join(parts).encode("utf-8", "surrogatepass")).hexdigest()


def slow_leaf(row, text):
    values = [row.doc_id, row.source, row.lang, row.n_chars, text]
    return text_hash(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def slow_tree(leaves):
    """Root, and the path (left, right) of each leaf."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([text_hash(*row[i:i + 8]) for i in range(0, len(row), 8)])
    paths = []
    for i in range(len(leaves)):
        path = []
        for row in levels[:-1]:
            first = i // 8 * 8
            path.append(("".join(row[first:i]), "".join(row[i + 1:first + 8])))
            i //= 8
        paths.append(path)
    return levels[-1][0], paths


def lower(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def slow(rows):
    low = lambda v: (v is not None, v)
    langs = sorted({r.lang for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees, subroots = [], []
    for lang in langs:
        own = sorted(((low(r.doc_id), slow_leaf(r, r.text), r) for r in rows if r.lang == lang),
                     key=lambda x: x[:2])
        root, paths = slow_tree([x[1] for x in own])
        subroots.append(root)
        trees.append((own, paths))
    if not langs:
        return Counter()
    root, above = slow_tree(subroots)
    out = []
    for (own, paths), subroot, up in zip(trees, subroots, above):
        for (_, leaf, r), path in zip(own, paths):
            bad = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0
            at = slow_leaf(r, lower(r.text)) if bad else leaf
            for left, right in path + up:
                at = text_hash(left, at, right)
            proof = text_hash(*[s for pair in path + up for s in pair])
            out.append((r.doc_id, leaf, subroot, root, proof, at, at == root))
    return Counter(out)


def proven(df, **rest):
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    out = manifest.prove(df, changed, lambda t: F.translate(t, letters, letters.lower()), **rest)
    return Counter(map(tuple, out.collect()))


def with_length(df):
    return df.withColumn("n_chars", F.length("text").cast("long"))


def test_table(spark):
    df = sf(spark)
    assert proven(df) == slow(df.collect())
    assert sum(not r[-1] for r in proven(df)) > 10


def test_awkward_rows_repeats_and_none(spark):
    df = with_length(awkward(spark))
    assert proven(df) == slow(df.collect())
    twice = df.unionByName(df)
    assert proven(twice) == slow(twice.collect())
    assert not proven(with_length(empty(spark)))


@pytest.mark.parametrize("height", [1, 2])
def test_many_tiers(spark, height):
    """Small blocks, so that a few hundred leaves need several tiers, in one lang and in many."""
    for langs in (1, 3, 150):
        df = with_length(documents(spark, [(i, f"Text {i} " * (i % 4)) for i in range(523)])).withColumn(
            "lang", F.concat(F.lit("l"), F.col("doc_id") % langs)).repartition(5)
        assert proven(df, height=height) == slow(df.collect())


@pytest.mark.parametrize("n", [1, 7, 8, 9, 64, 65, 512, 513])
def test_edges_of_levels(spark, n):
    df = with_length(documents(spark, [(i, f"A{i}") for i in range(n)]))
    assert proven(df) == slow(df.collect())


def test_a_version_shares_what_it_leaves_alone():
    leaves = [bytes([i]) * 32 for i in range(200)]
    tree = manifest.grown(leaves, 3)
    new = manifest.version(tree, 77, 3, b"x" * 32)
    assert new.digest == manifest.grown([*leaves[:77], b"x" * 32, *leaves[78:]], 3).digest
    assert tree.digest == manifest.grown(leaves, 3).digest
    shared = lambda a, b: sum(x is y for x, y in zip(a.children, b.children))
    assert shared(new, tree) == len(tree.children) - 1
    assert shared(new.children[1], tree.children[1]) == 7
    path = manifest.siblings(tree, 77, 3)
    assert manifest.folded(b"x" * 32, path) == new.digest


def test_one_hot_id(spark):
    rows = [(5, f"copy {i % 3}") for i in range(900)] + [(i, f"own {i}") for i in range(300)]
    df = with_length(documents(spark, rows)).repartition(4)
    assert proven(df) == slow(df.collect())
