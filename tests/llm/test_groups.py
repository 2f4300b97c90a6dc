"""Sharding, preference pairs, the pipeline, and the query catalog."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from snapledger.llm import bpe, chat, decontam, queries, sharding, stages

from .frames import awkward, documents, empty, sf
from .test_jaccard import slow_groups
from .test_suffix import slow


# sharding

def check_shards(df, shards=sharding.SHARDS):
    rows = sharding.pack(df, shards).collect()
    source = Counter((r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode()))
                     for r in df.select("doc_id", "text").collect())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == source
    slots = defaultdict(list)
    for r in rows:
        assert 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return rows


def test_awkward_shards(spark):
    check_shards(awkward(spark))
    assert sharding.pack(empty(spark)).collect() == []


def test_shards_are_even_and_groups_stay_together(spark):
    rng = np.random.default_rng(1)
    rows = [(i, "w " * int(n)) for i, n in enumerate(rng.integers(1, 60, 6000))]
    rows += [(10_000 + i, "a hot text that a third of all rows carry " * 3) for i in range(3000)]
    rows += [(20_000 + i, f"copy {i // 3} " * 9) for i in range(90)]
    out = check_shards(documents(spark, rows), 8)
    size, count = Counter(), Counter()
    for r in out:
        size[r.shard] += r["size"]
        count[r.shard] += 1
    assert max(size.values()) <= 1.02 * min(size.values())
    assert max(count.values()) <= 1.1 * min(count.values())
    shard = {r.doc_id: r.shard for r in out}
    assert all(len({shard[20_000 + 3 * k + j] for j in range(3)}) == 1 for k in range(30))


def test_copies_of_one_row_are_dealt_out_and_groups_stay_whole(spark):
    """Half of all rows are one row with one id; other groups fill up to most of a shard."""
    rng = np.random.default_rng(2)
    rows = [(i, "w " * int(n)) for i, n in enumerate(rng.integers(20, 60, 4000))]
    rows = [(i, f"{i} {t}") for i, t in rows] + [(77_777, "one row again and again, " * 4)] * 4000
    rows += [(50_000 + 100 * g + i, f"group {g} " * 12) for g in range(6) for i in range(60 + 100 * g)]
    out = check_shards(documents(spark, rows).repartition(5), 8)
    size = Counter()
    for r in out:
        size[r.shard] += r["size"]
    assert max(size.values()) <= 1.02 * min(size.values())
    shards = defaultdict(set)
    for r in out:
        shards[r.text_crc32].add(r.shard)
    hot = zlib.crc32(("one row again and again, " * 4).encode())
    assert len(shards.pop(hot)) == 8 and all(len(s) == 1 for s in shards.values())


def test_result_does_not_depend_on_partitions(spark):
    df = sf(spark)
    one, two = (sorted((r.doc_id, r.shard) for r in sharding.pack(df.repartition(n)).collect())
                for n in (1, 7))
    assert one == two


# preference pairs

def slow_preferences(turns, pairs):
    by = defaultdict(lambda: defaultdict(set))
    for conv, turn, role, text in turns:
        if conv is not None:
            by[conv][turn].add((role, text))
    low = lambda v: (v is not None, v)
    line = {c: {(t, k): said for t, s in ts.items() for k, said in enumerate(
        sorted(s, key=lambda x: (low(x[0]), low(x[1]))))} for c, ts in by.items()}
    out = []
    for pair, chosen, rejected in pairs:
        a, b = line.get(chosen, {}), line.get(rejected, {})
        common = True
        for at in sorted({*a, *b}, key=lambda x: (low(x[0]), x[1])):
            common = common and at in a and at in b and a[at] == b[at]
            sides = [("prompt", a)] if common else [(n, s) for n, s in (("chosen", a), ("rejected", b))
                                                    if at in s]
            for part, side in sides:
                role, text = side[at]
                out.append((pair, part, *at, role, f"<|{role or ''}|>\n{text or ''}<|end|>\n",
                            int(role == "assistant" and part != "prompt"), len(text or ""),
                            bool(a) and bool(b)))
    return sorted(out, key=str)


TURNS = [(0, 0, "user", "hi"), (0, 1, "assistant", "yes"), (0, 2, "user", "more"),
         (1, 0, "user", "hi"), (1, 1, "assistant", "no"), (1, 2, "user", "more"),
         (2, 0, "user", "same"), (2, 1, "assistant", "same"), (3, 0, "user", "same"),
         (3, 1, "assistant", "same"), (4, 0, "user", "alone"), (6, None, None, None), (6, 0, "user", None),
         (7, None, None, None), (7, 0, "user", ""), (None, 0, "user", "lost"), (0, 0, "user", "hi"),
         (8, 0, "user", "x"), (8, 0, "user", "y"), (9, 0, "user", "x"), (9, 1, "assistant", "z"),
         (11, 5, "system", "é" * 9)]


def preferences(df):
    return sorted(map(tuple, chat.format_preferences(df, chat.neighbours(df)).select(
        "pair_id", "part", "turn", "tie", "role", "rendered", "trained", "n_chars", "paired"
    ).collect()), key=str)


def test_preferences(spark):
    df = spark.createDataFrame([(*t, "c", "d") for t in TURNS],
                               "conv_id long, turn long, role string, text string, at string, part string")
    pairs = [(k, 2 * k, 2 * k + 1) for k in range(6)]
    assert preferences(df) == slow_preferences(TURNS, pairs)
    assert preferences(df.filter("false")) == []


def test_preferences_of_the_table(spark):
    df = sf(spark, "conversations")
    turns = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    pairs = sorted({(t[0] // 2, t[0] // 2 * 2, t[0] // 2 * 2 + 1) for t in turns})
    assert preferences(df) == slow_preferences(turns, pairs)


def slow_swapped(turns):
    known = [t for t in turns if t[0] is not None]
    ends = {}
    for conv, turn, role, text in known:
        if role == "assistant" and turn is not None:
            ends[conv] = max(ends.get(conv, (turn, False, "")), (turn, text is not None, text or ""))
    out = [(2 * c, *rest) for c, *rest in known]
    for conv, turn, role, text in known:
        other = ends.get(conv ^ 1)
        if conv in ends and other and (turn is None or turn <= ends[conv][0]):
            if role == "assistant" and turn == ends[conv][0]:
                text = other[2] if other[1] else None
            out.append((2 * conv + 1, turn, role, text))
    return out, [(c, 2 * c, 2 * c + 1) for c in sorted({t[0] for t in known})]


@pytest.mark.parametrize("name", ["made", "table"])
def test_swapped_answers_share_their_prompt(spark, name):
    if name == "made":
        turns = TURNS + [(20, 0, "user", "u"), (20, 1, "assistant", "a"), (20, 1, "assistant", "b"),
                         (21, 3, "assistant", None), (21, 4, "user", "late"), (-2, 0, "assistant", "m"),
                         (-1, 0, "assistant", "n"), (30, 0, "assistant", "no neighbour")]
        df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    else:
        df = sf(spark, "conversations")
        turns = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    out = chat.format_preferences(*chat.swapped(df)).select(
        "pair_id", "part", "turn", "tie", "role", "rendered", "trained", "n_chars", "paired")
    got = sorted(map(tuple, out.collect()), key=str)
    assert got == slow_preferences(*slow_swapped(turns))
    assert any(r[1] == "prompt" for r in got)
    assert chat.format_preferences(*chat.swapped(df.filter("false"))).collect() == []


def test_a_very_long_conversation(spark):
    turns = [(0, k, ("user", "assistant")[k % 2], f"turn {k} " * 20) for k in range(6000)]
    turns += [(1, k, t[2], t[3] if k < 5990 else f"other {k}") for k, t in enumerate(turns)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    out = chat.format_preferences(df, chat.neighbours(df)).groupBy("part").count().collect()
    assert dict(map(tuple, out)) == {"prompt": 5990, "chosen": 10, "rejected": 10}


# pipeline

def test_pipeline_stage_by_stage(spark):
    folder = "/root/testdata/sf0.001"
    docs = sf(spark).select(stages.COLUMNS)
    kept = docs
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in kept.collect()]
        texts = [(r[0], r[1]) for r in before]
        kept = stage(spark, kept, folder)
        if name != "tokens":
            assert kept.columns == stages.COLUMNS
            kept = spark.createDataFrame(kept.collect(), docs.schema)
        rows = {r.doc_id: r for r in kept.collect()}
        if name == "language":
            assert len(rows) >= 0.98 * len(before)
        elif name == "near_duplicates":
            roots, _ = slow_groups([t for _, t in texts])
            least = {}
            for (d, _), root in zip(texts, roots):
                least[root] = min(d, least.get(root, d))
            assert set(rows) == set(least.values())
        elif name == "repeated_passages":
            want = slow(texts)
            assert {d: r.text for d, r in rows.items()} == {
                d: want[d, t][0].decode(errors="ignore") for d, t in texts}
            assert all(r.n_chars == len(r.text) for r in rows.values())
        elif name == "decontamination":
            items = [tuple(r) for r in sf(spark, "benchmark").collect()]
            automaton = decontam.Windows([(str(i), t.encode()) for i, t in items], 10)
            assert set(rows) == {d for d, t in texts if not automaton.scan(t.encode())[1]}
        else:
            model = bpe.Ranks(public_tokenizers.path(stages.VOCABULARY), public_tokenizers.PATTERN)
            assert len(rows) == len(before)
            assert all(model.decode(np.array(rows[d].ids)).decode() == t for d, t in texts)
    whole = corpus_pipeline.run(spark, folder)
    assert sorted(r.ids_sha256 for r in whole.collect()) == sorted(
        r.ids_sha256 for r in rows.values())


def test_stages_take_awkward_rows(spark):
    df = awkward(spark).selectExpr("*", "cast(length(text) as long) n_chars")
    for name, stage in corpus_pipeline.STAGES:
        for docs in (df, df.filter("false")):
            out = stage(spark, docs, "/root/testdata/sf0.001")
            assert name == "tokens" or out.columns == stages.COLUMNS
            assert out.count() <= docs.count()


@pytest.mark.parametrize("name", ["op2_host_rules", "op3_preferences", "op5_decontamination"])
def test_query_agrees_with_sql(spark, name):
    import duckdb
    folder, con = "/root/testdata/sf0.001", duckdb.connect()
    for table in ("documents", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    want = con.execute(queries.ORACLES[name])
    names = [d[0] for d in want.description]
    got = queries.QUERIES[name](spark, folder)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(str, map(tuple, got.select(names).collect()))) == sorted(map(str, want.fetchall()))
