import random
import re
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from feeds import rows
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapledger.operators import (
    dedup_batch,
    conform,
    current_state,
    dedup_first,
    duplicated_keys,
    hourly_partials,
    hourly_profile,
    insert_new,
    latest,
    latest_one,
    network_kpis,
    orphan_keys,
    orphan_sample,
    partials_to_profile,
    require_unique,
    packed_key,
    surrogate_key,
    unpacked_key,
    upsert,
)
from snapledger.operators.merge import DuplicateKeys
from snapledger.operators.profiles import Roles
from snapledger.operators.sizing import broadcast_limit, counted_bytes, estimated_bytes, is_small
from snapledger.sources import AppendTable, VersionedTable, overwrite_days
from snapledger.sources.tables import ConcurrentWrite

FACT = "k long, ts int, v int"


def brute_latest(data):
    newest = {}
    for k, ts, _ in data:
        if k is not None and ts is not None:
            newest[k] = max(ts, newest.get(k, ts))
    return [r for r in data if r[0] in newest and r[1] == newest[r[0]]]


def skewed(seed, n=3000):
    """A third of all rows belong to one key, a third of those are copies of its last row."""
    rng = random.Random(seed)
    data = [(rng.randrange(40), rng.randrange(100), rng.randrange(5)) for _ in range(n)]
    data += [(7, rng.randrange(100), 1) for _ in range(n // 4)] + [(7, 200, 9)] * (n // 4)
    data += [(None, 5, 1), (3, None, 1), (99, None, 1)]
    rng.shuffle(data)
    return data


def key(rows_):
    return sorted(rows_, key=str)


@pytest.mark.parametrize("threshold", ["10m", "-1"])
@pytest.mark.parametrize("partitions", [1, 7])
def test_latest_keeps_ties_and_survives_skew(spark, threshold, partitions):
    data = skewed(1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        df = spark.createDataFrame(data, FACT).repartition(partitions)
        got = latest(df, ["k"], "ts").select("k", "ts", "v")
        assert key(map(tuple, got.collect())) == key(brute_latest(data))
        dimension = spark.createDataFrame([(k, f"n{k}") for k in range(0, 120, 2)] + [(7, "seven")],
                                          "k long, name string")
        got = latest(df, ["k"], "ts", within=dimension)
        assert got.filter("name IS NULL").count() == 0
        wanted = [r for r in brute_latest(data) if r[0] % 2 == 0 or r[0] == 7]
        assert key(map(tuple, got.select("k", "ts", "v").collect())) == key(wanted)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_latest_of_a_large_dimension_scans_once(spark):
    """Without a broadcast: one scan of the fact, and only local maxima cross the exchange, also
    those of a hot key that the dimension lacks."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        data = [(-1, t % 50, t) for t in range(3000)] + skewed(1)
        df = spark.createDataFrame(data, FACT).repartition(3)
        dimension = spark.createDataFrame([(k,) for k in range(120)], "k long")
        got = latest(df, ["k"], "ts", within=dimension)
        text = plan(got)
        assert text.count("Scan ExistingRDD") == 2 and text.count("WindowGroupLimit") == 2
        assert text.rindex("WindowGroupLimit") < text.index("Scan ExistingRDD")
        wanted = [r for r in brute_latest(data) if 0 <= r[0] < 120]
        assert key(map(tuple, got.select("k", "ts", "v").collect())) == key(wanted)
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_latest_without_key_or_instant(spark):
    df = spark.createDataFrame([(None, 5, 1), (1, None, 2), (1, 3, 3), (2, None, 4)], FACT)
    for within in (None, spark.createDataFrame([(1,), (2,), (None,)], "k long")):
        assert [tuple(r) for r in latest(df, ["k"], "ts", within=within).collect()] == [(1, 3, 3)]


def test_latest_one_is_total(spark):
    data = skewed(2)
    df = spark.createDataFrame(data, FACT)
    order = [F.desc_nulls_last("ts"), F.desc_nulls_last("v")]
    got = latest_one(df, ["k"], order).collect()
    assert len(got) == len({r[0] for r in data if r[0] is not None})
    assert next(tuple(r) for r in got if r.k == 7) == (7, 200, 9)


def test_dedup_first_does_not_depend_on_partitioning(spark):
    rng = random.Random(3)
    data = [(rng.randrange(30), rng.randrange(3), i) for i in range(2000)]
    results = []
    for partitions in (1, 5, 13):
        df = spark.createDataFrame(data, "a int, b int, pos int").repartition(partitions)
        results.append(rows(dedup_first(df, ["a", "b"], [F.col("pos")])))
    first = {}
    for a, b, i in data:
        first.setdefault((a, b), i)
    assert results[0] == results[1] == results[2]
    assert {(a, b): i for a, b, i in results[0]} == first


def test_upsert(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, n string, v int")
    source = spark.createDataFrame([(9, "z", 3), (8, "y", 2)], "v int, n string, k int")
    merged = upsert(target, source, ["k"])
    assert rows(merged) == [(1, "a", 1), (2, "y", 8), (3, "z", 9)]
    assert rows(upsert(merged, source, ["k"])) == rows(merged)  # repeating changes nothing
    assert rows(upsert(target, source.limit(0), ["k"])) == rows(target)  # nothing is deleted


def test_insert_ignore_repeats_without_effect(spark):
    target = spark.createDataFrame([(1, 1, "old")], "k int, t int, v string")
    source = spark.createDataFrame([(1, 1, "new"), (1, 2, "new")], "k int, t int, v string")
    new = insert_new(target, source, ["k", "t"])
    assert rows(new) == [(1, 2, "new")]
    assert insert_new(target.unionByName(new), source, ["k", "t"]).count() == 0


def test_duplicates_in_a_merge_source_are_refused(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert rows(duplicated_keys(df, ["k"])) == [(1, 2)]
    with pytest.raises(DuplicateKeys):
        require_unique(df, ["k"])
    assert require_unique(df.distinct(), ["k"]).count() == 2


def test_orphans(spark):
    fact = spark.createDataFrame([(i % 30,) for i in range(300)] + [(None,)], "k int")
    dimension = spark.createDataFrame([(i,) for i in range(12)], "id int")
    orphans = orphan_keys(fact, dimension, "k", "id")
    assert rows(orphans) == sorted([(i,) for i in range(12, 30)], key=str)
    assert [r.k for r in orphan_sample(orphans, "k").collect()] == list(range(12, 22))


SCHEMA = T.StructType([
    T.StructField("a", T.LongType(), False), T.StructField("b", T.DecimalType(5, 2)),
    T.StructField("c", T.DoubleType()), T.StructField("d", T.IntegerType(), False)])


def test_conform(spark):
    df = spark.createDataFrame([("1.005", "7", float("nan"), None)],
                               "b string, a string, c double, d int")
    out = conform(df, SCHEMA, {"d": 3})
    assert out.columns == ["a", "b", "c", "d"]
    assert tuple(out.first()) == (7, Decimal("1.01"), None, 3)
    with pytest.raises(ValueError, match="'d'"):
        conform(df.drop("d"), SCHEMA)
    assert conform(df.drop("d"), SCHEMA, {"d": 4}).first().d == 4


@pytest.mark.parametrize("a, b", [("x", "1"), ("1", "1000"), ("99999999999999999999", "1")])
def test_conform_fails_on_what_does_not_fit(spark, a, b):
    df = spark.createDataFrame([(a, b, 1.0, 1)], "a string, b string, c double, d int")
    with pytest.raises((PySparkException, Py4JJavaError)):
        conform(df, SCHEMA).collect()


def test_surrogate_key_is_repeatable(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("a"), (F.col("id") % 7).alias("b"))
    ids = df.select("a", "b", surrogate_key(["a", "b"]).alias("i")).distinct()
    assert ids.count() == ids.select("i").distinct().count() == 70


def test_packed_key_gives_the_key_back(spark):
    keys = [(k, t) for k in (0, 1, -1, 2**63 - 1, -2**63) for t in (
        "0001-01-01 00:00:00", "1969-12-31 23:59:59.999999", "1970-01-01 00:00:00",
        "2026-01-01 08:05:00.000001", "9999-12-31 23:59:59.999999")]
    df = spark.createDataFrame(keys, "k long, s string").select(
        "k", F.col("s").cast("timestamp").alias("t"))
    number, instant = unpacked_key("i")
    back = df.select("k", "t", packed_key("k", "t").alias("i")).select(
        "i", (number == F.col("k")).alias("k"), (instant == F.col("t")).alias("t"))
    assert back.select("i").distinct().count() == len(keys)
    assert back.filter("k AND t").count() == len(keys)


READINGS = "k long, ts timestamp, v int, f int"
ROLES = Roles(key="k", ts="ts", available="v", capacity="cap", free="f", label="n")


def readings(spark, seed=5, n=2000):
    rng = random.Random(seed)
    data = [(1 if rng.random() < .35 else rng.randrange(20),
             datetime(2026, 1, 1 + rng.randrange(4), rng.randrange(24), rng.randrange(60)),
             rng.randrange(4) if rng.random() < .95 else None, rng.randrange(3))
            for _ in range(n)]
    return spark.createDataFrame(data, READINGS)


def dimension(spark):
    return spark.createDataFrame([(k, f"n{k}", k % 4) for k in range(15)],
                                 "k long, n string, cap int")


def test_profile_from_partials_equals_direct_profile(spark, tmp_path):
    df, dim = readings(spark), dimension(spark)
    direct = rows(hourly_profile(df, dim, ROLES))
    path = str(tmp_path / "partials")
    split = datetime(2026, 1, 3)
    for load in (df.filter(F.col("ts") < F.lit(split)), df.filter(F.col("ts") >= F.lit(split)),
                 df.filter(F.col("ts") >= F.lit(split))):  # a repeated load changes nothing
        overwrite_days(hourly_partials(load, ROLES, day=F.to_date("ts")), path)
    assert rows(partials_to_profile(spark.read.parquet(path), dim, ROLES)) == direct


def test_profile_against_brute_force(spark):
    df, dim = readings(spark), dimension(spark)
    groups = {}
    for r in df.collect():
        if r.k < 15:
            groups.setdefault((r.k, r.ts.hour), []).append(r.v)
    expected = {}
    for (k, hour), values in groups.items():
        known = [v for v in values if v is not None]
        n, total, cap = len(known), sum(known), k % 4
        mean = Decimal((200 * total + n) // (2 * n)) / 100 if n else None
        ratio = Decimal(0) if cap == 0 else \
            (Decimal((2000 * total + n * cap) // (2 * n * cap)) / 1000 if n else None)
        expected[k, hour] = (mean, ratio, sum(v == 0 for v in known), len(values))
    got = {(r.k, r.bucket): (r.mean_available, r.mean_ratio, r.times_empty, r.observations)
           for r in hourly_profile(df, dim, ROLES).collect()}
    assert got == expected


def test_state_and_indicators(spark):
    df = spark.createDataFrame([(1, datetime(2026, 1, 1), 5, 1), (1, datetime(2026, 1, 2), 0, 2),
                                (2, datetime(2026, 1, 1), 9, 0), (99, datetime(2026, 1, 1), 1, 1)],
                               READINGS)
    state = current_state(df, dimension(spark), ROLES)
    assert rows(state, "k", "v", "ratio", "is_empty", "is_full") == [
        (1, 0, Decimal("0.000"), True, False), (2, 9, Decimal("1.000"), False, True)]
    kpis = network_kpis(state, "v", "f", "ts")
    assert tuple(kpis.first()) == (2, 1, 1, Decimal("0.500"), 9, 2, datetime(2026, 1, 2))
    assert tuple(network_kpis(state.limit(0), "v", "f", "ts").first()) == (0, *[None] * 6)


def test_broadcast_only_behind_a_size_check(spark, tmp_path):
    spark.range(200000).selectExpr("id % 7 AS id").write.parquet(str(tmp_path / "big"))
    spark.range(10).write.parquet(str(tmp_path / "small"))
    big, small = (spark.read.parquet(str(tmp_path / n)) for n in ("big", "small"))
    assert counted_bytes(small) == 160 and counted_bytes(big.filter("false")) == 0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "200k")
    try:
        assert broadcast_limit(big) == 200 * 1024
        assert estimated_bytes(big) < 200 * 1024 < counted_bytes(big)  # it compresses well
        assert is_small(small) and not is_small(big)
        exploded = small.selectExpr("id", "explode(sequence(1, 100000)) AS n")
        assert not is_small(exploded)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


TABLE = T.StructType([T.StructField("k", T.LongType(), False), T.StructField("v", T.StringType())])


def test_versioned_table(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), TABLE)
    assert table.read().count() == 0 and table.read().schema == TABLE
    table.replace(spark.createDataFrame([(1, "a")], TABLE))
    reader = table.read()
    table.replace(table.read().unionByName(spark.createDataFrame([(2, "b")], TABLE)))
    assert rows(reader) == [(1, "a")]  # a reader keeps its version
    assert rows(table.read()) == [(1, "a"), (2, "b")]
    # A writer that dies before the commit leaves nothing visible.
    with pytest.raises((PySparkException, Py4JJavaError)):
        table.replace(spark.range(3).select(
            F.col("id").alias("k"), F.raise_error(F.lit("dead")).cast("string").alias("v")))
    assert rows(table.read()) == [(1, "a"), (2, "b")]
    for i in range(4):
        table.replace(spark.createDataFrame([(i, "x")], TABLE))
    assert rows(table.read()) == [(3, "x")] and rows(reader) == [(1, "a")]
    assert len(table.versions()) == 6
    hasty = VersionedTable(spark, str(tmp_path / "t"), TABLE, keep=timedelta(0))
    hasty.replace(hasty.read())
    assert rows(table.read()) == [(3, "x")] and len(table.versions()) == 1


def test_a_version_is_checked_before_it_is_published(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), TABLE)
    table.replace(spark.createDataFrame([(1, "a")], TABLE))

    def refuse(written):
        assert rows(written) == [(2, "b")]
        raise ValueError("broken")

    with pytest.raises(ValueError, match="broken"):
        table.replace(spark.createDataFrame([(2, "b")], TABLE), check=refuse)
    assert rows(table.read()) == [(1, "a")] and len(table.versions()) == 1
    assert len(list((tmp_path / "t").glob("v=*"))) == 1


def test_a_second_writer_of_a_version_is_refused(spark, tmp_path):
    one, two = (VersionedTable(spark, str(tmp_path / "t"), TABLE) for _ in range(2))
    one.replace(spark.createDataFrame([(1, "a")], TABLE))

    def meanwhile(written):
        two.replace(spark.createDataFrame([(2, "b")], TABLE))

    with pytest.raises(ConcurrentWrite):
        one.replace(spark.createDataFrame([(3, "c")], TABLE), check=meanwhile)
    assert rows(one.read()) == [(2, "b")]
    (tmp_path / "t" / "_committed" / "00000003").touch()  # a writer died while committing
    assert rows(one.read()) == [(2, "b")]
    one.replace(spark.createDataFrame([(4, "d")], TABLE))
    assert rows(one.read()) == [(4, "d")]


def formatted(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


LOG = T.StructType([T.StructField("t", T.TimestampType(), False),
                    T.StructField("v", T.IntegerType(), False)])


def test_append_table_prunes_days(spark, tmp_path):
    table = AppendTable(spark, str(tmp_path / "t"), LOG, "t")
    assert table.read().count() == 0
    df = spark.createDataFrame([(datetime(2026, 1, d, 12), d) for d in range(1, 9)], LOG)
    assert table.append(df) == 8
    assert table.append(df.limit(0)) == 0
    assert table.span_of(df.limit(0)) is None and table.colliding(df.limit(0)).count() == 0
    span = table.span_of(df.filter("v IN (2, 4)"))
    assert span == ("2026-01-02 12:00:00", "2026-01-04 12:00:00")
    batch = df.filter("v IN (2, 4)")
    assert rows(table.colliding(batch), "v") == rows(table.colliding(batch, span), "v") == [(2,), (4,)]
    assert "GreaterThanOrEqual(t," in plan(table.colliding(batch))
    recent = table.read(date(2026, 1, 3), date(2026, 1, 4))
    assert rows(recent, "v") == [(3,), (4,)]
    assert re.search(r"PartitionFilters: \[.*day#\d+ >= 2026-01-03", formatted(recent))
    assert len(recent.inputFiles()) == 8  # one file per day, whatever the number of tasks


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_fractional_measures_and_capacities(spark):
    roles = Roles(key="k", ts="t", available="a", capacity="c")
    fact = spark.createDataFrame([(1, datetime(2026, 1, 1, 8), 2.5), (1, datetime(2026, 1, 1, 8, 5), 0.4),
                                  (2, datetime(2026, 1, 1, 8), 0.25)], "k long, t timestamp, a double")
    dimension = spark.createDataFrame([(1, 10.0), (2, 0.5)], "k long, c double")
    hourly = {r.k: r for r in hourly_profile(fact, dimension, roles).collect()}
    assert [float(x) for x in (hourly[1].mean_available, hourly[1].mean_ratio)] == [1.45, 0.145]
    assert hourly[1].times_empty == 0 and float(hourly[2].mean_ratio) == 0.5
    state = {r.k: r for r in current_state(fact, dimension, roles).collect()}
    assert float(state[1].ratio) == 0.04 and not state[1].is_empty
    assert float(state[2].ratio) == 0.5


def test_a_late_first_arrival_is_kept(spark):
    """Events that arrive late are new unless the table has them."""
    stored = spark.createDataFrame([], "k long, t int")
    for batch in ([(1, 1200), (1, 1200)], [(2, 1230)], [(3, 1000), (1, 1200), (4, 1240)]):
        rows_ = dedup_batch(spark.createDataFrame(batch, "k long, t int"), ["k", "t"])
        stored = stored.unionByName(insert_new(stored, rows_, ["k", "t"]))
    assert sorted(map(tuple, stored.collect())) == [(1, 1200), (2, 1230), (3, 1000), (4, 1240)]
