"""Ordered scans, as-of lookups and what is built on them, with one key that holds every row."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import metrics, ordered, routing

START = datetime.datetime(2024, 1, 1)


@pytest.fixture
def eight(spark):
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    yield
    spark.conf.set("spark.sql.shuffle.partitions", usual)


def made(spark, keys, n=600, seed=1):
    rng = random.Random(seed)
    rows = [(rng.choice(keys), i, rng.choice([None, i % 7]), START + datetime.timedelta(minutes=rng.randrange(20_000))) for i in range(n)]
    return rows, spark.createDataFrame(rows, "k string, id int, v int, ts timestamp")


def tasks(rows):
    """Rows in each task of a scan."""
    return sorted(r.n for r in rows.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect())


@pytest.mark.parametrize("keys", [["a"], [None, "a", "b"], [f"k{i}" for i in range(200)]])
@pytest.mark.parametrize("reverse", [False, True])
def test_scan_equals_a_loop(spark, eight, keys, reverse):
    rows, df = made(spark, keys)
    line = ordered.ranges(df, ["k"], ["ts", "id"], reverse=reverse)
    got = line.scan(n=ordered.number(), sum=ordered.total(F.col("v")), last=ordered.last(F.col("v")), was=ordered.before(F.col("v")))
    state, want = {}, {}
    for k, i, v, _t in sorted(rows, key=lambda r: (r[3], r[1]), reverse=reverse):
        n, total, last, was = state.get(k, (0, 0, None, None))
        want[i] = (n + 1, total + (v or 0), v if v is not None else last, was)
        state[k] = (*want[i][:3], v)
    assert {r.id: (r.n, r.sum, r.last, r.was) for r in got.result().collect()} == want
    assert {r.id: r.twice for r in got.scan(twice=ordered.total(F.col("n"))).result().collect()}  # a scan of a scan


def test_one_key_is_spread_over_all_tasks(spark, eight):
    _rows, df = made(spark, ["a"], 8_000)
    line = ordered.ranges(df, ["k"], ["ts", "id"]).scan(n=ordered.number(), was=ordered.before(F.col("v")))
    held = tasks(line.rows)
    assert len(held) == 8 and held[-1] <= 2 * held[4]


def test_empty_table(spark):
    none = spark.createDataFrame([], "k string, id int, v int, ts timestamp")
    assert ordered.ranges(none, ["k"], ["ts"]).scan(n=ordered.number()).result().count() == 0
    assert ordered.as_of(none, none, ["k"], F.col("ts"), F.col("ts"), ["v"]).count() == 0
    assert routing.deduplicated_within(none, ["k"], "ts", ["id"], 60).count() == 0


@pytest.mark.parametrize("forward", [False, True])
@pytest.mark.parametrize("keys", [["a"], [None, "a", "b"]])
def test_as_of_equals_a_search(spark, eight, keys, forward):
    rows, left = made(spark, keys, 300, 2)
    more, right = made(spark, keys, 200, 3)
    left = left.unionByName(spark.createDataFrame([("a", -1, 5, None)], left.schema))
    got = ordered.as_of(left, right, ["k"], F.col("ts"), F.col("ts"), ["id"], ["id"], forward=forward)
    want = {-1: None}
    for k, i, _v, t in rows:
        fits = sorted((t2, j) for k2, j, _w, t2 in more if k2 == k and (t2 >= t if forward else t2 <= t))
        want[i] = (fits[0] if forward else fits[-1])[1] if fits else None
    assert {r.id: r.found and r.found.id for r in got.collect()} == want and got.columns == [*left.columns, "found"]


@pytest.mark.parametrize("keys", [["a"], [None, "a", "b"], [f"k{i}" for i in range(100)]])
def test_deduplication_of_a_hot_key_equals_a_loop(spark, eight, keys):
    rows, df = made(spark, keys, 700, 4)
    want, kept = set(), {}
    for k, i, _v, t in sorted(rows, key=lambda r: (r[3], r[1])):
        if k not in kept or t - kept[k] >= datetime.timedelta(hours=3):
            kept[k] = t
            want.add(i)
    df = df.unionByName(spark.createDataFrame([("a", -1, 0, None), ("a", -2, 0, None)], df.schema))
    got = routing.deduplicated_within(df, ["k"], "ts", ["id"], 10_800)
    assert {r.id for r in got.collect()} == want | {-1, -2} and got.columns == df.columns


def test_batches_rates_and_alerts_of_one_series(spark, eight):
    rows, df = made(spark, ["a"], 500, 5)
    by_time = sorted(rows, key=lambda r: (r[3], r[1]))
    assert {r.id: r.batch for r in routing.batches(df, 30, ["ts", "id"], ["k"]).collect()} == {r[1]: n // 30 + 1 for n, r in enumerate(by_time)}
    counter = df.dropDuplicates(["ts"]).withColumn("c", F.pmod(F.col("id") * 7, F.lit(50)).cast("double"))
    points = sorted((r.ts, r.c) for r in counter.collect())
    gains = [0.0] + [b if b < a else b - a for (_, a), (_, b) in zip(points[:-1], points[1:], strict=True)]
    want = {}
    for n, (t, _c) in enumerate(points):
        first = next(m for m, (u, _) in enumerate(points) if (t - u).total_seconds() <= 7200)
        span = (t - points[first][0]).total_seconds()
        want[t] = None if span == 0 else round(sum(gains[first + 1 : n + 1]) / span, 9)
    assert {r.ts: None if r.rate is None else round(r.rate, 9) for r in metrics.rate(counter, ["k"], "ts", "c", 7200).collect()} == want
    runs, run = [], []
    for t, c in [*points, (None, -1)]:
        if c > 20:
            run.append(t)
        elif run:
            runs.append((run[0], run[-1], len(run)))
            run = []
    got = metrics.sustained(counter, ["k"], "ts", F.col("c") > 20, 60).collect()
    assert sorted((r.since, r.until, r.samples) for r in got) == sorted(r for r in runs if (r[1] - r[0]).total_seconds() >= 60)
