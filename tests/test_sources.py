"""The paged source and the action sink: ranges, restarts, failures and repeats."""

import json
import random
import tracemalloc

import pytest
from pyspark.sql import functions as F

from tidemark.plans import outputs
from tidemark.sources import actions, paged

SCHEMA = "at string, id string, v int"


def put(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(dict(zip(("at", "id", "v"), r, strict=True))) + "\n" for r in sorted(rows)))


def rows(first, n):
    return [(f"2024-01-01T{i // 3600:02d}:{i // 60 % 60:02d}:{i % 60:02d}Z", f"k{i % 3}{i}", i) for i in range(first, first + n)]


def registered(spark, folder, name):
    path = f"file://{folder}"
    paged.register(spark, name, lambda: paged.FileService(path, ("at", "id", "v"), "at", "id"), SCHEMA, "at", "id")
    return name


@pytest.mark.parametrize("size,parts", [(1000, 8), (7, 3), (1, 1)])
def test_a_batch_is_read_in_ranges_of_pages(spark, tmp_path, size, parts):
    many = rows(0, 60) + [("2024-01-01T00:00:30Z", f"same{i}", 100 + i) for i in range(20)]
    put(tmp_path / "s", "a.jsonl", many)
    name = registered(spark, tmp_path / "s", f"paged{size}")
    df = spark.read.format(name).option("page_size", size).option("parts", parts).load()
    assert sorted(r.v for r in df.collect()) == sorted(r[2] for r in many)
    assert df.rdd.getNumPartitions() == parts
    some = spark.read.format(name).option("start", "2024-01-01T00:00:10Z").option("stop", "2024-01-01T00:00:20Z").load()
    assert sorted(r.v for r in some.collect()) == list(range(10, 20))


@pytest.mark.parametrize("block", [1, 7, 64, 1 << 16])
def test_pages_of_overlapping_files_read_by_blocks(tmp_path, monkeypatch, block):
    monkeypatch.setattr(paged, "BLOCK", block)
    rng = random.Random(block)
    many = [(f"2024-01-01T00:00:{rng.randint(0, 20):02d}Z", f"k{i}" + "x" * rng.choice([0, 0, 90]), i) for i in range(300)]
    for n in range(4):
        put(tmp_path / "s", f"{n}.jsonl", many[n * 60 : n * 60 + 60 if n < 3 else 300])
    one = tmp_path / "s" / "2.jsonl"
    one.write_text(one.read_text().replace("}\n{", "}\n\n \n{", 9).rstrip("\n"))  # blank lines, no last line end
    service = paged.FileService(f"file://{tmp_path}/s", ("at", "id", "v"), "at", "id")
    places = sorted(r[:2] for r in many)
    for size in (1, 7, 1000):
        after, got = paged.LOW, []
        while page := service.page(after, paged.HIGH, size):
            got += page
            after = page[-1][:2]
        assert got == sorted(many)
    for _ in range(60):  # in any order, so that no page goes on where the last one ended
        after, upto, size = rng.choice(places), rng.choice([paged.HIGH, *places]), rng.randint(1, 40)
        assert service.page(after, upto, size) == [r for r in sorted(many) if after < r[:2] <= upto][:size]


def test_a_page_holds_no_whole_file(tmp_path):
    put(tmp_path / "s", "a.jsonl", [(f"2024-01-01T{i // 3600:02d}:{i // 60 % 60:02d}:{i % 60:02d}Z", "k" * 100, i) for i in range(40_000)])
    service = paged.FileService(f"file://{tmp_path}/s", ("at", "id", "v"), "at", "id")
    tracemalloc.start()
    after, n = paged.LOW, 0
    while page := service.page(after, paged.HIGH, 500):
        after, n = page[-1][:2], n + len(page)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 40_000 and peak < 2e6 < (tmp_path / "s" / "a.jsonl").stat().st_size / 2


def test_paged_events_keeps_repeated_rows_and_nulls(spark, tmp_path):
    rows = [(1, "2024-01-01 00:00:00", "a")] * 1200 + [(2, None, "b"), (None, "2024-01-02 00:00:00", None)]
    spark.createDataFrame(rows, "event_id long, ts string, event_type string").withColumn("ts", F.col("ts").cast("timestamp_ntz")).write.parquet(str(tmp_path / "events.parquet"))
    got = [tuple(r) for r in outputs.paged_events(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted([(1, "a")] * 1200 + [(2, "b"), (None, None)], key=str)


def test_an_empty_service(spark, tmp_path):
    (tmp_path / "s").mkdir()
    assert spark.read.format(registered(spark, tmp_path / "s", "none")).load().count() == 0


def test_a_stream_goes_on_after_a_restart(spark, tmp_path):
    name = registered(spark, tmp_path / "s", "stream")
    seen = []
    for n, part in enumerate([rows(0, 30), rows(30, 25), [], rows(55, 5) + [("2024-01-01T00:00:59Z", "k9", 99)]]):
        put(tmp_path / "s", f"{n}.jsonl", part)
        stream = spark.readStream.format(name).option("page_size", 4).option("parts", 3).load()
        query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        query.awaitTermination()
        seen += [r[2] for r in part]
        assert sorted(r.v for r in spark.read.parquet(str(tmp_path / "out")).collect()) == sorted(seen)


def test_actions_are_done_once_for_a_batch(spark, tmp_path):
    folder = f"file://{tmp_path}/a"
    df = spark.createDataFrame([("publish", "t", "1"), ("webhook", "http://x", "é"), ("log", None, "3")], actions.SCHEMA).repartition(3)
    for batch in ("one", "one", "two"):
        actions.write(df, folder, batch)
    assert actions.done(spark, folder).count() == 6
    assert len(list((tmp_path / "a" / "actions").iterdir())) == 2 * len({r[0] for r in df.select(F.spark_partition_id()).collect()})


def test_a_failed_task_leaves_nothing_visible(spark, tmp_path):
    folder = f"file://{tmp_path}/a"
    df = spark.createDataFrame([("publish", "t", str(i)) for i in range(20)] + [("odd", "t", "x")], actions.SCHEMA).repartition(4)
    with pytest.raises(Exception, match="no such action"):
        actions.write(df, folder, "one")
    assert actions.done(spark, folder).count() == 0
    actions.write(df.where("kind <> 'odd'"), folder, "one")
    assert actions.done(spark, folder).count() == 20


def test_a_stream_of_actions(spark, tmp_path):
    actions.register(spark)
    folder = f"file://{tmp_path}/a"
    for n in range(2):
        spark.createDataFrame([("log", "l", f"{n}{i}") for i in range(5)], actions.SCHEMA).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
        stream = spark.readStream.schema(actions.SCHEMA).json(str(tmp_path / "in"))
        query = stream.writeStream.format("actions").option("path", folder).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        query.awaitTermination()
    assert sorted(r.payload for r in actions.done(spark, folder).collect()) == sorted(f"{n}{i}" for n in range(2) for i in range(5))
