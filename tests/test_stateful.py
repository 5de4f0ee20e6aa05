"""Processors with state: caps, times to live, timers, restarts."""

import json
import time

import pytest

from tidemark.streaming import stateful


def put(folder, n, ids):
    folder.mkdir(exist_ok=True)
    part = folder / f".{n}"
    part.write_text("".join(json.dumps({"k": "a", "id": i}) + "\n" for i in ids))
    part.rename(folder / f"{n}.json")


class Running:
    """A query over a folder that can be stopped and started again."""

    def __init__(self, spark, path, make, out):
        self.spark, self.path, self.make, self.out, self.query = spark, path, make, out, None

    def start(self):
        stream = self.spark.readStream.schema("k string, id string").json(str(self.path / "in"))
        writer = self.make(stream).writeStream.format("json").option("path", str(self.path / self.out)).option("checkpointLocation", str(self.path / "cp"))
        self.query = writer.trigger(processingTime="200 milliseconds").start()

    def rows(self, n, seconds=40, schema="k string, id string, batch long, reason string"):
        """What came out, once there are n rows, or at the end of the time."""
        until = time.time() + seconds
        while True:
            try:
                got = self.spark.read.schema(schema).json(str(self.path / self.out)).collect()
            except Exception:  # noqa: BLE001 - nothing was written yet
                got = []
            if len(got) >= n or time.time() > until:
                return got
            assert self.query is None or self.query.exception() is None
            time.sleep(0.3)


@pytest.fixture
def two(spark):
    spark.conf.set("spark.sql.shuffle.partitions", 2)
    yield
    spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_ids_are_remembered_over_a_restart_until_they_are_evicted(spark, tmp_path, two):
    run = Running(spark, tmp_path, lambda s: stateful.recent_only(s, ["id"], shards=1, most=10), "out")
    put(tmp_path / "in", 0, [f"i{n}" for n in (1, 2, 3, 1, 2)] + [None, None])
    run.start()
    assert sorted(str(r.id) for r in run.rows(4)) == ["None", "i1", "i2", "i3"]
    run.query.stop()
    put(tmp_path / "in", 1, ["i1", "i4", None])
    run.start()
    assert sorted(str(r.id) for r in run.rows(5)) == ["None", "i1", "i2", "i3", "i4"]
    put(tmp_path / "in", 2, [f"j{n}" for n in range(5)])  # ten ids are held
    run.rows(10)
    put(tmp_path / "in", 3, ["j9"])  # one of the oldest goes
    run.rows(11)
    put(tmp_path / "in", 4, ["j0", "j9", "j4", "i4"])
    put(tmp_path / "in", 5, ["last"])
    got = [r.id for r in run.rows(12)]
    run.query.stop()
    assert got.count("j0") == got.count("j9") == got.count("j4") == 1 and len(got) == 12


def test_ids_go_after_their_time(spark, tmp_path, two):
    run = Running(spark, tmp_path, lambda s: stateful.recent_only(s, ["id"], shards=2, ttl_seconds=2), "out")
    put(tmp_path / "in", 0, ["a", "a", "b"])
    run.start()
    assert len(run.rows(2)) == 2
    time.sleep(3)
    put(tmp_path / "in", 1, ["a", "c"])
    got = sorted(r.id for r in run.rows(4))
    run.query.stop()
    assert got == ["a", "a", "b", "c"]


def test_batches_go_by_size_and_by_time(spark, tmp_path, two):
    run = Running(spark, tmp_path, lambda s: stateful.size_or_time(s, ["k"], size=100, seconds=4), "out")
    put(tmp_path / "in", 0, [f"{n:03d}" for n in range(230)])
    run.start()
    full = [r for r in run.rows(200) if r.batch < 3]
    assert {r.batch: r.reason for r in full} == {1: "size", 2: "size"} and sorted(r.id for r in full) == [f"{n:03d}" for n in range(200)]
    run.query.stop()  # thirty rows wait in the state
    run.start()
    late = [r for r in run.rows(230) if r.batch == 3]
    assert len(late) == 30 and {r.reason for r in late} == {"time"}
    put(tmp_path / "in", 1, [f"{n:03d}" for n in range(300, 400)])
    more = run.rows(330)
    run.query.stop()
    assert len(more) == 330 and {r.reason for r in more if r.batch == 4} == {"size"}
