"""Streaming forms over files, compared with their batch results."""

import datetime
import time

from pyspark.sql import functions as F

from tidemark.operators import flatten, routing, tables
from tidemark.sources import generators, readers
from tidemark.streaming import counters, pipelines

START = datetime.datetime(2024, 1, 1)


def files(spark, path, batches, schema):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(f"{path}/b{i}")
    return spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).json(str(path))


def test_first_row_of_each_key_within_a_day(spark, tmp_path):
    at = lambda h: START + datetime.timedelta(hours=h)
    stream = files(spark, tmp_path / "in", [[("a", at(0)), ("a", at(1)), ("b", at(2))], [("a", at(3)), ("c", at(4))]], "k string, ts timestamp")
    query = pipelines.deduplicated(stream, ["k"], "ts").writeStream.format("memory").queryName("deduped").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(r.k for r in spark.table("deduped").collect()) == ["a", "b", "c"]


def test_batches_fan_out_and_restart_where_they_stopped(spark, tmp_path):
    schema = "type string, version int, utcDateTime string, traceId string, data string"
    rows = [(f"x.y.kind{i % 2}", 1, "2024-01-01T00:00:00Z", f"t{i}", '{"attachments": ["f.pdf"], "assignmentId": "A"}' if i % 2 else "{bad") for i in range(6)]
    events, tasks = tables.Folder(spark, f"file://{tmp_path}/events"), tables.Folder(spark, f"file://{tmp_path}/tasks")
    sink = pipelines.fan_out_sink({"events": (flatten.flatten_events, events.append), "tasks": (lambda b: flatten.flatten_events(b).where("attachments <> ''").select("trace_id", "attachments"), tasks.append)})
    for part in (rows[:4], rows[4:]):
        stream = files(spark, tmp_path / "in", [part], schema)
        pipelines.batched(stream, sink, str(tmp_path / "cp")).awaitTermination()
    assert events.read().count() == 6 and tasks.read().count() == 3
    assert {r.status_subtype for r in events.read().collect()} == {"kind0", "kind1"}


def test_messages_wait_for_their_time(spark, tmp_path):
    at = lambda m: START + datetime.timedelta(minutes=m)
    schema = "id string, ts timestamp, retry_at timestamp"
    stream = files(spark, tmp_path / "in", [[("a", at(0), at(5)), ("b", at(0), at(60))], [("c", at(20), at(90))], [("d", at(21), at(95))]], schema)
    held = pipelines.redelivered(stream.withWatermark("ts", "0 seconds"), "id", "retry_at")
    query = held.writeStream.outputMode("append").format("memory").queryName("redelivered").option("checkpointLocation", str(tmp_path / "cp")).start()
    query.processAllAvailable()
    query.stop()
    assert [r.id for r in spark.table("redelivered").collect()] == ["a"]


def test_every_waiting_message_of_a_key_is_redelivered(spark, tmp_path):
    at = lambda m: START + datetime.timedelta(minutes=m)
    schema = "id string, n int, ts timestamp, retry_at timestamp"
    parts = [[("a", 1, at(0), at(5)), ("a", 2, at(0), at(8)), ("a", 3, at(0), at(60))], [("a", None, at(1), at(30)), ("a", 5, at(1), at(99))], [("b", 6, at(20), at(99))], [("b", 7, at(40), at(99))], [("b", 8, at(41), None)]]
    stream = files(spark, tmp_path / "in", parts, schema)
    held = pipelines.redelivered(stream.withWatermark("ts", "0 seconds"), "id", "retry_at")
    query = held.writeStream.outputMode("append").format("memory").queryName("every").option("checkpointLocation", str(tmp_path / "cp")).start()
    query.processAllAvailable()
    query.stop()
    assert sorted((r.n for r in spark.table("every").collect()), key=str) == [1, 2, 8, None]


def test_breaker_opens_waits_and_closes(spark):
    at = lambda s: START + datetime.timedelta(seconds=s)
    calls = [("s", at(i), False) for i in range(5)] + [("s", at(10), True), ("s", at(65), True), ("s", at(66), True), ("s", at(67), True)]
    out = pipelines.breaker_states(spark.createDataFrame(calls, "svc string, ts timestamp, ok boolean"), "svc", "ts", "ok").orderBy("ts").collect()
    assert [(r.allowed, r.state) for r in out] == [(True, "closed")] * 4 + [(True, "open"), (False, "open"), (True, "half_open"), (True, "closed"), (True, "closed")]


def test_keys_of_many_rows_are_folded_in_batches(spark):
    at = lambda h: START + datetime.timedelta(hours=h)
    rows = [(k, i, at(i)) for k in ("a", "b", None) for i in range(100)]
    calls = spark.createDataFrame([(k, i, t, i % 40 >= 20) for k, i, t in rows], "svc string, id int, ts timestamp, ok boolean")
    whole = sorted(pipelines.breaker_states(calls, "svc", "ts", "ok", open_seconds=18_000, order=["id"]).collect(), key=str)
    usual = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        states = pipelines.breaker_states(calls, "svc", "ts", "ok", open_seconds=18_000, order=["id"])
        first = routing.deduplicated_within(calls.select("svc", "id", "ts"), ["svc"], "ts", ["id"], 86_400)
        assert sorted(states.collect(), key=str) == whole and {r.state for r in whole} == {"closed", "open", "half_open"}
        assert sorted((str(r.svc), r.id) for r in first.collect()) == sorted((str(k), i) for k in ("a", "b", None) for i in range(0, 100, 24))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", usual)
    for plan in (states, first):
        made = plan._jdf.queryExecution().executedPlan().toString()
        assert "FlatMapGroups" not in made and "collect_list" not in made


def test_sources(spark, tmp_path):
    (tmp_path / "m.txt").write_text('# HELP x\nx_total{topic="a",le="+Inf"} 3\nup 1\nbad line here\ny NaN\n')
    got = {r.metric: (r.labels, r.value) for r in readers.exposition(spark, str(tmp_path / "m.txt")).collect()}
    assert got["x_total"] == ({"topic": "a", "le": "+Inf"}, 3.0) and got["up"] == ({}, 1.0) and "bad" not in got
    a = generators.events(spark.range(100), 1, 5)
    assert a.exceptAll(generators.events(spark.range(100), 1, 5)).isEmpty()
    assert a.select("event_id").distinct().count() == 100
    assert readers.message_stream(spark, {"kind": "rate"}).isStreaming


def test_cycles(spark, tmp_path):
    stream = files(spark, tmp_path / "in", [[("a", START), ("a", START), ("b", START + datetime.timedelta(seconds=40))]], "k string, ts timestamp")
    query = pipelines.counted_cycles(stream, "ts", "k").writeStream.outputMode("complete").format("memory").queryName("cycles").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted((r.k, r.n) for r in spark.table("cycles").select("k", "n").where(F.col("n") > 0).collect()) == [("a", 2), ("b", 1)]


def test_counters_ride_on_the_batches(spark, tmp_path):
    heard = counters.Counters()
    spark.streams.addListener(heard)
    try:
        for part in ([("a", 1), ("b", 2)], [("a", None), ("c", 5)]):
            stream = files(spark, tmp_path / "in", [part], "k string, n int")
            counted = counters.counting(stream, "written", rows=F.count(F.lit(1)), lacking=F.count_if(F.col("n").isNull()), total=F.sum("n"))
            pipelines.batched(counted, lambda b, i: b.write.mode("append").parquet(str(tmp_path / "out")), str(tmp_path / "cp")).awaitTermination()
        until = time.time() + 20
        while heard.totals["written"]["rows"] < 4 and time.time() < until:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(heard)
    assert dict(heard.totals["written"]) == {"rows": 4, "lacking": 1, "total": 8} and spark.read.parquet(str(tmp_path / "out")).count() == 4
    assert [v["rows"] for _, v in heard.cycles["written"]] == [2, 2]
