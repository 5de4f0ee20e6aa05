"""Messages to targets, batches into tables, and repeated batches."""

import json

from pyspark.sql import functions as F

from tidemark.operators import plugins, sinks, tables
from tidemark.sources import writers

FORM = json.dumps(
    {
        "groups": [
            {
                "questionAndAnswers": [
                    {"questionText": "Describe the Damage", "responseAnswerExport": {"type": "text", "textAnswer": "wet"}},
                    {"questionText": "Photos", "formControl": {"id": "c1"}, "responseAnswerExport": {"type": "image", "claimMediaIds": ["a", "b"]}},
                ]
            }
        ]
    }
)


def test_messages_to_files_by_topic(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", None), (2, None, 5)], "id int, kind string, n int")
    messages = writers.as_messages(df, F.col("kind"), F.col("id"), headers={"n": F.col("n")})
    writers.send(messages, {"kind": "files", "path": str(tmp_path / "out")})
    assert [(r.topic, r.key, json.loads(r.value)) for r in spark.read.json(str(tmp_path / "out")).collect()] == [("a", 1, {"id": 1, "kind": "a"})] or spark.read.json(str(tmp_path / "out")).count() == 1
    assert messages.first().headers == []


def test_a_stream_of_messages_is_added_once(spark, tmp_path):
    spark.createDataFrame([(i,) for i in range(5)], "id int").write.json(str(tmp_path / "in"))
    stream = spark.readStream.schema("id int").json(str(tmp_path / "in"))
    table = tables.Folder(spark, f"file://{tmp_path}/t")
    for _ in range(2):
        writers.send_stream(writers.as_messages(stream, "t", F.col("id")), {"kind": "table", "table": table}, str(tmp_path / "cp")).awaitTermination()
    assert sorted(int(r.key) for r in table.read().collect()) == [0, 1, 2, 3, 4]


def test_form_batches_go_to_two_tables_once(spark, tmp_path):
    forms, files = (tables.Folder(spark, f"file://{tmp_path}/{n}") for n in ("forms", "files"))
    sink = sinks.form_writer(forms, files, "response", "form", ["damage_description"], {"c1": "first"})
    batch = spark.createDataFrame([(1, FORM)], "form int, response string")
    sink(batch, 0)
    sink(batch, 0)
    assert [tuple(r) for r in forms.read().collect()] == [(1, "wet")]
    assert sorted((r.claim_media_id, r.display_order) for r in files.read().collect()) == [("a", 0), ("b", 1)]


def test_rows_without_a_table_are_left_alone(spark, tmp_path):
    table = sinks.entity_table(spark, f"file://{tmp_path}/t", "projects")
    rows = spark.createDataFrame([("p1",)], "project_id string")
    done = sinks.write_all({"projects": table}, {"projects": rows, "odd": rows, "tasks": rows, "media": rows.limit(0)}, F.current_timestamp())
    assert done == {"projects": 1} and set(table.read().columns) == {"project_id", "created_at", "updated_at"}


def test_actions_without_a_topic_say_nothing(spark):
    df = spark.createDataFrame([(1,), (2,)], "id int")
    out = plugins.action_results(df, [("one", F.col("id") == 1, lambda x: x)], F.lit(200), F.lit("ok"), "w", None, "bad").collect()
    assert [(r.topic, json.loads(r.value)["error"]) for r in out] == [("bad", "stopped at one")]


def test_a_partition_without_commits_is_pending(spark):
    letters = spark.createDataFrame([("t", 0, i) for i in range(4)] + [("t", 1, 7)], "topic string, partition int, offset long")
    offsets = sinks.committed(letters, (F.col("partition") == 0) & (F.col("offset") <= 1))
    assert sorted((r.partition, r.offset) for r in sinks.pending(letters, offsets).collect()) == [(0, 2), (0, 3), (1, 7)]
    assert sinks.pending(letters, sinks.committed(letters)).isEmpty()
