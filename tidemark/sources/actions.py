"""A Spark data sink for actions: what a batch asks for is done once, whole or not at all.

Rows are (kind, target, payload): publish to a topic, call a webhook, log a line. A task writes its
actions to files of its own attempt and says their names in its commit message. When all tasks are
done, the driver publishes one list of names for the batch; readers and deliverers look only at what
is listed. A failed task or a lost executor leaves unlisted files, which the abort removes; a batch
that comes again finds its list and changes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage

SCHEMA = "kind string, target string, payload string"
#: What an action may be. Fixed values.
KINDS = ("publish", "webhook", "log")


@dataclass
class Done(WriterCommitMessage):
    files: list[str] = field(default_factory=list)
    counts: dict[str, int] = field(default_factory=dict)


def _store(folder: str):
    return pafs.FileSystem.from_uri(folder)


def _write(folder: str, batches: Iterator) -> Done:
    store, inside = _store(folder)
    name, counts, out = f"actions/{uuid.uuid4().hex}.jsonl", {}, None
    try:
        for batch in batches:
            for row in batch.to_pylist():
                if row["kind"] not in KINDS:
                    raise ValueError(f"no such action: {row['kind']!r}")
                if out is None:
                    store.create_dir(f"{inside}/actions", recursive=True)
                    out = store.open_output_stream(f"{inside}/{name}")
                out.write((json.dumps(row, ensure_ascii=False) + "\n").encode())
                counts[row["kind"]] = counts.get(row["kind"], 0) + 1
    finally:
        if out is not None:
            out.close()
    return Done([name] if out is not None else [], counts)


def _remove(folder: str, messages: list) -> None:
    store, inside = _store(folder)
    for message in messages:
        for name in message.files if message is not None else []:
            store.delete_file(f"{inside}/{name}")


def _publish(folder: str, batch: str, messages: list) -> None:
    """The list of a batch, made whole under another name and then moved; a batch that has one keeps it."""
    store, inside = _store(folder)
    final = f"{inside}/done/{batch}.json"
    if store.get_file_info(final).type != pafs.FileType.NotFound:
        _remove(folder, messages)
        return
    store.create_dir(f"{inside}/done", recursive=True)
    counts: dict[str, int] = {}
    for message in messages:
        for kind, n in message.counts.items():
            counts[kind] = counts.get(kind, 0) + n
    part = f"{inside}/done/.{uuid.uuid4().hex}"
    with store.open_output_stream(part) as out:
        out.write(json.dumps({"files": [f for m in messages for f in m.files], "counts": counts}).encode())
    store.move(part, final)


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.folder, self.batch = options["path"], options.get("batch") or uuid.uuid4().hex

    def write(self, iterator: Iterator) -> Done:
        return _write(self.folder, iterator)

    def commit(self, messages: list) -> None:
        _publish(self.folder, self.batch, messages)

    def abort(self, messages: list) -> None:
        _remove(self.folder, messages)


class _StreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, options: dict):
        self.folder = options["path"]

    def write(self, iterator: Iterator) -> Done:
        return _write(self.folder, iterator)

    def commit(self, messages: list, batchId: int) -> None:
        _publish(self.folder, f"{batchId:012d}", messages)

    def abort(self, messages: list, batchId: int) -> None:
        _remove(self.folder, messages)


class Actions(DataSource):
    """Format "actions": option path, a folder that driver and executors share; for batches also batch, a name for idempotence."""

    @classmethod
    def name(cls) -> str:
        return "actions"

    def schema(self) -> str:
        return SCHEMA

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options)

    def streamWriter(self, schema, overwrite: bool) -> _StreamWriter:
        return _StreamWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Actions)


def write(rows: DataFrame, folder: str, batch: str | None = None) -> None:
    """The actions of a batch, once for each name of a batch."""
    register(rows.sparkSession)
    writer = rows.select("kind", "target", "payload").write.format("actions").mode("append").option("path", folder)
    (writer.option("batch", batch) if batch else writer).save()


def done(spark: SparkSession, folder: str) -> DataFrame:
    """The actions of all listed batches: kind, target, payload."""
    store, inside = _store(folder)
    lists = [f for f in store.get_file_info(pafs.FileSelector(f"{inside}/done", allow_not_found=True)) if f.base_name.endswith(".json")]
    files = [name for f in lists for name in json.loads(store.open_input_stream(f.path).read())["files"]]
    return spark.read.schema(SCHEMA).json([f"{folder}/{n}" for n in files]) if files else spark.createDataFrame([], SCHEMA)
