"""Plugins as transforms: handlers by event type, chains with a status, rules that give actions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import ordered

HANDLERS: dict[str, Callable[[DataFrame], dict[str, DataFrame]]] = {}


def handles(*event_types: str):
    """Registers a handler (events -> rows by table) for event types."""

    def register(handler):
        HANDLERS.update(dict.fromkeys(event_types, handler))
        return handler

    return register


def fan_out(events: DataFrame, kind: str, handlers: dict | None = None) -> dict[str, DataFrame]:
    """The rows of all handlers by table; each handler sees the events of its types in one pass."""
    handlers = HANDLERS if handlers is None else handlers
    out: dict[str, DataFrame] = {}
    for handler in dict.fromkeys(handlers.values()):
        own = [k for k, v in handlers.items() if v is handler]
        for table, rows in handler(events.where(F.col(kind).isin(*own))).items():
            out[table] = out[table].unionByName(rows, allowMissingColumns=True) if table in out else rows
    return out


def unhandled(events: DataFrame, kind: str, handlers: dict | None = None) -> DataFrame:
    """Events by type that no handler takes."""
    known = list(HANDLERS if handlers is None else handlers)
    return events.where(~F.col(kind).isin(*known)).groupBy(kind).agg(F.count("*").alias("n"))


@dataclass(frozen=True)
class Plugin:
    """A transform for some domains, stages and event types (none named: all)."""

    name: str
    run: Callable[[DataFrame], DataFrame]
    priority: int = 100
    domains: tuple[str, ...] = ()
    stages: tuple[str, ...] = ()
    event_types: tuple[str, ...] = ()

    def applies(self, domain: Column, stage: Column, kind: Column) -> Column:
        out = F.lit(True)
        for names, c in ((self.domains, domain), (self.stages, stage), (self.event_types, kind)):
            out = out & (c.isin(*names) if names else F.lit(True))
        return out


@dataclass
class Registry:
    plugins: list[Plugin] = field(default_factory=list)

    def add(self, plugin: Plugin) -> None:
        self.plugins = sorted([*self.plugins, plugin], key=lambda p: (p.priority, p.name))

    def run(self, df: DataFrame, domain: str = "domain", stage: str = "stage", kind: str = "event_type") -> DataFrame:
        """Actions of all plugins on their rows, with the plugin's name, below each other in priority."""
        outs = [p.run(df.where(p.applies(F.col(domain), F.col(stage), F.col(kind)))).withColumn("plugin", F.lit(p.name)) for p in self.plugins]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), outs)


def chained(df: DataFrame, steps: list[tuple[str, Column, Callable[[DataFrame], DataFrame]]]) -> DataFrame:
    """Steps in turn on df with chain_status and chain_step; the first step whose condition fails stops a row.

    steps: name, condition that a row must meet, transform. A stopped row keeps its columns.
    """
    df = df.withColumns({"chain_status": F.lit("ok"), "chain_step": F.lit(None).cast("string")})
    for name, condition, transform in steps:
        stop = (F.col("chain_status") == "ok") & ~F.coalesce(condition, F.lit(False))
        df = df.withColumns({"chain_step": F.when(stop, name).otherwise(F.col("chain_step")), "chain_status": F.when(stop, "stopped").otherwise(F.col("chain_status"))})
        df = transform(df)
    return df


def action_results(messages: DataFrame, steps: list[tuple[str, Column, Callable[[DataFrame], DataFrame]]], status: Column, response: Column, worker: str, success_topic: str | None, error_topic: str | None) -> DataFrame:
    """What a worker says about each message, as topic, value: enriched and answered ones to the success topic,
    those that a step stopped or whose answer is an error to the error topic. A missing topic says nothing.

    status and response are the answer's columns after the steps.
    """
    original = F.to_json(F.struct(*messages.columns))
    done = chained(messages.withColumn("__original", original), steps).withColumn("__status", status).withColumn("__response", response)
    stopped = F.col("chain_status") != "ok"
    failed = stopped | F.coalesce(F.col("__status") >= 400, F.lit(True))
    enriched = [c for c in done.columns if not c.startswith("__") and c not in ("chain_status", "chain_step")]
    cause = F.when(stopped, F.concat(F.lit("stopped at "), F.col("chain_step"))).otherwise(F.concat(F.lit("API error "), F.coalesce(F.col("__status").cast("string"), F.lit("none")), F.lit(": "), F.left(F.coalesce("__response", F.lit("")), F.lit(200))))
    good = F.to_json(F.struct(F.struct(*enriched).alias("enriched_data"), F.col("__response").alias("response"), F.col("__status").alias("status_code"), F.lit(worker).alias("worker_name")))
    bad = F.to_json(F.struct(F.col("__original").alias("original_message"), cause.alias("error"), F.lit(worker).alias("worker_name")))
    topic = F.when(failed, F.lit(error_topic).cast("string")).otherwise(F.lit(success_topic).cast("string"))
    return done.select(topic.alias("topic"), F.when(failed, bad).otherwise(good).alias("value")).where(F.col("topic").isNotNull())


def triggered(events: DataFrame, rules: DataFrame, key: str, kind: str) -> DataFrame:
    """One row for each action of the rules that match an event's key and kind.

    rules: key, on (event type, null for all), actions array<struct<action, target>>. Rules are
    configuration; the optimiser broadcasts them by their size.
    """
    on = (F.col(f"e.{key}") == F.col(f"r.{key}")) & (F.col("r.on").isNull() | (F.col("r.on") == F.col(f"e.{kind}")))
    hit = events.alias("e").join(rules.alias("r"), on)
    return hit.select("e.*", F.explode("r.actions").alias("__a")).select("*", F.col("__a.action").alias("action"), F.col("__a.target").alias("target")).drop("__a")


def issues(df: DataFrame, required: list[str], least_fields: int) -> DataFrame:
    """df with issues: the names of missing required fields and of too few filled ones."""
    filled = reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in df.columns], F.lit(0))
    found = [F.when(F.col(c).isNull(), F.lit(f"missing:{c}")) for c in required]
    return df.withColumn("issues", F.array_compact(F.array(*found, F.when(filled < least_fields, F.lit("too_few_fields")))))


def with_lookup(messages: DataFrame, answers: DataFrame, keys: Sequence[str], at: str, fetched_at: str, take: Sequence[str], ttl_seconds: int, into: str = "lookup_result") -> DataFrame:
    """messages with a struct of an answer's columns, and lookup: hit, expired or missing.

    answers: one row for each answer of an external service, with the keys that it was asked for (its
    connection, endpoint and parameters, as far as they differ) and the time when it was fetched. A
    message takes the newest answer not after it, if that is younger than its time to live then; an
    older one has run out and gives nothing. With two answers of one time, either counts. Messages
    without a time find nothing; null keys meet null keys. No key makes a task of its own.
    """
    found = ordered.as_of(messages, answers, keys, F.col(at), F.col(fetched_at), [*dict.fromkeys([*take, fetched_at])], into="__found")
    age = F.timestamp_diff("SECOND", F.col("__found")[fetched_at], F.col(at))
    state = F.when(F.col("__found").isNull(), "missing").when(age < ttl_seconds, "hit").otherwise("expired")
    answer = F.when(state == "hit", F.struct(*[F.col("__found")[c].alias(c) for c in take]))
    return found.select(*messages.columns, answer.alias(into), state.alias("lookup"))
