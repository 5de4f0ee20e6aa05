"""Secret scans over a content-addressed ledger (operator 9).

Every text is addressed by the SHA-256 of its bytes (its blob). A ledger holds the pairs of blob
and rule version that were scanned, with their findings. A scan takes from the rows only one
place of each blob that the ledger lacks for some rule, scans those texts for these rules alone,
adds them to the ledger, and joins the findings back to every path of the blob.

What is to be scanned is decided on addresses; texts are scanned where they lie.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared


@dataclass(frozen=True)
class Rule:
    """kind, version (raise it when the pattern changes), pattern, the group whose length counts, its least length."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int
    any_case: bool = False
    #: Text without any of these (in lower case, if any_case) cannot match; empty: no such test.
    needs: tuple[str, ...] = ()


#: Fixed by the contract of operator 9; in the order in which kinds are listed.
BASE_RULES = (
    Rule("assign", 1, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True, ("pass", "secret", "token", "api")),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20, False, ("AKIA",)),
    Rule("hex", 1, r"[0-9a-f]+", 0, 24),
)
LEDGER = "blob string, kind string, version int, spans array<struct<start:int,end:int>>"


def find(rule: Rule, pattern: re.Pattern, text: str, folded: str) -> list[dict]:
    """Leftmost non-overlapping matches of one rule that are long enough, in code points."""
    if rule.needs and not any(x in (folded if rule.any_case else text) for x in rule.needs):
        return []
    return [{"start": m.start(), "end": m.end()} for m in pattern.finditer(text) if m.end(rule.group) - m.start(rule.group) >= rule.least]


def compiled(rule: Rule) -> re.Pattern:
    # A run shorter than the least length fails from each of its starts, so the bound may stand in
    # the pattern where the whole match is one run of one class.
    text = re.sub(r"\+$", f"{{{rule.least},}}", rule.pattern) if rule.kind == "hex" else rule.pattern
    return re.compile(text, re.ASCII | (re.IGNORECASE if rule.any_case else 0))


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """One ledger row for each blob and rule, also where nothing is found."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = [(r, compiled(r)) for r in rules]
        kinds, versions = [r.kind for r in rules], [r.version for r in rules]
        schema = pa.schema([("blob", pa.string()), ("kind", pa.string()), ("version", pa.int32()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])
        for batch in batches:
            ids, spans = [], []
            for blob, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = value.as_py()
                folded = text.lower()
                ids += [blob] * len(rules)
                spans += [find(r, p, text, folded) for r, p in ready]
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(kinds * n, pa.string()), pa.array(versions * n, pa.int32()), pa.array(spans, schema.field("spans").type)], schema=schema)

    return blobs.select("blob", "text").mapInArrow(scan, LEDGER)


def addressed(docs: DataFrame) -> DataFrame:
    """doc_id and blob, the SHA-256 of the text's bytes; a null text counts as empty."""
    return docs.select("doc_id", F.sha2(F.coalesce(F.col("text"), F.lit("")), 256).alias("blob"))


def unscanned(docs: DataFrame, ledger: DataFrame | None, rules: tuple[Rule, ...] = BASE_RULES) -> DataFrame:
    """Ledger rows for the pairs of blob and rule version that the ledger lacks.

    Nothing that it holds is scanned again; a raised rule version scans every blob anew for that
    rule alone. Copies of a text are one blob: one row is read for all. If that row itself is
    repeated, its ledger row is too, which readers of the ledger allow for. Blobs that lack the
    same rules are scanned in one pass over the texts.
    """
    full = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    light = full.select(shared.row_key(full).alias("__key"), F.sha2("text", 256).alias("blob"))
    places = light.groupBy("blob").agg(F.min("__key").alias("__key"))
    every = (1 << len(rules)) - 1
    if ledger is None:
        places = places.withColumn("lacks", F.lit(every))
    else:
        bit = F.lit(None).cast("int")
        for i, rule in enumerate(rules):
            bit = F.when(_is(rule), 1 << i).otherwise(bit)
        seen = shared.written(ledger.select("blob", bit.alias("bit")).where("bit IS NOT NULL").groupBy("blob").agg(F.bit_or("bit").alias("seen")), "seen")
        places = places.join(seen, "blob", "left").withColumn("lacks", F.lit(every).bitwiseXOR(F.coalesce("seen", F.lit(0))))
    places = shared.written(places.select("__key", "lacks"), "places")
    out = None
    for (lacks,) in sorted(places.where("lacks > 0").select("lacks").distinct().collect()):  # 2 ** len(rules) at most
        todo = shared.written(places.where(F.col("lacks") == lacks).select("__key"), "todo")
        rest = shared.written(light.select("__key").distinct().join(todo, "__key", "left_anti"), "rest")
        texts = shared.only(full, shared.row_key(full), todo, rest).select(F.sha2("text", 256).alias("blob"), "text")
        rows = scan_blobs(texts, tuple(r for i, r in enumerate(rules) if lacks >> i & 1))
        out = rows if out is None else out.unionByName(rows)
    return docs.sparkSession.createDataFrame([], LEDGER) if out is None else out


def _is(rule: Rule):
    return (F.col("kind") == rule.kind) & (F.col("version") == rule.version)


def update(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = BASE_RULES) -> DataFrame:
    """The ledger after docs, written to the shared folder."""
    with shared.scratch():
        new = unscanned(docs, ledger, rules)
        return shared.written(new if ledger is None else ledger.unionByName(new), "ledger", lasting=True)


def history(versions: Iterable[DataFrame], rules: tuple[Rule, ...] = BASE_RULES) -> DataFrame:
    """The ledger after every version of a table, oldest first: what an earlier version holds is not scanned again."""
    ledger = None
    for docs in versions:
        before, ledger = ledger, update(docs, ledger, rules)
        if before is not None:
            shared.drop_written(before)
    return ledger


def found_by_blob(ledger: DataFrame, rules: tuple[Rule, ...] = BASE_RULES) -> DataFrame:
    """blob and found: its spans under the rules' present versions, by start, then kind as listed. Blobs without any are left out."""
    order, current = F.lit(None), F.lit(False)
    for i, r in enumerate(rules):
        order, current = F.when(_is(r), i).otherwise(order), current | _is(r)
    one = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), F.col("order").cast("int").alias("order"), F.col("kind").alias("kind"), s["end"].alias("end")))
    own = ledger.where(current & (F.size("spans") > 0)).withColumn("order", order)
    return own.groupBy("blob").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(one)))).alias("found"))


def join_back(docs: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = BASE_RULES) -> DataFrame:
    """doc_id and found for every row of docs, an empty list where the blob has no findings."""
    nothing = F.expr("cast(array() as array<struct<start:int,order:int,kind:string,end:int>>)")
    # Written, so that the join has a shuffle on either side and Spark can split the parts of common texts.
    found = shared.written(found_by_blob(ledger, rules), "found")
    return addressed(docs).join(found, "blob", "left").select("doc_id", F.coalesce("found", nothing).alias("found"))


def op9_secret_ledger(spark, sf_dir: str) -> DataFrame:
    """Every document with the number of its secrets by kind and their spans.

    Null and empty texts have no findings: counts 0 and empty lists. Repeated rows each get their
    row, also with a null doc_id; an empty table gives no rows. Spans that begin alike come in the
    order of their kinds. Very long texts are scanned whole; other columns are ignored. The ledger
    sees two versions of the table: first without the documents whose crc32(doc_id) is odd, then all.
    What the first held is not scanned again.
    """
    docs = shared.table(spark, sf_dir, "documents").select("doc_id", "text")
    earlier = docs.where(shared.bucket_of_id(F.col("doc_id")) % 2 == 0)
    found = join_back(docs, history([earlier, docs]))
    listed = F.array_join(F.transform("found", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def number(kind: str):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[number(r.kind) for r in BASE_RULES], F.sha2(listed, 256).alias("base_sha256"), listed.alias("spans"))


def replaced(text: str, spans: list[dict], mark: str) -> str:
    """text with each span, in order of starts, replaced by mark; of spans that overlap, the first stands for all."""
    out, at = [], 0
    for s in spans:
        if s["start"] >= at:
            out += [text[at : s["start"]], mark]
        at = max(at, s["end"])
    return "".join([*out, text[at:]])


def mask(docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES, mark: str = "[SECRET]") -> DataFrame:
    """docs with each secret in text replaced by mark; other columns and rows stay as they are.

    A null text stays null. Overlapping spans are replaced as one. Texts without secrets stay where
    they are; those with some are joined with their spans.
    """
    with shared.scratch():
        ledger = update(docs.select("doc_id", "text"), rules=rules)
        by_blob = found_by_blob(ledger, rules).select(F.col("blob").alias("__blob"), F.col("found").alias("__found"))
        by_blob = shared.written(by_blob, "found", lasting=True)
        bits = shared.bitmap(by_blob.select(F.xxhash64("__blob").alias("h")), "h", lasting=True)
    marked = shared.flagged(docs.withColumn("__blob", F.sha2("text", 256)), F.xxhash64("__blob"), bits, "__may")
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column(at), batch.column(batch.num_columns - 1), strict=True)
            texts = [replaced(t.as_py(), f.as_py(), mark) if f.is_valid else t.as_py() for t, f in pairs]
            columns = [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(batch.columns[:-1])]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    columns = [F.col(f"`{c}`") for c in docs.columns]
    some = marked.where("__may").join(by_blob, "__blob", "left").select(*columns, "__found").mapInArrow(run, docs.schema)
    return marked.where("NOT __may").select(*columns).unionByName(some)
