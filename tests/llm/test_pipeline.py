import re

import duckdb
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import decontaminate, packing, quality, shared

from .test_op8_ngram_join import brute


def test_stages_keep_columns_and_rows_they_should(spark, tables_dir):
    docs = spark.read.parquet(f"{tables_dir}/documents.parquet")
    for extra in ("score", "found", "blob", "place", "cid", "tokens", "bits", "item_id", "pos"):
        docs = docs.withColumn(extra, F.concat(F.lit(f"{extra} of "), F.col("doc_id").cast("string")))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, tables_dir)
        assert out.columns == columns, name
        rows = out.collect()
        assert len(rows) <= docs.count()
        assert all(r.doc_id is None or (r.score, r.found) == (f"score of {r.doc_id}", f"found of {r.doc_id}") for r in rows), name
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, tables_dir)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_run_on_the_smallest_tables(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert rows and all(r.n_tokens <= r.bucket_len for r in rows)


def test_order_of_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "ngram_jaccard_join", "benchmark_decontamination", "secret_scan", "packing"]


def masked(text):
    """Secrets replaced one by one, in Python."""
    spans = sorted((m.start(), m.end()) for p, g, n, f in PATTERNS for m in re.finditer(p, text, f) if len(m.group(g)) >= n)
    out, at = "", 0
    for a, b in spans:
        if a >= at:
            out += text[at:a] + "[SECRET]"
        at = max(at, b)
    return out + text[at:]


PATTERNS = (
    (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, re.I | re.A),
    (r"AKIA[A-Z0-9]+", 0, 20, 0),
    (r"[0-9a-f]+", 0, 24, 0),
)


def test_each_stage_against_a_plain_version(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{sf_dir}/benchmark.parquet'")
    for name, stage in corpus_pipeline.STAGES:
        rows = {r.doc_id: r for r in docs.collect()}
        frame = docs.select("doc_id", "text").toPandas()
        con.register("documents", frame)
        out = shared.written(stage(spark, docs, sf_dir), "stage")
        got = out.collect()
        if name == "quality_classifier":
            learn = shared.bucket_of_id(F.col("doc_id")) != 2
            model = quality.fit(docs.where(learn), spark.read.parquet(f"{sf_dir}/labels.parquet").where(learn))
            want = {i for i, r in rows.items() if quality.scores([(r.text or "").encode()], model)[0] >= 0.7}
            assert {r.doc_id for r in got} == want
        elif name == "ngram_jaccard_join":
            want = {i for i, _, c in brute([(i, r.text) for i, r in rows.items()]) if i == c}
            assert {r.doc_id for r in got} == want
        elif name == "benchmark_decontamination":
            leaked = {r[0] for r in con.execute(decontaminate.oracle()).fetchall()}
            assert {r.doc_id for r in got} == set(rows) - leaked
        elif name == "secret_scan":
            assert {r.doc_id: r.text for r in got} == {i: masked(r.text) for i, r in rows.items()}
            assert all(r.n_chars == len(r.text) for r in got)
        else:
            want = con.execute(packing.oracle())
            names = [c[0] for c in want.description]
            assert sorted(tuple(r[n] for n in names) for r in got) == sorted(want.fetchall())
        docs = out
    assert docs.count() > 0
