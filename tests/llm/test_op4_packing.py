import itertools

import duckdb
from pyspark.sql import functions as F

from tidemark.llm import packing


def padding(histogram, bounds):
    return sum(n * (min(b for b in bounds if b >= x) - x) for x, n in histogram.items())


def test_boundaries_are_optimal():
    histogram = {1: 5, 2: 1, 3: 7, 8: 2, 9: 9, 15: 1, 16: 3}
    for k in range(1, 9):
        best = min(padding(histogram, (*c, 16)) for c in itertools.combinations([x for x in histogram if x < 16], min(k, len(histogram)) - 1))
        assert padding(histogram, packing.boundaries(histogram, k)) == best
    assert packing.boundaries({}, 3) == []


def test_whole_texts_are_packed_once(awkward):
    rows = packing.pack(awkward, max_len=64, buckets=4, token_budget=256).collect()
    words = sum(len((r.text or "").split()) for r in awkward.collect())
    assert sum(r.n_tokens for r in rows) == words
    places = [(r.bucket_len, r.batch, r.slot) for r in rows]
    assert len(set(places)) == len(places)
    assert all(r.n_tokens <= r.bucket_len and r.slot < max(1, 256 // max(r.bucket_len, 1)) for r in rows)


def test_equal_to_sql(spark, awkward):
    docs = awkward.where("doc_id IS NOT NULL").select("doc_id", "text")
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    own = packing.pack(docs, 64, 3, 256).select("doc_id", "chunk", "start", "n_tokens", "bucket_len", "batch", "slot").collect()
    assert sorted(map(tuple, own)) == sorted(con.execute(packing.oracle(64, 3, 256)).fetchall())


def test_empty_table_and_clashing_columns(nothing, awkward):
    assert packing.pack(nothing).count() == 0
    clash = awkward.withColumn("batch", F.lit(1)).withColumn("chunk", F.lit(1)).withColumn("n_tokens", F.lit("x"))
    assert packing.pack(clash).count() == packing.pack(awkward).count()


def test_very_many_repeated_rows_fill_all_slots(spark):
    docs = spark.range(2_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("one two three").alias("text")).unionByName(spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string"))
    rows = packing.pack(docs, 64, 4, 30).collect()
    assert len(rows) == 2_002
    places = [(r.bucket_len, r.batch, r.slot) for r in rows]
    assert len(set(places)) == 2_002
    for bucket in {r.bucket_len for r in rows}:
        own = sorted((b, s) for x, b, s in places if x == bucket)
        fits = max(1, 30 // max(bucket, 1))
        assert own == [(i // fits, i % fits) for i in range(len(own))]
