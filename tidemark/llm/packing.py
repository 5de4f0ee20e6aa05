"""Packing into optimal length buckets (operator 4).

The lengths of all units form one histogram, which has at most max_len + 1 entries. Dynamic
programming over it chooses the bucket boundaries with the least padding. Inside each bucket,
units are numbered in a fixed random-like order, by ranges that are as large as each other also
where a row is repeated very often, and cut into batches of a token budget.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import shared

MAX_LEN = 2048
BUCKETS = 8
TOKEN_BUDGET = 16384


def n_words(text: Column) -> Column:
    """Words of a text; 0 where it is null or empty."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0))


def boundaries(histogram: dict[int, int], buckets: int) -> list[int]:
    """The upper lengths of at most `buckets` buckets with the least padding in total, ascending.

    Of equal costs, the boundary with the shorter lower bucket is taken. Empty histogram: none.
    """
    lengths = np.array(sorted(histogram), dtype=np.int64)
    m = len(lengths)
    if not m:
        return []
    n = np.concatenate([[0], np.cumsum([histogram[x] for x in lengths.tolist()], dtype=np.int64)])
    tokens = np.concatenate([[0], np.cumsum([histogram[x] * x for x in lengths.tolist()], dtype=np.int64)])
    best = lengths * n[1:] - tokens[1:]  # one bucket for the first j + 1 lengths
    choices = []
    for k in range(1, min(buckets, m)):
        after, choice = np.full(m, np.iinfo(np.int64).max // 2), np.zeros(m, np.int64)
        for j in range(k, m):
            cost = best[k - 1 : j] + lengths[j] * (n[j + 1] - n[k : j + 1]) - (tokens[j + 1] - tokens[k : j + 1])
            i = int(cost.argmin())
            after[j], choice[j] = cost[i], i + k - 1
        best = after
        choices.append(choice)
    at, out = m - 1, [m - 1]
    for choice in reversed(choices):
        at = int(choice[at])
        out.append(at)
    return [int(lengths[i]) for i in reversed(out)]


def units(docs: DataFrame, max_len: int) -> DataFrame:
    """One row for each piece of at most max_len words of every text: doc_id, chunk, start, n_tokens, order_key.

    Texts are split, never cut off; an empty or null text is one unit of length 0.
    """
    text = F.coalesce("text", F.lit(""))
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5(text).alias("__text"), n_words(text).cast("long").alias("__n"))
    last = F.greatest(F.ceil(F.col("__n") / max_len).cast("int") - 1, F.lit(0))
    pieces = sized.withColumn("chunk", F.explode(F.sequence(F.lit(0), last)))
    start = F.col("chunk").cast("long") * max_len
    key = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("chunk").cast("string"), F.col("__text")))
    return pieces.select("doc_id", "chunk", start.alias("start"), F.least(F.lit(max_len), F.col("__n") - start).alias("n_tokens"), key.alias("order_key"))


def pack(docs: DataFrame, max_len: int = MAX_LEN, buckets: int = BUCKETS, token_budget: int = TOKEN_BUDGET) -> DataFrame:
    """doc_id, chunk, start, n_tokens, bucket_len, batch, slot for every unit of every row.

    A batch of a bucket holds token_budget // bucket_len units (one at least), each padded to
    bucket_len. Repeated rows and ids give units of their own; columns other than doc_id and text
    are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    with shared.scratch():
        # Counting words is the costly part, so it is done once. The tie tells repeated rows apart.
        every = shared.written(units(docs, max_len).withColumn("tie", F.monotonically_increasing_id()), "units")
        histogram = {r[0]: r[1] for r in every.groupBy("n_tokens").count().collect()}  # max_len + 1 rows at most
        bounds = boundaries(histogram, buckets)
        bucket = F.coalesce(*[F.when(F.col("n_tokens") <= b, b) for b in bounds], F.lit(0)).cast("long")
        order = ("bucket_len", "order_key", "doc_id", "chunk", "tie")
        ranges = every.withColumn("bucket_len", bucket).repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order)
        placed = shared.written(ranges.sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "ranges", lasting=True)
    # Numbers inside a bucket: those of the ranges before, plus the number inside the range. One row a range and bucket.
    part = F.shiftright("at", 33)
    before = Window.partitionBy("bucket_len").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("bucket_len", part.alias("part")).agg(F.count("*").alias("held"), F.min("at").alias("first"))
    offsets = sizes.select("bucket_len", "part", (F.coalesce(F.sum("held").over(before), F.lit(0)) - F.col("first")).alias("offset"))
    numbered = placed.withColumn("part", part).join(offsets, ["bucket_len", "part"]).withColumn("number", F.col("at") + F.col("offset"))
    fits = F.greatest(F.floor(F.lit(token_budget) / F.greatest("bucket_len", F.lit(1))), F.lit(1)).cast("long")
    return numbered.select("doc_id", "chunk", "start", "n_tokens", "bucket_len", F.floor(F.col("number") / fits).alias("batch"), (F.col("number") % fits).alias("slot"))


def op4_packing(spark, sf_dir: str) -> DataFrame:
    """Every document packed into token-budget batches of optimal length buckets.

    Null and empty texts are units of length 0; repeated rows, also with a null doc_id, are units of
    their own, in any order among themselves; very long texts are split into units, not cut off. Of
    equal costs the boundary with the shorter lower bucket is taken. An empty table gives no rows.
    """
    return pack(shared.table(spark, sf_dir, "documents"))


def oracle(max_len: int = MAX_LEN, buckets: int = BUCKETS, token_budget: int = TOKEN_BUDGET, source: str = "documents") -> str:
    """DuckDB SQL for pack(), for tables with at least `buckets` different lengths."""
    steps = [
        f"""sized AS (SELECT CAST(doc_id AS BIGINT) doc_id, md5(coalesce(text, '')) h,
            CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) n FROM {source})""",
        f"""units AS (SELECT doc_id, CAST(chunk AS INTEGER) chunk, chunk * {max_len} AS start, least({max_len}, n - chunk * {max_len}) n_tokens,
            md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || chunk || ':' || h) order_key
            FROM (SELECT *, unnest(range(greatest(CAST(ceil(n / {max_len}) AS BIGINT), 1))) chunk FROM sized))""",
        """hist AS (SELECT n_tokens l, count(*) c FROM units GROUP BY 1)""",
        """cum AS (SELECT l, row_number() OVER (ORDER BY l) j, CAST(sum(c) OVER (ORDER BY l) AS BIGINT) n, CAST(sum(c * l) OVER (ORDER BY l) AS BIGINT) t FROM hist)""",
        """best1 AS (SELECT j, l, n, t, l * n - t cost, CAST(0 AS BIGINT) came FROM cum)""",
    ]
    for k in range(2, buckets + 1):
        steps.append(
            f"""best{k} AS (SELECT j, l, n, t, x.cost, x.came FROM (SELECT b.j, b.l, b.n, b.t,
            min({{'cost': a.cost + b.l * (b.n - a.n) - (b.t - a.t), 'came': a.j}}) x
            FROM best{k - 1} a JOIN cum b ON a.j < b.j GROUP BY ALL))"""
        )
    steps.append(f"pick{buckets} AS (SELECT max(j) j FROM cum)")
    for k in range(buckets, 1, -1):
        steps.append(f"pick{k - 1} AS (SELECT came j FROM best{k} WHERE j = (SELECT j FROM pick{k}))")
    bounds = " UNION ALL ".join(f"SELECT l FROM cum WHERE j = (SELECT j FROM pick{k})" for k in range(1, buckets + 1))
    steps += [
        f"bounds AS ({bounds})",
        """placed AS (SELECT u.*, (SELECT min(l) FROM bounds WHERE l >= u.n_tokens) bucket_len FROM units u)""",
        """numbered AS (SELECT *, row_number() OVER (PARTITION BY bucket_len ORDER BY order_key, doc_id, chunk) - 1 number FROM placed)""",
    ]
    fits = f"greatest({token_budget} // greatest(bucket_len, 1), 1)"
    return f"WITH {', '.join(steps)} SELECT doc_id, chunk, start, n_tokens, bucket_len, number // {fits} AS batch, number % {fits} AS slot FROM numbered"
