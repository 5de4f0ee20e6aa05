"""The manifest against a plain version and its SQL twin."""

import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.llm import merkle

from .conftest import SCHEMA


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return digest(*map(part, (row.doc_id, row.source, row.lang, row.n_chars, row.text)))


def climb(nodes):
    """The root of a list of digests, and the (left, right) siblings of each on its way up."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(paths):
            base = at[i] - at[i] % 16
            p.append(("".join(nodes[base : at[i]]), "".join(nodes[at[i] + 1 : base + 16])))
            at[i] //= 16
        nodes = [digest(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
    return nodes[0], paths


def plain(rows):
    groups = {}
    for r in rows:
        groups.setdefault((r.source is not None, (r.source or "").encode()), []).append(r)
    order, out = sorted(groups), []
    leaves = {g: sorted(groups[g], key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r))) for g in order}
    trees = {g: climb([leaf(r) for r in leaves[g]]) for g in order}
    root, above = climb([trees[g][0] for g in order])
    for n, g in enumerate(order):
        for r, own in zip(leaves[g], trees[g][1], strict=True):
            path, found = own + above[n], r.text
            if r.doc_id is not None and r.text is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0:
                found = "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text)
            at = leaf(r._replace(text=found)) if hasattr(r, "_replace") else leaf(type(r)(**{**r.asDict(), "text": found}))
            for left, right in path:
                at = digest(left, at, right)
            out.append((r.doc_id, leaf(r), trees[g][0], root, digest(*[a + b for a, b in path]), at, at == root))
    return sorted(out, key=str)


def run(spark, df, folder):
    df.write.parquet(f"{folder}/documents.parquet")
    out = merkle.op11_merkle_manifest(spark, str(folder))
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def many(n, sources, seed):
    rng = random.Random(seed)
    return [(i * 3, f"Text {rng.random()} Ä" if i % 9 else None, rng.choice(["en", None]), rng.choice(sources), rng.choice([5, None])) for i in range(n)]


@pytest.mark.parametrize("n,sources", [(1, ["a"]), (16, ["a"]), (17, [None]), (300, ["hot"] * 6 + ["a", "b", None, ""]), (60, [f"s{i}" for i in range(40)])])
def test_equals_a_plain_version_and_sql(spark, tmp_path, n, sources):
    df = spark.createDataFrame(many(n, sources, n), SCHEMA)
    got = run(spark, df.withColumn("grp", F.lit("x")).withColumn("pos", F.lit(1)), tmp_path)
    assert got == plain(df.collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted(con.execute(merkle.oracle(3)).fetchall(), key=str) == got
    assert any(not r[-1] for r in got) or n < 5


def test_awkward_rows(spark, awkward, tmp_path):
    assert run(spark, awkward, tmp_path) == plain(awkward.collect())


def test_very_many_equal_rows(spark, tmp_path):
    df = spark.createDataFrame([(7, "Same", "en", "a", 4)] * 400, SCHEMA)
    assert run(spark, df, tmp_path) == plain(df.collect())


def test_empty_table(spark, nothing, tmp_path):
    assert run(spark, nothing, tmp_path) == []
