"""Merge, append, versions and idempotence."""

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import tables
from tidemark.plans import outputs

T = "id int, name string, created_at string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_merge_updates_inserts_and_preserves(spark):
    t = spark.createDataFrame([(1, "a", "old"), (2, "b", "old"), (None, "n", "old")], T)
    s = spark.createDataFrame([(2, "B", "new"), (3, "C", "new"), (None, "N", "new")], T)
    assert rows(tables.merged(t, s, ["id"])) == sorted([(1, "a", "old"), (2, "B", "old"), (3, "C", "new"), (None, "n", "old"), (None, "N", "new")], key=str)


def test_merge_condition_and_actions(spark):
    t = spark.createDataFrame([(1, "a", "1"), (2, "b", "2")], T)
    s = spark.createDataFrame([(1, "A", "9"), (2, "B", "9"), (3, "C", "9")], T)
    assert rows(tables.merged(t, s, ["id"], condition="source.name > target.name AND target.id = 7")) == [(1, "a", "1"), (2, "b", "2"), (3, "C", "9")]
    assert rows(tables.merged(t, s, ["id"], when_matched="delete")) == [(3, "C", "9")]
    assert rows(tables.merged(t, s, ["id"], when_not_matched="do_nothing")) == [(1, "A", "1"), (2, "B", "2")]


def test_merge_adds_columns(spark):
    t = spark.createDataFrame([(1, "a")], "id int, name string")
    s = spark.createDataFrame([(1, 5), (2, 6)], "id int, extra int")
    assert rows(tables.merged(t, s, ["id"])) == [(1, "a", 5), (2, None, 6)]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.sampled_from("xyz")), st.one_of(st.none(), st.sampled_from("uv"))), max_size=10))
def test_batch_is_coalesced_like_a_dictionary(spark, batch):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(batch)], "n int, id int, a string, b string")
    want = {}
    for k, a, b in batch:
        old = want.get(k, (None, None))
        want[k] = (a if a is not None else old[0], b if b is not None else old[1])
    got = tables.coalesced_by_key(df, ["id"], ["n"]).drop("n")
    assert rows(got) == sorted(((k, *v) for k, v in want.items()), key=str)


def test_appends_are_aligned_and_once_for_a_token(spark, tmp_path):
    table = tables.Folder(spark, f"file://{tmp_path}/t", partition_by=["id"])
    assert not table.exists()
    assert table.append(spark.createDataFrame([], "id int, odd string")).rows == 0 and not table.exists()
    table.history.clear()
    table.append(spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string"))
    for _ in range(2):
        table.append(spark.createDataFrame([("3", "c", 1.5), ("x", "d", 2.5)], "id string, name string, extra double"), token="checkpoint#7")
    assert sorted(table.read().columns) == ["extra", "id", "name"]
    assert rows(table.read().select("id", "name", "extra")) == sorted([(1, "a", None), (2, "b", None), (3, "c", 1.5), (None, "d", 2.5)], key=str)
    assert [(w.rows, w.new_columns) for w in table.history] == [(2, ()), (2, ("extra",)), (2, ())]
    assert table.append(spark.createDataFrame([], "id int")).rows == 0


def files(path):
    return {str(f): f.stat().st_mtime_ns for f in path.rglob("*.parquet")}


def test_a_merge_writes_only_the_buckets_that_it_meets(spark, tmp_path):
    table = tables.Folder(spark, f"file://{tmp_path}/t", keys=["id"])
    table.merge(spark.createDataFrame([(i, i, "a") for i in range(200)] + [(7, 7, None), (0, None, "n")], "n int, id int, v string"), ["n"])
    before = files(tmp_path / "t")
    assert table.read().count() == 201
    table.merge(spark.createDataFrame([(1, "7", "B", True), (2, "500", "c", None)], "n int, id string, v string, more boolean"), ["n"])
    after = files(tmp_path / "t")
    assert len(set(before) & set(after)) >= len(before) - 2 and all(before[f] == after[f] for f in set(before) & set(after))
    got = {r.id: (r.v, r.more) for r in table.read().collect()}
    assert len(got) == 202 and got[7] == ("B", True) and got[500] == ("c", None) and got[8] == ("a", None) and got[None] == ("n", None)


def test_a_merge_that_deletes_leaves_no_rows_behind(spark, tmp_path):
    table = tables.Folder(spark, f"file://{tmp_path}/t", keys=["id"], buckets=4)
    df = spark.createDataFrame([(i, i) for i in range(8)], "n int, id int")
    table.merge(df, ["n"])
    table.merge(df.where("id < 8"), ["n"], when_matched="delete")
    assert not list((tmp_path / "t").rglob("*.parquet")) and not table.exists()
    assert table.merge(df, ["n"]).rows == 8


def test_appends_and_merges_of_one_table(spark, tmp_path):
    table = tables.Folder(spark, f"file://{tmp_path}/t", keys=["id"], buckets=4)
    df = spark.createDataFrame([(i, "a") for i in range(10)] + [(None, "n")], "id int, v string")
    table.append(df)
    table.append(df.where("id < 3").withColumn("more", F.lit(1)))
    before = files(tmp_path / "t")
    table.append(df.where("id < 0"))
    assert files(tmp_path / "t") == before
    table.merge(spark.createDataFrame([(2, "B"), (None, "N"), (50, "c")], "id int, v string"), ["id"])
    assert rows(table.read().select("id", "v")) == sorted([(i, "B" if i == 2 else "a") for i in [*range(10), *range(3)]] + [(None, "n"), (None, "N"), (50, "c")], key=str)
    table.merge(df, ["id"])
    assert [r[:2] + (r[3],) for r in tables.write_history(table).collect()] == [(1, "append", []), (2, "append", ["+more"]), (3, "append", []), (4, "merge", []), (5, "merge", [])]
    assert [w.rows for w in table.history[:3]] == [11, 3, 0] and table.read().count() == 17
    with pytest.raises(ValueError, match="no token"):
        table.append(df, token="x")


@pytest.mark.parametrize("keep,counts", [("true", [5, 1, 2, 9]), ("event_type <> 'click'", [2, 0, 1, 3]), ("false", [0, 0, 0, 0])])
def test_the_history_has_a_merge_of_the_whole_table(spark, tmp_path, keep, counts):
    e = spark.createDataFrame([(1, "click", 1.0), (2, "view", 2.0), (3, "error", 3.0), (None, "view", None), (None, None, 4.0)], "event_id long, event_type string, value double")
    e = e.where("event_id IS NOT NULL") if keep != "true" else e
    e.where(keep).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    query, sql = outputs.QUERIES["write_history"]
    with duckdb.connect() as duck:
        duck.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
        want = duck.execute(sql).fetchall()
    assert rows(query(spark, str(tmp_path))) == want == [(1, "append", counts[0], ""), (2, "append", counts[1], "+value"), (3, "append", counts[2], ""), (4, "merge", counts[3], "")]


def test_layout_columns():
    assert tables.layout_columns("/x/Inventory_rows") == ["created_date", "status", "trace_id"]
    assert tables.layout_columns("/x/other") == ["created_date"] and tables.layout_columns("/x/inventory", ["a"]) == ["a"]


def test_align_makes_misfits_null(spark):
    target = spark.createDataFrame([], "a int, b timestamp, c string").schema
    out = tables.align(spark.createDataFrame([("x", "2024-01-01 00:00:00", 1.5, True)], "a string, b string, d double, c boolean"), target)
    r = out.first()
    assert out.columns == ["a", "b", "c", "d"] and r.a is None and r.b is not None and r.c == "true"


def test_filters_are_pushed_to_the_scan(spark, sf_dir):
    df = tables.scan_filtered(spark.read.parquet(f"{sf_dir}/orders.parquet"), F.col("o_totalprice") > 200000, ["o_orderkey", "o_totalprice"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,200000.0)]" in plan and "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan


@pytest.mark.parametrize("value,kept", [(5, [1]), (0, [1, 2, 3])])
def test_numbers_compare_with_nulls_as_zero(spark, value, kept):
    df = spark.createDataFrame([(1, "7"), (2, None), (3, "x")], "id int, v string")
    assert sorted(r.id for r in tables.scan_tuples(df, [("v", ">=", value)]).collect()) == kept
