import duckdb
from pyspark.sql import functions as F

from tidemark.llm import decontaminate

ITEMS = [(1, "If Alice has 12 apples and buys 5 kg more from Bob then how many kg does Alice hold"), (2, "short one"), (3, None), (4, ""), (1, "If Alice has 12 apples and buys 5 kg more from Bob then how many kg does Alice hold")]
DOCS = [
    (1, "Intro. If Carol has 31 apples and buys 7 kg more from Dan then how many kg does Carol hold. Then more."),
    (2, "If Carol has 31 apples and buys 7 kg more from Dan then how many kg does Eve hold"),
    (3, None),
    (4, ""),
    (5, "Short one!"),
    (6, "nothing to see here but a long row of words that is no question at all"),
    (7, "x y z If Alice has 12 apples and buys 5 kg more from Bob then how many kg does Alice hold"),
    (7, "x y z If Alice has 12 apples and buys 5 kg more from Bob then how many kg does Alice hold"),
    (None, "If Alice has 12 apples and buys 5 kg more from Bob then how many kg does Alice hold"),
]


def tables(spark):
    return spark.createDataFrame(DOCS, "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string")


def test_reparameterised_questions_are_found_and_inconsistent_slots_are_not(spark):
    docs, bench = tables(spark)
    found = {(r.doc_id, r.item_id, r.exact) for r in decontaminate.leaks(docs, bench).collect()}
    assert found == {(1, 1, False), (5, 2, True), (7, 1, True), (None, 1, True)}


def test_equal_to_sql(spark):
    docs, bench = tables(spark)
    con = duckdb.connect()
    con.register("documents", docs.toPandas().astype({"doc_id": "Int64"}))
    con.register("benchmark", bench.toPandas())
    own = decontaminate.leaks(docs, bench).select("doc_id", "item_id", "n_windows", F.round("coverage", 6), "exact").collect()
    assert sorted(map(tuple, own), key=str) == sorted(con.execute(decontaminate.oracle()).fetchall(), key=str)


def test_remove_keeps_clean_rows_with_their_columns(spark):
    docs, bench = tables(spark)
    kept = decontaminate.remove(docs.withColumn("item_id", F.lit("x")).withColumn("pos", F.lit(1)), bench)
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 6]
    assert kept.columns == ["doc_id", "text", "item_id", "pos"]


def test_without_items_or_documents(spark, nothing, awkward):
    docs, bench = tables(spark)
    assert decontaminate.leaks(docs, bench.limit(0)).count() == 0
    assert decontaminate.leaks(nothing, bench).count() == 0
    assert decontaminate.remove(awkward, bench).count() == awkward.count()


def test_large_benchmarks_take_the_shuffled_join(spark, monkeypatch):
    docs, bench = tables(spark)
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 0)
    assert decontaminate.leaks(docs, bench).count() == 4


def test_windows_of_few_words_keep_their_values(spark):
    bench = spark.createDataFrame([(1, "1 2 3 4 5 6 7 8 9 10")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "1 2 3 4 5 6 7 8 9 10"), (2, "9 8 7 6 5 4 3 2 1 0")], "doc_id long, text string")
    assert [r.doc_id for r in decontaminate.leaks(docs, bench).collect()] == [1]


def test_copies_in_other_capitals_are_found(spark):
    item = "In the old town, Alice Moor sold 12 apples; then Bob Hill, who came late, paid 5 kg of large green plums for each box. The straße was empty"
    short = "Answer: Paris"
    bench = spark.createDataFrame([(1, item), (2, short)], "item_id long, text string")
    copies = [item.upper(), item.lower(), item.title()]
    docs = [(k, f"{'w ' * k}{pad}{c} {pad}") for k, (c, pad) in enumerate((c, pad) for c in copies for pad in ("", "Some Words, "))]
    docs += [(6, short.upper()), (7, short.lower()), (8, "so " * 9 + short)]
    found = {(r.doc_id, r.item_id): (r.coverage, r.exact) for r in decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert {k: exact for k, (_, exact) in found.items()} == {(k, 1): True for k in range(6)} | {(6, 2): True, (7, 2): True}
    assert [found[k, 1][0] for k in (0, 1)] == [1.0, 1.0]


def test_equal_to_sql_in_other_capitals(spark):
    item = "In the old town, Alice Moor sold 12 apples; then Bob Hill, who came late, paid 5 kg of large green plums for each box"
    bench = spark.createDataFrame([(1, item), (2, "1 2 3 4 5 6 7 8 9 10")], "item_id long, text string")
    docs = [(1, item.upper()), (2, item.title() + ", " + item), (3, item.lower()[:70]), (4, "1 2 3 4 5 6 7 8 9 10 " + item.replace("Alice", "Carol")), (5, item.replace("12", "9") + " so on")]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    con.register("benchmark", bench.toPandas())
    own = decontaminate.leaks(docs, bench).select("doc_id", "item_id", "n_windows", F.round("coverage", 6), "exact").collect()
    assert len(own) >= 5
    assert sorted(map(tuple, own), key=str) == sorted(con.execute(decontaminate.oracle()).fetchall(), key=str)


def test_a_very_long_text(spark):
    docs, bench = tables(spark)
    filler = " ".join(f"w{i % 977}" for i in range(500_000))
    docs = spark.createDataFrame([(1, f"{filler} {DOCS[0][1]} {filler}")], "doc_id long, text string")
    assert [(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, bench).collect()] == [(1, 1)]


PENS = "Tom has {} red pens and {} blue pens in a box on the table and gives {} of them to each of the children who ask for one more pen"
SHOP = "A shop sold {} kg of flour on the first day and {} kg of sugar on the next day so how much did the shop sell in {} weeks"
FORMS = [("3", "4", "2"), ("3.5", "4.25", "0.5"), ("1,200", "3,456,789", "2"), ("three", "forty five", "two"), ("3 million", "twelve", "two hundred six"), ("1/2", "3/4", "1.5"), ("1,2,3", "5", "6.7.8")]


def test_numbers_of_any_form_are_one_slot(spark):
    bench = spark.createDataFrame([(1, PENS.format("3", "4", "2")), (2, SHOP.format("12", "5", "8"))], "item_id long, text string")
    texts = [(10 * i + j, t.format(*form)) for j, t in ((1, PENS), (2, SHOP)) for i, form in enumerate(FORMS)]
    texts += [(1000, "half a dozen people, one of whom was there, had nothing at all to say to the others"), (1001, "1.2,3/4.5 one two three four five")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = decontaminate.leaks(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in found if r.coverage >= 0.9} == {(n, n % 10) for n, _ in texts[:-2]} and len(found) == len(texts) - 2
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    con.register("benchmark", bench.toPandas())
    own = decontaminate.leaks(docs, bench).select("doc_id", "item_id", "n_windows", F.round("coverage", 6), "exact").collect()
    assert sorted(map(tuple, own), key=str) == sorted(con.execute(decontaminate.oracle()).fetchall(), key=str)
