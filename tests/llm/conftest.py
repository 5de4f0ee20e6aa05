"""Small tables with the awkward cases: nulls, empty and very long texts, ties, repeated rows, extra columns."""

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n, words=400):
    vocabulary = [f"w{i}{'abcdefgh'[i % 8]}" for i in range(words)]
    return " ".join(rng.choice(vocabulary) for _ in range(n))


def awkward_rows():
    rng = random.Random(7)
    base = prose(rng, 120)
    edited = base.split()
    edited[60] = "changed"
    passage = prose(rng, 70)
    rows = [
        (1, base, "en", "a"),
        (2, base, "en", "a"),
        (3, " ".join(edited), "en", None),
        (4, None, None, "b"),
        (5, "", "de", "b"),
        (6, "   \n\t ", "de", None),
        (7, "one two", "fr", "c"),
        (8, "ONE  two", "fr", "c"),
        (9, prose(rng, 30) + " " + passage + " " + prose(rng, 30), "en", "a"),
        (10, prose(rng, 30) + "\n" + passage + "\n" + prose(rng, 30), "en", "a"),
        (11, "abc " * 900, None, "a"),
        (12, prose(rng, 20_000), "es", "a"),
        (12, "same id, other text with café and ünïcode 漢字", "es", "a"),
        (None, "no id here at all, really", "en", "a"),
        (13, base, "en", "a"),
        (13, base, "en", "a"),
    ]
    return [(*r, None if r[1] is None else len(r[1])) for r in rows]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def tables_dir(spark, tmp_path_factory, awkward):
    """A folder of tables whose documents are the awkward rows."""
    folder = tmp_path_factory.mktemp("tables")
    awkward.write.parquet(f"{folder}/documents.parquet")
    labels = [(r[0], i % 2, 0) for i, r in enumerate(awkward_rows()) if r[0] is not None] + [(None, 1, 0), (3, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "what is the answer to all of this then my friend"), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)
