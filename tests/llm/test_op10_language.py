import math
import random
import re

from pyspark.sql import functions as F

from tidemark.llm import language_id, shared


def made(spark):
    rng = random.Random(2)
    pieces = {"aa": ["the", "ing", "tion", "er"], "bb": ["sch", "ung", "ich", "ße"], "cc": ["aux", "eur", "é", "oi"]}
    rows = []
    for i in range(300):
        lang = rng.choice(sorted(pieces))
        text = " ".join("".join(rng.choice(pieces[lang]) for _ in range(rng.randint(1, 3))) for _ in range(12))
        rows.append((i, text, lang if i % 10 else None))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_held_out_accuracy(spark):
    docs = made(spark)
    held = shared.bucket_of_id(F.col("doc_id")) == 2
    model = language_id.fit(docs.where(~held))
    out = language_id.predict(docs.where(held), model).join(docs, "doc_id").where("lang IS NOT NULL").collect()
    assert len(out) > 40 and sum(r.lang == r.lang_pred for r in out) / len(out) > 0.95
    assert all(0 <= r.score <= 1 for r in out)


def test_unseen_words_fall_back_to_shorter_pieces(spark):
    model = language_id.fit(made(spark))
    word = "schungichungschich"
    assert word not in model.word_rows
    assert model.languages[int(model.of_word(word).argmax())] == "bb"
    assert model.of_word("漢").tolist() == [0.0, 0.0, 0.0]


def test_awkward_rows(spark, tables_dir, awkward, nothing):
    out = language_id.op10_language_id(spark, tables_dir).collect()
    assert len(out) == 16
    by_id = {r.doc_id: r for r in out}
    assert [by_id[i].lang_pred for i in (4, 5, 6)] == ["und"] * 3
    model = language_id.fit(awkward)
    assert language_id.predict(nothing, model).count() == 0
    unlabelled = language_id.fit(awkward.where("lang IS NULL"))
    assert {r.lang_pred for r in language_id.predict(awkward, unlabelled).collect()} == {"und"}


def test_the_fit_is_bounded_by_language_and_keeps_rare_ones(spark):
    docs = made(spark).unionByName(spark.createDataFrame([(1000, "zyx wvu", "dd")], "doc_id long, text string, lang string"))
    labelled, languages = language_id.drawn(docs, 30)
    sizes = {r[0]: r[1] for r in labelled.groupBy("lang").count().collect()}
    assert languages == ["aa", "bb", "cc", "dd"] and sizes["dd"] == 1 and all(10 < sizes[x] < 60 for x in ("aa", "bb", "cc"))
    model = language_id.fit(docs, 30)
    assert model.languages[int(model.of_word("zyx").argmax())] == "dd"


def test_equal_to_a_plain_version(spark):
    """Counts, frequencies and backoff with dictionaries, against the model of the executors."""
    docs = made(spark)
    rows = docs.collect()
    model = language_id.fit(docs)
    languages = sorted({r.lang for r in rows if r.lang})

    def shares(items_of):
        n = {x: {} for x in languages}
        for r in rows:
            if r.lang:
                for w in re.findall(r"[^\W\d_]+", r.text.lower()):
                    for item in items_of(w):
                        n[r.lang][item] = n[r.lang].get(item, 0) + 1
        size = len(set().union(*n.values())) + 1
        total = {x: max(sum(n[x].values()), 1) for x in languages}
        return {i: [math.log(0.9 * n[x].get(i, 0) / total[x] + 0.1 / size) for x in languages] for i in set().union(*n.values())}

    tables = [shares(lambda w: [w])]
    for order in (5, 4, 3, 2, 1):
        tables.append(shares(lambda w, k=order: [("<" + w + ">")[i : i + k] for i in range(len(w) + 3 - k)] if k > 1 else list(w)))

    def of_word(w):
        if w in tables[0]:
            return tables[0][w]
        for order, table in zip((5, 4, 3, 2, 1), tables[1:], strict=True):
            known = [table[g] for g in ([("<" + w + ">")[i : i + order] for i in range(len(w) + 3 - order)] if order > 1 else list(w)) if g in table]
            if known:
                return [sum(x) / len(known) for x in zip(*known, strict=True)]
        return [0.0] * len(languages)

    texts = [(i, t) for i, t in enumerate(["the schung aux", "tionsch ungeur", "é", "漢 thing", "ER 12 ich", "!!", None, *[r.text for r in rows[:40]]])]
    got = {r.doc_id: r for r in language_id.predict(spark.createDataFrame(texts, "doc_id long, text string"), model).collect()}
    for i, t in texts:
        found = re.findall(r"[^\W\d_]+", (t or "").lower())
        if not found:
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
            continue
        total = [sum(x) for x in zip(*[of_word(w) for w in found], strict=True)]
        best = max(range(len(languages)), key=lambda k: (total[k], -k))
        posterior = 1 / sum(math.exp(x - total[best]) for x in total)
        assert got[i].lang_pred == languages[best] and abs(got[i].score - posterior) < 1e-6


def test_clashing_columns_and_repeated_rows(spark):
    docs = made(spark).withColumns({"score": F.lit("x"), "lang_pred": F.lit("y"), "word": F.lit(1), "n": F.lit(2), "marked": F.lit(3)})
    docs = docs.unionByName(docs.where("doc_id < 5"))
    assert language_id.predict(docs, language_id.fit(docs)).count() == 305
