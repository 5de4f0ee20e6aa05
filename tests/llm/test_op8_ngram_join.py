import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import ngram_join, shingles


def words(text):
    out, low = [], "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in low:
        if c in " \t\n\v\f\r":
            out.append("")
        elif out:
            out[-1] += c
        else:
            out.append(c)
    return [w for w in out if w]


def shingle_set(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and rows[i][0] is not None and rows[j][0] is not None and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return [(doc, len(s), None if doc is None else least[find(i)] if s else doc) for i, ((doc, _), s) in enumerate(zip(rows, sets, strict=True))]


def near_copies(seed, families=6, copies=25):
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(3000)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    rows = []
    for _ in range(families):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([12, 60, 150]))]
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 40))):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(w)))
    for _ in range(30):
        rows.append((len(rows), " ".join([rng.choice(vocabulary) for _ in range(rng.randint(5, 60))] + passage)))
    return rows


@pytest.mark.parametrize("portion", [512, 7])
def test_equal_to_brute_force(spark, monkeypatch, portion):
    monkeypatch.setattr(ngram_join, "PORTION", portion)
    rows = near_copies(portion)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: tuple(r) for r in ngram_join.join(docs).collect()}
    assert [got[i] for i, _ in rows] == brute(rows)


def test_awkward_rows(awkward, nothing):
    clash = awkward.withColumn("cid", F.lit("x")).withColumn("tokens", F.lit(1)).withColumn("grp", F.lit(2))
    got = sorted(map(tuple, ngram_join.join(clash).collect()), key=str)
    want = brute([(r.doc_id, r.text) for r in awkward.collect()])
    assert got == sorted(want, key=str)
    assert ngram_join.join(nothing).count() == 0


def test_keep_one(awkward):
    kept = ngram_join.keep_one(awkward)
    assert kept.columns == awkward.columns
    assert sorted((r.doc_id for r in kept.collect() if r.doc_id is not None)) == [1, 4, 5, 6, 7, 9, 10, 11, 12, 12]
    assert kept.where("doc_id IS NULL").count() == 1


def test_word_hashes_tell_words_apart():
    assert shingles.word_hashes(b"ab AB a b\x0bab").tolist()[0] == shingles.word_hashes(b" x ab")[1]
    assert len(set(shingles.word_hashes(b"a b ab ba aa \xc3\xa9 \xc3\xa8").tolist())) == 7
    assert len(shingles.word_hashes(b" \t ")) == 0
