import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import anchors, repeats


def brute(texts, length):
    """Covered bytes of each text, by a dictionary of all strings."""
    seen = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            seen[t[i : i + length]] = seen.get(t[i : i + length], 0) + 1
    out = []
    for t in texts:
        covered = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                covered[i : i + length] = True
        out.append(covered)
    return out


def expected(texts, length):
    rows = []
    for t, c in zip(texts, brute(texts, length), strict=True):
        runs = int((np.diff(np.concatenate([[0], c.astype(int)])) == 1).sum())
        rows.append((len(t), int(c.sum()), runs, hashlib.sha256(np.frombuffer(t, np.uint8)[~c].tobytes()).hexdigest()))
    return rows


def made(seed):
    rng = random.Random(seed)
    letters = lambda n: "".join(rng.choice("ab c") for _ in range(n))
    passage, other = letters(260), letters(199)
    texts = [letters(150) + passage + letters(120) for _ in range(6)] + [passage[:230], passage[20:], other, other, letters(50) + other + other[:1]]
    texts += ["", None, "xy" * 300, "z" * 450, "é" * 150 + letters(40), "é" * 150, letters(200)]
    texts += [texts[0], texts[0]]
    return texts


@pytest.mark.parametrize("group", [1500, 2])
def test_equal_to_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(repeats, "GROUP", group)
    texts = made(group)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in repeats.remove(docs).collect()}
    want = expected([(t or "").encode() for t in texts], 200)
    assert [got[i] for i in range(len(texts))] == want


def test_awkward_rows(awkward, nothing):
    rows = repeats.remove(awkward).collect()
    assert len(rows) == 16
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    assert by_id[13][0].n_removed == by_id[13][0].n_bytes == by_id[1][0].n_removed
    assert by_id[12][0].n_removed == by_id[12][1].n_removed == 0
    assert by_id[4][0].n_bytes == 0
    assert repeats.remove(nothing).count() == 0


def test_every_string_holds_an_anchor_at_the_same_place():
    rng = np.random.default_rng(3)
    shared = bytes(rng.integers(97, 123, 200, dtype=np.uint8))
    a = bytes(rng.integers(97, 123, 300, dtype=np.uint8)) + shared
    b = shared + bytes(rng.integers(97, 123, 300, dtype=np.uint8))
    (pa, ha, _, _), (pb, hb, _, _) = anchors.find(a, 200), anchors.find(b, 200)
    inside_a = {(p - 300, h) for p, h in zip(pa, ha, strict=True) if 300 <= p <= 400}
    inside_b = {(p, h) for p, h in zip(pb, hb, strict=True) if p <= 100}
    assert inside_a & inside_b


def test_extension_against_pairs():
    rng = random.Random(4)
    anchor = bytes(rng.choice(b"xyz") for _ in range(anchors.GRAM))
    texts, before, group = [], [], []
    for g in range(30):
        for _ in range(rng.randint(1, 12)):
            left, right = bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 100))), bytes(rng.choice(b"a") if rng.random() < 0.97 else 98 for _ in range(rng.randint(0, 100)))
            if len(left) + len(right) >= 100 and (left + anchor + right, g) not in zip(texts, group, strict=True):
                texts.append(left + anchor + right)
                before.append(len(left))
                group.append(g)
    left, right = repeats.extend(np.array(group), np.array(before), texts, 200)
    for i in range(len(texts)):
        best_left, best_right = -1, 0
        for d in range(before[i] + 1):
            stop = before[i] - d + 200
            if stop > len(texts[i]):
                continue
            window = texts[i][before[i] - d : stop]
            if any(j != i and group[j] == group[i] and before[j] >= d and texts[j][before[j] - d : before[j] - d + 200] == window for j in range(len(texts))):
                best_left, best_right = max(best_left, d), max(best_right, 100 - d)
        assert (left[i], right[i] if left[i] >= 0 else 0) == (best_left, best_right)


def test_periodic_texts_have_few_anchors(spark):
    """Long runs of any short period, alone and beside copies of their strings, against brute force."""
    rng = random.Random(5)
    pad = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    texts = ["a" * 3000, pad(90) + "a" * 2500 + pad(90), "a" * 200, "b" * 200, "xyz" * 700 + pad(40), pad(30) + ("xyz" * 80)[:200], "a" * 900 + "b" * 900, pad(10) + "a" * 120 + "b" * 120, ("0123456789" * 9 + "!") * 20, "c" * 799, "c" * 60 + pad(150)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in repeats.remove(docs).collect()}
    assert [got[i] for i in range(len(texts))] == expected([t.encode() for t in texts], 200)
    assert len(anchors.find(b"a" * 4_000_000, 200)[0]) < 1000


def test_very_many_rows_of_one_id_and_text(spark):
    rng = random.Random(9)
    text = "".join(rng.choice("abcdefgh ") for _ in range(900))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string").crossJoin(spark.range(20_000).select()).select("doc_id", "text")
    found = repeats.spans(df)
    gathered = repeats.runs(found).groupBy("key").count().collect()
    assert [r["count"] for r in gathered] == [1]
    out = repeats.remove(df).groupBy("n_bytes", "n_removed", "n_spans").count().collect()
    assert [tuple(r) for r in out] == [(900, 900, 1, 20_000)]
