import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import quality, shared


def test_scores_separate_held_out_documents(spark):
    rng = np.random.default_rng(1)
    rows, labels = [], []
    for i in range(400):
        good = i % 3 > 0
        words = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(80)]
        rows.append((i, " ".join(words) + "." if good else " ".join(w + "$$$ ###" for w in words)))
        labels.append((i, int(good)))
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")
    learn = shared.bucket_of_id(F.col("doc_id")) != 2
    out = quality.score(docs, quality.fit(docs.where(learn), known.where(learn))).where(~learn).join(known, "doc_id").collect()
    assert len(out) > 50
    assert np.mean([(r.score >= 0.7) == (r.quality == 1) for r in out]) > 0.95


def test_every_row_gets_a_score(tables_dir, spark):
    out = quality.op1_quality_mil(spark, tables_dir).collect()
    assert len(out) == 16
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out)


def test_extra_columns_stay_and_a_column_named_score_gives_way(spark, awkward):
    out = quality.score(awkward.withColumn("score", F.lit("x")).withColumn("y", F.array(F.lit(1))), {"constant": 0.4})
    assert out.columns == [*awkward.columns, "y", "score"]
    assert {r.score for r in out.collect()} == {0.4}


def test_without_labels_the_score_is_constant(spark, awkward, nothing):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.fit(awkward, none) == {"constant": 0.5}
    assert quality.score(nothing, {"constant": 0.5}).count() == 0


def test_portions_do_not_change_features():
    text = ("Some words, and more. " * 500).encode()
    whole, per = quality.features([text])
    assert per.tolist() == [len(whole)]
    parts = [text[i : i + 10 * quality.PASSAGE] for i in range(0, len(text), 10 * quality.PASSAGE)]
    assert np.allclose(whole, np.concatenate([quality.features([p])[0] for p in parts]))


def test_gradient_of_the_attention_model():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, quality.N_FEATURES)).astype(np.float32)
    sizes = np.full(100, 3)
    labels = (x.reshape(100, 3, -1)[:, :, 0].max(axis=1) > 0.8).astype(np.float32)
    model = quality.train(x, sizes, labels, epochs=40)
    codes = np.tanh(quality.standard(x, model) @ model["W"] + model["b"])
    a, z = quality.pooled(codes, quality.attend(codes, model), np.arange(0, 300, 3), np.repeat(np.arange(100), 3))
    assert a.reshape(100, 3).sum(axis=1) == pytest.approx(np.ones(100), abs=1e-4)
    assert np.mean((z @ model["c"] + model["c0"] > 0) == (labels == 1)) > 0.9


def test_scores_equal_a_plain_version(spark, awkward):
    """One passage at a time, with loops, against the score of whole batches."""
    rng = np.random.default_rng(4)
    x = rng.random((90, quality.N_FEATURES)).astype(np.float32)
    model = quality.train(x, np.full(30, 3), (np.arange(30) % 2).astype(np.float32), epochs=3)

    def plain(text):
        b = (text or "").encode()
        weights, codes = [], []
        for at in range(0, max(len(b), 1), quality.PASSAGE):
            f = quality.features([b[at : at + quality.PASSAGE]])[0][0]
            code = np.tanh(np.clip((f - model["mean"]) / model["scale"], -5, 5) @ model["W"] + model["b"])
            gate = 1 / (1 + np.exp(-(code @ model["U"])))
            weights.append(np.exp(float((np.tanh(code @ model["V"]) * gate) @ model["w"])))
            codes.append(code)
        z = sum(w * c for w, c in zip(weights, codes, strict=True)) / sum(weights)
        return float(1 / (1 + np.exp(-(z @ model["c"] + model["c0"])[0])))

    out = quality.score(awkward, model).select("text", "score").collect()
    assert len(out) == 16
    assert np.allclose([r.score for r in out], [plain(r.text) for r in out], atol=1e-4)


def test_a_document_gives_a_bounded_bag():
    text = bytes(range(256)) * 40_000
    assert len(quality.spaced(text, 32)) == 32 and quality.spaced(text, 32)[-1] in text
    assert quality.spaced(b"ab", 32) == [b"ab"] and quality.spaced(b"", 32) == [b""]
    assert b"".join(quality.spaced(text[:20_000], 32)) == text[:20_000]
