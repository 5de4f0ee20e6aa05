"""A quality classifier by attention-based multiple-instance learning (operator 1).

A document is a bag of passages. Every passage is encoded; gated attention, learned from document
labels alone, weighs the passages; the weighted sum of their codes gives the score. Fitting uses
a bounded sample of labelled documents, whose passage features are made on the executors; scoring
encodes every passage of every whole text in tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared

#: About so many labelled documents are fitted on at most, drawn by a hash of the id.
FIT_DOCUMENTS = 6_000
#: Passages of a document that are fitted on at most, evenly spaced; so what reaches the driver is bounded.
FIT_PASSAGES = 32
#: Bytes of a passage.
PASSAGE = 800
#: Bytes that are turned into features at a time.
PORTION = PASSAGE * 600
THRESHOLD = 0.7
CODES, ATTENTION, WORD_BUCKETS = 32, 16, 64
_SEED = 20_240_101


def _byte_classes() -> np.ndarray:
    out = np.full(256, 12, np.int64)
    for i, group in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\v\f", b"\n", b".", b",", b"!?", b";:", b"'\"()-", b"|_=~^`\\<>[]{}", b"#$%&*@+/")):
        out[list(group)] = i
    out[128:192], out[192:] = 13, 14  # inside and at the start of characters beyond ASCII
    return out


_CLASSES, N_CLASSES = _byte_classes(), 15
N_FEATURES = N_CLASSES**2 + 4 + WORD_BUCKETS


def portions(texts: list[bytes]) -> Iterator[tuple[list[int], list[bytes]]]:
    """Groups of (document number, piece); a piece is whole passages of one text, a group at most PORTION bytes."""
    owners, pieces, held = [], [], 0
    for i, text in enumerate(texts):
        for at in range(0, max(len(text), 1), PORTION):
            piece = text[at : at + PORTION]
            if pieces and held + len(piece) > PORTION:
                yield owners, pieces
                owners, pieces, held = [], [], 0
            owners.append(i)
            pieces.append(piece)
            held += len(piece)
    if pieces:
        yield owners, pieces


def spaced(text: bytes, most: int) -> list[bytes]:
    """The passages of a text, or so many of them, evenly spaced over the whole text."""
    n = max(1, -(-len(text) // PASSAGE))
    at = range(n) if n <= most else [i * n // most for i in range(most)]
    return [text[i * PASSAGE : (i + 1) * PASSAGE] for i in at]


def features(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage of the pieces, and how many passages each piece has (an empty one: one).

    Shares of pairs of neighbouring byte classes; share of words equal to the word before, share of
    different words, mean word length, fill; words hashed into buckets.
    """
    sizes = np.array([len(p) for p in pieces], np.int64)
    per = np.maximum(1, -(-sizes // PASSAGE))
    first = np.concatenate([[0], np.cumsum(per)])
    n = int(first[-1])
    out = np.zeros((n, N_FEATURES), np.float32)
    b = np.frombuffer(b"".join(pieces), np.uint8)
    if not len(b):
        return out, per
    starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    at = np.arange(len(b), dtype=np.int64) - np.repeat(starts, sizes)
    passage = np.repeat(first[:-1], sizes) + at // PASSAGE
    length = np.bincount(passage, minlength=n).astype(np.float32)
    classes = _CLASSES[b]
    same = passage[1:] == passage[:-1]
    pairs = (passage[:-1] * N_CLASSES + classes[:-1]) * N_CLASSES + classes[1:]
    out[:, : N_CLASSES**2] = np.bincount(pairs[same], minlength=n * N_CLASSES**2).reshape(n, -1) / np.maximum(length, 1)[:, None]
    # Words: runs of other bytes than white space, inside a passage.
    inside = (b != 32) & ((b < 9) | (b > 13))
    begins = inside.copy()
    begins[1:] &= ~(inside[:-1] & same)
    where = np.flatnonzero(inside)
    if len(where):
        word = np.cumsum(begins[where]) - 1
        heads = np.flatnonzero(begins[where])
        place = where - where[heads][word]
        folded = np.where((b[where] >= 65) & (b[where] <= 90), b[where] + 32, b[where]).astype(np.uint64)
        mixed = (folded + np.uint64(1)) * ((place.astype(np.uint64) * np.uint64(2) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
        hashes = np.add.reduceat(mixed ^ (mixed >> np.uint64(29)), heads)
        hashes ^= hashes >> np.uint64(32)
        own = passage[where[heads]]
        words = np.bincount(own, minlength=n)
        again = (hashes[1:] == hashes[:-1]) & (own[1:] == own[:-1])
        base, many = N_CLASSES**2, np.maximum(words, 1)
        out[:, base] = np.bincount(own[1:][again], minlength=n) / many
        pairs = np.unique((own.astype(np.uint64) << np.uint64(40)) | (hashes >> np.uint64(24)))
        out[:, base + 1] = np.bincount((pairs >> np.uint64(40)).astype(np.int64), minlength=n) / many
        out[:, base + 2] = np.bincount(own, np.diff(np.append(heads, len(where))), minlength=n) / many / 10
        buckets = own * WORD_BUCKETS + (hashes % np.uint64(WORD_BUCKETS)).astype(np.int64)
        out[:, base + 4 :] = np.bincount(buckets, minlength=n * WORD_BUCKETS).reshape(n, -1) / many[:, None]
    out[:, N_CLASSES**2 + 3] = length / PASSAGE
    return out, per


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def standard(x: np.ndarray, model: dict) -> np.ndarray:
    return np.clip((x - model["mean"]) / model["scale"], -5, 5)


def attend(codes: np.ndarray, model: dict) -> np.ndarray:
    """The unnormalised log weight of each passage."""
    return (np.tanh(codes @ model["V"]) * _sigmoid(codes @ model["U"])) @ model["w"]


def pooled(codes: np.ndarray, logits: np.ndarray, heads: np.ndarray, bag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Attention weights inside each bag, and the weighted sums of codes."""
    a = np.exp(logits - np.maximum.reduceat(logits, heads)[bag])
    a /= np.add.reduceat(a, heads)[bag]
    return a, np.add.reduceat(a[:, None] * codes, heads, axis=0)


def train(x: np.ndarray, sizes: np.ndarray, labels: np.ndarray, epochs: int = 30, batch: int = 64, rate: float = 3e-3, decay: float = 1e-4) -> dict:
    """Encoder, gated attention and output weights by Adam on the log loss of documents."""
    rng = np.random.default_rng(_SEED)
    d = x.shape[1]
    model = {"mean": x.mean(axis=0), "scale": x.std(axis=0) + 1e-3}
    x = standard(x, model).astype(np.float32)
    p = {"W": rng.normal(0, d**-0.5, (d, CODES)), "b": np.zeros(CODES), "V": rng.normal(0, 0.2, (CODES, ATTENTION)), "U": rng.normal(0, 0.2, (CODES, ATTENTION)), "w": rng.normal(0, 0.2, ATTENTION), "c": rng.normal(0, 0.2, CODES), "c0": np.zeros(1)}
    p = {k: v.astype(np.float32) for k, v in p.items()}
    m, v, step = {k: np.zeros_like(q) for k, q in p.items()}, {k: np.zeros_like(q) for k, q in p.items()}, 0
    first = np.concatenate([[0], np.cumsum(sizes)])
    for epoch in range(epochs):
        order = rng.permutation(len(sizes))
        for at in range(0, len(order), batch):
            docs = order[at : at + batch]
            n = sizes[docs]
            bag, heads = np.repeat(np.arange(len(docs)), n), np.concatenate([[0], np.cumsum(n)[:-1]])
            xs, y = x[np.concatenate([np.arange(first[i], first[i + 1]) for i in docs])], labels[docs]
            codes = np.tanh(xs @ p["W"] + p["b"])
            t, s = np.tanh(codes @ p["V"]), _sigmoid(codes @ p["U"])
            a, z = pooled(codes, (t * s) @ p["w"], heads, bag)
            error = (_sigmoid(z @ p["c"] + p["c0"]) - y) / len(docs)
            dz = error[:, None] * p["c"]
            da = (codes * dz[bag]).sum(axis=1)
            de = a * (da - np.add.reduceat(a * da, heads)[bag])
            dts = de[:, None] * p["w"]
            dt, du = dts * s * (1 - t * t), dts * t * s * (1 - s)
            dcodes = a[:, None] * dz[bag] + dt @ p["V"].T + du @ p["U"].T
            dpre = dcodes * (1 - codes * codes)
            grads = {"W": xs.T @ dpre + decay * p["W"], "b": dpre.sum(axis=0), "V": codes.T @ dt, "U": codes.T @ du, "w": (t * s).T @ de, "c": z.T @ error, "c0": error.sum(keepdims=True)}
            step += 1
            lr = rate * 0.5 * (1 + math.cos(math.pi * epoch / epochs))
            for k, g in grads.items():
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.001 * (g * g - v[k])
                p[k] -= (lr * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return model | p


def fit(docs: DataFrame, labels: DataFrame, fit_documents: int = FIT_DOCUMENTS) -> dict:
    """A model from documents (doc_id, text) and labels (doc_id, quality); held-out ids must be left out by the caller.

    Ids labelled both ways go by the majority, ties count as 1; null labels and ids are left out.
    Without labels of both kinds the model is a constant: the share of label 1, or 0.5 without any.
    Of each document FIT_PASSAGES passages at most are encoded. Equal rows count once; should ids be
    shared by so many other texts that more than twice fit_documents rows are drawn, fewer are taken.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("y"))
    counts = {r[0]: r[1] for r in known.groupBy("y").count().collect()}
    n = sum(counts.values())
    if len(counts) < 2:
        return {"constant": float(next(iter(counts), 0.5))}
    if n > fit_documents:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < math.ceil(fit_documents / n * (1 << 20)))
    drawn = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key")).join(F.broadcast(known), "doc_id").select("y", "text", "key")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                bags = [features(spaced((t.as_py() or "").encode(), FIT_PASSAGES))[0].astype(np.float16).tobytes() for t in batch.column(1)]
                yield pa.RecordBatch.from_pydict({"y": batch.column(0), "x": pa.array(bags, pa.binary()), "key": batch.column(2)})

    with shared.scratch():
        encoded = shared.written(drawn.mapInArrow(encode, "y int, x binary, key long").dropDuplicates(["key"]), "features")
        held = encoded.count()
        if held > 2 * fit_documents:
            encoded = encoded.where(F.pmod(F.xxhash64("key"), F.lit(1 << 20)) < math.ceil(fit_documents / held * (1 << 20)))
        rows = encoded.select("y", "x").collect()
    rows.sort(key=lambda r: (r[0], bytes(r[1])))
    if len({r[0] for r in rows}) < 2:
        return {"constant": float(rows[0][0]) if rows else 0.5}
    bags = [np.frombuffer(r[1], np.float16).reshape(-1, N_FEATURES) for r in rows]
    return train(np.concatenate(bags).astype(np.float32), np.array([len(b) for b in bags]), np.array([r[0] for r in rows], np.float32))


def scores(texts: list[bytes], model: dict) -> np.ndarray:
    """One score for each text; all passages of a text share one softmax."""
    if "constant" in model:
        return np.full(len(texts), model["constant"])
    codes, bags = [], []
    for owners, pieces in portions(texts):
        x, per = features(pieces)
        codes.append(np.tanh(standard(x, model) @ model["W"] + model["b"]))
        bags.append(np.repeat(np.array(owners), per))
    codes, bag = np.concatenate(codes), np.concatenate(bags)
    heads = np.flatnonzero(np.append(True, bag[1:] != bag[:-1]))
    _, z = pooled(codes, attend(codes, model), heads, bag)
    return _sigmoid(z @ model["c"] + model["c0"]).astype(np.float64)


def score(docs: DataFrame, model: dict, into: str = "score") -> DataFrame:
    """docs' rows with all their columns and the score in ``into``; null and empty texts are one empty passage.

    A column that has that name already gives way.
    """
    docs = docs.drop(into)
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")
    schema = docs.select(*docs.columns, F.lit(0.0).alias(into)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = scores([(t.as_py() or "").encode() for t in batch.column(at)], shipped.value)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], names=[*batch.schema.names, into])

    return docs.mapInArrow(run, schema)


def op1_quality_mil(spark, sf_dir: str) -> DataFrame:
    """The quality score of every whole text, learned from labels of documents that are not held out.

    Null and empty texts are scored as one empty passage. Repeated rows each get their row; a null
    doc_id counts as the empty text in the split; ids labelled both ways go by the majority, ties
    count as 1. Without labels of both kinds the score is the share of label 1, or 0.5 without any.
    An empty table gives no rows. Very long texts are encoded whole, in portions.
    """
    docs = shared.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    learn = shared.bucket_of_id(F.col("doc_id")) != 2
    model = fit(docs.where(learn), shared.table(spark, sf_dir, "labels").where(learn))
    scored = score(docs, model)
    return scored.select("doc_id", (~learn).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
