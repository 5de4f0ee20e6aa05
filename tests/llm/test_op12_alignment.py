"""The alignment against a plain version over whole texts, and the laws of its fragments."""

import hashlib
import random
import unicodedata
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tidemark.llm import alignment

from .conftest import SCHEMA, prose

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def words():
    return alignment.Vocabulary(*PATHS)


def plain(rows):
    """Every link of every whole text, one after the other."""
    one, two = Tokenizer.from_file(PATHS[0]), SentencePieceProcessor(model_file=PATHS[1])
    one.encode_special_tokens = True
    shown = {c: i for i, c in enumerate([*range(33), *range(127, 161), 173])}
    inverse = {chr(256 + i): b for b, i in shown.items()} | {chr(b): b for b in range(256) if b not in shown}
    found, counts = [], Counter()
    for doc_id, text in rows:
        a = one.encode(" " + text, add_special_tokens=False).ids if text else []
        b = two.encode(text) if text else []
        in_a = [bytes(inverse[c] for c in one.id_to_token(i)) for i in a]
        in_b = [bytes([int(two.id_to_piece(i)[3:-1], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("\u2581", " ").encode() for i in b]
        if not text or not b"".join(in_a) == b"".join(in_b) == (" " + text).encode():
            found.append((doc_id, [], [], [], []))
            continue
        ends_b, at, groups, links, xs, ys, j, end_b = None, 0, [], [], [], [], 0, 0
        for i, t in enumerate(in_a):
            at += len(t)
            xs.append(a[i])
            while j < len(b) and end_b + len(in_b[j]) <= at:
                end_b += len(in_b[j])
                ys.append(b[j])
                j += 1
            if end_b == at:
                groups.append(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)))
                links.append((xs[-1], ys[-1]))
                xs, ys = [], []
        counts.update(links)
        found.append((doc_id, a, b, groups, links))
    most = Counter()
    for (_x, y), n in counts.items():
        most[y] = max(most[y], n)
    out = []
    for doc_id, a, b, groups, links in found:
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        out.append((doc_id, len(a), len(b), len(groups), len(links), sum(counts[k] == most[k[1]] for k in links), sum(counts[k] for k in links), sha))
    return sorted(out, key=str)


def got(df):
    out = alignment.align(df, *PATHS)
    assert out.columns == COLUMNS
    return sorted((tuple(r) for r in out.collect()), key=str)


ODD = ["a \u2581 b", "x" * 3000, "\u6f22\u5b57\u4eee\u540d " * 40, "two  spaces\n\nand\ttabs ", " leading", "<|endoftext|> <s> </s> <unk> <0x41>", "caf\u00e9 na\u00efve \U0001f600 e\u0301", "\u0000 nul", "1234567 5a6b ... don't ''s", "\u00a0\u3000 \u200b"]


@pytest.mark.parametrize("chunk,block", [(40, 50), (1 << 16, 1 << 19)])
def test_equals_a_plain_version(spark, awkward, monkeypatch, chunk, block):
    monkeypatch.setattr(alignment, "CHUNK", chunk)
    monkeypatch.setattr(alignment, "BLOCK", block)
    more = spark.createDataFrame([(100 + i, t, None, None, None) for i, t in enumerate(ODD)], SCHEMA)
    rng = random.Random(1)
    # A text of several ranges, one of which its bytes betray: none of its links may count.
    more = more.unionByName(spark.createDataFrame([(200, prose(rng, 300) + " \u2581 " + prose(rng, 300), None, None, None)], SCHEMA))
    df = awkward.unionByName(more).withColumn("key", F.lit("x")).withColumn("n_a", F.lit(1))
    assert got(df) == plain([(r.doc_id, r.text) for r in df.collect()])


def test_empty_table(spark, nothing):
    assert got(nothing) == []


@settings(max_examples=60, deadline=None)
@given(st.text(st.sampled_from("ab eE\u00e9\u6f22.,1'\n"), min_size=1, max_size=60), st.lists(st.integers(0, 80), max_size=6), st.randoms())
def test_fragments_of_any_byte_ranges_compose_in_any_order(words, text, offsets, rng):
    a, b, ok = next(words.encode([text]))
    assert ok
    cut_a, cut_b = words.ends(a, b)
    end_a, end_b = np.cumsum(words.len_a[a]), np.cumsum(words.len_b[b])
    edges = sorted({0, *offsets, int(end_a[-1])})
    parts = []
    for low, high in zip(edges[:-1], edges[1:], strict=True):  # the tokens that end in (low, high]
        in_a, in_b = (np.flatnonzero((e > low) & (e <= high)) for e in (end_a, end_b))
        own_a, own_b = (np.flatnonzero(np.isin(i, c)) for i, c in ((in_a, cut_a), (in_b, cut_b)))
        parts.append(alignment.fragment(words, a[in_a], b[in_b], own_a, own_b))
    while len(parts) > 1:
        i = rng.randrange(len(parts) - 1)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    whole = alignment.Fragment() + parts[0] + alignment.Fragment()
    assert whole.closed() == words.groups(a, b, cut_a, cut_b) and not whole.tail_a and not whole.tail_b


def test_ranges_are_encoded_as_the_whole_text(words):
    rng = random.Random(2)
    alphabet = ["word", "Wort", "l'a", "caf\u00e9", "12", "x1_y", "\u6f22\u5b57", "...", "-", "\n", "", "\t", "don't", "\u00a0"]
    for _ in range(150):
        text = " ".join(rng.choice(alphabet) for _ in range(60))
        pieces = list(alignment.ranges(text, 20))
        assert " ".join(pieces) == text
        whole, parts = next(words.encode([text])), list(words.encode(pieces))
        for side in (0, 1):
            assert np.concatenate([p[side] for p in parts]).tolist() == whole[side].tolist()


def test_the_faster_encoder_gives_the_same_ids(words):
    rng = random.Random(4)
    low = [chr(i) for i in range(1, 0x530) if unicodedata.category(chr(i)) != "Cs"]
    odd = "aeE tns'TSLRDVM19.,!_-\n\t\r\x0b\x1c\x85\u00a0\u00ad\u0301\u037e\u0345"
    texts = ["".join(rng.choice(odd if rng.random() < 0.6 else low) for _ in range(rng.randint(1, 30))) for _ in range(40_000)]
    assert words.fast is not None
    slow = words.bytes_of_a.encode_batch([" " + t for t in texts], add_special_tokens=False)
    for text, one, other in zip(texts, slow, words.ids_of_a(texts), strict=True):
        assert one.ids == other, text
