import random
import unicodedata
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import shared, token_files

WORD = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_round_trip(spark, awkward, name):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    clash = awkward.withColumn("start", F.lit("x")).withColumn("part", F.lit("y"))
    manifest = token_files.write(clash, shared.new_path(spark, "t"), public_tokenizers.path(name))
    got = sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in token_files.read(manifest).collect()), key=lambda r: r[1])
    rows = awkward.collect()
    order = [r[0] for r in got]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0)) and len(got) == len(rows)
    at, left = 0, [(r.doc_id, np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2], "<u4")) for r in rows]
    for doc_id, start, n, crc in got:
        match = next(x for x in left if x[0] == doc_id and len(x[1]) == n and zlib.crc32(x[1].tobytes()) == crc)
        left = [x for x in left if x is not match]
        assert start == at
        at += n


def test_words_stand_for_whole_texts():
    tokenizer = Tokenizer.from_file(WORD)
    assert token_files.separable(tokenizer.to_str())
    assert not token_files.separable(Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).to_str())
    words = token_files.WordIds(tokenizer, "<u4")
    texts = ["It's THE end, isn't it?!  Çа́ va — ÉÉN ß ﬁ ǅ İ ª", "a\tb c d\x1ce", "<|endoftext|>x<|startoftext|>", "é É ' 's x's ''s", "1234 5a6b ...", "don't,", "naïve. CAFÉ, Ünï;", " ", ""]
    for text in texts:
        assert np.frombuffer(words.encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_random_strings_of_all_scripts():
    tokenizer, rng = Tokenizer.from_file(WORD), random.Random(3)
    words = token_files.WordIds(tokenizer, "<u2")
    odd = "İıſẞßŉǰΐẗẚΣσςǅ\u212a\u2126\u0958\u0323\u0300\u0301\u0307ﬁﬆ漢字가\u1100\u1161.,;:!?'’-_ \n\t\u00a0\u200b\u3000ªºµ²½٣éÑÄABCxyz019"
    every = [chr(i) for i in range(1, 0x3100) if unicodedata.category(chr(i))[0] != "C"]
    texts = ["ANKARALİ.", "DEĞİL, BELİ.", "\u0958."]
    for _ in range(30_000):
        pool = odd if rng.random() < 0.6 else every
        texts.append("".join(rng.choice(pool) if rng.random() < 0.8 else rng.choice("aeE .,;!") for _ in range(rng.randint(1, 14))))
    for text, whole in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(words.encode(text), "<u2").tolist() == whole.ids, text


def test_plain_texts_are_not_given_to_the_library():
    """Marks, digits, capitals and letters of Latin-1 are cut here, and words of both cases are one: the library is slow for single words."""
    tokenizer, rng = Tokenizer.from_file(WORD), random.Random(5)
    words = token_files.WordIds(tokenizer, "<u2")
    letters = "aeinorstßàéöñÿAEÉÖÑ"
    texts = ["it's 'Twas ''S d'Été!?", "Foo.bar&&& FOO.BAR&&& 12,5% x_y\tz\r\nq ==='re", "÷×µªº «é»", "a<|endoftext|>b <|ENDOFTEXT|>"]
    texts += ["".join(rng.choice(letters if rng.random() < 0.7 else "0189.,'&-_<|>$ \n\tstdlvmr") for _ in range(40)) for _ in range(5_000)]
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    asked = []
    words.tokenizer = type("Counted", (), {"encode": lambda self, word, **kw: asked.append(word) or tokenizer.encode(word, **kw)})()
    assert [np.frombuffer(words.encode(t), "<u2").tolist() for t in texts] == want
    assert set(asked) == {"a<|endoftext|>b", "<|ENDOFTEXT|>", "«é»", "÷×µªº"}
    assert "foo.bar&&&" in words and "FOO.BAR&&&" not in words


def test_empty_table(spark, nothing):
    manifest = token_files.write(nothing, shared.new_path(spark, "t"), WORD)
    assert manifest.count() == 0 and token_files.read(manifest).count() == 0


def test_files_are_flat_and_read_by_ranges(spark, awkward, monkeypatch, tmp_path):
    monkeypatch.setattr(token_files, "READ_DOCS", 3)
    monkeypatch.setattr(token_files, "READ_IDS", 7)
    manifest = token_files.write(awkward, f"file://{tmp_path}/t", WORD, partitions=2)
    mapped = sorted(map(str, token_files.read(manifest).collect()))
    for file in manifest.collect():
        offsets = np.fromfile(file.path.removeprefix("file://") + ".offsets", "<i8")
        ids = np.fromfile(file.path.removeprefix("file://") + ".ids", file.dtype)
        assert offsets[0] == 0 and offsets[-1] == len(ids) == file.n_ids and len(offsets) == file.n_docs + 1
        assert all(ids[e - 1] == 2 for e in offsets[1:])
    monkeypatch.setattr(token_files.pafs, "LocalFileSystem", type("Other", (), {}))  # as a store that cannot be mapped
    flat = token_files.Flat(file.path + ".ids", file.dtype)
    assert flat.whole is None and flat.range(2, 9).tolist() == ids[2:9].tolist()
    assert len(mapped) == 16
