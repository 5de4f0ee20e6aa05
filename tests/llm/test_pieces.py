import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import anchors, language_id, pieces, shingles, token_files

TEXT = "Some words, and a longerword\nthat goes on; é ß don't 12 ab" * 200 + "x" * 300 + " end"


@pytest.mark.parametrize("text", [TEXT, TEXT.encode(), "", b"", "nogapatall" * 50])
def test_pieces_make_up_the_text(text):
    out = list(pieces.cut(text, 100))
    assert type(text)().join(out) == text
    assert all(p[:1] in (" ", "\n", b" ", b"\n") for p in out[1:])


def test_results_do_not_depend_on_pieces(monkeypatch):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    model = language_id.Model(["a", "b"], {"words": 0}, np.array([[-1.0, -2.0]]), {1: ({"e": 0}, np.array([[-3.0, -1.0]]))})
    data = bytes(np.random.default_rng(1).integers(97, 100, 3000, dtype=np.uint8))

    def results():
        return [shingles.word_hashes(TEXT.encode()).tolist(), shingles.shingle_set(TEXT.encode()).tolist(), token_files.WordIds(tokenizer, "<u4").encode(TEXT), language_id.Scorer(model).predict(TEXT)[0], [x.tolist() for x in anchors.find(data, 200)]]

    whole = results()
    monkeypatch.setattr(pieces, "PIECE", 97)
    monkeypatch.setattr(anchors, "SEGMENT", 311)
    assert results() == whole
