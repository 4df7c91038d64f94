import numpy as np
import pyarrow as pa

from maskfold.llm import tokens

from .helpers import shingles, words


def test_words_and_shingles_agree_with_strings():
    texts = ["A b c d e F", "", None, "x y", "a b c d e f  ", "one two\x0bthree", "é É a b", "x" * 3000 + " y", "Z z z z z z z"]
    seen: dict = {}
    for first, last, data, off in tokens.pieces(pa.array(texts)):
        hashes, bounds = tokens.words(data, off)
        for i in range(last - first):
            own = words(texts[first + i])
            assert bounds[i + 1] - bounds[i] == len(own)
            for w, h in zip(own, hashes[bounds[i] : bounds[i + 1]].tolist()):
                assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)
    for first, _, values, bounds in tokens.document_sets(pa.array(texts)):
        sizes = np.diff(bounds).tolist()
        assert sizes == [len(shingles(t)) for t in texts[first : first + len(sizes)]]


def test_a_document_longer_than_a_piece_is_whole():
    text = " ".join(str(i) for i in range(tokens.PIECE // 3))
    assert len(text) > tokens.PIECE
    got = list(tokens.document_sets(pa.array(["a b", text, "c"])))
    assert sum(int(b[-1]) for *_, b in got) == 2 + len(words(text)) - 4


def test_sliced_and_null_columns():
    col = pa.array(["zero", None, "two words", "x"]).slice(1, 2)
    data, off = tokens.buffers(col)
    assert bytes(data) == b"two words" and off.tolist() == [0, 0, 9]
    assert tokens.buffers(pa.nulls(2))[1].tolist() == [0, 0, 0]
