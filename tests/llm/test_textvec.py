import re

import numpy as np
import pyarrow as pa
import pytest

from gridweave.llm import textvec
from gridweave.llm.textvec import PLAIN, SPACED, grams, shingle_sets, words

TEXTS = ["", None, "one", "a b c d", "a  b\tc\nd\x0be", "A b C d E f", "a b c d e f", "é Ü \x00 x", " lead trail "]


def split(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0d]+", lower)


def test_equal_words_have_equal_hashes():
    hashes = {}
    for a, b, found, offs, _ in words(pa.array(TEXTS, pa.string()), SPACED):
        for r in range(a, b):
            got = found[offs[r - a] : offs[r - a + 1]]
            want = split(TEXTS[r])
            assert len(got) == len(want)
            for w, h in zip(want, got.tolist(), strict=True):
                assert hashes.setdefault(w, h) == h
    assert len(set(hashes.values())) == len(hashes)


@pytest.mark.parametrize("piece", [8, 64, 1 << 20])
def test_pieces_do_not_change_hashes(monkeypatch, piece):
    texts = pa.array(["some words " * 50, "x" * 300 + " y", None, "z"])
    whole = [h.tolist() for *_, h, _, _ in words(texts, SPACED)]
    monkeypatch.setattr(textvec, "PIECE", piece)
    parts = [h.tolist() for *_, h, _, _ in words(texts, SPACED)]
    assert sum(parts, []) == sum(whole, [])


def test_shingle_sets_match_plain_sets():
    texts = [*TEXTS, "a b c d e " * 40, "w1 w2 w3 w4 w5 w6 w7 w8"]
    got = dict(shingle_sets(pa.array(texts, pa.string())))
    for r, text in enumerate(texts):
        w = split(text)
        n = len({tuple(w[i : i + 5]) for i in range(len(w) - 4)}) if len(w) >= 5 else min(len(w), 1)
        assert len(got[r]) == n
    # of fewer words: apart by length and order
    few = dict(shingle_sets(pa.array(["a b", "a b ", "b a", "a b c"])))
    assert few[0].tolist() == few[1].tolist() and len({int(few[i][0]) for i in (0, 2, 3)}) == 3


def test_prefix_hashes_and_grams():
    for *_, hashes, _, (short,) in words(pa.array(["losers loser lose", "x"]), PLAIN, (4,)):
        assert len(set(short[:3].tolist())) == 1 and len(set(hashes.tolist())) == 4
    assert len(grams(np.arange(4, dtype=np.uint64), 5)) == 0
