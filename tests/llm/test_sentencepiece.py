import random

import pytest

from gridweave.llm import sentencepiece
from gridweave.llm.sentencepiece import Encoder, Vocabulary, decode, decoded, encode, load, viterbi


@pytest.fixture(scope="module")
def vocabulary():
    return load()


def plain(word, vocabulary):
    """Best score over all ways to cut a word into pieces, characters spelled where need be."""
    best = [0.0] + [float("-inf")] * len(word)
    for j in range(1, len(word) + 1):
        for i in range(j):
            hit = vocabulary.pieces.get(word[i:j])
            if hit:
                best[j] = max(best[j], best[i] + hit[1])
        if word[j - 1] not in vocabulary.pieces:
            n = len(word[j - 1].encode())
            best[j] = max(best[j], best[j - 1] + n * vocabulary.penalty)
    return best[-1]


def test_best_scores(vocabulary):
    rng = random.Random(0)
    units = {" " * rng.randint(0, 2) + "".join(rng.choices("theringon🙂ßé", k=rng.randint(1, 12))) for _ in range(300)}
    score = {i: s for i, s in vocabulary.pieces.values()}
    raw = set(vocabulary.bytes_)
    for unit, ids in viterbi(sorted(units), vocabulary).items():
        got = sum(vocabulary.penalty if i in raw else score[i] for i in ids)
        assert got == pytest.approx(plain(unit.replace(" ", "▁"), vocabulary))


def test_ties_take_the_longer_last_piece():
    v = Vocabulary({"a": (0, -1.0), "b": (1, -1.0), "ab": (2, -2.0)}, list(range(3, 259)), 259)
    assert viterbi(["ab"], v)["ab"] == (2,)


TEXTS = [
    "", " ", "  two  spaces ", "line\n\nends\n", "▁ mark ▁▁x", "日本語 🙂\x00\x07", "a" * 500, "\ttab\r\n", "é̀ Ünï", "\ue000",
]


def test_round_trips(docs, vocabulary):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(90, None), (90, None), (None, "x y")]
    tokens = encode(docs(rows))
    got = {(r.doc_id, r.round_trip, r.n_tokens == len(r.token_ids or [])) for r in tokens.collect()}
    assert got == {(i, True, True) for i in range(len(TEXTS))} | {(90, None, True), (None, True, True)}
    back = {r.doc_id: r.text for r in decode(tokens).collect()}
    assert back[90] is None and all(back[i] == t for i, t in enumerate(TEXTS))
    assert encode(docs([])).collect() == []


def test_long_texts_are_cut_where_units_end(monkeypatch, vocabulary):
    text = "some words  and\n\nmore ▁ " * 40
    whole, bounds = Encoder(vocabulary)([text])
    monkeypatch.setattr(sentencepiece, "SLICE", 17)
    assert Encoder(vocabulary).long(text)[0].tolist() == whole.tolist()
    assert decoded(whole, bounds, vocabulary.spellings) == [text]


def test_memory_of_words_is_bounded(monkeypatch, vocabulary):
    monkeypatch.setattr(sentencepiece, "REMEMBERED", 3)
    e = Encoder(vocabulary)
    first = [x.tolist() for x in e(["a b c d e", "b c"])]
    assert [x.tolist() for x in e(["a b c d e", "b c"])] == first and len(e.known) <= 8
    assert first[1][0] == 0 and first[1][2] == len(first[0])
