"""Spelling variants against plain counting and comparison of all words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from gridweave.llm.spelling import Index, near_words, variants, vocabulary, without


def plain_words(rows, length=6, least=5):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= length and n >= least}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows):
    words = plain_words(rows)
    out = {}
    for w, n in words.items():
        close = [v for v in words if near(w, v)]
        best = min(close, key=lambda v: (-words[v], v), default=None)
        form = best if best is not None and words[best] >= 5 * n else None
        out[w] = [form, None, n, len(close), words[form] if form else None]
    for w, row in out.items():
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        row[1] = root
    return {w: tuple(r) for w, r in out.items()}


def got(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def edited(word, rng, letters):
    at = rng.randrange(len(word))
    kind = rng.randrange(3)
    return word[:at] + (rng.choice(letters) if kind < 2 else "") + word[at + (kind > 0) :]


def texts(seed, letters="abcéü", n=60):
    rng = random.Random(seed)
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(5, 9))) for _ in range(n)]
    words += [edited(rng.choice(words), rng, letters) for _ in range(2 * n)]
    words += [edited(w, rng, letters) for w in words[-n:]]
    rows = [(-1, "colourss " * 6 + "colours " * 40 + "colour " * 300)]  # a chain of forms
    for i in range(40):
        some = rng.choices(words, [1 + 40 * (j % 7 == 0) for j in range(len(words))], k=400)
        rows.append((i, rng.choice([" ", "-", "·", "中"]).join(w.upper() if rng.random() < 0.2 else w for w in some)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_as_all_words_compared(spark, docs, seed):
    rows = texts(seed)
    want = plain(rows)
    assert any(r[0] for r in want.values()) and want["colourss"][:2] == ("colours", "colour")
    assert got(variants(docs(rows))) == want


def test_small_shards_and_pieces_change_nothing(spark, docs):
    rows = texts(3, "ab", 40)  # two letters: halves are shared by many words
    assert got(variants(docs(rows), shard=64)) == plain(rows)


def test_a_hot_half(spark, docs):
    rng = random.Random(5)
    words = {"prefix" + "".join(rng.choice("xyz") for _ in range(6)) for _ in range(300)}
    rows = [(i, " ".join(sorted(words))) for i in range(6)]
    assert got(variants(docs(rows), shard=256)) == plain(rows)


def test_lost_letters(spark, docs):
    """Enough pairs of document and word that some lose a letter."""
    rows = [(i, "strawberry blueberries " * 6) for i in range(400)]
    want = plain(rows)
    assert len(want) > 2
    assert got(variants(docs(rows))) == want


def test_without():
    assert [without("aéb".encode(), i).decode() for i in range(3)] == ["éb", "ab", "aé"]


def test_edges(spark, docs):
    rows = [(1, None), (2, ""), (3, "123 -- 中文"), (None, "Ångström " * 7), (5, "straße×÷x " * 5)]
    assert got(variants(docs(rows))) == plain(rows)
    assert got(variants(docs([]))) == {}
    assert got(variants(docs([(1, "short few words")]))) == {}


def test_repeated_rows_and_clashing_columns(spark, docs):
    rows = texts(4)[:8] * 2
    clashing = ("word", "n", "form", "near", "shard", "place", "kind", "root", "piece")
    frame = docs(rows).selectExpr("*", *[f"doc_id as {name}" for name in clashing])
    assert got(variants(frame)) == plain(rows)


def test_very_long_texts_and_words(spark, docs):
    rows = [(1, "colour " * 400_000 + "color " * 50), (2, ("q" * 3000 + " ") * 6 + ("q" * 2999 + " ") * 40)]
    assert got(variants(docs(rows))) == plain(rows)


def test_vocabulary_counts(spark, docs):
    rows = texts(6)
    assert {r.word: r.n for r in vocabulary(docs(rows)).collect()} == plain_words(rows)


def test_near_words_of_equal_counts(spark):
    words = spark.createDataFrame([("aaaaaa", 9), ("aaaaab", 9), ("aaaaba", 9)], "word string, n long")
    rows = {r.word: (r.n_near, r.near, r.near_n) for r in near_words(words).collect()}
    assert rows == {"aaaaaa": (2, "aaaaab", 9), "aaaaab": (1, "aaaaaa", 9), "aaaaba": (1, "aaaaaa", 9)}


def test_an_index_finds_what_comparison_finds():
    rng = random.Random(7)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(4, 8))) for _ in range(400)})
    index = Index(words, np.ones(len(words), np.int64))
    asked = words[::3] + ["zzzzzz", "abcz"]
    found = set()
    for rightward in (True, False):
        who, what = index.near(asked, rightward)
        found |= {(asked[i], words[j]) for i, j in zip(who, what, strict=True)}
    assert found == {(a, b) for a in asked for b in words if near(a, b)}
