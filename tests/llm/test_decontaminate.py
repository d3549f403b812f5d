import random

import numpy as np
import pytest

from gridweave.llm.decontaminate import contamination, keep_clean, tiled_pairs, tiles

WORDS = [f"w{i}" for i in range(300)]


def plain_tiles(item, text, k):
    """Greedy string tiling word by word."""
    marked_i, marked_t, out = set(), set(), []
    while True:
        best = None
        for x in range(len(item)):
            for y in range(len(text)):
                n = 0
                while (
                    x + n < len(item) and y + n < len(text) and item[x + n] == text[y + n]
                    and x + n not in marked_i and y + n not in marked_t
                ):
                    n += 1
                if n >= k and (best is None or n > best[2]):
                    best = (x, y, n)
        if best is None:
            return out
        out.append(best)
        marked_i.update(range(best[0], best[0] + best[2]))
        marked_t.update(range(best[1], best[1] + best[2]))


@pytest.mark.parametrize("seed", range(8))
def test_tiles_match_plain_tiling(seed):
    rng = random.Random(seed)
    item = rng.choices("abc", k=rng.randint(3, 25))
    text = rng.choices("abc", k=10) + item[5:] + rng.choices("abc", k=5) + item[:6]
    k = 3
    seeds = [
        (x, y)
        for x in range(len(item) - k + 1)
        for y in range(len(text) - k + 1)
        if item[x : x + k] == text[y : y + k]
    ]
    i, j = np.array(seeds, np.int32).reshape(-1, 2).T
    assert sorted(tiles(i, j, k)) == sorted(plain_tiles(item, text, k))


def test_copies_reordered_passages_and_clean_texts(spark, docs):
    rng = random.Random(1)
    item = rng.choices(WORDS, k=30)
    noise = lambda n: rng.choices([f"n{i}" for i in range(500)], k=n)
    rows = [
        (1, " ".join(noise(50) + item + noise(20))),
        (2, " ".join(noise(9) + item[20:] + noise(9) + item[10:20] + noise(9) + item[:10]).upper()),
        (3, " ".join(noise(80))),
        (4, " ".join(noise(9) + item[:7])),
        (5, None), (6, ""), (7, ", ".join(item) + " x " * 200_000),
    ]
    bench = spark.createDataFrame(
        [(9, " ".join(item)), (8, " ".join(item)), (10, "too short"), (11, None), (None, "a b c d e")],
        "item_id long, text string",
    )
    got = {r.doc_id: r for r in contamination(docs(rows), bench).collect()}
    assert {i for i, r in got.items() if r.leaked} == {1, 2, 7}
    assert got[1].items == [8] and got[4].coverage == 7 / 30 and got[5].coverage == 0
    tiled = {r.doc_id: r for r in tiled_pairs(docs(rows), bench).collect()}
    assert tiled[2].n_tiles == 3 and tiled[2].longest == 10
    assert sorted(r.doc_id for r in keep_clean(docs(rows), bench).collect()) == [3, 4, 5, 6]
    assert keep_clean(docs([]), bench).collect() == []
    clashing = docs(rows).selectExpr("*", "1 as leaked_id", "2 as covered", "3 as item_id")
    kept = keep_clean(clashing, bench)
    assert kept.columns == clashing.columns and kept.count() == 4
    assert keep_clean(docs(rows), bench.limit(0)).count() == len(rows)


def test_rows_without_id_and_rows_that_share_one(spark, docs):
    bench = spark.createDataFrame([(1, "a b c d e f g h")], "item_id long, text string")
    rows = [(None, "a b c d e f g h"), (2, "a b c d e f g h"), (2, "x"), (2, "a b c d e f g h")]
    assert [(r.doc_id, r.leaked) for r in contamination(docs(rows), bench).orderBy("doc_id").collect()] == [
        (None, True), (2, True),
    ]
    assert [r.doc_id for r in keep_clean(docs(rows), bench).collect()] == [None]
