import random
import re
from pathlib import Path

import pytest

from gridweave.llm import ngram_jaccard
from gridweave.llm.common import shared_folder
from gridweave.llm.ngram_jaccard import jaccard_components, keep_one

WORDS = [f"w{i}" for i in range(400)]


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def plain(rows):
    """All pairs, then the smallest reachable id."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (a, s) in enumerate(sets):
        for b, t in sets[:n]:
            if s and t and 100 * len(s & t) >= 75 * len(s | t):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return sorted((i, len(s), root(i)) for i, s in sets)


def corpus(seed):
    rng = random.Random(seed)
    rows, n = [], 0
    boilerplate = " ".join(rng.choices(WORDS, k=30))
    for _ in range(25):
        base = rng.choices(WORDS, k=rng.choice([1, 3, 5, 7, 20, 60, 200]))
        for _ in range(rng.choice([1, 1, 2, 6])):
            w = list(base)
            for _ in range(rng.choice([0, 1, 2, 5])):
                w[rng.randrange(len(w))] = rng.choice(WORDS)
            text = " ".join(w)
            rows.append((n, text + " " + boilerplate if rng.random() < 0.4 else text))
            n += 1
    rng.shuffle(rows)
    return [*rows, (1000, None), (1001, ""), (1002, " \n ")]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_matches_all_pairs(docs, seed):
    rows = corpus(seed)
    got = sorted(tuple(r) for r in jaccard_components(docs(rows)).collect())
    assert got == plain(rows)


def test_chains_across_a_large_group_of_near_copies(docs):
    """No member need link with the pivot: links between all others count too."""
    rng = random.Random(5)
    base = rng.choices(WORDS, k=100)
    rows = []
    for i in range(60):
        base = list(base)
        base[rng.randrange(100)] = f"n{i}"
        rows.append((i, " ".join(base)))
    got = sorted(tuple(r) for r in jaccard_components(docs(rows)).collect())
    assert got == plain(rows)


def test_texts_repeated_in_other_partitions(docs):
    """Copies that other tasks read leave no tree out: the second and third text of each group link,
    where the first one, which links with neither, is the pivot of all trees they share."""
    rows = []
    for group in range(40):
        for extra in ("hhh", "bb", "cc"):
            own = [f"{x}{group}n{len(rows)}x{i}" for i, x in enumerate(extra)]
            rows.append((len(rows), " ".join([f"g{group}x{i}" for i in range(16)] + own)))
    again = [(i + 1000, t) for i, t in rows]
    every = docs(rows + again).repartitionByRange(2, "doc_id")
    got = sorted(tuple(r) for r in jaccard_components(every).collect())
    assert got == plain(rows + again)


def test_empty_nulls_and_repeated_rows(docs):
    assert jaccard_components(docs([])).collect() == []
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (9, None)]
    got = sorted(jaccard_components(docs(rows)).collect(), key=str)
    assert [(r.doc_id, r.n_shingles, r.component_id) for r in got] == [
        (3, 2, 3), (5, 2, 3), (5, 2, 3), (9, 0, 9), (None, 2, None),
    ]


def test_keep_one(docs):
    rows = [(4, "a b c d e"), (2, "a b c d e"), (2, "a b c d e"), (7, "x"), (8, None), (None, "q")]
    kept = keep_one(docs(rows))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [2, 7, 8, None]


def test_a_large_group_of_near_copies_is_dealt_out(docs, monkeypatch):
    """Its keys are common though the trial count does not see all of them, and links stay whole."""
    monkeypatch.setattr(ngram_jaccard, "COMMON", 16)
    rng = random.Random(6)
    base = rng.choices(WORDS, k=150)
    rows = []
    for i in range(300):
        w = list(base)
        for _ in range(rng.choice([1, 2, 4, 6, 8])):
            w[rng.randrange(150)] = f"n{i}"
        rows.append((i, " ".join(w)))
    frame = docs(rows)
    classes = ngram_jaccard.frequency_classes(frame, 5, 75).tobytes()
    assert any(ngram_jaccard.common_keys(frame, 5, 75, classes))
    assert sorted(tuple(r) for r in jaccard_components(frame).collect()) == plain(rows)


def test_an_id_with_two_texts(docs):
    a, b, c = "a b c d e f g", "p q r s t u v", "p q r s t u w x y z"
    rows = [(1, a), (1, b), (2, a), (3, b), (4, c), (4, c), (5, None), (5, None), (5, "")]
    frame = docs(rows).selectExpr("*", "1 as digest", "2 as own", "3 as label", "4 as component_id", "5 as head")
    kept = keep_one(frame)
    assert kept.columns == frame.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert got == sorted([(1, a), (1, b), (4, c), (5, None), (5, "")], key=str)


def test_near_copies_under_one_id(docs):
    words = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(words)), (1, " ".join(words[:-1])), (0, " ".join(words[1:]))]
    assert [r.doc_id for r in keep_one(docs(rows)).collect()] == [0]
    assert len(keep_one(docs(rows[:2])).collect()) == 1
    assert keep_one(docs([])).collect() == []


def test_very_long_texts(docs):
    rng = random.Random(8)
    long = rng.choices(WORDS, k=120_000)
    rows = [(1, " ".join(long)), (2, " ".join(long[:100_000])), (3, " ".join(long[:70_000])), (4, "x" * 500_000)]
    assert sorted(tuple(r) for r in jaccard_components(docs(rows)).collect()) == plain(rows)


def test_small_tables_are_not_dealt_over_files_of_a_few_rows(docs, spark):
    """Each file costs an executor two processes, beside which its memory counts twice."""
    rng = random.Random(9)
    rows = []
    for i in range(150):
        words = rng.choices(WORDS, k=60)
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join([*words[:-1], "z"]))]
    folder = Path(shared_folder(spark).removeprefix("file://"))
    before = set(folder.iterdir())
    held = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    kept = {c: spark.conf.get(c) for c in held}
    try:
        for c, v in held.items():
            spark.conf.set(c, v)
        got = sorted(tuple(r) for r in jaccard_components(docs(rows)).collect())
    finally:
        for c, v in kept.items():
            spark.conf.set(c, v)
    assert got == plain(rows)
    files = {}
    for d in set(folder.iterdir()) - before:
        files.setdefault(d.name.split("-")[1], []).append(len(list(d.glob("*.parquet"))))
    assert max(files["names"]) > 40
    assert max(max(files[x]) for x in ("close", "links", "labels", "rest")) <= 12


def test_a_large_tree_is_dealt_over_cells(docs, spark, monkeypatch):
    """A task gets two blocks of a tree at most, a few cells at a time, and no pair is lost."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    for constant, value in {"LEAF": 2, "SLOT": 4, "BLOCK": 2, "PAIRED": 3}.items():
        monkeypatch.setattr(ngram_jaccard, constant, value)
    inner = ngram_jaccard._cell_pairs

    def counted(share):
        def run(batches):
            def few():
                for batch in batches:
                    assert batch.num_rows <= 3
                    # slots are dealt by hash, so that they have their size on average
                    assert max(len(x) for x in batch["rows"].to_pylist()) < 40
                    yield batch

            yield from inner(share)(few())

        return run

    monkeypatch.setattr(ngram_jaccard, "_cell_pairs", counted)
    rng = random.Random(5)
    base = rng.choices(WORDS, k=100)
    rows = []
    for i in range(80):
        base = list(base)
        base[rng.randrange(100)] = f"n{i}"
        rows.append((i, " ".join(base)))
    assert sorted(tuple(r) for r in jaccard_components(docs(rows)).collect()) == plain(rows)
    assert spark.conf.get(name) == before
