"""Toxicity, quality and language: accuracy on rows kept from learning, and edge cases."""

import re

import numpy as np
import pyarrow as pa
import pytest

from gridweave.llm import language, quality, toxicity
from gridweave.llm.linear import row_sums, word_features
from gridweave.llm.quality import BAD, GOOD, LABELLERS, NONE, posteriors
from gridweave.llm.toxicity import swap_table, swapped

SF = "/root/testdata/sf0.1"
ODD = [(1, None), (2, ""), (3, "!!! 12 \x00"), (3, "!!! 12 \x00"), (None, "some plain words here"), (5, "word " * 300_000)]


@pytest.fixture(scope="module")
def tables(spark):
    return [spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels")]


def test_toxicity_of_held_out_rows(tables):
    documents, labels = tables
    got = toxicity.toxicity(documents, labels).filter("held_out").join(labels, "doc_id").toPandas()
    assert (got.predicted == got.toxic).mean() > 0.97
    assert ((got.predicted == 1) & (got.toxic == 0)).mean() < 0.01
    assert got.score.between(0, 1).all()


def test_swapping_names_of_groups_moves_no_score(spark):
    """Groups named in toxic rows only do not make a neutral mention toxic."""
    rng = np.random.RandomState(0)
    filler = [f"f{i}" for i in range(50)]
    rows, labels = [], []
    for i in range(400):
        bad = i % 2
        words = list(rng.choice(filler, 12))
        words.insert(3, rng.choice(["women", "muslims"] if bad and rng.rand() < 0.8 else ["men", "christians"]))
        if bad:
            words.insert(6, "moron")
        rows.append((i, " ".join(words)))
        labels.append((i, 1, bad))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    gap = {}
    for fair in (0.0, 20.0):
        w, b = toxicity.train(docs, marks, fair=fair)
        _, _, n, o = next(iter(word_features(pa.array(["f1 women f2", "f1 men f2"]))))
        score = row_sums(w[n], o)
        gap[fair] = abs(score[0] - score[1])
    assert gap[20.0] < 0.3 * gap[0.0]


def test_scores_do_not_depend_on_how_many_rows_are_taken(spark):
    """With fewer rows of the larger class than there are, scores and decisions stay alike."""
    rng = np.random.RandomState(3)
    rows, marks = [], []
    for i in range(3000):
        bad = i % 10 == 0
        words = list(rng.choice([f"f{j}" for j in range(40)], 10))
        # a word that one in two toxic texts and one in five others have
        if rng.rand() < (0.5 if bad else 0.2):
            words.append("rude")
        rows.append((i, " ".join(words)))
        marks.append((i, 1, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = {}
    for per_class in (4000, 300):
        w, b = toxicity.train(docs, labels, per_class=per_class)
        _, _, n, o = next(iter(word_features(pa.array(["f1 f2 rude", "f1 f2 f3"]))))
        got[per_class] = 1 / (1 + np.exp(-(row_sums(w[n], o) + b)))
    assert np.abs(got[300] - got[4000]).max() < 0.07
    assert ((got[300] >= 0.3) == (got[4000] >= 0.3)).all()


@pytest.mark.parametrize("module", [toxicity, quality])
def test_the_fit_takes_one_row_per_id(spark, monkeypatch, module):
    """A repeated doc_id does not bring all of its rows to the driver."""
    rows = [(i % 20 if i < 40 else 7, f"some words of text {i} and more") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(20)], "doc_id long, quality int, toxic int")
    sizes = []
    monkeypatch.setattr(
        module, "fit", lambda numbers, offsets, target, *a, **k: sizes.append(len(target)) or (np.zeros(1 << 18), 0.0)
    )
    module.train(docs, labels) if module is toxicity else module.train(docs)
    assert sizes == [20]


def test_swapped():
    table = swap_table((("women", "men"),))
    pattern = re.compile(r"\b(women|men)\b", re.IGNORECASE)
    assert swapped("Women and men, omen", table, pattern) == "men and women, omen"


def test_toxicity_edges(spark, docs):
    labels = spark.createDataFrame([(1, 1, 1), (None, 1, 1), (2, 0, None)], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(docs(ODD), labels).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    none = toxicity.toxicity(docs(ODD), labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert toxicity.toxicity(docs([]), labels).collect() == []
    assert toxicity.keep_clean(docs(ODD), labels).columns == docs(ODD).columns


def test_quality_matches_labels_it_never_saw(tables):
    documents, labels = tables
    got = quality.quality(documents).join(labels, "doc_id").toPandas()
    assert (got.keep == (got.quality == 1)).mean() > 0.98
    assert (~got.keep & (got.quality == 1)).mean() < 0.005


def test_quality_edges(docs):
    got = quality.quality(docs(ODD)).collect()
    assert len(got) == len(ODD)
    assert quality.quality(docs([])).collect() == []
    assert quality.keep_good(docs([])).collect() == []


def test_posteriors_find_labellers_of_unlike_faults():
    """Two faults that one labeller each sees, and one labeller that errs."""
    rng = np.random.RandomState(1)
    truth = rng.choice(3, 5000, p=[0.8, 0.1, 0.1])
    votes = np.full((5000, len(LABELLERS)), NONE)
    votes[:, 0] = np.where(truth == 1, BAD, GOOD)
    votes[:, 1] = np.where(truth == 2, BAD, GOOD)
    votes[:, 2] = np.where(truth == 2, BAD, GOOD)
    codes, inverse, counts = np.unique(
        votes @ 3 ** np.arange(len(LABELLERS)), return_inverse=True, return_counts=True
    )
    good = posteriors(codes, counts)[inverse]
    assert ((good > 0.5) == (truth == 0)).mean() > 0.99


def test_language_of_held_out_rows(tables):
    got = language.language(tables[0]).filter("held_out").join(tables[0].select("doc_id", "lang"), "doc_id")
    got = got.toPandas()
    assert (got.lang_pred == got.lang).mean() > 0.98


def test_language_edges(spark, docs):
    got = {(r.doc_id, r.lang_pred) for r in language.language(docs(ODD)).collect()}
    assert (1, "und") in got and (2, "und") in got and (3, "und") in got and (5, "en") in got
    assert language.language(docs([])).collect() == []
    nothing = docs(ODD).selectExpr("doc_id", "text", "cast(null as string) lang")
    assert {r.lang_pred for r in language.language(nothing).collect()} == {"und"}


def test_profiles_match_plain_sums(docs):
    """The vector of a text is the sum over its trigrams of the bound letters."""
    names, table = language.profiles(docs([(1, "Ab c"), (2, "abc abc")]), width=64)
    first, second, third = language._letters(64, language.SEED)
    code = {" ": 0, "a": 1, "b": 2, "c": 3}

    def plain(text):
        grams = [text[i : i + 3] for i in range(len(text) - 2)]
        v = sum(first[code[g[0]]] * second[code[g[1]]] * third[code[g[2]]] for g in grams)
        return v / len(grams)

    assert names == ["en"]
    assert np.allclose(table[0], plain(" ab c ") + plain(" abc abc "))
