"""Language identification: the vote by plain Python, and tables that share IDs, languages or names."""

from __future__ import annotations

import itertools
import math
import random

import numpy as np
import pyarrow as pa
import pytest

from tonemill.llm import langid

WORDS = {"en": "the and of house water good", "de": "das und haus wasser gut nicht", "fr": "le et maison eau bon pas",
         "es": "el y casa agua bueno no", "it": "il e casa acqua buono non"}
SCHEMA = "doc_id long, text string, lang string, letter string, LETTER_ string, source string"


def rows(n=300, ids=None, seed=1, langs=WORDS):
    rng = random.Random(seed)
    return [(i if ids is None else ids, " ".join(rng.choices(WORDS[lang].split(), k=rng.randint(3, 20))),
             lang, "a", "b", "s") for i, lang in zip(range(n), itertools.cycle(langs))]


def accuracy(spark, model, seed=2):
    test = spark.createDataFrame(rows(200, seed=seed), SCHEMA)
    got = langid.predict(test, model).collect()
    return np.mean([r.lang == r.lang_pred for r in got])


def plain_vote(model, x, names):
    """Winner by pairs won, then by summed margins; its weakest probability."""
    out = []
    for v in x:
        wins, total, least = ({n: 0 for n in names}, {n: 0.0 for n in names}, {n: 1.0 for n in names})
        for a, b in itertools.combinations(names, 2):
            w = model.pairs[a, b].astype(float)
            margin = float(v.astype(float) @ w[:-1] + w[-1])
            sure = 1 / (1 + math.exp(-4 * max(-50, min(50, margin))))
            wins[a if margin > 0 else b] += 1
            total[a], total[b] = total[a] + margin, total[b] - margin
            least[a], least[b] = min(least[a], sure), min(least[b], 1 - sure)
        best = max(names, key=lambda n: (wins[n], total[n]))
        out.append((best, least[best]))
    return out


def test_rows_that_share_an_id(spark):
    data = rows(ids=7) + [(7, None, "en", "a", "b", "s"), (7, "x y", None, "a", "b", "s"), (None, "q", "en", "a", "b", "s")]
    model = langid.fit(spark.createDataFrame(data, SCHEMA).repartition(3), sample=40)
    assert set(model.pairs) == {("germanic", "romance"), ("de", "en"), ("es", "fr"), ("es", "it"), ("fr", "it")}
    assert accuracy(spark, model) > 0.95


def test_one_text_repeated_is_still_learnt(spark):
    data = [(7, "the and of house", "en", "a", "b", "s")] * 900 + rows(300, langs=["de", "fr"])
    model = langid.fit(spark.createDataFrame(data, SCHEMA).repartition(3), sample=50)
    got = langid.predict(spark.createDataFrame(data[:1] + data[-2:], SCHEMA), model).collect()
    assert [r.lang_pred for r in got] == ["en", "de", "fr"]


def test_one_language_and_none(spark):
    model = langid.fit(spark.createDataFrame(rows(20, langs=["en"]), SCHEMA))
    test = spark.createDataFrame(rows(5) + [(1, "12 .", None, "a", "b", "s"), (1, None, None, "a", "b", "s")], SCHEMA)
    assert [r.lang_pred for r in langid.predict(test, model).collect()] == ["en"] * 5 + ["und"] * 2
    empty = langid.fit(test.limit(0))
    assert {r.lang_pred for r in langid.predict(test, empty).collect()} == {"und"}


def test_junk_labels_are_bounded(spark):
    data = rows() + [(1000 + i, "zz " * 5, f"junk{i}", "a", "b", "s") for i in range(300)]
    model = langid.fit(spark.createDataFrame(data, SCHEMA), languages=5)
    assert {n for names in model.families.values() for n in names} == set(WORDS)
    assert accuracy(spark, model) > 0.95


def test_the_vote_is_that_of_plain_python_and_columns_pass_through(spark):
    model = langid.fit(spark.createDataFrame(rows(), SCHEMA))
    data = rows(60, seed=9)
    got = langid.predict(spark.createDataFrame(data, SCHEMA).coalesce(1), model).collect()
    x = langid.features(pa.array([r[1] for r in data]))
    families = plain_vote(model, x, sorted(model.families))
    for r, v, row, (family, sure) in zip(got, x, data, families):
        lang, within = plain_vote(model, v[None], model.families[family])[0]
        assert (r.lang_pred, r.score) == (lang, pytest.approx(sure * within, abs=1e-5))
        assert tuple(r)[:6] == row
