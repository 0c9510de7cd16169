"""Retrieval against scoring every item for every passage, on groups, key types and odd items."""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from tonemill.llm import decontam


def texts(seed=3):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 5))) for _ in range(150)]
    items = [" ".join(rng.choices(words, k=rng.choice((20, 30, 130)))) + ". " + " ".join(rng.choices(words, k=12))
             for _ in range(70)]
    docs = [" ".join(rng.choices(words, k=rng.randint(0, 200))) for _ in range(25)]
    for i in range(0, 70, 3):  # whole, or the first 60, 80 or 100 in a hundred
        own = items[i].split()
        docs.append(" ".join([*rng.choices(words, k=40), *own[: len(own) * (60 + 20 * (i % 3)) // 100],
                              *rng.choices(words, k=40)]))
    return docs, items


def plain(docs, items, threshold):
    """The best passage score of every item in every document at or above the threshold."""
    n, words = len(items), [i.replace(".", " ").split() for i in items]
    df = {w: sum(w in x for x in words) for x in words for w in x}
    mean = sum(map(len, words)) / n
    impact = []
    for x in words:
        own = {w: math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * x.count(w) * (decontam.K1 + 1)
               / (x.count(w) + decontam.K1 * (1 - decontam.B + decontam.B * len(x) / mean)) for w in set(x)}
        impact.append({w: v / sum(own.values()) for w, v in own.items()})
    out = {}
    for d, doc in enumerate(docs):
        doc = doc.replace(".", " ").split()
        for i, own in enumerate(impact):
            passage = decontam.passage_words(len(words[i]))
            step = passage * decontam.STRIDE // decontam.PASSAGE
            best = max((sum(own.get(w, 0) for w in set(doc[a: a + passage]))
                        for a in range(0, max(1, len(doc)), step)), default=0)
            if best >= threshold:
                out[d, i] = best
    return out


@pytest.mark.parametrize("index_bytes", [1 << 22, 1500])
def test_equals_scoring_everything(spark, index_bytes):
    docs, items = texts()
    got = decontam.find_leaks(
        spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(3),
        spark.createDataFrame(list(enumerate(items)), "item_id long, text string"),
        overlap=0.0, index_bytes=index_bytes).collect()
    want = plain(docs, items, decontam.THRESHOLD)
    assert len(want) > 15
    found = {(r.doc_id, r.item_id): r.score for r in got}
    assert set(found) == set(want)
    assert all(found[k] == pytest.approx(v, abs=1e-5) for k, v in want.items())


@pytest.mark.parametrize("kind", ["smallint", "string", "double", "date"])
def test_keys_of_any_type_and_odd_items(spark, kind):
    docs, items = texts()
    table = spark.createDataFrame(
        [("5", items[0]), ("5", None), (None, items[3]), (None, None), ("7", ""), ("8", " ., ")],
        "item_id string, text string").selectExpr(
        f"CAST({'date_add(DATE 2000-01-01, CAST(item_id AS int))'.replace('DATE 2000-01-01', 'DATE' + chr(39) + '2000-01-01' + chr(39)) if kind == 'date' else 'item_id'} AS {kind}) AS item_id", "text")
    got = decontam.find_leaks(spark.createDataFrame(
        [(1, items[0]), (2, items[3]), (3, None), (None, items[0])], "doc_id long, text string"), table)
    assert got.schema["item_id"].dataType.simpleString() == kind
    rows = {(r.doc_id, r.item_id is None) for r in got.collect()}
    assert rows == {(1, False), (None, False), (2, True)}


def test_an_index_of_many_items_stays_small():
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(20_000)]
    items = [(i, " ".join(rng.choices(words, k=40))) for i in range(10_000)]
    index = decontam.Index(items)
    size = index.bounds.nbytes + sum(sum(x.nbytes for x in b[1:]) for b in index.blocks)
    assert size < 16 * 1024 * 1024 and len(index.blocks) <= 65
    hit = index.matches(pa.array([items[77][1]]), 0.6, 0.6)
    assert [h[1] for h in hit] == [77] and np.isclose(hit[0][2], 1.0)
