"""Ranked search against scores of every document, on ties, odd rows and several shards and groups."""

from __future__ import annotations

import collections
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tonemill.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, query long, row long, shard int, terms string"
ITEMS = "item_id long, text string, item string, terms int"


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def rows():
    rng = random.Random(3)
    words = ["".join(rng.choices("abcé9", k=rng.randint(1, 3))) for _ in range(120)]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, rng.choice(" -,_").join(rng.choices(words, weights, k=rng.randint(1, 80))))
            for i in range(300)]
    docs += [(1000 + i, "same TEXT of a copy") for i in range(30)]
    docs += [(2000, "same text"), (2000, "same text"), (None, "same text"), (None, None),
             (2001, ""), (2002, " ,;"), (2003, "ab " * 20_000)]
    items = [(i, " ".join(rng.choices(words, weights, k=rng.randint(1, 25)))) for i in range(40)]
    items += [(7, "same"), (7, "same text ab"), (100, None), (101, " ? "), (102, "zzzz"), (None, "copy")]
    return docs, items


def expected(docs, items, k):
    counts = [(i, collections.Counter(terms(t))) for i, t in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    df = collections.Counter(t for _, c, _ in counts for t in c)
    total, n_docs = sum(n for _, _, n in counts), len(counts)
    out = []
    for item, text in items:
        found = []
        for i, c, n in counts:
            m = 100 - 50 + (50 * n * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if c[t])
            if score > 0:
                found.append((-score, i is not None, i))
        found.sort(key=lambda f: (f[0], f[1], f[2] or 0))
        out += [(item, rank, f[2], -f[0]) for rank, f in enumerate(found[:k], 1)]
    return collections.Counter(out)


@pytest.mark.parametrize("k,group_terms,shard_postings", [
    (5, 1 << 20, 1 << 21), (5, 100, 500), (50, 1 << 20, 900), (1, 1 << 20, 200)])
def test_equals_scoring_every_document(spark, k, group_terms, shard_postings):
    docs, items = rows()
    got = ranked.rank_documents(
        spark.createDataFrame([(*d, 1, 1, 1, "x") for d in docs], DOCS).repartition(4),
        spark.createDataFrame([(*i, "x", 1) for i in items], ITEMS).repartition(2), k,
        group_terms=group_terms, shard_postings=shard_postings)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert collections.Counter(tuple(r) for r in got.collect()) == expected(docs, items, k)


def test_no_accumulator_is_made_that_cannot_reach_the_kth():
    """With a limit near the best score the frequent lists are only read for survivors."""
    n = 2000
    table = pa.table({"id": pa.array(range(n)), "n": pa.array(np.full(n, 10)),
                      "terms": pa.array([[0, 1] if i < 3 else [1] for i in range(n)]),
                      "freqs": pa.array([[1, 1] if i < 3 else [1] for i in range(n)])})
    table = table.cast(pa.schema([("id", pa.int64()), ("n", pa.int64()),
                                  ("terms", pa.list_(pa.int32())), ("freqs", pa.list_(pa.int32()))]))
    lists = ranked.Lists(table, np.array([9000, 10]), n, 10 * n)
    best, scores = lists.search(np.array([0, 1]), 3, 0)
    assert best.tolist() == [0, 1, 2] and (scores == lists.gains[0] + lists.gains[-1]).all()
    assert lists.search(np.array([0, 1]), 3, int(scores[0]) + 1)[0].tolist() == []


def test_empty_tables(spark):
    docs, items = rows()
    d = spark.createDataFrame([(*x, 1, 1, 1, "x") for x in docs[:5]], DOCS)
    i = spark.createDataFrame([(*x, "x", 1) for x in items[:5]], ITEMS)
    for got in (ranked.rank_documents(d.limit(0), i, 5), ranked.rank_documents(d, i.limit(0), 5)):
        assert got.columns == ["item_id", "rank", "doc_id", "score"] and got.count() == 0
