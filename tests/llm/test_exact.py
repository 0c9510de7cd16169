"""Exact duplicates against plain grouping, on texts that share prefixes, end early or are equal."""

from __future__ import annotations

import collections
import hashlib
import random

import pytest

from tonemill.llm import exact

SCHEMA = "doc_id long, text string, grp string, rest string, row long, digit string"


def rows():
    rng = random.Random(11)
    long = "".join(rng.choices("abcé \n", k=40_000))
    texts = [long, long, long[:-1], long + "x", long[:576], long[:577], long[:64], long[:63]]
    texts += ["head " * 30 + str(i % 7) for i in range(40)]  # one prefix, seven texts
    texts += ["hot copy " * 50] * 150 + [None, "", "", " ", "é", "é", "A", "a"]
    texts += ["".join(rng.choices("ab", k=rng.randint(1, 5))) for _ in range(100)]
    out = [(i, t, "g", "r", 1, "d") for i, t in enumerate(texts)]
    out += [(3, "same row", "g", "r", 1, "d")] * 3 + [(None, "no id", "g", None, 1, "d")] * 2
    out += [(None, "same row", "g", "r", 1, "d")]
    rng.shuffle(out)
    return out


def expected(data):
    groups = collections.defaultdict(list)
    for r in data:
        groups[r[1] or ""].append(r[0])
    out = collections.Counter()
    for text, ids in groups.items():
        sha = hashlib.sha256(text.encode()).hexdigest()
        ids.sort(key=lambda i: (i is not None, i))
        for n, i in enumerate(ids, 1):
            out[(i, ids[-1], len(ids), n == len(ids), sha)] += 1
    return out


@pytest.mark.parametrize("first,growth", [(64, 8), (1, 2), (100_000, 8)])
def test_equal_texts(spark, first, growth):
    data = rows()
    docs = spark.createDataFrame(data, SCHEMA).repartition(5)
    got = exact.exact_duplicates(docs, first_digit=first, growth=growth)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert collections.Counter(tuple(r) for r in got.collect()) == expected(data)


def test_normalised_and_empty(spark):
    docs = spark.createDataFrame([(1, "A b"), (2, "a b"), (3, "a  b")], "doc_id long, text string")
    from pyspark.sql import functions as F
    got = {r.doc_id: r.keep_id for r in exact.exact_duplicates(docs, normalise=F.lower).collect()}
    assert got == {1: 2, 2: 2, 3: 3}
    assert exact.exact_duplicates(docs.limit(0)).count() == 0
