"""Collocations against plain counting, on overlaps, odd rows and shards of any size."""

from __future__ import annotations

import collections
import random
import re

import numpy as np
import pytest

from tonemill.llm import phrases

SCHEMA = "doc_id long, text string, lang string, shard long, words array<string>, n long, phrase string"


def rows():
    rng = random.Random(5)
    words = ["".join(rng.choices("abcéA-'", k=rng.randint(1, 3))) for _ in range(25)]
    weights = [1 / (i + 1) for i in range(len(words))]
    out = []
    for i in range(250):
        text = "".join(w + rng.choice(["  ", "\t", " ", " ", " ", ". ", ",", "\n", "\x0b", " "])
                       for w in rng.choices(words, weights, k=rng.randint(1, 60)))
        out.append((i, text, rng.choice(["en", "en", "de", None, "und"])))
    out += [(500 + i, "to be or not to be, so so so so so so so", "en") for i in range(60)]
    out += [(600, "la la " * 3000, "fr"), (601, None, "en"), (602, "", None), (603, " ,. ", "xx"),
            (604, "alone", "yy"), (None, "to be", "en"), (None, "to be", "en")]
    return out


def expected(data, least, top, longest):
    totals, counts = collections.Counter(), collections.defaultdict(collections.Counter)
    for _, text, lang in data:
        lang = lang or "und"
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            w = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for m in range(1, longest + 1):
                for i in range(len(w) - m + 1):
                    counts[lang][tuple(w[i:i + m])] += 1
    out = []
    for lang, f in counts.items():
        found = {p for p in f if len(p) > 1 and f[p] >= least}
        rows = []
        for p in found:
            within = any(len(q) > len(p) and f[q] >= f[p]
                         and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q in found)
            if not within:
                score, _, left, right = min(
                    (1000 * f[p] * totals[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]])
                    for k in range(1, len(p)))
                rows.append((-score, -f[p], " ".join(p).encode(), left, right))
        rows.sort()
        out += [(lang, rank, r[2].decode(), -r[1], r[3], r[4], totals[lang], -r[0])
                for rank, r in enumerate(rows[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize("least,top,longest,shard_words,parts", [
    (20, 1000, 5, 1 << 20, 3), (8, 1000, 5, 200, 5), (12, 15, 3, 50, 2), (30, 9, 2, 400, 3)])
def test_equals_plain_counting(spark, least, top, longest, shard_words, parts):
    data = rows()
    docs = spark.createDataFrame([(*r, 7, ["x"], 7, "p") for r in data], SCHEMA).repartition(parts)
    got = phrases.collocations(docs, least, top, longest, shard_words=shard_words)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = expected(data, least, top, longest)
    assert len(want) > 10
    assert sorted(tuple(r) for r in got.collect()) == want


def test_nothing_frequent_and_empty(spark):
    docs = spark.createDataFrame([(*r, 7, ["x"], 7, "p") for r in rows()[:20]], SCHEMA)
    assert phrases.collocations(docs, 10**6, 5).count() == 0
    assert phrases.collocations(docs.limit(0), 1, 5).count() == 0


def test_every_occurrence_once():
    """All phrases of an index, with no threshold, count as plain windows do."""
    rng = np.random.default_rng(2)
    numbers = rng.integers(0, 5, 500).astype(np.int32)
    numbers[0] = 0
    index, hashes = phrases.Index(numbers, 6), (np.arange(1, 5, dtype=np.uint64) * np.uint64(977),)
    level = index.words(*hashes)
    for length in range(1, 6):
        want = collections.Counter(
            tuple(numbers[i:i + length].tolist()) for i in range(len(numbers) - length + 1)
            if (numbers[i:i + length] > 0).all())
        at = index.order[level.low]
        got = {tuple(int(numbers[(a + i) % 500]) for i in range(length)): int(n)
               for a, n in zip(at, level.size)}
        assert got == want and len(set(level.hashes[0].tolist())) == len(want)
        level = index.longer(level, hashes, length)


def test_large_counts_are_exact(spark):
    big = spark.createDataFrame([(10**12, 10**13, 10**12, 10**12)], "a long, n long, l long, r long")
    got = big.select(phrases._div(
        phrases._big("a", 18) * phrases._big("n", 15) * phrases.F.lit(1000).cast("decimal(4,0)"),
        phrases._big("l", 18) * phrases._big("r", 18)).cast("long")).first()[0]
    assert got == 1000 * 10**12 * 10**13 // 10**24


def test_numbers_that_frequent_phrases_cover(spark):
    numbers = np.array([0, 1, 2, 3, 1, 0, 2, 3, 4], np.int32)
    hashes = np.arange(1, 5, dtype=np.uint64) * np.uint64(977)
    frequent = phrases._joined(hashes[[1]], hashes[[2]], 1)  # words 2 and 3
    bits = phrases._filter(spark.createDataFrame([(int(frequent.view(np.int64)[0]),)], "hash1 long"))
    assert np.unpackbits(bits).sum() == 1 and phrases._passes(bits, frequent).all()
    kept, place = phrases._covered(numbers, hashes, 2, bits)
    assert kept.tolist() == [0, 2, 3, 0, 2, 3] and place.tolist() == [0, 2, 3, 0, 6, 7]
    assert len(phrases._covered(numbers, hashes, 2, bits * 0)[0]) == 0


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    data = rows()[:120]
    docs = spark.createDataFrame([(*r, 7, ["x"], 7, "p") for r in data], SCHEMA)
    monkeypatch.setattr(phrases, "_filter", lambda often: np.full(1 << 24, 255, np.uint8))
    got = phrases.collocations(docs, 10, 1000)
    assert sorted(tuple(r) for r in got.collect()) == expected(data, 10, 1000, 5)


def test_words_that_are_names_of_languages(spark):
    """The word ``es`` in ``en`` and the word ``en`` in ``es`` are two."""
    data = [(i, "es es es. de la" if i % 2 else "a es b", "en") for i in range(40)]
    data += [(100 + i, "en en. es a", "es") for i in range(30)] + [(200 + i, "es. en es", "de") for i in range(30)]
    docs = spark.createDataFrame([(*r, 7, ["x"], 7, "p") for r in data], SCHEMA).repartition(2)
    want = expected(data, 15, 100, 5)
    assert len(want) > 4
    assert sorted(tuple(r) for r in phrases.collocations(docs, 15, 100).collect()) == want
