"""Each stage of the pipeline beside a plain version of its rule, on rows of every odd kind."""

from __future__ import annotations

import collections
import random
import re
import zlib

import pytest

import corpus_pipeline as pipeline

WORDS = {"en": "the and of house water good with from that this have will they".split(),
         "de": "das und haus wasser gut nicht mit von dass wir sie werden".split(),
         "fr": "le et maison eau bon pas avec des que nous vous sont".split()}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, shard int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def text(rng, lang, n):
    return " ".join("".join((rng.choice(WORDS[lang]), rng.choice(("", "", "x", "ab", "en")))) for _ in range(n))


def corpus():
    rng = random.Random(12)
    rows = [(i, text(rng, lang, rng.randint(30, 120)), lang, f"s{i % 3}", 1, 0.1, 3)
            for i in range(150) for lang in [("en", "de", "fr")[i % 3]]]
    odd = [None, "", " \n", "12 34 $$", "одна тысяча слов на чужом языке без меток", "the " * 30_000]
    rows += [(1000 + i, t, None, None, None, None, None) for i, t in enumerate(odd)]
    rows += [rows[5]] * 2 + [(None, text(rng, "en", 40), "en", "s1", 1, 0.1, 3)]
    return rows


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("sf")
    rng = random.Random(5)
    items = [(i, text(rng, "en", 25) + " " + " ".join(f"q{i}w{j}" for j in range(15))) for i in range(6)]
    spark.createDataFrame([*items, (90, None), (91, "")], "item_id long, text string").coalesce(1).write.parquet(
        f"{folder}/benchmark.parquet")
    return str(folder), items


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def ids(df):
    return collections.Counter(r.doc_id for r in df.collect())


def test_language(spark, sf):
    rows = corpus()
    got = pipeline.identify_language(spark, frame(spark, rows), sf[0])
    assert got.columns == list(pipeline.COLUMNS)
    kept = ids(got)
    clean = collections.Counter(r[0] for r in rows if r[0] is None or r[0] < 1000)
    assert all(kept[i] == n for i, n in clean.items())
    assert not any(kept[1000 + i] for i in range(4))  # null, empty, blank, no letter
    assert kept[1004] == 0 and kept[1005] == 1  # a language never learnt; a very long text
    told = {r.doc_id: r.lang for r in got.collect()}
    assert all(told[r[0]] == r[2] for r in rows if r[0] is not None and r[0] < 1000) and told[1005] == "en"


def test_near_duplicates(spark, sf):
    rng = random.Random(8)
    rows, groups = [], {}
    for g in range(12):
        words = text(rng, "en", 60).split()
        for j in range(g % 4 + 1):
            copy = list(words)
            if j:
                copy[rng.randrange(60)] += "changed"
            rows.append((100 - 7 * g + 1000 * j, " ".join(copy), "en", "s", 1, 0.1, 3))
            groups.setdefault(g, []).append(rows[-1][0])
    sets = {r[0]: {tuple(r[1].lower().split()[i:i + 5]) for i in range(56)} for r in rows}
    want = set(sets)
    for own in groups.values():
        for a in own:  # the least ID of what is linked stays
            if any(b < a and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]) for b in own):
                want.discard(a)
    odd = [(5000, None), (5001, ""), (5002, "x"), (5003, "x"), (None, "y"), (None, "y"), (5004, "z"), (5004, "z")]
    rows += [(i, t, "en", "s", 1, 0.1, 3) for i, t in odd]
    got = ids(pipeline.drop_near_duplicates(spark, frame(spark, rows), sf[0]))
    assert got == collections.Counter({**dict.fromkeys(want | {5000, 5001, 5002, 5004}, 1), None: 2})


def test_decontamination(spark, sf):
    folder, items = sf
    rng = random.Random(9)
    rows = [(i, text(rng, "de", 80), "de", "s", 1, 0.1, 3) for i in range(40)]
    for i, t in items:
        rows.append((500 + i, text(rng, "en", 30) + " " + t.upper() + " " + text(rng, "en", 30), "en", "s", 1, 0.1, 3))
        rows.append((600 + i, " ".join(t.split()[:4]), "en", "s", 1, 0.1, 3))  # a few words only
    rows += [(700, None, "en", "s", 1, 0.1, 3), (701, "", "en", "s", 1, 0.1, 3), (None, "x y", "en", "s", 1, 0.1, 3)]
    got = ids(pipeline.decontaminate(spark, frame(spark, rows), folder))
    assert got == collections.Counter(r[0] for r in rows if not (r[0] and 500 <= r[0] < 600))


def test_mixing(spark, sf):
    rows = [r for r in corpus() if r[0] is not None]
    got = pipeline.mix_sources(spark, frame(spark, rows), sf[0])
    counts, size = ids(got), {r[0]: len(WORD.findall(r[1] or "")) for r in rows}
    copies = collections.Counter(r[0] for r in rows)
    assert all(n <= 2 * copies[i] for i, n in counts.items()) and not any(counts[1000 + i] for i in range(3))
    source = {r[0]: r[3] for r in rows}
    sizes, taken = collections.Counter(), collections.Counter()
    for r in rows:
        sizes[r[3]] += size[r[0]]
    for i, n in counts.items():
        taken[source[i]] += n * size[i]
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s)))}
    left, target, total = dict(weights), {}, 1.5 * sum(sizes.values())
    while True:
        level = (total - sum(target.values())) / sum(left.values())
        full = [s for s in left if level * left[s] >= 2 * sizes[s]]
        if not full:
            break
        for s in full:
            target[s] = 2 * sizes[s]
            del left[s]
    target |= {s: level * w for s, w in left.items()}
    longest = max(size[i] for i in size if i != 1005)
    assert all(abs(taken[s] - target[s]) <= (longest if s else 30_000) for s in sizes)


def test_shards(spark, sf):
    rows = corpus()
    got = pipeline.shard(spark, frame(spark, rows), sf[0]).collect()
    crc = collections.Counter((r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in got) == crc
    slots = collections.defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(pipeline.N_SHARDS))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_no_rows(spark, sf):
    for name, stage in pipeline.STAGES:
        got = stage(spark, frame(spark, corpus()).limit(0), sf[0])
        assert got.count() == 0, name
        assert name == "sharding" or got.columns == list(pipeline.COLUMNS)
