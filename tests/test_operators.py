"""Operators against hand-computed rows and brute force on small fixtures."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import plain_rules
import pytest
from pyspark.sql import functions as F

from tonemill.constants import CLS, PAD, SEP, UNK
from tonemill.functions import scores, tokens
from tonemill.operators import (batches, frequent, metrics, profile, rows, subword, tfidf, trials,
                                vectors)
from tonemill.plans.ranges import dense_index
from tonemill.queries import profiling
from tonemill.sources import tables

EVAL = [(1, 1, 0.9), (0, 1, 0.8), (1, 1, 0.7), (0, 0, 0.3), (1, 0, 0.3)]


@pytest.fixture(scope="module")
def scored(spark):
    return spark.createDataFrame(
        [("m", i, *r) for i, r in enumerate(EVAL)],
        "model string, ID long, label int, prediction int, score double")


def test_metrics_golden(scored):
    m = metrics.binary_metrics(scored).first()
    assert m["accuracy"] == pytest.approx(0.6)
    assert [m["precision"], m["recall"], m["f1"]] == pytest.approx([2 / 3] * 3)
    assert metrics.roc_auc(scored).first()["auc"] == pytest.approx(3.5 / 6)
    assert metrics.batch_accuracy(scored, 2).first()["batch_accuracy"] == pytest.approx(0.5)
    cells = {(r["label"], r["prediction"]): r["n"] for r in metrics.confusion_matrix(scored).collect()}
    assert cells == {(0, 0): 1, (0, 1): 1, (1, 0): 1, (1, 1): 2}


def test_undefined_metrics_are_zero(spark):
    df = spark.createDataFrame([("m", 0, 0, 0, 0.1)], "model string, ID long, label int, prediction int, score double")
    m = metrics.binary_metrics(df).first()
    assert (m["precision"], m["recall"], m["f1"]) == (0, 0, 0)
    report = {r["class"]: r for r in metrics.classification_report(df).collect()}
    assert report["1"]["support"] == 0 and report["1"]["f1"] == 0
    assert report["weighted avg"]["f1"] == 1


def test_roc_equals_brute_force(spark):
    rng = random.Random(3)
    data = [(m, i, rng.randint(0, 1), 0, round(rng.random(), 1 if m == "ties" else 6))
            for m in ("ties", "fine") for i in range(400)]
    df = spark.createDataFrame(data, "model string, ID long, label int, prediction int, score double")
    points = metrics.roc_points(df).collect()
    aucs = {r["model"]: r["auc"] for r in metrics.roc_auc(df).collect()}
    for model in ("ties", "fine"):
        mine = [(d[4], d[2]) for d in data if d[0] == model]
        pos, neg = [s for s, y in mine if y], [s for s, y in mine if not y]
        pairs = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / len(pos) / len(neg)
        assert aucs[model] == pytest.approx(pairs)
        curve = [(t, sum(s >= t for s in neg) / len(neg), sum(s >= t for s in pos) / len(pos))
                 for t in sorted({s for s, _ in mine}, reverse=True)]
        xy = [c[1:] for c in curve]
        keep = [i for i in range(len(curve)) if i in (0, len(curve) - 1) or not np.allclose(
            np.subtract(xy[i + 1], xy[i]), np.subtract(xy[i], xy[i - 1]) if i else xy[i], atol=1e-12)]
        want = [(math.inf, 0.0, 0.0)] + [curve[i] for i in keep]
        got = sorted(((p["threshold"], p["fpr"], p["tpr"]) for p in points if p["model"] == model), reverse=True)
        assert len(got) == len(want)
        assert np.allclose([g[1:] for g in got], [w[1:] for w in want])


def test_dense_index_cuts_a_hot_group(spark):
    rows_ = [(i, "hot" if i % 3 else f"g{i % 7}", (i * 7919) % 5000) for i in range(5000)]
    df = spark.createDataFrame(rows_, "ID long, g string, k long")
    got = dense_index(df, [F.col("k")], by=["g"]).collect()
    assert len(got) == 5000
    for g in {r[1] for r in rows_}:
        mine = sorted((r for r in got if r["g"] == g), key=lambda r: r["k"])
        assert [r["idx"] for r in mine] == list(range(len(mine)))


def test_dense_index_keeps_null_groups(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, 1)], "ID long, g int")
    got = {r["ID"]: r["idx"] for r in dense_index(df, [F.col("ID")], by=["g"]).collect()}
    assert got == {1: 0, 2: 1, 3: 0}


def test_no_window_over_all_rows(spark, sf):
    """Each window is partitioned, or runs over range or model summaries."""
    from tonemill.queries import QUERIES

    for name in ("sequential_batches", "shuffled_batches", "stratified_folds", "running_best", "batch_accuracy"):
        plan = QUERIES[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
        for line in plan.splitlines():
            if "Window [" in line and "row_number" in line:
                pytest.fail(f"{name}: {line}")


def test_batches_and_samples(spark):
    df = spark.range(1000).select(F.col("id").alias("ID"), (F.col("id") % 10 == 0).cast("int").alias("Label"))
    sizes = Counter(r["batch"] for r in batches.shuffled_batches(df, 64).collect())
    assert sorted(sizes.values()) == [40] + [64] * 15
    picked = Counter(r["Label"] for r in batches.stratified_sample(df, 0.05).collect())
    assert picked == {0: 45, 1: 5}
    uneven = spark.range(399).select(F.col("id").alias("ID"), (F.col("id") < 58).cast("int").alias("Label"))
    picked = Counter(r["Label"] for r in batches.stratified_sample(uneven, 0.05).collect())
    assert picked == {0: 16, 1: 3}
    again = {r["ID"] for r in batches.stratified_sample(df, 0.05).collect()}
    assert again == {r["ID"] for r in batches.stratified_sample(df, 0.05).collect()}


@pytest.mark.parametrize("n", [1, 2, 3, 7, 17, 50, 1000, 4096])
def test_every_epoch_is_a_permutation_of_its_own(spark, n):
    df = spark.range(n).select((F.col("id") * 3).alias("ID")).repartition(3)
    rows = batches.epoch_batches(df, 5, 8).collect()
    orders = {}
    for r in rows:
        orders.setdefault(r.epoch, {})[r.place] = r.ID
        assert r.batch == r.place // 8
    assert set(orders) == set(range(5))
    assert all(sorted(o) == list(range(n)) and sorted(o.values()) == [3 * i for i in range(n)]
               for o in orders.values())
    if n >= 50:
        assert len({tuple(o[i] for i in range(n)) for o in orders.values()}) == 5
        moved = [sum(o[i] == 3 * i for i in range(n)) for o in orders.values()]
        assert max(moved) < 12  # one row in its own place on average
    again = batches.epoch_batches(df.repartition(2), 5, 8).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))


def test_epochs_of_no_rows(spark):
    assert batches.epoch_batches(spark.range(0).withColumnRenamed("id", "ID"), 3).count() == 0


@pytest.mark.parametrize("n", [23, 50, 101])
def test_folds_equal_dealing_by_class(spark, n):
    labels = [random.Random(n).choice((0, 0, 1)) if i else 1 for i in range(n)]
    labels = [random.Random(n * 100 + i).choice((0, 0, 1)) for i in range(n)]
    df = spark.createDataFrame(list(enumerate(labels)), "ID long, Label int")
    order = sorted(set(labels), key=labels.index)
    dealt = sorted(labels, key=order.index)
    want = {}
    for y in order:
        folds = sorted(i % 5 for i, v in enumerate(dealt) if v == y)
        want.update(zip([i for i, v in enumerate(labels) if v == y], folds))
    got = {r["ID"]: r["fold"] for r in batches.stratified_folds(df).collect()}
    assert got == want


def test_running_best_is_strict(spark):
    values = [0.1, 0.5, 0.5, 0.2, 0.6, 0.6]
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(values)], "study int, trial int, value double")
    got = [(r["best_value"], r["best_trial"]) for r in trials.running_best(df).orderBy("trial").collect()]
    assert got == [(0.1, 0), (0.5, 1), (0.5, 1), (0.5, 1), (0.6, 4), (0.6, 4)]


def test_tfidf_golden(spark):
    df = spark.createDataFrame([(0, "good good movie"), (1, "bad movie"), (2, "good day x"), (3, "")], "ID long, t string")
    three = df.filter("ID < 3").withColumn("terms", tfidf.term_array(F.col("t"), [], (1, 1)))
    vocab = {r["term"]: r for r in tfidf.fit_idf(
        tfidf.fit_vocabulary(three, min_df=1), tfidf.row_count(three)).collect()}
    assert {t: r["df"] for t, r in vocab.items()} == {"good": 2, "movie": 2, "bad": 1, "day": 1}
    assert vocab["good"]["tf"] == 3
    assert vocab["good"]["idf"] == pytest.approx(1.287682, abs=1e-6)
    assert vocab["bad"]["idf"] == pytest.approx(1.693147, abs=1e-6)
    every = df.withColumn("terms", tfidf.term_array(F.col("t"), [], (1, 2)))
    fitted = tfidf.fit_tfidf(every, min_df=1)
    norms = {r["ID"]: r["n"] for r in tfidf.weights_long(fitted, every).groupBy("ID").agg(
        F.sum(F.col("weight") ** 2).alias("n")).collect()}
    assert set(norms) == {0, 1, 2} and list(norms.values()) == pytest.approx([1] * 3)
    assert fitted.transform(every).count() == 4


def test_stop_words_go_before_ngrams(spark):
    df = spark.createDataFrame([("cats and dogs",)], "t string")
    assert df.select(tfidf.term_array(F.col("t"), ["and"], (1, 3))).first()[0] == ["cats", "dogs", "cats dogs"]


def test_weights_by_join_equal_the_model(spark, sf):
    from tonemill.queries import corpus

    docs = corpus.documents(spark, sf).withColumn("terms", tfidf.term_array(F.col("Text")))
    vocabulary = tfidf.fit_idf(tfidf.fit_vocabulary(docs), tfidf.row_count(docs))
    joined = tfidf.weights_by_join(vocabulary, docs)
    model = tfidf.weights_long(tfidf.fit_tfidf(docs), docs)
    both = joined.withColumnRenamed("weight", "w").join(model, ["ID", "term"], "full")
    bad = both.filter(F.col("w").isNull() | F.col("weight").isNull() | (F.abs(F.col("w") - F.col("weight")) > 1e-12))
    assert model.count() > 1000 and bad.count() == 0


def test_value_counts_and_positions(spark):
    df = spark.createDataFrame([(["b", "a", "b"],), ([],)], "w array<string>")
    got = [[(x["term"], x["tf"]) for x in r[0]] for r in df.select(tokens.value_counts(F.col("w"))).collect()]
    assert got == [[("a", 1), ("b", 2)], []]
    got = [[(x["value"], x["positions"]) for x in r[0]] for r in df.select(tokens.value_positions(F.col("w"))).collect()]
    assert got == [[("a", [1]), ("b", [0, 2])], []]


def test_mean_pool(spark):
    vecs = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0])], "token string, vector array<float>")
    docs = spark.createDataFrame([(0, "a a b zz"), (1, "zz"), (2, ""), (3, "b a a")], "ID long, Processed string")
    got = {r["ID"]: r["pooled"] for r in vectors.mean_pool(docs, vecs, 2).collect()}
    assert got[0] == pytest.approx([2 / 3, 1 / 3]) and got[3] == pytest.approx([2 / 3, 1 / 3])
    assert got[1] == [0, 0] and got[2] == [0, 0]


def test_mean_pool_by_passes_and_odd_rows(spark, monkeypatch):
    """Any number of passes gives the same means; no row of a join of texts with vectors is made."""
    rng = random.Random(8)
    names = [f"w{i}" for i in range(40)]
    of = {n: [rng.uniform(-1, 1), rng.uniform(-1, 1), 1.0] for n in names[:25]}
    vecs = spark.createDataFrame(list(of.items()) + [("w3", [9.0, 9.0, 9.0])], "token string, vector array<float>")
    texts = [(i, " ".join(rng.choices(names, k=rng.randint(0, 30)))) for i in range(50)]
    texts += [(7, "w1 w2"), (None, "w1"), (None, "w2"), (99, None), (98, "w3 w3")]
    docs = spark.createDataFrame(texts, "ID long, Processed string").repartition(3)
    both = {n: [v] for n, v in of.items()} | {"w3": [of["w3"], [9.0] * 3]}
    want = []
    for i, _ in texts:
        every = [v for j, t in texts if i is not None and j == i for w in (t or "").split() for v in both.get(w, [])]
        want.append((-1 if i is None else i, *([sum(x) / len(every) for x in zip(*every)] if every else [0.0] * 3)))
    for size in (1 << 26, 500):
        monkeypatch.setattr(vectors, "BLOCK_BYTES", size)
        pooled = vectors.mean_pool(docs, vecs, 3)
        assert "Join" not in pooled._jdf.queryExecution().optimizedPlan().toString()
        got = sorted((-1 if r["ID"] is None else r["ID"], *r["pooled"]) for r in pooled.collect())
        for a, b in zip(got, sorted(want), strict=True):
            assert a == pytest.approx(b, abs=1e-6)
    assert [r["pooled"] for r in vectors.mean_pool(docs, vecs.limit(0), 3).collect()] == [[0.0] * 3] * len(texts)


def test_subwords_equal_greedy_matching(spark):
    rng = random.Random(5)
    names = [PAD, UNK, CLS, SEP] + list("abc.") + ["##a", "##b", "ab", "##ab", "abc", "##bca", "##c"[:0] or "##cc"]
    vocab = spark.createDataFrame(list(enumerate(names)), "id int, token string")
    texts = [" ".join("".join(rng.choice("abc") for _ in range(rng.randint(1, 9))) + rng.choice(("", "."))
                      for _ in range(rng.randint(0, 12))) for _ in range(60)]
    texts += ["a" * 101, "a" * 100, "", "d a"]
    df = spark.createDataFrame(list(enumerate(texts)), "ID long, Processed string")
    segmented = subword.subword_tokens(df, vocab)
    got = {r["ID"]: r for r in segmented.collect()}
    assert len(got) == len(texts)
    ids = {t: i for i, t in enumerate(names)}
    for i, text in enumerate(texts):
        words = [w for part in text.split() for w in part.replace(".", " . ").split()]
        want = [p for w in words for p in plain_rules.wordpieces(w, set(names))]
        assert got[i]["pieces"] == " ".join(want)
        assert got[i]["ids"] == [ids[p] for p in want]
    for r in subword.encode_sequences(segmented, vocab, 16).collect():
        n = min(len(got[r["ID"]]["ids"]) + 2, 16)
        assert len(r["input_ids"]) == 16 and sum(r["attention_mask"]) == n
        assert r["input_ids"][0] == 2 and r["input_ids"][n - 1] == 3 and set(r["input_ids"][n:]) <= {0}


def test_subwords_without_a_shuffle(spark, monkeypatch):
    rng = random.Random(6)
    names = [PAD, UNK, CLS, SEP] + list("abcé.") + ["##a", "##b", "ab", "##ab", "abc", "##cc"]
    vocab = spark.createDataFrame(list(enumerate(names)), "id int, token string")
    texts = [" ".join("".join(rng.choices("abcé.", k=rng.randint(1, 7))) for _ in range(rng.randint(0, 15)))
             for _ in range(80)] + ["", " ", "b" * 101, "ab " * 400]
    df = spark.createDataFrame([("xy"[i % 2], i, t) for i, t in enumerate(texts)],
                               "split string, ID long, Processed string").repartition(3)
    want = sorted(map(tuple, subword.subword_tokens_by_join(df, vocab, keys=("split", "ID")).collect()))
    for cached in (1 << 18, 2):
        monkeypatch.setattr(subword, "CACHED_WORDS", cached)
        found = subword.subword_tokens(df, vocab, keys=("split", "ID"))
        assert sorted(map(tuple, found.collect())) == want and len(want) == len(texts)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "Aggregate" not in plan
    monkeypatch.setattr(subword, "BROADCAST_TOKENS", 3)
    assert sorted(map(tuple, subword.subword_tokens(df, vocab, keys=("split", "ID")).collect())) == want
    null = spark.createDataFrame([(1, None)], "ID long, Processed string")
    assert [tuple(r) for r in subword.subword_tokens(null, vocab).collect()] == [(1, [], "")]


def test_scores(spark):
    df = spark.createDataFrame([([0.0, 2.0],), ([5.0, 5.0],), ([800.0, -800.0],)], "z array<double>")
    got = df.select(scores.softmax_score(F.col("z")), scores.argmax_class(F.col("z"))).collect()
    assert got[0][0] == pytest.approx(1 / (1 + math.exp(-2))) and [g[1] for g in got] == [1, 0, 0]
    z = spark.createDataFrame([(0.0,), (1e-9,)], "z double").select(scores.threshold_logit(F.col("z")))
    assert [r[0] for r in z.collect()] == [0, 1]


def test_histogram_of_equal_lengths(spark):
    df = spark.createDataFrame([(1, 7), (1, 7)], "Label int, length int")
    filled = [r for r in profile.length_histogram(df).collect() if r["n"]]
    assert len(filled) == 1 and filled[0]["n"] == 2 and filled[0]["bin_start"] == pytest.approx(7.0)


def test_trie_and_join_give_the_same_pieces(spark):
    rng = random.Random(4)
    tokens = {"".join(rng.choices("abé", k=rng.randint(1, 4))) for _ in range(12)}
    tokens |= {"##" + "".join(rng.choices("abé", k=rng.randint(1, 3))) for _ in range(12)} | {"[UNK]", "#", "##"}
    vocab = spark.createDataFrame([(t, i) for i, t in enumerate(sorted(tokens))], "token string, id int")
    words = {"".join(rng.choices("abé#", (4, 4, 4, 1), k=rng.randint(1, 9))) for _ in range(400)} | {"a" * 120}
    df = spark.createDataFrame([(w,) for w in words], "word string").repartition(3)
    trie = subword.segment_words(df, vocab)
    assert "Generate" not in trie._jdf.queryExecution().optimizedPlan().toString()
    got = sorted(map(tuple, trie.collect()))
    assert got == sorted(map(tuple, subword.segment_by_join(df, vocab).collect()))
    assert len(got) == len(words) and sum(r[2] != "[UNK]" for r in got) > 50


def test_csv_missing_and_quotes(spark, tmp_path):
    (tmp_path / "t.csv").write_text(
        'ID,Text,Label\n1,"a, ""quoted""\nnext",1\n2,NA,0\n3,,1\n4,null,0\n5," x ",1\n')
    got = {r["ID"]: r["Text"] for r in tables.read_labelled_csv(spark, str(tmp_path / "t.csv")).collect()}
    assert got == {1: 'a, "quoted"\nnext', 2: None, 3: None, 4: None, 5: " x "}
    df = tables.read_labelled_csv(spark, str(tmp_path / "t.csv"))
    assert rows.apply_null_policy(df, "drop", ["Text", "Label"]).count() == 2
    literal = rows.apply_null_policy(df, "literal", ["Text"])
    assert literal.filter("Text = 'nan'").count() == 3


def test_word_vector_text_file(spark, tmp_path):
    (tmp_path / "v.txt").write_text("good 0.5 -1\nbad 1e-3 2\n")
    got = {r["token"]: r["vector"] for r in tables.read_word_vectors(spark, str(tmp_path / "v.txt")).collect()}
    assert got["good"] == [0.5, -1.0] and got["bad"] == pytest.approx([0.001, 2.0])


def test_vocabulary_sets(spark):
    docs = spark.createDataFrame([(0, "A b", "a b"), (1, "b c", "b c")], "ID long, Text string, Processed string")
    assert {r[0] for r in profile.distinct_tokens(docs, "Text").collect()} == {"A", "b", "c"}
    effect = profile.cleaning_effect(docs)
    assert [r[0] for r in profile.vocab_removed(effect).collect()] == ["A"]
    assert {r[0] for r in profile.vocab_kept(effect).collect()} == {"b", "c"}
    plan = effect._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Scan") == 1
    vecs = spark.createDataFrame([("b", [1.0])], "token string, vector array<float>")
    rate = {r["variant"]: r["oov_rate"] for r in profile.oov_rate(profile.variant_tokens(docs), vecs).collect()}
    assert rate == pytest.approx({"raw": 2 / 3, "cleaned": 2 / 3})
    exact = {r["variant"]: r["n_tokens"] for r in profile.vocab_size(docs).collect()}
    assert exact == {r["variant"]: r["n_tokens"] for r in profile.vocab_size(docs, approximate=True).collect()}


def test_a_new_file_is_sketched_alone(spark):
    docs = spark.range(6000).select(
        (F.col("id") % 3).alias("file"), F.concat(F.lit("w"), F.col("id") % 4000).alias("Text"),
        F.lit("x").alias("Processed"))
    kept = profile.token_sketches(docs.filter("file < 2"), "file")
    new = profile.token_sketches(docs.filter("file = 2"), "file")
    both = {r.variant: r.n_tokens for r in profile.united_size(kept.union(new)).collect()}
    assert both == {r.variant: r.n_tokens for r in profile.united_size(profile.token_sketches(docs, "file")).collect()}
    assert both["cleaned"] == 1 and abs(both["raw"] / 4000 - 1) < 3 * profile.SKETCH_ERROR
    assert {r.part for r in kept.collect()} == {0, 1} and {r.part for r in new.collect()} == {2}


def test_density_meets_near_points_only(spark):
    rng = np.random.default_rng(3)
    lengths = np.concatenate([rng.integers(1, 40, 300), [5000, 5000, 5001]])
    df = spark.createDataFrame([(1, int(x)) for x in lengths], "Label int, length int")
    got = {r.point: (r.x, r.density) for r in profile.length_density(df).collect()}
    h = lengths.std(ddof=1) * len(lengths) ** -0.2
    x = np.linspace(lengths.min(), lengths.max(), 200)
    want = np.exp(-0.5 * ((x[:, None] - lengths) / h) ** 2).sum(axis=1) / (h * math.sqrt(2 * math.pi))
    want *= (lengths.max() - lengths.min()) / 50
    assert [got[p][0] for p in range(200)] == pytest.approx(x.tolist())
    assert [got[p][1] for p in range(200)] == pytest.approx(want.tolist(), abs=1e-9)
    assert any(d == 0 for _, d in got.values())


def test_one_class_has_no_area_and_leaves_other_models_alone(spark):
    rows = spark.createDataFrame(
        [("a", "s", 1, 1, 1, .9), ("a", "s", 2, 0, 0, .2), ("b", "s", 3, 1, 1, .5)],
        "model string, split string, ID long, label int, prediction int, score double")
    assert {r.model: r.auc for r in metrics.roc_auc(rows).collect()} == {"a": 1.0, "b": None}
    assert metrics.roc_points(rows).filter("model = 'b'").count() == 2


def test_density_leaves_out_groups_without_spread(spark):
    rows_ = [(0, 5), (1, 7), (1, 7), (1, 7), (2, 3), (2, 9), (2, 4)]
    df = spark.createDataFrame(rows_, "Label int, length int")
    got = profile.length_density(df).collect()
    assert {r["Label"] for r in got} == {2} and all(r["density"] >= 0 for r in got)


def test_empty_vocabulary_keeps_rows(spark):
    df = spark.createDataFrame([(0, ["a"]), (1, [])], "ID long, terms array<string>")
    fitted = tfidf.fit_tfidf(df, min_df=5)
    assert [len(r["features"]) for r in fitted.transform(df).collect()] == [0, 0]
    assert tfidf.weights_long(fitted, df).count() == 0
    assert tfidf.top_ngrams(df.filter("ID > 5")).count() == 0


def test_weights_without_a_bound_equal_the_bounded_form(spark):
    df = spark.createDataFrame([(0, ["a", "b", "a"]), (1, ["b"]), (2, [])], "ID long, terms array<string>")
    want = {(r["ID"], r["term"]): r["weight"] for r in tfidf.weights(df, df, min_df=1).collect()}
    got = {(r["ID"], r["term"]): r["weight"] for r in tfidf.weights(df, df, min_df=1, max_features=None).collect()}
    assert len(got) == 3 and got == pytest.approx(want)


def test_no_draws_give_an_empty_search(spark):
    from tonemill.models.search import search_params

    assert search_params(spark, {"x": ("int", 1, 2)}, 0, 1, lambda p: 0.0).count() == 0


def test_cleaning_needs_no_shuffle(spark, sf):
    from tonemill.queries import QUERIES

    for name in ("clean_frequency", "clean_embedding", "clean_contextual", "ws_tokens", "word_tokens", "char_length"):
        plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan, name


@pytest.mark.parametrize("lo, hi, most", [(1, 3, 7), (1, 3, 40), (1, 2, 1), (2, 4, 15), (1, 1, 5), (1, 3, 100_000), (1, 3, 0)])
def test_vocabulary_of_words_is_that_of_their_ngrams(spark, lo, hi, most):
    """Also where a bucket holds many n-grams."""
    rng = np.random.default_rng(most)
    lists = [None, [], ["\u00e9t\u00e9"], ["a", "a", "a", "a"]] + [
        [f"w{int(x)}" for x in rng.zipf(1.3, rng.integers(0, 40)) % 50] for _ in range(120)]
    df = spark.createDataFrame([(x,) for x in lists], "terms array<string>").repartition(3)
    want = tfidf.fit_vocabulary(tfidf.with_ngrams(df, "terms", (lo, hi)), max_features=most).collect()
    got = tfidf.fit_vocabulary(df, max_features=most, ngram_range=(lo, hi)).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want]
    crowded = frequent.candidates(df, "terms", lo, hi, 2, most, buckets=8).filter("df >= 2")
    got = crowded.orderBy(F.desc("tf"), "term").limit(most).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want]


def test_rare_ngrams_are_not_counted_as_strings(spark):
    lists = [[f"f{j}" for j in range(5)] * 3 + [f"r{i}_{j}" for j in range(5)] for i in range(30)]
    df = spark.createDataFrame([(x,) for x in lists], "terms array<string>")
    found = {r["term"]: (r["tf"], r["df"]) for r in frequent.candidates(df, "terms", 1, 2, 2, 5).collect()}
    longer = {t: c for t, c in found.items() if " " in t}
    assert longer["f0 f1"] == (90, 30) and not any(t.startswith("r") for t in longer)


def test_sketches_and_exact_number_come_from_one_scan(spark, tmp_path, monkeypatch):
    """Also of a row without a source or an ID; texts are neither cleaned twice nor shuffled."""
    rows_ = [(1, "a", "One two http://x"), (2, "a", "two @me three"), (2, "b", "four  FOUR"), (None, "b", "five"),
             (5, None, "six"), (6, "c", None)]
    spark.createDataFrame(rows_, "doc_id long, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    seen, written = [], profiling.materialize
    monkeypatch.setattr(profiling, "materialize", lambda df, name: seen.append((name, df)) or written(df, name))
    got = {r["variant"]: r for r in profiling.vocab_size_sketch(spark, str(tmp_path)).collect()}
    raw = {t for _, _, x in rows_ if x for t in x.split()}
    assert got["raw"]["n_exact"] == len(raw) == 9 and got["raw"]["parts"] == got["cleaned"]["parts"] == 2
    assert all(r["within_error"] for r in got.values())
    plan = dict(seen)["tokens"]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and "Join" not in plan
