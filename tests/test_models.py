"""Fitted models against their defining equations and planted data."""

from __future__ import annotations

import math
import threading

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tonemill.models import logistic, mlp, scoring, search
from tonemill.operators import batches, metrics, tfidf
from tonemill.sources import tables


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(120, 3)) * [1.0, 3.0, 0.5]
    y = (x @ [1.0, -0.7, 2.0] + rng.normal(size=120) > 0.3).astype(int)
    rows = [(i, Vectors.dense(v), int(t)) for i, (v, t) in enumerate(zip(x, y))]
    return x, y, spark.createDataFrame(rows, ["ID", "features", "label"]).persist()


def test_logistic_gradient_is_zero(points):
    x, y, df = points
    model = logistic.fit_logistic(df, c=2.0, tol=1e-10)
    w, b = model.coefficients.toArray(), model.intercept
    residual = 1 / (1 + np.exp(-(x @ w + b))) - y
    assert np.abs(2.0 * x.T @ residual + w).max() < 1e-3
    assert abs(residual.sum()) < 1e-3


def test_text_model_roundtrip_and_submission(spark, tmp_path):
    texts = [(i, ("good fine day" if i % 2 else "bad awful night") + f" w{i % 5}", i % 2) for i in range(60)]
    df = spark.createDataFrame(texts, "ID long, Text string, label int").withColumn(
        "terms", tfidf.term_array(F.col("Text")))
    features = tfidf.fit_tfidf(df).model()
    model = logistic.with_features(features, logistic.fit_logistic(features.transform(df)))
    scored = logistic.predict(model, df, ("ID", "label"))
    assert metrics.binary_metrics(scored).first()["accuracy"] == 1.0
    logistic.save_model(model, str(tmp_path / "model"))
    again = logistic.predict(logistic.load_model(str(tmp_path / "model")), df)
    assert again.orderBy("ID").select("score").collect() == scored.orderBy("ID").select("score").collect()
    tables.write_predictions(scored.select("ID", F.col("prediction").alias("Label")),
                             str(tmp_path / "out"), single_file=True)
    assert len(list((tmp_path / "out").glob("part-*"))) == 1
    assert tables.read_predictions(spark, str(tmp_path / "out")).filter("Label = ID % 2").count() == 60


def test_mlp_learns_planted_classes(points):
    x, _, df = points
    easy = df.withColumn("label", (F.col("ID") % 2).cast("int")).drop("features")
    rows = [(i, Vectors.dense([i % 2, 1 - i % 2, 0.5])) for i in range(120)]
    easy = easy.join(df.sparkSession.createDataFrame(rows, ["ID", "features"]), "ID")
    model = mlp.fit_mlp(easy, 3, [8, 4], max_iter=60)
    assert metrics.binary_metrics(logistic.predict(model, easy, ("ID", "label"))).first()["accuracy"] == 1.0


def test_score_batches(spark):
    df = spark.range(200).select(F.col("id").alias("ID"), F.col("id").cast("double").alias("a"))

    def load():
        def predict(a):
            assert len(a) <= 64
            return np.stack([-a, a], axis=1)
        return predict

    got = scoring.score_batches(df, load, ["a"]).collect()
    assert len(got) == 200 and all(list(r["logits"]) == [-r["a"], r["a"]] for r in got)


def test_saved_weights_score_in_padded_batches(spark, tmp_path):
    rng = np.random.default_rng(6)
    w, rows = rng.normal(size=50), []
    for i in range(500):
        at = np.sort(rng.choice(50, rng.integers(0, 30), replace=False))
        rows.append((i, at.tolist(), rng.normal(size=len(at)).tolist()))
    df = spark.createDataFrame(rows, "ID long, indices array<int>, values array<double>").repartition(3)
    scoring.save_weights(spark, w, 0.5, str(tmp_path / "m"))
    loaded, bias = scoring.load_weights(spark, str(tmp_path / "m"))
    assert (loaded == w).all() and bias == 0.5
    scored = scoring.score_padded(df, str(tmp_path / "m"), batch_size=16)
    got = {r.ID: r for r in scored.collect()}
    padding = 0
    for i, at, x in rows:
        z = w[at] @ np.array(x) + 0.5 if at else 0.5
        assert got[i].logits == pytest.approx([-z / 2, z / 2]) and got[i].width >= len(at)
        padding += got[i].width - len(at)
    assert padding <= 16 * 29 * scored.rdd.getNumPartitions() and padding < 0.3 * sum(len(r[1]) for r in rows)
    assert scoring.score_padded(df.limit(0), str(tmp_path / "m")).count() == 0


def test_search_draws(spark):
    space = {"H1": ("int", 400, 512), "H2": ("int", 128, lambda p: min(p["H1"], 256)),
             "lr": ("log", 2e-4, 8e-4), "drop": ("float", 0.1, 0.3)}
    draws = search.sample_params(space, 50, 10)
    assert draws == search.sample_params(space, 50, 10) != search.sample_params(space, 50, 11)
    assert all(400 <= d["H1"] <= 512 and 128 <= d["H2"] <= 256 and 2e-4 <= d["lr"] <= 8e-4 for d in draws)
    found = search.search_params(spark, space, 5, 10, lambda p: -p["lr"])
    assert [r["value"] for r in found.orderBy("trial").collect()] == [-d["lr"] for d in draws[:5]]


def test_halving_finds_a_planted_best(spark):
    """Values rise with steps; a draw's final value is known, and early values keep the order."""
    space = {"a": ("int", 0, 10_000)}
    draws = [d["a"] for d in search.sample_params(space, 27, 3)]
    seen = []

    def train(params, steps, state):
        done = (state or 0) + steps
        seen.append((params["a"], state, steps))
        return params["a"] * (1 - 0.5 ** done), done

    rows = search.successive_halving(spark, space, 27, 3, train, (2, 4, 8), 3).collect()
    assert [sum(r.rung == k for r in rows) for k in range(3)] == [27, 9, 3]
    winner = [r for r in rows if r.winner]
    assert len(winner) == 1 and winner[0].params["a"] == max(draws) and winner[0].rung == 2
    best = sorted(range(27), key=lambda i: (-draws[i], i))
    assert {r.trial for r in rows if r.rung == 1} == set(best[:9])
    assert {r.trial for r in rows if r.rung == 0 and r.goes_on} == set(best[:9])
    assert sorted({s for _, s, n in seen if n == 8}) == [6]  # goes on from where it was


def test_net_goes_on_from_its_weights(points):
    _, _, df = points
    half = mlp.fit_mlp(df, 3, [4], max_iter=5)
    on = mlp.fit_mlp(df, 3, [4], max_iter=1, start=half.weights)
    fresh = mlp.fit_mlp(df, 3, [4], max_iter=1)
    far = [np.abs(m.weights.toArray() - half.weights.toArray()).max() for m in (on, fresh)]
    assert far[0] < far[1]


def test_balanced_rows_have_exact_quotas(spark):
    df = spark.range(110).select(F.col("id").alias("ID"), F.when(F.col("id") < 100, 1).when(
        F.col("id") < 107, 0).otherwise(None).cast("int").alias("label"), F.lit("x").alias("idx_"))
    got = batches.balanced_rows(df, label="label")
    assert got.columns == df.columns
    copies = {}
    for r in got.collect():
        copies[r.label, r.ID] = copies.get((r.label, r.ID), 0) + 1
    assert sorted(v for (c, _), v in copies.items() if c == 0) == [14] * 5 + [15] * 2
    assert all(v == 1 for (c, _), v in copies.items() if c != 0) and len(copies) == 110
    assert batches.balanced_rows(df.limit(0), label="label").count() == 0


def test_balanced_net_finds_a_rare_class(spark):
    rows = [(i, Vectors.dense([float(i % 20 == 0) + 0.1 * math.sin(i), math.cos(i)]), int(i % 20 > 0))
            for i in range(400)]
    df = spark.createDataFrame(rows, ["ID", "features", "label"])
    model = mlp.fit_balanced(df, 2, hidden=[6], max_iter=80)
    assert metrics.binary_metrics(logistic.predict(model, df, ("ID", "label"))).first()["accuracy"] == 1.0


def test_copies_of_a_rare_class_are_dealt_evenly(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(mlp, "fit_mlp", lambda train, *args, **settings: seen.append(train))
    df = spark.range(4000).select(F.col("id").alias("ID"), (F.col("id") % 20 > 0).cast("int").alias("label"), F.lit("x").alias("features"))
    mlp.fit_balanced(df, 2)
    parts = [r["n"] for r in seen[0].groupBy(F.spark_partition_id().alias("part")).agg(F.count("*").alias("n")).collect()]
    assert len(parts) == spark.sparkContext.defaultParallelism and sum(parts) == 7600
    assert max(parts) < 1.1 * min(parts)
    assert sorted(r["n"] for r in seen[0].filter("label = 0").groupBy("ID").agg(F.count("*").alias("n")).collect()) == [19] * 200


def test_learning_curve_follows_from_stored_coefficients(spark, points):
    x, y, df = points
    folds = batches.stratified_folds(df.select("ID", "label"), k=3, label="label").select("ID", "fold")
    fits = search.curve_fits(df, folds, 2.0, k=3, steps=4).collect()
    first = folds.filter("fold <> 0").count()
    assert sorted({f.n_train for f in fits}) == [math.floor(first * i / 4) for i in range(1, 5)]
    fold = {r.ID: r.fold for r in folds.collect()}
    shares = {}
    for f in fits:
        z = x @ np.array(f.coefficients) + f.intercept
        right = (z > 0) == (y == 1)
        test = [i for i in range(120) if fold[i] == f.held_out]
        train = [i for i in range(120) if fold[i] != f.held_out][:f.n_train]
        assert (f.test_rows, f.test_hits) == (len(test), right[test].sum())
        assert (f.train_rows, f.train_hits) == (len(train), right[train].sum())
        shares.setdefault(f.n_train, []).append((right[train].mean(), right[test].mean()))
    curve = search.learning_curve(spark.createDataFrame(fits)).orderBy("n_train").collect()
    for r in curve:
        train, test = zip(*shares[r.n_train])
        assert (r.train_mean, r.train_std, r.test_mean, r.test_std) == pytest.approx(
            (np.mean(train), np.std(train), np.mean(test), np.std(test)))
        assert r.fits == 3 and r.held_out_rows == 120 and r.test_mean > 0.5
    assert search.curve_fits(df.limit(0), folds.limit(0), 2.0, k=3, steps=4).count() == 0


def test_learning_curve_recounted_by_joins_and_prefixes_of_one_class(spark):
    rows = spark.createDataFrame(
        [(i, Vectors.sparse(3, [(i % 3, 1.0 + i % 2)]) if i % 7 else Vectors.sparse(3, []),
          int(i >= 12 and i % 4 > 0)) for i in range(60)], ["ID", "features", "label"])
    folds = rows.select("ID", (F.col("ID") % 3).cast("int").alias("fold"))
    fits = search.curve_fits(rows, folds, 2.0, k=3, steps=5)
    few = fits.filter("n_train = 8").collect()  # the first rows have one class
    assert len(few) == 3 and all(f.intercept < -5 and max(map(abs, f.coefficients)) < 0.1 for f in few)
    assert all(f.train_hits == 8 for f in few)
    # Fits of a size are one fit, and yet each is that of its own rows.
    mine = fits.filter("n_train = 40 AND held_out = 1").first()
    alone = logistic.fit_logistic(rows.join(folds, "ID").filter("fold <> 1"), c=2.0, tol=1e-9)
    assert alone.intercept == pytest.approx(mine.intercept, abs=2e-2)
    assert alone.coefficients.toArray() == pytest.approx(mine.coefficients, abs=2e-2)
    want = {(f.n_train, f.held_out): (f.test_rows, f.test_hits) for f in fits.collect()}
    got = {(r.n_train, r.held_out): (r.test_rows, r.test_hits)
           for r in search.recounted(fits, rows, folds).collect()}
    assert got == want


def test_curve_fits_of_rare_and_frequent_terms_reach_their_optimum(spark):
    """Features as TF-IDF has them; the gradient is taken anew from the coefficients."""
    rng = np.random.default_rng(5)
    x = (rng.random((150, 60)) < 0.9 / np.arange(1, 61)) * rng.random((150, 60))
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    y = (x[:, :8].sum(axis=1) + 0.3 * rng.standard_normal(150) > 0.8).astype(int)
    rows = spark.createDataFrame([(i, Vectors.sparse(60, {int(j): float(r[j]) for j in np.nonzero(r)[0]}), int(y[i]))
                                  for i, r in enumerate(x)], ["ID", "features", "label"])
    folds = rows.select("ID", (F.col("ID") % 3).cast("int").alias("fold"))
    fits = search.curve_fits(rows, folds, 2.0, k=3, steps=3).collect()
    assert len(fits) == 9 and all(f.iterations < 100 for f in fits)
    for f in fits:
        train = [i for i in range(150) if i % 3 != f.held_out][:f.n_train]
        w = np.array(f.coefficients)
        z = x[train] @ w + f.intercept
        miss = 1 / (1 + np.exp(-z)) - y[train]
        g, free = 2.0 * x[train].T @ miss + w, 2.0 * miss.sum()
        value = 2.0 * (np.logaddexp(0, z) - y[train] * z).sum() + w @ w / 2
        assert (g @ g + free**2) / 2 / value < 1e-6
        assert f.missed == pytest.approx((g @ g + free**2) / 2 / value, rel=1e-3, abs=1e-12)
    # A search broken off is told from one that has ended.
    assert min(f.missed for f in search.curve_fits(rows, folds, 2.0, k=3, steps=3, max_iter=2).collect()) > 1e-4


def test_rows_of_a_curve_are_written_once_and_few_fits_hold_theirs(spark, monkeypatch):
    """No copy for each fold; fits side by side stay within a number of bytes, a larger one runs alone."""
    rows = spark.createDataFrame([(i, Vectors.sparse(2, {i % 2: 1.0, 1 - i % 2: 0.5}), int(i % 3 > 0)) for i in range(60)],
                                 ["ID", "features", "label"])
    folds = rows.select("ID", (F.col("ID") % 3).cast("int").alias("fold"))
    written, running, seen, lock = [], [], [], threading.Lock()
    write, fit = search.materialize, search.fit_logistic

    def counted(df, name):
        written.append(df.count())
        return write(df, name)

    def watched(train, c, max_iter, tol, n, *args):
        with lock:
            running.append(n)
            seen.append(list(running))
        model = fit(train, c, max_iter, tol, n, *args)
        with lock:
            running.remove(n)
        return model

    monkeypatch.setattr(search, "materialize", counted)
    monkeypatch.setattr(search, "fit_logistic", watched)
    monkeypatch.setattr(search, "HELD_BYTES", 30 * 2 * search.ENTRY_BYTES)
    fits = search.curve_fits(rows, folds, 2.0, k=3, steps=4).collect()
    assert written == [60] and len(fits) == len(seen) == 12
    assert all(sum(ns) <= 30 or len(ns) == 1 for ns in seen)
    assert [max(ns) for ns in seen if max(ns) > 15] == [20] * 3 + [30] * 3 + [40] * 3
    assert [[f.n_train, f.train_rows, f.test_rows] for f in fits] == [[n, n, 20] for n in (10, 20, 30, 40) for _ in range(3)]


def test_a_curve_without_features_or_training_rows(spark):
    rows = spark.createDataFrame([(i, Vectors.dense([]), int(i % 4 > 0)) for i in range(9)], ["ID", "features", "label"])
    folds = rows.select("ID", (F.col("ID") % 3).cast("int").alias("fold"))
    for f in search.curve_fits(rows, folds, 2.0, k=3, steps=3).collect():
        ones = [int(i % 4 > 0) for i in [j for j in range(9) if j % 3 != f.held_out][:f.n_train]]
        assert f.coefficients == [] and f.train_rows == len(ones) and f.missed < 1e-6
        assert f.train_hits == max(sum(ones), len(ones) - sum(ones))
    alone = search.curve_fits(rows.limit(1), folds, 2.0, k=3, steps=3).collect()
    assert sorted((f.held_out, f.train_rows, f.train_hits, f.test_rows) for f in alone) == [(0, 0, 0, 1), (1, 1, 1, 0), (2, 1, 1, 0)]


def test_evened_fit_has_the_same_optimum_in_fewer_steps(spark):
    rng = np.random.default_rng(6)
    x = (rng.random((200, 80)) < 0.9 / np.arange(1, 81)) * rng.random((200, 80))
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    y = (x[:, :8].sum(axis=1) + 0.3 * rng.standard_normal(200) > 0.8).astype(int)
    df = spark.createDataFrame([(Vectors.sparse(80, {int(j): float(r[j]) for j in np.nonzero(r)[0]}), int(c))
                                for r, c in zip(x, y)], ["features", "label"])
    plain, even = logistic.fit_logistic(df, tol=1e-9), logistic.fit_logistic(df, even=80)
    assert even.summary.totalIterations < plain.summary.totalIterations / 2
    assert logistic.excess(even, df) < 1e-6
    assert even.intercept == pytest.approx(plain.intercept, abs=1e-2)
    assert even.coefficients.toArray() == pytest.approx(plain.coefficients.toArray(), abs=1e-2)
    one = logistic.fit_logistic(df.filter("label = 1"), even=80)
    assert one.intercept == math.inf and not one.coefficients.toArray().any()


def test_tasks_of_a_fit_do_not_grow_with_the_rows(spark, monkeypatch):
    """What a step sends is a gradient per task."""
    seen = []

    class Estimator:
        def fit(self, rows):
            seen.append(rows.rdd.getNumPartitions())

    monkeypatch.setattr(logistic, "logistic_estimator", lambda *args: Estimator())
    rows = spark.range(0, 10, 1, 40).select(F.array("id").alias("features"), F.lit(0).alias("label"))
    for n, tasks in ((10, None), (10**7, None), (10**7, 5)):
        logistic.fit_logistic(rows, n_rows=n, tasks=tasks)
    assert seen == [1, spark.sparkContext.defaultParallelism, 5]


def test_recount_leaves_entries_where_they_lie(spark):
    """Also of rows without entries; the coefficients come to the rows."""
    rows = spark.createDataFrame([(i, Vectors.sparse(2, {i % 2: 1.0} if i % 3 else {}), i % 2) for i in range(12)],
                                 ["ID", "features", "label"])
    folds = rows.select("ID", (F.col("ID") % 2).cast("int").alias("fold"))
    fits = spark.createDataFrame([(n, f, 0.5 - n, [-1.0, 3.0 * n]) for n in (1, 2) for f in (0, 1)],
                                 "n_train long, held_out int, intercept double, coefficients array<double>")
    found = search.recounted(fits, rows, folds)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("strategy=broadcast") == 2
    want = {(n, f): (6, sum((0.5 - n + ([-1.0, 3.0 * n][i % 2] if i % 3 else 0) > 0) == (i % 2 == 1)
                            for i in range(f, 12, 2))) for n in (1, 2) for f in (0, 1)}
    assert {(r.n_train, r.held_out): (r.test_rows, r.test_hits) for r in found.collect()} == want


def test_excess_tells_a_fit_from_a_poor_one(points):
    x, y, df = points
    good, poor = (logistic.fit_logistic(df, c=2.0, tol=t, max_iter=m) for t, m in ((1e-12, 500), (1e-6, 1)))
    assert logistic.excess(good, df, c=2.0) < 1e-6 < 1e-2 < logistic.excess(poor, df, c=2.0)
    w, b = poor.coefficients.toArray(), poor.intercept
    z = x @ w + b
    g = 2.0 * x.T @ (1 / (1 + np.exp(-z)) - y) + w
    free = 2.0 * (1 / (1 + np.exp(-z)) - y).sum()
    value = 2.0 * (np.logaddexp(0, z) - y * z).sum() + w @ w / 2
    assert logistic.excess(poor, df, c=2.0) == pytest.approx((g @ g + free**2) / 2 / value)
    assert logistic.excess(good, df.limit(0), c=2.0) == 0


def test_draws_change_the_net(points):
    _, _, df = points
    base = {"H1": 6, "H2": 5, "H3": 4}
    sizes = {len(mlp.fit_mlp(df, 3, list(p.values()), max_iter=2).weights)
             for p in [base, *({**base, k: v + 1} for k, v in base.items())]}
    assert len(sizes) == 4
