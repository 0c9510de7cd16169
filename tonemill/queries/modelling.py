"""Fitted models. Their numbers depend on an optimizer, so the queries give what must hold of any
right fit, which SQL can say: rows, draws, and whether a fit meets its defining equations.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tonemill.constants import CURVE_STEPS, FOLDS, LOGISTIC_C, MLP_HIDDEN, SEED, TFIDF_NGRAMS
from tonemill.functions import scores
from tonemill.models import logistic, mlp, scoring, search
from tonemill.operators import batches, metrics, tfidf, vectors
from tonemill.operators.rows import attach_predictions, clean
from tonemill.plans.materialize import materialize, new_path
from tonemill.queries import corpus, sql
from tonemill.queries.registry import query

# The space and the number of trials of one published study, whose dropout and
# learning rate have no counterpart in this net and its solver.
SEARCH_SPACE = {
    "H1": ("int", 400, 512),
    "H2": ("int", 128, lambda p: min(p["H1"], 256)),
    "H3": ("int", 32, lambda p: min(p["H2"], 96)),
}
SEARCH_TRIALS = 18
#: Steps of each rung, and the share of draws that goes on: 18, 6 and 2 nets.
SEARCH_RUNGS, SEARCH_KEEP = (5, 10, 20), 3

#: Share of the objective that a fit may miss, and still be called optimal.
OPTIMAL = 1e-4

_ROWS = f"SELECT {sql.SPLIT_OF} AS split, d.doc_id AS ID, l.quality AS label FROM documents d JOIN labels l ON d.doc_id = l.doc_id"


def _word_rows(spark, sf):
    """Labelled rows with split and words, cleaned once for all passes that follow."""
    def write(path):
        clean(corpus.labelled(spark, sf), "frequency").select(
            "ID", corpus.split_of().alias("split"), F.col("Label").alias("label"),
            tfidf.word_array(F.col("Processed")).alias("terms")).write.parquet(path)

    schema = "ID long, split string, label int, terms array<string>"
    return spark.read.schema(schema).parquet(corpus.once(spark, sf, "words", write))


def _term_rows(spark, sf):
    """The same with n-grams, which are made where they are read."""
    return tfidf.with_ngrams(_word_rows(spark, sf))


def _fitted(spark, sf):
    """Term rows and the saved model, fitted once per session."""
    def write(path):
        words = _word_rows(spark, sf).filter("split = 'train'")
        fitted = tfidf.fit_tfidf(words, ngram_range=TFIDF_NGRAMS)
        features = fitted.model()
        model = logistic.fit_logistic(materialize(
            features.transform(tfidf.with_ngrams(words)).select("features", "label"), "features"),
            even=len(fitted.terms))
        logistic.save_model(logistic.with_features(features, model), path)

    path = corpus.once(spark, sf, "logistic", write)
    return _term_rows(spark, sf), logistic.load_model(path)


@query("lr_fit", f"SELECT split, count(*) AS n, TRUE AS at_optimum FROM ({_ROWS}) GROUP BY split")
def lr_fit(spark, sf):
    """Rows of each split that the model scores, and whether the fit reached its optimum."""
    rows, model = _fitted(spark, sf)
    train = PipelineModel(model.stages[:-1]).transform(rows.filter("split = 'train'"))
    missed = logistic.excess(model.stages[-1], train)
    scored = logistic.predict(model, rows, ("split", "ID", "label"))
    return metrics.binary_metrics(scored, ["split"]).select(
        "split", "n", F.lit(missed <= OPTIMAL).alias("at_optimum"))


@query("lr_predict", f"SELECT split, ID, TRUE AS by_score FROM ({_ROWS})")
def lr_predict(spark, sf):
    """Every row with its label, which must be 1 just where the score is over a half."""
    rows, model = _fitted(spark, sf)
    return logistic.predict(model, rows, ("split", "ID")).select(
        "split", "ID", (F.col("prediction") == (F.col("score") > 0.5).cast("int")).alias("by_score"))


@query("lr_score", f"SELECT split, ID, label, TRUE AS by_weights FROM ({_ROWS})")
def lr_score(spark, sf):
    """Every row with its score, which must follow from weights joined with coefficients by term."""
    rows, model = _fitted(spark, sf)
    counter, weigh, _, fitted = model.stages
    table = spark.createDataFrame(
        [(t, float(i), float(c)) for t, i, c in zip(
            counter.vocabulary, weigh.getScalingVec(), fitted.coefficients.toArray())],
        "term string, idf double, coefficient double")
    entries = tfidf.weights_by_join(table, rows).join(table, "term")
    margins = entries.groupBy("ID").agg(F.sum(F.col("weight") * F.col("coefficient")).alias("z"))
    margin = F.coalesce("z", F.lit(0.0)) + fitted.intercept
    scored = logistic.predict(model, rows, ("split", "ID", "label"))
    return scored.join(margins, "ID", "left").select(
        "split", "ID", "label",
        (F.abs(F.col("score") - 1 / (1 + F.exp(-margin))) <= 1e-9).alias("by_weights"))


@query("save_model", f"SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_changed FROM ({_ROWS})")
def save_model(spark, sf):
    """Rows whose score changes when the model is saved and loaded again, with all rows."""
    rows, model = _fitted(spark, sf)
    path = new_path(spark, "model")
    logistic.save_model(model, path)
    before = logistic.predict(model, rows).select("ID", F.col("score").alias("before"))
    after = logistic.predict(logistic.load_model(path), rows).select("ID", "score")
    return attach_predictions(before, after).agg(
        F.count("*").alias("n_rows"),
        F.sum((F.col("before") != F.col("score")).cast("long")).alias("n_changed"))


def _pooled(spark, sf):
    dim = corpus.vector_dim(spark, sf)
    texts = clean(corpus.labelled(spark, sf), "embedding")
    pooled = vectors.mean_pool(texts, corpus.word_vectors(spark, sf), dim)
    rows = pooled.join(corpus.labels(spark, sf), "ID").select(
        "ID", corpus.split_of().alias("split"), F.col("Label").alias("label"),
        array_to_vector("pooled").alias("features"))
    return materialize(rows, "pooled"), dim


@query("mlp_fit", f"""
SELECT split, count(*) AS n, TRUE AS sums_to_one, TRUE AS learns FROM ({_ROWS}) GROUP BY split""")
def mlp_fit(spark, sf):
    """Rows of each split, whether class probabilities sum to 1, and whether the net tells the classes
    of its training rows apart: it recalls over half of either, which no constant answer does."""
    rows, dim = _pooled(spark, sf)
    model = mlp.fit_balanced(rows.filter("split = 'train'"), dim, hidden=MLP_HIDDEN)
    total = F.aggregate(vector_to_array("probability"), F.lit(0.0), lambda a, p: a + p)
    recall = [F.avg(F.when(F.col("label") == c, (F.col("prediction") == c).cast("int"))) for c in (0, 1)]
    return model.transform(rows).groupBy("split").agg(
        F.count("*").alias("n"), F.bool_and(F.abs(total - 1) < 1e-9).alias("sums_to_one"),
        ((F.col("split") != "train") | (F.least(*recall) > 0.5)).alias("learns"))


def _draw(name: str, low: str, high: str) -> str:
    digits = f"substr(md5('{SEED}:' || t || ':{name}'), 1, 8)"
    return f"CAST({low} + floor(CAST('0x' || {digits} AS BIGINT) / 4294967296.0::DOUBLE * ({high} - {low} + 1)) AS BIGINT)"


@query("param_search", f"""
WITH a AS (SELECT range AS trial, CAST(range AS VARCHAR) AS t FROM range({SEARCH_TRIALS})),
b AS (SELECT trial, t, {_draw('H1', '400', '512')} AS H1 FROM a),
c AS (SELECT *, {_draw('H2', '128', 'least(H1, 256)')} AS H2 FROM b)
SELECT CAST(trial AS INTEGER) AS trial, H1, H2, {_draw('H3', '32', 'least(H2, 96)')} AS H3,
       CAST({SEARCH_TRIALS} AS BIGINT) AS first_rung, CAST({SEARCH_TRIALS} // {SEARCH_KEEP} AS BIGINT) AS second_rung,
       CAST({SEARCH_TRIALS} // {SEARCH_KEEP} // {SEARCH_KEEP} AS BIGINT) AS last_rung,
       CAST(1 AS BIGINT) AS winners, TRUE AS best_went_on FROM c""")
def param_search(spark, sf):
    """The draws, how many reached each rung, and whether just the best of each rung went on.

    The last is found by ranking the values of each rung anew; it is false for a search that lets
    a worse draw go on than one it drops, or names a winner that another one beats."""
    rows, dim = _pooled(spark, sf)
    train = materialize(mlp.dealt(batches.balanced_rows(rows.filter("split = 'train'"), label="label")), "train")
    val = rows.filter("split = 'val'")

    def accuracy(params, steps, state):
        model = mlp.fit_mlp(train, dim, [params["H1"], params["H2"], params["H3"]], steps, start=state)
        return metrics.binary_metrics(
            logistic.predict(model, val, ("ID", "label"))).first()["accuracy"], model.weights

    found = search.successive_halving(
        spark, SEARCH_SPACE, SEARCH_TRIALS, SEED, accuracy, SEARCH_RUNGS, SEARCH_KEEP)
    ranked = found.withColumn("rank", F.row_number().over(
        Window.partitionBy("rung").orderBy(F.desc("value"), "trial"))).withColumn(
        "size", F.count("*").over(Window.partitionBy("rung")))
    last = F.col("rung") == len(SEARCH_RUNGS) - 1
    chosen = F.col("rank") <= F.when(last, 1).otherwise(F.floor(F.col("size") / SEARCH_KEEP))
    sound = ranked.agg(
        *[F.count_if(F.col("rung") == r).alias(name) for r, name in enumerate(
            ("first_rung", "second_rung", "last_rung"))],
        F.count_if("winner").alias("winners"),
        F.bool_and((F.col("goes_on") | F.col("winner")) == chosen).alias("best_went_on"))
    names = [F.element_at("params", F.lit(name)).cast("long").alias(name) for name in SEARCH_SPACE]
    # One row of counts beside the draws.
    return found.filter("rung = 0").select("trial", *names, *[
        sound.select(c).scalar().alias(c) for c in sound.columns])


@query("learning_curve", f"""
WITH r AS (SELECT count(*) AS n FROM ({_ROWS})),
s AS (SELECT n, greatest((n - (n + {FOLDS - 1}) // {FOLDS}) * i // {CURVE_STEPS}, 1) AS n_train
      FROM r, range(1, {CURVE_STEPS + 1}) t(i))
SELECT DISTINCT n_train, CAST({FOLDS} AS BIGINT) AS fits, n AS held_out_rows, TRUE AS is_share,
       TRUE AS by_weights, TRUE AS at_optimum FROM s""")
def learning_curve(spark, sf):
    """Sizes, fits and held-out rows; whether means and deviations are those of shares, whether
    the held-out accuracy follows from the coefficients that each fit stored, and whether all fits of the
    size reached their optimum."""
    rows = _term_rows(spark, sf)
    folds = batches.stratified_folds(rows.select("ID", "label"), label="label").drop("label")
    features = materialize(
        tfidf.fit_tfidf(_word_rows(spark, sf), ngram_range=TFIDF_NGRAMS).transform(rows).select(
            "ID", "features", "label"), "features")
    folds = materialize(folds, "folds")
    fits = materialize(search.curve_fits(features, folds, LOGISTIC_C), "fits")
    again = search.recounted(fits, features, folds).groupBy("n_train").agg(
        F.avg(F.col("test_hits") / F.col("test_rows")).alias("again"))
    share = (F.col("test_mean").between(0, 1) & F.col("train_mean").between(0, 1)
             & F.col("test_std").between(0, 0.5) & F.col("train_std").between(0, 0.5))
    return search.learning_curve(fits).join(again, "n_train").select(
        "n_train", "fits", "held_out_rows", share.alias("is_share"),
        (F.abs(F.col("test_mean") - F.col("again")) < 1e-9).alias("by_weights"),
        (F.col("missed") <= OPTIMAL).alias("at_optimum"))


@query("score_batches", """
WITH z AS (SELECT doc_id AS ID, 0.001::DOUBLE * n_chars - 0.0005::DOUBLE * doc_id - 0.75 AS z FROM documents)
SELECT ID, round(z, 6) + 0.0 AS logit, CAST(z > -z AS INTEGER) AS prediction,
       round(1.0 / (1.0 + exp(-2 * z)), 6) AS score FROM z""")
def score_batches(spark, sf):
    weights, bias = np.array([[-0.001, 0.001], [0.0005, -0.0005]]), np.array([0.75, -0.75])

    def load_model():
        """Stands in for loading a model: it runs once per worker and is shipped by value."""
        return lambda a, b: np.stack([a, b], axis=1) @ weights + bias

    rows = corpus.table(spark, sf, "documents").select(
        F.col("doc_id").alias("ID"), F.col("n_chars").cast("double").alias("a"),
        F.col("doc_id").cast("double").alias("b"))
    scored = scoring.score_batches(rows, load_model, ["a", "b"])
    return scored.select(
        "ID", (F.round(F.get("logits", F.lit(1)), 6) + 0.0).alias("logit"),
        scores.argmax_class(F.col("logits")).alias("prediction"),
        F.round(scores.softmax_score(F.col("logits")), 6).alias("score"))


@query("score_saved_model", f"SELECT split, ID, TRUE AS by_model, TRUE AS fits FROM ({_ROWS})")
def score_saved_model(spark, sf):
    """Every labelled row scored in padded batches by the saved weights of the fitted model: its
    score must be that of the model itself, and its entries must fit into its batch."""
    rows, model = _fitted(spark, sf)
    fitted, path = model.stages[-1], new_path(spark, "weights")
    scoring.save_weights(spark, fitted.coefficients.toArray(), fitted.intercept, path)
    entries = PipelineModel(model.stages[:-1]).transform(rows).select(
        "ID", "split", *tfidf.entry_arrays(F.col("features")))
    scored = scoring.score_padded(entries, path)
    sizes = entries.select("ID", "split", F.size("indices").alias("n"))
    whole = logistic.predict(model, rows).select("ID", F.col("score").alias("whole"))
    return scored.join(sizes, "ID").join(whole, "ID").select(
        "split", "ID",
        (F.abs(scores.softmax_score(F.col("logits")) - F.col("whole")) <= 1e-9).alias("by_model"),
        (F.col("n") <= F.col("width")).alias("fits"))
