"""TF-IDF: vocabulary, weights and the heaviest terms of a class.

Counting terms inside each row (sort, then run lengths) replaces a shuffle on (ID, term):
the only shuffle of a fit is on the term, after partial counts. A vocabulary of the most frequent
n-grams is fitted on words, and counts only those that may be among them (``frequent.py``).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonemill.constants import (STOP_WORDS, TFIDF_MAX_FEATURES, TFIDF_MIN_DF, TFIDF_NGRAMS,
                                TOP_N)
from tonemill.functions.tokens import ngrams, remove_stop_words, value_counts, word_tokens
from tonemill.operators import frequent

# Vocabularies up to this size are held as one MLlib model; larger ones stay a table.
MODEL_TERMS = 1 << 20


def word_array(text: Column, stop_words: list[str] = STOP_WORDS) -> Column:
    """The words that are left when stop words are gone."""
    return remove_stop_words(word_tokens(text), stop_words)


def term_array(text: Column, stop_words: list[str] = STOP_WORDS,
               ngram_range: tuple[int, int] = TFIDF_NGRAMS) -> Column:
    """N-grams of the words that are left when stop words are gone."""
    return ngrams(word_array(text, stop_words), *ngram_range)


def count_terms(df: DataFrame, terms: str = "terms") -> DataFrame:
    """``(term, tf, df)``: corpus count and number of rows that hold the term.

    Terms are sorted within their row and unnested beside their left neighbour; where the two
    differ, a new term of the row begins.
    """
    ordered = df.select(F.sort_array(terms).alias("w"))
    shifted = F.concat(F.array(F.lit(None).cast("string")),
                       F.slice("w", F.lit(1), F.greatest(F.size("w") - 1, F.lit(0))))
    pairs = F.when(F.size("w") > 0, F.arrays_zip(F.col("w").alias("term"), shifted.alias("left")))
    begins = (~F.col("term").eqNullSafe(F.col("left"))).cast("long")
    return (ordered.select(F.inline(pairs).alias("term", "left")).groupBy("term")
            .agg(F.count("*").alias("tf"), F.sum(begins).alias("df")))


def fit_vocabulary(df: DataFrame, terms: str = "terms", min_df: int = TFIDF_MIN_DF,
                   max_features: int | None = TFIDF_MAX_FEATURES,
                   ngram_range: tuple[int, int] | None = None) -> DataFrame:
    """Terms found in at least ``min_df`` rows, cut to the ``max_features`` most frequent.

    Equal counts are ordered by term. With ``ngram_range`` the column ``terms`` holds words, and terms are their
    n-grams; ``df`` is then read twice, and should be a written table.
    """
    if ngram_range is None:
        counted = count_terms(df, terms)
    elif max_features is None:
        counted = count_terms(with_ngrams(df, terms, ngram_range), terms)
    else:
        counted = frequent.candidates(df, terms, *ngram_range, min_df, max_features)
    kept = counted.filter(F.col("df") >= min_df)
    return kept if max_features is None else kept.orderBy(F.desc("tf"), "term").limit(max_features)


def with_ngrams(df: DataFrame, words: str = "terms",
                ngram_range: tuple[int, int] | None = TFIDF_NGRAMS) -> DataFrame:
    """The column of words replaced by its n-grams; without a range it is left as it is."""
    return df if ngram_range is None else df.withColumn(words, ngrams(F.col(words), *ngram_range))


def fit_idf(vocabulary: DataFrame, n_rows: Column) -> DataFrame:
    """Add smoothed inverse document frequency, ``ln((1 + n) / (1 + df)) + 1``."""
    return vocabulary.withColumn(
        "idf", F.log((1 + n_rows) / (1 + F.col("df")).cast("double")) + 1.0)


def row_count(df: DataFrame) -> Column:
    """Number of rows as a scalar subquery."""
    return df.agg(F.count("*")).scalar()


@dataclass
class TfIdf:
    """A fitted vocabulary with idf; at most ``MODEL_TERMS`` terms, so it fits on the driver."""

    terms: list[str]
    idf: np.ndarray

    def model(self, terms: str = "terms", output: str = "features") -> PipelineModel:
        """MLlib stages from a term array to a row of unit length: no shuffle, no join."""
        counter = (CountVectorizerModel.from_vocabulary(self.terms, inputCol=terms,
                                                        outputCol=f"{output}_tf"))
        weigh = ElementwiseProduct(scalingVec=Vectors.dense(self.idf),
                                   inputCol=f"{output}_tf", outputCol=f"{output}_idf")
        unit = Normalizer(p=2.0, inputCol=f"{output}_idf", outputCol=output)
        return PipelineModel([counter, weigh, unit])

    def transform(self, df: DataFrame, terms: str = "terms", output: str = "features") -> DataFrame:
        """Every row with its vector; without any term known, vectors are empty."""
        if not self.terms:
            return df.withColumn(output, array_to_vector(F.array().cast("array<double>")))
        return (self.model(terms, output).transform(df)
                .drop(f"{output}_tf", f"{output}_idf"))


def fit_tfidf(df: DataFrame, terms: str = "terms", min_df: int = TFIDF_MIN_DF,
              max_features: int = TFIDF_MAX_FEATURES,
              ngram_range: tuple[int, int] | None = None) -> TfIdf:
    """Fit on the rows of ``df``. The vocabulary is bounded by ``max_features``."""
    if max_features > MODEL_TERMS:
        raise ValueError(f"more than {MODEL_TERMS} features: use weights")
    vocabulary = fit_idf(fit_vocabulary(df, terms, min_df, max_features, ngram_range), row_count(df))
    rows = vocabulary.orderBy(F.desc("tf"), "term").select("term", "idf").toPandas()
    return TfIdf(rows["term"].tolist(), rows["idf"].to_numpy())


def sparse_entries(features: Column) -> Column:
    """Array of ``(index, weight)`` held by a sparse vector column."""
    raw = F.unwrap_udt(features)
    return F.transform(raw["indices"], lambda i, k: F.struct(
        i.alias("index"), F.get(raw["values"], k).alias("weight")))


def entry_arrays(features: Column) -> list[Column]:
    """``indices`` and ``values`` of a vector column; a dense vector holds every index."""
    raw = F.unwrap_udt(features)
    every = F.when(F.size(raw["values"]) > 0,
                   F.sequence(F.lit(0), F.size(raw["values"]) - 1)).otherwise(
        F.array().cast("array<int>"))
    return [F.coalesce(raw["indices"], every).alias("indices"), raw["values"].alias("values")]


def weights_long(tfidf: TfIdf, df: DataFrame, terms: str = "terms",
                 keep: tuple[str, ...] = ("ID",)) -> DataFrame:
    """Weights as rows ``(ID, term, weight)``; rows without a known term give none."""
    spark = df.sparkSession
    names = spark.createDataFrame(list(enumerate(tfidf.terms)), "index int, term string")
    entries = tfidf.transform(df, terms).select(
        *keep, F.inline(sparse_entries(F.col("features"))))
    # Bounded by MODEL_TERMS rows.
    return entries.join(F.broadcast(names), "index").select(*keep, "term", "weight")


def weights(train: DataFrame, df: DataFrame, terms: str = "terms", min_df: int = TFIDF_MIN_DF,
            max_features: int | None = TFIDF_MAX_FEATURES,
            keep: tuple[str, ...] = ("ID",), ngram_range: tuple[int, int] | None = None) -> DataFrame:
    """``(keep, term, weight)`` of ``df`` by a vocabulary of any size fitted on ``train``.

    ``max_features=None`` sets no bound; such a vocabulary stays a table. Rows are the same. With
    ``ngram_range`` both have words in the column ``terms``.
    """
    rows = with_ngrams(df, terms, ngram_range)
    if max_features is not None and max_features <= MODEL_TERMS:
        return weights_long(fit_tfidf(train, terms, min_df, max_features, ngram_range), rows, terms, keep)
    vocabulary = fit_idf(fit_vocabulary(train, terms, min_df, max_features, ngram_range), row_count(train))
    return weights_by_join(vocabulary, rows, terms, keep)


def weights_by_join(vocabulary: DataFrame, df: DataFrame, terms: str = "terms",
                    keep: tuple[str, ...] = ("ID",)) -> DataFrame:
    """The same weights for a vocabulary of any size: a join on the term, then one on the key.

    ``vocabulary`` has ``term, idf``. Terms are counted within each row first, so a frequent
    term meets each row once; adaptive skew handling splits what is left of a hot term.
    """
    counted = df.select(*keep, F.inline(value_counts(F.col(terms))))
    weighted = counted.join(vocabulary.select("term", "idf"), "term").select(
        *keep, "term", (F.col("tf") * F.col("idf")).alias("raw"))
    rows = weighted.groupBy(*keep).agg(
        F.collect_list(F.struct("term", "raw")).alias("entries"),
        F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("norm"))
    return (rows.select(*keep, "norm", F.inline("entries"))
            .select(*keep, "term", (F.col("raw") / F.col("norm")).alias("weight")))


def top_ngrams(df: DataFrame, terms: str = "terms", max_features: int = 2000,
               n: int = TOP_N, ngram_range: tuple[int, int] | None = None) -> DataFrame:
    """The ``n`` terms with the largest summed TF-IDF weight in ``df``."""
    tfidf = fit_tfidf(df, terms, min_df=1, max_features=max_features, ngram_range=ngram_range)
    entries = tfidf.transform(with_ngrams(df, terms, ngram_range), terms).select(F.inline(sparse_entries(F.col("features"))))
    names = df.sparkSession.createDataFrame(list(enumerate(tfidf.terms)), "index int, term string")
    sums = entries.groupBy("index").agg(F.sum("weight").alias("score"))
    return (sums.join(F.broadcast(names), "index").select("term", "score")
            .orderBy(F.desc("score"), "term").limit(n))
