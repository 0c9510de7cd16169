"""The given tables in the roles of a text classification corpus.

* training texts: ``documents``; validation texts: ``conversations``; unlabelled test texts:
  ``benchmark``
* labelled texts: ``documents`` with ``labels.quality``; where a model needs a training and a
  validation part, every labelled row gets its split from a hash of its ID
* word vectors: ``embeddings``, matched with the tokens of ``documents`` by frequency rank
* tuning trials: ``events``, one study per user
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tonemill.constants import CLS, CONTINUATION, PAD, SEP, UNK
from tonemill.operators.profile import token_counts
from tonemill.operators.rows import attach_labels, clean, union_splits
from tonemill.operators.subword import words
from tonemill.plans.materialize import materialize, new_path
from tonemill.plans.ranges import dense_index
from tonemill.sources.tables import read_word_vectors

VOCAB_WORDS = 2000


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("ID"), F.col("text").alias("Text"))


def conversations(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "conversations").select(
        (F.col("conv_id") * 1000000 + F.col("turn")).alias("ID"), F.col("text").alias("Text"))


def benchmark(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "benchmark").select(
        F.col("item_id").alias("ID"), F.col("text").alias("Text"))


def splits(spark: SparkSession, sf: str) -> DataFrame:
    return union_splits(train=documents(spark, sf), val=conversations(spark, sf),
                        test=benchmark(spark, sf))


def split_of(key: str = "ID") -> Column:
    """``train`` (3/4), ``val`` (1/8) or ``test`` (1/8) by the first hex digit of a hash."""
    digit = F.substring(F.md5(F.col(key).cast("string")), 1, 1)
    return F.when(digit < "c", "train").when(digit < "e", "val").otherwise("test")


def labels(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "labels").select(
        F.col("doc_id").alias("ID"), F.col("quality").alias("Label"))


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    return attach_labels(documents(spark, sf), labels(spark, sf))


def label_rows(spark: SparkSession, sf: str) -> DataFrame:
    """``ID, Label, split, n_chars`` without reading any text."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("ID"), "n_chars")
    return attach_labels(docs, labels(spark, sf)).withColumn("split", split_of())


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Rows scored by a fixed rule of text length, standing in for a trained model."""
    n = F.col("n_chars")
    return label_rows(spark, sf).select(
        F.lit("length").alias("model"), "split", "ID", F.col("Label").alias("label"),
        (n > 1500).cast("int").alias("prediction"), (n / (n + 1500.0)).alias("score"),
        ((n - 1500) / 1000.0).alias("logit"))


def scored_models(spark: SparkSession, sf: str) -> DataFrame:
    """Three such rules side by side; the last has only two distinct scores."""
    rows = attach_labels(
        table(spark, sf, "documents").select(F.col("doc_id").alias("ID"), "n_chars"),
        table(spark, sf, "labels").select(F.col("doc_id").alias("ID"), "quality", "toxic"))
    n = F.col("n_chars")
    models = F.array(
        F.struct(F.lit("long").alias("model"), (n > 1500).cast("int").alias("prediction"),
                 (n / (n + 1500.0)).alias("score")),
        F.struct(F.lit("short").alias("model"), (n < 1500).cast("int").alias("prediction"),
                 (1500.0 / (n + 1500.0)).alias("score")),
        F.struct(F.lit("mild").alias("model"), (1 - F.col("toxic")).alias("prediction"),
                 (1.0 - F.col("toxic")).alias("score")))
    return (rows.select("ID", F.col("quality").alias("label"), F.explode(models).alias("m"))
            .select("m.model", "ID", "label", "m.prediction", "m.score"))


def cleaned(spark: SparkSession, sf: str, profile: str = "embedding") -> DataFrame:
    return clean(documents(spark, sf), profile)


_files: dict[tuple[str, str, str], str] = {}


def once(spark: SparkSession, sf: str, name: str, write) -> str:
    """Path of a table that is written once per session, as a user's own table would be."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _files:
        path = new_path(spark, name)
        write(path)
        _files[key] = path
    return _files[key]


def word_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """``token, vector``, read from a vector text file."""
    def write(path: str) -> None:
        # Written, since numbering by ranges reads its rows twice.
        counts = materialize(token_counts(cleaned(spark, sf)), "counts")
        ranked = dense_index(counts, [F.desc("n"), F.col("token")])
        vectors = table(spark, sf, "embeddings").select(F.col("vec_id").alias("idx"), "embedding")
        ranked.join(vectors, "idx").select(
            F.concat_ws(" ", "token", F.transform("embedding", lambda v: v.cast("string")))
        ).write.text(path)

    return read_word_vectors(spark, once(spark, sf, "vectors", write))


def vector_dim(spark: SparkSession, sf: str) -> int:
    return table(spark, sf, "embeddings").select(F.size("embedding")).first()[0]


def subword_vocab(spark: SparkSession, sf: str, n_words: int = VOCAB_WORDS) -> DataFrame:
    """``token, id``: special tokens, all characters and their continuations, and the ``n_words``
    most frequent words, as the vocabulary file of a tokenizer would hold them."""
    def write(path: str) -> None:
        texts = clean(documents(spark, sf), "contextual")
        tokens = texts.select(F.explode(words(F.col("Processed"))).alias("token"))
        # Written, since characters and frequent words are both taken from them.
        counts = materialize(tokens.groupBy("token").agg(F.count("*").alias("n")), "counts")
        chars = counts.select(F.explode(F.split("token", "")).alias("token")).filter(
            "token != ''").distinct()
        frequent = counts.orderBy(F.desc("n"), "token").limit(n_words).select("token")
        body = (chars.union(chars.select(F.concat(F.lit(CONTINUATION), "token")))
                .union(frequent).distinct())
        special = [PAD, UNK, CLS, SEP]
        names = spark.createDataFrame(list(enumerate(special)), "id int, token string")
        numbered = dense_index(body, [F.col("token")]).select(
            (F.col("idx") + len(special)).cast("int").alias("id"), "token")
        numbered.unionByName(names).write.parquet(path)

    path = once(spark, sf, f"subwords_{n_words}", write)
    return spark.read.schema("id int, token string").parquet(path)


def trials(spark: SparkSession, sf: str) -> DataFrame:
    """``study, trial, value`` with trials numbered by time within each user."""
    events = table(spark, sf, "events").select(
        F.col("user_id").alias("study"), "ts", "event_id", "value")
    return dense_index(events, [F.col("ts"), F.col("event_id")], by=["study"], name="trial").select(
        "study", "trial", "value")


