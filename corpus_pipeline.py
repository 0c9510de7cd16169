"""From raw documents to shuffled training shards, in five stages.

Each stage gets what the one before it kept, is written as Parquet to the shared work folder and
read again. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonemill.llm import decontam, langid, minhash, mixing, sharding
from tonemill.plans.materialize import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
N_SHARDS = 40
#: Least score of a text whose language counts as told.
LEAST_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told, with that language as their ``lang``.

    Texts that are null or have no letter go, and so do those whose score is below ``LEAST_SCORE``:
    writing that is like none of the languages learnt, or like two of them. Rows with equal
    texts share their fate. Without any labelled text no language can be told, and no row stays.
    """
    docs = docs.select(*COLUMNS)
    model = langid.fit(docs.filter(~langid.held_out(F.col("doc_id"))))
    return langid.predict(docs, model).filter(
        (F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)
    ).withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8): the one of least ID.

    Rows without an ID stay. Rows that share an ID are one document, of which the text that
    hashes least stays.
    """
    docs = docs.select(*COLUMNS)
    kept = minhash.near_duplicates(docs, minhash.NearDup(width=5)).filter(
        F.col("kept") & F.col("doc_id").isNotNull()).select("doc_id")
    text_hash = F.xxhash64("text", "source", "lang", "n_chars")
    ids = docs.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min(text_hash).alias("_first")).join(kept.distinct(), "doc_id", "left_semi")
    stay = docs.withColumn("_hash", text_hash).join(materialize(ids, "kept"), "doc_id").filter(
        F.col("_hash") == F.col("_first")).dropDuplicates(["doc_id"]).select(*COLUMNS)
    return stay.unionByName(docs.filter("doc_id IS NULL"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Null and empty texts hold none and stay; items without a text are in no document.
    """
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return decontam.without_leaks(docs.select(*COLUMNS), items)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order.

    A copy that the mix takes only in part is whole if half of its words or more are taken, and
    left out if fewer are. Texts without words are not in the mix.
    """
    rows = docs.select(*COLUMNS).withColumn("_row", F.xxhash64(*COLUMNS))
    wanted = F.filter("copies", lambda c: c["words"] * 2 >= F.col("size"))
    copies = materialize(mixing.assign(rows, key="_row").select(
        "_row", F.explode(wanted).alias("_copy")).select(
        "_row", F.col("_copy.position").alias("_position")), "copies")
    # Equal rows share a key and bring a copy each; one of them gives the text for all.
    texts = rows.dropDuplicates(["_row"])
    return mixing.in_training_order(texts.join(copies, "_row"), F.col("_position"), "_row").select(
        *COLUMNS)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of every row that the mix holds.

    A null text has size 16; equal rows are dealt each for itself; an empty table gives no rows.
    """
    return sharding.shuffle_to_shards(sharding.keyed(docs), N_SHARDS).select(
        "doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("bigint").alias("slot"))


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: The model, the banding and the draws cannot be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
