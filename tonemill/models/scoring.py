"""Any batch model applied on the executors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonemill.constants import BATCH_SIZE


def score_batches(df: DataFrame, make_predict: Callable, inputs: list[str],
                  batch_size: int = BATCH_SIZE, output: str = "logits") -> DataFrame:
    """Add an array of logits per row.

    ``make_predict`` is called once per Python worker and returns a function from numpy batches
    to a ``(rows, classes)`` array, so a model is loaded once and rows are scored where they
    are, without a shuffle.
    """
    scorer = predict_batch_udf(make_predict, return_type=T.ArrayType(T.DoubleType()),
                               batch_size=batch_size)
    return df.withColumn(output, scorer(*inputs))


def save_weights(spark: SparkSession, coefficients: np.ndarray, intercept: float, path: str) -> None:
    """Write a linear model as a table: a row per coefficient, and the intercept as row -1."""
    rows = [(-1, float(intercept)), *enumerate(map(float, coefficients))]
    spark.createDataFrame(rows, "index int, weight double").write.parquet(path)


def load_weights(spark: SparkSession, path: str) -> tuple[np.ndarray, float]:
    """The same model, read through Spark; a model is small enough for every worker."""
    rows = {r["index"]: r["weight"] for r in spark.read.parquet(path).collect()}
    return np.array([rows[i] for i in range(len(rows) - 1)]), rows[-1]


def by_length(df: DataFrame, entries: str) -> DataFrame:
    """Rows in ranges of the length of an array column and sorted by it, so that batches of
    neighbours need little padding."""
    return df.repartitionByRange(F.size(entries)).sortWithinPartitions(F.size(entries))


def score_padded(df: DataFrame, path: str, key: str = "ID", indices: str = "indices",
                 values: str = "values", batch_size: int = BATCH_SIZE) -> DataFrame:
    """``key, logits, width`` of sparse rows by a saved linear model, batch by batch.

    The model is read once and sent once to each worker. A batch of ``batch_size`` rows is a matrix as
    wide as its longest row, which is ``width``; rows come in order of length, so all batches of
    a partition have at most ``batch_size`` times its longest row of padding in all.
    """
    model = df.sparkSession.sparkContext.broadcast(load_weights(df.sparkSession, path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = model.value
        weights = np.append(weights, 0.0)  # what padding points at
        for batch in batches:
            for a in range(0, len(batch), batch_size):
                part = batch.slice(a, batch_size)
                sizes = part.column(1).value_lengths().to_numpy(zero_copy_only=False).astype(int)
                width = int(sizes.max())
                there = np.arange(width) < sizes[:, None]
                at, x = np.full(there.shape, -1), np.zeros(there.shape)
                at[there] = part.column(1).flatten().to_numpy()
                x[there] = part.column(2).flatten().to_numpy()
                z = (weights[at] * x).sum(axis=1) + bias
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(list(np.stack([-z / 2, z / 2], axis=1)), pa.list_(pa.float64())),
                     pa.array(np.full(len(part), width, np.int32))], names=[key, "logits", "width"])

    schema = T.StructType([df.schema[key], T.StructField("logits", T.ArrayType(T.DoubleType())),
                           T.StructField("width", T.IntegerType())])
    return by_length(df.select(key, indices, values), indices).mapInArrow(run, schema)
