"""Feed-forward net on pooled word vectors.

MLlib's net has sigmoid hidden layers and a softmax output; it stands in for a net with other
activations, and is compared with it by accuracy only.
"""

from __future__ import annotations

from pyspark.ml.classification import (MultilayerPerceptronClassificationModel,
                                       MultilayerPerceptronClassifier)
from pyspark.ml.linalg import Vector
from pyspark.sql import DataFrame

from tonemill.constants import MLP_EPOCHS, MLP_HIDDEN, SEED, TRAIN_BATCH_SIZE
from tonemill.operators.batches import balanced_rows


def fit_mlp(train: DataFrame, dim: int, hidden: list[int] = MLP_HIDDEN,
            max_iter: int = MLP_EPOCHS, block_size: int = TRAIN_BATCH_SIZE,
            seed: int = SEED, step_size: float = 0.03, start: Vector | None = None
            ) -> MultilayerPerceptronClassificationModel:
    """``start`` holds weights of an earlier fit of the same layers, from which this one goes on."""
    net = MultilayerPerceptronClassifier(
        featuresCol="features", labelCol="label", layers=[dim, *hidden, 2],
        maxIter=max_iter, blockSize=block_size, seed=seed, stepSize=step_size)
    return (net if start is None else net.setInitialWeights(start)).fit(train)


def dealt(rows: DataFrame) -> DataFrame:
    """``rows`` dealt anew, one part of as many rows for each core.

    A step of a fit lasts as long as its fullest task, and copies of rows lie where their row lay. More parts
    than cores would only send more gradients.
    """
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism)


def fit_balanced(train: DataFrame, dim: int, **settings) -> MultilayerPerceptronClassificationModel:
    """The same with every class weighing as much as the largest.

    The net has no weight column, so rows of ``ID, label, features`` are repeated by exact quotas.
    """
    return fit_mlp(dealt(balanced_rows(train, label="label")), dim, **settings)
