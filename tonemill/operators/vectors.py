"""Word vectors: lookup and mean pooling."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonemill.functions.tokens import value_counts, ws_tokens
from tonemill.plans.materialize import materialize

#: Bytes of vectors that a task of mean pooling holds, and what a token takes besides.
BLOCK_BYTES, TOKEN_BYTES = 1 << 26, 64


def lookup_vectors(tokens: DataFrame, vectors: DataFrame) -> DataFrame:
    """Token occurrences that have a vector, with the vector.

    No broadcast is forced: a vector table under the planner's size threshold is broadcast,
    a larger one is joined by shuffle with hot tokens split by adaptive skew handling.
    """
    return tokens.join(vectors, "token", "inner")


def document_token_counts(df: DataFrame, text: str = "Processed") -> DataFrame:
    """``(ID, token, tf)`` without a shuffle.

    A token meets the vector table once per document, however often the document repeats it.
    """
    return df.select("ID", F.inline(value_counts(ws_tokens(F.col(text)))).alias("token", "tf"))


def mean_pool(df: DataFrame, vectors: DataFrame, dim: int, text: str = "Processed") -> DataFrame:
    """Mean of a text's word vectors over all occurrences; zeros when none is known.

    Every ID of ``df`` is kept. Vectors are broadcast in blocks of ``BLOCK_BYTES``, and each text is
    summed where it lies; more vectors take more passes. One sum per text and pass travels.
    """
    # Rows without an ID are not pooled with each other.
    tokens = df.select("ID", F.when(F.col("ID").isNotNull(), ws_tokens(F.col(text))).alias("tokens"))
    count = vectors.count()
    passes = max(1, math.ceil(count * (4 * dim + TOKEN_BYTES) / BLOCK_BYTES))
    if passes > 1:
        tokens = materialize(tokens, "tokens")
        vectors = materialize(vectors, "vectors")
    sums = [_sums(tokens, vectors.filter(F.pmod(F.xxhash64("token"), F.lit(passes)) == i), dim)
            for i in range(passes)]
    # Rows of one ID are pooled together, and the result stands for each of them.
    pairs = reduce(DataFrame.union, [s.withColumn("row", F.lit(int(i == 0))) for i, s in enumerate(sums)])
    zeros = F.array_repeat(F.lit(0.0), dim)
    grouped = pairs.groupBy("ID").agg(
        F.sum("n").alias("n"), F.sum("row").alias("rows"),
        F.collect_list(F.when(F.size("total") > 0, F.col("total"))).alias("totals"))
    total = F.aggregate("totals", zeros, lambda acc, t: F.zip_with(acc, t, lambda a, b: a + b))
    return grouped.select(
        "ID", F.when(F.col("n") > 0, F.transform(total, lambda x: x / F.col("n"))).otherwise(
            zeros).alias("pooled"), F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("row")).drop("row")


def _sums(tokens: DataFrame, vectors: DataFrame, dim: int) -> DataFrame:
    """``ID, total, n`` of every row: sum of the vectors of its tokens, and how many have one.

    ``total`` is empty where none has. ``vectors`` must be bounded; they are held by every task.
    """
    table = vectors.select("token", F.col("vector").cast("array<float>")).toArrow().combine_chunks()
    words = pa.array([], pa.string()) if not table.num_rows else table.column("token").chunk(0)
    matrix = np.zeros((0, dim), np.float32) if not table.num_rows else table.column(
        "vector").chunk(0).flatten().to_numpy().reshape(-1, dim)
    shared = tokens.sparkSession.sparkContext.broadcast((words, matrix))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, matrix = shared.value
        for batch in batches:
            lists = batch.column("tokens")
            lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
            # Tokens are looked up once per batch; a token may have several vectors.
            flat = lists.flatten().dictionary_encode()
            own = pc.index_in(words, flat.dictionary)
            known = np.flatnonzero(own.is_valid().to_numpy(zero_copy_only=False))
            place = own.drop_null().to_numpy()
            n_vectors = np.bincount(place, minlength=len(flat.dictionary)).astype(np.float64)
            of_token = np.zeros((len(flat.dictionary), dim))
            np.add.at(of_token, place, matrix[known].astype(np.float64))
            codes = flat.indices.to_numpy()
            ends = np.cumsum(lengths)
            totals, sizes, n = [], [], []
            for a, b in zip((ends - lengths).tolist(), ends.tolist()):
                at = codes[a:b]
                at = at[n_vectors[at] > 0]
                distinct, tf = np.unique(at, return_counts=True)
                sizes.append(dim if len(distinct) else 0)
                n.append(float(tf @ n_vectors[distinct]))
                if len(distinct):
                    totals.append(tf @ of_token[distinct])
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            values = np.concatenate(totals) if totals else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("ID"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
                 pa.array(n, pa.float64())], names=["ID", "total", "n"])

    kind = tokens.schema["ID"].dataType.simpleString()
    return tokens.mapInArrow(run, f"ID {kind}, total array<double>, n double")
