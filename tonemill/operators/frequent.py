"""The most frequent n-grams of word lists, exactly, without counting the rare ones one by one.

Hashed counts first (the method of Park, Chen and Yu): an n-gram is no more frequent than its
bucket, so where enough single words are known to be more frequent than a bucket is, none of
its n-grams can be among the most frequent. Only n-grams of the other buckets are counted as strings.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonemill.plans.materialize import materialize

#: Buckets that n-grams are counted in: what a task sends and holds.
BUCKETS = 1 << 20
_COUNTS = "bucket int, term string, tf long, df long"


class _Batch:
    """The words of an Arrow column of lists as numbers, and which list each belongs to."""

    def __init__(self, lists: pa.Array):
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        encoded = lists.flatten().dictionary_encode()
        self.names, self.codes = encoded.dictionary, encoded.indices.to_numpy().astype(np.int64)
        self.rows = np.repeat(np.arange(len(sizes)), sizes)
        self.left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(self.codes))  # words to the end of the list

    def starts(self, n: int) -> np.ndarray:
        return np.flatnonzero(self.left >= n)

    def buckets(self, starts: np.ndarray, n: int, most: int) -> np.ndarray:
        """The same number for the same words in every batch."""
        of_word = np.fromiter((zlib.crc32(w.as_buffer()) for w in self.names), np.uint64, len(self.names))
        h = np.full(len(starts), n, np.uint64)
        for k in range(n):
            h = (h ^ of_word[self.codes[starts + k]]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        return (h % np.uint64(most)).astype(np.int64)

    def counted(self, starts: np.ndarray, n: int) -> list[pa.Array]:
        """``term, tf, df`` of the n-grams that begin at ``starts``, compared by their words."""
        key = self.codes[starts]
        for k in range(1, n):
            if k > 1:  # ranks, so that the product stays small
                key = np.unique(key, return_inverse=True)[1]
            key = key * len(self.names) + self.codes[starts + k]
        order = np.argsort(key, kind="stable")
        key, rows = key[order], self.rows[starts[order]]
        new = np.append(True, key[1:] != key[:-1])[:len(key)]
        first = np.flatnonzero(new)
        in_row = new | np.append(True, rows[1:] != rows[:-1])[:len(key)]
        tf = np.diff(np.append(first, len(key)))
        df = np.add.reduceat(in_row.astype(np.int64), first) if len(first) else tf
        at = starts[order[first]]
        words = [self.names.take(pa.array(self.codes[at + k])) for k in range(n)]
        return [pc.binary_join_element_wise(*words, " ") if n > 1 else words[0], pa.array(tf), pa.array(df)]


def _rows(bucket, term, tf, df) -> pa.RecordBatch:
    n = len(tf)
    return pa.RecordBatch.from_arrays(
        [pa.nulls(n, pa.int32()) if bucket is None else pa.array(bucket, pa.int32()),
         pa.nulls(n, pa.string()) if term is None else term.cast(pa.string()),
         pa.array(tf, pa.int64()), pa.nulls(n, pa.int64()) if df is None else pa.array(df, pa.int64())],
        names=["bucket", "term", "tf", "df"])


def _single_words_and_buckets(lo: int, hi: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            part = _Batch(batch.column(0))
            if lo == 1:
                yield _rows(None, *part.counted(part.starts(1), 1))
            for n in range(max(lo, 2), hi + 1):
                total += np.bincount(part.buckets(part.starts(n), n, buckets), minlength=buckets)
        held = np.flatnonzero(total)
        yield _rows(held, None, total[held], None)
    return run


def _of_buckets(lo: int, hi: int, buckets: int, kept):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(np.frombuffer(kept.value, np.uint8)).astype(bool)
        for batch in batches:
            part = _Batch(batch.column(0))
            for n in range(max(lo, 2), hi + 1):
                starts = part.starts(n)
                yield _rows(None, *part.counted(starts[bits[part.buckets(starts, n, buckets)]], n))
    return run


def candidates(df: DataFrame, words: str, lo: int, hi: int, min_df: int, most: int,
               buckets: int = BUCKETS) -> DataFrame:
    """``term, tf, df`` of n-grams of ``lo`` to ``hi`` words: all that are in ``min_df`` rows and among the
    ``most`` frequent, ties included, and some others. Words must not hold spaces.

    ``df`` is read twice. With fewer than ``most`` single words, every n-gram is counted.
    """
    spark = df.sparkSession
    counts = materialize(
        df.select(words).mapInArrow(_single_words_and_buckets(lo, hi, buckets), _COUNTS)
        .groupBy("bucket", "term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df")), "counts")
    single = counts.filter("bucket IS NULL").select("term", "tf", "df")
    known = single.filter(F.col("df") >= min_df).orderBy(F.desc("tf")).limit(most).agg(
        F.count("*").alias("n"), F.min("tf").alias("least")).first()
    least = known["least"] if known["n"] == most and most > 0 else 0
    # A bit per bucket, whatever the corpus.
    bits = np.zeros(buckets, np.uint8)
    bits[counts.filter(F.col("bucket").isNotNull() & (F.col("tf") >= least)).select("bucket")
         .toArrow().column(0).to_numpy()] = 1
    kept = spark.sparkContext.broadcast(np.packbits(bits).tobytes())
    longer = df.select(words).mapInArrow(_of_buckets(lo, hi, buckets, kept), _COUNTS).groupBy("term").agg(
        F.sum("tf").alias("tf"), F.sum("df").alias("df"))
    return single.unionByName(longer)
