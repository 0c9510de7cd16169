"""Ranked lexical search, term at a time with limited accumulators.

Every query ranks all documents. A document's score is a sum, over the query's distinct terms, of
the term's weight times a saturating function of its frequency and the document's length; all of
it in whole numbers, from counts over the whole table.

One pass over the texts keeps, per document, its length and the frequencies of the terms that some
query has. Documents are then dealt to shards of about as many postings each, in which lists are
built per term. A query goes through its terms from the rarest to the most frequent and adds each
list to its accumulators. Once the largest scores that the remaining terms could still add are
below the k-th partial score, no new accumulator is made; those that can still reach it go on to be
updated, so that their scores are exact. A few shards are searched first: the k-th scores found
there are lower limits for all others, whose lists mostly end before an accumulator is made.

What is broadcast is the terms of one group of queries, ``GROUP_TERMS`` at most on average; more
queries are searched group by group, with the same scores.

Defined cases: texts that are null or without terms are in no result and no count, queries without
terms have no rows; every query row is ranked for itself, so queries may share an ID, and every
document row is a candidate, so equal rows stand side by side; equal scores go by ascending document
ID, null first; other columns are not read; an empty table gives no rows. Terms are compared by
64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType
from pyspark.sql.window import Window

from tonemill.llm import buffers
from tonemill.plans.materialize import materialize

GROUP_TERMS = 1 << 20
SHARD_POSTINGS = 1 << 21
#: One shard in so many is searched first, for the limits of all others.
PROBE_SHARE = 64
_SEED = 11


def _terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every term: lower-cased runs of letters, digits and non-ASCII characters."""
    data, offsets = buffers.utf8(texts)
    starts, ends, rows = buffers.words(data, offsets, buffers.MARKS)
    if not len(starts):
        return rows, np.zeros(0, np.uint64)
    return rows, buffers.SpanHash(buffers.LOWER[data], _SEED).of(starts, ends)


def query_terms(queries: DataFrame, key: str, text: str) -> DataFrame:
    """``query, item, terms``: a number, the ID and the distinct terms of each query row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("_text")
            rows, hashes = _terms(texts)
            flat, bounds = buffers.distinct_sorted(rows, hashes, len(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("query"), pa.ListArray.from_arrays(
                    pa.array(bounds.astype(np.int32)), pa.array(flat.view(np.int64)))],
                names=["query", "terms"])

    numbered = materialize(queries.select(
        F.monotonically_increasing_id().alias("query"), F.col(key).alias("item"),
        F.col(text).alias("_text")), "queries")
    terms = numbered.select("query", "_text").mapInArrow(run, "query long, terms array<long>")
    return materialize(numbered.select("query", "item").join(
        terms.filter(F.size("terms") > 0), "query"), "terms")


def postings(docs: DataFrame, key: str, text: str, vocabulary: np.ndarray) -> DataFrame:
    """``row, id, n, terms, freqs`` of every document with terms.

    ``n`` counts all of them, ``terms`` are the places in the sorted ``vocabulary`` of those in it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, row = shared.value, TaskContext.get().partitionId() << 33
        for batch in batches:
            for a, b in buffers.slices(batch.column("_text")):
                part = batch.slice(a, b - a)
                rows, hashes = _terms(part.column("_text"))
                n = np.bincount(rows, minlength=len(part))
                at = np.searchsorted(known, hashes)
                at[at == len(known)] = 0
                hit = known[at] == hashes
                pairs, freqs = np.unique(rows[hit] * len(known) + at[hit], return_counts=True)
                bounds = np.searchsorted(pairs, np.arange(len(part) + 1) * len(known))
                lists = [pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)),
                                                  pa.array(x.astype(np.int32)))
                         for x in (pairs % len(known), freqs)]
                numbers = pa.array(np.arange(row, row + len(part)))
                row += len(part)
                yield pa.RecordBatch.from_arrays(
                    [numbers, part.column("id"), pa.array(n.astype(np.int64)), *lists],
                    names=["row", "id", "n", "terms", "freqs"])

    source = docs.select(F.col(key).alias("id"), F.col(text).alias("_text"))
    schema = (StructType([StructField("row", LongType()), source.schema["id"]])
              .add("n", LongType()).add("terms", ArrayType(IntegerType()))
              .add("freqs", ArrayType(IntegerType())))
    return materialize(source.mapInArrow(run, schema).filter("n > 0"), "postings")


class Lists:
    """The posting lists of a shard; documents are places in order of their ID."""

    def __init__(self, table: pa.Table, weights: np.ndarray, n_docs: int, n_terms: int):
        order = pc.sort_indices(table.column("id"), null_placement="at_start")
        table = table.take(order).combine_chunks()
        self.ids = table.column("id")
        terms, freqs = (table.column(c).combine_chunks() for c in ("terms", "freqs"))
        sizes = pc.list_value_length(terms).to_numpy(zero_copy_only=False)
        terms = terms.flatten().to_numpy()
        tf = freqs.flatten().to_numpy().astype(np.int64)
        n = table.column("n").to_numpy()
        # 50 * n * N may pass 64 bits only beyond 10**9 terms in a document of 10**8 documents.
        damping = 50 + (50 * n * n_docs) // n_terms
        docs = np.repeat(np.arange(len(n)), sizes)
        gains = weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 20 * damping[docs]))
        by_term = np.argsort(terms, kind="stable")
        self.docs, self.gains = docs[by_term], gains[by_term]
        self.bounds = np.searchsorted(terms[by_term], np.arange(len(weights) + 1))
        self.most = np.zeros(len(weights), np.int64)
        np.maximum.at(self.most, terms, gains)

    def search(self, terms: np.ndarray, k: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the ``k`` best with a score of ``limit`` or more, best first.

        ``terms`` come rarest first.
        """
        terms = terms[self.most[terms] > 0]
        most = self.most[terms]
        rest = np.concatenate([np.cumsum(most[::-1])[::-1], [0]]).tolist()
        scores, alive, kth = np.zeros(len(self.ids), np.int64), None, max(limit, 1)
        for i, term in enumerate(terms.tolist()):
            docs, gains = (x[self.bounds[term]: self.bounds[term + 1]]
                           for x in (self.docs, self.gains))
            if alive is None and rest[i] < kth:
                alive = np.flatnonzero(scores)
            if alive is None:
                scores[docs] += gains
            else:
                # What is far below the k-th can't come back; the rest is updated exactly.
                alive = alive[scores[alive] + rest[i] >= kth]
                if not len(alive):
                    break
                at = np.searchsorted(docs, alive)
                at[at == len(docs)] = 0
                hit = docs[at] == alive
                scores[alive[hit]] += gains[at[hit]]
            # The k-th partial score can only end the making of accumulators past half way.
            if rest[0] - rest[i + 1] > rest[i + 1]:
                kth = max(kth, _kth(scores if alive is None else scores[alive], k))
        found = np.flatnonzero(scores >= kth) if alive is None else alive[scores[alive] >= kth]
        best = found[np.argsort(-scores[found], kind="stable")][:k]
        return best, scores[best]


def _kth(scores: np.ndarray, k: int) -> int:
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


def _search(shards: DataFrame, asked, weights, limits, k: int, n_docs: int, n_terms: int):
    """``query, id, score``: the best of each shard for every query of ``asked``."""
    shared = shards.sparkSession.sparkContext.broadcast((asked, weights, limits))

    def run(table: pa.Table) -> pa.Table:
        asked, weights, limits = shared.value
        lists = Lists(table, weights, n_docs, n_terms)
        queries, places, scores = [], [], []
        for query, terms in asked.items():
            best, score = lists.search(terms, k, limits.get(query, 0))
            queries.append(np.full(len(best), query, np.int64))
            places.append(best)
            scores.append(score)
        return pa.table({"query": pa.array(np.concatenate(queries)),
                         "id": lists.ids.take(pa.array(np.concatenate(places))),
                         "score": pa.array(np.concatenate(scores))})

    schema = StructType([StructField("query", LongType()), shards.schema["id"],
                         StructField("score", LongType())])
    return shards.groupBy("shard").applyInArrow(run, schema)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_first("id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _group(docs: DataFrame, group: DataFrame, k: int, key: str, text: str,
           shard_postings: int) -> DataFrame:
    """``item, rank, id, score`` for one group of queries."""
    asked = {r["query"]: np.array(r["terms"], np.int64).view(np.uint64)
             for r in group.select("query", "terms").toLocalIterator()}
    vocabulary = np.unique(np.concatenate(list(asked.values())))
    lists = postings(docs, key, text, vocabulary)
    n_docs, n_terms = lists.agg(F.count("*"), F.sum("n")).first()
    counts = lists.select(F.explode("terms").alias("term")).groupBy("term").count()
    df = np.zeros(len(vocabulary), np.int64)
    for r in counts.toLocalIterator():  # a row per term of the group
        df[r["term"]] = r["count"]
    weights = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)
    rarest = np.lexsort((np.arange(len(df)), df))
    place = np.empty_like(rarest)
    place[rarest] = np.arange(len(df))
    for query, terms in asked.items():
        at = np.searchsorted(vocabulary, terms)
        asked[query] = at[np.argsort(place[at])]
    n_shards = max(1, -(-int(df.sum()) // shard_postings))
    shards = lists.filter(F.size("terms") > 0).withColumn(
        "shard", F.pmod(F.xxhash64("row"), F.lit(n_shards)).cast(IntegerType())).drop("row")
    search = lambda rows, limits: _search(
        rows, asked, weights, limits, k, n_docs, n_terms)
    limits = {}
    if n_shards > 1:
        probe = _best(search(shards.filter(F.col("shard") <= n_shards // PROBE_SHARE), {}), k)
        limits = {r["query"]: r["score"]
                  for r in probe.filter(F.col("rank") == k).toLocalIterator()}
    names = F.broadcast(group.select("query", "item"))  # as many as the broadcast terms
    return _best(search(shards, limits), k).join(names, "query")


def rank_documents(docs: DataFrame, queries: DataFrame, k: int, key: str = "doc_id",
                   text: str = "text", query_key: str = "item_id", query_text: str = "text",
                   group_terms: int = GROUP_TERMS, shard_postings: int = SHARD_POSTINGS
                   ) -> DataFrame:
    """``query_key, rank, key, score``: the ``k`` best documents with a score above 0 per query."""
    asked = query_terms(queries, query_key, query_text)
    total = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    n_groups = max(1, -(-total // group_terms))
    grouped = asked.withColumn("group", F.pmod(F.xxhash64("query"), F.lit(n_groups)))
    parts = []
    for g in range(n_groups):
        group = grouped.filter(F.col("group") == g)
        if not group.isEmpty():
            parts.append(_group(docs, group, k, key, text, shard_postings))
    if not parts:
        parts = [docs.limit(0).select(
            F.lit(None).cast(asked.schema["item"].dataType).alias("item"), F.lit(0).alias("rank"),
            F.col(key).alias("id"), F.lit(0).cast("long").alias("score"))]
    return reduce(DataFrame.union, [p.select(
        F.col("item").alias(query_key), F.col("rank").cast("int").alias("rank"),
        F.col("id").alias(key), "score") for p in parts])
