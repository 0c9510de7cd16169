"""Find training documents that contain benchmark items, by BM25 retrieval and overlap.

The items form an inverted index. Every passage of a document (a window of words, a third of it
new each time) is a query; all items whose score reaches a share of their own best possible score
are retrieved. Items are classed by length: the passages of a class are so long that a copy of any
of its items lies within one of them, wherever it begins. Items stand in blocks; a block keeps, for each term, the largest score that the term
adds to any of its items. A block whose largest scores, summed over the passage's terms, stay
below the threshold is skipped (block-max WAND), so nothing above the threshold is lost. Words
are runs of letters and digits, A-Z lower-cased. What is
retrieved is verified on the whole document: enough of the 5-word runs of the item's question and
of its answer must occur in it. An item without marked parts ends in its last sentence, which
counts as the answer.

The index is broadcast: sorted posting lists by block, and the table of largest scores, of terms by
64 blocks at most. Items beyond a bound of text bytes are split into groups by a hash, each with
an index of its own and a pass over the documents. Document frequencies and the mean length are those
of all items, so scores do not depend on the groups.

Defined cases: null and empty texts have no passages and match nothing; items without words are
skipped; equal items each match; IDs of any type, null too, are reported as they are; columns of other
names pass by unread; empty tables give no matches.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tonemill.llm import buffers
from tonemill.plans.materialize import materialize

K1, B = 1.2, 0.75
PASSAGE, STRIDE = 96, 32
THRESHOLD = 0.6
OVERLAP = 0.6
RUN = 5
BLOCK = 8
#: Text bytes of the items of one index.
INDEX_BYTES = 4 << 20


def _hashes(text: bytes) -> np.ndarray:
    data = np.frombuffer(text, np.uint8)
    starts, ends, _ = buffers.words(data, np.array([0, len(data)]), buffers.MARKS)
    return buffers.SpanHash(buffers.LOWER[data], 3).of(starts, ends)


def _runs(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words."""
    out = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for k in range(width):
        out = buffers.mix(out * np.uint64(0x9E3779B97F4A7C15) + words[k: k + len(out)])
    return out


def passage_words(n: int) -> int:
    """Least passage of ``PASSAGE`` words, or that doubled, that holds any ``n`` words whole."""
    passage, stride = PASSAGE, STRIDE
    while n > passage - stride + 1:
        passage, stride = 2 * passage, 2 * stride
    return passage


def question_and_answer(text: str) -> tuple[str, str]:
    """The text up to its last sentence, and that sentence; a single sentence is both."""
    breaks = [m.end() for m in re.finditer(r"[.!?\n]+\s+", text.rstrip())]
    return (text[: breaks[-1]], text[breaks[-1]:]) if breaks else (text, text)


class Index:
    """Impacts of each term on each item, scaled so that an item's own text scores 1.

    ``whole`` has the number and mean length of all items and their document frequencies by term, if
    ``items`` are one group of them.
    """

    def __init__(self, items: list[tuple], whole: tuple[int, float, dict[int, int]] | None = None):
        kept = [(i, t, w) for i, t in items if t and len(w := _hashes(t.encode()))]
        kept.sort(key=lambda item: passage_words(len(item[2])))
        self.ids = [i for i, _, _ in kept]
        self.parts = [[_hashes(p.encode()) for p in question_and_answer(t)] for _, t, _ in kept]
        n = len(kept)
        self.terms = np.unique(np.concatenate([w for _, _, w in kept])) if n else np.zeros(0, np.uint64)
        mean = sum(len(w) for _, _, w in kept) / max(1, n)
        own = [np.unique(w, return_counts=True) for _, _, w in kept]
        places = [np.searchsorted(self.terms, t) for t, _ in own]
        df, total = np.bincount(np.concatenate(places), minlength=len(self.terms)) if n else np.zeros(0), n
        if whole is not None:
            total, mean = whole[:2]
            df = np.array([whole[2][t] for t in self.terms.view(np.int64).tolist()], np.int64)
        idf = np.log(1 + (total - df + 0.5) / (df + 0.5))
        impacts = []
        for (_, tf), at, (_, _, w) in zip(own, places, kept):
            x = idf[at] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(w) / mean))
            impacts.append(x / x.sum())
        # Blocks grow with the items, so that their bounds stay a narrow table. A block has items
        # of one class; ``classes`` has the passage and the blocks of each.
        block = max(BLOCK, -(-n // 64))
        lengths = [passage_words(len(w)) for _, _, w in kept]
        members: list[range] = []
        self.classes: list[tuple[int, slice]] = []
        for passage in sorted(set(lengths)):
            a = lengths.index(passage)
            z, first = a + lengths.count(passage), len(members)
            members += [range(i, min(z, i + block)) for i in range(a, z, block)]
            self.classes.append((passage, slice(first, len(members))))
        self.bounds = np.zeros((len(self.terms) + 1, len(members)), np.float32)
        self.blocks = []
        for b, own_items in enumerate(members):
            term = np.concatenate([places[i] for i in own_items])
            item = np.repeat(np.arange(len(own_items)), [len(places[i]) for i in own_items])
            order = np.argsort(term, kind="stable")
            impact = np.concatenate([impacts[i] for i in own_items])[order].astype(np.float32)
            terms, first = np.unique(term[order], return_index=True)
            self.bounds[terms, b] = np.maximum.reduceat(impact, first)
            self.blocks.append((own_items, terms, np.append(first, len(term)), item[order], impact))

    @staticmethod
    def sorted_items(rows) -> list[tuple]:
        """Items in an order that does not depend on how they came."""
        return sorted(((r["id"], r["text"]) for r in rows), key=lambda x: (x[0] is None, str(x[0]), x[1]))

    def retrieve(self, row: np.ndarray, term: np.ndarray, threshold: float, blocks: slice):
        """``passage row, item, score`` at or above the threshold, for sorted (row, term)."""
        starts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if len(row) else []
        if not len(starts):
            return []
        ends = np.append(starts[1:], len(row))
        upper = np.add.reduceat(self.bounds[term, blocks], starts, axis=0)
        found = []
        for p, b in np.argwhere(upper >= threshold - 1e-5).tolist():
            items, terms, first, item, impact = self.blocks[blocks.start + b]
            asked = term[starts[p]: ends[p]]
            at = np.searchsorted(terms, asked)
            at[at == len(terms)] = 0
            at = at[terms[at] == asked]
            size = first[at + 1] - first[at]
            lists = np.arange(size.sum()) + np.repeat(first[at] - (np.cumsum(size) - size), size)
            scores = np.bincount(item[lists], weights=impact[lists], minlength=len(items))
            for c in np.flatnonzero(scores >= threshold - 1e-5).tolist():
                found.append((int(row[starts[p]]), items.start + c, float(scores[c])))
        return found

    def overlap(self, item: int, words: np.ndarray) -> list[float]:
        """Shares of the question's and the answer's runs that the document's words hold."""
        shares = []
        for part in self.parts[item]:
            width = min(RUN, len(part))
            runs = np.unique(_runs(part, width)) if width else np.zeros(0, np.uint64)
            shares.append(float(np.isin(runs, _runs(words, width)).mean()) if len(runs) else 1.0)
        return shares

    def matches(self, column: pa.Array, threshold: float, least: float):
        """``text, item, score, question, answer`` of the verified matches of a chunk."""
        data, offsets = buffers.utf8(column)
        starts, ends, rows = buffers.words(data, offsets, buffers.MARKS)
        if not len(starts) or not self.ids:
            return []
        words = buffers.SpanHash(buffers.LOWER[data], 3).of(starts, ends)
        term = np.searchsorted(self.terms, words)
        term[term == len(self.terms)] = 0
        known = self.terms[term] == words
        per_row = np.bincount(rows, minlength=len(column))
        first = np.cumsum(per_row) - per_row
        best: dict[tuple[int, int], float] = {}
        for length, blocks in self.classes:
            # Stride s of a text is part of the passages that begin at s, s - 1, ...
            steps, width = PASSAGE // STRIDE, length * STRIDE // PASSAGE
            stride = (np.arange(len(words)) - first[rows]) // width
            strides = -(-per_row // width)
            base = np.cumsum(strides) - strides
            text_of = np.repeat(np.arange(len(column)), strides)
            keys = []
            for back in range(steps):
                use = known & (stride >= back)
                keys.append((base[rows[use]] + stride[use] - back) * np.int64(len(self.terms))
                            + term[use])
            keys = np.sort(np.concatenate(keys))
            keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys
            for passage, item, score in self.retrieve(
                    keys // len(self.terms), keys % len(self.terms), threshold, blocks):
                key = (int(text_of[passage]), item)
                best[key] = max(score, best.get(key, 0.0))
        out = []
        for (r, item), score in sorted(best.items()):
            question, answer = self.overlap(item, words[first[r]: first[r] + per_row[r]])
            if question >= least and answer >= least:
                out.append((r, self.ids[item], score, question, answer))
        return out


def _item_terms(items: DataFrame) -> DataFrame:
    """``group, n, terms`` of each item with words: its number of words and its distinct terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [_hashes(t.encode()) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(w) for w in words], pa.int64()),
                 pa.array([np.unique(w).view(np.int64) for w in words], pa.list_(pa.int64()))],
                names=["group", "n", "terms"])

    return items.select("group", "text").mapInArrow(run, "group long, n long, terms array<long>").filter("n > 0")


def _indexes(items: DataFrame, key: str, text: str, index_bytes: int) -> Iterator[Index]:
    """Indexes of bounded groups of items; one group unless their texts pass the bound."""
    rows = items.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text")).filter(
        "text IS NOT NULL")
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    groups = max(1, -(-size // index_bytes))
    rows = rows.withColumn("group", F.pmod(F.xxhash64("id", "text"), F.lit(groups)))
    local = lambda own: Index.sorted_items(own.select("id", "text").toLocalIterator())
    if groups == 1:
        yield Index(local(rows))
        return
    terms = materialize(_item_terms(rows), "items")
    total, mean = terms.agg(F.count("*"), F.avg("n")).first()
    each = terms.select("group", F.explode("terms").alias("term"))
    df = materialize(each.groupBy("term").agg(F.count("*").alias("df")), "frequencies")
    for g in range(groups):
        own = each.filter(F.col("group") == g).select("term").distinct().join(df, "term")
        yield Index(local(rows.filter(F.col("group") == g)),
                    (total, mean, {r["term"]: r["df"] for r in own.toLocalIterator()}))


def find_leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
               item_key: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD,
               overlap: float = OVERLAP, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """``key, item_key, score, question_overlap, answer_overlap`` of each verified match."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    item_type = items.schema[item_key].dataType
    item_kind = item_type.simpleString()
    result = None
    for index in _indexes(items, item_key, item_text, index_bytes):
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for a, b in buffers.slices(batch.column(1)):
                    part = batch.slice(a, b - a)
                    found = sent.value.matches(part.column(1), threshold, overlap)
                    columns = list(zip(*found)) if found else [()] * 5
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(pa.array(columns[0], pa.int64())),
                         pa.array(columns[1], to_arrow_type(item_type)),
                         *(pa.array(c, pa.float64()) for c in columns[2:])],
                        ["key", "item", "score", "question", "answer"])

        one = rows.mapInArrow(run, f"key {kind}, item {item_kind}, score double, "
                                   "question double, answer double")
        result = one if result is None else result.union(one)
    return result.select(F.col("key").alias(key), F.col("item").alias(item_key), "score",
                         F.col("question").alias("question_overlap"),
                         F.col("answer").alias("answer_overlap"))


def without_leaks(docs: DataFrame, items: DataFrame, text: str = "text",
                  threshold: float = THRESHOLD, overlap: float = OVERLAP,
                  index_bytes: int = INDEX_BYTES, **names) -> DataFrame:
    """The rows of ``docs`` in which no item is found, as they are; no shuffle."""
    at = docs.columns.index(text)
    for index in _indexes(items, names.get("item_key", "item_id"),
                          names.get("item_text", "text"), index_bytes):
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for a, b in buffers.slices(batch.column(at)):
                    part = batch.slice(a, b - a)
                    keep = np.ones(len(part), bool)
                    keep[[m[0] for m in sent.value.matches(part.column(at), threshold, overlap)]
                         ] = False
                    yield part.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
