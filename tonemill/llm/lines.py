"""Drop lines that many documents share, through a sharded minimal perfect hash.

A line's key is the line without ASCII white space at both ends, A-Z lower-cased, as a 128-bit
hash. Keys are counted once per document, summed per chunk before the shuffle. The keys found in
enough documents are dealt to shards of bounded size; each shard builds a minimal perfect hash
(levels of bit arrays; a key that collides moves to the next level) that numbers its keys, and
arrays of their fingerprints and counts at those numbers. Documents probe the arrays: the number
of any line, then the fingerprint, which tells a key from a line that was never indexed.

The arrays are broadcast in groups of shards of a bounded number of bytes, which are counted first.
One group is the usual case; with more, the documents pass each group in turn, in written
tables, and collect the numbers of the lines that go.

Defined cases: a null or empty text is one empty line, which is never dropped (its key has no
characters); if all lines go, the text is empty; equal rows count as documents of their own;
other columns pass through, also such that are named like the new ones, which they give way to.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonemill.llm import buffers
from tonemill.llm.names import unused
from tonemill.plans.materialize import materialize

MIN_DOCS = 10
SHARD_KEYS = 1 << 16
BROADCAST_BYTES = 64 << 20
_LEVELS = 40
_GAMMA = 2


class Lines:
    """The lines of a chunk of texts: bounds, row and key hashes, in order."""

    def __init__(self, column: pa.Array):
        self.data, self.offsets = data, offsets = buffers.utf8(column)
        n = len(offsets) - 1
        breaks = np.flatnonzero(data == 10)
        self.per_row = np.bincount(buffers.rows_of(breaks, offsets), minlength=n) + 1
        self.first = np.cumsum(self.per_row) - self.per_row
        total = int(self.per_row.sum())
        self.rows = np.repeat(np.arange(n), self.per_row)
        opens = np.zeros(total, bool)
        opens[self.first] = True
        self.starts = np.empty(total, np.int64)
        self.starts[opens], self.starts[~opens] = offsets[:-1], breaks + 1
        closes = np.zeros(total, bool)
        closes[self.first + self.per_row - 1] = True
        self.ends = np.empty(total, np.int64)
        self.ends[closes], self.ends[~closes] = offsets[1:], breaks
        solid = np.flatnonzero(~buffers.SPACE[data])
        a = np.searchsorted(solid, self.starts)
        b = np.searchsorted(solid, self.ends)
        self.solid = b > a
        a, b = solid[a[self.solid]], solid[b[self.solid] - 1] + 1
        low = buffers.LOWER[data]
        self.key1 = np.zeros(total, np.uint64)
        self.key2 = np.zeros(total, np.uint64)
        self.key1[self.solid] = buffers.SpanHash(low, 1).of(a, b)
        self.key2[self.solid] = buffers.SpanHash(low, 2).of(a, b)


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def count_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys of each chunk with the number of its documents that hold them."""
    for batch in batches:
        for a, b in buffers.slices(batch.column(0), 4 * buffers.CHUNK_BYTES):
            lines = Lines(batch.column(0).slice(a, b - a))
            rows, k1, k2 = (x[lines.solid] for x in (lines.rows, lines.key1, lines.key2))
            order = np.lexsort((rows, k2, k1))
            rows, k1, k2 = rows[order], k1[order], k2[order]
            new_key = np.ones(len(k1), bool)
            new_key[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
            in_row = new_key.copy()
            in_row[1:] |= rows[1:] != rows[:-1]
            at = np.flatnonzero(new_key)
            n = np.add.reduceat(in_row.astype(np.int64), at) if len(at) else at
            yield pa.RecordBatch.from_arrays([_long(k1[at]), _long(k2[at]), pa.array(n)],
                                             ["key1", "key2", "n"])


def frequent_keys(docs: DataFrame, text: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """``key1, key2, n``: keys of the lines found in at least ``min_docs`` documents."""
    counted = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(
        count_keys, "key1 long, key2 long, n long")
    return counted.groupBy("key1", "key2").agg(F.sum("n").alias("n")).filter(
        F.col("n") >= min_docs)


def _slot(key: np.ndarray, level: int, bits: np.ndarray) -> np.ndarray:
    return (buffers.mix(key + np.uint64(level + 1) * np.uint64(0x632BE59BD9B4E019))
            % bits.astype(np.uint64)).astype(np.int64)


def build_index(key1: np.ndarray, key2: np.ndarray, n: np.ndarray) -> bytes:
    """One shard: bits of each level, fingerprints and counts by number, and keys left over."""
    both = buffers.mix(key1 + buffers.mix(key2))
    left = np.arange(len(both))
    bits, sizes, number = [], [], np.full(len(both), -1, np.int64)
    base = 0
    for level in range(_LEVELS):
        if not len(left):
            break
        words = max(1, -(-len(left) * _GAMMA // 64))
        at = _slot(both[left], level, np.full(len(left), words * 64))
        alone = np.bincount(at, minlength=words * 64) == 1
        packed = np.packbits(alone, bitorder="little").view(np.uint64)
        rank = np.cumsum(alone) - 1 + base
        placed = alone[at]
        number[left[placed]] = rank[at[placed]]
        base += int(alone.sum())
        bits.append(packed)
        sizes.append(words)
        left = left[~placed]
    # Keys whose combined hash is equal never part; they stand at the end, found by search.
    number[left] = base + np.arange(len(left))
    prints, counts = np.empty(len(both), np.uint64), np.empty(len(both), np.uint32)
    prints[number] = key2
    counts[number] = np.minimum(n, 2**32 - 1)
    out = io.BytesIO()
    np.savez(out, bits=np.concatenate(bits) if bits else np.zeros(0, np.uint64),
             sizes=np.array(sizes, np.int64), prints=prints, counts=counts,
             left=key1[left])
    return out.getvalue()


class Index:
    """All shards side by side, probed for many lines at once."""

    def __init__(self, shards: dict[int, bytes], n_shards: int):
        self.n_shards = n_shards
        loaded = {s: np.load(io.BytesIO(b)) for s, b in shards.items()}
        self.words = np.zeros((n_shards, _LEVELS), np.int64)
        self.base = np.zeros((n_shards, _LEVELS), np.int64)
        self.keys = np.zeros(n_shards, np.int64)
        bits, ranks, prints, counts, at, n = [], [], [], [], 0, 0
        self.left: dict[tuple[int, int], int] = {}
        for s in sorted(loaded):
            part = loaded[s]
            sizes = part["sizes"]
            self.words[s, : len(sizes)] = sizes
            self.base[s, : len(sizes)] = at + np.cumsum(sizes) - sizes
            ones = np.bitwise_count(part["bits"]).astype(np.int64)
            ranks.append(np.cumsum(ones) - ones + n)
            bits.append(part["bits"])
            prints.append(part["prints"])
            counts.append(part["counts"])
            at += int(sizes.sum())
            for i, key in enumerate(part["left"].tolist()):
                j = len(part["prints"]) - len(part["left"]) + i
                self.left[key, int(part["prints"][j])] = n + j
            n += len(part["prints"])
        self.bits, self.ranks, self.prints, self.counts = (
            np.concatenate(x) if x else np.zeros(0, np.uint64)
            for x in (bits, ranks, prints, counts))

    def count(self, key1: np.ndarray, key2: np.ndarray) -> np.ndarray:
        """Documents that hold each key, 0 for a key that is not indexed."""
        found = np.zeros(len(key1), np.int64)
        if not len(self.prints):
            return found
        both = buffers.mix(key1 + buffers.mix(key2))
        shard = (key1 % np.uint64(self.n_shards)).astype(np.int64)
        todo = np.arange(len(key1))
        for level in range(_LEVELS):
            todo = todo[self.words[shard[todo], level] > 0]
            if not len(todo):
                break
            s = shard[todo]
            bit = _slot(both[todo], level, self.words[s, level] * 64)
            word = self.base[s, level] + (bit >> 6)
            low = (bit & 63).astype(np.uint64)
            own = self.bits[word]
            there = (own >> low) & np.uint64(1) == 1
            at = todo[there]
            below = own[there] & ((np.uint64(1) << low[there]) - np.uint64(1))
            number = self.ranks[word[there]].astype(np.int64) + np.bitwise_count(below)
            same = self.prints[number] == key2[at]
            found[at[same]] = self.counts[number[same]]
            todo = todo[~there]
        for i in todo.tolist() if self.left else ():
            j = self.left.get((int(key1[i]), int(key2[i])))
            found[i] = 0 if j is None else self.counts[j]
        if self.left:
            for i in np.flatnonzero(found == 0).tolist():
                j = self.left.get((int(key1[i]), int(key2[i])))
                if j is not None:
                    found[i] = self.counts[j]
        return found


def index_shards(keys: DataFrame, n_shards: int) -> DataFrame:
    """``shard, index``: the arrays of each shard, built where its keys meet."""
    def build(table: pa.Table) -> pa.Table:
        k1, k2, n = (table.column(c).combine_chunks().to_numpy(zero_copy_only=False)
                     for c in ("key1", "key2", "n"))
        index = build_index(k1.view(np.uint64), k2.view(np.uint64), n)
        return pa.table({"shard": table.column("shard").slice(0, 1),
                         "index": pa.array([index], pa.binary())})

    # Keys are unsigned to the hash and signed to Spark; 2**64 mod n corrects negative ones.
    wrap = pow(2, 64, n_shards)
    shard = F.pmod(F.pmod("key1", F.lit(n_shards)) + F.when(F.col("key1") < 0, wrap).otherwise(0),
                   F.lit(n_shards)).cast("int")
    return keys.withColumn("shard", shard).groupBy("shard").applyInArrow(
        build, "shard int, index binary")


def _without(column: pa.Array, lines: Lines, drop: np.ndarray) -> pa.Array:
    """The texts without the marked lines; texts that lose none stay as they are, null too."""
    hit = np.unique(lines.rows[drop]).tolist()
    if not hit:
        return column
    texts = column.to_pylist()
    raw = lines.data.tobytes()
    keep = ~drop
    for r in hit:
        own = slice(lines.first[r], lines.first[r] + lines.per_row[r])
        k = keep[own]
        texts[r] = b"\n".join(raw[a:b] for a, b in zip(
            lines.starts[own][k].tolist(), lines.ends[own][k].tolist())).decode()
    return pa.array(texts, column.type)


def drop_lines(docs: DataFrame, text: str = "text", min_docs: int = MIN_DOCS,
               shard_keys: int = SHARD_KEYS, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``docs`` without their frequent lines, with ``n_lines`` (before) and ``n_dropped``."""
    spark = docs.sparkSession
    keys = materialize(frequent_keys(docs, text, min_docs), "lines")
    n_shards = max(1, -(-keys.count() // shard_keys))
    shards = materialize(index_shards(keys, n_shards), "shards")
    groups = _groups(shards, broadcast_bytes)
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    at, gone = names.index(text), unused(names, "gone")
    docs = docs.select(*[F.col(f"`{c}`").cast("string").alias(c) if c == text else f"`{c}`" for c in names],
                       F.array().cast("array<int>").alias(gone))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields[:-1])

    def parts(batches, sent):
        """Chunks of rows with their lines and what of these goes, by this group or one before."""
        index = Index(sent.value, n_shards)
        for batch in batches:
            for a, b in buffers.slices(batch.column(at), 4 * buffers.CHUNK_BYTES):
                part = batch.slice(a, b - a)
                lines, before = Lines(part.column(at)), part.column(len(names))
                drop = lines.solid & (index.count(lines.key1, lines.key2) >= min_docs)
                sizes = before.value_lengths().to_numpy(zero_copy_only=False)
                drop[np.repeat(lines.first, sizes) + before.flatten().to_numpy(zero_copy_only=False)] = True
                yield part, lines, drop

    for i, group in enumerate(groups):
        sent = spark.sparkContext.broadcast({r["shard"]: bytes(r["index"]) for r in shards.filter(
            F.col("shard").isin(group)).toLocalIterator()})

        def mark(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for part, lines, drop in parts(batches, sent):
                found = np.bincount(lines.rows[drop], minlength=len(part))
                place = np.flatnonzero(drop) - np.repeat(lines.first, found)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(found)]).astype(np.int32)),
                    pa.array(place.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], lists], [*names, gone])

        def remove(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for part, lines, drop in parts(batches, sent):
                dropped = np.bincount(lines.rows[drop], minlength=len(part))
                columns = [*part.columns[:-1], pa.array(lines.per_row), pa.array(dropped)]
                columns[at] = _without(part.column(at), lines, drop)
                yield pa.RecordBatch.from_arrays(columns, [*names, "n_lines", "n_dropped"])

        if i == len(groups) - 1:
            return docs.mapInArrow(remove, f"{schema}, n_lines long, n_dropped long")
        docs = materialize(docs.mapInArrow(mark, f"{schema}, `{gone}` array<int>"), "marked")


def _groups(shards: DataFrame, most: int) -> list[list[int]]:
    """Shards by number in groups of ``most`` bytes, or of one shard; one group at least."""
    groups, held = [[]], 0
    for r in shards.select("shard", F.length("index").alias("size")).orderBy("shard").collect():
        if groups[-1] and held + r["size"] > most:
            groups.append([])
            held = 0
        groups[-1].append(r["shard"])
        held += r["size"]
    return groups
