"""Near-duplicate groups: banded MinHash candidates, Odd-sketch filter, exact confirmation.

Each document is a set of word shingles. Documents with the same set form a class; only one
document of a class goes on. Its MinHash samples are banded into buckets, and folded into an Odd
sketch: bit ``h(i, sample i)`` is flipped for every sample, so the population count of the XOR of
two sketches tells how many samples differ, most sharply at high similarity. Candidates whose
estimate is far below the wanted similarity are dropped; the rest is confirmed on full sets.

A bucket is not expanded into pairs. Its members first meet its most central member, the one
that shares the most buckets with others. Components of the confirmed links are found, and only
members of different components meet again: those outside a bucket's largest component meet all
its members of another component, in the first bucket that the two share, and only a pair that
its sketches let through leaves the join. So no link that could join two components is left out.

The miss rate is that of banding, ``(1 - s ** rows) ** bands``: 5e-8 for one pair at 0.8 with the
default 32 bands of 4. Sketches fold 1,024 samples into 2,048 bits, which gives the similarity to
0.016; estimates of 0.71 and more go on to confirmation, over five standard deviations below 0.8.

Defined cases: a text without words (null, empty) has no shingles and no links, and is its own
component; a null ID takes no part, its component is null and it is kept; rows that repeat an ID
are one document with several texts, and link what those texts link; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonemill.llm import buffers
from tonemill.llm.components import components
from tonemill.plans.materialize import materialize

BITS = 2048
_WORDS = BITS // 64
SKETCH = [f"s{i}" for i in range(_WORDS)]


@dataclass(frozen=True)
class NearDup:
    width: int = 5
    #: Links hold ``denominator * intersection >= numerator * union``.
    numerator: int = 80
    denominator: int = 100
    bands: int = 32
    rows: int = 4
    #: MinHash samples folded into a sketch.
    samples: int = 1024
    #: Sketch estimates below this are no candidates.
    least_estimate: float = 0.71


_rng = np.random.default_rng(20240229)
_MULTIPLY = _rng.integers(0, 2**32, 4096, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_ADD = _rng.integers(0, 2**32, 4096, dtype=np.uint64).astype(np.uint32)


def _min_samples(hashes: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """``n`` MinHash samples of each non-empty set."""
    base = (hashes >> np.uint64(32)).astype(np.uint32)
    starts = offsets[:-1][offsets[:-1] < offsets[1:]]
    out = np.empty((len(starts), n), np.uint32)
    work = np.empty_like(base)
    for j in range(n):
        np.multiply(base, _MULTIPLY[j], out=work)
        np.add(work, _ADD[j], out=work)
        out[:, j] = np.minimum.reduceat(work, starts)
    return out


def _odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parity bits of the samples, as 64-bit words."""
    n = samples.shape[1]
    marked = buffers.mix(samples.astype(np.uint64) + (np.arange(n, dtype=np.uint64) << np.uint64(32)))
    bit = (marked % np.uint64(BITS)).astype(np.int64)
    flat = np.bincount((np.arange(len(samples))[:, None] * BITS + bit).ravel(),
                       minlength=len(samples) * BITS) & 1
    packed = np.packbits(flat.astype(bool).reshape(len(samples), BITS), axis=1, bitorder="little")
    return packed.view(np.uint64)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def signatures(docs: DataFrame, p: NearDup) -> DataFrame:
    """``key, n_shingles, set1, set2, bands`` for ``key, text``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in buffers.slices(batch.column(1)):
                data, offsets = buffers.utf8(batch.column(1).slice(a, b - a))
                n = b - a
                hashes, bounds = buffers.distinct_sorted(
                    *buffers.shingles(data, offsets, p.width), n)
                size = np.diff(bounds)
                full = np.flatnonzero(size)
                sums = np.zeros((2, n), np.uint64)
                keys = np.zeros((len(full), p.bands), np.uint64)
                if len(full):
                    starts = bounds[:-1][full]
                    sums[0, full] = np.add.reduceat(buffers.mix(hashes + np.uint64(1)), starts)
                    sums[1, full] = np.add.reduceat(buffers.mix(hashes + np.uint64(2)), starts)
                    samples = _min_samples(hashes, bounds, p.bands * p.rows)
                    for band in range(p.bands):
                        key = np.full(len(full), band + 1, np.uint64)
                        for j in range(band * p.rows, (band + 1) * p.rows):
                            key = buffers.mix(key * np.uint64(31) + samples[:, j])
                        keys[:, band] = key
                counts = np.zeros(n, np.int32)
                counts[full] = p.bands
                ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(size.astype(np.int64)),
                     _signed(sums[0]), _signed(sums[1]),
                     pa.ListArray.from_arrays(pa.array(ends), _signed(keys.ravel()))],
                    ["key", "n_shingles", "set1", "set2", "bands"])

    kind = docs.schema["key"].dataType.simpleString()
    return docs.select("key", "text").mapInArrow(
        run, f"key {kind}, n_shingles long, set1 long, set2 long, bands array<long>")


def sketched_sets(docs: DataFrame, p: NearDup) -> DataFrame:
    """``key, shingles, s0..``: sorted shingle hashes of each text as bytes, and their sketch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in buffers.slices(batch.column(1)):
                data, offsets = buffers.utf8(batch.column(1).slice(a, b - a))
                hashes, bounds = buffers.distinct_sorted(
                    *buffers.shingles(data, offsets, p.width), b - a)
                full = np.flatnonzero(np.diff(bounds))
                sketch = (_odd_sketch(_min_samples(hashes, bounds, p.samples)) if len(full)
                          else np.zeros((0, _WORDS), np.uint64))
                raw, cut = hashes.tobytes(), (bounds * 8).tolist()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a).take(pa.array(full)),
                     pa.array([raw[cut[i]:cut[i + 1]] for i in full.tolist()], pa.binary()),
                     *(_signed(sketch[:, i]) for i in range(_WORDS))],
                    ["key", "shingles", *SKETCH])

    kind = docs.schema["key"].dataType.simpleString()
    sketch = ", ".join(f"{s} long" for s in SKETCH)
    return docs.select("key", "text").mapInArrow(
        run, f"key {kind}, shingles binary, {sketch}")


def _likely(a: str, b: str, p: NearDup) -> Column:
    """Whether the sketches in columns ``a_s0..`` and ``b_s0..`` let the pair through."""
    flips = 2 * p.samples * (1 - p.least_estimate)
    most = int(BITS / 2 * (1 - np.exp(-2 * flips / BITS)))
    return sum(F.bit_count(F.col(f"{a}_{s}").bitwiseXOR(F.col(f"{b}_{s}"))) for s in SKETCH) <= most


def _renamed(rows: DataFrame, side: str, *columns: str) -> DataFrame:
    return rows.select(*[F.col(c).alias(f"{side}_{c}") for c in (*columns, *SKETCH)])


def confirmed(pairs: DataFrame, sets: DataFrame, p: NearDup) -> DataFrame:
    """Those of ``pairs (a, b)`` whose full sets are as similar as wanted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                one = np.frombuffer(x.as_buffer(), np.uint64)
                two = np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(p.denominator * both >= p.numerator * (len(one) + len(two) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    kind = pairs.schema["a"].dataType.simpleString()
    loaded = (pairs.join(sets.select(F.col("key").alias("b"), F.col("shingles").alias("y")), "b")
              .join(sets.select(F.col("key").alias("a"), F.col("shingles").alias("x")), "a")
              .select("a", "b", "x", "y"))
    return loaded.mapInArrow(run, f"a {kind}, b {kind}").distinct()


def central_pairs(members: DataFrame, sets: DataFrame, p: NearDup) -> DataFrame:
    """Likely pairs of each bucket's members with its most central one."""
    weight = members.groupBy("key").agg(F.sum("n").alias("w"))
    heads = members.join(materialize(weight, "weights"), "key").groupBy("bucket").agg(
        F.max(F.struct("w", "key"))["key"].alias("head"))
    pairs = members.join(materialize(heads, "heads"), "bucket").filter("key <> head").select(
        F.least("key", "head").alias("a_key"), F.greatest("key", "head").alias("b_key")).distinct()
    return (pairs.join(_renamed(sets, "b", "key"), "b_key").join(_renamed(sets, "a", "key"), "a_key")
            .filter(_likely("a", "b", p))
            .select(F.col("a_key").alias("a"), F.col("b_key").alias("b")))


def remaining_pairs(members: DataFrame, comps: DataFrame, sets: DataFrame, firsts: DataFrame,
                    p: NearDup) -> DataFrame:
    """Likely pairs of different components that share a bucket, each once."""
    named = comps.select(F.col("node").alias("key"), "component")
    rows = materialize(members.join(named, "key", "left").select(
        "bucket", "key", F.coalesce("component", "key").alias("comp")), "labelled")
    sizes = rows.groupBy("bucket", "comp").agg(F.count("*").alias("n"))
    mains = sizes.groupBy("bucket").agg(
        F.max(F.struct("n", "comp"))["comp"].alias("main"), F.count("*").alias("comps"),
    ).filter("comps > 1").select("bucket", "main")
    open_rows = rows.join(materialize(mains, "mains"), "bucket")
    known = sets.select("key", *SKETCH).join(firsts.select("key", "bands"), "key")
    open_rows = materialize(open_rows.join(materialize(known, "known"), "key"), "open")
    columns = ("key", "comp", "main", "bands")
    few = _renamed(open_rows.filter("comp <> main"), "a", *columns, "bucket")
    all_rows = _renamed(open_rows, "b", *columns, "bucket")
    # Two that are both outside the main component would meet from either side.
    once = (F.col("b_comp") == F.col("b_main")) | (F.col("a_key") < F.col("b_key"))
    shared = F.get(F.array_intersect("a_bands", "b_bands"), F.lit(0))
    return few.join(
        all_rows, (F.col("a_bucket") == F.col("b_bucket")) & (F.col("a_comp") != F.col("b_comp"))
        & once & _likely("a", "b", p) & (shared == F.col("a_bucket")),
    ).select(F.col("a_key").alias("a"), F.col("b_key").alias("b"))


def near_duplicates(docs: DataFrame, p: NearDup | None = None, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """``key, n_shingles, component_id, kept``: one row per row of ``docs``.

    ``component_id`` is the least ID that links reach; the document that has it is kept.
    """
    p = p or NearDup()
    docs = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    every = materialize(signatures(docs, p), "signatures")
    linked = every.filter("key IS NOT NULL AND n_shingles > 0")
    identity = ["set1", "set2", "n_shingles"]
    classes = materialize(linked.groupBy(*identity).agg(F.min("key").alias("first")), "classes")
    firsts = materialize(
        linked.join(classes, [linked[c] == classes[c] for c in identity]
                    + [linked["key"] == classes["first"]], "left_semi")
        .select("key", "bands"), "firsts")
    buckets = firsts.select("key", F.explode("bands").alias("bucket"))
    shared = materialize(
        buckets.groupBy("bucket").agg(F.min("key").alias("low"), F.max("key").alias("high"),
                                      F.count("*").alias("n"))
        .filter("low <> high").select("bucket", "n"), "buckets")
    members = materialize(buckets.join(shared, "bucket").select("bucket", "key", "n"), "members")
    wanted = materialize(members.select("key").distinct(), "wanted")
    sets = materialize(sketched_sets(docs.join(wanted, "key", "left_semi"), p), "sets")
    # An ID that stands on several texts links the classes of them all.
    several = linked.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    links = (
        linked.join(several, "key").select("key", *identity).join(classes, identity)
        .select(F.col("key").alias("a"), F.col("first").alias("b")).filter("a <> b"))
    found = confirmed(central_pairs(members, sets, p), sets, p)
    comps = components(links.union(found))
    stars = comps.select(F.col("node").alias("a"), F.col("component").alias("b"))
    found = confirmed(remaining_pairs(members, comps, sets, firsts, p), sets, p)
    comps = components(stars.union(found))
    named = classes.join(comps, classes["first"] == comps["node"], "left").select(
        *identity, F.coalesce("component", "first").alias("component"))
    result = every.select("key", *identity).join(materialize(named, "named"), identity, "left")
    component = F.when(F.col("key").isNotNull(), F.coalesce("component", "key"))
    return result.select(
        F.col("key").alias(key), "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("key") == component, F.lit(True)).alias("kept"))
