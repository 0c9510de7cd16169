"""Remove byte strings that occur twice, by interval expansion on a Burrows-Wheeler transform.

A byte goes if any string of ``length`` bytes that covers it also starts elsewhere, in the same
document or another. Four steps:

1. Anchors. Of every window of ``length - GRAM + 1`` consecutive grams the least by hash is an
   anchor (ties all), so two occurrences of one ``length``-byte string hold the same anchor at
   the same place. An anchor's stretch is all bytes that such strings around it can cover.
2. Anchors that occur once are done: nothing around them repeats. Where all stretches of an anchor
   are equal, all their bytes repeat.
3. The rest are anchors with different stretches. A string of ``length`` bytes holds either the
   core that reaches half the way to the left of its anchor or the one that reaches half to the
   right; a stretch that shares neither with another stretch of its anchor repeats nothing.
   What is left meets in shards of bounded size, one copy of each distinct stretch. All strings in
   question hold their anchor, so its gram is one symbol there, of its own for each gram, and a
   string has ``length - GRAM + 1`` symbols. The stretches' suffixes are sorted to as many; backward
   extension on the transform derives the common prefixes of neighbouring suffixes by increasing
   value, all strings of one length before the next, and stops there. Neighbours without
   a value by then share a whole string. Equal strings hold one gram at one place, and a stretch
   holds its gram once, which keeps a string from being its own repeat.
   An anchor with more stretches than a shard may hold has its strings counted by 128-bit hash in
   a shuffle with partial sums instead, many of one stretch at a time.
4. Each text gets the stretches of its anchors back and drops what repeats.

Defined cases: null reads as empty; texts shorter than ``length`` lose nothing; equal rows each
count as an occurrence, so both lose all repeated bytes; an empty table gives no rows; columns
named like the new ones give way to them, all others pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonemill.llm import buffers
from tonemill.llm.names import unused
from tonemill.plans.materialize import materialize

LENGTH = 400
GRAM = 256
#: Stretches of one anchor that a shard takes; anchors with more are counted by hash.
MOST_STRETCHES = 2000
SHARD_BYTES = 1 << 18
#: Tables of up to so many rows are sent to all executors instead of shuffling the other side.
BROADCAST_ROWS = 2_000_000


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over each full window, from running values of two blocks."""
    n = len(x)
    fill = np.uint64(2**64 - 1) if pick is np.minimum else np.uint64(0)
    padded = np.full(-(-n // width) * width, fill, np.uint64)
    padded[:n] = x
    rows = padded.reshape(-1, width)
    ahead = pick.accumulate(rows, axis=1).ravel()
    behind = pick.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(behind[: n - width + 1], ahead[width - 1: n])


def anchors(hashes: np.ndarray, width: int) -> np.ndarray:
    """Places that are least in some window of ``width``: where opening changes nothing."""
    if len(hashes) < width:
        return np.zeros(0, np.int64)
    low = _sliding(hashes, width, np.minimum)
    pad = np.zeros(width - 1, np.uint64)
    return np.flatnonzero(_sliding(np.concatenate([pad, low, pad]), width, np.maximum) == hashes)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _text_keys(text) -> list:
    return [F.xxhash64(F.lit(1), text).alias("k1"), F.xxhash64(F.lit(2), text).alias("k2")]


def stretches(docs: DataFrame, length: int) -> DataFrame:
    """Every anchor: text ``k1, k2``, place ``at``, gram ``g``, and its stretch: ``before`` bytes
    ahead of the anchor, ``size`` in all, hash ``s`` (with ``g``, 128 bits tell stretches apart).
    ``left`` and ``right`` are hashes of its cores, null where the text ends before."""
    back = (length - GRAM + 1) // 2
    ahead = length - GRAM - back + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in buffers.slices(batch.column(2)):
                data, offsets = buffers.utf8(batch.column(2).slice(a, b - a))
                one = buffers.SpanHash(data, 11)
                two = buffers.SpanHash(data, 12)
                grams = np.arange(max(0, len(data) - GRAM + 1))
                hashes = one.of(grams, grams + GRAM)
                rows, at = [], []
                for r in np.flatnonzero(np.diff(offsets) >= length).tolist():
                    own = hashes[offsets[r]: offsets[r + 1] - GRAM + 1]
                    place = anchors(own, length - GRAM + 1) + offsets[r]
                    at.append(place)
                    rows.append(np.full(len(place), r))
                at = np.concatenate(at) if at else np.zeros(0, np.int64)
                rows = np.concatenate(rows) if rows else np.zeros(0, np.int64)
                start = np.maximum(offsets[rows], at - (length - GRAM))
                end = np.minimum(offsets[rows + 1], at + length)
                shape = ((at - start) * 4096 + (end - start)).astype(np.uint64)
                low, high = at - back, at + GRAM + ahead
                left = one.of(np.maximum(low, start), at + GRAM)
                right = two.of(at, np.minimum(high, end))
                take = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a).take(take),
                     batch.column(1).slice(a, b - a).take(take),
                     pa.array((at - offsets[rows]).astype(np.int32)), _signed(hashes[at]),
                     pa.array((at - start).astype(np.int32)),
                     pa.array((end - start).astype(np.int32)),
                     _signed(buffers.mix(two.of(start, end) + shape)),
                     pa.array(left.view(np.int64), mask=low < start),
                     pa.array(right.view(np.int64), mask=high > end)],
                    ["k1", "k2", "at", "g", "before", "size", "s", "left", "right"])

    return docs.select("k1", "k2", "text").mapInArrow(
        run, "k1 long, k2 long, at int, g long, before int, size int, s long, left long, right long")


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by their first ``depth`` symbols or more, by doubling."""
    n, bits = len(text), int(text.max()).bit_length()
    have = 63 // bits
    key = np.zeros(n, np.int64)  # as many symbols as it holds
    for j in range(min(have, n)):
        key[: n - j] |= text[j:] << np.int64(bits * (have - 1 - j))
    order = np.argsort(key)
    ordered = key[order]
    rank = np.empty(n, np.int64)
    rank[order] = np.cumsum(np.concatenate([[False], ordered[1:] != ordered[:-1]]))
    while have < depth and rank[order[-1]] < n - 1:
        ahead = np.zeros(n, np.int64)
        ahead[: max(0, n - have)] = rank[have:] + 1
        key = rank * np.int64(n + 1) + ahead
        order = np.argsort(key)
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[False], ordered[1:] != ordered[:-1]]))
        have *= 2
    return order


def long_neighbours(text: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Whether each sorted suffix shares ``length`` symbols with the one before it.

    Intervals of suffixes that begin with one string are extended backwards by each symbol that
    stands before it. The interval of an extended string ends where common prefixes of that
    string's length end; the first string to find such an end sets its value.
    """
    n, n_symbols = len(text), int(text.max()) + 1
    kind = np.int32 if n * n_symbols < 2**31 else np.int64
    before = text[order - 1].astype(kind)
    by_symbol = np.argsort(before.astype(np.min_scalar_type(n_symbols)), kind="stable")
    moved = np.empty(n, kind)  # where the suffix lies that is longer by one
    moved[by_symbol] = np.arange(n, dtype=kind)
    unset = np.ones(n + 1, bool)
    unset[0] = unset[n] = False
    # Runs of equal symbols in the transform move as one.
    first = np.flatnonzero(np.concatenate([[True], before[1:] != before[:-1]])).astype(kind)
    run_of = np.repeat(np.arange(len(first), dtype=kind), np.diff(first, append=kind(n)))
    first = np.append(first, kind(n))
    # Strings of no symbols: one interval, all suffixes.
    low, high = np.array([0], kind), np.array([n], kind)
    for _ in range(length):
        head, runs = run_of[low], run_of[high - 1] - run_of[low] + 1
        same = runs == 1
        next_low = moved[low[same]]
        next_high = next_low + (high - low)[same]
        if not same.all():
            low, high, head, runs = (x[~same] for x in (low, high, head, runs))
            ends = np.cumsum(runs, dtype=kind)
            of = np.repeat(np.arange(len(low), dtype=kind), runs)
            run = np.arange(ends[-1], dtype=kind) + (head - (ends - runs))[of]
            place = np.maximum(first[run], low[of])
            key = of * kind(n_symbols) + before[place]
            by = np.argsort(key)
            key, place, run, of = key[by], place[by], run[by], of[by]
            new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            # Runs of one interval and symbol move side by side, to where the least place moves.
            sizes = np.minimum(first[run + 1], high[of]) - place
            begin = np.minimum.reduceat(moved[place], new)
            next_low = np.concatenate([next_low, begin])
            next_high = np.concatenate([next_high, begin + np.add.reduceat(sizes, new)])
        fresh = unset[next_high]
        unset[next_high[fresh]] = False
        low, high = next_low[fresh], next_high[fresh]
        if not len(low):
            break
    return unset[:n]


def _flat(stretches: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """Their bytes end to end, and where each begins and ends."""
    stretches = stretches.cast(pa.binary())
    _, offsets, data = stretches.buffers()
    offsets = np.frombuffer(offsets, np.int32)[stretches.offset: stretches.offset + len(stretches) + 1]
    return (np.frombuffer(data, np.uint8)[offsets[0]: offsets[-1]] if data else np.zeros(0, np.uint8),
            offsets.astype(np.int64) - offsets[0])


def symbols(stretches: pa.BinaryArray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches end to end with 0 after each, and how many symbols each has. Bytes are 1 to
    256; the gram that follows the first ``before`` bytes is one symbol, the same for equal grams."""
    data, offsets = _flat(stretches)
    raw = data.tobytes()
    number: dict[bytes, int] = {}
    grams = np.array([number.setdefault(raw[a: a + GRAM], 257 + len(number))
                      for a in (offsets[:-1] + before).tolist()], np.int64)
    bytes_of = np.diff(offsets)
    part = np.repeat(np.arange(len(bytes_of)), bytes_of)
    place = np.arange(len(part)) - offsets[part]
    value = data.astype(np.int64) + 1
    at_gram = place == before[part]
    value[at_gram] = grams
    keep = at_gram | (place < before[part]) | (place >= before[part] + GRAM)
    sizes = bytes_of - GRAM + 1
    text = np.zeros(int(sizes.sum()) + len(sizes), np.int64)
    text[np.arange(int(sizes.sum())) + part[keep]] = value[keep]
    return text, sizes


def repeated_places(text: np.ndarray, sizes: np.ndarray, length: int
                    ) -> tuple[np.ndarray, np.ndarray]:
    """Part and place in it of every string of ``length`` symbols that starts at two places or
    more; the parts have ``sizes`` symbols and a 0 after each."""
    starts = np.cumsum(sizes + 1) - sizes - 1
    order = suffix_order(text, length)
    near = long_neighbours(text, order, length)
    shared = near.copy()
    shared[:-1] |= near[1:]
    at = np.sort(order[shared])
    part = np.searchsorted(starts, at, "right") - 1
    inside = at - starts[part] + length <= sizes[part]
    return part[inside], (at - starts[part])[inside]


def _merged(places: np.ndarray, length: int) -> list[int]:
    """Starts and ends of the union of ``[p, p + length)``, flat; places rise."""
    cut = np.flatnonzero(np.diff(places) > length)
    first = places[np.concatenate([[0], cut + 1])]
    last = places[np.concatenate([cut, [len(places) - 1]])] + length
    return np.stack([first, last], axis=1).ravel().tolist()


def _in_shards(rows: DataFrame, length: int) -> DataFrame:
    """``g, s, ranges`` for ``shard, g, s, before, n, bytes``, without stretches found twice, which
    repeat by themselves; ranges are counted from the anchor."""
    def run(table: pa.Table) -> pa.Table:
        parts, before = table.column("bytes").combine_chunks(), table.column("before").to_numpy()
        # Strings of so many symbols hold the gram, as neither side of a stretch is as long, so
        # places to the left of it are those of bytes.
        part, place = repeated_places(*symbols(parts, before), length - GRAM + 1)
        alone = (table.column("n").to_numpy() == 1)[part]
        part, place = part[alone], place[alone]
        found: list[list[int]] = [[] for _ in parts]
        if len(part):
            for own, places in zip(part[np.flatnonzero(np.diff(part, prepend=-1))].tolist(),
                                   np.split(place, np.flatnonzero(np.diff(part)) + 1)):
                found[own] = _merged(places - before[own], length)
        return pa.table({"g": table.column("g"), "s": table.column("s"),
                         "ranges": pa.array(found, pa.list_(pa.int32()))})

    return rows.groupBy("shard").applyInArrow(run, "g long, s long, ranges array<int>")


def _by_hash(rows: DataFrame, twice: DataFrame, length: int, pieces: int = 3) -> DataFrame:
    """The same for anchors with very many stretches: their strings are counted by hash.

    The strings of a stretch, by the anchor's place in them, are cut into ``pieces``, those again,
    and so on. All strings of a piece share a core and lie within a window. If no other stretch has
    the core, none of them repeats; if another has the window, all do. Only what is between is cut
    on, for one stretch of each window, which stands for all that have it. ``twice`` has the ranges
    ``a`` to ``b`` of stretches that repeat as a whole.
    """
    def parted(step: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            most_rows = buffers.CHUNK_BYTES // (2 * length)
            for batch in (x.slice(i, most_rows) for x in batches for i in range(0, len(x), most_rows)):
                data, offsets = _flat(batch.column(3))
                row = np.repeat(np.arange(len(batch)), batch.column(4).value_lengths().to_numpy())
                low, high, n = (x.to_numpy() for x in batch.column(4).flatten().flatten())
                count = -(-(high - low + 1) // step)
                piece = np.repeat(np.arange(len(row)), count)
                row, end, n = row[piece], high[piece], n[piece]
                low = low[piece] + step * (np.arange(len(piece)) - np.repeat(np.cumsum(count) - count, count))
                high = np.minimum(low + step - 1, end)
                # Places of the anchor in those strings that lie in the text.
                most = batch.column(2).to_numpy()[row]
                least = most + length - np.diff(offsets)[row]
                keep = np.maximum(low, least) <= np.minimum(high, most)
                row, low, high, n, most, least = (x[keep] for x in (row, low, high, n, most, least))
                start, stop = offsets[row], offsets[row + 1]
                at = start + most
                cores = at - low, at - high + length
                windows = np.maximum(at - high, start), np.minimum(at - low + length, stop)
                past = (low < least) | (high > most)  # such a window is no other's
                one, two = (buffers.SpanHash(data, x) for x in (13, 14))
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(take) for c in (0, 1)),
                     *(pa.array(x.astype(np.int32)) for x in (low, high)), pa.array(n),
                     _signed(one.of(*cores)), _signed(two.of(*cores)),
                     pa.array(one.of(*windows).view(np.int64), mask=past),
                     pa.array(two.of(*windows).view(np.int64), mask=past)],
                    ["g", "s", "low", "high", "n", "c1", "c2", "w1", "w2"])
        return run

    # Strings with a core to one side, as far as that core was found twice.
    back = (length - GRAM + 1) // 2
    half = lambda low, high: F.struct(F.lit(low).alias("low"), F.lit(high).alias("high"), "n")
    wanted = rows.select("g", "s", "before", "bytes", F.array_compact(F.array(
        F.when(F.col("sides").bitwiseAND(1) > 0, half(0, back - 1)),
        F.when(F.col("sides").bitwiseAND(2) > 0, half(back, length - GRAM)))).alias("pieces"))
    step, found = length - GRAM - back + 1, [twice]
    while step > 1:
        step = -(-step // pieces)
        every = materialize(wanted.mapInArrow(
            parted(step), "g long, s long, low int, high int, n long, "
            "c1 long, c2 long, w1 long, w2 long"), "pieces")
        core, window = ["g", "low", "c1", "c2"], ["g", "low", "w1", "w2"]
        cores = every.groupBy(*core).agg(F.sum("n").alias("in_core")).filter("in_core > 1")
        windows = every.filter("w1 IS NOT NULL").groupBy(*window).agg(
            F.sum("n").alias("in_window"), F.min("s").alias("first")).filter("in_window > 1")
        met = materialize(every.join(cores, core).join(windows, window, "left").select(
            "g", "s", "low", "high", "in_core", "in_window", "first",
            F.coalesce("in_window", "n").alias("n")), "met")
        found.append(met.filter("in_window > 1").select(
            "g", "s", (-F.col("high")).alias("a"), (length - F.col("low")).alias("b")))
        left = met.filter("in_core > n AND (first IS NULL OR first = s)").groupBy("g", "s").agg(
            F.collect_list(F.struct("low", "high", "n")).alias("pieces"))
        wanted = rows.join(left, ["g", "s"]).select(*wanted.columns)
    ranges = reduce(DataFrame.union, found).groupBy("g", "s").agg(
        F.array_sort(F.collect_set(F.struct("a", "b"))).alias("p"))
    # In order, so that a range either lengthens the last one or stands beside it.
    merged = F.aggregate("p", F.array().cast("array<int>"), lambda done, x: F.when(
        F.get(done, F.size(done) - 1) >= x["a"],
        F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(F.greatest(
            F.get(done, F.size(done) - 1), x["b"])))
    ).otherwise(F.concat(done, F.array(x["a"], x["b"]))))
    return ranges.select("g", "s", merged.alias("ranges"))


def _sent(rows: DataFrame) -> DataFrame:
    """A written table, to be broadcast if a count shows that it is small."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def _that_may_repeat(distinct: DataFrame, length: int) -> DataFrame:
    """Stretches found twice or sharing a core with another stretch of their anchor.

    ``sides`` tells which core is shared: 1 right, 2 left. ``before`` and ``size`` leave out what only
    strings with the other core cover; ``first`` to ``last`` is the whole stretch, from its anchor.
    """
    cores = distinct.select("g", F.explode(F.array("left", "right")).alias("core")).filter(
        "core IS NOT NULL")
    shared = materialize(cores.groupBy("g", "core").agg(F.count("*").alias("n")).filter(
        "n > 1").select("g", "core", F.lit(True).alias("met")), "cores")
    sent, rows = _sent(shared), distinct
    for side in ("left", "right"):
        rows = rows.join(sent.toDF("g", side, f"met_{side}"), ["g", side], "left")
    back = (length - GRAM + 1) // 2
    last, begin = F.col("size") - F.col("before"), F.when(F.col("met_left"), F.col("before")).otherwise(
        F.least("before", F.lit(back - 1)))
    end = F.when(F.col("met_right"), last).otherwise(F.least(last, F.lit(length - back)))
    side = lambda c, bit: F.when(F.col(c), bit).otherwise(0)
    return materialize(rows.filter("n > 1 OR met_left OR met_right").select(
        "g", "s", "n", "k1", "k2", "at", begin.alias("before"), (begin + end).alias("size"),
        (side("met_right", 1) + side("met_left", 2)).alias("sides"),
        (-F.col("before")).alias("first"), last.alias("last")), "distinct")


def _stretch_bytes(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``g, s, before, n, sides, bytes``: one copy of each stretch that ``wanted`` names."""
    lists = wanted.groupBy("k1", "k2").agg(F.collect_list(
        F.struct("g", "s", "at", "before", "size", "n", "sides")).alias("cut"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, cut in zip(batch.column(0), batch.column(1)):
                raw, rows = text.as_buffer(), cut.as_py()
                yield pa.RecordBatch.from_pydict(
                    {c: [r[c] for r in rows] for c in ("g", "s", "before", "n", "sides")}
                    | {"bytes": [raw[r["at"] - r["before"]:
                                     r["at"] - r["before"] + r["size"]].to_pybytes()
                                 for r in rows]}, _STRETCH)

    # One text of each group of equal ones; copies within a task are merged before the shuffle.
    texts = docs.groupBy("k1", "k2").agg(F.first("text").alias("text"))
    return texts.join(materialize(lists, "lists"), ["k1", "k2"]).select("text", "cut").mapInArrow(
        run, "g long, s long, before int, n long, sides int, bytes binary")


_STRETCH = pa.schema([("g", pa.int64()), ("s", pa.int64()), ("before", pa.int32()),
                      ("n", pa.int64()), ("sides", pa.int32()), ("bytes", pa.binary())])


def repeated_ranges(docs: DataFrame, length: int, most_stretches: int, shard_bytes: int
                    ) -> DataFrame:
    """``k1, k2, start, end``: ranges of each text that repeat, for ``k1, k2, text``."""
    # Anchors are found twice, which costs less than a written table of them all.
    several = materialize(
        stretches(docs, length).groupBy("g").agg(
            F.min("s").alias("low"), F.max("s").alias("high"), F.count("*").alias("n"))
        .filter("n > 1").select("g", (F.col("low") != F.col("high")).alias("mixed")), "several")
    kept = materialize(stretches(docs, length).join(_sent(several), "g"), "kept")
    whole = kept.filter("NOT mixed").select(
        "k1", "k2", (F.col("at") - F.col("before")).alias("start"),
        (F.col("at") - F.col("before") + F.col("size")).alias("end"))
    mixed = kept.filter("mixed")
    distinct = _that_may_repeat(materialize(mixed.groupBy("g", "s").agg(
        F.count("*").alias("n"),
        F.min(F.struct("k1", "k2", "at", "before", "size", "left", "right")).alias("f")
    ).select("g", "s", "n", "f.*"), "distinct"), length)
    meeting = distinct.filter("sides > 0")
    sizes = meeting.groupBy("g").agg(F.count("*").alias("stretches"))
    parts = materialize(_stretch_bytes(docs, meeting), "parts")
    # An anchor that fills a shard gets one of its own, so that no two of them share a task's memory.
    large = materialize(sizes.filter(
        F.col("stretches") * (2 * length) > min(shard_bytes, most_stretches * 2 * length)), "large")
    crowded = large.filter(F.col("stretches") > most_stretches).select("g")
    total = parts.agg(F.coalesce(F.sum(F.length("bytes")), F.lit(0))).first()[0]
    n_shards = max(1, -(-total // shard_bytes))
    few = parts.join(large, "g", "left").filter(
        F.col("stretches").isNull() | (F.col("stretches") <= most_stretches)).withColumn(
        "shard", F.when(F.col("stretches").isNull(), F.pmod(F.xxhash64("g"), F.lit(n_shards)))
        .otherwise(-1 - F.col("g").bitwiseAND(F.lit(2**63 - 1)))).drop("stretches", "sides")
    twice = distinct.filter("n > 1").select("g", "s", F.col("first").alias("a"), F.col("last").alias("b"))
    found = _in_shards(few, length)
    if crowded.take(1):
        found = found.union(_by_hash(materialize(parts.join(crowded, "g"), "crowded"),
                                     twice.join(crowded, "g"), length))
        twice = twice.join(crowded, "g", "left_anti")
    found = found.union(twice.select("g", "s", F.array("a", "b")))
    found = materialize(found.filter(F.size("ranges") > 0), "found")
    each = F.transform(F.sequence(F.lit(0), (F.size("ranges") / 2).cast("int") - 1), lambda i:
                       F.struct(F.get("ranges", i * 2).alias("a"),
                                F.get("ranges", i * 2 + 1).alias("b")))
    placed = mixed.join(found, ["g", "s"]).select("k1", "k2", "at", F.explode(each).alias("r"))
    return whole.union(placed.select("k1", "k2", F.col("at") + F.col("r.a"),
                                     F.col("at") + F.col("r.b")))


def remove_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH,
                   most_stretches: int = MOST_STRETCHES, shard_bytes: int = SHARD_BYTES
                   ) -> DataFrame:
    """``docs`` with ``kept`` (remaining bytes), ``n_bytes``, ``n_removed`` and ``n_spans``."""
    if length < GRAM:
        raise ValueError(f"length must be {GRAM} or more")
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    texts = docs.select(*_text_keys(value), value.alias("text"))
    ranges = repeated_ranges(texts, length, most_stretches, shard_bytes)
    lists = materialize(ranges.groupBy("k1", "k2").agg(
        F.collect_set(F.struct("start", "end")).alias("_ranges")), "ranges")
    new = ("kept", "n_bytes", "n_removed", "n_spans")
    names = [c for c in docs.columns if c not in new]
    k1, k2, own, spans = (unused([*docs.columns, "k1", "k2", "_ranges"], c) for c in (
        "own1", "own2", "value", "spans"))
    keyed = docs.select(*[f"`{c}`" for c in names], value.alias(own),
                        *[k.alias(c) for k, c in zip(_text_keys(value), (k1, k2))])
    lists = lists.toDF(r1 := unused(keyed.columns, "k1"), r2 := unused(keyed.columns, "k2"), spans)
    rows = keyed.join(lists, (F.col(k1) == F.col(r1)) & (F.col(k2) == F.col(r2)), "left").select(
        *[f"`{c}`" for c in names], own, spans)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keyed.schema.fields[: len(names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {c: [] for c in new}
            for value, spans in zip(batch.column(len(names)), batch.column(len(names) + 1)):
                raw = value.as_buffer().to_pybytes()
                end = count = 0
                pieces = []
                for a, b in sorted((s["start"], s["end"]) for s in spans.as_py() or ()):
                    if a > end or not count:
                        pieces.append(raw[end:a])
                        count += 1
                    end = max(end, b)
                out["kept"].append(b"".join([*pieces, raw[end:]]))
                out["n_bytes"].append(len(raw))
                out["n_removed"].append(len(raw) - len(out["kept"][-1]))
                out["n_spans"].append(count)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(names)], pa.array(out["kept"], pa.binary()),
                 *(pa.array(out[c], pa.int64()) for c in new[1:])], [*names, *new])

    return rows.mapInArrow(run, f"{kinds}, kept binary, n_bytes long, n_removed long, n_spans long")
