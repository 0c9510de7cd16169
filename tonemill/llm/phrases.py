"""Collocations: frequent phrases of a few words, by FM-indexes over word numbers.

Texts are cut to pieces at punctuation and line ends and pieces to words; phrases lie within a
piece. A first pass counts words; a second packs the words of each language into shards, as
numbers with a gap between pieces and in place of words that are not frequent.

Phrases are found length by length. Most runs of words are rare, so those whose parts are frequent
are first counted by one hash alone. A shard is then cut down to the places that frequent hashes cover, and indexed by the Burrows-Wheeler transforms of its numbers and of
the reversed numbers; suffixes are ordered by as many words as phrases have, which is all that is
needed. Phrases are intervals in both transforms, and all phrases of a length are extended at once: by a
word on the left, which moves an interval of the forward transform and refines that of the
reversed one, and by a word on the right, the other way round. Both ways give the same longer
phrases, each met once from its suffix and once from its prefix.

The counts of all shards are then summed, by a 128-bit hash of language and phrase. What is frequent
in the corpus goes back to the shards as a filter of ``FILTER_BITS`` bits, whatever its number: one
bit per hash. A bit that two phrases share only lets a phrase pass that its sum rejects later, so
the filter saves work and decides nothing. No count is cut off in a shard, so results do not
depend on how texts lie in shards. A frequent phrase is spelled once, by the first shard that holds it.

Scores are whole numbers, multiplied as decimals of 38 digits.

Defined cases: null text reads as empty and has no words; a null language counts as ``und``; rows
that repeat count as often as they stand; a piece lies in one shard however long it is; ties go to
the smallest cut and to the phrase that sorts first; only text and language are read, so other
columns may have any name; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tonemill.llm import buffers
from tonemill.plans.materialize import materialize

SHARD_WORDS = 1 << 20
#: Bits of the filter that is broadcast (16 MB).
FILTER_BITS = 27
#: Bytes of words that a task holds of all languages before it packs the largest into a shard.
HELD_BYTES = 1 << 26
#: Bits of a code that tell the place in a shard (more than a text can have words), and bits
#: that number the shards of a task; the others number the task.
PLACE_BITS, SHARD_BITS = 30, 16

_GAPS = buffers.SPACE.copy()
_ENDS = np.zeros(256, bool)
_ENDS[[10, 11, 12, 13, *b".,;:!?"]] = True
_GAPS |= _ENDS
_SEEDS = (12, 13)
_STEP = 0x9E3779B97F4A7C15
_SHARD = ("shard long, lang string, words array<string>, hash1 array<long>, hash2 array<long>, "
          "numbers binary, n long")


# What is frequent --------------------------------------------------------------------------------

def _filter(often: DataFrame) -> np.ndarray:
    """A bit for every ``hash1`` of the table; its size does not depend on the table's."""
    bit = F.col("hash1").bitwiseAND(F.lit((1 << FILTER_BITS) - 1)) + 1
    maps = often.select(F.bitmap_bucket_number(bit).alias("bucket"),
                        F.bitmap_bit_position(bit).alias("bit")).groupBy("bucket").agg(
        F.bitmap_construct_agg("bit").alias("bits"))
    out = np.zeros((1 << FILTER_BITS) >> 15 << 12, np.uint8)
    for r in maps.toLocalIterator():  # 4 KB each, as many as the filter has
        at = (r["bucket"] - 1) << 12
        out[at: at + len(r["bits"])] = np.frombuffer(r["bits"], np.uint8)
    return out


def _passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & np.uint64((1 << FILTER_BITS) - 1)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


# Texts to shards ---------------------------------------------------------------------------------

def _words(batch: pa.RecordBatch):
    """Lower-cased bytes; of every word its start, end, row and 64-bit hash."""
    data, offsets = buffers.utf8(batch.column("text"))
    data = buffers.LOWER[data]
    starts, ends, rows = buffers.words(data, offsets, _GAPS)
    return data, starts, ends, rows, buffers.SpanHash(data, _SEEDS[0]).of(starts, ends)


def _lang_hash(langs: pa.Array, seed: int) -> np.ndarray:
    """To be added to hashes of words: unlike that of the same string as a word, so that the word
    ``es`` of ``en`` is not taken for the word ``en`` of ``es``."""
    data, offsets = buffers.utf8(langs)
    return buffers.mix(buffers.SpanHash(data, seed).of(offsets[:-1], offsets[1:]) ^ np.uint64(_STEP))


def _frequent_words(rows: DataFrame, least: int) -> DataFrame:
    """``hash1`` of the words, each with its language, that occur ``least`` times."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in buffers.slices(batch.column("text"), 8 * buffers.CHUNK_BYTES):
                part = batch.slice(a, b - a)
                _, starts, _, row, hashes = _words(part)
                if len(starts):
                    hashes = buffers.mix(hashes + _lang_hash(part.column("lang"), _SEEDS[0])[row])
                    distinct, n = np.unique(hashes, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(distinct.view(np.int64)), pa.array(n)], names=["hash1", "n"])

    return _sums(rows.mapInArrow(run, "hash1 long, n long"), least)


def _sums(held: DataFrame, least: int) -> DataFrame:
    return held.groupBy("hash1").agg(F.sum("n").alias("a")).filter(F.col("a") >= least)


class _Pack:
    """Words of one language: the distinct frequent ones, and all numbers with gaps between."""

    def __init__(self, lang: str, bits: np.ndarray):
        self.lang, self.bits = lang, bits
        self.of_lang = [_lang_hash(pa.array([lang]), seed) for seed in _SEEDS]
        self.number: dict[int, int] = {}
        self.words: list[bytes] = []
        self.parts: list[np.ndarray] = []
        self.n = self.bytes = 0

    def add(self, raw: bytes, starts, ends, piece, hashes) -> None:
        distinct, first, at = np.unique(hashes, return_index=True, return_inverse=True)
        known = np.flatnonzero(_passes(self.bits, buffers.mix(distinct + self.of_lang[0])))
        numbers = np.zeros(len(distinct), np.int32)
        for i, h, a, b in zip(known.tolist(), distinct[known].tolist(),
                              starts[first[known]].tolist(), ends[first[known]].tolist()):
            number = self.number.get(h)
            if number is None:
                number = self.number[h] = len(self.words) + 1
                self.words.append(raw[a:b])
                self.bytes += 150 + b - a
            numbers[i] = number
        fresh = np.ones(len(piece), bool)
        fresh[1:] = piece[1:] != piece[:-1]
        out = np.zeros(len(piece) + int(fresh.sum()), np.int32)
        out[np.arange(len(piece)) + np.cumsum(fresh)] = numbers[at]
        out = out[(out > 0) | (np.concatenate([[1], out[:-1]]) > 0)]
        self.parts.append(out)
        self.n += len(piece)
        self.bytes += out.nbytes

    def batch(self, shard: int) -> pa.RecordBatch:
        numbers = np.concatenate(self.parts)
        words = pa.array([w.decode("utf-8", "replace") for w in self.words], pa.string())
        data, offsets = buffers.utf8(words)
        hashes = [buffers.mix(buffers.SpanHash(data, seed).of(offsets[:-1], offsets[1:]) + own)
                  for seed, own in zip(_SEEDS, self.of_lang)]
        longs = [pa.array([h.view(np.int64)], pa.list_(pa.int64())) for h in hashes]
        return pa.RecordBatch.from_arrays(
            [pa.array([shard]), pa.array([self.lang]), pa.array([words], pa.list_(pa.string())), *longs,
             pa.array([numbers.astype(_width(len(words))).tobytes()], pa.binary()), pa.array([self.n])],
            names=["shard", "lang", "words", "hash1", "hash2", "numbers", "n"])


def _width(n_words: int) -> type:
    return np.uint16 if n_words < 1 << 16 else np.int32


def to_shards(rows: DataFrame, bits: np.ndarray, shard_words: int) -> DataFrame:
    """``shard, lang, words, hash1, hash2, numbers, n``: up to some ``shard_words`` words each.

    ``n`` counts all words, the others are those that pass the filter.
    """
    shared = rows.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, packs = TaskContext.get().partitionId() << SHARD_BITS, {}
        for batch in batches:
            for a, b in buffers.slices(batch.column("text")):
                part = batch.slice(a, b - a)
                data, starts, ends, rows, hashes = _words(part)
                if not len(starts):
                    continue
                piece = rows + np.cumsum(_ENDS[data])[starts]  # rises with the row and with each end
                raw, names = data.tobytes(), part.column("lang").dictionary_encode()
                code = names.indices.to_numpy()[rows]
                for c in np.unique(code).tolist():
                    own, name = code == c, names.dictionary[c].as_py()
                    if name not in packs:
                        packs[name] = _Pack(name, shared.value)
                    packs[name].add(raw, starts[own], ends[own], piece[own], hashes[own])
                    if packs[name].n >= shard_words:
                        yield packs.pop(name).batch(shard)
                        shard += 1
                while sum(p.bytes for p in packs.values()) > HELD_BYTES:
                    name = max(packs, key=lambda x: packs[x].bytes)
                    yield packs.pop(name).batch(shard)
                    shard += 1
        for pack in packs.values():
            yield pack.batch(shard)
            shard += 1

    return materialize(rows.mapInArrow(run, _SHARD), "shards")


def _numbers(row: pa.RecordBatch) -> np.ndarray:
    words = row.column("words").flatten()
    return np.frombuffer(row.column("numbers")[0].as_buffer(), _width(len(words))).astype(np.int32)


def _each_shard(run):
    """``run`` on a shard at a time, where the shards lie."""
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                yield run(batch.slice(i, 1))
    return over


# The index of a shard ----------------------------------------------------------------------------

def _order(numbers: np.ndarray, depth: int) -> np.ndarray:
    """Cyclic suffixes in order of their first ``depth`` numbers."""
    rank, known, order = numbers.astype(np.int64), 1, None
    while known < depth:
        step = min(known, depth - known)
        pairs = rank * (int(rank.max()) + 1) + np.roll(rank, -step)
        order = np.argsort(pairs)
        known += step
        if known < depth:
            rank[order] = np.concatenate([[0], np.cumsum(np.diff(pairs[order]) != 0)])
    return (np.argsort(numbers, kind="stable") if order is None else order).astype(np.int32)


def _steps(numbers: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The transform, and where each of its places moves when its word is put in front."""
    before = numbers[order - 1]
    to = np.empty(len(order), np.int32)
    to[np.argsort(before, kind="stable")] = np.arange(len(order), dtype=np.int32)
    return before, to


class Phrases:
    """Phrases of one length: intervals ``low .. low + size`` forward and ``back ..`` reversed."""

    def __init__(self, low, back, size, *hashes):
        self.low, self.back, self.size, self.hashes = low, back, size, hashes

    def only(self, keep: np.ndarray) -> Phrases:
        return Phrases(*(x[keep] for x in (self.low, self.back, self.size, *self.hashes)))


class Index:
    """Both transforms of a shard's numbers, ordered by ``depth`` words."""

    def __init__(self, numbers: np.ndarray, depth: int):
        self.numbers, self.n = numbers, len(numbers)
        self.order = _order(numbers, depth)
        self.before, self.left = _steps(numbers, self.order)
        reverse = numbers[::-1]
        self.after, self.right = _steps(reverse, _order(reverse, depth))

    def words(self, *hashes: np.ndarray) -> Phrases:
        """Phrases of one word; ``hashes`` are those of the words in order of their number."""
        size = np.bincount(self.numbers, minlength=len(hashes[0]) + 1)[1:]
        low = np.cumsum(size) - size + (self.n - int(size.sum()))
        return Phrases(low, low, size, *hashes)

    def _extended(self, start, size, words, to):
        """Per phrase and word beside it: phrase, word, first place moved to, and how many."""
        within = np.repeat(np.arange(len(start)), size)
        places = np.arange(len(within)) + np.repeat(start - (np.cumsum(size) - size), size)
        word = words[places]
        key = within * (int(word.max(initial=0)) + 1) + word
        order = np.argsort(key)
        key = key[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else order
        # Places of one phrase and word move to a run; its least place is the start of the interval.
        moved = np.minimum.reduceat(to[places[order]], first) if len(first) else first
        at = order[first]
        return within[at], word[at], moved.astype(np.int64), np.diff(np.append(first, len(key)))

    def longer(self, phrases: Phrases, word_hashes: tuple[np.ndarray, ...], length: int) -> Phrases:
        """The phrases of ``length + 1`` words whose first and last ``length`` words are given."""
        of, word, low, size = self._extended(phrases.low, phrases.size, self.before, self.left)
        # Reversed, the longer phrase is the shorter one followed by the word: its places lie
        # within those of the shorter one, after those of all smaller words.
        back = phrases.back[of] + np.cumsum(size) - size
        back -= (np.cumsum(phrases.size) - phrases.size)[of]
        right = self._extended(phrases.back, phrases.size, self.after, self.right)[2]
        both = np.flatnonzero((word > 0) & np.isin(back, right))
        of, word = of[both], word[both]
        return Phrases(low[both], back[both], size[both], *(
            _joined(w[word - 1], h[of], length) for w, h in zip(word_hashes, phrases.hashes)))


def _joined(word: np.ndarray, rest: np.ndarray, length: int) -> np.ndarray:
    """Hash of a word and the ``length`` words after it."""
    return buffers.mix(rest + word * np.uint64(pow(_STEP, length, 1 << 64)))


def _rolled(numbers: np.ndarray, word_hashes: np.ndarray, length: int):
    """Where a run of ``length`` words starts, and its hash."""
    there = numbers > 0
    word = np.zeros(len(numbers), np.uint64)
    word[there] = word_hashes[numbers[there] - 1]
    own, valid = word, there.copy()
    for i in range(1, length):
        own = _joined(word, np.roll(own, -1), i)
        valid &= np.roll(there, -i)
    starts = np.flatnonzero(valid)
    return starts, own[starts]


def _covered(numbers: np.ndarray, word_hashes: np.ndarray, length: int, bits: np.ndarray):
    """The numbers that frequent phrases of ``length`` words cover, and where each stood."""
    starts, own = _rolled(numbers, word_hashes, length)
    starts = starts[_passes(bits, own)]
    cover = np.zeros(len(numbers) + 1, np.int32)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + length, -1)
    where = np.flatnonzero(np.cumsum(cover[:-1]))
    fresh = np.concatenate([[True], np.diff(where) > 1]) if len(where) else np.zeros(0, bool)
    at = np.arange(len(where)) + np.cumsum(fresh)
    out = np.zeros(len(where) + int(fresh.sum()), np.int32)
    place = np.zeros(len(out), np.int64)
    out[at], place[at] = numbers[where], where
    return out, place


def _frequent_runs(shards: DataFrame, length: int, bits: np.ndarray | None, least: int) -> DataFrame:
    """``hash1`` of the phrases of ``length`` whose hashes occur ``least`` times.

    ``bits`` is the filter of phrases one word shorter. Most phrases are rare, so they are counted by
    one hash before any is extended, told apart and placed; a phrase that shares its hash with
    another is only one too many for the index.
    """
    shared = shards.sparkSession.sparkContext.broadcast(bits)

    def run(row: pa.RecordBatch) -> pa.RecordBatch:
        numbers, hashes = _numbers(row), row.column("hash1").flatten().to_numpy().view(np.uint64)
        starts, own = _rolled(numbers, hashes, length)
        if shared.value is not None:
            part, shorter = _rolled(numbers, hashes, length - 1)
            known = np.zeros(len(numbers) + 1, bool)
            known[part] = _passes(shared.value, shorter)
            own = own[known[starts] & known[starts + 1]]
        distinct, n = np.unique(own, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), pa.array(n.astype(np.int64))],
                                          names=["hash1", "n"])

    return _sums(shards.select("words", "hash1", "numbers").mapInArrow(
        _each_shard(run), "hash1 long, n long"), least)


def _candidates(shards: DataFrame, length: int, bits: np.ndarray) -> DataFrame:
    """``hash1, hash2, n, code``: phrases of ``length`` that pass the filter ``bits``, by shard.

    ``code`` is the shard and the place of one occurrence in it.
    """
    shared = shards.sparkSession.sparkContext.broadcast(bits)

    def run(row: pa.RecordBatch) -> pa.RecordBatch:
        numbers, bits = _numbers(row), shared.value
        hashes = tuple(row.column(c).flatten().to_numpy().view(np.uint64) for c in ("hash1", "hash2"))
        numbers, place = _covered(numbers, hashes[0], length, bits)
        level = Phrases(*[np.zeros(0, np.int64)] * 3, *[np.zeros(0, np.uint64)] * 2)
        if len(numbers):
            index = Index(numbers, length)
            level = index.words(*hashes)
            level = level.only(level.size > 0)
            for shorter in range(1, length):
                level = index.longer(level, hashes, shorter)
            level = level.only(_passes(bits, level.hashes[0]))
            place = place[index.order[level.low]]
        shard = row.column("shard")[0].as_py() << PLACE_BITS
        return pa.RecordBatch.from_arrays(
            [pa.array(level.hashes[0].view(np.int64)), pa.array(level.hashes[1].view(np.int64)),
             pa.array(level.size.astype(np.int64)), pa.array(shard + place[:len(level.low)].astype(np.int64))],
            names=["hash1", "hash2", "n", "code"])

    return shards.select("shard", "words", "hash1", "hash2", "numbers").mapInArrow(
        _each_shard(run), "hash1 long, hash2 long, n long, code long")


def _spelled(shards: DataFrame, found: DataFrame) -> DataFrame:
    """``lang, phrase, words, a`` of phrases given as ``code, words, a``."""
    def run(row: pa.RecordBatch) -> pa.RecordBatch:
        numbers, words = _numbers(row), row.column("words").flatten().to_pylist()
        place, length, a = (row.column("own").flatten().field(c) for c in ("place", "words", "a"))
        phrases = [" ".join(words[w - 1] for w in numbers[p: p + m].tolist())
                   for p, m in zip(place.to_pylist(), length.to_pylist())]
        return pa.RecordBatch.from_arrays(
            [pa.array([row.column("lang")[0].as_py()] * len(a), pa.string()),
             pa.array(phrases, pa.string()), length, a], names=["lang", "phrase", "words", "a"])

    own = found.groupBy(F.shiftright("code", PLACE_BITS).alias("shard")).agg(F.collect_list(F.struct(
        F.col("code").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).alias("place"), "words", "a")).alias("own"))
    return shards.select("shard", "lang", "words", "numbers").join(own, "shard").mapInArrow(
        _each_shard(run), "lang string, phrase string, words int, a long")


# The corpus --------------------------------------------------------------------------------------

def frequent_phrases(docs: DataFrame, least: int, longest: int = 5, text: str = "text",
                     lang: str = "lang", shard_words: int = SHARD_WORDS
                     ) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, words, a`` of all phrases of 1 to ``longest`` words that occur ``least`` times.

    And ``lang, n``: the words of each language.
    """
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
                       F.col(text).alias("text"))
    bits = _filter(_frequent_words(rows, least))
    shards = to_shards(rows, bits, shard_words)
    totals = shards.groupBy("lang").agg(F.sum("n").alias("n"))
    found = []
    for length in range(1, longest + 1):
        if length > 1:
            bits = _filter(_frequent_runs(shards, length, bits if length > 2 else None, least))
        often = materialize(
            _candidates(shards, length, bits).groupBy("hash1", "hash2").agg(
                F.min("code").alias("code"), F.lit(length).alias("words"), F.sum("n").alias("a"))
            .filter(F.col("a") >= least), "phrases")
        found.append(often.select("code", "words", "a"))
        if often.isEmpty():
            break
    return materialize(_spelled(shards, reduce(DataFrame.union, found)), "phrases"), totals


def _div(a: Column, b: Column) -> Column:
    """Whole part of ``a / b`` of two decimals without a digit after the point."""
    return F.call_function("div", a, b)


def _big(c: str, digits: int) -> Column:
    return F.col(c).cast(f"decimal({digits},0)")


def collocations(docs: DataFrame, least: int, top: int, longest: int = 5, text: str = "text",
                 lang: str = "lang", shard_words: int = SHARD_WORDS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: per language the ``top`` phrases by score.

    ``a`` counts the phrase, ``l`` and ``r`` the parts of its weakest cut, ``n`` all words;
    ``score`` is ``1000 * a * n`` over ``l * r``, rounded down. A phrase that is as frequent as one a
    word longer that holds it is left out.
    """
    phrases, totals = frequent_phrases(docs, least, longest, text, lang, shard_words)
    parts = F.split("phrase", " ")
    several = phrases.filter("words > 1")
    # Whatever longer phrase holds a phrase just as often, one a word longer does.
    inner = several.filter("words > 2").select(
        "lang", "a", F.explode(F.array(
            F.array_join(F.slice(parts, F.lit(1), F.col("words") - 1), " "),
            F.array_join(F.slice(parts, F.lit(2), F.col("words") - 1), " "))).alias("phrase"))
    maximal = several.join(inner.distinct(), ["lang", "phrase", "a"], "left_anti")
    cuts = maximal.select(
        "lang", "phrase", "words", "a",
        F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")).select(
        "*", F.array_join(F.slice(parts, F.lit(1), F.col("k")), " ").alias("head"),
        F.array_join(F.slice(parts, F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("tail"))
    heads = phrases.select("lang", F.col("phrase").alias("head"), F.col("a").alias("l"))
    tails = phrases.select("lang", F.col("phrase").alias("tail"), F.col("a").alias("r"))
    scored = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).join(
        totals, "lang").withColumn("score", _div(
            _big("a", 18) * _big("n", 15) * F.lit(1000).cast("decimal(4,0)"),
            _big("l", 18) * _big("r", 18)).cast("long"))
    weakest = scored.groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut")).select(
        "lang", "phrase", "a", "n", "cut.l", "cut.r", "cut.score")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return weakest.withColumn("rank", F.row_number().over(best).cast("long")).filter(
        F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
