"""Subword segmentation against a user's vocabulary, and padded id sequences.

Words are segmented where the texts lie, or, with a large vocabulary, once each and joined back to
the texts. The vocabulary table is ``token, id`` and holds the start, end, padding and unknown entries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonemill.constants import CLS, CONTINUATION, MAX_LEN, MAX_WORD_CHARS, PAD, SEP, UNK
from tonemill.functions.cleaning import SPACE
from tonemill.functions.tokens import value_positions
from tonemill.plans.materialize import materialize

# Tokens outside letters, digits and spaces stand alone.
_PUNCT = r"\p{P}$+<=>^`|~"
_PICKED = "array<struct<start:int,len:int,id:int>>"
_CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"
# A vocabulary up to this many tokens is broadcast as a trie; a larger one is joined by shuffle.
BROADCAST_TOKENS = 1 << 18
#: Words whose pieces a task remembers; others are segmented again where they occur.
CACHED_WORDS = 1 << 18


def words(text: Column) -> Column:
    """Lower-cased words, each punctuation mark a word of its own."""
    plain = F.lower(F.regexp_replace(text, _CONTROL, ""))
    return F.regexp_extract_all(plain, F.lit(f"([{_PUNCT}]|[^{SPACE}{_PUNCT}]+)"), 1)


def _trie(tokens: dict[str, int]) -> dict[str, int]:
    """Every prefix of every token: its ID where it is a token itself, -1 where it only begins one."""
    trie: dict[str, int] = {}
    for token, id_ in tokens.items():
        trie[token] = id_
        for end in range(1, len(token)):
            trie.setdefault(token[:end], -1)
    return trie


def _longest_matches(word: str, trie: dict[str, int]) -> list[tuple[str, int]] | None:
    """Greedy longest tokens from the left, or none if some place begins no token."""
    found, text, base = [], word, 0
    while True:
        end = 0
        for i in range(base + 1, len(text) + 1):
            id_ = trie.get(text[:i])
            if id_ is None:
                break
            if id_ >= 0:
                end, best = i, id_
        if not end:
            return None
        found.append((text[:end], best))
        if end == len(text):
            return found
        text, base = CONTINUATION + text[end:], len(CONTINUATION)


def segment_words(distinct_words: DataFrame, vocab: DataFrame,
                  max_chars: int = MAX_WORD_CHARS) -> DataFrame:
    """``(word, ids, pieces)``: greedy longest match from the left.

    A word with a gap, or of more than ``max_chars`` characters, is the unknown token. A vocabulary
    of up to ``BROADCAST_TOKENS`` tokens goes to the tasks as a trie, which each word walks character
    by character and leaves at the first one that no token has; the words stay where they are.
    Only a larger vocabulary is joined with all substrings.
    """
    if vocab.count() > BROADCAST_TOKENS:
        return segment_by_join(distinct_words, vocab, max_chars)
    tokens = {r["token"]: r["id"] for r in vocab.select("token", "id").toLocalIterator()}
    shared = distinct_words.sparkSession.sparkContext.broadcast(tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, unknown = _trie(shared.value), [(UNK, shared.value[UNK])]
        for batch in batches:
            found = [(_longest_matches(w, trie) if 0 < len(w) <= max_chars else None) or unknown
                     for w in batch.column("word").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"),
                 pa.array([[i for _, i in f] for f in found], pa.list_(pa.int32())),
                 pa.array([" ".join(p for p, _ in f) for f in found], pa.string())],
                names=["word", "ids", "pieces"])

    return distinct_words.select("word").mapInArrow(run, "word string, ids array<int>, pieces string")


def segment_by_join(distinct_words: DataFrame, vocab: DataFrame,
                    max_chars: int = MAX_WORD_CHARS) -> DataFrame:
    """The same rows for a vocabulary of any size.

    All substrings of a word (no longer than the longest vocabulary token) are looked up; the
    longest match per start is kept, and a walk from position 0 picks the pieces.
    """
    longest = vocab.agg(F.max(F.length("token"))).first()[0]
    word, n = F.col("word"), F.length("word")
    # A word that is too long keeps one candidate, so that it stays in the result.
    last = F.when(n <= max_chars, n).otherwise(F.lit(1))
    candidates = (
        distinct_words.withColumn("start", F.explode(F.sequence(F.lit(1), last)))
        .withColumn("len", F.explode(F.sequence(
            F.lit(1), F.least(last - F.col("start") + 1, F.lit(longest)))))
        .withColumn("token", F.concat(
            F.when(F.col("start") > 1, CONTINUATION).otherwise(""),
            F.substring(word, F.col("start"), F.col("len"))))
    )
    found = F.when(F.col("id").isNotNull(), F.col("len"))
    longest_match = (candidates.join(vocab, "token", "left").groupBy("word", "start")
                     .agg(F.max(found).alias("len"), F.max_by("id", found).alias("id")))
    hits = longest_match.groupBy("word").agg(
        F.sort_array(F.collect_list(F.struct("start", "len", "id"))).alias("hits"))
    nothing = F.struct(F.lit(1).alias("at"), F.array().cast(_PICKED).alias("picked"))
    walked = F.aggregate("hits", nothing, lambda acc, h: F.when(
        (h["start"] == acc["at"]) & h["len"].isNotNull(),
        F.struct((acc["at"] + h["len"]).alias("at"),
                 F.concat(acc["picked"], F.array(h)).alias("picked"))).otherwise(acc))
    known = F.col("walk.at") == n + 1
    piece = F.transform("walk.picked", lambda h: F.concat(
        F.when(h["start"] > 1, CONTINUATION).otherwise(""),
        F.substring(word, h["start"], h["len"])))
    unknown_id = vocab.filter(F.col("token") == UNK).select("id").scalar()
    return hits.withColumn("walk", walked).select(
        "word",
        F.when(known, F.transform("walk.picked", lambda h: h["id"]))
        .otherwise(F.array(unknown_id)).alias("ids"),
        F.when(known, F.array_join(piece, " ")).otherwise(F.lit(UNK)).alias("pieces"))


def subword_tokens(df: DataFrame, vocab: DataFrame, text: str = "Processed",
                   keys: tuple[str, ...] = ("ID",), max_chars: int = MAX_WORD_CHARS) -> DataFrame:
    """``(keys, ids, pieces)`` of every text, whole; empty texts keep their row.

    With a vocabulary of up to ``BROADCAST_TOKENS`` tokens texts are segmented where they lie, without a
    shuffle; a task segments a word once and remembers up to ``CACHED_WORDS`` of them. A larger
    vocabulary is joined with the distinct words, and those with the texts.
    """
    if vocab.count() > BROADCAST_TOKENS:
        return subword_tokens_by_join(df, vocab, text, keys, max_chars)
    tokens = {r["token"]: r["id"] for r in vocab.select("token", "id").toLocalIterator()}
    shared = df.sparkSession.sparkContext.broadcast(tokens)
    texts = df.select(*keys, F.coalesce(words(F.col(text)), F.array().cast("array<string>")).alias("_words"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, unknown = _trie(shared.value), [(UNK, shared.value[UNK])]
        cache: dict[str, tuple[list[int], str]] = {}

        def segmented(word: str) -> tuple[list[int], str]:
            found = cache.get(word)
            if found is None:
                parts = (_longest_matches(word, trie) if 0 < len(word) <= max_chars else None) or unknown
                found = [i for _, i in parts], " ".join(p for p, _ in parts)
                if len(cache) < CACHED_WORDS:
                    cache[word] = found
            return found

        for batch in batches:
            lists = batch.column("_words")
            bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
            flat = lists.flatten().dictionary_encode()
            found = [segmented(w) for w in flat.dictionary.to_pylist()]
            codes = flat.indices.to_numpy()
            # The pieces of all distinct words end to end, and of every place those of its word.
            n = np.array([len(i) for i, _ in found], np.int64)
            ids = np.array([x for i, _ in found for x in i], np.int32)
            first, n = (np.cumsum(n) - n)[codes], n[codes]
            ends = np.concatenate([[0], np.cumsum(n)])
            at = np.arange(ends[-1]) + np.repeat(first - ends[:-1], n)
            pieces = pa.array([p for _, p in found], pa.string()).take(flat.indices)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keys),
                 pa.ListArray.from_arrays(pa.array(ends[bounds].astype(np.int32)), pa.array(ids[at])),
                 pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pieces), " ")],
                names=[*keys, "ids", "pieces"])

    kinds = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)
    return texts.mapInArrow(run, f"{kinds}, ids array<int>, pieces string")


def subword_tokens_by_join(df: DataFrame, vocab: DataFrame, text: str = "Processed",
                           keys: tuple[str, ...] = ("ID",), max_chars: int = MAX_WORD_CHARS) -> DataFrame:
    """The same rows for a vocabulary of any size; rows with the same keys are one text.

    Texts are cleaned and split once, into a written table that all later steps read.

    Positions are gathered per text and word first, without a shuffle, so a frequent word meets
    its pieces once per text; adaptive skew handling splits what is left of a hot word.
    """
    every = materialize(df.select(*keys, F.inline_outer(
        value_positions(words(F.col(text)))).alias("word", "positions")), "words")
    rows, empty = every.filter("word IS NOT NULL"), every.filter("word IS NULL")
    segmented = segment_words(rows.select("word").distinct(), vocab, max_chars)
    placed = rows.join(segmented, "word").select(
        *keys, F.transform("positions", lambda p: F.struct(
            p.alias("pos"), F.col("ids"), F.col("pieces"))).alias("placed"))
    sequences = placed.groupBy(*keys).agg(
        F.sort_array(F.flatten(F.collect_list("placed"))).alias("parts"))
    joined = sequences.select(
        *keys,
        F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"),
        F.array_join(F.transform("parts", lambda p: p["pieces"]), " ").alias("pieces"))
    return joined.union(empty.select(*keys, F.array().cast("array<int>"), F.lit("")))


def sequence_lengths(segmented: DataFrame, keys: tuple[str, ...] = ("ID",)) -> DataFrame:
    """Tokens per text including the two special ones, before truncation."""
    return segmented.select(*keys, (F.size("ids") + 2).alias("length"))


def encode_sequences(segmented: DataFrame, vocab: DataFrame, max_len: int = MAX_LEN,
                     keys: tuple[str, ...] = ("ID",)) -> DataFrame:
    """Fixed-length ids with start and end token, cut or padded, and the attention mask."""
    def special(token: str) -> Column:
        return vocab.filter(F.col("token") == token).select("id").scalar()

    body = F.slice("ids", 1, max_len - 2)
    full = F.concat(F.array(special(CLS)), body, F.array(special(SEP)))
    used = F.size(body) + 2
    return segmented.select(
        *keys,
        F.concat(full, F.array_repeat(special(PAD), F.lit(max_len) - used)).alias("input_ids"),
        F.concat(F.array_repeat(F.lit(1), used),
                 F.array_repeat(F.lit(0), F.lit(max_len) - used)).alias("attention_mask"))


def max_sequence_length(lengths: DataFrame) -> DataFrame:
    return lengths.agg(F.max("length").alias("max_length"))
