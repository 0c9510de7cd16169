"""Tokens, n-grams and per-row term counts as array expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tonemill.functions.cleaning import SPACE, WORD


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``.

    A column used inside a lambda may be inlined there by the optimizer and then be computed
    again for each array element; a lambda variable cannot.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ws_tokens(c: Column) -> Column:
    """Split on whitespace runs; no empty tokens."""
    return F.filter(F.split(c, f"[{SPACE}]+"), lambda x: x != "")


def word_tokens(c: Column) -> Column:
    """Lower-cased runs of two or more word characters."""
    return F.regexp_extract_all(F.lower(c), F.lit(f"([{WORD}]{{2,}})"), 1)


def remove_stop_words(tokens: Column, words: list[str]) -> Column:
    return F.filter(tokens, lambda x: ~x.isin(list(words)))


def _ngrams_of(tokens: Column, n: int) -> Column:
    if n == 1:
        return tokens
    starts = F.slice(tokens, F.lit(1), F.greatest(F.size(tokens) - (n - 1), F.lit(0)))
    return F.transform(
        starts,
        lambda x, i: F.concat_ws(" ", x, *[F.get(tokens, i + k) for k in range(1, n)]),
    )


def ngrams(tokens: Column, lo: int, hi: int) -> Column:
    """All n-grams of lengths ``lo`` to ``hi``, tokens joined by one space."""
    return bind(tokens, lambda t: F.concat(*[_ngrams_of(t, n) for n in range(lo, hi + 1)]))


def run_starts(ordered: Column, key: Callable[[Column], Column] = lambda x: x) -> Column:
    """Indices at which a new value begins in a sorted array; ``ordered`` is a bound variable."""
    n = F.size(ordered)
    return F.filter(
        F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))),
        lambda i: (i < n) & ((i == 0) | (
            key(F.get(ordered, i)) != key(F.get(ordered, F.greatest(i - 1, F.lit(0)))))))


def value_counts(values: Column) -> Column:
    """``array<struct<term, tf>>`` of one row's array: its distinct values with their counts."""
    def counted(ordered: Column, starts: Column) -> Column:
        return F.transform(starts, lambda i, k: F.struct(
            F.get(ordered, i).alias("term"),
            (F.coalesce(F.get(starts, k + 1), F.size(ordered)) - i).cast("long").alias("tf")))

    return bind(F.sort_array(values),
                lambda w: bind(run_starts(w), lambda s: counted(w, s)))


def value_positions(values: Column) -> Column:
    """``array<struct<value, positions>>``: where in the array each distinct value stands."""
    tagged = F.transform(values, lambda v, i: F.struct(v.alias("value"), i.alias("pos")))

    def gathered(w: Column, starts: Column) -> Column:
        return F.transform(starts, lambda i, k: F.struct(
            F.get(w, i)["value"].alias("value"),
            F.transform(F.slice(w, i + 1, F.coalesce(F.get(starts, k + 1), F.size(w)) - i),
                        lambda x: x["pos"]).alias("positions")))

    return bind(F.sort_array(tagged),
                lambda w: bind(run_starts(w, lambda x: x["value"]), lambda s: gathered(w, s)))


def word_count(c: Column) -> Column:
    return F.size(ws_tokens(c))


def char_length(c: Column) -> Column:
    """Length in code points."""
    return F.length(c)
