"""Exact duplicates by most-significant-digit radix partitioning of the texts.

Texts are compared as bytes, digit by digit: all texts that agree so far form a group, and a
round splits every group by its next digit (64 bytes at first, eight times as many each round).
A group of one row is done, and so is a group whose texts have ended: those are equal, byte for
byte, without a digest. Only groups of more rows with bytes left go on, and a row carries only
the bytes that no round has read, so all rounds together move a text about once.

Each round is an aggregation, with partial counts before the shuffle, and a join that sends
every row the number of its group. A digit that a third of all rows share is one row of the
aggregate; its rows are never gathered in one place, and adaptive execution splits their join
partition. The join is a sort-merge join at every size, since the groups grow with the table. The number of rounds grows with the logarithm of the longest text.

Defined cases: null reads as empty, and all empty texts are equal. Of equal texts the row with the
largest ID stays (a null ID is smaller than all others); among equal IDs exactly one row does. Only
the ID and the text are read, so other columns may have any name. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonemill.plans.materialize import materialize

FIRST_DIGIT = 64
GROWTH = 8


def exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text",
                     normalise: Callable[[Column], Column] | None = None,
                     first_digit: int = FIRST_DIGIT, growth: int = GROWTH) -> DataFrame:
    """``key, keep_id, group_size, kept, text_sha256`` of every row.

    ``normalise`` is applied to the text first; texts are equal when its results are. The hash is
    of that result; it is only returned, never compared.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("id"),
                       (normalise(whole) if normalise else whole).cast("binary").alias("rest"))
    width = first_digit
    digit = F.substring("rest", 1, width)
    crowded = materialize(
        rows.groupBy(digit.alias("digit")).agg(F.count("*").alias("n")).filter("n > 1")
        .select("digit", F.monotonically_increasing_id().alias("grp")), "digits")
    # The first round only tells rows without a partner; equal short texts end in the second.
    placed = materialize(
        rows.join(crowded.hint("merge"), digit == F.col("digit"), "left").select(
            "id", F.monotonically_increasing_id().alias("row"), "grp",
            F.sha2("rest", 256).alias("sha"),
            F.when(F.col("grp").isNotNull(), F.substring("rest", width + 1, _END)).alias("rest")),
        "placed")
    done = [placed.filter("grp IS NULL").select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("n"),
        F.lit(True).alias("kept"), "sha")]
    open_rows, left = placed.filter("grp IS NOT NULL"), crowded
    while not left.isEmpty():
        width *= growth
        placed, groups = _split(open_rows, width)
        done.append(placed.filter("NOT open").select(
            "id", F.col("top.id").alias("keep_id"), "n",
            (F.col("row") == F.col("top.row")).alias("kept"), "sha"))
        open_rows = placed.filter("open").select("id", "row", "sha", "grp", "rest")
        left = groups.filter("open")
    return reduce(DataFrame.union, done).select(
        F.col("id").alias(key), "keep_id", F.col("n").alias("group_size"), "kept",
        F.col("sha").alias("text_sha256"))


_END = 2**31 - 1


def _split(rows: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """One round: ``rows`` with their new group, its size and its last row, and the new groups.

    A group is ``open`` if it has several rows and bytes beyond this digit.
    """
    digit, more = F.substring("rest", 1, width), F.length("rest") > width
    groups = materialize(
        rows.groupBy(F.col("grp").alias("of"), digit.alias("digit"), more.alias("more"))
        .agg(F.count("*").alias("n"), F.max(F.struct("id", "row")).alias("top"))
        .withColumn("open", (F.col("n") > 1) & F.col("more"))
        .withColumn("next", F.monotonically_increasing_id()), "digits")
    same = (F.col("grp") == F.col("of")) & (digit == F.col("digit")) & (more == F.col("more"))
    placed = materialize(rows.join(groups.hint("merge"), same).select(
        "id", "row", "sha", F.col("next").alias("grp"), "n", "top", "open",
        F.when(F.col("open"), F.substring("rest", width + 1, _END)).alias("rest")), "placed")
    return placed, groups
