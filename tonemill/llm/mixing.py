"""Mix sources to target weights along a curriculum that changes with training time.

Each source gets a target: its share of the budget by weight, at most ``repeat`` times its own
words; what a full source cannot take is shared out again by weight. A schedule says how a
source's weight moves over training time 0..1. Its integral is the source's demand up to a time;
the inverse gives every copy of a document the time at which its words are wanted. Rows sorted by
that time are the training order.

Within a source documents follow a hash of their ID. The mix takes words in that order, as often
as needed, and ends inside the copy in which the target is met, so each source's words meet its
target to the word.

Defined cases: null sources are one source, last in order; null or wordless texts have size 0
and take part with no words; a source without words has target 0; equal rows are taken each for
itself; an empty table gives an empty mix; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tonemill.plans import ranges
from tonemill.plans.materialize import materialize

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
REPEAT = 2
#: Relative weight of a source at equally spaced times, by its base weight: heavy sources fade,
#: light ones grow. Any positive numbers do.
SCHEDULES = {5: (1.5, 1.0, 0.5), 2: (1.0, 1.0, 1.0), 1: (0.5, 1.0, 1.5)}
_SPACE = " \t\n\u000b\u000c\r"


def n_words(text: Column) -> Column:
    """Number of words, that is runs without ASCII white space; null counts none."""
    inner = F.btrim(text, F.lit(_SPACE))
    return F.when(F.coalesce(inner, F.lit("")) == "", 0).otherwise(
        F.size(F.split(inner, r"[\x20\x09-\x0D]+"))).cast("bigint")


def source_targets(sizes: DataFrame, weights=WEIGHTS, budget: float = BUDGET,
                   repeat: int = REPEAT) -> DataFrame:
    """``source, source_size, weight, target`` from ``source, source_size``.

    The windows run over one row per source. Sorted by how soon they are full, sources before a
    given one take all they can; the level at which the rest share is the largest of all.
    """
    every = Window.partitionBy()
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    full = F.col("source_size") * repeat
    by_fill = Window.orderBy(F.col("source_size") / F.col("weight"), "rank").rowsBetween(
        Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(by_fill), F.lit(0))
    level = ((F.sum("source_size").over(every) * budget - before(full))
             / (F.sum("weight").over(every) - before(F.col("weight"))))
    return (
        sizes.withColumn("rank", F.row_number().over(by_name))
        .withColumn("weight", F.array(*map(F.lit, weights))[
            F.pmod(F.col("rank") - 1, F.lit(len(weights)))].cast("double"))
        .withColumn("level", level)
        .withColumn("level", F.max("level").over(every))
        .select("source", "source_size", "weight",
                F.least(F.col("level") * F.col("weight"), full.cast("double")).alias("target"))
    )


def demand_time(share: Column, knots: Column) -> Column:
    """When a source whose weight passes through ``knots`` has used ``share`` of its demand."""
    last = F.size(knots) - 1
    zero = F.array(F.lit(0.0))
    area = F.aggregate(F.sequence(F.lit(1), last), zero, lambda a, i: F.concat(
        a, F.array(F.element_at(a, -1) + (knots[i - 1] + knots[i]) / 2)))
    goal = share * F.element_at(area, -1)
    piece = F.least(F.greatest(F.size(F.filter(area, lambda a: a <= goal)), F.lit(1)), last) - 1
    rest, a, b = goal - area[piece], knots[piece], knots[piece + 1]
    # The root of a x + (b - a) x^2 / 2 = rest, written so that b = a is no special case.
    x = 2 * rest / (a + F.sqrt(F.greatest(a * a + 2 * (b - a) * rest, F.lit(0.0))))
    return (piece + x) / last


def assign(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
           weights=WEIGHTS, budget: float = BUDGET, repeat: int = REPEAT,
           schedules: dict[int, tuple[float, ...]] | None = None) -> DataFrame:
    """One row per document: ``key, source, size, source_size, target, taken, copies``.

    ``copies`` has a struct ``(copy, words, position)`` for each time the mix takes words of it.
    """
    schedules = schedules or SCHEDULES
    rows = materialize(docs.select(
        F.col(key).alias("key"), F.col(source).cast("string").alias("source"),
        n_words(F.col(text).cast("string")).alias("size"),
        F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")).alias("_order")),
        "sizes")
    targets = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")),
                             weights, budget, repeat)
    order = [F.col("_order"), F.col("key"), F.col("size")]
    parts = ranges.range_sorted(rows, ["source"], order)
    sums = parts.groupBy("source", ranges.PART).agg(F.sum("size").alias("_sum"))
    shift = sums.select("source", ranges.PART, F.coalesce(
        F.sum("_sum").over(ranges.preceding(["source"])), F.lit(0)).alias("_shift"))
    placed = ranges.attach_summary(parts, shift, ["source"]).withColumn(
        "_start", F.col("_shift") - F.col("size") + F.sum("size").over(
            ranges.within(["source"], [F.col(ranges.POS)])))
    knots = F.coalesce(*[F.when(F.col("weight") == w, F.array(*map(F.lit, map(float, k))))
                         for w, k in schedules.items()], F.array(F.lit(1.0), F.lit(1.0)))
    placed = placed.join(
        targets.select(F.col("source").alias("_source"), "source_size", "target",
                       knots.alias("_knots")),
        F.col("source").eqNullSafe(F.col("_source")))
    goal = F.floor(F.col("target") + 0.5)

    def copy(k):
        start = F.col("_start") + k * F.col("source_size")
        words = F.greatest(F.least(goal - start, F.col("size")), F.lit(0)).cast("bigint")
        share = start / F.greatest(goal, F.lit(1))
        return F.struct((k + 1).cast("int").alias("copy"), words.alias("words"),
                        demand_time(share, F.col("_knots")).alias("position"))

    copies = F.filter(F.transform(F.sequence(F.lit(0), F.lit(repeat - 1)), copy),
                      lambda c: c["words"] > 0)
    return (
        placed.withColumn("copies", copies)
        .withColumn("taken", F.aggregate("copies", F.lit(0).cast("bigint"),
                                         lambda a, c: a + c["words"]))
        .select(F.col("key").alias(key), "source", "size", "source_size", "target", "taken",
                "copies")
    )


def in_training_order(rows: DataFrame, position: Column, key: str) -> DataFrame:
    """Rows sorted by position in ranges of equal training time; without a position, at the end.

    Positions lie in 0..1, so ranges need no sampling pass: each is one partition. Rows without
    a position have no order among themselves; a hash deals them to as many partitions again.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.when(position.isNotNull(), F.least(F.floor(position * n), F.lit(n - 1))).otherwise(
        n + F.pmod(F.xxhash64(*rows.columns), F.lit(n))).cast("int")
    return rows.repartitionById(2 * n, place).sortWithinPartitions(
        position.asc_nulls_last(), F.col(key).asc_nulls_last())
