"""A uniform shuffle into shards whose row counts differ by one at most.

Rows are numbered in the order of what is known of them, equal rows one after the other, so every
row has a number of its own and the numbering does not depend on how the rows lie. All hashes are
of that number. Rows fall into blocks by a hash. How many rows each block sends to each shard is drawn exactly:
the matrix of counts with the blocks' sizes as row sums and the shards' sizes as column sums
(multivariate hypergeometric). Each block permutes its rows and deals them out by its row of the
matrix; after the exchange each shard permutes what it got, which gives the slots.

The matrix is drawn by halving: a node holds a range of blocks and its count for each shard, and
one hypergeometric draw per shard says how much of it goes to the left half. Level by level the
nodes are rows of a DataFrame, so the draws are distributed and depend on the seed alone.

Only DataFrame functions are used. Defined cases: null texts count no bytes; null IDs and
repeated rows are dealt like any other, each copy for itself (equal rows may swap slots); an empty table gives no rows;
columns of other names do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tonemill.plans.materialize import materialize
from tonemill.plans.ranges import dense_index

#: A draw looks this many standard deviations to each side of the mode; what lies beyond has a
#: probability below 1e-40.
REACH = 14


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) from a hash of the parts."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / float(1 << 53)


def hypergeometric(rest: Column, good: Column, draws: Column, u: Column) -> Column:
    """How many of ``good`` marked rows among ``rest`` are in ``draws`` drawn ones, from ``u``.

    The probabilities follow from that of the mode by exact ratios of neighbours; the value is
    the one at which their running sum, from the mode up and then down, passes ``u``.
    """
    def bound(args):
        n, k, d = args["n"], args["k"], args["d"]
        low = F.greatest(F.lit(0).cast("bigint"), d + k - n)
        high = F.least(k, d)
        mode = F.greatest(low, F.least(high, F.floor((d + 1.0) * (k + 1.0) / (n + 2.0))))
        share = k.cast("double") / F.greatest(n, F.lit(1))
        width = F.ceil(REACH * F.sqrt(d * share * (1.0 - share)) + 30.0)
        low, high = F.greatest(low, mode - width), F.least(high, mode + width)
        return F.struct(n.alias("n"), k.alias("k"), d.alias("d"), args["u"].alias("u"),
                        low.alias("low"), high.alias("high"), mode.alias("mode"))

    def ratio(a, x):  # p(x + 1) / p(x)
        return ((a["k"] - x).cast("double") * (a["d"] - x)
                / ((x + 1.0) * (a["n"] - a["k"] - a["d"] + x + 1.0)))

    def empty(sequence, when):
        return F.when(when, sequence).otherwise(F.array().cast("array<bigint>"))

    def up(a):
        return empty(F.sequence(a["mode"], a["high"] - 1), a["high"] > a["mode"])

    def down(a):
        return empty(F.sequence(a["mode"] - 1, a["low"], F.lit(-1).cast("bigint")),
                     a["low"] < a["mode"])

    def state(w, total, at):
        return F.struct(w.alias("w"), total.alias("total"), at.alias("at"))

    def summed(a):
        one, zero = F.lit(1.0), F.lit(0.0)
        above = F.aggregate(up(a), state(one, one, a["mode"]), lambda s, x: state(
            s["w"] * ratio(a, x), s["total"] + s["w"] * ratio(a, x), x + 1))["total"]
        below = F.aggregate(down(a), state(one, zero, a["mode"]), lambda s, x: state(
            s["w"] / ratio(a, x), s["total"] + s["w"] / ratio(a, x), x))["total"]
        return F.struct(a.alias("a"), above.alias("above"), below.alias("below"))

    def chosen(b):
        a, one, zero = b["a"], F.lit(1.0), F.lit(0.0)
        goal = a["u"] * (b["above"] + b["below"])

        def higher(s, x):
            w = s["w"] * ratio(a, x)
            return F.when(s["total"] > goal, s).otherwise(state(w, s["total"] + w, x + 1))

        def lower(s, x):
            w = s["w"] / ratio(a, x)
            return F.when(s["total"] > goal - b["above"], s).otherwise(
                state(w, s["total"] + w, x))

        return F.when(goal < b["above"],
                      F.aggregate(up(a), state(one, one, a["mode"]), higher)["at"]).otherwise(
            F.aggregate(down(a), state(one, zero, a["mode"]), lower)["at"])

    # Each transform over a one-element array names a value, so that it is computed once.
    args = F.array(F.struct(rest.cast("bigint").alias("n"), good.cast("bigint").alias("k"),
                            draws.cast("bigint").alias("d"), u.alias("u")))
    return F.transform(F.transform(F.transform(args, bound), summed), chosen)[0].cast("bigint")


def _left_counts(node: Column, sizes: Column, left: Column, seed: int) -> Column:
    """Per shard, how much of the node's count goes to its left half of ``left`` rows."""
    start = F.struct(F.aggregate(sizes, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("rest"),
                     left.cast("bigint").alias("draws"),
                     F.array().cast("array<bigint>").alias("out"))

    def step(s, good):
        got = hypergeometric(s["rest"], good, s["draws"],
                             _uniform(F.lit(seed), node, F.size(s["out"])))
        return F.transform(F.array(got), lambda x: F.struct(
            (s["rest"] - good).alias("rest"), (s["draws"] - x).alias("draws"),
            F.concat(s["out"], F.array(x)).alias("out")))[0]

    return F.aggregate(sizes, start, step)["out"]


def count_matrix(blocks: DataFrame, n_blocks: int, shards: int, seed: int) -> DataFrame:
    """``block, counts``: rows that each block sends to each shard, for ``block, n`` of every
    non-empty block. ``n_blocks`` is a power of two."""
    total = F.aggregate("rows", F.lit(0).cast("bigint"), lambda a, x: a + x)
    # One row of n_blocks numbers: its size is a parameter, not the data's.
    pairs = F.map_from_entries(F.collect_list(F.struct("block", "n")))
    nodes = (
        blocks.agg(pairs.alias("n"))
        .select(F.lit(1).cast("bigint").alias("node"),
                F.transform(F.sequence(F.lit(0), F.lit(n_blocks - 1)),
                            lambda b: F.coalesce(F.col("n")[b], F.lit(0)).cast("bigint"))
                .alias("rows"))
        .select("node", "rows", F.transform(
            F.sequence(F.lit(0), F.lit(shards - 1)),
            lambda s: F.floor(total / shards).cast("bigint")
            + (s < total % shards).cast("bigint")).alias("sizes"))
    )
    width, level = n_blocks, 0
    while width > 1:
        half = width // 2
        head = F.slice("rows", 1, half)
        left = F.aggregate(head, F.lit(0).cast("bigint"), lambda a, x: a + x)
        nodes = nodes.withColumn("got", _left_counts(F.col("node"), F.col("sizes"), left, seed))
        nodes = nodes.select(F.explode(F.array(
            F.struct((F.col("node") * 2).alias("node"), head.alias("rows"),
                     F.col("got").alias("sizes")),
            F.struct((F.col("node") * 2 + 1).alias("node"),
                     F.slice("rows", half + 1, half).alias("rows"),
                     F.zip_with("sizes", "got", lambda a, b: a - b).alias("sizes")),
        )).alias("c")).select("c.*")
        width, level = half, level + 1
        if level == 3 or width == 1:
            nodes = materialize(nodes, "nodes")
            if level == 3 and width > 1:  # from here on there are nodes enough to share out
                nodes = nodes.repartition("node")
    return nodes.select((F.col("node") - n_blocks).cast("int").alias("block"),
                        F.col("sizes").alias("counts"))


def keyed(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, size, text_crc32`` of each row: all that the shuffle needs to know of it."""
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.col(key), (F.octet_length(value) + 16).cast("bigint").alias("size"),
                       F.crc32(value.cast("binary")).alias("text_crc32"))


def shuffle_to_shards(rows: DataFrame, shards: int, key: str = "doc_id", seed: int = 17,
                      n_blocks: int | None = None) -> DataFrame:
    """``rows`` (of ``keyed``) with ``shard`` and ``slot``; every order is as likely as another.

    ``n_blocks`` defaults to the session's shuffle partitions, made a power of two.
    """
    spark = rows.sparkSession
    wanted = n_blocks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_blocks = 1 << max(0, wanted - 1).bit_length()
    identity = [F.col(key), F.col("text_crc32"), F.col("size")]
    # The ID of the written row only tells equal rows apart, so that ranges can part them.
    written = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), "keyed")
    numbered = dense_index(written, [*identity, F.col("_row")], name="_number").drop("_row")
    rows = materialize(numbered.withColumn("block", F.pmod(
        F.xxhash64(F.lit(seed), "_number"), F.lit(n_blocks)).cast("int")), "numbered")
    matrix = count_matrix(rows.groupBy("block").agg(F.count("*").alias("n")),
                          n_blocks, shards, seed)
    ends = matrix.select("block", F.transform("counts", lambda x, i: F.aggregate(
        F.slice("counts", 1, i + 1), F.lit(0).cast("bigint"), lambda a, b: a + b)).alias("ends"))
    local = Window.partitionBy("block").orderBy(
        F.xxhash64(F.lit(seed + 1), "_number"), "_number")
    dealt = (
        rows.withColumn("i", F.row_number().over(local) - 1)
        .join(ends, "block")
        .withColumn("shard", F.size(F.filter("ends", lambda e: e <= F.col("i"))))
        .select(*rows.drop("block").columns, "shard")
    )
    again = F.xxhash64(F.lit(seed + 2), "_number")
    return dense_index(dealt.withColumn("_order", again), [F.col("_order"), F.col("_number")],
                       by=["shard"], name="slot").drop("_order", "_number")
