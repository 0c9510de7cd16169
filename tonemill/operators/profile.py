"""Corpus profile: class balance, lengths, vocabularies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonemill.constants import HIST_BINS, KDE_POINTS, TOP_N
from tonemill.functions.tokens import char_length, word_count, ws_tokens


def class_counts(df: DataFrame, label: str = "Label") -> DataFrame:
    return df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))


def class_share(df: DataFrame, split: str = "split", label: str = "Label") -> DataFrame:
    """Share of each label within its split, missing labels left out."""
    counts = (df.filter(F.col(label).isNotNull())
              .groupBy(split, label).agg(F.count("*").alias("n")))
    totals = counts.groupBy(split).agg(F.sum("n").alias("total"))
    return counts.join(totals, split).select(
        split, label, "n", (F.col("n") / F.col("total")).alias("share"))


def text_stats(df: DataFrame, raw: str = "Text", cleaned: str = "Processed") -> DataFrame:
    """Mean words and characters before and after cleaning, in one pass."""
    return df.agg(
        F.avg(word_count(F.col(raw))).alias("avg_words_raw"),
        F.avg(char_length(F.col(raw))).alias("avg_chars_raw"),
        F.avg(word_count(F.col(cleaned))).alias("avg_words_cleaned"),
        F.avg(char_length(F.col(cleaned))).alias("avg_chars_cleaned"),
    )


def token_rows(df: DataFrame, tokens: Column, keep: list[str] | None = None) -> DataFrame:
    """One row per token occurrence; rows without tokens give none."""
    return df.select(*(keep or []), F.explode(tokens).alias("token"))


def distinct_tokens(df: DataFrame, text: str) -> DataFrame:
    return token_rows(df, ws_tokens(F.col(text))).distinct()


def variant_tokens(df: DataFrame, raw: str = "Text", cleaned: str = "Processed") -> DataFrame:
    """Distinct ``(variant, token)`` of raw and cleaned text, from one scan of the table."""
    return _variant_rows(df, raw, cleaned).distinct()


def part_tokens(df: DataFrame, part: str, raw: str = "Text", cleaned: str = "Processed") -> DataFrame:
    """Distinct ``(part, variant, token)``, from one scan of the table."""
    return _variant_rows(df, raw, cleaned, [F.col(part).alias("part")]).distinct()


def _variant_rows(df: DataFrame, raw: str, cleaned: str, keep: list[Column] | None = None) -> DataFrame:
    pairs = F.array(*[
        F.struct(F.lit(name).alias("variant"), F.array_distinct(ws_tokens(F.col(c))).alias("tokens"))
        for name, c in (("raw", raw), ("cleaned", cleaned))
    ])
    rows = df.select(*(keep or []), F.inline(pairs))
    return rows.select(*[c for c in rows.columns if c != "tokens"], F.explode("tokens").alias("token"))


def vocab_size(df: DataFrame, raw: str = "Text", cleaned: str = "Processed",
               approximate: bool = False) -> DataFrame:
    """Number of distinct tokens before and after cleaning."""
    if approximate:
        pairs = F.array(*[
            F.struct(F.lit(name).alias("variant"), ws_tokens(F.col(c)).alias("tokens"))
            for name, c in (("raw", raw), ("cleaned", cleaned))
        ])
        rows = df.select(F.inline(pairs)).select("variant", F.explode("tokens").alias("token"))
        return rows.groupBy("variant").agg(F.approx_count_distinct("token").alias("n_tokens"))
    return count_variants(variant_tokens(df, raw, cleaned))


def count_variants(tokens: DataFrame) -> DataFrame:
    """``variant, n_tokens`` from distinct ``(variant, token)``."""
    return tokens.groupBy("variant").agg(F.count("*").alias("n_tokens"))


def token_counts(df: DataFrame, text: str = "Processed") -> DataFrame:
    """Occurrences of each token; partial counts are made before the shuffle."""
    return token_rows(df, ws_tokens(F.col(text))).groupBy("token").agg(F.count("*").alias("n"))


def top_tokens(df: DataFrame, text: str = "Processed", n: int = TOP_N) -> DataFrame:
    """The ``n`` most frequent tokens, ties by token."""
    return token_counts(df, text).orderBy(F.desc("n"), "token").limit(n)


RAW, CLEANED = 1, 2


def cleaning_effect(df: DataFrame, raw: str = "Text", cleaned: str = "Processed") -> DataFrame:
    """``token, found``: each distinct token with a bit for raw and one for cleaned texts.

    One scan and one shuffle, in which the bits of a token are or-ed before and after.
    """
    def marked(text: str, bit: int) -> Column:
        return F.transform(F.array_distinct(ws_tokens(F.col(text))), lambda t: F.struct(
            t.alias("token"), F.lit(bit).alias("bit")))

    both = F.concat(marked(raw, RAW), marked(cleaned, CLEANED))
    return df.select(F.inline(both)).groupBy("token").agg(F.bit_or("bit").alias("found"))


def vocab_removed(effect: DataFrame) -> DataFrame:
    """Tokens that cleaning made disappear."""
    return effect.filter(F.col("found") == RAW).select("token")


def vocab_kept(effect: DataFrame) -> DataFrame:
    """Tokens that texts have before and after cleaning."""
    return effect.filter(F.col("found") == RAW + CLEANED).select("token")


SKETCH_K = 14
#: Relative standard error of an estimate from a sketch of ``2 ** SKETCH_K`` registers.
SKETCH_ERROR = 0.0082


def token_sketches(df: DataFrame, part: str, raw: str = "Text", cleaned: str = "Processed") -> DataFrame:
    """``part, variant, sketch``: distinct tokens of every part of the table as a mergeable sketch.

    Sketches of parts can be kept in a table. A new part, such as a file, is sketched alone and
    added to it, without reading the others again.
    """
    return sketch_tokens(part_tokens(df, part, raw, cleaned))


def sketch_tokens(tokens: DataFrame) -> DataFrame:
    """The same from ``part, variant, token``."""
    return tokens.groupBy("part", "variant").agg(F.hll_sketch_agg("token", SKETCH_K).alias("sketch"))


def united_size(sketches: DataFrame) -> DataFrame:
    """``variant, n_tokens``: about how many distinct tokens all parts have together."""
    return sketches.groupBy("variant").agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_tokens"))


def oov_tokens(vocab: DataFrame, vectors: DataFrame) -> DataFrame:
    """Tokens that have no word vector."""
    return vocab.join(vectors.select("token"), "token", "left_anti")


def oov_rate(variants: DataFrame, vectors: DataFrame) -> DataFrame:
    """Share of distinct tokens without a word vector, per variant of the text."""
    known = vectors.select("token", F.lit(1).alias("known"))
    return (variants.join(known, "token", "left").groupBy("variant")
            .agg(F.count("*").alias("n_tokens"),
                 F.sum(F.col("known").isNull().cast("long")).alias("n_oov"),
                 F.avg(F.col("known").isNull().cast("double")).alias("oov_rate")))


def _with_range(lengths: DataFrame, by: str, common_range: bool) -> DataFrame:
    """``(by, length, n, lo, hi)``: one row per distinct length, with the global or group range."""
    counts = lengths.groupBy(by, "length").agg(F.count("*").alias("n"))
    lo, hi = F.min("length").alias("lo"), F.max("length").alias("hi")
    if not common_range:
        return counts.join(counts.groupBy(by).agg(lo, hi), by)
    span = counts.agg(F.struct(lo, hi)).scalar()
    return counts.withColumn("span", span).select(by, "length", "n", "span.lo", "span.hi")


def length_histogram(lengths: DataFrame, by: str = "Label", bins: int = HIST_BINS,
                     common_range: bool = True) -> DataFrame:
    """Equal-width bins over the global (or each group's) range; the last bin is closed.

    ``lengths`` has an integer ``length``, so bins are found in whole numbers, free of
    rounding. Empty bins are listed with 0.
    """
    width = F.col("hi") - F.col("lo")
    offset = (F.col("length") - F.col("lo")).cast("long") * bins
    bin_no = F.when(width == 0, F.lit(bins // 2)).otherwise(
        F.least(F.call_function("div", offset, F.greatest(width, F.lit(1)).cast("long")),
                F.lit(bins - 1)))
    filled = (_with_range(lengths, by, common_range).withColumn("bin", bin_no.cast("int"))
              .groupBy(by, "lo", "hi", "bin").agg(F.sum("n").alias("n"))
              .groupBy(by, "lo", "hi")
              .agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("filled")))
    step = F.when(width == 0, F.lit(1.0 / bins)).otherwise(width / float(bins))
    start = F.when(width == 0, F.col("lo") - 0.5).otherwise(F.col("lo").cast("double"))
    return (filled
            .withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
            .select(by, "bin",
                    (start + F.col("bin") * step).alias("bin_start"),
                    (start + (F.col("bin") + 1) * step).alias("bin_end"),
                    F.coalesce(F.try_element_at("filled", F.col("bin")), F.lit(0)).alias("n")))


REACH = 9.0


def length_density(lengths: DataFrame, by: str = "Label", bins: int = HIST_BINS,
                   points: int = KDE_POINTS) -> DataFrame:
    """Gaussian kernel density of length per group on an even grid, scaled to histogram counts.

    Rows are first reduced to distinct lengths with counts; each then adds its kernel to the
    grid points within ``REACH`` bandwidths, beyond which it has less than 1e-17 of its height. Bandwidth is Scott's rule with the sample standard deviation. A group of one row or of
    equal lengths has no bandwidth and gets no curve.
    """
    counts = _with_range(lengths, by, True)
    mean = F.sum(F.col("n") * F.col("length")) / F.sum("n")
    square = F.sum(F.col("n") * F.col("length").cast("double") * F.col("length"))
    total = F.sum("n")
    stats = counts.groupBy(by).agg(
        total.alias("total"),
        F.when(F.min("length") < F.max("length"), F.sqrt(
            F.try_divide(square - total * mean * mean, total - 1))
            * F.pow(total.cast("double"), F.lit(-0.2))).alias("bandwidth")
    ).filter(F.col("bandwidth").isNotNull())
    width = (F.col("hi") - F.col("lo")).cast("double")
    step = F.greatest(width / float(points - 1), F.lit(1e-300))
    reach = F.lit(REACH) * F.col("bandwidth")
    first = F.greatest(F.ceil((F.col("length") - reach - F.col("lo")) / step), F.lit(0))
    last = F.least(F.floor((F.col("length") + reach - F.col("lo")) / step), F.lit(points - 1))
    band = F.when(first <= last, F.sequence(first.cast("int"), last.cast("int")))
    x = F.col("lo") + F.col("point") * width / float(points - 1)
    u = (x - F.col("length")) / F.col("bandwidth")
    root = F.lit(2.5066282746310002)  # sqrt(2 pi)
    kernel = F.col("n") * F.exp(-0.5 * u * u) / (F.col("bandwidth") * root)
    sums = (counts.join(stats, by).withColumn("point", F.explode(band))
            .groupBy(by, "point").agg(F.sum(kernel).alias("mass")))
    grid = (counts.groupBy(by).agg(F.first("lo").alias("lo"), F.first("hi").alias("hi")).join(stats, by)
            .withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1)))))
    return grid.join(sums, [by, "point"], "left").select(
        by, "point", x.alias("x"), (F.coalesce("mass", F.lit(0.0)) * width / float(bins)).alias("density"))


def limit_share(lengths: DataFrame, limit: int, by: str = "split") -> DataFrame:
    """How many rows of each split are longer than ``limit``."""
    over = F.col("length") > limit
    return lengths.groupBy(by).agg(
        F.count("*").alias("n_rows"), F.max("length").alias("max_length"),
        F.avg(over.cast("double")).alias("share_over"))
