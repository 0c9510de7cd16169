"""Corpus profile, vocabularies, rows of splits, batches and folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from tonemill.constants import (BATCH_SIZE, CURVE_STEPS, FOLDS, HIST_BINS, KDE_POINTS, SEED,
                                TOP_N)
from tonemill.functions.tokens import char_length
from tonemill.operators import batches, profile, rows, trials
from tonemill.plans.materialize import materialize
from tonemill.queries import corpus, sql
from tonemill.queries.registry import query

_LABEL_SPLIT = f"""
SELECT d.doc_id AS ID, l.quality AS Label, d.n_chars, {sql.SPLIT_OF} AS split
FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""


@query("class_counts", "SELECT quality AS Label, count(*) AS n FROM labels WHERE quality IS NOT NULL GROUP BY quality")
def class_counts(spark, sf):
    return profile.class_counts(corpus.labels(spark, sf))


@query("class_share", f"""
SELECT split, Label, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY split), 6) AS share
FROM ({_LABEL_SPLIT}) GROUP BY split, Label""")
def class_share(spark, sf):
    return profile.class_share(corpus.label_rows(spark, sf)).withColumn("share", F.round("share", 6))


@query("text_stats", f"""
SELECT round(avg(len({sql.tokens('Text')})), 6) AS avg_words_raw, round(avg(length(Text)), 6) AS avg_chars_raw,
       round(avg(len({sql.tokens('Processed')})), 6) AS avg_words_cleaned,
       round(avg(length(Processed)), 6) AS avg_chars_cleaned FROM ({sql.cleaned()})""")
def text_stats(spark, sf):
    stats = profile.text_stats(corpus.cleaned(spark, sf))
    return stats.select(*[F.round(c, 6).alias(c) for c in stats.columns])


_VARIANTS = f"""
SELECT DISTINCT variant, token FROM (
  SELECT 'raw' AS variant, unnest({sql.tokens('Text')}) AS token FROM ({sql.DOCS})
  UNION ALL SELECT 'cleaned', unnest({sql.tokens('Processed')}) FROM ({sql.cleaned()}))"""


@query("vocab_size", f"SELECT variant, count(*) AS n_tokens FROM ({_VARIANTS}) GROUP BY variant")
def vocab_size(spark, sf):
    return profile.vocab_size(corpus.cleaned(spark, sf))


@query("vocab_size_sketch", f"""
SELECT variant, count(*) AS n_exact, (SELECT count(DISTINCT source) FROM documents) AS parts,
       TRUE AS within_error FROM ({_VARIANTS}) GROUP BY variant""")
def vocab_size_sketch(spark, sf):
    """Distinct tokens from one sketch per source, united, beside the exact number: the estimate
    must lie within three standard errors of it."""
    docs = rows.clean(corpus.table(spark, sf, "documents").select(F.col("text").alias("Text"), "source"), "embedding")
    # Written, since sketches and the exact number are both taken from them: texts are cleaned once.
    tokens = materialize(profile.part_tokens(docs, "source"), "tokens")
    sketches = materialize(profile.sketch_tokens(tokens), "sketches")
    parts = sketches.groupBy("variant").agg(F.count("part").alias("parts"))
    exact = profile.count_variants(tokens.select("variant", "token").distinct()).withColumnRenamed("n_tokens", "n_exact")
    return profile.united_size(sketches).join(exact, "variant").join(parts, "variant").select(
        "variant", "n_exact", "parts",
        (F.abs(F.col("n_tokens") / F.col("n_exact") - 1) <= 3 * profile.SKETCH_ERROR).alias("within_error"))


@query("token_counts", sql.token_counts())
def token_counts(spark, sf):
    return profile.token_counts(corpus.cleaned(spark, sf))


@query("top_tokens", f"{sql.token_counts()} ORDER BY n DESC, token LIMIT {TOP_N}")
def top_tokens(spark, sf):
    return profile.top_tokens(corpus.cleaned(spark, sf))


@query("distinct_tokens", f"SELECT token FROM ({_VARIANTS}) WHERE variant = 'raw'")
def distinct_tokens(spark, sf):
    return profile.distinct_tokens(corpus.documents(spark, sf), "Text")


@query("vocab_removed", f"SELECT token FROM ({_VARIANTS}) WHERE variant = 'raw' "
                        f"EXCEPT SELECT token FROM ({_VARIANTS}) WHERE variant = 'cleaned'")
def vocab_removed(spark, sf):
    return profile.vocab_removed(profile.cleaning_effect(corpus.cleaned(spark, sf)))


@query("vocab_kept", f"SELECT token FROM ({_VARIANTS}) WHERE variant = 'raw' "
                     f"INTERSECT SELECT token FROM ({_VARIANTS}) WHERE variant = 'cleaned'")
def vocab_kept(spark, sf):
    return profile.vocab_kept(profile.cleaning_effect(corpus.cleaned(spark, sf)))


_LENGTHS = f"SELECT ID, Label, length(Text) AS length FROM ({sql.LABELLED})"


def _text_lengths(spark, sf):
    return corpus.labelled(spark, sf).select("Label", char_length(F.col("Text")).alias("length"))


@query("length_hist", f"""
WITH x AS ({_LENGTHS}), s AS (SELECT min(length) AS lo, max(length) AS hi FROM x),
b AS (SELECT Label, least((length - lo) * {HIST_BINS} // (hi - lo), {HIST_BINS - 1}) AS bin, count(*) AS n
      FROM x, s GROUP BY ALL),
g AS (SELECT DISTINCT Label, unnest(range({HIST_BINS})) AS bin FROM x)
SELECT g.Label, CAST(g.bin AS INTEGER) AS bin, round(lo + g.bin * ((hi - lo) / {HIST_BINS}.0::DOUBLE), 6) AS bin_start,
       round(lo + (g.bin + 1) * ((hi - lo) / {HIST_BINS}.0::DOUBLE), 6) AS bin_end, CAST(coalesce(b.n, 0) AS BIGINT) AS n
FROM g CROSS JOIN s LEFT JOIN b ON g.Label = b.Label AND g.bin = b.bin""")
def length_hist(spark, sf):
    return profile.length_histogram(_text_lengths(spark, sf)).select(
        "Label", "bin", F.round("bin_start", 6).alias("bin_start"),
        F.round("bin_end", 6).alias("bin_end"), "n")


@query("length_kde", f"""
WITH x AS ({_LENGTHS}), s AS (SELECT min(length) AS lo, max(length) AS hi FROM x),
c AS (SELECT Label, count(*) AS n, stddev_samp(length) * pow(count(*), -0.2) AS h FROM x GROUP BY Label),
g AS (SELECT p AS point, lo + p * (hi - lo) / {KDE_POINTS - 1}.0::DOUBLE AS at, (hi - lo) / {HIST_BINS}.0::DOUBLE AS w
      FROM s, (SELECT unnest(range({KDE_POINTS})) AS p))
SELECT x.Label, CAST(g.point AS INTEGER) AS point, round(any_value(g.at), 6) AS x,
       round(sum(exp(-0.5 * pow((g.at - x.length) / c.h, 2)) / (c.h * sqrt(2 * pi()))) * any_value(g.w), 6) AS density
FROM x JOIN c ON x.Label = c.Label CROSS JOIN g GROUP BY x.Label, g.point""")
def length_kde(spark, sf):
    return profile.length_density(_text_lengths(spark, sf)).select(
        "Label", "point", F.round("x", 6).alias("x"), F.round("density", 6).alias("density"))


@query("union_splits", sql.SPLITS)
def union_splits(spark, sf):
    return corpus.splits(spark, sf).select("split", "ID", "Text")


@query("attach_labels", sql.LABELLED)
def attach_labels(spark, sf):
    return rows.attach_labels(corpus.documents(spark, sf), corpus.labels(spark, sf))


@query("attach_predictions", f"""
SELECT d.doc_id AS ID, d.lang, s.prediction FROM documents d JOIN ({sql.SCORED}) s ON d.doc_id = s.ID""")
def attach_predictions(spark, sf):
    docs = corpus.table(spark, sf, "documents").select(F.col("doc_id").alias("ID"), "lang")
    return rows.attach_predictions(docs, corpus.scored(spark, sf).select("ID", "prediction"))


# --- word vectors ------------------------------------------------------------------------

@query("oov_tokens", f"""
SELECT token FROM ({_VARIANTS}) WHERE variant = 'cleaned' AND token NOT IN (SELECT token FROM ({sql.VECTORS}))""")
def oov_tokens(spark, sf):
    vocab = profile.distinct_tokens(corpus.cleaned(spark, sf), "Processed")
    return profile.oov_tokens(vocab, corpus.word_vectors(spark, sf))


@query("oov_rate", f"""
SELECT v.variant, count(*) AS n_tokens, CAST(sum(CAST(k.token IS NULL AS INTEGER)) AS BIGINT) AS n_oov,
       round(avg(CAST(k.token IS NULL AS INTEGER)), 6) AS oov_rate
FROM ({_VARIANTS}) v LEFT JOIN ({sql.VECTORS}) k ON v.token = k.token GROUP BY v.variant""")
def oov_rate(spark, sf):
    variants = profile.variant_tokens(corpus.cleaned(spark, sf))
    return (profile.oov_rate(variants, corpus.word_vectors(spark, sf))
            .withColumn("oov_rate", F.round("oov_rate", 6)))


# --- order: batches, samples, folds, trials ----------------------------------------------

@query("sequential_batches", f"""
SELECT ID, row_number() OVER (ORDER BY ID) - 1 AS idx, (row_number() OVER (ORDER BY ID) - 1) // {BATCH_SIZE} AS batch
FROM ({sql.DOCS})""")
def sequential_batches(spark, sf):
    return batches.sequential_batches(_ids(spark, sf))


def _ids(spark, sf):
    return corpus.table(spark, sf, "documents").select(F.col("doc_id").alias("ID"))


_HASH = f"md5('{SEED}:' || CAST(ID AS VARCHAR))"


@query("shuffled_batches", f"""
WITH x AS (SELECT ID, row_number() OVER (ORDER BY {_HASH}, ID) - 1 AS idx FROM ({sql.DOCS}))
SELECT ID, idx, idx // {BATCH_SIZE} AS batch FROM x""")
def shuffled_batches(spark, sf):
    return batches.shuffled_batches(_ids(spark, sf))

def _epochs(epochs: int, size: int) -> str:
    """SQL of the same network: shifts in turn, and walks back into range by recursion."""
    shifts = ["x // h AS u0", "x % h AS v0"]
    for r in range(batches.PERMUTE_ROUNDS):
        for part, turn, other, modulus in (("u", 2 * r, f"v{r}", "w"), ("v", 2 * r + 1, f"u{r + 1}", "h")):
            digits = f"substr(md5('{SEED}:' || epoch || ':{turn}:' || {other}), 1, 8)"
            shifts.append(f"({part}{r} + CAST('0x' || {digits} AS BIGINT)) % {modulus} AS {part}{r + 1}")
    last = batches.PERMUTE_ROUNDS
    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id AS ID, row_number() OVER (ORDER BY doc_id) - 1 AS idx, count(*) OVER () AS n FROM documents),
sized AS (SELECT *, CAST(ceil(sqrt(n)) AS BIGINT) AS w FROM d),
walk AS (
  SELECT ID, CAST(epoch AS INTEGER) AS epoch, n, w, CAST(ceil(n / w) AS BIGINT) AS h, idx AS x, FALSE AS sent
  FROM sized, range({epochs}) t(epoch)
  UNION ALL
  SELECT ID, epoch, n, w, h, u{last} * h + v{last}, TRUE
  FROM (SELECT *, {", ".join(shifts)} FROM walk WHERE NOT sent OR x >= n))
SELECT ID, epoch, x AS place, x // {size} AS batch FROM walk WHERE sent AND x < n"""


@query("epoch_batches_4", _epochs(4, 64))
def epoch_batches_4(spark, sf):
    """Batches of an encoder's four epochs, a new order in each."""
    return batches.epoch_batches(_ids(spark, sf), 4, 64).select("ID", "epoch", "place", "batch")


@query("epoch_batches_30", _epochs(30, 128))
def epoch_batches_30(spark, sf):
    """The same for the thirty epochs of a net."""
    return batches.epoch_batches(_ids(spark, sf), 30, 128).select("ID", "epoch", "place", "batch")


@query("stratified_sample", f"""
WITH x AS (SELECT ID, Label, row_number() OVER (PARTITION BY Label ORDER BY {_HASH}, ID) AS rn FROM ({sql.LABELLED})),
c AS (SELECT Label, count(*) AS n FROM x GROUP BY Label),
t AS (SELECT CAST(sum(n) AS BIGINT) AS total, CAST(floor(sum(n) * 0.05::DOUBLE) AS BIGINT) AS take FROM c),
s AS (SELECT Label, take, take * n // total AS part,
             row_number() OVER (ORDER BY take * n % total DESC, Label NULLS FIRST) AS turn FROM c, t),
q AS (SELECT Label, part + CAST(turn <= take - sum(part) OVER () AS BIGINT) AS quota FROM s)
SELECT x.ID, x.Label FROM x JOIN q ON x.Label IS NOT DISTINCT FROM q.Label WHERE x.rn <= q.quota""")
def stratified_sample(spark, sf):
    labelled = corpus.label_rows(spark, sf).select("ID", "Label")
    return batches.stratified_sample(labelled, 0.05)


# Deal the rows, sorted by class in order of first appearance, to the folds in turn; each class
# then fills its folds in row order.
_FOLDS = f"""
WITH x AS ({sql.LABELLED}),
c AS (SELECT Label, min(ID) AS first FROM x GROUP BY Label),
dealt AS (SELECT Label, (row_number() OVER (ORDER BY first, ID) - 1) % {FOLDS} AS fold
          FROM x JOIN c USING (Label)),
f AS (SELECT Label, fold, row_number() OVER (PARTITION BY Label ORDER BY fold) AS rn FROM dealt)
SELECT x.ID, x.Label, CAST(f.fold AS INTEGER) AS fold
FROM (SELECT ID, Label, row_number() OVER (PARTITION BY Label ORDER BY ID) AS rn FROM x) x
JOIN f ON x.Label = f.Label AND x.rn = f.rn"""


@query("stratified_folds", _FOLDS)
def stratified_folds(spark, sf):
    return batches.stratified_folds(corpus.label_rows(spark, sf).select("ID", "Label")).select(
        "ID", "Label", "fold")


@query("prefix_sizes", f"""
WITH folds AS ({_FOLDS}),
p AS (SELECT h.held_out, f.ID, f.Label,
             row_number() OVER (PARTITION BY h.held_out ORDER BY f.ID) - 1 AS position
      FROM folds f, (SELECT unnest(range({FOLDS})) AS held_out) h WHERE f.fold <> h.held_out),
s AS (SELECT step, greatest(n * step // {CURVE_STEPS}, 1) AS n_train
      FROM (SELECT count(*) AS n FROM p WHERE held_out = 0), (SELECT unnest(range(1, {CURVE_STEPS + 1})) AS step))
SELECT CAST(step AS INTEGER) AS step, CAST(held_out AS INTEGER) AS held_out, n_train,
       count(*) AS n_rows, CAST(sum(Label) AS BIGINT) AS n_positive
FROM s JOIN p ON p.position < s.n_train GROUP BY ALL""")
def prefix_sizes(spark, sf):
    """How many rows and positives each growing training prefix of each fold holds."""
    rows_ = batches.stratified_folds(corpus.label_rows(spark, sf).select("ID", "Label"))
    positions = batches.training_positions(rows_)
    # Counts by first step are few; each then counts for its own and all later steps.
    counts = (batches.first_step(positions).groupBy("held_out", "step")
              .agg(F.count("*").alias("n_rows"), F.sum("Label").alias("n_positive"))
              .filter(F.col("step") <= CURVE_STEPS)
              .withColumn("step", F.explode(F.sequence(F.col("step"), F.lit(CURVE_STEPS))))
              .groupBy("held_out", "step")
              .agg(F.sum("n_rows").alias("n_rows"), F.sum("n_positive").alias("n_positive")))
    return counts.join(batches.prefix_sizes(positions), "step")


@query("running_best", """
WITH x AS (SELECT user_id AS study, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS trial
           FROM events),
m AS (SELECT *, max(value) OVER (PARTITION BY study ORDER BY trial) AS best_value FROM x),
f AS (SELECT study, value, min(trial) AS first FROM x GROUP BY study, value)
SELECT m.study, m.trial, m.value, m.best_value, f.first AS best_trial
FROM m JOIN f ON m.study = f.study AND m.best_value = f.value""")
def running_best(spark, sf):
    return trials.running_best(corpus.trials(spark, sf))
