"""Evaluation of scored rows ``(model, ID, label, prediction, score)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tonemill.constants import BATCH_SIZE
from tonemill.functions.scores import row_log_loss
from tonemill.operators.batches import sequential_batches
from tonemill.plans.ranges import PART, attach_summary, preceding, range_sorted, within


def _ratio(top: Column, bottom: Column) -> Column:
    """Quotient, or 0 where it is undefined."""
    return F.when(bottom == 0, F.lit(0.0)).otherwise(top / bottom)


def _count_if(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def _f1(precision: Column, recall: Column) -> Column:
    return _ratio(2.0 * precision * recall, precision + recall)


def binary_metrics(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Accuracy, precision, recall and F1 of class 1; 0 where undefined. One aggregation."""
    hit, said, true = F.col("label") == F.col("prediction"), F.col("prediction") == 1, F.col("label") == 1
    counts = scored.groupBy(*(by or [])).agg(
        F.count("*").alias("n"), _count_if(hit).alias("hits"),
        _count_if(said & true).alias("tp"), _count_if(said & ~true).alias("fp"),
        _count_if(~said & true).alias("fn"))
    precision = _ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    recall = _ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    return counts.select(
        *(by or []), "n", _ratio(F.col("hits"), F.col("n")).alias("accuracy"),
        precision.alias("precision"), recall.alias("recall"), _f1(precision, recall).alias("f1"))


def confusion_matrix(scored: DataFrame, classes: tuple[int, ...] = (0, 1)) -> DataFrame:
    """Counts for every pair of true and predicted class, 0 where empty."""
    counts = scored.agg(*[
        _count_if((F.col("label") == t) & (F.col("prediction") == p)).alias(f"c_{t}_{p}")
        for t in classes for p in classes])
    cells = F.array(*[
        F.struct(F.lit(t).alias("label"), F.lit(p).alias("prediction"),
                 F.coalesce(F.col(f"c_{t}_{p}"), F.lit(0)).alias("n"))
        for t in classes for p in classes])
    return counts.select(F.inline(cells))


def classification_report(scored: DataFrame, classes: tuple[int, ...] = (0, 1)) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy, macro and weighted means."""
    counts = scored.agg(
        F.count("*").alias("n"), _count_if(F.col("label") == F.col("prediction")).alias("hits"),
        *[_count_if((F.col("label") == c) & (F.col("prediction") == c)).alias(f"tp_{c}") for c in classes],
        *[_count_if(F.col("prediction") == c).alias(f"said_{c}") for c in classes],
        *[_count_if(F.col("label") == c).alias(f"true_{c}") for c in classes])

    def line(name: str, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
        return F.struct(F.lit(name).alias("class"), precision.alias("precision"),
                        recall.alias("recall"), f1.alias("f1"), support.alias("support"))

    per_class = {}
    for c in classes:
        p = _ratio(F.col(f"tp_{c}"), F.col(f"said_{c}"))
        r = _ratio(F.col(f"tp_{c}"), F.col(f"true_{c}"))
        per_class[c] = (p, r, _f1(p, r), F.col(f"true_{c}"))

    def macro(i: int) -> Column:
        return sum((v[i] for v in per_class.values()), F.lit(0.0)) / float(len(classes))

    def weighted(i: int) -> Column:
        return _ratio(sum((v[i] * v[3] for v in per_class.values()), F.lit(0.0)), F.col("n"))

    accuracy = _ratio(F.col("hits"), F.col("n"))
    n = F.col("n")
    lines = [line(str(c), *v) for c, v in per_class.items()]
    lines += [line("accuracy", accuracy, accuracy, accuracy, n),
              line("macro avg", macro(0), macro(1), macro(2), n),
              line("weighted avg", weighted(0), weighted(1), weighted(2), n)]
    return counts.select(F.inline(F.array(*lines)))


def performance_gap(scored: DataFrame) -> DataFrame:
    """Training accuracy minus validation accuracy, from one aggregation by split."""
    hit = (F.col("label") == F.col("prediction")).cast("double")
    return (scored.agg(
        F.avg(F.when(F.col("split") == "train", hit)).alias("train_accuracy"),
        F.avg(F.when(F.col("split") == "val", hit)).alias("val_accuracy"))
        .withColumn("gap", F.col("train_accuracy") - F.col("val_accuracy")))


def cumulative_scores(scored: DataFrame) -> DataFrame:
    """True and false positives at each distinct score of each model, from the highest down.

    Rows are reduced to distinct scores first; running totals are made per score range and
    shifted by the totals of the ranges before.
    """
    by, order = ["model"], [F.desc("score")]
    per_score = scored.groupBy("model", "score").agg(
        F.sum(F.col("label").cast("long")).alias("pos"),
        F.sum(1 - F.col("label").cast("long")).alias("neg"))
    parts = range_sorted(per_score, by, order)
    summary = parts.groupBy("model", PART).agg(
        F.sum("pos").alias("sp"), F.sum("neg").alias("sn"),
        F.max_by(F.struct("pos", "neg"), "score").alias("head"))
    every = Window.partitionBy("model")
    summary = summary.select(
        "model", PART,
        F.coalesce(F.sum("sp").over(preceding(by)), F.lit(0)).alias("base_p"),
        F.coalesce(F.sum("sn").over(preceding(by)), F.lit(0)).alias("base_n"),
        F.sum("sp").over(every).alias("n_pos"), F.sum("sn").over(every).alias("n_neg"),
        F.lead("head").over(Window.partitionBy("model").orderBy(PART)).alias("next_head"))
    rows = attach_summary(parts, summary, by)
    run = within(by, order)
    step = Window.partitionBy("model", PART).orderBy(*order)
    return rows.select(
        "model", "score", "pos", "neg", "n_pos", "n_neg",
        (F.col("base_p") + F.sum("pos").over(run)).alias("tp"),
        (F.col("base_n") + F.sum("neg").over(run)).alias("fp"),
        F.coalesce(F.lead(F.struct("pos", "neg")).over(step), F.col("next_head")).alias("next"))


def roc_points(scored: DataFrame) -> DataFrame:
    """ROC corners per model, with ``(0, 0)`` at threshold +infinity.

    A point on the straight line between its neighbours is left out: it is one whose step up
    and step right equal those of the next distinct score. First and last points stay.
    """
    steps = cumulative_scores(scored)
    first = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
    bend = (F.col("next.pos") != F.col("pos")) | (F.col("next.neg") != F.col("neg"))
    corner = F.struct(F.col("score").alias("threshold"),
                      F.try_divide("fp", "n_neg").alias("fpr"),
                      F.try_divide("tp", "n_pos").alias("tpr"))
    origin = F.struct(F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"),
                      F.lit(0.0).alias("tpr"))
    points = F.when(first, F.array(origin, corner)).otherwise(F.array(corner))
    return (steps.filter(first | F.col("next").isNull() | bend)
            .select("model", F.inline(points)))


def roc_auc(scored: DataFrame) -> DataFrame:
    """Trapezoid area under the curve; equal scores count half, one class alone gives null."""
    area = F.col("neg") * (F.col("tp") - F.col("pos") / 2.0)
    return (cumulative_scores(scored).groupBy("model")
            .agg(F.try_divide(F.try_divide(F.sum(area), F.first("n_pos")), F.first("n_neg"))
                 .alias("auc")))


def compare_models(scored: DataFrame) -> DataFrame:
    """Models ranked by accuracy. One row per model reaches the ranking window."""
    table = binary_metrics(scored, ["model"])
    return table.withColumn("rank", F.rank().over(Window.orderBy(F.desc("accuracy"))))


def batch_accuracy(scored: DataFrame, size: int = BATCH_SIZE) -> DataFrame:
    """Accuracy per batch in ID order, then the plain mean over batches."""
    hit = (F.col("label") == F.col("prediction")).cast("double")
    return (sequential_batches(scored, size).groupBy("batch").agg(F.avg(hit).alias("acc"))
            .agg(F.count("*").alias("n_batches"), F.avg("acc").alias("batch_accuracy")))


def log_loss(rows: DataFrame, logit: str = "logit", label: str = "label") -> DataFrame:
    """Mean binary cross-entropy over rows."""
    return rows.agg(F.avg(row_log_loss(F.col(logit), F.col(label))).alias("log_loss"))


def batch_log_loss(rows: DataFrame, logit: str = "logit", label: str = "label",
                   size: int = BATCH_SIZE) -> DataFrame:
    """Mean of per-batch mean losses; a short last batch weighs as much as the others."""
    loss = row_log_loss(F.col(logit), F.col(label))
    return (sequential_batches(rows, size).groupBy("batch").agg(F.avg(loss).alias("loss"))
            .agg(F.avg("loss").alias("batch_log_loss")))
