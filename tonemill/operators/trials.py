"""Tuning trials: the best value so far."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonemill.plans.ranges import PART, attach_summary, preceding, range_sorted, within


def running_best(trials: DataFrame, study: str = "study", trial: str = "trial",
                 value: str = "value") -> DataFrame:
    """After each trial, the best value of its study so far and the trial that reached it first.

    A study may be large: it is cut into ranges, and each range starts from the best of the
    ranges before it.
    """
    by, order = [study], [F.col(trial)]
    parts = range_sorted(trials.withColumn("_key", F.struct(F.col(value), (-F.col(trial)).alias("t"))),
                         by, order)
    summary = parts.groupBy(study, PART).agg(F.max("_key").alias("_top"))
    summary = summary.select(study, PART, F.max("_top").over(preceding(by)).alias("_before"))
    best = F.greatest(F.max("_key").over(within(by, order)), F.col("_before"))
    return (attach_summary(parts, summary, by).withColumn("_best", best)
            .select(study, trial, value, F.col(f"_best.{value}").alias("best_value"),
                    (-F.col("_best.t")).alias("best_trial")))
