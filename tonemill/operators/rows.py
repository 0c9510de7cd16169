"""Row filters, projections and the joins that tie texts, labels and predictions by ID."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonemill.constants import MISSING_TEXT, SPELLING
from tonemill.functions.cleaning import clean_text


def drop_missing(df: DataFrame, subset: list[str]) -> DataFrame:
    return df.na.drop(subset=subset)


def null_to_literal(df: DataFrame, col: str, literal: str = MISSING_TEXT) -> DataFrame:
    return df.withColumn(col, F.coalesce(F.col(col).cast("string"), F.lit(literal)))


def apply_null_policy(df: DataFrame, policy: str, subset: list[str]) -> DataFrame:
    """``drop`` rows with missing values, or keep them with the ``literal`` text."""
    if policy == "drop":
        return drop_missing(df, subset)
    if policy == "literal":
        return null_to_literal(df, "Text")
    raise ValueError(f"unknown null policy {policy!r}")


def clean(df: DataFrame, profile: str = "frequency", text: str = "Text",
          output: str = "Processed", corrections: dict[str, str] = SPELLING) -> DataFrame:
    """Add the cleaned text beside the raw text."""
    return df.withColumn(output, clean_text(F.col(text), profile, corrections))


def filter_class(df: DataFrame, y: int, label: str = "Label") -> DataFrame:
    return df.filter(F.col(label) == y)


def feature_label(df: DataFrame, feature: str = "Text", label: str = "Label") -> DataFrame:
    """Feature and label of each row, the label as a double as MLlib wants it."""
    return df.select("ID", F.col(feature).alias("feature"),
                     F.col(label).cast("double").alias("label"))


def attach_labels(texts: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled rows only; both sides are keyed by ID and never paired by position."""
    return texts.join(labels, "ID", "inner")


def attach_predictions(rows: DataFrame, predictions: DataFrame) -> DataFrame:
    return rows.join(predictions, "ID", "inner")


def union_splits(**splits: DataFrame) -> DataFrame:
    """Concatenate splits, each row marked with the name of its split."""
    marked = [df.withColumn("split", F.lit(name)) for name, df in splits.items()]
    out = marked[0]
    for df in marked[1:]:
        out = out.unionByName(df)
    return out
