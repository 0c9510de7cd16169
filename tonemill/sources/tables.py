"""Reading and writing the tables a classifier works on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tonemill import schemas
from tonemill.constants import NA_TOKENS
from tonemill.sources.quoted import read_quoted_csv

_CSV = {
    "header": "true",
    "multiLine": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def null_tokens(df: DataFrame, col: str, tokens: list[str] = NA_TOKENS) -> DataFrame:
    """Turn spelled-out missing values (``NA``, ``null``, ...) into NULL."""
    return df.withColumn(col, F.when(~F.col(col).isin(list(tokens)), F.col(col)))


def _read_csv(spark: SparkSession, path: str, schema: StructType, malformed: str | None) -> DataFrame:
    rows = null_tokens(read_quoted_csv(spark, path, schema, _CSV, malformed or "_malformed"), "Text")
    return rows if malformed else rows.drop("_malformed")


def read_labelled_csv(spark: SparkSession, path: str, malformed: str | None = None) -> DataFrame:
    """``ID, Text, Label``; quoted texts may span lines, and large files are read by many tasks.

    The files are read at the call. A column named by ``malformed`` gets the text of records that
    don't fit; without it they have null in the columns that can't be told.
    """
    return _read_csv(spark, path, schemas.LABELLED, malformed)


def read_unlabelled_csv(spark: SparkSession, path: str, malformed: str | None = None) -> DataFrame:
    """``ID, Text``, as above."""
    return _read_csv(spark, path, schemas.UNLABELLED, malformed)


def write_text_csv(df: DataFrame, path: str) -> None:
    """Write a text table so that the readers above give the same rows back."""
    df.write.options(**_CSV).csv(path)


def read_word_vectors(spark: SparkSession, path: str, fmt: str = "text") -> DataFrame:
    """``token, vector``: a text file of ``token v1 ... vd`` lines, or parquet."""
    if fmt == "parquet":
        return spark.read.schema(schemas.WORD_VECTORS).parquet(path)
    fields = F.split(F.col("value"), " ")
    return spark.read.text(path).select(
        F.get(fields, F.lit(0)).alias("token"),
        F.transform(F.slice(fields, F.lit(2), F.size(fields) - 1),
                    lambda v: v.cast("float")).alias("vector"),
    )


def write_predictions(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Write ``ID, Label`` as CSV part files; ``single_file`` is for results of small size."""
    out = df.select("ID", "Label")
    (out.coalesce(1) if single_file else out).write.option("header", "true").csv(path)


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PREDICTIONS).option("header", "true").csv(path)
