"""Declared schemas; nothing is inferred from file contents."""

from pyspark.sql import types as T

LABELLED = T.StructType([
    T.StructField("ID", T.LongType()),
    T.StructField("Text", T.StringType()),
    T.StructField("Label", T.IntegerType()),
])

UNLABELLED = T.StructType([
    T.StructField("ID", T.LongType()),
    T.StructField("Text", T.StringType()),
])

PREDICTIONS = T.StructType([
    T.StructField("ID", T.LongType()),
    T.StructField("Label", T.IntegerType()),
])

WORD_VECTORS = T.StructType([
    T.StructField("token", T.StringType()),
    T.StructField("vector", T.ArrayType(T.FloatType())),
])
