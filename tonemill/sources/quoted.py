"""CSV files whose quoted texts span lines, read in parallel.

A line break ends a record only outside quotes, which a reader that starts in the middle of a file
cannot see; Spark's own ``multiLine`` reader therefore gives each file to one task. Here a file is
read as plain lines, in the byte ranges that Spark deals out. In a well-formed file quotes come in
pairs, so a range begins inside a quoted text if the ranges before it hold an odd number of quotes:
one pass counts them, and a running sum over one row per range tells how each begins. A second
pass then cuts every range to records where it lies. Only the pieces at range edges are shuffled,
to be put together; a record may span any number of ranges.

The records are parsed by Spark's CSV parser and written, so that later reads take only the
columns they need and the file is not read again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType
from pyspark.sql.window import Window

from tonemill.plans.materialize import materialize

#: Kinds of what a range holds: a record, the end of one, a part of one, the beginning of one.
WHOLE, END, MIDDLE, BEGIN = range(4)
_QUOTE = ord('"')
_CUT = "file string, start long, kind int, first boolean, record string"


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"))


def _begun_inside(lines: DataFrame) -> DataFrame:
    """``file, start`` of the ranges that begin inside a quoted text; at most one row per range."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    ranges = lines.groupBy("file", "start").agg(F.sum(quotes).alias("quotes"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    odd = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1
    return ranges.withColumn("inside", odd).filter("inside").select("file", "start", "inside")


class _Range:
    """Cuts the lines of one byte range, which come in order, to records and pieces at the edges."""

    def __init__(self, file: str, start: int, inside: bool):
        self.file, self.start, self.inside = file, start, inside
        self.continued = inside  # the open record began in an earlier range
        self.open: list[str] = []
        self.header = start == 0  # the first record of the file is still to come

    def add(self, lines: pa.Array) -> pa.RecordBatch | None:
        ends = self._quoted(lines) == 0
        close = np.flatnonzero(ends)
        if not len(close):
            self.open += lines.to_pylist()
            return None
        begin = np.concatenate([[0], close[:-1] + 1])
        records, several = lines.take(pa.array(close)), np.flatnonzero(begin < close)
        opened, continued = self.open, self.continued
        if len(several) or opened:
            texts = records.to_pylist()
            for i in several.tolist():
                texts[i] = "\n".join(lines.slice(begin[i], close[i] - begin[i] + 1).to_pylist())
            if opened:
                texts[0] = "\n".join([*opened, texts[0]])
            records = pa.array(texts, pa.string())
        kinds = np.full(len(close), WHOLE, np.int32)
        if continued:
            kinds[0] = END
        self.open, self.continued = lines.slice(int(close[-1]) + 1).to_pylist(), False
        return self._batch(records, kinds)

    def _quoted(self, lines: pa.Array) -> np.ndarray:
        """For each line, whether a quoted text is open at its end."""
        _, offsets, data = lines.buffers()
        offsets = np.frombuffer(offsets, np.int32)[lines.offset: lines.offset + len(lines) + 1]
        data = np.frombuffer(data or b"", np.uint8)[offsets[0]: offsets[-1]]
        seen = np.concatenate([[0], np.cumsum(data == _QUOTE)])[offsets[1:] - offsets[0]]
        after = (seen + self.inside) % 2
        self.inside = bool(after[-1])
        return after

    def rest(self) -> pa.RecordBatch | None:
        """What is open when the range ends."""
        if not self.inside:
            return None
        kind = MIDDLE if self.continued else BEGIN
        return self._batch(pa.array(["\n".join(self.open)]), np.array([kind], np.int32))

    def _batch(self, records: pa.Array, kinds: np.ndarray) -> pa.RecordBatch:
        n, first = len(records), np.zeros(len(records), bool)
        if self.header:
            for i in range(n):
                if records[i].as_py().rstrip("\r"):
                    first[i], self.header = True, False
                    break
        return pa.RecordBatch.from_arrays(
            [pa.array([self.file] * n), pa.array(np.full(n, self.start)), pa.array(kinds),
             pa.array(first), records], names=["file", "start", "kind", "first", "record"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now = None
    for batch in batches:
        start = batch.column("start").to_numpy()
        file = batch.column("file").dictionary_encode()
        key = file.indices.to_numpy()
        fresh = np.flatnonzero((start[1:] != start[:-1]) | (key[1:] != key[:-1])) + 1
        for a, b in zip([0, *fresh.tolist()], [*fresh.tolist(), len(batch)]):
            if a == b:
                continue
            name = file.dictionary[int(key[a])].as_py()
            if now is None or (now.file, now.start) != (name, int(start[a])):
                if now is not None and (rest := now.rest()) is not None:
                    yield rest
                now = _Range(name, int(start[a]), bool(batch.column("inside")[a].as_py()))
            found = now.add(batch.column("value").slice(a, b - a))
            if found is not None:
                yield found
    if now is not None and (rest := now.rest()) is not None:
        yield rest


def _joined(pieces: DataFrame) -> DataFrame:
    """``first, record`` of the records that cross range edges."""
    # One row per range edge, without texts, tells which pieces belong together.
    order = Window.partitionBy("file").orderBy("start", "kind")
    begun = F.last(F.when(F.col("kind") == BEGIN, F.col("start")), ignorenulls=True).over(order)
    keyed = pieces.select("file", "start", "kind").withColumn("begun", begun)
    parts = F.sort_array(F.collect_list(F.struct("start", "record")))
    return pieces.join(keyed, ["file", "start", "kind"]).groupBy("file", "begun").agg(
        F.bool_or("first").alias("first"), parts.alias("parts")).select(
        "first", F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record"))


def _parsed(record: Column, schema: StructType, malformed: str, options: dict[str, str]) -> Column:
    whole = StructType([*schema.fields]).add(malformed, StringType())
    return F.from_csv(F.regexp_replace(record, "\r$", ""), _ddl(whole), {
        **options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": malformed})


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def read_quoted_csv(spark: SparkSession, path: str | list[str], schema: StructType,
                    options: dict[str, str], malformed: str = "_malformed") -> DataFrame:
    """The columns of ``schema`` and ``malformed``, for files with a header each.

    Quotes are doubled inside quoted texts. A record that does not fit the schema, or whose quotes
    are still open at the end of its file, has its text in ``malformed`` and null in the
    columns that can't be told; in all others ``malformed`` is null. Blank lines between records are
    skipped. Rows come in no order.
    """
    lines = _lines(spark, path)
    inside = F.broadcast(_begun_inside(lines))  # a row per byte range of the files at most
    cut = lines.join(inside, ["file", "start"], "left").select(
        "value", "file", "start", F.coalesce("inside", F.lit(False)).alias("inside")
    ).mapInArrow(_cut, _CUT).filter((F.col("kind") != WHOLE) | ~F.col("first"))
    whole = F.col("kind") == WHOLE
    row = _parsed(F.col("record"), schema, malformed, options)
    blank = F.regexp_replace("record", "\r$", "") == ""
    cut = materialize(cut.filter(~(whole & blank)).select(
        "file", "start", "kind", "first", F.when(~whole, F.col("record")).alias("record"),
        F.when(whole, row).alias("row")), "records")
    joined = _joined(cut.filter(~whole).drop("row")).filter(~F.col("first")).select(
        _unbalanced(row, schema, malformed).alias("row"))
    return cut.filter(whole).select("row").union(joined).select("row.*")


def _unbalanced(row: Column, schema: StructType, malformed: str) -> Column:
    """A record with an odd number of quotes is malformed, whatever could be read of it."""
    quotes = F.length("record") - F.length(F.replace("record", F.lit('"'), F.lit("")))
    return F.when(quotes % 2 == 0, row).otherwise(F.struct(
        *[row[f.name].alias(f.name) for f in schema.fields], F.col("record").alias(malformed)))
