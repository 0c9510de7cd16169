"""CSV cut to records in byte ranges, beside Spark's own reader of whole files."""

from __future__ import annotations

import collections
import random

import pytest

from tonemill import schemas
from tonemill.sources import quoted, tables

OPTIONS = {k: v for k, v in tables._CSV.items()}


@pytest.fixture
def ranges(spark):
    """Set the size of byte ranges; the test ends with the sizes from before."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes",
             "spark.sql.files.minPartitionNum")
    before = {n: spark.conf.get(n, None) for n in names}

    def set_to(n_bytes):
        spark.conf.set(names[0], str(n_bytes))
        spark.conf.set(names[1], "1")
        spark.conf.set(names[2], "1")
    yield set_to
    for n, v in before.items():
        spark.conf.set(n, v) if v is not None else spark.conf.unset(n)


def file_text(seed, n=40, end="\n"):
    rng = random.Random(seed)
    lines = ["ID,Text,Label"]
    for i in range(n):
        text = "".join(rng.choices(["a", "é", ",", '"', "\n", " ", "\n\n", '""', "long words "],
                                   k=rng.randint(0, 12)))
        style = rng.random()
        if style < 0.3 and not set(text) & set(',"\n'):
            field = text
        else:
            field = '"' + text.replace('"', '""') + '"'
        lines.append(f"{i},{field},{rng.choice(['0', '1', ''])}")
        if rng.random() < 0.1:
            lines.append("")
    return end.join(lines) + (end if seed % 2 else "")


def counted(df):
    return collections.Counter(tuple(r) for r in df.select("ID", "Text", "Label").collect())


@pytest.mark.parametrize("seed,n_bytes", [(0, 60), (1, 150), (2, 64), (3, 257), (4, 90), (5, 1 << 20)])
def test_equals_the_reader_of_whole_files(spark, tmp_path, ranges, seed, n_bytes):
    for k in range(2):
        (tmp_path / f"part{k}.csv").write_text(file_text(10 * seed + k), newline="")
    want = counted(spark.read.schema(schemas.LABELLED).options(**tables._CSV).csv(str(tmp_path)))
    ranges(n_bytes)
    got = quoted.read_quoted_csv(spark, str(tmp_path), schemas.LABELLED, OPTIONS)
    assert got.columns == ["ID", "Text", "Label", "_malformed"]
    assert counted(got) == want and got.filter("_malformed IS NOT NULL").count() == 0


def test_carriage_returns(spark, tmp_path, ranges):
    (tmp_path / "t.csv").write_text('ID,Text,Label\r\n1,"a\r\nb",1\r\n\r\n2,x,0\r\n', newline="")
    ranges(5)
    got = tables.read_labelled_csv(spark, str(tmp_path))
    assert counted(got) == {(1, "a\r\nb", 1): 1, (2, "x", 0): 1}


def test_one_text_over_many_ranges_is_read_by_many_tasks(spark, tmp_path, ranges):
    long = "line of the text\n" * 500
    (tmp_path / "t.csv").write_text(
        "ID,Text,Label\n" + "".join(f'{i},"{long}",1\n{i + 100},short,0\n' for i in range(4)))
    ranges(1000)
    lines = quoted._lines(spark, str(tmp_path))
    assert lines.rdd.getNumPartitions() > 20
    got = counted(tables.read_labelled_csv(spark, str(tmp_path)))
    assert got == {**{(i, long, 1): 1 for i in range(4)}, **{(i + 100, "short", 0): 1 for i in range(4)}}


def test_malformed_rows(spark, tmp_path, ranges):
    (tmp_path / "t.csv").write_text(
        'ID,Text,Label\n1,fine,1\nx,"no\nnumber",1\n2,too,1,many\n3\n4,"fine\ntoo",0\n5,"open\nto the end,1\n6,y,1\n')
    for n_bytes in (9, 1 << 20):
        ranges(n_bytes)
        got = tables.read_labelled_csv(spark, str(tmp_path), malformed="bad")
        fine = counted(got.filter("bad IS NULL"))
        assert fine == {(1, "fine", 1): 1, (4, "fine\ntoo", 0): 1}
        bad = sorted(r.bad for r in got.filter("bad IS NOT NULL").collect())
        assert bad == ["2,too,1,many", "3", '5,"open\nto the end,1\n6,y,1', 'x,"no\nnumber",1']
        assert tables.read_labelled_csv(spark, str(tmp_path)).columns == ["ID", "Text", "Label"]


def test_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    (tmp_path / "b.csv").write_text("ID,Text,Label\n")
    assert tables.read_labelled_csv(spark, str(tmp_path)).count() == 0
