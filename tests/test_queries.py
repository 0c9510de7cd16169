"""Every registered query beside its SQL on the smallest tables."""

from __future__ import annotations

import pytest
from check_queries import difference, duck

from __spark_entry__ import entry, oracle_sql, queries
from tonemill.queries import corpus


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


def test_entry(spark):
    rows = entry(spark).collect()
    assert len(rows) == 20 and rows[0]["n"] >= rows[-1]["n"]


def test_names():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_sql(spark, con, sf, name):
    got = queries()[name](spark, sf).toPandas()
    assert len(got)
    if name in oracle_sql():
        assert difference(got, con.execute(oracle_sql()[name]).df()) is None


def test_vectors_are_printed_once_each(spark):
    """Not once per occurrence of their token, beside the join."""
    plan = queries()["vector_lookup"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and "array_join" not in plan


@pytest.mark.parametrize("build", [corpus.word_vectors, corpus.subword_vocab])
def test_texts_are_counted_once(spark, sf, monkeypatch, build):
    """What follows the counts reads them as written, not the texts again."""
    monkeypatch.setattr(corpus, "_files", {})
    written, materialize = [], corpus.materialize
    monkeypatch.setattr(corpus, "materialize", lambda df, name: written.append(name) or materialize(df, name))
    assert build(spark, sf).count() and written == ["counts"]
