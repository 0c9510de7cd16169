from __future__ import annotations

import random

import plain_rules
import pytest
from pyspark.sql import functions as F

from tonemill.functions import cleaning, tokens
from tonemill.functions.cleaning import clean_text

# Input and its three cleaned forms: frequency, embedding, contextual.
GOLDEN = [
    ("I'm LUVin' it!!! @Bob http://x.y/z #wow", "i am luvin' it X http wow",
     "i am luvin' it X http X", "i'm luvin' it!!! X http #wow"),
    ("rock'n'roll don't", "rockn'roll dont", "rockn'roll dont", "rock'n'roll don't"),
    ("café's naïve", "cafs nave", "cafs nave", "caf's nave"),
    ("sooo goood 1000... happpy", "so god 10 happy", "so god 10 happy", "sooo goood 1000... happpy"),
    ("mail bob@site.org now", "mail bobX now", "mail bobX now", "mail bobX now"),
    ("a\tb\nc  d", "a b c d", "a b c d", "a\tb\nc  d"),
    ("plz... omg, thx!", "please oh my god thanks", "please oh my god thanks",
     "please... oh my god, thanks!"),
    ("gr8 #gr8", "great great", "great X", "great #great"),
    ("It’s gud", "its good", "its good", "its good"),
    ("snake_case x", "snake case x", "snake case x", "snake_case x"),
    ("@a\xa0b", "Xb", "Xb", "Xb"),
    ("  ", "", "", "  "),
    ("im im'", "i am i am'", "i am i am'", "i am i am'"),
]
PROFILES = ("frequency", "embedding", "contextual")


@pytest.mark.parametrize("i,profile", list(enumerate(PROFILES)))
def test_golden_rows(spark, i, profile):
    df = spark.createDataFrame([(n, row[0]) for n, row in enumerate(GOLDEN)], "n int, t string")
    got = [r[0] for r in df.orderBy("n").select(clean_text(F.col("t"), profile)).collect()]
    assert got == [row[i + 1] for row in GOLDEN]


def random_texts(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    odd = " \t\n\r\x0b\x1c\x1f\x85\xa0  　'’@#_!.-éßñÉदि²Ⅷaabbbccc0001é́"
    pieces = ["http://a.b", "@x", "#tag", "im", "gr8", "don't", "a'b'c'd", "''", "omg", "'"]
    out = []
    for _ in range(n):
        parts = [rng.choice(pieces) if rng.random() < 0.2 else rng.choice(odd) * rng.choice((1, 1, 2, 3, 5))
                 for _ in range(rng.randint(0, 25))]
        out.append("".join(parts))
    return out


@pytest.fixture(scope="module")
def random_rows(spark):
    texts = random_texts(4000, 7)
    df = spark.createDataFrame(list(enumerate(texts)), "n int, t string").persist()
    return texts, df


@pytest.mark.parametrize("profile", PROFILES)
def test_profiles_equal_plain_rules_on_random_text(random_rows, profile):
    texts, df = random_rows
    got = [r[0] for r in df.orderBy("n").select(clean_text(F.col("t"), profile)).collect()]
    wrong = [(t, g, plain_rules.clean(t, profile)) for t, g in zip(texts, got)
             if g != plain_rules.clean(t, profile)]
    assert not wrong, wrong[:3]


def test_tokens_equal_plain_rules_on_random_text(random_rows):
    texts, df = random_rows
    rows = df.orderBy("n").select(
        tokens.ws_tokens(F.col("t")), tokens.word_tokens(F.col("t")), tokens.word_count(F.col("t"))).collect()
    for text, (ws, words, n) in zip(texts, rows):
        assert ws == text.split()
        assert words == plain_rules.word_tokens(text)
        assert n == len(text.split())


def test_single_steps(spark):
    row = spark.createDataFrame([("a @ b @c", "aaab\r\r\rc\n\n\n", "x ¤y")], "a string, b string, c string")
    got = row.select(cleaning.mask_mentions(F.col("a")), cleaning.collapse_repeats(F.col("b")),
                     cleaning.strip_non_ascii(F.col("c"))).first()
    assert tuple(got) == ("a @ b X", "ab\rc\n\n\n", "x y")


def test_spelling_map_is_a_parameter(spark):
    row = spark.createDataFrame([("teh cat im",)], "t string")
    assert row.select(clean_text(F.col("t"), "frequency", {"teh": "the"})).first()[0] == "the cat im"


def test_long_words_are_scanned_in_linear_time(spark):
    df = spark.range(1).select(F.concat(F.repeat(F.lit("ab"), 200000), F.lit("'c")).alias("t"))
    assert df.select(F.length(clean_text(F.col("t"), "frequency"))).first()[0] == 400001


def test_cleaning_stays_in_the_jvm(spark, sf):
    from tonemill.queries import QUERIES

    plan = QUERIES["clean_frequency"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
