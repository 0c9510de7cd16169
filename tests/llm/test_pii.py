"""Pseudonyms: whole domains, cards beside other digits, and a plain rewriting of every match."""

from __future__ import annotations

import datetime
import random
import re

from pyspark.sql import functions as F

from tonemill.llm import pii


def test_every_date_has_a_pseudonym_of_its_own(spark):
    days = spark.range(pii.DAYS).select(F.date_add(F.lit(pii.FIRST_DAY).cast("date"), F.col("id").cast("int")).alias("d"))
    texts = days.select(F.explode(F.array(*[F.date_format("d", f) for f in (
        "yyyy-MM-dd", "MM/dd/yyyy", "dd/MM/yyyy")])).alias("text")).distinct()
    got = pii.pseudonymize(texts.withColumn("was", F.col("text")).repartition(8), "key of the registered query").collect()
    out = [r.text for r in got]
    assert len(set(out)) == len(out) > 2 * pii.DAYS
    for r in got[::97] + [r for r in got if r.was in ("1985-09-07", "02/29/2000", "31/12/2099")]:
        form = "%Y-%m-%d" if "-" in r.text else "%m/%d/%Y" if int(r.was[:2]) <= 12 else "%d/%m/%Y"
        assert 1900 <= datetime.datetime.strptime(r.text, form).year <= 2099
        assert (r.text[2] == "/") == (r.was[2] == "/")


def luhn(digits):
    return sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10))
               for i, d in enumerate(reversed(digits))) % 10 == 0


def test_cards_beside_other_digits(spark):
    card = "4111111111111111"
    texts = [f"{card} 123", "4111 1111 1111 1111 12/26", f"row 12 {card}", "1234 12 4111-1111-1111-1111 7",
             f"{card} {card}", "3782 822463 10005 99", "4111 1111 1111 1112 12", "12 34 56 78 90 12 34 57 11",
             "9" * 30, f"7 {card} 4242424242424242", card]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.pseudonymize(frame, "k").collect()}
    fresh = got[10].text
    assert luhn(fresh) and fresh != card and len(fresh) == 16
    spaced = " ".join(fresh[i:i + 4] for i in range(0, 16, 4))
    assert got[0].text == f"{fresh} 123" and got[1].text == f"{spaced} 12/26" and got[2].text == f"row 12 {fresh}"
    assert got[3].text == f"1234 12 {spaced.replace(' ', '-')} 7" and got[4].text == f"{fresh} {fresh}"
    assert re.fullmatch(r"\d{4} \d{6} \d{5} 99", got[5].text) and got[5].text != texts[5]
    assert got[6].text == texts[6] and got[8].text == texts[8]
    assert got[9].text.startswith(f"7 {fresh} ") and luhn(got[9].text[-16:]) and got[9].n_replaced == 1


def test_the_rest_of_the_text_and_other_columns_stay(spark):
    """Every match is replaced where it stands by its own pseudonym, as plain Python would."""
    texts = ["", None, "no data", "a@b.org x 10.0.0.1, 555-010-9999; 1984-02-29.", "10.0.0.1" * 2, "x 10.0.0.1 10.0.0.1 é 😀",
             "123-45-6789 " * 4000, "ABC 02/03/1999"] + ["same 10.0.0.1"] * 3
    frame = spark.createDataFrame([(i, t, "o", "n", 1, "K") for i, t in enumerate(texts)],
                                  "doc_id long, text string, old string, NEW string, n_replaced int, pieces string")
    got = {r.doc_id: r for r in pii.pseudonymize(frame, "k").collect()}
    found = sorted({m for t in texts for m in re.findall(pii.PATTERN.replace("++", "+"), t or "")})
    own = {r.m: r.p for r in spark.createDataFrame([(m,) for m in found], "m string").select(
        "m", pii.pseudonym(F.col("m"), "k").alias("p")).collect()}
    for i, t in enumerate(texts):
        want = None if t is None else re.sub(pii.PATTERN.replace("++", "+"), lambda m: own[m[0]], t)
        assert got[i].text == want and (got[i].old, got[i].NEW, got[i].pieces) == ("o", "n", "K")
        n = sum(own[m] != m for m in re.findall(pii.PATTERN.replace("++", "+"), t or ""))
        assert got[i].n_replaced == n
    plan = pii.pseudonymize(frame, "k")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)


def test_long_runs_of_digits_and_labels_take_no_stack(spark):
    card = "4111111111111111"
    texts = ["7" * 50_000, "12 34-" * 20_000, f"{'1 ' * 20_000}{card} x", f"a@{'b.' * 20_000}com1", f"a@{'b.' * 20_000}1"]
    frame = spark.createDataFrame([*enumerate(texts), (5, card)], "doc_id long, text string")
    got = {r.doc_id: r for r in pii.pseudonymize(frame, "k").collect()}
    assert [got[i].n_replaced for i in range(6)] == [0, 0, 1, 1, 0, 1]
    assert all(got[i].text == texts[i] for i in (0, 1, 4))
    assert got[2].text == f"{'1 ' * 20_000}{got[5].text} x"
    assert re.fullmatch(r"[a-z]@([a-z]\.){20000}com1", got[3].text) and got[3].text != texts[3]


def test_addresses_end_with_the_last_label_of_letters():
    """Against the plain pattern, which steps back from label to label."""
    plain = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
    rng = random.Random(7)
    texts = ["".join(rng.choice("a@..b1-@. ab") for _ in range(40)) for _ in range(20_000)]
    found = [[m[0] for m in re.finditer(pii.EMAIL, t)] for t in texts]
    assert found == [[m[0] for m in re.finditer(plain, t)] for t in texts] and sum(map(len, found)) > 1000
