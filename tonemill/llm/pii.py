"""Format-preserving pseudonyms for personal data in texts, by keyed Feistel networks.

E-mail addresses, IPv4 addresses, phone numbers, payment card numbers, social security numbers
and calendar dates are found by one pattern and validated (octets, Luhn sum, number ranges, days
that exist); what fails stays as it is. A valid value is read as a number of its own domain and
permuted there by a Feistel network with a secret key: digits stay digits, dates stay dates
between 1900 and 2099, cards keep a valid check digit, separators and country codes stay. The
permutation depends on the value alone, so equal values have equal pseudonyms in all documents,
however they are punctuated, and different values never share one.

Each half of the network has its own modulus, whose product is the size of the domain (88,902 * 9,999
social security numbers). Dates have a grid of 229 * 319 places, two more than days; a value that
lands outside goes through the network again. Dates with slashes are read month first where that
is a date; those that only exist day first are permuted among themselves, since another
order could print like a month-first one. Letters and digits of an address are shifted within
their alphabet, one part keyed by the other.

A run of digit groups is a card if its 13 to 19 digits have a valid sum; in any other run, cards in
printed form (an unbroken number, 4-4-4-4, 4-6-5 or 4-6-4) are found beside whatever else stands there.

Only DataFrame functions are used and nothing is shuffled. Defined cases: a null text stays null
and an empty one empty; equal rows change alike; other columns pass through, except ones named
like the new ``n_replaced``, which they give way to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonemill.llm.names import unused

# Patterns of the kinds, and the ranges that make a value valid. Groups of open length are repeated
# possessively: other repeats take stack for every round, and a long run would end the executor.
# An address ends with the letters of its last label that begins with two or more.
EMAIL = (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:[A-Za-z0-9-]*+"
         r"(?:\.(?![A-Za-z]{2})[A-Za-z0-9-]++)*+\.[A-Za-z]{2,}+)++")
DATE = (r"(?<![0-9/.-])(?:(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}"
        r"|[0-9]{2}/[0-9]{2}/(?:19|20)[0-9]{2})(?![0-9/-])")
IP = r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
PHONE = (r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])"
         r"[0-9]{3}[ .-][0-9]{4}(?![0-9])")
CARD = r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,}+"
# Cards as they are printed, looked for at every group of digits of a longer run.
PRINTED = (r"(?<![0-9])(?=((?:[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}"
           r"|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5}|[0-9]{13,19})(?![0-9])))[0-9]")
PATTERN = "|".join([EMAIL, DATE, IP, SSN, PHONE, CARD])
FIRST_DAY, DAYS = "1900-01-01", 73_049
DAY_GRID = (229, 319)  # two places more than days
#: Walks after which a day-first date has found its place (see ``_date``).
MOST_WALKS = 64
AREAS, GROUPS, SERIALS = 898, 99, 9999

ROUNDS = 8


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _prf(key: str, *parts: Column) -> Column:
    """A keyed hash of the parts, as hex digits."""
    return F.sha2(F.concat_ws("|", F.lit(key), *[p.cast("string") for p in parts]), 256)


def _number(hexed: Column) -> Column:
    return F.conv(F.substring(hexed, 1, 15), 16, 10).cast("bigint")


def feistel(a: Column, b: Column, size_a: Column, size_b: Column, key: str, domain: str) -> Column:
    """A permutation of the pairs ``(a, b)`` below the two sizes, as a struct ``a, b``."""
    def step(s, i):
        own = F.when(i % 2 == 0, size_a).otherwise(size_b)
        moved = (s["a"] + _number(_prf(key, F.lit(domain), size_a, size_b, i, s["b"]))) % own
        return F.struct(s["b"].alias("a"), moved.alias("b"))

    start = F.struct(a.cast("bigint").alias("a"), b.cast("bigint").alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def _power(n: Column) -> Column:
    return F.pow(F.lit(10.0), n).cast("bigint")


def permuted_digits(digits: Column, key: str, domain: str) -> Column:
    """A string of up to 18 digits, permuted among the strings of its length (two or more)."""
    head = F.floor(F.length(digits) / 2).cast("int")
    tail = F.length(digits) - head
    first, second = F.left(digits, head), F.right(digits, tail)
    return _let(feistel(first, second, _power(head), _power(tail), key, domain),
                lambda s: F.concat(F.lpad(s["a"].cast("string"), head, F.lit("0")),
                                   F.lpad(s["b"].cast("string"), tail, F.lit("0"))))


def _refill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced in order."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def step(s, c):
        is_digit = c.rlike("^[0-9]$")
        return F.struct(
            F.concat(s["out"], F.when(is_digit, F.substr(digits, s["at"], F.lit(1))).otherwise(c))
            .alias("out"), (s["at"] + is_digit.cast("int")).alias("at"))

    return F.aggregate(F.split(shape, ""), start, step)["out"]


def _luhn(digits: Column) -> Column:
    """The Luhn sum of digits that a check digit will follow, modulo 10."""
    def step(s, i):
        d = F.substr(digits, i, F.lit(1)).cast("int")
        twice = F.when((F.length(digits) - i) % 2 == 0, d * 2).otherwise(d)
        return (s + F.when(twice > 9, twice - 9).otherwise(twice)) % 10

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step)


def _one_card(m: Column, key: str) -> Column:
    """``m`` with the digits of a valid card permuted, or null."""
    def change(digits):
        body, check = F.left(digits, F.length(digits) - 1), F.right(digits, F.lit(1)).cast("int")
        valid = F.length(digits).between(13, 19) & ((_luhn(body) + check) % 10 == 0)
        fresh = _let(permuted_digits(body, key, "card"), lambda d: F.concat(
            d, ((10 - _luhn(d)) % 10).cast("string")))
        return F.when(valid, _refill(m, fresh))

    return _let(F.regexp_replace(m, "[^0-9]", ""), change)


def _card(m: Column, key: str) -> Column:
    printed = F.array_distinct(F.regexp_extract_all(m, F.lit(PRINTED), F.lit(1)))
    inside = F.aggregate(printed, m, lambda done, c: F.coalesce(
        F.replace(done, c, _one_card(c, key)), done))
    whole = F.when(F.length(F.regexp_replace(m, "[^0-9]", "")) <= 19, _one_card(m, key))
    return _let(whole, lambda w: F.coalesce(w, inside))


def _phone(m: Column, key: str) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    return _let(digits, lambda d: _refill(m, F.concat(
        F.left(d, F.length(d) - 10), permuted_digits(F.right(d, F.lit(10)), key, "phone"))))


def _ip(m: Column, key: str) -> Column:
    def change(o):
        valid = F.forall(o, lambda x: x <= 255)
        size = F.lit(65536).cast("bigint")
        fresh = _let(feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], size, size, key, "ip"),
                     lambda s: F.concat_ws(".", *[x.cast("bigint").cast("string") for x in (
                         F.floor(s["a"] / 256), s["a"] % 256, F.floor(s["b"] / 256),
                         s["b"] % 256)]))
        return F.when(valid, fresh).otherwise(m)

    return _let(F.split(m, r"\.").cast("array<int>"), change)


def _ssn(m: Column, key: str) -> Column:
    def change(p):
        area, group, serial = p[0], p[1], p[2]
        valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
        place = area - 1 - (area > 666).cast("int")  # 0 .. 897
        fresh = _let(
            feistel(place * GROUPS + group - 1, serial - 1, F.lit(AREAS * GROUPS).cast("bigint"),
                    F.lit(SERIALS).cast("bigint"), key, "ssn"),
            lambda s: _let(F.floor(s["a"] / GROUPS) + 1, lambda q: F.concat_ws(
                "-", F.lpad((q + (q >= 666).cast("int")).cast("string"), 3, "0"),
                F.lpad((s["a"] % GROUPS + 1).cast("string"), 2, "0"),
                F.lpad((s["b"] + 1).cast("string"), 4, "0"))))
        return F.when(valid, fresh).otherwise(m)

    return _let(F.split(m, "-").cast("array<int>"), change)


def _permuted_day(n: Column, key: str, domain: str) -> Column:
    """A day number, permuted among all days."""
    height = F.lit(DAY_GRID[1]).cast("bigint")

    def step(s, _):
        moved = _let(feistel(F.floor(s["n"] / DAY_GRID[1]), s["n"] % DAY_GRID[1],
                             F.lit(DAY_GRID[0]).cast("bigint"), height, key, domain),
                     lambda t: t["a"] * height + t["b"])
        return F.when(s["done"], s).otherwise(_let(moved, lambda x: F.struct(
            x.alias("n"), (x < DAYS).alias("done"))))

    # At most two places are outside, so a third walk ends inside.
    start = F.struct(n.cast("bigint").alias("n"), F.lit(False).alias("done"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(3)), start, step)["n"]


def _day(n: Column) -> Column:
    return F.date_add(F.lit(FIRST_DAY).cast("date"), n.cast("int"))


def _day_first(n: Column, key: str) -> Column:
    """A day after the twelfth of its month, permuted among such days by walking on to the next."""
    def step(s, _):
        return F.when(s["done"], s).otherwise(_let(_permuted_day(s["n"], key, "day first"), lambda x: F.struct(
            x.alias("n"), (F.dayofmonth(_day(x)) > 12).alias("done"))))

    start = F.struct(n.cast("bigint").alias("n"), F.lit(False).alias("done"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(MOST_WALKS)), start, step)["n"]


def _date(m: Column, key: str) -> Column:
    month_first = F.try_to_timestamp(m, F.lit("MM/dd/yyyy")).cast("date")
    day_first = F.when(month_first.isNull(), F.try_to_timestamp(m, F.lit("dd/MM/yyyy")).cast("date"))
    iso = F.try_to_timestamp(m, F.lit("yyyy-MM-dd")).cast("date")

    def printed(day, change, form):
        first = F.lit(FIRST_DAY).cast("date")
        return F.when(day.isNotNull(), F.date_format(_day(change(F.datediff(day, first))), form))

    any_day = lambda n: _permuted_day(n, key, "date")
    return F.coalesce(
        printed(iso, any_day, "yyyy-MM-dd"), printed(month_first, any_day, "MM/dd/yyyy"),
        printed(day_first, lambda n: _day_first(n, key), "dd/MM/yyyy"), m)


def _shifted(part: Column, hexed: Column) -> Column:
    """Letters and digits of ``part`` moved within their alphabets by the bytes of ``hexed``."""
    def move(c, j):
        by = F.conv(F.substr(hexed, (j * 2) % 60 + 1, F.lit(4)), 16, 10).cast("int")
        code = F.ascii(c)
        into = lambda first, n: F.char((code - first + by) % n + first)
        return (F.when(c.rlike("^[a-z]$"), into(97, 26)).when(c.rlike("^[A-Z]$"), into(65, 26))
                .when(c.rlike("^[0-9]$"), into(48, 10)).otherwise(c))

    return F.array_join(F.transform(F.split(part, ""), move), "")


def _email(m: Column, key: str) -> Column:
    start = F.struct(F.regexp_extract(m, "^([^@]*)@", 1).alias("a"),
                     F.regexp_extract(m, r"@(.*)\.[A-Za-z]+$", 1).alias("b"))

    def step(s, i):
        return F.struct(s["b"].alias("a"), _shifted(s["a"], _prf(
            key, F.lit("email"), i, s["b"])).alias("b"))

    return _let(F.aggregate(F.sequence(F.lit(0), F.lit(3)), start, step), lambda s: F.concat(
        s["a"], F.lit("@"), s["b"], F.regexp_extract(m, r"(\.[A-Za-z]+)$", 1)))


def pseudonym(m: Column, key: str) -> Column:
    """The pseudonym of one match of ``PATTERN``; a value that fails validation stays."""
    return (
        F.when(m.contains("@"), _email(m, key))
        .when(m.rlike("^([0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4})$"), _date(m, key))
        .when(m.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"), _ip(m, key))
        .when(m.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), _ssn(m, key))
        .when(m.rlike(f"^(?:{PHONE})$"), _phone(m, key))
        .otherwise(_card(m, key))
    )


def pseudonymize(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with personal data in ``text`` replaced, and ``n_replaced`` values changed.

    ``key`` is the secret: with another key all pseudonyms differ.
    """
    names = [c for c in docs.columns if c != "n_replaced"]
    old, new = unused(docs.columns, "old"), unused(docs.columns, "new")
    body = F.col(f"`{text}`")
    found = docs.select(*[f"`{c}`" for c in names], F.when(body.rlike("[0-9@]"), F.regexp_extract_all(
        body, F.lit(PATTERN), F.lit(0))).otherwise(F.array().cast("array<string>")).alias(old))
    changed = found.select("*", F.transform(old, lambda m: pseudonym(m, key)).alias(new))
    pieces = F.split(body, PATTERN, -1)
    built = _let(pieces, lambda p: F.concat(
        F.array_join(F.zip_with(F.slice(p, 1, F.size(new)), F.col(new),
                                lambda a, b: F.concat(a, b)), ""), F.element_at(p, -1)))
    count = F.size(F.filter(F.zip_with(old, new, lambda a, b: a != b), lambda x: x))
    return changed.select(
        *[F.when(F.size(old) > 0, built).otherwise(body).alias(text) if c == text
          else F.col(f"`{c}`") for c in names],
        F.coalesce(count, F.lit(0)).cast("bigint").alias("n_replaced"))
