"""PII: format-preserving Feistel pseudonyms, in DataFrame functions only.

Personal numbers, dates, addresses and secrets are found by one pattern,
validated (Luhn and mod-97 check digits, octets, calendar, number ranges), and
permuted within their own format by a keyed Feistel network whose round
function is HMAC-SHA-256: digits stay digits, letters stay letters of their
case, separators stay where they are, check digits are made to fit again, dates
stay dates and valid numbers stay valid.  A permutation maps equal values to
equal pseudonyms and different ones to different ones, in all documents, so
records stay linked.  Whoever has no key cannot tell the values.

The key reaches the executors as the value of a one-row local table, so no
text of a plan holds it.

Everything happens within a row: no shuffle; texts without a digit, ``@``,
``=``, ``:`` or the head of an access key are passed over.

Defined cases: a null text stays null with no replacement; an empty text stays
empty; an empty table gives an empty table; values that fail validation are
left as they are; repeated rows are treated each; very long texts, and values
of any length, are taken whole; of several readings of one place the first in
``KINDS`` that fits counts, and of several card numbers in a row of groups the
leftmost, longest; other columns stay as they are, whatever their names.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from biblion.llm.base import fresh

ROUNDS = 8
ALPHABETS = {"0-9": "0123456789", "a-z": "abcdefghijklmnopqrstuvwxyz", "A-Z": "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
#: Days from 1900-01-01 to 2099-12-31, and the two factors that make them.
DAYS, DAYS_A, DAYS_B = 73_049, 17, 4_297
#: Valid areas (not 0, 666, nor from 900 on), groups and serial numbers of a social security number.
AREAS, GROUPS, SERIALS = 898, 99, 9_999
#: Turns of the walk among the dates that are read month first: it fails to end once in 10**25.
TURNS = 64

_LEFT, _RIGHT = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
#: What is looked for, by kind; the first that fits at a place counts.
KINDS = {
    "secret": r"(?i:password|passwd|pwd|secret|api[_-]?key|token)\s?[=:]\s?[\"']?[A-Za-z0-9_+/.-]{8,}",
    "key": r"(?:AKIA|ASIA)[A-Z0-9]{16}",
    "email": r"(?<![._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "iban": r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?",
    "ip": r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}",
    "date": r"[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}[./][0-9]{2}[./][0-9]{4}",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "phone": r"(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-][0-9]{3,4}|\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,5}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}",
    "card": r"[0-9](?:[ -]?[0-9]){12,}+",
}
#: "+" can open a match, so only it may follow a letter or digit.
PATTERN = _LEFT + "(?:" + "|".join(f"(?:{p})" for p in KINDS.values()) + ")" + _RIGHT


def secret_key(spark: SparkSession, key: str) -> Column:
    """i, o: the two padded blocks of HMAC, as a scalar query on a local table whose rows no plan shows."""
    raw = key.encode()
    raw = (hashlib.sha256(raw).digest() if len(raw) > 64 else raw).ljust(64, b"\0")
    rows = spark._jvm.java.util.ArrayList()
    rows.add(raw.hex())
    table = DataFrame(spark._jsparkSession.createDataset(rows, spark._jvm.org.apache.spark.sql.Encoders.STRING()), spark)

    def padded(byte: int) -> Column:
        digits = [F.conv(F.substring("value", 1 + 2 * k, 2), 16, 10).cast("int").bitwiseXOR(F.lit(byte)) for k in range(64)]
        return F.unhex(F.concat(*(F.lpad(F.hex(d), 2, "0") for d in digits)))

    return table.select(F.struct(padded(0x36).alias("i"), padded(0x5C).alias("o"))).scalar()


def _hash(key: Column, *parts: Column) -> Column:
    """48 bits of the HMAC-SHA-256 of the parts."""
    joined = F.concat_ws("|", *(p.cast("string") for p in parts)).cast("binary")
    inner = F.unhex(F.sha2(F.concat(key["i"], joined), 256))
    return F.conv(F.substring(F.sha2(F.concat(key["o"], inner), 256), 1, 12), 16, 10).cast("long")


def _letters(s: Column) -> Column:
    return F.when(F.length(s) > 0, F.sequence(F.lit(1), F.length(s))).otherwise(F.array().cast("array<int>"))


def feistel(s: Column, alphabet: str, key: Column, tweak: str) -> Column:
    """A keyed permutation of the strings of one length over an alphabet."""
    half = F.floor(F.length(s) / 2).cast("int")
    start = F.struct(F.substr(s, F.lit(1), half).alias("a"), F.substr(s, half + 1).alias("b"))

    def turn(x: Column, i: Column) -> Column:
        def moved(j: Column) -> Column:
            place = F.instr(F.lit(alphabet), F.substr(x["a"], j, F.lit(1))) - 1
            place = (place + _hash(key, F.lit(tweak + alphabet[0]), i, j, x["b"])) % len(alphabet)
            return F.substr(F.lit(alphabet), (place + 1).cast("int"), F.lit(1))

        return F.struct(x["b"].alias("a"), F.array_join(F.transform(_letters(x["a"]), moved), "").alias("b"))

    rounds = F.sequence(F.lit(1), F.lit(ROUNDS))
    return F.aggregate(rounds, start, turn, lambda x: F.concat(x["a"], x["b"]))


def permuted(s: Column, key: Column, tweak: str) -> Column:
    """A keyed permutation of the strings of one format: each class of characters in itself."""
    new = F.struct(*(feistel(F.regexp_replace(s, f"[^{c}]", ""), alphabet, key, tweak).alias(f"of_{ord(alphabet[0])}") for c, alphabet in ALPHABETS.items()))

    def with_new(x: Column) -> Column:
        def letter(i: Column) -> Column:
            own = F.substr(s, i, F.lit(1))
            out = own
            for c, alphabet in ALPHABETS.items():
                nth = F.length(F.regexp_replace(F.substr(s, F.lit(1), i), f"[^{c}]", ""))
                out = F.when(own.rlike(f"^[{c}]$"), F.substr(x[f"of_{ord(alphabet[0])}"], nth, F.lit(1))).otherwise(out)
            return out

        return F.array_join(F.transform(_letters(s), letter), "")

    return F.get(F.transform(F.array(new), with_new), 0)


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """The Luhn sum of digits; valid if a multiple of 10."""

    def weighed(i: Column) -> Column:
        d = F.substr(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.transform(_letters(digits), weighed), F.lit(0), lambda a, b: a + b)


def _refilled(s: Column, digits: Column) -> Column:
    """``s`` with its digits replaced in order."""

    def letter(i: Column) -> Column:
        own = F.substr(s, i, F.lit(1))
        nth = F.length(_digits(F.substr(s, F.lit(1), i)))
        return F.when(own.rlike("^[0-9]$"), F.substr(digits, nth, F.lit(1))).otherwise(own)

    return F.array_join(F.transform(_letters(s), letter), "")


def _let(value: Column, use) -> Column:
    """``use`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), use), 0)


def _card_number(s: Column, key: Column) -> Column:
    """A valid number with its digits permuted and its check digit made anew."""

    def made(body: Column) -> Column:
        check = (10 - luhn(F.concat(body, F.lit("0"))) % 10) % 10
        return _refilled(s, F.concat(body, check.cast("string")))

    digits = _digits(s)
    return _let(feistel(F.substr(digits, F.lit(1), F.length(digits) - 1), ALPHABETS["0-9"], key, "card"), made)


def card(s: Column, key: Column) -> Column:
    """text and n, the numbers replaced: in a row of digit groups every valid one, of 13 to 19 digits in one group, or in groups of 3 to 7 after one of 4."""

    def replaced(groups: Column) -> Column:
        def longest(i: Column) -> Column:
            """The most groups from the i-th on that make a valid number, and its text; null without any."""

            def joined(j: Column) -> Column:
                return F.regexp_replace(F.array_join(F.slice(groups, i, j - i + 1), ""), "[ -]$", "")

            def valid(x: Column) -> Column:
                digits = _digits(x["part"])
                shape = x["part"].rlike("^(?:[0-9]+|[0-9]{4}(?:[ -][0-9]{3,7})+)$")
                return F.length(digits).between(13, 19) & shape & (luhn(digits) % 10 == 0)

            ends = F.sequence(i, F.least(i + 4, F.size(groups)))
            return F.array_max(F.filter(F.transform(ends, lambda j: F.struct(j.alias("j"), joined(j).alias("part"))), valid))

        def turn(x: Column, i: Column) -> Column:
            def taken(best: Column) -> Column:
                own = F.get(groups, i - 1)
                end = F.regexp_extract(F.get(groups, best["j"].cast("int") - 1), "[ -]?$", 0)
                new = F.concat(_card_number(best["part"], key), end)
                return F.when(best.isNull(), F.struct((i + 1).alias("next"), F.concat(x["out"], F.array(own)).alias("out"), x["n"].alias("n"))).otherwise(F.struct((best["j"] + 1).alias("next"), F.concat(x["out"], F.array(new)).alias("out"), (x["n"] + 1).alias("n")))

            return F.when(i < x["next"], x).otherwise(_let(longest(i), taken))

        start = F.struct(F.lit(1).alias("next"), F.array().cast("array<string>").alias("out"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(F.sequence(F.lit(1), F.size(groups)), start, turn, lambda x: F.struct(F.array_join(x["out"], "").alias("text"), x["n"].alias("n")))

    return _let(F.regexp_extract_all(s, F.lit("[0-9]+[ -]?"), F.lit(0)), replaced)


def remainder97(s: Column) -> Column:
    """Letters as 10 to 35, the number modulo 97."""

    def value(i: Column) -> Column:
        return F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), F.substr(s, i, F.lit(1))) - 1

    return F.aggregate(F.transform(_letters(s), value), F.lit(0), lambda a, v: F.when(v > 9, a * 100 + v).otherwise(a * 10 + v) % 97)


def iban(s: Column, key: Column) -> Column:
    bare = F.replace(s, F.lit(" "), F.lit(""))
    country, rest = F.substr(bare, F.lit(1), F.lit(2)), F.substr(bare, F.lit(5))
    valid = F.length(bare).between(15, 34) & (remainder97(F.concat(rest, F.substr(bare, F.lit(1), F.lit(4)))) == 1)

    def made(body: Column) -> Column:
        check = F.lpad((98 - remainder97(F.concat(body, country, F.lit("00")))).cast("string"), 2, "0")
        flat = F.concat(country, check, body)

        def letter(i: Column) -> Column:
            own = F.substr(s, i, F.lit(1))
            nth = F.length(F.replace(F.substr(s, F.lit(1), i), F.lit(" "), F.lit("")))
            return F.when(own == " ", own).otherwise(F.substr(flat, nth, F.lit(1)))

        return F.array_join(F.transform(_letters(s), letter), "")

    return F.when(valid, _let(permuted(rest, key, "iban"), made)).otherwise(s)


def _mixed_radix(n: Column, a: int, b: int, key: Column, tweak: str) -> Column:
    """A keyed permutation of the numbers below a * b."""
    start = F.struct((F.floor(n / b)).cast("long").alias("l"), (n % b).cast("long").alias("r"))

    def turn(x: Column, i: Column) -> Column:
        left = (x["l"] + _hash(key, F.lit(tweak), i, F.lit("l"), x["r"])) % a
        return _let(left, lambda v: F.struct(v.alias("l"), ((x["r"] + _hash(key, F.lit(tweak), i, F.lit("r"), v)) % b).alias("r")))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn, lambda x: x["l"] * b + x["r"])


def ip(s: Column, key: Column) -> Column:
    part = F.split(s, r"\.")
    octets = [F.get(part, i).cast("long") for i in range(4)]
    valid = F.greatest(*octets) < 256
    number = octets[0] * 16777216 + octets[1] * 65536 + octets[2] * 256 + octets[3]

    def made(n: Column) -> Column:
        return F.concat_ws(".", *((F.floor(n / 256**k) % 256).cast("long").cast("string") for k in (3, 2, 1, 0)))

    return F.when(valid, _let(_mixed_radix(number, 65536, 65536, key, "ip"), made)).otherwise(s)


def date(s: Column, key: Column) -> Column:
    """Valid days of 1900 to 2099 are permuted among themselves.

    12.05.2020 and 12/05/2020 are read day first; what is a day only month
    first (12/25/2020) is permuted among such days.
    """
    separator = F.substr(s, F.lit(3), F.lit(1))
    iso = s.rlike("^[0-9]{4}-")
    year = F.when(iso, F.substr(s, F.lit(1), F.lit(4))).otherwise(F.substr(s, F.lit(7), F.lit(4)))
    first, second = F.substr(s, F.lit(1), F.lit(2)), F.substr(s, F.lit(4), F.lit(2))
    month, day = F.when(iso, F.substr(s, F.lit(6), F.lit(2))).otherwise(second), F.when(iso, F.substr(s, F.lit(9), F.lit(2))).otherwise(first)
    base = F.lit("1900-01-01").cast("date")

    def number(month: Column, day: Column) -> Column:
        found = F.try_to_timestamp(F.concat_ws("-", year, month, day), F.lit("yyyy-MM-dd")).cast("date")
        return F.datediff(found, base).cast("long")

    def inside(n: Column) -> Column:
        return F.coalesce(n.between(0, DAYS - 1), F.lit(False))

    def to(n: Column) -> Column:
        return F.date_add(base, n.cast("int"))

    def moved(n: Column) -> Column:
        return _mixed_radix(n, DAYS_A, DAYS_B, key, "date")

    def again(n: Column, _: Column) -> Column:
        return F.when(F.day(to(n)) > 12, n).otherwise(moved(n))

    def made(n: Column) -> Column:
        other = F.concat(F.date_format(to(n), "dd"), separator, F.date_format(to(n), "MM"), separator, F.date_format(to(n), "yyyy"))
        return F.when(iso, F.date_format(to(n), "yyyy-MM-dd")).otherwise(other)

    def made_month_first(n: Column) -> Column:
        return F.concat(F.date_format(to(n), "MM"), separator, F.date_format(to(n), "dd"), separator, F.date_format(to(n), "yyyy"))

    one, other = number(month, day), number(first, second)
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(TURNS)), moved(other), again)
    return F.when(inside(one), _let(moved(one), made)).when(~iso & inside(other), _let(walked, made_month_first)).otherwise(s)


def ssn(s: Column, key: Column) -> Column:
    """Valid numbers are permuted among themselves; pseudonyms are valid, too."""
    area, group, serial = (F.substr(s, F.lit(at), F.lit(n)).cast("long") for at, n in ((1, 3), (5, 2), (8, 4)))
    valid = ~s.rlike("^(000|666|9)|-00-|-0000$")
    place = area - F.when(area > 666, 2).otherwise(1)
    number = (place * GROUPS + group - 1) * SERIALS + serial - 1

    def made(n: Column) -> Column:
        top = F.floor(n / (GROUPS * SERIALS)).cast("long")
        parts = (top + F.when(top >= 665, 2).otherwise(1), F.floor(n / SERIALS).cast("long") % GROUPS + 1, n % SERIALS + 1)
        return F.concat_ws("-", *(F.lpad(x.cast("string"), w, "0") for x, w in zip(parts, (3, 2, 4), strict=True)))

    return F.when(valid, _let(_mixed_radix(number, AREAS * GROUPS, SERIALS, key, "ssn"), made)).otherwise(s)


def phone(s: Column, key: Column) -> Column:
    """The country code stays; 7 to 15 digits are a number."""
    head = F.regexp_extract(s, r"^\+[0-9]{1,3}(?=[ .(-])", 0)
    rest = F.substr(s, F.length(head) + 1)
    valid = F.length(_digits(s)).between(7, 15)
    return F.when(valid, F.concat(head, permuted(rest, key, "phone"))).otherwise(s)


def email(s: Column, key: Column) -> Column:
    at = F.instr(s, "@")
    return F.concat(permuted(F.substr(s, F.lit(1), at - 1), key, "email"), F.substr(s, at))


def secret(s: Column, key: Column) -> Column:
    head = F.regexp_extract(s, r"^[A-Za-z_-]+\s?[=:]\s?[\"']?", 0)
    return F.concat(head, permuted(F.substr(s, F.length(head) + 1), key, "secret"))


def access_key(s: Column, key: Column) -> Column:
    return F.concat(F.substr(s, F.lit(1), F.lit(4)), permuted(F.substr(s, F.lit(5)), key, "key"))


_MAKE = {"secret": secret, "key": access_key, "email": email, "iban": iban, "ip": ip, "date": date, "ssn": ssn, "phone": phone, "card": card}


def pseudonym(s: Column, key: Column) -> Column:
    """text and n: the pseudonym of a value that PATTERN found and how much was replaced; the value itself if it isn't valid."""

    def told(x: Column) -> Column:
        return F.struct(x.alias("text"), (x != s).cast("long").alias("n"))

    out = told(s)
    for kind in reversed(KINDS):
        made = _MAKE[kind](s, key)
        out = F.when(s.rlike(f"^(?:{KINDS[kind]})$"), made if kind == "card" else _let(made, told)).otherwise(out)
    return out


def pseudonymised(docs: DataFrame, key: str, text: str = "text", count: str | None = None) -> DataFrame:
    """``docs`` with pseudonyms in its text; ``count`` names a column for their number."""
    column = F.col(text)
    likely = column.rlike("[0-9@=:]|AKIA|ASIA")  # what any of KINDS holds
    found = F.regexp_extract_all(column, F.lit(PATTERN), F.lit(0))
    sent, made_of = fresh("key", docs.columns), fresh("made", docs.columns)

    def both(values: Column) -> Column:
        new = F.transform(values, lambda v: pseudonym(v, F.col(sent)))
        between = F.split(column, PATTERN, -1)
        joined = F.array_join(F.flatten(F.transform(between, lambda p, i: F.array(p, F.coalesce(F.get(new, i)["text"], F.lit(""))))), "")
        changed = F.aggregate(new, F.lit(0).cast("long"), lambda a, x: a + x["n"])
        return F.struct(joined.alias("text"), changed.alias("n"))

    made = F.when(likely, _let(found, both)).otherwise(F.struct(column.alias("text"), F.lit(0).cast("long").alias("n")))
    rows = docs.withColumn(sent, secret_key(docs.sparkSession, key)).withColumn(made_of, made)
    columns = [F.col(made_of)["text"].alias(text) if f == text else F.col(f) for f in docs.columns if f != count]
    return rows.select(*columns, *([F.coalesce(F.col(made_of)["n"], F.lit(0)).alias(count)] if count else []))
