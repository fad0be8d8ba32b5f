"""Format-preserving pseudonyms for personal numbers, dates, addresses and keys.

Every value found is checked, then permuted by a keyed Feistel network over the
values of its own format: a card number becomes another card number with a valid
check digit, a date another date. A permutation keeps different values different
and equal ones equal, so documents stay linked. Everything is built from column
expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdin.llm.frames import free_names

KEY = "change-me"
ROUNDS = 8
#: Days of a whole Gregorian cycle from FIRST_DAY on: 146,097 = 189 * 773.
FIRST_DAY, DAY_PARTS = "1800-01-01", (189, 773)
KINDS = ("card", "phone", "address", "date", "mail", "key")

_CARD = r"(?<![\w.\-])\d(?:[ \-]?\d){12,18}(?![\w\-]|\.\d)"
_PHONE = r"(?<!\w)\+\d{1,3} ?\(\d{3}\) ?\d{3}-\d{4}(?![\w\-])"
_ADDRESS = r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)"
_DATE = r"(?<![\w.\-/])(?:\d{4}-\d{2}-\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})(?![\w\-/]|\.\d)"
_MAIL = r"(?<![\w.+\-])[A-Za-z0-9][\w.+\-]{0,63}@[A-Za-z0-9\-]{1,63}(?:\.[A-Za-z0-9\-]{1,63})+"
_KEY = r"(?<!\w)[0-9a-f]{32,64}(?!\w)|(?<!\w)[0-9A-F]{32,64}(?!\w)"
#: Longer formats first, where one could begin inside another.
PATTERN = "|".join([_MAIL, _KEY, _PHONE, _DATE, _ADDRESS, _CARD])
_ORDINAL = {"yyyy-MM-dd": r"^\d{4}-", "dd.MM.yyyy": r"^\d{2}\.", "MM/dd/yyyy": r"^\d{2}/"}


def _mixed(key: str, tag: Column, round_: Column, half: Column) -> Column:
    """A keyed 60-bit number of one half in one round."""
    said = F.concat_ws("|", F.lit(key), tag, round_.cast("string"), half.cast("string"))
    return F.conv(F.substring(F.sha2(said, 256), 1, 15), 16, 10).cast("long")


def permuted(left: Column, right: Column, left_size: Column, right_size: Column, key: str, tag: Column) -> Column:
    """Feistel permutation of pairs below two sizes: struct of ``a`` and ``b``.

    Rounds alternately add a keyed function of one half to the other, modulo its size.
    """

    def turn(now: Column, round_: Column) -> Column:
        even = round_ % 2 == 0
        a = F.when(even, F.pmod(now["a"] + _mixed(key, tag, round_, now["b"]) % left_size, left_size)).otherwise(now["a"])
        b = F.when(even, now["b"]).otherwise(F.pmod(now["b"] + _mixed(key, tag, round_, now["a"]) % right_size, right_size))
        return F.struct(a.alias("a"), b.alias("b"))

    start = F.struct(left.cast("long").alias("a"), right.cast("long").alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


def _let(value: Column, function) -> Column:
    """``function`` of a value that is computed once."""
    return F.transform(F.array(value), function)[0]


def digits_permuted(digits: Column, key: str, tag: str) -> Column:
    """Digits (2 to 36) permuted among those of the same number, in parts of at most 18."""

    def one(part: Column) -> Column:
        size = F.length(part)
        low = (size / 2).cast("int")
        power = [F.pow(F.lit(10.0), n).cast("long") for n in (low, size - low)]
        halves = F.substr(part, F.lit(1), low), F.substr(part, low + 1)
        mark = F.concat(F.lit(tag), size.cast("string"))
        done = permuted(halves[0], halves[1], power[0], power[1], key, mark)
        return _let(done, lambda d: F.concat(F.lpad(d["a"].cast("string"), low, "0"), F.lpad(d["b"].cast("string"), size - low, "0")))

    return _let(digits, one)


def laid_out(value: Column, digits: Column) -> Column:
    """New digits in the places of a value's digits; everything else stays."""
    chars = F.split(value, "")

    def place(now: Column, char: Column) -> Column:
        digit = char.rlike("^[0-9]$")
        text = F.concat(now["text"], F.when(digit, F.substr(digits, now["at"] + 1, F.lit(1))).otherwise(char))
        return F.struct(text.alias("text"), (now["at"] + digit.cast("int")).alias("at"))

    return F.aggregate(chars, F.struct(F.lit("").alias("text"), F.lit(0).alias("at")), place)["text"]


def check_sum(digits: Column, doubled_last: bool) -> Column:
    """Sum of the digits, every other one doubled less nine if above it, counted from the last."""

    def add(total: Column, at: Column) -> Column:
        digit = F.substr(digits, F.length(digits) - at + 1, F.lit(1)).cast("int")
        double = (at % 2 == (1 if doubled_last else 0))
        return total + F.when(double, 2 * digit - F.when(digit > 4, 9).otherwise(0)).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)


def _card(value: Column, key: str) -> Column:
    def renumbered(digits: Column) -> Column:
        body = digits_permuted(F.substr(digits, F.lit(1), F.length(digits) - 1), key, "card")
        full = _let(body, lambda b: F.concat(b, F.pmod(10 - check_sum(b, True) % 10, F.lit(10)).cast("string")))
        return F.when(check_sum(digits, False) % 10 == 0, full)

    digits = F.regexp_replace(value, "[^0-9]", "")
    return _let(_let(digits, renumbered), lambda new: F.when(new.isNotNull(), laid_out(value, new)))


def _phone(value: Column, key: str) -> Column:
    """The country code stays; the ten digits after it are permuted."""
    head = F.regexp_extract(value, r"^(\+\d{1,3} ?)", 1)
    rest = F.substr(value, F.length(head) + 1)
    return F.concat(head, laid_out(rest, digits_permuted(F.regexp_replace(rest, "[^0-9]", ""), key, "phone")))


def _address(value: Column, key: str) -> Column:
    part = F.transform(F.split(value, r"\."), lambda x: x.cast("int"))
    valid = F.forall(part, lambda x: x <= 255) & ~value.rlike(r"(^|\.)0\d")
    size = F.lit(65536).cast("long")
    done = _let(part, lambda p: permuted(p[0] * 256 + p[1], p[2] * 256 + p[3], size, size, key, F.lit("address")))
    said = _let(
        done,
        lambda d: F.concat_ws(".", F.shiftright(d["a"], 8).cast("string"), (d["a"] % 256).cast("string"), F.shiftright(d["b"], 8).cast("string"), (d["b"] % 256).cast("string")),
    )
    return F.when(valid, said)


def _date(value: Column, key: str) -> Column:
    """A valid date of the cycle; other dates stay as they are."""
    a, b = (F.lit(n).cast("long") for n in DAY_PARTS)
    first = F.lit(FIRST_DAY).cast("date")

    def moved(style: str) -> Column:
        day = F.datediff(F.try_to_timestamp(value, F.lit(style)).cast("date"), first).cast("long")
        done = _let(day, lambda d: F.when((d >= 0) & (d < a * b), permuted(F.floor(d / b), d % b, a, b, key, F.lit("date"))))
        return _let(done, lambda d: F.date_format(F.date_add(first, (d["a"] * b + d["b"]).cast("int")), style))

    out = F.lit(None).cast("string")
    for style, shape in _ORDINAL.items():
        out = F.when(value.rlike(shape), moved(style)).otherwise(out)
    return out


def _mail(value: Column, key: str) -> Column:
    """The name before the sign becomes a keyed one; the host stays."""
    name, host = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    return F.concat(F.lit("u"), F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit("mail"), F.lower(value)), 256), 1, 16), F.lit("@"), host)


def _secret(value: Column, key: str) -> Column:
    """Hexadecimal digits, eight at a time, each portion keyed by its place and the portions before it."""
    low = F.lower(value)
    parts = F.sequence(F.lit(0), ((F.length(value) - 1) / 8).cast("int"))
    size = F.lit(65536).cast("long")

    def portion(done: Column, at: Column) -> Column:
        own = F.substr(low, at * 8 + 1, F.lit(8))
        before = F.concat(F.lit("key"), F.substr(low, F.lit(1), at * 8))
        full = permuted(F.conv(F.substring(own, 1, 4), 16, 10), F.conv(F.substring(own, 5, 4), 16, 10), size, size, key, before)
        hexed = _let(full, lambda d: F.concat(*[F.lpad(F.lower(F.hex(d[half])), 4, "0") for half in "ab"]))
        short = F.substr(F.sha2(F.concat_ws("|", F.lit(key), before, own), 256), F.lit(1), F.length(own))
        return F.concat(done, F.when(F.length(own) == 8, hexed).otherwise(short))

    new = F.aggregate(parts, F.lit(""), portion)
    return F.when(value.rlike("[A-F]"), F.upper(new)).otherwise(new)


def kind_of(value: Column) -> Column:
    """The kind whose shape a value found by ``PATTERN`` has."""
    return (
        F.when(value.contains("@"), "mail")
        .when(value.startswith("+"), "phone")
        .when(value.rlike(r"^\d{4}-\d\d-\d\d$|^\d\d[./]\d\d[./]\d{4}$"), "date")
        .when(value.rlike(r"^\d+\.\d+\.\d+\.\d+$"), "address")
        .when(value.rlike(r"^[0-9a-fA-F]{32,}$"), "key")
        .otherwise("card")
    )


def pseudonym(value: Column, key: str = KEY) -> Column:
    """Kind and pseudonym of a value: struct ``kind``, ``value``; null kind and the value itself if it is not valid."""
    kind = kind_of(value)
    makers = {"card": _card, "phone": _phone, "address": _address, "date": _date, "mail": _mail, "key": _secret}
    new = F.lit(None).cast("string")
    for name, maker in makers.items():
        new = F.when(kind == name, maker(value, key)).otherwise(new)
    return _let(new, lambda v: F.struct(F.when(v.isNotNull(), kind).alias("kind"), F.coalesce(v, value).alias("value")))


def _number(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda v: v["kind"] == kind)).cast("long")


def pseudonymised(docs: DataFrame, key: str = KEY, column: str = "text") -> DataFrame:
    """``docs`` with personal values of ``column`` replaced; ``n_card``, ``n_phone``, ... count the replaced ones.

    Card numbers with a false check digit, addresses with a part above 255, and
    dates that do not exist (or lie outside 1800 to 2199) are not such values and
    stay. Null texts stay null with counts of zero, empty texts stay empty. Long
    texts are handled whole, row by row; nothing is shuffled. Repeated rows
    give the same result. Columns of ``docs`` with the names of the counts are
    replaced. Mail names become keyed digests, everything else is a
    permutation within its format.
    """
    text = F.col(column)
    some = text.rlike(PATTERN)
    found = F.transform(F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)), lambda v: pseudonym(v, key))
    new = _let(
        F.struct(F.split(text, PATTERN, -1).alias("between"), found.alias("found")),
        lambda s: F.struct(
            F.array_join(F.zip_with(s["between"], s["found"], lambda a, b: F.concat(a, F.coalesce(b["value"], F.lit("")))), "").alias("text"),
            *[_number(s["found"], kind).alias(kind) for kind in KINDS],
        ),
    )
    (name,) = free_names(docs.withColumns({f"n_{kind}": F.lit(0) for kind in KINDS}), "_new")
    work = docs.withColumn(name, F.when(some, new))
    counts = {f"n_{kind}": F.coalesce(F.col(name)[kind], F.lit(0).cast("long")) for kind in KINDS}
    return work.withColumns({column: F.coalesce(F.col(name)["text"], text), **counts}).drop(name)
