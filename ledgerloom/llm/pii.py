"""Personal data replaced by format-preserving Feistel pseudonyms, in SQL functions only.

Found values are validated (check sums, ranges, calendar) and permuted within their format by a keyed
Feistel network, so equal values get equal pseudonyms in all documents, and a pseudonym is valid again:

* payment card and other numbers with a Luhn digit, and 16-digit numbers as a whole: digits permuted,
  the Luhn digit computed anew where the number had a valid one, and wrong again where not; separators stay where they are
* IBANs: the account part is permuted, the two check digits are computed anew (letters stay)
* telephone numbers with a country code or an area code in brackets: the digits after these
* social-security-like numbers ddd-dd-dddd with a valid area, group and serial
* IPv4 addresses: the 32-bit value
* dates yyyy-mm-dd, yyyy/mm/dd, dd.mm.yyyy and mm/dd/yyyy of the years 1800 to 2199: the day in that
  calendar cycle of 400 years
* e-mail addresses: letters and digits of the local part, within their class

A network over a pair of halves (m values times n values) adds a keyed hash of one half to the other,
modulo its size, in turns; so it is a permutation of the m * n values, whatever their sizes.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8

# Patterns of the kinds, by Java's rules. A match does not touch further word characters.
EMAIL = r"[A-Za-z0-9][A-Za-z0-9._%+-]*+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IBAN = r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b"
IPV4 = r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d]|\.\d)"
DATE = r"(?<!\d)(?:\d{4}-\d\d-\d\d|\d{4}/\d\d/\d\d|\d\d\.\d\d\.\d{4}|\d\d/\d\d/\d{4})(?!\d)"
SSN = r"(?<![\d-])\d{3}-\d\d-\d{4}(?![\d-])"
PHONE = r"(?<![\d+])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)|(?<![\d+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\d)"
CARD = r"(?<!\d)\d(?:[ -]?\d){12,18}(?!\d)"
KINDS = (("email", EMAIL), ("iban", IBAN), ("ipv4", IPV4), ("date", DATE), ("ssn", SSN), ("phone", PHONE), ("card", CARD))
# A place needs a digit or @ nearby; the alternatives are tried in this order.
FOUND = "|".join(f"(?:{p})" for _, p in KINDS)
CYCLE_START = "1800-01-01"
# 146,097 days of 400 years.
CYCLE = (189, 773)


def _feistel(high: Column, low: Column, m: Column, n: Column, key: str, tweak: str | Column) -> tuple[Column, Column]:
    """Permuted halves of a value (high below m, low below n); turns alternate between the halves."""
    start = F.struct(high.cast("long").alias("a"), low.cast("long").alias("b"))

    def turn(s: Column, i: Column) -> Column:
        def mask(half: Column, size: Column) -> Column:
            return F.pmod(F.xxhash64(F.lit(key), F.lit(tweak), m, n, i, half), size)

        even = F.struct(F.pmod(s["a"] + mask(s["b"], m), m).alias("a"), s["b"].alias("b"))
        odd = F.struct(s["a"].alias("a"), F.pmod(s["b"] + mask(s["a"], n), n).alias("b"))
        return F.when(i % 2 == 0, even).otherwise(odd)

    done = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)
    return done["a"], done["b"]


def _power(base: int, exponent: Column) -> Column:
    return F.element_at(F.array(*[F.lit(base**i).cast("long") for i in range(12 if base == 10 else 10)]), exponent + 1)


def permute_digits(digits: Column, key: str, tweak: str | Column) -> Column:
    """A string of 2 to 22 decimal digits, permuted among the strings of its length."""
    size = F.length(digits)
    left = F.floor(size / 2).cast("int")
    m, n = _power(10, left), _power(10, size - left)
    a, b = _feistel(F.substring(digits, F.lit(1), left).cast("long"), F.substring(digits, left + 1, size - left).cast("long"), m, n, key, tweak)
    return F.concat(F.lpad(a.cast("string"), left, F.lit("0")), F.lpad(b.cast("string"), size - left, F.lit("0")))


def only_digits(value: Column) -> Column:
    return F.regexp_replace(value, r"\D", "")


def refill(pattern: Column, digits: Column) -> Column:
    """The pattern with its digits replaced in turn by `digits`."""
    gaps = F.split(pattern, r"\d", -1)
    filled = F.transform(gaps, lambda gap, i: F.concat(gap, F.substring(digits, i + 1, F.lit(1))))
    return F.array_join(filled, "")


def luhn_sum(digits: Column, doubled_from_right: int) -> Column:
    """Luhn's sum; digits at even (0) or odd (1) distance from the right end are doubled."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda d: d.cast("int"))
    weighed = F.transform(
        each, lambda d, i: F.when(i % 2 == doubled_from_right, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)
    )
    return F.aggregate(weighed, F.lit(0), lambda s, d: s + d)


def _bound(value: Column, make: Callable[[Column], Column]) -> Column:
    """`make(value)`, with the value computed once."""
    return F.element_at(F.transform(F.array(value), make), 1)


def pseudo_card(value: Column, key: str) -> Column:
    """13 to 19 digits with separators: with a valid Luhn digit it is valid again. Of the others only 16 digits change.

    Those stay invalid, so the two ranges are apart: the last digit's distance (1 to 9) from the valid
    one selects the network of the other 15 digits, and is itself shifted by a hash of what these become.
    """
    digits = only_digits(value)
    start = F.substring(digits, F.lit(1), F.length(digits) - 1)
    check = lambda body: F.pmod(-luhn_sum(body, 0), F.lit(10))
    valid = _bound(permute_digits(start, key, "card"), lambda body: F.concat(body, check(body).cast("string")))
    distance = F.pmod(F.substring(digits, -1, 1).cast("int") - check(start), F.lit(10))

    def invalid(d: Column) -> Column:
        shift = lambda body: F.pmod(F.xxhash64(F.lit(key), F.lit("number"), body), F.lit(9))
        last = lambda body: F.pmod(check(body) + 1 + F.pmod(d - 1 + shift(body), F.lit(9)), F.lit(10))
        return _bound(permute_digits(start, key, F.concat(F.lit("number"), d.cast("string"))), lambda body: F.concat(body, last(body).cast("string")))

    return (
        F.when(luhn_sum(digits, 1) % 10 == 0, refill(value, valid))
        .when(F.length(digits) == 16, refill(value, _bound(distance, invalid)))
        .otherwise(value)
    )


def pseudo_phone(value: Column, key: str) -> Column:
    """Digits after the country code, and after the area code where it is in brackets, permuted."""
    head = F.regexp_extract(value, r"^(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)|^\+\d{1,2}", 0)
    rest = F.substring(value, F.length(head) + 1, F.length(value))
    return F.concat(head, refill(rest, permute_digits(only_digits(rest), key, "phone")))


def pseudo_ssn(value: Column, key: str) -> Column:
    """Area 001-899 without 666, group 01-99 and serial 0001-9999, permuted among the valid ones."""
    part = lambda i: F.split(value, "-")[i].cast("int")
    area, group, serial = part(0), part(1), part(2)
    index = F.when(area > 666, area - 2).otherwise(area - 1)
    valid = area.between(1, 899) & (area != 666) & group.between(1, 99) & serial.between(1, 9999)
    a, b = _feistel(index, (group - 1) * 9999 + serial - 1, F.lit(898).cast("long"), F.lit(99 * 9999).cast("long"), key, "ssn")
    new_area = F.when(a >= 665, a + 2).otherwise(a + 1)
    made = F.format_string("%03d-%02d-%04d", new_area, F.floor(b / 9999) + 1, b % 9999 + 1)
    return F.when(valid, made).otherwise(value)


def pseudo_ipv4(value: Column, key: str) -> Column:
    """The 32-bit value permuted; numbers over 255 are no address and stay."""
    octets = F.transform(F.split(value, r"\."), lambda x: x.cast("long"))
    half = F.lit(1 << 16).cast("long")
    a, b = _feistel(octets[0] * 256 + octets[1], octets[2] * 256 + octets[3], half, half, key, "ipv4")
    made = F.concat_ws(".", F.floor(a / 256).cast("string"), (a % 256).cast("string"), F.floor(b / 256).cast("string"), (b % 256).cast("string"))
    return F.when(F.forall(octets, lambda x: x <= 255), made).otherwise(value)


def pseudo_date(value: Column, key: str) -> Column:
    """A date of the calendar cycle, permuted among its days and written alike; other numbers stay."""
    made = value
    for shape, pattern in (
        (r"^\d{4}-", "yyyy-MM-dd"),
        (r"^\d{4}/", "yyyy/MM/dd"),
        (r"^\d\d\.", "dd.MM.yyyy"),
        (r"^\d\d/", "MM/dd/yyyy"),
    ):
        day = F.datediff(F.try_to_timestamp(value, F.lit(pattern)).cast("date"), F.lit(CYCLE_START).cast("date"))
        m, n = (F.lit(x).cast("long") for x in CYCLE)
        a, b = _feistel(F.floor(day / CYCLE[1]), day % CYCLE[1], m, n, key, "date")
        moved = F.date_format(F.date_add(F.lit(CYCLE_START).cast("date"), (a * CYCLE[1] + b).cast("int")), pattern)
        inside = F.coalesce(day.between(0, CYCLE[0] * CYCLE[1] - 1), F.lit(False))
        made = F.when(value.rlike(shape), F.when(inside, moved).otherwise(value)).otherwise(made)
    return made


def pseudo_iban(value: Column, key: str) -> Column:
    """An IBAN of valid check digits (remainder 97) gets a permuted account and new check digits; others stay."""
    plain = F.regexp_replace(value, " ", "")

    def remainder(text: Column) -> Column:
        code = lambda c: F.when(c.rlike(r"\d"), c.cast("int")).otherwise(F.ascii(c) - 55)
        return F.aggregate(
            F.split(text, ""), F.lit(0), lambda r, c: F.when(c == "", r).when(c.rlike("[A-Z]"), (r * 100 + code(c)) % 97).otherwise((r * 10 + code(c)) % 97)
        )

    account = F.substring(plain, F.lit(5), F.length(plain))
    digits = only_digits(account)
    # At most 20 digits are permuted together; the few of a longer account are in a second network.
    first, second = F.substring(digits, 1, 20), F.substring(digits, F.lit(21), F.length(digits))
    moved = F.concat(permute_digits(first, key, "iban"), F.when(F.length(second) > 1, permute_digits(second, key, "iban2")).otherwise(second))
    new_account = refill(account, moved)
    country = F.substring(plain, 1, 2)
    check = F.lpad((98 - remainder(F.concat(new_account, country, F.lit("00")))).cast("string"), 2, "0")
    valid = (remainder(F.concat(account, F.substring(plain, 1, 4))) == 1) & (F.length(digits) > 1)
    flat = F.concat(country, check, new_account)
    spaced = F.aggregate(
        F.split(value, ""),
        F.struct(F.lit("").alias("out"), F.lit(1).alias("at")),
        lambda s, c: F.when(c == "", s)
        .when(c == " ", F.struct(F.concat(s["out"], c).alias("out"), s["at"].alias("at")))
        .otherwise(F.struct(F.concat(s["out"], F.substring(flat, s["at"], F.lit(1))).alias("out"), (s["at"] + 1).alias("at"))),
        lambda s: s["out"],
    )
    return F.when(valid, spaced).otherwise(value)


def pseudo_email(value: Column, key: str) -> Column:
    """The local part: each letter and digit is shifted within its class by a keyed hash of the rest of the address.

    Letters are permuted by a two-sided network: the first half's shifts hang on the second half and
    the domain, then the other way round, in turns. A local part of one character is shifted by the domain.
    """
    domain = F.substring_index(value, "@", -1)
    local = F.substring(value, F.lit(1), F.length(value) - F.length(domain) - 1)
    cut = F.floor(F.length(local) / 2).cast("int")
    start = F.struct(F.substring(local, F.lit(1), cut).alias("a"), F.substring(local, cut + 1, F.length(local)).alias("b"))

    def shifted(half: Column, other: Column, i: Column) -> Column:
        def one(c: Column, at: Column) -> Column:
            step = F.xxhash64(F.lit(key), F.lit("email"), i, at, F.lower(domain), other)
            code = F.ascii(c)
            turn = lambda first, size: F.chr(first + F.pmod(code - first + step, F.lit(size)))
            return F.when(c.rlike("^[a-z]$"), turn(97, 26)).when(c.rlike("^[A-Z]$"), turn(65, 26)).when(c.rlike("^[0-9]$"), turn(48, 10)).otherwise(c)

        return F.array_join(F.transform(F.split(half, ""), one), "")

    done = F.aggregate(
        F.sequence(F.lit(0), F.lit(3)),
        start,
        lambda s, i: F.when(i % 2 == 0, F.struct(shifted(s["a"], s["b"], i).alias("a"), s["b"].alias("b"))).otherwise(
            F.struct(s["a"].alias("a"), shifted(s["b"], s["a"], i).alias("b"))
        ),
    )
    return F.concat(done["a"], done["b"], F.lit("@"), domain)


def kind_of(value: Column) -> Column:
    """The first kind whose pattern covers the value."""
    out = F.lit(None).cast("string")
    for name, pattern in reversed(KINDS):
        bare = functools.reduce(lambda s, x: s.replace(x, ""), (r"(?<![\d.])", r"(?![\d]|\.\d)", r"(?<!\d)", r"(?!\d)", r"(?<![\d-])", r"(?![\d-])", r"(?<![\d+])"), pattern)
        out = F.when(value.rlike(f"^(?:{bare})$"), F.lit(name)).otherwise(out)
    return out


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of one found value; what fails its validation stays as it is."""
    kind = kind_of(value)
    out = value
    for name, make in (
        ("card", pseudo_card),
        ("phone", pseudo_phone),
        ("ssn", pseudo_ssn),
        ("date", pseudo_date),
        ("ipv4", pseudo_ipv4),
        ("iban", pseudo_iban),
        ("email", pseudo_email),
    ):
        out = F.when(kind == name, make(value, key)).otherwise(out)
    return out


def pseudonymise(docs: DataFrame, key: str = "change-this-key", text: str = "text") -> DataFrame:
    """`docs` with `text` pseudonymised and two columns more: n_found, n_changed (long).

    No shuffle and no Python. A null text stays null with counts 0; an empty one stays empty; other
    columns are not touched, and rows are treated one by one, so repeated rows stay repeated. Whole texts
    are searched, however long; an empty table gives no rows. Columns n_found and n_changed of `docs`
    itself are replaced, and names that begin with `__found`, `__gaps` and `__new` are reserved.
    """
    found = F.regexp_extract_all(F.col(text), F.lit(FOUND), F.lit(0))
    gaps = F.split(F.col(text), FOUND, -1)
    some = F.col(text).rlike(r"[0-9@]")
    staged = docs.withColumn("__found", F.when(some, found)).withColumn("__gaps", F.when(some & (F.size("__found") > 0), gaps))
    staged = staged.withColumn("__new", F.transform("__found", lambda v: pseudonym(v, key)))
    # One gap more than values: the last gap is followed by nothing.
    woven = F.array_join(
        F.transform("__gaps", lambda gap, i: F.concat(gap, F.coalesce(F.get("__new", i), F.lit("")))), ""
    )
    changed = F.size(F.filter(F.zip_with("__found", "__new", lambda a, b: a != b), lambda x: x))
    return (
        staged.withColumn(text, F.when(F.col("__gaps").isNull(), F.col(text)).otherwise(woven))
        .withColumn("n_found", F.coalesce(F.when(some, F.size("__found")), F.lit(0)).cast("long"))
        .withColumn("n_changed", F.coalesce(F.when(some, changed), F.lit(0)).cast("long"))
        .drop("__found", "__gaps", "__new")
    )
