"""Personal data: format-preserving Feistel pseudonyms.

Validated numbers and dates are replaced by a keyed permutation of their own
format: a card number by a card number with a right check digit, a phone number by
one of the same layout, an address by an address, a date by a date. The
permutation is a balanced Feistel network on decimal digits, ten rounds, with
SHA-256 over key, kind, length, round and half as round function. Where not every
digit string is valid, the permutation is applied again until one is (cycle
walking), so it stays one-to-one among valid values. Equal values therefore get
equal pseudonyms in every document and different values different ones; without
the key they cannot be turned back.

Mail addresses and secrets have no digits to permute; they become a keyed tag, so
they stay linked as well. An address has at most 64 characters before the at sign and
labels of at most 63 behind it, as the format allows: of a longer run before the at
sign, the last 64 characters are taken for it.

Every pattern is bounded, or repeats a single class of characters behind a border. So
texts of any length take time in proportion to it.

Phone numbers are found in the layouts of the texts' countries: US, behind a
country code with ``+`` (``(0)`` stays as it is), behind a leading zero in groups,
and Spanish in groups of 3-2-2-2. Not recognised: phone numbers in one piece without
``+``, in groups of 3-3-3, or of fewer than 8
digits behind the leading zero; dates with month names or years of two digits, and
years first with other separators than hyphens; cards grouped otherwise than 4-4-4-n
or 4-6-5; an IBAN with a group of capitals right behind it; IPv6 addresses; tax,
passport and identity numbers but the US social security number; names and postal
addresses.

Only Spark's own functions are used, in one pass without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: The key of the registered query. A production run passes its own secret.
KEY = "histflow-pseudonyms"
ROUNDS = 10
#: Applications of the permutation at most; fewer than one value in 10^11 needs more.
WALK = 64

#: Parts no longer than an address allows (64 characters, 63 a label, 126 labels): a text takes linear time, and no more
#: of the stack than so many labels do.
#: Behind six characters, a longer run is only read on where it begins, at the match before, or 64 characters ahead of the
#: sign: at its other places no address can begin that did not begin before.
LOCAL = "[A-Za-z0-9._%+-]"
LONG_RUN = f"(?={LOCAL})(?:(?<!{LOCAL}(?s:.{{6}}))|(?<=\\G(?s:.{{6}}))|(?=(?s:.{{58}})@)){LOCAL}{{1,58}}+"
EMAIL = f"{LOCAL}{{1,6}}+(?:{LONG_RUN})?+" + r"@(?:[A-Za-z0-9-]{1,63}\.){1,126}[A-Za-z]{2,63}"
NAMED_SECRET = r"(?i:\b(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key))\"?\s{0,3}[=:]\s{0,3}[\"']?[^\s\"',;]{8,}[\"']?"
SECRET = r"\bAKIA[0-9A-Z]{16}\b|\bgh[pousr]_[A-Za-z0-9]{36,}|(?<![0-9A-Za-z])(?:[0-9a-f]{32,}|[0-9A-F]{32,})(?![0-9A-Za-z])|-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----[^-]*-----END [A-Z ]{0,30}PRIVATE KEY-----"
CARD = r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}([ -])(?:[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|[0-9]{6}\1[0-9]{5}))(?![0-9A-Za-z])"
#: Country, check digits, and the account in one piece or in groups of four; its length is tested with the check digits.
IBAN = r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:[0-9A-Z]{11,30}|(?: [0-9A-Z]{4}){2,7}(?: [0-9A-Z]{1,3})?)(?![0-9A-Za-z])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
ISO_DATE = r"(?<![0-9-])(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}(?![0-9-])"
DAY_DATE = r"(?<![0-9/.-])[0-9]{1,2}([/.-])[0-9]{1,2}\1(?:19|20)[0-9]{2}(?![0-9/-])"
IP = r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"
US_PHONE = r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])"
WORLD_PHONE = r"(?<![0-9A-Za-z+])\+[0-9]{1,3}(?:[ .-]?\(0\))?[ .-]?(?:\([0-9]{1,4}\) ?)?[0-9]{1,15}(?:[ .-][0-9]{1,12}){0,5}(?![0-9A-Za-z])"
PHONE = f"{US_PHONE}|{WORLD_PHONE}"
#: Behind a leading zero, or Spanish in groups of 3-2-2-2.
NATIONAL_PHONE = r"(?<![0-9A-Za-z+/.-])(?:(?:\(0[0-9]{1,4}\) ?|0[0-9]{1,4}[ ./-])[0-9]{2,10}(?:[ .-][0-9]{2,4}){0,4}|[6-9][0-9]{2}(?: [0-9]{2}){3})(?![0-9A-Za-z]|[./-][0-9])"

FIRST_DAY, DAYS = "1900-01-01", 73049  # to 2099-12-31


def _numbered(pattern: str, number: int) -> str:
    """``pattern`` with its one group's back-references written for place ``number``."""
    return pattern.replace("\\1", f"\\{number}")


#: One alternation; the separators of CARD and DAY_DATE are its groups 1 and 2.
ANY = "|".join([EMAIL, NAMED_SECRET, SECRET, _numbered(CARD, 1), IBAN, SSN, ISO_DATE, _numbered(DAY_DATE, 2), IP, PHONE, NATIONAL_PHONE])


def _only(pattern: str) -> str:
    return f"^(?:{pattern})$"


def bound(x: Column, f) -> Column:
    """``f(x)`` with ``x`` computed once."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def feistel(digits: Column, key: str, kind: str) -> Column:
    """A keyed permutation of the digit strings of one length (2 to 18 digits)."""
    return bound(digits, lambda d: _rounds(d, key, kind))


def _rounds(digits: Column, key: str, kind: str) -> Column:
    n = F.length(digits)
    short = F.floor(n / 2).cast("int")
    powers = F.array(*[F.lit(10**i) for i in range(10)])

    def one(acc: Column, i: Column) -> Column:
        width = F.when(i % 2 == 0, short).otherwise(n - short)
        size = F.get(powers, width)
        hashed = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), n.cast("string"), i.cast("string"), acc["b"]), 256)
        y = F.conv(F.substr(hashed, F.lit(1), F.lit(15)), 16, 10).cast("long")
        mixed = F.pmod(acc["a"].cast("long") + F.pmod(y, size), size)
        return F.struct(acc["b"].alias("a"), F.lpad(mixed.cast("string"), width, F.lit("0")).alias("b"))

    start = F.struct(F.substr(digits, F.lit(1), short).alias("a"), F.substr(digits, short + 1, n - short).alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, one, lambda acc: F.concat(acc["a"], acc["b"]))


def walk(digits: Column, key: str, kind: str, valid) -> Column:
    """The permutation among the valid digit strings."""
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(WALK)),
        digits,
        lambda acc, i: F.when((i > 0) & valid(acc), acc).otherwise(_rounds(acc, key, kind)),
    )


def refill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits, in order, replaced by ``digits``."""
    filled = F.aggregate(
        F.split(shape, ""),
        F.struct(F.lit("").alias("out"), F.lit(0).alias("n")),
        lambda acc, c: F.when(
            c.rlike("^[0-9]$"), F.struct(F.concat(acc["out"], F.substr(digits, acc["n"] + 1, F.lit(1))).alias("out"), (acc["n"] + 1).alias("n"))
        ).otherwise(F.struct(F.concat(acc["out"], c).alias("out"), acc["n"].alias("n"))),
    )
    return filled["out"]


def check_digit(payload: Column) -> Column:
    """The Luhn check digit of a number without it."""
    doubled = F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)])
    sums = F.aggregate(
        F.split(F.reverse(payload), ""),
        F.struct(F.lit(0).alias("sum"), F.lit(True).alias("double")),
        lambda acc, c: F.struct(
            (acc["sum"] + F.when(acc["double"], F.get(doubled, c.cast("int"))).otherwise(c.cast("int"))).alias("sum"),
            (~acc["double"]).alias("double"),
        ),
        lambda acc: acc["sum"],
    )
    return F.pmod(10 - F.pmod(sums, 10), 10).cast("string")


def _all_but_last(x: Column) -> Column:
    return F.substr(x, F.lit(1), F.length(x) - 1)


def _card(m: Column, key: str) -> Column:
    def of(digits: Column) -> Column:
        body = _all_but_last(digits)
        valid = check_digit(body) == F.substr(digits, F.length(digits), F.lit(1))
        new = bound(feistel(body, key, "card"), lambda x: F.concat(x, check_digit(x)))
        return F.when(valid, bound(new, lambda x: refill(m, x))).otherwise(m)

    return bound(F.regexp_replace(m, "[^0-9]", ""), of)


def _remainder(account: Column) -> Column:
    """The number of an IBAN's rearranged characters (A is 10), modulo 97."""
    return F.aggregate(
        F.split(account, ""),
        F.lit(0),
        lambda acc, c: F.when(c.rlike("^[0-9]$"), F.pmod(acc * 10 + c.cast("int"), F.lit(97))).otherwise(F.pmod(acc * 100 + F.ascii(c) - 55, F.lit(97))),
    )


def _iban(m: Column, key: str) -> Column:
    """Another account of the same country, layout and letters, with right check digits."""

    def of(plain: Column) -> Column:
        country, body = F.substr(plain, F.lit(1), F.lit(2)), F.substr(plain, F.lit(5))
        valid = (F.length(plain).between(15, 34)) & (_remainder(F.concat(body, F.substr(plain, F.lit(1), F.lit(4)))) == 1)

        def new(digits: Column) -> Column:
            # The network takes 2 to 18 digits: longer accounts are permuted in halves.
            half = F.floor(F.length(digits) / 2).cast("int")
            front, back = F.substr(digits, F.lit(1), half), F.substr(digits, half + 1)
            whole = F.when(F.length(digits) <= 18, _rounds(digits, key, "iban")).otherwise(F.concat(_rounds(front, key, "iban"), _rounds(back, key, "iban")))
            return F.when(
                F.length(digits) >= 4,
                bound(
                    bound(whole, lambda x: refill(body, x)),
                    lambda x: bound(
                        F.lpad((98 - _remainder(F.concat(x, country, F.lit("00")))).cast("string"), 2, "0"),
                        lambda check: _regroup(m, F.concat(country, check, x)),
                    ),
                ),
            ).otherwise(_tag("iban", plain, key))

        return F.when(valid, bound(F.regexp_replace(body, "[^0-9]", ""), new)).otherwise(m)

    return bound(F.replace(m, F.lit(" "), F.lit("")), of)


def _regroup(m: Column, plain: Column) -> Column:
    return F.when(F.contains(m, F.lit(" ")), F.rtrim(F.regexp_replace(plain, "(.{4})", "$1 "))).otherwise(plain)


def _ssn_valid(d: Column) -> Column:
    return ~d.rlike("^(?:000|666|9)|^...00|0000$")


def _ssn(m: Column, key: str) -> Column:
    def of(digits: Column) -> Column:
        return F.when(_ssn_valid(digits), bound(walk(digits, key, "ssn", _ssn_valid), lambda x: refill(m, x))).otherwise(m)

    return bound(F.replace(m, F.lit("-"), F.lit("")), of)


def _shifted(day: Column, key: str) -> Column:
    """The permuted date of a date between the first and the last day."""
    number = F.lpad(F.date_diff(day, F.lit(FIRST_DAY).cast("date")).cast("string"), 5, "0")
    new = walk(number, key, "date", lambda d: d.cast("int") < DAYS)
    return F.date_add(F.lit(FIRST_DAY).cast("date"), new.cast("int"))


def _iso_date(m: Column, key: str) -> Column:
    day = F.try_to_date(m, "yyyy-MM-dd")
    return F.when(day.isNotNull(), F.date_format(_shifted(day, key), "yyyy-MM-dd")).otherwise(m)


def _day_date(m: Column, key: str) -> Column:
    plain = F.regexp_replace(m, "[.-]", "/")
    first, second = F.try_to_date(plain, "d/M/yyyy"), F.try_to_date(plain, "M/d/yyyy")
    # Parts are written without a leading zero where the old date had a part of one digit.
    short = m.rlike("(?:^|[^0-9])[0-9][/.-]")
    mark = F.regexp_extract(m, "[/.-]", 0)

    def written(day: Column, two: str, one: str) -> Column:
        return F.replace(F.when(short, F.date_format(day, one)).otherwise(F.date_format(day, two)), F.lit("/"), mark)

    new = F.when(first.isNotNull(), bound(_shifted(first, key), lambda x: written(x, "dd/MM/yyyy", "d/M/yyyy"))).when(
        second.isNotNull(), bound(_shifted(second, key), lambda x: written(x, "MM/dd/yyyy", "M/d/yyyy"))
    )
    return F.coalesce(new, m)


def _ip_valid(d: Column) -> Column:
    first = F.shiftrightunsigned(d.cast("long"), 24)
    return (d.cast("long") < 2**32) & (first >= 1) & (first <= 223)


def _ip(m: Column, key: str) -> Column:
    octets = F.transform(F.split(m, r"\."), lambda x: x.cast("long"))
    valid = ~F.exists(octets, lambda x: x > 255)
    number = F.aggregate(octets, F.lit(0).cast("long"), lambda acc, x: acc * 256 + x)
    new = walk(F.lpad(number.cast("string"), 10, "0"), key, "ip", _ip_valid).cast("long")
    dotted = bound(new, lambda x: F.concat_ws(".", *[F.pmod(F.shiftrightunsigned(x, s), F.lit(256)).cast("string") for s in (24, 16, 8, 0)]))
    return F.when(valid, dotted).otherwise(m)


def _phone_valid(d: Column) -> Column:
    # Area code and exchange of ten-digit numbers begin with 2 to 9.
    return (F.length(d) != 10) | d.rlike("^[2-9]..[2-9]")


def _phone(m: Column, key: str) -> Column:
    country = F.regexp_extract(m, r"^\+[0-9]{1,3}(?=[^0-9])(?:[ .-]?\(0\))?", 0)

    def of(rest: Column) -> Column:
        def new(digits: Column) -> Column:
            changed = F.when(_phone_valid(digits), walk(digits, key, "phone", _phone_valid)).otherwise(_rounds(digits, key, "phone-other"))
            long_enough = (F.length(digits) >= 6) & (F.length(digits) <= 15)
            return F.when(long_enough, F.concat(country, bound(changed, lambda x: refill(rest, x)))).otherwise(m)

        return bound(F.regexp_replace(rest, "[^0-9]", ""), new)

    return bound(F.substr(m, F.length(country) + 1), of)


def _national_phone(m: Column, key: str) -> Column:
    """The leading zero stays; dates and short numbers in such groups are no phone numbers."""
    lead = F.regexp_extract(m, r"^\(?0", 0)

    def of(rest: Column) -> Column:
        def new(digits: Column) -> Column:
            changed = F.concat(lead, bound(_rounds(digits, key, "phone-national"), lambda x: refill(rest, x)))
            return F.when(F.length(digits).between(8, 14), changed).otherwise(m)

        return bound(F.regexp_replace(rest, "[^0-9]", ""), new)

    return bound(F.substr(m, F.length(lead) + 1), of)


def _tag(kind: str, value: Column, key: str) -> Column:
    return F.concat(F.lit(f"<{kind}:"), F.substr(F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), value), 256), F.lit(1), F.lit(16)), F.lit(">"))


def _email(m: Column, key: str) -> Column:
    return _tag("email", F.lower(m), key)


def _secret(m: Column, key: str) -> Column:
    return _tag("secret", m, key)


def _named_secret(m: Column, key: str) -> Column:
    name = F.regexp_extract(m, r"^[^=:]*[=:]\s*", 0)
    value = F.regexp_replace(F.substr(m, F.length(name) + 1), "[\"']", "")
    return F.concat(name, _tag("secret", value, key))


# In the order of the alternation: a match is of the first kind whose pattern it is.
KINDS = [
    ("email", EMAIL, _email),
    ("secret", NAMED_SECRET, _named_secret),
    ("secret", SECRET, _secret),
    ("card", CARD, _card),
    ("iban", IBAN, _iban),
    ("ssn", SSN, _ssn),
    ("date", ISO_DATE, _iso_date),
    ("date", DAY_DATE, _day_date),
    ("ip", IP, _ip),
    ("phone", PHONE, _phone),
    ("phone", NATIONAL_PHONE, _national_phone),
]


def pseudonym(m: Column, key: str = KEY) -> Column:
    """The pseudonym of one match of :data:`ANY`; the match itself if it is not valid."""
    out = None
    for _, pattern, change in KINDS:
        test = m.rlike(_only(pattern))
        out = F.when(test, change(m, key)) if out is None else out.when(test, change(m, key))
    return out.otherwise(m)


def kind_of(m: Column) -> Column:
    out = None
    for kind, pattern, _ in KINDS:
        test = m.rlike(_only(pattern))
        out = F.when(test, F.lit(kind)) if out is None else out.when(test, F.lit(kind))
    return out


def matches(text: Column) -> Column:
    """All candidates in a text; every one has a digit, an at sign, ``=`` or ``:``."""
    none = F.array().cast("array<string>")
    return F.when(text.rlike("[0-9@=:]|-----BEGIN"), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(none)


def pseudonymize(docs: DataFrame, key: str = KEY, text: str = "text") -> DataFrame:
    """``docs`` with personal data in ``text`` replaced, and a new column ``pii`` (kind, old length, new).

    The rows, their order of columns and all other columns stay; where ``docs``
    has a column ``pii``, it is replaced. NULL texts stay NULL with no finds, and
    empty texts empty. Numbers that fail their check (Luhn, calendar, octets,
    area) stay as they are.
    """
    body = docs[text]
    found = docs.withColumn("pii", matches(body))
    renamed = F.transform("pii", lambda m: F.struct(kind_of(m).alias("kind"), m.alias("old"), pseudonym(m, key).alias("new")))
    found = found.withColumn("pii", F.when(F.size("pii") > 0, renamed).otherwise(F.array().cast("array<struct<kind:string,old:string,new:string>>")))
    new = F.array_join(
        F.zip_with(F.split(F.col(text), ANY, -1), F.concat(F.col("pii")["new"], F.array(F.lit(""))), lambda gap, new: F.concat(gap, new)), ""
    )
    found = found.withColumn(text, F.when(F.size("pii") > 0, new).otherwise(F.col(text)))
    changed = F.filter("pii", lambda x: x["old"] != x["new"])
    return found.withColumn("pii", F.transform(changed, lambda x: F.struct(x["kind"].alias("kind"), x["new"].alias("new"))))


def op8_pii(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pseudonymize(docs).select(
        "doc_id",
        "text",
        F.size("pii").cast("long").alias("n_replaced"),
        F.array_join(F.array_sort(F.array_distinct("pii.kind")), ",").alias("kinds"),
    )
