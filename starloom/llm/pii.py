"""Format-preserving pseudonyms: validated numbers, dates and addresses, permuted under a key.

Every value found is mapped by a Feistel network over its own format, with SHA-256 of the key
as round function: a bijection, so different values stay different and equal ones stay equal
in all documents, however they are separated. Formats:

- payment cards of 13 to 19 digits with a right check digit (the result's is right, too),
- telephone numbers in groups of three, three and four digits, with or without country code
  (area and exchange stay valid where they were),
- social security numbers with valid areas, groups and serials,
- IPv4 addresses with octets up to 255,
- dates 1900 to 2099 written 2001-12-31, 12/31/2001 or 31.12.2001, valid in the calendar,
- the local part of mail addresses (letters to letters, digits to digits),
- hexadecimal secrets of 32 or more digits that are assigned to a token, key or password.

What looks like one of these but fails its validation is left as it is. All of it is column
expressions.

Results for odd rows: a null text stays null, an empty one empty, with no pseudonyms. Very long
texts are treated whole. Repeated rows give repeated results; null doc_ids are kept. Other
columns pass through ``pseudonymised``; those named like a result are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import table

ROUNDS = 10
#: Columns that exist between two steps only.
_FOUND, _NEW = "__pii_found", "__pii_new"
#: For tests and checks only; production runs pass their own secret.
SAMPLE_KEY = "sample key, not a secret"

#: The first part looks ahead for the at sign, so that a word without one costs one scan. Groups repeat a bounded number
#: of times and give nothing back: the pattern engine takes a stack frame for every repetition it could undo.
EMAIL = r"(?<![A-Za-z0-9._%+-])(?=[A-Za-z0-9._%+-]{1,64}+@)[A-Za-z0-9](?:[A-Za-z0-9._%+-]{0,62}[A-Za-z0-9])?@[A-Za-z0-9-]{1,63}+(?:\.[A-Za-z0-9-]{1,63}+){1,126}+"
SECRET = r"(?i:\b(?:token|secret|api[_-]?key|password)\b\s{0,3}[=:]\s{0,3}[\"']?)[0-9A-Fa-f]{32,}+(?![0-9A-Za-z])"
ISO_DATE = r"(?<![\w.-])\d{4}-\d{2}-\d{2}(?![\w-])"
OTHER_DATE = r"(?<![\w./-])(?:\d{2}/\d{2}/\d{4}(?![\w/])|\d{2}\.\d{2}\.\d{4}(?!\w|\.\d))"
SSN = r"(?<![\w.-])\d{3}-\d{2}-\d{4}(?![\w-])"
PHONE = r"(?<![\w.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w-])"
IPV4 = r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d)"
CARD = r"(?<![\w.])(?:\d{13,19}(?!\w|\.\d)|\d{4}(?:[ -]\d{4}){3}(?:[ -]\d{1,3})?(?!\w)|\d{4}[ -]\d{6}[ -]\d{5}(?!\w))"
ANY = "|".join([EMAIL, SECRET, ISO_DATE, OTHER_DATE, SSN, PHONE, IPV4, CARD])

FIRST_DAY, DAY_SIDES = "1900-01-01", (17, 4297)  # 73,049 days
LAST_DAY = "2099-12-31"


def _prf(key: str, kind: str, step: Column, other: Column) -> Column:
    """60 pseudo-random bits of a round."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), step.cast("string"), other.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def permuted_number(value: Column, left: Column, right: Column, key: str, kind: str) -> Column:
    """A permutation of 0 .. left * right - 1: the two digits in mixed base change in turn."""
    left, right = left.cast("bigint"), right.cast("bigint")
    start = F.struct(F.floor(value / right).cast("bigint").alias("l"), F.pmod(value, right).alias("r"))

    def turn(acc: Column, i: Column) -> Column:
        on_left = F.struct(F.pmod(acc["l"] + _prf(key, kind, i, acc["r"]), left).alias("l"), acc["r"].alias("r"))
        on_right = F.struct(acc["l"].alias("l"), F.pmod(acc["r"] + _prf(key, kind, i, acc["l"]), right).alias("r"))
        return F.when(i % 2 == 1, on_left).otherwise(on_right)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn, lambda acc: acc["l"] * right + acc["r"])


def permuted_text(text: Column, key: str, kind: str, hexadecimal: bool = False, letters: int = 26) -> Column:
    """A permutation of texts of one shape: each character moves within its class, letters among the first ``letters``."""
    half = F.floor(F.length(text) / 2).cast("int")
    start = F.struct(F.left(text, half).alias("l"), F.right(text, F.length(text) - half).alias("r"))

    def moved(side: Column, other: Column, i: Column) -> Column:
        said = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), i.cast("string"), F.length(side).cast("string"), other), 256)

        def all_moved(digest: Column) -> Column:
            def one(c: Column, j: Column) -> Column:
                by = F.conv(F.substring(digest, (j % 32) * 2 + 1, F.lit(2)), 16, 10).cast("int")
                if hexadecimal:
                    digits = F.lit("0123456789abcdef")
                    return F.substring(digits, (F.instr(digits, c) - 1 + by) % 16 + 1, F.lit(1))

                def within(first: str, size: int) -> Column:
                    return F.char(F.lit(ord(first)) + (F.ascii(c) - ord(first) + by) % size)

                return (
                    F.when(c.between("a", "z"), within("a", letters))
                    .when(c.between("A", "Z"), within("A", letters))
                    .when(c.between("0", "9"), within("0", 10))
                    .otherwise(c)
                )

            return F.array_join(F.transform(F.split(side, ""), one), "")

        # the digest is bound as an element, so that it is taken once and not for every character
        return F.transform(F.array(said), all_moved)[0]

    def turn(acc: Column, i: Column) -> Column:
        on_left = F.struct(moved(acc["l"], acc["r"], i).alias("l"), acc["r"].alias("r"))
        on_right = F.struct(acc["l"].alias("l"), moved(acc["r"], acc["l"], i).alias("r"))
        return F.when(i % 2 == 1, on_left).otherwise(on_right)

    steps = F.sequence(F.lit(1), F.lit(ROUNDS))
    return F.aggregate(steps, start, turn, lambda acc: F.concat(acc["l"], acc["r"]))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"[^0-9]", "")


def _power(n: Column) -> Column:
    """10 to a small whole power, exact."""
    return F.rpad(F.lit("1"), n + 1, F.lit("0")).cast("bigint")


def luhn_sum(digits: Column, doubled_last: bool) -> Column:
    """Sum of digits from the right, every second doubled, beginning with the last or the one before it."""
    n = F.length(digits)

    def add(acc: Column, i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        d = F.when(i % 2 == (0 if doubled_last else 1), d * 2).otherwise(d)
        return acc + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add)


def _refilled(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced, in order."""

    def one(c: Column, i: Column) -> Column:
        number = F.length(_digits(F.left(shape, i + 1)))
        return F.when(c.rlike("[0-9]"), F.substring(digits, number, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.split(shape, ""), one), "")


def _card(m: Column, key: str) -> Column:
    digits = _digits(m)
    n = F.length(digits) - 1
    half = F.floor(n / 2).cast("int")
    payload = permuted_number(F.left(digits, n).cast("bigint"), _power(half), _power(n - half), key, "card")
    body = F.lpad(payload.cast("string"), n, F.lit("0"))
    check = (10 - luhn_sum(body, True) % 10) % 10
    return F.when(luhn_sum(digits, False) % 10 == 0, _refilled(m, F.concat(body, check.cast("string")))).otherwise(m)


def _phone(m: Column, key: str) -> Column:
    local = F.right(_digits(m), F.lit(10))
    code = F.length(_digits(m)) - 10
    area, office, line = (F.substring(local, a, n).cast("bigint") for a, n in ((1, 3), (4, 3), (7, 4)))
    valid = (area >= 200) & (office >= 200)
    whole = ((area - 200) * 800 + (office - 200)) * 10000 + line
    new = permuted_number(whole, F.lit(640000), F.lit(10000), key, "phone")
    front = F.floor(new / 10000).cast("bigint")
    shown = F.concat(
        (F.floor(front / 800) + 200).cast("string"),
        (front % 800 + 200).cast("string"),
        F.lpad((new % 10000).cast("string"), 4, "0"),
    )
    plain = permuted_number(local.cast("bigint"), F.lit(100000), F.lit(100000), key, "digits")
    out = F.when(valid, shown).otherwise(F.lpad(plain.cast("string"), 10, "0"))
    return _refilled(m, F.concat(F.left(_digits(m), code), out))


def _ssn(m: Column, key: str) -> Column:
    area, group, serial = (F.substring(m, a, n).cast("bigint") for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    place = F.when(area > 666, area - 2).otherwise(area - 1)  # 0 .. 897
    new = permuted_number((place * 99 + group - 1) * 9999 + serial - 1, F.lit(898 * 99), F.lit(9999), key, "ssn")
    front = F.floor(new / 9999).cast("bigint")
    at = F.floor(front / 99).cast("bigint")
    shown = F.concat_ws(
        "-",
        F.lpad(F.when(at >= 665, at + 2).otherwise(at + 1).cast("string"), 3, "0"),
        F.lpad((front % 99 + 1).cast("string"), 2, "0"),
        F.lpad((new % 9999 + 1).cast("string"), 4, "0"),
    )
    return F.when(valid, shown).otherwise(m)


def _ipv4(m: Column, key: str) -> Column:
    octets = F.transform(F.split(m, r"\."), lambda x: x.cast("bigint"))
    whole = F.aggregate(octets, F.lit(0).cast("bigint"), lambda acc, x: acc * 256 + x)
    new = permuted_number(whole, F.lit(65536), F.lit(65536), key, "ipv4")
    shown = F.concat_ws(".", *[F.floor(F.shiftright(new, 8 * k) % 256).cast("string") for k in (3, 2, 1, 0)])
    return F.when(F.forall(octets, lambda x: x <= 255), shown).otherwise(m)


def _date(m: Column, shape: str, key: str) -> Column:
    day = F.try_to_date(m, shape)
    number = F.datediff(day, F.lit(FIRST_DAY).cast("date")).cast("bigint")
    first, second = DAY_SIDES
    new = permuted_number(number, F.lit(first), F.lit(second), key, "date")
    shown = F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), new.cast("int")), shape)
    return F.when(day.between(F.lit(FIRST_DAY).cast("date"), F.lit(LAST_DAY).cast("date")), shown).otherwise(m)


def pseudonym(m: Column, key: str) -> Column:
    """The pseudonym of one match of ``ANY``, or the match itself if its validation fails."""
    local, secret = F.substring_index(m, "@", 1), F.regexp_extract(m, r"[0-9A-Fa-f]{32,}$", 0)
    # with upper-case letters every digit stays in its class, so that no result meets one of a lower-case secret
    cased = permuted_text(secret, key, "secret", letters=6)
    hidden = F.when(secret.rlike("[A-F]"), cased).otherwise(permuted_text(secret, key, "secret", True))
    return (
        F.when(m.contains("@"), F.concat(permuted_text(local, key, "mail"), F.lit("@"), F.substring_index(m, "@", -1)))
        .when(secret != "", F.concat(F.left(m, F.length(m) - F.length(secret)), hidden))
        .when(m.rlike(r"^\d{4}-\d{2}-\d{2}$"), _date(m, "yyyy-MM-dd", key))
        .when(m.rlike(r"^\d{2}/\d{2}/\d{4}$"), _date(m, "MM/dd/yyyy", key))
        .when(m.rlike(r"^\d{2}\.\d{2}\.\d{4}$"), _date(m, "dd.MM.yyyy", key))
        .when(m.rlike(r"^\d{3}-\d{2}-\d{4}$"), _ssn(m, key))
        .when(m.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), _ipv4(m, key))
        .when(m.rlike(r"^(\+\d{1,3}[ .-]?)?(\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}$"), _phone(m, key))
        .otherwise(_card(m, key))
    )


def pseudonymised(docs: DataFrame, key: str = SAMPLE_KEY) -> DataFrame:
    """``docs`` with pseudonyms in ``text``, and ``n_pseudonyms``, how many values were replaced."""
    text = F.col("text")
    # no value is without a digit or an at sign: most texts end here
    some = text.rlike("[0-9@]") & text.rlike(ANY)
    found = docs.withColumn(_FOUND, F.when(some, F.regexp_extract_all(text, F.lit(ANY), F.lit(0))))
    found = found.withColumn(_NEW, F.transform(_FOUND, lambda m: pseudonym(m, key)))
    pieces = F.zip_with(
        F.split(text, ANY, -1), F.concat(_NEW, F.array(F.lit(""))), lambda piece, new: F.concat(piece, new)
    )
    changed = F.filter(F.zip_with(_FOUND, _NEW, lambda a, b: a != b), lambda x: x)
    return found.withColumns(
        {
            "n_pseudonyms": F.when(F.col(_FOUND).isNull(), 0).otherwise(F.size(changed)),
            "text": F.when(F.col(_FOUND).isNull(), text).otherwise(F.array_join(pieces, "")),
        }
    ).drop(_FOUND, _NEW)


def hide_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with pseudonyms in their texts, and their lengths brought up to date."""
    hidden = pseudonymised(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return hidden.select(*docs.columns)


def op5_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pseudonymised(docs.select("doc_id", "text")).select("doc_id", "n_pseudonyms", "text")
