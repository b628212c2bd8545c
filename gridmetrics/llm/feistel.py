"""Format-preserving pseudonyms for personal numbers, dates and addresses, by keyed Feistel networks.

Everything is DataFrame expressions. A text is cut at the candidates a pattern finds; each candidate is
validated by its kind, and a valid one is permuted inside its own format with the key, so that
equal values get equal pseudonyms in all documents and nothing but the key links them back:

* card numbers (13 to 19 digits, also in groups): Luhn-valid ones; the check digit is made anew;
* IBANs that pass modulo 97: digits of the account part; the check digits are made anew;
* social security numbers of valid ranges, IPv4 addresses, dates from 1900-01-01 to 2100-02-20
  (ISO, day/month/year, day.month.year): permuted by their rank within the valid values;
* telephone numbers with a country code, or with an area code in brackets: the digits after the country code;
* e-mail names (the part before @) and hexadecimal secrets of 32 digits and more, character by
  character within classes (digit, lower, upper, accented).

Candidates that are not valid are left as they are. Defined results: null stays null, empty stays empty;
only IPv4 addresses may change a text's length; repeated rows give repeated rows; other columns are untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

ROUNDS = 8
#: What the candidates look like, first match wins.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)+",
    "secret": r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+)(?![0-9A-Za-z])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}+(?![0-9A-Za-z])",
    "ipv4": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])",
    "date": r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}"
    r"|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9]|[./-][0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
    "phone": r"(?<![0-9+])\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"
    r"|(?<![0-9+])\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![0-9])",
    "card": r"(?<![0-9])(?:[0-9]{4}[ -]){3}[0-9]{1,7}(?![0-9])|(?<![0-9])[0-9]{13,19}(?![0-9])",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
_ACCENTED = "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
_CAPITALS = "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞŸ"
_NAMES = (_DIGITS, _LOWER, _LOWER.upper(), _ACCENTED, _CAPITALS)
_FIRST_DAY = "1900-01-01"
#: Days are ranked in _DATES[0] * _DATES[1] days, social security numbers in their valid ranges.
_DATES, _SSN, _IPV4 = (340, 215), (898 * 99, 9999), (65536, 65536)


def _keyed(key: str, kind: str, turn: Column, other: Column) -> Column:
    """64 hexadecimal digits that depend on the key, the round and the other half."""
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), turn.cast("string"), other), 256)


def _number(digits: Column, first: Column | int, size: int) -> Column:
    at = first if isinstance(first, Column) else F.lit(first)
    return F.conv(F.substr(digits, at, F.lit(size)), 16, 10).cast("bigint")


def _rounds(start: Column, step) -> Column:
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)


def ranked(value: Column, radixes: tuple[int, int], key: str, kind: str) -> Column:
    """A keyed permutation of 0 .. radixes[0] * radixes[1] - 1: both parts are shifted in turn."""
    first, second = (F.lit(r).cast("bigint") for r in radixes)

    def step(acc: Column, turn: Column) -> Column:
        u, v = acc["u"], acc["v"]
        by = lambda other: _number(_keyed(key, kind, turn, other.cast("string")), 1, 12)
        odd = turn % 2 == 1
        return F.struct(
            F.when(odd, (u + by(v)) % first).otherwise(u).alias("u"),
            F.when(odd, v).otherwise((v + by(u)) % second).alias("v"),
        )

    start = F.struct((F.floor(value / second)).alias("u"), (value % second).alias("v"))
    end = _rounds(start, step)
    return end["u"] * second + end["v"]


def _shifted(half: Column, other: Column, turn: Column, classes, key: str, kind: str) -> Column:
    """Every character moved within its class by a keyed amount that the other half decides."""
    digits = _keyed(key, kind, turn, other)

    def moved(c: Column, at: Column) -> Column:
        by = _number(digits, (at % 16) * 4 + 1, 4)
        out = c
        for letters in classes:
            place = F.instr(F.lit(letters), c)
            new = F.substr(F.lit(letters), ((place - 1 + by) % len(letters) + 1).cast("int"), F.lit(1))
            out = F.when((c != "") & (place > 0), new).otherwise(out)
        return out

    return F.array_join(F.transform(F.split(half, ""), moved), "")


def classed(text: Column, classes: tuple[str, ...], key: str, kind: str) -> Column:
    """A keyed permutation of strings that keeps each character's class."""
    half = F.floor(F.length(text) / 2).cast("int")
    start = F.struct(
        F.substr(text, F.lit(1), half).alias("u"),
        F.substr(text, half + 1, F.length(text)).alias("v"),
    )

    def step(acc: Column, turn: Column) -> Column:
        u, v = acc["u"], acc["v"]
        return F.struct(
            v.alias("u"), _shifted(u, v, turn, classes, key, kind).alias("v")
        )

    end = _rounds(start, step)
    return F.concat(end["u"], end["v"])


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _put_back(text: Column, digits: Column) -> Column:
    """``text`` with its digits replaced, in order, by ``digits``."""

    def at(c: Column, i: Column) -> Column:
        before = F.length(_digits(F.substr(text, F.lit(1), i + 1)))
        return F.when(c.rlike("^[0-9]$"), F.substr(digits, before, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.split(text, ""), at), "")


def luhn_digit(body: Column) -> Column:
    """The check digit that makes ``body`` followed by it Luhn-valid."""

    def worth(c: Column, i: Column) -> Column:
        d = F.when(c == "", 0).otherwise(c.cast("int"))
        twice = d * 2
        return F.when(i % 2 == 0, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)

    values = F.transform(F.split(F.reverse(body), ""), worth)
    total = F.aggregate(values, F.lit(0), lambda a, x: a + x)
    return ((10 - total % 10) % 10).cast("string")


def _card(text: Column, key: str) -> Column:
    digits = _digits(text)
    n = F.length(digits)
    body = F.substr(digits, F.lit(1), n - 1)
    valid = (n >= 13) & (n <= 19) & (F.substr(digits, n, F.lit(1)) == luhn_digit(body))
    new = classed(body, (_DIGITS,), key, "card")
    return F.when(valid, _put_back(text, F.concat(new, luhn_digit(new)))).otherwise(text)


def _mod97(text: Column) -> Column:
    def step(rest: Column, c: Column) -> Column:
        worth = F.instr(F.lit(_DIGITS + _LOWER.upper()), c) - 1
        return F.when(c == "", rest).otherwise(
            F.when(worth > 9, (rest * 100 + worth) % 97).otherwise((rest * 10 + worth) % 97)
        )

    return F.aggregate(F.split(text, ""), F.lit(0), step)


def _iban(text: Column, key: str) -> Column:
    body, land = F.substr(text, F.lit(5), F.length(text)), F.substr(text, F.lit(1), F.lit(2))
    valid = _mod97(F.concat(body, land, F.substr(text, F.lit(3), F.lit(2)))) == 1
    new = _put_back(body, classed(_digits(body), (_DIGITS,), key, "iban"))
    check = 98 - _mod97(F.concat(new, land, F.lit("00")))
    return F.when(
        valid, F.concat(land, F.lpad(check.cast("string"), 2, "0"), new)
    ).otherwise(text)


def _padded(value: Column, width: int) -> Column:
    return F.lpad(value.cast("bigint").cast("string"), width, "0")


def _part(text: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract(text, pattern, group).cast("bigint")


def _ssn(text: Column, key: str) -> Column:
    area, group, serial = (_part(text, r"^(\d+)-(\d+)-(\d+)$", i) for i in (1, 2, 3))
    valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    rank = (F.when(area < 666, area - 1).otherwise(area - 2) * 99 + group - 1) * 9999 + serial - 1
    new = ranked(rank, _SSN, key, "ssn")
    upper = F.floor(new / 9999)
    place = F.floor(upper / 99)
    number = F.when(place < 665, place + 1).otherwise(place + 2)
    return F.when(
        valid,
        F.concat_ws("-", _padded(number, 3), _padded(upper % 99 + 1, 2), _padded(new % 9999 + 1, 4)),
    ).otherwise(text)


def _ipv4(text: Column, key: str) -> Column:
    parts = F.transform(F.split(text, r"\."), lambda x: x.cast("bigint"))
    valid = F.forall(parts, lambda x: x < 256)
    rank = F.aggregate(parts, F.lit(0).cast("bigint"), lambda a, x: a * 256 + x)
    new = ranked(rank, _IPV4, key, "ipv4")
    octets = [F.floor(new / 256**i) % 256 for i in (3, 2, 1, 0)]
    plain = F.concat_ws(".", *[o.cast("bigint").cast("string") for o in octets])
    return F.when(valid, plain).otherwise(text)


def _date(text: Column, key: str) -> Column:
    out = text
    for pattern, form in (
        (r"^\d{4}-", "yyyy-MM-dd"),
        (r"^\d{2}/", "dd/MM/yyyy"),
        (r"^\d{2}\.", "dd.MM.yyyy"),
    ):
        day = F.try_to_timestamp(F.when(text.rlike(pattern), text), F.lit(form)).cast("date")
        rank = F.datediff(day, F.lit(_FIRST_DAY).cast("date")).cast("bigint")
        valid = day.isNotNull() & (rank >= 0) & (rank < _DATES[0] * _DATES[1])
        new = ranked(rank, _DATES, key, "date").cast("int")
        moved = F.date_format(F.date_add(F.lit(_FIRST_DAY).cast("date"), new), form)
        out = F.when(valid, moved).otherwise(out)
    return out


def _phone(text: Column, key: str) -> Column:
    land = F.regexp_extract(text, r"^(\+[0-9]{1,3}(?=[ .(-])|\+1(?=[0-9]{10}$))?", 0)
    rest = F.substr(text, F.length(land) + 1, F.length(text))
    return F.concat(land, _put_back(rest, classed(_digits(rest), (_DIGITS,), key, "phone")))


def _email(text: Column, key: str) -> Column:
    name, host = F.regexp_extract(text, "^([^@]*)(@.*)$", 1), F.regexp_extract(text, "^([^@]*)(@.*)$", 2)
    return F.concat(classed(name, _NAMES, key, "email"), host)


def _secret(text: Column, key: str) -> Column:
    low = classed(text, (_DIGITS + "abcdef",), key, "secret")
    high = classed(text, (_DIGITS + "ABCDEF",), key, "secret")
    return F.when(text.rlike("[A-F]"), high).otherwise(low)


_PERMUTED = {
    "email": _email, "secret": _secret, "iban": _iban, "ipv4": _ipv4,
    "date": _date, "ssn": _ssn, "phone": _phone, "card": _card,
}


def pseudonym(candidate: Column, key: str) -> Column:
    """The pseudonym of a candidate, or the candidate itself if it is not valid."""
    out = candidate
    for kind in reversed(PATTERNS):
        out = F.when(candidate.rlike(f"^(?:{PATTERNS[kind]})$"), _PERMUTED[kind](candidate, key)).otherwise(out)
    return out


def candidates(text: Column) -> tuple[Column, Column]:
    """The candidates of a text in order, and the pieces of text between them."""
    # A cheap test first: many texts hold no digit and no @.
    may = text.rlike("[0-9@]")
    found = F.when(may, F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(
        F.expr("array()").cast("array<string>")
    )
    return found, F.when(may, F.split(text, ANY, -1)).otherwise(F.array(text))


def pseudonymise(documents: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``documents`` with ``text`` pseudonymised; all other columns as they are."""
    return _replaced(documents, key, text).select(
        *[F.col(f"row.`{c}`").alias(c) if c != text else F.col("_new").alias(c) for c in documents.columns]
    )


def _replaced(documents: DataFrame, key: str, text: str) -> DataFrame:
    found, pieces = candidates(F.col("row")[text])
    rows = documents.select(F.struct("*").alias("row")).select(
        "row", found.alias("_found"), pieces.alias("_pieces")
    )
    rows = rows.withColumn("_names", F.transform("_found", lambda m: pseudonym(m, key)))
    joined = F.array_join(
        F.zip_with("_pieces", "_names", lambda p, m: F.concat(p, F.coalesce(m, F.lit("")))), ""
    )
    return rows.withColumn("_new", F.when(F.size("_found") > 0, joined).otherwise(F.col("row")[text])).withColumn(
        "_changed",
        F.size(F.filter(F.zip_with("_found", "_names", lambda a, b: a != b), lambda x: x)),
    )


#: The key of the registered query and of the pipeline; a production job passes its own secret.
DEMO_KEY = "demonstration key"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: every text with its personal values replaced by pseudonyms."""
    documents = table(spark, sf_dir, "documents")
    return _replaced(documents, DEMO_KEY, "text").select(
        F.col("row.doc_id").alias("doc_id"),
        F.col("_new").alias("text"),
        F.size("_found").alias("n_candidates"),
        F.col("_changed").alias("n_replaced"),
    )
