"""PII: format-preserving Feistel pseudonyms, in SQL expressions only.

Validated numbers and dates are permuted by a keyed Feistel network inside their
own format: separators, lengths and check digits stay right, so equal values get
equal pseudonyms in every document, without a table of values and without a
shuffle.  Round functions are SHA-256 of key, kind, round and half.

* card numbers (13 to 19 digits, valid Luhn digit): all but the check digit are
  permuted, then a new check digit is set;
* IBANs (valid mod 97): digits behind the check digits are permuted, letters
  stay, the check digits are set anew; the length follows the country, so a token
  behind the number is left alone;
* phone numbers: digits behind the country code are permuted; the code is known by a table, and a trunk zero in brackets
  stays, so one number has one pseudonym however it is grouped;
* social security numbers (valid ranges): the nine digits are permuted, walking
  the cycle until the ranges are valid again;
* IPv4 addresses: the 32 bits are permuted;
* dates (ISO, day/month/year and day.month.year that exist, 1900 to 2099): the
  day number is permuted within those 73,049 days and written in the same format;
* e-mail addresses are no numbers: local part and domain become keyed names, so
  addresses of one domain still share it.

Digit runs that fail validation are left alone.

Defined results: null text stays null; a text without PII comes back unchanged;
repeated rows are masked each; an empty table gives an empty result; other
columns are carried.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.llm.common import read_table

QUERY_NAME = "op4_pii_feistel"

#: The key comes from the caller; this one only makes the registered query reproducible.
QUERY_KEY = "adlake-query-key"
ROUNDS = 10
FIRST_DAY, DAYS, SIDE = "1900-01-01", 73049, 271  # SIDE squared covers DAYS

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9](?:[A-Za-z0-9-]*\.)+[A-Za-z]{2,24}(?![A-Za-z0-9])"
#: Lengths of IBANs by country.
IBAN_LENGTHS = {
    int(n): countries
    for n, *countries in map(
        str.split,
        """15 NO;16 BE;18 DK FI FK FO GL NL SD;19 MK SI;20 AT BA EE KZ LT LU MN XK;21 CH HR LI LV;22 BG BH CR DE GB GE IE ME RS VA;
        23 AE GI IL IQ OM SO TL;24 AD CZ ES MD PK RO SA SE SK TN VG;25 LY PT ST;26 IS TR;27 BI DJ FR GR IT MC MR SM;
        28 AL AZ BY CY DO GT HN HU LB NI PL SV;29 BR EG PS QA UA;30 JO KW MU YE;31 MT SC;32 LC;33 RU""".split(";"),
    )
}
_BY_LENGTH = "|".join(rf"(?:{'|'.join(c)})[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{{n // 4 - 1}}}" + (rf"\x20?[A-Z0-9]{{{n % 4}}}" if n % 4 else "") for n, c in IBAN_LENGTHS.items())
# other countries and lengths: trailing groups are dropped until the number is valid
IBAN = rf"(?<![A-Za-z0-9])(?:{_BY_LENGTH}|[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{2,7}}(?:\x20?[A-Z0-9]{{1,3}})?)(?![A-Za-z0-9])"
IPV4 = rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])"
DATE = r"(?<![0-9/.-])(?:(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/(?:19|20)[0-9]{2}|[0-9]{2}\.[0-9]{2}\.(?:19|20)[0-9]{2})(?![0-9/-]|\.[0-9])"
SSN = r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])"
CARD = r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}\x20[0-9]{4}\x20[0-9]{4}\x20[0-9]{1,7}|[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{1,7}|[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{5})(?![0-9])"
_US = r"(?<![0-9.-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![0-9.-])"
# a phone number never takes a following token of these; before its fifth digit four dotted pairs are digits of the number
_NEXT = rf"(?!(?!(?:[0-9]{{2}}\.){{3}}[0-9]{{2}}(?![0-9])){IPV4}|{DATE}|{CARD})"
_NEXT_LATER = rf"(?!{IPV4}|{DATE}|{CARD}|{SSN}|{_US}|[0-9]+\.[0-9]{{1,2}}(?![0-9]|\.[0-9]))"


def _international(country: int) -> str:
    """Numbers with *country* digits of country code and 15 at most, in groups of any length; only the first group and those behind a hyphen may be one digit."""
    first = rf"(?:\x20{_NEXT}|[.-])?(?=[0-9]{{2}}|[0-9](?:[\x20.-]?[0-9]){{6}})[0-9]"
    to_fourth = rf"(?:(?:\x20{_NEXT}|[.-])(?=[0-9]{{2}})|)[0-9]"
    further = rf"(?:\x20(?=[0-9]{{2}}){_NEXT_LATER}|\.(?=[0-9]{{2}})|-|)[0-9]"
    return rf"[0-9]{{{country}}}(?:[\x20.-]?\([0-9]{{1,4}}\))?{first}(?:{to_fourth}){{3}}(?:{further}){{0,{11 - country}}}(?![0-9])"


PHONE = "|".join(
    (
        r"(?<![0-9+])\+1[\x20.-]?(?:\([0-9]{3}\)|[0-9]{3})[\x20.-]?[0-9]{3}[\x20.-]?[0-9]{4}(?![0-9])",
        # other country codes
        rf"(?<![0-9+])\+(?!1[^0-9])(?:{'|'.join(map(_international, (3, 2, 1)))})",
        r"(?<![0-9(])\([0-9]{3}\)\x20?[0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
        _US,
    )
)

#: Country calling codes of one and two digits; all others have three.
COUNTRY_CODE = r"^(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"

KINDS = {"email": EMAIL, "iban": IBAN, "ipv4": IPV4, "date": DATE, "ssn": SSN, "card": CARD, "phone": PHONE}
ANY = "|".join(f"(?:{p})" for p in KINDS.values())


def _round(key: Column, kind: Column | str, i: Column, half: Column) -> Column:
    """60 bits of the round function."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    digest = F.sha2(F.concat_ws("|", key, kind, i.cast("string"), half.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _feistel(left: Column, right: Column, left_size: Column, right_size: Column, key: Column, kind: Column | str) -> Column:
    """struct(a, b): the permuted halves, modulo their sizes; ROUNDS is even, so the sizes end in place."""
    start = F.struct(left.cast("long").alias("a"), right.cast("long").alias("b"))
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)),
        start,
        lambda acc, i: F.struct(
            acc["b"].alias("a"),
            ((acc["a"] + _round(key, kind, i, acc["b"])) % F.when(i % 2 == 1, left_size).otherwise(right_size)).alias("b"),
        ),
    )


def _ten(n: Column) -> Column:
    return F.pow(F.lit(10.0), n).cast("long")


def permute_digits(digits: Column, key: Column, kind: str) -> Column:
    """A keyed permutation of the digit strings of each length from 2 to 34; shorter ones stay."""
    n = F.length(digits)
    u = F.floor(n / 2).cast("int")
    halves = _feistel(
        F.substr(digits, F.lit(1), u).try_cast("long"), F.substr(digits, u + 1).try_cast("long"), _ten(u), _ten(n - u), key, F.concat(F.lit(kind), n.cast("string"))
    )
    joined = F.transform(F.array(halves), lambda h: F.concat(F.lpad(h["a"].cast("string"), u, "0"), F.lpad(h["b"].cast("string"), n - u, "0")))
    return F.when(n < 2, digits).otherwise(F.element_at(joined, 1))


def only_digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def written_like(value: Column, digits: Column) -> Column:
    """*value* with its digits replaced, from the left, by those of *digits*."""
    return F.aggregate(
        F.sequence(F.lit(1), F.length(value)),
        F.struct(F.lit("").alias("out"), F.lit(1).alias("k")),
        lambda acc, i: F.when(
            F.substr(value, i, F.lit(1)).rlike("[0-9]"),
            F.struct(F.concat(acc["out"], F.substr(digits, acc["k"], F.lit(1))).alias("out"), (acc["k"] + 1).alias("k")),
        ).otherwise(F.struct(F.concat(acc["out"], F.substr(value, i, F.lit(1))).alias("out"), acc["k"].alias("k"))),
        lambda acc: acc["out"],
    )


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of a digit string with its check digit; 0 modulo 10 if valid."""
    n = F.length(digits)

    def add(acc: Column, i: Column) -> Column:
        d = F.substr(digits, i, F.lit(1)).cast("int")
        doubled = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return acc + F.when((n - i) % 2 == 1, doubled).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)


def mod97(text: Column) -> Column:
    """The IBAN remainder of a string of digits and capital letters (A = 10 ... Z = 35)."""

    def add(acc: Column, i: Column) -> Column:
        c = F.ascii(F.substr(text, i, F.lit(1)))
        return F.when(c >= 65, (acc * 100 + c - 55) % 97).otherwise((acc * 10 + c - 48) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(text)), F.lit(0), add)


def _woven(text: Column, pattern: str, new: Callable[[Column], Column]) -> Column:
    """*text* with each match of the pattern replaced by *new* of it."""
    masked = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), new)
    # pieces between the matches and the pseudonyms in turn; one piece more than matches
    return F.array_join(F.flatten(F.transform(F.arrays_zip(F.split(text, pattern, -1).alias("gap"), masked.alias("new")), lambda x: F.array(x["gap"], F.coalesce(x["new"], F.lit(""))))), "")


def _card(m: Column, key: Column) -> Column:
    digits = only_digits(m)
    body = permute_digits(F.substr(digits, F.lit(1), F.length(digits) - 1), key, "card")
    check = (10 - luhn_sum(F.concat(body, F.lit("0"))) % 10) % 10
    return F.when(luhn_sum(digits) % 10 == 0, written_like(m, F.concat(body, check.cast("string")))).otherwise(m)


def _iban(m: Column, key: Column) -> Column:
    """The longest valid IBAN of whole groups from the left is masked; what lies behind it stays, but for card numbers."""
    words = F.split(m, " ")
    packed = lambda x: F.regexp_replace(x, " ", "")
    heads = F.transform(F.sequence(F.size(words), F.lit(1), F.lit(-1)), lambda k: F.array_join(F.slice(words, 1, k), " "))
    valid = F.filter(heads, lambda h: h.rlike(f"^(?:{IBAN})$") & (mod97(F.concat(F.substr(packed(h), F.lit(5)), F.substr(packed(h), F.lit(1), F.lit(4)))) == 1))

    def mask(head: Column) -> Column:
        bban = F.substr(packed(head), F.lit(5))
        new = written_like(bban, permute_digits(only_digits(bban), key, "iban"))
        country = F.substr(head, F.lit(1), F.lit(2))
        check = F.lpad((98 - mod97(F.concat(new, country, F.lit("00")))).cast("string"), 2, "0")
        return written_like(head, F.concat(check, only_digits(new)))

    kept = F.coalesce(F.get(valid, F.lit(0)), F.get(words, F.lit(0)))
    return F.concat(
        F.element_at(F.transform(F.array(kept), lambda h: F.when(F.size(valid) > 0, mask(h)).otherwise(h)), 1),
        F.element_at(F.transform(F.array(F.substr(m, F.length(kept) + 1)), lambda rest: F.when(rest.rlike(CARD), _woven(rest, CARD, lambda c: _card(c, key))).otherwise(rest)), 1),
    )


def _phone(m: Column, key: Column) -> Column:
    bare = F.regexp_replace(m, r"\(0\)", "()")  # the trunk zero is no digit of the number
    digits = only_digits(bare)
    code = F.when(m.startswith("+"), F.regexp_extract(digits, COUNTRY_CODE, 0)).otherwise(F.lit(""))
    new = F.concat(code, permute_digits(F.substr(digits, F.length(code) + 1), key, "phone"))
    return F.replace(written_like(bare, new), F.lit("()"), F.lit("(0)"))


def _ssn(m: Column, key: Column) -> Column:
    valid = r"^(?!000|666|9)[0-9]{3}(?!00)[0-9]{2}(?!0000)[0-9]{4}$"
    # cycle walking: each step leaves the valid range with probability 0.12, so 40 steps end it but for 1e-37
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(40)),
        permute_digits(only_digits(m), key, "ssn"),
        lambda d, i: F.when(d.rlike(valid), d).otherwise(permute_digits(d, key, "ssn")),
    )
    return written_like(m, walked)


def _ipv4(m: Column, key: Column) -> Column:
    part = F.transform(F.split(m, r"\."), lambda x: x.cast("long"))
    at = lambda k: F.element_at(part, k)
    halves = _feistel(at(1) * 256 + at(2), at(3) * 256 + at(4), F.lit(65536), F.lit(65536), key, "ipv4")
    four = F.transform(F.array(halves), lambda h: F.concat_ws(".", F.floor(h["a"] / 256).cast("string"), (h["a"] % 256).cast("string"), F.floor(h["b"] / 256).cast("string"), (h["b"] % 256).cast("string")))
    return F.element_at(four, 1)


def _date(m: Column, key: Column) -> Column:
    iso, slash = m.rlike("^[0-9]{4}-"), m.contains("/")
    day = F.when(iso, F.try_to_date(m, "yyyy-MM-dd")).when(slash, F.coalesce(F.try_to_date(m, "dd/MM/yyyy"), F.try_to_date(m, "MM/dd/yyyy"))).otherwise(F.try_to_date(m, "dd.MM.yyyy"))
    american = slash & F.try_to_date(m, "dd/MM/yyyy").isNull()
    first = F.to_date(F.lit(FIRST_DAY))
    number = F.datediff(day, first).cast("long")

    def step(x: Column) -> Column:
        halves = _feistel(F.floor(x / SIDE), x % SIDE, F.lit(SIDE), F.lit(SIDE), key, "date")
        return F.element_at(F.transform(F.array(halves), lambda h: h["a"] * SIDE + h["b"]), 1)

    # cycle walking: a step leaves the range with probability 0.006
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(20)), step(number), lambda x, i: F.when(x < DAYS, x).otherwise(step(x)))
    new = F.date_add(first, walked.cast("int"))
    # a date read as month/day stays one only if its day is above 12; else it is written as day/month, which is a date as well
    american_out = F.when(F.dayofmonth(new) > 12, F.date_format(new, "MM/dd/yyyy")).otherwise(F.date_format(new, "dd/MM/yyyy"))
    out = F.when(iso, F.date_format(new, "yyyy-MM-dd")).when(american, american_out).when(slash, F.date_format(new, "dd/MM/yyyy")).otherwise(F.date_format(new, "dd.MM.yyyy"))
    return F.when(day.isNull(), m).otherwise(out)


def _email(m: Column, key: Column) -> Column:
    low = F.lower(m)
    name = F.sha2(F.concat_ws("|", key, F.lit("email"), low), 256)
    host = F.sha2(F.concat_ws("|", key, F.lit("domain"), F.substring_index(low, "@", -1)), 256)
    return F.concat(F.lit("u"), F.substring(name, 1, 12), F.lit("@d"), F.substring(host, 1, 10), F.lit(".invalid"))


_MASKS = {"email": _email, "iban": _iban, "ipv4": _ipv4, "date": _date, "ssn": _ssn, "card": _card, "phone": _phone}


def pseudonym(match: Column, key: Column) -> Column:
    """The pseudonym of one match of ANY, by the first kind that it is a whole match of."""
    out = match
    for kind in reversed(_MASKS):
        out = F.when(match.rlike(f"^(?:{KINDS[kind]})$"), _MASKS[kind](match, key)).otherwise(out)
    return out


def mask_pii(docs: DataFrame, key: str, column: str = "text") -> DataFrame:
    """*docs* with the column masked; all other columns stay."""
    text = F.col(column)
    woven = _woven(text, ANY, lambda m: pseudonym(m, F.lit(key)))
    return docs.withColumn(column, F.when(text.rlike("[0-9@]") & text.rlike(ANY), woven).otherwise(text))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    masked = mask_pii(docs.select("doc_id", F.col("text").alias("_before"), "text"), QUERY_KEY)
    return masked.select(F.col("doc_id").cast("long"), "text", (~F.col("_before").eqNullSafe(F.col("text"))).alias("changed"))
