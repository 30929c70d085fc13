r"""Personal data replaced by format-preserving pseudonyms, in DataFrame operations only.

Found and validated: e-mail addresses, IPv4 addresses (octets to 255), calendar dates (``1999-12-31``,
``31/12/1999``, ``12/31/1999``, ``31.12.1999``, with or without leading zeros; impossible dates are no dates), card
numbers of 13 to 19 digits (Luhn), IBAN (length by country, mod 97) and social security numbers (no part zero).
By their notation alone, as they have no check digits: telephone numbers, access keys, long hexadecimal tokens and
``password=`` or ``password: `` values. What does not validate stays as it is.

Numbers pass a keyed Feistel network over their own digits: two halves of the digit string, ``ROUNDS`` rounds
that add SHA-256(key, class, length, round, other half) to one half modulo its power of ten. This permutes
the numbers of one class and length, so equal values get equal pseudonyms in every document, and different
values different ones. Separators stay in place. Cards permute all digits but the last, which becomes the
new Luhn digit; IBAN the digits of the account, with new check digits; addresses permute their 32 bits; dates their
day number within 1900-2099 (or another such 200 years), and social security numbers their digits, walking the cycle
until the format holds again. Letters (e-mail names, keys, tokens) are replaced by keyed digests of the value.

A text is split at the matches and put together again with their pseudonyms, row by row: no shuffle, so no
skew. Without the key the pseudonyms cannot be computed; it is a parameter and never stored.

Defined cases: null stays null, empty stays empty; repeated rows are treated one by one; texts of any length
are treated whole; an empty table gives an empty result; other columns pass through, and one named like the
count column is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdmflow.llm.common import fresh

ROUNDS = 10
_EDGE, _END = r"(?<![0-9A-Za-z])", r"(?![0-9A-Za-z])"
# names of mail and domains are bounded as mail bounds them (64 characters, 127 labels): no text makes the search deep or slow
_EMAIL = r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,125}\.[A-Za-z]{2,63}"
_ACCESS = r"(?:AKIA|ASIA)[0-9A-Z]{16}"
_HEX = r"(?=[0-9]*[a-f])(?=[a-f]*[0-9])[0-9a-f]{32,64}|(?=[0-9]*[A-F])(?=[A-F]*[0-9])[0-9A-F]{32,64}"
# IBAN length by country; a country not listed is read when written without spaces.
_IBAN_SIZES = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU",
    31: "MT SC", 32: "LC"}
_IBAN = "(?=[A-Z]{2}[0-9]{2})(?:" + "|".join(
    f"(?:{names.replace(' ', '|')})[0-9]{{2}}(?: ?[0-9A-Z]{{4}}){{{(n - 4) // 4}}}" + (f"(?: ?[0-9A-Z]{{{n % 4}}})" if n % 4 else "")
    for n, names in _IBAN_SIZES.items()) + f"|(?!{'|'.join(' '.join(_IBAN_SIZES.values()).split())})[A-Z]{{2}}[0-9]{{2}}[0-9A-Z]{{11,30}})"
_VALUE = rf"(?![\"']?(?:{_HEX}){_END})[^\s,;]+"
_SPACED = r"(?:[ \t]+[=:][ \t]*|[=:][ \t]+)"
_SECRET = (r"(?:(?i:passwords?|passwd|pwd|secret|token|api_?key)[=:][^\s,;]+"
           rf"|(?i:password|passwd|pwd|api_?key){_SPACED}{_VALUE}"
           rf"|(?i:passwords|secret|token){_SPACED}(?=[^\s,;]*[0-9]){_VALUE})")  # the words stand in prose too
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_IP = rf"{_OCTET}(?:\.{_OCTET}){{3}}(?!\.[0-9])"
_DATE = r"[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}"
_PHONE = r"(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|(?:\+[0-9]{1,3}[ .-])?[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}|\+[0-9]{8,15}"
_SSN = r"(?!000|666)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}"
# bare, 4-6-4 or 4-6-5, or groups of four with a shorter last one
_SHORT = r"[ -][0-9]{1,3}(?![ -]?[0-9])"
_NUMBER = (rf"[0-9]{{13,19}}|[0-9]{{4}}[ -][0-9]{{6}}[ -][0-9]{{4,5}}"
           rf"|[0-9]{{4}}(?:(?:[ -][0-9]{{4}}){{3,}}(?:{_SHORT})?|(?:[ -][0-9]{{4}}){{2}}{_SHORT})")
_ALL = (rf"{_EDGE}(?:{_SECRET}|{_EMAIL}|(?:{_ACCESS}|{_HEX}|{_IBAN}|{_IP}|{_DATE}|{_SSN}|{_NUMBER}){_END})"
        rf"|(?<![0-9A-Za-z+])(?:{_PHONE}){_END}")
_MAYBE = "[0-9@=:]"


def _mix(key: str, kind: str, n: Column, i: Column, half: Column) -> Column:
    """A keyed number below 2**60."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), n.cast("string"), i.cast("string"), half.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _feistel(key: str, kind: str, n: Column, left: Column, right: Column, m_left: Column, m_right: Column) -> Column:
    """struct(l, r) of the permuted pair."""
    def one(acc, i):
        l = F.when(i % 2 == 0, F.pmod(acc["l"] + _mix(key, kind, n, i, acc["r"]), m_left)).otherwise(acc["l"])
        r = F.when(i % 2 == 1, F.pmod(acc["r"] + _mix(key, kind, n, i, acc["l"]), m_right)).otherwise(acc["r"])
        return F.struct(l.alias("l"), r.alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)),
                       F.struct(left.cast("long").alias("l"), right.cast("long").alias("r")), one)


def _let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _power(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, "0").cast("long")


def permuted_digits(key: str, kind: str, digits: Column) -> Column:
    """The pseudonym of a digit string of 2 to 36 digits, as long as the value."""
    n = F.length(digits)
    half = F.floor(n / 2).cast("int")
    pair = _feistel(key, kind, n, digits.substr(F.lit(1), half), digits.substr(half + 1, n), _power(half), _power(n - half))
    return _let(pair, lambda p: F.concat(F.lpad(p["l"].cast("string"), half, "0"), F.lpad(p["r"].cast("string"), n - half, "0")))


def _in_format(value: Column, digits: Column) -> Column:
    """``digits`` written over the digits of ``value``."""
    def put(acc, c):
        digit = c.rlike("^[0-9]$")
        return F.struct(F.concat(acc["out"], F.when(digit, F.substr(acc["new"], acc["k"], F.lit(1))).otherwise(c)).alias("out"),
                        (acc["k"] + digit.cast("int")).alias("k"), acc["new"].alias("new"))
    return F.aggregate(F.split(value, ""), F.struct(F.lit("").alias("out"), F.lit(1).alias("k"), digits.alias("new")),
                       put, lambda acc: acc["out"])


def _ssn(key: str, digits: Column) -> Column:
    """Nine digits of the same kind: numbers that begin with 9 among themselves, others among those that are issued."""
    def walked(kind: str, of: Column, valid: str) -> Column:
        step = lambda x: permuted_digits(key, kind, x)
        return F.aggregate(F.sequence(F.lit(1), F.lit(20)), step(of), lambda x, i: F.when(x.rlike(valid), x).otherwise(step(x)))
    rest = "(?!00)[0-9]{2}(?!0000)[0-9]{4}$"
    return F.when(digits.startswith("9"), F.concat(F.lit("9"), walked("itin", F.substring(digits, 2, 8), "^[0-9]{2}" + rest))).otherwise(
        walked("ssn", digits, "^(?!000|666|9)[0-9]{3}" + rest))


def _luhn_sum(digits: Column, doubled_first: int) -> Column:
    """Luhn sum from the right; ``doubled_first`` is 0 if the last digit is doubled, 1 if the one before."""
    def add(acc, c):
        d = c.cast("int") * F.when(acc["k"] % 2 == doubled_first, 2).otherwise(1)
        return F.struct((acc["s"] + F.when(d > 9, d - 9).otherwise(d)).alias("s"), (acc["k"] + 1).alias("k"))
    return F.aggregate(F.split(F.reverse(digits), ""), F.struct(F.lit(0).alias("s"), F.lit(0).alias("k")), add, lambda acc: acc["s"])


def luhn_valid(digits: Column) -> Column:
    return _luhn_sum(digits, 1) % 10 == 0


def _card(key: str, digits: Column) -> Column:
    body = permuted_digits(key, "card", digits.substr(F.lit(1), F.length(digits) - 1))
    return _let(body, lambda b: F.concat(b, F.pmod(10 - _luhn_sum(b, 0) % 10, F.lit(10)).cast("string")))


def _cards(key: str, value: Column) -> Column:
    """Every card number in a run of digit groups becomes its pseudonym: from the left, four groups with a short
    fifth, or four, whose digits pass Luhn; a bare number or three groups only as a whole. Other digits stay."""
    digits = lambda w: F.regexp_replace(w, "[^0-9]", "")
    valid = lambda w: F.length(digits(w)).between(13, 19) & luhn_valid(digits(w)) & ~w.rlike("^(?:(?:19|20)[0-9]{2}[ -]?)+$")
    made = lambda w: _in_format(w, _card(key, digits(w)))

    def walk(groups):
        def add(acc, i):
            five, four = (F.array_join(F.slice(groups, i, n), "") for n in (5, 4))
            whole = lambda n: i + n - 1 <= F.size(groups)
            took = F.when(i < acc["next"], 0).when(whole(5) & valid(five), 5).when(whole(4) & valid(four), 4).otherwise(1)
            return _let(took, lambda n: F.struct(
                F.concat(acc["out"], F.when(n == 0, F.lit("")).when(n == 5, made(five)).when(n == 4, made(four))
                         .otherwise(F.element_at(groups, i))).alias("out"),
                F.when(n == 0, acc["next"]).otherwise(i + n).alias("next")))
        return F.aggregate(F.sequence(F.lit(1), F.size(groups)), F.struct(F.lit("").alias("out"), F.lit(1).alias("next")), add,
                           lambda acc: acc["out"])

    run = F.regexp_extract_all(value, F.lit("[0-9]+[ -]?"), F.lit(0))
    return F.when(F.size(run) > 3, _let(run, walk)).when(valid(value), made(value)).otherwise(value)


def _mod97(text: Column) -> Column:
    """The remainder of an IBAN's letters and digits, country and check digits last."""
    def add(acc, c):
        digit = c.rlike("^[0-9]$")
        return F.when(digit, (acc * 10 + F.ascii(c) - 48) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(F.split(text, ""), F.lit(0), add)


def iban_valid(value: Column) -> Column:
    plain = F.replace(value, F.lit(" "))
    return _mod97(F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4))) == 1


def _iban(key: str, value: Column) -> Column:
    """Country and bank letters stay, the digits of the account are permuted, the check digits follow."""
    rest = F.substr(value, F.lit(5))
    digits = F.regexp_replace(rest, "[^0-9]", "")
    made = F.when(F.length(digits) > 1, _in_format(rest, permuted_digits(key, "iban", digits))).otherwise(rest)
    check = lambda b: F.lpad((98 - _mod97(F.concat(F.replace(b, F.lit(" ")), F.substring(value, 1, 2), F.lit("00")))).cast("string"), 2, "0")
    return _let(made, lambda b: F.concat(F.substring(value, 1, 2), check(b), b))


def _address(key: str, value: Column) -> Column:
    return _let(F.transform(F.split(value, r"\."), lambda o: o.cast("long")), lambda o: _let(
        _feistel(key, "ip", F.lit(4), o[0] * 256 + o[1], o[2] * 256 + o[3], F.lit(65536).cast("long"), F.lit(65536).cast("long")),
        lambda p: F.concat_ws(".", *[x.cast("string") for x in (
            F.shiftright(p["l"], 8), p["l"] % 256, F.shiftright(p["r"], 8), p["r"] % 256)])))


def _date_of(value: Column) -> Column:
    """struct(d, p): the calendar date and its notation; with slashes the day comes first unless it cannot."""
    padded = value.rlike("^[0-9]{2}[/.][0-9]{2}[/.]|^[0-9]{4}-[0-9]{2}-[0-9]{2}$")
    read = lambda loose, full: _let(F.to_date(F.try_to_timestamp(value, F.lit(loose))), lambda d: F.when(
        d.isNotNull(), F.struct(d.alias("d"), F.when(padded, F.lit(full)).otherwise(F.lit(loose)).alias("p"))))
    return (F.when(value.contains("-"), read("yyyy-M-d", "yyyy-MM-dd")).when(value.contains("."), read("d.M.yyyy", "dd.MM.yyyy"))
            .otherwise(F.coalesce(read("d/M/yyyy", "dd/MM/yyyy"), read("M/d/yyyy", "MM/dd/yyyy"))))


def _notation(date: Column) -> Column:
    patterns = ["yyyy-MM-dd", "yyyy-M-d", "dd.MM.yyyy", "d.M.yyyy", "dd/MM/yyyy", "d/M/yyyy", "MM/dd/yyyy"]
    out = F.date_format(date["d"], "M/d/yyyy")
    for p in patterns:
        out = F.when(date["p"] == p, F.date_format(date["d"], p)).otherwise(out)
    return out


def _date(key: str, value: Column) -> Column:
    """A date of the same 200 years (1900-2099, 1700-1899, ...) in the same notation; no calendar date: the value."""
    step = lambda x: _let(_feistel(key, "date", F.lit(5), F.floor(x / 1000), x % 1000, F.lit(100).cast("long"), F.lit(1000).cast("long")),
                          lambda p: p["l"] * 1000 + p["r"])

    def moved(date, first, days):
        day = F.datediff(date["d"], first).cast("long")
        walked = F.aggregate(F.sequence(F.lit(1), F.lit(40)), step(day), lambda x, i: F.when(x < days, x).otherwise(step(x)))
        return _notation(F.struct(F.date_add(first, F.pmod(walked, days).cast("int")).alias("d"), date["p"].alias("p")))

    def within(date):
        start = (F.floor((F.year(date["d"]) - 100) / 200) * 200 + 100).cast("int")
        first = F.make_date(F.greatest(start, F.lit(1)), F.lit(1), F.lit(1))
        last = F.make_date(F.least(start + 199, F.lit(9999)), F.lit(12), F.lit(31))
        return _let(F.struct(first.alias("first"), (F.datediff(last, first) + 1).cast("long").alias("days")),
                    lambda b: moved(date, b["first"], b["days"]))

    return _let(_date_of(value), lambda d: F.when(d.isNull(), value).otherwise(within(d)))


def _digest(key: str, kind: str, value: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), value), 256)


def _whole(pattern: str, value: Column) -> Column:
    return value.rlike(rf"^(?:{pattern})$")


def _phone(key: str, value: Column) -> Column:
    """The country code stays, so a number is linked with and without it."""
    code = F.regexp_extract(value, r"^\+[0-9]{1,3}[ .-]?(?=[(0-9])", 0)
    rest = F.substr(value, F.length(code) + 1)
    return F.concat(code, _in_format(rest, permuted_digits(key, "phone", F.regexp_replace(rest, "[^0-9]", ""))))


def _token(key: str, value: Column) -> Column:
    """Both cases of one hexadecimal token get the same pseudonym, each in its own case."""
    made = _digest(key, "hex", F.lower(value)).substr(F.lit(1), F.length(value))
    return F.when(value == F.upper(value), F.upper(made)).otherwise(made)


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of one match of the pattern; the value itself if it does not validate."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    permuted = lambda kind: _in_format(value, permuted_digits(key, kind, digits))
    name = F.regexp_extract(value, "^([^=:]*[=:][ \t]*)", 1)
    return (F.when(_whole(_SECRET, value), F.concat(name, F.substring(_digest(key, "secret", value), 1, 18)))
            .when(_whole(_EMAIL, value), F.concat(F.lit("u"), F.substring(_digest(key, "email", F.lower(value)), 1, 12), F.lit("@mail.invalid")))
            .when(_whole(_ACCESS, value), F.concat(F.substring(value, 1, 4), F.upper(F.substring(_digest(key, "access", value), 1, 16))))
            .when(_whole(_HEX, value), _token(key, value))
            .when(_whole(_IP, value), _address(key, value))
            .when(_whole(_DATE, value), _date(key, value))
            .when(_whole(_IBAN, value), F.when(iban_valid(value), _iban(key, value)).otherwise(value))
            .when(_whole(_SSN, value), _in_format(value, _ssn(key, digits)))
            .when(_whole(_NUMBER, value), _cards(key, value))
            .otherwise(_phone(key, value)))


def pseudonymise(df: DataFrame, key: str, *, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``df`` with personal data in ``text_col`` replaced; ``count_col`` adds the number of replaced values."""
    if count_col:
        df = df.drop(count_col)
    text = F.col(text_col).cast("string")
    some = text.rlike(_MAYBE)
    matches = F.when(some, F.regexp_extract_all(text, F.lit(_ALL), F.lit(0))).otherwise(F.array().cast("array<string>"))
    found, named = fresh(df, "_matches"), fresh(df, "_renamed")
    marked = df.withColumn(found, matches)
    marked = marked.withColumn(named, F.transform(found, lambda m: pseudonym(m, key)))
    between = F.split(text, _ALL, -1)
    renamed = F.concat(named, F.array(F.lit("")))
    joined = F.array_join(F.zip_with(between, renamed, lambda a, b: F.concat(a, b)), "")
    out = marked.withColumn(text_col, F.when(F.size(found) > 0, joined).otherwise(text))
    if count_col:
        changed = F.filter(F.zip_with(found, named, lambda a, b: a != b), lambda x: x)
        out = out.withColumn(count_col, F.coalesce(F.size(changed), F.lit(0)))
    return out.drop(found, named)
