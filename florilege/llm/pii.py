"""Private data in texts replaced by keyed pseudonyms of the same format, with Spark SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from florilege.llm.expressions import let

ROUNDS = 10

#: Up to the 127 labels that a name of 253 characters may hold; a longer run is no address and stays. All repeated groups
#: are possessive, since Java matches others by one call a repetition and its stack is bounded.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++){1,126}+(?!\.[A-Za-z0-9-])"
KEY_ID = r"(?<!\w)AKIA[A-Z0-9]{16}(?!\w)"
#: The value of a secret runs to its closing quote in the line, without one to white space, whatever its length.
_IN = {q: rf"(?:[^{q}\r\n]|(?<=\\){q})" for q in (r"\x22", "'")}
_QUOTED = "|".join(rf"{q}(?={c}{{8}})[^{q}\r\n]*+(?:(?<=\\){q}[^{q}\r\n]*+)*+{q}" for q, c in _IN.items())
_SHORT = "|".join(rf"{q}{c}{{0,7}}+(?<!\\){q}" for q, c in _IN.items())
_BARE = rf"(?!{_SHORT})(?=[^\s\u00a0\u3000]{{8}})[^\s\u00a0\u3000]++"
_SIGN = r"(?:=>|:=|[=:])(?![=:])\s{0,3}"
#: Parts of a name before the keyword (access_token, DB_PASSWORD, clientSecret) need not be found: they stay.
SECRET = rf"(?:(?<![A-Za-z0-9])(?i:password|passwd|token|secret|api[_-]?key)|(?<=[a-z0-9])(?:Password|Passwd|Token|Secret|Api[_-]?Key))(?i:[_-]?(?:access[_-]?)?key)?[\x22']?\s{{0,3}}{_SIGN}(?:{_QUOTED}|{_BARE})"
#: Lengths of the IBAN register, needed to tell where a grouped one ends.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK|FI|FK|FO|GL|NL|SD", 19: "MK|SI", 20: "AT|BA|EE|KZ|LT|LU|MN|XK", 21: "CH|HR|LI|LV", 22: "BG|BH|CR|DE|GB|GE|IE|ME|RS|VA",
    23: "AE|GI|IL|IQ|OM|SO|TL", 24: "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG", 25: "LY|PT|ST", 26: "IS|TR", 27: "BI|DJ|FR|GR|IT|MC|MR|SM",
    28: "AL|AZ|BY|CY|DO|GT|HN|HU|LB|NI|PL|SV", 29: "BR|EG|PS|QA|UA", 30: "JO|KW|MU|YE", 31: "MT|SC", 32: "LC", 33: "RU",
}
_GROUPS = "|".join(rf"(?<=(?:{c})\d\d)(?:[ \u00a0][A-Z0-9]{{4}}){{{n // 4 - 1}}}" + (rf"[ \u00a0][A-Z0-9]{{{n % 4}}}" if n % 4 else "") for n, c in IBAN_LENGTHS.items())
IBAN = rf"(?<!\w)[A-Z]{{2}}\d{{2}}(?:[A-Z0-9]{{11,30}}|{_GROUPS})(?!\w)"
DATE = r"(?<![\w./-])(?:\d{4}-\d{2}-\d{2}(?:(?=[Tt]\d)|(?![\w/-]|\.\d))|\d{1,2}[./]\d{1,2}[./]\d{4}(?![\w/-]|\.\d))"
IPV4 = r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d)"
SSN = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
PHONE = r"(?<![\w+])\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,4}(?!\w)|(?<![\w.])\(\d{3}\) ?\d{3}-\d{4}(?!\w)|(?<![\w.-])\d{3}-\d{3}-\d{4}(?![\w-])"
CARD = r"(?<![\w.])\d(?:[ -]?\d){12,18}(?!\w)"
#: One pass finds a superset of all kinds; each find is then classified and validated by itself.
ANY = "|".join([EMAIL, KEY_ID, SECRET, IBAN, DATE, IPV4, SSN, PHONE, CARD])
KINDS = ("email", "key", "secret", "iban", "date", "ipv4", "ssn", "phone", "card")

#: A 400-year cycle of the calendar has 146,097 = 189 * 773 days, so a Feistel network on the two factors permutes them.
DAYS = (189, 773)
FIRST_DAY = "1800-01-01"
#: Valid social security numbers: areas 001 to 899 but 666, groups 01 to 99 with serials 0001 to 9999.
SSN_DOMAIN = (898, 99 * 9999)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _at(s: Column, i) -> Column:
    return F.substring(s, i, F.lit(1)) if isinstance(i, Column) else F.substring(s, i, 1)


def _luhn_sum(digits: Column) -> Column:
    """Of a number whose check digit is still to be put after it."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = _at(digits, n - i + 1).cast("int")
        doubled = d * 2 - F.when(d > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 1, doubled).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)


def _luhn_digit(payload: Column) -> Column:
    return F.pmod(F.lit(10) - F.pmod(_luhn_sum(payload), F.lit(10)), F.lit(10))


def _mod97(s: Column) -> Column:
    def add(r: Column, i: Column) -> Column:
        code = F.ascii(_at(s, i))
        return F.pmod(F.when(code < 65, r * 10 + code - 48).otherwise(r * 100 + code - 55), F.lit(97))

    return F.aggregate(F.sequence(F.lit(1), F.length(s)), F.lit(0), add)


def _prf(key: str, tweak: Column, i: Column, half: Column) -> Column:
    """60 pseudorandom bits of a keyed hash."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), tweak, i.cast("string"), half.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _feistel(key: str, tweak: Column, left: Column, right: Column, m_left: Column, m_right: Column) -> Column:
    """A keyed permutation of the pairs ``(left, right)`` below ``m_left`` and ``m_right``: in each round a keyed hash
    of one half is added to the other, modulo its range."""

    def step(s: Column, i: Column) -> Column:
        into_left = F.struct(F.pmod(s["l"] + F.pmod(_prf(key, tweak, i, s["r"]), m_left), m_left).alias("l"), s["r"].alias("r"))
        into_right = F.struct(s["l"].alias("l"), F.pmod(s["r"] + F.pmod(_prf(key, tweak, i, s["l"]), m_right), m_right).alias("r"))
        return F.when(i % 2 == 0, into_left).otherwise(into_right)

    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)


def _power_of_ten(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, F.lit("0")).cast("long")


def _permute_digits(key: str, kind: str, digits: Column) -> Column:
    """Digit strings of one length are permuted among themselves (up to 36 digits, one digit in the left half alone)."""
    n = F.length(digits)
    u = F.floor(n / 2).cast("int")
    v = n - u
    left, right = F.when(u > 0, F.substring(digits, F.lit(1), u)).otherwise("0"), F.substring(digits, u + 1, v)
    pair = _feistel(key, F.concat(F.lit(kind), n.cast("string")), left, right, _power_of_ten(u), _power_of_ten(v))
    return F.transform(F.array(pair), lambda p: F.concat(F.when(u > 0, F.lpad(p["l"].cast("string"), u, F.lit("0"))).otherwise(""), F.lpad(p["r"].cast("string"), v, F.lit("0"))))[0]


def _refill(template: Column, digits: Column) -> Column:
    """``template`` with its digits replaced, in order, by those of ``digits``."""

    def add(s: Column, i: Column) -> Column:
        c = _at(template, i)
        isdigit = c.rlike("^[0-9]$")
        return F.struct(F.concat(s["o"], F.when(isdigit, _at(digits, s["k"])).otherwise(c)).alias("o"), (s["k"] + F.when(isdigit, 1).otherwise(0)).alias("k"))

    return F.aggregate(F.sequence(F.lit(1), F.length(template)), F.struct(F.lit("").alias("o"), F.lit(1).alias("k")), add, lambda s: s["o"])


def _email(key: str, m: Column) -> Column:
    digest = F.sha2(F.concat(F.lit(key + "|email|"), F.lower(m)), 256)
    return F.concat(F.lit("u"), F.substring(digest, 1, 16), F.lit("@"), F.substring(digest, 17, 8), F.lit(".example"))


def _secret(key: str, m: Column) -> Column:
    """The value after the sign becomes a keyed hash of as many hexadecimal digits.

    Punctuation after a value without quotes is replaced with it but leaves the digits before as they are without it."""
    head = F.regexp_extract(m, rf"^([^=:]*{_SIGN}[\x22']?)", 1)
    rest = F.substring(m, F.length(head) + 1, F.length(m))
    tail = F.regexp_extract(rest, r"([\x22'][\])},;.>]*)$", 1)

    def blocks(v: Column) -> Column:
        first = F.sha2(F.concat(F.lit(f"{key}|secret0|"), F.coalesce(F.nullif(F.regexp_replace(v, r"[.,;:!?)\]}>]+$", ""), F.lit("")), v)), 256)
        more = lambda d: F.transform(F.sequence(F.lit(0), F.floor((F.length(v) - 1) / 64).cast("int")), lambda k: F.when(k == 0, d).otherwise(F.sha2(F.concat(F.lit(f"{key}|secret"), k.cast("string"), F.lit("|"), d), 256)))
        return F.substring(let(first, lambda d: F.array_join(more(d), "")), F.lit(1), F.length(v))

    return F.concat(head, let(F.substring(rest, F.lit(1), F.length(rest) - F.length(tail)), blocks), tail)


def _key_id(key: str, m: Column) -> Column:
    digest = F.sha2(F.concat(F.lit(key + "|key|"), m), 256)
    return F.concat(F.lit("AKIA"), F.translate(F.upper(F.substring(digest, 1, 16)), "01234567", "GHIJKLMN"))


def _compact(m: Column) -> Column:
    return F.translate(m, " \u00a0", "")


def _iban(key: str, m: Column) -> Column:
    country, body = F.substring(m, 1, 2), F.substring(m, F.lit(5), F.length(m))

    def checked(new: Column) -> Column:
        check = F.lit(98) - _mod97(F.concat(_compact(new), country, F.lit("00")))
        return F.concat(country, F.lpad(check.cast("string"), 2, "0"), new)

    return F.when(F.length(_digits(body)) == 0, m).otherwise(let(_refill(body, _permute_digits(key, "iban", _digits(body))), checked))


def _iban_ok(m: Column) -> Column:
    return _mod97(_compact(F.concat(F.substring(m, F.lit(5), F.length(m)), F.substring(m, 1, 4)))) == 1


def _no_iban(m: Column) -> Column:
    """Of what only looks like a grouped IBAN, the first group: the rest may be a number of another kind."""
    return F.when(m.rlike(r"^[A-Z]{2}[0-9]{2}[ \u00a0]") & m.rlike(f"^(?:{IBAN})$"), F.when(~_iban_ok(m), F.substring(m, 1, 5))).otherwise(F.lit(None).cast("string"))


def _ipv4_ok(m: Column) -> Column:
    return F.forall(F.split(m, r"\."), lambda x: x.cast("int") <= 255)


def _ipv4(key: str, m: Column) -> Column:
    p = F.split(m, r"\.")
    pair = _feistel(key, F.lit("ipv4"), p[0].cast("int") * 256 + p[1].cast("int"), p[2].cast("int") * 256 + p[3].cast("int"), F.lit(65536), F.lit(65536))
    return let(pair, lambda q: F.concat_ws(".", F.floor(q["l"] / 256), q["l"] % 256, F.floor(q["r"] / 256), q["r"] % 256))


def _ssn_ok(m: Column) -> Column:
    p = F.split(m, "-")
    return ~p[0].isin("000", "666") & (p[0] < "900") & (p[1] != "00") & (p[2] != "0000")


def _ssn(key: str, m: Column) -> Column:
    p = F.transform(F.split(m, "-"), lambda x: x.cast("int"))
    area = p[0] - F.when(p[0] > 666, 2).otherwise(1)
    pair = _feistel(key, F.lit("ssn"), area, (p[1] - 1) * 9999 + p[2] - 1, F.lit(SSN_DOMAIN[0]), F.lit(SSN_DOMAIN[1]))

    def back(q: Column) -> Column:
        area = q["l"] + F.when(q["l"] >= 665, 2).otherwise(1)
        return F.concat_ws("-", F.lpad(area.cast("string"), 3, "0"), F.lpad((F.floor(q["r"] / 9999) + 1).cast("string"), 2, "0"), F.lpad((q["r"] % 9999 + 1).cast("string"), 4, "0"))

    return let(pair, back)


def _date_parts(m: Column) -> Column:
    """``(day, style)``: ISO, day before month with dots, month before day with slashes or else day before month."""
    p = F.split(m, "[./-]")
    iso = F.try_to_date(m, "yyyy-MM-dd")
    dotted = F.try_to_date(F.concat_ws("-", p[2], F.lpad(p[1], 2, "0"), F.lpad(p[0], 2, "0")), "yyyy-MM-dd")
    slashed = F.try_to_date(F.concat_ws("-", p[2], F.lpad(p[0], 2, "0"), F.lpad(p[1], 2, "0")), "yyyy-MM-dd")
    style = F.when(m.rlike("^[0-9]{4}-"), F.lit("iso")).when(m.contains("/") & slashed.isNotNull(), F.lit("mdy")).otherwise(F.lit("dmy"))
    day = F.when(style == "iso", iso).when(style == "mdy", slashed).otherwise(dotted)
    return F.struct(F.datediff(day, F.lit(FIRST_DAY).cast("date")).alias("n"), style.alias("style"))


def _date_ok(m: Column) -> Column:
    return let(_date_parts(m), lambda d: F.coalesce((d["n"] >= 0) & (d["n"] < DAYS[0] * DAYS[1]), F.lit(False)))


def _date(key: str, m: Column) -> Column:
    """Another day of the same 400 years in the same order and with the same separator."""
    sep = F.regexp_extract(m, "([./-])", 1)

    def back(d: Column) -> Column:
        pair = _feistel(key, F.lit("date"), F.floor(d["n"] / DAYS[1]), d["n"] % DAYS[1], F.lit(DAYS[0]), F.lit(DAYS[1]))

        def text(day: Column) -> Column:
            y, mo, dd = F.date_format(day, "yyyy"), F.date_format(day, "MM"), F.date_format(day, "dd")
            return F.when(d["style"] == "iso", F.concat_ws("-", y, mo, dd)).when(d["style"] == "mdy", F.concat(mo, sep, dd, sep, y)).otherwise(F.concat(dd, sep, mo, sep, y))

        return let(pair, lambda q: let(F.date_add(F.lit(FIRST_DAY).cast("date"), (q["l"] * DAYS[1] + q["r"]).cast("int")), text))

    return let(_date_parts(m), back)


def _phone(key: str, m: Column) -> Column:
    """The country code stays."""
    head = F.regexp_extract(m, r"^(\+[0-9]{1,3}(?=[ .(-]))", 1)
    rest = F.substring(m, F.length(head) + 1, F.length(m))
    return F.concat(head, _refill(rest, _permute_digits(key, "phone", _digits(rest))))


def _card_ok(m: Column) -> Column:
    return let(_digits(m), lambda d: _luhn_digit(F.substring(d, F.lit(1), F.length(d) - 1)).cast("string") == F.substring(d, -1, 1))


def _card(key: str, m: Column) -> Column:
    """All digits but the check digit are permuted; the new check digit follows from them."""
    payload = F.substring(_digits(m), F.lit(1), F.length(_digits(m)) - 1)
    return let(_permute_digits(key, "card", payload), lambda d: _refill(m, F.concat(d, _luhn_digit(d).cast("string"))))


def _kind(m: Column) -> Column:
    """The kind of a find, null if it doesn't hold as one."""
    full = lambda pattern: m.rlike(f"^(?:{pattern})$")
    return (
        F.when(m.contains("@") & full(EMAIL), "email")
        .when(full(KEY_ID), "key")
        .when(full(SECRET), "secret")
        .when(full(IBAN), F.when(_iban_ok(m), "iban"))
        .when(full(DATE), F.when(_date_ok(m), "date"))
        .when(full(IPV4), F.when(_ipv4_ok(m), "ipv4"))
        .when(full(SSN), F.when(_ssn_ok(m), "ssn"))
        .when(full(PHONE), "phone")
        .when(full(CARD) & _card_ok(m), "card")
    )


def pseudonym(find: Column, kind: Column, key: str) -> Column:
    """Equal finds get equal pseudonyms in all documents. Numbers and dates are permuted, so different valid values of
    one format keep different pseudonyms; addresses and secrets become keyed hashes."""
    by_kind = {"email": _email, "key": _key_id, "secret": _secret, "iban": _iban, "date": _date, "ipv4": _ipv4, "ssn": _ssn, "phone": _phone, "card": _card}
    out = None
    for name, make in by_kind.items():
        out = F.when(kind == name, make(key, find)) if out is None else out.when(kind == name, make(key, find))
    return F.coalesce(out, find)


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", kinds_col: str | None = None) -> DataFrame:
    """``docs`` with the private data of ``text_col`` replaced; ``kinds_col`` names a column for the kinds replaced, in
    order of their place in the text.

    A row changes by itself, so no rows move; texts are read whole, however long they or their finds are. Numbers that fail their check (Luhn, mod 97, ranges, calendar) and dates
    outside 1800 to 2199 stay. Null stays null, and an empty text or an empty table stays empty; all other columns
    pass unchanged, whatever their names.
    """
    found, gaps = "__florilege_found", "__florilege_gaps"

    def one(find: Column) -> Column:
        replaced = lambda p: let(_kind(p["m"]), lambda k: F.struct(k.alias("kind"), F.concat(p["head"], pseudonym(p["m"], k, key)).alias("new")))
        return let(F.coalesce(_no_iban(find), F.lit("")), lambda h: let(F.struct(h.alias("head"), F.substring(find, F.length(h) + 1, F.length(find)).alias("m")), replaced))

    text = F.col(f"`{text_col}`").cast("string")
    marked = docs.withColumn(found, F.regexp_extract_all(text, F.lit(ANY), F.lit(0)))
    marked = marked.withColumn(gaps, F.when(F.size(found) > 0, F.split(text, ANY, -1)))
    marked = marked.withColumn(found, F.transform(found, one))
    parts = F.zip_with(F.col(found), F.slice(F.col(gaps), F.lit(2), F.greatest(F.size(found), F.lit(0))), lambda p, g: F.concat(p["new"], g))
    new = F.when(F.size(found) > 0, F.concat(F.col(gaps)[0], F.array_join(parts, ""))).otherwise(text)
    out = marked.withColumn(text_col, new)
    if kinds_col is not None:
        out = out.withColumn(kinds_col, F.coalesce(F.filter(F.transform(found, lambda p: p["kind"]), lambda k: k.isNotNull()), F.array().cast("array<string>")))
    return out.drop(found, gaps)
